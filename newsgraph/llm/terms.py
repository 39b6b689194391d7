"""Exact terms of whole texts, as Arrow string arrays.

Terms are what lies between runs of separator bytes, after lower-casing A-Z
only; they keep their bytes, so equal terms are equal strings, not equal
hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: separators of ``[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+``
NOT_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: separators of ``[^\x00-\x40\x5B-\x60\x7B-\x7F]+``
NOT_LETTER = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"

SLICE_ROWS = 2000
SLICE_BYTES = 8 << 20


def slices(batch: pa.RecordBatch, column: str) -> Iterator[pa.RecordBatch]:
    """``batch`` in pieces of bounded rows and bytes of one string column (a
    single longer text is a piece of its own)."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < batch.num_rows:
        done = ends[at - 1] if at else 0
        to = int(np.searchsorted(ends, done + SLICE_BYTES, "right"))
        to = min(max(to, at + 1), at + SLICE_ROWS, batch.num_rows)
        yield batch.slice(at, to - at)
        at = to


def split_terms(texts: pa.Array, separators: str) -> tuple[np.ndarray, pa.Array]:
    """(row, term) of all terms in order; a null text has none."""
    whole = pc.fill_null(texts, "").cast(pa.large_string())
    # Arrow's string kernels misread a cast slice of a column: give them an array that begins at 0
    whole = pc.ascii_lower(pa.concat_arrays([whole, pa.array([], pa.large_string())]))
    lists = pc.split_pattern_regex(whole, separators)
    flat = lists.flatten()
    rows = np.repeat(np.arange(len(texts)), pc.list_value_length(lists).to_numpy(zero_copy_only=False))
    some = pc.greater(pc.binary_length(flat), 0)  # a text may begin or end with separators
    return rows[some.to_numpy(zero_copy_only=False)], flat.filter(some)


def row_term_counts(rows: np.ndarray, codes: np.ndarray, n_codes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, code, occurrences), one for each distinct pair, sorted."""
    key, count = np.unique(rows.astype(np.int64) * max(n_codes, 1) + codes, return_counts=True)
    return key // max(n_codes, 1), key % max(n_codes, 1), count
