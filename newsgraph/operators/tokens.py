"""Exact token counts by byte-pair merging.

The caller gives the rank table of a byte-pair vocabulary (and the pattern that
splits a text before merging).  Spark splits the texts; the pre-tokens stream
through Python batch by batch, where each distinct one of a batch is merged
unless its count is among the ``HELD`` that the task remembers.  What leaves
a batch is a sum per text, so no task's memory follows the table's size and no
pre-token is shuffled.

The rank table goes to the executors: it is counted, and refused over
``MAX_RANKS``."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.functions.text import PRETOKEN_RE

MAX_RANKS = 1_000_000
HELD, HELD_CHARS = 1 << 17, 64   # counts that a task remembers, and the longest pre-token among them


def merge_count(piece: bytes, ranks: dict[bytes, int]) -> int:
    """Tokens of one pre-token: the neighbouring parts whose join has the
    lowest rank become one (the first of equal ones), until none has a rank."""
    if piece in ranks:
        return 1
    parts = [piece[i:i + 1] for i in range(len(piece))]
    while len(parts) > 1:
        rank, at = min((ranks.get(a + b, MAX_RANKS), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
        if rank == MAX_RANKS:
            break
        parts[at:at + 2] = [parts[at] + parts[at + 1]]
    return len(parts)


def bpe_token_counts(df: DataFrame, ranks: DataFrame, key: str, text_col: str = "text",
                     pattern: str = PRETOKEN_RE) -> DataFrame:
    """``(key, tokens)``, one row per row of ``df`` (``key`` is unique).

    ``ranks``: (token binary, rank int), ranks below ``MAX_RANKS``.  A null
    text has null tokens, an empty one 0.  A byte without a rank of its own is
    one token.  What the pattern does not match gives no token."""
    held = ranks.limit(MAX_RANKS + 1).collect()
    if len(held) > MAX_RANKS:
        raise ValueError(f"the rank table has more than {MAX_RANKS} rows")
    sent = df.sparkSession.sparkContext.broadcast({bytes(r["token"]): r["rank"] for r in held})
    pieces = (df.where(F.col(text_col).isNotNull())
              .select(F.col(key).alias("_key"), F.explode(F.regexp_extract_all(F.col(text_col), F.lit(pattern), F.lit(0))).alias("piece")))

    def run(batches):
        held_counts: dict[str, int] = {}
        for b in batches:
            coded = b.column("piece").dictionary_encode()
            counts = []
            for p in coded.dictionary.to_pylist():
                n = held_counts.get(p)
                if n is None:
                    n = merge_count(p.encode(), sent.value)
                    if len(p) <= HELD_CHARS:
                        if len(held_counts) >= HELD:
                            held_counts.clear()
                        held_counts[p] = n
                counts.append(n)
            each = pa.table({"_key": b.column("_key"), "n": pa.array(counts, pa.int64()).take(coded.indices)})
            sums = each.group_by("_key", use_threads=False).aggregate([("n", "sum")]).select(["_key", "n_sum"]).combine_chunks()
            yield from sums.rename_columns(["_key", "n"]).to_batches()

    kind = pieces.schema["_key"].dataType
    schema = T.StructType([T.StructField("_key", kind), T.StructField("n", T.LongType())])
    total = pieces.mapInArrow(run, schema).groupBy("_key").agg(F.sum("n").alias("tokens"))
    return (df.select(key, F.col(text_col).isNull().alias("_none")).join(total, F.col(key) == F.col("_key"), "left")
            .select(key, F.when(~F.col("_none"), F.coalesce("tokens", F.lit(0))).cast("long").alias("tokens")))
