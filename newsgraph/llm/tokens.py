"""Token counts of whole texts with a whole-token shortcut.

The tokenizer is a piece model of merges (byte-pair merging over the
characters of a text, spaces written as U+2581 and one put in front, bytes for
unknown characters).  Two facts are proved from the vocabulary once, on the
driver, before any text is read:

* *Cuts.*  A merge makes a piece of the vocabulary, so where no piece holds
  two neighbouring characters side by side, nothing is ever merged across
  that place, and what stands on its two sides is tokenized independently.
  The pre-tokens are the text's runs between such places.
* *Whole tokens.*  Each vocabulary string is encoded alone (behind a
  character that joins nothing); those that come out as one token count 1.

A text's pre-tokens are then looked up: a whole token counts 1 at once, and
only the rest is merged by the library, once per distinct string while it is
in a bounded memory.  The sum equals the library's own count exactly.

Edge cases: a null or empty text has 0 bytes and 0 tokens; control and
special strings in a text are ordinary characters, as for the library; very
long texts are read in windows cut at cuts (a run without any cut is one
pre-token, whatever its length); each row is counted by itself, so repeated
rows and null ids need no rule; other columns are ignored."""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsgraph.llm import terms
from newsgraph.llm.common import text_buffer

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
SPACE = "▁"
WINDOW_BYTES = 4 << 20
HELD, HELD_CHARS = 1 << 19, 64     # remembered pre-tokens of a worker, and how long they may be


class Proof(NamedTuple):
    """What a model's vocabulary proves; plain values of a size fixed by the
    vocabulary."""
    path: str
    digest: str           # of the model file, so that another file is noticed
    barrier: str          # a character that joins nothing
    joined: bytes         # 256 x 256: may two neighbouring bytes of a text stand in one token
    whole: list[str]      # strings that alone are one token


def _load(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def _digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def _joined(pieces: list[str]) -> np.ndarray:
    """The cuts at the level of UTF-8 bytes: a text's bytes may stand in one
    token where they end and begin neighbours of some piece, or stand inside
    one character.  U+2581 stands for a space and for itself."""
    ends = lambda c: {c.encode()} | ({b" "} if c == SPACE else set())
    out = np.zeros((256, 256), bool)
    for x, y in {(x, y) for p in pieces for x, y in zip(p, p[1:])}:
        for a in ends(x):
            for b in ends(y):
                out[a[-1], b[0]] = True
    out[128:, 128:192] = True
    return out


def prove(path: str) -> Proof:
    """Cuts and whole tokens of the model at ``path``."""
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    with open(path, "rb") as f:
        model.ParseFromString(f.read())
    norm = model.normalizer_spec
    if (model.trainer_spec.model_type != pb.TrainerSpec.BPE or norm.precompiled_charsmap or not norm.add_dummy_prefix
            or norm.remove_extra_whitespaces or not norm.escape_whitespaces
            or model.trainer_spec.treat_whitespace_as_suffix):
        raise ValueError("the shortcut is proved for merge models that keep a text's characters as they are")
    kind = pb.ModelProto.SentencePiece
    pieces = [p.piece for p in model.pieces if p.type in (kind.NORMAL, kind.USER_DEFINED, kind.UNUSED)]
    within = {c for p in pieces if len(p) > 1 for c in p}
    barrier = next(c for c in map(chr, range(1, 128)) if c != " " and c not in within)
    sp = _load(path)
    base = len(sp.encode(barrier))
    whole = [p for p, ids in zip(pieces, sp.encode([barrier + p for p in pieces])) if len(ids) == base + 1]
    return Proof(path, _digest(path), barrier, np.packbits(_joined(pieces)).tobytes(), whole)


class Counter:
    """Counts tokens by the proof; the library is loaded when it is first needed."""

    def __init__(self, proof: Proof):
        self.proof = proof
        self.joined = np.unpackbits(np.frombuffer(proof.joined, np.uint8)).view(bool)
        self.whole = frozenset(proof.whole)
        self.rest: dict[str, int] = {}
        self.library = None

    def merged(self, pieces: list[str]) -> list[int]:
        """Tokens of pre-tokens that are no whole tokens, by merging."""
        if self.library is None:
            if _digest(self.proof.path) != self.proof.digest:
                raise ValueError(f"{self.proof.path} is not the model that the proof was made from")
            self.library = _load(self.proof.path)
            self.base = len(self.library.encode(self.proof.barrier))
        found = [len(x) - self.base for x in self.library.encode([self.proof.barrier + p for p in pieces], num_threads=1)]
        if len(self.rest) + len(pieces) > HELD:
            self.rest.clear()
        self.rest.update((p, n) for p, n in zip(pieces, found) if len(p) <= HELD_CHARS)
        return found

    def pre_tokens(self, data: np.ndarray, offsets: np.ndarray):
        """(starts, ends) of the pre-tokens of the texts in a buffer, window by window."""
        lo, n, size = 0, len(data), WINDOW_BYTES
        while lo < n:
            hi = min(lo + size, n)
            two = data[lo:hi - 1].astype(np.int64) << 8 | data[lo + 1:hi]
            cut = np.zeros(hi - lo, bool)
            cut[1:] = ~self.joined[two]
            cut[offsets[np.searchsorted(offsets, lo):np.searchsorted(offsets, hi)] - lo] = True
            cut[0] = True
            starts = np.flatnonzero(cut) + lo
            if hi < n:  # what the window may have cut off waits for the next one
                if len(starts) == 1:
                    size *= 2
                    continue
                hi = int(starts[-1])
                starts = starts[:-1]
            yield starts, np.append(starts[1:], hi)
            lo, size = hi, WINDOW_BYTES

    def count(self, texts: pa.Array) -> np.ndarray:
        """Tokens of each text of a string column."""
        data, offsets = text_buffer(texts)
        out = np.zeros(len(texts), np.int64)
        whole, rest = self.whole, self.rest
        for starts, ends in self.pre_tokens(data, offsets):
            base = int(starts[0])
            flat = pa.LargeStringArray.from_buffers(
                len(starts), pa.py_buffer(np.append(starts, ends[-1]) - base), pa.py_buffer(data[base:ends[-1]]))
            coded = flat.dictionary_encode()
            codes = coded.indices.to_numpy()
            row = np.searchsorted(offsets, starts, "right") - 1
            first = starts == offsets[row]   # the library puts a space before a text
            distinct, code = np.unique(codes * 2 + first, return_inverse=True)
            spelled = coded.dictionary.to_pylist()
            spelled = [(SPACE if x & 1 else "") + spelled[x >> 1].replace(" ", SPACE) for x in distinct.tolist()]
            cost = [1 if p in whole else rest.get(p, 0) for p in spelled]
            unknown = [i for i, n in enumerate(cost) if not n]
            for i, n in zip(unknown, self.merged([spelled[i] for i in unknown]) if unknown else []):
                cost[i] = n
            np.add.at(out, row, np.array(cost, np.int64)[code])
        return out


_counters: dict[str, Counter] = {}  # of this worker process


def count_tokens(docs: DataFrame, model_path: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of ``docs``."""
    sent = docs.sparkSession.sparkContext.broadcast(tuple(prove(model_path)))

    def run(batches):
        proof = Proof(*sent.value)
        counter = _counters.get(proof.digest)
        if counter is None:
            counter = _counters[proof.digest] = Counter(proof)
        for b in batches:
            for part in terms.slices(b, "text"):
                n = pa.array(counter.count(part.column("text")))
                size = pc.fill_null(pc.binary_length(part.column("text")), 0).cast(pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op12(docs: DataFrame, model_path: str | None = None) -> DataFrame:
    """The registered query: doc_id, n_bytes, n_tokens, over_limit."""
    if model_path is None:
        import public_tokenizers

        model_path = public_tokenizers.path(MODEL)
    return count_tokens(docs, str(model_path))
