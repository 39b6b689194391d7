import random

import pyarrow as pa
import pytest

sentencepiece = pytest.importorskip("sentencepiece")
public_tokenizers = pytest.importorskip("public_tokenizers")

from newsgraph.llm import tokens  # noqa: E402
from tests.llm import brute  # noqa: E402

PATH = str(public_tokenizers.path(tokens.MODEL))


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def counter():
    return tokens.Counter(tokens.prove(PATH))


TEXTS = ["", " ", "   ", "a", " a", "a ", "a  b   c ", "\n", "\n\n\t x", "<s>", "</s> <unk> <0x0A>", "▁", "▁▁a ▁", "a▁b", "\0", "a\0 b",
         "中文 ß é́ 😀😀", " x", "----****////", "a" * 5000, "=" * 3000, "don't stop), he said (\"no\").", "x" * 63 + " " + "é" * 65,
         "﻿​\r\n", "123 45.6e-7", "".join(map(chr, range(1, 700)))]


def test_count_equals_the_library(library, counter):
    for t in TEXTS:
        assert counter.count(pa.array([t])) == len(library.encode(t)), repr(t[:50])
    rng = random.Random(4)
    words = [library.id_to_piece(rng.randrange(3, library.vocab_size())).replace("▁", " ") for _ in range(3000)]
    chars = "abcdeé ▁ \n\t.,-=(){}中ß😀"
    for _ in range(300):
        t = "".join(rng.choice(words) for _ in range(rng.randrange(60)))
        assert counter.count(pa.array([t])) == len(library.encode(t)), repr(t)
        t = "".join(rng.choice(chars) for _ in range(rng.randrange(80)))
        assert counter.count(pa.array([t])) == len(library.encode(t)), repr(t)


def test_long_texts_are_read_in_windows(library, monkeypatch):
    monkeypatch.setattr(tokens, "WINDOW_BYTES", 7)
    monkeypatch.setattr(tokens, "HELD", 3)
    c = tokens.Counter(tokens.prove(PATH))
    rng = random.Random(5)
    texts = [*TEXTS[:16], "abcdefghijklmnopqrstuvw" * 5, None, brute.sentence(rng, 80), ""]
    assert c.count(pa.array(texts)).tolist() == [len(library.encode(t or "")) for t in texts]


def test_whole_tokens_are_most_of_the_vocabulary(library):
    proof = tokens.prove(PATH)
    assert len(proof.whole) > 0.9 * library.vocab_size()
    assert tokens.Counter(proof).count(pa.array([proof.barrier])) == len(library.encode(proof.barrier))


@pytest.mark.parametrize("extra", [False, True])
def test_query(spark, library, extra):
    rows = brute.messy_documents() + [(900 + i, t, None, None, None) for i, t in enumerate(TEXTS)]
    got = tokens.op12(brute.frame(spark, rows, extra)).collect()
    want = [(i, len((t or "").encode()), n := len(library.encode(t or "")), n > 4096) for i, t, *_ in rows]
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, want))
    assert any(r.over_limit for r in got)


def test_empty_table_and_types(spark):
    df = tokens.op12(brute.frame(spark, []).coalesce(1))
    assert df.collect() == [] and [t for _, t in df.dtypes] == ["bigint", "bigint", "bigint", "boolean"]


def test_another_kind_of_model_is_refused(tmp_path):
    from sentencepiece import sentencepiece_model_pb2 as pb

    model = pb.ModelProto()
    model.ParseFromString(open(PATH, "rb").read())
    model.normalizer_spec.remove_extra_whitespaces = True
    other = tmp_path / "other.model"
    other.write_bytes(model.SerializeToString())
    with pytest.raises(ValueError):
        tokens.prove(str(other))
