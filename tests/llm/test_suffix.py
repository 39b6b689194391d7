import random

import pytest

from newsgraph.llm import suffix
from tests.llm import brute

N = suffix.LENGTH


def covered(texts):
    seen = {}
    for i, b in enumerate(texts):
        for p in range(len(b) - N + 1):
            seen.setdefault(b[p:p + N], []).append((i, p))
    mark = [bytearray(len(b)) for b in texts]
    for where in seen.values():
        if len(where) > 1:
            for i, p in where:
                mark[i][p:p + N] = b"\1" * N
    return mark


def expected(rows):
    texts = [(r[1] or "").encode() for r in rows]
    out = []
    for r, b, m in zip(rows, texts, covered(texts)):
        runs = sum(1 for p in range(len(m)) if m[p] and (p == 0 or not m[p - 1]))
        out.append((r[0], len(b), sum(m), runs, brute.sha(bytes(x for x, k in zip(b, m) if not k))))
    return sorted(out, key=repr)


def rows_with_repeats(seed=8):
    rng = random.Random(seed)
    rows = list(brute.messy_documents())
    shared = [brute.sentence(rng, 60) for _ in range(3)]
    for i in range(12):
        a, z = sorted((rng.randrange(0, 300), rng.randrange(0, 300)))
        rows.append((2000 + i, brute.sentence(rng, 15) + shared[i % 3][a // 4:200 + z] + brute.sentence(rng, 9), "", "", 0))
    rows.append((3000, "ab" * 400, "", "", 0))
    rows.append((3001, "x" * 199, "", "", 0))
    rows.append((3002, "x" * 200, "", "", 0))
    rows.append((3003, "\0" * 300 + "é" * 150, "", "", 0))
    return rows


@pytest.mark.parametrize("extra", [False, True])
def test_spans_match_brute_force(spark, extra):
    rows = rows_with_repeats()
    got = suffix.op10(brute.frame(spark, rows, extra)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_pieces_parts_and_hot_grams(spark, monkeypatch):
    monkeypatch.setattr(suffix, "PIECE", 333)
    monkeypatch.setattr(suffix, "PART", 2)
    monkeypatch.setattr(suffix, "HOT", 1)
    monkeypatch.setattr(suffix, "PACK", 1)
    monkeypatch.setattr(suffix.C, "BROADCAST_ROWS", 3)
    rows = rows_with_repeats(11)
    got = suffix.op10(brute.frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_no_merge_holds_more_than_the_bound(spark, monkeypatch):
    """One passage in many documents: its grams are over the bound, and no
    task merges them; what is removed stays right."""
    bound = 4000
    monkeypatch.setattr(suffix, "GROUP", bound)
    kept, plain = {}, suffix.C.keep

    def noted(df, name):
        out = plain(df, name)
        kept[name] = [r.asDict(True) for r in out.collect()] if name in ("suffix-wanted", "suffix-counted") else []
        return out

    rng = random.Random(4)
    passage = brute.sentence(rng, 90)
    rows = [(i, f"{brute.sentence(rng, 30)} {i} {passage} {i} {brute.sentence(rng, 30)}", "", "", 0) for i in range(40)]
    monkeypatch.setattr(suffix.C, "keep", noted)
    got = suffix.op10(brute.frame(spark, rows)).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)
    size = {}
    for r in kept["suffix-wanted"]:
        if not r["hot"]:
            for w in r["wanted"]:
                size[w["anchor"]] = size.get(w["anchor"], 0) + w["windows"] + N - 1
    assert not size or max(size.values()) <= bound
    assert len(kept["suffix-counted"]) >= 40


def test_empty_table(spark):
    assert suffix.op10(brute.frame(spark, []).coalesce(1)).collect() == []


def test_merge_finds_what_shards_share():
    rng = random.Random(2)
    for trial in range(20):
        alphabet = "ab" if trial % 2 else "abcdefgh"
        base = "".join(rng.choice(alphabet) for _ in range(600)).encode()
        parts = []
        for _ in range(rng.randint(1, 9)):
            a = rng.randrange(0, 400)
            parts.append(base[a:a + rng.randint(0, 500)] + bytes(rng.choice(b"xyz") for _ in range(rng.randint(0, 30))))
        want = covered(parts)
        got = [bytearray(len(p)) for p in parts]
        for i, s, e in zip(*(x.tolist() for x in suffix.repeats(parts, rng.randint(1, 4)))):
            got[i][s:e] = b"\1" * (e - s)
        assert got == want


def test_stage_keeps_rows_and_columns(spark):
    rows = rows_with_repeats()
    docs = brute.frame(spark, rows, True)
    out = suffix.drop_repeats(spark, docs, "")
    assert out.columns == docs.columns
    got = out.collect()
    assert len(got) == len(rows)
    texts = [(r[1] or "").encode() for r in rows]
    want = sorted((r[0] or -1, bytes(x for x, k in zip(b, m) if not k).decode("utf-8", "ignore"))
                  for r, b, m in zip(rows, texts, covered(texts)))
    assert sorted((r.doc_id or -1, r.text or "") for r in got) == want
    assert all(r.n_chars == len(r.text) for r in got if r.text is not None)
