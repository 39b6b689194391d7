import random

import numpy as np
import pytest

from newsgraph.llm import lsh, paragraphs, queries
from tests.llm import brute


def jaccard(a, b):
    a, b = set(brute.shingles(a)), set(brute.shingles(b))
    return len(a & b) / len(a | b)


def cases():
    rng = random.Random(6)
    rows = [tuple(r) for r in brute.messy_documents()]
    long_ = brute.sentence(rng, 70)
    w = long_.split()
    for i in range(10):
        own = list(w)
        own[rng.randrange(5, 60)] = f"edit{i}"
        rows.append((5000 + i, "\n".join([brute.sentence(rng, 20), " ".join(own), "short line", brute.sentence(rng, 9)]), "", "", 0))
    rows.append((6000, long_ + "\n" + long_.upper() + "!\n\n" + "short line", "", "", 0))
    return rows


def expected(rows):
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    place = [(k, n, p) for k in order for n, p in enumerate((rows[k][1] or "").split("\n"))
             if len(brute.words(p)) >= paragraphs.MIN_WORDS]
    texts = sorted({tuple(brute.words(p)) for _, _, p in place})
    number = {t: i for i, t in enumerate(texts)}
    edges = [(a, b) for a in range(len(texts)) for b in range(a + 1, len(texts))
             if jaccard(" ".join(texts[a]), " ".join(texts[b])) >= 0.8]
    root = brute.roots(range(len(texts)), edges)
    size, first = {}, {}
    for k, n, p in place:
        c = root[number[tuple(brute.words(p))]]
        size[c] = size.get(c, 0) + 1
        first.setdefault(c, (k, n))
    out = {k: [rows[k][0], len((rows[k][1] or "").split("\n")), 0, []] for k in range(len(rows))}
    for k, n, p in place:
        c = root[number[tuple(brute.words(p))]]
        if size[c] > 1:
            out[k][2] += 1
            if first[c] != (k, n):
                out[k][3].append(n)
    return [(i, n, r, len(x), ",".join(map(str, x))) for i, n, r, x in out.values()]


@pytest.mark.parametrize("extra", [False, True])
def test_removals_match_brute_force(spark, extra):
    rows = cases()
    got = [tuple(r) for r in paragraphs.op9(brute.frame(spark, rows, extra)).collect()]
    want = expected(rows)
    repeated = {3, None}  # which of equal rows is first is free; their sum is not
    assert sorted(r for r in got if r[0] not in repeated) == sorted(r for r in want if r[0] not in repeated)
    total = lambda x: sorted((str(r[0]), r[1], r[2]) for r in x)
    assert total(got) == total(want)
    assert sum(r[3] for r in got) == sum(r[3] for r in want)


def short_lines():
    """Lines of one to seven words: copies, near copies, equal shingle sets."""
    lines = ["Read more", "read, more!", "one", "home page of us", "a b c d e", "A-b c d e", "a b c d e f", "a b c d e g",
             "x x x x x", "x x x x x x x", "a b c d e f g", "g f e d c b a", "p q r s t u v", "P q r s t, u v", "..."]
    return [(i, "\n".join([line, "Read more", f"own{i}"]), "", "", 0) for i, line in enumerate(lines)]


def test_short_lines_take_part(spark):
    assert paragraphs.MIN_WORDS == 1
    rows = short_lines()
    got = sorted(tuple(r) for r in paragraphs.op9(brute.frame(spark, rows)).collect())
    assert got == sorted(expected(rows))
    at = {r[0]: r for r in got}
    assert at[0] == (0, 3, 2, 1, "1") and at[1] == (1, 3, 2, 2, "0,1")
    assert [at[i][4] for i in (5, 9, 13)] == ["0,1"] * 3


def missed(common, trials, seed=3):
    """Share of random pairs at Jaccard 0.8 that share no band; ``common``
    shingles are shared, an eighth as many are each side's own."""
    own = common // 8
    h = np.random.default_rng(seed).integers(0, 1 << 48, (trials, common + 2 * own), dtype=np.uint64)
    def keys(x):
        rows = np.repeat(np.arange(trials), x.shape[1])
        sig = paragraphs.minhash(rows, x.ravel(), trials, paragraphs.BANDS * paragraphs.ROWS)
        return lsh.band_keys(sig, paragraphs.ROWS)
    return float((keys(h[:, :common + own]) != keys(np.delete(h, np.s_[common:common + own], 1))).all(1).mean())


@pytest.mark.parametrize("common", [8, 40])
def test_pairs_at_the_threshold_share_a_band(common):
    assert (1 - 0.8 ** 3) ** 12 < 2e-4
    assert missed(common, 20_000) < 1e-3  # 3.7 expected, 20 allowed


def test_texts_without_id_get_only_their_own_paragraphs(spark, monkeypatch):
    sizes, plain = [], paragraphs.C.map_arrow

    def counted(df, fn, schema):
        if "wanted" in df.columns:
            sizes.extend((len(r.wanted), r.text.count("\n") + 1) for r in df.collect())
        return plain(df, fn, schema)

    monkeypatch.setattr(paragraphs.C, "map_arrow", counted)
    line = "one line of some words that near copies of it change at the end by word"
    rows = [(None, f"{line} {i}\nanother {line} x{i}", "", "", 0) for i in range(20)]
    got = paragraphs.op9(brute.frame(spark, rows)).collect()
    assert sum(r.n_removed for r in got) == sum(r[3] for r in expected(rows))
    assert sizes and all(wanted <= lines for wanted, lines in sizes)


def test_empty_table(spark):
    assert paragraphs.op9(brute.frame(spark, []).coalesce(1)).collect() == []


def runs(text, n):
    w = brute.words(text)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)}


def elsewhere(rows, n):
    """Per row, whether a run of n of its words stands in another row."""
    own = [runs(r[1], n) for r in rows]
    seen = {}
    for k, found in enumerate(own):
        for r in found:
            seen.setdefault(r, set()).add(k)
    return [any(len(seen[r]) > 1 for r in found) for found in own]


def inside_lines():
    """Passages in the middle of longer lines, across line ends, at either end
    of a text, and too short ones; short lines that stand everywhere."""
    rng = random.Random(11)
    rows, own = [], lambda k: " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(k))
    for size in (39, 50, 51, 52, 60, 75, 120):
        p = own(size)
        w = p.split()
        broken = " ".join(w[:20]) + ".\n" + ", ".join(w[20:]).upper()
        for text in (f"{own(90)} {p} {own(80)}", f"{own(7)} {broken} {own(140)}", f"{p} {own(200)}", f"{own(200)} {p}"):
            rows.append((len(rows), f"Of.\n{text}\nAll rights reserved", "", "", 0))
    one = own(60)
    rows += [(len(rows), f"Of.\n{own(100)}\nAll rights reserved", "", "", 0),
             (len(rows) + 1, f"{own(80)} {one} {own(70)} {one} {own(60)}\nOf.", "", "", 0),  # repeats itself alone
             (None, f"{own(10)} {rows[8][1]}", "", "", 0), (None, None, "", "", 0), (None, "Of.", "", "", 0)]
    return rows


def test_passages_inside_longer_lines_are_found(spark, tmp_path):
    rows = inside_lines()
    brute.frame(spark, [(1000 + i, *r[1:]) for i, r in enumerate(rows)]).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r.doc_id - 1000: r for r in queries.QUERIES["op9_paragraphs"](spark, str(tmp_path)).collect()}
    assert [got[k].n_repeated_passages > 0 for k in range(len(rows))] == elsewhere(rows, 50)
    assert elsewhere(rows, 50) == elsewhere(rows, 40)  # so nothing here is free
    assert got[28].n_repeated == 2 and got[28].n_repeated_passages == 0  # short lines alone
    assert got[0].n_repeated_passages == 0 and got[29].n_repeated_passages == 0


@pytest.mark.parametrize("extra", [False, True])
def test_passages_of_messy_documents(spark, extra):
    rows = cases()
    got = paragraphs.op9_passages(brute.frame(spark, rows, extra)).collect()
    assert sorted(tuple(r)[:3] for r in got if r.doc_id is not None) == sorted(r[:3] for r in expected(rows) if r[0] is not None)
    found = {(r.doc_id, r.n_paragraphs) for r in got if r.n_repeated_passages}
    key = [(r[0], len((r[1] or "").split("\n"))) for r in rows]
    assert {k for k, x in zip(key, elsewhere(rows, 50)) if x} <= found <= {k for k, x in zip(key, elsewhere(rows, 40)) if x}


def test_pieces_are_the_minima_of_all_runs():
    rng = np.random.default_rng(4)
    rows = np.repeat(np.arange(6), [0, 49, 50, 51, 200, 130])
    h = rng.integers(0, 1 << 63, len(rows), dtype=np.uint64)
    h[-60:] = 5  # one word sixty times
    got = list(zip(*(x.tolist() for x in paragraphs.pieces(rows, h))))
    hashes = {}
    for i in range(len(h) - 39):
        if rows[i] == rows[i + 39]:
            one = paragraphs._runs(h[i:i + 40], 40, lambda a, b: paragraphs.C.mix64(a * np.uint64(0x9E3779B97F4A7C15) + b))
            hashes[i] = int(one[0])
    want = {(int(rows[i]), min(hashes[j] for j in range(i, i + 11))) for i in range(len(h) - 49) if rows[i] == rows[i + 49]}
    assert got == sorted(want) and len(paragraphs.pieces(rows[:49], h[:49])[0]) == 0
