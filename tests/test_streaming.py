"""Incremental feed: one row per link across micro-batches, and the graph
that is kept up with it."""

import json
import os

import pytest
from pyspark.sql import functions as F

from newsgraph.operators.articles import filter_newspapers, normalize_feed
from newsgraph.operators.graph import ArticleGraph
from newsgraph.operators.persons import process_persons
from newsgraph.sources.feed import feed_items, read_feed
from newsgraph.streaming.feed_stream import run_feed_stream
from newsgraph.streaming.graph_stream import GraphState, run_graph_stream


def _reply(idx, items):
    return {"source_idx": idx, "keywords": "q",
            "news_results": [{"position": i, "title": t, "link": l, "date": d, "source": {"name": n}}
                             for i, (t, l, d, n) in enumerate(items)]}


def test_feed_stream_keeps_each_link_once_and_loses_none(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / p) for p in ("in", "out", "ckpt"))
    os.makedirs(src)
    landings = [
        [_reply(0, [("a", "L1", "1/10/2024, 07:00 AM", "Paper A"), ("b", "L2", "1/11/2024", "Paper A")])],
        [_reply(1, [("a again", "L1", "1/11/2024", "Paper B"),      # same link: dropped
                    ("c", "L3", "1/12/2024", "Paper B"),            # new: kept
                    ("other", "L4", "1/12/2024", "Gazette")])],     # newspaper not accepted
        [_reply(2, [("old", "L0", "11/1/2023", "Paper C"),          # an old date is not late
                    ("e", "L5", "1/13/2024", "Paper C")])],         # new: kept
    ]
    for i, b in enumerate(landings):
        path = os.path.join(src, f"landing-{i}.json")
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(r) for r in b))
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))  # arrival order
    q = run_feed_stream(spark, src, ["paper"], out, ckpt, max_files_per_trigger=1)
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 3
    got = sorted((r.link, r.title) for r in spark.read.parquet(out).collect())
    assert got == [("L0", "old"), ("L1", "a"), ("L2", "b"), ("L3", "c"), ("L5", "e")]


def _land(src, landings):
    os.makedirs(src)
    for i, b in enumerate(landings):
        path = os.path.join(src, f"landing-{i}.json")
        with open(path, "w") as f:
            f.write("\n".join(json.dumps(r) for r in b))
        os.utime(path, (1_700_000_000 + 10 * i, 1_700_000_000 + 10 * i))


def test_a_link_of_another_newspaper_does_not_hide_an_accepted_one(spark, tmp_path):
    src, out, ckpt = (str(tmp_path / p) for p in ("in", "out", "ckpt"))
    _land(src, [
        [_reply(0, [("first", "L1", "1/10/2024", "Gazette"), ("n1", None, "1/10/2024", "Paper A")])],
        [_reply(1, [("second", "L1", "1/10/2024", "Paper A"), ("n2", None, "1/10/2024", "Paper A")])],
        [_reply(1, [("third", "L1", "1/10/2024", "Paper A"), ("n2", None, "1/10/2024", "Paper A")])]])
    run_feed_stream(spark, src, ["paper"], out, ckpt, max_files_per_trigger=1).awaitTermination()
    got = sorted((r.link or "-", r.title) for r in spark.read.parquet(out).collect())
    assert got == [("-", "n1"), ("-", "n2"), ("-", "n2"), ("L1", "second")]


RELS = [("newspaper", "topics", "covers"), ("newspaper", "persons", "cites"), ("persons", "topics", "about")]


def _annotate(articles):
    """Topic and persons out of the title: "topic: Name Name, Name"."""
    head = F.split("title", ": ")
    return articles.select("*", F.lit("t").alias("text"), F.when(head[0] != "none", head[0]).alias("topics"),
                           F.filter(F.split(head[1], ", "), lambda x: x != "").alias("persons"))


def _tables(g):
    return [sorted(map(repr, map(tuple, t.collect()))) for t in (g.nodes, g.edges_simple, g.edges_multi)]


LANDINGS = [
    [_reply(0, [("economia: Draghi, anna verdi", "L1", "1/10/2024", "Paper A"), ("sport: Luca Rossi, Rossi", "L2", "1/11/2024", "Paper B")])],
    [_reply(0, [("politica: Rossi, economia", "L3", "1/10/2024", "Paper A"), ("esteri: Mario Draghi", None, "1/11/2024", "Paper A")])],
    [_reply(1, [("cultura: ", "L1", "1/12/2024", "Paper B"), ("none: Paolo Rossi", "L4", "1/12/2024", "Paper C")]),
     _reply(2, [("sport: Verdi", "L5", "1/12/2024", "Gazette")])],
    [_reply(0, [("arte: Draghi, Draghi", "L1", "1/9/2024", "Paper A"), ("sport: Verdi", "L6", "1/9/2024", "Paper D")])],
]


@pytest.mark.parametrize("order", [(0, 1, 2, 3), (3, 2, 1, 0), (2, 0, 3, 1)])
def test_graph_stream_equals_the_batch_in_any_order(spark, tmp_path, order):
    src = str(tmp_path / "in")
    _land(src, [LANDINGS[i] for i in order])
    arts = filter_newspapers(normalize_feed(feed_items(read_feed(spark, src))), ["paper"])
    whole = F.struct("row_ord", "title", "newspaper", "link", "date")
    once = (arts.where("link is not null").groupBy("link").agg(F.min(whole).alias("r")).select("r.*")
            .unionByName(arts.where("link is null"), allowMissingColumns=True))
    want = _tables(ArticleGraph.build(process_persons(_annotate(once)), RELS))

    state = GraphState(spark, str(tmp_path / "state"), RELS, _annotate)
    run_graph_stream(state, src, ["paper"], str(tmp_path / "ckpt"), max_files_per_trigger=1).awaitTermination()
    assert _tables(state.graph()) == want
    state.compact()
    assert _tables(state.graph()) == want and len(os.listdir(tmp_path / "state" / "pairs")) == 1


def test_a_batch_that_runs_again_changes_nothing(spark, tmp_path):
    src = str(tmp_path / "in")
    _land(src, LANDINGS)
    state = GraphState(spark, str(tmp_path / "state"), RELS, _annotate)
    parts = [filter_newspapers(normalize_feed(feed_items(read_feed(spark, f"{src}/landing-{i}.json"))), ["paper"]) for i in range(4)]
    for i, p in enumerate(parts):
        state.apply(p, i)
        if i == 1:
            state.compact()
    once = _tables(state.graph())
    state.apply(parts[3], 3)
    assert _tables(state.graph()) == once
