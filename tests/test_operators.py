"""Edge cases of FIXTURES.md and operator properties, on literal rows."""

import datetime as dt
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from newsgraph.plans import stand_ins as SI
from newsgraph.operators import annotate as A
from newsgraph.operators import articles as AR
from newsgraph.operators import graph as G
from newsgraph.operators import persons as P
from newsgraph.operators import topics as TP
from newsgraph.sources import feed as FD

# clients defined here run in Python workers: ship them by value
cloudpickle.register_pickle_by_value(sys.modules[__name__])


# --------------------------------------------------------------------------
# Feed, filters
# --------------------------------------------------------------------------

def test_feed_items_positions_limit_and_missing_results(spark):
    replies = spark.createDataFrame(
        [(0, "a q", [(None, "t0", "l0", "5/5/2024, x", ("A",)), (None, "t1", "l1", "05/25/2024", ("B",))]),
         (1, "b q", None)], FD.FEED_REPLY)
    items = FD.feed_items(replies, limit=1).collect()
    assert [(r.position, r.title, r.row_ord) for r in items] == [(0, "t0", 0)]
    all_items = FD.feed_items(replies).orderBy("row_ord").collect()
    assert [r.link for r in all_items] == ["l0", "l1"]


def test_date_window_inclusive(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, d),) for d in (1, 2, 3, 4)], "date date")
    got = [r.date.day for r in AR.date_window(df, "2024-01-02", "2024-01-03").collect()]
    assert sorted(got) == [2, 3]


def test_newspaper_filter_inline_and_join(spark):
    df = spark.createDataFrame([("La Repubblica",), ("",), ("Il Sole",), ("La Repubblica",)], "newspaper string")
    inline = sorted(r[0] for r in AR.filter_newspapers(df, ["repubblica online"]).collect())
    joined = sorted(r[0] for r in AR.filter_newspapers(
        df, spark.createDataFrame([("repubblica online",)], "name string")).collect())
    assert inline == joined == ["La Repubblica", "La Repubblica"]


def test_keyword_filter_first_in_list_order(spark):
    df = spark.createDataFrame([("red hot plate",), ("blue ring",), ("green rod",)], "s string")
    out = AR.keyword_filter(df, "s", ["red", "blue", "hot"], ["hot", "red", "blue"], ["H", "R", "B"])
    assert sorted(r[0] for r in out.collect()) == ["B", "H"]


def test_length_filter_bounds_and_nulls(spark):
    df = spark.createDataFrame([("a" * 14999,), ("a" * 15000,), (None,)], "text string")
    assert AR.length_filter(df).count() == 1
    assert AR.length_filter(df, pandas_compat=True).count() == 2


def test_attach_pages_miss_and_status(spark):
    arts = spark.createDataFrame([("u1",), ("u2",), ("u3",)], "link string")
    pages = spark.createDataFrame([("u1", 200, "<p>x</p>"), ("u2", 404, "<p>no</p>")], FD.PAGE)
    got = dict(FD.attach_pages(arts, pages).collect())
    assert got == {"u1": "<p>x</p>", "u2": None, "u3": None}


# --------------------------------------------------------------------------
# Annotation replies
# --------------------------------------------------------------------------

REPLIES = {
    1: "Ecco {'text': 'a', 'topic': 't1', 'persons': ['Mario Rossi']} ok",   # single quotes
    2: 'x {"text": "b" "topic": "t2", "persons": []}',                       # missing comma
    3: "garbage {not json at all}",                                           # garbage
    4: "nothing here {}",                                                     # empty object
    5: '{"text": "c", "topic": "t5", "persons": ["A",],}',                    # trailing commas
    6: '{"text": "d", "persons": ["B"]}',                                     # no topic key
    7: "{'text': 'e', 'topic': None, 'persons': ['C']}",                      # Python None
    8: '{"text": "f", "topic": "", "persons": []}',                           # empty topic
    9: "no braces at all",                                                    # nothing
}


def test_parse_annotations_cases(spark):
    df = spark.createDataFrame([(k, v) for k, v in REPLIES.items()], "row_ord long, reply string")
    acc, rej = A.parse_annotations(df)
    got = {r.row_ord: (r.text, r.topics, r.persons) for r in acc.collect()}
    assert got == {1: ("a", "t1", ["Mario Rossi"]), 5: ("c", "t5", ["A"]), 6: ("d", None, ["B"]),
                   7: ("e", None, ["C"]), 8: ("f", "", [])}
    assert sorted(r.row_ord for r in rej.collect()) == [2, 3]
    kept = A.drop_empty_topics(acc)
    assert sorted(r.row_ord for r in kept.collect()) == [1, 5, 6, 7]


class _Counting:
    def complete(self, system, prompt, max_tokens):
        return "reply:" + prompt[-3:]


class _Failing:
    def complete(self, system, prompt, max_tokens):
        raise RuntimeError("service down")


def test_call_model_store_reuses_replies(spark, tmp_path):
    df = spark.createDataFrame([(i, f"t{i % 3}") for i in range(9)], "id int, text string")
    store = str(tmp_path / "replies")
    spec = A.CallSpec("sys", 10)
    first = A.call_model(df, F.col("text"), _Counting, spec, store=store)
    assert {r.reply for r in first.collect()} == {"reply:t0", "reply:t1", "reply:t2"}
    assert spark.read.parquet(store).count() == 3  # distinct prompts only
    again = A.call_model(df, F.col("text"), _Failing, spec, store=store)  # nothing new to send
    assert {r.reply for r in again.collect()} == {"reply:t0", "reply:t1", "reply:t2"}
    failed = A.call_model(df, F.col("text"), _Failing, A.CallSpec("sys", 10, on_error="empty"))
    rows = failed.collect()
    assert {r.reply for r in rows} == {""} and all("service down" in r.error for r in rows)


def test_stub_annotator_reply_parses(spark):
    df = spark.createDataFrame([(1, "Mario Draghi parla con Draghi. the end")], "row_ord long, text string")
    out = A.call_model(df, A.annotate_prompt(F.col("text"), "q", ["the"]), lambda: SI.StubAnnotator(["the"]),
                       A.ANNOTATE_CALL)
    acc, _ = A.parse_annotations(out)
    r = acc.first()
    assert (r.topics, r.persons) == ("the", ["Mario Draghi", "Draghi"])


# --------------------------------------------------------------------------
# Persons
# --------------------------------------------------------------------------

def _arts(spark, rows):
    return spark.createDataFrame(rows, "row_ord long, title string, newspaper string, link string, "
                                       "date date, text string, topics string, persons array<string>")


def test_complete_surnames_last_full_name_wins(spark):
    d = dt.date(2024, 1, 1)
    arts = _arts(spark, [(0, "a", "n", "l0", d, "x", "t", ["Mario Draghi", "Draghi", "Luca Draghi"])])
    p = P.complete_surnames(P.title_persons(P.explode_persons(arts)))
    assert [r.person for r in p.orderBy("pos").collect()] == ["Mario Draghi", "Luca Draghi", "Luca Draghi"]


def test_regroup_null_keys_duplicates_and_empty_lists(spark):
    d = dt.date(2024, 1, 1)
    arts = _arts(spark, [
        (0, "a", "n", "l", d, "x", "t", ["anna bianchi", "Bianchi"]),
        (1, "a", "n", "l", d, "x", "t", ["Bianchi", "anna bianchi"]),   # same article again
        (2, "b", "n", "l2", d, "y", None, ["Carlo Verdi"]),            # null topic: dropped at the end
        (3, "c", "n", "l3", d, "z", "u", []),
        (4, "e", "n", "l4", d, "w", "u", None),
        (5, "f", "n", "l5", d, "v", "u", ["Verdi"]),                    # completed from the null-topic row
    ])
    out = {r.title: r.persons for r in P.process_persons(arts).collect()}
    assert out == {"a": ["Anna Bianchi", "Anna Bianchi", "Anna Bianchi", "Anna Bianchi"],
                   "c": [], "e": [], "f": ["Carlo Verdi"]}
    compat = {r.title: r.persons for r in P.process_persons(arts, pandas_compat=True).collect()}
    assert compat["c"] == ["Nan"] and compat["e"] == ["None"]


# --------------------------------------------------------------------------
# Topics
# --------------------------------------------------------------------------

def test_reverse_map_later_label_and_remap_passthrough(spark):
    reply = spark.createDataFrame([(0, '{"L1": ["a", "b"], "L2": ["b", "c"]}')], "first_ord long, j string")
    rev = TP.reverse_mapping(TP.mapping_from_json(reply, "j", ("first_ord",)))
    assert dict(rev.collect()) == {"a": "L1", "b": "L2", "c": "L2"}
    df = spark.createDataFrame([("a",), ("b",), ("z",)], "topics string")
    assert sorted(r[0] for r in TP.remap(df, "topics", rev).collect()) == ["L1", "L2", "z"]


def test_repeated_key_keeps_last_list(spark):
    reply = spark.createDataFrame([(0, '{"L1": ["a"], "L2": ["b"], "L1": ["c"]}')], "first_ord long, j string")
    rev = TP.reverse_mapping(TP.mapping_from_json(reply, "j", ("first_ord",)))
    assert dict(rev.collect()) == {"c": "L1", "b": "L2"}


def test_representative_tie_first_seen(spark):
    df = spark.createDataFrame([(0, 1, "y"), (1, 1, "x"), (2, 1, "x"), (3, 1, "y"), (4, 2, "z")],
                               "row_ord long, topic_cluster int, topics string")
    reps = dict(TP.representatives(df).collect())
    assert reps == {1: "y", 2: "z"}


def test_cluster_with_model_stub(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(["red plate", "hot plate", "blue ring", None])],
                               "row_ord long, topics string")
    out = TP.cluster_with_model(df, SI.StubClusterer, batch_size=2)
    assert sorted((r.row_ord, r.topics) for r in out.collect()) == [
        (0, "plate"), (1, "plate"), (2, "ring"), (3, None)]


class SynonymClusterer:
    """Topics "t<k> <set>" of one set are synonyms; a set's label is the
    first of its topics in the call, so it differs per batch."""

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        import json

        from newsgraph.operators.annotate import CLUSTER_MARKER, prompt_body

        sets: dict[str, list[str]] = {}
        for t in filter(None, prompt_body(prompt, CLUSTER_MARKER).split("\n")):
            sets.setdefault(t.split()[-1], []).append(t)
        return json.dumps({members[0]: members for members in sets.values()})


def test_cluster_with_model_same_for_any_batch_size(spark):
    names = [f"t{k} s{i}" for k in range(2) for i in range(20)]
    df = spark.createDataFrame(list(enumerate(names)), "row_ord long, topics string")
    for size in (8, 1000):
        out = TP.cluster_with_model(df, SynonymClusterer, batch_size=size)
        assert sorted((r.row_ord, r.topics) for r in out.collect()) == [(i, f"t0 s{i % 20}") for i in range(40)]


class CountingClusterer(SynonymClusterer):
    """Notes the topics of each call in a file of its own."""

    def __init__(self, folder: str):
        self.folder = folder

    def complete(self, system: str, prompt: str, max_tokens: int) -> str:
        import os
        import uuid

        from newsgraph.operators.annotate import CLUSTER_MARKER, prompt_body

        with open(os.path.join(self.folder, uuid.uuid4().hex), "w") as f:
            f.write(prompt_body(prompt, CLUSTER_MARKER))
        return super().complete(system, prompt, max_tokens)


def test_cluster_calls_are_linear_in_the_labels(spark, tmp_path):
    """320 labels in 20 batches: as one large call places them, within a few
    calls per batch; no call is sent twice."""
    names = [f"t{k} s{i}" for k in range(4) for i in range(80)]
    df = spark.createDataFrame(list(enumerate(names)), "row_ord long, topics string")
    folder = str(tmp_path)
    out = TP.cluster_with_model(df, lambda: CountingClusterer(folder), batch_size=16, pin=True).collect()
    assert sorted((r.row_ord, r.topics) for r in out) == [(i, f"t0 s{i % 80}") for i in range(320)]
    calls = [p.read_text() for p in tmp_path.iterdir()]
    assert len(calls) == len(set(calls)) <= 20 * 5
    assert max(len(c.split("\n")) for c in calls) <= 60


def test_labels_without_a_common_word_meet_on_request(spark):
    class OneLabel:
        def complete(self, system, prompt, max_tokens):
            import json

            from newsgraph.operators.annotate import CLUSTER_MARKER, prompt_body

            lines = prompt_body(prompt, CLUSTER_MARKER).split("\n")
            same = [t for t in lines if int(t[1:]) % 10 == 0]
            return json.dumps({same[0]: same} if len(same) > 1 else {})

    df = spark.createDataFrame([(i, f"w{i}") for i in range(40)], "row_ord long, topics string")
    out = TP.cluster_with_model(df, OneLabel, batch_size=6, every_pair=True, pin=True).collect()
    assert {r.topics for r in out if r.row_ord % 10 == 0} == {"w0"}
    assert all(r.topics == f"w{r.row_ord}" for r in out if r.row_ord % 10)


def test_paired_batches_bring_each_two_topics_together(spark):
    topics = spark.createDataFrame([(f"t{i}", i) for i in range(30)], "topic string, first_ord long").cache()
    met = set()
    for turn in range(3, 8):
        for r in TP._paired_batches(topics, 6, turn).collect():
            lines = r.prompt_lines.split("\n")
            met |= {(a, b) for a in lines for b in lines}
    assert len(met) == 30 * 30


# --------------------------------------------------------------------------
# Graph
# --------------------------------------------------------------------------

RELS = [("a", "b", "r1"), ("b", "c", "r2")]


def test_graph_frequencies_types_edges(spark):
    df = spark.createDataFrame([(0, "x", "x", "y"), (1, "y", "z", "x")], "row_ord long, a string, b string, c string")
    g = G.ArticleGraph.build(df, RELS)
    nodes = {r.id: (r.type, r.freq) for r in g.nodes.collect()}
    # row 0: (x,x) r1 → x+2; (x,y) r2 → x+1, y+1; row 1: (y,z) r1; (z,x) r2
    assert nodes == {"x": ("c", 4), "y": ("a", 2), "z": ("b", 2)}
    simple = {(r.src, r.dst): r.relationship for r in g.edges_simple.collect()}
    assert simple == {("x", "x"): "r1", ("x", "y"): "r2", ("y", "z"): "r1", ("x", "z"): "r2"}
    assert g.edges_multi.count() == 4


def test_simple_edge_last_relationship_wins(spark):
    df = spark.createDataFrame([(0, "a1", "b1"), (1, "b1", "a1")], "row_ord long, s string, t string")
    g = G.ArticleGraph.build(df, [("s", "t", "first"), ("t", "s", "second")])
    assert [(r.src, r.dst, r.relationship) for r in g.edges_simple.collect()] == [("a1", "b1", "second")]


def test_graph_explodes_arrays_and_drops_null_ends(spark):
    df = spark.createDataFrame([(0, "n1", ["p1", "p2"]), (1, "n2", []), (2, None, ["p1"])],
                               "row_ord long, newspaper string, persons array<string>")
    g = G.ArticleGraph.build(df, [("newspaper", "persons", "cites")])
    assert {r.id: r.freq for r in g.nodes.collect()} == {"n1": 2, "p1": 1, "p2": 1}


def test_node_size_and_layouts(spark):
    nodes = spark.createDataFrame([("a", "t0", 4), ("b", "t1", 2), ("c", "t2", 1)], "id string, type string, freq long")
    sizes = {r.id: r.size for r in G.node_sizes(nodes).collect()}
    assert sizes["a"] == 2200.0 and sizes["b"] == 1200.0
    lay = {r.id: (r.color_idx, r.dx, r.dy) for r in G.display_attributes(nodes, ["t0", "t1", "t2"], "layered_layout").collect()}
    assert lay == {"a": (0, 0.0, 1.5), "b": (1, 0.0, 3.0), "c": (2, 0.0, 4.5)}
    tri = {r.id: (r.dx, r.dy) for r in G.display_attributes(nodes, ["t0", "t1", "t2"], "triangle_layout").collect()}
    assert tri == {"a": (-1.0, -1.0), "b": (1.0, -1.0), "c": (0.0, 1.0)}
    base = G.display_attributes(nodes, ["t0", "t1", "t2"]).collect()
    assert all(0.0 <= r.x < 1.0 and 0.0 <= r.y < 1.0 for r in base)
    with pytest.raises(G.LayoutError):
        G.display_attributes(nodes, ["t0"], "circle_layout")


def test_graph_properties_random(spark):
    import random

    rnd = random.Random(3)
    vals = ["v%d" % i for i in range(6)] + [None]
    rows = [(i, rnd.choice(vals), rnd.choice(vals), rnd.choice(vals)) for i in range(200)]
    df = spark.createDataFrame(rows, "row_ord long, a string, b string, c string")
    g = G.ArticleGraph.build(df, RELS)
    non_null = sum(1 for r in rows if r[1] and r[2]) + sum(1 for r in rows if r[2] and r[3])
    assert g.nodes.agg(F.sum("freq")).first()[0] == 2 * non_null
    assert g.edges_simple.count() <= g.edges_multi.count()
    assert g.edges_multi.agg(F.sum("n")).first()[0] == non_null


def test_workflow_with_model_cleaning(spark):
    from newsgraph.plans import workflow as W

    pages = spark.createDataFrame([("u1", "<p>Mario Rossi parla. the end!!</p>"), ("u2", "<p>nothing</p>")],
                                  "url string, html string")
    arts = spark.createDataFrame([(0, "t1", "Paper", "u1", dt.date(2024, 1, 1)),
                                  (1, "t2", "Paper", "u2", dt.date(2024, 1, 1))],
                                 "row_ord long, title string, newspaper string, link string, date date")
    run = W.NewsRun(query="q", sources=["paper"], topics=["the"])
    out, rej = W.process_articles(arts, pages, run, lambda: SI.StubAnnotator(["the"]),
                                  cluster_client_factory=SI.StubClusterer, clean_client_factory=SI.StubCleaner,
                                  pin=False)
    rows = out.collect()
    assert [(r.title, r.topics, r.persons, r.text) for r in rows] == [
        ("t1", "the", ["Mario Rossi"], "Mario Rossi parla the end")]
    assert rej.count() == 0


def test_collect_articles_dedup_links(spark):
    from newsgraph.plans import workflow as W

    items = [(None, "t", "same", "1/5/2024", ("Paper A",)), (None, "u", "other", "1/6/2024", ("Paper A",))]
    replies = spark.createDataFrame([(0, "a q", items), (1, "b q", [(None, "t2", "same", "1/5/2024", ("Paper B",))])],
                                    FD.FEED_REPLY)
    run = W.NewsRun(query="q", sources=["paper"], start_date="2024-01-01", end_date="2024-01-31")
    assert W.collect_articles(replies, run).count() == 3
    run.dedup_links = True
    got = sorted((r.link, r.newspaper) for r in W.collect_articles(replies, run).collect())
    assert got == [("other", "Paper A"), ("same", "Paper A")]


def test_cluster_topics_by_density(spark):
    from newsgraph.plans import workflow as W

    topics = ["red plate"] * 3 + ["red plates"] * 2 + ["blue ring", "green rod", "old gizmo"]
    df = spark.createDataFrame(list(enumerate(topics)), "row_ord long, topics string")
    out = W.cluster_topics(df, density_cut=10.0)
    assert out.count() == len(topics)
    noisy = W.cluster_topics(df, density_cut=0.0, noise_as_cluster=True)
    # "red plate" (3 copies) is a cluster; all noise rows take the commonest noise topic
    assert sorted(r.topics for r in noisy.collect()) == ["red plate"] * 3 + ["red plates"] * 5
    kept = W.cluster_topics(df, density_cut=0.0)
    # copies (weight >= 3) have core distance 0 and form a cluster of their own
    assert sorted({r.topics for r in kept.collect()}) == sorted(set(topics))


def test_process_persons_sorted_by_keys(spark):
    d = dt.date(2024, 1, 1)
    arts = _arts(spark, [(0, "b", "n", "l", d, "x", "t", ["A B"]), (1, "a", "n", "l", d, "x", "t", []),
                         (2, "c", "m", "l", d, "x", "t", ["B"])])
    got = [r.title for r in P.process_persons(arts, sort_keys=True).collect()]
    assert got == ["a", "b", "c"]


def test_attach_pages_without_dedupe(spark):
    arts = spark.createDataFrame([("u1",), ("u2",)], "link string")
    pages = spark.createDataFrame([("u1", "<p>x</p>"), ("u1", "<p>y</p>")], "url string, html string")
    assert FD.attach_pages(arts, pages).count() == 2                      # one page per URL
    assert FD.attach_pages(arts, pages, dedupe=False).count() == 3        # caller vouches for unique URLs
