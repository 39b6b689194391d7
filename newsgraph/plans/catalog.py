"""Query catalogue: every operator run on the driver's tables.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` and, where
the result can be stated in SQL, the same result as a DuckDB query over the
driver's views.  Column names and types are aligned between the two;
arrays are returned joined into strings and doubles rounded, so the value
hashes compare like with like."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from newsgraph.functions import text as T
from newsgraph.operators import annotate as A
from newsgraph.operators import articles as AR
from newsgraph.operators import density as D
from newsgraph.operators import graph as G
from newsgraph.operators import persons as P
from newsgraph.operators import tokens as TK
from newsgraph.operators import topics as TP
from newsgraph.operators import vectors as V
from newsgraph.plans import fixtures as fx
from newsgraph.plans import stand_ins as SI
from newsgraph.plans import sql as S
from newsgraph.plans import workflow as W
from newsgraph.session import materialize
from newsgraph.sources import feed as FD

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn
    return deco


def _t(spark, d, name):
    return fx.table(spark, d, name)


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(c.strip().rstrip(",") for c in ctes)


# Fixed parameters of the catalogue queries.
WINDOW = ("2024-01-15", "2024-02-10")
EVENT_WINDOW = ("2024-01-03", "2024-01-05")
ACCEPTED_NAMES = ["Blog Tionsh", "THTHER news", "M"]
KW_WORDS = ["red", "blue", "hot"]
KW_KEYWORDS = ["hot", "red", "blue", "re"]
KW_CANONICAL = ["HOT", "RED", "BLUE", "RE"]
FEED_LIMIT = 5
RELS = [("newspaper", "topics", "covers"), ("newspaper", "persons", "cites"), ("persons", "topics", "about")]
CUSTOMER_RELS = [("c_name", "n_name", "lives_in"), ("n_name", "r_name", "part_of"),
                 ("c_name", "c_mktsegment", "segment")]
DENSITY_CUT = 1.14
KMEANS_ROUNDS = 3
GIVEN_TOPICS = ["plate", "widget", "ring"]


def _lst(values) -> str:
    return "[" + ", ".join(S.lit(v) for v in values) + "]"


# ---------------------------------------------------------------------------
# Feed (I-01, I-02, I-05, I-06, I-07, I-26, I-50)
# ---------------------------------------------------------------------------

@query("feed_queries", f"""
SELECT CAST(n_nationkey AS INTEGER) AS source_idx, n_name AS source,
       n_name || ' ' || {S.lit(fx.QUERY)} AS keywords
FROM nation""")
def q_feed_queries(spark, d):
    nation = _t(spark, d, "nation")
    return FD.search_queries(nation.select(F.col("n_nationkey").alias("source_idx"),
                                           F.col("n_name").alias("source")), fx.QUERY)


@query("feed_read", f"""
WITH r AS (
  SELECT page_id, {S.newspaper_of('url')} AS keywords,
         regexp_extract_all(html, {S.lit(fx.ANCHOR_RE)}, 1) AS h,
         regexp_extract_all(html, {S.lit(fx.ANCHOR_RE)}, 2) AS t
  FROM pages),
x AS (SELECT page_id, keywords, h, t, unnest(range(0, len(h))) AS pos FROM r)
SELECT CAST(page_id AS INTEGER) AS source_idx, keywords, CAST(pos AS INTEGER) AS position,
       t[pos + 1] AS title, h[pos + 1] AS link, (CAST(page_id AS BIGINT) << 32) + pos AS row_ord
FROM x WHERE pos < {FEED_LIMIT}""")
def q_feed_read(spark, d):
    items = FD.feed_items(fx.feed_replies_from_pages(_t(spark, d, "pages")), limit=FEED_LIMIT)
    return items.select("source_idx", "keywords", "position", "title", "link", "row_ord")


@query("feed_normalize", _with(S.FEED_ITEMS, S.NORMALIZED) + """
SELECT row_ord, title, newspaper, link, date FROM normalized""")
def q_feed_normalize(spark, d):
    n = AR.normalize_feed(fx.feed_items_from_pages(_t(spark, d, "pages")))
    return n.select("row_ord", "title", "newspaper", "link", "date")


@query("date_window", _with(S.FEED_ITEMS, S.NORMALIZED) + f"""
SELECT row_ord, date FROM normalized
WHERE date BETWEEN DATE {S.lit(WINDOW[0])} AND DATE {S.lit(WINDOW[1])}""")
def q_date_window(spark, d):
    n = AR.normalize_feed(fx.feed_items_from_pages(_t(spark, d, "pages")))
    return AR.date_window(n, *WINDOW).select("row_ord", "date")


@query("date_window_events", f"""
SELECT event_id, CAST(ts AS DATE) AS date FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE {S.lit(EVENT_WINDOW[0])} AND DATE {S.lit(EVENT_WINDOW[1])}""")
def q_date_window_events(spark, d):
    ev = _t(spark, d, "events").select("event_id", F.to_date("ts").alias("date"))
    return AR.date_window(ev, *EVENT_WINDOW)


def _acc_tokens(names) -> str:
    return _lst(AR._accepted_tokens(names))


@query("newspaper_filter", _with(S.FEED_ITEMS, S.NORMALIZED) + f"""
SELECT row_ord, newspaper FROM normalized
WHERE list_has_any({S.ws_tokens('lower(newspaper)')}, {_acc_tokens(ACCEPTED_NAMES)})""")
def q_newspaper_filter(spark, d):
    n = AR.normalize_feed(fx.feed_items_from_pages(_t(spark, d, "pages")))
    return AR.filter_newspapers(n, ACCEPTED_NAMES).select("row_ord", "newspaper")


@query("newspaper_filter_join", f"""
WITH acc AS (
  SELECT DISTINCT unnest({S.ws_tokens("lower('SRC' || CAST(n_nationkey * 3 AS VARCHAR) || ' Daily')")}) AS tok
  FROM nation)
SELECT doc_id, source FROM documents
WHERE list_has_any({S.ws_tokens('lower(source)')}, (SELECT list(tok) FROM acc))""")
def q_newspaper_filter_join(spark, d):
    acc = _t(spark, d, "nation").select(
        F.concat(F.lit("SRC"), (F.col("n_nationkey") * 3).cast("string"), F.lit(" Daily")).alias("name"))
    docs = _t(spark, d, "documents").select("doc_id", "source")
    return AR.filter_newspapers(docs, acc, col="source")


@query("collect_articles", _with(S.FEED_ITEMS, S.NORMALIZED) + f"""
SELECT row_ord, title, newspaper, link, date FROM normalized
WHERE date BETWEEN DATE {S.lit(WINDOW[0])} AND DATE {S.lit(WINDOW[1])}
  AND list_has_any({S.ws_tokens('lower(newspaper)')}, {_acc_tokens(ACCEPTED_NAMES)})""")
def q_collect_articles(spark, d):
    run = W.NewsRun(query=fx.QUERY, sources=ACCEPTED_NAMES, start_date=WINDOW[0], end_date=WINDOW[1])
    arts = W.collect_articles(fx.feed_items_from_pages(_t(spark, d, "pages")), run)
    return arts.select("row_ord", "title", "newspaper", "link", "date")


# ---------------------------------------------------------------------------
# Keyword filter (I-08, I-09, I-10)
# ---------------------------------------------------------------------------

def _kw_case(col: str) -> str:
    m: dict[str, str] = {}
    for k, w in zip(KW_KEYWORDS, KW_CANONICAL):
        m[k] = w
    whens = " ".join(f"WHEN contains({col}, {S.lit(k)}) THEN {S.lit(w)}" for k, w in m.items())
    return f"CASE {whens} END"


@query("keyword_canonical", f"""
SELECT p_partkey, {_kw_case('p_name')} AS p_name FROM part
WHERE list_has_any({S.ws_tokens('p_name')}, {_lst(KW_WORDS)})""")
def q_keyword_canonical(spark, d):
    part = _t(spark, d, "part").select("p_partkey", "p_name")
    return AR.keyword_filter(part, "p_name", KW_WORDS, KW_KEYWORDS, KW_CANONICAL)


# ---------------------------------------------------------------------------
# Pages (I-03, I-25, I-11)
# ---------------------------------------------------------------------------

@query("page_fetch_join", _with(S.FEED_ITEMS) + f"""
, fi AS (SELECT row_ord, CASE WHEN row_ord % {fx.MOVED_EVERY} = 0 THEN link || '?moved=1' ELSE link END AS link
        FROM feed_items)
SELECT fi.row_ord, fi.link, CAST(length(p.html) AS BIGINT) AS html_chars
FROM fi LEFT JOIN pages p ON fi.link = p.url""")
def q_page_fetch_join(spark, d):
    pages = _t(spark, d, "pages")
    items = fx.moved_links(fx.feed_items_from_pages(pages)).select("row_ord", "link")
    j = FD.attach_pages(items, pages.select("url", "html"))
    return j.select("row_ord", "link", F.length("html").cast("bigint").alias("html_chars"))


@query("html_to_text", f"SELECT page_id, {S.html_to_text('html')} AS text FROM pages")
def q_html_to_text(spark, d):
    return _t(spark, d, "pages").select("page_id", T.html_to_text("html").alias("text"))


@query("length_filter", f"""
SELECT doc_id, CAST(length(text) AS BIGINT) AS chars FROM documents WHERE length(text) < {AR.MAX_TEXT_CHARS}""")
def q_length_filter(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return AR.length_filter(docs).select("doc_id", F.length("text").cast("bigint").alias("chars"))


# ---------------------------------------------------------------------------
# Text functions (I-28, I-30, I-32, I-33)
# ---------------------------------------------------------------------------

def _injected_sql(x: str) -> str:
    return (f"replace(replace(replace(replace({x}, chr(233), chr(8216)), chr(232), chr(8220)), ', ', ',' || chr(160)), "
            f"'.', '.' || chr(8203)) || chr(9)")


def _injected(c):
    c = F.replace(c, F.lit("\u00e9"), F.lit("\u2018"))
    c = F.replace(c, F.lit("\u00e8"), F.lit("\u201c"))
    c = F.replace(c, F.lit(", "), F.lit(",\u00a0"))
    c = F.replace(c, F.lit("."), F.lit(".\u200b"))
    return F.concat(c, F.lit("\t"))


@query("clean_json", f"""
SELECT conv_id, turn, {S.clean_json_text(_injected_sql('text'))} AS cleaned FROM conversations""")
def q_clean_json(spark, d):
    conv = _t(spark, d, "conversations")
    return conv.select("conv_id", "turn", T.clean_json_text(_injected(F.col("text"))).alias("cleaned"))


@query("brace_extract", _with(S.REPLIES, S.brace_extract_cte("replies", "doc_id", "reply", "bx")) + """
SELECT id AS doc_id, json FROM bx""")
def q_brace_extract(spark, d):
    r = fx.replies_from_documents(_t(spark, d, "documents"))
    return r.select("doc_id", T.extract_braces("reply").alias("json"))


def _props_sql() -> str:
    return ("CASE WHEN event_id % 5 = 0 THEN '} ' || props || '}' "
            "WHEN event_id % 7 = 0 THEN '{' || props ELSE 'x ' || props || ' {y}' END")


def _props(c):
    e = F.col("event_id")
    return (F.when(F.pmod(e, F.lit(5)) == 0, F.concat(F.lit("} "), c, F.lit("}")))
            .when(F.pmod(e, F.lit(7)) == 0, F.concat(F.lit("{"), c))
            .otherwise(F.concat(F.lit("x "), c, F.lit(" {y}"))))


@query("brace_extract_events", _with(f"ev AS (SELECT event_id, {_props_sql()} AS s FROM events)",
                                     S.brace_extract_cte("ev", "event_id", "s", "bx")) + """
SELECT id AS event_id, json FROM bx""")
def q_brace_extract_events(spark, d):
    ev = _t(spark, d, "events")
    return ev.select("event_id", T.extract_braces(_props(F.col("props"))).alias("json"))


@query("text_title_case", f"SELECT conv_id, turn, {S.title_case('text')} AS title FROM conversations")
def q_text_title_case(spark, d):
    return _t(spark, d, "conversations").select("conv_id", "turn", T.title_case("text").alias("title"))


@query("token_budget", f"""
SELECT source, count(*) AS n_docs, CAST(sum({S.pretoken_count('text')}) AS BIGINT) AS tokens
FROM documents GROUP BY source""")
def q_token_budget(spark, d):
    docs = _t(spark, d, "documents")
    return docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"),
                                      F.sum(T.token_count(F.col("text"))).cast("bigint").alias("tokens"))


# A small byte-pair vocabulary: single bytes, then merges in order of rank.
BPE_PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
BPE_MERGES = ["th", "in", "er", "an", "re", "on", "the", "ing", "en", " t", " the", "or", "es", "al", "ti", "tion", "st", "ar", " a", " in",
              "at", "ed", "le", " s", "ion", "is", "it", "as", "and", " and"]


def bpe_ranks(spark) -> DataFrame:
    tokens = [bytes([i]) for i in range(256)] + [m.encode() for m in BPE_MERGES]
    return spark.createDataFrame([(bytearray(t), i) for i, t in enumerate(tokens)], "token binary, rank int")


@query("token_exact")
def q_token_exact(spark, d):
    """Exact tokens of every document under a given rank table."""
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return TK.bpe_token_counts(docs, bpe_ranks(spark), "doc_id", pattern=BPE_PATTERN)


# ---------------------------------------------------------------------------
# Annotation (I-12..I-15, I-24, I-29, I-34, I-35)
# ---------------------------------------------------------------------------

def _accepted(spark, d, keep: bool = True) -> DataFrame:
    """Parsed annotations; kept as a table when later steps read it twice."""
    arts = fx.articles_from_documents(_t(spark, d, "documents"))
    acc, _ = A.parse_annotations(arts)
    acc = A.drop_empty_topics(acc)
    return materialize(acc, "accepted") if keep else acc


def _joined(c):
    return F.array_join(F.col(c), "|")


@query("annotation_parse", _with(S.ACCEPTED) + """
SELECT row_ord, title, newspaper, link, date, text, topics,
       array_to_string(persons, '|') AS persons, CAST(len(persons) AS INTEGER) AS n_persons
FROM accepted""")
def q_annotation_parse(spark, d):
    acc = _accepted(spark, d, keep=False)
    return acc.select("row_ord", "title", "newspaper", "link", "date", "text", "topics",
                      _joined("persons").alias("persons"), F.size("persons").alias("n_persons"))


@query("annotation_rejects", _with(S.REPLIES) + f"""
SELECT CAST(doc_id AS BIGINT) AS row_ord, '{{' || text_kv || ' ' || topic_kv || ', ' || persons_kv || '}}' AS json
FROM reply_kv WHERE doc_id % {fx.MISSING_COMMA} = 0""")
def q_annotation_rejects(spark, d):
    _, rej = A.parse_annotations(fx.articles_from_documents(_t(spark, d, "documents")))
    return rej.select("row_ord", "json")


def _prompt_sql(head: str) -> str:
    return f"SELECT doc_id, {S.lit(head + A.TEXT_MARKER)} || text AS prompt FROM documents"


_ANN_HEAD = A.ANNOTATE_HEAD.format(query=fx.QUERY) + A.ANNOTATE_TOPICS.format(topics=A._topic_list(fx.STUB_TOPICS))


@query("prompt_annotate", _prompt_sql(_ANN_HEAD))
def q_prompt_annotate(spark, d):
    docs = _t(spark, d, "documents")
    return docs.select("doc_id", A.annotate_prompt(F.col("text"), fx.QUERY, fx.STUB_TOPICS).alias("prompt"))


@query("prompt_summary", _prompt_sql(A.SUMMARY_HEAD))
def q_prompt_summary(spark, d):
    return _t(spark, d, "documents").select("doc_id", A.summary_prompt(F.col("text")).alias("prompt"))


@query("prompt_clean", _prompt_sql(A.CLEAN_HEAD))
def q_prompt_clean(spark, d):
    return _t(spark, d, "documents").select("doc_id", A.clean_prompt(F.col("text")).alias("prompt"))


def _stub_topic_sql(x: str) -> str:
    words = f"regexp_extract_all(lower({x}), {S.lit(SI.STUB_WORD_RE)}, 0)"
    whens = " ".join(f"WHEN list_contains({words}, {S.lit(t)}) THEN {S.lit(t)}" for t in fx.STUB_TOPICS)
    return f"CASE {whens} ELSE '' END"


def _stub_client(kind: str):
    topics = fx.STUB_TOPICS

    def make():
        if kind == "annotate":
            return SI.StubAnnotator(topics)
        if kind == "summary":
            return SI.StubSummarizer()
        return SI.StubCleaner()
    return make


@query("annotate_stub", f"""
SELECT doc_id, 'Ecco: {{"text": "' || regexp_replace(text, {S.lit(SI.STUB_KEEP_RE)}, '', 'g')
       || '", "topic": "' || {_stub_topic_sql('text')} || '", "persons": ['
       || array_to_string(list_transform(regexp_extract_all(text, {S.lit(SI.STUB_PERSON_RE)}, 0), lambda x: '"' || x || '"'), ', ')
       || ']}} fine' AS reply
FROM documents""")
def q_annotate_stub(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    out = A.call_model(docs, A.annotate_prompt(F.col("text"), fx.QUERY, fx.STUB_TOPICS),
                       _stub_client("annotate"), A.ANNOTATE_CALL)
    return out.select("doc_id", "reply")


@query("summary_stub", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, {S.lit(SI.STUB_WORD_RE)}, 0)) AS VARCHAR) || ' parole, '
       || CAST(length(text) - length(replace(text, '.', '')) AS VARCHAR) || ' punti, parola piu'' lunga: '
       || CAST(coalesce(list_max(list_transform(regexp_extract_all(text, {S.lit(SI.STUB_WORD_RE)}, 0), lambda w: length(w))), 0) AS VARCHAR)
       || ' lettere' AS reply
FROM documents""")
def q_summary_stub(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    out = A.call_model(docs, A.summary_prompt(F.col("text")), _stub_client("summary"), A.SUMMARY_CALL)
    return out.select("doc_id", "reply")


@query("clean_stub", """
SELECT doc_id, regexp_replace(text, '[^\\p{L}\\p{N} .,]', '', 'g') AS reply FROM documents""")
def q_clean_stub(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    out = A.call_model(docs, A.clean_prompt(F.col("text")), _stub_client("clean"), A.CLEAN_CALL)
    return out.select("doc_id", "reply")


# ---------------------------------------------------------------------------
# Persons (I-20, I-21, I-30, I-31)
# ---------------------------------------------------------------------------

@query("persons_explode", _with(S.PERSONS_EXPLODED) + "\nSELECT row_ord, pos, person FROM pe")
def q_persons_explode(spark, d):
    return P.explode_persons(_accepted(spark, d, keep=False)).select("row_ord", "pos", "person")


@query("persons_title", _with(S.PERSONS_EXPLODED) + f"\nSELECT row_ord, pos, {S.title_case('person')} AS person FROM pe")
def q_persons_title(spark, d):
    return P.title_persons(P.explode_persons(_accepted(spark, d, keep=False))).select("row_ord", "pos", "person")


@query("persons_full_name", _with(S.PERSONS_FULL) + "\nSELECT row_ord, pos, person FROM pdone")
def q_persons_full_name(spark, d):
    p = P.complete_surnames(P.title_persons(P.explode_persons(_accepted(spark, d))))
    return p.select("row_ord", "pos", "person")


@query("persons_regroup", _with(S.PERSONS_FULL, S.regroup_ctes("accepted")) + """
SELECT title, newspaper, link, date, topics, array_to_string(persons, '|') AS persons,
       CAST(len(persons) AS INTEGER) AS n_persons
FROM grp""")
def q_persons_regroup(spark, d):
    out = P.process_persons(_accepted(spark, d))
    return out.select("title", "newspaper", "link", "date", "topics", _joined("persons").alias("persons"),
                      F.size("persons").alias("n_persons"))


# ---------------------------------------------------------------------------
# Topics (I-16..I-19, I-22, I-42)
# ---------------------------------------------------------------------------

@query("topic_distinct", """
SELECT p_name AS topic, min(p_partkey) AS first_ord, count(*) AS weight FROM part GROUP BY p_name""")
def q_topic_distinct(spark, d):
    return TP.distinct_topics(fx.part_topics(_t(spark, d, "part")))


def _part_mapping(part: DataFrame) -> DataFrame:
    toks = T.ws_tokens(F.col("p_name"))
    roles = part.select("p_partkey", "p_name", F.explode(F.array(
        F.struct(F.lit(0).alias("role"), F.element_at(toks, 1).alias("label")),
        F.struct(F.lit(1).alias("role"), F.element_at(toks, -1).alias("label")))).alias("r")
    ).select("p_partkey", "p_name", "r.role", "r.label")
    lab = roles.groupBy("role", "label").agg(F.min("p_partkey").alias("first"))
    members = roles.select("role", "label", F.col("p_name").alias("member")).distinct()
    return members.join(lab, ["role", "label"]).select(
        "label", F.struct("first", "role").alias("label_ord"), "member")


_MAPPING_SQL = f"""
roles AS (
  SELECT p_partkey, p_name, 0 AS role, {S.ws_tokens('p_name')}[1] AS label FROM part
  UNION ALL SELECT p_partkey, p_name, 1, {S.ws_tokens('p_name')}[-1] FROM part),
lab AS (SELECT role, label, min(p_partkey) AS first FROM roles GROUP BY role, label),
m AS (SELECT DISTINCT r.role, r.label, r.p_name AS member, l.first FROM roles r JOIN lab l USING (role, label)),
rev AS (SELECT member, arg_max(label, first * 2 + role) AS label FROM m GROUP BY member)"""


@query("topic_reverse_map", _with(_MAPPING_SQL) + "\nSELECT member, label FROM rev")
def q_topic_reverse_map(spark, d):
    return TP.reverse_mapping(_part_mapping(_t(spark, d, "part")))


@query("topic_remap", _with(_MAPPING_SQL) + """
SELECT p.p_partkey, coalesce(a.label, p.p_name) AS topic, coalesce(b.label, p.p_type) AS p_type
FROM part p LEFT JOIN rev a ON p.p_name = a.member LEFT JOIN rev b ON p.p_type = b.member""")
def q_topic_remap(spark, d):
    part = _t(spark, d, "part")
    rev = TP.reverse_mapping(_part_mapping(part))
    out = TP.remap(part.select("p_partkey", F.col("p_name").alias("topic"), "p_type"), "topic", rev)
    return TP.remap(out, "p_type", rev)


@query("topic_llm_merge", f"SELECT p_partkey, {S.ws_tokens('p_name')}[-1] AS topics FROM part")
def q_topic_llm_merge(spark, d):
    pt = fx.part_topics(_t(spark, d, "part"))
    merged = TP.cluster_with_model(pt, SI.StubClusterer, batch_size=16)
    return merged.select("p_partkey", "topics")


@query("topic_representative", """
WITH c AS (SELECT p_size % 7 AS cl, p_name, count(*) AS n, min(p_partkey) AS f FROM part GROUP BY p_size % 7, p_name),
r AS (SELECT cl, arg_max(p_name, n * 1000000000 - f) AS rep FROM c GROUP BY cl)
SELECT p.p_partkey, CAST(p.p_size % 7 AS INTEGER) AS topic_cluster, r.rep AS topics
FROM part p JOIN r ON p.p_size % 7 = r.cl""")
def q_topic_representative(spark, d):
    pt = fx.part_topics(_t(spark, d, "part")).withColumn("topic_cluster", F.pmod("p_size", F.lit(7)).cast("int"))
    reps = TP.representatives(pt, "topic_cluster", "topics")
    return TP.apply_representatives(pt, reps).select("p_partkey", "topic_cluster", "topics")


# ---------------------------------------------------------------------------
# Vectors and clustering (I-27, I-41, I-43, I-44, I-45)
# ---------------------------------------------------------------------------

def _word_slot(w, n: int):
    return F.pmod((F.ascii(w) * 31 + F.length(w) * 7 + F.ascii(F.reverse(w))) * 7919, F.lit(n))


def _word_slot_sql(w: str) -> str:
    return f"((ascii({w}) * 31 + length({w}) * 7 + ascii(reverse({w}))) * 7919) % (SELECT count(*) FROM embeddings)"


def _given_words(spark, d) -> DataFrame:
    """A vector for each word of the part names: the embedding in its slot."""
    words = _t(spark, d, "part").select(F.explode(T.ws_tokens("p_name")).alias("word")).distinct()
    emb = _t(spark, d, "embeddings")
    return words.join(emb, emb["vec_id"] == _word_slot(F.col("word"), emb.count())).select("word", F.col("embedding").alias("vec"))


@query("topic_vector_mean", f"""
WITH w AS (SELECT DISTINCT unnest({S.ws_tokens('p_name')}) AS word FROM part),
wv AS (SELECT w.word, e.embedding AS vec FROM w JOIN embeddings e ON e.vec_id = {_word_slot_sql('w.word')}),
t AS (SELECT DISTINCT p_name AS topic FROM part),
tw AS (SELECT topic, unnest({S.ws_tokens('topic')}) AS word FROM t),
x AS (SELECT topic, vec, unnest(range(1, len(vec) + 1)) AS i FROM tw JOIN wv USING (word))
SELECT topic, CAST(i - 1 AS INTEGER) AS dim, round(avg(CAST(vec[i] AS DOUBLE)), 6) AS x
FROM x GROUP BY topic, i""")
def q_topic_vector_mean(spark, d):
    part = _t(spark, d, "part")
    means = V.mean_word_vectors(part.select(F.col("p_name").alias("topic")).distinct(), _given_words(spark, d))
    return means.select("topic", F.posexplode("vec").alias("dim", "x")).withColumn("x", F.round("x", 6))


@query("topic_word2vec", "SELECT DISTINCT p_name AS topic, 100 AS dims, CAST(0 AS DOUBLE) AS off FROM part")
def q_topic_word2vec(spark, d):
    from pyspark.ml.functions import vector_to_array

    pt = fx.part_topics(_t(spark, d, "part"))
    model = V.train_word2vec(pt, "topics")
    vecs = V.topic_vectors(TP.distinct_topics(pt), model)
    # each topic's vector is the mean of its words' vectors
    words = model.getVectors().select("word", vector_to_array("vector").alias("vec"))
    means = V.mean_word_vectors(vecs.select("topic"), words).withColumnRenamed("vec", "mean")
    off = F.array_max(F.zip_with("vec", "mean", lambda a, b: F.abs(a - b)))
    return vecs.join(means, "topic").select("topic", F.size("vec").alias("dims"), F.round(off, 6).alias("off"))


def _points(spark, d) -> DataFrame:
    return _t(spark, d, "embeddings").select(F.col("vec_id").alias("id"),
                                             F.col("embedding").cast("array<double>").alias("vec"),
                                             F.lit(1).cast("bigint").alias("weight"))


@query("kmeans_plain", "SELECT vec_id, TRUE AS nearest, 10 AS n_clusters FROM embeddings")
def q_kmeans_plain(spark, d):
    """Every point is assigned to the nearest of ten centres, none empty."""
    out, centres = V.kmeans(_points(spark, d), k=10, seed=42)
    near = V.assign(out.withColumnRenamed("cluster", "given"), centres)
    n = out.select("cluster").distinct().count()
    return near.select(F.col("id").alias("vec_id"), (F.col("cluster") == F.col("given")).alias("nearest"),
                       F.lit(n).alias("n_clusters"))


def _label_seeds(spark, d) -> list[list[float]]:
    from pyspark.ml.functions import array_to_vector, vector_to_array
    from pyspark.ml.stat import Summarizer

    emb = _t(spark, d, "embeddings")
    rows = (emb.select("label", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
            .groupBy("label").agg(vector_to_array(Summarizer.mean(F.col("v"))).alias("m"))
            .orderBy("label").collect())  # one mean per label: k rows
    return [list(r["m"]) for r in rows]


def _kmeans_sql(rounds: int) -> str:
    ctes = ["""
pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
seed0 AS (
  SELECT label AS cid, list(x ORDER BY i) AS centre FROM (
    SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
    FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label),
allp AS (SELECT id, v FROM pts UNION ALL SELECT -1 - cid, centre FROM seed0),
c0 AS (SELECT cid, centre FROM seed0)"""]
    for r in range(rounds):
        ctes.append(f"""
a{r} AS (SELECT p.id, p.v, arg_min(c.cid, list_distance(p.v, c.centre)) AS cid FROM allp p, c{r} c GROUP BY p.id, p.v),
m{r} AS (
  SELECT cid, list(x ORDER BY i) AS centre FROM (
    SELECT cid, i, avg(v[i]) AS x FROM (SELECT cid, v, unnest(range(1, len(v) + 1)) AS i FROM a{r}) GROUP BY cid, i)
  GROUP BY cid),
c{r + 1} AS (SELECT c.cid, coalesce(m.centre, c.centre) AS centre FROM c{r} c LEFT JOIN m{r} m USING (cid))""")
    ctes.append(f"""
fin AS (SELECT p.id, arg_min(c.cid, list_distance(p.v, c.centre)) AS cid FROM pts p, c{rounds} c GROUP BY p.id)""")
    return "WITH " + ",".join(ctes) + "\nSELECT id AS vec_id, CAST(cid AS INTEGER) AS cluster FROM fin"


@query("kmeans_seeded", _kmeans_sql(KMEANS_ROUNDS))
def q_kmeans_seeded(spark, d):
    seeds = _label_seeds(spark, d)
    pts = _points(spark, d)
    seed_pts = spark.createDataFrame([(-1 - i, s, 1) for i, s in enumerate(seeds)],
                                     "id bigint, vec array<double>, weight bigint")
    out, _ = V.seeded_kmeans(pts.unionByName(seed_pts), seeds, fixed_iterations=KMEANS_ROUNDS)
    return out.filter(F.col("id") >= 0).select(F.col("id").alias("vec_id"), "cluster")


_KMEANS_RUN_SQL = """
WITH RECURSIVE pts AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
seed0 AS (
  SELECT label AS cid, list(x ORDER BY i) AS centre FROM (
    SELECT label, i, avg(CAST(embedding[i] AS DOUBLE)) AS x
    FROM (SELECT label, embedding, unnest(range(1, len(embedding) + 1)) AS i FROM embeddings)
    GROUP BY label, i) GROUP BY label),
allp AS (SELECT id, v FROM pts UNION ALL SELECT -1 - cid, centre FROM seed0),
limits AS (SELECT 0.0001 * avg(x) AS least FROM (
  SELECT i, var_pop(v[i]) AS x FROM (SELECT v, unnest(range(1, len(v) + 1)) AS i FROM allp) GROUP BY i)),
st(turn, cid, centre, moved) AS (
  SELECT 0, cid, centre, CAST('inf' AS DOUBLE) FROM seed0
  UNION ALL
  SELECT turn, cid, centre, sum(list_distance(centre, before) ** 2) OVER () FROM (
    SELECT o.turn + 1 AS turn, o.cid, o.centre AS before, coalesce(m.centre, o.centre) AS centre
    FROM st o LEFT JOIN (
      SELECT cid, list(x ORDER BY i) AS centre FROM (
        SELECT cid, i, avg(v[i]) AS x FROM (
          SELECT cid, v, unnest(range(1, len(v) + 1)) AS i FROM (
            SELECT p.id, p.v, arg_min(c.cid, list_distance(p.v, c.centre)) AS cid FROM allp p, st c GROUP BY p.id, p.v))
        GROUP BY cid, i) GROUP BY cid) m USING (cid)
    WHERE o.turn < 300 AND o.moved > (SELECT least FROM limits)))
SELECT p.id AS vec_id, CAST(arg_min(c.cid, list_distance(p.v, c.centre)) AS INTEGER) AS cluster
FROM pts p, st c WHERE c.turn = (SELECT max(turn) FROM st) GROUP BY p.id"""


@query("kmeans_converged", _KMEANS_RUN_SQL)
def q_kmeans_converged(spark, d):
    """Seeded k-means until the centres move less than the default tolerance."""
    seeds = _label_seeds(spark, d)
    seed_pts = spark.createDataFrame([(-1 - i, s, 1) for i, s in enumerate(seeds)],
                                     "id bigint, vec array<double>, weight bigint")
    out, _ = V.seeded_kmeans(_points(spark, d).unionByName(seed_pts), seeds)
    return out.filter(F.col("id") >= 0).select(F.col("id").alias("vec_id"), "cluster")


_PAIRS_SQL = """
pr AS (SELECT a.vec_id AS a, b.vec_id AS b,
              list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])) AS d
       FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id),
core AS (SELECT a AS id, d AS core FROM (
           SELECT a, d, row_number() OVER (PARTITION BY a ORDER BY d, b) AS rn FROM pr) WHERE rn = 2)"""


@query("density_core_distance", _with(_PAIRS_SQL) + "\nSELECT id AS vec_id, round(core, 6) AS core FROM core")
def q_density_core_distance(spark, d):
    c = D.core_distances(_points(spark, d), block_size=256)
    return c.select(F.col("id").alias("vec_id"), F.round("core", 6).alias("core"))


@query("density_components", _with(_PAIRS_SQL) + f""",
cp AS (SELECT id, core FROM core WHERE core <= {DENSITY_CUT}),
e AS (SELECT pr.a, pr.b FROM pr JOIN cp x ON pr.a = x.id JOIN cp y ON pr.b = y.id
      WHERE greatest(x.core, y.core, pr.d) <= {DENSITY_CUT}),
reach AS (
  WITH RECURSIVE r(src, dst) AS (
    SELECT id, id FROM cp
    UNION
    SELECT r.src, e.b FROM r JOIN e ON r.dst = e.a)
  SELECT src AS id, min(dst) AS comp FROM r GROUP BY src),
sizes AS (SELECT comp, count(*) AS n FROM reach GROUP BY comp)
SELECT c.id AS vec_id,
       CAST(CASE WHEN s.n >= {D.MIN_CLUSTER_SIZE} THEN r.comp ELSE -1 END AS BIGINT) AS cluster
FROM core c LEFT JOIN reach r ON c.id = r.id LEFT JOIN sizes s ON r.comp = s.comp""")
def q_density_components(spark, d):
    c = D.density_components(_points(spark, d), DENSITY_CUT, block_size=256)
    return c.select(F.col("id").alias("vec_id"), "cluster")


_REACH_SQL = _PAIRS_SQL + """,
m AS (SELECT pr.a, pr.b, greatest(x.core, y.core, pr.d) AS w
      FROM pr JOIN core x ON pr.a = x.id JOIN core y ON pr.b = y.id),
prim(step, v, best, picked) AS (
  SELECT 0, vec_id, CAST('inf' AS DOUBLE), vec_id = (SELECT min(vec_id) FROM embeddings) FROM embeddings
  UNION ALL
  SELECT step + 1, v, near, row_number() OVER (ORDER BY near, v) = 1
  FROM (SELECT o.step, o.v, least(o.best, m.w) AS near
        FROM prim o JOIN prim p ON p.picked AND NOT o.picked JOIN m ON m.a = p.v AND m.b = o.v))"""


@query("density_tree", "WITH RECURSIVE " + _REACH_SQL.strip() + """
SELECT CAST(row_number() OVER (ORDER BY best) AS BIGINT) AS rank, round(best, 6) AS w FROM prim WHERE picked AND step > 0""")
def q_density_tree(spark, d):
    """The weights of the spanning tree of mutual reachability, in order (the
    edges themselves are not unique, their weights are)."""
    tree, _ = D.density_tree(_points(spark, d), block_size=256)
    rank = F.row_number().over(Window.orderBy("w")).cast("bigint").alias("rank")
    return tree.select(rank, F.round("w", 6).alias("w"))


# In the order in which the tree takes the points in, a component at a distance
# is a run of points whose weights are within it; every run of two or more is
# a large part for a least cluster size of two.
_CLUSTERS_SQL = _REACH_SQL + """,
s AS (SELECT step AS i, v, best AS w FROM prim WHERE picked),
e AS (SELECT i, w FROM s WHERE i > 0),
run AS (
  SELECT DISTINCT e.w,
         coalesce((SELECT max(x.i) FROM e x WHERE x.i < e.i AND x.w > e.w), 0) AS l,
         coalesce((SELECT min(x.i) FROM e x WHERE x.i > e.i AND x.w > e.w), (SELECT count(*) FROM s)) - 1 AS r
  FROM e),
par AS (SELECT c.l, c.r, c.w, p.l AS pl, p.r AS pr, p.w AS pw
        FROM run c LEFT JOIN run p ON p.l <= c.l AND p.r >= c.r AND p.r - p.l > c.r - c.l
        QUALIFY row_number() OVER (PARTITION BY c.l, c.r ORDER BY p.r - p.l) = 1),
kids AS (SELECT pl AS l, pr AS r, count(*) AS n, max(r - l + 1) AS held FROM par WHERE pl IS NOT NULL GROUP BY pl, pr),
node AS (SELECT p.*, coalesce(k.n, 0) AS n, p.r - p.l + 1 - CASE WHEN k.n = 1 THEN k.held ELSE 0 END AS lost,
                q.n IS NULL OR q.n >= 2 AS born
         FROM par p LEFT JOIN kids k ON k.l = p.l AND k.r = p.r LEFT JOIN kids q ON q.l = p.pl AND q.r = p.pr),
inn AS (SELECT x.l, x.r, x.w, x.lost, b.l AS bl, b.r AS br
        FROM node x JOIN node b ON b.born AND b.l <= x.l AND b.r >= x.r
        QUALIFY row_number() OVER (PARTITION BY x.l, x.r ORDER BY b.r - b.l) = 1),
clu AS (SELECT b.l, b.r, any_value(u.bl) AS ul, any_value(u.br) AS ur,
               sum(i.lost / i.w) - coalesce((b.r - b.l + 1) / any_value(b.pw), 0) AS stab
        FROM node b JOIN inn i ON i.bl = b.l AND i.br = b.r LEFT JOIN inn u ON u.l = b.pl AND u.r = b.pr
        WHERE b.born GROUP BY b.l, b.r),
st(it, l, r, ul, ur, stab, below, best) AS (
  SELECT 0, c.l, c.r, c.ul, c.ur, c.stab, CAST(NULL AS DOUBLE),
         CASE WHEN NOT EXISTS (SELECT 1 FROM clu k WHERE k.ul = c.l AND k.ur = c.r) THEN c.stab END FROM clu c
  UNION ALL
  SELECT t.it + 1, t.l, t.r, t.ul, t.ur, t.stab, coalesce(t.below, k.below), coalesce(t.best, greatest(t.stab, k.below))
  FROM st t LEFT JOIN (SELECT ul, ur, CASE WHEN count(*) = count(best) THEN sum(best) END AS below FROM st GROUP BY ul, ur) k
    ON k.ul = t.l AND k.ur = t.r
  WHERE EXISTS (SELECT 1 FROM st WHERE best IS NULL)),
sel AS (SELECT l, r FROM st WHERE it = (SELECT max(it) FROM st) AND ul IS NOT NULL AND (below IS NULL OR stab >= below)),
own AS (SELECT s.v, x.l, x.r FROM s JOIN sel x ON s.i BETWEEN x.l AND x.r
        QUALIFY row_number() OVER (PARTITION BY s.v ORDER BY x.r - x.l DESC) = 1)"""


@query("density_clusters", "WITH RECURSIVE " + _CLUSTERS_SQL.strip() + """
SELECT s.v AS vec_id, CAST(coalesce(min(o.v) OVER (PARTITION BY o.l, o.r), -1) AS BIGINT) AS cluster
FROM s LEFT JOIN own o ON s.v = o.v""")
def q_density_clusters(spark, d):
    """Clusters chosen by stability over the whole hierarchy."""
    c = D.density_clusters(_points(spark, d), block_size=256)
    return c.select(F.col("id").alias("vec_id"), "cluster")


@query("topic_merge")
def q_topic_merge(spark, d):
    pt = fx.part_topics(_t(spark, d, "part"))
    out = W.cluster_topics(pt, GIVEN_TOPICS)
    return out.select("p_partkey", "topics", "topic_cluster")


_MERGE_GIVEN_SQL = f"""
WITH RECURSIVE w AS (SELECT DISTINCT unnest({S.ws_tokens('p_name')}) AS word FROM part),
wv AS (SELECT w.word, CAST(e.embedding AS DOUBLE[]) AS vec FROM w JOIN embeddings e ON e.vec_id = {_word_slot_sql('w.word')}),
t AS (SELECT p_name AS topic, count(*) AS weight FROM part GROUP BY p_name),
g AS (SELECT topic, cid FROM (VALUES {', '.join(f"({S.lit(t)}, {i})" for i, t in enumerate(GIVEN_TOPICS))}) v(topic, cid)),
tv AS (
  SELECT topic, list(x ORDER BY i) AS v FROM (
    SELECT topic, i, avg(vec[i]) AS x FROM (
      SELECT topic, vec, unnest(range(1, len(vec) + 1)) AS i
      FROM (SELECT topic, unnest({S.ws_tokens('topic')}) AS word FROM (SELECT topic FROM t UNION SELECT topic FROM g)) JOIN wv USING (word))
    GROUP BY topic, i) GROUP BY topic),
allp AS (SELECT topic, v, weight, FALSE AS given FROM t JOIN tv USING (topic) UNION ALL SELECT topic, v, 1, TRUE FROM g JOIN tv USING (topic)),
limits AS (SELECT 0.0001 * avg(x) AS least FROM (
  SELECT i, sum(weight * v[i] ** 2) / sum(weight) - (sum(weight * v[i]) / sum(weight)) ** 2 AS x
  FROM (SELECT v, weight, unnest(range(1, len(v) + 1)) AS i FROM allp) GROUP BY i)),
st(turn, cid, centre, moved) AS (
  SELECT 0, cid, v, CAST('inf' AS DOUBLE) FROM g JOIN tv USING (topic)
  UNION ALL
  SELECT turn, cid, centre, sum(list_distance(centre, before) ** 2) OVER () FROM (
    SELECT o.turn + 1 AS turn, o.cid, o.centre AS before, coalesce(m.centre, o.centre) AS centre
    FROM st o LEFT JOIN (
      SELECT cid, list(x ORDER BY i) AS centre FROM (
        SELECT cid, i, sum(weight * v[i]) / sum(weight) AS x FROM (
          SELECT cid, v, weight, unnest(range(1, len(v) + 1)) AS i FROM (
            SELECT p.topic, p.given, p.v, p.weight, arg_min(c.cid, list_distance(p.v, c.centre)) AS cid
            FROM allp p, st c GROUP BY p.topic, p.given, p.v, p.weight))
        GROUP BY cid, i) GROUP BY cid) m USING (cid)
    WHERE o.turn < 300 AND o.moved > (SELECT least FROM limits))),
lab AS (SELECT p.topic, arg_min(c.cid, list_distance(p.v, c.centre)) AS cid
        FROM allp p, st c WHERE NOT p.given AND c.turn = (SELECT max(turn) FROM st) GROUP BY p.topic)
SELECT p.p_partkey, g.topic AS topics, CAST(lab.cid AS INTEGER) AS topic_cluster
FROM part p JOIN lab ON lab.topic = p.p_name JOIN g USING (cid)"""


@query("topic_merge_given", _MERGE_GIVEN_SQL)
def q_topic_merge_given(spark, d):
    """The whole merge on word vectors that are given, so that every step
    after the training is checked by value."""
    out = W.cluster_topics(fx.part_topics(_t(spark, d, "part")), GIVEN_TOPICS, words=_given_words(spark, d))
    return out.select("p_partkey", "topics", "topic_cluster")


# ---------------------------------------------------------------------------
# Graph (I-23, I-36..I-40, I-46..I-49)
# ---------------------------------------------------------------------------

def _graph(spark, d) -> G.ArticleGraph:
    acc = _accepted(spark, d).select("row_ord", "newspaper", "topics", "persons")
    return G.ArticleGraph.build(acc, RELS)


_GRAPH_SQL = S.PERSONS_EXPLODED + """,
gx AS (SELECT a.row_ord, coalesce(p.pos, 0) AS sub, a.newspaper, a.topics, p.person AS persons
       FROM accepted a JOIN pe p USING (row_ord)),
pairs0 AS (
  SELECT row_ord, sub, 0 AS rel_idx, 'covers' AS relationship, newspaper AS src, 'newspaper' AS src_type,
         topics AS dst, 'topics' AS dst_type FROM gx
  UNION ALL SELECT row_ord, sub, 1, 'cites', newspaper, 'newspaper', persons, 'persons' FROM gx
  UNION ALL SELECT row_ord, sub, 2, 'about', persons, 'persons', topics, 'topics' FROM gx),
pairs AS (SELECT *, (row_ord * 1000000 + sub) * 16 + rel_idx AS o FROM pairs0 WHERE src IS NOT NULL AND dst IS NOT NULL),
ends AS (SELECT o * 2 AS o, src AS id, src_type AS type FROM pairs UNION ALL SELECT o * 2 + 1, dst, dst_type FROM pairs),
nodes AS (SELECT id, arg_max(type, o) AS type, count(*) AS freq FROM ends GROUP BY id),
simple AS (SELECT least(src, dst) AS src, greatest(src, dst) AS dst, arg_max(relationship, o) AS relationship
           FROM pairs GROUP BY least(src, dst), greatest(src, dst)),
types AS (SELECT * FROM (VALUES ('newspaper', 0), ('topics', 1), ('persons', 2)) t(type, color_idx))"""


@query("graph_node_types", _with(_GRAPH_SQL) + """
SELECT t.type, CAST(t.color_idx AS INTEGER) AS color_idx, count(n.id) AS n_nodes
FROM types t LEFT JOIN nodes n USING (type) GROUP BY t.type, t.color_idx""")
def q_graph_node_types(spark, d):
    g = _graph(spark, d)
    types = spark.createDataFrame(list(enumerate(g.node_types)), "color_idx int, type string")
    return types.join(g.nodes, "type", "left").groupBy("type", "color_idx").agg(
        F.count("id").alias("n_nodes"))


@query("graph_node_freq", _with(_GRAPH_SQL) + "\nSELECT id, count(*) AS freq FROM ends GROUP BY id")
def q_graph_node_freq(spark, d):
    return G.node_frequencies(G.endpoints(_accepted(spark, d).select("row_ord", "newspaper", "topics", "persons"), RELS))


@query("graph_nodes", _with(_GRAPH_SQL) + "\nSELECT id, type, freq FROM nodes")
def q_graph_nodes(spark, d):
    return _graph(spark, d).nodes


@query("graph_edges_multi", _with(_GRAPH_SQL) + """
SELECT src, dst, relationship, count(*) AS n FROM pairs GROUP BY src, dst, relationship""")
def q_graph_edges_multi(spark, d):
    return _graph(spark, d).edges_multi


@query("graph_edges_simple", _with(_GRAPH_SQL) + "\nSELECT src, dst, relationship FROM simple")
def q_graph_edges_simple(spark, d):
    return _graph(spark, d).edges_simple


@query("graph_edge_labels", _with(_GRAPH_SQL) + "\nSELECT src, dst, relationship AS label FROM simple")
def q_graph_edge_labels(spark, d):
    return G.edge_labels(_graph(spark, d).edges_simple)


@query("graph_node_size", _with(_GRAPH_SQL) + """
SELECT id, freq, round(200 + freq / (SELECT max(freq) FROM nodes) * 2000, 6) AS size FROM nodes""")
def q_graph_node_size(spark, d):
    s = _graph(spark, d).node_sizes()
    return s.select("id", "freq", F.round("size", 6).alias("size"))


def _offset_sql(layout: str) -> str:
    if layout == "layered_layout":
        dx, dy = "0.0", f"(t.color_idx + 1) * {G.LAYER_STEP}"
    else:
        xs = " ".join(f"WHEN {i} THEN {v[0]}" for i, v in enumerate(G.TRIANGLE_SHIFTS))
        ys = " ".join(f"WHEN {i} THEN {v[1]}" for i, v in enumerate(G.TRIANGLE_SHIFTS))
        dx, dy = f"CASE t.color_idx {xs} END", f"CASE t.color_idx {ys} END"
    return _with(_GRAPH_SQL) + f"""
SELECT n.id, n.type, CAST(t.color_idx AS INTEGER) AS color_idx,
       CAST({dx} AS DOUBLE) AS dx, CAST({dy} AS DOUBLE) AS dy
FROM nodes n JOIN types t USING (type)"""


@query("graph_layered", _offset_sql("layered_layout"))
def q_graph_layered(spark, d):
    return _graph(spark, d).display("layered_layout").select("id", "type", "color_idx", "dx", "dy")


@query("graph_triangle", _offset_sql("triangle_layout"))
def q_graph_triangle(spark, d):
    return _graph(spark, d).display("triangle_layout").select("id", "type", "color_idx", "dx", "dy")


_CUSTOMER_SQL = """
cg AS (SELECT c.c_custkey AS row_ord, c.c_name, n.n_name, r.r_name, c.c_mktsegment
       FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey JOIN region r ON n.n_regionkey = r.r_regionkey),
pairs AS (
  SELECT row_ord * 16 + 0 AS o, 'lives_in' AS relationship, c_name AS src, 'c_name' AS src_type, n_name AS dst, 'n_name' AS dst_type FROM cg
  UNION ALL SELECT row_ord * 16 + 1, 'part_of', n_name, 'n_name', r_name, 'r_name' FROM cg
  UNION ALL SELECT row_ord * 16 + 2, 'segment', c_name, 'c_name', c_mktsegment, 'c_mktsegment' FROM cg),
ends AS (SELECT o * 2 AS o, src AS id, src_type AS type FROM pairs WHERE src IS NOT NULL AND dst IS NOT NULL
         UNION ALL SELECT o * 2 + 1, dst, dst_type FROM pairs WHERE src IS NOT NULL AND dst IS NOT NULL)"""


def _customer_table(spark, d) -> DataFrame:
    c, n, r = _t(spark, d, "customer"), _t(spark, d, "nation"), _t(spark, d, "region")
    return (c.join(n, c["c_nationkey"] == n["n_nationkey"]).join(r, n["n_regionkey"] == r["r_regionkey"])
            .select(F.col("c_custkey").alias("row_ord"), "c_name", "n_name", "r_name", "c_mktsegment"))


@query("graph_customer_nodes", _with(_CUSTOMER_SQL) + """
SELECT id, arg_max(type, o) AS type, count(*) AS freq FROM ends GROUP BY id""")
def q_graph_customer_nodes(spark, d):
    return G.ArticleGraph.build(_customer_table(spark, d), CUSTOMER_RELS).nodes


@query("graph_customer_edges", _with(_CUSTOMER_SQL) + """
SELECT least(src, dst) AS src, greatest(src, dst) AS dst, arg_max(relationship, o) AS relationship
FROM pairs WHERE src IS NOT NULL AND dst IS NOT NULL GROUP BY least(src, dst), greatest(src, dst)""")
def q_graph_customer_edges(spark, d):
    return G.ArticleGraph.build(_customer_table(spark, d), CUSTOMER_RELS).edges_simple


# ---------------------------------------------------------------------------
# Whole workflow (I-50, I-51, I-52)
# ---------------------------------------------------------------------------

def _process_sql() -> str:
    from newsgraph.plans.flagship import FLAGSHIP_RUN

    r = FLAGSHIP_RUN
    return _with(S.FEED_ITEMS, S.NORMALIZED, f"""
arts AS (
  SELECT row_ord, title, newspaper, link, date FROM normalized
  WHERE date BETWEEN DATE {S.lit(r["start_date"])} AND DATE {S.lit(r["end_date"])}
    AND list_has_any({S.ws_tokens('lower(newspaper)')}, {_acc_tokens(r["sources"])})),
fetched AS (SELECT a.*, {S.html_to_text('p.html')} AS page_text FROM arts a LEFT JOIN pages p ON a.link = p.url),
ann AS (
  SELECT row_ord, title, newspaper, link, date,
         regexp_replace(page_text, {S.lit(SI.STUB_KEEP_RE)}, '', 'g') AS text,
         {_stub_topic_sql('page_text')} AS topics,
         regexp_extract_all(page_text, {S.lit(SI.STUB_PERSON_RE)}, 0) AS persons
  FROM fetched WHERE length(page_text) < {AR.MAX_TEXT_CHARS}),
merged AS (
  SELECT row_ord, title, newspaper, link, date, text, {S.ws_tokens('topics')}[-1] AS topics, persons
  FROM ann WHERE topics <> '')""", S.persons_ctes("merged"), S.regroup_ctes("merged")) + """
SELECT title, newspaper, link, date, topics, array_to_string(persons, '|') AS persons,
       CAST(len(persons) AS INTEGER) AS n_persons
FROM grp"""


def _flagship_nodes_sql() -> str:
    body = _process_sql()
    head, tail = body.split("\nSELECT title, newspaper, link, date, topics, array_to_string", 1)
    return head + """,
fx0 AS (SELECT struct_pack(title := title, newspaper := newspaper, link := link, date := date, text := text,
                           topics := topics) AS k, newspaper, topics, persons FROM grp),
fx1 AS (SELECT k, newspaper, topics, persons, unnest(range(0, greatest(len(persons), 1))) AS pos FROM fx0),
fx2 AS (SELECT k, pos, newspaper, topics, persons[pos + 1] AS person FROM fx1),
fpairs AS (
  SELECT k, pos, 0 AS rel_idx, newspaper AS src, 'newspaper' AS src_type, topics AS dst, 'topics' AS dst_type FROM fx2
  UNION ALL SELECT k, pos, 1, newspaper, 'newspaper', person, 'persons' FROM fx2
  UNION ALL SELECT k, pos, 2, person, 'persons', topics, 'topics' FROM fx2),
fends AS (
  SELECT k, pos, rel_idx, 0 AS e, src AS id, src_type AS type FROM fpairs WHERE src IS NOT NULL AND dst IS NOT NULL
  UNION ALL
  SELECT k, pos, rel_idx, 1, dst, dst_type FROM fpairs WHERE src IS NOT NULL AND dst IS NOT NULL)
SELECT id, arg_max(type, struct_pack(k := k, pos := pos, rel_idx := rel_idx, e := e)) AS type, count(*) AS freq
FROM fends GROUP BY id"""


@query("flagship_nodes", _flagship_nodes_sql())
def q_flagship_nodes(spark, d):
    from newsgraph.plans.flagship import flagship

    return flagship(spark, d)


@query("process_articles", _process_sql())
def q_process_articles(spark, d):
    from newsgraph.plans.flagship import processed_articles

    out, _ = processed_articles(spark, d)
    return out.select("title", "newspaper", "link", "date", "topics", _joined("persons").alias("persons"),
                      F.size("persons").alias("n_persons"))


# ---------------------------------------------------------------------------
# Failed calls (I-12, I-34) and hard pages (I-25)
# ---------------------------------------------------------------------------

def _outcomes(accepted: DataFrame, rejects: DataFrame) -> DataFrame:
    return (accepted.select("row_ord", F.lit("accepted").alias("outcome"))
            .union(rejects.select("row_ord", F.col("error").alias("outcome"))))


def _asked(spark, d) -> DataFrame:
    return fx.articles_from_documents(_t(spark, d, "documents")).drop("reply")


@query("annotation_failures", """
SELECT CAST(doc_id AS BIGINT) AS row_ord,
       CASE WHEN length(text) % 5 = 0 THEN 'RuntimeError: busy' ELSE 'accepted' END AS outcome
FROM documents""")
def q_annotation_failures(spark, d):
    """Every article is accepted, or rejected with the error of its call."""
    asked = A.annotate(_asked(spark, d), lambda: SI.FailingAnnotator(fx.STUB_TOPICS), fx.QUERY, fx.STUB_TOPICS, pin=True)
    return _outcomes(*A.parse_annotations(asked))


@query("annotation_retry", "SELECT CAST(doc_id AS BIGINT) AS row_ord, 'accepted' AS outcome FROM documents")
def q_annotation_retry(spark, d):
    """Failed calls are not stored: the next run sends them again."""
    from newsgraph.session import scratch_path

    store = scratch_path(spark, "reply-store")
    for client in (SI.FailingAnnotator, SI.StubAnnotator):
        asked = A.annotate(_asked(spark, d), lambda c=client: c(fx.STUB_TOPICS), fx.QUERY, fx.STUB_TOPICS, store=store)
        out = _outcomes(*A.parse_annotations(asked))
        if client is SI.FailingAnnotator:
            out.count()
    return out


HARD_HTML = ("<img alt=\"x > y\">one<script>var s=\"<!--\";</script><![CDATA[two]]>&copy 2024 AT&ampT "
             "&#0000000065;&#x0041&notit;<p title='a>b'><!-- <script> -->three</p>")
HARD_HTML_TEXT = "onetwo\u00a9 2024 AT&T AA\u00acit;three"


@query("html_to_text_hard", f"""
SELECT page_id, {S.lit(HARD_HTML_TEXT)} || {S.html_to_text('html')} AS text FROM pages""")
def q_html_to_text_hard(spark, d):
    """Each page with a hard piece of HTML in front, whose text is stated."""
    p = _t(spark, d, "pages")
    return p.select("page_id", T.html_to_text(F.concat(F.lit(HARD_HTML), F.col("html"))).alias("text"))


# ---------------------------------------------------------------------------
# Incremental feed (E-1)
# ---------------------------------------------------------------------------

@query("feed_stream", _with(S.FEED_ITEMS, S.NORMALIZED) + f"""
SELECT row_ord << 32 AS row_ord, title, newspaper, link, date FROM normalized
WHERE list_has_any({S.ws_tokens('lower(newspaper)')}, {_acc_tokens(ACCEPTED_NAMES)})""")
def q_feed_stream(spark, d):
    """Feed replies derived from pages (one reply per page) are landed twice
    (the second landing repeats every article) and read in micro-batches of
    four files; the stream keeps each link once, with its default settings."""
    import os

    from newsgraph.session import scratch_path
    from newsgraph.streaming.feed_stream import run_feed_stream

    base = scratch_path(spark, "feed-stream")
    items = fx.feed_items_from_pages(_t(spark, d, "pages"))
    replies = items.select(F.col("row_ord").cast("int").alias("source_idx"), F.lit(fx.QUERY).alias("keywords"),
                           F.array(F.struct(F.lit(0).alias("position"), "title", "link", "date", "source"))
                           .alias("news_results"))
    for i in range(2):
        replies.write.json(os.path.join(base, "in", f"landing-{i}"))
    q = run_feed_stream(spark, os.path.join(base, "in", "*"), ACCEPTED_NAMES, os.path.join(base, "out"),
                        os.path.join(base, "ckpt"), max_files_per_trigger=4)
    q.awaitTermination()
    return spark.read.parquet(os.path.join(base, "out")).select("row_ord", "title", "newspaper", "link", "date")
