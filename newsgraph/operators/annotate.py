"""Annotation of articles by an external language model.

Prompts are rendered natively (string concatenation).  Only the distinct
prompts are sent; the calls run in ``mapInPandas``, a bounded number at a
time per task, so tasks times calls in flight bounds the concurrency.  Replies
can be kept in a store keyed by the prompt hash (``replies``), written by each
task as it goes: later runs and retried tasks send only the prompts not yet
answered, and a recomputed stage reads the pinned replies instead of calling
again.

Replies are parsed with ``from_json`` against a fixed schema; a reply that
does not parse goes to a rejects table instead of stopping the run."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsgraph.functions.text import extract_braces, repair_json, with_columns_once
from newsgraph.operators.replies import (REPLY, ReplyPart, ReplyStore, key_part, key_part_column, store_uri,
                                         stored_replies)
from newsgraph.session import materialize

ANNOTATION = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("topic", T.StringType()),
    T.StructField("persons", T.StringType()),  # a list as JSON text, or one name
    T.StructField("_corrupt_record", T.StringType()),
])

CALL_WINDOW = 256   # prompts of a task that are with the pool at a time
LEFT_KEYS = 500_000  # keys of prompts left to send that are broadcast

# --------------------------------------------------------------------------
# Prompt templates (own wording).  The article text goes last, after the
# marker, so a client can find it.
# --------------------------------------------------------------------------

TEXT_MARKER = "\n### TESTO\n"

SYSTEM_ANNOTATE = "Leggi articoli e ne ricavi dati ordinati. Rispondi sempre in JSON."
SYSTEM_SUMMARY = "Riassumi articoli in modo fedele e breve."
SYSTEM_CLEAN = "Separi il testo di un articolo dal resto della pagina."
SYSTEM_CLUSTER = "You sort short topic names into groups and answer in JSON."

ANNOTATE_HEAD = (
    "Leggi l'articolo qui sotto, preso da una pagina web, e rispondi con un solo "
    "oggetto JSON, senza altro testo.\n"
    "Chiavi:\n"
    '  "text": la parte che parla di {query}, ripulita dal resto della pagina e '
    "riassunta in 3 righe;\n"
    '  "topic": l\'unico argomento principale, il piu\' specifico possibile;\n'
    '  "persons": i nomi dei personaggi pubblici citati, o una lista vuota.\n'
    'Forma: {{"text": "...", "topic": "...", "persons": ["..."]}}\n'
)
ANNOTATE_TOPICS = ("L'argomento deve essere uno di questi: {topics}. Se nessuno va bene, "
                   'lascia "topic" vuoto.\n')
SUMMARY_HEAD = ("Riassumi il testo qui sotto in 500 parole. Rispondi solo con il riassunto, "
                "senza commenti.\n")
CLEAN_HEAD = ("Pulisci il testo qui sotto, estratto da un sito web: togli pubblicita' e "
              "rumore, tieni solo titolo, autore e corpo dell'articolo, in questo ordine. "
              "Non aggiungere parole.\n")
CLUSTER_HEAD = ("Group the news topics below so that very similar topics share a cluster. "
                "Answer ONLY with a JSON object whose keys are cluster labels and whose values "
                "are the lists of topics in each cluster.\n")
CLUSTER_LABELS = "Every label must be one of: {labels}.\n"
CLUSTER_MARKER = "\n### TOPICS\n"


def _topic_list(topics: Sequence[str]) -> str:
    return ", ".join(f'"{t}"' for t in topics)


def annotate_prompt(text: Column, query: str, topics: Sequence[str] | None = None) -> Column:
    head = ANNOTATE_HEAD.format(query=query)
    if topics:
        head += ANNOTATE_TOPICS.format(topics=_topic_list(topics))
    return F.concat(F.lit(head + TEXT_MARKER), text)


def summary_prompt(text: Column) -> Column:
    return F.concat(F.lit(SUMMARY_HEAD + TEXT_MARKER), text)


def clean_prompt(text: Column) -> Column:
    return F.concat(F.lit(CLEAN_HEAD + TEXT_MARKER), text)


def cluster_prompt(topic_lines: Column, labels: Sequence[str] | None = None) -> Column:
    """``topic_lines``: the batch's topics joined by newlines."""
    head = CLUSTER_HEAD
    if labels:
        head += CLUSTER_LABELS.format(labels=_topic_list(labels))
    return F.concat(F.lit(head + CLUSTER_MARKER), topic_lines)


def prompt_body(prompt: str, marker: str = TEXT_MARKER) -> str:
    """The article text (or topic list) of a rendered prompt."""
    i = prompt.find(marker)
    return prompt if i < 0 else prompt[i + len(marker):]


# --------------------------------------------------------------------------
# Calling the model
# --------------------------------------------------------------------------

@dataclass(frozen=True)
class CallSpec:
    system: str
    max_tokens: int = 1024
    min_interval: float = 0.0       # seconds between calls of one caller
    on_error: str = "null"          # "null" or "empty"
    in_flight: int = 4              # calls of one task at a time
    model: str = ""                 # passed on to the client factory's caller; part of the store key


ANNOTATE_CALL = CallSpec(SYSTEM_ANNOTATE, 1024)
SUMMARY_CALL = CallSpec(SYSTEM_SUMMARY, 200)
CLEAN_CALL = CallSpec(SYSTEM_CLEAN, 1024, on_error="empty")
CLUSTER_CALL = CallSpec(SYSTEM_CLUSTER, 4096)


def _call_batches(client_factory: Callable, spec: CallSpec, store: ReplyStore | None = None, parts: int = 1):
    """Per partition of distinct prompts: up to ``spec.in_flight`` calls at a
    time, each on a client of its own thread, started ``spec.min_interval``
    apart.  With a store, finished replies are written as they come, and those
    that an earlier attempt of the same part wrote are not asked for again."""
    import pandas as pd

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import threading
        from concurrent.futures import ThreadPoolExecutor, as_completed

        own, gate, last = threading.local(), threading.Lock(), [-spec.min_interval]
        part = None

        def call(prompt: str):
            if not hasattr(own, "client"):
                own.client = client_factory()
            if spec.min_interval:
                with gate:  # one limit for all calls of the task
                    wait = spec.min_interval - (time.monotonic() - last[0])
                    if wait > 0:
                        time.sleep(wait)
                    last[0] = time.monotonic()
            try:
                return own.client.complete(spec.system, prompt, spec.max_tokens), None
            except Exception as ex:  # the reply is marked, the run goes on
                return "" if spec.on_error == "empty" else None, f"{type(ex).__name__}: {ex}"

        pool = ThreadPoolExecutor(max(1, spec.in_flight))
        try:
            for b in batches:
                keys, prompts = b["prompt_key"].tolist(), b["prompt"].tolist()
                found = {}
                if store is not None and keys:
                    if part is None:
                        part = ReplyPart(store, key_part(keys[0], parts), parts)
                    found = {k: (part.known[k], None) for k in keys if k in part.known}
                todo = [(k, p) for k, p in zip(keys, prompts) if k not in found]
                try:
                    for at in range(0, len(todo), CALL_WINDOW):  # as many prompts wait in the pool at most
                        calls = {pool.submit(call, p): k for k, p in todo[at:at + CALL_WINDOW]}
                        for done in as_completed(calls):
                            found[calls[done]] = done.result()
                            if part is not None and found[calls[done]][1] is None:
                                part.add(calls[done], found[calls[done]][0])
                finally:
                    if part is not None:
                        part.flush()
                yield pd.DataFrame({"prompt_key": keys, "reply": [found[k][0] for k in keys],
                                    "error": [found[k][1] for k in keys]})
        finally:
            pool.shutdown(wait=True, cancel_futures=True)

    return run


def call_model(df: DataFrame, prompt: Column, client_factory: Callable, spec: CallSpec,
               partitions: int | None = None, store: str | None = None,
               pin: bool = False) -> DataFrame:
    """Add ``prompt_key``, ``reply`` and ``error`` to ``df``.

    Distinct prompts only are sent (the dedupe combines on the map side, so
    a prompt shared by a third of all rows costs one partial row per map
    task); the calls run in ``partitions`` round-robin partitions of
    distinct prompts (the number of concurrent callers); replies are joined
    back on the prompt hash (AQE splits a hot key).  ``prompt`` must refer
    to columns by name.

    With ``store`` (a folder in the shared file system) stored replies are
    reused and only new prompts are sent.  Each task handles one range of key
    prefixes and writes its replies to the store as they come, so a task that
    is killed, or a run that ends halfway, is resumed with the prompts that
    were not finished; a failed call is not stored and is sent again.  The key covers the
    model, the system line and the token limit besides the prompt.  With
    ``pin`` or ``store`` the input rows are written once to the shared
    folder (so the input plan is not run twice) and the replies too (so no
    recomputed stage calls the model again)."""
    spark = df.sparkSession
    n = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = F.lit(f"{spec.model}\x00{spec.system}\x00{spec.max_tokens}\x00")
    base = df.withColumn("prompt_key", F.sha2(F.concat(key, prompt), 256))
    if store or pin:
        base = materialize(base, "prompted")
    todo = base.select("prompt_key", prompt.alias("prompt"))
    kept = ReplyStore(store_uri(spark, store)) if store else None
    if kept:
        stored = stored_replies(spark, kept).select("prompt_key")
        if not stored.isEmpty():
            # keys are short: where few are left to send, the prompts of the others are not shuffled
            left = base.select("prompt_key").join(stored, "prompt_key", "left_anti").distinct()
            if left.limit(LEFT_KEYS + 1).count() <= LEFT_KEYS:
                left = left.select(F.col("prompt_key").alias("_left"))
                todo = todo.join(F.broadcast(left), F.col("prompt_key").eqNullSafe(F.col("_left")), "left_semi")
    todo = todo.dropDuplicates(["prompt_key"])
    if kept:
        todo = todo.join(stored, "prompt_key", "left_anti")
        todo = todo.repartitionById(n, key_part_column("prompt_key", n))
    else:
        todo = todo.repartition(n)
    replies = todo.mapInPandas(_call_batches(client_factory, spec, kept, n), REPLY)
    if kept:
        # the tasks store what succeeds as they go; only the failures are left to write
        failed = materialize(replies.where(F.col("error").isNotNull()), "replies")
        replies = stored_replies(spark, kept).unionByName(failed)
    elif pin:
        replies = materialize(replies, "replies")
    return base.join(replies, "prompt_key", "left")


def annotate(df: DataFrame, client_factory: Callable, query: str, topics: Sequence[str] | None = None,
             text_col: str = "text", **kw) -> DataFrame:
    """Annotation reply (topic, persons, short text as JSON) per row."""
    return call_model(df, annotate_prompt(F.col(text_col), query, topics), client_factory, ANNOTATE_CALL, **kw)


def summarize(df: DataFrame, client_factory: Callable, text_col: str = "text", out_col: str = "summary",
              **kw) -> DataFrame:
    """Summary of ``text_col`` by the model (at most 200 tokens asked)."""
    out = call_model(df, summary_prompt(F.col(text_col)), client_factory, SUMMARY_CALL, **kw)
    return out.withColumnRenamed("reply", out_col)


def clean_texts(df: DataFrame, client_factory: Callable, text_col: str = "text", **kw) -> DataFrame:
    """Page text cleaned by the model (title, author, body); a failed call
    gives an empty string, as the page cleaner does."""
    out = call_model(df, clean_prompt(F.col(text_col)), client_factory, CLEAN_CALL, **kw)
    return out.withColumn(text_col, F.col("reply")).drop("reply")


# --------------------------------------------------------------------------
# Parsing replies
# --------------------------------------------------------------------------

def parse_annotations(df: DataFrame, reply_col: str = "reply",
                      drop_columns: Sequence[str] = ("prompt_key", "error")) -> tuple[DataFrame, DataFrame]:
    """Split replies into (accepted, rejects).

    accepted: rows whose reply holds a parseable non-empty object, with
    ``text`` replaced by the reply's text, ``topics`` and ``persons`` added;
    a missing key gives null, a bare string as persons is one person.  The
    object is parsed as it was sent; only one that does not parse is
    repaired (outside its strings) and parsed again.  An empty object drops
    the row.  rejects: rows whose object does not parse and rows whose call
    failed, with the reply, the extracted object and the error."""
    # three once-per-row steps, so no stage sees a costly input twice
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", "allowSingleQuotes": "true",
               "allowUnquotedControlChars": "true"}
    broken = lambda c: F.col(c).isNull() | F.col(f"{c}._corrupt_record").isNotNull()
    parsed = with_columns_once(df, _j0=extract_braces(F.col(reply_col)))
    parsed = with_columns_once(parsed, _a0=F.from_json(F.col("_j0"), ANNOTATION, options))
    parsed = with_columns_once(parsed, _json=F.when(broken("_a0"), repair_json(F.col("_j0"))).otherwise(F.col("_j0")))
    parsed = with_columns_once(parsed, _ann=F.when(
        broken("_a0"), F.from_json(F.col("_json"), ANNOTATION, options)).otherwise(F.col("_a0")))
    parsed = parsed.drop("_j0", "_a0")
    failed = F.col("error").isNotNull() if "error" in df.columns else F.lit(False)
    empty = F.regexp_like(F.col("_json"), F.lit(r"^\{\s*\}$")) & ~failed
    bad = broken("_ann") | failed
    given = F.col("_ann.persons")
    persons = (F.when(F.startswith(given, F.lit("[")), F.from_json(given, "array<string>"))
               .when(given.isNotNull(), F.array(given)))
    base = [c for c in df.columns if c not in (reply_col, "text", *drop_columns)]
    accepted = (parsed.filter(~empty & ~bad)
                .select(*base,
                        F.col("_ann.text").alias("text"),
                        F.col("_ann.topic").alias("topics"),
                        persons.alias("persons")))
    error = F.col("error") if "error" in df.columns else F.lit(None).cast("string")
    rejects = parsed.filter(~empty & bad).select(*base, F.col(reply_col).alias("reply"),
                                                 F.col("_json").alias("json"), error.alias("error"))
    return accepted, rejects


def drop_empty_topics(df: DataFrame, col: str = "topics") -> DataFrame:
    """Drop rows whose topic is the empty string.  Null topics stay here;
    they leave at the regroup, after their persons fed the surname map."""
    return df.filter(~F.col(col).eqNullSafe(F.lit("")))
