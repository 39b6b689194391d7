"""The same rules as ``functions/text.py`` and ``plans/fixtures.py``,
stated in ANSI-style SQL (DuckDB dialect) for the oracle check."""

from __future__ import annotations

from newsgraph.functions import text as T
from newsgraph.plans import fixtures as fx


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def html_to_text(x: str) -> str:
    e = f"regexp_replace({x}, '(?s)<!--.*?(-->|$)', '', 'g')"
    for tag in T.SKIPPED_ELEMENTS:
        e = f"regexp_replace({e}, '(?is)<{tag}\\b[^>]*>.*?(</{tag}\\s*>|$)', '', 'g')"
    e = f"regexp_replace({e}, '(?s)<[!?][^>]*>', '', 'g')"
    e = f"regexp_replace({e}, '(?s)</?[A-Za-z][^>]*>', '', 'g')"
    for ent, ch in T.NATIVE_ENTITIES:
        e = f"replace({e}, {lit(ent)}, {lit(ch)})"
    return f"replace({e}, chr(10), '')"


def html_title(x: str) -> str:
    return html_to_text(f"regexp_extract({x}, '(?is)<title[^>]*>(.*?)</title', 1)")


def url_host(x: str) -> str:
    return f"regexp_extract({x}, '^[A-Za-z][A-Za-z0-9+.-]*://([^/:?#]+)', 1)"


def newspaper_of(x: str) -> str:
    return f"replace({url_host(x)}, '.', ' ')"


def feed_date_text(page_id: str) -> str:
    return (f"strftime(DATE {lit(fx.FEED_EPOCH)} + CAST({page_id} % {fx.FEED_DAYS} AS INTEGER), '%-m/%-d/%Y')"
            f" || {lit(fx.FEED_TIME_SUFFIX)}")


def parse_feed_date(x: str) -> str:
    return f"CAST(try_strptime(split_part({x}, ',', 1), '%m/%d/%Y') AS DATE)"


def ws_tokens(x: str) -> str:
    return f"list_filter(string_split_regex({x}, '\\s+'), lambda t: t <> '')"


def title_case(x: str) -> str:
    run = "[\\p{Lu}\\p{Ll}\\p{Lt}]"
    return (f"array_to_string(list_transform(regexp_extract_all({x}, '({run}+|[^\\p{{Lu}}\\p{{Ll}}\\p{{Lt}}]+)', 1), "
            f"lambda s: CASE WHEN regexp_matches(s, '^{run}') THEN replace(upper(s[1]), 'ẞ', 'Ss') || lower(s[2:]) "
            f"ELSE s END), '')")


def clean_json_text(x: str) -> str:
    e = x
    for a, b in zip(T.JSON_CLEAN_FROM, T.JSON_CLEAN_TO):
        e = f"replace({e}, chr({ord(a)}), {lit(b)})"
    for a in T.JSON_CLEAN_FROM[len(T.JSON_CLEAN_TO):]:  # no partner: deleted
        e = f"replace({e}, chr({ord(a)}), '')"
    return f"regexp_replace({e}, '[\\x00-\\x1F]', '', 'g')"


def pretoken_count(x: str) -> str:
    return f"CAST(len(regexp_extract_all({x}, {lit(T.PRETOKEN_RE)})) AS BIGINT)"


def brace_extract_cte(src: str, id_col: str, s_col: str, name: str) -> str:
    """CTEs ``{name}`` = ``(id, json)``: outermost brace group by a running
    depth over the brace characters."""
    return f"""
{name}_ch AS (
  SELECT {id_col} AS id, i, substr({s_col}, i, 1) AS c
  FROM (SELECT {id_col}, {s_col}, unnest(range(1, length({s_col}) + 1)) AS i FROM {src})
  WHERE substr({s_col}, i, 1) IN ('{{', '}}')),
{name}_dep AS (
  SELECT id, i, c, sum(CASE WHEN c = '{{' THEN 1 ELSE -1 END)
         OVER (PARTITION BY id ORDER BY i ROWS UNBOUNDED PRECEDING) AS d FROM {name}_ch),
{name}_se AS (
  SELECT id, min(i) FILTER (WHERE c = '{{' AND d = 1) AS st,
         min(i) FILTER (WHERE c = '}}' AND d = 0) AS en FROM {name}_dep GROUP BY id),
{name} AS (
  SELECT s.{id_col} AS id,
         CASE WHEN se.st IS NOT NULL AND se.en IS NOT NULL THEN substr(s.{s_col}, se.st, se.en - se.st + 1)
              ELSE '{{}}' END AS json
  FROM {src} s LEFT JOIN {name}_se se ON s.{id_col} = se.id)"""


# ---------------------------------------------------------------------------
# Base views (same rules as plans/fixtures.py)
# ---------------------------------------------------------------------------

FEED_ITEMS = f"""
feed_items AS (
  SELECT 0 AS source_idx, CAST(page_id AS INTEGER) AS position, {html_title('html')} AS title,
         url AS link, {feed_date_text('page_id')} AS date, {newspaper_of('url')} AS newspaper,
         CAST(page_id AS BIGINT) AS row_ord
  FROM pages)"""

NORMALIZED = f"""
normalized AS (
  SELECT title, newspaper, link, {parse_feed_date('date')} AS date, row_ord FROM feed_items)"""


def _div(n: int) -> str:
    return f"doc_id % {n} = 0"


REPLY_PARTS = f"""
reply_parts AS (
  SELECT doc_id, lang, source, text,
         regexp_replace(text, {lit(fx.REPLY_KEEP_RE)}, '', 'g')
           || CASE WHEN {_div(fx.HARD_TEXT)} AND NOT ({_div(fx.SINGLE_QUOTES)}) THEN {lit(fx.HARD_WORDS)} ELSE '' END AS r_text,
         CASE WHEN {_div(fx.EMPTY_TOPIC)} THEN '' ELSE source END AS r_topic,
         CASE WHEN {_div(fx.STRING_PERSONS)} THEN [{lit(fx.ONE_PERSON)}]
              WHEN {_div(fx.NO_PERSONS)} THEN CAST([] AS VARCHAR[])
              ELSE regexp_extract_all(text, {lit(fx.REPLY_PERSON_RE)}, 0) END AS r_persons
  FROM documents)"""

REPLIES = REPLY_PARTS + f""",
reply_kv AS (
  SELECT *, '"text": "' || replace(r_text, '"', chr(92) || '"') || '"' AS text_kv, '"topic": "' || r_topic || '"' AS topic_kv,
         '"persons": ' || CASE WHEN {_div(fx.STRING_PERSONS)} THEN '"' || {lit(fx.ONE_PERSON)} || '"' ELSE
           '[' || array_to_string(list_transform(r_persons, lambda x: '"' || x || '"'), ', ') || ']' END AS persons_kv
  FROM reply_parts),
replies AS (
  SELECT doc_id, lang, source, text, 'Ecco: ' || CASE
      WHEN {_div(fx.MISSING_COMMA)} THEN '{{' || text_kv || ' ' || topic_kv || ', ' || persons_kv || '}}'
      WHEN {_div(fx.NO_BRACES)} THEN 'nessun risultato'
      WHEN {_div(fx.NO_TOPIC_KEY)} THEN '{{' || text_kv || ', ' || persons_kv || '}}'
      WHEN {_div(fx.SINGLE_QUOTES)} THEN replace('{{' || text_kv || ', ' || topic_kv || ', ' || persons_kv || '}}', '"', '''')
      WHEN {_div(fx.TRAILING_COMMA)} THEN '{{' || text_kv || ', ' || topic_kv || ', ' || persons_kv || ',}}'
      ELSE '{{' || text_kv || ', ' || topic_kv || ', ' || persons_kv || '}}' END || ' fine' AS reply
  FROM reply_kv)"""

# Accepted annotations restated from the construction rules: a missing comma
# is rejected, no braces is an empty object (dropped), a missing topic key
# gives a null topic; an empty topic is dropped.
ACCEPTED = REPLY_PARTS + f""",
accepted_all AS (
  SELECT CAST(doc_id AS BIGINT) AS row_ord, 'doc ' || CAST(doc_id AS VARCHAR) AS title, lang AS newspaper,
         'https://news.example/' || CAST(doc_id AS VARCHAR) AS link,
         DATE {lit(fx.FEED_EPOCH)} + CAST(doc_id % {fx.FEED_DAYS} AS INTEGER) AS date,
         r_text AS text, CASE WHEN {_div(fx.NO_TOPIC_KEY)} THEN NULL ELSE r_topic END AS topics,
         r_persons AS persons
  FROM reply_parts
  WHERE NOT ({_div(fx.MISSING_COMMA)}) AND NOT ({_div(fx.NO_BRACES)})),
accepted AS (SELECT * FROM accepted_all WHERE topics IS DISTINCT FROM '')"""

def persons_ctes(src: str) -> str:
    """Explode (pe), title-case (pt), complete surnames (pdone) over ``src``
    (``row_ord, persons, ...``)."""
    return f"""
pe0 AS (SELECT row_ord, persons, unnest(range(0, len(persons))) AS pos FROM {src}),
pe AS (
  SELECT row_ord, CAST(pos AS INTEGER) AS pos, persons[pos + 1] AS person FROM pe0
  UNION ALL
  SELECT row_ord, CAST(NULL AS INTEGER), CAST(NULL AS VARCHAR) FROM {src}
  WHERE persons IS NULL OR len(persons) = 0),
pt AS (SELECT row_ord, pos, {title_case('person')} AS person FROM pe),
ptok AS (SELECT *, {ws_tokens('person')} AS t FROM pt),
full_names AS (
  SELECT t[-1] AS surname, arg_max(person, row_ord * 1000000 + pos) AS full_name
  FROM ptok WHERE len(t) >= 2 GROUP BY 1),
pdone AS (
  SELECT p.row_ord, p.pos,
         COALESCE(CASE WHEN len(p.t) = 1 THEN f.full_name END, p.person) AS person
  FROM ptok p LEFT JOIN full_names f ON len(p.t) = 1 AND p.t[1] = f.surname)"""


def regroup_ctes(src: str) -> str:
    """Regroup (grp) of ``src`` articles with the persons of ``pdone``."""
    return f"""
per_row AS (
  SELECT row_ord, list(person ORDER BY pos) FILTER (WHERE person IS NOT NULL) AS pl FROM pdone GROUP BY row_ord),
grp AS (
  SELECT title, newspaper, link, date, text, topics,
         flatten(list(coalesce(pl, CAST([] AS VARCHAR[])) ORDER BY row_ord)) AS persons
  FROM {src} LEFT JOIN per_row USING (row_ord)
  WHERE title IS NOT NULL AND newspaper IS NOT NULL AND link IS NOT NULL AND date IS NOT NULL
    AND text IS NOT NULL AND topics IS NOT NULL
  GROUP BY title, newspaper, link, date, text, topics)"""


PERSONS_EXPLODED = ACCEPTED + "," + persons_ctes("accepted")
PERSONS_FULL = PERSONS_EXPLODED
