"""Queries over documents, pages and model responses, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.functions import jsons, text as tx
from loomgraph.operators import documents as docs_, extraction
from loomgraph.plans import fixtures as fx
from loomgraph.plans.fixtures import table

QUERIES, ORACLE_SQL = {}, {}
WS = "[ \\t\\n\\x0B\\f\\r]+"


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


_LANG = "CASE WHEN doc_id % 17 = 0 THEN NULL ELSE lang END"
_META = "concat('{\"lang\":\"', upper(lang), '_X\",\"source\":\"', source, '\"}')"


def bronze(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "documents").selectExpr("doc_id", "text AS raw_text", f"{_LANG} AS lang", f"{_META} AS metadata")
    return docs_.to_bronze(rows, "vi")


_BRONZE = f"SELECT doc_id, text AS raw_text, coalesce(CASE WHEN length(trim({_LANG})) > 0 THEN {_LANG} END, CASE WHEN length(trim({_META}::JSON->>'lang')) > 0 THEN {_META}::JSON->>'lang' END, 'vi') AS lang, {_META} AS metadata FROM documents WHERE doc_id IS NOT NULL AND text IS NOT NULL"
_CLEAN = f"trim(regexp_replace(regexp_replace(replace(regexp_replace(replace(raw_text, '�', ' '), '&nbsp;|&#160;', ' ', 'g'), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '{WS}', ' ', 'g'))"
_FLAGGED = f"""SELECT *, text = '' AS empty, lang NOT IN ('en', 'de', 'fr-x') AS disallowed, lang IS NULL AS null_lang, length(text) < 40 AS short
 FROM (SELECT doc_id, {_CLEAN} AS text, lower(replace(lang, '_', '-')) AS lang FROM ({_BRONZE}))"""


def _flagged(spark, sf):
    return docs_.clean_documents(bronze(spark, sf), ["en", "de", "fr-x"], 40)


@query(f"SELECT doc_id, lang, metadata, sha256(raw_text) AS raw_hash FROM ({_BRONZE})")
def ingest_bronze(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf).select("doc_id", "lang", "metadata", F.sha2("raw_text", 256).alias("raw_hash"))


@query(f"SELECT lang, count(*) AS n FROM ({_BRONZE}) GROUP BY lang")
def lang_resolve(spark: SparkSession, sf: str) -> DataFrame:
    return bronze(spark, sf).groupBy("lang").agg(F.count("*").alias("n"))


@query(f"SELECT doc_id, lang, sha256(text) AS text_hash, CAST(length(text) AS BIGINT) AS n FROM ({_FLAGGED}) WHERE NOT (empty OR disallowed OR short)")
def doc_clean(spark: SparkSession, sf: str) -> DataFrame:
    return docs_.cleaned(_flagged(spark, sf)).select("doc_id", "lang", "text_hash", F.length("text").cast("bigint").alias("n"))


@query(f"SELECT count(*) AS input_rows, count(*) FILTER (empty) AS removed_empty, count(*) FILTER (disallowed) AS removed_language, count(*) FILTER (null_lang) AS removed_null_lang, count(*) FILTER (short) AS removed_short, count(*) FILTER (NOT (empty OR disallowed OR short)) AS kept_rows FROM ({_FLAGGED})")
def doc_clean_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return docs_.clean_metrics(_flagged(spark, sf))


@query("SELECT sha256(text) AS text_hash, count(*) AS copies, min(doc_id) AS first_id FROM documents GROUP BY 1 HAVING count(*) > 1")
def text_dedup_hash(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").groupBy(F.sha2("text", 256).alias("text_hash")).agg(F.count("*").alias("copies"), F.min("doc_id").alias("first_id")).where("copies > 1")


#: Greedy chunks as a recursion over word positions a..b: c[i] is the length of the first i words with a space after each. No word is longer than a chunk.
_CHUNKED = r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(text, '\S+') AS ws FROM documents),
 u AS (SELECT doc_id, ws, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w WHERE len(ws) > 0), s AS (SELECT doc_id, i, sum(length(word) + 1) OVER (PARTITION BY doc_id ORDER BY i) AS c FROM u),
 d AS MATERIALIZED (SELECT w.doc_id, w.ws, len(w.ws) AS n, x.c FROM w JOIN (SELECT doc_id, list(CAST(c AS BIGINT) ORDER BY i) AS c FROM s GROUP BY doc_id) x USING (doc_id)),
 r(doc_id, k, a, b) AS (SELECT doc_id, 0, 1, greatest(1, len([x FOR x IN c IF x <= 3001])) FROM d
  UNION ALL SELECT doc_id, k + 1, a2, greatest(b + 1, len([x FOR x IN c IF x <= 3001 + CASE WHEN a2 > 1 THEN c[a2 - 1] ELSE 0 END])) FROM (
   SELECT r.doc_id, k, b, c, greatest(a, 1 + CASE WHEN c[b] - 201 > 0 THEN 1 ELSE 0 END + len([x FOR x IN c IF x < c[b] - 201])) AS a2 FROM r JOIN d USING (doc_id) WHERE b < n)),
 t AS (SELECT r.doc_id, k, array_to_string(ws[a:b], ' ') AS x FROM r JOIN d USING (doc_id)),
 f AS (SELECT *, max(length(x)) OVER (PARTITION BY doc_id) AS longest, row_number() OVER (PARTITION BY doc_id ORDER BY length(x) DESC, k) AS place FROM t)
 SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY k) - 1 AS INTEGER) AS chunk_id, x FROM f WHERE length(x) >= 50 OR (longest < 50 AND place = 1)"""


@query(f"SELECT doc_id, chunk_id, sha256(x) AS chunk_hash FROM ({_CHUNKED})")
def document_chunks(spark: SparkSession, sf: str) -> DataFrame:
    return docs_.chunk_documents(table(spark, sf, "documents"), most=None).select("doc_id", "chunk_id", "chunk_hash")


@query(f"SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS chunks, round(avg(n), 6) AS avg_chunks, max(n) AS max_chunks, round(sum(chars) / sum(n), 6) AS avg_chars FROM (SELECT doc_id, count(*) AS n, sum(length(x)) AS chars FROM ({_CHUNKED}) GROUP BY doc_id)")
def chunk_stats(spark: SparkSession, sf: str) -> DataFrame:
    return docs_.chunk_stats(docs_.chunk_documents(table(spark, sf, "documents"), most=None))


_STAGES = [("entity_relation", "You extract.", "Entities of: {{text}}", "v1"), ("event_entity", "You extract.", "Events of: {{text}}", "v1"), ("event_relation", "You extract.", "Relations of: {{text}}", "v2")]


def _requests(spark, sf):
    stages = spark.createDataFrame(_STAGES, "stage string, system_prompt string, user_prompt string, prompt_version string")
    whole = table(spark, sf, "documents").select("doc_id", F.lit(0).alias("chunk_id"), F.col("text").alias("chunk_text"))
    return docs_.extraction_requests(whole, stages, "stub")


_STAGE_SQL = "(VALUES " + ", ".join(f"('{a}', '{b}', '{c}', '{d}')" for a, b, c, d in _STAGES) + ") s(stage, system_prompt, user_prompt, prompt_version)"
_REQUESTS = f"SELECT sha256(concat_ws('||', CAST(doc_id AS STRING), '0', stage, prompt_version, 'stub')) AS request_id, doc_id, 0 AS chunk_id, stage, replace(user_prompt, '{{{{text}}}}', text) AS user_prompt FROM documents, {_STAGE_SQL}"


@query(f"SELECT request_id, doc_id, stage, sha256(user_prompt) AS prompt_hash FROM ({_REQUESTS})")
def extraction_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _requests(spark, sf).select("request_id", "doc_id", "stage", F.sha2("user_prompt", 256).alias("prompt_hash"))


@query(f"SELECT stage, count(*) AS rows, count(DISTINCT request_id) AS ids FROM ({_REQUESTS}) GROUP BY stage")
def request_cardinality(spark: SparkSession, sf: str) -> DataFrame:
    return docs_.cardinality(_requests(spark, sf))


_RAW = "CASE WHEN page_id % 13 = 0 THEN NULL WHEN page_id % 11 = 0 THEN '   ' ELSE html END"


@query(f"""SELECT page_id, CASE WHEN t IS NULL THEN 'missing_text' WHEN page_id % 7 = 0 THEN 'invalid_type' WHEN trim(t) = '' THEN 'empty_text' WHEN length(trim(t)) < 1500 THEN 'too_short' END AS reason,
 coalesce(CASE WHEN page_id % 5 = 0 THEN CAST(page_id AS STRING) END, CASE WHEN length(trim(url)) > 0 THEN url END) AS doc_id FROM (SELECT page_id, url, {_RAW} AS t FROM pages)""")
def preprocess_rejects(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "pages").selectExpr("page_id", "url", f"{_RAW} AS t")
    own = F.when(F.col("page_id") % 5 == 0, F.col("page_id").cast("string"))
    return df.select("page_id", docs_.reject_reason(F.col("t"), F.col("page_id") % 7 != 0, 1500).alias("reason"), docs_.derive_doc_id(own, F.col("url"), content=F.col("t")).alias("doc_id"))


_FLAT = f"trim(regexp_replace(text, '{WS}', ' ', 'g'))"


@query(f"""SELECT doc_id, CASE WHEN length(f) <= 280 THEN f ELSE concat(CASE WHEN contains(left(f, 281), ' ') THEN regexp_extract(left(f, 281), '(?s)^(.*) [^ ]*$', 1) ELSE left(f, 280) END, '...') END AS preview,
 CASE WHEN length(f) <= 100 THEN f ELSE concat(rtrim(left(f, 97)), '...') END AS compact, left(f, 500) AS excerpt FROM (SELECT doc_id, {_FLAT} AS f FROM documents)""")
def text_previews(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", tx.preview("text").alias("preview"), tx.compact("text", 100).alias("compact"), tx.excerpt("text").alias("excerpt"))


_FOLD = "replace(lower(strip_accents(translate(text, 'đĐ', 'dD'))), 'ß', 'ss')"


@query(f"SELECT doc_id, sha256({_FOLD}) AS folded_hash FROM documents")
def ascii_fold(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2(tx.ascii_fold("text"), 256).alias("folded_hash"))


@query(r"""SELECT item_id, CASE WHEN len(t) = 0 THEN '*' ELSE array_to_string([CASE WHEN length(x) >= 4 AND NOT regexp_full_match(x, '[0-9]+') THEN concat(x, '~1') ELSE x END FOR x IN t], ' OR ') END AS q
 FROM (SELECT item_id, regexp_extract_all(lower(text), '[\p{L}\p{N}_]+') AS t FROM benchmark)""")
def fuzzy_query(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select("item_id", tx.fuzzy_query("text").alias("q"))


@query(r"SELECT doc_id, sha256(trim(regexp_replace(regexp_replace(lower(text), '[^\p{L}\p{M}\p{N}_\s]', ' ', 'g'), '\s+', ' ', 'g'))) AS form_hash FROM documents")
def answer_normalize(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", F.sha2(tx.answer_form("text"), 256).alias("form_hash"))


@query("SELECT p_partkey, array_to_string([trim(x) FOR x IN string_split(concat(p_brand, '<SEP> ', p_type, '<SEP><SEP>', p_name), '<SEP>') IF trim(x) <> ''], '|') AS parts FROM part")
def sep_lists(spark: SparkSession, sf: str) -> DataFrame:
    joined = F.concat("p_brand", F.lit("<SEP> "), "p_type", F.lit("<SEP><SEP>"), "p_name")
    return table(spark, sf, "part").select("p_partkey", F.array_join(tx.split_list(joined), "|").alias("parts"))


_CLEANED = "trim(regexp_replace(regexp_replace(replace(regexp_replace({0}, '&nbsp;|&#160;', ' ', 'g'), '&amp;', '&'), '<[^>]+>', ' ', 'g'), '" + WS + "', ' ', 'g'))"
_TITLE = _CLEANED.format("regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1)")
_H1 = _CLEANED.format("regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1)")
_BODY = _CLEANED.format("regexp_replace(html, '(?is)<head[^>]*>.*?</head>|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->', ' ', 'g')")


@query(f"SELECT page_id, CASE WHEN {_TITLE} <> '' THEN {_TITLE} WHEN {_H1} <> '' THEN {_H1} ELSE url END AS title, sha256({_BODY}) AS body_hash FROM pages")
def html_extract(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "pages").select("page_id", tx.html_title("html", "url").alias("title"), F.sha2(tx.html_text("html"), 256).alias("body_hash"))


# --- model responses

_KIND = f"SELECT *, {fx.OUTCOME} AS parse_status FROM ({fx.RESPONSES})"


def parsed(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.parse_responses(fx.responses(spark, sf))


@query(f"SELECT stage, status, parse_status, count(*) AS n FROM ({_KIND}) GROUP BY ALL")
def validate_counts(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.parse_metrics(parsed(spark, sf))


@query(f"SELECT doc_id, chunk_id, stage, parse_status, CASE WHEN status <> 'SUCCESS' THEN 'source_not_success' WHEN l_orderkey % 7 = 0 THEN 'invalid_json' WHEN stage = 'event_entity' THEN 'invalid_entities' ELSE 'missing_field' END AS error_code, coalesce(response_text, '') AS response_excerpt FROM ({_KIND}) WHERE parse_status <> 'VALID'")
def extraction_rejects(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.rejects(parsed(spark, sf))


@query(f"SELECT stage, CAST(sum(l_partkey % 100) AS BIGINT) AS prompt_tokens, CAST(sum(7) AS BIGINT) AS completion_tokens, CAST(sum(l_partkey % 100 + 7) AS BIGINT) AS total_tokens FROM ({fx.RESPONSES}) GROUP BY stage")
def usage_totals(spark: SparkSession, sf: str) -> DataFrame:
    return extraction.usage_totals(fx.responses(spark, sf))


@query(f"SELECT status, count(*) AS n FROM ({fx.RESPONSES}) GROUP BY status")
def status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return fx.responses(spark, sf).groupBy("status").agg(F.count("*").alias("n"))


def structured(spark: SparkSession, sf: str) -> DataFrame:
    chunks = fx.responses(spark, sf).select("doc_id", "chunk_id", F.concat(F.lit(" text "), "doc_id", F.lit("/"), F.col("chunk_id").cast("string")).alias("original_text")).distinct()
    return extraction.structured(parsed(spark, sf), chunks, "request_id")


#: One valid response for each chunk and stage.
CHOSEN = f"SELECT doc_id, chunk_id, stage, arg_min(l_partkey, request_id) AS partkey, arg_min(l_returnflag, request_id) AS flag, arg_min(l_suppkey, request_id) AS suppkey FROM ({_KIND}) WHERE parse_status = 'VALID' GROUP BY ALL"


@query(f"""SELECT doc_id, chunk_id, concat(' text ', doc_id, '/', CAST(chunk_id AS STRING)) AS original_text, count(*) AS n_stages,
 coalesce(max(CASE WHEN stage = 'entity_relation' THEN concat('p', CAST(partkey AS STRING)) END), '') AS entity_head, coalesce(max(CASE WHEN stage = 'event_relation' THEN concat('p', CAST(partkey AS STRING)) END), '') AS event_head,
 CAST(count(*) FILTER (stage = 'event_entity') AS INTEGER) AS events, coalesce(max(CASE WHEN stage = 'event_entity' THEN concat('p', CAST(partkey AS STRING), ' sold:', flag, ',s', CAST(suppkey AS STRING)) END), '') AS event FROM ({CHOSEN}) GROUP BY doc_id, chunk_id""")
def structured_pivot(spark: SparkSession, sf: str) -> DataFrame:
    head = lambda s: F.coalesce(F.get(F.col(s), F.lit(0))["Head"], F.lit(""))
    event = F.array_join(F.transform("event_entity", lambda e: F.concat(e["Event"], F.lit(":"), F.array_join(e["Entity"], ","))), ";")
    return structured(spark, sf).select("doc_id", "chunk_id", "original_text", "n_stages", head("entity_relation").alias("entity_head"), head("event_relation").alias("event_head"), F.size("event_entity").alias("events"), event.alias("event"))


_CONCEPT_TEXT = """CASE WHEN p_partkey % 5 = 0 THEN concat('{"concepts": ["', p_brand, '", " ', p_type, '  x", "", "', p_brand, '"]}')
 WHEN p_partkey % 5 = 1 THEN concat(p_brand, ', ', p_type, ' ,', p_brand) WHEN p_partkey % 5 = 2 THEN concat('["', p_brand, '", 3]') WHEN p_partkey % 5 = 3 THEN '[' ELSE concat('```json', chr(10), '["', p_type, '"]', chr(10), '```') END"""


@query("""SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN concat(p_brand, '|', p_type, ' x') WHEN p_partkey % 5 = 1 THEN concat(p_brand, '|', p_type) WHEN p_partkey % 5 = 4 THEN p_type END AS concepts FROM part""")
def concepts_parse(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "part").selectExpr("p_partkey", f"{_CONCEPT_TEXT} AS t")
    return df.select("p_partkey", F.array_join(jsons.concepts("t"), "|").alias("concepts"))


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_scalar(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("event_id", jsons.scalar("props", "k").alias("k"))


@query("SELECT conv_id, turn, nxt AS next_chunk FROM (SELECT conv_id, turn, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS nxt FROM conversations) WHERE nxt IS NOT NULL")
def next_chunk(spark: SparkSession, sf: str) -> DataFrame:
    return docs_.next_chunks(table(spark, sf, "conversations"), "conv_id", ["turn"], "turn")


@query("SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def longest_documents(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "documents").select("doc_id", "source", "n_chars").orderBy(F.desc("n_chars"), "doc_id").limit(20)


@query("SELECT round(avg(length(text)), 6) AS avg_text_length, max(length(text)) AS max_text_length, round(avg(length(source)), 6) AS avg_source_length, max(length(source)) AS max_source_length FROM documents")
def text_lengths(spark: SparkSession, sf: str) -> DataFrame:
    df = docs_.text_lengths(table(spark, sf, "documents"), "text", "source")
    return df.withColumns({c: F.col(c).cast("bigint") for c in ("max_text_length", "max_source_length")})


#: Raw records: ids in five places, as number, object or text; hosts with ports.
_RECORD = """CASE page_id % 6 WHEN 0 THEN concat('{"key": {"n": ', page_id, '}, "url": "', url, '"}') WHEN 1 THEN concat('{"_id": {"$oid": "o', page_id, '"}, "domain": "d', page_id % 3, '"}')
 WHEN 2 THEN concat('{"key": {}, "_id": ', page_id, ', "url": "http://h', page_id % 5, ':80/x"}') WHEN 3 THEN concat('{"key": {"n": ""}, "id": true, "url": ""}') WHEN 4 THEN concat('{"_id": {"b": 1, "a": ', page_id, '}}') ELSE '{"x": 1}' END"""


@query(r"""SELECT page_id, CASE page_id % 6 WHEN 0 THEN CAST(page_id AS VARCHAR) WHEN 1 THEN concat('o', page_id) WHEN 2 THEN CAST(page_id AS VARCHAR) WHEN 3 THEN 'true' WHEN 4 THEN concat('{"a": ', page_id, ', "b": 1}') ELSE sha256(html) END AS doc_id,
 CASE page_id % 6 WHEN 0 THEN regexp_extract(url, '^[a-zA-Z]+://([^/?#]+)', 1) WHEN 1 THEN concat('d', page_id % 3) WHEN 2 THEN concat('h', page_id % 5, ':80') ELSE 'pages' END AS source_name FROM pages""")
def source_ids(spark: SparkSession, sf: str) -> DataFrame:
    df = table(spark, sf, "pages").selectExpr("page_id", "html", f"{_RECORD} AS record")
    return df.select("page_id", docs_.derive_doc_id(docs_.source_id("record", "key.n"), content=F.col("html")).alias("doc_id"), docs_.source_name("record", F.lit("/raw/pages.jsonl")).alias("source_name"))
