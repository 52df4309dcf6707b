"""Documents: ingest, clean, chunk, and requests to a model."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import jsons
from loomgraph.functions import text as tx
from loomgraph.functions.chunking import chunks


def to_bronze(docs: DataFrame, default_lang: str = "vi") -> DataFrame:
    """doc_id, raw_text, lang, metadata: rows without id or text are left out (see missing_keys)."""
    return docs.where(F.col("doc_id").isNotNull() & F.col("raw_text").isNotNull()).select("doc_id", "raw_text", tx.resolve_lang("lang", "metadata", default_lang).alias("lang"), "metadata")


def missing_keys(docs: DataFrame) -> DataFrame:
    return docs.where(F.col("doc_id").isNull() | F.col("raw_text").isNull())


def clean_documents(bronze: DataFrame, languages: list[str], least: int = 20, steps: tuple[str, ...] = tx.CLEAN_STEPS) -> DataFrame:
    """All rows with text, lang and the flags empty, disallowed, null_lang, short; kept: none of them."""
    df = bronze.withColumns({"text": tx.clean("raw_text", steps), "lang": tx.lang_code("lang")})
    df = df.withColumns({"empty": F.coalesce(F.col("text") == "", F.lit(True)), "disallowed": ~F.col("lang").isin(languages), "null_lang": F.col("lang").isNull(), "short": F.length("text") < least})
    return df.withColumn("kept", ~F.col("empty") & ~F.coalesce("disallowed", F.lit(True)) & ~F.coalesce("short", F.lit(True)))


def cleaned(flagged: DataFrame) -> DataFrame:
    return flagged.where("kept").select("doc_id", "text", "lang", F.sha2("text", 256).alias("text_hash"))


def clean_metrics(flagged: DataFrame) -> DataFrame:
    """One pass: input and removed rows by reason (reasons overlap; null languages are apart), kept rows."""
    return flagged.agg(
        F.count("*").alias("input_rows"), F.count_if("empty").alias("removed_empty"), F.count_if("disallowed").alias("removed_language"),
        F.count_if("null_lang").alias("removed_null_lang"), F.count_if("short").alias("removed_short"), F.count_if("kept").alias("kept_rows"),
    )


def chunk_documents(docs: DataFrame, size: int = 3000, overlap: int = 200, least: int = 50, most: int | None = 50) -> DataFrame:
    """doc_id, lang, chunk_id (from 0), chunk_text, chunk_hash."""
    out = docs.select("doc_id", "lang", F.posexplode(chunks(F.col("text"), size, overlap, least, most)).alias("chunk_id", "chunk_text"))
    return out.withColumn("chunk_hash", F.sha2("chunk_text", 256))


def chunk_stats(chunked: DataFrame) -> DataFrame:
    per_doc = chunked.groupBy("doc_id").agg(F.count("*").alias("n"), F.sum(F.length("chunk_text")).alias("chars"))
    return per_doc.agg(F.count("*").alias("docs"), F.sum("n").alias("chunks"), F.round(F.avg("n"), 6).alias("avg_chunks"), F.max("n").alias("max_chunks"), F.round(F.sum("chars") / F.sum("n"), 6).alias("avg_chars"))


def extraction_requests(chunked: DataFrame, stages: DataFrame, model: str) -> DataFrame:
    """Each chunk for each stage (a literal table: stage, system_prompt, user_prompt, prompt_version)."""
    df = chunked.crossJoin(F.broadcast(stages))
    return df.select(
        tx.key_hash("doc_id", "chunk_id", "stage", "prompt_version", F.lit(model)).alias("request_id"),
        "doc_id", "chunk_id", "stage", "system_prompt", tx.fill(F.col("user_prompt"), text="chunk_text").alias("user_prompt"), "prompt_version", F.lit(model).alias("model_name"),
    )


def cardinality(requests: DataFrame) -> DataFrame:
    """Per stage: rows and distinct ids, which must be equal, and equal for all stages."""
    return requests.groupBy("stage").agg(F.count("*").alias("rows"), F.countDistinct("request_id").alias("ids"))


def even_partitions(requests: DataFrame, workers: int, rows_each: int = 50, key: str = "request_id") -> DataFrame:
    """For calls to a model: partitions by key, sorted; at most `workers`, and only so many that each has about rows_each rows or more."""
    parts = max(1, min(workers, -(-requests.count() // max(1, rows_each))))
    return requests.repartition(parts, key).sortWithinPartitions(key)


def reject_reason(text: Column, kind_ok: Column, least: int = 1) -> Column:
    """Why a raw record is refused; null if it isn't."""
    return F.when(text.isNull(), "missing_text").when(~kind_ok, "invalid_type").when(F.trim(text) == "", "empty_text").when(F.length(F.trim(text)) < least, "too_short")


def derive_doc_id(*candidates: Column, content: Column) -> Column:
    """The first non-blank candidate, else the hash of the content."""
    blank_to_null = [F.when(tx.non_empty(c), c) for c in candidates]
    return F.coalesce(*blank_to_null, F.sha2(content, 256))


def first_rows(df: DataFrame, keys: list[str], n: int) -> DataFrame:
    return df.orderBy(*keys).limit(n)


def next_chunks(chunked: DataFrame, doc: str, order: list[str], chunk: str) -> DataFrame:
    """Ordered neighbours within a document: doc, chunk, next_chunk."""
    w = Window.partitionBy(doc).orderBy(*order)
    return chunked.select(doc, chunk, F.lead(chunk).over(w).alias("next_chunk")).where("next_chunk is not null")


def source_id(record: Column | str, id_field: str = "id") -> Column:
    """The id that a raw record (JSON text) brings: the given field, `_id.$oid`, `_id`, id, url; the first that isn't empty."""
    record = F.col(record) if isinstance(record, str) else record
    oid = F.get_json_object(record, "$._id['$oid']")
    found = [jsons.normal_scalar(record, id_field), oid, *(jsons.normal_scalar(record, p) for p in ("_id", "id", "url"))]
    return F.coalesce(*(F.when(F.length(c) > 0, c) for c in found))


def source_name(record: Column | str, path: Column | str) -> Column:
    """Where a record is from: its domain, the host (and port) of its url, or the stem of its file."""
    record = F.col(record) if isinstance(record, str) else record
    host = F.regexp_extract(F.get_json_object(record, "$.url"), "^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]+)", 1)
    stem = F.regexp_extract(F.col(path) if isinstance(path, str) else path, r"([^/]*?)(\.[^./]*)?$", 1)
    return F.coalesce(*(F.when(F.length(c) > 0, c) for c in (F.get_json_object(record, "$.domain"), host, stem)))


def text_lengths(df: DataFrame, *columns: str) -> DataFrame:
    """One row: avg_<column>_length (6 digits) and max_<column>_length, in one pass."""
    parts = [f for c in columns for f in (F.round(F.avg(F.length(c)), 6).alias(f"avg_{c}_length"), F.max(F.length(c)).alias(f"max_{c}_length"))]
    return df.agg(*parts)


def of_types(df: DataFrame, types: list[str], column: str = "node_type") -> DataFrame:
    """Only rows of the given types."""
    return df.where(F.col(column).isin(types))


def tagged(df: DataFrame, run_id: str, version: str, now: datetime | None = None) -> DataFrame:
    """With run_id, schema_version and created_at of a run; `now` fixes the clock (default: the time of the query)."""
    at = F.current_timestamp() if now is None else F.lit(now)
    return df.withColumns({"run_id": F.lit(run_id), "schema_version": F.lit(version), "created_at": at})


def run_id_of(now: datetime, prefix: str = "run") -> str:
    """A run's id by the clock, in UTC."""
    return f"{prefix}_{now.astimezone(timezone.utc):%Y%m%dT%H%M%SZ}"
