"""Evaluation of answers as DataFrame operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.functions.vectors import clamp


def token_f1(pairs: DataFrame, keys: list[str], a: str, b: str) -> DataFrame:
    """keys and f1: the harmonic mean of precision and recall over the tokens with their numbers. Two empty texts: 1; one: 0."""

    def counts(col: str, name: str) -> DataFrame:
        return pairs.select(*keys, F.explode(tx.answer_tokens(col)).alias("t")).groupBy(*keys, "t").agg(F.count("*").alias(name))

    common = counts(a, "x").join(counts(b, "y"), [*keys, "t"]).groupBy(*keys).agg(F.sum(F.least("x", "y")).alias("c"))
    sizes = pairs.select(*keys, F.size(tx.answer_tokens(a)).alias("na"), F.size(tx.answer_tokens(b)).alias("nb"))
    n = F.col("na") + F.col("nb")
    f1 = F.when(n == 0, 1.0).otherwise(2.0 * F.coalesce("c", F.lit(0)) / n)
    return sizes.join(common, keys, "left").select(*keys, F.round(f1, 6).alias("f1"))


def exact_match(a: str, b: str) -> F.Column:
    return tx.answer_form(a) == tx.answer_form(b)


def reference_chunk_f1(references: DataFrame, chunks: DataFrame, key: str, reference: str, chunk_id: str, chunk: str) -> DataFrame:
    """The best token F1 of an item's reference with any of its chunks."""
    pairs = references.select(key, reference).join(chunks.select(key, chunk_id, chunk), key)
    return token_f1(pairs, [key, chunk_id], reference, chunk).groupBy(key).agg(F.max("f1").alias("reference_chunk_f1"))


def summary(results: DataFrame, metrics: list[str], error: str = "error") -> DataFrame:
    """Rows, completed rows, and the means of the metrics over rows without error (nulls left out)."""
    ok = F.col(error).isNull()
    return results.agg(F.count("*").alias("items"), F.count_if(ok).alias("completed"), *(F.round(F.avg(F.when(ok, F.col(m))), 6).alias(f"avg_{m}") for m in metrics))


def ranked_cases(results: DataFrame, metric: str, key: str) -> DataFrame:
    """Best cases first; a null counts as 0."""
    return results.withColumn(metric, F.coalesce(metric, F.lit(0.0))).orderBy(F.desc(metric), key)


def judge_scores(replies: DataFrame, text: str, fields: list[str], low: float = 0.0, high: float = 5.0) -> DataFrame:
    """A judge's JSON reply (also inside prose) as numbers within the bounds."""
    j = F.regexp_extract(F.col(text), r"(?s)(\{.*\})", 1)
    return replies.withColumns({f: clamp(F.get_json_object(F.when(F.try_parse_json(j).isNotNull(), j), f"$.{f}"), low, high) for f in fields})


def select_items(items: DataFrame, domain: str | None = None, question_type: str | None = None, topic: str | None = None, offset: int = 0, limit: int | None = None) -> DataFrame:
    """A QA set filtered by its fields, in the order of id."""
    for col, value in (("domain", domain), ("question_type", question_type)):
        items = items if value is None else items.where(F.col(col) == value)
    items = items if topic is None else items.where(F.array_contains("topic", topic))
    items = items.orderBy("id").offset(offset)
    return items if limit is None else items.limit(limit)


def answer_context_f1(answers: DataFrame, chunks: DataFrame, key: list[str], order: str, answer: str = "answer", chunk: str = "chunk") -> DataFrame:
    """The token F1 of each answer with its chunks joined by newlines in their order (no chunks: the empty text)."""
    joined = chunks.groupBy(*key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(order, F.coalesce(chunk, F.lit("")).alias("c")))), lambda x: x["c"]), "\n").alias("_context"))
    pairs = answers.join(joined, key, "left").withColumn("_context", F.coalesce("_context", F.lit("")))
    return token_f1(pairs, key, answer, "_context").withColumnRenamed("f1", "answer_context_f1")


def summary_from_file(spark, path: str, metrics: list[str], key: str = "id", by: str | None = None) -> tuple[DataFrame, DataFrame]:
    """The summary of a results file of JSON lines, and its cases ranked by a metric (default: the first)."""
    results = spark.read.json(path)
    absent = [c for c in (*metrics, "error", key) if c not in results.columns]
    results = results.withColumns({c: F.lit(None).cast("string" if c in ("error", key) else "double") for c in absent})
    return summary(results, metrics), ranked_cases(results, by or metrics[0], key)
