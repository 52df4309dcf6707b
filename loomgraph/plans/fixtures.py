"""Graph, response and concept inputs derived from the tables, as Spark frames and as SQL.

The expressions are read alike by Spark and DuckDB. Every fixture uses all rows of its tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_TRIPLES = [
    "concat('c', CAST(o_custkey AS STRING)) AS src",
    "concat('p', CAST(l_partkey AS STRING)) AS dst",
    "concat('rel_', l_returnflag, l_linestatus) AS relation",
    "CASE WHEN l_linenumber % 3 = 0 THEN 'entity_relation' WHEN l_linenumber % 3 = 1 THEN 'event_entity' ELSE 'event_relation' END AS stage",
    "CAST(o_orderkey AS STRING) AS source_doc_id",
    "CAST(l_linenumber AS INT) AS source_chunk_id",
]


def triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers to parts, one edge for each distinct order line."""
    joined = table(spark, sf_dir, "orders").join(table(spark, sf_dir, "lineitem"), on=[_eq("o_orderkey", "l_orderkey")])
    # Rows that are equal as numbers are equal as text, and narrower. ~ keeps their distinct out of the tasks that sort for the join.
    narrow = ["o_custkey", "~o_orderkey AS o_orderkey", "l_partkey", "concat(l_returnflag, l_linestatus) AS flags", "l_linenumber"]
    return joined.selectExpr(*narrow).distinct().withColumn("o_orderkey", F.bitwise_not("o_orderkey")).selectExpr(*(c.replace("l_returnflag, l_linestatus", "flags") for c in _TRIPLES))


def _eq(a: str, b: str):
    return F.col(a) == F.col(b)


TRIPLES = f"SELECT DISTINCT {', '.join(_TRIPLES)} FROM orders JOIN lineitem ON o_orderkey = l_orderkey"

_NEXT = "lead(user_id) OVER (PARTITION BY CAST(ts AS DATE), event_type ORDER BY ts, event_id) AS nxt"


def transitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A user to the next one with an event of the same type on the same day: src, dst, relation, event_id."""
    df = table(spark, sf_dir, "events").selectExpr("user_id", "event_id", "event_type", _NEXT).where("nxt is not null")
    return df.selectExpr("concat('u', CAST(user_id AS STRING)) AS src", "concat('u', CAST(nxt AS STRING)) AS dst", "event_type AS relation", "event_id")


TRANSITIONS = f"SELECT concat('u', CAST(user_id AS STRING)) AS src, concat('u', CAST(nxt AS STRING)) AS dst, event_type AS relation, event_id FROM (SELECT user_id, event_id, event_type, {_NEXT} FROM events) WHERE nxt IS NOT NULL"

_STAGE = "CASE l_linenumber % 3 WHEN 0 THEN 'event_entity' WHEN 1 THEN 'entity_relation' ELSE 'event_relation' END"
#: Items as text: a triple, or an event with its entities (the flag twice).
_ITEM = """CASE WHEN l_linenumber % 3 = 0 THEN concat('{"Event":" p', CAST(l_partkey AS STRING), '  sold ","Entity":["', l_returnflag, '","s', CAST(l_suppkey AS STRING), '"," ', l_returnflag, ' "]}')
 ELSE concat('{"Head":"p', CAST(l_partkey AS STRING), '","Relation":" has  flag ","Tail":"', l_returnflag, '"}') END"""
_BAD_ITEM = """CASE WHEN l_linenumber % 3 = 0 THEN concat('{"Event":"p', CAST(l_partkey AS STRING), '","Entity":[]}')
 ELSE concat('{"Head":"p', CAST(l_partkey AS STRING), '","Relation":" ","Tail":"', l_returnflag, '"}') END"""
_TEXT = f"""CASE WHEN l_orderkey % 11 = 0 OR l_orderkey % 13 = 0 THEN NULL
 WHEN l_orderkey % 7 = 0 THEN 'not json'
 WHEN l_orderkey % 5 = 0 THEN concat('```json', chr(10), '[', {_ITEM}, ',]', chr(10), '```')
 WHEN l_orderkey % 17 = 0 THEN concat('[', {_BAD_ITEM}, ']')
 WHEN l_orderkey % 19 = 0 THEN concat('{{"', {_STAGE}, '": [', {_ITEM}, ']}}')
 WHEN l_orderkey % 23 = 0 THEN concat('Here it is: [', {_ITEM}, '] as asked.')
 ELSE concat('[', {_ITEM}, ']') END"""
_RESPONSES = [
    "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber AS STRING), '-', CAST(l_partkey AS STRING), '-', l_returnflag, '-', CAST(l_suppkey AS STRING)) AS request_id",
    "CAST(l_orderkey AS STRING) AS doc_id",
    "CAST(floor((l_linenumber - 1) / 3) AS INT) AS chunk_id",
    f"{_STAGE} AS stage",
    "CASE WHEN l_orderkey % 11 = 0 THEN 'TIMEOUT' WHEN l_orderkey % 13 = 0 THEN 'FAILED' ELSE 'SUCCESS' END AS status",
    f"{_TEXT} AS response_text",
    "concat('{\"prompt_tokens\":', CAST(l_partkey % 100 AS STRING), ',\"completion_tokens\":7,\"total_tokens\":', CAST(l_partkey % 100 + 7 AS STRING), '}') AS usage_json",
]


def responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One model response for each order line; the outcome follows from the keys."""
    return table(spark, sf_dir, "lineitem").selectExpr(*_RESPONSES, "l_partkey", "l_returnflag", "l_orderkey", "l_suppkey")


RESPONSES = f"SELECT {', '.join(_RESPONSES)}, l_partkey, l_returnflag, l_orderkey, l_suppkey FROM lineitem"
#: The outcome of a response by its keys.
OUTCOME = """CASE WHEN status <> 'SUCCESS' THEN concat('SOURCE_', status) WHEN l_orderkey % 7 = 0 THEN 'INVALID'
 WHEN l_orderkey % 5 = 0 THEN 'VALID' WHEN l_orderkey % 17 = 0 THEN 'INVALID' ELSE 'VALID' END"""

_NAMES = [
    "concat(p_name, ' ', CAST(p_partkey AS STRING)) AS name",
    "CASE WHEN p_partkey % 3 = 0 THEN 'event' ELSE 'entity' END AS node_type",
    "p_partkey", "p_brand", "p_type", "p_size",
]


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One name for each part."""
    return table(spark, sf_dir, "part").selectExpr(*_NAMES)


NAMES = f"SELECT {', '.join(_NAMES)} FROM part"
