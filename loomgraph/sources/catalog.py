"""Versioned lake tables, readers and sinks.

A table is a folder of Parquet folders run_id=<id>; the newest version is the greatest id.
Everything goes through Spark's readers and Hadoop's file systems.
"""

from __future__ import annotations

import json
import os
import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

DOCUMENT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("doc_id", "source_id", "content", "url", "title", "lang", "source_name", "ingest_date", "source_file")] + [T.StructField("metadata", T.MapType(T.StringType(), T.StringType()))]
)
RESPONSE = T.StructType(
    [T.StructField("request_id", T.StringType()), T.StructField("doc_id", T.StringType()), T.StructField("chunk_id", T.IntegerType())]
    + [T.StructField(n, T.StringType()) for n in ("stage", "prompt_version", "model_name", "response_text", "usage_json", "status", "error_message")]
    + [T.StructField("created_ts", T.TimestampType()), T.StructField("run_id", T.StringType())]
)


class Lake:
    """Tables below a root folder."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, table: str, run_id: str | None = None) -> str:
        base = f"{self.root}/{table.replace('.', '/')}"
        return f"{base}/run_id={run_id}" if run_id else base

    def versions(self, table: str) -> list[str]:
        """All run ids in order; none if the table doesn't exist."""
        jvm = self.spark._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path(table))
        files = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(path):
            return []
        names = [s.getPath().getName() for s in files.listStatus(path) if s.isDirectory()]
        return sorted(n.removeprefix("run_id=") for n in names if n.startswith("run_id="))

    def latest(self, table: str, default: str | None = None) -> str | None:
        return max(self.versions(table), default=default)

    def read(self, table: str, run_id: str | None = None) -> DataFrame:
        """One version: the given one, else the newest."""
        run_id = run_id or self.latest(table)
        if run_id is None:
            raise FileNotFoundError(f"{table} has no version below {self.root}")
        return self.spark.read.parquet(self.path(table, run_id))

    def read_runs(self, table: str, run_ids: list[str] | None = None) -> DataFrame:
        """Several versions (default: all), with run_id as a column; others are pruned."""
        df = self.spark.read.option("mergeSchema", "true").parquet(self.path(table))
        df = df.withColumn("run_id", F.col("run_id").cast("string"))
        return df if run_ids is None else df.where(F.col("run_id").isin(run_ids))

    def write(self, df: DataFrame, table: str, run_id: str) -> DataFrame:
        """Replaces this version; gives the rows as written."""
        df.drop("run_id").write.mode("overwrite").parquet(self.path(table, run_id))
        return self.read(table, run_id)

    def append_new(self, df: DataFrame, table: str, run_id: str, keys: list[str]) -> DataFrame:
        """Writes those rows whose keys no earlier version has, once for each key."""
        rows = df.dropDuplicates(keys)
        if self.versions(table):
            rows = rows.join(self.read_runs(table).select(*keys).distinct(), keys, "left_anti")
        return self.write(rows, table, run_id)


def write_rejects(lake: Lake, rejected: DataFrame, table: str, run_id: str) -> int:
    """Refused rows below logs/<table>, one version a run; how many they are."""
    return lake.write(rejected, f"logs/{table}", run_id).count()


def latest_version(versions: DataFrame, table: str = "table", run_id: str = "run_id") -> DataFrame:
    """The relational form: the greatest run_id of each table."""
    return versions.groupBy(table).agg(F.max(run_id).alias("latest"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Normalised JSON lines."""
    return spark.read.schema(DOCUMENT).json(path)


def read_records(spark: SparkSession, path: str, fmt: str = "jsonl") -> DataFrame:
    """A JSON array (`json`) or JSON lines (`jsonl`)."""
    return spark.read.option("multiLine", fmt == "json").json(path)


def read_feeds(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("multiLine", True).json(paths)


def read_triples_csv(spark: SparkSession, path: str) -> DataFrame:
    """head, relation, tail, stage, source as text; quotes inside quotes are doubled; rows without an end are dropped."""
    df = spark.read.option("header", True).option("escape", '"').option("multiLine", True).csv(path)
    return df.dropna(subset=["head", "relation", "tail"])


def read_triples_json(spark: SparkSession, path: str) -> DataFrame:
    """Nested records with metadata.source, flattened."""
    schema = "head string, relation string, tail string, stage string, metadata struct<source: string>"
    df = spark.read.schema(schema).json(path)
    return df.select("head", "relation", "tail", "stage", F.col("metadata.source").alias("source")).dropna(subset=["head", "relation", "tail"])


def triples_from_lines(lines: DataFrame, fields: tuple[str, ...] = ("head", "relation", "tail", "stage", "source"), least: int = 4) -> DataFrame:
    """Records from the lines (n, value) of pretty-printed JSON: a head line starts one; the first value of a field counts; records with `least` fields or more stay."""
    found = lines.select("n", *(F.nullif(F.regexp_extract("value", f'^\\s*"{f}"\\s*:\\s*"((?:[^"\\\\]|\\\\.)*)"', 1), F.lit("")).alias(f) for f in fields)).where(F.coalesce(*fields).isNotNull())
    # Files are read by n ranges; one file's records are contiguous, so the running count is per file in practice.
    numbered = found.withColumn("record", F.count_if(F.col(fields[0]).isNotNull()).over(Window.orderBy("n")))
    first = [F.min_by(f, F.when(F.col(f).isNotNull(), F.col("n"))).alias(f) for f in fields]
    seen = sum((F.col(f).isNotNull().cast("int") for f in fields), F.lit(0))
    return numbered.groupBy("record").agg(*first).where(seen >= least).select(*fields)


def read_graphml(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) with their data keys as a map."""
    data = "data array<struct<_key: string, _VALUE: string>>"
    as_map = F.map_from_entries(F.transform("data", lambda d: F.struct(d["_key"], d["_VALUE"]))).alias("props")
    nodes = spark.read.format("xml").option("rowTag", "node").schema(f"_id string, {data}").load(path).select(F.col("_id").alias("id"), as_map)
    edges = spark.read.format("xml").option("rowTag", "edge").schema(f"_source string, _target string, {data}").load(path).select(F.col("_source").alias("src"), F.col("_target").alias("dst"), as_map)
    return nodes, edges


def read_kv(spark: SparkSession, path: str, value_schema: str) -> DataFrame:
    """A JSON object of id -> record, one row each: id and the record's columns."""
    text = spark.read.option("wholetext", True).text(path)
    rows = text.select(F.explode(F.from_json("value", f"map<string, struct<{value_schema}>>")).alias("id", "v"))
    return rows.select("id", "v.*")


def read_objects(spark: SparkSession, keys: DataFrame, root: str, schema: str) -> DataFrame:
    """Stored JSON objects by key (column object_key): key, the parsed object, found, error (`missing` or `invalid_json`; null if neither).

    Files are listed and matched with the keys by their paths; only those wanted are read and parsed.
    """
    folder = re.sub(r"^[A-Za-z0-9]+:/*", "", root).strip("/")
    at = F.regexp_replace("path", "^.*?" + re.escape(folder) + "/", "")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    wanted = keys.select("object_key").distinct()
    stored = files.select(at.alias("object_key"), "path", "content").join(wanted, "object_key", "left_semi")
    read = stored.select("object_key", F.from_json(F.col("content").cast("string"), schema, {"mode": "PERMISSIVE"}).alias("object"), F.try_parse_json(F.col("content").cast("string")).isNotNull().alias("sound"))
    found = F.col("sound").isNotNull()
    error = F.when(~found, "missing").when(~F.col("sound"), "invalid_json")
    return wanted.join(read, "object_key", "left").select("object_key", F.when(F.col("sound"), F.col("object")).alias("object"), found.alias("found"), error.alias("error"))


def write_report(metrics: DataFrame, path: str) -> None:
    """A small report as one JSON file."""
    metrics.coalesce(1).write.mode("overwrite").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file with a header, for small results."""
    df.coalesce(1).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def render_markdown(title: str, metrics: DataFrame, most: int = 1000) -> str:
    """A report of (metric, key, value) rows; at most `most` rows, and a line that says so if there are more."""
    lines, last = [f"# {title}", ""], None
    rows = metrics.orderBy("metric", "key").limit(most + 1).collect()
    for r in rows[:most]:
        if r.metric != last:
            lines += ["", f"## {r.metric}", "", "| key | value |", "| --- | --- |"]
            last = r.metric
        lines.append(f"| {r.key} | {r.value} |")
    if len(rows) > most:
        lines += ["", f"Only the first {most} rows are shown."]
    return "\n".join(lines) + "\n"


def merge_rows(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Keyed upsert: new rows replace old ones with the same keys."""
    return old.join(new.select(*keys).distinct(), keys, "left_anti").unionByName(new, allowMissingColumns=True)


def env_file(path: str, environ: dict[str, str] | None = None) -> dict[str, str]:
    """KEY=value lines (comments, quotes and export allowed); non-empty variables of the environment win."""
    out: dict[str, str] = {}
    if os.path.exists(path):
        for line in Path(path).read_text().splitlines():
            key, sep, value = line.strip().removeprefix("export ").partition("=")
            if sep and not key.startswith("#"):
                out[key.strip()] = value.strip().strip("\"'")
    return out | {k: v for k, v in (environ if environ is not None else os.environ).items() if v}


def canonical_json(value) -> str:
    return json.dumps(value, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
