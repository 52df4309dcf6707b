"""What a serving graph is loaded with: documents, chunks, entities, relations and the links between them.

Inputs are tables of the stores that an extraction run leaves: records by id, vectors by id, graph
nodes and edges, and lists of chunk ids. Each function gives the rows of one kind of node or link;
load() merges them into versioned tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.operators.documents import next_chunks
from loomgraph.plans.runner import expect, expect_dimension, expect_unique
from loomgraph.sources.catalog import Lake, merge_rows

SEP = "<SEP>"
#: Keys of the loaded tables.
KEYS = {
    "documents": ["id"], "chunks": ["id"], "entities": ["id"], "document_chunks": ["doc_id", "chunk_id"],
    "next_chunks": ["left_id", "right_id"], "mentions": ["entity_id", "chunk_id"], "relations": ["pair_id"],
}


def _filled(*columns: Column | str) -> Column:
    """The first that is neither null nor empty."""
    return F.coalesce(*(F.when(F.length(c) > 0, c) for c in (F.col(c) if isinstance(c, str) else c for c in columns)))


def document_rows(docs: DataFrame, statuses: DataFrame) -> DataFrame:
    """docs: id, content, file_path; statuses: id, status, file_path, chunks_count, content_length."""
    known = statuses.select("id", "status", F.col("file_path").alias("_path"), "chunks_count", "content_length")
    return docs.join(known, "id", "left").select("id", "content", _filled("file_path", "_path").alias("file_path"), "status", "chunks_count", "content_length")


def chunk_rows(chunks: DataFrame, vectors: DataFrame) -> DataFrame:
    """chunks with the vector of their id (vectors: id, embedding); an empty vector counts as none."""
    return chunks.join(vectors.select("id", F.when(F.size("embedding") > 0, F.col("embedding")).alias("embedding")), "id", "left")


def document_chunk_rows(statuses: DataFrame) -> DataFrame:
    """statuses: id, chunks_list."""
    return statuses.select(F.col("id").alias("doc_id"), F.explode("chunks_list").alias("chunk_id")).distinct()


def next_chunk_rows(chunks: DataFrame) -> DataFrame:
    """left_id, right_id: neighbours in the order of chunk_order_index (null as 0), then id, of each full_doc_id."""
    ordered = chunks.where(F.length("full_doc_id") > 0).withColumn("_at", F.coalesce("chunk_order_index", F.lit(0)))
    return next_chunks(ordered, "full_doc_id", ["_at", "id"], "id").select(F.col("id").alias("left_id"), F.col("next_chunk").alias("right_id"))


def entity_rows(nodes: DataFrame, records: DataFrame) -> DataFrame:
    """All names of graph nodes and of vector records; what the node lacks is taken from the record.

    nodes: id, entity_type, description, source_ids, file_paths; records: id, content, source_id,
    file_path (lists joined by <SEP>), embedding.
    """
    both = nodes.join(records, "id", "full_outer")
    listed = lambda own, joined: F.when(F.size(own) > 0, F.col(own)).otherwise(F.coalesce(tx.split_list(F.col(joined)), F.array().cast("array<string>")))
    sources = listed("source_ids", "source_id")
    return both.select(
        "id", F.lower("id").alias("name_lc"), tx.ascii_fold("id").alias("name_ascii"), "entity_type", _filled("description", "content").alias("description"),
        sources.alias("source_ids"), F.size(sources).alias("source_count"), listed("file_paths", "file_path").alias("file_paths"), F.when(F.size("embedding") > 0, F.col("embedding")).alias("embedding"),
    )


def mention_rows(entity_chunks: DataFrame) -> DataFrame:
    """entity_chunks: id, chunk_ids."""
    return entity_chunks.select(F.col("id").alias("entity_id"), F.explode("chunk_ids").alias("chunk_id")).distinct()


def relation_rows(edges: DataFrame, relation_chunks: DataFrame) -> DataFrame:
    """edges (src, dst, ...) with the chunks of their pair, or else of the pair the other way round.

    relation_chunks: id (the two names joined by <SEP>), chunk_ids. Adds pair_id, chunk_ids, chunk_count.
    """
    pair, reverse = F.concat_ws(SEP, "src", "dst"), F.concat_ws(SEP, "dst", "src")
    own = relation_chunks.select(F.col("id").alias("pair_id"), F.col("chunk_ids").alias("_own"), F.lit(True).alias("_has"))
    other = relation_chunks.select(F.col("id").alias("_reverse"), F.col("chunk_ids").alias("_other"))
    df = edges.withColumn("pair_id", pair).withColumn("_reverse", reverse).join(own, "pair_id", "left").join(other, "_reverse", "left")
    ids = F.coalesce(F.when(F.col("_has"), F.col("_own")).otherwise(F.col("_other")), F.array().cast("array<string>"))
    return df.withColumn("chunk_ids", ids).withColumn("chunk_count", F.size("chunk_ids")).drop("_own", "_has", "_other", "_reverse")


def load_summary(tables: dict[str, DataFrame], statuses: DataFrame, dimensions: dict[str, int] | None = None) -> DataFrame:
    """metric, key, value: rows of each table, documents of each status (null: unknown), sizes of vectors."""
    out = statuses.groupBy(F.coalesce("status", F.lit("unknown")).alias("key")).agg(F.count("*").alias("value")).select(F.lit("doc_status").alias("metric"), "key", "value")
    for name, df in tables.items():
        out = out.union(df.agg(F.count("*").alias("value")).select(F.lit("rows"), F.lit(name), "value"))
    for name, size in (dimensions or {}).items():
        out = out.union(tables[name].limit(1).select(F.lit("dimension"), F.lit(name), F.lit(size).cast("bigint"))) if name in tables else out
    return out


def load(lake: Lake, run_id: str, tables: dict[str, DataFrame], reset: bool = False) -> dict[str, int]:
    """Merges rows into the newest version of each table and writes the version run_id; the row counts.

    Rows replace those of equal keys; with reset the old versions count for nothing. Keys must be unique in
    what is given, and run_id must be new.
    """
    counts = {}
    for name, rows in tables.items():
        expect(name in KEYS, f"no table {name}")
        counts[name] = _merged(lake, run_id, name, rows, KEYS[name], reset)
    return counts


def load_vectors(lake: Lake, run_id: str, vectors: DataFrame, size: int, reset: bool = False) -> int:
    """The bulk load of a vector index (id, embedding): all vectors must have `size` components."""
    expect_dimension(vectors, "embedding", size)
    return _merged(lake, run_id, "vectors", vectors, ["id"], reset)


def _merged(lake: Lake, run_id: str, name: str, rows: DataFrame, keys: list[str], reset: bool) -> int:
    expect_unique(rows, keys)
    expect(run_id not in lake.versions(name), f"{name} has a version {run_id}")
    old = None if reset or not lake.versions(name) else lake.read(name)
    return lake.write(rows if old is None else merge_rows(old, rows, keys), name, run_id).count()


def fan_out(stores: dict[str, Callable[[], object]]) -> dict[str, tuple[str, object]]:
    """Runs the loader of each store; a failing one doesn't stop the others: name to (LOADED, result) or (FAILED, message)."""
    out: dict[str, tuple[str, object]] = {}
    for name, loader in stores.items():
        try:
            out[name] = ("LOADED", loader())
        except Exception as error:  # noqa: BLE001
            out[name] = ("FAILED", str(error))
    return out
