"""Exact top-k search by the three-phase uniform threshold method.

A vector's dimensions are dealt into m groups; the inner product of query and vector is the
sum of m local scores, one for each group. Each group's parts are rows of their own, and a task sees
the parts of one group only. Phase 1 gathers, for each query, the best entries of each local
list; their full scores give a safe cutoff t: the k-th best score of all is t or more.
Phase 2 sends t to all tasks; as m local scores that sum to t or more have one of t / m or more,
the entries with a local score of t / m or more suffice, and only their ids come back. Phase 3
resolves the full scores of these survivors exactly and keeps the k best, ties to the smaller vec_id.
The fewer groups, the fewer survivors: two by default.

Components become floor(scale * x), computed as double. Vectors that are null or hold a null
or a component that isn't finite take no part, nor do rows without an id; empty tables give no rows.
Of vectors of different lengths the shorter one counts as padded with zeros. Rows of one vec_id are
candidates each; a query id asks once, with the least of its vectors, and never finds rows of its own
id. Scores beyond the long range are clamped to it; vectors may be of any length, and those of a block are held together. Other columns, whatever their names, are not read.

Skew: equal vectors are one entry with the ids that any query can find among them (the k + 1 least,
each at most k times), however many rows hold them. Entries and queries are dealt into blocks of bounded
size by a hash; a task compares one block of each.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.session import cut, prepare

_EXACT = float(1 << 52)
LEAST, MOST = -(1 << 63), (1 << 63) - 1
#: Bytes of all queries' vectors up to which they are broadcast.
BROADCAST = 32 << 20


def _product(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows: in doubles where they hold, else in Python's integers."""
    if not len(q) or not len(v) or not q.shape[1] or float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < _EXACT:
        return q @ v.T
    whole = np.vectorize(int, otypes=[object])
    return whole(q).dot(whole(v).T)


def _row_products(q: np.ndarray, v: np.ndarray) -> list[int]:
    """Exact inner products of the rows of q with those of v, clamped to the long range."""
    if not q.size or float(np.abs(q).max()) * float(np.abs(v).max()) * q.shape[1] < _EXACT:
        return np.einsum("ij,ij->i", q, v).astype(np.int64).tolist()
    return [min(max(sum(int(a) * int(b) for a, b in zip(x, y, strict=True)), LEAST), MOST) for x, y in zip(q, v, strict=True)]


def _matrix(rows, width: int, scale: float) -> np.ndarray:
    """floor(scale * x) of each row as doubles, padded with zeros."""
    out = np.zeros((len(rows), width))
    for k, x in enumerate(rows):
        out[k, : len(x)] = x
    return np.floor(out * scale)


def _arrow_matrix(column: pa.Array, width: int, scale: float) -> np.ndarray:
    """The same of a list column."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == width).all():
        return np.floor(column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width) * scale)
    return _matrix(column.to_pylist(), width, scale)


def survivors(vectors: DataFrame, queries: DataFrame, cutoffs: DataFrame | None, k: int, groups: int, width: int, scale: float, query_block: int, vector_block: int) -> DataFrame:
    """query_id, rid: of phase 1 (without cutoffs) the best k + 1 entries of each group's list, else those with t / m or more."""
    m, first = max(1, min(groups, width)), cutoffs is None
    each = -(-width // m)
    n_v, n_q = max(1, -(-vectors.count() // vector_block)), max(1, -(-queries.count() // query_block))
    parts = F.explode(F.transform(F.sequence(F.lit(0), F.lit(m - 1)), lambda g: F.struct(g.alias("g"), F.slice("x", g * each + 1, F.lit(each)).alias("part"))))
    blocks = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    asking = queries if first else queries.join(cutoffs, "query_id", "left")
    cutoff = F.lit(None).cast("bigint") if first else F.col("cutoff")
    asking = asking.select("query_id", cutoff.alias("cutoff"), F.pmod(F.xxhash64("query_id"), F.lit(n_q)).cast("int").alias("qb"), parts.alias("p")).select("query_id", "cutoff", "qb", "p.g", "p.part", blocks(n_v).alias("vb"))
    held = vectors.select("rid", F.pmod(F.xxhash64("rid"), F.lit(n_v)).cast("int").alias("vb"), parts.alias("p")).select("rid", "vb", "p.g", "p.part", blocks(n_q).alias("qb"))

    def run(key, asks: pd.DataFrame, entries: pd.DataFrame) -> pd.DataFrame:
        asked, who, local = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
        vs, ids = _matrix(entries.part, each, scale), entries.rid.to_numpy()
        for at in range(0, len(asks) if len(entries) else 0, 128):
            part = asks.iloc[at : at + 128]
            for query, t, row in zip(part.query_id, part.cutoff, _product(_matrix(part.part, each, scale), vs), strict=True):
                if first:
                    best = np.argpartition(-row, min(k, len(ids) - 1))[: k + 1] if row.dtype != object else np.array(sorted(range(len(ids)), key=lambda i, r=row: -r[i])[: k + 1])
                elif pd.isna(t):
                    best = np.arange(len(ids))
                else:  # a little below: t may have been rounded on its way here
                    best = np.flatnonzero(row >= int(t) // m - 1 - abs(int(t)) // (1 << 50))
                asked.append(np.full(len(best), query, np.int64))
                who.append(ids[best])
                local.append(row[best].astype(float))
        return pd.DataFrame({"query_id": np.concatenate(asked), "g": key[0], "rid": np.concatenate(who).astype(np.int64), "local": np.concatenate(local)})

    found = asking.groupBy("g", "qb", "vb").cogroup(held.groupBy("g", "qb", "vb")).applyInPandas(run, "query_id bigint, g int, rid bigint, local double")
    if first:
        by_local = Window.partitionBy("query_id", "g").orderBy(F.desc("local"), "rid")
        found = found.withColumn("r", F.row_number().over(by_local)).where(F.col("r") <= k + 1)
    return found.select("query_id", "rid").distinct()


def resolved(pairs: DataFrame, vectors: DataFrame, queries: DataFrame, width: int, scale: float) -> DataFrame:
    """query_id, vec_id, score of the rows of the entries of pairs.

    Queries of up to BROADCAST bytes together are broadcast; more are joined by their ids.
    """
    asked = queries.withColumnRenamed("x", "q")
    asked = F.broadcast(asked) if queries.count() * width * 8 <= BROADCAST else asked
    both = pairs.join(vectors.withColumnRenamed("x", "v"), "rid").join(asked, "query_id").select("query_id", "q", "v", "ids")

    def run(batches):
        for batch in batches:
            scores = _row_products(_arrow_matrix(batch.column(1), width, scale), _arrow_matrix(batch.column(2), width, scale))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(3), pa.array(scores, pa.int64())], ["query_id", "ids", "score"])

    scored = both.mapInArrow(run, "query_id bigint, ids array<bigint>, score bigint")
    return scored.select("query_id", F.explode("ids").alias("vec_id"), "score").where("vec_id <> query_id")


def _usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    return df.select(F.col(id_col).cast("bigint").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & ~F.exists("x", lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    )


def entries_of(vectors: DataFrame, k: int) -> DataFrame:
    """rid, x, ids: one row for each distinct vector of (vec_id, x)."""
    same, among = Window.partitionBy("x", "vec_id").orderBy("vec_id"), Window.partitionBy("x").orderBy("vec_id")
    few = vectors.withColumn("r", F.row_number().over(same)).where(F.col("r") <= k).withColumn("r", F.dense_rank().over(among)).where(F.col("r") <= k + 1)
    return few.groupBy("x").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).select(F.monotonically_increasing_id().alias("rid"), "x", "ids")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, scale: float = 256.0, groups: int = 2, query_block: int = 4096, vector_block: int = 16384, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of each query (all, if fewer)."""
    prepare(vectors.sparkSession)
    v = cut(entries_of(_usable(vectors, id_col, vector_col), k))
    q = cut(_usable(queries, id_col, vector_col).groupBy("vec_id").agg(F.min("x").alias("x")).withColumnRenamed("vec_id", "query_id"))
    width = max(1, *(df.agg(F.max(F.size("x"))).first()[0] or 0 for df in (v, q)))
    shape = (k, groups, width, scale, query_block, vector_block)
    # Phase 1.
    by_score = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    first = resolved(survivors(v, q, None, *shape), v, q, width, scale)
    cutoffs = first.withColumn("r", F.row_number().over(by_score)).where(F.col("r") == k).select("query_id", F.col("score").alias("cutoff"))
    # Phases 2 and 3.
    last = resolved(survivors(v, q, cutoffs, *shape), v, q, width, scale)
    return last.withColumn("rank", F.row_number().over(by_score)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
