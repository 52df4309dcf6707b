"""Graphs as arrays of numbers: numbered nodes, packed links, and the kernels that run over them in Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.session import cut, prepare


def numbered(ids: DataFrame) -> DataFrame:
    """id (distinct), no: numbers from 0 without gaps, in the order of the ids. Only the row counts of the partitions come to the driver."""
    parts = cut(ids.select("id").repartitionByRange("id").sortWithinPartitions("id"))
    sizes = {r.p: r.n for r in parts.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect()}
    starts = np.concatenate([[0], np.cumsum([sizes.get(p, 0) for p in range(max(sizes, default=0) + 1)])])
    first = F.element_at(F.array(*(F.lit(int(s)).cast("bigint") for s in starts)), F.spark_partition_id() + 1)
    return parts.select("id", (first + F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).alias("no"))


def by_number(edges: DataFrame, numbers: DataFrame) -> DataFrame:
    """(u, v): the numbers of src and dst, without self loops; parallel edges stay."""
    known = [numbers.select(F.col("id").alias(end), F.col("no").alias(no)) for end, no in (("src", "u"), ("dst", "v"))]
    return edges.select("src", "dst").where("src <> dst").join(known[0], "src").join(known[1], "dst").select("u", "v")


def _packed(links: DataFrame, wide: bool, most: int = 250_000) -> DataFrame:
    """block: up to `most` links by u, as three arrays of bytes (u, how many, v)."""
    kind = "<i8" if wide else "<i4"

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        us, vs, held = [], [], 0

        def out() -> pa.RecordBatch:
            u, n = np.unique(np.concatenate(us), return_counts=True)
            return pa.RecordBatch.from_arrays([pa.array([x.astype(kind).tobytes()], pa.binary()) for x in (u, n, np.concatenate(vs))], ["u", "n", "v"])

        for batch in batches:
            if batch.num_rows:
                us.append(batch.column(0).to_numpy())
                vs.append(batch.column(1).to_numpy())
                held += batch.num_rows
            if held >= most:
                yield out()
                us, vs, held = [], [], 0
        if held:
            yield out()

    return links.select("u", "v").repartition("u").sortWithinPartitions("u").mapInArrow(pack, "u binary, n binary, v binary")


def _rows(blocks: pa.Table, n: int, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(start, dst): the links of node x are dst[start[x] : start[x + 1]]."""
    u, many, v = (blocks.column(c) for c in ("u", "n", "v"))
    view = lambda column, i: np.frombuffer(column[i].as_buffer(), kind)
    degree = np.zeros(n + 1, np.int64)
    for i in range(len(u)):
        degree[view(u, i) + 1] += view(many, i)
    start = np.cumsum(degree)
    free, dst = start[:-1].copy(), np.empty(start[-1], kind)
    for i in range(len(u)):
        at, k = view(u, i), view(many, i).astype(np.int64)
        dst[np.repeat(free[at] - np.cumsum(k) + k, k) + np.arange(k.sum())] = view(v, i)
        free[at] += k
    return start, dst


def _steps(nodes: np.ndarray, start: np.ndarray, most: int = 1 << 20) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The links of the nodes in pieces of about `most`: (nodes, how many of each, their places in dst)."""
    k = start[nodes + 1] - start[nodes]
    for piece in np.split(np.arange(len(nodes)), np.flatnonzero(np.diff(np.cumsum(k) // most)) + 1):
        at, many = nodes[piece], k[piece]
        yield at, many, np.repeat(start[at] - np.cumsum(many) + many, many) + np.arange(many.sum())


def _dependencies(start: np.ndarray, dst: np.ndarray, sources: np.ndarray) -> np.ndarray:
    """The sum over the sources of the dependencies of each node (Brandes), the sources' own left out."""
    n = len(start) - 1
    total = np.zeros(n)
    for s in sources:
        level, paths, delta = np.full(n, -1, np.int32), np.zeros(n), np.zeros(n)
        level[s], paths[s] = 0, 1.0
        fronts = [np.array([s], np.int64)]
        while len(fronts[-1]):
            depth, found = len(fronts), []
            for at, many, places in _steps(fronts[-1], start):
                to = dst[places]
                fits = (level[to] == -1) | (level[to] == depth)
                to, given = to[fits], np.repeat(paths[at], many)[fits]
                new = to[level[to] == -1]
                level[new] = depth
                found.append(new)
                if 4 * len(to) > n:
                    paths += np.bincount(to, given, n)
                else:
                    np.add.at(paths, to, given)
            new = np.concatenate(found)
            fronts.append(np.flatnonzero(level == depth) if 8 * len(new) > n else np.unique(new).astype(np.int64))
        for depth in range(len(fronts) - 3, 0, -1):
            for at, many, places in _steps(fronts[depth], start):
                to = dst[places]
                fits = level[to] == depth + 1
                to, of = to[fits], np.repeat(np.arange(len(at)), many)[fits]
                delta[at] = paths[at] * np.bincount(of, (1 + delta[to]) / paths[to], len(at))
        total += delta
    return total


def dependencies(links: DataFrame, n: int, sources: DataFrame, k: int, tasks: int = 24) -> DataFrame:
    """no, s: the sums over the k sources (column no) of the dependencies of the n nodes; links (u, v) distinct.

    The sources are dealt out to `tasks` tasks (to the root of k, if that is more); each holds the links as
    arrays, 4 bytes a link, and 20 bytes a node.
    """
    spark = prepare(links.sparkSession)
    tasks = max(1, min(k, max(tasks, int(k**0.5))))
    wide = n >= 1 << 31
    kind = "<i8" if wide else "<i4"
    # One key for each of the partitions that the tasks are dealt out to.
    slot = F.pmod(F.hash(F.col("id")), F.lit(tasks))
    keys = {r.slot: r.key for r in spark.range(64 * tasks + 1024).groupBy(slot.alias("slot")).agg(F.min("id").alias("key")).collect()}
    names = F.array(*(F.lit(keys[i]) for i in sorted(keys)))
    asked = numbered(sources.select(F.col("no").alias("id")))
    asked = asked.select(F.col("id").alias("source"), F.element_at(names, (F.col("no") % len(keys) + 1).cast("int")).alias("task")).repartition(tasks, "task")
    blocks = cut(_packed(links, wide)).select("*", F.explode(names).alias("task")).repartition(tasks, "task")

    def run(mine: pa.Table, blocks: pa.Table) -> pa.Table:
        start, dst = _rows(blocks, n, kind)
        total = _dependencies(start, dst, mine.column("source").to_numpy())
        at = np.flatnonzero(total)
        return pa.table({"no": at.astype(np.int64), "s": total[at]})

    return asked.groupBy("task").cogroup(blocks.groupBy("task")).applyInArrow(run, "no bigint, s double").groupBy("no").agg(F.sum("s").alias("s"))


def _corners(u: np.ndarray, v: np.ndarray, colours: tuple[int, int, int], p: int, most: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, triangles of each): of distinct links (u, v) whose corners have these colours (number modulo p)."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    m = len(nodes)
    order = np.argsort(np.bincount(at, minlength=m), kind="stable")  # links go to the end of higher degree, so no node opens many pairs
    rank = np.empty(m, np.int64)
    rank[order] = np.arange(m)
    a, b = rank[at[: len(u)]], rank[at[len(u) :]]
    keys = np.sort(np.minimum(a, b) * m + np.maximum(a, b))
    x, y = keys // m, keys % m
    later = np.searchsorted(x, x, "right") - np.arange(len(x)) - 1
    single = next((c for c in colours if colours.count(c) == 1), None) if len(set(colours)) == 2 else None
    colour = nodes[order] % p
    count = np.zeros(m, np.int64)
    for piece in np.split(np.arange(len(x)), np.flatnonzero(np.diff(np.cumsum(later) // most)) + 1):
        k = later[piece]
        one = np.repeat(piece, k)
        z = y[one + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k) + 1]
        wanted = y[one] * m + z
        place = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
        hit = keys[place] == wanted
        corners = np.stack([x[one[hit]], y[one[hit]], z[hit]])
        if single is not None:  # those of one colour are counted elsewhere
            corners = corners[:, (colour[corners] == single).any(axis=0)]
        count += np.bincount(corners.ravel(), minlength=m)
    has = np.flatnonzero(count)
    return nodes[order][has], count[has]


def triangle_corners(pairs: DataFrame) -> DataFrame:
    """no, t: in how many triangles of the pairs (u < v, distinct) each node is.

    Nodes have p colours, and each triangle is found once, in the task of its three colours, which gets the pairs
    between these; so no pairs of neighbours are sent. A pair goes to p tasks. p grows to 12 for small
    tables, and on from 192 million pairs on, so that a task holds at most about 8 million.
    """
    prepare(pairs.sparkSession)
    e = pairs.count()
    p = max(1, min(12, int((6 * e / 250_000) ** 0.5)), int((6 * e / 8_000_000) ** 0.5))
    colours = F.array_sort(F.array((F.col("u") % p).cast("int"), (F.col("v") % p).cast("int"), F.col("c").cast("int")))
    dealt = pairs.select("u", "v", F.explode(F.sequence(F.lit(0), F.lit(p - 1))).alias("c")).select(((colours[0] * p + colours[1]) * p + colours[2]).alias("g"), "u", "v")

    def run(key: tuple, mine: pa.Table) -> pa.Table:
        g = key[0].as_py()
        nodes, count = _corners(mine.column("u").to_numpy(), mine.column("v").to_numpy(), (g // p // p, g // p % p, g % p), p)
        return pa.table({"no": nodes, "t": count})

    return dealt.groupBy("g").applyInArrow(run, "no bigint, t bigint").groupBy("no").agg(F.sum("t").alias("t"))
