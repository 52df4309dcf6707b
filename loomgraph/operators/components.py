"""Connected components of an edge table: by contraction over numbered nodes, or by alternating large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.operators.packed import numbered
from loomgraph.session import cut, spooled


def _star(edges: DataFrame, larger: bool) -> DataFrame:
    """Links neighbours of each node to the least node it knows (itself included)."""
    if larger:
        near = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    least = near.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    linked = near.join(least, "u")
    if larger:
        out = linked.where(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = linked.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").distinct()


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) for every node of an edge; component is the least node of it.

    Self loops count as nodes of their own; nulls are dropped; an empty table gives none.
    Each round is cut by a checkpoint, so that lost executors cost one round at most. The
    number of rounds grows with the logarithm of the longest path.
    """
    given = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    edges = cut(given.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    links = edges.where("u <> v")
    nodes = edges.select(F.col("u").alias("node")).union(edges.select(F.col("v").alias("node"))).distinct()
    state = None
    for _ in range(max_rounds):
        links = cut(_star(_star(links, True), False))
        now = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if tuple(now) == state:
            break
        state = tuple(now)
    else:
        raise RuntimeError("components did not settle")
    return nodes.join(links.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


#: Links that one task joins at the end of a contraction, and the bits that number a node.
FEW, _BITS = 50_000, 40


def _key(no: Column, seed: int) -> Column:
    """A random order of the nodes for each seed; the lower bits are the node."""
    return F.shiftleft(F.shiftrightunsigned(F.xxhash64(no, F.lit(seed)), _BITS + 1), _BITS).bitwiseOR(no)


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """no, rep of all nodes of a few links."""
    up: dict[int, int] = {}

    def root(x: int) -> int:
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = x = up[up[x]]
        return x

    for batch in batches:
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            a, b = root(u), root(v)
            up[max(a, b)] = min(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(list(up), pa.int64()), pa.array([root(x) for x in list(up)], pa.int64())], ["no", "rep"])


def contracted_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60) -> DataFrame:
    """(node, component) as connected_components() gives them, for large tables: each round leaves a part of the links.

    Nodes are numbered in their order. In a round each node goes to the first of its neighbours and itself in a
    random order (one for two rounds, so that stars end in two), and links between the places are what is left. The
    last FEW links are joined in one task; then the places are followed back.
    """
    given = edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null")
    numbers = numbered(given.select(F.explode(F.array("u", "v")).alias("id")).distinct())
    known = [numbers.select(F.col("id").alias(c), F.col("no").alias(f"_{c}")) for c in "uv"]
    links = given.where("u <> v").join(known[0], "u").join(known[1], "v").select(F.col("_u").alias("u"), F.col("_v").alias("v"))
    links = cut(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    went = []
    for k in range(max_rounds):
        n = links.count()
        if n <= FEW:
            if n:
                went.append(cut(links.coalesce(1).mapInArrow(_joined, "no bigint, rep bigint")))
            break
        both = links.select(F.expr("explode(array(named_struct('no', u, 'near', v), named_struct('no', v, 'near', u)))").alias("l")).select("l.no", _key(F.col("l.near"), k // 2).alias("key"))
        first = F.least(F.min("key"), _key(F.col("no"), k // 2)).bitwiseAND(F.lit((1 << _BITS) - 1))
        moves = cut(both.groupBy("no").agg(first.alias("rep")))
        went.append(moves)
        ends = links.join(moves.select(F.col("no").alias("u"), F.col("rep").alias("a")), "u").join(moves.select(F.col("no").alias("v"), F.col("rep").alias("b")), "v")
        links = cut(ends.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    else:
        raise RuntimeError("components did not settle")
    place = None
    for moves in reversed(went):
        if place is not None:
            moves = moves.join(place.select(F.col("no").alias("rep"), F.col("rep").alias("last")), "rep", "left").select("no", F.coalesce("last", "rep").alias("rep"))
        place = cut(moves)
    if place is None:
        return numbers.select(F.col("id").alias("node"), F.col("id").alias("component"))
    all_ = cut(numbers.join(place, "no", "left").select("id", F.coalesce("rep", "no").alias("rep")))
    least = all_.groupBy("rep").agg(F.min("id").alias("component"))
    return all_.join(least, "rep").select(F.col("id").alias("node"), "component")


def picks(no: Column, near: Column, k: int = 3) -> list[Column]:
    """Aggregates of the links of a node: up to k of its neighbours' numbers, each the first in an order of its own."""
    masks = [F.xxhash64(no, F.lit(i)) for i in range(k)]
    return [F.min(near.bitwiseXOR(m)).alias(f"_pick{i}") for i, m in enumerate(masks)]


def picked(df: DataFrame, no: str = "no", k: int = 3) -> DataFrame:
    """(u, v): the links that the aggregates of picks() chose."""
    chosen = F.array(*(F.col(f"_pick{i}").bitwiseXOR(F.xxhash64(F.col(no), F.lit(i))) for i in range(k)))
    return df.select(F.col(no).alias("u"), F.explode(F.array_distinct(chosen)).alias("v")).where("v is not null")


def sparse_components(chosen: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component: a node of it) of all links (u, v), for graphs with many more links than nodes.

    Only the chosen links, a few for each node, are contracted. All links are then looked at once: those that
    still lie between two parts, of which few are left, join the parts.
    """
    parts = spooled(contracted_components(chosen, "u", "v"))
    known = [parts.select(F.col("node").alias(c), F.col("component").alias(to)) for c, to in (("u", "a"), ("v", "b"))]
    between = cut(links.select("u", "v").where("u <> v").join(known[0], "u").select("a", "v").join(known[1], "v").where("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct())
    if between.isEmpty():
        return parts
    more = contracted_components(between, "u", "v").select(F.col("node").alias("component"), F.col("component").alias("whole"))
    return parts.join(more, "component", "left").select("node", F.coalesce("whole", "component").alias("component"))
