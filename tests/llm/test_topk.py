import math
import random

import pytest

from loomgraph.llm import topk

VEC = "vec_id bigint, embedding array<double>, score string"


def brute(rows, asking, k=5):
    ok = lambda v: v is not None and all(x is not None and math.isfinite(x) for x in v)
    rows = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and ok(v)]
    out = []
    for q in sorted({i for i, _ in rows if asking(i)}):
        v = min(x for i, x in rows if i == q)
        clamp = lambda s: max(-(1 << 63), min((1 << 63) - 1, s))
        scored = sorted((-clamp(sum(a * b for a, b in zip(v, w, strict=False))), i) for i, w in rows if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return out


def run(spark, rows, **params):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VEC)
    return sorted(map(tuple, topk.top_k(df, df.where("vec_id % 7 = 0"), **params).collect()))


@pytest.mark.parametrize("params", [{}, {"query_block": 4, "vector_block": 30}])
def test_against_brute_force(spark, params):
    rng = random.Random(3)
    rows = [(i, [rng.gauss(0, 0.3) for _ in range(10)]) for i in range(150)]
    rows += [(200 + i, [0.5] * 10) for i in range(60)]  # ties
    rows += [(400, None), (401, [1.0, None]), (402, [float("nan")] * 10), (403, [float("inf")] * 10), (404, []), (405, [1.0] * 3), (406, [1.0] * 12), (3, rows[3][1]), (None, [1.0] * 10)]
    assert run(spark, rows, **params) == brute(rows, lambda i: i % 7 == 0)


def test_few_rows_and_huge_values(spark):
    assert run(spark, [(7, [1.0, 2.0]), (8, [1e6, -3.0]), (9, [1e6 + 0.5, 1.0])]) == brute([(7, [1.0, 2.0]), (8, [1e6, -3.0]), (9, [1e6 + 0.5, 1.0])], lambda i: i % 7 == 0)
    big = [(7, [1e9, 1.0]), (14, [3e9, 7.0]), (1, [2e5 + 1, 5.0]), (2, [2e5, 9.0])]
    assert run(spark, big) == brute(big, lambda i: i % 7 == 0)
    assert run(spark, []) == []
    assert run(spark, [(7, [1.0])]) == []


def test_whole_small_table(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    got = sorted(map(tuple, topk.top_k(df, df.where("vec_id % 50 = 0")).collect()))
    assert got == brute(rows, lambda i: i % 50 == 0)


def test_only_survivors_are_resolved(spark):
    """The cutoff leaves a small part of all pairs, and among them every result."""
    rng = random.Random(4)
    rows = [(i, [rng.gauss(0, 1) for _ in range(64)]) for i in range(1500)] + [(i, [0.25] * 64) for i in range(2000, 2600)]
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], VEC)
    v = topk.cut(topk.entries_of(topk._usable(df, "vec_id", "embedding"), 5))
    q = topk.cut(topk._usable(df.where("vec_id % 7 = 0"), "vec_id", "embedding").groupBy("vec_id").agg(topk.F.min("x").alias("x")).withColumnRenamed("vec_id", "query_id"))
    assert v.count() == 1501 and max(len(r.ids) for r in v.collect()) == 6  # equal vectors are one entry
    want = brute(rows, lambda i: i % 7 == 0)
    cutoffs = spark.createDataFrame([(a, s) for a, r, _, s in want if r == 5], "query_id bigint, cutoff bigint")
    shape = (5, 2, 64, 256.0, 4096, 16384)
    left = topk.survivors(v, q, cutoffs, *shape)
    pairs = q.count() * v.count()
    assert left.count() < 0.1 * pairs
    found = {(r.query_id, r.vec_id): r.score for r in topk.resolved(left, v, q, 64, 256.0).collect()}
    assert all(found[a, i] == s for a, _, i, s in want)
    first = topk.survivors(v, q, None, *shape)
    assert first.count() <= q.count() * 2 * 6
