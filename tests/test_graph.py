import itertools
import random
from collections import deque

import pytest

from loomgraph.operators import graph, kg
from loomgraph.operators.components import connected_components


def edges(spark, pairs):
    return spark.createDataFrame([(*p, "r") for p in pairs], "src string, dst string, relation string")


def reach(pairs, start):
    seen, todo = {start: 0}, deque([start])
    while todo:
        x = todo.popleft()
        for a, b in pairs:
            if a == x and b not in seen:
                seen[b] = seen[x] + 1
                todo.append(b)
    return seen


@pytest.fixture(scope="module")
def pairs():
    rng = random.Random(11)
    out = [(f"n{rng.randint(0, 14):02d}", f"n{rng.randint(0, 14):02d}") for _ in range(24)]
    return out + [("x", "y"), ("y", "z"), ("z", "x"), ("z", "w"), ("s", "s")]


def test_components(spark, pairs):
    both = pairs + [(b, a) for a, b in pairs]
    want = {v: min(reach(both, v)) for p in pairs for v in p}
    assert {r.node: r.component for r in connected_components(edges(spark, pairs)).collect()} == want
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(60)]
    assert {r.component for r in connected_components(edges(spark, chain)).collect()} == {"c000"}


def test_strong_components(spark, pairs):
    nodes = sorted({v for p in pairs for v in p})
    want = {v: min(u for u in reach(pairs, v) if v in reach(pairs, u)) for v in nodes}
    assert {r.id: r.component for r in graph.strong_components(edges(spark, pairs)).collect()} == want


def test_distances(spark, pairs):
    got = {(r.source, r.id): r.dist for r in graph.distances(edges(spark, pairs), spark.createDataFrame([("x",), ("n00",)], "id string")).collect()}
    assert got == {(s, v): d for s in ("x", "n00") for v, d in reach(pairs, s).items()}


def test_triangles_and_clustering(spark, pairs):
    links = {frozenset(p) for p in pairs if p[0] != p[1]}
    nodes = {v for e in links for v in e}
    want = {v: sum(1 for a, b in itertools.combinations(sorted(nodes - {v}), 2) if {frozenset((v, a)), frozenset((v, b)), frozenset((a, b))} <= links) for v in nodes}
    got = graph.clustering(edges(spark, pairs)).collect()
    assert {r.id: r.triangles for r in got} == want
    for r in got:
        d = sum(r.id in e for e in links)
        assert r.coefficient == pytest.approx(2 * want[r.id] / (d * (d - 1)) if d > 1 else 0)


def test_pagerank_and_hits(spark, pairs):
    nodes = sorted({v for p in pairs for v in p})
    rank = dict.fromkeys(nodes, 1 / len(nodes))
    for _ in range(6):
        lost = sum(rank[v] for v in nodes if not any(a == v for a, _ in pairs))
        rank = {v: 0.15 / len(nodes) + 0.85 * (lost / len(nodes) + sum(rank[a] / sum(x == a for x, _ in pairs) for a, b in pairs if b == v)) for v in nodes}
    got = {r.id: r["rank"] for r in graph.pagerank(edges(spark, pairs), 6).collect()}
    assert got == pytest.approx(rank) and sum(got.values()) == pytest.approx(1)
    h = graph.hits(edges(spark, [("a", "b"), ("c", "b"), ("c", "d")]), 10).collect()
    assert max(h, key=lambda r: r.hub).id == "c" and max(h, key=lambda r: r.authority).id == "b"


def test_betweenness(spark):
    path = [("a", "b"), ("b", "c"), ("c", "d"), ("a", "e"), ("e", "c")]
    got = {r.id: r.betweenness for r in graph.betweenness(edges(spark, path), normalised=False).collect()}
    assert got == pytest.approx({"a": 0, "b": 1.0, "c": 3.0, "d": 0, "e": 1.0})


def test_counts(spark):
    e = edges(spark, [("a", "b"), ("a", "b"), ("b", "a"), ("b", "c"), ("c", "c")])
    assert graph.two_hop_count(e).first().chains == sum(x[1] == y[0] for x in [("a", "b"), ("a", "b"), ("b", "a"), ("b", "c"), ("c", "c")] for y in [("a", "b"), ("a", "b"), ("b", "a"), ("b", "c"), ("c", "c")])
    assert [tuple(r) for r in graph.reciprocal_pairs(e).collect()] == [("a", "b")]
    q = graph.quality(e).first()
    assert (q.edges, q.self_loops, q.nodes) == (5, 1, 3)
    assert [r.label for r in graph.label_propagation(edges(spark, [("a", "b")]), 2).orderBy("id").collect()] == ["a", "b"]


def test_quotas():
    assert kg.concept_quotas(100) == {"entity": 50, "relation": 20, "event": 30}
    assert kg.concept_quotas(10, entity=8, event=5, relation=4) == {"entity": 8, "relation": 0, "event": 2}
    assert kg.concept_quotas(10, entity=1, event=1, relation=1) == {"entity": 8, "relation": 1, "event": 1}
    assert kg.embedding_quotas(1000) == {"text": 250, "node": 500, "edge": 250}
    assert kg.embedding_quotas(10, text=8, node=8, edge=0) == {"text": 2, "node": 8, "edge": 0}
    assert kg.embedding_quotas(10, text=2, node=3, edge=1) == {"text": 2, "node": 3, "edge": 1}  # a lack stays
    assert kg.embedding_quotas(100, text=-5) == {"text": 0, "node": 100, "edge": 0}


def test_best_status_of_runs(spark):
    rows = [("a", "mapped", 1), ("a", "VALID", 5), ("b", " success", None), ("b", "VALID", None), ("c", "FAILED", 2), ("c", "TIMEOUT", 3), ("d", "INVALID", 0), ("d", "EMPTY", 0), ("e", "what", 1), ("e", None, 2), ("f", "NOT_REQUESTED", 0), ("f", "MISSING", 0)]
    df = spark.createDataFrame([(n, "Entity", s, c) for n, s, c in rows] + [(" ", "entity", "MAPPED", 9)], "name string, node_type string, mapping_status string, concept_count int")
    got = {r.name: (r.mapping_status, r.concept_count) for r in kg.global_coverage(df).collect()}
    assert got == {"a": ("MAPPED", 5), "b": ("VALID", None), "c": ("RATE_LIMITED", 3), "d": ("EMPTY", 0), "e": ("MISSING", 2), "f": ("NOT_REQUESTED", 0)}


def test_settled_communities(spark, pairs):
    near = {}
    for a, b in pairs:
        if a != b:
            near.setdefault(a, set()).add(b)
            near.setdefault(b, set()).add(a)
    label = {r.id: r.label for r in graph.communities(edges(spark, pairs)).collect()}
    for v, others in near.items():
        votes = [label[w] for w in others]
        assert votes.count(label[v]) == max(map(votes.count, votes)), v
    with pytest.raises(RuntimeError, match="settle"):
        graph.communities(edges(spark, [("a", "b"), ("b", "c")]), max_rounds=1)


def test_round_limits_raise(spark):
    rings = [("a", "b"), ("b", "a"), ("c", "d"), ("d", "c"), ("a", "c")]
    with pytest.raises(RuntimeError, match="rounds"):
        graph.strong_components(edges(spark, rings), max_rounds=1)
    got = {r.id: r.component for r in graph.strong_components(edges(spark, rings)).collect()}
    assert got == {"a": "a", "b": "a", "c": "c", "d": "c"}
    path = edges(spark, [("a", "b"), ("b", "c"), ("c", "d")])
    with pytest.raises(RuntimeError, match="hops"):
        graph.distances(path, spark.createDataFrame([("a",)], "id string"), max_depth=2)
    assert graph.distances(path, spark.createDataFrame([("a",)], "id string"), max_depth=4).count() == 4


def test_degree_summary_and_clustering(spark):
    star = [("h", f"x{k}") for k in range(39)] + [("x0", "x1")]
    r = graph.degree_summary(edges(spark, star)).first()
    assert (r.nodes, r.degree_max, r.degree_median, r.degree_p95, r.degree_p99, r.max_in_degree, r.max_out_degree) == (40, 39, 1, 2, 39, 2, 39)
    assert graph.average_clustering(edges(spark, star)).first()[0] == pytest.approx((2 * 1.0 + 2 / (39 * 38)) / 40, abs=1e-6)


def test_seeds_in_the_giant_component(spark):
    e = edges(spark, [("a", "b"), ("b", "c"), ("x", "y")])
    ranked = spark.createDataFrame([("x", 0.9), ("c", 0.5), ("a", 0.5), ("b", 0.1)], "id string, rank double")
    assert {r.id for r in graph.giant_seeds(e, ranked, 2).collect()} == {"a", "c"}


def test_two_types_of_one_name(spark):
    e = spark.createDataFrame([("a", "b", "r", "entity_relation", "d", 0), ("a", "c", "r", "event_relation", "d", 0), ("c", "b", "is participated by", "event_entity", "d", 0)], "src string, dst string, relation string, edge_type string, source_doc_id string, source_chunk_id int")
    assert sorted(map(tuple, kg.triple_nodes(e).collect())) == [("a", "entity"), ("a", "event"), ("b", "entity"), ("c", "event")]


def test_betweenness_of_500_sources(spark):
    """The registered query against Brandes' method in plain Python, on small tables."""
    from collections import defaultdict, deque
    from hashlib import sha256

    from loomgraph.plans import fixtures, registry

    sf = "/root/testdata/sf0.01"
    links, nodes = defaultdict(set), set()
    for r in fixtures.transitions(spark, sf).select("src", "dst").collect():
        nodes |= {r.src, r.dst}
        if r.src != r.dst:
            links[r.src].add(r.dst)
    sources = sorted(nodes, key=lambda v: (sha256(v.encode()).hexdigest(), v))[:500]
    want = dict.fromkeys(nodes, 0.0)
    for s in sources:
        paths, level, order, queue = defaultdict(float, {s: 1.0}), {s: 0}, [], deque([s])
        while queue:
            v = queue.popleft()
            order.append(v)
            for w in links[v]:
                if w not in level:
                    level[w] = level[v] + 1
                    queue.append(w)
                if level[w] == level[v] + 1:
                    paths[w] += paths[v]
        delta = dict.fromkeys(order, 0.0)
        for v in reversed(order):
            delta[v] = sum(paths[v] / paths[w] * (1 + delta[w]) for w in links[v] if level[w] == level[v] + 1)
            if v != s:
                want[v] += delta[v]
    n = len(nodes)
    got = {r.id: r.betweenness for r in registry.QUERIES["betweenness_500"](spark, sf).collect()}
    print("nodes", n, "sources", len(sources))
    assert len(sources) > 20
    assert got == pytest.approx({v: x / ((n - 1) * (n - 2)) * n / len(sources) for v, x in want.items()}, abs=1e-6)
