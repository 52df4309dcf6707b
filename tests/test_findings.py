import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomgraph.operators import graph
from loomgraph.operators.components import contracted_components, sparse_components


@pytest.fixture(scope="module")
def shared_urls(spark, tmp_path_factory):
    """Pages of which several share a URL."""
    sf = str(tmp_path_factory.mktemp("sf"))
    rows = [(i, f"http://h/{i % 4}", f"text {i % 8}") for i in range(24)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").write.parquet(f"{sf}/pages.parquet")
    return sf


def like_duckdb(spark, sf, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{sf}/pages.parquet/*.parquet'")
    df = entry.queries()[name](spark, sf)
    want = con.execute(f"select {', '.join(df.columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)


def test_upsert_of_pages_that_share_a_url(spark, shared_urls):
    like_duckdb(spark, shared_urls, "crawl_upsert")


def test_object_keys_of_pages_that_share_a_url(spark, shared_urls):
    like_duckdb(spark, shared_urls, "object_key_reuse")


def test_dependencies_over_arrays():
    """A path of 3,000 nodes with a short cut, in pieces of links, from several sources."""
    import numpy as np

    from loomgraph.operators import packed

    links = sorted({(i, i + 1) for i in range(2999)} | {(0, 5)})
    start = np.searchsorted([u for u, _ in links], np.arange(3001))
    got = packed._dependencies(start, np.array([v for _, v in links], np.int32), np.array([0, 2990]))
    assert got[1] == 3 and got[4] == 0 and got[5] == 2999 - 5 and got[2991] == 8 + 8 and got[0] == 0
    assert [len(at) for at, _, _ in packed._steps(np.arange(10), np.arange(0, 33, 3), most=6)] == [1, 2, 2, 2, 2, 1]


def test_triangles_by_colours():
    """Every triangle is found in the task of its colours and in no other."""
    import itertools
    import random

    import numpy as np

    from loomgraph.operators import packed

    rng, p = random.Random(5), 3
    links = sorted({tuple(sorted(rng.sample(range(30), 2))) for _ in range(200)} | {(0, k) for k in range(1, 30)})
    want = np.zeros(30, int)
    for c in itertools.combinations(range(30), 3):
        if all(e in links for e in itertools.combinations(c, 2)):
            want[list(c)] += 1
    got = np.zeros(30, int)
    for g in itertools.combinations_with_replacement(range(p), 3):
        mine = [(u, v) for u, v in links if any(tuple(sorted((u % p, v % p, c))) == g for c in range(p))]
        nodes, count = packed._corners(*(np.array(x) for x in zip(*mine)), g, p, most=7)
        got[nodes] += count
    assert want.sum() > 300 and got.tolist() == want.tolist()


def test_knn_of_equal_and_odd_vectors(spark):
    """Copies, ties, nulls, zeros, two lengths; against plain Python. Blocks are small."""
    import math
    import random

    from loomgraph.operators import retrieval as rt

    rng = random.Random(3)
    rows = [(i, [float(rng.randint(-1, 1)) for _ in range(3)]) for i in range(120)] + [(200 + i, [1.0, 2.0, 3.0]) for i in range(30)]
    rows += [(300, None), (301, []), (302, [0.0, 0.0, 0.0]), (303, [1.0, 0.0]), (304, [2.0, 1.0]), (305, [1.0, None, 2.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    asked = df.where("vec_id % 5 = 0").selectExpr("vec_id AS query_id", "embedding AS q")
    got = sorted(map(tuple, rt.knn(df, asked, 4, block_size=60).collect()))
    good = {i: v for i, v in rows if v and None not in v and any(v)}
    want = []
    for i, q in good.items():
        if i % 5 == 0:
            score = {j: round(sum(map(lambda x, y: x * y, q, v)) / (math.hypot(*q) * math.hypot(*v)), 6) for j, v in good.items() if j != i and len(v) == len(q)}
            want += [(i, r, j, score[j]) for r, j in enumerate(sorted(score, key=lambda j: (-score[j], j))[:4], 1)]
    assert [x[:3] for x in got] == [x[:3] for x in sorted(want)] and [x[3] for x in got] == pytest.approx([x[3] for x in sorted(want)])


def test_knn_leaves_most_pairs_out():
    import numpy as np

    from loomgraph.operators import retrieval as rt

    rng = np.random.default_rng(1)
    q, v = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rng.normal(size=(1500, 16)), rng.normal(size=(9000, 16))))
    pairs = [np.concatenate(x) for x in zip(*rt._nearest(q.astype(np.float32), v.astype(np.float32), 5))]
    assert len(pairs[0]) < 1500 * 6
    found = set(zip(*map(np.ndarray.tolist, pairs)))
    assert {(i, j) for i, row in enumerate(np.argsort(-(q @ v.T), axis=1)[:, :5].tolist()) for j in row} <= found


def test_contracted_components(spark, monkeypatch):
    """Against the star rounds: paths, stars, loops, nulls; no links left to one task."""
    import random

    from loomgraph.operators import components

    rng = random.Random(2)
    rows = [(f"p{i}", f"p{i + 1}") for i in range(150)] + [("h", f"h{i}") for i in range(60)] + [(f"r{rng.randint(0, 80)}", f"r{rng.randint(0, 80)}") for _ in range(60)]
    df = spark.createDataFrame([*rows, ("s", "s"), (None, "x"), ("x", None)], "src string, dst string")
    want = {r.node: r.component for r in components.connected_components(df).collect()}
    assert {r.node: r.component for r in components.contracted_components(df).collect()} == want
    monkeypatch.setattr(components, "FEW", 3)
    got = components.contracted_components(df).collect()
    assert {r.node: r.component for r in got} == want and len(got) == len(want)
    assert components.contracted_components(df.where("src = 's'")).collect() == [("s", "s")]
    assert components.contracted_components(df.limit(0)).collect() == []


def test_selection_leaves_few_rows_to_a_task(spark):
    """The window over a whole type follows one over its parts, with the same rows."""
    from loomgraph.operators import kg

    rows = [(f"{i * 7919 % 1009:04d}", "edge" if i % 5 else "text") for i in range(1000)]
    items = spark.createDataFrame(rows, "item_id string, item_type string")
    done = items.where("item_id < '0100'")
    for limit in (30, 2000):
        df = kg.select_inputs(items, done, limit, {"edge": 20, "text": 4})
        want = []
        for kind, quota in (("edge", 20), ("text", 4)):
            left = sorted(i for i, t in rows if t == kind and i >= "0100")
            want += [(int(r > quota), r, kind, i) for r, i in enumerate(left, 1)]
        assert [(r.phase, r.type_rank, r.item_type, r.item_id) for r in df.collect()] == sorted(want)[:limit]
        assert "_part" in df._jdf.queryExecution().optimizedPlan().toString()


def test_rows_of_triples_are_narrow(spark):
    """They are distinct as numbers: no text of keys is in the rows that move."""
    from loomgraph.plans import fixtures

    plan = fixtures.triples(spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "cast(" not in plan.split("\n", 1)[1] and "cast(" not in plan[: plan.index("], [")]


def test_relation_stats_of_nulls(spark):
    from loomgraph.operators import graph

    rows = [("a", "b", "r"), ("a", "b", "r"), ("a", None, "r"), (None, "b", "r"), ("c", "b", None), ("c", "d", None)]
    plan = graph.relation_stats(spark.createDataFrame(rows, "src string, dst string, relation string"))
    assert {tuple(r) for r in plan.collect()} == {("r", 4, 1, 1, 3, 1.33), (None, 2, 1, 2, 2, 1.0)}
    assert "Expand" not in plan._jdf.queryExecution().optimizedPlan().toString()


def test_bm25_scores_where_documents_are_read(spark):
    """Against scores by hand, with ties, copies of texts, equal questions, a repeated id, and blocks of questions; no row for each pair moves."""
    import math
    from collections import Counter, defaultdict

    from pyspark.sql import functions as F

    from loomgraph.operators import retrieval as rt

    words = [f"w{i}" for i in range(12)] + ["É", "7"]
    texts = [(i, " ".join(words[(i * i + 3 * j * (i % 5)) % 14] for j in range(i % 23 + 1)) if i % 40 else None) for i in range(400)]
    texts += [(1000 + i, "w1, w2 W2") for i in range(50)] + [(7, "w3 w3 w4"), (7, "w3 w3 w4"), (7, "w5")]
    asked = [(q, w) for q in range(30) for w in {words[q % 7].lower(), words[(q * q + 1) % 14].lower(), "w2"}]
    queries = spark.createDataFrame(asked, "query_id int, term string")
    docs = spark.createDataFrame(texts, "id bigint, text string").repartition(5)

    said = [(i, rt_words) for i, t in texts for rt_words in [(t or "").lower().replace(",", "").split()]]
    mean = sum(len(w) for _, w in said) / len(said)
    found = Counter((i, len(ws), w) for i, ws in said for w in ws)
    df = Counter(w for _, _, w in found)
    scores = defaultdict(float)
    for q, t in asked:
        for (i, n, w), tf in found.items():
            if w == t:
                scores[q, i] += math.log(1 + (len(said) - df[w] + 0.5) / (df[w] + 0.5)) * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * n / mean))
    want = set()
    for q in range(30):
        best = sorted((-round(s, 6), i) for (p, i), s in scores.items() if p == q)[:6]
        want |= {(q, r, i, -s) for r, (s, i) in enumerate(best, 1)}
    for block in (1_000_000, 20):
        got = rt.bm25(docs, queries, 6, block=block)
        assert {(r.query_id, r.rank, r.id, r.score) for r in got.collect()} == want
    assert rt.bm25(docs, queries.limit(0), 6).isEmpty() and rt.bm25(docs.limit(0), queries, 6).isEmpty()
    named = rt.bm25(docs.select(F.concat(F.lit("d"), "id").alias("id"), "text"), queries, 6)
    assert named.where("query_id = 2").count() == 6


# --- round 2: figures that grew with the larger tables


def test_report_contracts_few_links_of_a_dense_graph(spark, monkeypatch):
    given = []

    def watched(edges, *names):
        given.append(edges.count())
        return contracted_components(edges, *names)

    monkeypatch.setattr("loomgraph.operators.components.contracted_components", watched)
    monkeypatch.setattr("loomgraph.operators.graph.contracted_components", watched)
    cliques = [(f"{g}{i:02}", f"{g}{j:02}", "r", "e") for g in "abc" for i in range(30) for j in range(30) if i < j]
    edges = spark.createDataFrame([*cliques, *cliques[:5], ("b00", "a07", "s", "e"), ("a07", "b00", "r", None), ("x", "x", "r", "e"), (None, "c01", "r", "e")], "src string, dst string, relation string, edge_type string")
    nodes = spark.createDataFrame([(f"{g}{i:02}", "n") for g in "abc" for i in range(30)] + [("x", "n"), ("alone", "n")], "node_name string, node_type string")
    got = {(r.metric, r.key): r.value for r in graph.report(nodes, edges).collect()}
    assert sum(given) <= 4 * 92
    assert [got["components", k] for k in ("components", "largest_component", "isolated_nodes")] == [4, 60, 2]
    assert got["counts", "triple_edges"] == len(cliques) + 9 and got["counts", "distinct_directed_pairs"] == len(cliques) + 3
    assert got["counts", "distinct_semantic_triples"] == len(cliques) + 2 and got["counts", "reciprocal_directed_pairs"] == 1
    assert got["degree", "zero_degree_nodes"] == 1 and got["top_nodes", "a07"] == 31 and got["top_nodes", "a00"] == 34


def test_sparse_components_join_what_the_chosen_links_leave(spark):
    links = spark.createDataFrame([(1, 2), (3, 4), (2, 3), (5, 6), (7, 8), (8, 5)], "u bigint, v bigint")
    chosen = links.where("u in (1, 3, 5, 7)")
    got = {}
    for r in sparse_components(chosen, links).collect():
        got.setdefault(r.component, set()).add(r.node)
    assert sorted(map(sorted, got.values())) == [[1, 2, 3, 4], [5, 6, 7, 8]]


def test_table_report_makes_its_rows_once(spark):
    made = spark.sparkContext.accumulator(0)

    def watched(frames):
        for frame in frames:
            made.add(len(frame))
            yield frame

    rows = spark.createDataFrame([(f"n{i % 7}", f"t{i}") for i in range(40)], "node_name string, text_id string").mapInPandas(watched, "node_name string, text_id string")
    texts = spark.createDataFrame([(f"t{i}",) for i in range(30)], "text_id string")
    enriched = spark.createDataFrame([("a", "b", "r", "M", "E", "V"), ("a", "c", "r", "M", "M", "V"), (None, "c", "r", "M", "M", "V")], "src string, dst string, relation string, src_concept_status string, dst_concept_status string, relation_concept_status string")
    nodes = spark.createDataFrame([("b",), ("c",)], "node_name string")
    coverage = spark.createDataFrame([("entity", "MAPPED")], "node_type string, mapping_status string")
    concepts = spark.createDataFrame([("k",)], "concept_id string"), spark.createDataFrame([("k",), ("z",), ("z",)], "dst string")
    got = {(r.metric, r.key): r.value for r in graph.table_report(texts, rows, coverage, enriched, nodes, *concepts).collect()}
    assert made.value == 40
    assert got["provenance", "orphan_text_edges"] == 10 and got["provenance", "nodes_with_source_text"] == 7 and got["provenance", "text_nodes_with_edges"] == 40
    assert got["quality", "orphan_enriched_src"] == 3 and got["quality", "orphan_enriched_dst"] == 0 and got["concept", "orphan_concept_edges"] == 2
    assert got["dst_concept_status", "M"] == 2


def test_text_edges_parse_once(spark):
    df = entry.queries()["text_edges"](spark, "/root/testdata/sf0.001")
    assert "try_parse_json" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_text_between_brackets_is_found_without_python(spark):
    from loomgraph.functions import jsons

    texts = ['see [{"Head": "a"}] there', 'x {"a": [1]} y', "[1] and [2]", 'a [1], "y": [2]', "a [1]] b ]", "a [1.50] b", "a [-0] b", "none", "a [ b", "a } b [", "[x] [2]"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [(r.b, r.f) for r in df.select("t", jsons.bracketed(F.col("t")).alias("b"), jsons.fragment("t").alias("f")).collect()]
    assert all(b is None or b == f for b, f in got)
    assert [b for b, _ in got][:2] == ['[{"Head": "a"}]', '{"a": [1]}'] and sum(b is not None for b, _ in got) == 2
    assert [f for _, f in got] == ['[{"Head": "a"}]', '{"a": [1]}', "[1]", "[1]", "[1]", "[1.5]", "[0]", None, None, None, "[2]"]


def test_diameter_bound_of_several_sources(spark):
    links = [(f"n{i:02}", f"n{i + 1:02}") for i in range(9)] + [("n03", "x"), ("q", "r"), ("q", "q")]
    edges = spark.createDataFrame(links, "src string, dst string")
    for asked in (["n00"], ["n04", "n03"], ["x", "q"], ["q"], []):
        sources = spark.createDataFrame([(x,) for x in asked], "id string")
        want = graph.distances(edges, sources, directed=False).agg(F.max("dist")).first()[0]
        assert graph.diameter_bound(edges, sources).first()[0] == want
    many = spark.createDataFrame([(f"n{i:02}",) for i in range(70)], "id string")
    assert graph.diameter_bound(edges, many).first()[0] == 9
