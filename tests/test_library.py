import asyncio
import json

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from loomgraph.operators import extraction, ingestion as ing
from loomgraph.operators import retrieval as rt
from loomgraph.plans import runner
from loomgraph.sources import catalog
from loomgraph.streaming import crawl


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 20 and rows[0].degree >= rows[-1].degree
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", ["doc_clean_metrics", "structured_pivot", "concept_coverage", "node_context_hash", "relation_stats", "rrf_fusion", "token_f1", "quality_report", "page_links", "components"])
def test_queries_equal_duckdb(spark, name):
    import duckdb

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    df = entry.queries()[name](spark, sf)
    want = con.execute(f"select {', '.join(df.columns)} from ({entry.oracle_sql()[name]})").fetchall()
    assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str)


def test_lake(spark, tmp_path):
    lake = catalog.Lake(spark, str(tmp_path))
    assert lake.versions("silver.t") == [] and lake.latest("silver.t") is None
    with pytest.raises(FileNotFoundError):
        lake.read("silver.t")
    lake.write(spark.createDataFrame([(1, "a")], "k int, v string"), "silver.t", "r1")
    lake.append_new(spark.createDataFrame([(1, "x"), (2, "b"), (2, "b")], "k int, v string"), "silver.t", "r2", ["k"])
    assert lake.versions("silver.t") == ["r1", "r2"]
    assert sorted(r.k for r in lake.read("silver.t").collect()) == [2]
    assert sorted((r.k, r.run_id) for r in lake.read_runs("silver.t").collect()) == [(1, "r1"), (2, "r2")]
    assert lake.read_runs("silver.t", ["r1"]).count() == 1
    merged = catalog.merge_rows(lake.read("silver.t", "r1"), spark.createDataFrame([(1, "new")], "k int, v string"), ["k"])
    assert [tuple(r) for r in merged.collect()] == [(1, "new")]


def test_readers(spark, tmp_path):
    (tmp_path / "t.csv").write_text('head,relation,tail,stage,source\n"say ""hi""",r,b,s,x\n,r,b,s,x\n')
    assert [r["head"] for r in catalog.read_triples_csv(spark, str(tmp_path / "t.csv")).collect()] == ['say "hi"']
    (tmp_path / "kv.json").write_text(json.dumps({"d1": {"content": "a"}, "d2": {"content": "b"}}))
    assert sorted(map(tuple, catalog.read_kv(spark, str(tmp_path / "kv.json"), "content string").collect())) == [("d1", "a"), ("d2", "b")]
    (tmp_path / "g.graphml").write_text('<graphml><graph><node id="A"><data key="d0">x</data></node><node id="B"/><edge source="A" target="B"><data key="d1">2</data></edge></graph></graphml>')
    nodes, links = catalog.read_graphml(spark, str(tmp_path / "g.graphml"))
    assert nodes.count() == 2 and [(r.src, r.dst, r.props) for r in links.collect()] == [("A", "B", {"d1": "2"})]
    (tmp_path / "j.json").write_text('[{"a": 1}, {"a": 2}]')
    assert catalog.read_records(spark, str(tmp_path / "j.json"), "json").count() == 2
    lines = spark.createDataFrame(list(enumerate(['  "head": "h1",', '  "relation": "r",', '  "tail": "t",', '  "stage": "s",', '  "source": "one",', '  "source": "two",', '  "head": "h2",', '  "tail": "x",'])), "n int, value string")
    assert [tuple(r) for r in catalog.triples_from_lines(lines).collect()] == [("h1", "r", "t", "s", "one")]


def test_change_detection(spark):
    s = "normalized_url string, content_hash string, etag string, last_modified string, object_key string"
    state = spark.createDataFrame([("a", "h1", None, None, "k"), ("b", "h1", "e", None, "k"), ("c", None, "e", None, "k"), ("d", None, None, "m", "k")], s)
    new = spark.createDataFrame([("a", "h1", None, None, "n"), ("b", "h2", "e", None, "n"), ("c", "h", "e", None, "n"), ("d", None, "z", "q", "n"), ("e", "h", None, None, "n")], s)
    got = {r.normalized_url: (r.change, r.object_key) for r in ing.keep_object_key(ing.changes(new, state)).collect()}
    assert got == {"a": ("SKIPPED_UNCHANGED", "k"), "b": ("UPDATED", "n"), "c": ("SKIPPED_UNCHANGED", "k"), "d": ("UPDATED", "n"), "e": ("NEW", "n")}


def test_streamed_changes(spark, tmp_path):
    lake = catalog.Lake(spark, str(tmp_path / "lake"))
    cols = "normalized_url, content_hash, null AS etag, null AS last_modified, 'k' AS object_key, timestamp'2024-01-01' AS fetched_at"

    def feed(rows):
        df = spark.createDataFrame(rows, "normalized_url string, content_hash string").selectExpr(*cols.split(", "))
        df.select(*(F.col(f.split()[0]).cast(f.split()[1]) for f in crawl.STATE.split(", "))).write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(crawl.STATE).parquet(str(tmp_path / "in"))
        crawl.track_changes(source, lake, str(tmp_path / "ck")).awaitTermination(120)

    feed([("a", "1"), ("b", "1")])
    feed([("a", "1"), ("b", "2"), ("c", "1")])
    assert {r.normalized_url: r.change for r in lake.read("crawl.changes").collect()} == {"a": "SKIPPED_UNCHANGED", "b": "UPDATED", "c": "NEW"}
    assert {r.normalized_url: r.content_hash for r in lake.read("crawl.state").collect()} == {"a": "1", "b": "2", "c": "1"}


def test_source_registry():
    config = {"version": 1, "defaults": {"allowed_domains": ["X.edu "]}, "sources": [{"id": "main-site", "start_urls": ["https://www.x.edu/a"]}, {"id": "off", "enabled": False}]}
    sources = ing.registry(config)
    assert sources[0]["allowed_domains"] == ["x.edu"] and [s["id"] for s in ing.selected(sources, " ALL ")] == ["main-site"]
    for bad in ({"id": "Bad_Id"}, {"id": "main-site"}, {"id": "z", "start_urls": ["https://y.org"]}):
        with pytest.raises(ValueError):
            ing.registry({**config, "sources": [*config["sources"], bad]})


def test_retries_and_order():
    tries = {}

    async def call(x):
        tries[x] = tries.get(x, 0) + 1
        if x == "limited" and tries[x] < 3:
            raise extraction.ModelError("RATE_LIMITED", "429", True)
        if x == "bad":
            raise extraction.ModelError("FAILED", "400", False)
        if x == "slow":
            raise extraction.ModelError("TIMEOUT", "late", True)
        return x.upper()

    got = asyncio.run(extraction.call_all(call, ["a", "limited", "bad", "slow"], at_once=2, pause=0))
    assert [r["status"] for r in got] == ["SUCCESS", "SUCCESS", "FAILED", "TIMEOUT"] and got[1]["response_text"] == "LIMITED"
    assert tries == {"a": 1, "limited": 3, "bad": 1, "slow": 4}


def test_rate_limit():
    now, made = [0.0], []

    async def go():
        limiter = extraction.RateLimiter(2, 0.05)
        loop = asyncio.get_running_loop()
        for _ in range(5):
            await limiter.acquire()
            made.append(loop.time())

    asyncio.run(go())
    assert made[2] - made[0] >= 0.045 and made[4] - made[2] >= 0.045 and now == [0.0]


def test_model_runner(spark):
    def client():
        async def call(prompt):
            return f"<{prompt}>"

        return call

    df = spark.createDataFrame([("1", "a"), ("2", "b")], "request_id string, user_prompt string")
    assert sorted((r.request_id, r.response_text) for r in extraction.run_model(df, client).collect()) == [("1", "<a>"), ("2", "<b>")]


def test_runner(spark, tmp_path):
    steps = [runner.Step("one", lambda s: {"a": 1}), runner.Step("two", lambda s: {"b": s["a"] + 1}), runner.Step("three", lambda s: {"c": s["b"] + 1})]
    path = str(tmp_path / "state.json")
    assert runner.Runner(steps).go(end="two", state_path=path) == {"a": 1, "b": 2}
    assert runner.Runner(steps).go(start="three", state_path=path) == {"a": 1, "b": 2, "c": 3}
    assert runner.Runner(steps).go(dry_run=True) == {}
    with pytest.raises(runner.InvariantError):
        runner.Runner(steps).go(start="three", end="one")
    df = spark.createDataFrame([(1,), (1,)], "k int")
    for check in (lambda: runner.expect_unique(df, ["k"]), lambda: runner.expect_rows(df.limit(0)), lambda: runner.expect_equal_rows(df, df.distinct()), lambda: runner.expect_no_orphans(df, "rows")):
        with pytest.raises(runner.InvariantError):
            check()
    assert runner.parse_limit(None, 5) == 5 and runner.parse_limit("7", 5) == 7 and runner.parse_limit("9", 5, full=True) is None


def test_neighbourhood_uses_no_edge_twice(spark):
    e = spark.createDataFrame([(1, "a", "b", 2.0), (2, "b", "c", 1.0), (3, "c", "a", None)], "edge_id long, src string, dst string, weight double")
    got = rt.neighbourhood(e, spark.createDataFrame([("a",)], "id string"), 3).collect()
    assert sorted((r.node, r.path, r.weight) for r in got) == [("b", [1], 2.0), ("b", [3, 2], 1.0), ("c", [1, 2], 3.0), ("c", [3], 0.0)]


def test_serving_load(spark, tmp_path):
    """Merges by key over versions, a reset, repeated keys and a failing store."""
    from loomgraph.operators import serving
    from loomgraph.plans.runner import InvariantError
    from loomgraph.sources.catalog import Lake, write_rejects

    lake = Lake(spark, f"file://{tmp_path}/lake")
    rows = lambda *r: spark.createDataFrame(list(r), "id string, content string")
    assert serving.load(lake, "r1", {"chunks": rows(("a", "1"), ("b", "2"))}) == {"chunks": 2}
    assert serving.load(lake, "r2", {"chunks": rows(("b", "3"), ("c", "4"))}) == {"chunks": 3}
    assert sorted(map(tuple, lake.read("chunks").collect())) == [("a", "1"), ("b", "3"), ("c", "4")]
    assert serving.load(lake, "r3", {"chunks": rows(("z", "0"))}, reset=True) == {"chunks": 1}
    with pytest.raises(InvariantError):
        serving.load(lake, "r4", {"chunks": rows(("a", "1"), ("a", "2"))})
    vectors = spark.createDataFrame([("a", [1.0, 2.0])], "id string, embedding array<double>")
    out = serving.fan_out({"index": lambda: serving.load_vectors(lake, "r1", vectors, 2), "other": lambda: serving.load_vectors(lake, "r2", vectors, 3)})
    assert out["index"] == ("LOADED", 1) and out["other"][0] == "FAILED"
    assert write_rejects(lake, rows(("x", "bad")), "chunks", "r1") == 1


def test_stored_objects_by_key(spark, tmp_path):
    from loomgraph.sources.catalog import read_objects, render_markdown

    (tmp_path / "d").mkdir()
    (tmp_path / "d" / "1.json").write_text('{"a": 1}')
    (tmp_path / "d" / "2.json").write_text("{broken")
    (tmp_path / "d" / "9.json").write_text('{"a": 9}')
    keys = spark.createDataFrame([("d/1.json",), ("d/2.json",), ("d/3.json",), ("d/1.json",)], "object_key string")
    got = {r.object_key: (r.object and r.object.a, r.found, r.error) for r in read_objects(spark, keys, f"file://{tmp_path}", "a int").collect()}
    assert got == {"d/1.json": (1, True, None), "d/2.json": (None, True, "invalid_json"), "d/3.json": (None, False, "missing")}
    metrics = spark.createDataFrame([("m", str(k), 1.0) for k in range(5)], "metric string, key string, value double")
    assert "Only the first 3 rows" in render_markdown("t", metrics, 3) and "Only" not in render_markdown("t", metrics, 5)


def test_summary_of_a_results_file(spark, tmp_path):
    from loomgraph.operators import evaluation as ev

    path = tmp_path / "results.jsonl"
    path.write_text('{"id": "a", "f1": 0.5}\n{"id": "b", "f1": null}\n{"id": "c", "error": "x", "f1": 0.9}\n')
    summary, ranked = ev.summary_from_file(spark, str(path), ["f1", "absent"])
    row = summary.first()
    assert (row["items"], row.completed, row.avg_f1, row.avg_absent) == (3, 2, 0.5, None)
    assert [r.id for r in ranked.collect()] == ["c", "a", "b"]


def test_clock_and_scalars(spark):
    from datetime import datetime, timezone

    from loomgraph.functions import jsons
    from loomgraph.operators import documents

    now = datetime(2024, 5, 6, 7, 8, 9, tzinfo=timezone.utc)
    assert documents.run_id_of(now) == "run_20240506T070809Z"
    df = documents.tagged(spark.createDataFrame([("entity", "7"), ("event", "x")], "node_type string, v string"), "r1", "v2", now)
    assert [(r.run_id, r.schema_version) for r in df.collect()] == [("r1", "v2")] * 2
    assert [r.i for r in df.select(jsons.safe_int("v").alias("i")).collect()] == [7, None]
    assert documents.of_types(df, ["event"]).count() == 1


def test_partitions_for_calls(spark):
    from loomgraph.operators import documents

    rows = spark.range(120).selectExpr("CAST(id AS STRING) AS request_id")
    assert documents.even_partitions(rows, 8, rows_each=50).rdd.getNumPartitions() == 3
    assert documents.even_partitions(rows, 2, rows_each=50).rdd.getNumPartitions() == 2
    assert documents.even_partitions(rows.limit(0), 8).count() == 0
