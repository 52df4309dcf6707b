import corpus_pipeline
from loomgraph.llm import decontam, pii, toxicity

from test_similar_texts import brute_classes  # noqa: I001


def test_stages_against_plain_code(spark, tmp_path):
    """Each stage's rows from its input, recomputed in plain Python with the same models."""
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels, bench = spark.read.parquet(f"{sf}/labels.parquet"), spark.read.parquet(f"{sf}/benchmark.parquet")
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs.orderBy("doc_id").collect()
        out = stage(spark, docs, sf)
        out.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        after = {r.doc_id: r for r in docs.collect()}
        if name == "toxicity":
            chain = toxicity.train_toxicity(spark.createDataFrame(before), labels)
            p = chain.predict([toxicity._hashed(toxicity.features_of(r.text.encode())) for r in before])
            assert set(after) == {r.doc_id for r, x in zip(before, p[:, -1], strict=True) if x < 0.5}
        elif name == "near_copies":
            _, part = brute_classes([r.text for r in before])
            kept = {before[i].doc_id for i in set(part)}
            assert set(after) == kept
        elif name == "decontamination":
            wu = decontam.WuManber([(str(r.item_id), r.text.encode()) for r in bench.collect()])
            assert set(after) == {r.doc_id for r in before if not wu.search(decontam.words_of(r.text.encode()))[0]}
        elif name == "pii":
            model = pii.train_candidate_model()
            assert {d: r.text for d, r in after.items()} == {r.doc_id: pii.redacted(r.text, pii.find_in_text(r.text, model)[1]) for r in before}
        else:
            assert set(after) == {r.doc_id for r in before}
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_odd_rows(spark, tmp_path):
    """Null and repeated ids, an id with two texts, empty and very long texts, columns named like the stages' own."""
    long = " ".join(f"w{k}" for k in range(60_000))
    rows = [(1, None, "en", "s", None), (2, "", None, "s", 0), (2, "", None, "s", 0), (3, "a@b.cd words", "en", None, 12), (3, "a@b.cd words", "en", None, 12)]
    rows += [(None, "one text without an id", None, None, 1), (None, "and quite another text", None, None, 1), (4, "the first text of four", "en", "s", 1), (4, "what else has number four", "en", "s", 1), (5, long, "en", "s", 1)]
    extra = "_hit1 string, key string, part string, r1 string, rank int, fp string, row string, n_hit int"
    docs = spark.createDataFrame([(*r, "x", "x", "x", "x", 1, "x", "x", 1) for r in rows], f"doc_id bigint, text string, lang string, source string, n_chars bigint, {extra}")
    empty = docs.limit(0)
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        if k < len(corpus_pipeline.STAGES) - 1:
            assert stage(spark, docs, "/root/testdata/sf0.001").columns == docs.columns
        assert stage(spark, empty, "/root/testdata/sf0.001").count() == 0
        stage(spark, docs, "/root/testdata/sf0.001").write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
    assert sorted(str(r.doc_id) for r in docs.collect()) == ["1", "3", "4", "4", "5", "None", "None"]


def test_oracle_queries_equal_duckdb(spark):
    import duckdb

    from loomgraph.llm import queries

    sf, con = "/root/testdata/sf0.001", duckdb.connect()
    for t in ("documents", "embeddings", "benchmark", "conversations"):
        con.execute(f"create view {t} as select * from '{sf}/{t}.parquet'")
    for name, sql in queries.ORACLE_SQL.items():
        df = queries.QUERIES[name](spark, sf)
        want = con.execute(f"select {', '.join(df.columns)} from ({sql})").fetchall()
        assert sorted(map(tuple, df.collect()), key=str) == sorted(want, key=str), name
