"""Queries over the knowledge graph: construction, concepts, embeddings, analytics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomgraph.operators import graph, kg
from loomgraph.operators.components import contracted_components
from loomgraph.plans import document_queries as dq
from loomgraph.plans import fixtures as fx
from loomgraph.session import cut, spooled

QUERIES, ORACLE_SQL = {}, {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


# --- base tables from validated responses

_KEY = "stage AS edge_type, doc_id AS source_doc_id, chunk_id AS source_chunk_id"
_SOLD = "concat('p', CAST(partkey AS STRING), ' sold')"
_EDGES = f"""SELECT DISTINCT concat('p', CAST(partkey AS STRING)) AS src, flag AS dst, 'has flag' AS relation, {_KEY} FROM ({dq.CHOSEN}) WHERE stage <> 'event_entity'
 UNION SELECT {_SOLD}, flag, 'is participated by', {_KEY} FROM ({dq.CHOSEN}) WHERE stage = 'event_entity'
 UNION SELECT {_SOLD}, concat('s', CAST(suppkey AS STRING)), 'is participated by', {_KEY} FROM ({dq.CHOSEN}) WHERE stage = 'event_entity'"""
_NODES = f"""SELECT DISTINCT n AS node_name, t AS node_type FROM (SELECT src AS n, CASE WHEN edge_type = 'entity_relation' THEN 'entity' ELSE 'event' END AS t FROM ({_EDGES})
 UNION ALL SELECT dst, CASE WHEN edge_type = 'event_relation' THEN 'event' ELSE 'entity' END FROM ({_EDGES}))"""


@query(f"SELECT * FROM ({_EDGES})")
def triple_edges(spark: SparkSession, sf: str) -> DataFrame:
    return kg.triple_edges(dq.structured(spark, sf))


@query(f"SELECT * FROM ({_NODES})")
def triple_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return kg.triple_nodes(kg.triple_edges(dq.structured(spark, sf)))


_TEXTS = f"SELECT DISTINCT doc_id, chunk_id, concat('text ', doc_id, '/', CAST(chunk_id AS STRING)) AS t FROM ({dq.CHOSEN})"


@query(f"SELECT DISTINCT sha256(t) AS text_id, t AS original_text FROM ({_TEXTS})")
def text_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return kg.text_nodes(dq.structured(spark, sf))


@query(f"SELECT DISTINCT n AS node_name, sha256(t) AS text_id, 'Source' AS edge_type FROM (SELECT src AS n, source_doc_id, source_chunk_id FROM ({_EDGES}) UNION ALL SELECT dst, source_doc_id, source_chunk_id FROM ({_EDGES})) e JOIN ({_TEXTS}) x ON e.source_doc_id = x.doc_id AND e.source_chunk_id = x.chunk_id")
def text_edges(spark: SparkSession, sf: str) -> DataFrame:
    s = spooled(dq.structured(spark, sf))  # read twice; the parse runs once
    return kg.text_edges(kg.triple_edges(s), s.select("doc_id", "chunk_id", "original_text"))


@query(f"SELECT node_name AS name, node_type FROM ({_NODES}) UNION SELECT DISTINCT relation, 'relation' FROM ({_EDGES})")
def missing_concepts(spark: SparkSession, sf: str) -> DataFrame:
    edges = spooled(kg.triple_edges(dq.structured(spark, sf)))
    return kg.missing_concepts(kg.triple_nodes(edges), edges)


@query(f"SELECT count(*) AS orphan_nodes FROM ({_NODES}) WHERE NOT starts_with(node_name, 'p') OR node_name NOT IN (SELECT concat('p', CAST(p_partkey AS STRING)) FROM part)")
def orphan_nodes(spark: SparkSession, sf: str) -> DataFrame:
    known = fx.table(spark, sf, "part").selectExpr("concat('p', CAST(p_partkey AS STRING)) AS id")
    return kg.orphans(triple_nodes(spark, sf), "node_name", known, "id").agg(F.count("*").alias("orphan_nodes"))


def _context_sql(strategy: str) -> str:
    freq = "(SELECT relation, count(*) AS freq FROM t GROUP BY relation)" if strategy != "hash" else "(SELECT DISTINCT relation, 0 AS freq FROM t)"

    def side(node: str) -> str:
        return f"""SELECT node_name, left(string_agg(ctx, ' | ' ORDER BY r), 400) AS c FROM (
          SELECT *, row_number() OVER (PARTITION BY node_name ORDER BY freq, h) AS r FROM (
            SELECT *, row_number() OVER (PARTITION BY node_name, relation ORDER BY freq, h) AS rr FROM (
              SELECT {node} AS node_name, relation, freq, concat(src, ' --', relation, '--> ', dst) AS ctx, sha256(concat(src, ' --', relation, '--> ', dst)) AS h FROM (SELECT DISTINCT src, relation, dst FROM t) JOIN {freq} USING (relation)))
          WHERE rr = 1) WHERE r <= 5 GROUP BY node_name"""

    return f"""WITH t AS ({fx.TRIPLES}), n AS (SELECT DISTINCT src AS node_name, 'entity' AS node_type FROM t UNION SELECT DISTINCT dst, 'entity' FROM t)
    SELECT n.node_name, n.node_type, coalesce(a.c, '') AS predecessor_context, coalesce(b.c, '') AS successor_context, left(concat_ws(' | ', a.c, b.c), 1000) AS context_text
    FROM n LEFT JOIN ({side('dst')}) a ON n.node_name = a.node_name LEFT JOIN ({side('src')}) b ON n.node_name = b.node_name"""


def _triple_nodes(t: DataFrame) -> DataFrame:
    return graph.vertices(t).select(F.col("id").alias("node_name"), F.lit("entity").alias("node_type"))


@query(_context_sql("hash"))
def node_context_hash(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.triples(spark, sf)
    return kg.node_context(_triple_nodes(t), t)


@query(_context_sql("rarest"))
def node_context_rarest(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.triples(spark, sf)
    return kg.node_context(_triple_nodes(t), t, strategy="relation_frequency")


# --- concepts: every part is a name, its brand and type are its concepts

_PROMPTS = [("entity", "Concepts of {{node_name}}: {{context_text}}", "v1"), ("event", "Concepts of event {{node_name}}: {{context_text}}", "v1"), ("relation", "Concepts of relation {{node_name}}", "v1")]
_MISSING = f"SELECT name, node_type FROM ({fx.NAMES}) UNION SELECT DISTINCT p_type, 'relation' FROM part"
_REQ = f"""SELECT sha256(concat_ws('||', name, m.node_type, 'v1', 'v1', 'stub')) AS concept_request_id, name AS node_name, m.node_type,
 CASE WHEN m.node_type = 'relation' THEN NULL ELSE coalesce(c.p_brand, '') END AS context_text,
 CASE m.node_type WHEN 'relation' THEN concat('Concepts of relation ', name) WHEN 'event' THEN concat('Concepts of event ', name, ': ', coalesce(c.p_brand, '')) ELSE concat('Concepts of ', name, ': ', coalesce(c.p_brand, '')) END AS prompt_text, 'v1' AS prompt_version
 FROM ({_MISSING}) m LEFT JOIN (SELECT name, node_type, p_brand FROM ({fx.NAMES}) WHERE p_size > 10) c USING (name, node_type)"""


def _missing(spark, sf):
    names = fx.names(spark, sf)
    return names.select("name", "node_type").union(names.select("p_type", F.lit("relation"))).distinct()


def _requests(spark, sf):
    names = fx.names(spark, sf)
    context = names.where("p_size > 10").select(F.col("name").alias("node_name"), "node_type", F.col("p_brand").alias("context_text"))
    prompts = spark.createDataFrame(_PROMPTS, "node_type string, template string, prompt_version string")
    return kg.concept_requests(_missing(spark, sf), context, prompts, "stub")


@query(_REQ)
def concept_requests(spark: SparkSession, sf: str) -> DataFrame:
    return _requests(spark, sf)


_PLINES = "SELECT concat(p_name, ' ', CAST(p_partkey AS STRING)) AS src, p_type AS relation, concat('s', CAST(l_suppkey AS STRING)) AS dst FROM lineitem JOIN part ON l_partkey = p_partkey"


def _part_edges(spark, sf):
    return fx.table(spark, sf, "lineitem").join(fx.table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).selectExpr("concat(p_name, ' ', CAST(p_partkey AS STRING)) AS src", "p_type AS relation", "concat('s', CAST(l_suppkey AS STRING)) AS dst")


@query(f"""WITH e AS ({_PLINES}), d AS (SELECT id, count(*) AS n FROM (SELECT src AS id FROM e UNION ALL SELECT dst FROM e) GROUP BY id), f AS (SELECT relation, count(*) AS n FROM e GROUP BY relation),
 p AS (SELECT r.node_name, r.node_type, CAST(coalesce(CASE WHEN node_type = 'relation' THEN f.n ELSE d.n END, 0) AS BIGINT) AS priority_score FROM ({_REQ}) r LEFT JOIN d ON d.id = r.node_name LEFT JOIN f ON f.relation = r.node_name)
 SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY node_type ORDER BY priority_score DESC, node_name) AS INTEGER) AS type_rank FROM p)
 WHERE type_rank <= CASE node_type WHEN 'entity' THEN 50 WHEN 'event' THEN 30 ELSE 20 END""")
def priority_pick(spark: SparkSession, sf: str) -> DataFrame:
    scored = kg.priorities(_requests(spark, sf), _part_edges(spark, sf)).select("node_name", "node_type", "priority_score")
    return kg.pick_by_quota(scored, "node_type", kg.concept_quotas(100), [F.desc("priority_score"), F.col("node_name")])


_RUNS = "SELECT CAST(l_partkey AS STRING) AS concept_request_id, l_shipdate AS created_ts, concat('run_', l_returnflag) AS run_id, l_orderkey, l_linenumber FROM lineitem"


@query(f"SELECT concept_request_id, created_ts, run_id FROM (SELECT *, row_number() OVER (PARTITION BY concept_request_id ORDER BY created_ts DESC NULLS LAST, run_id DESC) AS r FROM ({_RUNS})) WHERE r = 1")
def latest_raw(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "lineitem").selectExpr("CAST(l_partkey AS STRING) AS concept_request_id", "l_shipdate AS created_ts", "concat('run_', l_returnflag) AS run_id")
    return kg.newest(rows, ["concept_request_id"], [F.desc_nulls_last("created_ts"), F.desc("run_id")])


_STATUS = "CASE WHEN p_partkey % 11 = 0 THEN 'TIMEOUT' ELSE 'SUCCESS' END"
_PARSE = "CASE WHEN p_partkey % 11 = 0 THEN 'SOURCE_TIMEOUT' WHEN p_partkey % 7 = 0 THEN 'EMPTY' ELSE 'VALID' END"
_RID = "sha256(concat_ws('||', name, node_type, 'v1', 'v1', 'stub'))"
#: Responses for the names whose part isn't divisible by 4: the others have not run.
_PARSED = f"SELECT {_RID} AS concept_request_id, name AS node_name, node_type, {_STATUS} AS status, {_PARSE} AS parse_status, p_brand, p_type FROM ({fx.NAMES}) WHERE p_partkey % 4 <> 0"
_MAPPINGS = f"SELECT concept_request_id, node_name, node_type, c AS concept_name, sha256(concat(c, '_concept')) AS concept_id FROM (SELECT *, p_brand AS c FROM ({_PARSED}) UNION ALL SELECT *, p_type AS c FROM ({_PARSED})) WHERE parse_status = 'VALID'"


def _parsed(spark, sf):
    names = fx.names(spark, sf).where("p_partkey % 4 <> 0")
    return names.select(F.expr(_RID.replace("sha256(", "sha2(")[:-1] + ", 256)").alias("concept_request_id"), F.col("name").alias("node_name"), "node_type", F.expr(_STATUS).alias("status"), F.expr(_PARSE).alias("parse_status"), F.array("p_brand", "p_type").alias("concepts"))


@query(_MAPPINGS)
def concept_mappings(spark: SparkSession, sf: str) -> DataFrame:
    return kg.concept_mappings(_parsed(spark, sf))


_COVERAGE = f"""SELECT m.name, m.node_type, {_RID.replace('name', 'm.name').replace('node_type', 'm.node_type')} AS concept_request_id, coalesce(p.status, 'NOT_RUN') AS request_status,
 coalesce(p.parse_status, 'NOT_RUN') AS parse_status, CASE WHEN p.parse_status = 'VALID' THEN 'MAPPED' WHEN p.status IS NULL THEN 'PENDING' ELSE 'UNMAPPED' END AS mapping_status,
 CAST(CASE WHEN p.parse_status = 'VALID' THEN CASE WHEN p_brand = p_type THEN 1 ELSE 2 END ELSE 0 END AS INTEGER) AS concept_count
 FROM ({_MISSING}) m LEFT JOIN ({_PARSED}) p ON m.name = p.node_name AND m.node_type = p.node_type"""


def _coverage(spark, sf):
    parsed = _parsed(spark, sf)
    return kg.concept_coverage(_missing(spark, sf), _requests(spark, sf), parsed, kg.concept_mappings(parsed))


@query(_COVERAGE)
def concept_coverage(spark: SparkSession, sf: str) -> DataFrame:
    return _coverage(spark, sf)


_PRIMARY = f"SELECT node_name, node_type, arg_min(concept_id, concept_name) AS concept_id, min(concept_name) AS concept_name, count(DISTINCT concept_id) AS concept_count FROM ({_MAPPINGS}) GROUP BY node_name, node_type"


@query(_PRIMARY)
def primary_concept(spark: SparkSession, sf: str) -> DataFrame:
    return kg.primary_concepts(kg.concept_mappings(_parsed(spark, sf)))


@query(f"SELECT DISTINCT node_name AS src, concept_id AS dst, 'has_concept' AS relation, 'Concept' AS edge_type FROM ({_MAPPINGS})")
def concept_edges(spark: SparkSession, sf: str) -> DataFrame:
    return kg.concept_graph(kg.concept_mappings(_parsed(spark, sf)), _coverage(spark, sf))[1]


@query(f"SELECT DISTINCT concept_id, concept_name AS name FROM ({_MAPPINGS})")
def concept_nodes(spark: SparkSession, sf: str) -> DataFrame:
    return kg.concept_graph(kg.concept_mappings(_parsed(spark, sf)), _coverage(spark, sf))[0]


def _look(key: str, kind: str, p: str) -> str:
    return f"LEFT JOIN (SELECT c.*, pc.concept_id, coalesce(pc.concept_count, 0) AS cc FROM ({_COVERAGE}) c LEFT JOIN ({_PRIMARY}) pc ON c.name = pc.node_name AND c.node_type = pc.node_type) {p} ON {p}.name = {key} AND {p}.node_type = {kind}"


@query(f"""WITH e AS (SELECT DISTINCT * FROM ({_PLINES})), n AS (SELECT name, min(node_type) AS t FROM ({fx.NAMES}) GROUP BY name)
 SELECT e.src, e.relation, e.dst, n.t AS src_type, a.mapping_status AS src_status, a.concept_id AS src_concept_id, CAST(coalesce(a.cc, 0) AS INTEGER) AS src_concept_count,
 r.mapping_status AS relation_status, b.mapping_status AS dst_status FROM e LEFT JOIN n ON n.name = e.src {_look('e.src', 'n.t', 'a')} {_look('e.relation', "'relation'", 'r')} {_look('e.dst', 'NULL', 'b')}""")
def edges_enriched(spark: SparkSession, sf: str) -> DataFrame:
    nodes = fx.names(spark, sf).select(F.col("name").alias("node_name"), "node_type")
    mappings = kg.concept_mappings(_parsed(spark, sf))
    out = kg.enrich_edges(_part_edges(spark, sf).distinct(), nodes, _coverage(spark, sf), kg.primary_concepts(mappings))
    return out.select("src", "relation", "dst", "src_type", "src_status", "src_concept_id", "src_concept_count", "relation_status", "dst_status")


# --- embeddings

_ITEMS = f"""SELECT sha256(concat_ws('||', name, node_type, 'stub')) AS item_id, 'node' AS item_type, concat('Node: ', name, chr(10), 'Node type: ', node_type, chr(10), 'Context: ', p_brand) AS text_for_embedding FROM ({fx.NAMES})
 UNION ALL SELECT sha256(concat_ws('||', src, relation, dst, 'stub')), 'edge', concat('Edge: ', src, ' --', relation, '--> ', dst) FROM (SELECT DISTINCT * FROM ({_PLINES}))
 UNION ALL SELECT sha256(text), 'text', left(text, 2000) FROM (SELECT DISTINCT trim(text) AS text FROM benchmark)"""


def _items(spark, sf):
    names = fx.names(spark, sf)
    nodes = names.select(F.col("name").alias("node_name"), "node_type")
    context = names.select(F.col("name").alias("node_name"), "node_type", F.col("p_brand").alias("context_text"))
    texts = kg.text_nodes(fx.table(spark, sf, "benchmark").withColumnRenamed("text", "original_text"))
    return kg.node_inputs(nodes, context, "stub").unionByName(kg.edge_inputs(_part_edges(spark, sf), "stub")).unionByName(kg.text_inputs(texts, "stub"))


@query(f"SELECT item_id, item_type, sha256(text_for_embedding) AS text_hash FROM ({_ITEMS})")
def embedding_inputs(spark: SparkSession, sf: str) -> DataFrame:
    return _items(spark, sf).select("item_id", "item_type", F.sha2("text_for_embedding", 256).alias("text_hash"))


_DONE = f"SELECT item_id FROM ({_ITEMS}) WHERE item_id < '4'"


@query(f"""SELECT item_id, item_type, CAST(type_rank AS INTEGER) AS type_rank, CAST(phase AS INTEGER) AS phase FROM (
 SELECT *, CASE WHEN type_rank <= CASE item_type WHEN 'text' THEN 10 WHEN 'node' THEN 500 ELSE 390 END THEN 0 ELSE 1 END AS phase FROM (
 SELECT *, row_number() OVER (PARTITION BY item_type ORDER BY item_id) AS type_rank FROM ({_ITEMS}) WHERE item_id NOT IN ({_DONE}))) ORDER BY phase, type_rank, item_type, item_id LIMIT 900""")
def embedding_select(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf)
    done = items.where("item_id < '4'")
    return kg.select_inputs(items, done, 900, kg.embedding_quotas(900, text=10)).select("item_id", "item_type", "type_rank", "phase")


@query(f"SELECT item_id, item_type, CASE WHEN item_id >= 'c' THEN CASE WHEN item_id >= 'e' THEN 'EMBEDDED' ELSE 'FAILED' END WHEN item_id < '4' THEN 'EMBEDDED' ELSE 'PENDING' END AS embedding_status FROM ({_ITEMS})")
def embedding_coverage(spark: SparkSession, sf: str) -> DataFrame:
    items = _items(spark, sf)
    results = items.where("item_id >= 'c'").selectExpr("item_id", "CASE WHEN item_id >= 'e' THEN 'SUCCESS' ELSE 'FAILED' END AS status")
    existing = items.where("item_id < '4' OR item_id >= 'f'").selectExpr("item_id", "'EMBEDDED' AS embedding_status")
    return kg.embedding_coverage(items, results, existing)


@query("""SELECT vec_id, label, src FROM (SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY prio, run_id DESC) AS r FROM (
 SELECT vec_id, label, 'old' AS src, 1 AS prio, 'r1' AS run_id FROM embeddings UNION ALL SELECT vec_id, label + 100, 'new', 0, 'r2' FROM embeddings WHERE label < 5)) WHERE r = 1""")
def embedding_upsert(spark: SparkSession, sf: str) -> DataFrame:
    old = fx.table(spark, sf, "embeddings").selectExpr("vec_id", "label", "'old' AS src", "1 AS prio", "'r1' AS run_id")
    new = fx.table(spark, sf, "embeddings").where("label < 5").selectExpr("vec_id", "label + 100 AS label", "'new' AS src", "0 AS prio", "'r2' AS run_id")
    return kg.newest(old.unionByName(new), ["vec_id"], [F.col("prio"), F.desc("run_id")]).select("vec_id", "label", "src")


# --- statistics

_TR = f"WITH t AS ({fx.TRIPLES}), d AS (SELECT id, sum(i) AS in_degree, sum(o) AS out_degree, count(*) AS degree FROM (SELECT src AS id, 0 AS i, 1 AS o FROM t UNION ALL SELECT dst, 1, 0 FROM t) GROUP BY id)"
_DEG = "id, CAST(in_degree AS BIGINT) AS in_degree, CAST(out_degree AS BIGINT) AS out_degree, degree"


@query(f"{_TR} SELECT {_DEG} FROM d ORDER BY degree DESC, id LIMIT 20")
def graph_degree_top(spark: SparkSession, sf: str) -> DataFrame:
    return graph.top_by(graph.degrees(fx.triples(spark, sf)), "degree", 20)


@query(f"{_TR} SELECT {_DEG} FROM d")
def graph_degrees(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degrees(fx.triples(spark, sf))


@query(f"{_TR} SELECT degree, count(*) AS nodes FROM d GROUP BY degree")
def degree_histogram(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degree_histogram(fx.triples(spark, sf))


@query(f"{_TR} SELECT count(*) AS n, max(degree) AS max_degree, quantile_disc(degree, 0.5) AS p50, quantile_disc(degree, 0.95) AS p95, quantile_disc(degree, 0.99) AS p99 FROM d")
def degree_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    p = F.percentile_approx("degree", [0.5, 0.95, 0.99], 1_000_000)
    df = graph.degrees(fx.triples(spark, sf)).agg(F.count("*").alias("n"), F.max("degree").alias("max_degree"), p.alias("p"))
    return df.select("n", "max_degree", *(F.col("p")[i].alias(name) for i, name in enumerate(("p50", "p95", "p99"))))


_RELS = "SELECT relation, count(*) AS n, count(DISTINCT src) AS heads, count(DISTINCT dst) AS tails, count(DISTINCT (src, dst)) AS pairs, round(count(*) / count(DISTINCT (src, dst)), 2) AS specificity FROM t GROUP BY relation"


@query(f"WITH t AS ({fx.TRIPLES}) {_RELS}")
def relation_stats(spark: SparkSession, sf: str) -> DataFrame:
    return graph.relation_stats(fx.triples(spark, sf))


@query(f"WITH t AS (SELECT src, dst, concat(relation, '_', dst) AS relation FROM ({fx.TRIPLES})) SELECT relation FROM t GROUP BY relation HAVING count(*) = 1")
def rare_relations(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.triples(spark, sf).withColumn("relation", F.concat("relation", F.lit("_"), "dst"))
    return t.groupBy("relation").count().where("count = 1").select("relation")


_TX = f"WITH t AS ({fx.TRANSITIONS})"


@query(f"{_TX} SELECT DISTINCT a.src AS a, a.dst AS b FROM t a JOIN t b ON a.src = b.dst AND a.dst = b.src WHERE a.src < a.dst")
def reciprocal_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return graph.reciprocal_pairs(fx.transitions(spark, sf))


@query(f"{_TX} SELECT src, dst, count(*) AS weight, min(relation) AS relation FROM t GROUP BY src, dst")
def simple_projection(spark: SparkSession, sf: str) -> DataFrame:
    return graph.simple_edges(fx.transitions(spark, sf))


@query(f"{_TX} SELECT CAST(sum(i.n * o.n) AS BIGINT) AS chains FROM (SELECT dst AS id, count(*) AS n FROM t GROUP BY dst) i JOIN (SELECT src AS id, count(*) AS n FROM t GROUP BY src) o USING (id)")
def two_hop_count(spark: SparkSession, sf: str) -> DataFrame:
    return graph.two_hop_count(fx.transitions(spark, sf))


@query(f"""{_TR}, e AS (SELECT count(*) AS edges, count(*) FILTER (src = dst) AS self_loops FROM t),
 n AS (SELECT count(*) AS nodes, count(*) FILTER (degree = 1) AS leaf_nodes, count(*) FILTER (in_degree = 0) AS head_only, count(*) FILTER (out_degree = 0) AS tail_only FROM d)
 SELECT *, round(edges / (CAST(nodes AS DOUBLE) * (nodes - 1)), 8) AS density FROM e, n""")
def graph_quality(spark: SparkSession, sf: str) -> DataFrame:
    return graph.quality(fx.triples(spark, sf))


@query(f"WITH t AS ({fx.TRIPLES}) SELECT 'head' AS side, id FROM (SELECT src AS id FROM t EXCEPT SELECT dst FROM t) UNION ALL SELECT 'tail', id FROM (SELECT dst AS id FROM t EXCEPT SELECT src FROM t)")
def head_tail_only(spark: SparkSession, sf: str) -> DataFrame:
    t = fx.triples(spark, sf)
    return graph.head_only(t).select(F.lit("head").alias("side"), "id").union(graph.tail_only(t).select(F.lit("tail"), "id"))


@query(f"""WITH t AS ({fx.TRIPLES}), m AS (SELECT DISTINCT id, source_doc_id, source_chunk_id FROM (SELECT src AS id, source_doc_id, source_chunk_id FROM t UNION ALL SELECT dst, source_doc_id, source_chunk_id FROM t))
 SELECT round(avg(n), 6) AS avg_texts_per_node, max(n) AS max_texts_per_node, (SELECT round(avg(n), 6) FROM (SELECT count(*) AS n FROM m GROUP BY source_doc_id, source_chunk_id)) AS avg_nodes_per_text FROM (SELECT count(*) AS n FROM m GROUP BY id)""")
def provenance_fan(spark: SparkSession, sf: str) -> DataFrame:
    m = fx.triples(spark, sf).select("source_doc_id", "source_chunk_id", F.explode(F.array("src", "dst")).alias("id")).distinct()
    nodes = m.groupBy("id").agg(F.count("*").alias("n")).agg(F.round(F.avg("n"), 6).alias("avg_texts_per_node"), F.max("n").alias("max_texts_per_node"))
    texts = m.groupBy("source_doc_id", "source_chunk_id").agg(F.count("*").alias("n")).agg(F.round(F.avg("n"), 6).alias("avg_nodes_per_text"))
    return nodes.crossJoin(texts)  # one row each


#: Every status, some in lower case and with blanks, one unknown.
_SEEN = "CASE (l_partkey + l_suppkey + l_linenumber) % 12 WHEN 0 THEN 'MAPPED' WHEN 1 THEN 'VALID' WHEN 2 THEN ' success ' WHEN 3 THEN 'EMPTY' WHEN 4 THEN 'invalid' WHEN 5 THEN 'FAILED' WHEN 6 THEN 'TIMEOUT' WHEN 7 THEN 'RATE_LIMITED' WHEN 8 THEN 'NOT_REQUESTED' WHEN 9 THEN 'MISSING' WHEN 10 THEN 'PENDING' END"
_RANKED = "CASE upper(trim(status)) WHEN 'MAPPED' THEN 60 WHEN 'VALID' THEN 55 WHEN 'SUCCESS' THEN 50 WHEN 'EMPTY' THEN 40 WHEN 'INVALID' THEN 30 WHEN 'FAILED' THEN 20 WHEN 'TIMEOUT' THEN 20 WHEN 'RATE_LIMITED' THEN 20 WHEN 'NOT_REQUESTED' THEN 10 ELSE 0 END"
_NAMED = "CASE max(k) WHEN 60 THEN 'MAPPED' WHEN 55 THEN 'VALID' WHEN 50 THEN 'SUCCESS' WHEN 40 THEN 'EMPTY' WHEN 30 THEN 'INVALID' WHEN 20 THEN 'RATE_LIMITED' WHEN 10 THEN 'NOT_REQUESTED' ELSE 'MISSING' END"
#: Few runs of each name, so that every status is the best of some.
_RUN_NAME = "concat(CAST(l_orderkey AS STRING), '-', CAST(l_linenumber % 3 AS STRING))"


@query(f"SELECT name, {_NAMED} AS status FROM (SELECT name, {_RANKED} AS k FROM (SELECT {_RUN_NAME} AS name, {_SEEN} AS status FROM lineitem)) GROUP BY name")
def best_status(spark: SparkSession, sf: str) -> DataFrame:
    rows = fx.table(spark, sf, "lineitem").selectExpr(f"{_RUN_NAME} AS name", f"{_SEEN} AS status")
    return kg.best_status(rows, ["name"], "status")


@query(f"""SELECT name, node_type, {_NAMED} AS mapping_status, CAST(max(c) AS INTEGER) AS concept_count FROM (SELECT name, node_type, c, {_RANKED} AS k FROM (
 SELECT {_RUN_NAME} AS name, CASE l_linestatus WHEN 'F' THEN 'entity' ELSE 'event' END AS node_type, l_linenumber AS c, {_SEEN} AS status FROM lineitem)) GROUP BY name, node_type""")
def global_coverage(spark: SparkSession, sf: str) -> DataFrame:
    """The coverage of several runs as one."""
    rows = fx.table(spark, sf, "lineitem").selectExpr(f"concat(' ', {_RUN_NAME}) AS name", "if(l_linestatus = 'F', 'Entity ', 'event') AS node_type", f"{_SEEN} AS mapping_status", "l_linenumber AS concept_count")
    return kg.global_coverage(rows.union(rows.limit(0)).union(rows.withColumn("name", F.lit(" "))))


_ALL_EDGES = f"SELECT t.*, l.* FROM ({fx.TRIPLES}) t JOIN (SELECT l_orderkey, l_linenumber, {_SEEN} AS status, l_linenumber AS c FROM lineitem) l ON CAST(l.l_orderkey AS STRING) = source_doc_id AND l.l_linenumber >= source_chunk_id"


@query(f"""SELECT src, dst, relation, stage AS edge_type, source_doc_id, source_chunk_id, {_NAMED} AS src_concept_status, {_NAMED} AS dst_concept_status, {_NAMED} AS relation_concept_status,
 CAST(max(c) AS INTEGER) AS src_concept_count, CAST(max(c) AS INTEGER) AS dst_concept_count, CAST(max(c) AS INTEGER) AS relation_concept_count FROM (SELECT *, {_RANKED} AS k FROM ({_ALL_EDGES})) GROUP BY ALL""")
def global_edges(spark: SparkSession, sf: str) -> DataFrame:
    """Enriched edges of several runs as one."""
    runs = fx.table(spark, sf, "lineitem").selectExpr("CAST(l_orderkey AS STRING) AS source_doc_id", "l_linenumber", f"{_SEEN} AS status")
    rows = fx.triples(spark, sf).withColumnRenamed("stage", "edge_type").join(runs, "source_doc_id").where("l_linenumber >= source_chunk_id")
    ends = ("src", "dst", "relation")
    return kg.global_edges(rows.select("*", *(F.col("status").alias(f"{e}_concept_status") for e in ends), *(F.col("l_linenumber").alias(f"{e}_concept_count") for e in ends)))


_IDX = "list_sort(list(degree), 'DESC') AS d, count(*) AS n, round(avg(degree), 2) AS a, max(in_degree) AS i, max(out_degree) AS o"


@query(f"{_TR} SELECT n AS nodes, d[1] AS degree_max, a AS degree_avg, d[n // 2 + 1] AS degree_median, d[CAST(floor(n * 0.05) AS BIGINT) + 1] AS degree_p95, d[CAST(floor(n * 0.01) AS BIGINT) + 1] AS degree_p99, CAST(i AS BIGINT) AS max_in_degree, CAST(o AS BIGINT) AS max_out_degree FROM (SELECT {_IDX} FROM d)")
def degree_summary(spark: SparkSession, sf: str) -> DataFrame:
    return graph.degree_summary(fx.triples(spark, sf))


_NODE = "SELECT DISTINCT src AS id, 'customer' AS k FROM t UNION SELECT DISTINCT dst, 'part' FROM t"


@query(f"""{_TR}, n AS ({_NODE}), f AS (SELECT (SELECT count(*) FROM n) AS nodes, count(*) AS edges, count(DISTINCT (src, relation, dst, stage)) AS triples, count(DISTINCT (src, dst)) AS pairs, count(DISTINCT relation) AS relations FROM t),
 c AS (WITH RECURSIVE p AS (SELECT DISTINCT src AS a, dst AS b FROM t UNION SELECT DISTINCT dst, src FROM t), r(id, k) AS (SELECT min(id), min(id) FROM n UNION SELECT p.b, r.k FROM r JOIN p ON p.a = r.id) SELECT count(*) AS size FROM r)
 SELECT 'counts' AS metric, unnest(['triple_nodes', 'triple_edges', 'distinct_semantic_triples', 'distinct_directed_pairs', 'relations', 'reciprocal_directed_pairs']) AS key, CAST(unnest([nodes, edges, triples, pairs, relations, 0]) AS DOUBLE) AS value FROM f
 UNION ALL SELECT 'node_type', k, CAST(count(*) AS DOUBLE) FROM n GROUP BY k UNION ALL SELECT 'edge_type', stage, CAST(count(*) AS DOUBLE) FROM t GROUP BY stage
 UNION ALL SELECT 'density', unnest(['directed_density_by_rows', 'directed_density_by_distinct_pairs', 'avg_degree_by_rows', 'avg_degree_by_distinct_pairs']),
  unnest([round(edges / (CAST(nodes AS DOUBLE) * (nodes - 1)), 8), round(pairs / (CAST(nodes AS DOUBLE) * (nodes - 1)), 8), round(2.0 * edges / nodes, 6), round(2.0 * pairs / nodes, 6)]) FROM f
 UNION ALL SELECT 'degree', unnest(['zero_degree_nodes', 'avg_degree', 'max_degree', 'p50_degree', 'p90_degree', 'p99_degree']), unnest([0.0, round(avg(degree), 6), CAST(max(degree) AS DOUBLE), CAST(quantile_disc(degree, 0.5) AS DOUBLE), CAST(quantile_disc(degree, 0.9) AS DOUBLE), CAST(quantile_disc(degree, 0.99) AS DOUBLE)]) FROM d
 UNION ALL SELECT 'components', unnest(['components', 'largest_component', 'isolated_nodes']), CAST(unnest([CASE WHEN size = nodes THEN 1 ELSE -1 END, size, 0]) AS DOUBLE) FROM c, f
 UNION ALL (SELECT 'top_nodes', id, CAST(degree AS DOUBLE) FROM d ORDER BY degree DESC, id LIMIT 20)
 UNION ALL (SELECT 'top_relations', relation, CAST(count(*) AS DOUBLE) AS n FROM t GROUP BY relation ORDER BY n DESC, relation LIMIT 20)""")
def graph_report(spark: SparkSession, sf: str) -> DataFrame:
    """The graph is one component, which the SQL follows from its least node."""
    t = spooled(fx.triples(spark, sf).select("src", "dst", "relation", "stage"))
    nodes = spooled(t.select(F.expr("explode(array(named_struct('node_name', src, 'node_type', 'customer'), named_struct('node_name', dst, 'node_type', 'part')))").alias("n")).select("n.*").distinct())
    return graph.report(nodes, t.withColumnRenamed("stage", "edge_type"))


_PROV = f"SELECT DISTINCT node_name, concat(source_doc_id, '/', CAST(source_chunk_id AS STRING)) AS text_id FROM (SELECT src AS node_name, source_doc_id, source_chunk_id FROM ({fx.TRIPLES}) UNION ALL SELECT dst, source_doc_id, source_chunk_id FROM ({fx.TRIPLES}))"
_FAN = "SELECT round(avg(n), 6) AS a, CAST(max(n) AS DOUBLE) AS m, CAST(count(*) AS DOUBLE) AS c FROM (SELECT count(*) AS n FROM p GROUP BY {0})"
_ENRICHED = f"SELECT DISTINCT src, dst, relation, CASE WHEN src >= 'c5' THEN 'MAPPED' ELSE 'EMPTY' END AS s, CASE WHEN dst >= 'p5' THEN 'MAPPED' ELSE 'MISSING' END AS d, 'VALID' AS r FROM ({fx.TRIPLES})"


@query(f"""WITH p AS ({_PROV}), e AS ({_ENRICHED}), a AS ({_FAN.format('node_name')}), b AS ({_FAN.format('text_id')})
 SELECT 'provenance' AS metric, unnest(['avg_source_texts_per_node', 'max_source_texts_per_node', 'nodes_with_source_text']) AS key, unnest([a, m, c]) AS value FROM a
 UNION ALL SELECT 'provenance', unnest(['avg_nodes_per_text', 'max_nodes_per_text', 'text_nodes_with_edges']), unnest([a, m, c]) FROM b
 UNION ALL SELECT 'provenance', 'orphan_text_edges', CAST(count(*) AS DOUBLE) FROM p WHERE text_id LIKE '%/7'
 UNION ALL SELECT 'coverage_by_type_status', concat_ws('/', node_type, mapping_status), CAST(count(*) AS DOUBLE) FROM ({_COVERAGE}) GROUP BY 2
 UNION ALL SELECT 'src_concept_status', s, CAST(count(*) AS DOUBLE) FROM e GROUP BY s UNION ALL SELECT 'dst_concept_status', d, CAST(count(*) AS DOUBLE) FROM e GROUP BY d UNION ALL SELECT 'relation_concept_status', r, CAST(count(*) AS DOUBLE) FROM e GROUP BY r
 UNION ALL SELECT 'quality', 'orphan_enriched_src', CAST(count(*) AS DOUBLE) FROM e WHERE src < 'c3' UNION ALL SELECT 'quality', 'orphan_enriched_dst', CAST(count(*) AS DOUBLE) FROM e WHERE dst < 'c3'
 UNION ALL SELECT 'concept', 'orphan_concept_edges', CAST(count(*) AS DOUBLE) FROM (SELECT DISTINCT node_name, concept_id FROM ({_MAPPINGS}) WHERE concept_name < 'Brand#3')""")
def table_report(spark: SparkSession, sf: str) -> DataFrame:
    t = spooled(fx.triples(spark, sf).select("src", "dst", "relation", "source_doc_id", "source_chunk_id"))
    text = F.concat("source_doc_id", F.lit("/"), F.col("source_chunk_id").cast("string")).alias("text_id")
    text_edges = t.select(F.explode(F.array("src", "dst")).alias("node_name"), text).distinct()
    enriched = t.select("src", "dst", "relation").distinct().selectExpr("src", "dst", "relation", "if(src >= 'c5', 'MAPPED', 'EMPTY') AS src_concept_status", "if(dst >= 'p5', 'MAPPED', 'MISSING') AS dst_concept_status", "'VALID' AS relation_concept_status")
    mappings = kg.concept_mappings(_parsed(spark, sf))
    coverage = spooled(_coverage(spark, sf))
    concept_nodes, concept_edges = kg.concept_graph(mappings, coverage)
    return graph.table_report(t.select(text).where("text_id not like '%/7'").distinct(), text_edges, coverage, enriched, graph.vertices(t).selectExpr("id AS node_name").where("node_name >= 'c3'"), concept_nodes.where("name >= 'Brand#3'"), concept_edges)


# --- iterative algorithms; the SQL unrolls the same number of rounds


def _pagerank_sql(rounds: int, group: str = "") -> str:
    g, on = (f"{group}, ", f"{group}, ") if group else ("", "")
    part = f"PARTITION BY {group}" if group else ""
    ctes = [
        f"t AS MATERIALIZED ({fx.TRANSITIONS})",
        f"l AS MATERIALIZED (SELECT {g}src, dst, count(*) / sum(count(*)) OVER (PARTITION BY {on}src) AS share FROM t GROUP BY {g}src, dst)",
        f"v AS MATERIALIZED (SELECT {g}id, CAST(count(*) OVER ({part}) AS DOUBLE) AS n FROM (SELECT DISTINCT {g}id FROM (SELECT {g}src AS id FROM t UNION ALL SELECT {g}dst FROM t)))",
        f"b AS MATERIALIZED (SELECT v.*, NOT EXISTS (SELECT 1 FROM l WHERE l.src = v.id {'AND l.' + group + ' = v.' + group if group else ''}) AS sink FROM v)",
        f"r0 AS MATERIALIZED (SELECT {g}id, sink, n, 1 / n AS rank FROM b)",
    ]
    for k in range(rounds):
        same = f"AND l.{group} = r.{group}" if group else ""
        lost = f"(SELECT sum(CASE WHEN sink THEN rank ELSE 0 END) FROM r{k} {'WHERE r' + str(k) + '.' + group + ' = b.' + group if group else ''})"
        got = f"(SELECT l.{group + ', l.' if group else ''}dst, sum(rank * share) AS got FROM l JOIN r{k} r ON l.src = r.id {same} GROUP BY ALL) g"
        ctes.append(f"r{k + 1} AS MATERIALIZED (SELECT {'b.' + group + ', ' if group else ''}b.id, b.sink, b.n, 0.15 / b.n + 0.85 * (coalesce(got, 0) + {lost} / b.n) AS rank FROM b LEFT JOIN {got} ON g.dst = b.id {'AND g.' + group + ' = b.' + group if group else ''})")
    return f"WITH {', '.join(ctes)} SELECT {g}id, round(rank, 6) AS rank FROM r{rounds}"


@query(_pagerank_sql(20))
def pagerank(spark: SparkSession, sf: str) -> DataFrame:
    return graph.pagerank(fx.transitions(spark, sf), 20).select("id", F.round("rank", 6).alias("rank"))


@query(_pagerank_sql(10, "relation"))
def pagerank_by_stage(spark: SparkSession, sf: str) -> DataFrame:
    return graph.pagerank(fx.transitions(spark, sf), 10, group="relation").select("relation", "id", F.round("rank", 6).alias("rank"))


#: Stars (suppliers and customers with their nation) and long paths (the events of a user, each to the next).
_STARS = "SELECT concat('s', CAST(s_suppkey AS STRING)) AS node, s_nationkey AS k FROM supplier UNION ALL SELECT concat('c', CAST(c_custkey AS STRING)), c_nationkey FROM customer"
_PATHS = "SELECT concat('e', CAST(event_id AS STRING)) AS node, user_id AS k, count(*) OVER (PARTITION BY user_id) AS n FROM events"
_PARTS = f"""SELECT node, min(node) OVER (PARTITION BY k) AS component FROM ({_STARS} UNION ALL SELECT DISTINCT concat('n', CAST(k AS STRING)), k FROM ({_STARS}))
 UNION ALL SELECT node, min(node) OVER (PARTITION BY k) FROM ({_PATHS}) WHERE n > 1"""


def _links(spark, sf):
    s = fx.table(spark, sf, "supplier").selectExpr("concat('s', CAST(s_suppkey AS STRING)) AS src", "concat('n', CAST(s_nationkey AS STRING)) AS dst")
    stars = s.union(fx.table(spark, sf, "customer").selectExpr("concat('c', CAST(c_custkey AS STRING))", "concat('n', CAST(c_nationkey AS STRING))"))
    following = "lead(event_id) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS later"
    paths = fx.table(spark, sf, "events").selectExpr("event_id", following).where("later is not null").selectExpr("concat('e', CAST(event_id AS STRING))", "concat('e', CAST(later AS STRING))")
    return stars.union(paths)


@query(_PARTS)
def components(spark: SparkSession, sf: str) -> DataFrame:
    return contracted_components(_links(spark, sf))


@query(f"SELECT component, count(*) AS size FROM ({_PARTS}) GROUP BY component")
def component_sizes(spark: SparkSession, sf: str) -> DataFrame:
    return graph.component_sizes(_links(spark, sf))


@query(f"""WITH RECURSIVE e AS (SELECT DISTINCT src, dst FROM ({fx.TRANSITIONS}) WHERE src <> dst), v AS (SELECT src AS id FROM e UNION SELECT dst FROM e),
 reach(a, b) AS (SELECT id, id FROM v UNION SELECT a, dst FROM reach JOIN e ON b = src)
 SELECT x.a AS id, min(x.b) AS component FROM reach x JOIN reach y ON x.a = y.b AND x.b = y.a GROUP BY x.a""")
def strong_components(spark: SparkSession, sf: str) -> DataFrame:
    return graph.strong_components(fx.transitions(spark, sf))


_TRI = f"""WITH p AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM ({fx.TRANSITIONS}) WHERE src <> dst), d AS (SELECT id, count(*) AS degree FROM (SELECT a AS id FROM p UNION ALL SELECT b FROM p) GROUP BY id),
 c AS (SELECT x.a, x.b, y.b AS c FROM p x JOIN p y ON x.b = y.a JOIN p z ON z.a = x.a AND z.b = y.b), n AS (SELECT id, count(*) AS t FROM (SELECT a AS id FROM c UNION ALL SELECT b FROM c UNION ALL SELECT c FROM c) GROUP BY id)"""


@query(f"{_TRI} SELECT id, degree, coalesce(t, 0) AS triangles FROM d LEFT JOIN n USING (id)")
def triangles(spark: SparkSession, sf: str) -> DataFrame:
    return graph.triangles(fx.transitions(spark, sf))


@query(f"{_TRI} SELECT id, round(CASE WHEN degree > 1 THEN 2.0 * coalesce(t, 0) / (degree * (degree - 1)) ELSE 0 END, 8) AS coefficient FROM d LEFT JOIN n USING (id)")
def clustering(spark: SparkSession, sf: str) -> DataFrame:
    return graph.clustering(fx.transitions(spark, sf)).select("id", F.round("coefficient", 8).alias("coefficient"))


@query(f"{_TRI} SELECT round(sum(CASE WHEN degree > 1 THEN 2.0 * coalesce(t, 0) / (degree * (degree - 1)) ELSE 0 END) / (SELECT count(*) FROM (SELECT src FROM ({fx.TRANSITIONS}) UNION SELECT dst FROM ({fx.TRANSITIONS}))), 6) AS avg_clustering_coefficient FROM d LEFT JOIN n USING (id)")
def average_clustering(spark: SparkSession, sf: str) -> DataFrame:
    return graph.average_clustering(fx.transitions(spark, sf))


@query()
def communities(spark: SparkSession, sf: str) -> DataFrame:
    """Label propagation until it settles; the tests hold it against its own condition."""
    return graph.communities(fx.transitions(spark, sf))


def _lpa_sql(rounds: int) -> str:
    ctes = [f"t AS ({fx.TRANSITIONS})", "e AS MATERIALIZED (SELECT id, other, count(*) AS w FROM (SELECT src AS id, dst AS other FROM t UNION ALL SELECT dst, src FROM t) GROUP BY id, other)", "l0 AS (SELECT DISTINCT id, id AS label FROM e)"]
    for k in range(rounds):
        ctes.append(f"l{k + 1} AS MATERIALIZED (SELECT id, label FROM (SELECT id, label, row_number() OVER (PARTITION BY id ORDER BY votes DESC, label) AS r FROM (SELECT e.id, l.label, sum(w) AS votes FROM e JOIN l{k} l ON e.other = l.id GROUP BY e.id, l.label)) WHERE r = 1)")
    return f"WITH {', '.join(ctes)} SELECT * FROM l{rounds}"


@query(_lpa_sql(5))
def label_propagation(spark: SparkSession, sf: str) -> DataFrame:
    return graph.label_propagation(fx.transitions(spark, sf), 5)


def _bfs_sql(both: bool, start: str) -> str:
    edges = f"SELECT DISTINCT dst AS a, src AS b FROM ({fx.TRANSITIONS})" if not both else f"SELECT src AS a, dst AS b FROM ({fx.TRANSITIONS}) UNION SELECT dst, src FROM ({fx.TRANSITIONS})"
    ctes = [f"e AS MATERIALIZED ({edges})", f"b0 AS ({start})"]
    for k in range(6):
        ctes.append(f"b{k + 1} AS MATERIALIZED (SELECT source, id, min(dist) AS dist FROM (SELECT * FROM b{k} UNION ALL SELECT source, e.b, dist + 1 FROM b{k} JOIN e ON e.a = b{k}.id) GROUP BY source, id)")
    return f"WITH {', '.join(ctes)}"


_RANKS = f"SELECT id, rank FROM ({_pagerank_sql(20)}) ORDER BY rank DESC, id"
_TOP5 = f"SELECT id AS source, id, 0 AS dist FROM ({_RANKS} LIMIT 5)"


@query(f"{_bfs_sql(False, _TOP5)} SELECT id, source AS landmark, CAST(dist AS INTEGER) AS dist FROM b6")
def landmark_distances(spark: SparkSession, sf: str) -> DataFrame:
    """Hops to the five nodes of the highest rank."""
    edges = cut(fx.transitions(spark, sf))
    return graph.landmark_distances(edges, graph.top_pagerank(edges, 5).select("id"))


@query(f"{_bfs_sql(True, _TOP5)} SELECT CAST(max(dist) AS INTEGER) AS diameter_lower_bound FROM b6")
def diameter_bound(spark: SparkSession, sf: str) -> DataFrame:
    """From five of the ten nodes of the highest rank, those in the largest component. The SQL takes the graph as one component, as it is."""
    edges = spooled(fx.transitions(spark, sf).select("src", "dst"))
    return graph.diameter_bound(edges, cut(graph.giant_seeds(edges, graph.top_pagerank(edges, 10))))


def _hits_sql(rounds: int) -> str:
    ctes = [f"e AS MATERIALIZED (SELECT src, dst, CAST(count(*) AS DOUBLE) AS w FROM ({fx.TRANSITIONS}) GROUP BY src, dst)", "v AS (SELECT src AS id FROM e UNION SELECT dst FROM e)", "h0 AS (SELECT id, 1.0 AS x FROM v)"]
    for k in range(1, rounds + 1):
        ctes.append(f"a{k} AS MATERIALIZED (SELECT id, x / sum(x) OVER () AS x FROM (SELECT dst AS id, sum(x * w) AS x FROM e JOIN h{k - 1} ON id = src GROUP BY dst))")
        ctes.append(f"h{k} AS MATERIALIZED (SELECT id, x / sum(x) OVER () AS x FROM (SELECT src AS id, sum(x * w) AS x FROM e JOIN a{k} ON id = dst GROUP BY src))")
    return f"WITH {', '.join(ctes)} SELECT v.id, round(coalesce(h.x, 0), 6) AS hub, round(coalesce(a.x, 0), 6) AS authority FROM v LEFT JOIN h{rounds} h ON h.id = v.id LEFT JOIN a{rounds} a ON a.id = v.id"


@query(_hits_sql(20))
def hits(spark: SparkSession, sf: str) -> DataFrame:
    return graph.hits(fx.transitions(spark, sf), 20).select("id", F.round("hub", 6).alias("hub"), F.round("authority", 6).alias("authority"))


def _betweenness_sql(levels: int, k: int) -> str:
    ctes = [f"e AS MATERIALIZED (SELECT DISTINCT src, dst FROM ({fx.TRANSITIONS}) WHERE src <> dst)", f"v AS MATERIALIZED (SELECT src AS id FROM ({fx.TRANSITIONS}) UNION SELECT dst FROM ({fx.TRANSITIONS}))"]
    ctes.append(f"s0 AS MATERIALIZED (SELECT id AS s, id, 0 AS l, CAST(1 AS DOUBLE) AS p FROM (SELECT id FROM v ORDER BY sha256(id), id LIMIT {k}))")
    for i in range(1, levels + 1):
        seen = " UNION ALL ".join(f"SELECT s, id FROM s{j}" for j in range(i))
        ctes.append(f"s{i} AS MATERIALIZED (SELECT f.s, e.dst AS id, {i} AS l, sum(p) AS p FROM s{i - 1} f JOIN e ON e.src = f.id WHERE NOT EXISTS (SELECT 1 FROM ({seen}) x WHERE x.s = f.s AND x.id = e.dst) GROUP BY f.s, e.dst)")
    ctes.append(f"d{levels} AS MATERIALIZED (SELECT s, id, p, CAST(0 AS DOUBLE) AS d FROM s{levels})")
    for i in range(levels - 1, 0, -1):
        ctes.append(f"d{i} AS MATERIALIZED (SELECT a.s, a.id, a.p, coalesce(sum(a.p / b.p * (1 + b.d)), 0) AS d FROM s{i} a LEFT JOIN e ON e.src = a.id LEFT JOIN d{i + 1} b ON b.s = a.s AND b.id = e.dst GROUP BY a.s, a.id, a.p)")
    every = " UNION ALL ".join(f"SELECT * FROM d{i}" for i in range(1, levels + 1))
    return f"WITH {', '.join(ctes)}, n AS (SELECT CAST(count(*) AS DOUBLE) AS n FROM v) SELECT v.id, round(coalesce(x.d, 0) / ((n - 1) * (n - 2)) * n / least({k}, n), 6) AS betweenness FROM v CROSS JOIN n LEFT JOIN (SELECT id, sum(d) AS d FROM ({every}) WHERE s <> id GROUP BY id) x ON x.id = v.id"


@query(_betweenness_sql(6, 20))
def betweenness_sampled(spark: SparkSession, sf: str) -> DataFrame:
    edges = fx.transitions(spark, sf)
    return graph.betweenness(edges, cut(graph.hash_sample(graph.vertices(edges), 20))).select("id", F.round("betweenness", 6).alias("betweenness"))


@query()
def betweenness_500(spark: SparkSession, sf: str) -> DataFrame:
    """The whole job of betweenness_sampled: 500 sources, all nodes where the graph has no more. No SQL."""
    edges = fx.transitions(spark, sf)
    return graph.betweenness(edges, cut(graph.hash_sample(graph.vertices(edges), 500))).select("id", F.round("betweenness", 6).alias("betweenness"))
