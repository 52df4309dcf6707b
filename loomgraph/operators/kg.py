"""Relational construction of the knowledge graph: edges, nodes, provenance, context, concepts, embeddings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as tx
from loomgraph.session import cut, spooled

#: Relations whose counts are broadcast; more are joined by Spark's choice.
MOST_BROADCAST = 100_000
EDGE_KEY = ["src", "dst", "relation", "edge_type", "source_doc_id", "source_chunk_id"]


def triple_edges(structured: DataFrame) -> DataFrame:
    """All distinct edges of the three stages: triples of two stages, and events to their entities."""

    def triples(stage: str) -> Column:
        return F.transform(stage, lambda t: F.struct(F.trim(t["Head"]).alias("src"), F.trim(t["Tail"]).alias("dst"), F.trim(t["Relation"]).alias("relation"), F.lit(stage).alias("edge_type")))

    def taking_part(event: Column) -> Column:
        part = lambda e: F.struct(F.trim(event["Event"]).alias("src"), F.trim(e).alias("dst"), F.lit("is participated by").alias("relation"), F.lit("event_entity").alias("edge_type"))
        return F.transform(event["Entity"], part)

    items = F.concat(triples("entity_relation"), triples("event_relation"), F.flatten(F.transform("event_entity", taking_part)))
    rows = structured.select(F.explode(items).alias("t"), F.col("doc_id").alias("source_doc_id"), F.col("chunk_id").alias("source_chunk_id"))
    out = rows.select("t.src", "t.dst", "t.relation", "t.edge_type", "source_doc_id", "source_chunk_id")
    return out.where(tx.non_empty("src") & tx.non_empty("dst") & tx.non_empty("relation")).dropDuplicates(EDGE_KEY)


def triple_nodes(edges: DataFrame) -> DataFrame:
    """(node_name, node_type): entities are ends of entity relations and what takes part in events; a name may have both types."""
    ends = "array(named_struct('node_name', src, 'node_type', '{}'), named_struct('node_name', dst, 'node_type', '{}'))"
    kinds = F.expr(f"case edge_type when 'entity_relation' then {ends.format('entity', 'entity')} when 'event_relation' then {ends.format('event', 'event')} else {ends.format('event', 'entity')} end")
    return edges.select(F.explode(kinds).alias("n")).select("n.node_name", "n.node_type").distinct()


def text_nodes(structured: DataFrame, text: str = "original_text") -> DataFrame:
    return structured.where(tx.non_empty(text)).select(F.sha2(F.trim(text), 256).alias("text_id"), F.trim(text).alias("original_text")).distinct()


def text_edges(edges: DataFrame, chunk_texts: DataFrame) -> DataFrame:
    """(node_name, text_id, edge_type): where a node was found. chunk_texts: doc_id, chunk_id, original_text."""
    keyed = chunk_texts.where(tx.non_empty("original_text")).select(F.col("doc_id").alias("source_doc_id"), F.col("chunk_id").alias("source_chunk_id"), F.sha2(F.trim("original_text"), 256).alias("text_id"))
    ends = edges.select("source_doc_id", "source_chunk_id", F.explode(F.array("src", "dst")).alias("node_name")).distinct()
    return ends.join(keyed, ["source_doc_id", "source_chunk_id"]).select("node_name", "text_id", F.lit("Source").alias("edge_type")).distinct()


def missing_concepts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Every entity, event and relation that needs concepts: (name, node_type)."""
    return nodes.select(F.col("node_name").alias("name"), "node_type").union(edges.select("relation", F.lit("relation"))).distinct()


def orphans(rows: DataFrame, key: str, known: DataFrame, known_key: str) -> DataFrame:
    """Rows whose key is unknown."""
    return rows.join(known.select(F.col(known_key).alias(key)).distinct(), key, "left_anti")


def node_context(nodes: DataFrame, edges: DataFrame, top_k: int = 5, max_neighbors: int = 10, strategy: str = "hash", diverse: bool = True, max_chars: int = 1000, each_chars: int = 400) -> DataFrame:
    """node_name, node_type, predecessor_context, successor_context, context_text.

    hash: neighbours in the order of the hash of their text; relation_frequency: the rarest
    relations of all edges first. diverse: one neighbour for each relation of a node. A name of
    both types gets the same context.
    """
    k = max(1, min(top_k, max_neighbors))
    pairs = spooled(edges.groupBy("src", "relation", "dst").agg(F.count("*").alias("n")))
    if strategy == "relation_frequency":
        freq = cut(pairs.groupBy("relation").agg(F.sum("n").alias("freq")))
        few = freq.limit(MOST_BROADCAST + 1).count() <= MOST_BROADCAST
        pairs = pairs.join(F.broadcast(freq) if few else freq, "relation")
    else:
        pairs = pairs.withColumn("freq", F.lit(0).cast("bigint"))

    def side(node: str, other: str, out: str) -> DataFrame:
        # Rows move once, by node and without the texts; these are made where they are compared.
        df = pairs.select(F.col(node).alias("node_name"), F.col(other).alias("other"), "relation", "freq").where("node_name is not null").repartition("node_name")
        src, dst = (F.col("node_name"), F.col("other")) if node == "src" else (F.col("other"), F.col("node_name"))
        line = F.concat(src, F.lit(" --"), F.col("relation"), F.lit("--> "), dst)
        df = df.select("*", F.unhex(F.sha2(line, 256)).alias("h"))
        order = [F.col("freq"), F.col("h")]
        if diverse:
            df = df.withColumn("r", F.row_number().over(Window.partitionBy("node_name", "relation").orderBy(*order))).where("r = 1").drop("r")
        df = df.withColumn("r", F.row_number().over(Window.partitionBy("node_name").orderBy(*order))).where(F.col("r") <= k).select("node_name", "r", line.alias("ctx"))
        listed = F.transform(F.sort_array(F.collect_list(F.struct("r", "ctx"))), lambda x: x["ctx"])
        return df.groupBy("node_name").agg(F.substring(F.concat_ws(" | ", listed), 1, each_chars).alias(out))

    before, after = side("dst", "src", "predecessor_context"), side("src", "dst", "successor_context")
    df = nodes.join(before, "node_name", "left").join(after, "node_name", "left").fillna("", ["predecessor_context", "successor_context"])
    text = F.substring(F.concat_ws(" | ", F.nullif(F.col("predecessor_context"), F.lit("")), F.nullif(F.col("successor_context"), F.lit(""))), 1, max_chars)
    return df.select("node_name", "node_type", "predecessor_context", "successor_context", text.alias("context_text"))


def concept_requests(missing: DataFrame, context: DataFrame, prompts: DataFrame, model: str, context_version: str = "v1") -> DataFrame:
    """One request for each name and type; relations carry no context, others '' where they have none. prompts: node_type, template, prompt_version."""
    known = context.select(F.col("node_name").alias("name"), "node_type", "context_text").dropDuplicates(["name", "node_type"])
    df = missing.join(F.broadcast(prompts), "node_type").join(known, ["name", "node_type"], "left")
    text = F.when(F.col("node_type") == "relation", F.lit(None).cast("string")).otherwise(F.coalesce("context_text", F.lit("")))
    prompt = tx.fill(F.col("template"), node_name=F.col("name"), context_text=F.coalesce(text, F.lit("")))
    return df.select(
        tx.key_hash("name", "node_type", "prompt_version", F.lit(context_version), F.lit(model)).alias("concept_request_id"),
        F.col("name").alias("node_name"), "node_type", text.alias("context_text"), prompt.alias("prompt_text"), "prompt_version",
    )


def priorities(requests: DataFrame, edges: DataFrame) -> DataFrame:
    """Adds priority_score: the degree of a node, the frequency of a relation."""
    degree = edges.select(F.explode(F.array("src", "dst")).alias("node_name")).groupBy("node_name").agg(F.count("*").alias("degree"))
    freq = edges.groupBy(F.col("relation").alias("node_name")).agg(F.count("*").alias("freq"))
    df = requests.join(degree, "node_name", "left").join(freq, "node_name", "left")
    score = F.when(F.col("node_type") == "relation", F.col("freq")).otherwise(F.col("degree"))
    return df.withColumn("priority_score", F.coalesce(score, F.lit(0)).cast("bigint")).drop("degree", "freq")


def concept_quotas(limit: int, entity: int | None = None, event: int | None = None, relation: int | None = None) -> dict[str, int]:
    """Half entities, a fifth relations, the rest events, unless given; an excess is cut from relations, then events, then entities; a lack goes to entities."""
    q = {"entity": limit // 2 if entity is None else max(0, entity), "relation": limit // 5 if relation is None else max(0, relation)}
    q["event"] = max(0, limit - sum(q.values())) if event is None else max(0, event)
    over = sum(q.values()) - limit
    for kind in ("relation", "event", "entity"):
        cut = min(max(over, 0), q[kind])
        q[kind] -= cut
        over -= cut
    q["entity"] += max(0, limit - sum(q.values()))
    return q


def embedding_quotas(limit: int, text: int | None = None, node: int | None = None, edge: int | None = None) -> dict[str, int]:
    """At most 250 texts and 500 nodes, the rest edges, unless given; an excess is cut from texts, then nodes, then edges. A lack stays."""
    text = min(250, limit) if text is None else text
    node = min(500, max(0, limit - text)) if node is None else node
    edge = max(0, limit - text - node) if edge is None else edge
    q = {"text": max(0, text), "node": max(0, node), "edge": max(0, edge)}
    over = sum(q.values()) - limit
    for kind in q:
        cut = min(max(over, 0), q[kind])
        q[kind] -= cut
        over -= cut
    return q


def pick_by_quota(df: DataFrame, kind: str, quotas: dict[str, int], order: list[Column]) -> DataFrame:
    """The first rows of each kind, by its quota."""
    table = F.create_map(*(x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))))
    ranked = df.withColumn("type_rank", F.row_number().over(Window.partitionBy(kind).orderBy(*order)))
    return ranked.where(F.col("type_rank") <= F.coalesce(F.try_element_at(table, F.col(kind)), F.lit(0)))


def not_yet_done(df: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return df.join(done.select(key).distinct(), key, "left_anti")


def concept_mappings(parsed: DataFrame) -> DataFrame:
    """One row for each concept of a valid response (column concepts): with concept_id."""
    df = parsed.where("parse_status = 'VALID'").select("concept_request_id", "node_name", "node_type", F.explode("concepts").alias("concept_name"))
    return df.withColumn("concept_id", F.sha2(F.concat("concept_name", F.lit("_concept")), 256))


def concept_coverage(missing: DataFrame, requests: DataFrame, parsed: DataFrame, mappings: DataFrame) -> DataFrame:
    """How far each name has come: request_status, parse_status, mapping_status, concept_count."""
    req = requests.select(F.col("node_name").alias("name"), "node_type", "concept_request_id")
    raw = parsed.select("concept_request_id", F.col("status").alias("raw_status"), F.col("parse_status").alias("raw_parse"))
    counts = mappings.groupBy("concept_request_id").agg(F.countDistinct("concept_id").alias("n"))
    df = missing.join(req, ["name", "node_type"], "left").join(raw, "concept_request_id", "left").join(counts, "concept_request_id", "left")
    count = F.coalesce("n", F.lit(0)).cast("int")
    request = F.when(F.col("concept_request_id").isNull(), "MISSING_REQUEST").when(F.col("raw_status").isNull(), "NOT_RUN").otherwise(F.col("raw_status"))
    parse = F.when(F.col("raw_status").isNull(), "NOT_RUN").otherwise(F.coalesce("raw_parse", F.lit("NOT_RUN")))
    mapping = F.when(count > 0, "MAPPED").when(F.col("raw_status").isNull(), "PENDING").otherwise("UNMAPPED")
    return df.select("name", "node_type", "concept_request_id", request.alias("request_status"), parse.alias("parse_status"), mapping.alias("mapping_status"), count.alias("concept_count"))


def concept_graph(mappings: DataFrame, coverage: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Concept nodes (concept_id, name) and edges (src, dst, relation, edge_type) of mapped names."""
    mapped = coverage.where("mapping_status = 'MAPPED'").select("concept_request_id").distinct()
    rows = mappings.join(mapped, "concept_request_id", "left_semi")
    nodes = rows.select("concept_id", F.col("concept_name").alias("name")).distinct()
    edges = rows.select(F.col("node_name").alias("src"), F.col("concept_id").alias("dst"), F.lit("has_concept").alias("relation"), F.lit("Concept").alias("edge_type")).distinct()
    return nodes, edges


def primary_concepts(mappings: DataFrame) -> DataFrame:
    """The alphabetically first concept of each name and type, and how many there are."""
    return mappings.groupBy("node_name", "node_type").agg(F.min_by("concept_id", F.struct("concept_name", "concept_id")).alias("concept_id"), F.min("concept_name").alias("concept_name"), F.countDistinct("concept_id").alias("concept_count"))


def enrich_edges(edges: DataFrame, nodes: DataFrame, coverage: DataFrame, primary: DataFrame) -> DataFrame:
    """Edges with types, mapping statuses and primary concepts of both ends and the relation. A name of both types counts as an entity."""
    types = nodes.groupBy("node_name").agg(F.min("node_type").alias("node_type"))
    facts = coverage.select(F.col("name").alias("node_name"), "node_type", "mapping_status").join(primary.select("node_name", "node_type", "concept_id", F.col("concept_count")), ["node_name", "node_type"], "left").dropDuplicates(["node_name", "node_type"])

    def look(df: DataFrame, key: str, kind: Column, prefix: str) -> DataFrame:
        table = facts.select(F.col("node_name").alias(key), F.col("node_type").alias("_kind"), F.col("mapping_status").alias(f"{prefix}_status"), F.col("concept_id").alias(f"{prefix}_concept_id"), F.coalesce("concept_count", F.lit(0)).cast("int").alias(f"{prefix}_concept_count"))
        return df.withColumn("_kind", kind).join(table, [key, "_kind"], "left").drop("_kind").fillna(0, [f"{prefix}_concept_count"])

    df = edges.join(types.select(F.col("node_name").alias("src"), F.col("node_type").alias("src_type")), "src", "left").join(types.select(F.col("node_name").alias("dst"), F.col("node_type").alias("dst_type")), "dst", "left")
    df = look(look(look(df, "src", F.col("src_type"), "src"), "dst", F.col("dst_type"), "dst"), "relation", F.lit("relation"), "relation")
    return df


def node_inputs(nodes: DataFrame, context: DataFrame, model: str, max_chars: int = 2000) -> DataFrame:
    df = nodes.join(context.select("node_name", "node_type", "context_text").dropDuplicates(["node_name", "node_type"]), ["node_name", "node_type"], "left")
    text = F.concat(F.lit("Node: "), F.col("node_name"), F.lit("\nNode type: "), F.col("node_type"), F.lit("\nContext: "), F.coalesce("context_text", F.lit("")))
    return df.select(tx.key_hash("node_name", "node_type", F.lit(model)).alias("item_id"), F.lit("node").alias("item_type"), tx.truncate(text, max_chars).alias("text_for_embedding"))


def edge_inputs(edges: DataFrame, model: str, max_chars: int = 2000) -> DataFrame:
    text = F.concat(F.lit("Edge: "), F.col("src"), F.lit(" --"), F.col("relation"), F.lit("--> "), F.col("dst"))
    df = edges.select("src", "relation", "dst").distinct()
    return df.select(tx.key_hash("src", "relation", "dst", F.lit(model)).alias("item_id"), F.lit("edge").alias("item_type"), tx.truncate(text, max_chars).alias("text_for_embedding"))


def text_inputs(texts: DataFrame, model: str, max_chars: int = 2000) -> DataFrame:
    return texts.select(F.col("text_id").alias("item_id"), F.lit("text").alias("item_type"), tx.truncate("original_text", max_chars).alias("text_for_embedding"))


def select_inputs(inputs: DataFrame, done: DataFrame, limit: int, quotas: dict[str, int], parts: int | None = None) -> DataFrame:
    """What to embed next: by the quotas of the types, then filled up with the others; at most limit rows.

    phase (0 quota, 1 filler), type_rank and item_id give the order.
    """
    left = not_yet_done(inputs, done, "item_id").select(*inputs.columns)
    # Of each type only the first `limit` can be selected: first those of each of its parts, then those of the type.
    # Below 1,000 Spark keeps only so many of a part before rows move, and few parts leave least.
    parts = parts or (16 if limit < 1000 else 256)
    part = left.withColumn("_part", F.pmod(F.xxhash64("item_id"), F.lit(parts)))
    first = part.withColumn("_r", F.row_number().over(Window.partitionBy("item_type", "_part").orderBy("item_id"))).where(F.col("_r") <= limit).drop("_r", "_part")
    ranked = first.withColumn("type_rank", F.row_number().over(Window.partitionBy("item_type").orderBy("item_id")))
    table = F.create_map(*(x for k, v in quotas.items() for x in (F.lit(k), F.lit(v))))
    phase = F.when(F.col("type_rank") <= F.coalesce(F.try_element_at(table, F.col("item_type")), F.lit(0)), 0).otherwise(1)
    return ranked.withColumn("phase", phase).orderBy("phase", "type_rank", "item_type", "item_id").limit(limit)


def embedding_coverage(inputs: DataFrame, results: DataFrame, existing: DataFrame) -> DataFrame:
    """item_id, item_type, embedding_status: this run beats earlier ones; SUCCESS counts as EMBEDDED."""
    as_status = lambda c: F.when(c == "SUCCESS", "EMBEDDED").otherwise(c)
    now = results.select("item_id", as_status(F.col("status")).alias("now"))
    old = existing.select("item_id", F.col("embedding_status").alias("old"))
    return inputs.select("item_id", "item_type").join(now, "item_id", "left").join(old, "item_id", "left").select("item_id", "item_type", F.coalesce("now", "old", F.lit("PENDING")).alias("embedding_status"))


def newest(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row for each key, the first in order."""
    return rows.withColumn("_r", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_r = 1").drop("_r")


# The rank of each status over runs. Unknown ones rank 0.
STATUS_RANK = {"MAPPED": 60, "VALID": 55, "SUCCESS": 50, "EMPTY": 40, "INVALID": 30, "FAILED": 20, "TIMEOUT": 20, "RATE_LIMITED": 20, "NOT_REQUESTED": 10, "MISSING": 0}
#: The name of a rank: of equal ranks the last one above.
_RANK_NAME = {rank: status for status, rank in STATUS_RANK.items()}


def _mapped(table: dict, key: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for item in table.items() for x in item)), key)


def best_over_runs(rows: DataFrame, keys: list[str], statuses: list[str], counts: list[str] = ()) -> DataFrame:
    """One row for each key: the best of each status (trimmed, in any case) and the greatest of each count over all runs."""
    rank = lambda c: F.coalesce(_mapped(STATUS_RANK, F.upper(F.trim(F.col(c)))), F.lit(0))
    best = rows.groupBy(*keys).agg(*(F.max(rank(c)).alias(c) for c in statuses), *(F.max(F.col(c).cast("int")).alias(c) for c in counts))
    return best.select(*keys, *(_mapped(_RANK_NAME, F.col(c)).alias(c) for c in statuses), *counts)


def best_status(rows: DataFrame, keys: list[str], status: str) -> DataFrame:
    """The best status of each key over all runs, as `status`."""
    return best_over_runs(rows, keys, [status]).withColumnRenamed(status, "status")


def global_coverage(coverage: DataFrame) -> DataFrame:
    """The coverage of all runs as one: name, node_type, mapping_status, concept_count."""
    rows = coverage.select(F.trim("name").alias("name"), F.lower(F.trim("node_type")).alias("node_type"), "mapping_status", "concept_count").where(tx.non_empty("name"))
    return best_over_runs(rows, ["name", "node_type"], ["mapping_status"], ["concept_count"])


def global_edges(enriched: DataFrame) -> DataFrame:
    """The enriched edges of all runs as one, with the best statuses and greatest concept counts of src, dst and relation."""
    ends = ("src", "dst", "relation")
    return best_over_runs(enriched, EDGE_KEY, [f"{e}_concept_status" for e in ends], [f"{e}_concept_count" for e in ends])
