"""Ingestion: change detection, state, links, manifests, quality gate, contracts, source registry."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from loomgraph.functions import text as tx

STATUSES = ("NEW", "UPDATED", "SKIPPED_UNCHANGED")


def changes(incoming: DataFrame, state: DataFrame, key: str = "normalized_url") -> DataFrame:
    """incoming with change: NEW without a known state; equal content hashes decide where both are there; else equal
    etags or modification times mean unchanged; else UPDATED. previous_object_key comes from the state."""
    old = state.select(key, *(F.col(c).alias(f"_{c}") for c in ("content_hash", "etag", "last_modified", "object_key")))
    df = incoming.join(old.withColumn("_known", F.lit(True)), key, "left")
    both = F.col("content_hash").isNotNull() & F.col("_content_hash").isNotNull()
    same = F.coalesce(F.col("etag") == F.col("_etag"), F.lit(False)) | F.coalesce(F.col("last_modified") == F.col("_last_modified"), F.lit(False))
    unchanged = F.when(both, F.col("content_hash") == F.col("_content_hash")).otherwise(same)
    change = F.when(F.col("_known").isNull(), "NEW").when(unchanged, "SKIPPED_UNCHANGED").otherwise("UPDATED")
    return df.select(*incoming.columns, change.alias("change"), F.col("_object_key").alias("previous_object_key"))


def keep_object_key(changed: DataFrame, key_col: str = "object_key") -> DataFrame:
    """Unchanged pages keep the key of their stored object."""
    return changed.withColumn(key_col, F.when(F.col("change") == "SKIPPED_UNCHANGED", F.coalesce("previous_object_key", key_col)).otherwise(F.col(key_col)))


def upsert(state: DataFrame, rows: DataFrame, key: str, order: str) -> DataFrame:
    """The newest row of each key; of equal times the incoming one."""
    both = state.withColumn("_new", F.lit(0)).unionByName(rows.withColumn("_new", F.lit(1)), allowMissingColumns=True)
    w = Window.partitionBy(key).orderBy(F.desc("_new"), F.desc_nulls_last(order))
    return both.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r", "_new")


def page_links(pages: DataFrame, domains: list[str], deny: list[str] = ()) -> DataFrame:
    """page_id, link (absolute, normalised, distinct) and its class."""
    raw = pages.select("page_id", "url", F.explode(tx.html_links("html")).alias("href")).where(F.trim("href") != "")
    df = raw.select("page_id", tx.normalize_url(tx.absolute_url("href", "url")).alias("link")).distinct()
    return df.withColumn("link_class", tx.url_class("link", domains, list(deny)))


def per_source_cap(frontier: DataFrame, source: str, order: list[str], cap: int) -> DataFrame:
    """A crawl budget: the first `cap` pages of each source."""
    w = Window.partitionBy(source).orderBy(*order)
    return frontier.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= cap).drop("_r")


def new_references(found: DataFrame, manifest: DataFrame, key: str = "normalized_url") -> DataFrame:
    """References that the manifest doesn't have, each once."""
    return found.dropDuplicates([key]).join(manifest.select(key).distinct(), key, "left_anti")


def manifest(records: DataFrame) -> DataFrame:
    """Long-format counts of a feed: by record type, crawl status, and in all."""
    def part(name: str, col: str) -> DataFrame:
        return records.groupBy(F.col(col).alias("key")).agg(F.count("*").alias("value")).select(F.lit(name).alias("metric"), "key", "value")

    return part("record_type", "record_type").union(part("crawl_status", "crawl_status")).union(records.agg(F.count("*").alias("value")).select(F.lit("records"), F.lit("all"), "value"))


def ratio(good: Column, of: Column) -> Column:
    return F.when(of == 0, 1.0).otherwise(good / of)


THRESHOLDS = {"title_ratio": 0.95, "preview_ratio": 0.9, "metadata_ratio": 0.98, "object_ratio": 1.0}


def quality_report(records: DataFrame, objects: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """metric, value, threshold, passed over the html pages of a feed. objects: object_key, valid (stored and well-formed)."""
    limits = THRESHOLDS | (thresholds or {})
    pages = records.where("record_type = 'html_page'").join(objects.select("object_key", F.col("valid").alias("_valid")).dropDuplicates(["object_key"]), "object_key", "left")
    n = F.count("*")
    facts = pages.agg(
        ratio(F.count_if(tx.non_empty("title")), n).alias("title_ratio"), ratio(F.count_if(tx.non_empty("text_preview")), n).alias("preview_ratio"),
        ratio(F.count_if(tx.non_empty("object_key") & tx.non_empty("crawl_status")), n).alias("metadata_ratio"), ratio(F.count_if(F.coalesce("_valid", F.lit(False))), n).alias("object_ratio"),
    )
    rows = facts.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.round(F.col(m).cast("double"), 6).alias("value"), F.lit(float(t)).alias("threshold")) for m, t in limits.items()))).alias("m")).select("m.*")
    return rows.withColumn("passed", F.col("value") >= F.col("threshold"))


def log_summary(lines: DataFrame, classes: dict[str, str]) -> DataFrame:
    """class, lines: how many log lines hold each marker."""
    return lines.select(F.explode(F.array_compact(F.array(*(F.when(F.col("value").contains(m), F.lit(c)) for c, m in classes.items())))).alias("class")).groupBy("class").agg(F.count("*").alias("lines"))


def failed_urls(lines: DataFrame, n: int = 20) -> DataFrame:
    """The first n distinct URLs of error lines (n, value)."""
    found = lines.where(F.col("value").contains("ERROR")).select("n", F.regexp_extract("value", r"(https?://[^\s>)\"']+)", 1).alias("url")).where("url <> ''")
    return found.groupBy("url").agg(F.min("n").alias("n")).orderBy("n").limit(n)


def html_contract(rows: DataFrame, known: list[str] | None = None) -> DataFrame:
    """rows with violation: the first broken rule of a stored page, null if none. known: allowed columns (others are a violation)."""
    extra = [c for c in rows.columns if known is not None and c not in known]
    rule = F.when(F.lit(bool(extra)), "extra_field: " + ",".join(extra)).when(~tx.non_empty("doc_id"), "doc_id").when(~F.coalesce(F.col("url").rlike("^https?://[^/?#]+"), F.lit(False)), "url")
    rule = rule.when(~tx.non_empty("title"), "title").when(~F.coalesce(F.col("http_status").between(100, 599), F.lit(False)), "http_status").when(~F.coalesce(F.length("content_hash") == 64, F.lit(False)), "content_hash")
    return rows.withColumn("violation", rule.when(~F.coalesce(F.col("content_length") >= 0, F.lit(False)), "content_length"))


def nonblank_lines(lines: DataFrame) -> DataFrame:
    return lines.where(F.trim("value") != "").agg(F.count("*").alias("lines"))


def object_keys(records: DataFrame) -> DataFrame:
    """Distinct object keys of html pages, with the place of their first appearance (column n)."""
    return records.where((F.col("record_type") == "html_page") & tx.non_empty("object_key")).groupBy("object_key").agg(F.min("n").alias("first_seen"))


_ID = re.compile(r"[a-z0-9]+(-[a-z0-9]+)*")


def registry(config: dict) -> list[dict]:
    """Sources of a registry with the defaults merged in; a ValueError names what is wrong."""
    if not config.get("version"):
        raise ValueError("version is missing")
    defaults, seen, out = config.get("defaults") or {}, set(), []
    for raw in config.get("sources") or []:
        source = {**defaults, **raw}
        for field in ("allowed_domains", "deny_patterns", "pdf_patterns"):
            values = [*(defaults.get(field) or []), *(raw.get(field) or [])]
            source[field] = list(dict.fromkeys(v.strip().lower() if field == "allowed_domains" else v.strip() for v in values if v.strip()))
        if not _ID.fullmatch(source.get("id", "")):
            raise ValueError(f"source id {source.get('id')!r} must be kebab case")
        if source["id"] in seen:
            raise ValueError(f"source id {source['id']} is used twice")
        seen.add(source["id"])
        for url in source.get("start_urls") or []:
            host = re.sub(r"^[a-z]+://([^/:?#]+).*$", r"\1", url.lower())
            if not any(host == d or host.endswith("." + d) for d in source["allowed_domains"]):
                raise ValueError(f"{url} is outside the allowed domains")
        out.append({"enabled": True, **source})
    return out


def selected(sources: list[dict], selector: str | None) -> list[dict]:
    """all, * or blank: every enabled source; else the one with this id."""
    if (selector or "").strip().lower() in ("", "all", "*"):
        return [s for s in sources if s["enabled"]]
    found = [s for s in sources if s["id"] == selector.strip()]
    if not found:
        raise ValueError(f"no source {selector}")
    return found
