"""Change detection over a stream of page fetches.

Each micro-batch is compared with the newest version of the state table, and the merged
state becomes a new version. A batch that is run again writes the same version anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from loomgraph.operators.ingestion import changes, keep_object_key, upsert
from loomgraph.sources.catalog import Lake

STATE = "normalized_url string, content_hash string, etag string, last_modified string, object_key string, fetched_at timestamp"


def track_changes(pages: DataFrame, lake: Lake, checkpoint: str, state: str = "crawl.state", log: str = "crawl.changes") -> StreamingQuery:
    """pages: a streaming frame with the columns of STATE."""
    spark = lake.spark

    def step(batch: DataFrame, epoch: int) -> None:
        run = f"{epoch:012d}"
        before = [v for v in lake.versions(state) if v < run]
        known = lake.read(state, before[-1]) if before else spark.createDataFrame([], STATE)
        # Of several fetches of a page in one batch the newest counts.
        newest = upsert(batch.limit(0), batch, "normalized_url", "fetched_at").select(*batch.columns)
        found = keep_object_key(changes(newest, known)).persist()
        lake.write(found.drop("previous_object_key"), log, run)
        lake.write(upsert(known, found.select(*known.columns), "normalized_url", "fetched_at").select(*known.columns), state, run)
        found.unpersist()

    return pages.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
