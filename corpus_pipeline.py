"""The corpus pipeline: toxicity, near-copy removal, benchmark decontamination, PII, BPE.

Each stage is a function of (spark, docs, sf_dir), works on all rows its predecessor kept and
gives a DataFrame that is written as Parquet and read again. All but the last return the
columns of docs, whatever these are named. Null and empty texts are documents like any other; copies
of one are a group of near copies. Rows with a null or repeated id are rows like any other.
"""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from loomgraph.llm import bpe, decontam, pii, queries, simhash, toxicity
from loomgraph.session import prepare, shared_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the chain calls toxic go; the chain learns from the labels."""
    chain = toxicity.train_toxicity(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score_toxicity(docs, chain, queries.TOXIC_AT, keep=True)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies (five-word shingles, similarity 0.8 or more) one row stays.

    It is the row of the least doc_id, nulls last, then of the least row hashes.
    """
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.drop_contaminated(docs, _table(spark, sf_dir, "benchmark"), queries.WINDOW)


def redact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is replaced by the name of its kind; n_chars is renewed."""
    return pii.redact_pii(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids (little-endian unsigned 32-bit integers), n_tokens."""
    return bpe.bpe_encode(docs, queries.ranks_path(), public_tokenizers.PATTERN)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("pii", redact),
    ("bpe", encode),
]

#: Learned models and XXH64 are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; what lies between two is written to the shared folder."""
    docs, folder = _table(spark, sf_dir, "documents"), f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs.write.parquet(f"{folder}/{k}")
            docs = spark.read.parquet(f"{folder}/{k}")
    return docs
