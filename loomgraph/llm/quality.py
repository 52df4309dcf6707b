"""Quality classification with supervised subword embeddings.

A document is the bag of its words (split at white space, A-Z lower-cased), the character
n-grams of its words (with borders marked) and its word bigrams, each hashed into one of
`buckets` learned vectors. The vectors are averaged over the document and a softmax over
the two labels follows; vectors and output are trained together in numpy by stochastic
gradient descent.

Since the output is linear in the mean, a bucket acts through one number (the difference of
its two logits); scoring adds these numbers, kept for each word in a bounded cache. Whole
texts are scored, however long. The model is fitted on a bounded sample of labelled rows (`sample_docs`
ids with the smallest hashes) by `updates` steps, whatever the size of the tables; of repeated
ids one row teaches. A text without words (null, empty) gets the score of the output's bias. Without
labelled rows every score is 0.5. Repeated rows are scored each; empty tables give empty tables;
columns other than the id, the text and the label are not read.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._common import WordCache, bounded_sample, doc_columns, remainder, sigmoid, steps, utf8
from loomgraph.session import prepare

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_LOWER).split() if text else []


def subwords(word: bytes, buckets: int, shortest: int = 3, longest: int = 5) -> list[int]:
    """Buckets of the word itself and of its n-grams of whole characters (their UTF-8)."""
    marked = b"<" + word + b">"
    cuts = range(len(marked) + 1) if word.isascii() else [k for k, b in enumerate(marked) if b & 0xC0 != 0x80] + [len(marked)]
    return [zlib.crc32(word) % buckets] + [zlib.crc32(marked[a:b], n) % buckets for n in range(shortest, longest + 1) for a, b in zip(cuts, cuts[n:], strict=False)]


def _bigrams(h: np.ndarray, buckets: int) -> np.ndarray:
    return (((h[:-1].astype(np.uint64) * _MIX) ^ h[1:].astype(np.uint64)) * _MIX >> np.uint64(40)).astype(np.int64) % buckets


def bag(text: bytes | None, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Buckets and their counts over the whole text."""
    words = words_of(text)
    ids: list[int] = []
    for w in words:
        ids += subwords(w, buckets)
    h = np.fromiter(map(zlib.crc32, words), np.int64, len(words))
    return np.unique(np.concatenate([np.array(ids, np.int64), _bigrams(h, buckets)]), return_counts=True) if words else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class SubwordModel:
    def __init__(self, buckets: int, dim: int, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.buckets = buckets
        self.vectors = rng.uniform(-1 / dim, 1 / dim, (buckets, dim)).astype(np.float32)
        self.output = np.zeros((2, dim), np.float32)
        self.bias = np.zeros(2, np.float32)

    def train(self, bags: list[tuple[np.ndarray, np.ndarray]], y: np.ndarray, updates: int, rate: float, seed: int = 11) -> None:
        """One document an update; they are taken in random order, again and again."""
        rng, done = np.random.default_rng(seed), 0
        while bags and done < updates:
            for k in rng.permutation(len(bags))[: updates - done]:
                ids, counts = bags[k]
                lr = rate * (1 - done / updates)
                done += 1
                n = counts.sum()
                if not n:
                    continue
                share = (counts / n).astype(np.float32)
                mean = share @ self.vectors[ids]
                logits = self.output @ mean + self.bias
                p = np.exp(logits - logits.max())
                p /= p.sum()
                p[y[k]] -= 1
                back = self.output.T @ p
                self.output -= lr * np.outer(p, mean)
                self.bias -= 0.1 * lr * p
                self.vectors[ids] -= lr * share[:, None] * back * min(float(len(ids)), 100.0)

    def weights(self) -> tuple[np.ndarray, float]:
        """What a bucket adds to the mean's logit difference, and the bias."""
        w = self.output[1] - self.output[0]
        return (self.vectors @ w).astype(np.float64), float(self.bias[1] - self.bias[0])


def train_quality_model(docs: DataFrame, labels: DataFrame, label: str = "quality", sample_docs: int = 2500, buckets: int = 1 << 17, dim: int = 16, updates: int = 12_000, rate: float = 0.5) -> SubwordModel:
    """docs: doc_id, text; labels: doc_id and 0/1 in `label`, of rows that may teach."""
    prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    chosen = bounded_sample(known.groupBy("doc_id").agg(F.min("y").alias("y")), "doc_id", sample_docs)

    def run(batches):
        for batch in batches:
            for k, text in enumerate(utf8(batch.column(2))):
                ids, counts = bag(text, buckets)
                packed = ids.astype("<u4").tobytes() + counts.astype("<u8").tobytes()
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(k, 1), batch.column(1).slice(k, 1), pa.array([packed], pa.binary())], ["doc_id", "y", "bag"])

    rows = doc_columns(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    taken = rows.mapInArrow(run, "doc_id bigint, y int, bag binary").groupBy("doc_id", "y").agg(F.min("bag").alias("bag"))
    found = sorted((r.doc_id, r.y, bytes(r.bag)) for r in taken.toLocalIterator())  # sample_docs rows at most
    bags = [(np.frombuffer(b, "<u4", len(b) // 12).astype(np.int64), np.frombuffer(b, "<u8", len(b) // 12, len(b) // 12 * 4).astype(np.int64)) for _, _, b in found]
    model = SubwordModel(buckets, dim)
    model.train(bags, np.array([y for _, y, _ in found], int), updates, rate)
    return model


def score_quality(docs: DataFrame, model: SubwordModel) -> DataFrame:
    """doc_id, score: the probability of label 1."""
    spark = prepare(docs.sparkSession)
    weights, bias = model.weights()
    shared, buckets = spark.sparkContext.broadcast((weights.astype(np.float32), bias)), model.buckets  # 4 bytes a bucket

    def run(batches):
        w, b = shared.value

        def make(new: list[bytes]) -> dict:
            found = [subwords(x, buckets) for x in new]
            sums = [float(w[f].sum()) for f in found]
            return {"s": sums, "n": [len(f) for f in found], "h": [zlib.crc32(x) for x in new]}

        cache = WordCache(make, {"s": np.float64, "n": np.int64, "h": np.int64})
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in steps([len(t or b"") for t in texts]):
                words = [words_of(texts[k]) for k in part]
                cache.learn({x for ws in words for x in ws})
                scores = []
                for ws in words:
                    at = cache.rows(ws)
                    pairs = _bigrams(cache.table["h"][at], buckets) if len(ws) > 1 else np.zeros(0, np.int64)
                    n = cache.table["n"][at].sum() + len(pairs)
                    scores.append((cache.table["s"][at].sum() + w[pairs].sum(dtype=np.float64)) / n + b if n else b)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(part)), pa.array(sigmoid(np.array(scores)), pa.float64())], ["doc_id", "score"])

    return doc_columns(docs).mapInArrow(run, "doc_id bigint, score double")


def held_out_quality(docs: DataFrame, labels: DataFrame, folds: int = 3, held: int = 1, **params) -> DataFrame:
    """doc_id, held_out (crc32 of the id as text mod folds is held), score, predicted; held-out rows teach nothing."""
    model = train_quality_model(docs, labels.where(remainder(F.col("doc_id"), folds) != held), **params)
    scored = score_quality(docs, model)
    return scored.select("doc_id", (remainder(F.col("doc_id"), folds) == held).alias("held_out"), "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).cast("int").alias("predicted"))
