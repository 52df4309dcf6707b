"""Toxicity by a classifier chain of linear models.

The categories are predicted in order; each is a logistic regression over the presence of
words and repeated stems in the whole text and over the probabilities of the categories before it. While
training, those earlier probabilities are out-of-fold predictions, so that a later model
sees them as noisy as they are on new documents.

The labels know one category (toxic). The categories before it are learned from the labelled rows:
spherical k-means parts the toxic rows by the features that mark them into `kinds` kinds, the largest
first, and a row's category k says if it is of kind k. The chain predicts kind 1, kind 2, ..., toxic.
The features of each link are selected from the training rows of each fold by their association
with the label.

The models are fitted on a bounded sample of labelled rows (`sample_docs` ids with the smallest
hashes, near copies of a taken row left out); of repeated ids one row teaches. Null and empty
texts have no words and get the intercepts' probabilities; texts of any length are read whole, in
time linear in them. Without labelled rows, or with one class only, nothing is toxic beyond the share
of that class. Repeated rows are scored each; empty tables give empty tables. Other columns, whatever
their names, are not read.
"""

from __future__ import annotations

import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._common import bounded_sample, lower_ascii_table, sigmoid, steps, utf8
from loomgraph.session import prepare

_WORDS = lower_ascii_table(lambda b: 97 <= b <= 122 or b >= 128)

#: Lengths of stems.
STEMS = (5, 6, 7)


def features_of(text: bytes | None) -> set[bytes]:
    """The distinct words of the whole text (letters, A-Z lower-cased), and its repeated stems.

    A stem is the first 5, 6 or 7 characters of a longer word; one that stands in the text at least
    k times (k = 2, 3) is the feature "k*stem". Forms of one word thus count together.
    """
    if not text:
        return set()
    counts = Counter(text.translate(_WORDS).split())
    stems: Counter[str] = Counter()
    for word, n in counts.items():
        if len(word) > STEMS[0]:
            chars = word.decode("utf-8", "replace")
            for k in STEMS:
                if len(chars) > k:
                    stems[chars[:k]] += n
    out = set(counts)
    for stem, n in stems.items():
        if n > 1:
            out.add(b"2*" + stem.encode())
            if n > 2:
                out.add(b"3*" + stem.encode())
    return out


def _logistic(x: np.ndarray, y: np.ndarray, penalty: float, rounds: int = 25) -> np.ndarray:
    """Weights, the intercept last, by damped Newton steps with an L2 penalty on all but the intercept."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w = np.zeros(x.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    ridge = np.full(x.shape[1], penalty)
    ridge[-1] = 1e-6
    loss = lambda w: float(np.logaddexp(0, x @ w).sum() - y @ (x @ w) + (ridge * w) @ w / 2)
    before = loss(w)
    for _ in range(rounds):
        p = sigmoid(x @ w)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (p - y) + ridge * w)
        while (after := loss(w - step)) > before and np.abs(step).max() > 1e-6:
            step /= 2
        w, before = w - step, after
        if np.abs(step).max() < 1e-6:
            break
    return w


class Link:
    """One category: its selected words (by hash) and weights; the last weights are of earlier categories and the intercept."""

    def __init__(self, docs: list[np.ndarray], y: np.ndarray, earlier: np.ndarray, least_z: float, most: int, least_docs: int, penalty: float):
        self.words = self.select(docs, y, least_z, most, least_docs)
        self.w = _logistic(np.hstack([self._presence(docs), earlier]), y.astype(float), penalty)

    @staticmethod
    def select(docs, y, least_z, most, least_docs) -> np.ndarray:
        n1, n0 = int(y.sum()), int((1 - y).sum())
        if not n1 or not n0:
            return np.zeros(0, np.uint32)
        every, at = np.unique(np.concatenate(docs), return_inverse=True)
        of = np.repeat(y, [len(d) for d in docs])
        a, b = np.bincount(at, weights=of, minlength=len(every)), np.bincount(at, weights=1 - of, minlength=len(every))
        share = (a + b + 1) / (n1 + n0 + 2)
        z = (a / n1 - b / n0) / np.sqrt(share * (1 - share) * (1 / n1 + 1 / n0))
        z[a + b < least_docs] = 0
        best = np.lexsort((every, -np.abs(z)))[:most]
        return np.sort(every[best[np.abs(z[best]) >= least_z]])

    def _presence(self, docs) -> np.ndarray:
        out = np.zeros((len(docs), len(self.words)))
        for row, d in zip(out, docs, strict=True):
            if len(self.words) and len(d):
                at = np.minimum(np.searchsorted(self.words, d), len(self.words) - 1)
                row[at[self.words[at] == d]] = 1
        return out

    def predict(self, docs, earlier: np.ndarray) -> np.ndarray:
        return sigmoid(np.hstack([self._presence(docs), earlier, np.ones((len(docs), 1))]) @ self.w)


def chain_names(kinds: int = 2) -> tuple[str, ...]:
    """The categories in the order in which they are predicted."""
    return (*(f"kind{k + 1}" for k in range(kinds)), "toxic")


def learn_kinds(docs: list[np.ndarray], toxic: np.ndarray, kinds: int, *select) -> list[np.ndarray]:
    """For each kind 0/1 of each document: toxic ones are parted by the features that mark them.

    The means start with equal shares of the documents along their first principal axis; a toxic
    document without such features is of the kind with the nearest mean, ties to the least number.
    """
    labels = [np.zeros(len(docs), int) for _ in range(kinds)]
    rows = np.flatnonzero(toxic)
    if not len(rows) or not kinds:
        return labels
    marks = Link.__new__(Link)
    marks.words = Link.select(docs, toxic, *select)
    x = marks._presence([docs[k] for k in rows])
    if x.shape[1]:
        x /= np.maximum(np.sqrt((x * x).sum(axis=1, keepdims=True)), 1e-9)
    of = np.zeros(len(rows), int)
    if x.any():
        axis = np.linalg.svd(x - x.mean(axis=0), full_matrices=False)[2][0]
        axis *= np.sign(axis[np.abs(axis).argmax()])
        of[np.lexsort((np.arange(len(x)), np.round(x @ axis, 9)))] = np.arange(len(x)) * kinds // len(x)
        for _ in range(20):
            centres = np.stack([x[of == k].mean(axis=0) if (of == k).any() else 0 * x[0] for k in range(kinds)])
            old, of = of, (x @ (centres / np.maximum(np.sqrt((centres**2).sum(axis=1, keepdims=True)), 1e-9)).T).argmax(axis=1)
            if (of == old).all():
                break
    by_size = np.argsort(-np.bincount(of, minlength=kinds), kind="stable")
    for label, k in zip(labels, by_size, strict=True):
        label[rows[of == k]] = 1
    return labels


class ClassifierChain:
    def __init__(self, kinds: int = 2, folds: int = 5, least_z: float = 6.0, most: int = 256, least_docs: int = 5, penalty: float = 0.3):
        self.names, self.folds, self.links = chain_names(kinds), folds, []
        self.select = (least_z, most, least_docs, penalty)

    def fit_toxic(self, docs: list[np.ndarray], toxic: np.ndarray, fold: np.ndarray) -> ClassifierChain:
        """Learns the kinds, then the chain."""
        kinds = learn_kinds(docs, toxic, len(self.names) - 1, *self.select[:3])
        return self.fit(docs, dict(zip(self.names, [*kinds, toxic], strict=True)), fold)

    def fit(self, docs: list[np.ndarray], labels: dict[str, np.ndarray], fold: np.ndarray) -> ClassifierChain:
        """docs: sorted word hashes of each; labels: 0/1 by category; fold: fold numbers."""
        earlier = np.zeros((len(docs), 0))
        for name in self.names:
            y = labels[name]
            self.links.append(Link(docs, y, earlier, *self.select) if len(docs) else None)
            out = np.zeros(len(docs))
            for k in range(self.folds):
                inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
                if len(outside) and len(inside):
                    link = Link([docs[i] for i in inside], y[inside], earlier[inside], *self.select)
                    out[outside] = link.predict([docs[i] for i in outside], earlier[outside])
            earlier = np.hstack([earlier, out[:, None]])
        self.out_of_fold = earlier
        return self

    def predict(self, docs: list[np.ndarray]) -> np.ndarray:
        """(documents, categories): probabilities along the chain."""
        p = np.zeros((len(docs), 0))
        for link in self.links:
            p = np.hstack([p, (link.predict(docs, p) if link else np.zeros(len(docs)))[:, None]])
        return p


def _hashed(words) -> np.ndarray:
    return np.unique(np.fromiter(map(zlib.crc32, words), np.uint32, len(words)))


def _sketch(text: bytes | None) -> bytes:
    """The 4 smallest hashes of the five-word shingles."""
    words = text.translate(_WORDS).split() if text else []
    hashes = {xxhash.xxh64_intdigest(b" ".join(words[i : i + 5]), 42) for i in range(max(1, len(words) - 4))}
    return np.array(sorted(hashes)[:4], "<u8").tobytes()


def train_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = 6000, **params) -> ClassifierChain:
    """docs: doc_id, text; labels: doc_id, toxic (0/1)."""
    prepare(docs.sparkSession)
    known = labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("toxic").cast("int").alias("y")).where("doc_id is not null and y in (0, 1)")
    chosen = bounded_sample(known.groupBy("doc_id").agg(F.max("y").alias("y")), "doc_id", sample_docs)

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(2))
            packed = [_sketch(t).ljust(32, b"\xff") + _hashed(features_of(t)).astype("<u4").tobytes() for t in texts]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(packed, pa.binary())], ["doc_id", "y", "f"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "y", "text")
    taken = rows.mapInArrow(run, "doc_id bigint, y int, f binary").groupBy("doc_id", "y").agg(F.min("f").alias("f"))
    found = sorted((r.doc_id, r.y, bytes(r.f)) for r in taken.toLocalIterator())  # sample_docs rows at most
    seen: dict[bytes, int] = {}
    ids, y, words = [], [], []
    for doc, label, f in found:
        marks = [f[k : k + 8] for k in range(0, 32, 8)]
        before = [seen[m] for m in marks if m in seen]
        if before and max(map(before.count, before)) >= 3:
            continue  # a near copy of a row that is taken
        seen.update((m, doc) for m in marks if m != b"\xff" * 8)
        ids.append(doc)
        y.append(label)
        words.append(np.frombuffer(f, "<u4", offset=32))
    toxic = np.array(y, int)
    chain = ClassifierChain(**params)
    return chain.fit_toxic(words, toxic, np.array([zlib.crc32(str(d).encode()) % chain.folds for d in ids], int))


def score_toxicity(docs: DataFrame, chain: ClassifierChain, threshold: float = 0.5, keep: bool = False) -> DataFrame:
    """doc_id, p_kind1, p_kind2, p_toxic, toxic (p_toxic >= threshold).

    keep: instead, the rows of docs that are not toxic, with all of their columns.
    """
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(chain)  # at most `most` words and weights a category
    base = docs if keep else docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    text_at = base.columns.index("text")
    names = [f"p_{n}" for n in chain.names]

    def run(batches):
        model = shared.value
        used = set(np.concatenate([k.words for k in model.links if k] or [np.zeros(0, np.uint32)]).tolist())
        for batch in batches:
            texts = utf8(batch.column(text_at))
            for part in steps([len(t or b"") for t in texts]):
                found = [np.array(sorted(used.intersection(map(zlib.crc32, features_of(texts[k])))), np.uint32) for k in part]
                p = model.predict(found)
                toxic = p[:, -1] >= threshold
                own = batch.slice(part.start, len(part))
                if keep:
                    yield own.filter(pa.array(~toxic))
                else:
                    yield pa.RecordBatch.from_arrays([own.column(0), *(pa.array(c, pa.float64()) for c in p.T), pa.array(toxic)], ["doc_id", *names, "toxic"])

    schema = base.schema if keep else f"doc_id bigint, {', '.join(f'{n} double' for n in names)}, toxic boolean"
    return base.mapInArrow(run, schema)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, **params) -> DataFrame:
    """Trains on labels and scores every row of docs."""
    return score_toxicity(docs, train_toxicity(docs, labels, **params), threshold)
