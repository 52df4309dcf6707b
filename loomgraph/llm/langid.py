"""Language identification by a bidirectional gated recurrent network over bytes.

Each direction is a gated recurrent unit: from the byte x_t and the state h it forms an update
gate z = s(T_z[x_t] + U_z h), a reset gate r = s(T_r[x_t] + U_r h), s the logistic function, and
a candidate n = tanh(T_n[x_t] + r * U_n h), and h becomes h + z (n - h). Both states label every
byte with a softmax over the languages; a document's probabilities are the means over its letter
bytes. The network is trained in numpy by backpropagation through time with Adam.

The states run through the whole text, however long, from its first byte and from its last; many texts
go side by side. Time and memory are linear in the length. A text that is null or has no letter
gets `und` with score 0; ties between languages go to the first by name. The training set is a bounded
sample: of the rows that may teach, `sample_docs` ids with the smallest hashes, and of each
`sample_windows` windows of 64 bytes, evenly spread over the whole text; each of `updates` steps
takes `batch` of them, whatever the size of the tables. Of repeated ids one row teaches. Without
any row to learn from, every text is `und`. Repeated rows are labelled each; empty tables give
empty tables; columns other than the id, the text and (to learn) the language are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._common import bounded_sample, remainder, steps, utf8
from loomgraph.session import prepare

WINDOW = 64
#: Bytes of texts that go side by side.
STEP = 6 << 20
_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.array([65 <= b <= 90 or 97 <= b <= 122 for b in range(256)])
#: Bytes that count in the pooling: ASCII letters and bytes of other characters.
_POOLED = _ASCII_LETTER | (np.arange(256) >= 128)


def _logistic(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)), in place."""
    np.negative(x, out=x)
    np.minimum(x, 40, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


class ByteNetwork:
    """T: (2, 3 hidden, 256), U: (2, 3 hidden, hidden), O: (2, labels, hidden); forward first, then backward."""

    def __init__(self, labels: list[str], hidden: int = 8, seed: int = 7, dtype=np.float32):
        rng = np.random.default_rng(seed)
        self.labels, self.hidden, self.dtype = labels, hidden, dtype
        normal = lambda *shape: rng.normal(0, 0.3, shape).astype(dtype)
        self.p = {"T": normal(2, 3 * hidden, 256), "U": normal(2, 3 * hidden, hidden), "O": normal(2, len(labels), hidden), "b": np.zeros(len(labels), dtype)}

    def _step(self, a: np.ndarray, h: np.ndarray):
        """Of inputs a = T[x] (2, 3 hidden, width), which it overwrites, and states h: gates, U_n h, the candidate and the new states."""
        H = self.hidden
        q = np.matmul(self.p["U"], h)
        a[:, : 2 * H] += q[:, : 2 * H]
        gates = _logistic(a[:, : 2 * H])
        n = gates[:, H:] * q[:, 2 * H :]
        n += a[:, 2 * H :]
        np.tanh(n, out=n)
        new = n - h
        new *= gates[:, :H]
        new += h
        return gates, q[:, 2 * H :], n, new

    def gradients(self, x: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """The mean loss over the letter bytes of windows x (rows, steps) with labels y, and its gradients."""
        H, p = self.hidden, self.p
        both = np.stack([x.T, x.T[::-1]]).astype(np.intp)  # (direction, step, window)
        steps_, width = both.shape[1:]
        mask = _POOLED[x.T]
        weight = (mask / max(1, mask.sum())).astype(self.dtype)
        h, trail = np.zeros((2, H, width), self.dtype), []
        logits = np.broadcast_to(p["b"][:, None], (steps_, len(self.labels), width)).copy()
        for t in range(steps_):
            a = np.stack([p["T"][d].take(both[d, t], axis=1) for d in (0, 1)])
            gates, un, n, new = self._step(a, h)
            trail.append((h, gates, un, n, new))
            h = new
            out = np.matmul(p["O"], h)
            logits[t] += out[0]
            logits[steps_ - 1 - t] += out[1]
        delta = _softmax(logits, 1)
        rows = np.arange(width)
        loss = float(-(np.log(np.maximum(delta[:, y, rows], 1e-30)) * weight).sum())
        delta[:, y, rows] -= 1
        delta *= weight[:, None, :]
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        grads["b"] += delta.sum(axis=(0, 2))
        back = np.zeros((2, H, width), self.dtype)
        inputs = np.empty((2, 3 * H, steps_, width), self.dtype)
        for t in reversed(range(steps_)):
            h, gates, un, n, new = trail[t]
            z, r = gates[:, :H], gates[:, H:]
            here = np.stack([delta[t], delta[steps_ - 1 - t]])
            grads["O"] += here @ new.transpose(0, 2, 1)
            back += p["O"].transpose(0, 2, 1) @ here
            dn = back * z * (1 - n * n)
            dz, dr = back * (n - h) * z * (1 - z), dn * un * r * (1 - r)
            inputs[:, :, t] = np.concatenate([dz, dr, dn], axis=1)
            inner = np.concatenate([dz, dr, dn * r], axis=1)  # by U h
            grads["U"] += inner @ h.transpose(0, 2, 1)
            back = back * (1 - z) + p["U"].transpose(0, 2, 1) @ inner
        for d in (0, 1):
            flat = both[d].ravel()
            for k in range(3 * H):
                grads["T"][d, k] = np.bincount(flat, weights=inputs[d, k].ravel(), minlength=256)
        return loss, grads

    def train(self, x: np.ndarray, y: np.ndarray, updates: int = 320, batch: int = 256, rate: float = 0.03, seed: int = 7) -> None:
        """x: windows (rows, steps) of bytes; y: label numbers of the rows. Adam; rows are taken in random order, again and again."""
        rng = np.random.default_rng(seed)
        first = {k: np.zeros_like(v) for k, v in self.p.items()}
        second = {k: np.zeros_like(v) for k, v in self.p.items()}
        queue = np.zeros(0, int)
        for step in range(1, updates + 1):
            while len(queue) < batch:
                queue = np.concatenate([queue, rng.permutation(len(x))])
            rows, queue = queue[:batch], queue[batch:]
            _, grads = self.gradients(x[rows], y[rows])
            scale = rate * (1 - 0.9 * step / updates)
            for k, g in grads.items():
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.p[k] -= scale * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)

    def label_bytes(self, texts: list[bytes]) -> Iterator[tuple[int, np.ndarray]]:
        """(k, label probabilities of the bytes of texts[k]: (bytes, labels)) for each text.

        The texts are sorted by length; at each step all that have a byte left go on, the forward
        states from their first bytes, the backward ones from their last.
        """
        H, p = self.hidden, self.p
        order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
        lengths = np.array([len(texts[k]) for k in order], np.int64)
        longest = int(lengths.max(initial=0))
        widths = (len(texts) - np.cumsum(np.bincount(lengths, minlength=longest + 1)))[:longest]
        offsets = np.cumsum(widths) - widths  # where the bytes of a step begin
        x = np.empty((2, int(lengths.sum())), np.uint8)
        for lane, k in enumerate(order):
            own = np.frombuffer(texts[k], np.uint8)
            at = offsets[: len(own)] + lane
            x[0, at], x[1, at] = own, own[::-1]
        out = np.empty((2, len(self.labels), x.shape[1]), self.dtype)
        # Signs of the gates are turned, so that exp() can follow at once.
        T, U = p["T"].copy(), p["U"].copy()
        T[:, : 2 * H] *= -1
        U[:, : 2 * H] *= -1
        h, width = np.zeros((2, H, len(texts)), self.dtype), -1
        with np.errstate(over="ignore"):
            for at, w in zip(offsets.tolist(), widths.tolist(), strict=True):
                if w != width:
                    width, h = w, np.ascontiguousarray(h[:, :, :w])
                    a, q, new = np.empty((2, 3 * H, w), self.dtype), np.empty((2, 3 * H, w), self.dtype), np.empty((2, H, w), self.dtype)
                    gates, z, r, n, un = a[:, : 2 * H], a[:, :H], a[:, H : 2 * H], a[:, 2 * H :], q[:, 2 * H :]
                    inner = q[:, : 2 * H]
                T[0].take(x[0, at : at + w], axis=1, out=a[0], mode="clip")
                T[1].take(x[1, at : at + w], axis=1, out=a[1], mode="clip")
                np.matmul(U, h, out=q)
                gates += inner
                np.exp(gates, out=gates)
                np.add(gates, 1, out=gates)
                np.reciprocal(gates, out=gates)
                np.multiply(un, r, out=new)
                new += n
                np.tanh(new, out=new)
                new -= h
                new *= z
                h += new
                np.matmul(p["O"], h, out=out[:, :, at : at + w])
        for lane, k in enumerate(order):
            at = offsets[: len(texts[k])] + lane
            logits = out[0][:, at].T + out[1][:, at[::-1]].T
            yield k, _softmax(logits + p["b"], 1)

    def pooled(self, texts: list[bytes]) -> np.ndarray:
        """Mean label probabilities over the letter bytes of each whole text (0 without any)."""
        out = np.zeros((len(texts), len(self.labels)))
        for k, probabilities in self.label_bytes(texts):
            mask = _POOLED[np.frombuffer(texts[k], np.uint8)]
            if mask.any():
                out[k] = probabilities[mask].mean(axis=0, dtype=np.float64)
        return out


def _softmax(logits: np.ndarray, axis: int) -> np.ndarray:
    """In place."""
    logits -= logits.max(axis=axis, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=axis, keepdims=True)
    return logits


def _windows(text: bytes, most: int) -> bytes:
    """At most `most` windows, evenly spread over the whole text."""
    n = -(-len(text) // WINDOW)
    padded = text.ljust(n * WINDOW, b"\0")
    chosen = range(n) if n <= most else [k * n // most for k in range(most)]
    return b"".join(padded[k * WINDOW : (k + 1) * WINDOW] for k in chosen)


def train_language_model(docs: DataFrame, sample_docs: int = 1600, sample_windows: int = 10, hidden: int = 8, updates: int = 320) -> ByteNetwork:
    """Learns from the text and the non-null lang of docs, on the bounded sample named above."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang")).where("doc_id is not null and lang is not null and text is not null")
    chosen = bounded_sample(rows.groupBy("doc_id").agg(F.min("lang").alias("lang")), "doc_id", sample_docs)

    def run(batches):
        for batch in batches:
            cut = [_windows(t, sample_windows) for t in utf8(batch.column(2))]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(cut, pa.binary())], ["doc_id", "lang", "w"])

    taken = rows.join(F.broadcast(chosen), ["doc_id", "lang"]).select("doc_id", "lang", "text").mapInArrow(run, "doc_id bigint, lang string, w binary")
    found = taken.groupBy("doc_id", "lang").agg(F.min("w").alias("w")).collect()  # sample_docs rows at most
    found = sorted((r.doc_id, r.lang, bytes(r.w)) for r in found if r.w)
    labels = sorted({lang for _, lang, _ in found})
    net = ByteNetwork(labels, hidden)
    if len(labels) > 1:
        x = np.frombuffer(b"".join(w for _, _, w in found), np.uint8).reshape(-1, WINDOW)
        y = np.repeat([labels.index(lang) for _, lang, _ in found], [len(w) // WINDOW for _, _, w in found])
        net.train(x, y, updates)
    return net


def predict_languages(docs: DataFrame, net: ByteNetwork) -> DataFrame:
    """doc_id, lang_pred, score (the pooled probability of lang_pred)."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(net)  # about hidden * 1,600 numbers

    def run(batches):
        model = shared.value
        for batch in batches:
            texts = [t or b"" for t in utf8(batch.column(1))]
            for part in steps([len(t) for t in texts], STEP):
                own = texts[part.start : part.stop]
                has = [bool(model.labels) and _LETTER.search(t.decode("utf-8", "replace")) is not None for t in own]
                p = model.pooled([t if h else b"" for t, h in zip(own, has, strict=True)]) if model.labels else np.zeros((len(own), 1))
                names = [model.labels[k] if h else "und" for k, h in zip(p.argmax(axis=1), has, strict=True)]
                score = [min(1.0, float(s)) if h else 0.0 for s, h in zip(p.max(axis=1), has, strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(part)), pa.array(names, pa.string()), pa.array(score, pa.float64())], ["doc_id", "lang_pred", "score"])

    base = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return base.mapInArrow(run, "doc_id bigint, lang_pred string, score double")


def held_out_languages(docs: DataFrame, folds: int = 5, **params) -> DataFrame:
    """doc_id, held_out (crc32 of the id as text mod folds is 0), lang_pred, score; held-out rows teach nothing."""
    net = train_language_model(docs.where(remainder(F.col("doc_id"), folds) != 0), **params)
    return predict_languages(docs, net).select("doc_id", (remainder(F.col("doc_id"), folds) == 0).alias("held_out"), "lang_pred", "score")
