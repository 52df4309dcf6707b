import random

import numpy as np
import pytest

from loomgraph.llm import langid, quality, toxicity
from loomgraph.llm._common import crc_mod

DOCS = "doc_id bigint, text string, lang string, score string"


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet("/root/testdata/sf0.01/documents.parquet")


@pytest.fixture(scope="module")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")


def test_language_held_out_accuracy(spark, docs):
    got = {r.doc_id: r for r in langid.held_out_languages(docs).collect()}
    rows = docs.select("doc_id", "lang").collect()
    assert len(got) == len(rows)
    assert all(got[r.doc_id].held_out == (crc_mod(r.doc_id, 5) == 0) for r in rows)
    held = [r for r in rows if got[r.doc_id].held_out and got[r.doc_id].lang_pred != "und"]
    assert np.mean([got[r.doc_id].lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_odd_rows(spark, docs):
    net = langid.ByteNetwork(["a", "b"])
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (3, "123 !?", "a", "x"), (None, "word", None, "x"), (4, "é" * 200_000, "b", "x"), (4, "é", "b", "x")]
    got = sorted(((r.doc_id or 0, r.lang_pred) for r in langid.predict_languages(spark.createDataFrame(rows, DOCS), net).collect()))
    assert [g for g in got if g[1] == "und"] == [(1, "und"), (2, "und"), (3, "und")] and len(got) == 6
    assert langid.held_out_languages(docs.limit(0)).count() == 0


def test_gradients_of_the_network():
    """Backpropagation through time against finite differences of the loss, for every parameter array."""
    net = langid.ByteNetwork(["a", "b", "c"], hidden=3, dtype=np.float64)
    rng = np.random.default_rng(0)
    x, y = rng.integers(97, 103, (4, 12)).astype(np.uint8), np.array([0, 1, 2, 1])
    x[0, 3:5] = 32
    _, grads = net.gradients(x, y)
    for name, value in net.p.items():
        for at in rng.integers(0, value.size, 12).tolist() if name != "T" else [d * 9 * 256 + k * 256 + c for d in (0, 1) for k in range(9) for c in (97, 100)]:
            cell = np.unravel_index(at, value.shape)
            old, losses = value[cell], []
            for step in (1e-5, -1e-5):
                value[cell] = old + step
                losses.append(net.gradients(x, y)[0])
            value[cell] = old
            assert np.isclose((losses[0] - losses[1]) / 2e-5, grads[name][cell], rtol=1e-4, atol=1e-8), (name, cell)


def test_labels_of_bytes_against_a_plain_loop():
    """Texts of different lengths, one beyond a window, byte by byte in plain Python; the state is never reset."""
    net, rng = langid.ByteNetwork(["a", "b"], hidden=3, dtype=np.float64), np.random.default_rng(3)
    texts = [bytes(rng.integers(0, 256, n).astype(np.uint8)) for n in (5, 300, 0, 1, 40)]
    T, U, O, s = net.p["T"], net.p["U"], net.p["O"], lambda v: 1 / (1 + np.exp(-v))
    found = dict(net.label_bytes(texts))
    assert sorted(found) == list(range(len(texts)))
    for text, got in ((texts[k], p) for k, p in found.items()):
        logits = np.tile(net.p["b"], (len(text), 1))
        for d in (0, 1):
            h = np.zeros(3)
            for k in range(len(text)) if d == 0 else range(len(text) - 1, -1, -1):
                x, q = T[d][:, text[k]], U[d] @ h
                z, r = s(x[:3] + q[:3]), s(x[3:6] + q[3:6])
                h = h + z * (np.tanh(x[6:] + r * q[6:]) - h)
                logits[k] += O[d] @ h
        want = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
        assert got.shape == want.shape and np.allclose(got, want)
    letters = [[b for b in t if b >= 128 or chr(b).isalpha()] for t in texts]
    assert [bool(x) for x in letters] == [bool(row.any()) for row in net.pooled(texts)]


def _auc(score, y):
    order = np.argsort(score)
    ranks = np.empty(len(score))
    ranks[order] = np.arange(1, len(score) + 1)
    return (ranks[y == 1].sum() - (y == 1).sum() * ((y == 1).sum() + 1) / 2) / ((y == 1).sum() * (y == 0).sum())


def test_quality_held_out(spark, docs, labels):
    got = {r.doc_id: r for r in quality.held_out_quality(docs, labels).collect()}
    rows = [r for r in labels.collect() if got[r.doc_id].held_out]
    assert all(got[r.doc_id].held_out == (crc_mod(r.doc_id, 3) == 1) for r in labels.collect())
    y, s = np.array([r.quality for r in rows]), np.array([got[r.doc_id].score for r in rows])
    assert _auc(s, y) > 0.85
    assert all(r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())


def test_quality_odd_rows(spark, labels, docs):
    model = quality.SubwordModel(1 << 10, 4)
    rows = [(1, None, "a", "x"), (2, "", "a", "x"), (None, "w", None, "x"), (3, "w " * 100_000, "a", "x"), (3, "w" * 50_000, "a", "x")]
    got = quality.score_quality(spark.createDataFrame(rows, DOCS), model).collect()
    assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
    none = quality.held_out_quality(docs.limit(3), labels.limit(0)).collect()
    assert [r.score for r in none] == [0.5] * 3
    assert quality.held_out_quality(docs.limit(0), labels).count() == 0


def test_scores_equal_the_plain_sum():
    """The cached numbers of words against averaging the vectors."""
    model = quality.SubwordModel(1 << 12, 8)
    rng = np.random.default_rng(0)
    model.output = rng.normal(size=(2, 8)).astype(np.float32)
    ids, counts = quality.bag(b"some words, some more Words", 1 << 12)
    mean = counts @ model.vectors[ids] / counts.sum()
    w, b = model.weights()
    assert np.isclose((w[ids] * counts).sum() / counts.sum() + b, (model.output[1] - model.output[0]) @ mean, atol=1e-5)


def test_score_quality_against_plain_averages(spark, docs, labels):
    """Every row of a table: the vectors of all words, n-grams of characters and bigrams averaged, then the softmax."""
    import zlib

    model = quality.train_quality_model(docs, labels, buckets=1 << 12, dim=4, updates=500)
    texts = [*(r.text for r in docs.orderBy("doc_id").limit(150).collect()), "über Straße été 漢字漢字", "the " * 70_000, "", None, "a b"]
    frame = spark.createDataFrame([(k, t, "x", "y") for k, t in enumerate(texts)], DOCS)
    got = {r.doc_id: r.score for r in quality.score_quality(frame, model).collect()}
    for k, text in enumerate(texts):
        words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
        assert all(ord(c) != 0x85 for c in text or "")
        total, n = np.zeros(4), 0
        for w in words[:200] if text and text.startswith("the the") else words:
            marked = f"<{w}>"
            grams = [zlib.crc32(w.encode())] + [zlib.crc32(marked[i : i + m].encode(), m) for m in (3, 4, 5) for i in range(len(marked) - m + 1)]
            total += model.vectors[[g % 4096 for g in grams]].sum(axis=0)
            n += len(grams)
        if text and text.startswith("the the"):
            total, n = total * 350, n * 350
        hashes = [zlib.crc32(w.encode()) for w in words]
        mix = 0x9E3779B97F4A7C15
        for a, b in zip(hashes, hashes[1:], strict=False):
            total += model.vectors[((((a * mix % 2**64) ^ b) * mix % 2**64) >> 40) % 4096]
            n += 1
        logits = model.output @ (total / max(n, 1)) + model.bias
        assert np.isclose(got[k], 1 / (1 + np.exp(logits[0] - logits[1])), atol=1e-4), k


def test_training_bags_count_every_repetition():
    ids, counts = quality.bag(b"the " * 70_000, 1 << 16)
    assert counts.max() >= 70_000 and counts.sum() == 70_000 * 7 + 69_999


def test_toxicity_on_planted_documents(spark):
    rng = random.Random(6)
    words = ["".join(rng.choice(["an", "er", "th", "ion", "re", "st"]) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    bad = ["idiot", "moron", "worthless", "pathetic", "stupid", "scum"]

    def text(n, toxic):
        ws = [rng.choice(words) for _ in range(n)]
        for _ in range(4 if toxic else 0):
            ws[rng.randrange(n)] = rng.choice(bad)
        return " ".join(ws)

    rows = [(k, text(rng.randint(20, 300), k % 10 == 0)) for k in range(1200)]
    marks = [(k, int(k % 10 == 0) if rng.random() > 0.05 else rng.randint(0, 1)) for k in range(600)]
    rows += [(5000, None), (5001, ""), (5002, "ok"), (5002, "ok"), (None, text(30, True)), (5003, text(20_000, False)), (5004, text(20_000, True))]
    d = spark.createDataFrame([(*r, "x") for r in rows], "doc_id bigint, text string, toxic string")
    m = spark.createDataFrame(marks, "doc_id bigint, toxic int")
    got = toxicity.toxicity(d, m).collect()
    assert len(got) == len(rows)
    flagged = {r.doc_id for r in got if r.toxic}
    wanted = {k for k in range(1200) if k % 10 == 0} | {None, 5004}
    assert len(flagged & wanted) >= 0.97 * len(wanted) and len(flagged - wanted) <= 3
    kept = toxicity.score_toxicity(d, toxicity.train_toxicity(d, m), keep=True)
    assert kept.columns == d.columns and kept.count() == len(rows) - sum(r.toxic for r in got)
    assert not any(r.toxic for r in toxicity.toxicity(d, m.limit(0)).collect())
    assert toxicity.toxicity(d.limit(0), m).count() == 0


def _chain_rows(seed=2, n=400):
    """Word hashes; documents with 3 or 4 are toxic, of two kinds that share the word 5."""
    rng = np.random.default_rng(seed)
    docs = [np.sort(rng.choice(np.arange(10, 60), 8, replace=False)).astype(np.uint32) for _ in range(n)]
    kind = rng.integers(0, 6, n)  # 0, 1 and 2: toxic, 0 and 1 with word 3, 2 with word 4
    docs = [np.unique(np.r_[d, [3, 5] if k < 2 else [4, 5] if k == 2 else []]).astype(np.uint32) for d, k in zip(docs, kind, strict=True)]
    return docs, kind


def test_kinds_are_learned_from_the_labels():
    docs, kind = _chain_rows()
    toxic = (kind < 3).astype(int)
    first, second = toxicity.learn_kinds(docs, toxic, 2, 6.0, 256, 5)
    assert (first == (kind < 2)).all() and (second == (kind == 2)).all()
    none = toxicity.learn_kinds(docs, 0 * toxic, 2, 6.0, 256, 5)
    assert not any(x.any() for x in none)


def test_chain_feeds_earlier_out_of_fold_probabilities():
    """Each link against a plain repetition: fit on the other folds, predict this one, feed that to the next link."""
    docs, kind = _chain_rows()
    toxic, fold = (kind < 3).astype(int), np.arange(len(docs)) % 5
    chain = toxicity.ClassifierChain().fit_toxic(docs, toxic, fold)
    assert chain.names == ("kind1", "kind2", "toxic")
    assert [len(link.w) - len(link.words) - 1 for link in chain.links] == [0, 1, 2]

    def presence(link, rows):
        return np.array([[float(w in set(docs[k].tolist())) for w in link.words.tolist()] for k in rows]).reshape(len(rows), len(link.words))

    labels = [(kind < 2).astype(int), (kind == 2).astype(int), toxic]
    earlier = np.zeros((len(docs), 0))
    for step, (link, y) in enumerate(zip(chain.links, labels, strict=True)):
        out = np.zeros(len(docs))
        for k in range(5):
            inside, outside = np.flatnonzero(fold != k), np.flatnonzero(fold == k)
            other = toxicity.Link([docs[i] for i in inside], y[inside], earlier[inside], 6.0, 256, 5, 0.3)
            for i, x in zip(outside, presence(other, outside), strict=True):
                out[i] = 1 / (1 + np.exp(-sum(a * b for a, b in zip([*x, *earlier[i], 1.0], other.w, strict=True))))
        assert np.allclose(out, chain.out_of_fold[:, step])
        full = toxicity.Link(docs, y, earlier, 6.0, 256, 5, 0.3)
        assert (full.words == link.words).all() and np.allclose(full.w, link.w)
        earlier = np.hstack([earlier, out[:, None]])
    assert ((chain.predict(docs)[:, 2] > 0.5) == toxic).mean() > 0.98


def test_toxicity_query_against_plain_scores(spark, docs, labels):
    """Every row of the table, its features and the chain recomputed one document at a time."""
    import re
    import zlib
    from collections import Counter

    chain = toxicity.train_toxicity(docs, labels)
    got = {r.doc_id: r for r in toxicity.score_toxicity(docs, chain).collect()}
    for row in docs.select("doc_id", "text").collect():
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in row.text or "")
        words = Counter(re.findall("[a-z\u0080-\U0010ffff]+", lowered))
        found, stems = set(words), Counter()
        for w, n in words.items():
            for k in (5, 6, 7):
                if len(w) > k and len(w.encode()) > 5:
                    stems[w[:k]] += n
        found |= {f"{k}*{s}" for s, n in stems.items() for k in (2, 3) if n >= k}
        hashes, p = {zlib.crc32(f.encode()) for f in found}, []
        for link in chain.links:
            x = [*(float(w in hashes) for w in link.words.tolist()), *p, 1.0]
            p.append(1 / (1 + np.exp(-sum(a * b for a, b in zip(x, link.w, strict=True)))))
        assert np.allclose(list(got[row.doc_id])[1:4], p), row.doc_id
        assert got[row.doc_id].toxic == (got[row.doc_id].p_toxic >= 0.5)
