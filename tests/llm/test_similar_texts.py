import random

import corpus_pipeline
import numpy as np
from pyspark.sql import functions as F

from loomgraph.llm import simhash

COLUMNS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def brute_set(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def similarity(a, b):
    return len(a & b) / len(a | b) if a or b else 1.0


def brute_classes(texts):
    """The pairs of a similarity of 0.8 or more, and the class of each text."""
    sets, pairs, parent = [brute_set(t) for t in texts], [], list(range(len(texts)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if min(len(sets[i]), len(sets[j])) * 5 >= max(len(sets[i]), len(sets[j])) * 4 and similarity(sets[i], sets[j]) >= 0.8:
                pairs.append((j, i))
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return pairs, [find(i) for i in range(len(sets))]


def varied(seed, n):
    """Texts of 50 to 600 words and variants with random words replaced, most near the border of 0.8."""
    rng = random.Random(seed)
    word = lambda: f"w{rng.randrange(3000)}"
    texts = []
    for _ in range(n):
        base = [word() for _ in range(rng.randint(50, 600))]
        texts.append(" ".join(base))
        for rate in (0.005, 0.01, 0.02, 0.025, 0.03):
            texts.append(" ".join(word() if rng.random() < rate else w for w in base))
    return texts


def test_recall_against_brute_force(spark):
    texts = varied(1, 60)
    pairs, want = brute_classes(texts)
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)], COLUMNS)
    _, members = simhash.similar_texts(docs, F.col("doc_id"))
    known = {r.key: r.part for r in members.collect()}
    part = {k: known[int(np.uint64(simhash._set_key(simhash.shingle_set(t.encode()))).view(np.int64))] for k, t in enumerate(texts)}
    found = sum(part[a] == part[b] for a, b in pairs)
    print("pairs", len(pairs), "found", found)
    assert len(pairs) > 300 and found >= 0.99 * len(pairs)
    assert all(want[a] == want[b] for a in part for b in range(a) if part[a] == part[b])


def test_stage_drops_near_copies_of_a_table(spark):
    """The whole table of 1,000 documents: of each class by brute force the least id stays."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = docs.orderBy("doc_id").select("doc_id", "text").collect()
    _, want = brute_classes([r.text for r in rows])
    kept = {r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()}
    assert kept == {rows[i].doc_id for i in set(want)}


def test_many_copies_and_odd_texts(spark):
    """A large class of variants of one text, short texts, empty ones and repeated rows."""
    rng = random.Random(3)
    base = [f"b{k}" for k in range(120)]
    texts = [" ".join(f"x{rng.randrange(99)}" if k == at else w for k, w in enumerate(base)) for at in (rng.randrange(120) for _ in range(150))]
    texts += [None, "", " \n", "one", "One", "one two", "a b c d e", "a b c d f"]
    docs = spark.createDataFrame([(k, t, "en", "s", 1) for k, t in enumerate(texts)] + [(0, texts[0], "en", "s", 1)] * 3, COLUMNS)
    _, want = brute_classes(texts)
    kept = [r.doc_id for r in corpus_pipeline.drop_near_copies(spark, docs, "").collect()]
    assert sorted(kept) == sorted(set(want))
    empty = spark.createDataFrame([], COLUMNS)
    assert corpus_pipeline.drop_near_copies(spark, empty, "").count() == 0


def test_null_ids_and_an_id_with_two_texts(spark):
    """Every class leaves one row, chosen by its row and not by its id."""
    one, two, three = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    rows = [(None, one, "en", None, 1), (None, two, None, "en", 1), (None, two, "en", None, 1), (7, three, "en", "s", 1), (7, "other text of its own here", "en", "s", 1), (8, three + " end", "en", "s", 1), (None, three, "en", "s", 1), (7, three, "en", "s", 1)]
    kept = corpus_pipeline.drop_near_copies(spark, spark.createDataFrame(rows, COLUMNS), "").collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(0, one), (0, two), (7, three), (7, "other text of its own here")])
