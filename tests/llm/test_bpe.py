import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from loomgraph.llm import bpe
from loomgraph.llm.queries import ranks_path

DOCS = "doc_id bigint, text string"


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(ranks_path()), special_tokens={})


def texts():
    rng = random.Random(5)
    pool = ["hello", "don't", " ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "été", "Straße", "漢字", "١٢", "²", "😀", "'ll", "'", "12345", "<|endoftext|>", "aaaa", "!!", "_", "́", "x" * 40, "Ⅷ", "\r\n", "᠎", "​"]
    made = ["".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(600)]
    made += [" ".join(rng.choice(pool) for _ in range(rng.randint(0, 30))) for _ in range(300)]
    made += ["".join(chr(rng.choice([rng.randint(32, 126), rng.randint(0, 0x2FF), rng.randint(0x2000, 0x206F)])) for _ in range(50)) for _ in range(300)]
    return made + ["", " ", " a", "a ", "a\n b", "a \n \n b", "a" * 20_000, "ab" * 5_000 + " " * 300, "é" * 3000]


def test_equals_the_library(library):
    enc = bpe.Encoder(bpe.load_ranks(ranks_path()), public_tokenizers.PATTERN, limit=200)
    made = texts()
    for at in range(0, len(made), 50):
        for text, ids in zip(made[at : at + 50], enc.encode(made[at : at + 50]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text), repr(text[:80])


def test_merge_order_of_crossing_ranks():
    """A merge may create a pair of a lower rank, which then goes first."""
    ranks = {bytes([b]): b for b in range(256)} | {b"bc": 300, b"abc": 310, b"ab": 320, b"abca": 315, b"ca": 330, b"abab": 290}
    replay = bpe.MergeReplay(ranks)

    def plain(word):
        parts = [bytes([b]) for b in word]
        while True:
            found = [(ranks[parts[i] + parts[i + 1]], i) for i in range(len(parts) - 1) if parts[i] + parts[i + 1] in ranks]
            if not found:
                return [ranks[p] for p in parts]
            _, i = min(found)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]

    rng = random.Random(1)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 14))).encode() for _ in range(500)]
    for word, ids in zip(words, replay.encode(words), strict=True):
        assert ids == ([ranks[word]] if word in ranks else plain(word)), word


def test_merges_go_in_rank_order_over_all_words():
    """Without crossing ranks each rank has one turn, in order, for the pairs of all words; words of any length go the same way."""
    ranks = bpe.load_ranks(ranks_path())
    replay, rng = bpe.MergeReplay(ranks), random.Random(8)
    words = [("".join(rng.choice(["th", "er", "ing", "on", "x", "qu"]) for _ in range(n))).encode() for n in [*range(2, 40)] * 5 + [3000]]
    trace: list[tuple[int, int]] = []
    ids = replay.replay(words, trace)
    turns = [r for r, _ in trace]
    falls = sum(b <= a for a, b in zip(turns, turns[1:], strict=False))
    assert falls <= 0.05 * len(turns) and max(n for _, n in trace) > len(words)
    assert sum(n for _, n in trace) == sum(map(len, words)) - sum(len(x) // 4 for x in ids)


def test_query_rows(spark, library):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (None, "x"), (3, "")]
    got = bpe.bpe_digests(spark.createDataFrame([(*r, "z") for r in rows], DOCS + ", ids string"), ranks_path(), public_tokenizers.PATTERN).collect()
    want = []
    for doc, text in rows:
        ids = library.encode_ordinary(text or "")
        want.append((doc, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256((text or "").encode()).hexdigest()))
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    empty = spark.createDataFrame([], DOCS)
    assert bpe.bpe_digests(empty, ranks_path(), public_tokenizers.PATTERN).count() == 0


def test_whole_corpus_round_trip(spark, library):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: bytes(r.ids) for r in bpe.bpe_encode(docs, ranks_path(), public_tokenizers.PATTERN).collect()}
    for r in docs.collect():
        assert np.frombuffer(got[r.doc_id], "<u4").tolist() == library.encode_ordinary(r.text or "")
