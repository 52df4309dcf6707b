import random
import re
from collections import defaultdict

import pytest
import xxhash

from loomgraph.llm import simhash

DOCS = "doc_id bigint, text string"


def brute_fingerprint(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps, bits=3):
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                parent[find(i)] = find(j)
    return [find(i) for i in range(len(fps))]


def test_fingerprints():
    rng = random.Random(2)
    for _ in range(200):
        text = "".join(rng.choice(["A", "b", "É", " ", "\n", "\x0b", " ", "\x1c", "zz"]) for _ in range(rng.randint(0, 60)))
        assert simhash.fingerprint(text.encode()) == brute_fingerprint(text), repr(text)
    assert simhash.fingerprint(None) == 0
    long = "word other thing " * 40_000
    assert simhash.fingerprint(long.encode()) == brute_fingerprint(long)


@pytest.mark.parametrize("block", [2048, 3])
def test_links_of_near_fingerprints(spark, block):
    """Clusters around random centres; small blocks make every key a hot one."""
    rng = random.Random(block)
    fps = []
    for _ in range(40):
        centre = rng.getrandbits(64)
        for _ in range(rng.randint(1, 12)):
            fp = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                fp ^= 1 << bit
            fps.append(fp)
    fps = sorted(set(fps))
    signed = [f - (1 << 64) if f >> 63 else f for f in fps]
    frame = spark.createDataFrame([(s,) for s in signed], "fp bigint")
    links = simhash._links(simhash._ring_keys(frame), block, simhash.NARROW)
    got = {r.node: r.component for r in simhash.connected_components(links).collect()}
    groups, want = defaultdict(set), defaultdict(set)
    for s, part in zip(signed, brute_components(fps), strict=True):
        want[part].add(s)
        groups[got.get(s, s)].add(s)
    assert sorted(map(sorted, want.values())) == sorted(map(sorted, groups.values()))
    for r in links.collect():
        assert ((r.src ^ r.dst) & (1 << 64) - 1).bit_count() <= 3


def test_rows(spark):
    base = " ".join(f"w{k}" for k in range(200))
    rows = [(5, base), (3, base.upper()), (9, base + " end"), (7, None), (2, ""), (4, " \n"), (8, "one"), (8, "one"), (None, "other words here"), (None, base)]
    got = simhash.near_duplicates(spark.createDataFrame([(*r, "x") for r in rows], DOCS + ", component_id string")).collect()
    fps = [brute_fingerprint(t) for _, t in rows]
    parts = brute_components(fps)
    least = {p: min([d for (d, _), q in zip(rows, parts, strict=True) if q == p and d is not None], default=None) for p in parts}
    want = [(d, f"{f:016x}", least[p]) for (d, _), f, p in zip(rows, fps, parts, strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(spark.createDataFrame([], DOCS)).count() == 0


def test_whole_small_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [brute_fingerprint(t) for _, t in rows]
    parts = brute_components(fps)
    least = {}
    for (d, _), p in zip(rows, parts, strict=True):
        least[p] = min(d, least.get(p, d))
    want = sorted((d, f"{f:016x}", least[p]) for (d, _), f, p in zip(rows, fps, parts, strict=True))
    assert sorted(map(tuple, simhash.near_duplicates(docs).collect())) == want
