"""SimHash near-duplicates with pigeonring filtering.

`near_duplicates`: a fingerprint has 64 bits; a bit is set where more than half of the document's
word shingles (repeats included) have it set in their XXH64. Two fingerprints link if they differ
in at most 3 bits; the classes are the connected components of these links.

`similar_texts`: documents link if their sets of five-word shingles have a Jaccard similarity of 0.8 or
more. Sets that similar differ in 15 % of their bits on average, so fingerprints have 512
bits (eight hashes of 64), up to 115 of which may differ; whole sets confirm each link.

Pigeonring: the bits are a ring of m segments. If two fingerprints differ in at most t bits, some
segment i starts a chain in which any l consecutive segments together differ in at most
floor(l t / m) bits.

* 64 bits: 4 segments of 16, budgets 0, 1, 2. Candidates share segment i and differ in at most one bit
  of segment i + 1: each fingerprint is filed under (i, segment i, segment i + 1), and looks also
  under the keys in which one set bit of segment i + 1 is cleared. No link is missed.
* 512 bits: 21 segments of 24, budgets 5, 10, 16. Each fingerprint is filed under (i, segment i) and
  looks also where some of the four bits of the segment that were decided most narrowly are flipped
  (PROBES): a similar text differs there first. This can miss links; recall against brute
  force is measured in the tests and stated in the README.

The chain of three is tested before the full distance. Links between fingerprints form loose
classes; inside a loose class similar_texts() compares the sets of all pairs that pass the full distance
and aren't linked already, in blocks of bounded size.

Skew: equal texts have equal fingerprints and are one row before any join. A key with many
fingerprints is dealt into blocks; each pair of blocks is compared in a task of its own,
and gives back a spanning forest of its links, not all pairs, so no link between classes
is lost. A document of less words than a shingle is one shingle; one without words (null,
empty) has fingerprint zero and links like any other (similar_texts: all of these are one class).
Repeated rows are rows of one class. Other columns of the documents, whatever their names, are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._common import doc_columns, steps, utf8
from loomgraph.operators.components import connected_components
from loomgraph.session import cut, prepare

_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Fingerprints of a key that one task compares with as many others.
BLOCK = 2048
#: Groups of up to so many rows are compared together.
SMALL = 64


class Ring:
    """A fingerprint of `lanes` words as a ring of segments of `width` bits, from its highest bits on, and its budget."""

    def __init__(self, lanes: int, segments: int, width: int, budget: int):
        self.lanes, self.segments, self.width, self.budget = lanes, segments, width, budget
        chains = np.zeros((segments, 3, lanes * 64), np.uint8)
        for i in range(segments):
            for step in range(3):
                for k in range(step + 1):
                    at = (segments - 1 - (i + k) % segments) * width
                    chains[i, step, at : at + width] = 1
        #: Bits of the first one, two and three segments from each on, and their budgets.
        self.chains = np.packbits(chains, axis=2, bitorder="little").view("<u8")
        self.budgets = [budget * k // segments for k in (1, 2, 3)]

    def cut(self, bits: np.ndarray) -> np.ndarray:
        """Rows of lanes * 64 values, lowest bit first, as (rows, segments, width)."""
        return bits[:, : self.segments * self.width].reshape(-1, self.segments, self.width)[:, ::-1]

    def near(self, start, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Which rows of a and b pass the chain from segment `start` and then the full distance."""
        diff = a ^ b
        ok = np.ones(len(diff), bool)
        for step, budget in enumerate(self.budgets):
            mask = self.chains[start, step]
            ok &= np.bitwise_count(diff & mask).sum(axis=1, dtype=np.int64) <= budget
        ok[ok] = np.bitwise_count(diff[ok]).sum(axis=1, dtype=np.int64) <= self.budget
        return ok


NARROW = Ring(1, 4, 16, 3)
WIDE = Ring(8, 21, 24, 115)
#: Sets of positions, in order of margin, whose flips are looked under.
PROBES = ((0,), (1,), (2,), (3,), (0, 1), (0, 2))


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many hashes have each of the 64 bits."""
    counts = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        counts += np.unpackbits(hashes[k : k + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return counts


def fingerprint(text: bytes | None, shingle_words: int = 3) -> int:
    """The unsigned fingerprint of a whole text."""
    words = (text or b"").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, 42)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
        starts = (ends[:-shingle_words] if shingle_words else ends).tolist()
        digest = xxhash.xxh64_intdigest
        hashes = np.array([digest(joined[a:b], 42) for a, b in zip([0, *starts], (ends[shingle_words - 1 :] - 1).tolist(), strict=True)], np.uint64)
    bits = (2 * _bit_counts(hashes) > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fp (bigint: the fingerprint's bits)."""
    prepare(docs.sparkSession)

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(1))
            for part in steps([len(t or b"") for t in texts]):
                fps = np.array([fingerprint(texts[k], shingle_words) for k in part], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(part.start, len(part)), pa.array(fps)], ["doc_id", "fp"])

    return doc_columns(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, fp bigint")


def _ring_keys(fps: DataFrame) -> DataFrame:
    """key, size (1: filed there, -1: looks there), id (the fingerprint) of 64-bit fingerprints."""

    def run(batches):
        for batch in batches:
            fp = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            keys, who, size = [], [], []
            for i in range(4):
                ring = np.bitwise_or(fp << np.uint64(16 * i), fp >> np.uint64((64 - 16 * i) % 64)) if i else fp
                key = (ring >> np.uint64(32)) | np.uint64(i << 32)
                keys.append(key)
                who.append(fp)
                size.append(np.ones(len(fp), np.int32))
                for bit in range(16):
                    has = (key >> np.uint64(bit)) & np.uint64(1) == 1
                    keys.append(key[has] ^ np.uint64(1 << bit))
                    who.append(fp[has])
                    size.append(np.full(int(has.sum()), -1, np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(size)), pa.array(np.concatenate(who).view(np.int64))], ["key", "size", "id"])

    return fps.mapInArrow(run, "key bigint, size int, id bigint")


class _Forest:
    """Keeps the links that join classes."""

    def __init__(self):
        self.parent: dict[int, int] = {}
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parent = self.parent
        root = x
        while (up := parent.get(root, root)) != root:
            root = up
        while x != root:
            parent[x], x = root, parent.get(x, x)
        return root

    def add(self, x: int, y: int) -> bool:
        a, b = self.find(x), self.find(y)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
            self.links.append((x, y))
        return a != b

    def batch(self) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in self.links], pa.int64()) for k in (0, 1)], ["src", "dst"])


def _compare_small(ring: Ring, forest: _Forest, start: np.ndarray, bounds: np.ndarray, own: np.ndarray, ids: np.ndarray, fps: np.ndarray) -> None:
    """All pairs inside many small groups: neighbours at each offset, all groups at once."""
    ends = np.repeat(bounds[1:], np.diff(bounds))
    at = np.arange(len(own))
    offset = 1
    while len(at := at[at + offset < ends[at]]):
        pairs = at[own[at] | own[at + offset]]
        pairs = pairs[ring.near(start[pairs], fps[pairs], fps[pairs + offset])]
        for x, y in zip(ids[pairs].tolist(), ids[pairs + offset].tolist(), strict=True):
            forest.add(x, y)
        offset += 1


def _compare_large(ring: Ring, forest: _Forest, start: int, left: np.ndarray, right: np.ndarray, ids: np.ndarray, fps: np.ndarray) -> None:
    """Each row of left with all of right that are in other classes still."""
    if not len(left) or not len(right):
        return
    label, theirs = np.array([forest.find(x) for x in ids[right].tolist()]), fps[right]
    for row in left.tolist():
        name = int(ids[row])
        own = forest.find(name)
        other = np.flatnonzero(label != own)
        near = other[ring.near(start, fps[row : row + 1], theirs[other])]
        _, first = np.unique(label[near], return_index=True)
        for k in near[first].tolist():
            if forest.add(name, int(ids[right[k]])):
                old, new = label[k], forest.find(name)
                label[(label == old) | (label == own)] = new
                own = new


def _links(keys: DataFrame, block: int, ring: Ring, fps: DataFrame | None = None, least: tuple[int, int] = (0, 1)) -> DataFrame:
    """(src, dst): links of ids that suffice for the components.

    keys: key (the start of the chain above ring.width or 32 bits), size (of the set; negative where the id only
    looks), id; fps: id, f0 ... of each lane; without it the id is the fingerprint. Sets whose sizes are not
    within the fraction `least` of each other can't link: where only such meet, their rows go at once.
    """
    num, den = least
    lanes = [f"f{k}" for k in range(ring.lanes)]
    shift = 32 if fps is None else ring.width
    size, own = F.abs("size").cast("bigint"), F.when(F.col("size") > 0, F.col("size"))
    counts = keys.groupBy("key").agg(F.count("*").alias("n"), F.min(own).alias("own_lo"), F.max(own).alias("own_hi"), F.min(size).alias("lo"), F.max(size).alias("hi"))
    counts = counts.where(f"n > 1 and own_lo is not null and (n > 2 or lo * {den} >= hi * {num})").select("key", "n", "own_lo", "own_hi")
    live = keys.join(counts, "key").where(f"size > 0 or own_hi * {den}L >= abs(size) * {num}L and own_lo * {num}L <= abs(size) * {den}L").withColumn("own", F.col("size") > 0)
    live = live.withColumn("f0", F.col("id")) if fps is None else live.join(fps, "id")
    blocks = F.ceil(F.col("n") / block).cast("int")
    live = live.select("key", "own", "id", *lanes, blocks.alias("nb"), F.pmod(F.xxhash64("id"), blocks).cast("int").alias("c"))
    # Role 0: on both sides of its block; 1: left; 2: right. Own rows meet own rows once.
    placed = F.expr("""
        case when nb = 1 then array(named_struct('a', 0, 'b', 0, 'role', if(own, 0, 2)))
             when own then transform(sequence(0, nb - 1), j -> if(j < c, named_struct('a', j, 'b', c, 'role', 2), named_struct('a', c, 'b', j, 'role', if(j = c, 0, 1))))
             else transform(sequence(0, nb - 1), j -> named_struct('a', j, 'b', c, 'role', 2)) end""")
    # An own row is also on the left of the blocks below it, where only looking rows stand right.
    extra = F.expr("if(nb > 1 and own and c > 0, transform(sequence(0, c - 1), j -> named_struct('a', c, 'b', j, 'role', 1)), array())")
    dealt = live.select("key", "own", "id", *lanes, F.explode(F.concat(placed, extra)).alias("p")).select("key", "p.a", "p.b", "p.role", "own", "id", *lanes)

    def run(batches):
        held = None  # rows of the last group, which may go on

        def links(rows) -> _Forest:
            key, a, b, role, own, ids, fps = rows
            forest, start = _Forest(), key >> shift
            change = np.flatnonzero((np.diff(key) != 0) | (np.diff(a) != 0) | (np.diff(b) != 0)) + 1
            bounds = np.array([0, *change.tolist(), len(key)])
            sizes = np.diff(bounds)
            alone = (sizes <= SMALL) & (a[bounds[:-1]] == b[bounds[:-1]])
            few = np.repeat(alone, sizes)
            _compare_small(ring, forest, start[few], np.concatenate([[0], np.cumsum(sizes[alone])]), own[few], ids[few], fps[few])
            for x, y in zip(bounds[:-1][~alone].tolist(), bounds[1:][~alone].tolist(), strict=True):
                right = role[x:y] != 1 if a[x] <= b[x] else (role[x:y] == 2) & ~own[x:y]
                _compare_large(ring, forest, int(start[x]), x + np.flatnonzero(role[x:y] <= 1), x + np.flatnonzero(right), ids, fps)
            return forest

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(6 + ring.lanes)]
            rows = [*columns[:6], np.stack([c.view(np.uint64) for c in columns[6:]], axis=1)]
            if held:
                rows = [np.concatenate(x) for x in zip(held, rows, strict=True)]
            key, a, b = rows[:3]
            last = len(key) - 1
            goes = np.flatnonzero((key != key[last]) | (a != a[last]) | (b != b[last]))
            split = int(goes[-1]) + 1 if len(goes) else 0
            held = [x[split:] for x in rows]
            if split and (found := links([x[:split] for x in rows])).links:
                yield found.batch()
        if held and (found := links(held)).links:
            yield found.batch()

    by = ["key", "a", "b"]
    return dealt.repartition(*by).sortWithinPartitions(*by).mapInArrow(run, "src bigint, dst bigint")


def near_duplicates(docs: DataFrame, shingle_words: int = 3, bits: int = 3, block: int = BLOCK, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: one row for each row of docs.

    component_id is the least doc_id of the class (null only where all its ids are null).
    bits is at most 3, for which the chain budgets above hold.
    """
    if not 0 <= bits <= 3:
        raise ValueError("the ring of four segments serves distances up to 3")
    marked = cut(fingerprints(docs, shingle_words, id_col, text_col))
    reps = cut(marked.groupBy("fp").agg(F.min("doc_id").alias("rep")))
    parts = connected_components(_links(_ring_keys(reps.select("fp")), block, Ring(1, 4, 16, bits)))
    grouped = reps.join(parts.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "rep", F.coalesce("component", "fp").alias("part"))
    least = grouped.groupBy("part").agg(F.min("rep").alias("component_id"))
    by_fp = grouped.join(least, "part").select("fp", "component_id")
    digits = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return marked.join(by_fp, "fp").select("doc_id", digits.alias("fingerprint"), "component_id")


# Similar texts


def _mixed(x: np.ndarray) -> np.ndarray:
    """The finalizer of SplitMix64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: bytes | None, words: int = 5) -> np.ndarray:
    """The distinct 64-bit hashes of a text's shingles, in order."""
    found = (text or b"").translate(_LOWER).split()
    if not found:
        return np.zeros(0, np.uint64)
    if len(found) <= words:
        return np.array([xxhash.xxh64_intdigest(b" ".join(found), 5)], np.uint64)
    h = np.fromiter(map(xxhash.xxh64_intdigest, found), np.uint64, len(found))
    out = h[: len(h) - words + 1].copy()
    for k in range(1, words):
        out = _mixed(out) + h[k : len(h) - words + 1 + k]
    return np.unique(_mixed(out))


def wide_fingerprint(shingles: np.ndarray, ring: Ring = WIDE) -> tuple[np.ndarray, np.ndarray]:
    """The lanes of a set's fingerprint; the positions of the four narrowest bits of each segment."""
    counts = np.concatenate([_bit_counts(_mixed(shingles + np.uint64(lane * 0x9E3779B97F4A7C15 % (1 << 64)))) for lane in range(ring.lanes)])
    margin = ring.cut(np.abs(2 * counts - len(shingles))[None, :])[0]
    weak = np.argsort(margin, axis=1, kind="stable")[:, :4].astype(np.uint8)
    return np.packbits((2 * counts > len(shingles)).astype(np.uint8), bitorder="little").view("<u8"), weak


def row_hashes(docs: DataFrame) -> list[Column]:
    """Two hashes over all columns that tell rows apart, nulls included."""
    every = [*(F.col(f"`{c}`").isNull() for c in docs.columns), *(F.col(f"`{c}`") for c in docs.columns)]
    return [F.xxhash64(F.lit(k), *every) for k in (1, 2)]


def _identified(docs: DataFrame, text_col: str) -> DataFrame:
    """r1, r2 (row_hashes), text."""
    r1, r2 = row_hashes(docs)
    return docs.select(r1.alias("r1"), r2.alias("r2"), F.col(text_col).cast("string").alias("text"))


def _set_key(shingles: np.ndarray) -> int:
    return xxhash.xxh64_intdigest(shingles.tobytes(), 6)


def _marked(docs: DataFrame, rank: Column, text_col: str, words: int, ring: Ring) -> DataFrame:
    """rank, r1, r2, key and n of the set, f0 ..., weak."""
    lanes = [f"f{k}" for k in range(ring.lanes)]
    r1, r2 = row_hashes(docs)
    rows = docs.select(rank.alias("rank"), r1.alias("r1"), r2.alias("r2"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        for batch in batches:
            texts = utf8(batch.column(3))
            for part in steps([len(t or b"") for t in texts]):
                sets = [shingle_set(texts[k], words) for k in part]
                made = [wide_fingerprint(s, ring) for s in sets]
                keys = np.array([_set_key(s) for s in sets], np.uint64).view(np.int64)
                fps = np.stack([f for f, _ in made]).view(np.int64)
                own = [batch.column(k).slice(part.start, len(part)) for k in range(3)]
                yield pa.RecordBatch.from_arrays(
                    [*own, pa.array(keys), pa.array(list(map(len, sets)), pa.int64()), *(pa.array(c) for c in fps.T), pa.array([w.tobytes() for _, w in made], pa.binary())],
                    ["rank", "r1", "r2", "key", "n", *lanes, "weak"],
                )

    return rows.mapInArrow(run, f"rank {rows.schema['rank'].dataType.simpleString()}, r1 bigint, r2 bigint, key bigint, n bigint, {' '.join(f'{c} bigint,' for c in lanes)} weak binary")


def _probe_keys(reps: DataFrame, ring: Ring) -> DataFrame:
    """key, size (negative where it only looks), id: where the fingerprints of reps (key, n, f0 ..., weak) are filed or look."""
    lanes = [f"f{k}" for k in range(ring.lanes)]

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            sizes = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int32)
            fps = np.stack([batch.column(2 + k).to_numpy(zero_copy_only=False) for k in range(ring.lanes)], axis=1)
            values = ring.cut(np.unpackbits(np.ascontiguousarray(fps).view(np.uint8), axis=1, bitorder="little")) @ (1 << np.arange(ring.width))
            weak = np.frombuffer(b"".join(batch.column(2 + ring.lanes).to_pylist()), np.uint8).reshape(-1, ring.segments, 4)
            for i in range(ring.segments):
                flips = 1 << weak[:, i].astype(np.int64)
                looked = [values[:, i], *(values[:, i] ^ np.bitwise_or.reduce(flips[:, list(p)], axis=1) for p in PROBES)]
                keys = np.concatenate(looked) | i << ring.width
                size = np.concatenate([sizes, np.tile(-sizes, len(PROBES))])
                yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array(size), pa.array(np.tile(ids, len(looked)))], ["key", "size", "id"])

    return reps.select("key", "n", *lanes, "weak").mapInArrow(run, "key bigint, size int, id bigint")


def _confirmed(docs: DataFrame, reps: DataFrame, loose: DataFrame, least: tuple[int, int], text_col: str, words: int, ring: Ring, block_shingles: int) -> DataFrame:
    """(src, dst): keys of sets in the same loose class that are similar enough; a forest that suffices."""
    num, den = least
    lanes = [f"f{k}" for k in range(ring.lanes)]
    mates = reps.join(loose.withColumnRenamed("node", "key").withColumnRenamed("component", "part"), "key")
    sizes = mates.groupBy("part").agg(F.sum("n").alias("total"))
    nb = F.ceil(F.col("total") / block_shingles).cast("int")
    dealt = mates.join(sizes, "part").select("part", "key", "n", "best.r1", "best.r2", *lanes, nb.alias("nb"), F.pmod(F.col("key"), nb).cast("int").alias("c"))

    def parse(batches):
        for batch in batches:
            texts = utf8(batch.column(batch.num_columns - 1))
            for part in steps([len(t or b"") for t in texts]):
                sets = [shingle_set(texts[k], words).astype("<u8").tobytes() for k in part]
                own = [batch.column(k).slice(part.start, len(part)) for k in range(batch.num_columns - 1)]
                yield pa.RecordBatch.from_arrays([*own, pa.array(sets, pa.binary())], [*batch.schema.names[:-1], "shingles"])

    texts = _identified(docs, text_col).join(dealt, ["r1", "r2"]).dropDuplicates(["key"])
    columns = ["part", "key", "nb", "c", *lanes]
    sets = cut(texts.select(*columns, "text").mapInArrow(parse, f"part bigint, key bigint, nb int, c int, {' '.join(f'{c} bigint,' for c in lanes)} shingles binary"))
    placed = F.transform(F.sequence(F.lit(0), F.col("nb") - 1), lambda j: F.struct(F.least(j, F.col("c")).alias("a"), F.greatest(j, F.col("c")).alias("b")))
    blocks = sets.withColumn("p", F.explode(placed)).select("part", "p.a", "p.b", "c", "key", *lanes, "shingles")

    def run(batches):
        held, group = [], None

        def close() -> _Forest:
            forest = _Forest()
            keys, c = np.array([r[0] for r in held]), np.array([r[1] for r in held])
            fps = np.array([r[2] for r in held], np.int64).view(np.uint64).reshape(len(held), -1)
            sets = [np.frombuffer(r[3], "<u8") for r in held]
            n = np.array([len(s) for s in sets])
            label = keys.copy()
            right = np.flatnonzero(c == group[2])
            for k in np.flatnonzero(c == group[1]).tolist():
                other = right[(label[right] != label[k]) & (np.minimum(n[right], n[k]) * den >= np.maximum(n[right], n[k]) * num)]
                other = other[other > k] if group[1] == group[2] else other
                distance = np.bitwise_count(fps[other] ^ fps[k]).sum(axis=1, dtype=np.int64)
                near = distance <= ring.budget
                for j in other[near][np.argsort(distance[near], kind="stable")].tolist():
                    if label[j] == label[k]:
                        continue
                    shared = len(np.intersect1d(sets[j], sets[k], assume_unique=True))
                    if shared * den >= (n[j] + n[k] - shared) * num:
                        forest.links.append((int(keys[k]), int(keys[j])))
                        label[label == label[j]] = label[k]
            return forest

        for batch in batches:
            rows = [batch.column(k).to_pylist() for k in range(batch.num_columns)]
            out = _Forest()
            for part, a, b, c, key, *rest in zip(*rows, strict=True):
                if (part, a, b) != group:
                    if len(held) > 1:
                        out.links += close().links
                    held, group = [], (part, a, b)
                held.append((key, c, rest[:-1], rest[-1]))
            if out.links:
                yield out.batch()
        if len(held) > 1 and (found := close()).links:
            yield found.batch()

    by = ["part", "a", "b"]
    return blocks.repartition(*by).sortWithinPartitions(*by, "key").mapInArrow(run, "src bigint, dst bigint")


def similar_texts(docs: DataFrame, rank: Column, words: int = 5, least: tuple[int, int] = (4, 5), ring: Ring = WIDE, block: int = BLOCK, block_shingles: int = 1 << 20, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two tables: part, best (one row a class of similar texts); key, part of each set of shingles.

    best is the least (rank, r1, r2) of the class, where r1, r2 are the row's row_hashes. least is the
    similarity of a link, as a fraction.
    """
    prepare(docs.sparkSession)
    lanes = [f"f{k}" for k in range(ring.lanes)]
    marked = cut(_marked(docs, rank, text_col, words, ring))
    reps = cut(marked.groupBy("key", "n").agg(F.min(F.struct("rank", "r1", "r2")).alias("best"), *(F.min(c).alias(c) for c in lanes), F.min("weak").alias("weak")))
    filled = reps.where("n > 0")
    loose = connected_components(_links(_probe_keys(filled, ring), block, ring, filled.select(F.col("key").alias("id"), *lanes), least))
    links = _confirmed(docs, reps, loose, least, text_col, words, ring, block_shingles)
    parts = connected_components(links).withColumnRenamed("node", "key")
    members = cut(reps.select("key", "best").join(parts, "key", "left").select("key", "best", F.coalesce("component", "key").alias("part")))
    return members.groupBy("part").agg(F.min("best").alias("best")), members.select("key", "part")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **params) -> DataFrame:
    """The rows of docs of which one of each class of similar texts stays, with all of their columns.

    It is the row of the least id, nulls last, then of the least row hashes; equal rows are one row.
    """
    rank = F.struct(F.col(id_col).isNull().alias("no_id"), F.col(id_col).cast("bigint").alias("id"))
    classes, _ = similar_texts(docs, rank, text_col=text_col, **params)
    first = classes.select("best.r1", "best.r2")
    r1, r2 = row_hashes(docs)
    packed = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), r1.alias("r1"), r2.alias("r2"))
    kept = packed.join(first, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"])
    return kept.select("row.*")
