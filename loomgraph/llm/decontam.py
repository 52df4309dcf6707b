"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

The patterns are the windows of the benchmark items (window consecutive words; an item of
fewer words is one window). For each window length a shift table, keyed by a block of two
consecutive words (one for windows of one word), tells how far the search may jump; where
the shift is zero, the block is the suffix of some windows, whose bucket is compared
directly. Words unknown to the benchmark give the longest jump.

Words are taken from the text with A-Z lower-cased: runs of a-z, 0-9 and non-ASCII
characters. A null text has no words; an item without words has no window. Each row of the
documents gives one row; repeated item ids count once. An empty benchmark hits nothing.
Texts of any length are searched whole. Other columns, whatever their names, are not read.
Items without an id hit words like any other: together they are one null at the end of the items
of a row, counted as an item but not joined into the list of ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._common import doc_columns, lower_ascii_table, steps, utf8
from loomgraph.session import cut, prepare

_WORDS = lower_ascii_table(lambda b: 48 <= b <= 57 or 97 <= b <= 122 or b >= 128)

HITS = "n_words bigint, n_hit bigint, items array<string>, spans array<int>"


def words_of(text: bytes | None) -> list[bytes]:
    return text.translate(_WORDS).split() if text else []


class WuManber:
    """Shift tables and suffix buckets of a bounded set of items, by window length."""

    def __init__(self, items: list[tuple[str | None, bytes]], window: int = 10):
        self.vocabulary: dict[bytes, int] = {}
        patterns: dict[int, dict[tuple[int, ...], set[str | None]]] = {}
        for item, text in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words_of(text)]
            n = min(window, len(ids))
            for i in range(len(ids) - n + 1) if n else ():
                patterns.setdefault(n, {}).setdefault(tuple(ids[i : i + n]), set()).add(item)
        self.size = len(self.vocabulary) + 1
        self.tables = [self._table(n, found) for n, found in sorted(patterns.items())]

    def _table(self, n: int, found: dict[tuple[int, ...], set[str]]):
        block = min(2, n)
        shifts: dict[int, int] = {}
        buckets: dict[int, dict[tuple[int, ...], frozenset[str]]] = {}
        for pattern, items in found.items():
            for end in range(block - 1, n):
                key = pattern[end] if block == 1 else pattern[end - 1] * self.size + pattern[end]
                shifts[key] = min(shifts.get(key, n), n - 1 - end)
            buckets.setdefault(key, {})[pattern] = frozenset(items)
        return n, block, n - block + 1, shifts, buckets

    def search(self, words: list[bytes]) -> tuple[int, set[str], list[int]]:
        """Words that are hit, items, and the hit ranges as [start, end, start, end, ...] of word numbers."""
        known = self.vocabulary
        ids = [known.get(w, 0) for w in words]
        size, total = self.size, len(ids)
        items: set[str] = set()
        starts: list[tuple[int, int]] = []
        for n, block, most, shifts, buckets in self.tables:
            at = n - 1
            while at < total:
                last = ids[at]
                key = last if block == 1 else ids[at - 1] * size + last
                shift = shifts.get(key, most)
                if shift:
                    at += shift
                    continue
                found = buckets[key].get(tuple(ids[at - n + 1 : at + 1]))  # compares the words themselves
                if found:
                    items |= found
                    starts.append((at - n + 1, at + 1))
                at += 1
        merged: list[int] = []
        for a, b in sorted(starts):
            if merged and a <= merged[-1]:
                merged[-1] = max(merged[-1], b)
            else:
                merged += [a, b]
        return sum(merged[1::2]) - sum(merged[::2]), items, merged


def _blocks(benchmark: DataFrame, limit: int, id_col: str, text_col: str) -> Iterator[list[tuple[str | None, bytes]]]:
    """The items in blocks of at most limit bytes of text (a longer item alone); the driver holds one at a time."""
    rows = benchmark.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).cast("string").alias("t")).where("t is not null")
    block: list[tuple[str | None, bytes]] = []
    size = 0
    for r in rows.distinct().orderBy("i", "t").toLocalIterator():
        text = r.t.encode("utf-8")
        if size + len(text) > limit and block:
            yield block
            block, size = [], 0
        block.append((r.i, text))
        size += len(text)
    yield block


def contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20, item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_hit, items (sorted as strings, null last), spans (hit ranges of word numbers).

    Each block of at most block_bytes of benchmark text is searched in a pass of its own, so
    what is broadcast at once is bounded whatever the benchmark's size; the usual benchmark is
    one block.
    """
    spark = prepare(docs.sparkSession)
    names, kinds = ["doc_id", "n_words", "n_hit", "items", "spans"], [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.list_(pa.int32())]

    def one(df: DataFrame, block: list[tuple[str | None, bytes]], again: bool) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches):
            wu = WuManber(shared.value, window)
            for batch in batches:
                texts = utf8(batch.column(1))
                for part in steps([len(t or b"") for t in texts]):
                    rows = []
                    for k in part:
                        words = words_of(texts[k])
                        n, items, spans = wu.search(words)
                        if again:
                            old_items, old_spans = batch.column(4)[k].as_py(), batch.column(5)[k].as_py()
                            items |= set(old_items)
                            spans = _union(spans, old_spans)
                            n = sum(spans[1::2]) - sum(spans[::2])
                        rows.append((len(words), n, sorted(items, key=lambda i: (i is None, i or "")), spans))
                    new = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds[1:], strict=True)]
                    doc, text = (batch.column(c).slice(part.start, len(part)) for c in range(2))
                    yield pa.RecordBatch.from_arrays([doc, text, *new], ["doc_id", "text", *names[1:]])

        return df.mapInArrow(run, f"doc_id bigint, text string, {HITS}")

    out = doc_columns(docs)
    for k, block in enumerate(_blocks(benchmark, block_bytes, item_col, item_text_col)):
        out = one(cut(out) if k and k % 8 == 0 else out, block, k > 0)
    return out.select(names)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, window: int = 10, block_bytes: int = 16 << 20, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of docs without a hit word, with all of their columns and no other."""
    spark = prepare(docs.sparkSession)
    text_at = docs.columns.index(text_col)

    def one(df: DataFrame, block: list[tuple[str | None, bytes]]) -> DataFrame:
        shared = spark.sparkContext.broadcast(block)

        def run(batches):
            wu = WuManber(shared.value, window)
            for batch in batches:
                texts = utf8(batch.column(text_at))
                for part in steps([len(t or b"") for t in texts]):
                    clean = pa.array([not wu.search(words_of(texts[k]))[0] for k in part], pa.bool_())
                    yield batch.slice(part.start, len(part)).filter(clean)

        return df.mapInArrow(run, docs.schema)

    out = docs
    for k, block in enumerate(_blocks(benchmark, block_bytes, item_col, item_text_col)):
        out = one(cut(out) if k and k % 8 == 0 else out, block)
    return out


def _union(a: list[int], b: list[int]) -> list[int]:
    out: list[int] = []
    for s, e in sorted([*zip(a[::2], a[1::2], strict=True), *zip(b[::2], b[1::2], strict=True)]):
        if out and s <= out[-1]:
            out[-1] = max(out[-1], e)
        else:
            out += [s, e]
    return out


def contamination_report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    return contaminated(docs, benchmark, window).select(
        "doc_id", "n_words", "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
