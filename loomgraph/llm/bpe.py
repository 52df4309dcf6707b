"""Byte-level BPE encoding and decoding by corpus-level merge replay.

The distinct new words of a step (STEP characters of texts) are laid end to end. An inverted index
maps the rank of each adjacent token pair (the rank of the joined bytes) to the positions in all words
where it stands. The merges are replayed in rank order: a rank's turn merges its pairs in all words
at once and touches only their two neighbours, whose new pairs enter the index. A turn of a lower rank
comes back only where a merge made such a pair, which must go first in its word. Encoded words are
kept in a bounded cache, so a word of the corpus is merged about once a worker.

Nulls count as empty texts (no ids). Texts of any length are encoded whole; ties of equal
ranks inside a word go to the leftmost pair. Repeated rows give repeated rows, empty tables
empty tables; columns other than the id and the text are not read.
"""

from __future__ import annotations

import base64
import re
import sys
from array import array
from heapq import heappop, heappush
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomgraph.llm._common import doc_columns, steps
from loomgraph.session import prepare

#: A single space between two characters that are no spaces always starts a token.
_CUT = re.compile(r"(?<=\S) (?=\S)")
_UNSURE = re.compile(r"\s \s")
#: Characters of text whose new words are merged together.
STEP = 1 << 22
#: The rank of what is no pair.
NONE = 1 << 62


def load_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a file of lines "base64 rank"."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


class MergeReplay:
    """Encodes many words together."""

    def __init__(self, ranks: dict[bytes, int]):
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int64)
        self.token = {w: _packed([r]) for w, r in ranks.items()}
        found = {a << 32 | b: r for w, r in ranks.items() for k in range(1, len(w)) if (a := ranks.get(w[:k])) is not None and (b := ranks.get(w[k:])) is not None}
        keys = np.array([*found, NONE], np.int64)  # the last is of no pair
        order = np.argsort(keys)
        self.pair_keys, self.pair_ranks = keys[order], np.array([*found.values(), -1], np.int64)[order]
        #: The rank of each pair of bytes, -1 without one.
        self.first = np.array([[ranks.get(bytes([a, b]), -1) for b in range(256)] for a in range(256)], np.int64)
        every = np.arange(max(ranks.values()) + 1)
        #: Ranks whose merge next to another of the same makes a pair of a lower rank.
        twice = self._ranks_of(every, every)
        self.falls = ((twice >= 0) & (twice < every)).tolist()

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """The ids of each word."""
        return [np.frombuffer(ids, "<u4").tolist() for ids in self.encode_packed(words)]

    def encode_packed(self, words: list[bytes]) -> list[bytes]:
        """Ids as little-endian unsigned 32-bit integers; a word that is a token is that token, others are merged."""
        out, known = [b""] * len(words), self.token.get
        rest = []
        for k, w in enumerate(words):
            ids = known(w)
            if ids is not None:
                out[k] = ids
            elif w:
                rest.append(k)
        for k, ids in zip(rest, self.replay([words[k] for k in rest]), strict=True):
            out[k] = ids
        return out

    def _ranks_of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The ranks of token pairs, -1 without one."""
        key = a << 32 | b
        at = np.searchsorted(self.pair_keys, key)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], -1)

    def replay(self, words: list[bytes], trace: list[tuple[int, int]] | None = None) -> list[bytes]:
        """Merges all words (none empty) together; trace gets (rank, merges) of each turn."""
        if not words:
            return []
        flat = np.frombuffer(b"".join(words), np.uint8)
        n, lengths = len(flat), np.fromiter(map(len, words), np.int64, len(words))
        ends = np.cumsum(lengths)
        sym, word = self.single[flat], np.repeat(np.arange(len(words)), lengths)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[ends - 1] = before[ends - lengths] = -1
        rank = np.full(n, -1)  # of the pair that begins at a position
        rank[:-1] = self.first[flat[:-1], flat[1:]]
        rank[after < 0] = -1
        index: dict[int, list[np.ndarray]] = {}  # rank of a pair: its positions
        heap: list[int] = []
        self._enter(index, heap, rank, np.arange(n))
        while heap:
            r = heappop(heap)
            found = index.pop(r)
            at = found[0] if len(found) == 1 else np.unique(np.concatenate(found))
            at = at[rank[at] == r]
            if not len(at):
                continue
            i, waits = self._turn(r, at, sym, word, after, before)
            if trace is not None:
                trace.append((r, len(i)))
            j = after[i]
            k = after[j]
            sym[i], sym[j], rank[j], after[i] = r, -1, -1, k
            inner = k >= 0
            before[k[inner]] = i[inner]
            rank[i] = -1
            rank[i[inner]] = self._ranks_of(sym[i[inner]], sym[k[inner]])
            p = before[i]
            p = p[p >= 0]
            rank[p] = self._ranks_of(sym[p], sym[after[p]])
            self._enter(index, heap, rank, np.unique(np.concatenate([i, p, waits])))
        return _cut(sym, ends)

    def _turn(self, r: int, at: np.ndarray, sym, word, after, before) -> tuple[np.ndarray, np.ndarray]:
        """The positions of pairs of rank r to merge now, and those that have to wait.

        Of overlapping pairs the left one goes. Where a merge makes a pair of a lower rank, that
        goes before the word's next pair of rank r: only the word's leftmost pair is merged now.
        """
        i = at
        clash = after[at[:-1]] == at[1:]
        if clash.any():
            k, starts = np.arange(len(at)), np.concatenate([[True], ~clash])
            i = at[(k - np.maximum.accumulate(np.where(starts, k, 0))) % 2 == 0]
        p, k = before[i], after[after[i]]
        right = np.where(k >= 0, self._ranks_of(np.full(len(i), r), sym[k]), -1)
        left = np.where(p >= 0, self._ranks_of(sym[p], np.full(len(i), r)), -1)
        falls = (right >= 0) & (right < r) | (left >= 0) & (left < r) | self.falls[r]
        if not falls.any():
            return i, i[:0]
        slow = np.unique(word[i[falls]])
        leftmost = np.concatenate([[True], word[i[1:]] != word[i[:-1]]])
        return i[leftmost | ~np.isin(word[i], slow)], at[np.isin(word[at], slow)]

    @staticmethod
    def _enter(index: dict[int, list[np.ndarray]], heap: list[int], rank: np.ndarray, at: np.ndarray) -> None:
        """Enters positions into the index under the ranks of their pairs."""
        r = rank[at]
        at, r = at[r >= 0], r[r >= 0]
        if not len(at):
            return
        order = np.argsort(r, kind="stable")
        at, r = at[order], r[order]
        cuts = np.flatnonzero(r[1:] != r[:-1]) + 1
        for q, part in zip(r[np.concatenate([[0], cuts])].tolist(), np.split(at, cuts), strict=True):
            if q in index:
                index[q].append(part)
            else:
                index[q] = [part]
                heappush(heap, q)


def _cut(sym: np.ndarray, ends: np.ndarray) -> list[bytes]:
    """The ids of each word, of the symbols that are left."""
    alive = np.flatnonzero(sym >= 0)
    cuts = (np.searchsorted(alive, ends) * 4).tolist()
    ids = sym[alive].astype("<u4").tobytes()
    return [ids[x:y] for x, y in zip([0, *cuts], cuts, strict=False)]


def _packed(ids: list[int]) -> bytes:
    out = array("I", ids)
    if sys.byteorder == "big":
        out.byteswap()
    return out.tobytes()


class Generations:
    """A bounded cache: what a generation does not use before the next one is full is forgotten."""

    def __init__(self, limit: int):
        self.limit, self.young, self.old = limit, {}, {}

    def missing(self, keys: set) -> set:
        """Keys without a value; values of all others are in young until the next call."""
        if len(self.young) > self.limit:
            self.old, self.young = self.young, {}
        return self.absent(keys)

    def absent(self, keys: set) -> set:
        """The same within a generation."""
        away = keys.difference(self.young)
        kept = away.intersection(self.old)
        self.young.update(zip(kept, map(self.old.__getitem__, kept), strict=True))
        return away - kept


class Encoder:
    """Whole texts to ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, limit: int = 100_000):
        self.replay, self.pattern = MergeReplay(ranks), regex.compile(pattern)
        self.cache = Generations(limit)  # of pieces; a word is a piece of one match

    def split(self, text: str) -> list[str]:
        """Pieces at whose borders a token surely starts."""
        first, *rest = text.split(" ") if not _UNSURE.search(text) else _CUT.split(text)
        return [first, *[" " + x for x in rest]]

    def encode(self, texts: list[str]) -> list[bytes]:
        pieces = [self.split(t) for t in texts]
        new = self.cache.missing(set(chain.from_iterable(pieces)))
        known = self.cache.young
        # a space and ASCII letters are one match
        unknown = {p for p in new if p[:1] == " " and (q := p[1:]).isascii() and q.isalpha()}
        mixed = list(new - unknown)
        found = list(map(self.pattern.findall, mixed))
        unknown = list(unknown | self.cache.absent(set(chain.from_iterable(found)) - unknown))
        known.update(zip(unknown, self.replay.encode_packed([w.encode("utf-8") for w in unknown]), strict=True))
        for p, ws in zip(mixed, found, strict=True):
            if len(ws) != 1:
                known[p] = b"".join(map(known.__getitem__, ws))
        return [b"".join(map(known.__getitem__, ps)) for ps in pieces]


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, pattern: str) -> Encoder:
    """One a worker, so that its caches serve all of its tasks."""
    if (path, pattern) not in _ENCODERS:
        _ENCODERS[path, pattern] = Encoder(load_ranks(path), pattern)
    return _ENCODERS[path, pattern]


def bpe_encode(docs: DataFrame, ranks_path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (binary: little-endian unsigned 32-bit integers), n_tokens."""
    prepare(docs.sparkSession)

    def run(batches):
        enc = encoder(ranks_path, pattern)
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for part in steps([len(t) for t in texts], STEP):
                ids = enc.encode(texts[part.start : part.stop])
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.start, len(part)), pa.array(ids, pa.binary()), pa.array([len(x) // 4 for x in ids], pa.int64())],
                    ["doc_id", "ids", "n_tokens"],
                )

    return doc_columns(docs, id_col, text_col).mapInArrow(run, "doc_id bigint, ids binary, n_tokens bigint")


def bpe_decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """The rows of bpe_encode() with decoded (binary) added. Null ids count as none."""
    prepare(encoded.sparkSession)

    def run(batches):
        pieces = {r: b for b, r in load_ranks(ranks_path).items()}
        for batch in batches:
            ids = batch.column(1).to_pylist()
            for part in steps([len(x or b"") for x in ids]):
                decoded = [b"".join(map(pieces.__getitem__, np.frombuffer(x or b"", "<u4").tolist())) for x in ids[part.start : part.stop]]
                at = (part.start, len(part))
                yield pa.RecordBatch.from_arrays([*(batch.column(k).slice(*at) for k in range(3)), pa.array(decoded, pa.binary())], ["doc_id", "ids", "n_tokens", "decoded"])

    return encoded.select("doc_id", "ids", "n_tokens").mapInArrow(run, "doc_id bigint, ids binary, n_tokens bigint, decoded binary")


def bpe_digests(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of the round trip."""
    trip = bpe_decode(bpe_encode(docs, ranks_path, pattern), ranks_path)
    return trip.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
