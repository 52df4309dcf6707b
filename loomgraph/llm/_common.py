"""What several operators of this subpackage share."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bytes of text that one step inside a Python worker looks at together.
STEP_BYTES = 2 << 20


def doc_columns(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id (bigint) and the text (string); other columns are never read."""
    return docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def remainder(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo divisor; null ids count as the text ''."""
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(divisor))


def crc_mod(doc_id: int | None, divisor: int) -> int:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % divisor


def utf8(column: pa.Array) -> list[bytes | None]:
    """The values of a string column as their UTF-8 bytes."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return column.cast(kind).to_pylist()


def steps(sizes: list[int], limit: int = STEP_BYTES) -> Iterator[range]:
    """Consecutive ranges of rows of about limit bytes together, at least one row each."""
    start, total = 0, 0
    for k, n in enumerate(sizes):
        if k > start and total + n > limit:
            yield range(start, k)
            start, total = k, 0
        total += n
    if start < len(sizes):
        yield range(start, len(sizes))


def lower_ascii_table(keep) -> bytes:
    """For bytes.translate: A-Z to a-z, bytes for which keep() is false to a space."""
    return bytes(b + 32 if 65 <= b <= 90 else (b if keep(b) else 32) for b in range(256))


def bounded_sample(rows: DataFrame, key: str, limit: int) -> DataFrame:
    """The limit rows whose keys have the smallest hashes: the same for any partitioning."""
    return rows.orderBy(F.xxhash64(F.col(key)), F.col(key)).limit(limit)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -40.0, 40.0)))


class WordCache:
    """Values of words, computed once a worker; cleared when it holds too many words.

    make(words) returns one row of values for each word; lookup(list of words) returns rows
    of the table for them.
    """

    def __init__(self, make, columns: dict[str, type], limit: int = 400_000):
        self.make, self.columns, self.limit = make, columns, limit
        self.clear()

    def clear(self) -> None:
        self.index: dict[bytes, int] = {}
        self.table = {c: np.empty(1024, t) for c, t in self.columns.items()}

    def learn(self, words) -> None:
        """Call before lookup() with all the words of a step."""
        new = [w for w in words if w not in self.index]
        if len(self.index) + len(new) > self.limit and self.index:
            self.clear()
            new = list(words)
        if not new:
            return
        at, end = len(self.index), len(self.index) + len(new)
        made = self.make(new)
        for c in self.columns:
            if end > len(self.table[c]):
                self.table[c] = np.concatenate([self.table[c][:at], np.empty(max(end, at * 2) - at, self.columns[c])])
            self.table[c][at:end] = made[c]
        self.index.update(zip(new, range(at, end), strict=True))

    def rows(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.index.__getitem__, words), np.int64, len(words))
