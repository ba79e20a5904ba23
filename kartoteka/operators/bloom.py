"""Surname membership by a Bloom filter of fixed size."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.functions.text import fold_marks

CAPACITY, ERROR_RATE = 200_000, 0.01


def sizing(n: int = CAPACITY, p: float = ERROR_RATE) -> tuple[int, int]:
    """Bits and hash functions for ``n`` values at error rate ``p``."""
    bits = -int(n * math.log(p) / math.log(2) ** 2)
    return bits, max(1, int(bits / n * math.log(2)))


def _murmur3(data: bytes, seed: int) -> int:
    """32-bit Murmur3, signed (public domain algorithm)."""
    mask, h, n = 0xFFFFFFFF, seed & 0xFFFFFFFF, len(data)
    for at in range(0, n + 1, 4):
        chunk = data[at : at + 4]
        k = int.from_bytes(chunk, "little") * 0xCC9E2D51 & mask
        k = (k << 15 | k >> 17) & mask
        h ^= k * 0x1B873593 & mask
        if len(chunk) < 4:
            break
        h = (h << 13 | h >> 19) & mask
        h = h * 5 + 0xE6546B64 & mask
    h ^= n
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        h = (h ^ h >> shift) * factor & mask
    h ^= h >> 16
    return h - (1 << 32) if h >> 31 else h


@dataclass
class BloomFilter:
    """``size`` bits, ``hashes`` functions; ``bits`` packs them, lowest position first within big-endian bytes."""

    size: int
    hashes: int
    bits: np.ndarray

    @classmethod
    def empty(cls, n: int = CAPACITY, p: float = ERROR_RATE) -> BloomFilter:
        size, hashes = sizing(n, p)
        return cls(size, hashes, np.zeros(-(-size // 8), dtype=np.uint8))

    @classmethod
    def train(cls, names: DataFrame, column: str, n: int = CAPACITY, p: float = ERROR_RATE) -> BloomFilter:
        """A filter of all names of a column. Each partition fills its own bits, which are joined by OR in byte slices, so what
        the driver gets is the filter, whose size depends on ``n`` and ``p`` alone."""
        size, hashes = sizing(n, p)

        def fill(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            bits = np.zeros(-(-size // 8), dtype=np.uint8)
            for batch in batches:
                for name in batch["name"]:
                    for at in _positions(name, size, hashes):
                        bits[at >> 3] |= 0x80 >> (at & 7)
            where = np.flatnonzero(bits)
            yield pd.DataFrame({"at": where, "byte": bits[where].astype("int32")})

        rows = names.select(fold_marks(F.col(column)).alias("name")).where("name <> ''").distinct()
        filled = rows.mapInPandas(fill, "at bigint, byte int").groupBy("at").agg(F.bit_or("byte").alias("byte")).toPandas()
        out = cls(size, hashes, np.zeros(-(-size // 8), dtype=np.uint8))
        out.bits[filled["at"].to_numpy()] = filled["byte"].to_numpy(dtype=np.uint8)
        return out

    def has(self, folded: str) -> bool:
        """Whether a folded name may be in the filter; the empty name never is."""
        return bool(folded) and all(self.bits[at >> 3] & (0x80 >> (at & 7)) for at in _positions(folded, self.size, self.hashes))

    def check(self, names: Column, df: DataFrame) -> Column:
        """Boolean column for ``names`` of ``df``; the filter is broadcast, as its size is fixed."""
        book = df.sparkSession.sparkContext.broadcast(self)

        @F.pandas_udf(T.BooleanType())
        def test(folded: pd.Series) -> pd.Series:
            codes, distinct = pd.factorize(folded)
            values = np.array([book.value.has(s) for s in distinct] + [False])
            return pd.Series(values[codes])

        return test(fold_marks(names))

    def save(self, path: str | Path) -> None:
        Path(path).write_bytes(f"{self.size},{self.hashes}\n".encode() + self.bits.tobytes())

    @classmethod
    def load(cls, path: str | Path) -> BloomFilter:
        head, _, body = Path(path).read_bytes().partition(b"\n")
        size, hashes = map(int, head.split(b","))
        return cls(size, hashes, np.frombuffer(body, dtype=np.uint8)[: -(-size // 8)].copy())


def _positions(folded: str, size: int, hashes: int) -> list[int]:
    data = folded.encode()
    return [_murmur3(data, seed) % size for seed in range(hashes)]


def hit_rate(names: DataFrame, column: str, bloom: BloomFilter) -> DataFrame:
    """One row ``hit_rate``: part of the names that pass; 0 for no names."""
    hits = names.select(bloom.check(F.col(column), names).cast("double").alias("hit"))
    return hits.agg(F.coalesce(F.avg("hit"), F.lit(0.0)).alias("hit_rate"))
