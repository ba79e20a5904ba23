"""Strings within a few edits of each other: common subsequences for short ones, segment index and probing windows for the others."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def even_segments(n: int, k: int) -> list[tuple[int, int]]:
    """Start (from 1) and length of ``k + 1`` segments of nearly equal length."""
    parts = k + 1
    ends = [round(i * n / parts) for i in range(parts + 1)]
    return [(a + 1, b - a) for a, b in zip(ends, ends[1:])]


@dataclass
class SegmentTables:
    """For each length: the segments to index, and the substrings to probe with. A few rows per length, so broadcast.

    ``edits(n, m)`` is the number of edits allowed between strings of lengths ``n <= m``, negative for none.
    """

    index: DataFrame
    probe: DataFrame

    @classmethod
    def upto(cls, spark: SparkSession, longest: int, edits: Callable[[int, int], int], widest: Callable[[int], int]) -> SegmentTables:
        index, probe = set(), set()
        for n in range(1, longest + 1):
            for m in range(n, min(longest, widest(n)) + 1):
                k, gap = edits(n, m), m - n
                if k < gap:
                    continue
                if n <= k:  # too short for k + 1 segments: all strings of these lengths are candidates
                    index.add((n, n, k, -1, 1, 0))
                    probe.add((m, n, k, -1, 1, 0))
                    continue
                for i, (start, size) in enumerate(even_segments(n, k)):
                    index.add((n, n, k, i, start, size))
                    for shift in range(-k, k + 1):
                        at = start + shift
                        if at >= 1 and at + size - 1 <= m and abs(shift) <= i and abs(shift - gap) <= k - i:
                            probe.add((m, n, k, i, at, size))
        kind = "m int, n int, k int, i int, at int, size int"
        return cls(spark.createDataFrame(sorted(index), kind), spark.createDataFrame(sorted(probe), kind))


def candidates(names: DataFrame, tables: SegmentTables, near: Column, parts: int) -> DataFrame:
    """``a, b`` (with repeats): pairs of ``text`` of ``names`` that share a segment at a fitting place and are ``near``, a condition on
    ``a, b`` and the other columns of both, named ``a_...`` and ``b_...``, that is checked within the join. Every pair within the
    allowed edits is among them."""

    def cut_texts(table: DataFrame, name: str) -> DataFrame:
        rows = names.join(F.broadcast(table), F.length("text") == F.col("m"))
        seg = F.xxhash64("n", "k", "i", F.substring("text", F.col("at"), F.col("size"))).alias("key")
        return rows.select(*_named(names, name), seg)

    return joined(cut_texts(tables.index, "a"), cut_texts(tables.probe, "b"), near, parts)


def joined(left: DataFrame, right: DataFrame, near: Column, parts: int) -> DataFrame:
    """``a, b`` of rows with equal ``key`` that are ``near``. ``left`` should be the smaller one."""
    left, right = left.repartition(parts, "key"), right.repartition(parts, "key").withColumnRenamed("key", "b_key")
    return left.hint("shuffle_hash").join(right, (F.col("key") == F.col("b_key")) & near).select("a", "b")


def _named(names: DataFrame, name: str) -> list[Column]:
    return [F.col("text").alias(name), *(F.col(c).alias(f"{name}_{c}") for c in names.columns if c != "text")]


def code_points(texts: list[str], width: int, pad: int = 0) -> np.ndarray:
    """One row of ``width`` code points for each text, filled up with ``pad``."""
    out = np.full((len(texts), width), pad, dtype=np.uint32)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    out[np.arange(width) < sizes[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    return out


@F.pandas_udf(T.LongType())
def letters(text: pd.Series) -> pd.Series:
    """62 bits: two for each of a to z (once, twice at least), ten for all other characters. An insertion or deletion changes one bit at most."""
    out, sizes = np.zeros(len(text), np.int64), text.str.len().to_numpy()
    for n in np.unique(sizes[sizes > 0]):
        at = np.flatnonzero(sizes == n)
        codes = code_points(text.iloc[at].tolist(), n)
        plain = (codes >= 97) & (codes <= 122)
        for c in range(26):
            found = (codes == 97 + c).sum(axis=1)
            out[at] |= (found >= 1) * np.int64(1 << 2 * c) | (found >= 2) * np.int64(2 << 2 * c)
        for c in range(10):
            out[at] |= (~plain & (codes % 10 == c)).any(axis=1) * np.int64(1 << 52 + c)
    return pd.Series(out)


def by_subsequence(n: int, m: int, k: int) -> bool:
    """Whether texts of lengths ``n <= m`` with ``k`` insertions and deletions are found by :func:`subsequence_pairs`: few characters are
    to be left out, so few keys are needed."""
    short, long = (k - (m - n)) // 2, (k + m - n) // 2
    return 0 < long <= 2 or (short <= 1 and 2 < long <= 4)


def subsequence_pairs(names: DataFrame, longest: int, edits: Callable[[int, int], int], widest: Callable[[int], int], near: Column, parts: int) -> DataFrame:
    """``a, b`` (with repeats), like :func:`candidates`, for the lengths of :func:`by_subsequence`.

    Texts of lengths ``n`` and ``m`` within ``k`` insertions and deletions have a common subsequence of ``(n + m - k) / 2`` characters.
    Its first ``r`` are left when ``n`` or ``m`` less that number are taken from the text's start; they and its length are the key.
    Unlike segments, which many texts share at their ends, keys stay rare however many texts there are.
    """
    short, long = defaultdict(set), defaultdict(set)
    for n in range(1, longest + 1):
        for m in range(n, min(longest, widest(n)) + 1):
            k = edits(n, m)
            if k >= m - n and by_subsequence(n, m, k):
                common = (n + m - k) // 2
                r = min(common, 6 if m - common <= 2 else 5)
                short[n].add((common, r))
                long[m].add((common, r))

    def keyed(wanted: dict[int, set[tuple[int, int]]], name: str) -> DataFrame:
        kind = T.StructType([*names.schema.fields, T.StructField("keys", T.ArrayType(T.LongType()))])
        plan = {n: sorted(x) for n, x in wanted.items()}

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column("text").to_pylist()
                sizes = np.fromiter(map(len, texts), np.int64, len(texts))
                for n in np.unique(sizes).tolist():
                    if n not in plan:
                        continue
                    at = np.flatnonzero(sizes == n)
                    keys = np.sort(subsequence_keys([texts[i] for i in at], n, plan[n]), axis=1)
                    once = np.ones(keys.shape, bool)
                    once[:, 1:] = keys[:, 1:] != keys[:, :-1]
                    ends = np.concatenate([[0], once.sum(axis=1).cumsum()]).astype(np.int32)
                    lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[once]))
                    yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, lists], [*batch.schema.names, "keys"])

        rows = names.where(F.length("text").isin(sorted(wanted))).mapInArrow(run, kind)
        return rows.select(*_named(names, name), F.explode("keys").alias("key"))

    return joined(keyed(short, "a"), keyed(long, "b"), near, parts)


def subsequence_keys(texts: list[str], n: int, wanted: list[tuple[int, int]]) -> np.ndarray:
    """A row of keys for each text of length ``n``: for each ``common, r`` a key of every way to take ``r`` characters in order from the
    first ``n - common + r``."""
    codes, out = code_points(texts, n).astype(np.uint64), []
    for common, r in wanted:
        ways = np.array(list(combinations(range(n - common + r), r)), dtype=np.int64)
        key = np.full((len(texts), len(ways)), common * 64 + r, np.uint64)
        for j in range(r):
            key = key * np.uint64(0x9E3779B97F4A7C15) + codes[:, ways[:, j]]
        out.append(key)
    return np.concatenate(out, axis=1).view(np.int64)


def indel_budget(threshold: float) -> tuple[Callable[[int, int], int], Callable[[int], int]]:
    """Insertions and deletions allowed between lengths ``n <= m`` for a similarity ``1 - indel / (n + m)`` of ``threshold``, and
    the greatest ``m`` for ``n``. As their number has the parity of ``m - n``, the bound is lowered to it."""

    def edits(n: int, m: int) -> int:
        most = math.floor((1 - threshold) * (n + m) + 1e-9)
        return most - (most - (m - n)) % 2

    return edits, lambda n: math.floor(n * (2 - threshold) / threshold + 1e-9)
