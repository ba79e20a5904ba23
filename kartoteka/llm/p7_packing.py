"""Containers of fixed capacity filled with whole texts: a configuration linear program over the length histogram."""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from kartoteka.cluster import cut
from kartoteka.llm.tokens import VOCABULARY, with_tokens

#: Most rounds of the multiplicative weights method in one program, and how sharply a covered length loses its price.
ROUNDS, RATE = 3_000, 20.0
#: The fractional solution over all items ends within this part of its lower bound.
GAP = 0.03
#: A configuration may be worth this part less than the best one over all lengths; such ones are looked for in random groups of 48
#: to 192 lengths, and the best one itself in every ``EXACT``-th round and whenever no group has one.
SLACK, GROUP_WORK, EXACT = 0.3, 98_304, 8
#: Ways of rounding: of each solution one in so many containers is taken, the best ones, and the program over the items of the
#: others ends within this part of its bound. The next way is tried where no plan so far is as good as the lower bound allows.
WAYS = (4, 0.2), (1, 0.05), (8, 0.1)
#: Lengths covered by so much more than the scarcest one have no price until that one has caught up.
AHEAD = 0.5
#: Cells of a knapsack's table held at once; larger ones are computed again block by block when its choice is read off.
CELLS = 1 << 26
#: Plans whose numbers of containers differ by this part at most count as alike; the one that leaves least to best fit is taken.
ALIKE = 0.001
#: Items that share a bucket of one length are numbered together.
BUCKET_ROWS = 50_000
#: Largest capacity: the histogram, its program and the plan on the driver grow with the capacity, never with the rows.
MAX_CAPACITY = 65_536


def knapsack(lengths: np.ndarray, values: np.ndarray, capacity: int) -> tuple[dict[int, int], float]:
    """The most valuable multiset of lengths within the capacity, as ``{position in lengths: times}``, and its value.
    ``lengths`` is positive."""
    return bounded_knapsack(lengths, values, capacity // lengths, capacity)


def bounded_knapsack(lengths: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> tuple[dict[int, int], float]:
    """:func:`knapsack` with at most so many of each length. Numbers are split into powers of two; one vector step over all
    fillings for each part."""
    parts = []
    for i, length in enumerate(lengths.tolist()):
        left, times = min(int(most[i]), capacity // length), 1
        while left > 0 and values[i] > 0:
            times = min(times, left)
            parts.append((i, times, times * length, times * float(values[i])))
            left -= times
            times *= 2
    best, new = np.zeros(capacity + 1), np.empty(capacity + 1)
    block = max(1, CELLS // (capacity + 1))
    taken = np.zeros((min(block, len(parts)), capacity + 1), dtype=bool)
    before: list[np.ndarray] = []  # the best values in front of each block

    def fill(start: int) -> None:
        for row, (_, _, size, value) in zip(taken, parts[start : start + block]):
            end = capacity + 1 - size
            np.add(best[:end], value, out=new[:end])
            row[:size] = False
            np.greater(new[:end], best[size:], out=row[size:])
            np.maximum(new[:end], best[size:], out=best[size:])

    starts = range(0, len(parts), block)
    for start in starts:
        before.append(best.copy() if len(starts) > 1 else best)
        fill(start)
    worth, w = float(best[capacity]), capacity
    chosen: Counter[int] = Counter()
    for start in reversed(starts):
        if start != starts[-1]:
            best = before[start // block]
            fill(start)
        for row, (i, times, size, _) in reversed(list(zip(taken, parts[start : start + block]))):
            if row[w]:
                chosen[i] += times
                w -= size
    return dict(chosen), worth


def fractional(lengths: np.ndarray, counts: np.ndarray, capacity: int, gap: float = GAP, rounds: int = ROUNDS) -> tuple[dict[tuple, float], float, np.ndarray]:
    """The configuration program solved in fractions: ``{((position in lengths, times), ...): multiplicity}`` that together cover
    every length's count, a lower bound of any such solution and so of the number of containers, and the dual prices that give it.

    Multiplicative weights on the covering program: a length's price falls exponentially with the part of its items covered so
    far, from its share of a container. Each round a knapsack with these prices finds configurations, whose multiplicities grow
    together. Prices divided by the value of the best configuration are a feasible dual, so each knapsack over all lengths gives
    a lower bound (as do the shares of a container and the items above half of one); its value stays a ceiling later, as prices
    only fall. It ends within ``gap`` of the bound, or after ``rounds``
    with what covers all lengths by then.
    """
    size, covered, draw = lengths / capacity, np.zeros(len(lengths)), np.random.default_rng(0)
    bound, dual = max(((float(y @ counts), y) for y in (size, (2 * lengths > capacity).astype(float))), key=lambda d: d[0])
    groups = max(1, min(len(lengths) // max(48, min(192, GROUP_WORK // capacity)), int(bound / 2)))
    found: dict[tuple, float] = {}
    total, ceiling, low, since, k = 0.0, np.inf, 0.0, EXACT, 0
    while (k < rounds or low <= 0) and not (low > 0 and total <= (1 + gap) * bound * low):
        k += 1
        prices = np.where(covered - low > AHEAD, 0.0, size * np.exp(-RATE * (covered - low)))
        fresh = []
        for some in np.array_split(draw.permutation(len(lengths)), groups) if groups > 1 else ():
            chosen, value = bounded_knapsack(lengths[some], prices[some], counts[some], capacity)
            if value > 0 and value >= (1 - SLACK) * ceiling:
                fresh.append([(int(some[i]), n) for i, n in chosen.items()])
        since += 1
        if since >= EXACT or not fresh:
            chosen, ceiling = bounded_knapsack(lengths, prices, counts, capacity)
            since = 0
            if float(counts @ prices) / ceiling > bound:
                bound, dual = float(counts @ prices) / ceiling, prices / ceiling
            fresh.append(list(chosen.items()))
        grown, steps = np.zeros(len(lengths)), []
        for config in fresh:
            at, n = np.array(config).T
            part = n / counts[at]
            steps.append(1 / part.max())
            grown[at] += steps[-1] * part
        step = 0.5 / RATE / grown.max()
        for config, each in zip(fresh, steps):
            key = tuple(sorted(config))
            found[key] = found.get(key, 0.0) + step * each
        covered += step * grown
        total += step * sum(steps)
        ceiling, low = ceiling * float(np.exp(RATE * (covered.min() - low))), float(covered.min())
    return {config: x / low for config, x in found.items()}, bound, dual


def best_fit(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit decreasing, as ``(configuration, times)``. Items of one length and containers filled alike are taken together:
    best fit puts items of one length into a container until no more fits, so each length adds at most two kinds."""
    bins: dict[int, list[tuple[dict[int, int], int]]] = {}  # by free space
    space: list[int] = []  # free spaces, ascending

    def put(free: int, kind: dict[int, int], times: int) -> None:
        if free not in bins:
            insort(space, free)
        bins.setdefault(free, []).append((kind, times))

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        for free in [*space[bisect_left(space, length) :], capacity]:
            each = free // length
            kinds = bins.pop(free, [])
            if kinds:
                space.remove(free)
            if free == capacity:
                kinds.append(({}, -(-left // each)))
            for kind, times in kinds:
                whole = min(times, left // each)
                part = left - whole * each if whole < times else 0
                left -= whole * each + part
                if whole:
                    put(free - each * length, kind | {length: each}, whole)
                if part:
                    put(free - part * length, kind | {length: part}, 1)
                if times > whole + (part > 0):
                    put(free, kind, times - whole - (part > 0))
            if not left:
                break
    return [k for kinds in bins.values() for k in kinds]


def _rounded(lengths: np.ndarray, counts: np.ndarray, found: dict[tuple, float], dual: np.ndarray, parts: int) -> list[tuple[dict[int, int], int]]:
    """Whole multiples of a fractional solution that the counts allow: one in ``parts`` of its containers, but at least one, those
    first whose items the dual prices most (where space alone is scarce, the fullest). The fraction of each configuration is carried to the next one, in the order of their longest lengths."""
    left = dict(zip(lengths.tolist(), counts.tolist()))
    configs = [({int(lengths[i]): n for i, n in key}, x) for key, x in found.items()]
    configs.sort(key=lambda c: sorted(c[0].items(), reverse=True), reverse=True)
    sums = np.floor(np.cumsum([x for _, x in configs]) + 0.5).astype(np.int64)
    whole = [(config, int(n)) for (config, _), n in zip(configs, np.diff(sums, prepend=0)) if n] or [(configs[0][0], 1)]
    price = dict(zip(lengths.tolist(), dual.tolist()))
    share, out = -(-sum(n for _, n in whole) // parts), []
    for config, n in sorted(whole, key=lambda c: (-round(sum(price[length] * k for length, k in c[0].items()), 9), -sum(length * k for length, k in c[0].items()))):
        times = min(n, share, *(left[length] // k for length, k in config.items()))
        if times:
            out.append((config, times))
            share -= times
            for length, k in config.items():
                left[length] -= k * times
    return out


def plan(histogram: dict[int, int], capacity: int, rounds: int = ROUNDS) -> tuple[list[tuple[dict[int, int], int]], float, int]:
    """``(configuration, times)`` that holds exactly the histogram's items, a lower bound of the number of containers, and the
    number of items that the program left to best fit.

    The configuration program is solved in fractions (:func:`fractional`) and rounded to whole multiples, those configurations
    first that the dual prices most. What they leave is solved and rounded again, until nothing is left. Neither the rounds nor the plan
    grow with the counts. The lower bound is the dual of the program over all items.

    After each program the rest could be packed best-fit; of the plans within ``ALIKE`` of the fewest containers the one that
    leaves least to best fit is kept. At least one program is in each. Other ``WAYS`` of rounding are tried while the fewest
    containers are more than the bound, rounded up or with ``ALIKE`` added.
    """
    items = {length: n for length, n in histogram.items() if 0 < length < capacity and n > 0}
    full = histogram.get(capacity, 0)
    head: list[tuple[dict[int, int], int]] = [({capacity: 1}, full)] if full else []
    if not items:
        return head, float(full), 0
    lengths = np.array(sorted(items))
    counts = np.array([items[int(x)] for x in lengths])
    first, low, prices = fractional(lengths, counts, capacity, GAP, rounds)
    enough = max(np.ceil(low - 1e-6), low * (1 + ALIKE))
    plans: list[tuple[int, int, list, int, list]] = []  # containers, items left, configurations, how many of them before, best fit of the rest
    for parts, gap in WAYS:
        some, left, found, dual, out, used = lengths, counts, first, prices, [], 0
        while True:
            taken = _rounded(some, left, found, dual, parts)
            rest = Counter(dict(zip(some.tolist(), left.tolist())))
            for config, times in taken:
                rest.subtract({length: k * times for length, k in config.items()})
                used += times
            out += taken
            rest = {length: n for length, n in rest.items() if n}
            tail = best_fit(rest, capacity)
            plans.append((used + sum(t for _, t in tail), sum(rest.values()), out, len(out), tail))
            if not rest:
                break
            some = np.array(sorted(rest))
            left = np.array([rest[int(x)] for x in some])
            found, _, dual = fractional(some, left, capacity, gap, rounds)
        if min(p[0] for p in plans) <= enough:
            break
    fewest = min(p[0] for p in plans)
    _, loose, out, n, tail = min((p for p in plans if p[0] <= fewest * (1 + ALIKE)), key=lambda p: (p[1], p[0]))
    return head + out[:n] + tail, full + low, loose


def _slots(plans: dict[int, list[tuple[dict[int, int], int]]]) -> pd.DataFrame:
    """For each capacity and length the runs of item numbers that go into successive containers of one configuration."""
    rows = []
    for pack, configs in plans.items():
        base, at = 0, Counter()
        for config, times in configs:
            for length, n in config.items():
                rows.append((pack, length, at[length], base, n))
                at[length] += n * times
            base += times
    return pd.DataFrame(rows, columns=["pack_id", "length", "first", "base", "n"])


def pack(documents: DataFrame, sizes: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str = VOCABULARY, rounds: int = ROUNDS) -> DataFrame:
    """``pack_id, container_id, doc_id, piece, n_tokens`` for each capacity of ``sizes`` (``pack_id, capacity_tokens``).

    A text stays whole unless it exceeds the capacity; such a text is cut into full pieces and a rest, numbered from 0.
    The driver only sees the histogram of piece lengths (at most as many numbers as the capacity) and solves the
    configuration program over it (:func:`plan`), at any number of items; items are then numbered within their length by buckets and looked up in the plan, so no
    length's items meet in one task. Null and empty texts take no space and are left out; repeated ids count as own texts.
    """
    packs = [(int(r[0]), int(r[1])) for r in sizes.where("capacity_tokens > 0").select("pack_id", "capacity_tokens").distinct().collect()]
    if any(c > MAX_CAPACITY for _, c in packs):
        raise ValueError(f"capacities up to {MAX_CAPACITY} tokens")
    counted = cut(with_tokens(documents.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")), "text", path).where("n_tokens > 0"))
    each = F.explode(F.array(*[F.struct(F.lit(p).alias("pack_id"), F.lit(c).alias("capacity")) for p, c in packs]) if packs else F.array().cast("array<struct<pack_id:int,capacity:int>>"))
    items = counted.select("doc_id", "n_tokens", each.alias("p"))
    whole = (F.col("n_tokens") / F.col("p.capacity")).cast("bigint")
    items = items.select("doc_id", F.col("p.pack_id").alias("pack_id"), F.col("p.capacity").alias("capacity"), "n_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), F.ceil(F.col("n_tokens") / F.col("p.capacity")) - 1)).alias("piece"))
    length = F.least(F.col("capacity").cast("bigint"), F.col("n_tokens") - F.col("piece") * F.col("capacity")).cast("int")
    items = items.select("doc_id", "pack_id", "piece", length.alias("length"))
    histogram: dict[int, dict[int, int]] = {p: {} for p, _ in packs}
    for r in items.groupBy("pack_id", "length").agg(F.count("*")).collect():  # at most the sum of the capacities
        histogram[r[0]][r[1]] = r[2]
    plans = {p: plan(histogram[p], c, rounds)[0] for p, c in packs}
    slots = _slots(plans)
    key = slots["pack_id"].to_numpy(dtype="int64") * (MAX_CAPACITY + 1) + slots["length"].to_numpy(dtype="int64")
    order = np.lexsort((slots["first"].to_numpy(dtype="int64"), key))
    book = documents.sparkSession.sparkContext.broadcast((key[order], *(slots[c].to_numpy(dtype="int64")[order] for c in ("first", "base", "n"))))

    @F.pandas_udf(T.LongType())
    def container(pack_id: pd.Series, length: pd.Series, number: pd.Series) -> pd.Series:
        keys, first, base, times = book.value
        own = pack_id.to_numpy(dtype="int64") * (MAX_CAPACITY + 1) + length.to_numpy(dtype="int64")
        rank = number.to_numpy(dtype="int64")
        low, high = np.searchsorted(keys, own, "left"), np.searchsorted(keys, own, "right")
        while True:  # binary search for the last run that starts at or before the number, in all rows at once
            mid = (low + high) // 2
            wide = high - low > 1
            if not wide.any():
                break
            up = wide & (first[mid] <= rank)
            low = np.where(up, mid, low)
            high = np.where(wide & ~up, mid, high)
        return pd.Series(base[low] + (rank - first[low]) // times[low])

    n_items = sum(sum(h.values()) for h in histogram.values())
    buckets = max(1, -(-n_items // BUCKET_ROWS))
    items = items.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(buckets)).cast("int"))
    keys = ["pack_id", "length", "bucket"]
    sums = items.groupBy(*keys).agg(F.count("*").alias("n"))
    before = W.partitionBy("pack_id", "length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select(*keys, F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    numbered = items.withColumn("number", F.row_number().over(W.partitionBy(*keys).orderBy("doc_id", "piece")) - 1).join(offsets, keys)
    at = container("pack_id", "length", (F.col("number") + F.col("offset")).cast("bigint"))
    return numbered.select("pack_id", at.alias("container_id"), "doc_id", F.col("piece").cast("int"), F.col("length").alias("n_tokens"))


def report(packed: DataFrame, sizes: DataFrame) -> DataFrame:
    """``pack_id, containers, tokens, fill, least``: containers used, their fill, and how few could hold the tokens at best."""
    used = packed.groupBy("pack_id", "container_id").agg(F.sum("n_tokens").alias("t"))
    by = used.groupBy("pack_id").agg(F.count("*").alias("containers"), F.sum("t").alias("tokens")).join(F.broadcast(sizes.select("pack_id", "capacity_tokens")), "pack_id")
    return by.select("pack_id", "containers", "tokens", (F.col("tokens") / (F.col("containers") * F.col("capacity_tokens"))).alias("fill"), F.ceil(F.col("tokens") / F.col("capacity_tokens")).alias("least"))
