"""Given names learned from the data: frequent tokens that no list knows, and the names whose place they take in other rows."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kartoteka.cluster import cut
from kartoteka.llm.given_names import FILLERS, Names, _edits, _shortened, osa, plain, seed

#: A token is frequent with this part of all tokens, and LEAST of them, so at most so many tokens ever come to the driver.
FREQUENT_TOKENS, LEAST = 20_000, 5
#: A token is a typo of one that is one or two edits away and so many times as frequent.
TYPO = {1: 15, 2: 300}
#: A form stands for the name that takes its place under this weight of surnames, in this part of all exchanges, and so many
#: times as often as chance has it.
WEIGHT, PART, LIFT = 1.0, 0.2, 5.0


def given_tokens(given: str) -> F.Column:
    """Words of a given_names value, in lower case: of the list's items, or of the text where it is no list."""
    items = F.coalesce(F.from_json(given, "array<string>"), F.array(F.col(given)))
    return F.flatten(F.transform(items, lambda x: F.regexp_extract_all(F.lower(F.coalesce(x, F.lit(""))), F.lit(r"[\p{L}\p{M}]{2,}"), F.lit(0))))


def frequent_tokens(persons: DataFrame, given: str) -> dict[str, tuple[str, int]]:
    """``plain form -> (most frequent spelling, count)`` of the frequent tokens. Partial aggregates; the driver gets at most
    ``FREQUENT_TOKENS`` spellings."""
    counts = cut(persons.select(F.explode(given_tokens(given)).alias("t")).groupBy("t").agg(F.count("*").alias("n")))
    total = counts.agg(F.sum("n")).first()[0] or 0
    by: dict[str, list[tuple[int, str]]] = defaultdict(list)
    for t, n in counts.where(F.col("n") >= max(LEAST, -(-total // FREQUENT_TOKENS))).collect():
        if len(plain(t)) > 1 and plain(t) not in FILLERS:
            by[plain(t)].append((n, t))
    return {p: (max(v)[1], sum(n for n, _ in v)) for p, v in by.items()}


def new_forms(frequent: dict[str, tuple[str, int]], base: Names) -> list[str]:
    """Frequent tokens that are no known form and no typo of a token that is near and much more frequent."""
    near: dict[str, list[str]] = defaultdict(list)
    for f in frequent:
        for w in _shortened(f, min(2, _edits(f))):
            near[w].append(f)
    out = []
    for u, (_, n) in frequent.items():
        if u in base.forms:
            continue
        others = {f for w in _shortened(u, _edits(u)) for f in near[w]} - {u}
        if not any(frequent[f][1] >= TYPO.get(osa(u, f, _edits(u)), float("inf")) * n for f in others):
            out.append(u)
    return out


def _exchanges(persons: DataFrame, surname: str, given: str, names: dict[str, str]) -> DataFrame:
    """``u, v, w, part``: names ``v`` in rows of the same surname as ``u`` that never stand beside it there, where they make up
    ``PART`` of all such weight of ``u`` or more (so a few for each ``u``). A surname weighs one over the number of its names, so
    frequent surnames tell little and none is left out. ``names`` maps known and frequent tokens to names."""
    book = persons.sparkSession.sparkContext.broadcast(names)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memo: dict[str, str | None] = {}
        for batch in batches:
            out = []
            for s, words in zip(batch["s"], batch["w"]):
                for w in words:
                    if w not in memo:
                        memo[w] = book.value.get(plain(w))
                kept = {memo[w] for w in words} - {None}
                if kept:
                    out.append((s, sorted(kept)))
            yield pd.DataFrame(out, columns=["s", "w"])

    key = F.regexp_replace(F.translate(F.lower(surname), "ąćęłńóśźż", "acelnoszz"), r"[^\p{L}]", "")
    rows = persons.where(F.col(surname).isNotNull()).select(key.alias("s"), given_tokens(given).alias("w")).where("s <> '' AND size(w) > 0")
    rows = rows.mapInPandas(run, "s string, w array<string>").groupBy("s", "w").agg(F.lit(1).alias("_"))
    each = rows.select("s", F.explode("w").alias("u"), "w").groupBy("s", "u").agg(F.array_distinct(F.flatten(F.collect_set("w"))).alias("own"))  # known names only
    each = cut(each)
    sizes = each.groupBy("s").agg(F.count("*").alias("m")).where("m > 1")
    pairs = each.join(each.select("s", F.col("u").alias("v")), "s").where(~F.array_contains("own", F.col("v"))).join(sizes, "s")
    sums = cut(pairs.groupBy("u", "v").agg(F.sum(1 / F.col("m")).alias("w")))
    return sums.join(sums.groupBy("u").agg(F.sum("w").alias("all")), "u").select("u", "v", "w", (F.col("w") / F.col("all")).alias("part")).where(F.col("part") >= PART)


def learn(persons: DataFrame, surname: str, given: str, base: Names | None = None) -> tuple[Names, dict[str, str]]:
    """``base`` and the forms that ``persons`` shows beside it; and each frequent form's most frequent spelling.

    A frequent token that is neither known nor a typo becomes a form. Two names are one if one takes the other's place in rows
    of the same surname far more often than chance has it, and at least one of them is new; else a new form stands for
    itself. Known forms are never changed and never joined with one another. The driver gets frequent tokens and a few
    partners of each, both bounded (:func:`frequent_tokens`).
    """
    base = base or seed()
    frequent = frequent_tokens(persons, given)
    spelled = {p: t for p, (t, _) in frequent.items()}
    fresh = set(new_forms(frequent, base))
    if not fresh:
        return base, spelled
    names = dict(base.forms) | {f: f for f in fresh}
    count: dict[str, int] = defaultdict(int)
    for f, (_, n) in frequent.items():
        if f in names:
            count[names[f]] += n
    total, known = sum(count.values()), set(base.forms.values())
    edges = []
    for u, v, w, part in _exchanges(persons, surname, given, names).collect():
        if (u in fresh or v in fresh) and w >= WEIGHT and part >= LIFT * count[v] / total:
            edges.append((part, w, u, v))
    of = {f: f for f in fresh | known}
    for _, _, u, v in sorted(edges, reverse=True):  # the surest first; a name of the list is never joined with another one
        a, b = of[u], of[v]
        if a == b or (a in known and b in known):
            continue
        keep, gone = (a, b) if a in known or (b not in known and count[a] >= count[b]) else (b, a)
        of = {f: keep if n == gone else n for f, n in of.items()}
    return Names(dict(base.forms) | {f: of[f] for f in fresh}), spelled
