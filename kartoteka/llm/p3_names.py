"""Variant spellings of typed names: pigeonhole segment join of surnames under a shared given name."""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import attach, cut
from kartoteka.llm.given_names import FILLERS, Names, plain, seed
from kartoteka.llm.learned_names import learn
from kartoteka.llm.p4_forms import surface
from kartoteka.llm.p6_places import beside
from kartoteka.operators.graph import connected_components

#: Spellings of one sound, and words that join the parts of a surname.
SOUNDS = (("tsch", "cz"), ("sch", "sz"), ("tz", "c"), ("ph", "f"), ("th", "t"), ("x", "ks"), ("v", "w"), ("ch", "h"), ("y", "i"), ("j", "i"))
JOINING = {"z", "d", "zd", "von", "de", "vel", "dr", "ks", "primo", "domo"}
_WORD = regex.compile(r"[\p{L}\p{M}'.]+")
_SCHEMA = "id {id}, skey string, givens array<string>, inits array<string>, abbr string"


def given_tokens(value: str | None) -> list[str]:
    """The words of a given_names value: a JSON list, or free text; fillers are dropped, initials kept with their dot."""
    if not value:
        return []
    try:
        items = json.loads(value)
        items = items if isinstance(items, list) else [items]
    except ValueError:
        items = [value]
    words = [w for x in items if x is not None for w in _WORD.findall(surface(str(x)))]
    return [w for w in words if plain(w) and plain(w) not in FILLERS]


def surname_key(words: list[str]) -> str:
    """Sorted parts of a surname by sound, doubled letters once."""
    parts = []
    for w in words:
        s = plain(w)
        for a, b in SOUNDS:
            s = s.replace(a, b)
        s = regex.sub(r"(\p{L})\1+", r"\1", s)
        if s:
            parts.append(s)
    return "-".join(sorted(parts))


def parse(surname: str | None, given: str | None, names_known: Names | None = None) -> tuple[str, list[str], list[str], str | None]:
    """``(surname key, given names, initials, pattern of a shortened surname)`` of one row, whatever field the parts stand in."""
    known = names_known or seed()
    left = [w for w in _WORD.findall(surface(surname or "").replace("-", " - ").replace("‐", " - "))]
    text = surface(surname or "").strip()
    abbr = None
    tight = regex.fullmatch(r"(\p{L}{2,5})-(\p{Ll}{2,4}|\p{Lu}{2,4})", text)
    if tight:
        abbr = surname_key([tight[1]]) + "%" + surname_key([tight[2]])
    right = given_tokens(given)
    names: set[str] = set()
    inits: set[str] = set()
    family: list[str] = []
    unknown: list[str] = []
    for w in right:
        if len(plain(w)) == 1:
            inits.add(plain(w))
        elif found := known.of(w):
            names.update(found)
        else:
            unknown.append(w)
    words = [w for w in left if plain(w) and plain(w) not in JOINING]
    swapped = not names and any(len(plain(w)) >= 5 for w in unknown) and all(len(plain(w)) == 1 or known.of(w) for w in words)
    whole = not right and len(words) > 1
    for w in words:
        if len(plain(w)) == 1:
            inits.add(plain(w))
        elif (known.is_given(w) and (len(words) > 1 or swapped)) or ((swapped or whole) and known.of(w)):
            names.update(known.of(w))
        else:
            family.append(w)
    if len(family) == 1 and family[0].endswith(".") and len(plain(family[0])) >= 4:
        abbr = surname_key(family) + "%"
    if family and not swapped:
        names.update(plain(w) for w in unknown)
    else:
        family += unknown
    inits -= {n[0] for n in names}
    key = surname_key(family)
    return key, sorted(names), sorted(inits), abbr if key and not abbr == "%" else None


def parse_names(df: DataFrame, id_col: str, surname: str, given: str, known: Names) -> DataFrame:
    """``id, skey, givens, inits, abbr`` for each row with a surname; rows of one spelling are parsed once per batch."""
    book = df.sparkSession.sparkContext.broadcast(known)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            memo: dict[tuple, tuple] = {}
            out = []
            for s, g in zip(batch["s"], batch["g"]):
                if (s, g) not in memo:
                    memo[s, g] = parse(s, g, book.value)
                out.append(memo[s, g])
            skey, givens, inits, abbr = zip(*out) if out else ((), (), (), ())
            yield pd.DataFrame({"id": batch["id"], "skey": skey, "givens": givens, "inits": inits, "abbr": abbr})

    rows = df.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(surname).alias("s"), F.col(given).alias("g"))
    return rows.mapInPandas(run, _SCHEMA.format(id=dict(rows.dtypes)["id"])).where("skey <> ''")


def edits(n: int) -> int:
    """Edits allowed for a surname key of ``n`` letters: none below 5 letters, one below 9, else two."""
    return 0 if n < 5 else 1 if n < 9 else 2


def segments(n: int) -> list[tuple[int, int]]:
    """Start (from 1) and length of the ``edits(n) + 1`` segments of a key of length ``n``. The last one is the longest, as
    surnames share their endings."""
    k = edits(n)
    if k == 0:
        return [(1, n)]
    tail = math.ceil(0.45 * n)
    head = n - tail
    if k == 1:
        return [(1, head), (head + 1, tail)]
    return [(1, head // 2), (head // 2 + 1, head - head // 2), (head + 1, tail)]


#: Segment number of keys with one edit, for an exchange of the letters on both sides of the cut; within a segment an exchange
#: leaves the other one whole.
SWAP = -1


def windows(m: int) -> list[tuple[int, int, int, int]]:
    """``(n, segment, start, length)`` of every substring of a key of length ``m`` that can equal a segment of a key of length
    ``n <= m`` (multi-match-aware selection)."""
    out = []
    for n in range(max(1, m - 2), m + 1):
        k, gap = edits(n), m - n
        if gap > k:
            continue
        for i, (start, size) in enumerate(segments(n)):
            for shift in range(-k, k + 1):
                at = start + shift
                if abs(shift) <= i and abs(shift - gap) <= k - i and at >= 1 and at + size - 1 <= m:
                    out.append((n, i, at, size))
    return out


def _piece(at: Column, size: Column | int) -> Column:
    return F.substring("skey", at, F.lit(size) if isinstance(size, int) else size)


def _cut_keys(rows: DataFrame, table: DataFrame) -> DataFrame:
    """One row per entry of ``table`` (``m, n, i, at, size``, by key length): hash of given name, length, segment and text. The
    text of segment ``SWAP`` is the whole key, the two letters at ``at`` in order."""
    cut_at = rows.join(F.broadcast(table), F.length("skey") == F.col("m"))
    at = F.col("at")
    pair = _piece(at, 1), _piece(at + 1, 1)
    whole = F.concat(_piece(F.lit(1), at - 1), F.least(*pair), F.greatest(*pair), _piece(at + 2, F.length("skey")))
    text = F.when(F.col("i") == SWAP, whole).otherwise(_piece(at, F.col("size")))
    return cut_at.select("g", "skey", "node", F.xxhash64("g", "n", "i", text).alias("seg"))


def exchanged(a: str, b: str) -> Column:
    """Whether one exchange of neighbouring letters turns column ``a`` into ``b``."""
    x = F.col(a)

    def swapped(p: Column) -> Column:
        return F.concat(F.substring(x, F.lit(1), p - 1), F.substring(x, p + 1, F.lit(1)), F.substring(x, p, F.lit(1)), F.substring(x, p + 2, F.length(x)))

    return F.exists(F.sequence(F.lit(1), F.length(x) - 1), lambda p: swapped(p) == F.col(b))


@dataclass
class Segments:
    """The segment tables for the key lengths that occur; a few rows per length, so broadcast."""

    index: DataFrame
    probe: DataFrame

    @classmethod
    def of(cls, spark: SparkSession, lengths: list[int]) -> Segments:
        kind = "m int, n int, i int, at int, size int"
        index = [(n, n, i, at, size) for n in lengths for i, (at, size) in enumerate(segments(n))]
        probe = [(m, *w) for m in lengths for w in windows(m)]
        swap = [(n, n, SWAP, segments(n)[0][1], 2) for n in lengths if edits(n) == 1]
        return cls(spark.createDataFrame(index + swap, kind), spark.createDataFrame(probe + swap, kind))


def similar_keys(index: DataFrame, probe: DataFrame, tables: Segments, swaps: bool = False) -> DataFrame:
    """``g, key_a, a, key_b, b, d``: nodes of ``index`` and ``probe`` (each ``g, skey, node``) with the same ``g`` whose keys are at most the
    allowed edits apart, or with ``swaps`` one exchange of neighbouring letters (``d`` = 2) where one is allowed, the index key being the shorter or equally long one. Candidates come from the segment index and are
    verified by a banded edit distance."""
    left = _cut_keys(index, tables.index).select("seg", F.col("skey").alias("key_a"), F.col("node").alias("a"))
    right = _cut_keys(probe, tables.probe).select("seg", "g", F.col("skey").alias("key_b"), F.col("node").alias("b"))
    found = left.join(right, "seg").where("a <> b").drop("seg").distinct()
    allowed = F.when(F.length("key_a") < 5, 0).when(F.length("key_a") < 9, 1).otherwise(2)
    one_swap = (allowed == 1) & (F.col("d") == 2) & (F.length("key_a") == F.length("key_b")) & exchanged("key_a", "key_b")
    return found.withColumn("d", F.levenshtein("key_a", "key_b", 2)).where((F.col("d") >= 0) & ((F.col("d") <= allowed) | (one_swap if swaps else F.lit(False))))


#: Cost of a slip of the hand and of any other exchange of letters, and the most that two edits may cost together.
SLIP, OTHER, MOST = 0.8, 1.5, 2.2
#: Letters that are taken for each other by ear.
BY_EAR = {frozenset(p) for p in ("ou", "sz", "cz", "wb", "dt", "bp", "gk", "ea", "iu", "cs", "lu", "mn")}


def slip_cost(a: str, b: str) -> float:
    """Edit distance in which letters beside each other on the keyboard, alike by ear, or exchanged cost less than others."""
    before: list[float] = []
    row = [float(i) for i in range(len(b) + 1)]
    for x, ca in enumerate(a):
        now = [row[0] + 1]
        for y, cb in enumerate(b):
            swap = 0.0 if ca == cb else SLIP if beside(ca, cb) or frozenset((ca, cb)) in BY_EAR else OTHER
            best = min(row[y] + swap, row[y + 1] + 1, now[y] + 1)
            if x and y and ca == b[y - 1] and a[x - 1] == cb:
                best = min(best, before[y - 1] + SLIP)
            now.append(best)
        before, row = row, now
    return row[-1]


@F.pandas_udf(T.DoubleType())
def _slips(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([slip_cost(x, y) for x, y in zip(a, b)], dtype="float64")


def _plausible(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """Pairs of like surnames that can be one human being's: one side's given names are among the other's, or they share two; and
    two edits must look like slips of the hand or the ear."""
    a = full.select("g", F.col("skey").alias("key_a"), F.col("names").alias("names_a"))
    b = full.select("g", F.col("skey").alias("key_b"), F.col("names").alias("names_b"))
    both = pairs.join(a, ["g", "key_a"]).join(b, ["g", "key_b"])
    shared = F.size(F.array_intersect("names_a", "names_b"))
    agree = (shared >= 2) | (shared == F.least(F.size("names_a"), F.size("names_b")))
    kept = both.where(agree)
    return kept.where("d < 2").unionByName(kept.where("d = 2").where(_slips("key_a", "key_b") <= MOST))


def link(persons: DataFrame, id_col: str, surname: str, given: str, groups: DataFrame | None = None, known: Names | None = None) -> DataFrame:
    """``id, class_id``: rows of one human being share a class, whose id is its smallest row id.

    Rows are linked if they share a given name (short, foreign and mistyped forms resolved) and their surnames, by sound and
    without accents, are at most two edits apart (one, or one exchange of neighbouring letters, below nine letters; none below five); two edits must look like slips, and
    the given names must not contradict each other. Shortened surnames are linked
    with the only class they can stand for. Rows with initials alone, or no given name, join a class only if exactly one
    class fits best. ``groups`` (``group_id, person_id``) adds confirmed links. Rows without a surname, and rows that nothing
    fits, are a class of their own; a null id is left out. Spellings, not rows, are compared, so equal rows cost nothing.
    Given names are those of the list and those that the data show (:mod:`learned_names`); ``known`` replaces the list.
    """
    known, _ = learn(persons, surname, given, known)
    parsed, n_rows = cut(parse_names(persons, id_col, surname, given, known)), persons.count()
    shape = ["skey", "givens", "inits", "abbr"]
    nodes = cut(parsed.groupBy(*shape).agg(F.min("id").alias("node"), F.count("*").alias("n")))
    named = nodes.where("size(givens) > 0").select("skey", "node", F.explode("givens").alias("g"), "abbr", "givens")
    full = named.where("abbr IS NULL").groupBy("g", "skey").agg(F.min("node").alias("rep"), F.array_distinct(F.flatten(F.collect_set("givens"))).alias("names"))
    full = cut(full)  # names: all given names of one surname's rows that share one, a few
    same = named.where("abbr IS NULL").join(full, ["g", "skey"]).select(F.col("node").alias("a"), F.col("rep").alias("b"))
    keys = full.select("g", "skey", F.col("rep").alias("node"))
    tables = Segments.of(persons.sparkSession, [r[0] for r in nodes.select(F.length("skey")).distinct().collect()])
    near = _plausible(similar_keys(keys, keys, tables, swaps=True), full).select("a", "b")
    edges = same.unionByName(near)
    by_hash = parsed.select("id", _shape().alias("_s"))
    sizes = nodes.select(_shape().alias("_s"), "node", "n")
    member = cut(attach(by_hash, sizes, ["_s"], "n", n_rows).select("id", "node"))
    if groups is not None:
        at = groups.where("group_id IS NOT NULL").join(member, groups["person_id"] == member["id"]).select("group_id", "node")
        first = at.groupBy("group_id").agg(F.min("node").alias("b"), F.count("*").alias("n"))
        edges = edges.unionByName(attach(at, first, ["group_id"], "n", n_rows).select(F.col("node").alias("a"), "b"))
    strong = connected_components(edges)
    root = F.coalesce("root", "node").alias("root")
    classes = nodes.join(strong, "node", "left").select("node", *shape, root, F.col("root").isNull().alias("alone"))
    classes = cut(classes)
    firm = classes.where("size(givens) > 0 AND abbr IS NULL")
    joined = _weak_links(classes.where("size(givens) = 0 AND alone AND abbr IS NULL"), firm, tables)
    joined = joined.unionByName(_cut_short(classes.where("abbr IS NOT NULL AND alone"), firm))
    final = cut(classes.select("node", "root").join(joined, "node", "left").select("node", F.coalesce("to", "root").alias("root")))
    roots = final.groupBy("root").agg(F.min("node").alias("class_id"), F.count("*").alias("n_nodes"))
    final = cut(attach(final, roots, ["root"], "n_nodes", n_rows).select("node", "class_id"))
    out = member.join(final, "node").select("id", "class_id")
    rest = persons.where(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id")).distinct().join(parsed.select("id"), "id", "left_anti")
    return out.unionByName(rest.select("id", F.col("id").alias("class_id")))


def _shape() -> Column:
    return F.md5(F.concat_ws("\x00", F.col("skey"), F.array_join("givens", " "), F.array_join("inits", " "), F.coalesce("abbr", F.lit("\x01"))))


def _weak_links(weak: DataFrame, firm: DataFrame, tables: Segments) -> DataFrame:
    """``node, to`` for nodes without a given name: the only class that fits best, else the first node spelled like it."""
    letters = weak.select("node", "skey", F.explode("inits").alias("g"))
    firsts = firm.select("root", "skey", F.explode(F.array_distinct(F.concat(F.transform("givens", lambda x: F.substring(x, 1, 1)), F.col("inits")))).alias("g"))
    heads = firsts.groupBy("g", "skey", "root").agg(F.lit(1).alias("_"))
    ids = heads.select("g", "skey", F.col("root").alias("node"))
    near = similar_keys(ids, letters, tables, swaps=True).select(F.col("b").alias("node"), F.col("a").alias("to"), "d")
    near = near.unionByName(similar_keys(letters, ids, tables, swaps=True).select(F.col("a").alias("node"), F.col("b").alias("to"), "d"))
    bare = weak.where("size(inits) = 0").select("node", "skey").join(firm.select("skey", F.col("root").alias("to")).distinct(), "skey")
    fits = near.unionByName(bare.select("node", "to", F.lit(0).alias("d")))
    fits = cut(fits.groupBy("node", "to").agg((F.count("*") - F.min("d")).alias("score")))
    best = fits.groupBy("node").agg(F.max("score").alias("score"))
    only = fits.join(best, ["node", "score"]).groupBy("node").agg(F.min("to").alias("to"), F.count("*").alias("n")).where("n = 1")
    twins = weak.groupBy("skey", "inits").agg(F.min("node").alias("twin"))
    alike = weak.join(twins, ["skey", "inits"]).select("node", "twin")
    return alike.join(only.select("node", "to"), "node", "left").select("node", F.coalesce("to", "twin").alias("to"))


def _cut_short(cut_names: DataFrame, firm: DataFrame) -> DataFrame:
    """``node, to`` for shortened surnames: the only class with a shared given name or initial whose surname they begin."""

    def keyed(df: DataFrame, text: str) -> DataFrame:
        letters = F.concat(F.transform("givens", lambda x: F.substring(x, 1, 1)), "inits")
        g = F.when(F.size("givens") > 0, F.col("givens")).otherwise(F.col("inits")) if text == "abbr" else F.concat("givens", letters)
        return df.select("*", F.explode(F.array_distinct(g)).alias("g"), F.substring(text, 1, 3).alias("stem"))

    whole = keyed(firm, "skey").select("g", "stem", F.col("skey").alias("whole"), F.col("root").alias("to")).distinct()
    found = keyed(cut_names, "abbr").select("g", "stem", "abbr", "node").join(whole, ["g", "stem"]).where("whole LIKE abbr")
    found = found.groupBy("node").agg(F.min("to").alias("to"), F.max("to").alias("other"))
    return found.where(F.col("to") == F.col("other")).select("node", "to")


def pairs(classes: DataFrame) -> DataFrame:
    """``id_a, id_b`` (``id_a < id_b``) for all rows of each class, as the task's table of links asks; :func:`link` itself is the
    form that does not grow with the square of a class."""
    a = classes.select("class_id", F.col("id").alias("id_a"))
    b = classes.select("class_id", F.col("id").alias("id_b"))
    return a.join(b, "class_id").where("id_a < id_b").select("id_a", "id_b")
