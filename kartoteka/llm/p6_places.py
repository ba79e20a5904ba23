"""Free-entered values mapped to a reference list by a symmetric-delete dictionary and weighted edit distance."""

from __future__ import annotations

import unicodedata
import uuid
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.cluster import attach, cut
from kartoteka.llm.p4_forms import surface

#: Reference entries in one broadcast dictionary; a longer list is taken in blocks of so many.
BLOCK = 20_000
MAX_EDITS = 2
MEMO = 200_000

# Words that lead a street, a district, or a kind of settlement, and remarks that name no place.
STREET = r"ul|ulica|ulicy|al|aleja|alei|aleje|pl|plac|placu|os|osiedle|rynek|strasse|straße"
DISTRICT = r"pow|powiat|powiatu|powiecie"
KIND = r"w|we|z|ze|do|m|miasto|mieście|miescie|miasta|wieś|wies|wsi|gm|gmina|gminie|gminy|par|parafia|parafii|folwark|folwarku|kol|kolonia|osada|osadzie|miejscowość|miejscowości|miasteczko|st|stacja"
REMARK = r"tamże|tamze|przedm|przedmieście|j|jw|okolice|okolica|pod|koło|k"
KEYS = ("qwertyuiop", "asdfghjkl", "zxcvbnm")

_PARTS = regex.compile(r"\s*(?:[,;|()\[\]„”\"«»?]|\s/\s|\s[–—-](?=\s|$)|^[–—-]\s)\s*")
_STREET = regex.compile(rf"^(?:{STREET})\b\.?\s*\S", regex.I)
_INLINE_STREET = regex.compile(rf"(?<!\S)(?:{STREET})\b\.?\s*\p{{L}}[\p{{L}}\s.]*?\d+\p{{L}}?(?:/\d+)?", regex.I)
_DISTRICT = regex.compile(rf"(?<!\S)(?:{DISTRICT})\b\.?\s*([\p{{L}}-]+)\.?", regex.I)
_KIND = regex.compile(rf"^(?:(?:{KIND})(?:\.\s*|\s+))+(?=\p{{L}}{{2}})", regex.I)
_REMARK = regex.compile(rf"^(?:{REMARK})\.?$", regex.I)


def fold(text: str) -> str:
    """Lower case without accents and strokes."""
    text = unicodedata.normalize("NFD", text.lower().replace("ł", "l"))
    return "".join(c for c in text if not unicodedata.combining(c))


def inflected(word: str) -> list[str]:
    """Locative and genitive forms of a place name, by its ending."""
    for ending, forms in (
        ("ska", ("skach", "sk", "sku", "skiej")), ("ce", ("cach", "c")), ("owa", ("owej", "owie")), ("owo", ("owie", "owa", "owem")),
        ("ów", ("owie", "owa", "owem")), ("in", ("inie", "ina", "inem")), ("ec", ("cu", "ca", "cem")), ("no", ("nie", "na")), ("a", ("ie", "y", "ej")), ("o", ("ie", "a")), ("e", ("ach", "ych")),
    ):
        if word.endswith(ending):
            return [word[: -len(ending)] + f for f in forms]
    return [word + "ie", word + "u", word + "a"]


def deletes(word: str, most: int) -> set[str]:
    """The word with up to ``most`` letters left out."""
    out = {word}
    for n in range(1, min(most, len(word) - 1) + 1):
        out.update("".join(c for i, c in enumerate(word) if i not in gone) for gone in map(set, combinations(range(len(word)), n)))
    return out


def beside(a: str, b: str) -> bool:
    """Whether two letters are neighbours on a keyboard."""
    for row in KEYS:
        if a in row and b in row:
            return abs(row.index(a) - row.index(b)) == 1
    return False


def _cost(a: str, b: str) -> float:
    if a == b:
        return 0.0
    if fold(a) == fold(b):
        return 0.1
    return 0.8 if beside(fold(a), fold(b)) else 1.0


def distance(a: str, b: str, most: float) -> float:
    """Damerau-Levenshtein distance (adjacent exchange) with cheap accents, neighbouring keys and doubled letters; above
    ``most`` infinity."""
    if abs(len(a) - len(b)) > most / 0.7:
        return float("inf")
    before: list[float] = []
    row = [0.0]
    for y in range(len(b)):
        row.append(row[-1] + (0.7 if y and b[y] == b[y - 1] else 1.0))
    for x in range(len(a)):
        gap = 0.7 if x and a[x] == a[x - 1] else 1.0
        now = [row[0] + gap]
        for y in range(len(b)):
            best = min(row[y] + _cost(a[x], b[y]), row[y + 1] + gap, now[y] + (0.7 if y and b[y] == b[y - 1] else 1.0))
            if x and y and a[x] == b[y - 1] and a[x - 1] == b[y]:
                best = min(best, before[y - 1] + 0.8)
            now.append(best)
        if min(now) > most:
            return float("inf")
        before, row = row, now
    return row[-1] if row[-1] <= most else float("inf")


#: What a value resolves to that names no entry: place id, penalty, frequency.
NOTHING = (-1, float("inf"), 0)


@dataclass
class Dictionary:
    """Reference entries ``(place_id, name, district, aliases, frequency)`` ready for lookups."""

    entries: list[tuple]
    forms: dict[str, list[tuple[str, int, float]]] = field(default_factory=lambda: defaultdict(list))  # folded form -> (form, entry, penalty)
    near: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))  # shortened form -> folded forms
    prefixes: dict[str, set[str]] = field(default_factory=lambda: defaultdict(set))
    memo: dict[str, tuple[int, float, int]] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.rest: list[str] = []
        for k, (_, name, _, aliases, _) in enumerate(self.entries):
            first, *rest = surface(name or "").lower().split() or [""]
            self.rest.append(" ".join(rest))
            words = [(first, 0.0, True)] + [(w, 0.15, False) for w in inflected(first)]
            words += [(surface(a).lower().split()[0], 0.1, True) for a in aliases or [] if a and a.strip()]
            for word, penalty, plain in words:
                f = fold(word)
                if len(f) >= 2:
                    self.forms[f].append((word, k, penalty))
                    if plain:
                        for n in range(2, len(f)):
                            self.prefixes[f[:n]].add(f)
        self.longest = max(map(len, self.forms), default=0)
        for f in self.forms:
            for d in deletes(f, self.edits(f)):
                self.near[d].add(f)

    @staticmethod
    def edits(word: str) -> int:
        return MAX_EDITS if len(word) >= 7 else 1 if len(word) >= 4 else 0

    def resolve(self, value: str) -> tuple[int, float, int]:
        """The entry's id, its penalty and its frequency, or ``NOTHING``."""
        if value not in self.memo:
            if len(self.memo) >= MEMO:
                self.memo.clear()
            self.memo[value] = self._resolve(value)
        return self.memo[value]

    def _resolve(self, value: str) -> tuple[int, float, int]:
        text = surface(value).strip().lower()
        districts = [fold(d) for d in _DISTRICT.findall(text)]
        text = _DISTRICT.sub(" , ", text)
        best: tuple[float, int, int] | None = None
        for part in _PARTS.split(_INLINE_STREET.sub(" , ", text)):
            part = part.strip(" .:-–—'*/")
            dotted = part + "." if text.find(part + ".") >= 0 else part
            if not any(c.isalnum() for c in part) or _STREET.match(part) or _REMARK.match(part):
                continue
            bare = _KIND.sub("", dotted)
            for phrase in dict.fromkeys((bare, dotted)):
                for k, penalty in self._candidates(phrase.split(), districts):
                    place, _, _, _, frequency = self.entries[k]
                    found = (penalty, -int(frequency), place)
                    best = min(best, found) if best else found
        return (best[2], best[0], -best[1]) if best else NOTHING

    def _candidates(self, words: list[str], districts: list[str]) -> Iterator[tuple[int, float]]:
        if not words:
            return
        word, *rest = words
        if not rest and "." in word.rstrip(".") and len(word) > 4:  # gór. or m. written to the name
            word, *rest = [w + "." for w in word.rstrip(".").split(".")]
        core = word.rstrip(".")
        folded = fold(core)
        found: dict[int, float] = {}
        for form, k, penalty in self.forms.get(folded, ()):
            found[k] = min(found.get(k, 9.0), penalty + (0.0 if form == core else 0.05))
        if not found:
            edits = self.edits(folded) if len(folded) <= self.longest + MAX_EDITS else 0  # longer values are near no form
            for near in set().union(*(self.near.get(d, ()) for d in deletes(folded, edits))) if edits else ():
                for form, k, penalty in self.forms[near]:
                    d = distance(core, form, MAX_EDITS + 0.3)
                    if d > 9 and len(form) > len(core) > 5:  # an exchange across a lost letter
                        d = min(1.0 + distance(core, form[:i] + form[i + 1 :], 1.0) for i in range(len(form)))
                    if d < 9 and (d <= self.edits(near) + 0.3):
                        found[k] = min(found.get(k, 9.0), penalty + d)
        if (word.endswith(".") and len(folded) >= 3) or (not found and len(folded) >= 4):  # cut short, the dot perhaps lost
            for f in self.prefixes.get(folded, ()):
                for _, k, penalty in self.forms[f]:
                    if penalty < 0.15:
                        found[k] = min(found.get(k, 9.0), penalty + (1.0 if word.endswith(".") else 1.4))
        if "-" in core:  # contracted
            head, _, tail = folded.rpartition("-")
            if len(head) >= 2 and tail:
                for f in self.prefixes.get(head, ()):
                    if f.endswith(tail):
                        for _, k, penalty in self.forms[f]:
                            if penalty < 0.15:
                                found[k] = min(found.get(k, 9.0), penalty + 1.0)
        for k, penalty in found.items():
            penalty += self._rest(self.rest[k], [w.rstrip(".") for w in rest if any(c.isalnum() for c in w)])
            if districts:
                own = fold(self.entries[k][2] or "").split()
                penalty += 0.0 if any(d in own for d in districts) else 0.3 if any(distance(d, o, 2.3) < 9 for d in districts for o in own) else 1.5
            yield k, penalty

    @staticmethod
    def _rest(own: str, given: list[str]) -> float:
        """Penalty for the words after the first: górne, gór., g., wlk. or a form of it."""
        if not own:
            return 0.0 if not given else 1.2
        if not given:
            return 0.6
        a, b = fold(own), fold(given[0])
        if a == b:
            return 0.0
        if a.startswith(b) or (b[:1] == a[:1] and len(b) <= 4 and _within(b, a)):
            return 0.1
        if a[:-1] == b[: len(a) - 1] or distance(a, b, 2.0) < 9:
            return 0.4
        return 3.0


def _within(short: str, long: str) -> bool:
    """Whether the letters of ``short`` occur in ``long`` in this order."""
    rest = iter(long)
    return all(c in rest for c in short)


#: Total penalty beyond which a value names nothing in the list.
LIMIT = 3.4
_BUILT: dict[str, Dictionary] = {}


def _resolver(spark: SparkSession, entries: list[tuple]):
    """A function over batches of values and the broadcast variable that holds ``entries``."""
    book, key = spark.sparkContext.broadcast(entries), uuid.uuid4().hex

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        if key not in _BUILT:  # kept by the Python worker for its next tasks of the same list
            _BUILT.clear()
            _BUILT[key] = Dictionary(book.value)
        known = _BUILT[key]
        for batch in batches:
            codes, distinct = pd.factorize(batch["value"])
            found = [known.resolve(v) for v in distinct]
            found = [f if f[1] <= LIMIT else NOTHING for f in found]
            for at, name in enumerate(("place_id", "penalty", "frequency")):
                batch[name] = [found[c][at] for c in codes]
            yield batch

    return run, book


def named(value: Column) -> Column:
    """Whether a value has at least one letter or digit."""
    return value.rlike(r"[\p{L}\p{N}]")


def map_to_reference(df: DataFrame, id_col: str, value_col: str, reference: DataFrame, ref_id: str = "place_id", block: int = BLOCK) -> DataFrame:
    """``id, value, place_id, penalty, exact`` for each row whose value has a letter or digit; ``place_id`` is -1 and
    ``penalty`` infinite where the value names no entry of ``reference`` (``place_id, name, district, aliases``). ``exact``
    tells whether the value is a name character for character; a penalty of 0 does not, as other letter case, spaces,
    streets and matching districts cost nothing.

    Values equal to a name are matched in the JVM. The rest is parsed (street, district, kind of settlement), looked up in a
    symmetric-delete dictionary for two edits and ranked by weighted distance, second word, district and how often the entry
    is named exactly in ``df``; ties go to the smaller id. A value is worked on once per batch and remembered by the Python
    worker, so frequent values cost nothing and nothing is shuffled. The dictionary is broadcast for at most ``block``
    entries; a longer list is taken block by block over the distinct values, of which the driver holds one at a time, with
    the same ranking, so the length of the list changes no result. Null names are left out.
    """
    spark = df.sparkSession
    rows = df.where(named(F.col(value_col))).select(F.col(id_col).alias("id"), F.col(value_col).alias("value"))
    ref = reference.where(F.col("name").isNotNull()).select(F.col(ref_id).cast("bigint").alias("place_id"), "name", "district", "aliases")
    names = ref.groupBy(F.col("name").alias("value")).agg(F.min("place_id").alias("place_id"))
    schema = f"id {dict(rows.dtypes)['id']}, value string, place_id bigint, penalty double, frequency bigint"
    n_ref = ref.count()

    def counted(frequency: DataFrame) -> DataFrame:
        return ref.join(frequency, "place_id", "left").select("place_id", "name", "district", "aliases", F.coalesce("n", F.lit(0)).alias("n"))

    def result(part: DataFrame, exact: bool) -> DataFrame:
        penalty = F.lit(0.0) if exact else F.col("penalty")
        return part.select("id", "value", "place_id", penalty.alias("penalty"), F.lit(exact).alias("exact"))

    if n_ref <= block:
        exact = rows.join(F.broadcast(names), "value")
        other = rows.join(F.broadcast(names.select("value")), "value", "left_anti").select("id", "value")
        frequency = exact.groupBy("place_id").agg(F.count("*").alias("n"))
        run, _ = _resolver(spark, [tuple(r) for r in counted(frequency).collect()])
        held = other.withColumns({"place_id": F.lit(0).cast("bigint"), "penalty": F.lit(0.0), "frequency": F.lit(0).cast("bigint")})
        return result(exact, True).unionByName(result(held.mapInPandas(run, schema), False))
    values = cut(rows.groupBy("value").agg(F.count("*").alias("n")).join(names, "value", "left"))
    frequency = values.where("place_id IS NOT NULL").groupBy("place_id").agg(F.sum("n").alias("n"))
    ref, blocks = cut(counted(frequency)), -(-n_ref // block)
    open_values = values.where("place_id IS NULL").select(F.lit(None).cast(dict(rows.dtypes)["id"]).alias("id"), "value")
    best = None
    for k in range(blocks):
        part = ref.where(F.pmod(F.xxhash64("place_id"), F.lit(blocks)) == k).collect()
        run, book = _resolver(spark, [tuple(r) for r in part])
        held = open_values.withColumns({"place_id": F.lit(0).cast("bigint"), "penalty": F.lit(0.0), "frequency": F.lit(0).cast("bigint")})
        found = held.mapInPandas(run, schema).select("value", F.struct("penalty", (-F.col("frequency")).alias("rarity"), "place_id").alias("found"))
        best = found if best is None else best.unionByName(found)
        best = cut(best.groupBy("value").agg(F.min("found").alias("found")))
        book.destroy()
    open_ = best.select("value", "found.place_id", "found.penalty", F.lit(False).alias("exact"))
    known = values.where("place_id IS NOT NULL").select("value", "place_id", F.lit(0.0).alias("penalty"), F.lit(True).alias("exact"))
    every = known.unionByName(open_).join(values.select("value", "n"), "value")
    return attach(rows, every, ["value"], "n", df.count()).select("id", "value", "place_id", "penalty", "exact")


def misses(mapped: DataFrame) -> DataFrame:
    """``value, n``: every value that names no entry, with its number of rows."""
    return mapped.where("place_id = -1").groupBy("value").agg(F.count("*").alias("n"))
