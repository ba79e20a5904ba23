"""Noise of scanned pages: running heads, page numbers, hyphens at line ends and misread characters."""

from __future__ import annotations

from dataclasses import dataclass

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from kartoteka.cluster import attach, cut

# What a scanner prints and what stands on the page.
CONFUSIONS = (
    ("0", "o"), ("5", "s"), ("1", "l"), ("1", "i"), ("2", "z"), ("6", "b"), ("6", "ó"), ("8", "b"), ("9", "g"), ("|", "ł"), ("|", "l"),
    ("§", "ś"), ("£", "ż"), ("£", "ł"), ("@", "ą"), ("¢", "ę"), ("ü", "ii"), ("rn", "m"), ("m", "rn"), ("vv", "w"), ("cl", "d"),
    ("e", "c"), ("c", "e"), ("u", "n"), ("n", "u"), ("b", "h"), ("h", "b"), ("f", "t"), ("t", "f"), ("l", "i"), ("i", "l"), ("ni", "m"), ("li", "h"),
)
#: Letters read for a digit of a year.
DIGITS = str.maketrans("lI|OoSBZg", "111005829")
#: Marks of a split word at a line's end that are no hyphens of the text itself.
SOFT = "¬­=‐"
DASH = r"—–\-"
#: Letters of a word as printed, the signs that stand for letters included.
GLYPH = r"\p{L}\p{M}\p{N}|§£@¢"
#: A word is rare beside a variant that FREQUENT times as many texts have. FLOOR is a count of texts, not a share, and follows from
#: FREQUENT: a word stands in one text at least. So a small table yields fewer corrections than a large one with the same shares.
FREQUENT, FLOOR = 12, 12
#: A running head is believed from so many texts on that show it in a layout that no sentence has.
HEADS = 2
#: At most so many of the most frequent words are broadcast, each holding that part of all words or more.
HOT_WORDS = 20_000

PAGE_ALONE = rf"^(?:(?:str|s|S|Str)\.\s*\d{{1,4}}|[\[({DASH}·]\s*\d{{1,4}}\s*[\]){DASH}·]|\d{{1,4}})$"
PAGE_DOT = r"^\d{1,4}\.$"
PAGE_EDGE = r"(?:^\d{1,4} {2,}\S|(?:\S {3}|\S \. |\S\. )\d{1,4}$)"
GUIDE = rf"^(?:\d{{1,4}}\s+)?\p{{Lu}}{{2,4}}\s*[{DASH}]\s*\p{{Lu}}{{2,4}}(?:[ .]+\d{{1,4}})?$"
SPACED = r"^(?:\d{1,4} {2,})?(?:[\p{L}\p{N}],?\s+){5,}[\p{L}\p{N}],?(?:[ .]+\d{1,4})?$"
CAPITALS = r"^[\p{Lu}\s\d.,]*\p{Lu}{2,}[ ,]+\p{Lu}[\p{Lu}\s\d.,]*$"
EDGE = r"^\d{1,4} {3}\p{Lu}[\p{L}\s\d,.]+$|^\p{Lu}[\p{L}\s\d,.]+ {3}\d{1,4}$"
MISREAD_YEAR = r"(?<![\p{L}\p{N}/.-])(?=[\p{N}\p{L}|]*\d[\p{N}\p{L}|]*\d)(?=\d*[\p{L}|])(?:[lI|][789]\d\d|[1lI|][789OSBg][\dOSBlIoZ][\dOSBlIoZ])(?![\p{L}\p{N}/])"
MISREAD_WORD = r"(?:\p{L}[0-9|§£@¢]+\p{L}|(?<![\p{L}\p{N}])[0-9|§£@¢]\p{Ll}{3,}|(?<![\p{L}\p{N}])[|§£@¢]\p{L}|\p{L}{2}[0-9|§£@¢](?![\p{N}/])|\p{L}ü(?!\p{L}))"
#: An ordinal written with its ending is no misread word.
ORDINAL = r"(?<![\p{L}\p{N}])\d{1,4}(?:go|mu|ga|ta|ty|szy|gie|st|nd|rd|th|ej|ym|ych|tego)(?![\p{L}])"


def distinct_texts(df: DataFrame, text: str) -> DataFrame:
    """``tid, text, n``: each different text once with its number of rows; null and empty texts are left out."""
    rows = df.where(F.length(text) > 0).select(F.md5(F.col(text)).alias("tid"), F.col(text).alias("text"))
    return rows.groupBy("tid").agg(F.first("text").alias("text"), F.count("*").alias("n"))


def _core(line: Column) -> Column:
    """What the layouts of one running head have in common: its letters in lower case."""
    return F.regexp_replace(F.lower(line), r"[^\p{L}]", "")


def running_heads(texts: DataFrame) -> DataFrame:
    """``core, texts``: heads seen letter-spaced, in capitals or beside a page number in ``HEADS`` texts or more."""
    lines = texts.select(F.explode(F.split("text", "\n")).alias("line")).select(F.trim(F.translate("line", "\r", "")).alias("line"))
    shown = lines.where(
        (F.col("line").rlike(SPACED) | F.col("line").rlike(CAPITALS) | F.col("line").rlike(EDGE)) & ~F.col("line").rlike(GUIDE)
    )
    return shown.select(_core(F.col("line")).alias("core")).where("length(core) >= 6").groupBy("core").agg(F.count("*").alias("texts")).where(f"texts >= {HEADS}")


def mark_lines(texts: DataFrame, heads: DataFrame) -> DataFrame:
    """``texts`` with ``lines``, one struct ``line, head, page`` for each line of the text."""
    lines = texts.withColumn("lines", F.transform(F.split("text", "\n"), lambda x: F.trim(F.translate(x, "\r\t", "  "))))
    candidates = lines.select("tid", F.posexplode("lines").alias("pos", "line")).where(F.col("line").rlike(r"^[\p{Lu}\d]") & (F.length("line") >= 6) & ~F.col("line").rlike(r"\p{Ll}[.;:]\s+\p{L}|-$"))
    found = candidates.select("tid", "pos", _core(F.col("line")).alias("core")).join(heads, "core", "left_semi")
    found = found.groupBy("tid").agg(F.collect_set("pos").alias("at"))  # bounded by the lines of one text
    joined = lines.join(found, "tid", "left").withColumn("at", F.coalesce("at", F.array().cast("array<int>")))

    def mark(line: Column, i: Column) -> Column:
        head = F.array_contains("at", i) | line.rlike(GUIDE)
        before = F.try_element_at(F.filter(F.slice("lines", F.lit(1), i), lambda x: x != ""), F.lit(-1))
        after = F.get(F.filter(F.slice("lines", i + 2, F.size("lines")), lambda x: x != ""), F.lit(0))
        dotted = line.rlike(PAGE_DOT) & (F.coalesce(after.rlike(r"^\p{Ll}"), F.lit(False)) | F.coalesce(before.rlike(r"[.!?]$"), i == 0))
        page = line.rlike(PAGE_ALONE) | dotted | (head & line.rlike(PAGE_EDGE))
        return F.struct(line.alias("line"), head.alias("head"), page.alias("page"))

    odd = F.exists("lines", lambda x: x.rlike(GUIDE) | x.rlike(PAGE_ALONE) | x.rlike(PAGE_DOT)) | (F.size("at") > 0)
    plain = F.transform("lines", lambda x: F.struct(x.alias("line"), F.lit(False).alias("head"), F.lit(False).alias("page")))
    return joined.withColumn("lines", F.when(odd, F.transform("lines", mark)).otherwise(plain)).drop("at")


def without_edges(marked: DataFrame) -> DataFrame:
    """``tid, n, body, header, page_number``: the text without its edge lines, as lines, and which kinds it had."""
    kept = F.filter("lines", lambda x: ~x["head"] & ~x["page"])
    return marked.select(
        "tid",
        "n",
        F.array_join(F.transform(kept, lambda x: x["line"]), "\n").alias("body"),
        F.exists("lines", lambda x: x["head"]).alias("header"),
        F.exists("lines", lambda x: x["page"]).alias("page_number"),
    )


#: A word split at a line's end: its parts and the mark between them.
SPLIT = rf"([{GLYPH}-]*[\p{{L}}|§£@¢\d])([-{SOFT}])[ ]*\n\s*(\p{{L}}[{GLYPH}]*)"
SURE = rf"(?:[\p{{L}}|§£@¢\d][{SOFT}][ ]*\n\s*[{GLYPH}]|[\p{{L}}|§£@¢\d]-[ ]*\n\s*(?:\p{{Ll}}|[0-9|§£@¢]\p{{Ll}}{{2}}))"
OPEN = rf"([{GLYPH}-]*\p{{Lu}}{{2,}})-[ ]*\n\s*(\p{{Lu}}{{2,}})(?![\p{{Ll}}])"


def join_lines(body: Column) -> Column:
    """The body in one line: sure hyphens closed, other hyphens at a line's end kept, line ends as spaces."""
    text = F.regexp_replace(body, rf"(?<=[\p{{L}}|§£@¢\d])[{SOFT}][ ]*\n\s*(?=[{GLYPH}])", "")
    text = F.regexp_replace(text, r"(?<=[\p{L}|§£@¢\d])-[ ]*\n\s*(?=\p{Ll})", "")
    text = F.regexp_replace(text, r"(?<=[\p{L}|§£@¢\d])-[ ]*\n\s*", "-")
    return F.regexp_replace(text, r"\s+", " ")


def words(text: Column) -> Column:
    """The text's words, hyphenated ones whole, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(rf"[{GLYPH}]+(?:-[{GLYPH}]+)*"), F.lit(0))


def lexicon(joined: DataFrame) -> DataFrame:
    """``word, n``: every word with the number of texts that have it."""
    return joined.select(F.explode(F.array_distinct(words(F.col("joined")))).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


#: Anagram hashes are taken modulo this prime, so that no letter and no length overflows.
PRIME = 2_147_483_647


def anagram(word: Column) -> Column:
    """Sum of the letters' code points to the fifth power modulo ``PRIME``: equal for anagrams, and shifted by a constant for a
    confusion. Equal hashes are verified letter by letter afterwards."""

    def fifth(c: Column) -> Column:
        code = F.ascii(c).cast("bigint")
        square = code * code % PRIME
        return square * square % PRIME * code % PRIME

    return F.aggregate(F.split(word, ""), F.lit(0).cast("bigint"), lambda acc, c: (acc + F.when(c == "", F.lit(0).cast("bigint")).otherwise(fifth(c))) % PRIME)


def _anagram(text: str) -> int:
    return sum(ord(c) ** 5 for c in text) % PRIME


def corrections(lex: DataFrame, frequent: int = FREQUENT, floor: int = FLOOR) -> DataFrame:
    """``word, variant, n``: rare words that one confusion turns into a much more frequent word; the best variant each.

    An equi-join of anagram hashes: rare word's hash, shifted by the confusion, equals the frequent word's hash.
    Ranked by frequency, then alphabet. Words shorter than four letters are not corrected: most are one confusion away from
    another word. ``n`` is the number of texts that have the word.
    """
    lex = lex.where("length(word) >= 4")
    table = F.array(*[F.struct(F.lit(a).alias("seen"), F.lit(b).alias("true"), F.lit(_anagram(b) - _anagram(a)).alias("shift")) for a, b in CONFUSIONS])
    low = lex.where(F.col("word").rlike(r"\p{L}")).select("word", F.col("n").alias("n_word"), anagram(F.col("word")).alias("hash"))
    low = low.withColumn("c", F.explode(F.filter(table, lambda c: F.contains(F.col("word"), c["seen"]))))
    low = low.select("word", "n_word", "c.seen", "c.true", F.pmod(F.col("hash") + F.col("c.shift"), F.lit(PRIME)).alias("hash"))
    high = lex.where((F.col("n") >= floor) & F.col("word").rlike(r"^[\p{L}-]+$")).select(F.col("word").alias("variant"), F.col("n").alias("n_variant"), anagram(F.col("word")).alias("hash"))
    pairs = low.join(high, "hash").where(F.col("n_variant") >= frequent * F.col("n_word"))
    at = F.sequence(F.lit(1), F.length("word"))
    same = F.exists(at, lambda i: (F.substring("word", i, F.length("seen")) == F.col("seen")) & (F.concat(F.substring("word", F.lit(1), i - 1), F.col("true"), F.substring("word", i + F.length("seen"), F.length("word"))) == F.col("variant")))
    return pairs.where(same).groupBy("word").agg(F.max_by("variant", F.struct("n_variant", "variant")).alias("variant"), F.first("n_word").alias("n"))


def _open_hyphens(bodies: DataFrame, lex: DataFrame) -> DataFrame:
    """``tid`` of texts with a hyphen between capitals at a line's end that joins no double name, by the words elsewhere."""
    pairs = bodies.where(F.col("body").rlike(OPEN)).select("tid", F.explode(F.arrays_zip(F.regexp_extract_all("body", F.lit(OPEN), F.lit(1)).alias("a"), F.regexp_extract_all("body", F.lit(OPEN), F.lit(2)).alias("b"))).alias("x"))
    pairs = pairs.select("tid", F.lower("x.a").alias("a"), F.lower("x.b").alias("b"))
    pairs = pairs.withColumns({"whole": F.concat("a", "b"), "double": F.concat_ws("-", "a", "b")})
    whole = lex.select(F.col("word").alias("whole"), F.col("n").alias("n_whole"))
    double = lex.select(F.col("word").alias("double"), F.col("n").alias("n_double"))
    seen = pairs.join(whole, "whole", "left").join(double, "double", "left")
    n_whole, n_double = F.coalesce("n_whole", F.lit(0)), F.coalesce("n_double", F.lit(0)) - 1  # its own line counts once
    short = (F.length("a") < 5) | (F.length("b") < 5)
    return seen.where((n_whole > n_double) | ((n_whole == 0) & (n_double <= 0) & short)).select("tid").distinct()


def _analyse(texts: DataFrame) -> tuple[DataFrame, _Corrections, DataFrame]:
    """Texts without edge lines and in one line; the corrections; the texts with an open hyphen that closes."""
    joined = cut(without_edges(mark_lines(texts, running_heads(texts))).withColumn("joined", join_lines(F.col("body"))))
    lex = cut(lexicon(joined))
    total = lex.agg(F.sum("n")).first()[0] or 0
    fixes = cut(corrections(lex))
    hot = lex.where(F.col("n") >= max(1, -(-total // HOT_WORDS))).join(fixes, "word", "left_anti").select("word")  # at most HOT_WORDS words
    return joined, _Corrections(fixes, cut(hot), total), _open_hyphens(joined, lex)


@dataclass
class _Corrections:
    """The corrections, the frequent words that have none, and the number of words, counted once for each text."""

    fixes: DataFrame
    hot: DataFrame
    total: int


def _rare_words(joined: DataFrame, book: _Corrections) -> DataFrame:
    """``tid, word, variant`` for every text's words that have a correction. The most frequent words without one are left out by a
    broadcast whose size is bounded before the rest is shuffled, and those with one are joined by broadcast."""
    every = joined.select("tid", F.explode(F.array_distinct(words(F.col("joined")))).alias("word")).where(F.length("word") >= 4)
    open_ = every.join(F.broadcast(book.hot), "word", "left_anti")
    return attach(open_, book.fixes, ["word"], "n", book.total).select("tid", "word", "variant")


def find_noise(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, kind``: one row per row of ``df`` and kind of noise in its text: hyphen, misread, header, page_number.

    Work is done once per different text. Running heads are lines whose letters are seen in a head's layout in several texts;
    page numbers are recognised alone in a line or at the edge of a head; hyphens are sure marks, hyphens before a small
    letter, or hyphens between capitals whose joined word is known elsewhere; misread words hold a sign that no word has or
    are rare and one confusion away from a frequent word (anagram-hash join). Null and empty texts have no noise.
    """
    texts = cut(distinct_texts(df, text))
    joined, fixes, opened = _analyse(texts)
    body, line = F.col("body"), F.regexp_replace(F.col("joined"), ORDINAL, " ")
    certain = joined.select(
        "tid",
        F.array_compact(
            F.array(
                F.when(F.col("header"), F.lit("header")),
                F.when(F.col("page_number"), F.lit("page_number")),
                F.when(body.rlike(SURE), F.lit("hyphen")),
                F.when(line.rlike(MISREAD_WORD) | line.rlike(MISREAD_YEAR), F.lit("misread")),
            )
        ).alias("kinds"),
    )
    kinds = certain.select("tid", F.explode("kinds").alias("kind"))
    kinds = kinds.unionByName(opened.select("tid", F.lit("hyphen").alias("kind")))
    kinds = kinds.unionByName(_rare_words(joined, fixes).select("tid", F.lit("misread").alias("kind")))
    kinds = kinds.groupBy("tid").agg(F.collect_set("kind").alias("kinds"))  # at most four
    sized = kinds.join(texts.select("tid", "n"), "tid")
    rows = df.where(F.length(text) > 0).select(F.col(id_col).alias("id"), F.md5(F.col(text)).alias("tid"))
    return attach(rows, sized, ["tid"], "n", df.count()).select("id", F.explode("kinds").alias("kind")).distinct()


_SIGNS = {a: b for a, b in reversed(CONFUSIONS) if len(a) == 1 and a not in "eculbhftinm"}


def _letters(word: str) -> dict[int, str]:
    """What the signs of a word stand for, in capitals where its letters are."""
    upper = sum(c.isupper() for c in word) > 1 or word[:1].isupper() and len(word) < 3
    return {ord(a): b.upper() if upper else b for a, b in _SIGNS.items()}


@F.pandas_udf(T.StringType())
def _apply(texts: pd.Series, fixes: pd.Series) -> pd.Series:
    """Each text with its corrections, the letter case of the word's first letter kept. Signs that no word has, in words without a
    correction, take the letter that they are read for first among the confusions."""
    token = regex.compile(rf"[{GLYPH}]+(?:-[{GLYPH}]+)*")
    year, odd, ordinal = regex.compile(MISREAD_YEAR), regex.compile(MISREAD_WORD), regex.compile(ORDINAL)
    out = []
    for text, pairs in zip(texts, fixes):
        known = {p["word"]: p["variant"] for p in pairs} if pairs is not None else {}

        def fix(m, known=known):
            new = known.get(m[0].lower())
            if new is None:
                return m[0].translate(_letters(m[0])) if odd.search(m[0]) and not ordinal.fullmatch(m[0]) else m[0]
            return new.upper() if m[0].isupper() else new.capitalize() if m[0][0].isupper() else new

        text = token.sub(fix, text) if known or odd.search(text) else text
        out.append(year.sub(lambda m: m[0].translate(DIGITS), text))
    return pd.Series(out, dtype=object)


def repair(df: DataFrame, id_col: str, text: str) -> DataFrame:
    """``id, text``: the text as continuous paragraphs: edge lines removed, split words joined, ranked corrections applied.

    Null stays null and the empty string stays empty. Rows of one text share the work.
    """
    texts = cut(distinct_texts(df, text))
    joined, fixes, opened = _analyse(texts)
    open_text = F.regexp_replace(F.regexp_replace("body", rf"(?<=\p{{Lu}}{{2}})-[ ]*\n\s*(?=\p{{Lu}}{{2}})", ""), "\x00", "")
    marked = joined.join(opened.withColumn("closes", F.lit(True)), "tid", "left")
    marked = marked.withColumn("joined", F.when(F.col("closes"), join_lines(open_text)).otherwise(F.col("joined")))
    per_text = _rare_words(joined, fixes).groupBy("tid").agg(F.collect_list(F.struct("word", "variant")).alias("fixes"))
    fixed = marked.join(per_text, "tid", "left").select("tid", "n", F.trim(_apply("joined", "fixes")).alias("repaired"))
    rows = df.where(F.length(text) > 0).select(F.col(id_col).alias("id"), F.md5(F.col(text)).alias("tid"))
    done = attach(rows, fixed, ["tid"], "n", df.count()).select("id", F.col("repaired").alias("text"))
    return done.unionByName(df.where(F.col(text).isNull() | (F.length(text) == 0)).select(F.col(id_col).alias("id"), F.col(text).alias("text")))
