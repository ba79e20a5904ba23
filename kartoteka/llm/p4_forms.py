"""One consistent form for text that looks the same but is made of different characters."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pandas as pd
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Letters of other alphabets that look like a Latin one, each string beside what it looks like.
CYRILLIC = "АВЕЅІЈКМНОРСТУХЬавеѕіјкмнорстухьһԁԛԝѵӏ"
CYRILLIC_AS = "ABESIJKMHOPCTYXbabesijkmhopctyxbhdqwvl"
GREEK = "ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαικνορυχγϳ"
GREEK_AS = "ABEZHIKMNOPTYXaikvopuxyj"
LATIN = "ɑɡıƖɩǀɪ"
LATIN_AS = "agiliII"
LOOKS = dict(zip(CYRILLIC + GREEK + LATIN, CYRILLIC_AS + GREEK_AS + LATIN_AS))
#: A letter and an overlay that together look like one letter.
STROKED = {"l̸": "ł", "L̸": "Ł", "l̷": "ł", "L̷": "Ł", "l̵": "ł", "L̵": "Ł", "o̸": "ø", "O̸": "Ø", "d̵": "đ", "D̵": "Đ"}
#: Dashes that look like the hyphen, and quotes that look like the apostrophe.
DASHES, QUOTES = "‐‑‒–−﹣－⁃", "’ʼʹ′`´＇"
IGNORABLE = regex.compile(r"[\p{Default_Ignorable_Code_Point}\p{Cf}\p{Cc}--[\t\n\r\f\v]]", regex.V1)
SPACE = regex.compile(r"\s", regex.V1)
LETTER_OF = {k: regex.compile(rf"\p{{Script={k}}}") for k in ("Latin", "Cyrillic", "Greek")}
#: What an ordinary value consists of, for the JVM to leave out before Python; the rest is looked at in full.
ORDINARY = r"^[ -~ĄąĆćĘęŁłŃńÓóŚśŹźŻż]*$"


@lru_cache(maxsize=100_000)
def surface(value: str) -> str:
    """The value as it looks, in its own letter case: composed compatibility form, no hidden characters, plain spaces and
    hyphens, and look-alike letters in the alphabet of the value's other letters."""
    text = IGNORABLE.sub("", unicodedata.normalize("NFKC", value))
    text = SPACE.sub(" ", text)
    text = unicodedata.normalize("NFKC", text)
    if "̷" in text or "̸" in text or "̵" in text:
        for pair, one in STROKED.items():
            text = text.replace(pair, one)
    text = "".join("-" if c in DASHES else "'" if c in QUOTES else c for c in text)
    if any(LETTER_OF["Greek"].match(c) or LETTER_OF["Cyrillic"].match(c) or c in LATIN for c in text):
        text = unicodedata.normalize("NFKD", text)  # a look-alike letter may carry an accent
    if any(c in LOOKS for c in text):
        plain = [c for c in text if c.isalpha() and c not in LOOKS]
        latin = sum(1 for c in plain if LETTER_OF["Latin"].match(c))
        if latin >= len(plain) - latin and (latin or not plain and any(c in LATIN for c in text)):
            text = "".join(LOOKS.get(c, c) for c in text)
        elif plain:
            text = "".join(_back(c, plain) if LETTER_OF["Latin"].match(c) else c for c in text)
    elif any(LETTER_OF["Cyrillic"].match(c) or LETTER_OF["Greek"].match(c) for c in text):
        plain = [c for c in text if c.isalpha() and not LETTER_OF["Latin"].match(c)]
        if 2 * len(plain) > sum(c.isalpha() for c in text):
            text = "".join(_back(c, plain) if LETTER_OF["Latin"].match(c) else c for c in text)
    return unicodedata.normalize("NFKC", text)


def _back(c: str, plain: list[str]) -> str:
    """The letter of the value's own alphabet that looks like the Latin letter ``c``, if there is one."""
    pairs = zip(CYRILLIC, CYRILLIC_AS) if LETTER_OF["Cyrillic"].match(plain[0]) else zip(GREEK, GREEK_AS)
    return next((k for k, v in pairs if v == c), c)


def canonical(value: str | None) -> str | None:
    """The form under which equal-looking values compare equal: :func:`surface`, trimmed, single spaces, full case folding."""
    if value is None:
        return None
    return unicodedata.normalize("NFKC", " ".join(surface(value).split()).casefold())


def is_irregular(value: str | None) -> bool:
    """Whether a character of the value looks like, or hides within, its ordinary spelling without being the ordinary one."""
    return value is not None and surface(value) != value


def _each(values: pd.Series, f) -> pd.Series:
    """``f`` once per distinct value of the batch."""
    codes, distinct = pd.factorize(values, use_na_sentinel=True)
    out = pd.Series([f(v) for v in distinct] + [f(None)], dtype=object)
    return out.iloc[codes].reset_index(drop=True)  # the code of a null is -1, the last


@F.pandas_udf(T.StringType())
def canonical_udf(values: pd.Series) -> pd.Series:
    return _each(values, canonical)


@F.pandas_udf(T.BooleanType())
def irregular_udf(values: pd.Series) -> pd.Series:
    return _each(values, is_irregular).astype(bool)


def canonicalise(df: DataFrame, columns: Sequence[str], suffix: str = "_canonical") -> DataFrame:
    """``df`` with the canonical form of each of ``columns`` in a column of that name plus ``suffix``.

    No shuffle and no state: each Arrow batch works once per distinct value, so a value that fills a third of the rows costs
    what any other does. Null stays null, the empty string stays empty; a column of the new name is replaced.
    """
    return df.withColumns({c + suffix: canonical_udf(F.col(c)) for c in columns})


def irregular_values(df: DataFrame, id_col: str, columns: Sequence[str]) -> DataFrame:
    """``id, field`` for every value with a character that is not the ordinary single one for its look.

    Values of ASCII and Polish letters alone are passed by in the JVM; nulls and empty values are never irregular.
    """
    fields = F.explode(F.array(*[F.struct(F.lit(c).alias("field"), F.col(c).alias("value")) for c in columns])).alias("x")
    odd = df.select(F.col(id_col).alias("id"), fields).select("id", "x.field", "x.value").where(~F.col("value").rlike(ORDINARY))
    return odd.where(irregular_udf("value")).select("id", "field").distinct()
