"""Scalar text functions as column expressions; only :func:`fold_marks` leaves the JVM."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the language score.
DIACRITICS = "ąćęłńóśźżĄĆĘŁŃÓŚŹŻ"
FUNCTION_WORDS = ("i", "w", "z", "na", "do", "od", "pan", "pani", "roku", "ur", "zm", "syn", "córka", "małż", "wdowa")
CHAR_RATE, WORD_RATE, CHAR_WEIGHT, WORD_WEIGHT = 0.06, 0.20, 0.6, 0.4
SAMPLE = 500
# Fixed patterns of the structural fingerprint and what replaces them, in this order.
TEMPLATE = ((r"[A-ZŁŚŹŻĆŃÓĄ]{2,}", "U"), (r"\d{4}", "Y"), (r"\d{1,2}", "N"), (r"[a-złśźżćńóą]{2,}", "l"))
# Fixed values of the surname form that persons are matched by.
PLAIN_FROM, PLAIN_TO = "ąćęłńóśźż", "acelnoszz"


def strip(text: Column) -> Column:
    """Without white space of any kind at both ends."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def content_id(content: Column) -> Column:
    """First 16 hex digits of the content's SHA-256."""
    return F.substring(F.sha2(content.cast("binary"), 256), 1, 16)


def sample_text(text: Column, n: int = SAMPLE) -> Column:
    return F.substring(text, 1, n)


def lang_score(sample: Column) -> Column:
    """How Polish a sample is: share of Polish letters and of Polish function words, each against its usual rate, in [0, 1],
    four decimals. Null and empty samples score 0."""
    text = F.coalesce(sample, F.lit(""))
    letters = F.length(F.regexp_replace(text, f"[^{DIACRITICS}]", ""))
    words = F.regexp_count(text, F.lit(r"(?U)\S+"))
    known = F.regexp_count(text, F.lit(rf"(?iU)\b({'|'.join(FUNCTION_WORDS)})\b"))
    by_char = F.least(letters / F.length(text) / F.lit(CHAR_RATE), F.lit(1.0))
    by_word = F.when(words > 0, F.least(known / words / F.lit(WORD_RATE), F.lit(1.0))).otherwise(0.0)
    return F.when(F.length(text) == 0, F.lit(0.0)).otherwise(F.round(by_char * CHAR_WEIGHT + by_word * WORD_WEIGHT, 4))


def url_slug(url: Column) -> Column:
    """Last part of the URL's path, else its host, else the URL."""
    part = F.try_element_at(F.filter(F.split(F.try_parse_url(url, F.lit("PATH")), "/"), lambda x: x != ""), F.lit(-1))
    return F.coalesce(part, F.nullif(F.try_parse_url(url, F.lit("AUTHORITY")), F.lit("")), url)


def template(text: Column) -> Column:
    """The text with capital words, years, short numbers and small words replaced by U, Y, N and l."""
    out = text
    for pattern, letter in TEMPLATE:
        out = F.regexp_replace(out, rf"(?U)\b{pattern}\b", letter)
    return out


def fingerprint(text: Column) -> Column:
    """Hash of the text's :func:`template`; entries of one layout share it. Strip the text first."""
    return F.substring(F.sha2(template(text), 256), 1, 16)


def plain_surname(surname: Column) -> Column:
    """Lower case, Polish letters without their marks, trimmed."""
    return strip(F.translate(F.lower(surname), PLAIN_FROM, PLAIN_TO))


@F.pandas_udf(T.StringType())
def fold_marks(text: pd.Series) -> pd.Series:
    """Lower case without combining marks, trimmed; ł keeps its stroke. Null gives the empty string."""

    def one(s: str | None) -> str:
        s = unicodedata.normalize("NFD", (s or "").lower().strip())
        return "".join(c for c in s if unicodedata.category(c) != "Mn")

    codes, distinct = pd.factorize(text)
    values = pd.Series([one(s) for s in distinct] + [""], dtype=object)
    return values.iloc[codes].reset_index(drop=True)


def iso_date(date: Column) -> Column:
    """``dd.mm.yyyy`` at the start as ``yyyy-mm-dd``; else the first four digits in a row; else null."""
    text = F.lower(strip(date))
    full = r"^(\d{2})\.(\d{2})\.(\d{4})"
    parts = [F.regexp_extract(text, full, g) for g in (3, 2, 1)]
    return F.when(text.rlike(full), F.concat_ws("-", *parts)).otherwise(F.nullif(F.regexp_extract(text, r"(\d{4})", 1), F.lit("")))


def clean(text: Column) -> Column:
    """Trimmed; null if nothing is left."""
    return F.nullif(strip(text), F.lit(""))


def to_list(text: Column) -> Column:
    """Parts between commas, trimmed, empty ones left out; null gives the empty list."""
    parts = F.filter(F.transform(F.split(text, ","), lambda x: strip(x)), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def clean_list(items: Column) -> Column:
    """List items, trimmed, empty and null ones left out; null gives the empty list."""
    parts = F.filter(F.transform(items, lambda x: strip(x)), lambda x: x != "")
    return F.coalesce(parts, F.array().cast("array<string>"))


def split_names(text: Column) -> Column:
    """Parts between white space; null gives the empty list."""
    return F.coalesce(F.filter(F.split(text, r"\s+"), lambda x: x != ""), F.array().cast("array<string>"))


def title_case(text: Column) -> Column:
    """Each run of letters with a capital first letter, trimmed: nowak-kowalska becomes Nowak-Kowalska."""
    runs = F.regexp_extract_all(strip(text), F.lit(r"[\p{L}\p{M}]+|[^\p{L}\p{M}]+"), F.lit(0))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.lower(F.substring(x, F.lit(2), F.length(x))))), "")


def slice_id(doc_id: Column, page: Column, entry: Column) -> Column:
    return F.concat(doc_id.cast("string"), F.lit("_p"), page.cast("string"), F.lit("_e"), entry.cast("string"))


def entity_id(doc_id: Column, slice_of: Column) -> Column:
    """The same id for the same slice at every run."""
    return F.substring(F.sha2(F.concat_ws("|", doc_id, slice_of), 256), 1, 32)


def strip_fences(text: Column) -> Column:
    """A model's reply without the code fence around it."""
    return strip(F.regexp_replace(F.regexp_replace(strip(text), r"^```[a-z]*\n?", ""), r"\n?```$", ""))


def to_base64(content: Column) -> Column:
    """Bytes as text without line ends, for records in JSON."""
    return F.regexp_replace(F.base64(content), r"\s", "")


def from_base64(text: Column) -> Column:
    """The bytes of :func:`to_base64`; null where the text is none."""
    return F.try_to_binary(text, F.lit("base64"))
