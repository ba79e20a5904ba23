"""Personal information in free text: mentions, and texts with typed placeholders in their stead."""

from __future__ import annotations

import hashlib
import json
import secrets
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass
from datetime import date, timedelta

import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kartoteka.cluster import cut
from kartoteka.llm.given_names import FOREIGN, NAMES, SHORT, plain, seed
from kartoteka.llm.learned_names import learn

#: A word in this part of all documents, and in COMMON_LEAST at least, is a common word and no surname.
COMMON_SHARE, COMMON_LEAST = 0.002, 8
#: A word that follows a given name or initial in this part of its occurrences is a surname, however frequent.
SURNAME_SHARE = 0.2
ROUNDS = 8
#: Remembered tokens of one worker.
MEMO = 300_000

# Fixed patterns.
AT = r"(?:\s?@\s?|\s?[\[(]\s*(?:at|małpa|malpa)\s*[\])]\s?|\s(?:at|małpa)\s(?=[\w-]+(?:\s?(?:\.|[\[(])| kropka | dot )))"
DOT = r"(?:\.|\s?[\[(]\s*(?:kropka|dot)\s*[\])]\s?|\s(?:kropka|dot)\s)"
EMAIL = regex.compile(rf"(?<![\w.+@-])[\w](?:[\w.+-]*[\w])?{AT}[\w-]+(?:{DOT}[\w-]+)+", regex.I)
URL = regex.compile(r"https?://\S+")
PESEL = regex.compile(r"(?<![\d/.-])(?<!\d )\d{6}[ -]?\d{5}(?![\d/]|[.-]\d)")
CARD = regex.compile(r"(?<![\p{L}\d])(?:\p{Lu}{3}[ -]?\d{3} ?\d{3}|\p{Lu}{2}[ -]?\d{3} ?\d{4})(?![\d/]|[.-]\d)")
STREETS = r"(?:ul|al|pl|os)\.\s*|(?:ulica|ulicy|aleja|alei|aleje|plac|placu|osiedle|osiedlu)\s+"
HOUSE = r"\d{1,4}(?:\p{L}(?!\p{L}))?(?:\s?/\s?\d{1,4}\p{L}?)?(?:\s*(?:m|lok)\.\s*\d{1,4})?"
ADDRESS = regex.compile(
    rf"(?<![\p{{L}}\d])(?:(?:{STREETS})(?:\p{{L}}[\p{{L}}.'-]*\s+){{1,4}}?{HOUSE}|rynek\s+{HOUSE})(?![\p{{L}}\d])", regex.I
)
ADDRESS_DE = regex.compile(r"(?<![\p{L}\d])\p{Lu}[\p{L}-]*?(?:straße|strasse|str\.|gasse|weg|platz|allee|damm|ufer)\s*\d{1,4}\s?(?:[a-z](?!\p{L}))?(?:/\d+)?(?![\p{L}\d])")
ADDRESS_EN = regex.compile(r"(?<![\p{L}\d/-])\d{1,4}[a-zA-Z]?(?:/\d+)?\s+(?:\p{Lu}[\p{L}'-]+\s+){1,3}(?:Street|St\.|Lane|Avenue|Ave\.?|Road|Rd\.?|Square|Row|Hill|Terrace|Drive|Court)(?!\p{L})")
_LONG = (
    r"\+\d{2}[ -]?\d{2} \d{3} \d{2} \d{2}|\+\d{2}[ -]?\d{3}[ -]\d{3}[ -]\d{3}|\+\d{9,12}|00\d{2} ?\d{3} ?\d{3} ?\d{3}|00\d{2} \d{2} \d{3} \d{2} \d{2}"
    r"|\(?0-\d{2}\)?[ /]\d{3}-\d{2}-\d{2}|0-\d{2}/\d{3}-?\d{4}|\(\d{2,3}\) ?\d{3}[ -]\d{2}[ -]\d{2}|\(\d{2,3}\) ?\d{7}|\(\d{2,3}\) ?\d{3}[ -]\d{3,4}"
    r"|\d{3}[ .-]\d{3}[ .-]\d{3,4}|\d{2}[ -]\d{3}[ -]\d{2}[ -]\d{2}|\d{9,10}|\d{3}-\d{2}-\d{2}"
)
PHONE = regex.compile(rf"(?<![\w/.+(-])(?<!\d )(?:{_LONG})(?![\w/]|[.,-]\d| \d{{2,}})")
SHORT_PHONE = regex.compile(r"(?<=(?:tel|telef)\.:? ?|telefon[a-z]*:? (?:nr )?|numerem telefonu |fernruf:? |fernspr(?:echer|\.):? |phone:? |call )\d{1,3}(?:[- ]\d{2}){0,2}(?![\w/]|[.,-]\d)", regex.I)
#: Words just before a number that is no phone number and no identity number.
NO_PHONE = regex.compile(
    r"(?:poz|nr|sygn|sygnatura|isbn(?: książki)?|bibliografia|reference|item|abschrift|akte|file|kwerenda|nosił numer|o numerze|inwentarzowym|cyfrowej|skanu|aktu|mikrofilm|katalog|numer|numerem wniosku|dział|karta|blatt|folium|lat|lata|zeszyt)[.:]?\s*$",
    regex.I,
)
#: Fixed pattern: a full date, day or year first; and one after a word for birth.
DATE = r"(?:(?P<d1>\d{1,2})[./-](?P<m1>\d{1,2})[./-](?P<y2>\d{4})|(?P<y1>\d{4})[./-](?P<m2>\d{1,2})[./-](?P<d2>\d{1,2}))"
BIRTH_DATE = regex.compile(rf"(?:(?<!\p{{L}})(?:ur|urodz|geb|born|nat)\.?|urodzon[aey]|geboren|\*)(?: dnia| am| on| die)? ?(?P<date>{DATE})(?![\d/]|[.-]\d)", regex.I)
_PESEL_CUE = regex.compile(r"pesel(?:\s+to|u|em)?[:\s]*$", regex.I)
TOKEN = regex.compile(r"\p{L}[\p{L}\p{M}]*(?:['’]\p{L}+)?(?:-\p{Lu}[\p{L}\p{M}]+|-\p{Ll}{4,})?")
#: Spaces that look like the plain one, and dashes that look like the hyphen.
SPACES, DASHES = "\u00a0\u2007\u202f\u2009", "\u2010\u2011"
KINDS = ("email", "id_number", "address", "phone", "name")
# What a text must hold for a pattern to be tried on it.
_DIGIT, _SIX_DIGITS, _SERIES = regex.compile(r"\d"), regex.compile(r"\d{6}"), regex.compile(r"\p{Lu}{2}[ -]?\d{3}")
_AT_WORD = regex.compile(r"[\[( ]at[\]) ]")
_ADDRESSES = (
    (("ul.", "al.", "pl.", "os.", "ulic", "alej", "alei", "plac", "osiedl", "rynek"), True, ADDRESS),
    (("straße", "strasse", "str.", "gasse", "weg", "platz", "allee", "damm", "ufer"), False, ADDRESS_DE),
    (("Street", "St.", "Lane", "Ave", "Road", "Rd", "Square", "Row", "Hill", "Terrace", "Drive", "Court"), False, ADDRESS_EN),
)
_PHONE_WORDS = ("tel", "numerem telefonu", "fernr", "fernspr", "phone", "call")
_BIRTH_WORDS = ("ur", "geb", "born", "nat", "*")
_PREFIX = regex.compile(r"^(?:00|(?=48\d{9}$))48(?=\d{9}$)|^0(?=\d{9}$)")
_GAP = regex.compile(r"[ \t]*\n?[ \t]*")
_AFTER_STREET = regex.compile(rf"(?:{STREETS}|(?:św|sw)\.\s*)$", regex.I)


def _day(m: regex.Match) -> date | None:
    """The day that a match of ``DATE`` writes, if there is one within the years that dates are permuted in."""
    if m is None:
        return None
    try:
        day = date(int(m["y1"] or m["y2"]), int(m["m2"] or m["m1"]), int(m["d2"] or m["d1"]))
    except ValueError:
        return None
    return day if 1800 <= day.year < 2300 else None


def _digits(text: str) -> str:
    return "".join(filter(str.isdecimal, text))


def valid_pesel(digits: str) -> bool:
    """Eleven digits with a right check digit and a date that exists."""
    if len(digits) != 11 or sum(int(d) * w for d, w in zip(digits, (1, 3, 7, 9, 1, 3, 7, 9, 1, 3, 1))) % 10:
        return False
    y, m, d = int(digits[:2]), int(digits[2:4]), int(digits[4:6])
    try:
        date(1900 + y, m % 20, d)
    except ValueError:
        return False
    return True


def declined(name: str) -> set[str]:
    """Cases of a Polish given name, by its ending."""
    forms = {name}
    if name.endswith("a"):
        stem = name[:-1]
        forms |= {stem + "ę", stem + "ą"}  # without the vocative, which letters alone have: Anno is Latin, too
        if name.endswith("ia") and not name.endswith(("sia", "zia", "nia", "cia")) or name.endswith(("ria", "nia", "lia", "bia")):
            forms |= {stem + "i"}
        elif name.endswith(("ia", "la")):
            forms |= {name[:-2] + name[-2] + ("i" if name.endswith("la") else ""), stem + "i"}
        else:
            soft = {"k": "ce", "g": "dze", "r": "rze", "t": "cie", "ł": "le", "d": "dzie", "h": "sze"}
            forms |= {stem + ("i" if stem[-1] in "kg" else "y"), stem[:-1] + soft[stem[-1]] if stem[-1] in soft else stem + "ie"}
    elif name.endswith(("y", "i")):
        stem = name if name.endswith("i") else name[:-1]
        forms |= {stem + "ego", stem + "emu", name + "m"}
    else:
        stem = name[:-2] + name[-1] if name.endswith(("ek", "eł")) else name
        forms |= {stem + "a", stem + "owi", stem + "em", stem + "iem", stem + "u", stem + "ie"}
    return forms


@dataclass
class GivenForms:
    """Given names in all cases, without accents: those of the list, and ``others`` (as spelled) that the data show."""

    others: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        known = [f for n in (*NAMES, *SHORT) for f in declined(n)] + list(FOREIGN) + [f for n in FOREIGN for f in (n + "a", n + "owi")]
        self.forms = frozenset(plain(f) for f in known) | frozenset(plain(f) for n in self.others for f in declined(n))
        self.kinds = _Kinds(self.forms)

    def __reduce__(self):
        return GivenForms, (self.others,)


class _Kinds(dict):
    """Of each token seen: G or g for a given name in capital or small letters, I for a capital letter, - for what no surname is,
    else S or s."""

    def __init__(self, forms: frozenset[str]) -> None:
        self.forms = forms

    def __missing__(self, token: str) -> str:
        if len(self) >= MEMO:
            self.clear()
        if len(token) == 1:
            kind = "I" if token.isupper() else "-"
        elif len(token) > 2 and plain(token) in self.forms:
            kind = "G" if token[0].isupper() else "g"
        else:
            kind = "-" if len(token) < 3 else "S" if token[0].isupper() else "s"
        self[token] = kind
        return kind


def _hits(text: str) -> Iterator[tuple[str, int, int]]:
    """``(kind, start, end)`` of what looks like a number, an address or a birth date. A kind's pattern is only tried on texts that
    have what each of its mentions has."""
    low = text.lower()
    if "@" in text or "małpa" in low or "malpa" in low or _AT_WORD.search(low):
        yield from (("email", *m.span()) for m in EMAIL.finditer(text))
    if not _DIGIT.search(text):
        return

    def before(start: int) -> str:
        return text[max(0, start - 24) : start]

    if _SIX_DIGITS.search(text):
        for m in PESEL.finditer(text):
            if _PESEL_CUE.search(before(m.start())) or (valid_pesel(_digits(m[0])) and not NO_PHONE.search(before(m.start()))):
                yield "id_number", m.start(), m.end()
    if _SERIES.search(text):
        for m in CARD.finditer(text):
            if not NO_PHONE.search(before(m.start())):
                yield "id_number", m.start(), m.end()
    for words, within, pattern in _ADDRESSES:
        if any(w in (low if within else text) for w in words):
            yield from (("address", *m.span()) for m in pattern.finditer(text))
    for m in PHONE.finditer(text):
        if not NO_PHONE.search(before(m.start())):
            yield "phone", m.start(), m.end()
    if any(w in low for w in _PHONE_WORDS):
        yield from (("phone", *m.span()) for m in SHORT_PHONE.finditer(text))
    if any(w in low for w in _BIRTH_WORDS):
        for m in BIRTH_DATE.finditer(text):
            if _day(m) is not None:
                yield "date", m.start("date"), m.end("date")


class Spans:
    """Disjoint spans ``(kind, start, end, value)`` in the order of their starts."""

    def __init__(self, spans: Iterable[Sequence] = ()) -> None:
        self.spans = list(spans)
        self.starts = [s[1] for s in self.spans]

    def add(self, kind: str, start: int, end: int, value: str) -> None:
        """Add a span that overlaps none; others are passed by."""
        at = bisect_left(self.starts, start)
        if (at == 0 or self.spans[at - 1][2] <= start) and (at == len(self.starts) or self.starts[at] >= end):
            self.starts.insert(at, start)
            self.spans.insert(at, (kind, start, end, value))


def scan(text: str, forms: GivenForms) -> tuple[list[tuple], list[tuple], list[str], list[str]]:
    """One reading of a text: its hits ``(kind, start, end, value)``, URLs among them as kind ``url``; the tokens that may belong to a name as ``(number, kind,
    word, start, end, gap, street)``; its words in small letters; and those of them that follow a given name or initial.

    ``gap`` tells what stands behind the token: w white space with one line end at most, d a dot and then white space or
    nothing, c a comma and then white space, s other white space, - anything else; ``street`` whether a street word stands before it.
    """
    for marks, plain_mark in ((SPACES, " "), (DASHES, "-")):  # code point for code point, so positions stay
        for mark in marks:
            text = text.replace(mark, plain_mark)
    spans = Spans(("url", *m.span(), "") for m in URL.finditer(text)) if "://" in text else Spans()
    for kind, start, end in _hits(text):
        spans.add(kind, start, end, text[start:end])
    tokens = list(TOKEN.finditer(text))
    words = [m[0] for m in tokens]
    known = forms.kinds
    kinds = [known[w] for w in words]
    wanted = {i + d for i, k in enumerate(kinds) if k in "GgI" for d in (-1, 0, 1)}
    after: list[str] = []
    out = []
    for i in sorted(wanted):
        if not 0 <= i < len(tokens):
            continue
        m, kind = tokens[i], kinds[i]
        start, end = m.span()
        if kind == "I" and text[end : end + 1] != ".":
            kind = "-"
        gap = text[end : tokens[i + 1].start()] if i + 1 < len(tokens) else "-"
        if kinds[i] in "GgI" and i + 1 < len(tokens) and (gap == ". " if kinds[i] == "I" else gap.isspace()):
            after.append(words[i + 1].lower())
        if gap.startswith("."):
            mark = "d" if _GAP.fullmatch(gap, 1) else "-"
        elif gap.startswith(","):
            mark = "c" if len(gap) > 1 and _GAP.fullmatch(gap, 1) else "-"
        else:
            mark = "w" if gap and _GAP.fullmatch(gap) else "-"
        street = kind != "-" and _AFTER_STREET.search(text, max(0, start - 12), start) is not None
        out.append((i, kind, words[i], start, end, mark, street))
    return spans.spans, out, list(map(str.lower, words)), after


def _names(tokens: list[Sequence], common: frozenset[str]) -> Iterator[tuple[int, int, str]]:
    """Start, end and words of every name among the tokens of :func:`scan`; common words are no surnames."""
    kinds = ["-" if t[1] in "Ss" and t[2].lower() in common else t[1] for t in tokens]

    def near(a: int, b: int, comma: bool = False) -> bool:
        """Whether two tokens follow one another with only white space between, an initial's dot, or the allowed comma."""
        if b >= len(tokens) or tokens[b][0] != tokens[a][0] + 1:
            return False
        gap = tokens[a][5]
        return gap == "d" if kinds[a] == "I" else gap == "w" or (comma and gap == "c")

    i = 0
    while i < len(tokens):
        kind, start, street = kinds[i], tokens[i][3], tokens[i][6]
        if kind in "GgI":  # given names and initials, then a surname
            j = i
            while near(j, j + 1) and kinds[j + 1] in ("GgI" if kind != "g" else "g"):
                j += 1
            last = j + 1
            if near(j, last) and (kinds[last] == "S" or (kinds[last] == "s" and kind == "g")):
                if not street:
                    yield start, tokens[last][4], " ".join(t[2] for t in tokens[i : last + 1])
                i = last + 1
            else:
                i = j + 1
            continue
        if kind in "Ss" and near(i, i + 1, comma=True) and kinds[i + 1] in ("GI" if kind == "S" else "g"):
            j = i + 1
            while near(j, j + 1) and kinds[j + 1] in "GgI":
                j += 1
            if not (near(j, j + 1) and kinds[j + 1] in ("S" if kind == "S" else "s")):  # else the given name belongs to the next surname
                if not street:
                    yield start, tokens[j][4] + (kinds[j] == "I"), " ".join(t[2] for t in tokens[i : j + 1])
                i = j + 1
                continue
        i += 1


def settle(hits: list[Sequence], tokens: list[Sequence], common: frozenset[str]) -> list[Sequence]:
    """The mentions ``(kind, start, end, value)`` of a scanned text in the order of their starts, none within another."""
    spans = Spans(hits)
    for name in _names(tokens, common):
        spans.add("name", *name)
    return [s for s in spans.spans if s[0] != "url"]


def mentions(text: str, common: frozenset[str], forms: GivenForms | None = None) -> list[tuple[str, int, int]]:
    """``(kind, start, end)`` of every mention of one text in code points, in the order of their starts."""
    hits, tokens, _, _ = scan(text, forms or GivenForms())
    return [tuple(s[:3]) for s in settle(hits, tokens, common)]


def scan_texts(df: DataFrame, id_col: str, text: str, forms: GivenForms, keep: bool = False) -> DataFrame:
    """One reading of all texts: rows of words with their counts (``part`` 0), and for each text with a hit or a token the
    ``found`` ones, as JSON (``part`` 1). With ``keep`` every text comes out, null and empty ones too."""
    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text).alias("text"))
    rows = rows if keep else rows.where(F.length("text") > 0)
    book = df.sparkSession.sparkContext.broadcast(forms)

    def frame(part: int, **columns: list) -> pd.DataFrame:
        n = len(next(iter(columns.values())))
        every = {c: columns.get(c, [None] * n) for c in ("word", "docs", "times", "after", "doc_id", "text", "found")}
        return pd.DataFrame({"part": [part] * n, **{c: pd.Series(v, dtype=object) for c, v in every.items()}})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            docs, times, after = Counter(), Counter(), Counter()
            ids, texts, found = [], [], []
            for doc_id, value in zip(batch["doc_id"].tolist(), batch["text"].tolist()):
                hits, tokens = [], []
                if value:
                    hits, tokens, words, follow = scan(value, book.value)
                    docs.update(set(words))
                    times.update(words)
                    after.update(follow)
                if keep or hits or tokens:
                    ids.append(doc_id)
                    texts.append(value if keep else None)
                    found.append(json.dumps((hits, tokens)) if hits or tokens else None)
            yield frame(0, word=list(docs), docs=list(docs.values()), times=[times[w] for w in docs], after=[after[w] for w in docs])
            yield frame(1, doc_id=ids, text=texts, found=found)

    schema = f"part int, word string, docs bigint, times bigint, after bigint, doc_id {dict(rows.dtypes)['doc_id']}, text string, found string"
    return cut(rows.mapInPandas(run, schema))


def common_words(scanned: DataFrame, n_docs: int) -> DataFrame:
    """``word``: lower-case words in ``COMMON_SHARE`` of all documents or more that seldom follow a given name or initial.

    As a document of average length has some hundred different words, at most some hundred / ``COMMON_SHARE`` words
    qualify, at any number of documents. Counts are added up per batch before they are shuffled.
    """
    counts = scanned.where("part = 0").groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("times").alias("times"), F.sum("after").alias("after"))
    least = max(COMMON_LEAST, int(COMMON_SHARE * n_docs))
    return counts.where((F.col("docs") >= least) & (F.col("after") < SURNAME_SHARE * F.col("times"))).select("word")


def feistel(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of ``0 .. size - 1``: a Feistel network over two halves of mixed radix, walked until in range."""
    a = max(2, int(size**0.5))
    b = -(-size // a)
    while True:
        left, right = divmod(value, b)
        for r in range(ROUNDS):
            if r % 2 == 0:
                left = (left + _round(key, tweak, r, right)) % a
            else:
                right = (right + _round(key, tweak, r, left)) % b
        value = left * b + right
        if value < size:
            return value


def _round(key: bytes, tweak: str, r: int, half: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{tweak}|{r}|{half}".encode(), key=key, digest_size=8).digest(), "big")


def _with_digits(text: str, digits: str) -> str:
    new = iter(digits)
    return "".join(next(new) if c.isdecimal() else c for c in text)


def permute_digits(text: str, key: bytes, tweak: str = "") -> str:
    """``text`` with its digits permuted as one number of that many digits; all other characters stay."""
    digits = _digits(text)
    if not digits:
        return text
    new = str(feistel(int(digits), 10 ** len(digits), key, f"{tweak}{len(digits)}")).zfill(len(digits))
    return _with_digits(text, new)


_EPOCH, _DAYS = date(1800, 1, 1), (date(2300, 1, 1) - date(1800, 1, 1)).days


def permute_date(day: date, key: bytes) -> date:
    """Another day of the five centuries from 1800 on that the number format can write."""
    return _EPOCH + timedelta(days=feistel((day - _EPOCH).days % _DAYS, _DAYS, key, "date"))


def permute_written_date(text: str, key: bytes) -> str:
    """A date written day or year first, permuted as a day; order, separators and leading zeros stay."""
    m = regex.fullmatch(DATE, text)
    day = _day(m)
    if day is None:
        return permute_digits(text, key, "date")
    new = permute_date(day, key)
    parts = regex.split(r"(\d+)", text)
    values = (new.year, new.month, new.day) if m["y1"] else (new.day, new.month, new.year)
    for at, v in zip((1, 3, 5), values):
        parts[at] = str(v).zfill(len(parts[at]))
    return "".join(parts)


def permute_pesel(text: str, key: bytes) -> str:
    """A valid number for a valid one: its date and serial number are permuted, the check digit follows; separators stay."""
    digits = _digits(text)
    if not valid_pesel(digits):
        return permute_digits(text, key, "pesel")
    century = (18, 19, 20, 21, 22)[((int(digits[2:4]) - 1) // 20 + 1) % 5]
    day = permute_date(date(century * 100 + int(digits[:2]), (int(digits[2:4]) - 1) % 20 + 1, int(digits[4:6])), key)
    serial = feistel(int(digits[6:10]), 10**4, key, "serial" + digits[:6])
    month = day.month + {18: 80, 19: 0, 20: 20, 21: 40, 22: 60}[day.year // 100]
    body = f"{day.year % 100:02}{month:02}{day.day:02}{serial:04}"
    body += str(-sum(int(d) * w for d, w in zip(body, (1, 3, 7, 9, 1, 3, 7, 9, 1, 3))) % 10)
    return _with_digits(text, body)


def placeholder(kind: str, value: str, key: bytes) -> str:
    """``[KIND pseudonym]``: numbers keep their format, everything else becomes a short keyed code; equal values (letter case,
    accents, spacing and separators aside) get equal pseudonyms."""
    if kind == "id_number":
        digits = _digits(value)
        if len(digits) == 11:
            return f"[ID_NUMBER {permute_pesel(digits, key)}]"
        letters, number = "".join(filter(str.isalpha, value)).upper(), digits
        base = feistel(sum((ord(c) - 65) % 26 * 26**i for i, c in enumerate(letters)), 26 ** len(letters), key, "series")
        series = "".join(chr(65 + base // 26**i % 26) for i in range(len(letters)))
        return f"[ID_NUMBER {series}{permute_digits(number, key, 'card')}]"
    if kind == "phone":
        digits = _digits(value)
        digits = _PREFIX.sub("", digits)
        return f"[PHONE {permute_digits(digits, key, 'phone')}]"
    if kind == "date":
        return f"[DATE {permute_written_date(value, key)}]"
    code = hashlib.blake2b(f"{kind}|{plain(value) or value}".encode("utf-8", "surrogatepass"), key=key, digest_size=4).hexdigest()
    return f"[{kind.upper()} {code}]"


#: What a session may set as the key of the pseudonyms; without it each run draws its own.
KEY_SETTING = "spark.kartoteka.pseudonymKey"


def session_key(spark: SparkSession) -> str:
    """The key that the session sets, else a new one: pseudonyms then link the documents of one run only."""
    return spark.conf.get(KEY_SETTING, None) or secrets.token_hex(32)


def _read(df: DataFrame, id_col: str, text: str, key: str, persons: DataFrame | None, keep: bool):
    """The scanned texts, and a function from what was found in one to its mentions ``(kind, start, end, pseudonym)``."""
    if not key:
        raise ValueError("pseudonyms need a secret key")
    others: tuple[str, ...] = ()
    if persons is not None:
        known, spelled = learn(persons, "surname", "given_names")
        others = tuple(sorted(spelled[f].capitalize() for f in known.forms if f in spelled and f not in seed().forms))
    secret = hashlib.blake2b(key.encode(), digest_size=32).digest()
    scanned = scan_texts(df, id_col, text, GivenForms(others), keep)
    common = df.sparkSession.sparkContext.broadcast(frozenset(r[0] for r in common_words(scanned, df.count()).collect()))

    def settled(found: str | None) -> list[tuple[str, int, int, str]]:
        if not found:
            return []
        return [(kind, start, end, placeholder(kind, value, secret)) for kind, start, end, value in settle(*json.loads(found), common.value)]

    return scanned.where("part = 1").select("doc_id", "text", "found"), settled


def pseudonymise(df: DataFrame, id_col: str, text: str, key: str, persons: DataFrame | None = None) -> DataFrame:
    """``doc_id, kind, start_pos, end_pos, pseudonym`` of every mention in whole texts, positions in code points.

    E-mail addresses also with a written at sign or dot; identity numbers by format, check digit and the words before; phone
    numbers by format, and short ones after a word for telephone; streets with a house number; full dates after a word for
    birth; a given name or initial beside a surname. Texts are read once: that gives the hits, the tokens that names can be
    made of, and the counts of all words. With the list of common words, which are no surnames (bounded, see
    :func:`common_words`, and broadcast), the names are then settled from the tokens alone. ``persons`` (``surname,
    given_names``) adds given names that the list lacks.

    The pseudonym depends on the value and the secret ``key`` alone, so equal values stay linked across documents: numbers
    and dates are keyed permutations (Feistel) within their format, all else a keyed code. Null and empty texts have no
    mention; repeated ids count as own texts.
    """
    rows, settled = _read(df, id_col, text, key, persons, keep=False)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = [(d, *m) for d, f in zip(batch["doc_id"].tolist(), batch["found"]) for m in settled(f)]
            yield pd.DataFrame(out, columns=["doc_id", "kind", "start_pos", "end_pos", "pseudonym"])

    return rows.select("doc_id", "found").mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, kind string, start_pos bigint, end_pos bigint, pseudonym string")


def redact(df: DataFrame, id_col: str, text: str, key: str, persons: DataFrame | None = None) -> DataFrame:
    """``doc_id, text``: the text with each mention of :func:`pseudonymise` replaced by its pseudonym; null and empty texts stay as
    they are. The texts are written once with what was found in them, so they are neither read twice nor shuffled."""
    rows, settled = _read(df, id_col, text, key, persons, keep=True)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            texts = []
            for value, found in zip(batch["text"], batch["found"]):
                out, at = [], 0
                for _, start, end, pseudonym in settled(found):
                    out += [value[at:start], pseudonym]
                    at = end
                texts.append("".join(out) + value[at:] if out else value)
            yield pd.DataFrame({"doc_id": batch["doc_id"], "text": pd.Series(texts, dtype=object, index=batch.index)})

    return rows.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text string")
