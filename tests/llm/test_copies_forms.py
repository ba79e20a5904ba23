import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from kartoteka import cluster
from kartoteka.llm import p1_copies as p1
from kartoteka.llm import p4_forms as p4

KIND = "id bigint, person_id bigint, event_type string, event_date string, location string, detail string, n_copies string, _k int"
FIELDS = ("event_date", "location", "detail")


def copies(df):
    return p1.find_copies(df, "id", ("person_id", "event_type"), FIELDS, dates=("event_date",))


def brute(data):
    def words(s):
        return tuple(sorted(re.sub(r"^0+(?=\d)", "", w) for w in re.findall(r"[^\W_]+", (s or "").lower())))

    def date(s):
        s = s or ""
        if m := re.fullmatch(r"\W*(\d\d?)\W+(\d\d?)\W+(\d{4})\W*", s):
            return tuple(int(m[i]) for i in (3, 2, 1))
        if m := re.fullmatch(r"\W*(\d{4})\W+(\d\d?)\W+(\d\d?)\W*", s):
            return tuple(int(m[i]) for i in (1, 2, 3))
        return words(s)

    sets = defaultdict(list)
    for r in data:
        if r[0] is not None:
            sets[(r[1], r[2], date(r[3]), words(r[4]), words(r[5]))].append(r[0])
    return sorted((min(v), i, len(v)) for v in sets.values() if len(v) > 1 for i in v)


CASES = [
    (1, 1, "birth", "03.04.1890", "Łódź, ul. Polna 5", None),
    (2, 1, "birth", "1890-04-03", "UL. POLNA 5 ; łódź", "-"),
    (3, 1, "birth", "3/4/1890", "ul.Polna 5 Łódź", " "),
    (4, 1, "birth", "1890-03-04", "Łódź, ul. Polna 5", None),  # day and month change places: another fact
    (5, 1, "birth", "03.04.1890", "Lodz, ul. Polna 5", None),  # accents count
    (6, 1, "birth", "03.04.1890", "Łódź, Łódź, ul. Polna 5", None),  # repeated words count
    (7, None, None, None, None, None), (8, None, None, "—", "", "?!"), (9, 2, None, None, None, None),
    (10, 1, "birth", "1890", "x" * 20_000 + " y", None), (11, 1, "birth", "(1890)", "Y " + "X" * 20_000, None),
    (None, 1, "birth", "1890", None, None), (12, 1, "birth", "ok. 1890 r.", None, None), (13, 1, "birth", "r 1890 ok", None, None),
    (14, 3, "death", "1900", "a b", "c"), (14, 3, "death", "1900", "b a", "c"),
]


def test_cases(spark, rows):
    data = [(*c, "own", 1) for c in CASES]
    assert rows(copies(spark.createDataFrame(data, KIND))) == sorted(brute(CASES), key=str)
    assert (1, 3, 3) in brute(CASES) and (7, 8, 2) in brute(CASES)


def test_random_like_brute_force(spark, rows):
    random.seed(5)
    data = []
    for i in range(600):
        d = random.choice(["1.2.1900", "01.02.1900", "1900-02-01", "1900-01-02", None, "-", "1900"])
        place = random.choice(["a b", "B, A", "b  a", "ab", "a", "", None, "ą b", "a b b"])
        data.append((i, random.randrange(4), random.choice("xy"), d, place, random.choice(["k", "K.", None])))
    assert rows(copies(spark.createDataFrame([(*d, None, None) for d in data], KIND))) == sorted(brute(data), key=str)


def test_hot_class_is_joined_by_broadcast(spark, rows, monkeypatch):
    monkeypatch.setattr(cluster, "HOT_ROWS", 50)
    monkeypatch.setattr(cluster, "HOT_KEYS", 5)
    data = [(i, 1, "x", "1900", "a", None) for i in range(300)] + [(i, i, "x", "1900", "a", None) for i in range(300, 700)] + [(900, 300, "x", "1900", "A", None)]
    assert rows(copies(spark.createDataFrame([(*d, None, None) for d in data], KIND))) == sorted(brute(data), key=str)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], KIND)
    assert copies(empty).count() == 0 and p1.collapse(copies(empty)).count() == 0


@pytest.mark.parametrize(
    "value, looks",
    [
        ("Ｋowalski", "Kowalski"), ("Ko​walski", "Kowalski"), ("Kowal­ski", "Kowalski"), (" Kowalski", " Kowalski"), ("Kоwalski", "Kowalski"),
        ("Gl̸upek", "Głupek"), ("Świt", "Świt"), ("Nowak‑Lis", "Nowak-Lis"), ("ɡaj", "gaj"), ("κot", "kot"), ("Kowal\tski", "Kowal ski"), ("gόra", "góra"), ("Lis﻿owska", "Lisowska"),
    ],
)
def test_irregular(value, looks):
    assert p4.surface(value) == looks and p4.is_irregular(value)
    assert p4.canonical(value) == p4.canonical(looks)
    assert not p4.is_irregular(looks)


@pytest.mark.parametrize("value", ["Łódź", " Kowalski  Nowak ", "KOWALSKI", "Новак", "Йосиф", "Müller", "O'Brien", "", "Νικος", None])
def test_regular(value):
    assert not p4.is_irregular(value)


def test_fold():
    assert p4.canonical("Straße") == p4.canonical("STRASSE") and p4.canonical(None) is None and p4.canonical("") == ""


def test_forms_in_tables(spark, rows):
    data = [(1, "Kоwalski", None, "own"), (2, None, "Ｎowak", None), (3, "", "x" * 50_000 + "​", None), (4, "Kowalski", "kowalski", None), (1, "Kоwalski", None, "again")]
    df = spark.createDataFrame(data, "id bigint, surname string, surname_normalized string, field string")
    assert rows(p4.irregular_values(df, "id", ("surname", "surname_normalized"))) == [(1, "surname"), (2, "surname_normalized"), (3, "surname_normalized")]
    out = p4.canonicalise(df, ("surname",))
    assert rows(out, "id", "surname_canonical") == sorted([(1, "kowalski"), (1, "kowalski"), (2, None), (3, ""), (4, "kowalski")], key=str)
    assert p4.irregular_values(df.limit(0), "id", ("surname",)).count() == 0
    assert out.where(F.col("surname_canonical") == "kowalski").count() == 3
