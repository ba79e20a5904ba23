import os
import random
from datetime import datetime

import pytest

from kartoteka.llm import given_names as g
from kartoteka.llm import learned_names
from kartoteka.llm import p3_names as p3
from kartoteka.llm import p5_best as p5

KIND = "id bigint, surname string, given_names string, node string, skey int"


@pytest.mark.parametrize(
    "token, names",
    [("Zosia", ("zofia",)), ("FELIX", ("feliks",)), ("Болеслав", ("boleslaw",)), ("Kazmierz", ("kazimierz",)), ("Adalbert", ("wojciech",)), ("Stanislawa", ("stanislawa",)), ("Kowalski", ()), ("", ())],
)
def test_names_of(token, names):
    assert g.seed().of(token) == names


def link(spark, people, groups=None):
    df = spark.createDataFrame([(i, s, n, "own", 1) for i, s, n in people], KIND)
    gdf = spark.createDataFrame(groups, "group_id bigint, person_id bigint") if groups else None
    return {r.id: r.class_id for r in p3.link(df, "id", "surname", "given_names", gdf).collect()}


def test_variants(spark):
    people = [
        (1, "Krustegąguk", '["Kazimierz", "Ernest"]'), (2, "KRUSTEGAGUK", '["Kazio"]'), (3, "Krustegąguk", '["K.", "E."]'), (4, "Krusteggąuk", "Kazimierz"), (5, "Kazimierz", '["Krustegąguk"]'),
        (6, "Krustegąguk Kazimierz", "[]"), (7, "Krusteg.", '["Kazimierz"]'), (8, "Krustegąguk", '["Helena"]'), (9, "Krustegąguk", '["H."]'), (10, "Wołodyjowski", '["Kazimierz"]'),
        (11, None, None), (12, "", "[]"), (13, "Хобрызенмба", '["Анна"]'), (14, "Hobryzenmba", '["Anna"]'), (15, "Nowak-Lisowska", '["Anna"]'), (16, "Lisowska-Nowak", '["Ania"]'),
        (17, "Kоwalewska", '["Ewa"]'), (18, "Kowalewska", '["Ewa", "nieczyt."]'), (19, "x" * 3000, '["Ewa"]'), (1, "Krustegąguk", '["Kazimierz", "Ernest"]'), (20, "Nowa", '["Ewa"]'), (21, "Nova", '["Ewa"]'), (22, "Nora", '["Ewa"]'),
    ]
    got = link(spark, people)
    classes = {}
    for k, v in got.items():
        classes.setdefault(v, set()).add(k)
    assert classes[1] == {1, 2, 3, 4, 5, 6, 7}
    assert classes[8] == {8, 9} and classes[10] == {10} and classes[11] == {11} and classes[12] == {12}
    assert classes[13] == {13, 14} and classes[15] == {15, 16} and classes[17] == {17, 18} and classes[19] == {19}
    assert classes[20] == {20, 21} and classes[22] == {22}


def test_initials_that_fit_two_people_join_neither(spark):
    got = link(spark, [(1, "Głyskomolowska", '["Helena"]'), (2, "Głyskomolowska", '["Honorata"]'), (3, "Głyskomolowska", '["H."]')])
    assert len(set(got.values())) == 3


def test_confirmed_groups_and_pairs(spark, rows):
    df = spark.createDataFrame([(1, "Abacki", '["Jan"]', "", 1), (2, "Babacki", '["Piotr"]', "", 1), (3, "Cabacki", '["Ewa"]', "", 1)], KIND)
    classes = p3.link(df, "id", "surname", "given_names", spark.createDataFrame([(7, 1), (7, 3), (7, 99), (None, 2)], "group_id bigint, person_id bigint"))
    assert rows(p3.pairs(classes)) == [(1, 3)]


def test_empty(spark):
    assert p3.link(spark.createDataFrame([], KIND), "id", "surname", "given_names").count() == 0


def test_segments_lose_no_pair(spark, rows):
    random.seed(7)

    def lev(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            new = [i]
            for j, y in enumerate(b, 1):
                new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
            row = new
        return row[-1]

    names = sorted({"".join(random.choices("ab", k=random.randrange(3, 13))) for _ in range(160)})
    df = spark.createDataFrame([("g", n, i) for i, n in enumerate(names)], "g string, skey string, node bigint")
    got = {tuple(sorted((r.a, r.b))) for r in p3.similar_keys(df, df, p3.Segments.of(spark, list(range(1, 14)))).collect()}
    want = {(i, j) for i in range(len(names)) for j in range(i + 1, len(names)) if lev(names[i], names[j]) <= p3.edits(min(len(names[i]), len(names[j])))}
    assert got == want


T = datetime(2024, 5, 1)


def tables(spark, persons, groups, events):
    return (
        spark.createDataFrame(groups, "group_id bigint, person_id bigint, field string"),
        spark.createDataFrame(persons, "id bigint, given_names string, updated_at timestamp, created_at timestamp, group_id string"),
        spark.createDataFrame(events, "person_id bigint, confidence double, extraction_method string, source string"),
    )


def test_best(spark, rows):
    persons = [
        (1, '["Adam", "Adam", "ADAM"]', datetime(2099, 12, 31), T, None), (2, '["Adam", "Jan", "b.d."]', datetime(1970, 1, 1), T, None), (3, '["A.", "J.", "P."]', datetime(2024, 6, 1), T, None),
        (4, "Ewa Zofia", datetime(2024, 7, 1), T, None), (5, None, None, T, None), (6, '["Ewa"]', datetime(2024, 7, 1), T, None),
    ]
    groups = [(1, 1, "x"), (1, 2, "x"), (1, 3, "x"), (1, 3, "x"), (2, 4, "x"), (2, 5, "x"), (2, 6, "x"), (2, 77, "x"), (None, 1, "x")]
    events = [(1, 0.9, "manual", "s"), (1, 99.0, "manual", "s"), (2, -1.0, "llm", "s"), (3, 0.95, None, "s"), (4, None, "llm", "s"), (6, 1.7, "llm", "s"), (None, 0.5, "llm", "s")]
    got = rows(p5.best_members(*tables(spark, persons, groups, events)))
    assert got == sorted([(1, "given_names", 2), (1, "updated_at", 3), (1, "confidence", 3), (2, "given_names", 4), (2, "updated_at", 4)], key=str)
    records = {r.group_id: r for r in p5.records(*tables(spark, persons, groups, events)).collect()}
    assert records[1].given_names == ["adam", "jan"] and records[1].confidence == 0.95 and records[2].confidence is None
    assert records[2].given_names == ["ewa", "zofia"]


def test_best_of_nothing(spark):
    assert p5.best_members(*tables(spark, [], [], [])).count() == 0


def test_model_tells_good_from_bad_sources(spark):
    """Two sources: one that names what is true, one that invents; the fitted rates tell them apart."""
    random.seed(3)
    data = []
    for k in range(400):
        for name, true in (("a", True), ("b", True), ("z", False)):
            pos = [sum(random.random() < (0.8 if true else 0.02) for _ in range(4)), sum(random.random() < (0.5 if true else 0.4) for _ in range(2))]
            data.append((k, name, [("good", pos[0], 4 - pos[0]), ("bad", pos[1], 2 - pos[1])]))
    table = spark.createDataFrame(data, "group_id int, name string, evidence array<struct<source:string,pos:bigint,neg:bigint>>")
    rates, truth = p5.fit(table)
    model = {r.source: r for r in rates.collect()}
    assert model["good"].sens > 0.7 and model["good"].fpr < 0.08 and model["bad"].fpr > 0.2 and 0.5 < truth < 0.8
    p = {r.name: r.p for r in p5._judge(table, rates, truth).groupBy("name").agg({"p": "avg"}).withColumnRenamed("avg(p)", "p").collect()}
    assert p["a"] > 0.9 and p["z"] < 0.1


@pytest.mark.parametrize("broadcast", [100_000, 1])
def test_more_sources_than_ever_were_folded(spark, monkeypatch, broadcast):
    """Two hundred sources keep their own rates, joined by broadcast or by shuffle."""
    monkeypatch.setattr(p5, "BROADCAST_SOURCES", broadcast)
    monkeypatch.setattr(p5, "ROUNDS", 3)
    data = [(k, "a", [(f"s{k % 200}", 1 if k % 200 < 100 else 0, 0 if k % 200 < 100 else 1), ("all", 5, 0)]) for k in range(2000)]
    table = spark.createDataFrame(data, "group_id int, name string, evidence array<struct<source:string,pos:bigint,neg:bigint>>")
    sens = {r.source: r.sens for r in p5.fit(table, 3)[0].collect()}
    assert len(sens) == 201 and all((sens[f"s{i}"] > 0.7) == (i < 100) for i in range(200))


def test_forms_that_no_list_has_are_learned(spark):
    """Names of which no list knows any: forms that take one another's place under rare surnames become one, relatives do not."""
    random.seed(5)
    letters = [["".join(random.choices("bcdfgklmnprst", k=n)).capitalize() for n in (9, 6)] for _ in range(25)]
    forms = {"Zbylut": "Zbysz", "Dobrogniewa": "Doba", "Ludomiła": "Miłka"} | dict(letters)
    people = []
    for k in range(900):
        family = "".join(random.choices("bcdfgklmnprst", k=9))
        a, b = random.sample(sorted(forms), 2)
        people += [(family, a), (family, forms[a] if k % 2 else a), (family, b)]
    people += [("Kowalski", x) for x in (*forms, *forms.values()) for _ in range(9)]  # a frequent surname tells nothing
    df = spark.createDataFrame([(i, s, f'["{n}"]') for i, (s, n) in enumerate(people)], "id bigint, surname string, given_names string")
    names, spelled = learned_names.learn(df, "surname", "given_names", g.Names({}))
    assert all(names.of(a) == names.of(b) for a, b in forms.items()) and len({names.of(a) for a in forms}) == len(forms)
    assert spelled["milka"] == "miłka"
    known, _ = learned_names.learn(df, "surname", "given_names")  # beside the list, whose forms keep their names
    assert known.of("Janek") == ("jan",) and known.of("Zbysz") == known.of("Zbylut")


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.1"), reason="needs the test tables")
def test_links_are_found_with_a_fifth_of_the_list_removed(spark):
    random.seed(7)
    gone = frozenset(random.sample(sorted(g.seed().forms), len(g.seed().forms) // 5))
    persons, groups = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("persons", "person_groups"))
    pairs = [{tuple(r) for r in p3.pairs(p3.link(persons, "id", "surname", "given_names", groups, known)).collect()} for known in (None, g.seed(gone))]
    assert len(pairs[0] & pairs[1]) >= 0.9 * len(pairs[0]) and len(pairs[1] - pairs[0]) <= 0.02 * len(pairs[0])


def test_exchanged_letters_in_short_surnames(spark):
    keys = ["nowak", "nowka", "nwoak", "onwak", "noawk", "nokaw", "krol", "korl", "kowalik", "kowlaik", "kowailk", "koawlik"]
    df = spark.createDataFrame([("jan", k, i) for i, k in enumerate(keys)], "g string, skey string, node int")
    found = p3.similar_keys(df, df, p3.Segments.of(spark, sorted(set(map(len, keys)))), swaps=True)
    got = {(r.key_a, r.key_b) for r in found.collect()}
    swaps = {(a, b) for a in keys for b in keys if len(a) >= 5 and any(a[:p] + a[p + 1] + a[p] + a[p + 2 :] == b != a for p in range(len(a) - 1))}
    assert len(swaps) >= 14 and got == swaps


def test_link_of_an_exchange(spark):
    df = spark.createDataFrame([(1, "Nowak", "Jan"), (2, "Nowka", "Jan"), (3, "Nokaw", "Jan")], "id bigint, surname string, given_names string")
    assert {r.id: r.class_id for r in p3.link(df, "id", "surname", "given_names").collect()} == {1: 1, 2: 1, 3: 3}
