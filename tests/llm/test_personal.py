import random
from datetime import date

import pytest

from kartoteka.llm import p9_personal as p9

COMMON = frozenset("proszę o na adres zam wdowa tel wniosek dom handlowy i synowie firma nadawca poleca katalog nr kuzynka ma od poz pesel legitymuję dokumentem sygn według w parafii miejscowości akt dotyczy oraz".split())


def found(text):
    return [(k, text[s:e]) for k, s, e in p9.mentions(text, COMMON)]


@pytest.mark.parametrize(
    "text, mentions",
    [
        ("Proszę o adres jan.k+x@poczta.example lub 373.586.098", [("email", "jan.k+x@poczta.example"), ("phone", "373.586.098")]),
        ("pisz: ewa [małpa] listy(kropka)example", [("email", "ewa [małpa] listy(kropka)example")]), ("ewa(at)example.org", [("email", "ewa(at)example.org")]),
        ("@admin, poz. 601-60-697, katalog nr 262-989-227", []), ("tel. 2-93-70", [("phone", "2-93-70")]), ("Fernruf 256.", [("phone", "256")]),
        ("pod tym numerem +48 21 382 55 27 nikt", [("phone", "+48 21 382 55 27")]), ("tel. (92)0936204", [("phone", "(92)0936204")]), ("tel. 0-38/366-3062", [("phone", "0-38/366-3062")]),
        ("PESEL: 379014-67388", [("id_number", "379014-67388")]), ("numer kopii cyfrowej 55588605531", []), ("dokumentem ZZX-089606 i ZX 760 3820", [("id_number", "ZZX-089606"), ("id_number", "ZX 760 3820")]),
        ("ISBN 978-00-7424-774-2, sygn. 79/2882/0/2.3/111", []),
        ("zam. ul.Wodna 176/33 m. 5, os. Browarna 96", [("address", "ul.Wodna 176/33 m. 5"), ("address", "os. Browarna 96")]), ("ul. Piotra Grypękężuka 65/31", [("address", "ul. Piotra Grypękężuka 65/31")]),
        ("Das Haus Kirchstr. 8 und Lindenstraße 53", [("address", "Kirchstr. 8"), ("address", "Lindenstraße 53")]), ("lived at 168 Orchard Lane until", [("address", "168 Orchard Lane")]),
        ("na placu Rybnym, jarmarki 396 razy", []), ("Na ulicy Młyńskiej zapadł się", []),
        ("Akt dotyczy Ewy Mepęskełczyk oraz Grapąskewskiego Adama", [("name", "Ewy Mepęskełczyk"), ("name", "Grapąskewskiego Adama")]), ("Bekrowski, Jan, wdowa", [("name", "Bekrowski, Jan")]),
        ("J. K. Kwymokluwicka", [("name", "J. K. Kwymokluwicka")]), ("anna zdegółulkuk, wdowa", [("name", "anna zdegółulkuk")]), ("Kuzynka Katarzyna Brubópludło ma", [("name", "Katarzyna Brubópludło")]),
        ("Kuzynka KRYGENOWSKA Katarzyna ma", [("name", "KRYGENOWSKA Katarzyna")]), ("Weronika\nTrosąpyrowicz", [("name", "Weronika\nTrosąpyrowicz")]), ("Weronika\n\nTrosąpyrowicz", []),
        ("Dom handlowy Dybrużenczyk i Synowie", []), ("w parafii św. Anny w miejscowości Tyniglin", []), ("Anno Domini 1864 die 5 mensis", []), ("Jan", []), ("Bekrowski", []), ("", []),
    ],
)
def test_mentions(text, mentions):
    assert found(text) == mentions


def test_positions_are_code_points():
    text = "🙂🙂 tel. 2-93-70"
    assert p9.mentions(text, COMMON) == [("phone", 8, 15)]


def test_feistel_is_a_permutation():
    for size in (1, 2, 7, 100, 1000):
        assert sorted(p9.feistel(i, size, b"k", "t") for i in range(size)) == list(range(size))
    days = {p9.permute_date(date(1900, 1, 1 + i), b"k") for i in range(31)}
    assert len(days) == 31


def test_pseudonyms_keep_the_format_and_link():
    random.seed(1)
    numbers = []
    while len(numbers) < 40:
        body = f"{random.randrange(100):02}{random.choice([1, 12, 21, 32, 81, 92]):02}{random.randrange(1, 28):02}{random.randrange(10_000):04}"
        n = body + str(-sum(int(d) * w for d, w in zip(body, (1, 3, 7, 9, 1, 3, 7, 9, 1, 3))) % 10)
        if p9.valid_pesel(n):
            numbers.append(n)
    new = [p9.permute_pesel(n, b"k") for n in numbers]
    assert all(map(p9.valid_pesel, new)) and len(set(new)) == len(set(numbers)) and new != numbers
    key = b"secret"
    assert p9.placeholder("phone", "+48 21 382 55 27", key) == p9.placeholder("phone", "213825527", key) != p9.placeholder("phone", "213825528", key)
    assert p9.placeholder("id_number", "ZZX-089606", key) == p9.placeholder("id_number", "ZZX 089 606", key)
    assert p9.placeholder("name", "JAN ŻAK", key) == p9.placeholder("name", "Jan Zak", key)
    assert p9.permute_digits("12-34", key) != "12-34" and len(p9.permute_digits("12-34", key)) == 5


def test_tables(spark, rows):
    data = [(1, "tel. 2-93-70", "own"), (2, None, ""), (3, "", ""), (4, "Jan Kwymokluwicki " + "x " * 30_000 + "tel. 5-55-55", ""), (1, "tel. 2-93-70", "")]
    df = spark.createDataFrame(data, "doc_id bigint, text string, kind string")
    got = p9.pseudonymise(df, "doc_id", "text", "secret")
    assert rows(got.select("doc_id", "kind", "start_pos").distinct()) == [(1, "phone", 5), (4, "name", 0), (4, "phone", 60_023)]
    texts = {r.doc_id: r.text for r in p9.redact(df, "doc_id", "text", "secret").collect()}
    assert texts[2] is None and texts[3] == "" and texts[1].startswith("tel. [PHONE ") and texts[4].startswith("[NAME ")
    assert p9.pseudonymise(df.limit(0), "doc_id", "text", "secret").count() == 0 and p9.redact(df.limit(0), "doc_id", "text", "secret").count() == 0
    with pytest.raises(ValueError):
        p9.redact(df, "doc_id", "text", "")


def test_mentions_and_redaction_agree_and_persons_add_names(spark):
    df = spark.createDataFrame([(2**53 + 1, "Świadkiem był Zbylut Kwymokluwicki, ur. 3.04.1890, tel. 2-93-70."), (7, "Kwymokluwicki, Zbylut, *1890-04-03")], "doc_id bigint, text string")
    persons = spark.createDataFrame([(i, f"Kowal{chr(97 + i)}", '["Zbylut"]') for i in range(9)], "id int, surname string, given_names string")
    assert not {r.kind for r in p9.pseudonymise(df, "doc_id", "text", "k").collect()} & {"name"}
    found = p9.pseudonymise(df, "doc_id", "text", "k", persons).collect()
    assert {(r.doc_id, r.kind, r.start_pos) for r in found} == {(2**53 + 1, "name", 14), (2**53 + 1, "date", 40), (2**53 + 1, "phone", 56), (7, "name", 0), (7, "date", 24)}
    texts = {r.doc_id: r.text for r in p9.redact(df, "doc_id", "text", "k", persons).collect()}
    by = {(r.doc_id, r.kind): r.pseudonym for r in found}
    assert texts[2**53 + 1] == f"Świadkiem był {by[2**53 + 1, 'name']}, ur. {by[2**53 + 1, 'date']}, tel. {by[2**53 + 1, 'phone']}."
    first, second = by[2**53 + 1, "date"][6:-1].split("."), by[7, "date"][6:-1].split("-")
    assert [int(x) for x in first] == [int(x) for x in reversed(second)] and p9.permute_written_date("3.04.1890", b"k") != "3.04.1890"


def test_frequent_surnames_are_no_common_words(spark):
    data = [(i, f"Jan Bekrowski zapłacił {i}. Nadawca: Jan Bekrowski") for i in range(40)]
    scanned = p9.scan_texts(spark.createDataFrame(data, "d int, t string"), "d", "t", p9.GivenForms())
    common = {r.word for r in p9.common_words(scanned, 40).collect()}
    assert {"zapłacił", "nadawca"} <= common and "bekrowski" not in common
