import pytest

from kartoteka.llm import p2_scans as p2

BODY = "Należał do ochotniczej straży ogniowej oraz chóru kościelnego."
KIND = "id bigint, raw_text string, kind string, tid int, n string"


def noise(spark, texts):
    many = [(1000 + i, f"KOWALSKI Jan {i}. {BODY} Pochodził z rodziny\nrzemieślniczej osiadłej od kilku pokoleń.", "own", 1, "x") for i in range(40)]
    heads = [(2000 + i, f"tekst {i}\nK S I Ę G A     A D R E S O W A   {300 + i}\ndalej", None, None, None) for i in range(3)]
    df = spark.createDataFrame([(i, t, "own", 1, "x") for i, t in texts.items()] + many + heads, KIND)
    out = {}
    for r in p2.find_noise(df, "id", "raw_text").collect():
        out.setdefault(r.id, set()).add(r.kind)
    repaired = {r.id: r.text for r in p2.repair(df, "id", "raw_text").collect()}
    assert len(repaired) == df.count()
    return out, repaired


@pytest.fixture(scope="module")
def result(spark):
    texts = {
        1: "osiad-\nłej od kilku", 2: "osiad¬\n\nstr. 12\n\nłej od kilku", 3: "ur. 1848-\n06-25 w m.", 4: "Nowak-\nKowalska Anna", 5: "osiad=\nłej", 6: "osiad­\nłej",
        7: "do ochotniezej straży", 8: "do ochotnicze1 straży", 9: "w roku l892 zmarł", 10: "Dnia 3go maja 1892, ul. Polna 118a", 11: "kościelnego i cbóru",
        12: "tekst jeden\nKsięga adresowa\ndwa trzy", 13: "tekst\n— 17 —\ndalej", 14: "tekst\n[420]\ndalej", 15: "pod pozycją\n237.", 16: "tekst\n\n308.\n\nszkoły ludowej",
        17: "ŚWE — ŚŁO\ntekst", 18: "315   ŚWE - ŚŁO", 19: None, 20: "", 21: "x", 22: ("słowo " * 20_000) + "osiad-\nłej", 23: "osiad-\nłej od kilku", 24: "KOWAL-\nSKI Jan",
        25: "tekst\n467\ndalej", 26: "rzemieś1niczej", 27: "rnieszkał sam 1893", 28: "STRAẞE 漢字漢字 𝔘𝔫𝔦 słowo", 29: "Mł|ńska ulica",
    }
    return noise(spark, texts)


@pytest.mark.parametrize(
    "id, kinds",
    [
        (1, {"hyphen"}), (2, {"hyphen", "page_number"}), (3, set()), (4, set()), (5, {"hyphen"}), (6, {"hyphen"}), (7, {"misread"}), (8, {"misread"}), (9, {"misread"}),
        (10, set()), (11, {"misread"}), (12, {"header"}), (13, {"page_number"}), (14, {"page_number"}), (15, set()), (16, {"page_number"}), (17, {"header"}),
        (18, {"header", "page_number"}), (19, set()), (20, set()), (21, set()), (22, {"hyphen"}), (23, {"hyphen"}), (24, {"hyphen"}), (25, {"page_number"}), (26, {"misread"}),
        (2000, {"header", "page_number"}), (1000, set()),
    ],
)
def test_kinds(result, id, kinds):
    assert result[0].get(id, set()) == kinds


def test_repaired(result):
    text = result[1]
    assert text[1] == "osiadłej od kilku" == text[2] == text[23]
    assert text[3] == "ur. 1848-06-25 w m." and text[4] == "Nowak-Kowalska Anna"
    assert text[8] in ("do ochotniczej straży", "do ochotniczel straży")
    assert text[9] == "w roku 1892 zmarł" and text[12] == "tekst jeden dwa trzy" and text[24] == "KOWALSKI Jan"
    assert text[28] == "STRAẞE 漢字漢字 𝔘𝔫𝔦 słowo" and text[29] == "Młłńska ulica" and text[26] == "rzemieślniczej"
    assert text[19] is None and text[20] == "" and text[2000] == "tekst 0 dalej"


def test_anagram_join_corrects_by_one_confusion(spark, rows):
    lex = spark.createDataFrame([("chóru", 100), ("cbóru", 2), ("charu", 1), ("pracował", 200), ("pracovvał", 3), ("novak", 90), ("nowak", 100)], "word string, n bigint")
    assert rows(p2.corrections(lex), "word", "variant") == [("cbóru", "chóru"), ("pracovvał", "pracował")]


def test_words_of_any_length_are_corrected(spark, rows):
    lex = spark.createDataFrame([("x" * 60 + "chór", 100), ("x" * 60 + "cbór", 2)], "word string, n bigint")
    assert rows(p2.corrections(lex), "word", "variant") == [("x" * 60 + "cbór", "x" * 60 + "chór")]


def test_empty(spark):
    empty = spark.createDataFrame([], KIND)
    assert p2.find_noise(empty, "id", "raw_text").count() == 0 and p2.repair(empty, "id", "raw_text").count() == 0
