import hashlib
import json
import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kartoteka.functions import json as J
from kartoteka.functions import text as X


@pytest.mark.parametrize(
    "sample, score",
    [
        ("Pan Jan Kowalski ur w roku 1887 w Warszawie", 0.4),
        ("The quick brown fox jumps over the lazy dog", 0.0),
        ("", 0.0),
        (None, 0.0),
        ("Łódź i Gdańsk: córka Józefa", 1.0),
        ("   ", 0.0),
    ],
)
def test_lang_score(one, sample, score):
    assert one(X.lang_score(F.lit(sample))) == score


def test_lang_score_takes_the_first_500_characters(one):
    assert one(X.lang_score(X.sample_text(F.lit("x" * 500 + "ą" * 500)))) == 0.0


@pytest.mark.parametrize(
    "url, slug",
    [("https://example.com/files/doc.pdf", "doc.pdf"), ("https://example.com", "example.com"), ("https://example.com/a/b/", "b"), ("not a url", "not a url"), (None, None)],
)
def test_url_slug(one, url, slug):
    assert one(X.url_slug(F.lit(url))) == slug


def test_content_id(one):
    assert one(X.content_id(F.lit("abc"))) == hashlib.sha256(b"abc").hexdigest()[:16]


@pytest.mark.parametrize(
    "text, template",
    [("KOWALSKI, Jan, ur. 1892, lekarz, Kraków", "U, Jan, l. Y, l, Kraków"), ("WĘGRZYN, Ewa, ręka w 123 12345 7", "WĘGRZYN, Ewa, ręka w 123 12345 N")],
)
def test_template(one, text, template):
    assert one(X.template(F.lit(text))) == template
    assert one(X.fingerprint(F.lit(text))) == hashlib.sha256(template.encode()).hexdigest()[:16]


@pytest.mark.parametrize(
    "date, iso",
    [("12.03.1892", "1892-03-12"), ("1892-03-12", "1892"), ("ok. 1892 r.", "1892"), ("1.3.1892", "1892"), ("brak", None), ("", None), (None, None), (" 12.03.1892 x", "1892-03-12")],
)
def test_iso_date(one, date, iso):
    assert one(X.iso_date(F.lit(date))) == iso


def test_surname_forms(one):
    assert one(X.plain_surname(F.lit(" Żółć "))) == "zolc"
    assert one(X.fold_marks(F.lit("WIŚNIEWSKI"))) == one(X.fold_marks(F.lit("Wisniewski")))
    assert one(X.fold_marks(F.lit("Łoś"))) == "łos"
    assert one(X.title_case(F.lit(" nowak-kowalska o'brien "))) == "Nowak-Kowalska O'Brien"


def test_lists(one):
    assert one(X.to_list(F.lit("Warszawa, Kraków,, "))) == ["Warszawa", "Kraków"]
    assert one(X.to_list(F.lit(None).cast("string"))) == []
    assert one(X.clean_list(F.array(F.lit(" Gdańsk "), F.lit(""), F.lit(None)))) == ["Gdańsk"]
    assert one(X.split_names(F.lit(" Jan  Józef "))) == ["Jan", "Józef"]
    assert one(X.clean(F.lit("  "))) is None
    assert one(X.strip_fences(F.lit("```regex\nab+\n```"))) == "ab+"
    assert one(X.slice_id(F.lit("d"), F.lit(2), F.lit(7))) == "d_p2_e7"


@pytest.mark.parametrize(
    "raw, found",
    [
        ('{"surname":"Kowalski"}', '{"surname":"Kowalski"}'),
        ('x\n```json\n{"surname":"Nowak"}\n```\ny', '{"surname":"Nowak"}'),
        ('Sure: {"surname":"Wi"} ok', '{"surname":"Wi"}'),
        ("nope", None), ("[1]", None), (None, None), ("", None), ("{broken", None),
    ],
)
def test_recover_object(one, raw, found):
    assert one(J.recover_object(F.lit(raw))) == found


def test_extracted_fields_have_lists(one):
    got = one(J.extracted_fields(F.lit('{"surname":"A","given_names":[" B ",""],"roles":null}')))
    assert (got.surname, got.given_names, got.locations, got.roles, got.birth_date) == ("A", ["B"], [], [], None)
    assert one(J.extracted_fields(F.lit("nope"))) is None


def test_cdx_record(one):
    got = one(J.cdx_record(F.lit('{"url":"https://example.com/doc.pdf","offset":"5","length":100}')))
    assert (got.url, got.offset, got.length, got.warc_filename) == ("https://example.com/doc.pdf", 5, 100, "")
    assert one(J.cdx_record(F.lit("{bad"))) is None


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("aąbŁ 1.XYZ\n19", max_size=25), min_size=1, max_size=20))
def test_template_like_python(spark, texts):
    def model(t):
        for pattern, letter in X.TEMPLATE:
            t = re.sub(rf"\b{pattern}\b", letter, t)
        return t

    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", X.template(F.col("t")).alias("v"))
    assert {r.i: r.v for r in df.collect()} == {i: model(t) for i, t in enumerate(texts)}
    assert json.dumps(texts)
