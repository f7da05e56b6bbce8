"""Scalar functions against golden values."""

import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kinmark.functions import dates, humanname, identifiers, normalize, similarity

DOE = "  Doe, Jané O'Brien-Smith, 1900-1950. "


@pytest.mark.parametrize(
    ("f", "text", "want"),
    [
        (normalize.name_key, DOE, "doe jane o brien-smith 1900-1950"),
        (normalize.letters_key, DOE, "doe, jane o brien smith,"),
        (normalize.entry_key, "Doe, Jané [O'Brien]-Smith. (1900)", "doe jané obrien smith 1900"),
        (normalize.normalize, "A.B, C", "ab c"),
        (normalize.strip_corporate_abbreviations, "acme widget co", "acme widget"),
        (normalize.strip_controls, "a\x00b\x85c", "abc"),
        (normalize.compress_spaces, " a   b\t", "a b"),
        (normalize.strip_accents, "Ÿé́øß", "Yeøß"),
        (normalize.name_key, "", ""),
        (normalize.name_key, None, None),
        (dates.pad_date, "65", "0065"),
        (dates.pad_date, "-5-3", "-0005-03"),
        (dates.pad_date, "1900-1-0", "1900-01"),
        (dates.pad_date, "1900-00-00", "1900-00"),
        (dates.pad_date, "", ""),
        (identifiers.capitalize, "corporateBody", "Corporatebody"),
        (identifiers.worldcat_id, "n 50034079", "lccn-n50034079"),
        (identifiers.lc_id, "n 50034079", "n50034079"),
        (identifiers.full_ark, "00000/x1", "ark:/00000/x1"),
        (identifiers.ark_file_name, "ark:/00000/x1", "00000-x1.xml"),
        (identifiers.file_name_ark, "00000-x1.xml", "ark:/00000/x1"),
        (identifiers.quote_path, "a b/ç", "a%20b/%C3%A7"),
    ],
)
def test_text(one, f, text, want):
    assert one(lambda c: f(c.cast("string")), text) == want


def test_digits(one):
    assert one(normalize.has_digits, "a12", n=2) and not one(normalize.has_digits, "a1b2", n=2)
    assert one(normalize.digit_runs, "a1b22") == ["1", "22"]
    assert one(normalize.strip_date_words, "doe d 1900 circa") == "doe 1900"


@pytest.mark.parametrize(("text", "end", "want"), [("1900", False, (1900, 1, 1)), ("1900", True, (1900, 12, 31)), ("1920-02", True, (1920, 2, 29)), ("1920-2-3", True, (1920, 2, 3)), ("0", False, None), ("", False, None), ("1921-02-30", False, None), ("x", False, None)])
def test_parse_date(one, text, end, want):
    assert one(dates.parse_date, text, end=end) == (want and datetime.date(*want))


@pytest.mark.parametrize(("rec", "kind", "auth", "born", "want"), [("1900-01-01", "#Birth", "1900-05-01", True, 3), ("1900-01-01", "#Birth", "1905-01-01", True, 2), ("1900-01-01", "#Birth", "1910-01-01", True, 0), ("1900-01-01", "#Active", "1850-01-01", True, 1), ("1900-01-01", "#Active", "1950-01-01", True, 0), ("1900-01-01", None, "1900-01-01", True, -1), ("1900-01-01", "#Death", "1900-01-01", False, 3), (None, "#Birth", "1900-01-01", True, -1)])
def test_quality(one, rec, kind, auth, born, want):
    f = lambda r, k, a: dates.quality(r.cast("date"), k.cast("string"), a.cast("date"), born)
    assert one(f, rec, kind, auth) == want


@pytest.mark.parametrize(("a", "b", "want"), [("martha", "marhta", 0.944444), ("дима", "дама", 0.916667), ("acme widget", "acme widgets", 0.972222), ("dwayne", "duane", 0.822222), ("", "", 0), ("a", "", 0)])
def test_jaro(one, a, b, want):
    assert one(lambda x, y: F.round(similarity.jaro(x, y), 6), a, b) == want


@given(st.text(max_size=12), st.text(max_size=12))
@settings(max_examples=60, deadline=None)
def test_jaro_is_symmetric(a, b):
    x = similarity.jaro_bytes(a.encode(), b.encode())
    assert 0 <= x <= 1 and abs(x - similarity.jaro_bytes(b.encode(), a.encode())) < 1e-9


def test_lengths_and_trigrams(one):
    assert round(one(similarity.relative_length, "abcd", "ab"), 6) == 0.333333
    assert one(similarity.relative_length, "", "") is None
    assert round(one(lambda a, b: similarity.trigram_similarity(similarity.trigrams(a), similarity.trigrams(b)), "word one", "two words"), 6) == round(4 / 15, 6)


@pytest.mark.parametrize(
    ("x", "y", "want"),
    [
        ("Doe, Jane Quincy", "Doe, Jane Quincy", 1),
        ("Doe, Jane Q.", "Doe, Jane Quincy", 0.99),
        ("Doe, Jane", "Doe, Jane", 0.89999),
        ("Doe, Jane Quincy", "Doe, Jane Rose", 0),
        ("Doe, Jane Q.", "Doe, Jane Rose", 0),
        ("Smith, Jane Q", "Doe, Jane Q", 0),
        ("Plato", "Plato", 1),
        ("Doe, J. Quincy", "Doe, Jane Quincy", 1),
        ("Jane Quincy Doe", "Doe, Jane Quincy (1900-1950)", 1),
    ],
)
def test_name_quality(x, y, want):
    assert humanname.match_quality(x, y) == pytest.approx(want)


def test_assembled_names(spark):
    rows = spark.createDataFrame([("400", "MARC21", [("a", "Doe"), ("d", "1900"), ("c", "Sir")]), ("410", "MARC21", [("a", "Doe")]), ("400", "UNIMARC", [("a", "x"), ("a", "y"), ("b", "z")])], "tag string, dtype string, s array<struct<code:string,value:string>>")
    got = [r[0] for r in rows.select(identifiers.assembled_name("person", F.col("dtype"), F.col("tag"), F.col("s"))).collect()]
    assert got == ["Doe Sir 1900", "", "y z"]


def test_escapes_and_addresses(spark, one):
    assert one(identifiers.escape_attribute, 'a&<"\n') == "a&amp;&lt;&quot;&#xA;"
    assert one(identifiers.query_map, "http://h.example/p?a=1&b=2") == {"a": "1", "b": "2"}
    assert one(identifiers.is_country_code, "US") and not one(identifiers.is_country_code, "Us")
    row = spark.sql("select 'http://h.example/p?x=1#f' u").select(*identifiers.uri_parts(F.col("u"))).first()
    assert tuple(row) == ("http", "h.example", "/p", "x=1", "f")


def test_namespaces(one):
    text = "<p:a xmlns:p=\"u\" xmlns='v' p:x=\"1\" y='a:b'><p:b>t:u</p:b></p:a>"
    assert one(identifiers.strip_namespaces, text) == "<a x=\"1\" y='a:b'><b>t:u</b></a>"


@pytest.mark.parametrize(("old", "old_type", "new", "new_type", "born", "want"), [("1900", "#Active", "1900", "#Birth", True, True), ("1900", "#Birth", "1900-01-01", "#Birth", True, True), ("1900-01-01", "#Birth", "1900", "#Birth", True, False), ("1950", "#Active", "1950", "#Death", False, True), (None, None, "1900", "#Birth", True, False)])
def test_better_existence(one, old, old_type, new, new_type, born, want):
    f = lambda *c: dates.better_existence(*[x.cast("string") for x in c], born=born)
    assert one(f, old, old_type, new, new_type) == want


@pytest.mark.parametrize(
    ("heading", "name", "want"),
    [
        ("D, Jane", "Doe, Jane", None),
        ("Doe, Jane", "D, Jane", 0.0),
        ("Smith, Mrs Jane Anna", "Smith, Mrs Jane Anna", 0.89999),
        ("Smith, MRS Jane Anna", "Smith, Jane Anna", None),
        ("Smith, Jane Anna", "Smith, mrs Jane Anna", None),
        ("Smith, Jane Anna", "Smith, Jane Anna", 1.0),
        ("Doe, Jane Q", "Doe, Jane Quincy", 0.99),
        ("Doe, J Quincy", "Doe, Jane Quincy", 1.0),
        ("Plato", "Plato", 1.0),
        ("", "", None),
    ],
)
def test_names_by_parts(heading, name, want):
    from kinmark.functions.humanname import MAYBE, cleaned, match_quality
    from kinmark.functions.similarity import jaro_bytes

    whole = jaro_bytes(cleaned(heading).encode(), cleaned(name).encode())
    assert match_quality(heading, name) == (want if want is not None else MAYBE if whole >= 0.9 else whole)


def test_names_decided_by_parts_need_no_similarity(monkeypatch):
    def refused(*_):
        raise AssertionError("compared letter by letter")

    monkeypatch.setattr(humanname, "jaro_bytes", refused)
    assert [humanname.match_quality("Doe, Jane Quincy", y) for y in ("Roe, Jane Quincy", "Doe, Jane Q.", "Doe, Jane Quincy")] == [0.0, 0.99, 1.0]


def test_jaro_by_its_definition():
    def plain(a, b):
        reach, met = max(0, max(len(a), len(b)) // 2 - 1), {}
        for i, c in enumerate(a):
            j = next((j for j in range(len(b)) if abs(i - j) <= reach and j not in met and b[j] == c), None)
            met |= {} if j is None else {j: c}
        m, swapped = len(met), sum(c != b[j] for c, j in zip(met.values(), sorted(met), strict=True)) // 2
        return m and (m / len(a) + m / len(b) + (m - swapped) / m) / 3

    for a, b in ((b"martha", b"marhta"), (b"dixon", b"dickson"), ("Jané".encode(), "Janö É".encode()), (b"aab\x00\xff", b"b\xffa\x00a"), (b"ab", b"xy"), (bytes(range(256)), bytes(range(256))[::-1])):
        assert similarity.jaro_bytes(a, b) == pytest.approx(plain(a, b))
