import hashlib
import re
from datetime import date

import pytest
from pyspark.sql import functions as F

from papersieve.functions import dates as D
from papersieve.functions import identifiers as I
from papersieve.functions import text as X


def test_normalize_doi(apply):
    given = [" https://doi.org/10.1021/ABC.1 ", "DOI: 10.1021/x", "doi:https://doi.org/10.1021/q", None, " 10.1/x\t"]
    assert apply(I.normalize_doi, given) == ["10.1021/abc.1", "10.1021/x", "https://doi.org/10.1021/q", "", "10.1/x"]


def test_normalize_doi_is_stable(apply):
    once = apply(I.normalize_doi, ["HTTP://DX.DOI.ORG/10.5/A b", "doi:10.1234/XyZ"])
    assert apply(I.normalize_doi, once) == once


def test_valid_doi(apply):
    assert apply(I.is_valid_doi, ["10.1/abcdef", "10.1021/", "10.1021/a", "10.1021/a b", None]) == [
        False, False, True, False, False,
    ]


def test_normalize_title(apply):
    given = ["α-Amino_Acid: (3rd)", "  ", None, "x² – y", "title TWO, here!"]
    assert apply(X.normalize_title, given) == ["α amino_acid 3rd", "", "", "x² y", "title two here"]


def test_normalize_pub_date(apply):
    given = ["2024-Mar-05", "2024-3-5", "2024-13", "2024-Spring", "In Press", "", "1999 2024-05",
             "2024x 1999-03 2024-05", "Sep 2020", "2021/7"]
    assert apply(D.normalize_pub_date, given) == [
        "2024-03", "2024-03", "2024-13", "2024", "in press", "", "1999", "2024-05", "2020-09", "2021-07",
    ]


def test_sanitize(apply):
    assert apply(X.sanitize, ["a\r\nb\rc", "NaN", None, "nan."]) == ["a\nb c", "", "", "nan."]


def test_years(apply):
    assert apply(D.parse_year, ["2024-05", "20.5", "12d", "nan", " 1999", "", "1e3"]) == [
        2024, 20, None, None, 1999, None, 1000,
    ]
    assert apply(D.leading_year, ["2024-05", "x2024", " 1999", None]) == [2024, None, 1999, None]
    inside = lambda c: D.year_in_range(D.parse_year(c), "2020-05-01", "2022")
    assert apply(inside, ["2019", "2020", "2022-12", "2023", "unknown"]) == [False, True, True, False, True]
    assert apply(lambda c: D.year_in_range(D.parse_year(c), "soon", None), ["1900"]) == [True]


@pytest.mark.parametrize(
    "pattern", [r"\breview\b", r"meta-?analysis", r"\d+/\d{4}\)$", r"[\w-]+ \S+", r"\.s00"]
)
def test_search_agrees_with_python(apply, pattern):
    texts = ["a review", "previews", "Réview", "réview", "xéreview", "Meta-Analysis", "(3/2024)",
             "(3/2024)\n", "ab cd", "x.S001", "naïve é", "fooxbar", "³review"]
    expected = [re.search(pattern, t, re.IGNORECASE) is not None for t in texts]
    assert apply(lambda c: X.search(c, pattern), texts) == expected


def test_term_tests(apply):
    terms = ["ab", "abc", "b.c", "x y"]
    texts = ["zabz", "b.c", "bxc", "x y", "xy", "", "a b"]
    assert apply(lambda c: X.contains_any(c, terms), texts) == [any(t in s for t in terms) for s in texts]
    assert apply(lambda c: X.starts_with_any(c, terms), texts) == [s.startswith(tuple(terms)) for s in texts]


def test_keyword_hits(apply):
    assert apply(lambda c: X.keyword_hits(c, ["soil", "Algorithm"]), ["soil, algorithm", "Soil x", None]) == [
        ["Algorithm"], ["soil"], [],
    ]


def test_replies_and_labels(apply):
    assert apply(X.strip_code_fence, ["```json\n[1]\n```", " [1] ", "```JSON [1]```"]) == ["[1]"] * 3
    assert apply(lambda c: X.one_of(c, ["yes", "no"]), [" YES", "maybe", None]) == ["yes", "", ""]
    assert apply(X.html_unescape, ["a &amp; b &eacute;", "x", None]) == ["a & b é", "x", None]


def test_word_count(apply):
    texts = ["a b  c", "  ", "", " x ", "a　b"]
    assert apply(X.word_count, texts) == [len(t.split()) for t in texts]


def test_signatures(spark):
    dois = ["10.5/b", "10.5/a", "", "10.5/a"]
    want = hashlib.sha256("10.5/a\n10.5/b".encode()).hexdigest()[:16]
    frame = spark.createDataFrame([(dois,)], "d array<string>")
    assert frame.select(I.list_signature(F.col("d")).alias("s")).first()["s"] == want
    queries = ["q one", "q two"]
    frame = spark.createDataFrame([(queries,)], "q array<string>")
    column = I.query_signature_column(F.col("q"), F.lit("2024-01-01"), F.lit("2024-02-01"))
    assert frame.select(column.alias("s")).first()["s"] == I.query_signature(queries, "2024-01-01", "2024-02-01")


def test_table_signature_ignores_order_and_repeats(spark):
    one = spark.createDataFrame([("doi:10.5/A",), ("10.5/b",), ("",)], "doi string")
    two = spark.createDataFrame([("10.5/b",), ("10.5/a",), ("10.5/a",)], "doi string")
    other = spark.createDataFrame([("10.5/b",), ("10.5/c",)], "doi string")
    sign = lambda t: I.table_signature(t, F.col("doi")).first()["signature"]
    assert sign(one) == sign(two) != sign(other)


def test_windows(spark):
    day = date(2024, 3, 15)
    base = {"date_to": "2024-03-15"}
    window = lambda mode, **kw: D.run_window(spark, {**base, "date_range_mode": mode, **kw})
    assert window("prev_month") == (date(2024, 2, 1), date(2024, 2, 29))
    assert window("this_month") == (date(2024, 3, 1), day)
    assert window("rolling", rolling_days=30, min_date_from="2024-01-01") == (date(2024, 1, 1), day)
    assert window("rolling", rolling_days=30) == (date(2024, 2, 14), day)
    assert window("from_min_date", min_date_from="2020-01-01") == (date(2020, 1, 1), day)
    assert window("incremental") == (date(2024, 2, 14), day)
    assert D.run_window(spark, {**base, "date_range_mode": "incremental"}, last_run="2024-03-10") == (date(2024, 3, 10), day)
    with pytest.raises(ValueError):
        window("explicit")
    with pytest.raises(ValueError):
        window("explicit", date_from="2025-01-01")
    assert D.run_window(spark, {**base, "date_range_mode": "rolling"}, date_from=date(2024, 1, 1))[0] == date(2024, 1, 1)
    assert D.window_mode({"date_range_mode": "incremental"}) == "incremental" and D.window_mode({}) == "explicit"
