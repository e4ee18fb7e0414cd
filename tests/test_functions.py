"""Edge cases of the scalar functions."""

import pytest
from pyspark.sql import functions as F

from bindery.functions import dates, isbn, numbers, text, unicode


def run(spark, expr, values, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r["y"] for r in df.select("i", expr(F.col("x")).alias("y")).orderBy("i").collect()]


def test_missing_texts(spark):
    values = [None, "", "  ", "nan", " N/A ", "<NA>", "None", "123.0", "1.0.0", "\t x \n"]
    assert run(spark, text.clean_missing_text, values) == [None] * 7 + ["123", "1.0.0", "x"]


def test_isbn10(spark):
    values = ["0439023483", "439023483", "080501084X", "80501084x", "0439023484", "0-439-02348-3", "439023483.0", None, "n/a", "X"]
    want = ["0439023483", "0439023483", "080501084X", "080501084X", None, "0439023483", "0439023483", None, None, None]
    assert run(spark, isbn.clean_isbn10_padded, values) == want


def test_isbn13(spark):
    values = ["9780439023481", "9780439023480.0", "978-0-439-02348-1", "9780439023480", None]
    assert run(spark, isbn.clean_isbn13_valid, values) == ["9780439023481", None, "9780439023481", None, None]
    assert run(spark, isbn.norm_isbn13_loose, values)[1] == "9780439023480"
    assert run(spark, isbn.isbn10_to_13_valid, ["0439023483", "0439023484"]) == ["9780439023481", None]


def test_loose_isbn10(spark):
    values = ["439023483.0", "abc", "12345678901", None, "0-80501084-x"]
    assert run(spark, isbn.norm_isbn10_loose, values) == ["0439023483", "0000000000", None, None, "080501084X"]


def test_mixed_field(spark):
    values = ["0399167307 : HRD", "9780765330536", "080501084X", "no number", "9780439023480 0439023483", "439023483"]
    candidates = run(spark, isbn.extract_isbn_candidates, values)
    assert candidates[0] == ["0399167307"]
    assert candidates[1] == ["9780765330536"]
    assert candidates[3] == []
    keys = run(spark, isbn.oclc_to_isbn13, values)
    assert keys == ["9780399167300", "9780765330536", "9780805010848", None, None, "9780439023481"]


def test_title_norms(spark):
    values = ["The Éclair: a “tale”", "An a the x", None, "A", "œuvre – naïve", "A The An Apple"]
    assert run(spark, text.norm_title, values) == ["eclair a tale", "a the x", "", "a", "œuvre naive", "the an apple"]
    assert run(spark, text.norm_title_nfkd, values) == ["eclair: a tale", "a the x", "", "a", "uvre  naive", "the an apple"]
    assert run(spark, text.norm_text_ascii, [" Gone\tGirl! ", "Café", None]) == ["gone girl", "caf", ""]
    assert run(spark, unicode.strip_diacritics, ["ÀÉß", "plain", None]) == ["AEß", "plain", None]


def test_lists(spark):
    values = ["['a', \"b's\"]", "['x', None]", "[]", "nope", "", None]
    assert run(spark, text.parse_str_list, values) == [["a", "b's"], ["x", None], [], [], [], []]
    assert run(spark, lambda c: text.parse_str_list(c, "single"), values)[3:] == [["nope"], [], []]
    assert run(spark, lambda c: text.parse_str_list(c, "null"), values)[3:] == [None, None, None]
    with pytest.raises(ValueError):
        text.parse_str_list(F.lit("x"), "other")


def test_title_features(spark):
    df = spark.createDataFrame([("Catching Fire (Games, #2)",), (None,), ("Dune: Part One",)], "t string")
    rows = df.select(*[c.alias(k) for k, c in text.title_features(F.col("t")).items()]).collect()
    assert [tuple(r) for r in rows] == [(2, 13, False, True), (0, 0, False, False), (3, 14, True, False)]


def test_boxset_and_scrub(spark):
    assert run(spark, text.is_boxset, ["X (#1-3)", "BOXED SET", "box  set", "fine", None]) == [True, True, True, False, False]
    assert run(spark, text.scrub_accolades, ["A New York Times Bestseller!", "superbestsellers"]) == ["A  !", "superbestsellers"]


def test_words(spark):
    assert run(spark, text.word_count, [None, "", "  ", " a b\n c "]) == [0, 0, 0, 3]


def test_numbers(spark):
    assert run(spark, numbers.coerce_int, ["1998.0", " 7 ", "x", "", None]) == [1998, 7, None, None, None]
    assert run(spark, numbers.pub_decade, [1999, -5, 2000, None], "int") == [1990, -10, 2000, None]


def test_months(spark):
    values = [
        "09/14/08", "September 6th 2006", "November 2002", "August 7th 2007", "('6', '1', '2006')", "(None, None, '2003')",
        "2003", None, "nan", "2004-05-06", "Sep 1, 2001", "('13', '1', '2006')", "garbage",
    ]
    assert run(spark, dates.pub_month, values) == [9, 9, 11, 8, 6, 0, 0, 0, 0, 5, 9, 0, 0]
