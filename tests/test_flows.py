"""The labelling job on a small catalogue with one book of every kind."""

import pytest

from bindery.plans import flows
from bindery.plans.flows import label_catalogue, scope_filters


def test_label_catalogue(spark):
    books = spark.createDataFrame(
        [
            (1, "Gone Girl", ["Gillian Flynn"], "439023483", None, 2012, ["fiction"]),  # key, zero lost
            (2, "The Da Vinci Code", ["Dan Brown"], None, "n/a", 2003, ["fiction"]),  # title in other order
            (3, "The Da Vinci Code", ["Dan Brown"], None, None, None, ["nonfiction", "fiction"]),  # a copy
            (4, "Unknown Work", ["Nobody"], None, None, 1990, ["nonfiction"]),
            (5, "Gone Girl", ["Gillian Flynn"], None, None, 1900, ["fiction"]),  # its label is used up
            (6, None, [], "0439023484", None, 2000, []),  # bad check digit, no title
        ],
        "gb_id long, title string, authors array<string>, isbn string, isbn13 string, pub_year int, genres array<string>",
    )
    labels = spark.createDataFrame(
        [
            (10, "GONE GIRL", "Gillian Flynn", "0439023483 : HRD", 5, 2, 2012, 4),
            (11, "Gone Girl", "Gillian Flynn", "9780439023481", 9, 1, 2012, 3),  # stronger, same key
            (12, "Da Vinci Code, The", "Brown, Dan", None, 50, 1, 2003, 1),
        ],
        "label_id long, title string, author string, oclc_isbn string, weeks_on_list int, best_rank_achieved int, first_year int, debut_rank int",
    )
    out = label_catalogue(books, labels)
    got = {r["gb_id"]: (r["match_method"], r["label"], r["label_id"], r["weeks_on_list"], r["first_year"]) for r in out.collect()}
    assert got[1] == ("exact_isbn", 1, 11, 9, 2012)
    assert got[4] == ("unmatched", 0, None, 0, None)
    assert got[5] == ("unmatched", 0, None, 0, None)
    assert got[6] == ("unmatched", 0, None, 0, None)
    assert got[2][:3] == got[3][:3] == ("fuzzy_title_author", 1, 12)
    assert sorted(r["gb_id"] for r in scope_filters(out).collect()) == [1, 2, 3, 6]


class _Seen(Exception):
    pass


@pytest.mark.parametrize("job", ["label_catalogue", "canonical_table"])
def test_rows_are_dealt_out_before_they_are_cleaned(spark, monkeypatch, job):
    """A compact file is read in few tasks, which cleaned all its rows, some of them several times."""
    plans = {}
    last = {"label_catalogue": "labels", "canonical_table": "shop"}[job]

    def seen(df, name="stage", **options):
        plans[name] = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        if name == last:
            raise _Seen
        return df

    monkeypatch.setattr(flows, "materialize", seen)
    book = "title string, authors array<string>, isbn string, isbn13 string"
    with pytest.raises(_Seen):
        if job == "label_catalogue":
            books = spark.createDataFrame([(1, "A", ["b"], None, None)], "gb_id long, " + book).coalesce(1)
            labels = "label_id long, title string, author string, oclc_isbn string, weeks_on_list int, best_rank_achieved int, first_year int, debut_rank int"
            flows.label_catalogue(books, spark.createDataFrame([(1, "A", "b", None, 1, 1, 1, 1)], labels).coalesce(1))
        else:
            books = spark.createDataFrame([(1, "A", ["b"], None, None)], "book_id long, " + book).coalesce(1)
            values = "asin string, ISBN10 string, rating string, reviews_count string, final_price string, number_of_sellers string"
            shop = spark.createDataFrame([("a", None, "1", "1", "1", "1")], values).coalesce(1)
            flows.canonical_table(books, shop, *[None] * 5)
    assert set(plans) == {"books", last}
    assert all("REPARTITION_BY_COL" in p for p in plans.values())
