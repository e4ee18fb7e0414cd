"""File formats on small written fixtures."""

import json

import pytest
from pyspark.errors import StreamingQueryException

from bindery import schemas
from bindery.sources import files, sinks
from bindery.streaming.incremental import append_to_cache, grow_cache, incremental_cache


def test_keyed_maps_and_their_keys(spark, tmp_path):
    (tmp_path / "B1_com_norm.json").write_text(json.dumps({"100": 5, "200": 3}))
    (tmp_path / "B2_com_norm.json").write_text(json.dumps({}))
    (tmp_path / "notes.txt").write_text("x")
    rows = files.scan_keyed_json_maps(spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in rows) == [("B1", 100, 5), ("B1", 200, 3)]
    assert sorted(r["asin"] for r in files.list_source_keys(spark, str(tmp_path)).collect()) == ["B1", "B2"]


def test_catalogue_csv(spark, tmp_path):
    path = tmp_path / "books.csv"
    path.write_text(
        ",book_id,title,authors,isbn\n"
        '0,1,"Say ""Hi""\nagain","[\'A B\', ""C\'D""]",0439023483\n'
        "1,2,Plain,[],\n"
    )
    kinds = "book_id int, title string, authors string, isbn string"
    got = files.scan_csv_lists(spark, str(path), kinds, ["authors"], multiline=True)
    assert [tuple(r) for r in got.orderBy("book_id").collect()] == [
        (1, 'Say "Hi"\nagain', ["A B", "C'D"], "0439023483"),
        (2, "Plain", [], None),
    ]


def test_encoded_csv_drops_only_long_rows(spark, tmp_path):
    path = tmp_path / "index.csv"
    path.write_bytes("ASIN,TITLE,AUTHOR\nA1,Caf\xe9,X\nA2,short\nA3,a,b,c,d\n".encode("latin-1"))
    got = files.scan_csv_encoded(spark, str(path), "asin string, title string, author string", "ISO-8859-1")
    assert sorted((tuple(r) for r in got.collect()), key=str) == [("A1", "Café", "X"), ("A2", "short", None)]
    assert tuple(files.count_malformed(spark, str(path), "asin string, title string, author string", "ISO-8859-1").first()) == (3, 1)
    cp = tmp_path / "movies.csv"
    cp.write_bytes("author,movie\nx,It\x92s\n".encode("latin-1"))
    assert files.scan_csv_encoded(spark, str(cp), "author string, movie string", "windows-1252").first()["movie"] == "It’s"


def test_json_array_and_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps([{"asin": "1", "categories": ["x", "y"]}, {"asin": "2"}], indent=1))
    got = files.scan_json_array(spark, str(tmp_path / "a.json"), schemas.SHOP_CATALOGUE)
    assert [(r["asin"], r["categories"]) for r in got.orderBy("asin").collect()] == [("1", ["x", "y"]), ("2", None)]
    lines = [{"isbn13": " 1 ", "description": d} for d in ("a", " longest ", "bb")] + [{"isbn13": "9", "description": "z"}, {"description": "q"}]
    (tmp_path / "b.jsonl").write_text("\n".join(map(json.dumps, lines)))
    keys = spark.createDataFrame([("1",), ("7",)], "isbn13 string")
    got = files.scan_jsonl_semi(spark, str(tmp_path / "b.jsonl"), "isbn13", ["description"], "description", keys)
    assert [tuple(r) for r in got.collect()] == [("1", "longest")]
    assert files.scan_jsonl_limit(spark, str(tmp_path / "b.jsonl"), schemas.METADATA_DUMP, 2).count() == 2


def test_absent_source(spark, tmp_path):
    got = files.scan_optional(spark, lambda: spark.read.parquet(str(tmp_path / "none")), schemas.ADAPTATIONS)
    assert got.count() == 0 and got.columns == ["author", "movie_title", "movie_release_date", "book_title"]


def test_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, ["a", "b's"], 1990)], "id int, tags array<string>, pub_decade int")
    sinks.sink_csv(df, str(tmp_path / "csv"))
    back = spark.read.csv(str(tmp_path / "csv"), header=True, escape='"')
    assert back.first()["tags"] == "['a', \"b's\"]"
    sinks.sink_parquet(df, str(tmp_path / "pq"), "pub_decade")
    assert spark.read.parquet(str(tmp_path / "pq")).first()["tags"] == ["a", "b's"]


def test_cache_grows_by_new_keys_only(spark, tmp_path):
    path = str(tmp_path / "cache")
    schema = "isbn string, publisher string, publisher_source string"
    append_to_cache(spark.createDataFrame([("1", "old", "first")], schema), path)
    first = spark.createDataFrame([("1", "new"), ("2", None)], "isbn string, publisher string")
    second = spark.createDataFrame([("2", "two"), ("1", "x")], "isbn string, publisher string")
    wanted = spark.createDataFrame([("1",), ("2",), ("2",), ("3",), (None,)], "isbn string")
    for _ in range(2):
        fresh = incremental_cache(wanted, spark.read.parquet(path), "isbn", "publisher", [("first", first), ("second", second)])
        append_to_cache(fresh, path)
    rows = sorted(tuple(r) for r in spark.read.parquet(path).select(*schema.replace(" string", "").split(", ")).fillna("-").collect())
    assert rows == [("1", "old", "first"), ("2", "two", "second"), ("3", "-", "missing")]


def test_cache_grows_over_failed_runs(spark, tmp_path):
    """Broken off before and after a batch is written, and run again: every key once, values as of its batch."""
    wanted, folder = str(tmp_path / "wanted"), str(tmp_path / "cache")
    source = spark.createDataFrame([(k, f"v{k}") for k in range(0, 40, 2)], "k long, v string")
    known = spark.createDataFrame([(3,), (4,)], "k long")

    def deliver(keys):
        spark.createDataFrame([(k,) for k in keys], "k long").coalesce(1).write.mode("append").parquet(wanted)

    def run(flushed=None):
        return grow_cache(spark, wanted, folder, "k", "v", [("s", source)], known=known, files_per_batch=1, flushed=flushed)

    def broken(number):
        raise RuntimeError("lost")

    deliver([1, 2, 2, None])
    deliver([2, 3, 4, 5])
    got = run()
    assert {(r["k"], r["v"], r["v_source"]) for r in got.collect()} == {(1, None, "missing"), (2, "v2", "s"), (5, None, "missing")}
    deliver([5, 6])
    for _ in range(2):  # written both times, committed neither time
        with pytest.raises(StreamingQueryException):
            run(broken)
    deliver([6, 7])
    rows = [(r["k"], r["v"]) for r in run().orderBy("k").collect()]
    assert rows == [(1, None), (2, "v2"), (5, None), (6, "v6"), (7, None)]
    # A batch that was written but whose commit was lost is run again and replaced.
    last = max((tmp_path / "cache/checkpoint/commits").glob("[0-9]*"), key=lambda p: int(p.name))
    last.unlink()
    (last.parent / f".{last.name}.crc").unlink(missing_ok=True)
    again = run()
    assert [(r["k"], r["v"]) for r in again.orderBy("k").collect()] == rows
    assert run().count() == len(rows)
