"""Queries for sources and sinks: tables are written to the shared folder and scanned back."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindery.operators.keyed import append_rows
from bindery.plans.registry import query
from bindery.session import scratch_path
from bindery.sources import files, sinks


@query(
    "scan_csv_lists",
    "SELECT p_partkey, p_name || ', \"x\"' AS title, p_name || '|' || p_type || '''s' AS genres FROM part",
)
def _(t):
    path = scratch_path(t.spark, "csv-lists")
    rows = t.part.select(
        F.col("p_partkey").alias("_index"), "p_partkey", F.concat("p_name", F.lit(', "x"')).alias("title"),
        F.array("p_name", F.concat("p_type", F.lit("'s"))).alias("genres"),
    )
    sinks.sink_csv(rows, path)
    out = files.scan_csv_lists(t.spark, path, "p_partkey long, title string, genres string", ["genres", "authors"])
    return out.withColumn("genres", F.array_join("genres", "|"))


@query("scan_csv_strings", "SELECT CAST(p_partkey AS VARCHAR) AS part_key, p_name AS title FROM part")
def _(t):
    path = scratch_path(t.spark, "csv-strings")
    sinks.sink_csv(t.part.select(F.col("p_partkey").alias("Part Key"), F.col("p_name").alias("TITLE")), path)
    return files.scan_csv_strings(t.spark, path)


_LATIN = "regexp_replace(regexp_replace(text, '\\\\s+', ' '), '[^\\\\x00-\\\\xFF]', '?')"


def _latin(t) -> str:
    path = scratch_path(t.spark, "csv-latin")
    good = t.documents.select("doc_id", F.expr(_LATIN).alias("text"), "lang")
    long_rows = t.labels.select("doc_id", F.lit("a"), F.lit("b"), F.lit("c"))
    for df, name in ((good, "good"), (long_rows, "long")):
        df.write.options(header=True, encoding="ISO-8859-1", escape='"').csv(f"{path}/{name}")
    return path + "/*"


@query(
    "scan_csv_encoded",
    "SELECT doc_id, lang, trim(regexp_replace(regexp_replace(text, '\\s+', ' ', 'g'), '[^\\x{00}-\\x{FF}]', '?', 'g')) AS text FROM documents",
)
def _(t):
    out = files.scan_csv_encoded(t.spark, _latin(t), "doc_id long, text string, lang string", "ISO-8859-1")
    return out.withColumn("text", F.trim("text"))


@query(
    "count_malformed",
    "SELECT (SELECT count(*) FROM documents) + (SELECT count(*) FROM labels) AS n_rows, (SELECT count(*) FROM labels) AS n_malformed",
)
def _(t):
    return files.count_malformed(t.spark, _latin(t), "doc_id long, text string, lang string", "ISO-8859-1")


@query(
    "scan_json_array",
    "SELECT 'A' || p_partkey AS asin, CAST(p_retailprice AS VARCHAR) AS final_price, p_name || '|' || p_type AS categories FROM part",
)
def _(t):
    path = scratch_path(t.spark, "json-array")
    record = F.struct(
        F.concat(F.lit("A"), "p_partkey").alias("asin"), F.col("p_retailprice").cast("string").alias("final_price"),
        F.array("p_name", "p_type").alias("categories"),
    )
    # 500 records to an array, one array to a file.
    arrays = t.part.groupBy(F.floor(F.col("p_partkey") / 500)).agg(F.to_json(F.collect_list(record)).alias("value"))
    arrays.select("value").write.option("maxRecordsPerFile", 1).text(path)
    out = files.scan_json_array(t.spark, path, "asin string, final_price string, categories array<string>")
    return out.withColumn("categories", F.array_join("categories", "|"))


@query("scan_jsonl_limit", "SELECT least(count(*), 25) AS n_rows FROM documents")
def _(t):
    path = scratch_path(t.spark, "jsonl")
    t.documents.select("doc_id", "lang", "text").write.json(path)
    return files.scan_jsonl_limit(t.spark, path, "doc_id long, lang string", 25).agg(F.count("*").alias("n_rows"))


@query("scan_jsonl", "SELECT doc_id, lang, length(text) AS n_points FROM documents")
def _(t):
    path = scratch_path(t.spark, "jsonl")
    t.documents.select("doc_id", "lang", "text").write.json(path)
    rows = files.scan_jsonl_limit(t.spark, path, "doc_id long, lang string, text string")
    return rows.select("doc_id", "lang", F.length("text").cast("long").alias("n_points"))


@query(
    "scan_jsonl_semi",
    """WITH d AS (SELECT source AS isbn13, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS description, lang AS language_code FROM documents),
 k AS (SELECT DISTINCT source FROM documents JOIN labels USING (doc_id) WHERE quality = 0)
 SELECT isbn13, description, language_code FROM (SELECT *, row_number() OVER (PARTITION BY isbn13 ORDER BY length(description) DESC, description, language_code) AS rn
 FROM d WHERE isbn13 IN (SELECT source FROM k)) WHERE rn = 1""",
)
def _(t):
    path = scratch_path(t.spark, "jsonl-semi")
    d = t.documents.select(
        F.concat(F.lit(" "), "source").alias("isbn13"), F.col("text").alias("description"), F.col("lang").alias("language_code"), "n_chars"
    )
    d.write.json(path)
    keys = t.documents.join(t.labels.filter("quality = 0"), "doc_id").select(F.col("source").alias("isbn13"))
    return files.scan_jsonl_semi(t.spark, path, "isbn13", ["description", "language_code"], "description", keys)


@query(
    "scan_keyed_json_maps",
    "SELECT event_id, 'k' AS ts, CAST(json_extract_string(props, '$.k') AS INT) AS rank FROM events",
)
def _(t):
    return files.explode_json_map(t.events, "event_id", "props")


_NAMES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@query("list_source_keys", " UNION ALL ".join(f"SELECT '{n}' AS name, count(*) AS n_rows FROM {n}" for n in _NAMES.split()))
def _(t):
    """The tables that have a file, with the rows of their files."""
    keys = files.list_source_keys(t.spark, t.folder, "name", ".parquet")
    rows = t.spark.read.schema("no_such_column int").parquet(f"{t.folder}/*.parquet")
    counts = rows.groupBy(F.regexp_extract("_metadata.file_path", r"/(\w+)[.]parquet", 1).alias("name"))
    return keys.join(counts.agg(F.count("*").alias("n_rows")), "name")


@query("scan_parquet", "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 49")
def _(t):
    return files.scan_parquet(t.spark, f"{t.folder}/lineitem.parquet").filter("l_quantity > 49").select("l_orderkey", "l_linenumber", "l_quantity")


@query("scan_optional", "SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS movie_title FROM part")
def _(t):
    absent = files.scan_optional(
        t.spark, lambda: t.spark.read.parquet(f"{t.folder}/no_such_table.parquet"), "p_partkey long, movie_title string"
    )
    present = files.scan_optional(t.spark, lambda: t.part, "p_partkey long")
    return append_rows(present.select("p_partkey", "p_name"), absent)


@query("sink_csv", "SELECT c_custkey, c_name, c_acctbal FROM customer")
def _(t):
    path = scratch_path(t.spark, "sink-csv")
    sinks.sink_csv(t.customer.select("c_custkey", "c_name", "c_acctbal"), path)
    return t.spark.read.schema("c_custkey long, c_name string, c_acctbal double").csv(path, header=True)


@query("sink_parquet", "SELECT o_orderkey, o_totalprice, CAST(floor(year(o_orderdate) / 10.0) * 10 AS INT) AS pub_decade FROM orders")
def _(t):
    path = scratch_path(t.spark, "sink-parquet")
    decade = (F.floor(F.year("o_orderdate") / 10) * 10).cast("int")
    sinks.sink_parquet(t.orders.select("o_orderkey", "o_totalprice", decade.alias("pub_decade")), path, "pub_decade")
    return t.spark.read.parquet(path)
