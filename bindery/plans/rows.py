"""Queries for projections, filters, sorts, set operations and row ids."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindery.functions import numbers, text
from bindery.operators import filters, keyed, ordered, projection, sampling
from bindery.plans.registry import BOOKS, TITLE, books, query, r6

# --- projections -------------------------------------------------------------------------------


@query("standardize_names", "SELECT p_partkey, p_name AS part_name, p_brand AS brand FROM part")
def _(t):
    raw = t.part.select("p_partkey", F.col("p_name").alias(" Part Name "), F.col("p_brand").alias("BRAND"))
    return projection.standardize_names(raw)


@query("assign_row_id", "SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) - 1 AS row_id FROM orders")
def _(t):
    rows = t.orders.select("o_orderkey", "o_orderdate")
    out = ordered.assign_row_id(rows, [F.asc("o_orderdate"), F.asc("o_orderkey")])
    return out.select("o_orderkey", "row_id")


_NUMBER = """case p_partkey % 5 when 0 then cast(p_size as string) || '.0' when 1 then ' ' || cast(p_size as string)
 when 2 then 'unknown' when 3 then '' else cast(p_retailprice as string) end"""


@query(
    "coerce_numeric",
    "SELECT p_partkey, CASE WHEN p_partkey % 5 IN (0, 1) THEN p_size WHEN p_partkey % 5 = 4 THEN CAST(trunc(p_retailprice) AS INT) END AS as_int, "
    "CASE WHEN p_partkey % 5 IN (0, 1) THEN CAST(p_size AS DOUBLE) WHEN p_partkey % 5 = 4 THEN p_retailprice END AS as_double FROM part",
)
def _(t):
    raw = t.part.selectExpr("p_partkey", f"{_NUMBER} as raw")
    return raw.select(
        "p_partkey",
        numbers.coerce_int(F.col("raw")).alias("as_int"),
        numbers.coerce_double(F.col("raw")).alias("as_double"),
    )


@query("select_existing", "SELECT p_name, p_partkey, p_size FROM part")
def _(t):
    return projection.select_existing(t.part, ["p_name", "isbn13", "p_partkey", "p_name", "p_size"])


@query("rename_columns", "SELECT p_partkey, p_name AS title, p_brand AS author, p_type, p_size, p_retailprice FROM part")
def _(t):
    return projection.rename_columns(t.part, {"p_name": "title", "p_brand": "author", "p_type": "p_size"})


@query("drop_columns", "SELECT p_partkey, p_name FROM part")
def _(t):
    return t.part.drop("p_brand", "p_type", "p_size", "p_retailprice", "authors_2")


_GAP_COLUMNS = [
    "p_partkey",
    "case when p_partkey % 3 = 0 then null when p_partkey % 3 = 1 then '  ' else p_name end as a",
    "case when p_partkey % 4 = 0 then null when p_partkey % 4 = 1 then ' ' else p_type end as b",
    "p_brand as c",
]
_GAPS = ", ".join(_GAP_COLUMNS)


@query("coalesce_columns", f"SELECT p_partkey, coalesce(a, b, c) AS first_known FROM (SELECT {_GAPS} FROM part)")
def _(t):
    return t.part.selectExpr(*_GAP_COLUMNS).select("p_partkey", F.coalesce("a", "b", "c").alias("first_known"))


@query(
    "coalesce_blank_aware",
    f"SELECT p_partkey, CASE WHEN trim(coalesce(a, '')) = '' AND trim(coalesce(b, '')) <> '' THEN b ELSE a END AS filled FROM (SELECT {_GAPS} FROM part)",
)
def _(t):
    rows = t.part.selectExpr(*_GAP_COLUMNS)
    return rows.select("p_partkey", projection.coalesce_blank_aware(F.col("a"), F.col("b")).alias("filled"))


@query(
    "match_method_case",
    "SELECT o_orderkey, m AS match_method, CAST(m <> 'unmatched' AS INT) AS is_match FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' "
    "THEN 'exact_isbn' WHEN o_totalprice > 300000 THEN 'fuzzy_title_author' ELSE 'unmatched' END AS m FROM orders)",
)
def _(t):
    method = projection.match_method_case(F.col("o_orderstatus") == "F", F.col("o_totalprice") > 300000)
    return t.orders.select(
        "o_orderkey", method.alias("match_method"), projection.is_match(method).alias("is_match")
    )


@query(
    "finalize_labels",
    """SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS label, CASE WHEN o_orderstatus = 'F' AND o_orderkey % 4 <> 0
 THEN CAST(o_orderkey % 50 AS INT) ELSE 0 END AS weeks, CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 20 AS INT) END AS best_rank FROM orders""",
)
def _(t):
    rows = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", 1).alias("label"),
        F.when((F.col("o_orderstatus") == "F") & (F.col("o_orderkey") % 4 != 0), (F.col("o_orderkey") % 50).cast("int")).alias("weeks"),
        (F.col("o_custkey") % 20).cast("int").alias("best_rank"),
    )
    return projection.finalize_labels(rows, "label", ["weeks"], ["best_rank", "debut_rank"])


@query(
    "fill_defaults",
    "SELECT p_partkey, coalesce(CASE WHEN p_partkey % 3 = 0 THEN NULL ELSE p_brand END, 'Unknown') AS publisher, "
    "CASE WHEN p_partkey % 5 = 0 THEN 0 ELSE p_size END AS pages FROM part",
)
def _(t):
    rows = t.part.select(
        "p_partkey",
        F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand")).alias("publisher"),
        F.when(F.col("p_partkey") % 5 != 0, F.col("p_size")).alias("pages"),
    )
    return rows.fillna({"publisher": "Unknown", "pages": 0})


@query(
    "define_target",
    """WITH u AS (SELECT user_id, count_if(event_type = 'purchase') AS weeks, min(CASE WHEN event_type = 'view' THEN CAST(floor(value * 100) AS INT) END) AS best
 FROM events GROUP BY 1) SELECT user_id, CAST(CASE WHEN weeks > 12 OR best <= 30 THEN 1 ELSE 0 END AS INT) AS target FROM u""",
)
def _(t):
    users = t.events.groupBy("user_id").agg(
        F.count_if(F.col("event_type") == "purchase").alias("weeks"),
        F.min(F.when(F.col("event_type") == "view", F.floor(F.col("value") * 100).cast("int"))).alias("best"),
    )
    return users.select("user_id", projection.define_target(F.col("weeks") - 12, F.col("best"), 30).alias("target"))


@query(
    "bucket_capped",
    """WITH c AS (SELECT o_custkey, count_if(o_orderstatus = 'F') AS n FROM orders GROUP BY 1),
 b AS (SELECT CASE WHEN n >= 5 THEN '5+' ELSE CAST(n AS VARCHAR) END AS bucket, count(*) AS n FROM c GROUP BY 1)
 SELECT d.bucket, coalesce(b.n, 0) AS n_customers FROM (SELECT unnest(['0','1','2','3','4','5+']) AS bucket) d LEFT JOIN b USING (bucket)""",
)
def _(t):
    per = t.orders.groupBy("o_custkey").agg(F.count_if(F.col("o_orderstatus") == "F").alias("n"))
    counts = per.groupBy(projection.bucket_capped(F.col("n")).alias("bucket")).agg(F.count("*").alias("n_customers"))
    domain = t.spark.createDataFrame([(b,) for b in projection.capped_domain()], "bucket string")
    return domain.join(counts, "bucket", "left").fillna(0, ["n_customers"])


@query(
    "map_dictionary",
    "SELECT p_partkey, CAST(CASE lower(p_type) WHEN 'economy' THEN 0 WHEN 'standard' THEN 1 WHEN 'promo' THEN 2 ELSE 99 END AS INT) AS priority FROM part",
)
def _(t):
    ranks = {"economy": 0, "standard": 1, "promo": 2}
    return t.part.select("p_partkey", projection.map_dictionary(F.lower("p_type"), ranks, 99).alias("priority"))


@query(
    "expand_vector",
    "SELECT vec_id, " + ", ".join(f"embedding[{i + 1}] AS desc_emb_{i}" for i in range(64)) + " FROM embeddings",
)
def _(t):
    cells = projection.expand_vector(F.col("embedding"), 64, "desc_emb_")
    return t.embeddings.select("vec_id", *[c.alias(k) for k, c in cells.items()])


# --- filters -----------------------------------------------------------------------------------

_YEAR = "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(year(o_orderdate) - (o_orderkey % 90) AS INT) END"


def _years(t):
    year = F.when(F.col("o_orderkey") % 9 != 0, (F.year("o_orderdate") - F.col("o_orderkey") % 90).cast("int"))
    return t.orders.select("o_orderkey", year.alias("pub_year"))


@query(
    "filter_min_year_nullsafe",
    f"SELECT * FROM (SELECT o_orderkey, {_YEAR} AS pub_year FROM orders) WHERE pub_year IS NULL OR pub_year >= 1931",
)
def _(t):
    return filters.filter_min_year_nullsafe(_years(t), "pub_year")


@query(
    "filter_boxset",
    f"""SELECT * FROM (SELECT p_partkey, {TITLE} AS title FROM part) WHERE NOT (regexp_matches(coalesce(title, ''), '#\\d+-\\d+')
 OR regexp_matches(coalesce(title, ''), 'box\\s*set|boxed set|boxset|complete collection|complete series', 'i'))""",
)
def _(t):
    return filters.filter_boxset(t.part.selectExpr("p_partkey", f"{TITLE} as title"), "title")


@query(
    "filter_array_tags",
    "SELECT p_partkey, p_name FROM part WHERE NOT (list_contains(string_split(p_name, ' '), 'gear') AND NOT list_contains(string_split(p_name, ' '), 'red'))",
)
def _(t):
    rows = t.part.select("p_partkey", "p_name", F.split("p_name", " ").alias("tags"))
    return filters.filter_array_tags(rows, "tags", "gear", "red").drop("tags")


@query(
    "flag_tag_ci",
    "SELECT count(*) AS n, CAST(count_if(f) AS BIGINT) AS n_tagged, round(avg(CAST(f AS DOUBLE)), 6) AS rate FROM "
    "(SELECT list_contains(string_split(p_name, ' '), 'gear') AS f FROM part)",
)
def _(t):
    tags = F.transform(F.split("p_name", " "), lambda x: F.concat(F.lit(" "), F.upper(x)))
    flag = text.has_tag(tags, "gear")
    return t.part.agg(
        F.count("*").alias("n"), F.count_if(flag).alias("n_tagged"), r6(F.avg(flag.cast("double"))).alias("rate")
    )


@query(
    "flag_suspicious_range",
    "SELECT o_orderkey, y, coalesce(y < 1910 OR y > 1999, false) AS suspicious FROM "
    f"(SELECT o_orderkey, {_YEAR} AS y FROM orders)",
)
def _(t):
    rows = _years(t).withColumnRenamed("pub_year", "y")
    return rows.withColumn("suspicious", filters.flag_suspicious_range(F.col("y"), 1910, 1999))


@query("filter_between", "SELECT p_partkey, p_size FROM part WHERE p_size > 10 AND p_size < 40 AND p_retailprice BETWEEN 950 AND 1050")
def _(t):
    rows = filters.filter_between(t.part, "p_size", 10, 40, closed=False)
    return filters.filter_between(rows, "p_retailprice", 950, 1050).select("p_partkey", "p_size")


@query("filter_keywords", "SELECT doc_id FROM documents WHERE regexp_matches(text, 'license|password|copyright|http', 'i')")
def _(t):
    words = ["License", "password", "copyright", "HTTP"]
    return t.documents.filter(text.has_any_keyword(F.col("text"), words)).select("doc_id")


@query("filter_in_keys", "SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def _(t):
    keys = t.labels.filter("quality = 1")
    return keyed.filter_in_keys(t.documents.select("doc_id", "lang"), keys, ["doc_id"])


@query(
    "cap_at_quantile",
    "SELECT event_id, value FROM events WHERE value <= (SELECT quantile_cont(value, 0.99) FROM events WHERE event_type <> 'purchase')",
)
def _(t):
    reference = t.events.filter("event_type <> 'purchase'").select("value")
    return filters.cap_at_quantile(t.events.select("event_id", "value"), "value", reference)


@query(
    "clip_values",
    """SELECT event_id, least(greatest(value, 5.0), 60.0) AS clipped, round(least(value, q), 6) AS winsorised
 FROM events, (SELECT quantile_cont(value, 0.95) AS q FROM events)""",
)
def _(t):
    rows = t.events.select("event_id", "value")
    capped = filters.clip_at_quantile(rows.withColumnRenamed("value", "winsorised"), "winsorised", 0.95)
    both = rows.join(capped, "event_id")
    return both.select(
        "event_id", numbers.clip(F.col("value"), 5.0, 60.0).alias("clipped"), r6("winsorised").alias("winsorised")
    )


@query("drop_missing_rows", f"SELECT * FROM (SELECT {_GAPS} FROM part) WHERE a IS NOT NULL AND b IS NOT NULL")
def _(t):
    return filters.drop_missing_rows(t.part.selectExpr(*_GAP_COLUMNS), ["a", "b"])


# --- sort, limit, sample -----------------------------------------------------------------------


@query("top_k", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 10")
def _(t):
    return sampling.top_k(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice", 10, "o_orderkey")


@query(
    "sort_head",
    f"SELECT o_orderkey, pub_year FROM (SELECT o_orderkey, {_YEAR} AS pub_year FROM orders) ORDER BY pub_year DESC NULLS LAST, o_orderkey LIMIT 25",
)
def _(t):
    return _years(t).orderBy(F.desc_nulls_last("pub_year"), "o_orderkey").limit(25)


@query(
    "seeded_sample",
    """SELECT o_orderkey, o_totalprice / 5500 AS score, CASE WHEN o_totalprice / 5500 >= 90 THEN 'sure' WHEN o_totalprice / 5500 >= 85 THEN 'check' ELSE 'doubtful' END AS mark
 FROM orders WHERE o_totalprice / 5500 >= 80 ORDER BY md5(o_orderkey || ':42'), o_orderkey LIMIT 25""",
)
def _(t):
    rows = t.orders.select("o_orderkey", (F.col("o_totalprice") / 5500).alias("score")).filter("score >= 80")
    return sampling.seeded_sample(rows, "o_orderkey", 25).withColumn("mark", sampling.review_mark(F.col("score")))


@query(
    "preview_matches",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_orderkey LIMIT 25",
)
def _(t):
    matches = t.orders.withColumn("match_method", projection.match_method_case(F.col("o_orderstatus") == "F", F.lit(False)))
    return sampling.preview(matches, F.col("match_method") == "exact_isbn", ["o_orderkey", "o_custkey"], "o_orderkey")


# --- set operations ----------------------------------------------------------------------------


@query(
    "key_overlap",
    """SELECT (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F') AS n_left,
 (SELECT count(DISTINCT c_custkey) FROM customer WHERE c_nationkey < 10) AS n_right, count(*) AS n_both,
 round(count(*) / (SELECT count(DISTINCT o_custkey) FROM orders WHERE o_orderstatus = 'F'), 6) AS share_of_left
 FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' INTERSECT SELECT c_custkey FROM customer WHERE c_nationkey < 10)""",
)
def _(t):
    left = t.orders.filter("o_orderstatus = 'F'").select(F.col("o_custkey").alias("key"))
    right = t.customer.filter("c_nationkey < 10").select(F.col("c_custkey").alias("key"))
    return keyed.key_overlap(left, right, "key").withColumn("share_of_left", r6("share_of_left"))


@query(
    "key_difference",
    "SELECT DISTINCT o_custkey AS key FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 10)",
)
def _(t):
    wanted = t.orders.select(F.col("o_custkey").alias("key"))
    done = t.customer.filter("c_nationkey < 10").select(F.col("c_custkey").alias("key"))
    return keyed.key_difference(wanted, done, "key")


@query(
    "append_rows",
    "SELECT c_custkey AS id, c_name AS name, c_mktsegment AS segment FROM customer UNION ALL SELECT s_suppkey, s_name, NULL FROM supplier",
)
def _(t):
    a = t.customer.selectExpr("c_custkey as id", "c_name as name", "c_mktsegment as segment")
    return keyed.append_rows(a, t.supplier.selectExpr("s_name as name", "s_suppkey as id"))


@query(
    "concat_columns",
    "SELECT d.doc_id, n_chars, lang, quality FROM documents d JOIN labels USING (doc_id)",
)
def _(t):
    return keyed.concat_columns(
        "doc_id", t.documents.select("doc_id", "n_chars"), t.documents.select("doc_id", "lang"), t.labels.select("doc_id", "quality")
    )


# --- keyed windows -----------------------------------------------------------------------------


@query(
    "keep_best_per_key",
    """SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY
 CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE floor(o_totalprice / 1000) END DESC NULLS LAST, o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1""",
)
def _(t):
    weeks = F.when(F.col("o_orderkey") % 5 != 0, F.floor(F.col("o_totalprice") / 1000))
    best = keyed.keep_best_per_key(
        t.orders, ["o_custkey"], [weeks.desc_nulls_last(), F.asc("o_orderdate"), F.asc("o_orderkey")]
    )
    return best.select("o_custkey", "o_orderkey", "o_totalprice")


@query(
    "dedupe_any",
    "SELECT p_name, p_brand, min(p_partkey) AS p_partkey FROM part GROUP BY 1, 2",
)
def _(t):
    return keyed.dedupe_any(t.part.select("p_name", "p_brand", "p_partkey"), ["p_name", "p_brand"], [F.asc("p_partkey")])


@query(
    "best_candidate",
    """SELECT l_orderkey, l_partkey, score FROM (SELECT l_orderkey, l_partkey, round(0.7 * l_quantity + 0.3 * l_extendedprice / 1000, 6) AS score,
 row_number() OVER (PARTITION BY l_orderkey ORDER BY round(0.7 * l_quantity + 0.3 * l_extendedprice / 1000, 6) DESC, l_partkey, l_linenumber) AS rn
 FROM lineitem) WHERE rn = 1""",
)
def _(t):
    score = r6(F.col("l_quantity") * 0.7 + F.col("l_extendedprice") / 1000 * 0.3)
    scored = t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", score.alias("score"))
    best = keyed.keep_best_per_key(
        scored, ["l_orderkey"], [F.desc("score"), F.asc("l_partkey"), F.asc("l_linenumber")]
    )
    return best.drop("l_linenumber")


@query(
    "cumulative_share",
    """WITH c AS (SELECT author, count(*) AS n_positive FROM ({B}) WHERE label = 1 GROUP BY 1)
 SELECT author, n_positive, round(sum(n_positive) OVER (ORDER BY n_positive DESC, author ROWS UNBOUNDED PRECEDING) * 100.0
 / sum(n_positive) OVER (), 1) AS cumulative_pct FROM c""".replace("{B}", BOOKS),
)
def _(t):
    counts = books(t).filter("label = 1").groupBy("author").agg(F.count("*").alias("n_positive"))
    return ordered.cumulative_share(counts, "author", "n_positive")


