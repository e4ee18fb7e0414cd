"""Queries for the label audit: aggregates, pivots, correlations, histograms, history."""

from __future__ import annotations

import itertools

from pyspark.sql import functions as F

from bindery.functions.numbers import pub_decade
from bindery.functions.text import clean_author_name
from bindery.operators import history, profile, projection, quality
from bindery.plans.joins import _RANKS, _rank_table
from bindery.plans.registry import BOOKS, MESSY_SQL, books, messy_isbn, query, rounded

# --- history -----------------------------------------------------------------------------------

_PRIOR = f"""b AS ({BOOKS}), h AS (SELECT *, CAST(coalesce(sum(label) OVER (PARTITION BY author ORDER BY pub_year
 RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS INT) AS author_prior_count FROM b)"""


@query("author_prior_count", f"WITH {_PRIOR} SELECT gb_id, author_prior_count FROM h")
def _(t):
    return history.author_prior_count(books(t), "author", "pub_year", "label", "gb_id").select("gb_id", "author_prior_count")


@query(
    "prior_success_rates",
    f"""WITH {_PRIOR} SELECT CASE WHEN author_prior_count >= 5 THEN '5+' ELSE CAST(author_prior_count AS VARCHAR) END AS bucket, count(*) AS total,
 CAST(sum(label) AS BIGINT) AS positives, round(sum(label) * 100.0 / count(*), 1) AS hit_rate FROM h GROUP BY 1""",
)
def prior_success_rates(t):
    """Flagship: positive rate by the author's earlier positives."""
    rows = history.author_prior_count(books(t), "author", "pub_year", "label", "gb_id")
    return profile.rate_by_group(rows, projection.bucket_capped(F.col("author_prior_count")), "label", "bucket")


_YEAR_GAPS = "CASE WHEN gb_id % 13 = 0 THEN NULL ELSE pub_year END AS pub_year, CASE WHEN gb_id % 17 = 0 THEN NULL ELSE author END AS author"


@query(
    "years_since_last",
    f"""WITH b AS (SELECT gb_id, {_YEAR_GAPS} FROM ({BOOKS})),
 g AS (SELECT gb_id, CASE WHEN author IS NOT NULL THEN CAST(pub_year - lag(pub_year) OVER (PARTITION BY author ORDER BY pub_year NULLS LAST, gb_id) AS DOUBLE) END AS gap FROM b)
 SELECT gb_id, gap AS years_since_last_pub, gap IS NULL AS is_debut FROM g""",
)
def _(t):
    b = books(t).select(
        "gb_id",
        F.when(F.col("gb_id") % 13 != 0, F.col("pub_year")).alias("pub_year"),
        F.when(F.col("gb_id") % 17 != 0, F.col("author")).alias("author"),
    )
    return history.years_since_last(b, "author", "pub_year", "gb_id").drop("author", "pub_year")


@query(
    "max_author_prior",
    f"""WITH b AS ({BOOKS}), a AS (SELECT DISTINCT b.gb_id, l_suppkey AS a, pub_year, label FROM b JOIN lineitem ON l_orderkey = gb_id),
 c AS (SELECT a, pub_year, sum(label) AS n FROM a GROUP BY 1, 2),
 p AS (SELECT a, pub_year, coalesce(sum(n) OVER (PARTITION BY a ORDER BY pub_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS prior FROM c)
 SELECT b.gb_id, CAST(coalesce(max(prior), 0) AS INT) AS max_author_prior_count FROM b LEFT JOIN a ON a.gb_id = b.gb_id LEFT JOIN p ON p.a = a.a AND p.pub_year = a.pub_year GROUP BY 1""",
)
def _(t):
    names = t.lineitem.groupBy("l_orderkey").agg(
        F.collect_set(F.concat(F.lit(" Supp. #"), "l_suppkey")).alias("authors")
    )
    b = books(t).join(names, F.col("gb_id") == F.col("l_orderkey"), "left")
    return history.max_author_prior(b, "authors", "pub_year", "label", "gb_id", clean_author_name)


@query(
    "agg_weekly_list",
    f"""WITH e AS (SELECT user_id, event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'T' || event_id END AS title,
 CASE WHEN event_id % 5 <> 0 THEN 'by ' || event_type END AS author, CASE WHEN event_id % 4 = 0 THEN '978' || lpad(CAST(event_id AS VARCHAR), 10, '0') END AS isbn,
 CASE WHEN event_type = 'error' THEN 'oops' ELSE CAST(CAST(floor(value) AS INT) AS VARCHAR) END AS rank FROM events)
 SELECT user_id, arg_min(title, event_id) FILTER (WHERE title IS NOT NULL) AS title, CAST(min(TRY_CAST(rank AS DOUBLE)) AS DOUBLE) AS best_rank,
 arg_min(author, event_id) FILTER (WHERE author IS NOT NULL) AS author, arg_min(isbn, event_id) FILTER (WHERE isbn IS NOT NULL) AS oclc_isbn,
 arg_min(isbn, event_id) FILTER (WHERE isbn IS NOT NULL) AS primary_isbn13,
 count(TRY_CAST(rank AS DOUBLE)) AS weeks_on_list, CAST(1 AS INT) AS label FROM e GROUP BY 1""",
)
def _(t):
    weeks = t.events.select(
        "user_id", "event_id",
        F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("T"), "event_id")).alias("title"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit("by "), "event_type")).alias("author"),
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit("978"), F.lpad(F.col("event_id").cast("string"), 10, "0"))).alias("isbn"),
        F.when(F.col("event_type") == "error", "oops").otherwise(F.floor("value").cast("int").cast("string")).alias("rank"),
    )
    return history.agg_weekly_list(weeks, "user_id", "title", "author", "isbn", "rank", "event_id")


@query("rank_features", _RANKS)
def _(t):
    return _rank_table(t)


# --- balance, counts, rates --------------------------------------------------------------------


@query(
    "class_balance",
    """WITH c AS (SELECT count(*) FILTER (WHERE quality = 0) AS n0, count(*) FILTER (WHERE quality = 1) AS n1 FROM labels)
 SELECT CAST(0 AS INT) AS label, n0 AS n, round(n0 * 100.0 / (n0 + n1), 4) AS pct, round(n0 / n1, 4) AS neg_per_pos FROM c
 UNION ALL SELECT 1, n1, round(n1 * 100.0 / (n0 + n1), 4), round(n0 / n1, 4) FROM c""",
)
def _(t):
    return profile.class_balance(t.labels, "quality")


@query("value_counts", "SELECT source, count(*) AS n FROM documents GROUP BY 1 ORDER BY n DESC, source LIMIT 7")
def _(t):
    return profile.value_counts(t.documents, "source", 7)


@query(
    "rate_by_group",
    f"SELECT pub_year, count(*) AS total, CAST(sum(label) AS BIGINT) AS positives, round(sum(label) * 100.0 / count(*), 1) AS hit_rate FROM ({BOOKS}) GROUP BY 1",
)
def _(t):
    return profile.rate_by_group(books(t), "pub_year", "label", "pub_year")


_TAGGED = """SELECT o_orderkey, unnest(string_split(p_name, ' ')) AS tag, CAST(o_orderstatus = 'F' AS INT) AS y, CAST(o_totalprice > 250000 AS INT) AS z
 FROM lineitem JOIN part ON p_partkey = l_partkey JOIN orders ON o_orderkey = l_orderkey"""


def _tagged(t):
    tags = t.lineitem.join(t.part, F.col("p_partkey") == F.col("l_partkey")).select(
        "l_orderkey", F.split("p_name", " ").alias("tags")
    )
    return t.orders.join(tags, F.col("o_orderkey") == F.col("l_orderkey")).select(
        "o_orderkey", "tags",
        (F.col("o_orderstatus") == "F").cast("int").alias("y"), (F.col("o_totalprice") > 250000).cast("int").alias("z"),
    )


@query(
    "rate_by_tag",
    f"""SELECT tag, count(*) AS total, CAST(sum(y) AS BIGINT) AS positives, round(sum(y) * 100.0 / count(*), 1) AS hit_rate FROM ({_TAGGED}) GROUP BY 1
 HAVING count(*) >= 50 ORDER BY hit_rate DESC, tag LIMIT 15""",
)
def _(t):
    return profile.rate_by_tag(_tagged(t), "tags", "y")


@query(
    "tag_multi_rate",
    f"""WITH r AS (SELECT tag, count(*) AS n_tags FROM (SELECT unnest(list_concat(string_split(p_name, ' '), [string_split(p_name, ' ')[1]])) AS tag FROM part) GROUP BY 1 ORDER BY n_tags DESC, tag LIMIT 20),
 o AS (SELECT tag, count(*) AS n_rows, sum(y) AS y, sum(z) AS z FROM (SELECT unnest(list_distinct(string_split(p_name, ' '))) AS tag, CAST(p_size > 25 AS INT) AS y, CAST(p_retailprice > 1000 AS INT) AS z FROM part) GROUP BY 1)
 SELECT tag, n_tags, n_rows, round(y * 100.0 / n_rows, 1) AS y_rate, round(z * 100.0 / n_rows, 1) AS z_rate FROM r JOIN o USING (tag)""",
)
def _(t):
    tags = F.split("p_name", " ")
    rows = t.part.select(
        F.concat(tags, F.array(F.get(tags, F.lit(0)))).alias("tags"),
        (F.col("p_size") > 25).cast("int").alias("y"), (F.col("p_retailprice") > 1000).cast("int").alias("z"),
    )
    return profile.tag_multi_rate(rows, "tags", ["y", "z"]).withColumns({"n_tags": F.col("n_tags").cast("long"), "n_rows": F.col("n_rows").cast("long")})


_FLAGS = {"is_series": "p_size % 2 = 0", "is_large": "p_size > 30", "is_cheap": "p_retailprice < 1000"}


def _flagged(t):
    return t.part.select(
        *[F.expr(c).alias(k) for k, c in _FLAGS.items()], (F.col("p_partkey") % 3 == 0).cast("int").alias("y"), "p_type"
    )


@query(
    "indicator_rates",
    " UNION ALL ".join(
        f"SELECT '{k}' AS indicator, round(avg(CAST(p_partkey % 3 = 0 AS INT)), 6) AS rate FROM part WHERE {c}" for k, c in _FLAGS.items()
    ),
)
def _(t):
    return rounded(profile.indicator_rates(_flagged(t), list(_FLAGS), "y"), "rate")


@query("group_share", "SELECT p_type, round(avg(CAST(p_size > 30 AS INT)) * 100, 6) AS pct FROM part GROUP BY 1")
def _(t):
    return rounded(profile.group_share(_flagged(t), "p_type", F.col("is_large")), "pct")


_STATUS_YEAR = f"SELECT pub_year, count(*) AS total, CAST(sum(label) AS BIGINT) AS positives, round(sum(label) * 100.0 / count(*), 1) AS hit_rate FROM ({BOOKS}) GROUP BY 1"


@query("flag_groups_outside_band", f"SELECT * FROM ({_STATUS_YEAR}) WHERE hit_rate < 32.5 OR hit_rate > 34.0")
def _(t):
    rates = profile.rate_by_group(books(t), "pub_year", "label", "pub_year")
    return profile.flag_groups_outside_band(rates, 32.5, 34.0)


_SEG = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]


@query(
    "crosstab_norm",
    "SELECT c_nationkey, " + ", ".join(f"round(count(*) FILTER (WHERE c_mktsegment = '{s}') * 100.0 / nullif(count(*), 0), 4) AS pct_{s}" for s in _SEG)
    + " FROM customer WHERE c_mktsegment IN (" + ", ".join(f"'{s}'" for s in _SEG) + ") GROUP BY 1",
)
def _(t):
    return profile.crosstab_norm(t.customer, "c_nationkey", "c_mktsegment", _SEG)


_PIVOT = """WITH d AS (SELECT CAST(unnest(range(1993, 2003)) AS INT) AS pub_year), c AS (SELECT year(o_orderdate) AS pub_year,
 count(*) FILTER (WHERE o_orderstatus = 'F') AS f, count(*) FILTER (WHERE o_orderstatus = 'O') AS o FROM orders GROUP BY 1)
 SELECT d.pub_year, coalesce(f, 0) AS "n_F", coalesce(o, 0) AS "n_O" FROM d LEFT JOIN c USING (pub_year)"""


def _pivot(t):
    rows = t.orders.select(F.year("o_orderdate").alias("pub_year"), "o_orderstatus")
    return profile.pivot_counts(rows, "pub_year", "o_orderstatus", ["F", "O"], range(1993, 2003))


@query("pivot_counts", _PIVOT)
def _(t):
    return _pivot(t)


@query(
    "category_share",
    f'SELECT pub_year, "n_F", "n_O", round("n_F" * 100.0 / nullif("n_F" + "n_O", 0), 1) AS f_share FROM ({_PIVOT})',
)
def _(t):
    return profile.category_share(_pivot(t), "n_F", ["n_F", "n_O"], "f_share")


@query(
    "monthly_distribution",
    """WITH d AS (SELECT CAST(unnest(range(1, 13)) AS INT) AS month), c AS (SELECT month(o_orderdate) AS month, count(*) FILTER (WHERE o_orderstatus <> 'F') AS n_0,
 count(*) FILTER (WHERE o_orderstatus = 'F') AS n_1 FROM orders GROUP BY 1)
 SELECT d.month, coalesce(n_0, 0) AS n_0, coalesce(n_1, 0) AS n_1, round(n_1 * 100.0 / (n_0 + n_1), 1) AS rate FROM d LEFT JOIN c USING (month)""",
)
def _(t):
    rows = t.orders.select(F.month("o_orderdate").alias("month"), (F.col("o_orderstatus") == "F").cast("int").alias("y"))
    return profile.monthly_distribution(rows, "month", "y")


# --- profiles ----------------------------------------------------------------------------------

_GAPPY = f"SELECT p_partkey, raw, CASE WHEN p_partkey % 10 = 0 THEN NULL ELSE p_retailprice END AS price FROM ({MESSY_SQL})"


def _gappy(t):
    return messy_isbn(t).select("p_partkey", "raw", F.when(F.col("p_partkey") % 10 != 0, F.col("p_retailprice")).alias("price"))


@query(
    "missing_profile",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", '{k}' AS type, count(*) - count({c}) AS n_missing, round((count(*) - count({c})) * 100.0 / count(*), 4) AS pct_missing FROM ({_GAPPY})"""
        for c, k in (("p_partkey", "bigint"), ("raw", "string"), ("price", "double"))
    ),
)
def _(t):
    return profile.missing_profile(_gappy(t))


@query(
    "coverage_report",
    f"""WITH g AS ({_GAPPY}), n AS (SELECT count(*) AS n_total FROM g)
 SELECT 'ISBN' AS field, count(*) FILTER (WHERE trim(raw) <> '') AS n_covered, count(*) AS n_total, round(count(*) FILTER (WHERE trim(raw) <> '') * 100.0 / count(*), 1) AS pct FROM g
 UNION ALL SELECT 'Price', count(price), count(*), round(count(price) * 100.0 / count(*), 1) FROM g
 UNION ALL SELECT 'Positive', count(*) FILTER (WHERE p_partkey % 3 = 0), count(*), round(count(*) FILTER (WHERE p_partkey % 3 = 0) * 100.0 / count(*), 1) FROM g
 UNION ALL SELECT 'Tags', count(*) FILTER (WHERE p_partkey % 4 <> 0), count(*), round(count(*) FILTER (WHERE p_partkey % 4 <> 0) * 100.0 / count(*), 1) FROM g""",
)
def _(t):
    rows = _gappy(t).withColumns(
        {
            "y": (F.col("p_partkey") % 3 == 0).cast("int"),
            "tags": F.when(F.col("p_partkey") % 4 != 0, F.array("raw")).otherwise(F.array().cast("array<string>")),
        }
    )
    checks = [("raw", "ISBN"), ("price", "Price"), ("absent", "Absent"), ("y", "Positive"), ("tags", "Tags")]
    return profile.coverage_report(rows, checks, ["y"])


_NUMERIC = ["l_quantity", "l_extendedprice", "l_discount"]
_STATS = ("mean", "std", "min", "p25", "p50", "p75", "max")


def _describe_sql(c: str, name: str) -> str:
    return f"""count({c}) AS "count", round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(CAST(min({c}) AS DOUBLE), 6) AS min,
 round(quantile_cont({c}, 0.25), 6) AS p25, round(quantile_cont({c}, 0.5), 6) AS p50, round(quantile_cont({c}, 0.75), 6) AS p75, round(CAST(max({c}) AS DOUBLE), 6) AS max"""


@query(
    "describe_numeric",
    " UNION ALL ".join(f"""SELECT '{c}' AS "column", {_describe_sql(c, c)} FROM lineitem""" for c in _NUMERIC),
)
def _(t):
    return rounded(profile.describe_numeric(t.lineitem, _NUMERIC), *_STATS)


@query(
    "describe_all",
    f"""SELECT 'l_quantity' AS "column", {_describe_sql('l_quantity', '')}, CAST(NULL AS BIGINT) AS "unique", CAST(NULL AS VARCHAR) AS top, CAST(NULL AS BIGINT) AS freq FROM lineitem
 UNION ALL SELECT 'l_returnflag', sum(n)::BIGINT, NULL, NULL, NULL, NULL, NULL, NULL, NULL, count(*), first(l_returnflag ORDER BY n DESC, l_returnflag), max(n) FROM (SELECT l_returnflag, count(*) AS n FROM lineitem GROUP BY 1)""",
)
def _(t):
    return rounded(profile.describe_all(t.lineitem, ["l_quantity"], ["l_returnflag"]), *_STATS)


@query("describe_by_group", f"SELECT l_returnflag, {_describe_sql('l_extendedprice', '')} FROM lineitem GROUP BY 1")
def _(t):
    return rounded(profile.describe_by_group(t.lineitem, "l_extendedprice", "l_returnflag"), *_STATS)


@query("median_by_group", "SELECT o_orderstatus, round(quantile_cont(o_totalprice, 0.5), 6) AS median FROM orders GROUP BY 1")
def _(t):
    return rounded(profile.median_by_group(t.orders, "o_totalprice", "o_orderstatus"), "median")


_CORR = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "flat"]
_CORR_BASE = "(SELECT l_quantity, l_extendedprice, CASE WHEN l_linenumber = 3 THEN NULL ELSE l_discount END AS l_discount, l_tax, 1.0::DOUBLE AS flat FROM lineitem)"


def _corr_rows(t):
    return t.lineitem.select(
        "l_quantity", "l_extendedprice", F.when(F.col("l_linenumber") != 3, F.col("l_discount")).alias("l_discount"),
        "l_tax", F.lit(1.0).alias("flat"),
    )


def _corr_sql(a: str, b: str) -> str:
    r = "max(NULL::DOUBLE)" if "flat" in (a, b) else f"round(corr({a}, {b}), 6) + 0.0"
    return f"SELECT '{a}' AS a, '{b}' AS b, {r} AS r FROM {_CORR_BASE}"


_MATRIX = " UNION ALL ".join(_corr_sql(a, b) for a, b in itertools.combinations(_CORR, 2))


@query("correlation_matrix", _MATRIX)
def _(t):
    return rounded(profile.correlation_matrix(_corr_rows(t), _CORR), "r")


_PART_NUMBERS = "(SELECT p_partkey, p_size, p_retailprice, p_partkey + 300 * (p_partkey % 7) AS noisy, -p_retailprice AS minus FROM part)"


@query(
    "correlated_pairs",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM {_PART_NUMBERS}"
        for a, b in itertools.combinations(["p_partkey", "p_size", "p_retailprice", "noisy", "minus"], 2)
    ) + ") WHERE abs(r) > 0.52",
)
def _(t):
    noisy = F.col("p_partkey") + 300 * (F.col("p_partkey") % 7)
    rows = t.part.select("p_partkey", "p_size", "p_retailprice", noisy.alias("noisy"), (-F.col("p_retailprice")).alias("minus"))
    return rounded(profile.correlated_pairs(profile.correlation_matrix(rows, rows.columns), 0.52), "r")


@query(
    "target_correlation_rank",
    "SELECT * FROM (" + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, round(abs(corr({c}, CAST(l_returnflag = 'A' AS INT))), 6) AS abs_r FROM lineitem" for c in _NUMERIC
    ) + ") ORDER BY abs_r DESC, feature",
)
def _(t):
    rows = t.lineitem.withColumn("y", (F.col("l_returnflag") == "A").cast("int"))
    return rounded(profile.target_correlation_rank(rows, _NUMERIC, "y"), "abs_r")


# The share of Student's t within -t..t: midpoint sums of its density, scaled by the sum to 60.
_DENSITY = "list_sum(list_transform(range(0, 20000), lambda i: exp(-(n - 1) / 2.0 * ln(1 + pow((i + 0.5) / 20000 * {0}, 2) / (n - 2))))) * {0}"
_CENTRE = f"({_DENSITY.format('least(abs(t), 60)')}) / ({_DENSITY.format('60')})"


@query(
    "pointbiserial",
    " UNION ALL ".join(
        f"""SELECT '{c}' AS feature, round(r, 6) AS r, n, round(t, 5) AS t, round(1 - {_CENTRE}, 6) + 0.0 AS p FROM
 (SELECT r, n, r * sqrt((n - 2) / (1 - r * r)) AS t FROM
  (SELECT corr({c}, CAST(l_returnflag = 'A' AS INT)) AS r, count({c}) AS n FROM lineitem))""" for c in _NUMERIC
    ),
)
def _(t):
    rows = t.lineitem.withColumn("y", (F.col("l_returnflag") == "A").cast("int"))
    out = profile.pointbiserial(rows, "y", _NUMERIC)
    return rounded(rounded(out, "r", "p"), "t", digits=5)


_HIST = """WITH s AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT event_type, least(CAST(floor((value - lo) / ((hi - lo) / 12)) AS INT), 11) AS bin FROM events, s),
 d AS (SELECT event_type, CAST(i AS INT) AS bin FROM (SELECT DISTINCT event_type FROM events), range(0, 12) r(i)), c AS (SELECT event_type, bin, count(*) AS n FROM b GROUP BY 1, 2),
 t AS (SELECT event_type, count(*) AS total FROM events GROUP BY 1)
 SELECT event_type, bin, coalesce(n, 0) AS n, round(lo + bin * ((hi - lo) / 12), 6) AS low, round(lo + (bin + 1) * ((hi - lo) / 12), 6) AS high,
 round(coalesce(n, 0) / (total * ((hi - lo) / 12)), 6) AS density FROM d LEFT JOIN c USING (event_type, bin) JOIN t USING (event_type), s"""


@query("histogram_bins", _HIST)
def _(t):
    out = profile.histogram_bins(t.events, "value", 12, split="event_type", density=True)
    return rounded(out, "low", "high", "density")


@query(
    "boxplot_stats",
    """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS med, quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1)
 SELECT event_type, round(first(q1), 6) AS q1, round(first(med), 6) AS med, round(first(q3), 6) AS q3, min(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_low,
 max(value) FILTER (WHERE value BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) AS whisker_high FROM events JOIN q USING (event_type) GROUP BY 1""",
)
def _(t):
    return rounded(profile.boxplot_stats(t.events, "value", "event_type"), "q1", "med", "q3")


@query(
    "column_sum_shares",
    """WITH s AS (SELECT sum(l_quantity) AS a, sum(l_linenumber)::DOUBLE AS b, sum(l_discount) AS c FROM lineitem)
 SELECT 'l_quantity' AS "column", round(a / (a + b + c), 6) AS share FROM s UNION ALL SELECT 'l_linenumber', round(b / (a + b + c), 6) FROM s UNION ALL SELECT 'l_discount', round(c / (a + b + c), 6) FROM s""",
)
def _(t):
    return rounded(profile.column_sum_shares(t.lineitem, ["l_quantity", "l_linenumber", "l_discount"]), "share")


@query(
    "key_diagnostics",
    "SELECT count(*) AS n_usable, count(DISTINCT (p_name, p_brand)) AS n_unique, count(*) - count(DISTINCT (p_name, p_brand)) AS n_duplicate FROM part WHERE p_partkey % 5 <> 0",
)
def _(t):
    rows = t.part.select(F.when(F.col("p_partkey") % 5 != 0, F.col("p_name")).alias("p_name"), "p_brand")
    return profile.key_diagnostics(rows, ["p_name", "p_brand"])


@query(
    "column_equality_share",
    "SELECT count(*) FILTER (WHERE c_nationkey = c_custkey % 25) AS n_equal, round(avg(CAST(c_nationkey = c_custkey % 25 AS INT)), 6) AS share FROM customer",
)
def _(t):
    rows = t.customer.withColumn("other", F.col("c_custkey") % 25)
    return rounded(profile.column_equality_share(rows, "c_nationkey", "other"), "share")


@query(
    "cutoff_sweep",
    f"""WITH c AS (SELECT CAST(unnest([1996, 1998, 1999, 2000, 2001]) AS INT) AS cutoff)
 SELECT cutoff, count(*) FILTER (WHERE pub_year < cutoff) AS n_train, count(*) FILTER (WHERE pub_year >= cutoff) AS n_test,
 count(*) FILTER (WHERE pub_year >= cutoff AND label = 1) AS test_positives, round(count(*) FILTER (WHERE pub_year >= cutoff AND label = 1) / count(*) FILTER (WHERE pub_year >= cutoff), 6) AS test_rate,
 count(*) FILTER (WHERE pub_year >= cutoff AND label = 1) >= 200 AND count(*) FILTER (WHERE pub_year >= cutoff AND label = 1) / count(*) FILTER (WHERE pub_year >= cutoff) >= 0.05 AS is_valid
 FROM ({BOOKS}), c GROUP BY 1""",
)
def _(t):
    return rounded(profile.cutoff_sweep(books(t), "pub_year", "label", [1996, 1998, 1999, 2000, 2001]), "test_rate")


@query("author_concentration", f"SELECT author, count(*) AS n_positive FROM ({BOOKS}) WHERE label = 1 GROUP BY 1")
def _(t):
    return profile.author_concentration(books(t), "author", "label")


_SHARES = f"""SELECT author, n, round(sum(n) OVER (ORDER BY n DESC, author ROWS UNBOUNDED PRECEDING) * 100.0 / sum(n) OVER (), 1) AS pct
 FROM (SELECT author, count(*) AS n FROM ({BOOKS}) WHERE label = 1 GROUP BY 1)"""


@query(
    "concentration_summary",
    f"SELECT CAST(sum(n) AS BIGINT) AS n_positives, count(*) AS n_authors, count(*) FILTER (WHERE pct <= 25) AS authors_25, count(*) FILTER (WHERE pct <= 50) AS authors_50 FROM ({_SHARES})",
)
def _(t):
    return profile.concentration_summary(books(t), "author", "label")


@query(
    "both_flags_count",
    """SELECT count(*) FILTER (WHERE quality = 1 AND toxic = 1) AS n_both, count(*) FILTER (WHERE quality = 1 AND toxic = 0) AS n_only_a,
 count(*) FILTER (WHERE quality = 0 AND toxic = 1) AS n_only_b, count(*) FILTER (WHERE quality = 0 AND toxic = 0) AS n_neither FROM labels""",
)
def _(t):
    return profile.both_flags_count(t.labels, "quality", "toxic")


_METHOD = "CASE WHEN o_orderpriority LIKE '1%' OR o_orderpriority LIKE '2%' THEN 'fuzzy_title_author' ELSE 'exact_isbn' END"


@query(
    "health_verdict",
    f"""WITH b AS (SELECT *, CASE WHEN label = 0 THEN 'unmatched' ELSE m END AS method, CAST(floor(pub_year / 10.0) * 10 AS INT) AS decade FROM ({BOOKS}) JOIN (SELECT o_orderkey, {_METHOD} AS m FROM orders) ON o_orderkey = gb_id),
 d AS (SELECT round(sum(label) * 100.0 / count(*), 1) AS r FROM b GROUP BY decade), v AS (SELECT (SELECT min(r) FROM d) AS min_rate, (SELECT max(r) FROM d) AS max_rate,
 (SELECT count(*) FROM ({_SHARES}) WHERE pct <= 25) AS authors_25, round(count(*) FILTER (WHERE method = 'fuzzy_title_author') * 100.0 / count(*) FILTER (WHERE label = 1), 6) AS fuzzy_share FROM b)
 SELECT *, max_rate > 3 * min_rate AS decade_skew, authors_25 <= 5 AS author_concentrated, fuzzy_share > 30 AS fuzzy_heavy FROM v""",
)
def _(t):
    method = t.orders.select(F.col("o_orderkey").alias("gb_id"), F.expr(_METHOD).alias("m"))
    b = books(t).join(method, "gb_id").withColumns(
        {"method": F.when(F.col("label") == 0, "unmatched").otherwise(F.col("m")), "decade": pub_decade(F.col("pub_year"))}
    )
    return rounded(profile.health_verdict(b, "decade", "author", "method", "label"), "fuzzy_share")


@query(
    "source_coverage",
    """WITH c AS (SELECT count(*) FILTER (WHERE event_type <> 'error') AS f, count(*) FILTER (WHERE event_type = 'error') AS m FROM events)
 SELECT 'found' AS status, f AS n, round(f / (f + m), 6) AS share FROM c UNION ALL SELECT 'missing', m, round(m / (f + m), 6) FROM c""",
)
def _(t):
    cache = t.events.withColumn("source", F.when(F.col("event_type") == "error", "missing").otherwise(F.col("event_type")))
    return rounded(profile.source_coverage(cache, "source"), "share")


# --- checks ------------------------------------------------------------------------------------


@query("expect_unique", "SELECT p_name, p_brand, count(*) AS n FROM part GROUP BY 1, 2 HAVING count(*) > 1")
def _(t):
    return quality.expect_unique(t.part, ["p_name", "p_brand"])


@query(
    "expect_row_count",
    "SELECT (SELECT count(*) FROM orders) AS n_before, (SELECT count(*) FROM lineitem JOIN orders ON l_orderkey = o_orderkey) AS n_after",
)
def _(t):
    joined = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return quality.expect_row_count(t.orders, joined)


@query("expect_label_domain", "SELECT label, count(*) AS n FROM (SELECT CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN 2 ELSE 1 END AS label FROM events) WHERE label IS NULL OR label NOT IN (0, 1) GROUP BY 1")
def _(t):
    label = F.when(F.col("event_type") == "view", 2).when(F.col("event_type") != "error", 1)
    return quality.expect_label_domain(t.events.select(label.alias("label")), "label")


@query("expect_min_positives", "SELECT count(*) AS n_positive FROM labels WHERE toxic = 1 HAVING count(*) < 1000000")
def _(t):
    return quality.expect_min_positives(t.labels, "toxic", 1000000)


@query(
    "expect_equal_counts",
    "SELECT 'documents' AS variant, count(*) AS n FROM documents UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'embeddings', count(*) FROM embeddings",
)
def _(t):
    return quality.expect_equal_counts({"documents": t.documents, "labels": t.labels, "embeddings": t.embeddings})


@query(
    "expect_debut_zero",
    """SELECT o_custkey, o_orderkey, prior FROM (SELECT *, o_custkey % 3 AS prior, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS rn FROM orders) WHERE rn = 1 AND prior > 0""",
)
def _(t):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate", (F.col("o_custkey") % 3).alias("prior"))
    return quality.expect_debut_zero(rows, "o_custkey", "o_orderdate", "prior", "o_orderkey").drop("o_orderdate")




@query(
    "checked_write",
    """SELECT count(*) AS n_rows, CAST(0 AS BIGINT) AS n_bad_labels, count(*) FILTER (o_orderstatus = 'F') AS n_positive,
 CAST(sum(o_totalprice) AS DECIMAL(38, 2)) AS written FROM orders""",
)
def _(t):
    """Orders with their customers, labelled, written once; the checks' numbers come from that write."""
    label = (F.col("o_orderstatus") == "F").cast("int")
    rows = t.orders.withColumn("label", label).join(t.customer, F.col("o_custkey") == F.col("c_custkey"), "left")
    checks = [quality.keeps_keys(t.orders, ["o_orderkey"]), quality.label_domain("label"), quality.min_positives("label", 10)]
    out, numbers = quality.checked_write(rows.select("o_orderkey", "o_totalprice", "label"), "checked-orders", checks)
    seen = [F.lit(numbers[n]).cast("long").alias(n) for n in ("n_rows", "n_bad_labels", "n_positive")]
    return out.agg(F.sum(F.col("o_totalprice").cast("decimal(20,2)")).cast("decimal(38,2)").alias("written")).select(*seen, "written")
