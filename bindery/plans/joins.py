"""Queries for linkage: exact joins, cascades, patches, and the fuzzy joins."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from bindery.functions.isbn import norm_isbn10_loose, norm_isbn13_loose
from bindery.functions.text import norm_author, norm_text_ascii, norm_title
from bindery.operators import fuzzy, keyed, linkage, projection
from bindery.operators.history import author_cells, rank_features
from bindery.plans.registry import BOOKS, MESSY_SQL, books, messy_isbn, query, r6
from bindery.session import scratch_path

_LOOSE = "regexp_replace(upper(split_part(trim({c}), '.', 1)), '[^0-9X]', '', 'g')"


def _loose10(c: str) -> str:
    s = _LOOSE.format(c=c)
    return f"CASE WHEN length({s}) <= 10 THEN lpad({s}, 10, '0') END"


def _loose13(c: str) -> str:
    s = _LOOSE.format(c=c)
    return f"CASE WHEN length({s}) = 13 THEN {s} END"


# The right side: the ISBN of the even part of each pair, so every key occurs twice.
def _right(t):
    m = messy_isbn(t)
    even = m.select((F.col("p_partkey")).alias("_even"), F.col("b").alias("_b"))
    pairs = t.part.select("p_partkey", "p_name", (F.col("p_partkey") - F.col("p_partkey") % 2).alias("_even"))
    out = pairs.join(even, "_even").select(
        F.col("p_partkey").alias("r_key"), "p_name", "_b", F.concat(F.lit("S"), "p_partkey").alias("shop_id")
    )
    thirteen = F.concat(F.lit("978-"), F.substring("_b", 1, 9), F.lit("7"))
    return out.withColumns({"isbn10": F.concat(F.col("_b"), F.lit("5")), "isbn13": thirteen})


_RIGHT = f"""r AS (SELECT p.p_partkey AS r_key, p.p_name, m.b || '5' AS isbn10, '978-' || m.b || '7' AS isbn13, 'S' || p.p_partkey AS shop_id
 FROM part p JOIN ({MESSY_SQL}) m ON m.p_partkey = p.p_partkey - p.p_partkey % 2)"""


def _isbn_join_sql(key: str, column: str) -> str:
    return f"""WITH m AS (SELECT *, {key.format('raw')} AS k FROM ({MESSY_SQL})), {_RIGHT},
 d AS (SELECT k, arg_min(p_name, r_key) AS p_name, min(r_key) AS r_key FROM (SELECT *, {key.format(column)} AS k FROM r) WHERE k IS NOT NULL GROUP BY k)
 SELECT m.p_partkey, m.p_name, d.p_name AS p_name_right, d.r_key FROM m LEFT JOIN d USING (k)"""


@query("join_isbn10", _isbn_join_sql(_loose10("{0}"), "isbn10"))
def _(t):
    base = messy_isbn(t).select("p_partkey", "p_name", "raw")
    out = linkage.join_isbn10(
        base, _right(t), "raw", "isbn10", ["p_name", "r_key"], [F.asc("r_key")], row_id=["p_partkey"]
    )
    return out.drop("raw")


@query("join_isbn13", _isbn_join_sql(_loose13("{0}"), "isbn13"))
def _(t):
    base = messy_isbn(t).select("p_partkey", "p_name", "raw")
    out = linkage.join_isbn13(
        base, _right(t), "raw", "isbn13", ["p_name", "r_key"], [F.asc("r_key")], row_id=["p_partkey"]
    )
    return out.drop("raw")


# Titles on both sides differ in case, articles and punctuation; the author is one word.
def _title_base(t):
    return t.part.select(
        "p_partkey", F.concat(F.lit("The "), F.initcap("p_name"), F.lit("!")).alias("title"),
        F.array(F.concat(F.col("p_brand"), F.lit("."))).alias("authors"), (F.col("p_size") + 1960).alias("year"),
    )


def _title_right(t):
    kept = t.part.filter("p_size <= 20")
    return kept.select(
        F.upper("p_name").alias("r_title"), F.lower("p_brand").alias("r_author"), F.col("p_partkey").alias("r_key"),
        F.when(F.col("p_size") % 4 != 0, F.col("p_size") + 1975).alias("r_year"),
    )


_TITLE_JOIN = """WITH r AS (SELECT p_name, p_brand, arg_min(p_partkey, p_partkey) AS r_key,
 arg_min(coalesce(CASE WHEN p_size % 4 <> 0 THEN p_size + 1975 END, -1), p_partkey) AS y FROM part WHERE p_size <= 20 GROUP BY 1, 2)
 SELECT p.p_partkey, {key} AS r_key FROM part p LEFT JOIN r ON r.p_name = p.p_name AND r.p_brand = p.p_brand"""


@query("join_title_author", _TITLE_JOIN.replace("{key}", "r.r_key"))
def _(t):
    out = linkage.join_title_author(
        _title_base(t), _title_right(t), "title", "authors", "r_title", "r_author", ["r_key"], [F.asc("r_key")],
        row_id=["p_partkey"],
    )
    return out.select("p_partkey", "r_key")


@query(
    "join_title_author_year",
    _TITLE_JOIN.replace("{key}", "CASE WHEN r.y = -1 OR abs(r.y - (p.p_size + 1960)) <= 5 THEN r.r_key END"),
)
def _(t):
    out = linkage.join_title_author(
        _title_base(t), _title_right(t), "title", "authors", "r_title", "r_author", ["r_key"], [F.asc("r_key")],
        year="year", right_year="r_year", tolerance=5, row_id=["p_partkey"],
    )
    return out.select("p_partkey", "r_key")


# Exact pass and patch: orders as books with a customer-like key, labels per key from line items.
def _exact_parts(t):
    base = t.orders.select(
        F.col("o_orderkey").alias("gb_id"),
        F.when(F.col("o_orderkey") % 5 != 0, F.col("o_custkey")).alias("isbn13_key"),
    )
    labels = t.customer.select(
        (F.col("c_custkey") - F.col("c_custkey") % 2).alias("isbn13_key"), F.col("c_custkey").alias("label_id"),
        F.lit(1).alias("label"), (F.col("c_nationkey")).alias("weeks"),
        F.when(F.col("c_custkey") % 3 != 0, F.col("c_custkey") % 17).alias("best_rank"),
    ).withColumn("isbn13_key", F.when(F.col("label_id") % 7 != 0, F.col("isbn13_key")))
    order = [F.desc_nulls_last("weeks"), F.asc_nulls_last("best_rank"), F.asc("label_id")]
    return base, labels, order


_EXACT = """base AS (SELECT o_orderkey AS gb_id, CASE WHEN o_orderkey % 5 <> 0 THEN o_custkey END AS k FROM orders),
 lab AS (SELECT CASE WHEN c_custkey % 7 <> 0 THEN c_custkey - c_custkey % 2 END AS k, c_custkey AS label_id, 1 AS label, c_nationkey AS weeks,
 CASE WHEN c_custkey % 3 <> 0 THEN c_custkey % 17 END AS best_rank FROM customer),
 d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY k ORDER BY weeks DESC NULLS LAST, best_rank NULLS LAST, label_id) AS rn FROM lab WHERE k IS NOT NULL) WHERE rn = 1),
 ex AS (SELECT gb_id, base.k, label_id, label, weeks, best_rank, CASE WHEN label_id IS NULL THEN 'unmatched' ELSE 'exact_isbn' END AS match_method
 FROM base LEFT JOIN d ON d.k = base.k)"""


@query(
    "exact_key_merge",
    f"WITH {_EXACT} SELECT gb_id, k AS isbn13_key, label_id, label, weeks, best_rank, match_method FROM ex",
)
def _(t):
    base, labels, order = _exact_parts(t)
    return linkage.exact_key_merge(base, labels, "isbn13_key", order, ["gb_id"])


@query(
    "anti_consumed_labels",
    f"WITH {_EXACT} SELECT label_id FROM lab WHERE k IS NULL OR k NOT IN (SELECT k FROM ex WHERE match_method = 'exact_isbn')",
)
def _(t):
    base, labels, order = _exact_parts(t)
    merged = linkage.exact_key_merge(base, labels, "isbn13_key", order, ["gb_id"])
    return linkage.anti_consumed_labels(labels, merged, "isbn13_key").select("label_id")


@query(
    "apply_match_patch",
    f"""WITH {_EXACT} SELECT gb_id, CASE WHEN label IS NULL AND p.w IS NOT NULL THEN 1 ELSE label END AS label,
 CASE WHEN label IS NULL AND p.w IS NOT NULL THEN p.w ELSE weeks END AS weeks,
 CASE WHEN label IS NULL AND p.w IS NOT NULL THEN 'fuzzy_title_author' ELSE match_method END AS match_method
 FROM ex LEFT JOIN (SELECT o_orderkey, CAST(o_custkey % 40 AS INT) AS w FROM orders WHERE o_orderstatus = 'F') p ON p.o_orderkey = gb_id""",
)
def _(t):
    base, labels, order = _exact_parts(t)
    merged = linkage.exact_key_merge(base, labels, "isbn13_key", order, ["gb_id"])
    matches = t.orders.filter("o_orderstatus = 'F'").select(
        F.col("o_orderkey").alias("gb_id"), F.lit(1).alias("label"), (F.col("o_custkey") % 40).cast("int").alias("weeks")
    )
    out = linkage.apply_match_patch(merged, matches, "gb_id", ["label", "weeks"], "label")
    return out.select("gb_id", "label", "weeks", "match_method")


_CASCADE = f"""WITH m AS (SELECT *, {_loose10('raw')} AS k10, {_loose13('raw')} AS k13 FROM ({MESSY_SQL}) JOIN (SELECT p_partkey, p_brand FROM part) USING (p_partkey)), {_RIGHT},
 d10 AS (SELECT k, min(r_key) AS r_key FROM (SELECT {_loose10('isbn10')} AS k, r_key FROM r) WHERE k IS NOT NULL GROUP BY k),
 d13 AS (SELECT k, min(r_key) AS r_key FROM (SELECT {_loose13('isbn13')} AS k, r_key FROM r) WHERE k IS NOT NULL GROUP BY k),
 dt AS (SELECT p_name, p_brand, min(r_key) AS r_key FROM r JOIN (SELECT p_partkey, p_brand FROM part) q ON q.p_partkey = r.r_key WHERE r_key % 3 = 0 GROUP BY 1, 2),
 j AS (SELECT m.p_partkey, d10.r_key AS a, d13.r_key AS b, dt.r_key AS c FROM m LEFT JOIN d10 ON d10.k = m.k10 LEFT JOIN d13 ON d13.k = m.k13
 LEFT JOIN dt ON dt.p_name = m.p_name AND dt.p_brand = m.p_brand)
 SELECT p_partkey, coalesce(a, b, c) AS r_key, CASE WHEN a IS NOT NULL THEN 'isbn10' WHEN b IS NOT NULL THEN 'isbn13' WHEN c IS NOT NULL THEN 'title_author' END AS match_pass FROM j"""


def _cascade(t):
    base = messy_isbn(t).select("p_partkey", "raw").join(t.part.select("p_partkey", "p_name", "p_brand"), "p_partkey")
    right = _right(t).join(t.part.select(F.col("p_partkey").alias("r_key"), "p_brand"), "r_key")
    passes = [
        linkage.CascadePass(
            "isbn10", right, lambda: [norm_isbn10_loose(F.col("raw"))], lambda: [norm_isbn10_loose(F.col("isbn10"))]
        ),
        linkage.CascadePass(
            "isbn13", right,
            lambda: [linkage.norm_isbn13_loose(F.col("raw"))], lambda: [linkage.norm_isbn13_loose(F.col("isbn13"))],
        ),
        linkage.CascadePass(
            "title_author", right.filter("r_key % 3 = 0"),
            lambda: [norm_title(F.col("p_name")), norm_author(F.col("p_brand"))],
            lambda: [norm_title(F.col("p_name")), norm_author(F.col("p_brand"))],
        ),
    ]
    return linkage.cascade_join(base, passes, ["r_key"], [F.asc("r_key")], "p_partkey")


@query("cascade_join", _CASCADE)
def _(t):
    return _cascade(t).select("p_partkey", "r_key", "match_pass")


@query(
    "cascade_coverage",
    f"""WITH c AS ({_CASCADE}) SELECT 'isbn10' AS match_pass, count(*) FILTER (WHERE match_pass = 'isbn10') AS n_matched FROM c UNION ALL
 SELECT 'isbn13', count(*) FILTER (WHERE match_pass IN ('isbn10', 'isbn13')) FROM c UNION ALL SELECT 'title_author', count(match_pass) FROM c""",
)
def _(t):
    return linkage.pass_coverage(_cascade(t), ["isbn10", "isbn13", "title_author"])


@query(
    "match_rate",
    "SELECT count(q.k) AS n_matched, count(*) AS n_total, round(count(q.k) / count(*), 6) AS match_share FROM orders "
    "LEFT JOIN (SELECT c_custkey AS k FROM customer WHERE c_nationkey < 9) q ON q.k = o_custkey",
)
def _(t):
    right = t.customer.filter("c_nationkey < 9").select(F.col("c_custkey").alias("o_custkey"), "c_name")
    joined = keyed.lookup_join(t.orders.select("o_orderkey", "o_custkey"), right, ["o_custkey"], row_id=["o_orderkey"])
    return linkage.match_rate(joined, "c_name").withColumn("match_share", r6("match_share"))


@query(
    "best_edition_lookup",
    """WITH e AS (SELECT *, CASE p_type WHEN 'STANDARD' THEN 0 WHEN 'PROMO' THEN 1 WHEN 'MEDIUM' THEN 2 WHEN 'LARGE' THEN 3 ELSE 99 END AS fr FROM part
 WHERE p_partkey IN (SELECT l_partkey FROM lineitem WHERE l_quantity > 45)),
 b AS (SELECT * FROM (SELECT p_name, p_brand, p_partkey AS best, row_number() OVER (PARTITION BY p_name, p_brand ORDER BY fr, p_partkey) AS rn FROM e) WHERE rn = 1)
 SELECT p.p_partkey AS book_id, coalesce(CASE WHEN p.p_partkey % 10 = 0 THEN p.p_partkey END, best) AS asin FROM part p LEFT JOIN b USING (p_name, p_brand)""",
)
def _(t):
    base = t.part.select(
        F.col("p_partkey").alias("book_id"), F.col("p_name").alias("t"), F.col("p_brand").alias("a"),
        F.when(F.col("p_partkey") % 10 == 0, F.col("p_partkey")).alias("asin"),
    )
    available = t.lineitem.filter("l_quantity > 45").select(F.col("l_partkey").alias("p_partkey"))
    ranks = {"STANDARD": 0, "PROMO": 1, "MEDIUM": 2, "LARGE": 3}
    out = linkage.best_edition_lookup(
        base, t.part, available, edition_id="p_partkey", base_id="asin",
        edition_rank=projection.map_dictionary(F.col("p_type"), ranks, 99),
        base_keys=[norm_title(F.col("t")), norm_author(F.col("a"))],
        edition_keys=[norm_title(F.col("p_name")), norm_author(F.col("p_brand"))],
        row_id="book_id",
    )
    return out.select("book_id", "asin")


@query(
    "enrich_by_key",
    """SELECT d.doc_id, CASE WHEN d.doc_id % 3 IN (0, 1) AND b.text IS NOT NULL THEN b.text WHEN d.doc_id % 3 = 0 THEN NULL
 WHEN d.doc_id % 3 = 1 THEN ' ' ELSE d.lang END AS description FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id""",
)
def _(t):
    base = t.documents.select(
        "doc_id", F.when(F.col("doc_id") % 3 == 1, " ").when(F.col("doc_id") % 3 == 2, F.col("lang")).alias("description")
    )
    source = t.benchmark.select(F.col("item_id").alias("doc_id"), F.col("text").alias("other"))
    return linkage.enrich_by_key(base, source, "doc_id", ("description", "other"))


@query(
    "enrich_description_staged",
    """SELECT d.doc_id, coalesce(b.text, CASE WHEN l.quality = 1 THEN d.lang END, CASE WHEN e.label > 3 THEN 'vector' END, '') AS description
 FROM documents d LEFT JOIN benchmark b ON b.item_id = d.doc_id LEFT JOIN labels l USING (doc_id) LEFT JOIN embeddings e ON e.vec_id = d.doc_id""",
)
def _(t):
    docs = t.documents.select("doc_id", "lang")
    first = t.benchmark.select(F.col("item_id").alias("doc_id"), "text")
    second = docs.join(t.labels, "doc_id").select("doc_id", F.when(F.col("quality") == 1, F.col("lang")).otherwise(" ").alias("text"))
    third = t.embeddings.select(F.col("vec_id").alias("doc_id"), F.when(F.col("label") > 3, "vector").alias("text"))
    sources = [(first, "text"), (second, "text"), (third, "text")]
    return linkage.enrich_description_staged(docs.select("doc_id"), "doc_id", "description", sources)


_RANKS = """SELECT user_id, CAST(min(r) AS DOUBLE) AS rank_best, CAST(arg_max(r, ts) AS DOUBLE) AS rank_latest, count(*) AS rank_observations,
 round(avg(CAST(r <= 1000 AS INT)), 6) AS rank_time_in_top1k, round(avg(CAST(r <= 10000 AS INT)), 6) AS rank_time_in_top10k,
 quantile_cont(r, 0.5) AS rank_median FROM (SELECT user_id, ts, CAST(floor(value * 100) AS INT) AS r FROM events) GROUP BY 1"""


def _rank_table(t):
    history = t.events.select("user_id", "ts", F.floor(F.col("value") * 100).cast("int").alias("r"))
    out = rank_features(history, "user_id", "ts", "r")
    return out.withColumns({c: r6(c) for c in ("rank_time_in_top1k", "rank_time_in_top10k")})


@query(
    "attach_rank_features",
    f"SELECT c_custkey, rank_best, rank_median, rank_observations FROM customer LEFT JOIN ({_RANKS}) ON user_id = c_custkey",
)
def _(t):
    features = _rank_table(t).withColumnRenamed("user_id", "c_custkey")
    out = linkage.attach_rank_features(t.customer.select("c_custkey"), features, "c_custkey")
    return out.select("c_custkey", "rank_best", "rank_median", "rank_observations")


@query(
    "adaptation_join",
    """SELECT p.p_partkey, CAST(CASE WHEN m.n IS NULL THEN 0 ELSE 1 END AS INT) AS adapted_to_screen FROM part p LEFT JOIN
 (SELECT p_name, p_brand, count(*) AS n FROM part WHERE p_size > 30 GROUP BY 1, 2) m ON m.p_name = p.p_name AND m.p_brand = p.p_brand""",
)
def _(t):
    movies = t.part.filter("p_size > 30").select(
        F.when(F.col("p_partkey") % 2 == 0, F.upper("p_name")).alias("book_title"),
        F.when(F.col("p_partkey") % 2 == 0, F.lit("x")).otherwise(F.concat(F.lit("A "), "p_name")).alias("movie_title"),
        F.col("p_brand").alias("author"),
    )
    out = linkage.adaptation_join(t.part.select("p_partkey", "p_name", "p_brand"), movies, "p_name", "p_brand", row_id=["p_partkey"])
    return out.select("p_partkey", "adapted_to_screen")


@query("join_features_labels", "SELECT d.doc_id, n_chars, lang, quality, toxic FROM documents d JOIN labels l USING (doc_id)")
def _(t):
    return linkage.join_features_labels(t.documents.select("doc_id", "n_chars", "lang"), t.labels, "doc_id")


@query(
    "lookup_by_composite_key",
    f"""WITH b AS ({BOOKS}), c AS (SELECT author, pub_year, sum(label) AS n FROM b GROUP BY 1, 2),
 p AS (SELECT author, pub_year, CAST(coalesce(sum(n) OVER (PARTITION BY author ORDER BY pub_year ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS prior FROM c)
 SELECT gb_id, coalesce(prior, 0) AS prior FROM b LEFT JOIN p ON p.author = b.author AND p.pub_year = CASE WHEN gb_id % 11 = 0 THEN 1900 ELSE b.pub_year END""",
)
def _(t):
    b = books(t)
    cells = author_cells(b, "author", "pub_year", "label", "gb_id").withColumnRenamed("_prior", "prior")
    asked = b.withColumn("pub_year", F.when(F.col("gb_id") % 11 == 0, 1900).otherwise(F.col("pub_year")))
    out = linkage.lookup_by_composite_key(asked, cells, ["author", "pub_year"], "prior", ["gb_id"])
    return out.select("gb_id", "prior")


@query(
    "incremental_cache",
    """WITH w AS (SELECT DISTINCT user_id FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 2 = 0 AND event_type = 'signup' AND value > 120)),
 a AS (SELECT user_id, CAST(max(event_id) AS VARCHAR) AS v FROM events WHERE event_type = 'error' AND value > 120 GROUP BY 1),
 b AS (SELECT user_id, CAST(min(event_id) AS VARCHAR) AS v FROM events WHERE event_type = 'click' AND value > 100 GROUP BY 1)
 SELECT w.user_id, coalesce(a.v, b.v) AS publisher, CASE WHEN a.v IS NOT NULL THEN 'first' WHEN b.v IS NOT NULL THEN 'second' ELSE 'missing' END AS publisher_source, CAST(1 AS BIGINT) AS times
 FROM w LEFT JOIN a USING (user_id) LEFT JOIN b USING (user_id)""",
)
def _(t):
    """Keys that come in two deliveries; the run over the second one breaks off once, before its first commit."""
    from bindery.streaming.incremental import grow_cache

    e = t.events
    cache = e.filter("event_id % 2 = 0 and event_type = 'signup' and value > 120").select("user_id").distinct()
    first = e.filter("event_type = 'error' and value > 120").groupBy("user_id").agg(F.max("event_id").cast("string").alias("publisher"))
    second = e.filter("event_type = 'click' and value > 100").groupBy("user_id").agg(F.min("event_id").cast("string").alias("publisher"))
    wanted, folder = scratch_path(t.spark, "wanted"), scratch_path(t.spark, "cache")

    def deliver(rest: int) -> None:
        e.filter(F.col("event_id") % 2 == rest).select("user_id").repartition(2).write.mode("append").parquet(wanted)

    def run(flushed=None):
        sources = [("first", first), ("second", second)]
        return grow_cache(
            t.spark, wanted, folder, "user_id", "publisher", sources, known=cache, files_per_batch=2, flushed=flushed
        )

    def lost(number: int) -> None:
        raise ConnectionError(f"lost after batch {number} was written")

    deliver(0)
    run()
    deliver(1)
    try:
        run(lost)
    except StreamingQueryException:
        pass
    rows = run().groupBy("user_id", "publisher", "publisher_source").agg(F.count("*").alias("times"))
    return rows


# --- fuzzy joins -------------------------------------------------------------------------------

# Labels: part names with the words swapped and, for every third size, a letter dropped.
_VARIANT = """case when p_size % 3 = 0 then substr(split_part(p_name, ' ', 2), 1, length(split_part(p_name, ' ', 2)) - 1) || ' ' || split_part(p_name, ' ', 1)
 else split_part(p_name, ' ', 2) || ' ' || split_part(p_name, ' ', 1) end"""

# Common subsequence length by recursion over the letters; distinct pairs only, so it stays small.
_LCS = """list_last(list_reduce(list_prepend(list_resize([]::INT[], length({b}) + 1, 0), list_transform(range(1, length({a}) + 1), lambda i: [i])),
 lambda prev, cur: list_reduce(list_prepend([0], list_transform(range(1, length({b}) + 1), lambda j: [prev[j + 1], prev[j] + CASE WHEN substr({a}, cur[1], 1) = substr({b}, j, 1) THEN 1 ELSE 0 END])),
 lambda acc, x: list_append(acc, CAST(greatest(acc[len(acc)], x[1], x[2]) AS INT)))))"""


def _sorted_words(c: str) -> str:
    return f"array_to_string(list_sort(string_split(lower({c}), ' ')), ' ')"


def _rint(x: str) -> str:
    return f"CAST(round_even({x}, 0) AS INT)"


_FUZZY = f"""WITH b AS (SELECT p_partkey, {_sorted_words('p_name')} AS t, 'brand' || split_part(p_brand, '#', 2) AS a FROM part),
 l AS (SELECT t, a, min(p_partkey) AS label_id FROM (SELECT p_partkey, {_sorted_words(_VARIANT)} AS t, 'the brand' || split_part(p_brand, '#', 2) AS a FROM part WHERE p_size <= 25) GROUP BY 1, 2),
 tp AS (SELECT bt, lt, {_rint('200.0 * ' + _LCS.format(a='bt', b='lt') + ' / (length(bt) + length(lt))')} AS t_score
 FROM (SELECT DISTINCT t AS bt FROM b) CROSS JOIN (SELECT DISTINCT t AS lt FROM l)),
 w AS (SELECT ba, la, unnest(list_concat(list_transform(range(1, length(ba)), lambda i: substr(la, 1, i)), list_transform(range(1, length(la) + 1), lambda i: substr(la, i, length(ba))))) AS part
 FROM (SELECT DISTINCT a AS ba FROM b) CROSS JOIN (SELECT DISTINCT a AS la FROM l)),
 ap AS (SELECT ba, la, max({_rint('200.0 * ' + _LCS.format(a='ba', b='part') + ' / (length(ba) + length(part))')}) AS a_score FROM (SELECT DISTINCT * FROM w) GROUP BY 1, 2),
 c AS (SELECT b.t, b.a, l.label_id, t_score, a_score, 0.7::DOUBLE * t_score + 0.3::DOUBLE * a_score AS s FROM (SELECT DISTINCT t, a FROM b) b JOIN tp ON tp.bt = b.t AND t_score >= 65
 JOIN l ON l.t = tp.lt JOIN ap ON ap.ba = b.a AND ap.la = l.a AND a_score >= 55),
 d AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY t, a ORDER BY s DESC, label_id) AS rn FROM c WHERE s >= 85) WHERE rn = 1)
 SELECT p_partkey, label_id, t_score, a_score, round(s, 6) AS fuzzy_score FROM b JOIN d ON d.t = b.t AND d.a = b.a"""


@query("fuzzy_title_author_join", _FUZZY)
def _(t):
    base = t.part.select(
        "p_partkey", norm_text_ascii(F.col("p_name")).alias("t"), norm_text_ascii(F.col("p_brand")).alias("a")
    )
    labels = t.part.filter("p_size <= 25").select(
        F.col("p_partkey").alias("label_id"), norm_text_ascii(F.expr(_VARIANT)).alias("lt"),
        norm_text_ascii(F.concat(F.lit("The "), "p_brand")).alias("la"),
    )
    out = fuzzy.fuzzy_title_author_join(
        base, labels, base_id="p_partkey", base_title="t", base_author="a",
        label_id="label_id", label_title="lt", label_author="la",
    )
    return out.withColumn("fuzzy_score", r6("fuzzy_score"))


@query("fuzzy_page_titles")
def _(t):
    """Page titles and hosts against the titles of pages of the same tables with vowels dropped."""
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    host = F.regexp_extract("url", "^https?://([^/]+)/", 1)
    base = t.pages.select("page_id", norm_text_ascii(title).alias("t"), norm_text_ascii(host).alias("a"))
    labels = t.pages.select(
        F.col("page_id").alias("label_id"),
        norm_text_ascii(F.regexp_replace(title, "(?<=[a-z]{2})[eo](?=[a-z]{2} )", "")).alias("lt"),
        norm_text_ascii(F.regexp_replace(host, "^(blog|m)[.]", "")).alias("la"),
    )
    return fuzzy.fuzzy_title_author_join(
        base, labels, base_id="page_id", base_title="t", base_author="a",
        label_id="label_id", label_title="lt", label_author="la",
    )


_MOVIE = """case when p_size % 3 = 0 then 'The ' || p_name || 's' when p_size % 3 = 1 then upper(p_name) else substr(p_name, 1, length(p_name) - 1) end"""
# Every ninth film has the ISBN of another book, with hyphens; every fourth book has lost its own.
_MOVIE_ISBN = f"case when p_partkey % 9 = 0 then '978-' || lpad(cast(p_partkey * 7 % 1000 as string), 9, '0') || '-7' end"
_BOOK_ISBN = "case when p_partkey % 4 <> 0 then '978' || lpad(cast(p_partkey % 1000 as string), 9, '0') || '7.0' end"
_MOVIES = f"SELECT p_partkey AS movie_id, {_MOVIE} AS movie, CASE WHEN p_partkey % 6 <> 0 THEN 1950 + p_size END AS my, replace({_MOVIE_ISBN}, '-', '') AS isbn FROM part WHERE p_size > 35"


@query(
    "adaptation_fuzzy_join",
    f"""WITH m AS (SELECT *, regexp_replace(lower(movie), '^the ', '') AS mt FROM ({_MOVIES})),
 b AS (SELECT p_partkey, p_name AS t, CASE WHEN p_partkey % 7 <> 0 THEN 1990 + p_size % 20 END AS y, replace({_BOOK_ISBN}, '.0', '') AS isbn FROM part),
 k AS (SELECT isbn, arg_min(movie, movie_id) AS movie FROM m WHERE isbn IS NOT NULL GROUP BY isbn),
 s AS (SELECT t, mt, jaro_winkler_similarity(t, mt) AS s FROM (SELECT DISTINCT t FROM b) CROSS JOIN (SELECT DISTINCT mt FROM m)),
 c AS (SELECT p_partkey, movie, s, row_number() OVER (PARTITION BY p_partkey ORDER BY s DESC, movie_id) AS rn FROM b JOIN s USING (t) JOIN m USING (mt)
 WHERE s >= 0.9 AND (y IS NULL OR my IS NULL OR abs(y - my) <= 5))
 SELECT b.p_partkey, coalesce(k.movie, c.movie) AS adaptation_title, CAST(CASE WHEN k.movie IS NULL AND c.movie IS NULL THEN 0 ELSE 1 END AS INT) AS adapted_to_screen,
 CASE WHEN k.movie IS NOT NULL THEN 'identifier' WHEN c.s = 1 THEN 'title' WHEN c.s < 1 THEN 'similar_title' ELSE 'unmatched' END AS match_method
 FROM b LEFT JOIN k ON k.isbn = b.isbn LEFT JOIN (SELECT * FROM c WHERE rn = 1) c ON c.p_partkey = b.p_partkey""",
)
def _(t):
    year = F.when(F.col("p_partkey") % 7 != 0, F.lit(1990) + F.col("p_size") % 20)
    b = t.part.select("p_partkey", "p_name", year.alias("y"), F.expr(_BOOK_ISBN).alias("isbn"))
    movies = t.part.filter("p_size > 35").select(
        F.col("p_partkey").alias("movie_id"), F.expr(_MOVIE).alias("movie"),
        F.when(F.col("p_partkey") % 6 != 0, F.lit(1950) + F.col("p_size")).alias("my"),
        F.expr(_MOVIE_ISBN).alias("film_isbn"),
    )
    out = fuzzy.adaptation_fuzzy_join(
        b, movies, book_id="p_partkey", book_title="p_name", book_year="y",
        adaptation_id="movie_id", adaptation_title="movie", adaptation_year="my",
        identifiers=(norm_isbn13_loose(F.col("isbn")), norm_isbn13_loose(F.col("film_isbn"))),
    )
    return out.select("p_partkey", "adaptation_title", "adapted_to_screen", "match_method")
