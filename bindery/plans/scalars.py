"""Queries for the scalar functions."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindery.functions import dates, isbn, numbers, text, unicode
from bindery.operators.projection import top_n_dummies
from bindery.plans.registry import MESSY_SQL, TITLE, messy_isbn, query, r6

# --- identifiers: the oracle works on the lists of digits -----------------------------------


def _clean(x: str) -> str:
    return (
        f"(CASE WHEN lower(trim({x})) IN ('','nan','none','null','na','n/a','<na>') THEN NULL "
        f"ELSE regexp_replace(trim({x}), '^(\\d+)\\.0$', '\\1') END)"
    )


def _digits_x(x: str) -> str:
    return f"regexp_replace(upper({x}), '[^0-9X]', '', 'g')"


def _sum(s: str, n: int, weight: str) -> str:
    return f"list_sum(list_transform(range(1, {n + 1}), lambda i: ({weight}) * TRY_CAST(substr({s}, i, 1) AS INT)))"


def _check10(s: str) -> str:
    v = f"((11 - {_sum(s, 9, '11 - i')} % 11) % 11)"
    return f"(CASE WHEN {v} = 10 THEN 'X' ELSE CAST({v} AS VARCHAR) END)"


def _check13(s: str) -> str:
    return f"CAST((10 - {_sum(s, 12, 'CASE WHEN i % 2 = 1 THEN 1 ELSE 3 END')} % 10) % 10 AS VARCHAR)"


def _valid10(s: str) -> str:
    return (
        f"coalesce(CASE WHEN regexp_full_match({s}, '[0-9]{{9}}[0-9X]') "
        f"THEN {_check10(s)} = substr({s}, 10, 1) END, false)"
    )


def _valid13(s: str) -> str:
    return (
        f"coalesce(CASE WHEN regexp_full_match({s}, '[0-9]{{13}}') "
        f"THEN {_check13(s)} = substr({s}, 13, 1) END, false)"
    )


def _to13(s: str) -> str:
    return f"('978' || substr({s}, 1, 9) || {_check13(f'''('978' || substr({s}, 1, 9))''')})"


def _pad10(s: str) -> str:
    return f"(CASE WHEN length({s}) BETWEEN 1 AND 9 THEN lpad({s}, 10, '0') ELSE {s} END)"


def _isbn_sql(steps: str, out: str) -> str:
    """The messy ISBNs, a chain of derived columns, and the output columns."""
    return f"WITH m AS ({MESSY_SQL}), {steps} SELECT p_partkey, {out}"


_M_S = f"s1 AS (SELECT *, {_digits_x(_clean('raw'))} AS s FROM m)"
_M_LOOSE = f"s1 AS (SELECT *, {_digits_x('split_part(trim(raw), chr(46), 1)')} AS s FROM m)"
_CLEAN10 = (
    f"{_M_S}, s2 AS (SELECT *, CASE WHEN {_valid10('s')} THEN s WHEN length(s) BETWEEN 1 AND 9 "
    f"AND {_valid10(_pad10('s'))} THEN {_pad10('s')} END AS clean10 FROM s1)"
)


def _isbn_query(name: str, expr, sql: str):
    @query(name, sql)
    def run(t):
        cols = expr(F.col("raw"))
        cols = cols if isinstance(cols, dict) else {name: cols}
        return messy_isbn(t).select("p_partkey", *[c.alias(k) for k, c in cols.items()])


_isbn_query(
    "norm_isbn13_loose", isbn.norm_isbn13_loose,
    _isbn_sql(_M_LOOSE, "CASE WHEN length(s) = 13 THEN s END AS norm_isbn13_loose FROM s1"),
)
_isbn_query(
    "norm_isbn10_loose", isbn.norm_isbn10_loose,
    _isbn_sql(_M_LOOSE, "CASE WHEN length(s) <= 10 THEN lpad(s, 10, '0') END AS norm_isbn10_loose FROM s1"),
)
_isbn_query(
    "isbn10_to_13_loose", lambda c: isbn.isbn10_to_13_loose(isbn.norm_isbn10_loose(c)),
    _isbn_sql(
        f"{_M_LOOSE}, s2 AS (SELECT *, CASE WHEN length(s) <= 10 THEN lpad(s, 10, '0') END AS t FROM s1)",
        f"CASE WHEN regexp_matches(t, '^[0-9]{{9}}') THEN {_to13('t')} END AS isbn10_to_13_loose FROM s2",
    ),
)
_isbn_query(
    "oclc_isbn_loose", isbn.oclc_isbn_loose,
    _isbn_sql(
        f"s1 AS (SELECT *, {_digits_x('raw')} AS s FROM m)",
        f"CASE WHEN length(s) = 13 THEN s WHEN length(s) = 10 AND regexp_matches(s, '^[0-9]{{9}}') "
        f"THEN {_to13('s')} END AS oclc_isbn_loose FROM s1",
    ),
)
_isbn_query(
    "clean_isbn13_len", isbn.clean_isbn13_len,
    _isbn_sql(
        "s1 AS (SELECT *, regexp_replace(regexp_replace(trim(raw), '\\.0$', ''), '[^0-9]', '', 'g') AS s FROM m)",
        "CASE WHEN length(s) = 13 THEN s END AS clean_isbn13_len FROM s1",
    ),
)
_isbn_query(
    "split_mixed_isbn", lambda c: dict(zip(("isbn10", "isbn13"), isbn.split_mixed_isbn(c))),
    _isbn_sql(
        f"s1 AS (SELECT *, {_digits_x('split_part(raw, chr(46), 1)')} AS s FROM m)",
        f"CASE WHEN length(s) = 10 THEN s END AS isbn10, CASE WHEN length(s) = 13 THEN s WHEN length(s) = 10 "
        f"AND regexp_matches(s, '^[0-9]{{9}}') THEN {_to13('s')} END AS isbn13 FROM s1",
    ),
)
_isbn_query(
    "is_valid_isbn10", isbn.is_valid_isbn10,
    _isbn_sql(_M_S, f"{_valid10('s')} AS is_valid_isbn10 FROM s1"),
)
_M_13 = f"s1 AS (SELECT *, regexp_replace({_clean('raw')}, '[^0-9]', '', 'g') AS s FROM m)"
_isbn_query(
    "is_valid_isbn13", isbn.is_valid_isbn13,
    _isbn_sql(_M_13, f"{_valid13('s')} AS is_valid_isbn13 FROM s1"),
)
_isbn_query(
    "clean_isbn13_valid", isbn.clean_isbn13_valid,
    _isbn_sql(_M_13, f"CASE WHEN {_valid13('s')} THEN s END AS clean_isbn13_valid FROM s1"),
)
_isbn_query(
    "clean_isbn10_padded", isbn.clean_isbn10_padded,
    _isbn_sql(_CLEAN10, "clean10 AS clean_isbn10_padded FROM s2"),
)
_isbn_query(
    "isbn10_to_13_valid", isbn.isbn10_to_13_valid,
    _isbn_sql(_M_S, f"CASE WHEN {_valid10('s')} THEN {_to13('s')} END AS isbn10_to_13_valid FROM s1"),
)
_isbn_query(
    "build_isbn_key", lambda c: isbn.build_isbn_key(c, c),
    _isbn_sql(
        f"{_CLEAN10}, s3 AS (SELECT *, regexp_replace({_clean('raw')}, '[^0-9]', '', 'g') AS d FROM s2)",
        f"coalesce(CASE WHEN clean10 IS NOT NULL THEN {_to13('clean10')} END, "
        f"CASE WHEN {_valid13('d')} THEN d END) AS build_isbn_key FROM s3",
    ),
)

# Candidates without look-around: split on what is no digit or X, then judge each run.
_RUNS = f"""c0 AS (SELECT *, regexp_replace(upper({_clean('raw')}), '[\\s\\-]', '', 'g') AS u FROM m),
c1 AS (SELECT *, regexp_extract_all(u, '97[89]\\d{{10}}') AS c13,
  list_filter(list_transform(regexp_extract_all(u, '\\d+X?'), lambda r:
    CASE WHEN regexp_full_match(r, '\\d{{1,9}}[\\dX]') THEN r
         WHEN regexp_full_match(r, '\\d{{2,10}}X') THEN substr(r, 1, length(r) - 1) END), lambda r: r IS NOT NULL) AS c10 FROM c0),
c2 AS (SELECT *, CASE WHEN c13 IS NULL THEN [] ELSE list_concat(c13, list_filter(c10, lambda r: NOT list_contains(c13, r))) END AS cand FROM c1)"""
_isbn_query(
    "extract_isbn_candidates", lambda c: {"candidates": F.array_join(isbn.extract_isbn_candidates(c), "|")},
    _isbn_sql(_RUNS, "coalesce(array_to_string(cand, '|'), '') AS candidates FROM c2"),
)
_isbn_query(
    "oclc_to_isbn13", isbn.oclc_to_isbn13,
    _isbn_sql(
        f"{_RUNS}, u1 AS (SELECT p_partkey, unnest(cand) AS x, unnest(range(1, len(cand) + 1)) AS pos FROM c2), "
        f"u2 AS (SELECT *, CASE WHEN {_valid13('x')} THEN x WHEN {_valid10(_pad10('x'))} THEN {_to13(_pad10('x'))} END AS k FROM u1), "
        "u3 AS (SELECT p_partkey, arg_min(k, pos) AS k FROM u2 WHERE k IS NOT NULL GROUP BY 1)",
        "k AS oclc_to_isbn13 FROM m LEFT JOIN u3 USING (p_partkey)",
    ),
)


@query("isbn10_check_digit", f"SELECT p_partkey, {_check10('b')} AS digit FROM ({MESSY_SQL})")
def _(t):
    return messy_isbn(t).select("p_partkey", isbn.isbn10_check_digit(F.col("b")).alias("digit"))


@query("isbn13_check_digit", f"SELECT p_partkey, {_check13("('978' || b)")} AS digit FROM ({MESSY_SQL})")
def _(t):
    return messy_isbn(t).select("p_partkey", isbn.isbn13_check_digit(F.concat(F.lit("978"), "b")).alias("digit"))


# --- text --------------------------------------------------------------------------------------

_MARKS = """case p_partkey % 9 when 0 then ' NaN ' when 1 then 'n/a' when 2 then '' when 3 then cast(p_partkey as string) || '.0'
 when 4 then '<NA>' when 5 then null when 6 then '  none' else ' ' || p_name || ' ' end"""


@query("clean_missing_text", f"SELECT p_partkey, {_clean('x')} AS cleaned FROM (SELECT p_partkey, {_MARKS} AS x FROM part)")
def _(t):
    marked = t.part.selectExpr("p_partkey", f"{_MARKS} as x")
    return marked.select("p_partkey", text.clean_missing_text(F.col("x")).alias("cleaned"))


_PLAIN = "regexp_replace(strip_accents(lower(text)), '[^\\p{L}\\p{N}_\\s]', ' ', 'g')"
_NORM_AUTHOR = f"trim(regexp_replace({_PLAIN}, '\\s+', ' ', 'g'))"
_NORM_ASCII = (
    "regexp_replace(regexp_replace(regexp_replace(lower(text), '^\\s+|\\s+$', '', 'g'), "
    "'[^a-z0-9\\s]', '', 'g'), '\\s+', ' ', 'g')"
)
_NFKD = (
    "trim(regexp_replace(regexp_replace(regexp_replace(lower(regexp_replace(strip_accents(text), "
    "'[^\\x00-\\x7F]', '', 'g')), '^the ', ''), '^a ', ''), '^an ', ''))"
)


def _doc_query(name: str, expr, sql: str, out: str | None = None):
    out = out or name

    @query(name, f"SELECT doc_id, {sql} AS {out} FROM documents")
    def run(t):
        return t.documents.select("doc_id", expr(F.col("text")).alias(out))


_doc_query("norm_text_ascii", text.norm_text_ascii, _NORM_ASCII)
_doc_query("clean_author_name", text.clean_author_name, f"trim({_NORM_ASCII})")
_doc_query("norm_author", text.norm_author, _NORM_AUTHOR)
_doc_query("norm_title", text.norm_title, f"regexp_replace({_NORM_AUTHOR}, '^(the|a|an)\\s+', '')")
_doc_query("strip_diacritics", unicode.strip_diacritics, "strip_accents(text)")
_doc_query("description_word_count", text.word_count, "CAST(len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) AS INT)")
_doc_query("has_description", text.has_description, "len(list_filter(regexp_split_to_array(text, '\\s+'), lambda w: w <> '')) > 10")


@query("norm_title_nfkd", f"SELECT page_id, {_NFKD} AS norm_title_nfkd FROM (SELECT page_id, url || ' ' || html AS text FROM pages)")
def _(t):
    joined = t.pages.select("page_id", F.concat_ws(" ", "url", "html").alias("text"))
    return joined.select("page_id", text.norm_title_nfkd(F.col("text")).alias("norm_title_nfkd"))


_BLURB = """text || case doc_id % 5 when 0 then ' A New York Times Bestseller.' when 1 then ' AWARD-WINNING! superbestsellers'
 when 2 then ' (national bestseller) best seller' else '' end"""


@query(
    "scrub_accolades",
    f"SELECT doc_id, regexp_replace(x, '\\b(new york times|bestseller|best seller|award-winning|award winning|national bestseller)\\b', '', 'gi') "
    f"AS scrubbed FROM (SELECT doc_id, {_BLURB} AS x FROM documents)",
)
def _(t):
    blurbs = t.documents.selectExpr("doc_id", f"{_BLURB} as x")
    return blurbs.select("doc_id", text.scrub_accolades(F.col("x")).alias("scrubbed"))


@query(
    "first_author_key",
    "SELECT p_partkey, CASE WHEN p_partkey % 6 = 0 THEN '' ELSE lower(split_part(p_name, ' ', 1)) END AS author_key FROM part",
)
def _(t):
    names = F.when(F.col("p_partkey") % 6 == 0, F.array().cast("array<string>")).otherwise(
        F.split(F.concat(F.upper("p_name"), F.lit(" Sr.")), " ")
    )
    return t.part.select("p_partkey", text.first_author_key(names).alias("author_key"))


_LITERAL = """case p_partkey % 6 when 0 then '[' when 1 then null when 2 then '[]' when 3 then p_name
 when 4 then '["' || p_name || '''s", ''' || p_type || ''']' else '[''' || p_name || ''', ''' || p_type || ''']' end"""
_ITEMS = """case p_partkey % 6 when 4 then p_name || '''s|' || p_type when 5 then p_name || '|' || p_type else '' end"""


@query(
    "parse_str_list",
    f"SELECT p_partkey, {_ITEMS} AS items, CASE p_partkey % 6 WHEN 0 THEN '[' WHEN 3 THEN p_name ELSE {_ITEMS} END AS items_or_text, "
    f"CAST(CASE WHEN p_partkey % 6 IN (4, 5) THEN 2 ELSE 0 END AS INT) AS n_items FROM part",
)
def _(t):
    raw = t.part.selectExpr("p_partkey", f"{_LITERAL} as raw")
    items = text.parse_str_list(F.col("raw"))
    return raw.select(
        "p_partkey",
        F.array_join(items, "|").alias("items"),
        F.array_join(text.parse_str_list(F.col("raw"), "single"), "|").alias("items_or_text"),
        text.list_size(items).alias("n_items"),
    )


@query(
    "list_size",
    "SELECT o_orderkey, CAST(coalesce(n, 0) AS INT) AS num_credits, coalesce(n, 0) > 1 AS has_multiple_credits FROM orders "
    "LEFT JOIN (SELECT l_orderkey, count(DISTINCT l_suppkey) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey",
)
def _(t):
    credits = t.lineitem.groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("credits"))
    rows = t.orders.join(credits, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    n = text.list_size(F.col("credits"))
    return rows.select("o_orderkey", n.alias("num_credits"), (n > 1).alias("has_multiple_credits"))


_CORE = "trim(split_part(coalesce(title, ''), '(', 1))"


@query(
    "title_features",
    f"""SELECT p_partkey, CAST(len(list_filter(string_split_regex({_CORE}, '\\s+'), lambda w: w <> '')) AS INT) AS title_word_count,
 CAST(length({_CORE}) AS INT) AS title_char_count, contains({_CORE}, ':') AS has_subtitle,
 regexp_matches(coalesce(title, ''), '#\\d+') AS is_series FROM (SELECT p_partkey, {TITLE} AS title FROM part)""",
)
def _(t):
    titled = t.part.selectExpr("p_partkey", f"{TITLE} as title")
    return titled.select("p_partkey", *[c.alias(k) for k, c in text.title_features(F.col("title")).items()])


# --- numbers and dates -------------------------------------------------------------------------


@query("log_pages", "SELECT p_partkey, round(ln(1 + CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size END), 6) AS log_pages FROM part")
def _(t):
    pages = F.when(F.col("p_size") % 7 != 0, F.col("p_size"))
    return t.part.select("p_partkey", r6(numbers.log_pages(pages)).alias("log_pages"))


@query(
    "pub_decade",
    "SELECT o_orderkey, CAST(floor(y / 10.0) * 10 AS INT) AS pub_decade FROM "
    "(SELECT o_orderkey, year(o_orderdate) - CASE WHEN o_orderkey % 3 = 0 THEN 2003 ELSE 0 END AS y FROM orders)",
)
def _(t):
    year = F.year("o_orderdate") - F.when(F.col("o_orderkey") % 3 == 0, 2003).otherwise(0)
    return t.orders.select("o_orderkey", numbers.pub_decade(year).alias("pub_decade"))


@query("round_dp", "SELECT event_id, round(value, 1) AS rounded FROM events")
def _(t):
    return t.events.select("event_id", numbers.round_dp(F.col("value"), 1).alias("rounded"))


@query("log10p1", "SELECT event_id, round(log10(value + 1), 6) AS logged FROM events")
def _(t):
    return t.events.select("event_id", r6(numbers.log10p1(F.col("value"))).alias("logged"))


_MONTHS = ", ".join(f"CAST(m = {i} AS INT) AS pub_month_{i}" for i in range(1, 13))


@query(
    "pub_month",
    f"""SELECT o_orderkey, m AS pub_month, CAST(m = 0 AS INT) AS pub_month_missing, {_MONTHS} FROM
 (SELECT o_orderkey, CAST(CASE WHEN o_orderkey % 8 IN (4, 5, 6) THEN 0 ELSE month(o_orderdate) END AS INT) AS m FROM orders)""",
)
def _(t):
    d = F.col("o_orderdate")
    day = F.dayofmonth(d)
    nth = F.when(day.isin(1, 21, 31), "st").when(day.isin(2, 22), "nd").when(day.isin(3, 23), "rd").otherwise("th")
    kind = F.col("o_orderkey") % 8
    raw = (
        F.when(kind == 0, F.date_format(d, "MM/dd/yy"))
        .when(kind == 1, F.concat(F.date_format(d, "MMMM d"), nth, F.date_format(d, " yyyy")))
        .when(kind == 2, F.date_format(d, "MMMM yyyy"))
        .when(kind == 3, F.concat(F.lit("('"), F.month(d).cast("string"), F.lit("', '1', '"), F.year(d).cast("string"), F.lit("')")))
        .when(kind == 4, F.year(d).cast("string"))
        .when(kind == 6, F.concat(F.lit("(None, None, '"), F.year(d).cast("string"), F.lit("')")))
        .when(kind == 7, F.date_format(d, "yyyy-MM-dd"))
    )
    rows = t.orders.select("o_orderkey", raw.alias("raw"))
    return rows.select("o_orderkey", *[c.alias(k) for k, c in dates.pub_month_features(F.col("raw")).items()])


@query(
    "top_n_dummies",
    """WITH w AS (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part),
 v AS (SELECT w FROM w GROUP BY 1 ORDER BY count(*) DESC, w LIMIT 6)
 SELECT p.p_partkey, v.w AS tag, list_contains(string_split(p.p_name, ' '), v.w) AS has_tag FROM part p CROSS JOIN v""",
)
def _(t):
    rows = t.part.select("p_partkey", F.split("p_name", " ").alias("tags"))
    flags = top_n_dummies(rows, "tags", 6, "tag_")
    wide = rows.select("p_partkey", *[c.alias(k) for k, c in flags.items()])
    return wide.unpivot(["p_partkey"], list(flags), "tag", "has_tag").withColumn("tag", F.regexp_replace("tag", "^tag_", ""))
