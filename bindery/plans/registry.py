"""Registry of runnable queries over the star-schema tables, each with its SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Tables:
    """The Parquet tables of one folder, as attributes."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register a function of :class:`Tables` under a name, with its equivalent SQL."""

    def register(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, folder: fn(Tables(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def r6(c: Column | str, digits: int = 6) -> Column:
    """Rounded, with -0.0 as 0.0, so that both engines print the same value."""
    return F.round(F.col(c) if isinstance(c, str) else c, digits) + F.lit(0.0)


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r6(c, digits) for c in columns})


# --- text of the stand-in inputs, valid in both SQL dialects ---------------------------------

# A nine-digit body per part, and the same number mod-11 weighted.
BODY = "lpad(cast((p_partkey * 104729 + 12345) % 1000000000 as string), 9, '0')"
_SUM10 = " + ".join(f"{10 - i} * cast(substr(b, {i + 1}, 1) as int)" for i in range(9))
_SUM13 = "9 + 7 * 3 + 8 + " + " + ".join(
    f"{3 if i % 2 == 0 else 1} * cast(substr(b, {i + 1}, 1) as int)" for i in range(9)
)
CHECK10 = f"substr('0123456789X', (11 - ({_SUM10}) % 11) % 11 + 1, 1)"
CHECK13 = f"cast((10 - ({_SUM13}) % 10) % 10 as string)"

# An ISBN field as messy as the real ones: broken check digits, hyphens, dropped zeros, '.0', suffixes.
MESSY = f"""case p_partkey % 9
  when 0 then b || {CHECK10}
  when 1 then b || '5'
  when 2 then substr(b, 1, 1) || '-' || substr(b, 2, 3) || '-' || substr(b, 5) || '-' || {CHECK10}
  when 3 then cast(cast(b as bigint) as string) || {CHECK10}
  when 4 then '978' || b || {CHECK13}
  when 5 then '978' || b || {CHECK13} || '.0'
  when 6 then b || {CHECK10} || ' : HRD'
  when 7 then '978' || b || '7'
  else case p_partkey % 4 when 0 then null when 1 then 'n/a' when 2 then '  ' else lower(b || {CHECK10}) || '.0' end
end"""

# A title with series marks, subtitles and multi-volume sets.
TITLE = """case p_partkey % 7
  when 0 then p_name || ' (Series, #' || cast(p_size as string) || ')'
  when 1 then 'The ' || p_name || ': a tale'
  when 2 then p_name || ' Boxed Set (#1-' || cast(p_size as string) || ')'
  when 3 then ' ' || upper(p_name) || '!  complete  collection '
  when 4 then null
  else p_name
end"""


def messy_isbn(t: Tables) -> DataFrame:
    bodies = t.part.selectExpr("*", f"{BODY} as b")
    return bodies.selectExpr("p_partkey", "p_name", "p_retailprice", "b", f"{MESSY} as raw")


MESSY_SQL = f"SELECT p_partkey, p_name, p_retailprice, b, {MESSY} AS raw FROM (SELECT *, {BODY} AS b FROM part)"


# The catalogue role played by orders: author = customer, year = order year, label = status 'F'.
def books(t: Tables) -> DataFrame:
    return t.orders.select(
        F.col("o_orderkey").alias("gb_id"),
        F.col("o_custkey").alias("author"),
        F.year("o_orderdate").alias("pub_year"),
        (F.col("o_orderstatus") == "F").cast("int").alias("label"),
    )


BOOKS = (
    "SELECT o_orderkey AS gb_id, o_custkey AS author, CAST(year(o_orderdate) AS INT) AS pub_year, "
    "CAST(o_orderstatus = 'F' AS INT) AS label FROM orders"
)
