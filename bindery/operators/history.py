"""Point-in-time history per author, list summaries and rank summaries.

Rows are first combined to one cell per (author, year); only these cells enter a window, so an
author with a third of all rows adds no more than one row per year to it.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.functions.isbn import oclc_isbn_loose
from bindery.operators.keyed import above_share, lookup_join
from bindery.operators.ordered import exact_quantiles
from bindery.session import materialize


def author_cells(df: DataFrame, author: str, year: str, label: str, row_id: str) -> DataFrame:
    """Per (author, year): positives in earlier years, the previous year, and the year's first row."""
    cells = (
        df.filter(F.col(author).isNotNull() & F.col(year).isNotNull())
        .groupBy(author, year)
        .agg(
            F.sum(F.coalesce(F.col(label), F.lit(0))).alias("_pos"),
            F.min(row_id).alias("_first"),
            F.count("*").alias("_n"),
        )
    )
    by_year = Window.partitionBy(author).orderBy(year)
    earlier = by_year.rowsBetween(Window.unboundedPreceding, -1)
    return cells.select(
        author,
        year,
        "_first",
        "_n",
        F.coalesce(F.sum("_pos").over(earlier), F.lit(0)).alias("_prior"),
        F.lag(year).over(by_year).alias("_prev_year"),
    )


def author_history(
    df: DataFrame, author: str, year: str, label: str, row_id: str, strict_gap: bool = False
) -> DataFrame:
    """Add ``author_prior_count``, ``years_since_last_pub`` and ``is_debut``.

    The gap is to the author's previous row in (year, id) order, so a second row of the same year
    has gap 0; with ``strict_gap`` it is the gap to the last earlier year. Rows without an author
    or a year have count 0, no gap, and are debuts.
    """
    cells = author_cells(df, author, year, label, row_id)
    hot = above_share(cells, "_n").select(author, year)
    joined = lookup_join(df, cells.drop("_n"), [author, year], hot=hot, row_id=[row_id])
    to_previous = F.col(year) - F.col("_prev_year")
    gap = to_previous if strict_gap else (
        F.when(F.col(row_id) == F.col("_first"), to_previous).when(F.col("_first").isNotNull(), F.lit(0))
    )
    return (
        joined.withColumn("author_prior_count", F.coalesce("_prior", F.lit(0)).cast("int"))
        .withColumn("years_since_last_pub", gap.cast("double"))
        .withColumn("is_debut", F.col("years_since_last_pub").isNull())
        .drop("_first", "_prior", "_prev_year")
    )


def author_prior_count(df: DataFrame, author: str, year: str, label: str, row_id: str) -> DataFrame:
    return author_history(df, author, year, label, row_id).drop("years_since_last_pub", "is_debut")


def years_since_last(df: DataFrame, author: str, year: str, row_id: str, strict: bool = False) -> DataFrame:
    none = df.withColumn("_label", F.lit(0))
    out = author_history(none, author, year, "_label", row_id, strict)
    return out.drop("_label", "author_prior_count")


def max_author_prior(
    df: DataFrame, authors: str, year: str, label: str, row_id: str, clean: Callable[[Column], Column]
) -> DataFrame:
    """Per row, the largest prior count over its authors; 0 if there is none."""
    single = df.select(
        row_id, F.explode_outer(authors).alias("_name"), F.col(year).alias("_year"), F.col(label).alias("_label")
    ).select(row_id, F.nullif(clean(F.col("_name")), F.lit("")).alias("_author"), "_year", "_label")
    # Read several times below, so the exploding and cleaning is done once.
    single = materialize(single, "authors")
    cells = author_cells(single, "_author", "_year", "_label", row_id)
    hot = above_share(cells, "_n").select("_author", "_year")
    prior = cells.select("_author", "_year", "_prior")
    counted = lookup_join(single, prior, ["_author", "_year"], hot=hot, row_id=[row_id], rows=single.count())
    return counted.groupBy(row_id).agg(
        F.max(F.coalesce("_prior", F.lit(0))).cast("int").alias("max_author_prior_count")
    )


def agg_weekly_list(
    weeks: DataFrame, title_id: str, title: str, author: str, isbn: str, rank: str, order: str
) -> DataFrame:
    """Weekly rows to one row per title: first non-null texts, best rank, weeks with a rank."""
    number = F.col(rank).try_cast("double")

    def first_known(c: str) -> Column:
        return F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col(order)))

    return weeks.groupBy(title_id).agg(
        first_known(title).alias("title"),
        first_known(author).alias("author"),
        first_known(isbn).alias("oclc_isbn"),
        F.min(number).alias("best_rank"),
        F.count(number).alias("weeks_on_list"),
    ).withColumns({"primary_isbn13": oclc_isbn_loose(F.col("oclc_isbn")), "label": F.lit(1)})


def rank_features(history: DataFrame, key: str, ts: str, rank: str, keys: DataFrame | None = None) -> DataFrame:
    """Per key: best, median and latest rank, number of observations, share within 1,000 and 10,000.

    Requested keys always appear; without history the values are null and the count is 0.
    """
    summary = history.groupBy(key).agg(
        F.min(rank).cast("double").alias("rank_best"),
        F.max_by(rank, ts).cast("double").alias("rank_latest"),
        F.count(rank).alias("rank_observations"),
        F.avg((F.col(rank) <= 1000).cast("double")).alias("rank_time_in_top1k"),
        F.avg((F.col(rank) <= 10000).cast("double")).alias("rank_time_in_top10k"),
    )
    median = exact_quantiles(history, rank, [0.5], [key]).withColumnRenamed("q_0", "rank_median")
    out = summary.join(median, key, "left")
    if keys is not None:
        out = keys.select(key).distinct().join(out, key, "left")
    return out.withColumn("rank_observations", F.coalesce("rank_observations", F.lit(0)))
