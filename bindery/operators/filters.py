"""Filters and flags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.functions.text import is_boxset
from bindery.operators.ordered import bracketed_quantiles


def filter_min_year_nullsafe(df: DataFrame, year: str, minimum: int = 1931) -> DataFrame:
    return df.filter(F.col(year).isNull() | (F.col(year) >= minimum))


def filter_boxset(df: DataFrame, title: str) -> DataFrame:
    """Drop multi-volume titles; a null title stays."""
    return df.filter(~is_boxset(F.col(title)))


def filter_array_tags(df: DataFrame, tags: str, drop: str, unless: str) -> DataFrame:
    """Drop rows tagged ``drop`` and not also ``unless``."""
    tagged = F.array_contains(tags, drop) & ~F.array_contains(tags, unless)
    return df.filter(~F.coalesce(tagged, F.lit(False)))


def flag_suspicious_range(c: Column, low: int = 1000, high: int = 2024) -> Column:
    return F.coalesce((c < low) | (c > high), F.lit(False))


def filter_between(df: DataFrame, c: str, low, high, closed: bool = True) -> DataFrame:
    x = F.col(c)
    return df.filter(x.between(low, high) if closed else (x > low) & (x < high))


def quantile_limit(df: DataFrame, value: str, q: float) -> Column:
    """An exact quantile as a scalar subquery."""
    return bracketed_quantiles(df, value, [q]).select("q_0").scalar()


def cap_at_quantile(df: DataFrame, value: str, reference: DataFrame, q: float = 0.99) -> DataFrame:
    """Keep rows up to a quantile of the reference rows."""
    return df.filter(F.col(value) <= quantile_limit(reference, value, q))


def clip_at_quantile(df: DataFrame, value: str, q: float) -> DataFrame:
    limit = quantile_limit(df, value, q)
    return df.withColumn(value, F.when(F.col(value).isNotNull(), F.least(F.col(value), limit)))


def drop_missing_rows(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)
