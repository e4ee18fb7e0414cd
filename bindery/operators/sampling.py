"""Top-k, previews and reproducible samples."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def top_k(df: DataFrame, value: str, k: int, tie: str) -> DataFrame:
    return df.orderBy(F.desc_nulls_last(value), F.asc(tie)).limit(k)


def seeded_sample(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows chosen by the MD5 of key and seed: the same rows however the data is partitioned."""
    return df.orderBy(F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))), F.col(key)).limit(n)


def review_mark(score: Column) -> Column:
    """Confidence mark of a match score for a reviewer."""
    return F.when(score >= 90, "sure").when(score >= 85, "check").otherwise("doubtful")


def preview(df: DataFrame, condition: Column, columns: Sequence[str], order: str, n: int = 25) -> DataFrame:
    return df.filter(condition).select(*columns).orderBy(order).limit(n)
