"""Small numeric expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def coerce_double(c: Column) -> Column:
    return F.trim(c.cast("string")).try_cast("double")


def coerce_int(c: Column) -> Column:
    """Text to integer; '1998.0' is accepted, anything else unparsable is null."""
    return coerce_double(c).try_cast("int")


def log_pages(c: Column) -> Column:
    return F.log1p(c.cast("double"))


def log10p1(c: Column) -> Column:
    return F.log10(c.cast("double") + 1)


def pub_decade(year: Column) -> Column:
    """Start of the decade, rounding down for negative years too."""
    return (F.floor(year / 10) * 10).cast("int")


def round_dp(c: Column, digits: int = 1) -> Column:
    return F.round(c, digits)


def clip(c: Column, lower=None, upper=None) -> Column:
    if lower is not None:
        c = F.when(c.isNotNull(), F.greatest(c, F.lit(lower)))
    if upper is not None:
        c = F.when(c.isNotNull(), F.least(c, upper if isinstance(upper, Column) else F.lit(upper)))
    return c
