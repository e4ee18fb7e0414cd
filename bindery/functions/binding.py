"""Naming an intermediate value inside a Column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bound(c: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn(c)`` with ``c`` evaluated once per row, however often ``fn`` names it."""
    return F.get(F.transform(F.array(c), fn), F.lit(0))
