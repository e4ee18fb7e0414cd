"""Data-quality checks.

The ``expect_`` functions return their violations; an empty result means the check holds. A
:class:`WriteCheck` is judged by numbers that :func:`checked_write` gathers while it writes the table, so
any number of them costs no pass of its own.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from bindery.operators.keyed import keep_best_per_key
from bindery.session import discard, materialize


class CheckFailed(AssertionError):
    pass


def require(violations: DataFrame, message: str) -> None:
    """Raise if there is any violation (looks at one row)."""
    found = violations.take(1)
    if found:
        raise CheckFailed(f"{message}: e.g. {found[0].asDict()}")


def expect_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("n")).filter("n > 1")


def expect_row_count(before: DataFrame, after: DataFrame) -> DataFrame:
    counts = before.select(F.lit(1).alias("_b"), F.lit(0).alias("_a")).unionAll(
        after.select(F.lit(0).alias("_b"), F.lit(1).alias("_a"))
    )
    return counts.agg(
        F.coalesce(F.sum("_b"), F.lit(0)).alias("n_before"), F.coalesce(F.sum("_a"), F.lit(0)).alias("n_after")
    ).filter("n_before <> n_after")


def expect_exact_count(df: DataFrame, n: int) -> DataFrame:
    return df.agg(F.count("*").alias("n")).filter(F.col("n") != n)


def expect_label_domain(df: DataFrame, label: str) -> DataFrame:
    bad = F.col(label).isNull() | ~F.col(label).isin(0, 1)
    return df.filter(bad).groupBy(label).agg(F.count("*").alias("n"))


def expect_min_positives(df: DataFrame, label: str, minimum: int = 100) -> DataFrame:
    positives = df.agg(F.count_if(F.col(label) == 1).alias("n_positive"))
    return positives.filter(F.col("n_positive") < minimum)


def expect_equal_counts(variants: Mapping[str, DataFrame]) -> DataFrame:
    """Row counts per variant, if they are not all the same."""
    rows = None
    for name, df in variants.items():
        one = df.agg(F.count("*").alias("n")).select(F.lit(name).alias("variant"), "n")
        rows = one if rows is None else rows.unionByName(one)
    span = rows.agg(F.max("n") - F.min("n"))
    return rows.filter(span.scalar() > 0)


def expect_debut_zero(df: DataFrame, author: str, year: str, prior: str, row_id: str) -> DataFrame:
    """First rows of an author that still have a positive prior count."""
    known = df.filter(F.col(author).isNotNull())
    first = keep_best_per_key(known, [author], [F.col(year).asc_nulls_last(), F.col(row_id).asc()])
    return first.filter(F.col(prior) > 0)


# --- checks in the write itself ----------------------------------------------------------------


class WriteCheck(NamedTuple):
    """Aggregates over the rows written, and whether their values are as they should be."""

    message: str
    metrics: Mapping[str, Column]
    holds: Callable[[Mapping[str, object]], bool]


def _key_metrics(keys: Sequence[str]) -> dict[str, Column]:
    """The number of rows, and sums of two hashes of their keys: equal for equal collections of keys."""
    return {"n_rows": F.count(F.lit(1))} | {
        f"keys_{i}": F.coalesce(F.sum(F.xxhash64(F.lit(i), *keys).cast("decimal(38,0)")), F.lit(0)) for i in (1, 2)
    }


def keeps_keys(before: DataFrame, keys: Sequence[str]) -> WriteCheck:
    """Every key is written as often as ``before`` has it: no row lost, added or doubled.

    Reads the key columns of ``before`` once; nothing is shuffled. Where its keys are unique, so are
    the written ones. Differing collections pass with a probability of about 2 to the power of -128.
    """
    want = before.agg(*[c.alias(n) for n, c in _key_metrics(keys).items()]).first().asDict()
    return WriteCheck(f"keys {list(keys)} are not those before", _key_metrics(keys), lambda m: all(m[k] == want[k] for k in want))


def label_domain(label: str) -> WriteCheck:
    bad = F.col(label).isNull() | ~F.col(label).isin(0, 1)
    return WriteCheck(f"{label} must be 0 or 1", {"n_bad_labels": F.count_if(bad)}, lambda m: m["n_bad_labels"] == 0)


def min_positives(label: str, minimum: int = 100) -> WriteCheck:
    positives = {"n_positive": F.count_if(F.col(label) == 1)}
    return WriteCheck(f"fewer than {minimum} positives", positives, lambda m: m["n_positive"] >= minimum)


def checked_write(df: DataFrame, name: str, checks: Sequence[WriteCheck]) -> tuple[DataFrame, dict[str, object]]:
    """Write ``df`` as a stage and judge the checks by what was written: (the stage, the numbers).

    The numbers are gathered in the tasks that write, so each task counts once, whatever is run again.
    If a check fails the stage is removed and :class:`CheckFailed` names all that failed.
    """
    metrics = {n: c for check in checks for n, c in check.metrics.items()} or {"n_rows": F.count(F.lit(1))}
    seen = Observation()
    out = materialize(df.observe(seen, *[c.alias(n) for n, c in metrics.items()]), name)
    numbers = seen.get
    failed = [check.message for check in checks if not check.holds(numbers)]
    if failed:
        discard(out)
        raise CheckFailed(f"{'; '.join(failed)}: {numbers}")
    return out, numbers
