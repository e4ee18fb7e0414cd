"""Operators that work per key and stay balanced when one key holds a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.operators import bloom

HOT_SHARE = 0.001  # a key above this share of the rows is hot; so at most 1 / HOT_SHARE keys are
SPREAD = 4096
TASK_ROWS = 1 << 18  # rows that one task sorts where the caller counts them


def keep_best_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row per key in the given order (which should end in a unique column).

    ``row_number() = 1`` is planned with a group limit on both sides of the shuffle, so a map task
    sends at most one row per key and a hot key costs no more than any other.
    """
    best = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(best)).filter("_rn = 1").drop("_rn")


def dedupe_any(df: DataFrame, subset: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Drop duplicates on a subset, keeping the first row in an explicit order."""
    return keep_best_per_key(df, subset, order)


def hot_keys(df: DataFrame, keys: Sequence[str], share: float = HOT_SHARE) -> DataFrame:
    """Keys that hold more than ``share`` of the rows: at most 1/share rows by construction."""
    counts = df.filter(_all_present(keys)).groupBy(*keys).agg(F.count("*").alias("_n"))
    return above_share(counts, "_n", share).select(*keys)


def above_share(counts: DataFrame, n: str, share: float = HOT_SHARE) -> DataFrame:
    total = counts.agg(F.sum(n)).scalar()
    return counts.filter(F.col(n) > total * F.lit(share))


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    *,
    hot: DataFrame | None = None,
    row_id: Sequence[str] | None = None,
    rows: int | None = None,
) -> DataFrame:
    """Left join to a side with **unique** keys; keeps every left row once.

    Rows of hot keys take their values from a broadcast of the (at most 1/HOT_SHARE) hot right
    rows, and they, like rows with a null key, are spread over the shuffle of the second join,
    where they find no partner. No single key is shuffled into one task. Where ``rows``, the number of
    left rows, is given, the join has a task per ``TASK_ROWS`` of them: adaptive coalescing, which goes
    by compressed bytes and the number of cores, would give a task more narrow rows the more there are.
    """
    on = list(on)
    values = [c for c in right.columns if c not in on]
    hot = hot_keys(left, on) if hot is None else hot.select(*on)
    hot_right = right.join(F.broadcast(hot), on, "left_semi").select(
        *on, F.struct(*values, F.lit(True).alias("_found")).alias("_hot")
    )
    spread_by = list(row_id) if row_id else [c for c, t in left.dtypes if not t.startswith("map")]
    spread = F.pmod(F.xxhash64(*spread_by), F.lit(SPREAD)).cast("int") + 1
    direct = F.col("_hot").isNotNull() | ~_all_present(on)
    step = left.join(F.broadcast(hot_right), on, "left").withColumn(
        "_spread", F.when(direct, spread).otherwise(F.lit(0))
    )
    # Always 0, but not a constant: Catalyst would drop a constant from the keys of the shuffle.
    zero = F.pmod(F.xxhash64(*on), F.lit(1)).cast("int")
    cold = right.select(*on, zero.alias("_spread"), F.struct(*values).alias("_cold"))
    if rows is not None:
        step, cold = (side.repartition(-(-rows // TASK_ROWS) or 1, *on, "_spread") for side in (step, cold))
    joined = step.join(cold, [*on, "_spread"], "left")
    return joined.select(
        *[F.col(c) for c in left.columns],
        *[
            F.when(F.col("_hot").isNotNull(), F.col("_hot")[v]).otherwise(F.col("_cold")[v]).alias(v)
            for v in values
        ],
    )


def _all_present(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Sizes of two distinct key sets and of their intersection, and its share of the left."""
    sides = (
        left.select(key, F.lit(1).alias("_l"), F.lit(0).alias("_r"))
        .unionByName(right.select(key, F.lit(0).alias("_l"), F.lit(1).alias("_r")))
        .filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.max("_l").alias("_l"), F.max("_r").alias("_r"))
    )
    return sides.agg(
        F.sum("_l").alias("n_left"),
        F.sum("_r").alias("n_right"),
        F.sum(F.col("_l") * F.col("_r")).alias("n_both"),
    ).withColumn("share_of_left", F.try_divide("n_both", "n_left"))


def key_difference(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Distinct wanted keys that are not done yet."""
    return wanted.select(key).filter(F.col(key).isNotNull()).distinct().join(done.select(key), key, "left_anti")


def filter_in_keys(df: DataFrame, keys: DataFrame, on: Sequence[str]) -> DataFrame:
    """Membership in a distributed key set; a Bloom filter of it keeps other rows out of the shuffle."""
    return bloom.semi_join(df, keys, on)


def append_rows(*tables: DataFrame) -> DataFrame:
    """Stack tables by column name; columns absent from one are null there."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out


def concat_columns(key: str, *blocks: DataFrame) -> DataFrame:
    """Put feature blocks of the same rows side by side, joined on their key."""
    out = blocks[0]
    for b in blocks[1:]:
        out = out.join(b, key, "inner")
    return out
