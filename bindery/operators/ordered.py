"""Running totals, row ids, exact quantiles and cumulative shares over data of any size.

A plain ``Window.orderBy`` puts a whole group (or the whole table) into one task. Here the rows
are range-partitioned on (group, order), so that one group may span many partitions; each
partition is summed on its own and starts from the total of the partitions before it.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.session import materialize


def running_totals(
    df: DataFrame, order: Sequence[Column], values: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Add ``cum_<v>`` (inclusive running total) and ``tot_<v>`` (group total) for each value.

    ``order`` must be unique within a group, otherwise the running total of ties is arbitrary.
    """
    group = list(group)
    ranged = df.repartitionByRange(*[F.col(g) for g in group], *order)
    frozen = materialize(ranged.withColumn("_part", F.spark_partition_id()), "ranged")

    # One row per (group, partition), kept only for groups that cross a partition boundary.
    # A boundary is crossed by at most one group, so this has < 2 x partitions rows.
    across = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    before = across.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = frozen.groupBy(*group, "_part").agg(*[F.sum(v).alias(f"_s_{v}") for v in values])
    offsets = (
        offsets.withColumns(
            {
                "_pieces": F.count("*").over(across),
                **{f"_off_{v}": F.coalesce(F.sum(f"_s_{v}").over(before), F.lit(0)) for v in values},
                **{f"_tot_{v}": F.sum(f"_s_{v}").over(across) for v in values},
            }
        )
        .filter("_pieces > 1")
        .select(
            F.col("_part").alias("_opart"),
            *[F.col(g).alias(f"_o_{g}") for g in group],
            *[f"_off_{v}" for v in values],
            *[f"_tot_{v}" for v in values],
        )
    )
    on = F.col("_part") == F.col("_opart")
    for g in group:
        on = on & F.col(g).eqNullSafe(F.col(f"_o_{g}"))

    piece = Window.partitionBy(*group, "_part")
    upto = piece.orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = frozen.withColumns(
        {
            **{f"_cum_{v}": F.sum(v).over(upto) for v in values},
            **{f"_all_{v}": F.sum(v).over(piece) for v in values},
        }
    )
    joined = local.join(F.broadcast(offsets), on, "left")
    return joined.select(
        *df.columns,
        *[(F.col(f"_cum_{v}") + F.coalesce(f"_off_{v}", F.lit(0))).alias(f"cum_{v}") for v in values],
        *[F.coalesce(f"_tot_{v}", f"_all_{v}").alias(f"tot_{v}") for v in values],
    )


def assign_row_id(df: DataFrame, order: Sequence[Column], name: str = "row_id") -> DataFrame:
    """Contiguous ids 0..n-1 in the given (unique) order."""
    counted = running_totals(df.withColumn("_one", F.lit(1).cast("long")), order, ["_one"])
    return counted.withColumn(name, F.col("cum__one") - 1).drop("_one", "cum__one", "tot__one")


def exact_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = ()
) -> DataFrame:
    """Exact, linearly interpolated quantiles per group: columns ``q_<i>`` in the order of ``probs``.

    Rows are first reduced to counts per distinct value (combined map-side), so repeated values
    cost nothing after the first shuffle and no group is ever held in one task.
    """
    group = list(group)
    counts = (
        df.filter(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("double").alias("_v"))
        .agg(F.count("*").alias("_n"))
    )
    ranked = running_totals(counts, [F.col("_v")], ["_n"], group)
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("tot__n") - 1) * F.lit(float(p))
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            here = (at >= F.col("cum__n") - F.col("_n")) & (at < F.col("cum__n"))
            aggs.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}_{i}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_fr_{i}"))
    return _interpolated(ranked.groupBy(*group).agg(*aggs), len(probs), group)


def _interpolated(ends: DataFrame, n: int, group: Sequence[str]) -> DataFrame:
    low, high, part = (lambda i: F.col(f"_lo_{i}")), (lambda i: F.col(f"_hi_{i}")), (lambda i: F.col(f"_fr_{i}"))
    return ends.select(*group, *[(low(i) + part(i) * (high(i) - low(i))).alias(f"q_{i}") for i in range(n)])


SKETCH = 2048  # size of a quantile sketch: some 50 KB, and brackets of 0.8 % of the rows
SKETCH_GROUPS = 1024  # with more groups than that, all values are ranked at once
SPREAD = 32  # sketches of a group that the first level merges into


def _same_group(group: Sequence[str], mark: str) -> Column:
    return reduce(lambda x, y: x & y, [F.col(g).eqNullSafe(F.col(f"{mark}{g}")) for g in group])


def _brackets(known: DataFrame, probs: Sequence[float], group: Sequence[str], size: int) -> DataFrame:
    """Rows per group, and two values per quantile between which it lies but for rare misses."""
    error = 2 * 2.446 / size**0.9433  # twice the rank error of a sketch of this size at 99 % confidence
    number = F.when(~F.isnan("_v"), F.col("_v"))
    sketch = F.kll_sketch_agg_double(number, F.lit(size)).alias("_s")
    counts = [F.count("*").alias("_n"), F.count(number).alias("_sound")]
    parts = known.groupBy(*group, F.pmod(F.spark_partition_id(), F.lit(SPREAD)).alias("_part")).agg(*counts, sketch)
    merged = parts.groupBy(*group).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("_n"),
        F.sum("_sound").alias("_sound"),
        F.kll_merge_agg_double("_s", F.lit(size)).alias("_s"),
    )

    def edge(rank: float) -> Column:
        cut = F.kll_sketch_get_quantile_double("_s", F.lit(min(max(rank, 0.0), 1.0)))
        return F.when(F.col("_sound") > 0, cut)

    lows = [edge(p - error).alias(f"_low_{i}") for i, p in enumerate(probs)]
    highs = [edge(p + error).alias(f"_high_{i}") for i, p in enumerate(probs)]
    return materialize(merged.select(*[F.col(g).alias(f"_of_{g}") for g in group], "_n", *lows, *highs), "brackets")


def bracketed_quantiles(
    df: DataFrame, value: str, probs: Sequence[float], group: Sequence[str] = (), *, size: int = SKETCH
) -> DataFrame:
    """What :func:`exact_quantiles` gives, by two reads in place of a shuffle of all values.

    The first read makes a sketch per group, which brackets each quantile. The second counts the values
    below a bracket and combines those inside, and only these are ranked. Groups whose quantile is not
    inside its bracket (a rare miss, or NaN among the values) are ranked in full, and so is everything
    where there are more than ``SKETCH_GROUPS`` groups.
    """
    group, probs = list(group), [float(p) for p in probs]
    known = df.filter(F.col(value).isNotNull()).select(*group, F.col(value).cast("double").alias("_v"))
    brackets = _brackets(known, probs, group, size)
    if group and brackets.limit(SKETCH_GROUPS + 1).count() > SKETCH_GROUPS:
        return exact_quantiles(known, "_v", probs, group)
    if group:
        met = known.join(F.broadcast(brackets.drop("_n")), _same_group(group, "_of_"))
    else:
        row = brackets.first()
        met = known.withColumns({c: F.lit(row[c]).cast("double") for c in brackets.columns if c != "_n"})
    # One cell per value inside a bracket; all values below it are one cell without a value.
    cells = F.array(
        *[
            F.when(
                F.col("_v") <= F.col(f"_high_{i}"),
                F.struct(F.lit(i).alias("i"), F.when(F.col("_v") >= F.col(f"_low_{i}"), F.col("_v")).alias("v")),
            )
            for i in range(len(probs))
        ]
    )
    counts = (
        met.select(*group, F.explode(F.array_compact(cells)).alias("_c"))
        .groupBy(*group, F.col("_c.i").alias("_i"), F.col("_c.v").alias("_v"))
        .agg(F.count("*").alias("_k"))
    )
    ranked = running_totals(counts, [F.col("_v").asc_nulls_first()], ["_k"], [*group, "_i"])
    if group:
        ranked = ranked.join(F.broadcast(brackets.select(*[f"_of_{g}" for g in group], "_n")), _same_group(group, "_of_"))
    else:
        ranked = ranked.withColumn("_n", F.lit(row["_n"]))
    aggs = []
    for i, p in enumerate(probs):
        pos = (F.col("_n") - 1) * F.lit(p)
        for side, at in (("lo", F.floor(pos)), ("hi", F.ceil(pos))):
            here = (F.col("_i") == i) & (at >= F.col("cum__k") - F.col("_k")) & (at < F.col("cum__k"))
            aggs.append(F.max(F.when(here, F.col("_v"))).alias(f"_{side}_{i}"))
        aggs.append(F.max(pos - F.floor(pos)).alias(f"_fr_{i}"))
    found = materialize(_interpolated(ranked.groupBy(*group).agg(*aggs), len(probs), group), "quantiles")
    found = found.filter(reduce(lambda x, y: x & y, [F.col(f"q_{i}").isNotNull() for i in range(len(probs))]))
    if not group:
        return exact_quantiles(known, "_v", probs) if found.isEmpty() else found
    late = brackets.join(F.broadcast(found.select(*group)), _same_group(group, "_of_"), "left_anti")
    if late.isEmpty():
        return found
    rest = known.join(F.broadcast(late.select(*[f"_of_{g}" for g in group])), _same_group(group, "_of_"), "left_semi")
    return found.unionByName(exact_quantiles(rest, "_v", probs, group))


def cumulative_share(groups: DataFrame, key: str, count: str, digits: int = 1) -> DataFrame:
    """Groups by falling count with the cumulative % of the total (rounded)."""
    ranked = running_totals(groups.select(key, count), [F.desc(count), F.asc(key)], [count])
    share = F.round(F.col(f"cum_{count}") * 100.0 / F.col(f"tot_{count}"), digits)
    return ranked.select(key, count, share.alias("cumulative_pct"))
