"""Label-audit and profiling aggregates. Each is one or two aggregations over the input; only
their small results are reshaped."""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from bindery.functions.text import strip
from bindery.operators.keyed import lookup_join
from bindery.operators.ordered import bracketed_quantiles, cumulative_share

PROBS = (0.25, 0.5, 0.75)
FAN_IN = 32


def _domain(df: DataFrame, name: str, values: Sequence) -> DataFrame:
    """A literal list of values as a table, of the column's own type."""
    kind = df.schema[name].dataType
    rows = df.sparkSession.createDataFrame([(str(v),) for v in values], "v string")
    return rows.select(F.col("v").cast(kind).alias(name))


def _unpivot(row: DataFrame, columns: Sequence[str], name: str, value: str) -> DataFrame:
    return row.unpivot([], list(columns), name, value)


def value_counts(df: DataFrame, c: str, n: int | None = None) -> DataFrame:
    counts = df.filter(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
    return counts.orderBy(F.desc("n"), F.asc(c)).limit(n) if n else counts.orderBy(F.desc("n"), F.asc(c))


def class_balance(df: DataFrame, label: str) -> DataFrame:
    """Rows, share and negative:positive ratio for the labels 0 and 1, zero-filled."""
    one = df.agg(
        F.count_if(F.col(label) == 0).alias("0"), F.count_if(F.col(label) == 1).alias("1")
    )
    total = F.col("0") + F.col("1")
    ratio = F.round(F.try_divide("0", "1"), 4)
    rows = one.select(
        F.explode(
            F.array(
                *[
                    F.struct(
                        F.lit(k).alias("label"),
                        F.col(str(k)).alias("n"),
                        F.round(F.try_divide(F.col(str(k)) * 100.0, total), 4).alias("pct"),
                        ratio.alias("neg_per_pos"),
                    )
                    for k in (0, 1)
                ]
            )
        ).alias("r")
    )
    return rows.select("r.*")


def rate_by_group(df: DataFrame, group: str | Column, label: str, name: str = "group", digits: int = 1) -> DataFrame:
    """Rows, positives and % positive per group; rows without a group are left out."""
    g = F.col(group) if isinstance(group, str) else group
    return (
        df.select(g.alias(name), F.col(label).alias("_y"))
        .filter(F.col(name).isNotNull())
        .groupBy(name)
        .agg(F.count("_y").alias("total"), F.sum("_y").alias("positives"))
        .withColumn("hit_rate", F.round(F.try_divide(F.col("positives") * 100.0, "total"), digits))
    )


def rate_by_tag(df: DataFrame, tags: str, label: str, min_support: int = 50, n: int = 15) -> DataFrame:
    """Tags with enough rows, by falling rate."""
    tagged = df.select(F.explode(tags).alias("tag"), label).filter("tag is not null and tag <> ''")
    rates = rate_by_group(tagged, "tag", label, "tag").filter(F.col("total") >= min_support)
    return rates.orderBy(F.desc("hit_rate"), F.asc("tag")).limit(n)


def tag_multi_rate(df: DataFrame, tags: str, outcomes: Sequence[str], n: int = 20) -> DataFrame:
    """The n most frequent tags (by raw count) with rows and outcome rates (a row counts once per tag)."""
    raw = df.select(F.explode(tags).alias("tag"), F.lit(1).alias("_raw"), F.lit(0).alias("_row"),
                    *[F.lit(0).alias(o) for o in outcomes])
    once = df.select(F.explode(F.array_distinct(tags)).alias("tag"), F.lit(0).alias("_raw"), F.lit(1).alias("_row"), *outcomes)
    both = raw.unionByName(once).filter("tag is not null").groupBy("tag").agg(
        F.sum("_raw").alias("n_tags"),
        F.sum("_row").alias("n_rows"),
        *[F.sum(o).alias(f"_{o}") for o in outcomes],
    )
    rates = [F.round(F.try_divide(F.col(f"_{o}") * 100.0, "n_rows"), 1).alias(f"{o}_rate") for o in outcomes]
    return both.orderBy(F.desc("n_tags"), F.asc("tag")).limit(n).select("tag", "n_tags", "n_rows", *rates)


def indicator_rates(df: DataFrame, flags: Sequence[str], label: str) -> DataFrame:
    """Mean label where each flag is true, in one pass."""
    one = df.agg(*[F.avg(F.when(F.col(f), F.col(label))).alias(f) for f in flags])
    return _unpivot(one, flags, "indicator", "rate")


def group_share(df: DataFrame, group: str, flag: Column, name: str = "pct") -> DataFrame:
    return df.groupBy(group).agg((F.avg(flag.cast("double")) * 100).alias(name))


def flag_groups_outside_band(rates: DataFrame, low: float = 5.0, high: float = 30.0) -> DataFrame:
    return rates.filter((F.col("hit_rate") < low) | (F.col("hit_rate") > high))


def pivot_counts(
    df: DataFrame, group: str, category: str, categories: Sequence, groups: Sequence | None = None
) -> DataFrame:
    """Counts per group and (literal) category; missing cells and missing listed groups are 0."""
    aggs = [F.count_if(F.col(category) == F.lit(c)).alias(f"n_{c}") for c in categories]
    counts = df.filter(F.col(group).isNotNull()).groupBy(group).agg(*aggs)
    if groups is not None:
        counts = _domain(df, group, groups).join(counts, group, "left")
    return counts.fillna(0, [f"n_{c}" for c in categories])


def crosstab_norm(df: DataFrame, row: str, category: str, categories: Sequence) -> DataFrame:
    """Two-way table as % of the row total."""
    counts = pivot_counts(df.filter(F.col(category).isin(*categories)), row, category, categories)
    total = sum((F.col(f"n_{c}") for c in categories), F.lit(0))
    return counts.select(
        row, *[F.round(F.try_divide(F.col(f"n_{c}") * 100.0, total), 4).alias(f"pct_{c}") for c in categories]
    )


def category_share(counts: DataFrame, part: str, parts: Sequence[str], name: str, digits: int = 1) -> DataFrame:
    """One column as % of the row sum; null if the sum is 0."""
    total = sum((F.col(p) for p in parts), F.lit(0))
    return counts.withColumn(name, F.round(F.try_divide(F.col(part) * 100.0, total), digits))


def monthly_distribution(df: DataFrame, month: str, label: str) -> DataFrame:
    """Rows of each class per month 1..12, zero-filled, with the positive rate."""
    counts = pivot_counts(
        df.withColumn("_y", F.coalesce(F.col(label), F.lit(0))), month, "_y", [0, 1], range(1, 13)
    )
    total = F.col("n_0") + F.col("n_1")
    return counts.withColumn("rate", F.round(F.try_divide(F.col("n_1") * 100.0, total), 1))


def missing_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Type, null count and null % per column, in one pass."""
    columns = list(columns or df.columns)
    types = dict(df.dtypes)
    one = df.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in columns])
    rows = one.unpivot(["_n"], columns, "column", "n_present")
    return rows.select(
        "column",
        F.create_map(*[F.lit(x) for c in columns for x in (c, types[c])])[F.col("column")].alias("type"),
        (F.col("_n") - F.col("n_present")).alias("n_missing"),
        F.round(F.try_divide((F.col("_n") - F.col("n_present")) * 100.0, "_n"), 4).alias("pct_missing"),
    )


def coverage_report(df: DataFrame, checks: Sequence[tuple[str, str]], binary: Sequence[str] = ()) -> DataFrame:
    """(column, text) pairs to counts: positives of binary columns, non-empty lists, non-blank
    texts, else non-null values; columns that do not exist are skipped."""
    kinds = {f.name: f.dataType for f in df.schema}
    present = [(c, text) for c, text in checks if c in kinds]

    def usable(c: str) -> Column:
        if c in binary:
            return F.col(c).cast("int") == 1
        if isinstance(kinds[c], T.ArrayType):
            return F.size(c) > 0
        if isinstance(kinds[c], T.StringType):
            return strip(F.col(c)) != ""
        return F.col(c).isNotNull()

    one = df.agg(F.count("*").alias("n_total"), *[F.count_if(usable(c)).alias(text) for c, text in present])
    rows = one.unpivot(["n_total"], [text for _, text in present], "field", "n_covered")
    return rows.withColumn("pct", F.round(F.try_divide(F.col("n_covered") * 100.0, "n_total"), 1))


def _long(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    wide = df.select(*group, *[F.col(c).cast("double").alias(c) for c in columns])
    return wide.unpivot(list(group), list(columns), "column", "value").filter("value is not null")


def describe_numeric(df: DataFrame, columns: Sequence[str], group: Sequence[str] = ()) -> DataFrame:
    """count, mean, std (n-1), min, quartiles and max per column (and group)."""
    keys = [*group, "column"]
    long = _long(df, columns, group)
    moments = long.groupBy(*keys).agg(
        F.count("*").alias("count"),
        F.avg("value").alias("mean"),
        F.stddev_samp("value").alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = bracketed_quantiles(long, "value", PROBS, keys).withColumnsRenamed(
        {"q_0": "p25", "q_1": "p50", "q_2": "p75"}
    )
    return moments.join(quartiles, keys, "left")


def describe_by_group(df: DataFrame, value: str, group: str) -> DataFrame:
    return describe_numeric(df, [value], [group]).drop("column")


def median_by_group(df: DataFrame, value: str, group: str) -> DataFrame:
    return bracketed_quantiles(df, value, [0.5], [group]).withColumnRenamed("q_0", "median")


def describe_all(df: DataFrame, numeric: Sequence[str], text: Sequence[str]) -> DataFrame:
    """``describe_numeric`` plus unique / top / freq for text columns."""
    long = df.select(*[F.col(c).cast("string").alias(c) for c in text]).unpivot([], list(text), "column", "value")
    counts = long.filter("value is not null").groupBy("column", "value").agg(F.count("*").alias("_n"))
    rank = F.struct(-F.col("_n"), F.col("value"))
    texts = counts.groupBy("column").agg(
        F.sum("_n").alias("count"),
        F.count("*").alias("unique"),
        F.min_by("value", rank).alias("top"),
        F.max("_n").alias("freq"),
    )
    return describe_numeric(df, numeric).unionByName(texts, allowMissingColumns=True)


def correlation_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson r for every unordered pair (long form, a before b), pairwise complete.

    r is null if either column is constant on the common rows. Each task adds up one set of product
    matrices, whose size depends on the number of columns only; further levels of tasks add those up,
    ``FAN_IN`` at a time, and the driver gets at most so many. Values are centred first, against cancellation.
    """
    wide = df.select(*[F.col(c).cast("double").alias(c) for c in columns])
    centre = wide.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns]).first()
    means = np.array(list(centre))
    p = len(columns)

    upper = np.triu_indices(p)
    every = p * p
    size = every + every + every + len(upper[0])  # n, sums, squares, products (upper triangle)

    def products(batches):
        total = np.zeros(size)
        for batch in batches:
            x = batch.to_numpy(dtype=float, na_value=np.nan)
            known = (~np.isnan(x)).astype(float)
            x = np.where(known > 0, x - means, 0.0)
            blocks = (known.T @ known, x.T @ known, (x * x).T @ known)
            total += np.concatenate([*(m.ravel() for m in blocks), (x.T @ x)[upper]])
        yield pd.DataFrame({"g": [total]})

    def add_up(batches):
        total = np.zeros(size)
        for batch in batches:
            for g in batch["g"]:
                total += g
        yield pd.DataFrame({"g": [total]})

    schema = T.StructType([T.StructField("g", T.ArrayType(T.DoubleType()))])
    sums = wide.mapInPandas(products, schema)
    tasks = wide.rdd.getNumPartitions()
    while tasks > FAN_IN:  # no task adds up more than about FAN_IN matrices
        tasks = -(-tasks // FAN_IN)
        sums = sums.repartition(tasks).mapInPandas(add_up, schema)
    g = sum((np.array(r["g"]) for r in sums.collect()), np.zeros(size))
    n, sx, sxx = (g[i * every : (i + 1) * every].reshape(p, p) for i in range(3))
    sxy = np.zeros((p, p))
    sxy[upper] = g[3 * every :]
    with np.errstate(divide="ignore", invalid="ignore"):
        mean, var = sx / n, sxx / n - (sx / n) ** 2
        r = (sxy / n - mean * mean.T) / np.sqrt(var * var.T)
        flat = ~(var > np.maximum(1e-12 * sxx / n, 1e-24 * means[:, None] ** 2))
    rows = [
        (columns[i], columns[j], None if flat[i, j] or flat[j, i] else float(r[i, j]))
        for i, j in itertools.combinations(range(p), 2)
    ]
    return df.sparkSession.createDataFrame(rows, "a string, b string, r double")


def correlated_pairs(matrix: DataFrame, threshold: float = 0.5) -> DataFrame:
    return matrix.filter(F.abs("r") > threshold).orderBy(F.desc(F.abs("r")), "a", "b")


def target_correlation_rank(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """|r| of each feature with the label, strongest first."""
    aggs = []
    y0 = F.col(label).cast("double")
    for f in features:
        x0 = F.col(f).cast("double")
        x, y = F.when(y0.isNotNull(), x0), F.when(x0.isNotNull(), y0)
        aggs.append(F.abs(F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))).alias(f))
    return _unpivot(df.agg(*aggs), features, "feature", "abs_r").orderBy(F.desc_nulls_last("abs_r"), "feature")


def pointbiserial(df: DataFrame, binary: str, values: Sequence[str]) -> DataFrame:
    """r, n, t and the two-sided p of a 0/1 column against numeric columns, nulls dropped per pair."""
    aggs = []
    y0 = F.col(binary).cast("double")
    for v in values:
        x0 = F.col(v).cast("double")
        x, y = F.when(y0.isNotNull(), x0), F.when(x0.isNotNull(), y0)
        r = F.try_divide(F.covar_pop(x, y), F.stddev_pop(x) * F.stddev_pop(y))
        aggs.append(F.struct(r.alias("r"), F.count(x).alias("n")).alias(v))
    rows = df.agg(*aggs).unpivot([], list(values), "feature", "_s").select("feature", "_s.*")
    t = F.col("r") * F.sqrt(F.try_divide(F.col("n") - 2, 1 - F.col("r") * F.col("r")))
    return rows.withColumn("t", t).withColumn("p", _t_two_sided(F.col("t"), F.col("n") - 2))


def _t_two_sided(t: Column, dof: Column) -> Column:
    """Two-sided tail of Student's t, by Simpson's rule on the substituted integral.

    With x = sqrt(dof) tan(z / sqrt(dof)) the density becomes cos(z / sqrt(dof))^(dof - 1), which for
    any dof is at most about exp(-z^2 / 2); so the step follows the density's own width and not the
    number of rows, and nothing counts beyond z = 40. The ratio of two such integrals needs no gamma
    function. Runs on the few result rows only.
    """
    steps = 4000
    dof = dof.cast("double")
    root = F.sqrt(dof)
    grid = F.sequence(F.lit(0), F.lit(steps))
    flat = F.when(dof <= 1, 1.0).otherwise(0.0)  # the value where the cosine is 0

    def density(z: Column) -> Column:
        sine = F.sin(z / root / 2)
        return F.coalesce(F.exp((dof - 1) * F.log1p(sine * sine * -2)), flat)

    def integral(low: Column, high: Column) -> Column:
        h = (high - low) / steps
        total = F.aggregate(
            grid,
            F.lit(0.0),
            lambda acc, i: acc
            + F.when((i == 0) | (i == steps), 1.0).when(i % 2 == 1, 4.0).otherwise(2.0) * density(low + i * h),
        )
        return total * h / 3

    end = F.least(root * 1.5707963267948966, F.lit(40.0))
    start = F.least(root * F.atan(F.abs(t) / root), end)
    reach = F.least(end, start + 12)  # beyond, the rest is below 1e-31 of the whole
    return F.try_divide(integral(start, reach), integral(F.lit(0.0), F.least(end, F.lit(12.0))))


def histogram_bins(
    df: DataFrame, value: str, bins: int, split: str | None = None, density: bool = False
) -> DataFrame:
    """Counts in equal-width bins over [min, max], last bin closed, zero-filled; optionally per class."""
    known = df.filter(F.col(value).isNotNull()).select(
        F.col(value).cast("double").alias("_v"), *([split] if split else [])
    )
    span = known.agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
    low, high = span.select("_lo").scalar(), span.select("_hi").scalar()
    width = F.try_divide(high - low, F.lit(bins))
    bin_no = F.least(F.coalesce(F.floor(F.try_divide(F.col("_v") - low, width)), F.lit(0)), F.lit(bins - 1))
    keys = [split] if split else []
    counts = known.groupBy(*keys, bin_no.cast("int").alias("bin")).agg(F.count("*").alias("n"))
    # One row per class with a slot for every bin, so that empty bins show as 0.
    per_class = counts.groupBy(*keys).agg(
        F.array(*[F.coalesce(F.sum(F.when(F.col("bin") == b, F.col("n"))), F.lit(0)) for b in range(bins)]).alias("_n")
    )
    rows = per_class.select(*keys, F.posexplode("_n").alias("bin", "n"), F.aggregate("_n", F.lit(0).cast("long"), lambda a, x: a + x).alias("_all"))
    rows = rows.withColumns({"low": low + F.col("bin") * width, "high": low + (F.col("bin") + 1) * width})
    if density:
        rows = rows.withColumn("density", F.try_divide(F.col("n"), F.col("_all") * width))
    return rows.drop("_all")


def boxplot_stats(df: DataFrame, value: str, group: str) -> DataFrame:
    """Quartiles and the most extreme values within 1.5 IQR per class (outliers hidden)."""
    known = df.filter(F.col(value).isNotNull()).select(group, F.col(value).cast("double").alias("_v"))
    quartiles = bracketed_quantiles(known, "_v", PROBS, [group]).withColumnsRenamed(
        {"q_0": "q1", "q_1": "med", "q_2": "q3"}
    )
    reach = (F.col("q3") - F.col("q1")) * 1.5
    inside = F.col("_v").between(F.col("q1") - reach, F.col("q3") + reach)
    # Distinct values per class first, so that the join works on combined rows.
    values = known.groupBy(group, "_v").agg(F.lit(1).alias("_one"))
    return (
        lookup_join(values, quartiles, [group])
        .groupBy(group)
        .agg(
            F.first("q1").alias("q1"),
            F.first("med").alias("med"),
            F.first("q3").alias("q3"),
            F.min(F.when(inside, F.col("_v"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("_v"))).alias("whisker_high"),
        )
    )


def column_sum_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    one = df.agg(*[F.sum(F.col(c).cast("double")).alias(c) for c in columns])
    total = sum((F.col(c) for c in columns), F.lit(0.0))
    return _unpivot(one.select(*[F.try_divide(c, total).alias(c) for c in columns]), columns, "column", "share")


def key_diagnostics(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Usable, unique and duplicate keys; counted from combined groups."""
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    groups = df.filter(present).groupBy(*keys).agg(F.count("*").alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("n_usable"), F.count("*").alias("n_unique")
    ).withColumn("n_duplicate", F.col("n_usable") - F.col("n_unique"))


def column_equality_share(df: DataFrame, a: str, b: str) -> DataFrame:
    same = F.col(a).cast("string").eqNullSafe(F.col(b).cast("string"))
    return df.agg(F.count_if(same).alias("n_equal"), F.avg(same.cast("double")).alias("share"))


def cutoff_sweep(
    df: DataFrame, year: str, label: str, cutoffs: Sequence[int], min_positives: int = 200, min_rate: float = 0.05
) -> DataFrame:
    """Train and test sizes for each candidate cutoff year, from one aggregate per year."""
    y, pos = F.col("_year"), F.col("_pos")
    per_year = df.filter(F.col(year).isNotNull()).groupBy(F.col(year).alias("_year")).agg(
        F.count("*").alias("_n"), F.sum(label).alias("_pos")
    )
    rows = per_year.select("_year", "_n", "_pos", F.explode(F.array(*map(F.lit, cutoffs))).alias("cutoff"))
    out = rows.groupBy("cutoff").agg(
        F.sum(F.when(y < F.col("cutoff"), F.col("_n")).otherwise(0)).alias("n_train"),
        F.sum(F.when(y >= F.col("cutoff"), F.col("_n")).otherwise(0)).alias("n_test"),
        F.sum(F.when(y >= F.col("cutoff"), pos).otherwise(0)).alias("test_positives"),
    )
    rate = F.try_divide("test_positives", "n_test")
    valid = (F.col("test_positives") >= min_positives) & F.coalesce(rate >= min_rate, F.lit(False))
    return out.withColumns({"test_rate": rate, "is_valid": valid})


def author_concentration(df: DataFrame, author: str, label: str) -> DataFrame:
    positives = df.filter((F.col(label) == 1) & F.col(author).isNotNull())
    return positives.groupBy(author).agg(F.count("*").alias("n_positive"))


def concentration_summary(df: DataFrame, author: str, label: str) -> DataFrame:
    """Positives, authors, and how many authors hold up to 25 % and 50 % of the positives."""
    shares = cumulative_share(author_concentration(df, author, label), author, "n_positive")
    return shares.agg(
        F.sum("n_positive").alias("n_positives"),
        F.count("*").alias("n_authors"),
        F.count_if(F.col("cumulative_pct") <= 25).alias("authors_25"),
        F.count_if(F.col("cumulative_pct") <= 50).alias("authors_50"),
    )


def both_flags_count(df: DataFrame, a: str, b: str) -> DataFrame:
    x, y = F.coalesce(F.col(a) == 1, F.lit(False)), F.coalesce(F.col(b) == 1, F.lit(False))
    return df.agg(
        F.count_if(x & y).alias("n_both"),
        F.count_if(x & ~y).alias("n_only_a"),
        F.count_if(~x & y).alias("n_only_b"),
        F.count_if(~x & ~y).alias("n_neither"),
    )


def source_coverage(cache: DataFrame, source: str, missing: str = "missing") -> DataFrame:
    """Found and missing keys with their share; the empty side shows as 0."""
    one = cache.agg(
        F.count_if(F.col(source) != missing).alias("found"), F.count_if(F.col(source) == missing).alias("missing")
    )
    total = F.col("found") + F.col("missing")
    rows = one.select(
        F.explode(
            F.array(
                *[
                    F.struct(F.lit(s).alias("status"), F.col(s).alias("n"), F.try_divide(s, total).alias("share"))
                    for s in ("found", "missing")
                ]
            )
        ).alias("r")
    )
    return rows.select("r.*")


def health_verdict(
    df: DataFrame, decade: str, author: str, method: str, label: str, fuzzy: str = "fuzzy_title_author"
) -> DataFrame:
    """Three warnings: decade skew, author concentration, share of fuzzy matches among positives."""
    decades = rate_by_group(df, decade, label).agg(
        F.min("hit_rate").alias("min_rate"), F.max("hit_rate").alias("max_rate")
    )
    people = concentration_summary(df, author, label).select("authors_25")
    methods: Mapping[str, Column] = {
        "n_fuzzy": F.count_if(F.col(method) == fuzzy),
        "n_positive": F.count_if(F.col(label) == 1),
    }
    out = df.agg(*[c.alias(k) for k, c in methods.items()]).select(
        decades.select("min_rate").scalar().alias("min_rate"),
        decades.select("max_rate").scalar().alias("max_rate"),
        people.scalar().alias("authors_25"),
        F.try_divide(F.col("n_fuzzy") * 100.0, "n_positive").alias("fuzzy_share"),
    )
    return out.withColumns(
        {
            "decade_skew": F.col("max_rate") > 3 * F.col("min_rate"),
            "author_concentrated": F.col("authors_25") <= 5,
            "fuzzy_heavy": F.coalesce(F.col("fuzzy_share") > 30, F.lit(False)),
        }
    )
