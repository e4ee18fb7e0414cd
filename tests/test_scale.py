"""Skew, repartitioning and plan shape."""

import glob
import time
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from bindery.operators import history, keyed, ordered, quality
from bindery.session import materialize


def plan(df):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")


@pytest.fixture(scope="module")
def skewed(spark):
    """One key with a third of the rows, a fifth of them without a key."""
    key = F.when(F.col("id") % 5 == 0, None).when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 400)
    return spark.range(6000).select("id", key.alias("k"), (F.col("id") % 11).alias("v"))


def test_lookup_join_keeps_every_row_once(spark, skewed):
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = keyed.lookup_join(skewed, right, ["k"], row_id=["id"])
    want = skewed.join(right, "k", "left").select("id", "k", "v", "w")
    assert got.count() == 6000
    assert got.exceptAll(want).count() == 0
    assert keyed.hot_keys(skewed, ["k"], 0.1).collect()[0]["k"] == 7


def _quantiles(df, group):
    return {tuple(r[g] for g in group): tuple(str(r[f"q_{i}"]) for i in range(4)) for r in df.collect()}


@pytest.mark.parametrize("group", [[], ["g"], ["g", "h"]])
def test_bracketed_quantiles_are_exact(spark, group):
    """Skewed groups, ties, null groups and values, NaN, infinities and one-row groups."""
    g = F.when(F.col("id") % 3 == 0, "big").when(F.col("id") % 7 == 0, None).otherwise(F.concat(F.lit("s"), F.col("id") % 5))
    g = F.when(F.col("id") == 1, "one").when(F.col("id").isin(2, 4), "nan").otherwise(g)
    x = F.pmod(F.xxhash64("id"), F.lit(9973)) / 7
    x = F.when(F.col("id") % 11 == 0, None).when(F.col("id").isin(2, 4, 8), float("nan")).when(F.col("id") % 1000 == 5, float("inf")).otherwise(x)
    x = F.when(F.col("id") % 4 == 0, 3.5).otherwise(x)
    df = spark.range(0, 20_000, 1, 12).select(g.alias("g"), (F.col("id") % 2).alias("h"), x.alias("x"))
    probs = [0.0, 0.25, 0.5, 0.99]
    want = _quantiles(ordered.exact_quantiles(df, "x", probs, group), group)
    assert _quantiles(ordered.bracketed_quantiles(df, "x", probs, group, size=256), group) == want


def test_bracketed_quantiles_of_no_rows_and_of_many_groups(spark, monkeypatch):
    df = spark.range(900).select((F.col("id") % 30).alias("g"), F.col("id").alias("x"))
    probs = [0.0, 0.25, 0.5, 0.99]
    assert ordered.bracketed_quantiles(df.limit(0), "x", probs, ["g"]).count() == 0
    assert [tuple(r) for r in ordered.bracketed_quantiles(df.limit(0), "x", probs).collect()] == [(None,) * 4]
    want = _quantiles(ordered.exact_quantiles(df, "x", probs, ["g"]), ["g"])
    monkeypatch.setattr(ordered, "SKETCH_GROUPS", 10)
    assert _quantiles(ordered.bracketed_quantiles(df, "x", probs, ["g"]), ["g"]) == want


def test_bracketed_quantiles_rank_few_values(spark, monkeypatch):
    """Of distinct values, only those inside the brackets are ranked: under 5 % of the rows."""
    ranked = []
    plain = ordered.running_totals
    monkeypatch.setattr(ordered, "running_totals", lambda df, *a: ranked.append(df.count()) or plain(df, *a))
    df = spark.range(0, 400_000, 1, 8).select((F.col("id") % 3).alias("g"), F.xxhash64("id").alias("x"))
    out = ordered.bracketed_quantiles(df, "x", [0.25, 0.5, 0.75], ["g"])
    assert out.count() == 3 and len(ranked) == 1
    assert ranked[0] < 0.05 * 400_000


@contextmanager
def settings(spark, **conf):
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


NO_BROADCAST = {"spark.sql.autoBroadcastJoinThreshold": "-1"}
NO_COALESCE = {"spark.sql.adaptive.coalescePartitions.enabled": "false"}


def test_lookup_join_spreads_hot_and_missing_keys(spark, skewed):
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    with settings(spark, **NO_BROADCAST, **NO_COALESCE):
        got = keyed.lookup_join(skewed, right, ["k"], row_id=["id"]).withColumn("part", F.spark_partition_id())
        sizes = [r["n"] for r in got.groupBy("part").agg(F.count("*").alias("n")).collect()]
    assert sum(sizes) == 6000
    assert max(sizes) < 6000 / 3


def test_exact_quantiles_and_totals_over_many_partitions(spark):
    df = spark.range(5000).select((F.col("id") % 3).alias("g"), F.pmod(F.xxhash64("id"), F.lit(977)).alias("x"))
    got = {r["g"]: (r["q_0"], r["q_1"]) for r in ordered.exact_quantiles(df, "x", [0.1, 0.5], ["g"]).collect()}
    want = {r["g"]: tuple(r["q"]) for r in df.groupBy("g").agg(F.percentile("x", F.array(F.lit(0.1), F.lit(0.5))).alias("q")).collect()}
    assert {g: pytest.approx(q) for g, q in got.items()} == want
    with settings(spark, **NO_COALESCE):
        again = {r["g"]: (r["q_0"], r["q_1"]) for r in ordered.exact_quantiles(df, "x", [0.1, 0.5], ["g"]).collect()}
        ids = ordered.assign_row_id(df.withColumn("id", F.monotonically_increasing_id()), [F.asc("x"), F.asc("id")])
        assert [r["row_id"] for r in ids.orderBy("x", "id").collect()] == list(range(5000))
        total = ordered.running_totals(spark.range(1, 101).withColumn("v", F.col("id")), [F.asc("id")], ["v"])
        assert [(r["cum_v"], r["tot_v"]) for r in total.orderBy("id").collect()][-2:] == [(4950, 5050), (5050, 5050)]
    assert {g: pytest.approx(q) for g, q in again.items()} == want


def test_prior_count_equals_self_join(spark):
    df = spark.range(800).select(
        F.col("id").alias("gb_id"),
        F.when(F.col("id") % 17 != 0, F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 40)).alias("author"),
        F.when(F.col("id") % 13 != 0, (1990 + F.col("id") % 9).cast("int")).alias("year"),
        (F.col("id") % 4 == 0).cast("int").alias("y"),
    )
    got = {r["gb_id"]: r["author_prior_count"] for r in history.author_prior_count(df, "author", "year", "y", "gb_id").collect()}
    rows = df.collect()
    want = {
        r["gb_id"]: sum(o["y"] for o in rows if r["author"] is not None and o["author"] == r["author"] and None not in (r["year"], o["year"]) and o["year"] < r["year"])
        for r in rows
    }
    assert got == want
    again = history.author_prior_count(df.repartition(13), "author", "year", "y", "gb_id")
    assert {r["gb_id"]: r["author_prior_count"] for r in again.collect()} == want


def test_strict_gap(spark):
    df = spark.createDataFrame([(1, 1, 1990), (2, 1, 1995), (3, 1, 1995)], "gb_id long, author int, year int")
    code = history.years_since_last(df, "author", "year", "gb_id")
    assert {r["gb_id"]: r["years_since_last_pub"] for r in code.collect()} == {1: None, 2: 5.0, 3: 0.0}
    strict = history.years_since_last(df, "author", "year", "gb_id", strict=True)
    assert {r["gb_id"]: r["years_since_last_pub"] for r in strict.collect()} == {1: None, 2: 5.0, 3: 5.0}


def test_best_row_is_limited_before_the_shuffle(spark, data_dir):
    text = plan(entry.queries()["keep_best_per_key"](spark, data_dir))
    assert text.count("WindowGroupLimit") >= 2


def test_filters_and_columns_reach_the_scan(spark, data_dir):
    text = plan(entry.queries()["filter_between"](spark, data_dir))
    assert "GreaterThan(p_size,10)" in text
    assert "p_brand" not in text.split("ReadSchema:")[1].splitlines()[0]


@pytest.mark.parametrize(
    "name",
    ["author_prior_count", "exact_key_merge", "cascade_join", "join_title_author", "fuzzy_title_author_join",
     "adaptation_fuzzy_join", "roc_auc", "describe_numeric", "max_author_prior", "incremental_cache", "boxplot_stats"],
)
def test_no_cross_join_and_no_unpartitioned_window(spark, data_dir, name):
    text = plan(entry.queries()[name](spark, data_dir))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Exchange SinglePartition" not in "".join(l for l in text.splitlines() if "Window" in l)


def test_checks_raise(spark):
    df = spark.createDataFrame([(1,), (1,)], "k int")
    with pytest.raises(quality.CheckFailed):
        quality.require(quality.expect_unique(df, ["k"]), "key not unique")
    quality.require(quality.expect_exact_count(df, 2), "two rows")


def test_a_written_stage_leaves_no_shuffle_files(spark):
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()

    def held():
        return {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*")}

    before = held()
    materialize(spark.range(1000).repartition(3, "id"))
    end = time.monotonic() + 10
    while held() - before and time.monotonic() < end:
        time.sleep(0.2)
    assert not held() - before


def test_lookup_join_has_a_task_per_so_many_rows(spark, skewed, monkeypatch):
    """Coalescing by bytes leaves few tasks, each of which sorts a share of the rows that grows with them."""
    monkeypatch.setattr(keyed, "TASK_ROWS", 100)
    right = spark.range(0, 300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    got = keyed.lookup_join(skewed, right.hint("merge"), ["k"], row_id=["id"], rows=6000)
    assert got.rdd.getNumPartitions() >= 60
    assert got.exceptAll(skewed.join(right, "k", "left").select("id", "k", "v", "w")).count() == 0
    authors = skewed.select("id", F.array(F.col("k").cast("string")).alias("a"), (F.col("id") % 9).alias("y"), (F.col("v") % 2).alias("l"))
    prior = history.max_author_prior(authors, "a", "y", "l", "id", lambda c: c)
    assert "REPARTITION_BY_NUM" in plan(prior)
    want = history.author_prior_count(authors.withColumn("k", F.get("a", 0)), "k", "y", "l", "id")
    assert prior.exceptAll(want.select("id", F.col("author_prior_count").alias("max_author_prior_count"))).count() == 0
