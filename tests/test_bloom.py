"""Bloom filters before joins against plain semi and anti joins."""

from pyspark.sql import functions as F

from bindery.operators import bloom


def test_joins_equal_plain_joins(spark):
    n = 20_000
    # One key holds a third of the rows; some keys are null; keys have two columns.
    rows = spark.range(n).select(
        F.col("id").alias("row"),
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 101 == 0, None).otherwise(F.col("id") % 997).alias("k"),
        (F.col("id") % 2).cast("string").alias("s"),
    )
    keys = spark.range(997).filter("id % 10 = 7").select(F.col("id").alias("k"), F.lit("1").alias("s"), F.lit(0).alias("x"))
    keys = keys.unionByName(keys)
    for max_bytes in (bloom.MAX_BYTES, 0):
        for own, how in ((bloom.semi_join, "left_semi"), (bloom.anti_join, "left_anti")):
            got = own(rows, keys, ["k", "s"], max_bytes=max_bytes)
            want = rows.join(keys, ["k", "s"], how)
            assert got.columns == rows.columns
            assert sorted(r["row"] for r in got.collect()) == sorted(r["row"] for r in want.collect())


def test_few_others_pass(spark):
    keys = spark.range(5_000).select((F.col("id") * 7919).alias("k"))
    made = bloom.bloom_filter(keys, ["k"])
    others = spark.range(50_000).select((F.col("id") * 7919 + 1).alias("k"))
    assert made.possible(keys, ["k"]).count() == 5_000
    assert made.possible(others, ["k"]).count() < 50_000 * 0.04


def test_empty_sides(spark):
    none = spark.createDataFrame([], "k long")
    some = spark.range(5).select(F.col("id").alias("k"))
    assert bloom.semi_join(some, none, ["k"]).isEmpty()
    assert bloom.anti_join(some, none, ["k"]).count() == 5
    assert bloom.semi_join(none, some, ["k"]).isEmpty()


def test_the_filter_comes_before_the_shuffle(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    keys = spark.range(0, 1000, 10).select(F.col("id").alias("k"))
    plan = bloom.semi_join(rows.hint("merge"), keys, ["k"])._jdf.queryExecution().toString()
    physical = plan[plan.index("Physical Plan") :]
    assert "BroadcastHashJoin" in physical


def test_a_semi_join_moves_only_what_the_filter_lets_through(spark):
    rows = spark.range(1000).select(F.col("id").alias("k"), F.lit(1).alias("v"))
    keys = spark.range(0, 1000, 10).select(F.col("id").alias("k"))
    plan = bloom.semi_join(rows, keys, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.split("\n") if "Join " in line]  # the last to run comes first
    assert ["_segment" in line for line in joins] == [False, True]
