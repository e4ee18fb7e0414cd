"""Cases that small tables do not reach."""

import math

import pytest
from pyspark.sql import functions as F

from bindery.functions.dates import pub_month
from bindery.operators import features, profile
from bindery.operators.projection import top_n_dummies


@pytest.mark.parametrize("dof", [1, 2, 3, 30, 10**3, 6 * 10**6, 10**9])
def test_two_sided_t(spark, dof):
    """Against the closed forms of 1 and 2 degrees of freedom, known quantiles, and the normal limit."""
    known = {
        1: lambda t: 1 - 2 * math.atan(t) / math.pi,
        2: lambda t: 1 - t / math.sqrt(2 + t * t),
    }
    normal = lambda t: math.erfc(t / math.sqrt(2))
    for t in (0.0, 0.5, 1.96, 4.0, 7.0):
        column = profile._t_two_sided(F.lit(t), F.lit(dof))
        got = spark.range(1).select(column.alias("p")).first()["p"]
        if dof in known:
            assert got == pytest.approx(known[dof](t), abs=2e-4)
        elif dof >= 10**6:
            assert got == pytest.approx(normal(t), rel=1e-3)
    at = {3: 3.182446, 30: 2.042272, 10**3: 1.962339}  # 5 % points
    if dof in at:
        p = spark.range(1).select(profile._t_two_sided(F.lit(at[dof]), F.lit(dof)).alias("p")).first()["p"]
        assert p == pytest.approx(0.05, rel=1e-4)


def test_text_vectors_of_odd_texts(spark):
    rows = [("a", "Apple bestseller apple pear"), ("b", None), ("c", "  "), ("d", "pear plum"), ("e", "bestseller")]
    df = spark.createDataFrame(rows, "k string, t string")
    model = features.fit_text_vectors(df, "t", 2)
    assert model.vocabulary == ["pear", "apple"]
    out = {r["k"]: r["vector"].toArray().tolist() for r in model.transform(df).collect()}
    assert out["a"] == pytest.approx([math.log(6 / 3), 2 * math.log(6 / 2)])
    assert out["b"] == out["c"] == out["e"] == [0.0, 0.0]


def test_sentiment_with_a_word_in_a_third_of_all_places(spark):
    texts = [(i, " ".join(["the"] * 10 + [f"w{i}", "good"] * 10)) for i in range(300)] + [(900, None), (901, "")]
    df = spark.createDataFrame(texts, "k long, t string")
    lexicon = spark.createDataFrame([("good", 2.0), ("the", -1.0)], "word string, valence double")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = {r["k"]: r for r in features.lexicon_sentiment(df, "k", "t", lexicon).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    # 10 x (2 + 1) up, 10 x (1 + 1) down, 10 neutral
    assert {(r["desc_pos"], r["desc_neg"], r["desc_neu"]) for k, r in out.items() if k < 900} == {(0.5, 0.333, 0.167)}
    assert out[900]["desc_compound"] == out[901]["desc_compound"] == 0.0


def test_day_first_dates(spark):
    rows = [("14/09/2008", 9), ("14/9/08", 9), ("31-12-1999", 12), ("03/04/2001", 3), ("99/99/2000", 0)]
    df = spark.createDataFrame(rows, "s string, m int")
    assert df.filter(pub_month(F.col("s")) != F.col("m")).count() == 0


def test_tags_of_one_name_share_a_column(spark):
    df = spark.createDataFrame([(1, ["sci fi"]), (2, ["sci-fi"]), (3, ["x"])], "k int, tags array<string>")
    out = df.select("k", *[c.alias(n) for n, c in top_n_dummies(df, "tags", 5, "t_").items()]).orderBy("k").collect()
    assert [r["t_sci_fi"] for r in out] == [True, True, False]


def test_drop_correlated_on_the_training_rows_and_decimals(spark):
    rows = spark.range(100).selectExpr(
        "id", "cast(id as decimal(12, 2)) as a", "id * 2 as b", "case when id < 50 then id else -id end as c"
    )
    assert features.drop_correlated(rows, exclude=["id"]).columns == ["id", "a", "c"]
    assert features.drop_correlated(rows, exclude=["id"], fit_on=rows.filter("id < 50")).columns == ["id", "a"]


def test_projected_vectors(spark):
    """Zero for null and blank texts; whole for all others; like texts are nearer than unlike ones."""
    texts = [
        None, "", " \n", "a bestseller!", "red dragon of the north", "Red dragon, red dragon of the north", "seven blue moons over town",
        "word " * 3 + "red", " ".join(f"w{i}" for i in range(3000)),
    ]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string").withColumn("word", F.lit("clash"))
    got = {r["k"]: r["vector"] for r in features.projected_vectors(df, "k", "t", 64).collect()}
    assert sorted(got) == list(range(len(texts))) and all(len(v) == 64 for v in got.values())
    assert all(not any(got[k]) for k in (0, 1, 2)) and all(any(got[k]) for k in (3, 4, 5, 6, 8))

    def cosine(a, b):
        dot = sum(x * y for x, y in zip(a, b))
        return dot / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5

    assert cosine(got[4], got[5]) > 0.8 > 0.5 > abs(cosine(got[4], got[6]))
    assert features.projected_vectors(df.limit(0), "k", "t", 64).count() == 0


def test_checks_in_the_write(spark):
    """Lost, added and doubled keys, bad labels and too few positives fail, with no job beyond the write's."""
    from bindery.operators import quality

    base = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(None, 0)], "k long, label int")
    checks = [quality.keeps_keys(base, ["k"]), quality.label_domain("label"), quality.min_positives("label", 20)]
    out, numbers = quality.checked_write(base.repartition(3), "t", checks)
    assert out.count() == 51 and (numbers["n_rows"], numbers["n_bad_labels"], numbers["n_positive"]) == (51, 0, 25)

    tracker, jobs = spark.sparkContext.statusTracker(), []
    for group, run in (
        ("plain", lambda: quality.materialize(base.repartition(3), "t")),
        ("checked", lambda: quality.checked_write(base.repartition(3), "t", checks)),
    ):
        spark.sparkContext.setJobGroup(group, group)
        run()
        jobs.append(len(tracker.getJobIdsForGroup(group)))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs[0] == jobs[1]

    bad = {
        "keys": [
            base.filter("k <> 7 or k is null"), base.union(base.filter("k = 7")), base.filter("k is not null"),
            base.withColumn("k", F.when(F.col("k") == 7, 8).otherwise(F.col("k"))),
        ],
        "label must": [base.withColumn("label", F.when(F.col("k") != 3, F.col("label")).otherwise(2))],
        "positives": [base.withColumn("label", F.lit(0))],
    }
    for message, tables in bad.items():
        for df in tables:
            with pytest.raises(quality.CheckFailed, match=message):
                quality.checked_write(df, "t", checks)
    empty = base.limit(0)
    assert quality.checked_write(empty, "t", [quality.keeps_keys(empty, ["k"])])[0].count() == 0


@pytest.mark.parametrize("block", [4096, 3])
def test_thinned_curve(spark, monkeypatch, block):
    """Only bends are left, also where blocks meet; the area is that of all points."""
    import random

    from bindery.operators import evaluate

    monkeypatch.setattr(evaluate, "BLOCK", block)
    rng = random.Random(3)
    rows = [("r", float(rng.randrange(60)), rng.randrange(2)) for _ in range(300)]  # ties
    rows += [("s", float(i), int(i >= 50)) for i in range(100)] + [("one", float(i), 1) for i in range(9)] + [("r", None, 1)]
    df = spark.createDataFrame(rows, "m string, s double, y int")
    full, thin = (
        {m: [] for m in ("r", "s", "one")} for _ in range(2)
    )
    for points, curve in ((full, evaluate.roc_curve), (thin, evaluate.thinned_roc_curve)):
        for r in curve(df, "y", "s", ["m"]).collect():
            points[r["m"]].append((r["threshold"], r["fpr"], r["tpr"]))

    def area(points):
        way = [(0.0, 0.0)] + [(x, y) for _, x, y in sorted(points, reverse=True)]
        return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(way, way[1:]))

    assert [(x, y) for _, x, y in sorted(thin["s"], reverse=True)] == [(0.0, 1.0), (1.0, 1.0)]
    assert thin["one"] == [(0.0, None, 1.0)]
    assert set(thin["r"]) <= set(full["r"]) and abs(area(thin["r"]) - area(full["r"])) < 1e-12
    way = [(0.0, 0.0)] + [(x, y) for _, x, y in sorted(thin["r"], reverse=True)]
    for a, b, c in zip(way, way[1:], way[2:]):  # no point on the line of its neighbours
        assert abs((b[0] - a[0]) * (c[1] - b[1]) - (b[1] - a[1]) * (c[0] - b[0])) > 1e-12
    assert evaluate.thinned_roc_curve(df.limit(0), "y", "s", ["m"]).count() == 0
