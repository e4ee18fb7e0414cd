"""Features, splits, training and evaluation."""

import datetime
import hashlib
import itertools
import math
import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from bindery import schemas
from bindery.operators import evaluate, features, ml, profile, quality
from bindery.operators.linkage import join_title_author
from bindery.plans import load_all, models
from bindery.plans.registry import QUERIES, Tables


@pytest.fixture(scope="module")
def rows(spark):
    rnd = random.Random(1)
    data = []
    for i in range(600):
        y = int(rnd.random() < 0.25)
        data.append((i, y, 1990 + i % 20, rnd.gauss(2.0 * y, 1), None if i % 7 == 0 else rnd.gauss(0, 1), float(rnd.random() < 0.5)))
    return spark.createDataFrame(data, "id int, y int, year int, a double, b double, c double").repartition(4)


INPUTS = ["a", "b", "c"]


def test_models_beat_the_naive_floor(rows):
    train, test = ml.year_split(rows, "year", 2003)
    floor = max(r["f1_macro"] for r in evaluate.naive_baselines(test, "y").collect())
    logistic = ml.logistic_baseline(train, INPUTS, "y")
    assert ml.convergence(logistic)[1]
    for model in (logistic, ml.random_forest(train, INPUTS, "y", trees=20, depth=8), ml.gradient_boosting(train, INPUTS, "y", rounds=5)):
        m = ml.evaluate_model(model, test, "m", "y").first()
        assert m["f1_macro"] > floor + 0.1
        assert m["roc_auc"] > 0.8


def test_models_score_after_an_observed_write(rows):
    """A write with checks leaves the session unfit for sending; a fitted model must not carry it."""
    quality.checked_write(rows, "observed", [quality.label_domain("y")])
    train, test = ml.year_split(rows, "year", 2003)
    logistic = ml.logistic_baseline(train, INPUTS, "y")
    used, converged = ml.convergence(logistic)
    assert used > 0 and converged
    for model in (logistic, ml.random_forest(train, INPUTS, "y", trees=3, depth=3)):
        assert ml.score(model, test).filter("p_positive between 0 and 1").count() == test.count()


def test_grid_and_gate(rows, tmp_path):
    train, test = ml.year_split(rows, "year", 2003)
    model, table = ml.temporal_grid_search(train, INPUTS, "y", "year", 1999, depths=(2,), rates=(0.1, 0.2), rounds=3)
    assert table.count() == 2 and model.stages

    def fit(r):
        return ml.logistic_baseline(r, INPUTS, "y")

    f1 = ml.evaluate_model(fit(train), test, "m", "y").first()["f1_macro"]
    metrics, path = ml.retrain_and_compare(fit, train, test, "y", f1, str(tmp_path / "m"))
    assert metrics.first()["note"] == "reproduced"
    from bindery.sources.sinks import load_model

    assert ml.score(load_model(path), test).filter("p_positive between 0 and 1").count() == test.count()
    with pytest.raises(ml.QualityGate):
        ml.retrain_and_compare(fit, train, test, "y", f1 + 0.1, str(tmp_path / "n"))


def test_grid_equals_fits_one_by_one(rows, monkeypatch):
    """One preparation and one table of predictions give the metrics of separate fits."""
    train, _ = ml.year_split(rows, "year", 2003)
    prepared = []
    plain = ml.column_medians
    monkeypatch.setattr(ml, "column_medians", lambda *a: prepared.append(1) or plain(*a))
    model, table = ml.temporal_grid_search(train, INPUTS, "y", "year", 1999, depths=(1, 3), rates=(0.1, 0.3), rounds=3)
    got = {(r["depth"], r["rate"]): r for r in table.collect()}
    assert len(prepared) == 2  # the search and the last fit
    assert len(got) == 4
    fit_rows, check_rows = ml.year_split(train, "year", 1999)
    for depth, rate in ((1, 0.3), (3, 0.1)):
        one = ml.gradient_boosting(fit_rows, INPUTS, "y", 3, depth, rate)
        want = ml.evaluate_model(one, check_rows, "m", "y").first()
        for c in ("f1_macro", "precision", "recall", "roc_auc"):
            assert got[depth, rate][c] == pytest.approx(want[c])
    best = table.first()
    assert best["f1_macro"] == max(r["f1_macro"] for r in got.values())
    assert model.stages[-1].getMaxDepth() == best["depth"]


def test_importances_find_the_signal(rows):
    train, _ = ml.year_split(rows, "year", 2003)
    forest = ml.random_forest(train, INPUTS, "y", trees=10, depth=5)
    assert ml.feature_importance(forest, train, INPUTS).first()["feature"] == "a"
    stds = {c: s for c, (_, s) in ml.column_moments(train, INPUTS).items()}
    assert ml.coefficients(ml.logistic_baseline(train, INPUTS, "y"), train, INPUTS, stds, 1).first()["feature"] == "a"


def test_the_forest_learns_from_every_row(spark):
    """Its roots hold a draw, with replacement, of as many rows as there are: more than the 200,000 of an earlier limit."""
    n = 300_000
    x = (F.col("id") % 100).cast("double")
    df = spark.range(n).select(x.alias("a"), (F.col("id") % 7).cast("double").alias("b"), (F.col("id") % 100 < 30).cast("int").alias("y"))
    model = ml.random_forest(df, ["a", "b"], "y", trees=4, depth=2)
    drawn = [t._java_obj.rootNode().impurityStats().rawCount() for t in model.stages[-1].trees]
    assert len(drawn) == 4 and all(abs(d - n) < 10 * n**0.5 for d in drawn)


def test_empty_feature_fails(rows):
    with pytest.raises(ValueError):
        ml.column_medians(rows.withColumn("z", F.lit(None).cast("double")), ["a", "z"])


def test_auc_equals_pair_counting(spark):
    rnd = random.Random(2)
    data = [(rnd.randint(0, 1), float(rnd.randint(0, 9))) for _ in range(200)]
    pairs = [(p > n) + 0.5 * (p == n) for (y, p), (z, n) in itertools.product(data, data) if y == 1 and z == 0]
    got = evaluate.roc_auc(spark.createDataFrame(data, "y int, s double"), "y", "s").first()["roc_auc"]
    assert got == pytest.approx(sum(pairs) / len(pairs))
    one_class = spark.createDataFrame([(1, 0.5)], "y int, s double")
    assert evaluate.roc_auc(one_class, "y", "s").first()["roc_auc"] is None


def test_perfect_and_empty_predictions(spark):
    df = spark.createDataFrame([(1, 1), (0, 0)], "y int, p int")
    m = evaluate.evaluate_predictions(df, "m", "y", "p").first()
    assert (m["f1_macro"], m["precision"], m["recall"], m["roc_auc"]) == (1.0, 1.0, 1.0, None)
    none = evaluate.evaluate_predictions(df.withColumn("p", F.lit(0)), "m", "y", "p").first()
    assert (none["precision"], none["recall"]) == (0.0, 0.0)


def test_p_values(spark):
    data = [(i % 2, float((i * 37) % 19) + (i % 2) * 2) for i in range(40)]
    got = profile.pointbiserial(spark.createDataFrame(data, "y int, x double"), "y", ["x"]).first()
    assert got["n"] == 40
    # Two-sided tails of Student's t: known values at one and at ten degrees of freedom.
    tails = spark.range(1).select(
        profile._t_two_sided(F.lit(1.0), F.lit(1)).alias("one"), profile._t_two_sided(F.lit(2.228138852), F.lit(10)).alias("ten")
    ).first()
    assert tails["one"] == pytest.approx(0.5, abs=1e-6)
    assert tails["ten"] == pytest.approx(0.05, abs=1e-6)


def test_correlation_handles_gaps_and_constants(spark):
    df = spark.createDataFrame([(1.0, 2.0, 5.0, None), (2.0, None, 5.0, 1.0), (3.0, 6.5, 5.0, 2.0), (4.0, 8.0, 5.0, 2.5)], "a double, b double, k double, d double")
    got = {(r["a"], r["b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "k", "d"]).collect()}
    assert got["a", "k"] is None
    assert got["a", "b"] == pytest.approx(df.dropna(subset=["b"]).corr("a", "b"))
    assert got["b", "d"] == pytest.approx(1.0)


def test_greedy_drop():
    pairs = [("a", "b", 0.95), ("a", "c", 0.2), ("a", "d", None), ("b", "c", 0.99), ("c", "d", -0.93)]
    assert features.correlated_to_drop(pairs) == ["b", "d"]


def test_leakage_guard(spark):
    df = spark.createDataFrame([(1, 2.0, 3)], "gb_id int, average_rating double, words int")
    with pytest.raises(features.LeakageError):
        features.guard_leakage(df, "gb_id")
    renamed = schemas.with_roles(df).withColumnRenamed("average_rating", "harmless")
    assert schemas.leaked_columns(renamed, ["gb_id"]) == ["harmless"]
    assert features.guard_leakage(df.select("gb_id", "words"), "gb_id").columns == ["gb_id", "words"]


def test_sentiment(spark):
    df = spark.createDataFrame([(1, "Good, good bad day"), (2, None), (3, "New York Times bestseller")], "id int, t string")
    lexicon = spark.createDataFrame([("good", 2.0), ("bad", -1.0)], "word string, valence double")
    got = {r["id"]: r for r in features.lexicon_sentiment(df, "id", "t", lexicon).collect()}
    assert got[1]["desc_pos"] == pytest.approx(6 / 9, abs=1e-3) and got[1]["desc_neg"] == pytest.approx(2 / 9, abs=1e-3)
    assert got[1]["desc_compound"] == pytest.approx(3 / 24**0.5, abs=1e-4)
    assert got[2]["desc_compound"] == 0.0 and got[3]["desc_neu"] == 0.0


def test_blank_keys_match_each_other(spark):
    base = spark.createDataFrame([(1, None, None), (2, "X", ["Y"])], "id int, t string, a array<string>")
    right = spark.createDataFrame([("!", "", 9)], "rt string, ra string, v int")
    got = join_title_author(base, right, "t", "a", "rt", "ra", ["v"], [F.asc("v")], row_id=["id"])
    assert {r["id"]: r["v"] for r in got.collect()} == {1: 9, 2: None}


def test_tfidf_rows_of_any_text(spark, tmp_path):
    """One row per word of a text that not every text holds; null and blank texts have none."""
    load_all()
    texts = [(1, "red red gear"), (2, "gear, Bolt!"), (3, None), (4, " "), (5, "bestseller")]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r["doc_id"], r["word"]): r["weight"] for r in QUERIES["text_vectors_tfidf"](spark, str(tmp_path)).collect()}
    want = {(1, "red"): 2 * math.log(6 / 2), (1, "gear"): math.log(6 / 3), (2, "gear"): math.log(6 / 3), (2, "bolt"): math.log(6 / 2)}
    assert got == pytest.approx(want, abs=1e-4)


def test_training_rows_are_made_once(spark, tmp_path):
    """Fits and evaluations read stored rows, not the texts and joins they come from."""
    texts = [(i, f"The word {i}, and more.") for i in range(1, 21)]
    labels = [(i, i % 2) for i in range(1, 21)]
    orders = [(i, datetime.datetime(1995 + i % 7, 1, 2)) for i in range(1, 21)]
    spark.createDataFrame(texts, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp").write.parquet(f"{tmp_path}/orders.parquet")
    train, test = models._train_test(Tables(spark, str(tmp_path)))
    assert sorted(r["doc_id"] for r in train.collect()) == [i for i in range(1, 21) if i % 7 < 5]
    assert sorted(r["doc_id"] for r in test.collect()) == [i for i in range(1, 21) if i % 7 >= 5]
    for part in (train, test):
        assert part.inputFiles() and all("training-rows" in f for f in part.inputFiles())


def _texts(spark, with_odd_keys):
    """Texts of shared and own words, blank and null ones, one accolade; some keys twice or null."""
    rows = [(i, " ".join([f"w{i * j % 13}" for j in range(i % 9)] + [f"own{i}", "Über", "award-winning", "the"])) for i in range(40)]
    rows += [(100, None), (101, "  "), (102, "the " * 50 + "w1 w1")]
    if with_odd_keys:
        rows += [(3, "the w1 again"), (3, None), (None, "w2 w3"), (None, "w2 lost"), (104, "")]
    return spark.createDataFrame(rows, "k long, t string")


def test_words_are_counted_where_they_are_read(spark, monkeypatch):
    """A task that counts the words of many texts in one hash table takes memory with the number of texts."""
    plans, write = {}, features.materialize

    def seen(df, name="stage", **options):
        plans[name] = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
        return write(df, name, **options)

    monkeypatch.setattr(features, "materialize", seen)
    monkeypatch.setattr(features, "BATCH_WORDS", 20)
    monkeypatch.setattr(features, "BATCH_ROWS", 7)
    lexicon = spark.createDataFrame([("the", 2.0), ("w1", -1.0), ("über", 0.5)], "word string, valence double")
    got = {r["k"]: tuple(r)[1:] for r in features.lexicon_sentiment(_texts(spark, True), "k", "t", lexicon).collect()}
    assert "HashAggregate" not in plans["word-counts"] and "Exchange" not in plans["word-counts"]
    assert got[100] == got[101] == got[104] == (0.0, 0.0, 0.0, 0.0)
    # 51 words of value 2 or -1: 50 * 3 positive, 2 * 2 negative.
    assert got[102][:3] == (round(4 / 154, 3), 0.0, round(150 / 154, 3))
    # Both rows of key 3 are one text, and so are those without a key.
    assert len(got) == 45 and got[None] == (0.0, 1.0, 0.0, 0.0)


@pytest.mark.parametrize("odd", [False, True])
@pytest.mark.parametrize("head", [1 << 17, 5])
def test_projected_vectors_by_brute_force(spark, monkeypatch, head, odd):
    """The words beyond the most frequent ones are added too; rows of one key are one text."""
    monkeypatch.setattr(features, "HEAD", head)
    monkeypatch.setattr(features, "BATCH_WORDS", 20)
    df = _texts(spark, odd)
    held, n = {}, df.count()
    for r in df.collect():
        words = re.split(r"[^\w']+|_", (r["t"] or "").replace("award-winning", "").lower())
        held.setdefault(r["k"], Counter()).update(w for w in words if w)
    texts = Counter(w for words in held.values() for w in words)
    want = {}
    for k, words in held.items():
        want[k] = [0] * 16
        for w, c in words.items():
            weight = math.floor(1000.0 * c * math.log((n + 1) / (texts[w] + 1)) + 0.5)
            digest = hashlib.md5(w.encode()).hexdigest()
            for i in range(4):
                number = int(digest[8 * i : 8 * i + 8], 16)
                want[k][number % 16] += weight if number >= 1 << 31 else -weight
    got = features.projected_vectors(df, "k", "t", 16).collect()
    assert len(got) == n
    assert all(r["vector"] == (want[r["k"]] if r["k"] is not None else [0] * 16) for r in got)


def test_projected_vectors_spread_no_words_over_places(spark, monkeypatch):
    """Words were multiplied by their places and sorted; now only rare ones leave their text, as one row."""
    df = features.projected_vectors(_texts(spark, False), "k", "t", 16)
    plan = df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "simple")
    assert "Generate" not in plan and "MapInArrow" in plan
