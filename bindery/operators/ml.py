"""Time splits, imputation, scaling, weights and the classifiers, on pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import SQLTransformer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bindery.operators.evaluate import compare_models, evaluate_by, evaluate_predictions
from bindery.operators.keyed import append_rows
from bindery.operators.ordered import bracketed_quantiles
from bindery.session import discard, materialize, scratch_path

SEED = 42


def year_split(df: DataFrame, year: str, cutoff: int) -> tuple[DataFrame, DataFrame]:
    """Rows before the cutoff year, and from it on; a null year is in neither."""
    return df.filter(F.col(year) < cutoff), df.filter(F.col(year) >= cutoff)


def split_label_audit(year: Column, cutoff: int) -> Column:
    """'train' before the cutoff, else 'test' (a null year too)."""
    return F.when(year < cutoff, "train").otherwise("test")


def column_medians(train: DataFrame, columns: Sequence[str]) -> dict[str, float]:
    """Exact medians (one number per column); a column without any value is an error."""
    wide = train.select(*[F.col(c).cast("double").alias(c) for c in columns])
    long = wide.unpivot([], list(columns), "column", "value")
    found = {r["column"]: r["q_0"] for r in bracketed_quantiles(long, "value", [0.5], ["column"]).collect()}
    empty = [c for c in columns if c not in found]
    if empty:
        raise ValueError(f"feature columns without any value: {empty}")
    return {c: found[c] for c in columns}


def column_moments(df: DataFrame, columns: Sequence[str]) -> dict[str, tuple[float, float]]:
    """(mean, population std) per column; a constant column gets std 1."""
    aggs = []
    for c in columns:
        x = F.col(c).cast("double")
        aggs += [F.avg(x).alias(f"m_{c}"), F.stddev_pop(x).alias(f"s_{c}")]
    row = df.agg(*aggs).first()
    return {c: (row[f"m_{c}"], row[f"s_{c}"] or 1.0) for c in columns}


def median_impute(df: DataFrame, medians: dict[str, float]) -> DataFrame:
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(m)) for c, m in medians.items()})


def standard_scale(df: DataFrame, moments: dict[str, tuple[float, float]]) -> DataFrame:
    return df.withColumns({c: (F.col(c).cast("double") - m) / s for c, (m, s) in moments.items()})


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """n / (classes x n_class) per row; the class counts (one row per class) are broadcast."""
    counts = df.groupBy(label).agg(F.count("*").alias("_n"))
    n = counts.agg(F.sum("_n")).scalar()
    classes = counts.agg(F.count("*")).scalar()
    weights = counts.select(label, (n / (classes * F.col("_n"))).alias(name))
    return df.join(F.broadcast(weights), label, "left")


def _impute_stage(features: Sequence[str], medians: dict[str, float], moments=None) -> SQLTransformer:
    """Imputation (and scaling) with learned numbers, as a stage that is saved with the model."""
    parts = []
    for c in features:
        x = f"coalesce(cast(`{c}` as double), double({medians[c]!r}))"
        if moments:
            mean, std = moments[c]
            x = f"({x} - double({mean!r})) / double({std!r})"
        parts.append(f"{x} AS `in_{c}`")
    return SQLTransformer(statement=f"SELECT *, {', '.join(parts)} FROM __THIS__")


def _prepared(train: DataFrame, features: Sequence[str], label: str, scale: bool) -> tuple[PipelineModel, DataFrame]:
    """The learned stages before the classifier, and what it is fitted on: features, label and weight."""
    medians = column_medians(train, features)
    moments = column_moments(median_impute(train, medians), features) if scale else None
    impute = _impute_stage(features, medians, moments)
    assemble = VectorAssembler(inputCols=[f"in_{c}" for c in features], outputCol="features")
    before = PipelineModel([impute, assemble])
    ready = balanced_weights(before.transform(train), label).select("features", label, "weight")
    return before, ready.withColumn(label, F.col(label).cast("double"))


def _without_summary(model, df: DataFrame):
    """The fitted model alone.

    The summary of its training holds the session, which tasks are sent with the model, and a session
    that has observed a write can't be sent. A copy leaves the summary behind, or a stored model does.
    """
    if not getattr(model, "hasSummary", False):
        return model
    iterations = getattr(model.summary, "totalIterations", None)
    alone = model.copy()
    if alone.hasSummary:
        path = scratch_path(df.sparkSession, "fitted")
        model.write().save(path)
        alone = type(model).load(path)
    alone.iterations = iterations
    return alone


def _fit(train: DataFrame, features: Sequence[str], label: str, estimator, scale: bool) -> PipelineModel:
    before, ready = _prepared(train, features, label, scale)
    ready = ready.persist()
    try:
        return PipelineModel([*before.stages, _without_summary(estimator(ready).fit(ready), ready)])
    finally:
        ready.unpersist()


def logistic_baseline(train: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    """Impute, scale, L2 logistic regression on balanced weights (penalty 1/n on the weighted mean loss)."""

    def estimator(ready: DataFrame) -> LogisticRegression:
        return LogisticRegression(
            labelCol=label, weightCol="weight", maxIter=1000, tol=1e-6, regParam=1.0 / ready.count(),
            elasticNetParam=0.0, standardization=False,
        )

    return _fit(train, features, label, estimator, scale=True)


def convergence(model: PipelineModel, max_iter: int = 1000) -> tuple[int, bool]:
    """Iterations used and whether the fit stopped before the limit."""
    used = model.stages[-1].iterations
    return used, used < max_iter


def random_forest(
    train: DataFrame, features: Sequence[str], label: str, trees: int = 300, depth: int = 30
) -> PipelineModel:
    """Impute, then a forest on balanced weights (``depth`` 30 is Spark's limit). It learns from every row.

    Trees are put together on the driver; they grow with the rows as far as the labels are noise. Each row's place
    in every tree is kept between levels, so no level walks down from the roots again.
    """

    def estimator(_: DataFrame) -> RandomForestClassifier:
        return RandomForestClassifier(
            labelCol=label, weightCol="weight", numTrees=trees, maxDepth=depth, seed=SEED,
            featureSubsetStrategy="sqrt", maxMemoryInMB=1024, cacheNodeIds=True,
        )

    return _fit(train, features, label, estimator, scale=False)


def _boosting(label: str, rounds: int, depth: int = 3, rate: float = 0.1) -> GBTClassifier:
    return GBTClassifier(
        labelCol=label, weightCol="weight", maxIter=rounds, maxDepth=depth, stepSize=rate, seed=SEED
    )


def gradient_boosting(
    train: DataFrame, features: Sequence[str], label: str, rounds: int = 100, depth: int = 3, rate: float = 0.1
) -> PipelineModel:
    return _fit(train, features, label, lambda _: _boosting(label, rounds, depth, rate), scale=False)


def score(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Add the predicted class and the probability of class 1."""
    out = model.transform(df)
    added = [c for c in out.columns if c in ("features", "rawPrediction", "probability") or c.startswith("in_")]
    return out.withColumns(
        {"prediction": F.col("prediction").cast("int"), "p_positive": vector_to_array("probability")[1]}
    ).drop(*added)


def evaluate_model(model: PipelineModel, test: DataFrame, name: str, label: str) -> DataFrame:
    return evaluate_predictions(score(model, test), name, label, "prediction", "p_positive")


def temporal_grid_search(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    year: str,
    tune_cutoff: int,
    depths: Sequence[int] = (2, 3, 4),
    rates: Sequence[float] = (0.05, 0.1, 0.2),
    rounds: int = 100,
    parallelism: int = 3,
) -> tuple[PipelineModel, DataFrame]:
    """Boosting parameters chosen on later years of the training rows, then refitted on all of them.

    Both parts are prepared and written once; the fits share them, ``parallelism`` at a time. Predictions
    of all fits are written as one table and evaluated together. Returns the model and the table of tried
    parameters, best macro F1 first.
    """
    fit_rows, check_rows = year_split(train, year, tune_cutoff)
    before, ready = _prepared(fit_rows, features, label, scale=False)
    ready = materialize(ready, "grid-fit")
    check = materialize(before.transform(check_rows).select("features", F.col(label).alias("_label")), "grid-check")
    grid = [(depth, float(rate)) for depth in depths for rate in rates]
    boosting = _boosting(label, rounds)
    maps = [{boosting.maxDepth: depth, boosting.stepSize: rate} for depth, rate in grid]
    fits = boosting.fitMultiple(ready, maps)
    with ThreadPoolExecutor(parallelism) as pool:
        models = dict(pool.map(lambda _: next(fits), maps))
    scored = [
        score(models[at], check).select(
            F.lit(f"depth={depth},rate={rate}").alias("model"),
            F.lit(depth).alias("depth"),
            F.lit(rate).alias("rate"),
            "_label",
            "prediction",
            "p_positive",
        )
        for at, (depth, rate) in enumerate(grid)
    ]
    scored = materialize(append_rows(*scored), "grid-predictions")
    metrics = materialize(evaluate_by(scored, ["model", "depth", "rate"], "_label", "prediction", "p_positive"), "grid")
    table = compare_models(metrics.select("model", "f1_macro", "precision", "recall", "roc_auc", "depth", "rate"))
    discard(ready, check, scored)
    best = table.first()
    return gradient_boosting(train, features, label, rounds, best["depth"], best["rate"]), table


def _ranked(df: DataFrame, features: Sequence[str], values: Sequence[tuple], names: Sequence[str], top: int) -> DataFrame:
    rows = [(f, *map(float, v)) for f, v in zip(features, values)]
    schema = "feature string, " + ", ".join(f"{n} double" for n in names)
    table = df.sparkSession.createDataFrame(rows, schema)
    return table.orderBy(F.desc(F.abs(F.col(names[0]))), "feature").limit(top)


def coefficients(model: PipelineModel, df: DataFrame, features: Sequence[str], stds: dict[str, float], top: int = 20) -> DataFrame:
    """Largest coefficients, also in raw units (divided by the scale)."""
    coef = model.stages[-1].coefficients.toArray()
    values = [(c, c / stds[f]) for f, c in zip(features, coef)]
    return _ranked(df, features, values, ["coefficient", "per_raw_unit"], top)


def feature_importance(model: PipelineModel, df: DataFrame, features: Sequence[str], top: int = 20) -> DataFrame:
    values = [(v,) for v in model.stages[-1].featureImportances.toArray()]
    return _ranked(df, features, values, ["importance"], top)


class QualityGate(RuntimeError):
    pass


def retrain_and_compare(
    fit, train: DataFrame, test: DataFrame, label: str, recorded_f1: float, path: str,
    max_gap: float = 0.05, note_gap: float = 1e-6,
) -> tuple[DataFrame, str]:
    """Refit, evaluate on the held-out years, and save unless macro F1 is off by ``max_gap`` or more."""
    model = fit(train)
    metrics = evaluate_model(model, test, "retrained", label)
    gap = abs(metrics.first()["f1_macro"] - recorded_f1)
    if gap >= max_gap:
        raise QualityGate(f"macro F1 differs by {gap:.4f} from the recorded {recorded_f1:.4f}: not saved")
    model.write().overwrite().save(path)
    note = "differs slightly" if gap > note_gap else "reproduced"
    return metrics.withColumns({"gap": F.lit(gap), "note": F.lit(note)}), path
