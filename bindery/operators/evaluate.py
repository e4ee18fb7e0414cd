"""Evaluation of 0/1 predictions: every metric comes from one small aggregate."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from bindery.operators.keyed import append_rows
from bindery.operators.ordered import running_totals


def _counts(df: DataFrame, label: str, prediction: str, group: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label) == 1, F.col(prediction) == 1
    return df.groupBy(*group).agg(
        F.count_if(y & p).alias("tp"),
        F.count_if(~y & p).alias("fp"),
        F.count_if(y & ~p).alias("fn"),
        F.count_if(~y & ~p).alias("tn"),
    )


def _ratio(a: Column, b: Column) -> Column:
    """A division by zero counts as 0."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def _f1(hit: str) -> Column:
    return _ratio(2.0 * F.col(hit), 2 * F.col(hit) + F.col("fp") + F.col("fn"))


def confusion_matrix(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Counts for all four (label, prediction) cells."""
    cells = [(0, 0, "tn"), (0, 1, "fp"), (1, 0, "fn"), (1, 1, "tp")]
    rows = F.array(
        *[F.struct(F.lit(y).alias("label"), F.lit(p).alias("prediction"), F.col(c).alias("n")) for y, p, c in cells]
    )
    return _counts(df, label, prediction).select(F.inline(rows))


def evaluate_predictions(
    df: DataFrame, model: str, label: str, prediction: str, score: str | None = None
) -> DataFrame:
    """One row: macro F1, precision and recall of class 1, and ROC-AUC where there is a score."""
    out = _counts(df, label, prediction).select(F.lit(model).alias("model"), *_rates())
    auc = roc_auc(df, label, score).select("roc_auc").scalar() if score else F.lit(None).cast("double")
    return out.withColumn("roc_auc", auc)


def _rates() -> list[Column]:
    return [
        ((_f1("tp") + _f1("tn")) / 2).alias("f1_macro"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("precision"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fn")).alias("recall"),
    ]


def evaluate_by(df: DataFrame, group: Sequence[str], label: str, prediction: str, score: str) -> DataFrame:
    """The metrics of :func:`evaluate_predictions` per group, such as all models of a search at once."""
    areas = roc_auc(df, label, score, group)
    return _counts(df, label, prediction, group).select(*group, *_rates()).join(areas, list(group), "left")


def classification_report(df: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted means."""
    c = _counts(df, label, prediction)
    tp, fp, fn, tn = (F.col(x) for x in ("tp", "fp", "fn", "tn"))
    neg = {"p": _ratio(tn, tn + fn), "r": _ratio(tn, tn + fp), "f": _f1("tn"), "n": tn + fp}
    pos = {"p": _ratio(tp, tp + fp), "r": _ratio(tp, tp + fn), "f": _f1("tp"), "n": tp + fn}
    total = pos["n"] + neg["n"]
    macro = {k: (neg[k] + pos[k]) / 2 for k in "prf"} | {"n": total}
    weighted = {k: _ratio(neg[k] * neg["n"] + pos[k] * pos["n"], total) for k in "prf"} | {"n": total}
    accuracy = dict.fromkeys("prf", _ratio(tp + tn, total)) | {"n": total}
    lines = {"0": neg, "1": pos, "accuracy": accuracy, "macro avg": macro, "weighted avg": weighted}
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("class"),
                m["p"].alias("precision"),
                m["r"].alias("recall"),
                m["f"].alias("f1"),
                m["n"].alias("support"),
            )
            for name, m in lines.items()
        ]
    )
    return c.select(F.inline(rows))


def _score_counts(df: DataFrame, label: str, score: str, group: Sequence[str]) -> DataFrame:
    return (
        df.filter(F.col(score).isNotNull())
        .groupBy(*group, F.col(score).alias("_score"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )


def roc_auc(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """Exact area with ties counted half, from the counts per distinct score."""
    ranked = running_totals(_score_counts(df, label, score, group), [F.col("_score")], ["pos", "neg"], group)
    below = F.col("cum_neg") - F.col("neg")
    won = F.sum(F.col("pos") * (below + F.col("neg") / 2))
    return ranked.groupBy(*group).agg(
        F.try_divide(won, F.max("tot_pos").cast("double") * F.max("tot_neg")).alias("roc_auc")
    )


def roc_curve(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """One point per distinct score (predict 1 from this score up), per model."""
    ranked = running_totals(
        _score_counts(df, label, score, group), [F.desc("_score")], ["pos", "neg"], group
    )
    return ranked.select(
        *group,
        F.col("_score").alias("threshold"),
        F.try_divide("cum_neg", "tot_neg").alias("fpr"),
        F.try_divide("cum_pos", "tot_pos").alias("tpr"),
    )


BLOCK = 4096  # points of a curve looked at in one window


def thinned_roc_curve(df: DataFrame, label: str, score: str, group: Sequence[str] = ()) -> DataFrame:
    """The points of :func:`roc_curve` where the curve bends, and its last one.

    A point between two steps of one direction lies on the line of its neighbours and is left out, so
    the curve and its area stay the same while runs of one class cost one point. Steps are compared as whole numbers. Points are numbered and dealt
    in blocks, each with the first step of the next one, so no model is held in one task. Models
    without positives or negatives have null rates and keep the points where the other rate bends.
    """
    group = list(group)
    counts = _score_counts(df, label, score, group).filter("pos + neg > 0").withColumn("_one", F.lit(1).cast("long"))
    ranked = running_totals(counts, [F.desc("_score")], ["pos", "neg", "_one"], group)
    number = F.col("cum__one") - 1
    block = F.floor(number / BLOCK).cast("long")
    peeks = F.when((number % BLOCK == 0) & (block > 0), F.array(block, block - 1)).otherwise(F.array(block))
    dealt = ranked.withColumn("_at", number).withColumn("_block", F.explode(peeks))
    ahead = Window.partitionBy(*group, "_block").orderBy("_at")
    bends = F.col("pos") * F.lead("neg").over(ahead) != F.col("neg") * F.lead("pos").over(ahead)
    kept = dealt.withColumn("_bends", bends).filter(F.floor(F.col("_at") / BLOCK) == F.col("_block"))
    ends = F.col("cum__one") == F.col("tot__one")
    return kept.filter(ends | F.col("_bends")).select(
        *group,
        F.col("_score").alias("threshold"),
        F.try_divide("cum_neg", "tot_neg").alias("fpr"),
        F.try_divide("cum_pos", "tot_pos").alias("tpr"),
    )


def naive_baselines(df: DataFrame, label: str) -> DataFrame:
    """The floors every model is shown against: always 0 and always 1."""
    rows = [
        evaluate_predictions(df.select(label, F.lit(k).alias("_p")), f"always_{k}", label, "_p") for k in (0, 1)
    ]
    return append_rows(*rows)


def compare_models(*metrics: DataFrame) -> DataFrame:
    return append_rows(*metrics).orderBy(F.desc_nulls_last("f1_macro"), F.asc("model"))
