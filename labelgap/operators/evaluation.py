"""Quality of a binary classifier, from (label, prediction, score) rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from labelgap.operators.drift import auroc_verdict
from labelgap.operators.prefix import running_totals


def accuracy(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def _ratio(part, whole):
    return F.when(whole == 0, 0.0).otherwise(part / whole)


def f1_score(df: DataFrame, label: str = "label", prediction: str = "prediction", positive: int = 1) -> DataFrame:
    """F1 of the positive class; 0 where it is undefined."""
    counts = _class_counts(df, label, prediction, [positive])
    return counts.select(_ratio(2.0 * F.col("tp_0"), 2 * F.col("tp_0") + F.col("fp_0") + F.col("fn_0")).alias("f1"))


def _class_counts(df, label, prediction, classes):
    y, p = F.col(label), F.col(prediction)
    parts = []
    for i, c in enumerate(classes):
        parts += [
            F.count_if((y == c) & (p == c)).alias(f"tp_{i}"),
            F.count_if((y != c) & (p == c)).alias(f"fp_{i}"),
            F.count_if((y == c) & (p != c)).alias(f"fn_{i}"),
        ]
    return df.agg(*parts)


def confusion_matrix(
    df: DataFrame, label: str = "label", prediction: str = "prediction", classes: Sequence[int] = (0, 1)
) -> DataFrame:
    """``(actual, predicted, n)`` for every pair of classes, zeros included."""
    cells = [(a, b) for a in classes for b in classes]
    wide = df.agg(*[
        F.count_if((F.col(label) == a) & (F.col(prediction) == b)).alias(f"n_{i}") for i, (a, b) in enumerate(cells)
    ])
    rows = [
        F.struct(F.lit(a).alias("actual"), F.lit(b).alias("predicted"), F.col(f"n_{i}").alias("n"))
        for i, (a, b) in enumerate(cells)
    ]
    return wide.select(F.inline(F.array(*rows)))


def class_report(
    df: DataFrame,
    label: str = "label",
    prediction: str = "prediction",
    names: Sequence[str] = ("original", "synthetic"),
    classes: Sequence[int] = (0, 1),
) -> DataFrame:
    """Precision, recall, F1 and support per class, with accuracy, macro and weighted averages."""
    counts = _class_counts(df, label, prediction, classes)
    fields = ["precision", "recall", "f1"]
    per_class = {}
    for i, name in enumerate(names):
        tp, fp, fn = (F.col(f"{kind}_{i}") for kind in ("tp", "fp", "fn"))
        per_class[name] = {
            "precision": _ratio(tp, tp + fp),
            "recall": _ratio(tp, tp + fn),
            "f1": _ratio(2.0 * tp, 2 * tp + fp + fn),
            "support": tp + fn,
        }
    total = sum((m["support"] for m in per_class.values()), F.lit(0).cast("long"))
    hits = sum((F.col(f"tp_{i}") for i in range(len(names))), F.lit(0).cast("long"))
    macro = {f: sum((m[f] for m in per_class.values()), F.lit(0.0)) / len(names) for f in fields}
    weighted = {
        f: _ratio(sum((m[f] * m["support"] for m in per_class.values()), F.lit(0.0)), total) for f in fields
    }
    share = _ratio(hits, total)
    lines = {
        **per_class,
        "accuracy": {"precision": share, "recall": share, "f1": share, "support": total},
        "macro avg": {**macro, "support": total},
        "weighted avg": {**weighted, "support": total},
    }
    rows = [
        F.struct(
            F.lit(name).alias("class"),
            *[values[f].cast("double").alias(f) for f in fields],
            values["support"].cast("long").alias("support"),
        )
        for name, values in lines.items()
    ]
    return counts.select(F.inline(F.array(*rows)))


def score_counts(df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Positives and negatives per distinct score, highest first by ``descending = -score``."""
    return (
        df.filter(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(*by, (-F.col(score).cast("double") + F.lit(0.0)).alias("descending"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) != 1).alias("neg"))
    )


def auroc(
    df: DataFrame, label: str = "label", score: str = "score", by: Sequence[str] = (), buckets: int | None = None
) -> DataFrame:
    """Area under the ROC curve, exact, ties counted half. One row per ``by`` group (a model, say)."""
    totals = running_totals(score_counts(df, label, score, by), "descending", ["pos", "neg"], by, buckets=buckets)
    # A negative is beaten by all positives scored higher, and half beaten by those scored the same.
    beaten = F.col("neg") * (F.col("cum_pos") - F.col("pos") / 2)
    return totals.groupBy(*by).agg(
        F.try_divide(F.sum(beaten), F.max(F.col("total_pos").cast("double") * F.col("total_neg"))).alias("auroc")
    )


def roc_points(
    df: DataFrame,
    label: str = "label",
    score: str = "score",
    by: Sequence[str] = (),
    drop_intermediate: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """``(threshold, fpr, tpr)`` per distinct score, plus the start (0, 0) at an infinite threshold.

    With ``drop_intermediate`` a point is left out when the step to it equals the
    step after it, since it lies on the line between its neighbours. The
    first and the last score stay.
    """
    counts = score_counts(df, label, score, by)
    totals = running_totals(counts, "descending", ["pos", "neg"], by, following=["pos", "neg"], buckets=buckets)
    is_first = F.col("cum_pos") + F.col("cum_neg") == F.col("pos") + F.col("neg")
    same_step = (F.col("pos") == F.col("next_pos")) & (F.col("neg") == F.col("next_neg"))
    if drop_intermediate:
        totals = totals.filter(is_first | F.coalesce(~same_step, F.lit(True)))
    point = F.struct(
        (-F.col("descending") + F.lit(0.0)).alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("total_neg")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("total_pos")).alias("tpr"),
    )
    start = F.struct(F.lit(float("inf")).alias("threshold"), F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    # The row of the first score brings the start along, so the counts are not read again for it.
    return totals.select(*by, F.inline(F.when(is_first, F.array(start, point)).otherwise(F.array(point))))


def rank_models(results: DataFrame) -> DataFrame:
    """Models by the distance of their AUROC from 0.5, nearest first."""
    distance = F.abs(F.col("auroc") - 0.5)
    return results.withColumn("distance", distance).orderBy("distance", "model")


def discriminator_verdict(results: DataFrame) -> DataFrame:
    """Mean AUROC, mean distance from 0.5, and what they say."""
    means = results.agg(F.avg("auroc").alias("mean_auroc"), F.avg(F.abs(F.col("auroc") - 0.5)).alias("mean_distance"))
    return means.withColumn("verdict", auroc_verdict(F.col("mean_auroc")))


def class_balance(df: DataFrame, label: str = "target", few: int = 10) -> DataFrame:
    """Class counts, the share of the risk class in percent, and a warning when it is small."""
    counts = df.agg(
        F.count_if(F.col(label) == 0).alias("n_safe"),
        F.count_if(F.col(label) == 1).alias("n_risk"),
        F.count(F.lit(1)).alias("_rows"),
    )
    return counts.select(
        "n_safe", "n_risk",
        F.when(F.col("_rows") > 0, F.col("n_risk") / F.col("_rows") * 100).alias("risk_pct"),
        (F.col("n_risk") < few).alias("too_few"),
    )
