"""Evaluation of scored tables ``(row_id, model, label, score)``.

Ranking metrics are exact: labels are counted per distinct score and every
metric follows from that one curve (:func:`ranking.score_curve`). Any number
of models, folds or trials is evaluated by one job through ``keys``. Rows whose
score is null or NaN take no part in any metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from caretide import schema as S
from caretide.functions.clinical import column
from caretide.operators.ranking import has_value, score_curve

KEYS = ("model",)
BINS = 10
# interior bin edges as doubles (i * 0.1, not the decimal fraction)
EDGES = [i * 0.1 for i in range(1, BINS)]


def _ratio(part: Column, whole: Column) -> Column:
    return F.coalesce(F.try_divide(part, whole), F.lit(0.0))


def _auroc() -> Column:
    """Share of positive-negative pairs in order, a tie counting half."""
    below = F.col("neg_total") - F.col("fp")
    pairs = F.sum(
        F.col("pos").cast("double") * (below.cast("double") + F.col("neg") / 2)
    )
    return F.try_divide(
        pairs, F.max("pos_total").cast("double") * F.max("neg_total").cast("double")
    )


def _average_precision() -> Column:
    """Sum of recall steps times the precision at each step."""
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    return F.sum(F.try_divide(F.col("pos"), F.col("pos_total")) * precision)


def _brier() -> Column:
    score = F.col("score")
    squared = F.col("pos") * (1 - score) * (1 - score) + F.col("neg") * score * score
    return F.sum(squared) / F.sum(F.col("pos") + F.col("neg"))


def _best_point(fn_cost: float, fp_cost: float) -> Column:
    """Cheapest operating point, the lowest threshold on a tie.

    Alerting nobody, at a threshold above every score, is one of the points.
    """
    missed = F.col("pos_total") - F.col("tp")
    point = F.struct(
        (fn_cost * missed + fp_cost * F.col("fp")).alias("cost"),
        F.col("score").alias("threshold"), F.col("tp"), F.col("fp"),
    )
    zero = F.lit(0).cast("bigint")
    nobody = F.struct(
        (fn_cost * F.max("pos_total")).alias("cost"),
        F.lit(S.ALERT_NOBODY).alias("threshold"), zero.alias("tp"), zero.alias("fp"),
    )
    return F.least(F.min(point), nobody)


def auroc(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return score_curve(scored, keys).groupBy(*keys).agg(_auroc().alias("auroc"))


def average_precision(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return score_curve(scored, keys).groupBy(*keys).agg(
        _average_precision().alias("auprc")
    )


def quick_metrics(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """AUROC and average precision from one curve."""
    return score_curve(scored, keys).groupBy(*keys).agg(
        _auroc().alias("auroc"), _average_precision().alias("auprc")
    )


def brier(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    error = column("score") - column("label")
    return scored.where(has_value(F.col("score"))).groupBy(*keys).agg(F.avg(error * error).alias("brier"))


def best_threshold(scored: DataFrame, keys: Sequence[str] = KEYS,
                   fn_cost: float = S.FALSE_NEGATIVE_COST,
                   fp_cost: float = S.FALSE_POSITIVE_COST) -> DataFrame:
    """The threshold with the least total cost of misses and false alarms."""
    return (
        score_curve(scored, keys).groupBy(*keys)
        .agg(_best_point(fn_cost, fp_cost).alias("best"))
        .select(*keys, F.col("best.threshold").alias("threshold"),
                F.col("best.cost").alias("cost"))
    )


def threshold_of(scored: DataFrame, model: str | None = None, **costs) -> float:
    """One model's best threshold as a number on the driver."""
    if model is not None:
        scored = scored.where(F.col("model") == model)
    found = best_threshold(scored, **costs).limit(2).collect()
    if len(found) != 1:
        raise ValueError(f"expected scores of one model, found {len(found)}")
    return found[0]["threshold"]


def apply_threshold(scored: DataFrame, threshold: float | Column) -> DataFrame:
    cut = F.lit(threshold) if isinstance(threshold, float) else threshold
    flagged = F.when(has_value(F.col("score")), F.col("score") >= cut)
    return scored.withColumn("predicted", flagged.cast("int"))


def confusion(predicted: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Counts tn, fp, fn, tp per key; always all four."""
    actual, said = F.col("label"), F.col("predicted")
    return predicted.groupBy(*keys).agg(
        F.count_if((actual == 0) & (said == 0)).alias("tn"),
        F.count_if((actual == 0) & (said == 1)).alias("fp"),
        F.count_if((actual == 1) & (said == 0)).alias("fn"),
        F.count_if((actual == 1) & (said == 1)).alias("tp"),
    )


def clinical_rates(counts: DataFrame) -> DataFrame:
    """Sensitivity, specificity, PPV, NPV and F1; 0 on an empty denominator."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns({
        "sensitivity": _ratio(tp, tp + fn),
        "specificity": _ratio(tn, tn + fp),
        "ppv": _ratio(tp, tp + fp),
        "npv": _ratio(tn, tn + fn),
        "f1": _ratio(2 * tp, 2 * tp + fp + fn),
    })


def metric_table(scored: DataFrame, keys: Sequence[str] = KEYS,
                 fn_cost: float = S.FALSE_NEGATIVE_COST,
                 fp_cost: float = S.FALSE_POSITIVE_COST,
                 curve: DataFrame | None = None) -> DataFrame:
    """All nine metrics per model at its own cost-optimal threshold.

    One aggregation over one curve; the scored rows are read once, or not at all
    if their ``curve`` is given.
    """
    curve = score_curve(scored, keys) if curve is None else curve
    row = curve.groupBy(*keys).agg(
        _auroc().alias("AUROC"), _average_precision().alias("AUPRC"),
        _brier().alias("Brier"), _best_point(fn_cost, fp_cost).alias("best"),
        F.max("pos_total").alias("p"), F.max("neg_total").alias("n"),
    )
    counts = row.select(
        *keys, "AUROC", "AUPRC", "Brier", F.col("best.threshold").alias("Opt_Threshold"),
        (F.col("n") - F.col("best.fp")).alias("tn"), F.col("best.fp").alias("fp"),
        (F.col("p") - F.col("best.tp")).alias("fn"), F.col("best.tp").alias("tp"),
    )
    return clinical_rates(counts).select(
        *keys, "AUROC", "AUPRC", F.col("f1").alias("F1"), "Brier",
        F.col("sensitivity").alias("Sensitivity"),
        F.col("specificity").alias("Specificity"),
        F.col("ppv").alias("PPV"), F.col("npv").alias("NPV"), "Opt_Threshold",
    )


def roc_points(scored: DataFrame, keys: Sequence[str] = KEYS,
               drop_collinear: bool = True, curve: DataFrame | None = None) -> DataFrame:
    """ROC curve points; a point in the middle of a straight run is left out."""
    curve = score_curve(scored, keys) if curve is None else curve
    whole = curve
    if drop_collinear:
        # a point lies on a straight run when the step after it repeats its own
        bend = (F.col("pos") != F.col("next_pos")) | (F.col("neg") != F.col("next_neg"))
        first = (F.col("tp") == F.col("pos")) & (F.col("fp") == F.col("neg"))
        curve = curve.where(first | F.col("next_pos").isNull() | bend)
    points = curve.select(
        *keys,
        F.try_divide("fp", "neg_total").alias("fpr"),
        F.try_divide("tp", "pos_total").alias("tpr"),
        F.col("score").alias("threshold"),
    )
    origin = whole.select(*keys).distinct().select(
        *keys, F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"),
        F.lit(float("inf")).alias("threshold"),
    )
    return points.unionByName(origin)


def pr_points(scored: DataFrame, keys: Sequence[str] = KEYS,
              curve: DataFrame | None = None) -> DataFrame:
    """Precision and recall at each score, ending at recall 0, precision 1."""
    curve = score_curve(scored, keys) if curve is None else curve
    points = curve.select(
        *keys,
        (F.col("tp") / (F.col("tp") + F.col("fp"))).alias("precision"),
        F.try_divide("tp", "pos_total").alias("recall"),
        F.col("score").alias("threshold"),
    )
    end = curve.select(*keys).distinct().select(
        *keys, F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"),
        F.lit(None).cast("double").alias("threshold"),
    )
    return points.unionByName(end)


def prevalence(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    return scored.groupBy(*keys).agg(F.avg("label").alias("prevalence"))


def _edges_passed(score: Column, inclusive: bool) -> Column:
    terms = [
        ((score >= edge) if inclusive else (score > edge)).cast("int") for edge in EDGES
    ]
    passed = terms[0]
    for term in terms[1:]:
        passed = passed + term
    return passed


def calibration(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Mean score and observed rate of ten equal bins, closed on the right."""
    return (
        scored.where(has_value(F.col("score")))
        .withColumn("bin", _edges_passed(F.col("score"), inclusive=False))
        .groupBy(*keys, "bin")
        .agg(
            F.avg("score").alias("mean_score"), F.avg("label").alias("observed_rate"),
            F.count("*").alias("n"),
        )
    )


def score_histogram(scored: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """Counts in ten equal bins over [0, 1], closed on the left."""
    inside = F.col("score").between(0.0, 1.0)
    return (
        scored.where(inside)
        .withColumn("bin", _edges_passed(F.col("score"), inclusive=True))
        .groupBy(*keys, "bin").agg(F.count("*").alias("n"))
    )


def alignment(left: DataFrame, right: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    """How far two scored tables hold the same rows with the same labels."""
    a = left.select(row_id, F.col("label").alias("a"), F.lit(1).alias("in_a"))
    b = right.select(row_id, F.col("label").alias("b"), F.lit(1).alias("in_b"))
    both = F.col("in_a").isNotNull() & F.col("in_b").isNotNull()
    return a.join(b, row_id, "full_outer").agg(
        F.count_if(both).alias("matched"),
        F.count_if(F.col("in_b").isNull()).alias("only_left"),
        F.count_if(F.col("in_a").isNull()).alias("only_right"),
        F.count_if(both & ~F.col("a").eqNullSafe(F.col("b"))).alias("label_mismatch"),
    )


def check_alignment(left: DataFrame, right: DataFrame) -> None:
    found = alignment(left, right).first()
    if found["only_left"] or found["only_right"] or found["label_mismatch"]:
        raise ValueError(f"scored tables do not align: {found.asDict()}")


def check_models_align(scored: DataFrame, row_id: str = S.ROW_ID) -> None:
    """An error unless every model scores the same rows with the same labels.

    One grouping by row serves any number of models.
    """
    models = scored.select(F.count_distinct("model").alias("models")).first()["models"]
    rows = scored.groupBy(row_id).agg(
        F.count("*").alias("n"), F.count_distinct("model").alias("seen"),
        F.min("label").eqNullSafe(F.max("label")).alias("same"),
        F.count("label").alias("labels"),
    )
    found = rows.agg(
        F.count_if((F.col("n") != models) | (F.col("seen") != models)).alias("incomplete_rows"),
        F.count_if(~F.col("same") | ~F.col("labels").isin(0, models)).alias("label_mismatch"),
    ).first()
    if found["incomplete_rows"] or found["label_mismatch"]:
        raise ValueError(f"scored tables do not align: {found.asDict()}")


def union_metrics(*tables: DataFrame) -> DataFrame:
    """Metric rows of several models as one table."""
    union = tables[0]
    for table in tables[1:]:
        union = union.unionByName(table)
    return union


def metric_view(metrics: DataFrame, digits: int = 4) -> DataFrame:
    """Rounded metrics with the best AUROC, AUPRC and F1 marked."""
    everything = Window.partitionBy(F.lit(1))  # one row per model
    numbers = [c for c, kind in metrics.dtypes if kind == "double"]
    rounded = metrics.withColumns({c: F.round(c, digits) for c in numbers})
    return rounded.withColumns({
        f"best_{c}": (F.col(c) == F.max(c).over(everything)).cast("int")
        for c in ("AUROC", "AUPRC", "F1")
    })


def fold_summary(folds: DataFrame, spread: float = 0.05) -> DataFrame:
    """Mean and population deviation of fold scores; flags a wide AP spread."""
    return folds.agg(
        F.avg("auroc").alias("mean_auroc"), F.stddev_pop("auroc").alias("std_auroc"),
        F.avg("auprc").alias("mean_auprc"), F.stddev_pop("auprc").alias("std_auprc"),
    ).withColumn("high_variance", (F.col("std_auprc") > spread).cast("int"))
