"""Tables of per-row feature attributions.

Attributions come as ``entries``, one array of (feature, value, impact) per scored
row, or in the long form ``(row_id, feature, value, impact)`` with one row per
scored row and feature. :mod:`caretide.operators.tree_attribution` makes it for tree
ensembles, :func:`linear_attributions` for linear models; the rest reads it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from caretide import schema as S
from caretide.functions.clinical import column


def linear_entries(table: DataFrame, coefficients: dict[str, float],
                   means: dict[str, float], row_id: str = S.ROW_ID) -> DataFrame:
    """One row per scored row: ``entries``, an array of (feature, value, impact)."""
    entries = F.array(*[
        F.struct(
            F.lit(name).alias("feature"),
            column(name).cast("double").alias("value"),
            (F.lit(float(c)) * (column(name) - F.lit(float(means[name])))).alias("impact"),
        )
        for name, c in coefficients.items()
    ])
    return table.select(row_id, entries.alias("entries"))


def long_form(entries: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    return entries.select(row_id, F.inline("entries"))


def linear_attributions(table: DataFrame, coefficients: dict[str, float],
                        means: dict[str, float], row_id: str = S.ROW_ID) -> DataFrame:
    """``coefficient * (value - mean)`` of every feature of a linear model."""
    return long_form(linear_entries(table, coefficients, means, row_id), row_id)


def global_importance(long: DataFrame) -> DataFrame:
    """Mean absolute impact per feature."""
    return long.groupBy("feature").agg(F.avg(F.abs("impact")).alias("importance"))


def top_features(long: DataFrame, n: int = 5) -> DataFrame:
    return global_importance(long).orderBy(F.desc("importance"), "feature").limit(n)


def of_top_features(long: DataFrame, n: int) -> DataFrame:
    """The attributions of the ``n`` most important features.

    At most ``n`` names are broadcast.
    """
    chosen = top_features(long, n).select("feature")
    return long.join(F.broadcast(chosen), "feature", "left_semi")


def beeswarm(long: DataFrame, n: int = 20) -> DataFrame:
    return of_top_features(long, n).select(S.ROW_ID, "feature", "value", "impact")


def dependence(long: DataFrame, n: int = 5) -> DataFrame:
    """(value, impact) pairs of the most important features."""
    return of_top_features(long, n).select("feature", "value", "impact", S.ROW_ID)


def top_contributions(entries: DataFrame, n: int = 10, row_id: str = S.ROW_ID) -> DataFrame:
    """Each row's ``n`` largest impacts by absolute value, with their rank.

    The order is made inside the row's array, so nothing is shuffled.
    """
    falling = F.transform("entries", lambda e: F.struct(
        (-F.abs(e.impact)).alias("size"), e.feature.alias("feature"), e.value.alias("value"),
        e.impact.alias("impact")))
    top = F.slice(F.array_sort(falling), 1, n)
    return entries.select(row_id, F.posexplode(top).alias("rank", "e")).select(
        row_id, "e.feature", "e.value", "e.impact", (F.col("rank") + 1).alias("rank"))


def representative_cases(scored: DataFrame, cut: float = S.CASE_CUT,
                         row_id: str = S.ROW_ID) -> DataFrame:
    """The first true positive, true negative and false positive.

    Here a row counts as flagged strictly above the cut.
    """
    flagged = F.col("score") > cut
    outcome = (
        F.when(flagged & (F.col("label") == 1), "TP")
        .when(~flagged & (F.col("label") == 0), "TN")
        .when(flagged & (F.col("label") == 0), "FP")
    )
    place = F.struct(column(row_id).try_cast("bigint"), column(row_id))
    return (
        scored.withColumn("outcome", outcome)
        .where("outcome is not null")
        .groupBy("outcome")
        .agg(F.min_by(F.struct(row_id, "label", "score"), place).alias("case"))
        .select("outcome", "case.*")
    )


def waterfall(long: DataFrame, rows: DataFrame, base: float,
              row_id: str = S.ROW_ID) -> DataFrame:
    """Contributions of chosen rows, from small to large, with running totals.

    ``rows`` holds the chosen row ids; the totals run from the base value to
    the row's margin.
    """
    rising = Window.partitionBy(row_id).orderBy(F.abs("impact"), F.desc("feature"))
    so_far = rising.rowsBetween(Window.unboundedPreceding, 0)
    return (
        long.join(rows.select(row_id), row_id, "left_semi")
        .withColumn("step", F.row_number().over(rising))
        .withColumn("running", F.lit(float(base)) + F.sum("impact").over(so_far))
    )
