"""Distinct counts and quantiles from sketches that can be stored and merged.

One scan makes a sketch for each part of the data (a day, a site, a kind of admission) and
column. Sketches are rows of a table: new data add theirs, old data are not read again, and
any set of parts is merged without going back to the rows. The exact operators are in
``explore``; these state their error instead.

* **Distinct values**: HyperLogLog with ``2 ** LG_K`` registers. The standard error of a merged
  estimate is ``1.04 / sqrt(2 ** LG_K)`` of the true count, 0.8 percent; three of them,
  :data:`DISTINCT_ERROR`, hold in some 997 of 1000 cases.
* **Quantiles**: KLL of size :data:`KLL_K`. The value returned for a share ``p`` has a rank
  within :data:`RANK_ERROR` of ``p``, as a share of the rows, in some 99 of 100 cases.

Null and NaN take no part. A part whose values are all missing has a row without sketches,
and an estimate over such parts alone is null (distinct: 0). Sketches are bounded in size, some
16 KB for a distinct count and a few KB for a quantile, however many rows they stand for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from caretide.functions.clinical import column
from caretide.operators.ranking import has_value

#: Registers of a distinct-count sketch, as a power of two.
LG_K = 14
DISTINCT_ERROR = 3 * 1.04 / 2 ** (LG_K / 2)
#: Size of a quantile sketch and the rank error that this size is known for.
KLL_K = 400
RANK_ERROR = 0.0069


def distinct_sketches(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """``(part, attribute, n, sketch)``: for each part and column the values it holds.

    Sketches are merged before the shuffle, so that a part with most of the rows sends one
    per task.
    """
    sketches = [
        F.struct(F.lit(c).alias("attribute"), F.col(f"n{i}").alias("n"),
                 F.col(f"s{i}").alias("sketch")) for i, c in enumerate(columns)]
    return df.groupBy(column(part).cast("string").alias("part")).agg(*[
        made for i, c in enumerate(columns) for made in (
            F.count(column(c)).alias(f"n{i}"),
            F.hll_sketch_agg(column(c).cast("string"), F.lit(LG_K)).alias(f"s{i}"))
    ]).select("part", F.inline(F.array(*sketches)))


def distinct_estimates(sketches: DataFrame) -> DataFrame:
    """``(attribute, n, distinct)`` over all parts of the table given."""
    return sketches.groupBy("attribute").agg(
        F.sum("n").alias("n"),
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct"))


def quantile_sketches(df: DataFrame, columns: Sequence[str], part: str) -> DataFrame:
    """``(part, attribute, n, sketch)`` of numbers: one scan, no row per value."""
    made = []
    for i, c in enumerate(columns):
        value = column(c).cast("double")
        known = F.when(has_value(value), value)
        made += [F.count(known).alias(f"n{i}"), F.kll_sketch_agg_double(known, KLL_K).alias(f"s{i}")]
    sketches = [
        F.struct(F.lit(c).alias("attribute"), F.col(f"n{i}").alias("n"),
                 F.when(F.col(f"n{i}") > 0, F.col(f"s{i}")).alias("sketch"))
        for i, c in enumerate(columns)]
    return df.groupBy(column(part).cast("string").alias("part")).agg(*made).select(
        "part", F.inline(F.array(*sketches)))


def quantile_estimates(sketches: DataFrame, shares: Sequence[float] = (0.5,)) -> DataFrame:
    """``(attribute, n, share, value)`` over all parts of the table given."""
    merged = sketches.groupBy("attribute").agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", KLL_K).alias("sketch"))
    values = [
        F.struct(F.lit(p).alias("share"), F.when(
            F.col("n") > 0, F.kll_sketch_get_quantile_double("sketch", F.lit(p))).alias("value"))
        for p in map(float, shares)]
    return merged.select("attribute", "n", F.inline(F.array(*values)))


def rank_errors(df: DataFrame, estimates: DataFrame) -> DataFrame:
    """``(attribute, share, value, n_equal, rank_error)``: how far off the estimates are, exactly.

    A value covers the ranks of all rows equal to it; the error is the distance of the share
    from these ranks, as a share of the rows, and 0 inside. The estimates, one row per column
    and share, become columns of counts in one scan.
    """
    rows = [tuple(r) for r in estimates.select("attribute", "share", "value").collect()]
    kept = [r for r in rows if r[2] is not None]
    schema = "attribute string, share double, value double, below long, upto long, n long"
    if not kept:
        return df.sparkSession.createDataFrame([], schema).select(
            "attribute", "share", "value", F.lit(0).cast("long").alias("n_equal"),
            F.lit(0.0).alias("rank_error"))
    counted = []
    for i, (name, _, value) in enumerate(kept):
        x = column(name).cast("double")
        counted += [F.count_if(has_value(x) & (x < value)).alias(f"b{i}"),
                    F.count_if(has_value(x) & (x <= value)).alias(f"u{i}"),
                    F.count_if(has_value(x)).alias(f"n{i}")]
    lines = [F.struct(
        F.lit(name).alias("attribute"), F.lit(share).alias("share"), F.lit(value).alias("value"),
        F.col(f"b{i}").alias("below"), F.col(f"u{i}").alias("upto"), F.col(f"n{i}").alias("n"))
        for i, (name, share, value) in enumerate(kept)]
    off = F.greatest(F.col("below") / F.col("n") - F.col("share"),
                     F.col("share") - F.col("upto") / F.col("n"), F.lit(0.0))
    return df.agg(*counted).select(F.inline(F.array(*lines))).select(
        "attribute", "share", "value", (F.col("upto") - F.col("below")).alias("n_equal"),
        off.alias("rank_error"))
