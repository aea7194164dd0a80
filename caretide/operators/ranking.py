"""Exact running totals and order statistics without a global sort.

A window without a partition key would move every row to one task. Here rows
are first reduced to one row per distinct value, with map-side combining, so
that ties and hot values shrink before the shuffle. That table of counts is
written once. If it is small, one window per key finishes the work. If not, it
is cut into value ranges of about equal size; each range is summed on its own,
and a table of range totals supplies what lies before it.

The range edges are read to the driver and become literals of the plan. They
come from a sketch and only steer the balance: any edges give the same exact
result. As literals they cannot change when a lost task is run again, which
could not be said of edges computed inside the plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from caretide.functions.clinical import column, quoted
from caretide.session import materialize

#: Distinct values in one range, about as many as a task sorts at once.
RANGE_ROWS = 200_000


def _doubles(values) -> str:
    """The numbers as a SQL array of doubles; one text parses at once."""
    return "array(" + ", ".join(f"double('{float(v)!r}')" for v in values) + ")"


def ranges_for(n: int) -> int:
    return max(1, -(-n // RANGE_ROWS))


def range_edges(df: DataFrame, value: str, ranges: int) -> list[float]:
    """At most ``ranges - 1`` increasing finite cut points of ``value``."""
    if ranges < 2:
        return []
    shares = _doubles(i / ranges for i in range(1, ranges))
    sketch = df.selectExpr(
        f"percentile_approx(double(`{value}`), {shares}, {10 * ranges})"
    ).first()[0]
    return sorted(v for v in set(sketch or []) if math.isfinite(v))


def with_range(df: DataFrame, value: str, ranges: int) -> DataFrame:
    """Add ``_range``, the number of the value range each row falls into."""
    edges = range_edges(df, value, ranges)
    if not edges:
        return df.withColumn("_range", F.lit(0.0))
    splits = [float("-inf"), *edges, float("inf")]
    return Bucketizer(splits=splits, inputCol=value, outputCol="_range").transform(df)


def has_value(value: Column) -> Column:
    return value.isNotNull() & ~F.isnan(value)


def _zero_if_first(total: Column) -> Column:
    return F.coalesce(total, F.lit(0).cast("bigint"))


def score_curve(scored: DataFrame, keys: Sequence[str] = ("model",),
                label: str = "label", score: str = "score",
                ranges: int | None = None) -> DataFrame:
    """One row per key and distinct score, with exact cumulative counts.

    ``pos`` and ``neg`` count the rows at the score, ``tp`` and ``fp`` those at
    or above it, ``pos_total`` and ``neg_total`` all of the key's rows, and
    ``next_pos`` and ``next_neg`` those at the next lower score. ``ranges`` only
    steers how the work is cut.
    """
    keys = list(keys)
    value = column(score).cast("double")
    counts = materialize(
        scored.where(has_value(value)).groupBy(*keys, value.alias("score")).agg(
            F.count_if(column(label) == 1).alias("pos"),
            F.count_if(column(label) == 0).alias("neg"),
        ),
        "score-counts",
    )
    step = F.struct("pos", "neg")
    counts = with_range(counts, "score", ranges or ranges_for(counts.count()))
    totals = counts.groupBy(*keys, "_range").agg(
        F.sum("pos").alias("range_pos"), F.sum("neg").alias("range_neg"),
        F.max_by(step, "score").alias("top"),
    )
    falling = Window.partitionBy(*keys).orderBy(F.desc("_range"))
    above = falling.rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy(*keys)
    offsets = totals.select(
        *keys, "_range",
        _zero_if_first(F.sum("range_pos").over(above)).alias("pos_above"),
        _zero_if_first(F.sum("range_neg").over(above)).alias("neg_above"),
        F.sum("range_pos").over(everything).alias("pos_total"),
        F.sum("range_neg").over(everything).alias("neg_total"),
        F.lead("top").over(falling).alias("next_top"),
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(F.desc("score"))
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    following = F.coalesce(F.lead(step).over(inside), F.col("next_top"))
    return (
        counts.join(offsets, [*keys, "_range"])
        .select(
            *keys, "score", "pos", "neg",
            (F.col("pos_above") + F.sum("pos").over(so_far)).alias("tp"),
            (F.col("neg_above") + F.sum("neg").over(so_far)).alias("fp"),
            "pos_total", "neg_total", following.alias("_next"),
        )
        .select("*", F.col("_next.pos").alias("next_pos"), F.col("_next.neg").alias("next_neg"))
        .drop("_next")
    )


def _running_counts(counts: DataFrame, ranges: int | None) -> DataFrame:
    """``(column, value, n)`` with ``upto``, the count at or below the value,
    and ``total``, the count of the column."""
    everything = Window.partitionBy("column")
    counts = with_range(counts, "value", ranges or ranges_for(counts.count()))
    rising = Window.partitionBy("column").orderBy("_range")
    before = F.sum("n").over(rising.rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.groupBy("column", "_range").agg(F.sum("n").alias("n")).select(
        "column", "_range", _zero_if_first(before).alias("below"),
        F.sum("n").over(everything).alias("total"),
    )
    inside = Window.partitionBy("column", "_range").orderBy("value")
    running = F.sum("n").over(inside.rowsBetween(Window.unboundedPreceding, 0))
    return counts.join(offsets, ["column", "_range"]).select(
        "column", "value", "n", (F.col("below") + running).alias("upto"), "total"
    )


def exact_quantiles(df: DataFrame, columns: Sequence[str], shares: Sequence[float] = (0.5,),
                    ranges: int | None = None) -> DataFrame:
    """Exact linear-interpolation quantiles: ``(column, share, value)``.

    One scan makes the table of distinct values and their counts; the rest
    depends on how many values there are, not on how many rows.
    """
    counts = materialize(
        df.selectExpr(*[f"double(`{c}`) as `{c}`" for c in columns])
        .unpivot([], quoted(columns), "column", "value")
        .where(has_value(F.col("value")))
        .groupBy("column", "value")
        .agg(F.count("*").alias("n")),
        "value-counts",
    )
    wanted = (
        _running_counts(counts, ranges)
        .withColumn("share", F.explode(F.expr(_doubles(shares))))
        .withColumn("position", F.col("share") * (F.col("total") - 1))
    )
    low, high = F.floor("position"), F.ceil("position")

    def value_at(row: Column) -> Column:
        first = F.col("upto") - F.col("n")
        return F.max(F.when((first <= row) & (row < F.col("upto")), F.col("value")))

    return (
        wanted.groupBy("column", "share")
        .agg(
            value_at(low).alias("low"), value_at(high).alias("high"),
            F.max(F.col("position") - low).alias("part"),
        )
        .select(
            "column", "share",
            (F.col("low") + F.col("part") * (F.col("high") - F.col("low"))).alias("value"),
        )
    )
