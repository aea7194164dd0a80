"""Exploratory summaries: missingness, rates, histograms, correlation."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame, Window, functions as F

from caretide import schema as S
from caretide.functions import clinical as C
from caretide.functions.clinical import column, quoted
from caretide.operators.clean import is_terminal
from caretide.operators.ranking import exact_quantiles
from caretide.session import materialize


def missing_percent(df: DataFrame) -> DataFrame:
    """Percent of missing values per column, the worst first, zeros left out."""
    shares = df.agg(
        *[
            F.expr(f"try_divide((count(*) - count(`{c}`)) * 100, count(*)) as `{c}`")
            for c in df.columns
        ]
    )
    return (
        shares.unpivot([], quoted(df.columns), "column", "missing_pct")
        .where("missing_pct > 0")
        .orderBy(F.desc("missing_pct"), "column")
    )


def label_shares(df: DataFrame, label: str = S.RAW_LABEL) -> DataFrame:
    """Counts per non-null label value with their share of all rows."""
    counts = df.groupBy(label).agg(F.count("*").alias("n"))
    everything = F.sum("n").over(Window.partitionBy(F.lit(1)))  # one row per value
    return (
        counts.withColumn("pct", F.col("n") / everything * 100)
        .where(column(label).isNotNull())
    )


def class_balance(df: DataFrame, label: str) -> DataFrame:
    counts = df.agg(
        F.count_if(column(label) == 0).alias("negatives"),
        F.count_if(column(label) == 1).alias("positives"),
        F.count("*").alias("n"),
    )
    return counts.select(
        "negatives", "positives",
        F.try_divide("negatives", "positives").alias("imbalance_ratio"),
        F.try_divide(F.col("positives") * 100, F.col("n")).alias("positive_pct"),
    )


def rate_by(df: DataFrame, key: str, label: str, name: str = "value") -> DataFrame:
    """Mean label and row count per key; rows without key are left out."""
    return (
        df.where(column(key).isNotNull())
        .groupBy(column(key).alias(name))
        .agg(F.avg(column(label)).alias("rate"), F.count("*").alias("n"))
    )


def rate_by_attributes(df: DataFrame, keys: Sequence[str], label: str) -> DataFrame:
    """:func:`rate_by` for many keys, next to the overall rate, in one read.

    The overall rate is summed up from the groups of each key, null ones included.
    """
    long = df.selectExpr(
        f"`{label}` as _label", *[f"string(`{k}`) as `{k}`" for k in keys]
    ).unpivot("_label", quoted(keys), "attribute", "value")
    whole = Window.partitionBy("attribute")  # one row per value of a key
    return (
        long.groupBy("attribute", "value")
        .agg(F.sum("_label").alias("_sum"), F.count("_label").alias("_known"),
             F.count("*").alias("n"))
        .withColumn("overall_rate", F.try_divide(
            F.sum("_sum").over(whole), F.sum("_known").over(whole)))
        .where("value is not null")
        .select("attribute", "value", F.try_divide("_sum", "_known").alias("rate"), "n",
                "overall_rate")
    )


def value_table(df: DataFrame, columns: Sequence[str], kind: str = "string") -> DataFrame:
    """Long counts ``(attribute, value, n)`` over several columns, one pass."""
    return (
        df.selectExpr(*[f"{kind}(`{c}`) as `{c}`" for c in columns])
        .unpivot([], quoted(columns), "attribute", "value")
        .groupBy("attribute", "value")
        .agg(F.count("*").alias("n"))
    )


def histograms(df: DataFrame, columns: Sequence[str] = tuple(S.RAW_NUMERIC),
               bins: int = 30) -> DataFrame:
    """Equal-width histograms between each column's least and largest value.

    The columns are written once, so that what they come from is read once. A scan of
    them finds the ranges; a second bins each row where it lies, so that at most ``bins``
    counts per column and task are shuffled. Empty bins are left out, the last bin is
    closed.
    """
    df = materialize(df.select(*[column(c) for c in columns]), "numbers")
    ranges = df.selectExpr(*[
        part for c in columns for part in (f"min(double(`{c}`))", f"max(double(`{c}`))")
    ]).first()
    binned = []
    for i, c in enumerate(columns):
        low, high = ranges[2 * i], ranges[2 * i + 1]
        if low is None:
            continue
        if low == high:  # a single value gets a range of one around it
            low, high = low - 0.5, high + 0.5
        start, width = (f"double('{v!r}')" for v in (low, (high - low) / bins))
        binned.append(
            f"struct('{c}' as attribute, {start} as low, {width} as width, "
            f"size(filter(sequence(1, {bins - 1}), i -> {start} + i * {width} "
            f"<= double(`{c}`))) as bin, double(`{c}`) as value)")
    if not binned:
        return df.sparkSession.createDataFrame(
            [], "attribute string, bin int, bin_low double, n long")
    return (
        df.selectExpr(f"inline(array({', '.join(binned)}))").where("value is not null")
        .groupBy("attribute", "bin")
        .agg((F.min("low") + F.col("bin") * F.min("width")).alias("bin_low"),
             F.count("*").alias("n"))
    )


def top_values(df: DataFrame, columns: Sequence[str], n: int = 10) -> DataFrame:
    """The ``n`` most frequent values of each column; null counts as a value."""
    order = Window.partitionBy("attribute").orderBy(
        F.desc("n"), F.asc_nulls_last("value")
    )
    return (
        value_table(df, columns)
        .withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= n)
    )


def burden_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(C.medication_burden().alias("score")).agg(
        F.count("*").alias("n")
    ).orderBy("score")


def active_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(C.active_medications().alias("active")).agg(
        F.count("*").alias("n")
    ).orderBy("active")


def top_keys(df: DataFrame, key: str, n: int = 20) -> DataFrame:
    """The ``n`` most frequent non-null keys; ties go to the smaller key."""
    return (
        df.where(column(key).isNotNull())
        .groupBy(key).agg(F.count("*").alias("n"))
        .orderBy(F.desc("n"), key).limit(n)
    )


def top_key_rates(df: DataFrame, key: str, label: str, n: int = 20) -> DataFrame:
    """Rate and count of the most frequent keys.

    Both come from one grouping, so the table is scanned once and the rows of
    the chosen keys need not be looked up again.
    """
    return (
        df.where(column(key).isNotNull())
        .groupBy(key)
        .agg(F.avg(column(label)).alias("rate"), F.count("*").alias("n"))
        .orderBy(F.desc("n"), key).limit(n)
    )


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pearson correlation of each pair, over rows where both are known.

    All pairs are aggregated in one pass; the lower triangle comes out as rows.
    """
    pairs = list(combinations(columns, 2))
    # corr leaves out the rows in which either side is null
    row = df.selectExpr(*[f"double(`{c}`) as `{c}`" for c in columns]).agg(
        *[F.expr(f"corr(`{a}`, `{b}`) as p{i}") for i, (a, b) in enumerate(pairs)]
    )
    entries = ", ".join(
        f"struct('{b}' as row, '{a}' as column, p{i} as corr)"
        for i, (a, b) in enumerate(pairs)
    )
    return row.selectExpr(f"inline(array({entries}))")


def leakage_audit(df: DataFrame, label: str) -> DataFrame:
    """Terminal dispositions: count, percent of all rows, and their labels."""
    terminal = is_terminal()
    return df.agg(
        F.count_if(terminal).alias("n_terminal"),
        F.try_divide(F.count_if(terminal) * 100, F.count("*")).alias("pct_terminal"),
        F.coalesce(F.sum(F.when(terminal, column(label))), F.lit(0)).cast("bigint")
        .alias("label_sum"),
    )


def patient_duplicates(df: DataFrame, key: str = "patient_nbr") -> DataFrame:
    counts = df.agg(F.count("*").alias("encounters"), F.count_distinct(column(key)).alias("patients"))
    repeats = F.col("encounters") - F.col("patients")
    return counts.select(
        "encounters", "patients", repeats.alias("repeats"),
        F.try_divide(repeats * 100, F.col("encounters")).alias("repeat_pct"),
    )


def group_sizes(df: DataFrame, key: str = "patient_nbr") -> DataFrame:
    """How many keys have each number of rows: ``(size, n)``."""
    per_key = df.where(column(key).isNotNull()).groupBy(key).agg(F.count("*").alias("size"))
    return per_key.groupBy("size").agg(F.count("*").alias("n"))


def describe_group_sizes(df: DataFrame, key: str = "patient_nbr") -> DataFrame:
    """Count, mean, sample deviation, quartiles and range of the group sizes.

    Works on the table of sizes and how often each occurs, which has at most
    about the square root of twice as many rows as the input.
    """
    sizes = group_sizes(df, key)
    s, n = F.col("size").cast("double"), F.col("n")
    moments = sizes.agg(
        F.sum("n").alias("count"), F.sum(s * n).alias("s1"), F.sum(s * s * n).alias("s2"),
        F.min("size").alias("min"), F.max("size").alias("max"),
        F.percentile("size", F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75)), n).alias("q"),
    )
    mean = F.try_divide("s1", "count")
    variance = F.try_divide(F.col("s2") - F.col("s1") * mean, F.col("count") - 1)
    return moments.select(
        "count", mean.alias("mean"), F.sqrt(variance).alias("std"), "min",
        F.col("q")[0].alias("q25"), F.col("q")[1].alias("q50"), F.col("q")[2].alias("q75"),
        "max",
    )


def group_size_head(df: DataFrame, key: str = "patient_nbr", n: int = 15) -> DataFrame:
    return group_sizes(df, key).orderBy("size").limit(n)


def medians(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return exact_quantiles(df, columns, [0.5]).select("column", F.col("value").alias("median"))


def modes(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Most frequent value per column, the smallest on a tie, null if none."""
    counts = value_table(df, columns)
    known = F.col("value").isNotNull()
    best = F.min_by("value", F.when(known, F.struct(-F.col("n"), F.col("value"))))
    return counts.groupBy(F.col("attribute").alias("column")).agg(best.alias("mode"))


def distinct_values(df: DataFrame, columns: Sequence[str],
                    numbers: Sequence[str] | None = None) -> DataFrame:
    """Sorted distinct non-null values, text first, numbers in number order, as rows.

    With ``numbers`` only the values of these columns are taken as numbers.

    A value's ``position`` is its place inside a bucket of neighbouring values plus
    the size of the buckets before, so that no column is put in order by one task.
    """
    number = F.col("value").try_cast("bigint")
    if numbers is not None:
        number = F.when(F.col("attribute").isin(*numbers), number)
    distinct = (
        df.selectExpr(*[f"string(`{c}`) as `{c}`" for c in columns])
        .unpivot([], quoted(columns), "attribute", "value")
        .where("value is not null")
        .distinct()
        # neighbouring values: a thousand numbers, or texts that begin alike
        .withColumns({"_thousand": F.shiftright(number, 10), "_begin": F.when(
            number.isNull(), F.substring("value", 1, 3))})
    )
    bucket = ["attribute", "_thousand", "_begin"]
    in_order = Window.partitionBy("attribute").orderBy("_thousand", "_begin")
    before = F.sum("_n").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    offsets = distinct.groupBy(*bucket).agg(F.count("*").alias("_n")).select(
        *[F.col(c).alias(f"{c}_") for c in bucket], F.coalesce(before, F.lit(0)).alias("_before"))
    same = F.lit(True)
    for c in bucket:
        same &= F.col(c).eqNullSafe(F.col(f"{c}_"))
    inside = Window.partitionBy(*bucket).orderBy(number, "value")
    return (
        distinct.withColumn("_place", F.row_number().over(inside)).join(offsets, same)
        .select("attribute", "value",
                (F.col("_place") + F.col("_before")).cast("int").alias("position"))
    )


def value_shares(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Counts per value with their percentage of the column's rows."""
    counts = value_table(df, columns)
    totals = counts.groupBy("attribute").agg(F.sum("n").alias("total"))
    return counts.join(totals, "attribute").select(
        "attribute", "value", "n", (F.col("n") * 100 / F.col("total")).alias("pct"))


def value_difference(df: DataFrame, column_a: str, column_b: str) -> DataFrame:
    """Distinct non-null values of one column that another does not hold."""
    a = df.select(column(column_a).alias("value")).where("value is not null").distinct()
    b = df.select(column(column_b).alias("value"))
    return a.join(b, "value", "left_anti")
