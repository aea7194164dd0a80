"""Cleaning: missing values, eligibility, first encounter, label."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from caretide import schema as S
from caretide.functions import clinical as C
from caretide.functions.clinical import column


def text_columns(df: DataFrame) -> list[str]:
    return [name for name, kind in df.dtypes if kind == "string"]


def replace_sentinel(df: DataFrame, sentinel: str = S.MISSING) -> DataFrame:
    """Null for the sentinel in every text column, in one projection."""
    texts = set(text_columns(df))
    return df.selectExpr(*[
        f"nullif(`{c}`, '{sentinel}') as `{c}`" if c in texts else f"`{c}`"
        for c in df.columns
    ])


def drop_unused(df: DataFrame, keep_id: bool = True) -> DataFrame:
    """Drop the sparse columns; the encounter id goes on as the row id."""
    df = df.drop(*S.SPARSE_COLUMNS)
    if "encounter_id" not in df.columns:
        return df
    if keep_id:
        return df.withColumnRenamed("encounter_id", S.ROW_ID)
    return df.drop("encounter_id")


def is_terminal(disposition: str = "discharge_disposition_id"):
    return F.coalesce(
        column(disposition).isin(*S.TERMINAL_DISPOSITIONS), F.lit(False)
    )


def exclude_terminal(df: DataFrame) -> DataFrame:
    """Drop deaths and hospice discharges; an unknown disposition stays."""
    if "discharge_disposition_id" not in df.columns:
        return df
    return df.where(~is_terminal())


def encounter_order(order_col: str):
    """Encounter ids are text; their order is the order of their numbers."""
    return [column(order_col).try_cast("bigint"), column(order_col)]


def first_encounter(df: DataFrame, key: str = "patient_nbr",
                    order_col: str = S.ROW_ID) -> DataFrame:
    """Each patient's first row.

    Spark keeps only the best row per patient and map task before the shuffle
    (the window's group limit), so a patient with very many rows does not
    weigh on one task.
    """
    if key not in df.columns:
        return df
    window = Window.partitionBy(key).orderBy(*encounter_order(order_col))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.where("_rank = 1").drop("_rank", key)


def binarize_label(df: DataFrame) -> DataFrame:
    if S.RAW_LABEL not in df.columns:
        return df
    return df.withColumn(S.LABEL, C.label_30day(column(S.RAW_LABEL))).drop(
        S.RAW_LABEL, "readmitted_binary"
    )


def clean(df: DataFrame) -> DataFrame:
    return (
        df.transform(replace_sentinel)
        .transform(drop_unused)
        .transform(exclude_terminal)
        .transform(first_encounter)
        .transform(binarize_label)
    )


def cleaning_audit(df: DataFrame, key: str = "patient_nbr") -> DataFrame:
    """Rows at the start, removed by each step, and left, as one table.

    Rows are counted per patient first, so the only shuffle carries partial
    counts and no wide rows.
    """
    per_patient = (
        df.select(column(key).alias("key"), is_terminal().alias("terminal"))
        .groupBy("key")
        .agg(
            F.count("*").alias("n"),
            F.count_if("terminal").alias("terminal"),
        )
    )
    eligible = F.col("n") - F.col("terminal")
    sums = per_patient.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("initial"),
        F.coalesce(F.sum("terminal"), F.lit(0)).alias("removed_terminal"),
        F.coalesce(F.sum(F.greatest(eligible - 1, F.lit(0))), F.lit(0)).alias(
            "removed_repeat"
        ),
        F.count_if(eligible > 0).alias("final"),
    )
    steps = ["initial", "removed_terminal", "removed_repeat", "final"]
    return sums.unpivot([], steps, "step", "n_rows")


def require_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in the given order; missing ones are an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df.select(*[column(c) for c in columns])


def keep_values(df: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """Rows whose key occurs in ``values``."""
    return df.join(values, key, "left_semi")
