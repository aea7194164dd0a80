"""Data jobs behind a scoring service: defaults, options, bands, cohort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from caretide import schema as S
from caretide.functions import clinical as C
from caretide.functions.clinical import column
from caretide.operators.clean import encounter_order
from caretide.operators.explore import distinct_values, medians, modes


def _is_number(kind: str) -> bool:
    return kind in ("tinyint", "smallint", "int", "bigint", "float", "double")


def form_defaults(df: DataFrame) -> DataFrame:
    """Median of each numeric and mode of each other column, as rows.

    ``(column, number, text)``: one of the two is set.
    """
    numbers = [c for c, kind in df.dtypes if _is_number(kind)]
    others = [c for c in df.columns if c not in numbers]
    parts = []
    if numbers:
        parts.append(medians(df, numbers).select(
            "column", F.col("median").alias("number"), F.lit(None).cast("string").alias("text")
        ))
    if others:
        parts.append(modes(df, others).select(
            "column", F.lit(None).cast("double").alias("number"), F.col("mode").alias("text")
        ))
    return parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])


def defaults_dict(defaults: DataFrame) -> dict:
    """The defaults on the driver; there is one row per column."""
    return {
        r["column"]: r["text"] if r["number"] is None else r["number"]
        for r in defaults.collect()
    }


def form_options(df: DataFrame, columns: list[str] = S.FORM_OPTIONS) -> DataFrame:
    return distinct_values(df, columns)


def backfill(profiles: DataFrame, defaults: dict) -> DataFrame:
    """Fill missing fields, and add absent ones, from the defaults.

    Defaults enter as literals, so no join is needed and the same function
    works on a stream.
    """
    filled = {}
    for name in S.FEATURES:
        default = F.lit(defaults.get(name))
        if name in profiles.columns:
            kind = dict(profiles.dtypes)[name]
            if _is_number(kind):
                filled[name] = F.coalesce(column(name).cast("double"), default.cast("double"))
            else:
                filled[name] = F.coalesce(column(name), default.cast(kind))
        else:
            filled[name] = default
    return profiles.withColumns(filled)


def recompute_dependents(profiles: DataFrame) -> DataFrame:
    """Fields that follow from others: visits, abnormal results, utiliser flag."""
    visits = C.total([column(c) for c in S.VISIT_COLUMNS])
    return profiles.withColumns({
        "total_prior_visits": visits,
        "a1c_abnormal": C.is_true((column("a1c_tested") == 1) & (column("a1c_abnormal") == 1)),
        "glu_abnormal": C.is_true((column("glu_tested") == 1) & (column("glu_abnormal") == 1)),
        "high_utilizer_flag": C.high_utilizer(column("number_inpatient")),
    })


def band_scores(scored: DataFrame, threshold: float | Column) -> DataFrame:
    """Add the risk band and whether the score is at or above the threshold."""
    cut = F.lit(threshold) if isinstance(threshold, float) else threshold
    return scored.withColumns({
        "risk_band": C.risk_band(F.col("score"), cut),
        "above_threshold": (F.col("score") >= cut).cast("int"),
    })


def cohort(rows: DataFrame, size: int = S.COHORT_SIZE, row_id: str = S.ROW_ID) -> DataFrame:
    """The first ``size`` rows by row id, with their position from 0."""
    first = rows.orderBy(*encounter_order(row_id)).limit(size)
    # the window runs over the limited rows only
    place = Window.partitionBy(F.lit(1)).orderBy(*encounter_order(row_id))
    return first.withColumn("position", F.row_number().over(place) - 1)


def cohort_row(cohort_table: DataFrame, position: int) -> DataFrame:
    return cohort_table.where(F.col("position") == position)


def cohort_view(scored: DataFrame, threshold: float, size: int = S.COHORT_SIZE) -> DataFrame:
    """The cohort with score, band and the outcome in words."""
    rows = cohort(scored.select(S.ROW_ID, "label", "score"), size)
    return band_scores(rows, threshold).select(
        "position", S.ROW_ID, "score", "risk_band",
        C.outcome_text(F.col("label")).alias("actual_outcome"),
    )


def overview(df: DataFrame, label: str = S.RAW_LABEL) -> DataFrame:
    """Rows, columns and base rate of the raw table."""
    return df.agg(
        F.count("*").alias("n_rows"),
        F.avg(C.label_30day(column(label))).alias("base_rate"),
    ).withColumn("n_columns", F.lit(len(df.columns)))
