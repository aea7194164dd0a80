"""Scans, checks and sinks over tables derived from the given ones."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide import schema as S
from caretide.operators import evaluate as E
from caretide.operators.split import split_data
from caretide.plans import tables as T
from caretide.plans.oracle import TEXT_COLUMNS, columns, q, sql, values
from caretide.plans.registry import query, rounded
from caretide.session import materialize, scratch_path
from caretide.sources import encounters as R, lookups as L, sinks
from caretide.sources.bucketed import read_bucketed, write_bucketed
from caretide.sources.order_view import encounters, lookup_lines

_WORST = " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER ({q(c)} IS NULL) AS n_null FROM t_null"
    for c in S.RAW_COLUMNS
)


@query("s01_typed_csv_scan", sql(f"SELECT {columns(S.RAW_COLUMNS)} FROM t_null"))
def _(spark, sf_dir):
    path = scratch_path(spark, "encounters-csv")
    # Spark would read an empty unquoted field as null too, but none occurs
    encounters(spark, sf_dir).na.fill(S.MISSING).write.option("header", True).csv(path)
    return R.read_encounters(spark, path)


@query("s02_null_literals", sql("SELECT " + ", ".join(
    f"CASE WHEN {q(c)} NOT IN ({values(S.NULL_LITERALS)}) THEN {q(c)} END AS {q(c)}"
    for c in TEXT_COLUMNS) + " FROM t_null"))
def _(spark, sf_dir):
    path = scratch_path(spark, "encounters-parquet")
    T.loaded(spark, sf_dir).write.parquet(path)
    df = R.read_encounters(spark, path, fmt="parquet", null_literals=True)
    return df.select(*[f"`{c}`" for c in TEXT_COLUMNS])


@query("s03_lookup_file", sql("SELECT * FROM t_lookup_rows"))
def _(spark, sf_dir):
    path = scratch_path(spark, "lookup")
    # one small file: the lookup tables have a fixed number of rows
    lookup_lines(spark, sf_dir).orderBy("line_no").select("line").coalesce(1).write.text(path)
    return L.read_lookup_file(spark, path)


@query("s04_decode_ids", sql("""SELECT encounter_id, admission_type_id,
    discharge_disposition_id, admission_source_id, admission_type_id_label,
    discharge_disposition_id_label, admission_source_id_label FROM t_decoded"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, "encounter_id", *S.ID_COLUMNS)
    return L.decode_ids(df, T.lookups(spark, sf_dir))


@query("s05_shape_report", sql(f"""SELECT count(*) AS n_rows, {S.EXPECTED_COLUMNS} AS n_columns,
    CAST(count(*) = {S.EXPECTED_ROWS} AS INT) AS rows_as_expected,
    1 AS columns_as_expected FROM t_raw"""))
def _(spark, sf_dir):
    return R.shape_report(encounters(spark, sf_dir))


@query("s06_unexpected_labels", sql("""SELECT DISTINCT '>' || CAST(time_in_hospital AS STRING)
    AS readmitted FROM t_raw WHERE readmitted = '>30' AND time_in_hospital <> 30"""))
def _(spark, sf_dir):
    df = encounters(spark, sf_dir, ["readmitted", "time_in_hospital"])
    odd = F.concat(F.lit(">"), F.col("time_in_hospital").cast("string"))
    return R.unexpected_labels(df.withColumn(
        "readmitted", F.when(F.col("readmitted") == ">30", odd).otherwise(F.col("readmitted"))
    ))


@query("s07_label_distribution",
       sql("SELECT readmitted, count(*) AS n FROM t_null GROUP BY readmitted"))
def _(spark, sf_dir):
    return R.label_distribution(T.loaded(spark, sf_dir, "readmitted"))


@query("s08_existing_source", sql("SELECT count(*) AS n_rows FROM t_raw"))
def _(spark, sf_dir):
    missing = scratch_path(spark, "never-written")
    try:
        R.read_encounters(spark, missing)
    except FileNotFoundError:
        path = scratch_path(spark, "encounter-ids")
        encounters(spark, sf_dir, ["encounter_id"]).write.parquet(path)
        return R.read_encounters(spark, path, fmt="parquet").agg(F.count("*").alias("n_rows"))
    raise AssertionError("a missing source must be an error")


@query("s09_worst_nulls",
       sql(f"SELECT * FROM ({_WORST}) ORDER BY n_null DESC, \"column\" LIMIT 10"))
def _(spark, sf_dir):
    return R.worst_nulls(T.loaded(spark, sf_dir))


_TYPES = "CASE typeof({0}) WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' END"


@query("s09_sanity_summary", sql(f"""SELECT 'shape' AS section, 'rows' AS name,
    NULL::VARCHAR AS type, count(*) AS n FROM t_null
    UNION ALL SELECT 'shape', 'columns', NULL, {S.EXPECTED_COLUMNS}
    UNION ALL SELECT 'label', readmitted, NULL, count(*) FROM t_null GROUP BY readmitted
    UNION ALL SELECT 'null', "column", NULL, n_null FROM ({_WORST})
    """ + " ".join(f"UNION ALL SELECT 'type', '{c}', " + _TYPES.format(f'any_value({q(c)})')
                   + ", NULL FROM t_null" for c in S.RAW_COLUMNS)))
def _(spark, sf_dir):
    return R.sanity_summary(T.loaded(spark, sf_dir))


@query("s10_split_assignment", sql("SELECT row_id, split FROM t_split"))
def _(spark, sf_dir):
    df = materialize(T.modelling(spark, sf_dir).select(S.ROW_ID, S.LABEL), "labels")
    path = sinks.write_split(split_data(df), scratch_path(spark, "split"))
    return spark.read.parquet(path)


@query("s10b_bucketed_split", sql("SELECT row_id, split FROM t_split"))
def _(spark, sf_dir):
    """The assignment in buckets of the row, opened from its folder."""
    df = materialize(T.modelling(spark, sf_dir).select(S.ROW_ID, S.LABEL), "labels")
    path = write_bucketed(split_data(df).select(S.ROW_ID, "split"), scratch_path(spark, "split"))
    return read_bucketed(spark, path)


@query("s11_metric_sink", sql(f"""SELECT model, round(AUROC, 6) AS AUROC, round(AUPRC, 6)
    AS AUPRC, round(F1, 6) AS F1, round(Brier, 6) AS Brier, round(Sensitivity, 6)
    AS Sensitivity, round(Specificity, 6) AS Specificity, round(PPV, 6) AS PPV,
    round(NPV, 6) AS NPV, round(Opt_Threshold, 6) AS Opt_Threshold FROM t_metrics"""))
def _(spark, sf_dir):
    metrics = E.metric_table(T.scored(spark, sf_dir))
    path = sinks.write_metrics(metrics, scratch_path(spark, "metrics"))
    return rounded(sinks.read_metrics(spark, path))


@query("s12_threshold_lookup", sql("""SELECT round(threshold, 6) AS threshold
    FROM t_threshold WHERE contains(model, 'Boosted')"""))
def _(spark, sf_dir):
    scored = materialize(T.scored(spark, sf_dir), "scored")
    path = sinks.write_metrics(E.metric_table(scored), scratch_path(spark, "metrics"))
    return rounded(sinks.stored_threshold(spark, path, "Boosted"))
