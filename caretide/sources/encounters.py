"""Typed scans of raw encounter tables and the checks on them."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide import schema as S
from caretide.functions import clinical as C
from caretide.functions.clinical import column, quoted
from caretide.operators.clean import text_columns


def read_encounters(spark: SparkSession, path: str, fmt: str = "csv",
                    null_literals: bool = False) -> DataFrame:
    """Scan raw encounters with their declared types; ``?`` reads as null.

    Types are never inferred: codes such as ``250.00`` must stay text.
    ``null_literals`` also reads the usual spellings of missing as null; by
    default ``None`` stays text, because it says that a test was not made.

    A CSV's columns are taken by the names in its header, in any order; all files
    of a folder must have the same header. A missing column is an error when the
    table is opened, a text where a number belongs one when the row is read.
    """
    reader = spark.read
    if fmt == "csv":
        reader = reader.option("header", True).option("nullValue", S.MISSING)
        reader = reader.option("inferSchema", False).option("enforceSchema", False)
    else:
        reader = reader.schema(S.RAW_SCHEMA)
    try:
        df = reader.format(fmt).load(path)
        df = _typed(df) if fmt == "csv" else df
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no encounter table at {path}") from error
        raise
    return null_out_literals(df) if null_literals else df


def _typed(df: DataFrame) -> DataFrame:
    """The declared columns by name, with their declared types."""
    missing = [c for c in S.RAW_COLUMNS if c not in df.columns]
    if missing:
        raise ValueError(f"encounter table lacks {missing}")
    kinds = {f.name: f.dataType.simpleString() for f in S.RAW_SCHEMA.fields}

    def number(name: str, kind: str):
        read = F.trim(name).try_cast(kind)
        bad = F.raise_error(F.concat(F.lit(f"bad number in {name}: "), F.col(name))).cast(kind)
        return F.when(F.col(name).isNotNull() & read.isNull(), bad).otherwise(read)

    return df.select(*[
        (F.col(c) if kinds[c] == "string" else number(c, kinds[c])).alias(c)
        for c in S.RAW_COLUMNS
    ])


def null_out_literals(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {c: C.null_sentinel(c, S.NULL_LITERALS) for c in text_columns(df)}
    )


def shape_report(df: DataFrame, rows: int = S.EXPECTED_ROWS,
                 columns: int = S.EXPECTED_COLUMNS) -> DataFrame:
    """Row and column counts against the expected ones; it only reports."""
    return df.agg(F.count("*").alias("n_rows")).select(
        "n_rows",
        F.lit(len(df.columns)).alias("n_columns"),
        (F.col("n_rows") == rows).cast("int").alias("rows_as_expected"),
        F.lit(int(len(df.columns) == columns)).alias("columns_as_expected"),
    )


def unexpected_labels(df: DataFrame, label: str = S.RAW_LABEL) -> DataFrame:
    """Label values outside the known domain, each once."""
    value = column(label)
    return df.where(value.isNotNull() & ~value.isin(*S.RAW_LABELS)).select(label).distinct()


def check_labels(df: DataFrame, label: str = S.RAW_LABEL) -> DataFrame:
    """``df`` itself, or an error that names some unexpected labels."""
    found = [row[0] for row in unexpected_labels(df, label).limit(20).collect()]
    if found:
        raise ValueError(f"unexpected values in {label}: {sorted(found)}")
    return df


def label_distribution(df: DataFrame, label: str = S.RAW_LABEL) -> DataFrame:
    return df.groupBy(label).agg(F.count("*").alias("n")).orderBy(F.desc("n"), label)


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: how many of its values are null."""
    counted = df.groupBy().agg(
        *[F.expr(f"count(*) - count(`{c}`) as `{c}`") for c in df.columns]
    )
    return counted.unpivot([], quoted(df.columns), "column", "n_null")


def worst_nulls(df: DataFrame, n: int = 10) -> DataFrame:
    return null_counts(df).orderBy(F.desc("n_null"), "column").limit(n)


def column_types(df: DataFrame) -> DataFrame:
    rows = [(i, name, kind) for i, (name, kind) in enumerate(df.dtypes)]
    return df.sparkSession.createDataFrame(rows, "position int, column string, type string")


def sanity_summary(df: DataFrame, label: str = S.RAW_LABEL) -> DataFrame:
    """Shape, column types, label counts and null counts: ``(section, name, type, n)``."""
    text = F.lit(None).cast("string")
    size = df.agg(F.count("*").alias("n"))
    shape = size.select(F.lit("rows").alias("name"), "n").unionByName(
        size.select(F.lit("columns").alias("name"), F.lit(len(df.columns)).cast("long").alias("n")))
    labels = df.groupBy(column(label).alias("name")).agg(F.count("*").alias("n"))
    types = column_types(df).select(
        F.lit("type").alias("section"), F.col("column").alias("name"), "type",
        F.lit(None).cast("long").alias("n"))
    parts = [("shape", shape), ("label", labels),
             ("null", null_counts(df).withColumnRenamed("column", "name")
              .withColumnRenamed("n_null", "n"))]
    for section, part in parts:
        types = types.unionByName(part.select(
            F.lit(section).alias("section"), "name", text.alias("type"), "n"))
    return types
