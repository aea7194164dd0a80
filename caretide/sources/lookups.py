"""Sectioned lookup files and the decoding of id columns."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from caretide import schema as S


def read_lookup_file(spark: SparkSession, path: str) -> DataFrame:
    """Parse a sectioned lookup file into ``(id_column, id, description)``."""
    try:
        whole = spark.read.text(path, wholetext=True)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            raise FileNotFoundError(f"no lookup file at {path}") from error
        raise
    lines = whole.select(
        F.col("_metadata.file_path").alias("file"),
        F.posexplode(F.split("value", r"\r?\n")).alias("line_no", "line"),
    )
    return parse_lookup_lines(lines)


def parse_lookup_lines(lines: DataFrame) -> DataFrame:
    """``(file, line_no, line)`` to lookup rows.

    A section starts at a line that begins with an id column's name and holds
    ``id,description`` rows up to the next one. Blank lines, lone commas and
    rows without a whole-number id are skipped.
    """
    text = F.trim("line")
    header = F.coalesce(*[F.when(text.startswith(c), F.lit(c)) for c in S.ID_COLUMNS])
    in_order = Window.partitionBy("file").orderBy("line_no")
    id_text = F.trim(F.substring_index(text, ",", 1))
    rest = F.trim(F.regexp_extract(text, r"^[^,]*,(.*)$", 1))
    return (
        lines.withColumn("header", header)
        .withColumn("id_column", F.last("header", ignorenulls=True).over(in_order))
        .where(F.col("header").isNull() & F.col("id_column").isNotNull())
        .where(text.contains(",") & id_text.rlike(r"^\d+$"))
        .select(
            "id_column",
            id_text.cast("int").alias("id"),
            F.btrim(rest, F.lit('"')).alias("description"),
        )
    )


def decode_ids(df: DataFrame, lookups: DataFrame,
               columns: list[str] | None = None) -> DataFrame:
    """Add ``<column>_label`` for each id column; unknown ids give null.

    Plain joins: the optimizer broadcasts a lookup if its size allows it, and
    splits a frequent id if not.
    """
    for name in columns or S.ID_COLUMNS:
        if name not in df.columns:
            continue
        labels = lookups.where(F.col("id_column") == name).select(
            F.col("id").alias(name), F.col("description").alias(f"{name}_label")
        )
        df = df.join(labels, name, "left")
    return df


def source_labels(lookups: DataFrame, id_column: str = "admission_source_id") -> DataFrame:
    return lookups.where(F.col("id_column") == id_column).select("id", "description")
