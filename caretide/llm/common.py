"""Helpers the operators of this package share."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

Batches = Iterator[pa.RecordBatch]


def texts(docs: DataFrame, *keep: str, own: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id`` as long, ``text`` as string and the named columns, nothing else.

    Columns are taken by name, so that extra columns of the input, whatever
    they are called, cannot clash with those an operator adds. A column to be kept
    gives way if it is named like one of these (``own``), ``doc_id`` or ``text``.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *[F.col(c) for c in keep if c not in ("doc_id", "text", *own)],
    )


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Rows in one Arrow batch. Documents are long: of Spark's 10,000 rows each worker, and
#: the executor beside it, would hold many megabytes several times over.
BATCH_ROWS = 1_000
_BATCH_SETTING = "spark.sql.execution.arrow.maxRecordsPerBatch"


def map_batches(
    df: DataFrame, run: Callable[[Batches], Batches], schema: str | T.StructType
) -> DataFrame:
    """``mapInArrow`` with batches of bounded size.

    The size is a setting of the session; it is lowered if it is above BATCH_ROWS.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(_BATCH_SETTING, "10000")) <= BATCH_ROWS:
        conf.set(_BATCH_SETTING, BATCH_ROWS)
    return df.mapInArrow(run, schema)


def sha256(column: Column) -> Column:
    return F.sha2(column, 256)


def parts_for(df: DataFrame) -> int:
    """The session's shuffle partitions, which the cluster sets to suit the input."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
