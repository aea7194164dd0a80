"""Tables laid out in buckets of a row's id, so that joins by row move nothing.

A row-level table that is joined again and again (split assignment, demographics, scores of
several models) is shuffled once, when it is written. Tables with as many buckets then meet
bucket by bucket: a join or a grouping by the id reads both in place. A folder holds the
``rows`` and, written last, the ``layout`` that says how they lie, so that any session can
open it; the catalog entry is only this session's way to read it.
"""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from caretide import schema as S


def _name(path: str) -> str:
    return "bucketed_" + hashlib.md5(path.encode()).hexdigest()


def write_bucketed(df: DataFrame, path: str, key: str = S.ROW_ID,
                   buckets: int | None = None) -> str:
    """Write ``df`` in buckets of ``key``, one file each, sorted inside.

    ``buckets`` is the session's number of shuffle partitions by default; tables that are to
    be joined need the same. Rows without key share a bucket. An existing table is replaced.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    if buckets < 1 or key not in df.columns:
        raise ValueError(f"cannot cut {df.columns} into {buckets} buckets of {key!r}")
    # the writer deals rows as the shuffle does, so that a task holds one whole bucket
    writer = df.repartition(buckets, key).write.format("parquet").mode("overwrite")
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    writer.bucketBy(buckets, key).sortBy(key).option("path", f"{path}/rows").saveAsTable(_name(path))
    layout = {"key": key, "buckets": buckets, "schema": df.schema.json()}
    row = spark.createDataFrame([(json.dumps(layout),)], "value string")
    row.coalesce(1).write.mode("overwrite").text(f"{path}/layout")
    return path


def read_bucketed(spark: SparkSession, path: str) -> DataFrame:
    """The table at ``path`` with its buckets known to the optimizer."""
    layout = json.loads(spark.read.text(f"{path}/layout").first()["value"])
    columns = StructType.fromJson(json.loads(layout["schema"])).toDDL()
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
    spark.sql(f"""CREATE TABLE {_name(path)} ({columns}) USING parquet
        CLUSTERED BY (`{layout['key']}`) SORTED BY (`{layout['key']}`)
        INTO {layout['buckets']} BUCKETS LOCATION '{path}/rows'""")
    return spark.table(_name(path))


def bucketed(df: DataFrame, path: str, key: str = S.ROW_ID, buckets: int | None = None) -> DataFrame:
    """Write in buckets and go on from the written table."""
    return read_bucketed(df.sparkSession, write_bucketed(df, path, key, buckets))


def forget(spark: SparkSession, path: str) -> None:
    """Drop the session's entry; the files stay."""
    spark.sql(f"DROP TABLE IF EXISTS {_name(path)}")
