"""Exact top-k search by inner product over integer vectors.

Candidates are dealt by the hash of their id into shards and queries into groups
(``vectors.products``). A task multiplies tiles of queries with its shard, keeps the best
k of each query in the tile, and lists of ``fan`` shards at a time are merged until one
list per query is left.

Components are ``floor(scale * x)``. Products are made in floats, which are exact while a
bound on the sums stays below 2^24 or 2^53, and in Python's integers beyond it.

Cases: vectors that are null or hold a null or a non-finite component take no
part, nor do rows without an id; there is no text, and very long vectors only make
shards of fewer rows; repeated ids count once, with the smallest vector (of each length);
other columns of the input are not looked at; vectors of different lengths are never compared; ties go to the smaller id;
a query with fewer than k candidates returns them all; an empty table, no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from caretide.llm import vectors
from caretide.session import materialize

FAN = 16


def integer_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 256,
    keep: tuple[Column, ...] = (),
) -> DataFrame:
    """``vec_id``, ``dim`` and ``vector`` (array of long) of the rows that take part, and
    what ``keep`` names."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < math.inf))
    return (
        table.where(F.col(id_col).isNotNull() & F.col(vector_col).isNotNull())
        .where(fine)
        .select(
            F.col(id_col).cast("long").alias("vec_id"), F.size(vector_col).alias("dim"),
            F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
            .cast("array<long>").alias("vector"),
            *keep,
        )
    )


def distinct_queries(queries: DataFrame) -> DataFrame:
    """One row for each id, with the smallest label, if there is one, and vector."""
    names = [c for c in ("label", "vector", "dim") if c in queries.columns]
    one = queries.groupBy("vec_id").agg(F.min(F.struct(*names)).alias("v"))
    return one.select("vec_id", "v.*")


def merged(lists: DataFrame, k: int, shards: int, fan: int = FAN, *slot: str) -> DataFrame:
    """The best k of each query (and slot), ``rank`` from 1, from the shards' lists."""
    best = [F.desc("score"), F.asc("vec_id")]
    while shards > fan:
        shards = math.ceil(shards / fan)
        lists = lists.withColumn("part", F.floor(F.col("part") / fan).cast("int"))
        place = F.row_number().over(Window.partitionBy("query_id", *slot, "part").orderBy(*best))
        lists = lists.withColumn("place", place).where(F.col("place") <= k).drop("place")
    place = F.row_number().over(Window.partitionBy("query_id", *slot).orderBy(*best))
    return (
        lists.withColumn("rank", place).where(F.col("rank") <= k)
        .select("query_id", *slot, "rank", "vec_id", "score")
    )


def top_k(
    candidates: DataFrame, queries: DataFrame, k: int = 5,
    shape: tuple[int, int] | None = None, tile_rows: int = vectors.TILE_ROWS, fan: int = FAN,
) -> DataFrame:
    """``query_id``, ``rank`` (from 1), ``vec_id`` and ``score`` of each query's best k.

    Both inputs are tables of ``integer_vectors``; a candidate with the query's own
    id is left out. ``shape`` sets the number of shards and of query groups.
    """
    held = materialize(vectors.packed(candidates), "packed-vectors")
    asked = vectors.packed(distinct_queries(queries)).withColumns({
        "upper": F.array(F.lit(vectors.MOST)), "lower": F.array(F.lit(vectors.LEAST))})
    lists, shards = vectors.products(held, asked, k, vectors.ANY, shape, tile_rows)
    return merged(lists.drop("slot"), k, shards, fan)
