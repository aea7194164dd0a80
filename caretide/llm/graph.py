"""Connected components of an edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caretide.session import materialize


def _state(edges: DataFrame) -> tuple:
    return edges.agg(
        F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))
    ).first()


def _lowest(pairs: DataFrame) -> DataFrame:
    """Each node's smallest neighbour or itself, summed up before the shuffle."""
    return pairs.groupBy("u").agg(F.min("v").alias("low")).withColumn(
        "low", F.least("u", "low"))


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is connected to, for every linked node.

    ``edges`` has columns ``u`` and ``v``. Large-star and small-star steps alternate:
    each hangs neighbours below the smallest node known, until nothing changes,
    after a number of rounds about the logarithm of the longest path. A step is a
    minimum per node and a join, so that a node with very many edges is summed up
    before the shuffle and its edges may be split over tasks. Every round is a
    written table.
    """
    now = materialize(
        edges.where(F.col("u") != F.col("v"))
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        "edges",
    )
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            both.join(_lowest(both), "u").where(F.col("v") > F.col("u"))
            .select(F.col("v").alias("u"), F.col("low").alias("v")).distinct()
        )
        large = materialize(large, "large-star")
        low = _lowest(large)
        small = (
            large.join(low, "u").select(F.col("v").alias("u"), F.col("low").alias("v"))
            .unionByName(low.select("u", F.col("low").alias("v")))
            .where(F.col("u") != F.col("v")).distinct()
        )
        now = materialize(small, "small-star")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("u").alias("node"), F.col("v").alias("root"))
