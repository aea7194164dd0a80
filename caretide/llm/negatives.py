"""Hard negatives by slot-decomposed selection.

An anchor's positives are its nearest rows of the same label; each of them opens a
window of scores, between a lower and an upper share of the positive's own, in which the
best rows of other labels are its hard negatives. The windows of one anchor overlap.
Instead of searching each of them,

1. the upper limits of an anchor's windows cut all scores into disjoint slots;
2. one pass over the candidates keeps the best k of each slot: within a task first, then
   over all shards. A score below all windows that could use its slot is dropped;
3. slots laid end to end, from the highest down, hold an anchor's rows in falling order.
   A window's rows are the first k, from its own slot on, that are not below its lower
   limit: anything further down in a slot has k better ones in the same slot.

Anchors and candidates meet in the grid of ``vectors.products``.

Cases: rows whose label, vector or id is null, or with a null or non-finite component,
take no part; there is no text, and very long vectors only make shards of fewer rows;
vectors of different lengths never meet; repeated ids count once, with the smallest label
and then vector (of each length); ties go to the smaller id; an anchor without another row
of its label has no rows, nor has a positive whose window is empty, as below zero; an empty
table gives no rows; other columns of the input are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from caretide.llm import topk, vectors
from caretide.session import materialize

POSITIVES = 5
NEGATIVES = 10


def labelled_vectors(
    table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
    label_col: str = "label", scale: int = 256,
) -> DataFrame:
    """``vec_id``, ``dim``, ``vector`` and ``label`` (long) of the rows that take part."""
    rows = topk.integer_vectors(table.where(F.col(label_col).isNotNull()), id_col, vector_col,
                                scale, (F.col(label_col).cast("long").alias("label"),))
    return rows


def _windows(near: DataFrame, low: int, high: int, of: int) -> DataFrame:
    """``query_id`` and ``windows``: its positives, nearest first, with their limits."""
    upper = f"(score * {high}L - pmod(score * {high}L, {of}L)) div {of}L"  # rounded down
    lower = f"(score * {low}L + pmod(-score * {low}L, {of}L)) div {of}L"  # rounded up
    limits = near.select(
        "query_id", "rank", F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"), F.expr(upper).alias("upper"),
        F.expr(lower).alias("lower"))
    fields = ("rank", "positive_id", "positive_score", "upper", "lower")
    return limits.groupBy("query_id").agg(
        F.array_sort(F.collect_list(F.struct(*fields))).alias("windows"))


def hard_negatives(
    rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES,
    low: int = 30, high: int = 90, of: int = 100, shape: tuple[int, int] | None = None,
    tile_rows: int = vectors.TILE_ROWS, fan: int = topk.FAN,
) -> DataFrame:
    """The best rows of other labels in the window of each anchor's positive.

    Both inputs are tables of ``labelled_vectors``. A positive with score p opens the
    window ``low * p <= of * score <= high * p``, with ``low <= high``. ``anchor_id``,
    ``positive_id``, ``rank`` (from 1), ``negative_id``, ``positive_score``,
    ``negative_score``.
    """
    held = materialize(vectors.packed(rows), "packed-vectors")
    asked = materialize(vectors.packed(topk.distinct_queries(anchors)), "packed-anchors")
    whole = {"upper": F.array(F.lit(vectors.MOST)), "lower": F.array(F.lit(vectors.LEAST))}
    lists, shards = vectors.products(
        held, asked.withColumns(whole), positives, vectors.SAME, shape, tile_rows)
    near = topk.merged(lists.drop("slot"), positives, shards, fan)
    windows = materialize(_windows(near, low, high, of), "score-windows")

    # every anchor has as many slots; those beyond its positives take no score
    def padded(name: str, value: int):
        more = F.array_repeat(F.lit(value), positives - F.size("windows"))
        return F.concat(F.col(f"windows.{name}"), more)

    limits = windows.select(
        F.col("query_id").alias("vec_id"), padded("upper", vectors.LEAST).alias("upper"),
        padded("lower", vectors.MOST).alias("lower"))
    lists, shards = vectors.products(
        held, asked.join(limits, "vec_id"), negatives, vectors.OTHER, shape, tile_rows)
    slots = topk.merged(lists, negatives, shards, fan, "slot")
    laid = slots.groupBy("query_id").agg(F.array_sort(F.collect_list(
        F.struct("slot", "rank", "vec_id", "score"))).alias("laid"))
    each = windows.join(laid, "query_id").select(
        "query_id", "laid", F.posexplode("windows").alias("place", "window"))
    fitting = F.filter("laid", lambda e: (e["slot"] >= F.col("place"))
                       & (e["score"] >= F.col("window.lower")))
    best = F.slice(fitting, 1, negatives)
    return each.select("query_id", "window", F.posexplode(best).alias("at", "negative")).select(
        F.col("query_id").alias("anchor_id"), "window.positive_id",
        (F.col("at") + 1).alias("rank"), F.col("negative.vec_id").alias("negative_id"),
        "window.positive_score", F.col("negative.score").alias("negative_score"))
