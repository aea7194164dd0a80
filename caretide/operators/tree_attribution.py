"""Per-row attributions of boosted trees.

A fitted ensemble is small and its size is bounded by its parameters, so its
leaves are sent to the tasks; the rows stay distributed. For each leaf, the
features on its path form a small game: a feature that is not known follows
the training rows down both sides. The Shapley values of that game are summed
over leaves and trees (path-dependent tree attributions).

Spark's boosted classifier has the margin ``sum(weight * tree)`` and the
probability ``sigmoid(2 * margin)``. All values here are on the scale of
``2 * margin``, that is log-odds.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide import schema as S
from caretide.operators.attribute import long_form
from caretide.operators.encode import feature_names
from caretide.session import scratch_path, ship

_CELLS = 4_000_000  # largest intermediate array per step
TABLE_FEATURES = 6  # path features up to which values are tabled by pattern


@dataclass(frozen=True)
class Leaves:
    """Leaves with equally many path features; arrays run over the leaves.

    A row reaches a leaf if for each path feature it is not at or below
    ``low`` and, where ``capped``, is at or below ``high``. ``share`` is the
    part of the training rows that a feature's splits let through.
    """

    tree: np.ndarray
    value: np.ndarray
    feature: np.ndarray
    low: np.ndarray
    high: np.ndarray
    capped: np.ndarray
    share: np.ndarray


def read_nodes(spark: SparkSession, model: GBTClassificationModel):
    """The ensemble's nodes, one driver row per node, from its saved form."""
    path = scratch_path(spark, "trees")
    model.save(path)
    nodes = spark.read.parquet(f"{path}/data")
    return nodes.select(
        "treeID", "nodeData.id", "nodeData.prediction", "nodeData.rawCount",
        "nodeData.leftChild", "nodeData.rightChild",
        F.col("nodeData.split.featureIndex").alias("feature"),
        F.get("nodeData.split.leftCategoriesOrThreshold", F.lit(0)).alias("threshold"),
        F.col("nodeData.split.numCategories").alias("categories"),
    ).collect()


def collect_leaves(spark: SparkSession, model: GBTClassificationModel) -> list[Leaves]:
    """All leaves, grouped by how many features their paths use."""
    trees: dict[int, dict] = {}
    for row in read_nodes(spark, model):
        trees.setdefault(row["treeID"], {})[row["id"]] = row
    weights = model.treeWeights
    groups: dict[int, list] = {}
    for tree_id, nodes in trees.items():
        open_nodes = [(0, {})]
        while open_nodes:
            node_id, path = open_nodes.pop()
            node = nodes[node_id]
            if node["leftChild"] < 0:
                value = 2.0 * weights[tree_id] * node["prediction"]
                groups.setdefault(len(path), []).append((tree_id, value, path))
                continue
            if node["categories"] >= 0:
                raise ValueError("categorical splits are not supported")
            for child, left in ((node["leftChild"], True), (node["rightChild"], False)):
                low, high, capped, share = path.get(
                    node["feature"], (-np.inf, np.inf, False, 1.0)
                )
                part = nodes[child]["rawCount"] / node["rawCount"]
                cut = node["threshold"]
                bounds = (low, min(high, cut), True) if left else (max(low, cut), high, capped)
                open_nodes.append((child, {**path, node["feature"]: (*bounds, share * part)}))
    return [_pack(leaves, d) for d, leaves in sorted(groups.items())]


def _pack(leaves: list, d: int) -> Leaves:
    def table(pick, kind=float):
        rows = [[pick(f, b) for f, b in path.items()] for _, _, path in leaves]
        return np.array(rows, dtype=kind).reshape(len(leaves), d)

    return Leaves(
        tree=np.array([t for t, _, _ in leaves]),
        value=np.array([v for _, v, _ in leaves]),
        feature=table(lambda f, b: f, int),
        low=table(lambda f, b: b[0]), high=table(lambda f, b: b[1]),
        capped=table(lambda f, b: b[2], bool), share=table(lambda f, b: b[3]),
    )


def base_value(groups: list[Leaves]) -> float:
    """The expected log-odds over the training rows."""
    return float(sum((g.value * g.share.prod(axis=1)).sum() for g in groups))


def _reached(x: np.ndarray, g: Leaves, part: slice) -> np.ndarray:
    """(rows, leaves, features): whether a row passes the feature's splits."""
    v = x[:, g.feature[part]]
    return ~(v <= g.low[part]) & ((v <= g.high[part]) | ~g.capped[part])


def _shapley(g: Leaves, part: slice) -> np.ndarray:
    """(leaves, 2**d, d): each feature's value for every pattern of passes."""
    share, value = g.share[part], g.value[part]
    leaves, d = share.shape
    passed = ((np.arange(2**d)[:, None] >> np.arange(d)) & 1).astype(float)
    weight = np.ones(d)  # k!(d-1-k)!/d! for k known other features
    weight[0] = 1.0 / d
    for k in range(1, d):
        weight[k] = weight[k - 1] * k / (d - k)
    out = np.empty((leaves, 2**d, d))
    for i in range(d):
        known = np.zeros((leaves, 2**d, d))  # coefficients by number of known
        known[:, :, 0] = 1.0
        size = 0
        for j in range(d):
            if j == i:
                continue
            shifted = np.zeros_like(known)
            shifted[:, :, 1 : size + 2] = known[:, :, : size + 1] * passed[None, :, j, None]
            known = known * share[:, None, j, None] + shifted
            size += 1
        gain = passed[None, :, i] - share[:, None, i]
        out[:, :, i] = value[:, None] * (known @ weight) * gain
    return out


def _shapley_by_row(passed: np.ndarray, share: np.ndarray, value: np.ndarray) -> np.ndarray:
    """(rows, leaves, features) values, by polynomials in the number of known features.

    The product of a leaf's factors ``share + passed t`` is made once; a feature's
    own factor is divided out again, from the top coefficient down, which is stable
    since shares are at most one.
    """
    d = share.shape[1]
    weight = np.ones(d)
    weight[0] = 1.0 / d
    for k in range(1, d):
        weight[k] = weight[k - 1] * k / (d - k)
    whole = np.zeros((*passed.shape[:2], d + 1))
    whole[:, :, 0] = 1.0
    for j in range(d):
        grown = whole * share[None, :, j, None]
        grown[:, :, 1:] += whole[:, :, :-1] * passed[:, :, j, None]
        whole = grown
    out = np.empty(passed.shape)
    for i in range(d):
        s, knows = share[None, :, i], passed[:, :, i].astype(bool)
        rest = np.empty((*passed.shape[:2], d))
        rest[:, :, d - 1] = whole[:, :, d]
        for k in range(d - 1, 0, -1):
            rest[:, :, k - 1] = whole[:, :, k] - s * rest[:, :, k]
        rest = np.where(knows[:, :, None], rest, whole[:, :, :d] / s[:, :, None])
        out[:, :, i] = value[None, :] * (rest @ weight) * (knows - s)
    return out


def pattern_tables(groups: list[Leaves]) -> list[np.ndarray | None]:
    """Values by pattern of passes, made once, for leaves with few path features."""
    return [
        _shapley(g, slice(None)) if 0 < g.feature.shape[1] <= TABLE_FEATURES else None
        for g in groups
    ]


def row_impacts(x: np.ndarray, groups: list[Leaves], tables: list | None = None) -> np.ndarray:
    """(rows, features) attributions of a batch of rows.

    Few path features: a value is looked up by the pattern of passes. More: it is
    computed for each row and leaf, in the square of their number.
    """
    out, columns = np.zeros(x.shape[::-1]), np.ascontiguousarray(x.T)
    for g, table in zip(groups, pattern_tables(groups) if tables is None else tables):
        leaves, d = g.feature.shape
        if d == 0:
            continue
        if table is not None:
            for leaf in range(leaves):
                _add_tabled(out, columns, g, leaf, table[leaf])
            continue
        step = max(1, _CELLS // (len(x) * d * 4))
        for start in range(0, leaves, step):
            part = slice(start, start + step)
            gains = _shapley_by_row(_reached(x, g, part), g.share[part], g.value[part])
            flat = gains.reshape(len(x), -1)
            feature = g.feature[part].ravel()
            order = np.argsort(feature, kind="stable")
            present, first = np.unique(feature[order], return_index=True)
            out[present] += np.add.reduceat(flat[:, order], first, axis=1).T
    return np.ascontiguousarray(out.T)


def _add_tabled(out: np.ndarray, columns: np.ndarray, g: Leaves, leaf: int,
                table: np.ndarray) -> None:
    """Adds one leaf's values to ``out``; both it and ``columns`` have a row per feature."""
    pattern = np.zeros(columns.shape[1], np.uint8)  # TABLE_FEATURES bits at the most
    for j, feature in enumerate(g.feature[leaf]):
        passed = ~(columns[feature] <= g.low[leaf, j])
        if g.capped[leaf, j]:
            passed &= columns[feature] <= g.high[leaf, j]
        pattern |= passed.view(np.uint8) << np.uint8(j)
    place = pattern.astype(np.intp)
    for j, feature in enumerate(g.feature[leaf]):
        out[feature] += table[:, j].take(place)


@dataclass(frozen=True)
class Nodes:
    """An ensemble's nodes in one table; ``roots`` has each tree's first.

    An inner node sends rows at or below ``cut`` to ``left``, others, also NaN, to
    ``right``; a leaf is its own child. ``value`` is what a leaf adds to the log-odds.
    """

    roots: np.ndarray
    feature: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray


def collect_nodes(spark: SparkSession, model: GBTClassificationModel) -> Nodes:
    """The nodes of all trees, as many as the model's parameters allow."""
    rows = sorted(read_nodes(spark, model), key=lambda r: (r["treeID"], r["id"]))
    place = {(r["treeID"], r["id"]): i for i, r in enumerate(rows)}
    if any(r["leftChild"] >= 0 and r["categories"] >= 0 for r in rows):
        raise ValueError("categorical splits are not supported")

    def child(i, r, name):
        return i if r["leftChild"] < 0 else place[r["treeID"], r[name]]

    weights = model.treeWeights
    return Nodes(
        roots=np.array([place[t, 0] for t in range(model.getNumTrees)]),
        feature=np.array([r["feature"] if r["leftChild"] >= 0 else 0 for r in rows]),
        cut=np.array([r["threshold"] if r["leftChild"] >= 0 else 0.0 for r in rows]),
        left=np.array([child(i, r, "leftChild") for i, r in enumerate(rows)]),
        right=np.array([child(i, r, "rightChild") for i, r in enumerate(rows)]),
        value=np.array([2.0 * weights[r["treeID"]] * r["prediction"] for r in rows]),
    )


def tree_margins(x: np.ndarray, nodes: Nodes) -> np.ndarray:
    """(rows, trees): what each tree adds to the log-odds. A row takes as many steps in a
    tree as the tree is deep."""
    out = np.empty((len(x), len(nodes.roots)))
    row = np.arange(len(x))
    for t, root in enumerate(nodes.roots):
        at = np.full(len(x), root)
        while True:
            below = x[row, nodes.feature[at]] <= nodes.cut[at]
            after = np.where(below, nodes.left[at], nodes.right[at])
            if (after == at).all():
                break
            at = after
        out[:, t] = nodes.value[at]
    return out


def tree_attributions(rows: DataFrame, model: GBTClassificationModel, names: list[str],
                      row_id: str = S.ROW_ID, groups: list[Leaves] | None = None) -> DataFrame:
    """``(row_id, feature, value, impact)`` in log-odds for every row.

    The base value plus a row's impacts is the log-odds of its score.
    """
    return long_form(tree_entries(rows, model, names, row_id, groups), row_id)


def tree_entries(rows: DataFrame, model: GBTClassificationModel, names: list[str],
                 row_id: str = S.ROW_ID, groups: list[Leaves] | None = None) -> DataFrame:
    """One row per scored row: ``entries``, an array of (feature, value, impact)."""
    groups = collect_leaves(rows.sparkSession, model) if groups is None else groups
    shown = feature_names(names, model.numFeatures)
    shared = ship(rows.sparkSession, groups)

    def explain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        leaves = shared()
        tables = pattern_tables(leaves)
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["x"].to_numpy())
            yield pd.DataFrame({
                "id": pdf["id"], "x": list(x), "impacts": list(row_impacts(x, leaves, tables)),
            })

    wide = rows.select(
        F.col(row_id).alias("id"), vector_to_array("features").alias("x")
    ).mapInPandas(explain, "id string, x array<double>, impacts array<double>")
    named = F.array(*[F.lit(n) for n in shown])
    return wide.select(
        F.col("id").alias(row_id),
        F.transform(
            F.arrays_zip(named.alias("feature"), F.col("x").alias("value"),
                         F.col("impacts").alias("impact")),
            lambda e: F.struct(e["feature"].alias("feature"), e["value"].alias("value"),
                               e["impact"].alias("impact")),
        ).alias("entries"),
    )


def staged_scores(rows: DataFrame, model: GBTClassificationModel,
                  row_id: str = S.ROW_ID) -> DataFrame:
    """``(row_id, label, round, score)``: the score after each boosting round."""
    shared = ship(rows.sparkSession, collect_nodes(rows.sparkSession, model))

    def stages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes = shared()
        for pdf in batches:
            if pdf.empty:
                continue
            x = np.stack(pdf["x"].to_numpy())
            odds = tree_margins(x, nodes).cumsum(axis=1)
            yield pd.DataFrame({
                "id": pdf["id"], "label": pdf["label"],
                "scores": list(1.0 / (1.0 + np.exp(-odds))),
            })

    return (
        rows.select(
            F.col(row_id).alias("id"), F.col("label").cast("int").alias("label"),
            vector_to_array("features").alias("x"),
        )
        .mapInPandas(stages, "id string, label int, scores array<double>")
        .select(F.col("id").alias(row_id), "label", F.posexplode("scores").alias("round", "score"))
        .withColumn("round", F.col("round") + 1)
    )
