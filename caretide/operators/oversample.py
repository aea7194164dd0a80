"""Oversampling of the rarer class on mixed numeric and nominal features.

Synthetic rows lie between a minority row and one of its nearest minority
neighbours (numeric features) and take the neighbours' most frequent value
(nominal features). Distance is Euclidean over the numerics, plus the squared
median of their deviations for each nominal that differs.

Neighbours are exact and found without comparing all pairs:

1. Rows fall into the cells of a coarse tree that halves them along the features
   they vary most on. A cell that holds more rows than a block gets a fine tree of
   its own, grown in a task from a sample of the cell, so that boxes become more as
   rows do. A box that still holds too many (copies) is cut into blocks of bounded size.
2. Each block is searched on its own. The k-th distance found, also among a
   few pivot rows, bounds a row's search radius.
3. A row is sent on only to the cells, and in these only to the blocks, whose box
   may hold a nearer row. A row with enough exact copies has radius zero and
   searches no further.
4. The best k of all searches remain.

Trees come from samples of bounded size and only steer the search; any tree gives
the same distances. The coarse one, the pivots and the median deviation are fitted
once on the driver; the fine ones are a written table that never visits it. All stay
the same when a task is run again.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window, functions as F

from caretide import schema as S
from caretide.operators.split import order_key, ranked
from caretide.session import materialize, ship

NEIGHBOURS = 5
BLOCK_ROWS = 8192
QUERY_ROWS = 16_384
PIVOTS = 64
#: Leaves of one tree; a fine tree below each leaf of the coarse one may have as many again.
MAX_LEAVES = 16_384
SAMPLE_PER_LEAF = 8
#: Rows that one task takes through a fine tree at a time.
DESCENT_ROWS = 65_536

_FOUND = "row_id string, distance double, neighbour string, nx array<double>"


def _distances(a: np.ndarray, b: np.ndarray, numeric: int, penalty: float) -> np.ndarray:
    """Squared distances between the rows of ``a`` and of ``b``."""
    out = np.zeros((len(a), len(b)))
    for j in range(a.shape[1]):
        gap = a[:, j, None] - b[None, :, j]
        out += gap * gap if j < numeric else penalty * (gap != 0)
    return out


def _embedded(rows: np.ndarray, others: np.ndarray, numeric: int, penalty: float):
    """Points whose squared distance is that of the rows, so that a product of matrices
    gives all of them at once: a nominal of two values is one coordinate, others are one
    for each value. Numbers are centred, as rounding grows with their size."""
    centre = others[:, :numeric].mean(axis=0)
    left, right = [rows[:, :numeric] - centre], [others[:, :numeric] - centre]
    for j in range(numeric, others.shape[1]):
        values = np.unique(np.concatenate([rows[:, j], others[:, j]]))
        if len(values) == 2:
            shown, scale = values[:1], math.sqrt(penalty)
        else:
            shown, scale = values[: len(values) * (len(values) > 1)], math.sqrt(penalty / 2)
        left.append((rows[:, j, None] == shown) * scale)
        right.append((others[:, j, None] == shown) * scale)
    return (np.concatenate(part, axis=1).astype(np.float32) for part in (left, right))


def _rough_limits(rough: np.ndarray, slack: np.ndarray, k: int) -> np.ndarray:
    """Per row a rough distance that none of the k nearest exceeds."""
    if rough.shape[1] <= k:
        return np.full(len(rough), np.inf)
    return np.partition(rough + slack, k - 1, axis=1)[:, k - 1]


def _nearest(rows, row_ids, others, other_ids, k, numeric, penalty, radius=None):
    """Up to k nearest others per row: (row, other, squared distance) arrays.

    Pairs are told apart roughly by a product of matrices in single precision, whose
    rounding is bounded; those that may be among the nearest are then compared exactly.
    With a ``radius`` per row, others farther away are left out.
    """
    limits = np.full(len(rows), np.inf) if radius is None else np.square(radius) * (1 + 1e-9)
    # without finite numbers there is nothing to multiply: all pairs are compared exactly
    plain = not (np.isfinite(rows).all() and np.isfinite(others).all() and len(others)
                 and max(np.abs(rows).max(), np.abs(others).max()) < 1e15)
    if not plain:
        a, b = _embedded(rows, others, numeric, penalty)
        a_size, b_size = (np.square(v, dtype=float).sum(axis=1) for v in (a, b))
        b_sizes, unit = b_size.astype(np.float32), (a.shape[1] + 16) * 2.0**-22
        most_unit = unit * b_size.max()
    # a row is not its own neighbour, however often its id stands among the others
    own = int(pd.Series(other_ids).value_counts(dropna=False).max()) if len(other_ids) else 0
    hits = []
    for start in range(0, len(rows), 256):
        part = slice(start, start + 256)
        if plain:
            i, j = np.indices((len(rows[part]), len(others))).reshape(2, -1)
        else:
            rough = a[part] @ b.T
            rough *= -2
            rough += a_size[part, None].astype(np.float32)
            rough += b_sizes
            slack = (unit * a_size[part] + most_unit).astype(np.float32)[:, None]
            most = limits[part] if radius is not None else _rough_limits(rough, slack, k + own)
            i, j = np.nonzero(rough <= (most[:, None] + slack).astype(np.float32) * np.float32(1 + 1e-6))
        d = np.zeros(len(i))
        for c in range(rows.shape[1]):
            gap = rows[part][i, c] - others[j, c]
            d += gap * gap if c < numeric else penalty * (gap != 0)
        near = np.isfinite(d) & (d <= limits[part][i]) & (row_ids[part][i] != other_ids[j])
        i, j, d = i[near], j[near], d[near]
        # every tie with the k-th stays until ties are settled by id
        order = np.lexsort((d, i))
        i, j, d = i[order], j[order], d[order]
        first = np.searchsorted(i, i)
        full = np.bincount(i, minlength=len(rows[part]))[i] >= k
        kth = d[np.minimum(first + k - 1, len(d) - 1)] if len(d) else d
        near = ~full | (d <= kth)
        i, j, d = i[near], j[near], d[near]
        order = np.lexsort((other_ids[j], d, i))
        i, j, d = i[order], j[order], d[order]
        kept = np.arange(len(i)) - np.searchsorted(i, i) < k
        hits.append((i[kept] + start, j[kept], d[kept]))
    return tuple(np.concatenate(parts) for parts in zip(*hits))


def _matrix(column: pd.Series) -> np.ndarray:
    return np.stack(column.to_numpy()) if len(column) else np.zeros((0, 0))


@dataclass(frozen=True)
class _Tree:
    """Boxes that halve the rows along the axis they vary most on.

    Arrays run over the nodes. ``cut`` parts a node's rows into those at or
    below it (``left``) and those above; a leaf has ``axis`` -1. A node's box
    holds values above ``low`` and up to ``high``.
    """

    numeric: int
    penalty: float
    axis: np.ndarray
    cut: np.ndarray
    left: np.ndarray
    right: np.ndarray
    low: np.ndarray
    high: np.ndarray

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), int)
        while True:
            inner = self.axis[at] >= 0
            if not inner.any():
                return at
            node = at[inner]
            below = x[inner, self.axis[node]] <= self.cut[node]
            at[inner] = np.where(below, self.left[node], self.right[node])

    def near_leaves(self, x: np.ndarray, radius: np.ndarray) -> list[np.ndarray]:
        """Per row, the leaves that may hold a row nearer than ``radius``."""
        out = []
        for start in range(0, len(x), 256):
            part, reach = x[start : start + 256], radius[start : start + 256] ** 2
            row, node = np.arange(len(part)), np.zeros(len(part), int)
            done = []
            while len(row):
                leaf = self.axis[node] < 0
                done.append((row[leaf], node[leaf]))
                row, node = row[~leaf], node[~leaf]
                row = np.concatenate([row, row])
                node = np.concatenate([self.left[node], self.right[node]])
                kept = self._gaps(part[row], node) < reach[row]
                row, node = row[kept], node[kept]
            row, node = (np.concatenate(v) for v in zip(*done))
            order = np.argsort(row, kind="stable")
            out += np.split(node[order], np.searchsorted(row[order], np.arange(1, len(part))))
        return out

    def _gaps(self, x: np.ndarray, node: np.ndarray) -> np.ndarray:
        """Squared distance from rows to the boxes of nodes, at the least."""
        low, high, k = self.low[node], self.high[node], self.numeric
        gap = np.maximum(np.maximum(low[:, :k] - x[:, :k], x[:, :k] - high[:, :k]), 0)
        outside = (x[:, k:] <= low[:, k:]) | (x[:, k:] > high[:, k:])
        # a little less, so that rounding cannot hide a row at the border
        return ((gap**2).sum(axis=1) + self.penalty * outside.sum(axis=1)) * (1 - 1e-9)


def _grow(sample: np.ndarray, numeric: int, penalty: float, leaf_rows: int,
          low: np.ndarray | None = None, high: np.ndarray | None = None) -> _Tree:
    """Halve the sample until a node holds at most ``leaf_rows`` of it.

    ``low`` and ``high`` are the box that all rows lie in, if one is known.
    """
    width = sample.shape[1]
    nodes = {"axis": [], "cut": [], "left": [], "right": [], "low": [], "high": []}

    def add(low, high):
        for name, value in zip(nodes, (-1, 0.0, -1, -1, low, high)):
            nodes[name].append(value)
        return len(nodes["axis"]) - 1

    low = np.full(width, -np.inf) if low is None else low
    high = np.full(width, np.inf) if high is None else high
    open_nodes = [(add(low, high), sample)]
    while open_nodes:
        at, rows = open_nodes.pop()
        if len(rows) <= leaf_rows:
            continue
        spread = rows.var(axis=0) * 2
        for j in range(numeric, width):
            _, n = np.unique(rows[:, j], return_counts=True)
            spread[j] = penalty * (1 - ((n / len(rows)) ** 2).sum())
        j = int(np.argmax(spread))
        values = np.unique(rows[:, j])
        if len(values) < 2:
            continue  # all rows of the node are alike
        middle = np.searchsorted(values, np.median(rows[:, j]))
        cut = values[min(middle, len(values) - 2)]
        below = rows[:, j] <= cut
        low, high = nodes["low"][at].copy(), nodes["high"][at].copy()
        low[j] = high[j] = cut
        nodes["axis"][at], nodes["cut"][at] = j, cut
        nodes["left"][at] = add(nodes["low"][at], high)
        nodes["right"][at] = add(low, nodes["high"][at])
        open_nodes += [(nodes["left"][at], rows[below]), (nodes["right"][at], rows[~below])]
    return _Tree(numeric, penalty, **{k: np.array(v) for k, v in nodes.items()})


def _sampled_share(n, block_rows: int, max_leaves: int):
    """Which share of ``n`` rows a tree over them is grown from, as a column."""
    return F.least(F.ceil(n / block_rows), F.lit(max_leaves)) * SAMPLE_PER_LEAF / n


def _fit_tree(points: DataFrame, n: int, numeric: int, penalty: float,
              block_rows: int, max_leaves: int) -> _Tree:
    """The coarse tree over a seeded sample of bounded size; it only steers the search."""
    leaves = min(max_leaves, math.ceil(n / block_rows))
    wanted = leaves * SAMPLE_PER_LEAF
    rows = points
    if wanted < n:
        top = f"{int(wanted / n * 16**8):08x}"
        rows = points.where(order_key("row_id") < top).limit(2 * wanted)
    sample = _matrix(rows.select("x").toPandas()["x"])
    if leaves == 1 or not len(sample):
        sample = sample[:1] if len(sample) else np.zeros((1, len(points.first()["x"])))
    return _grow(sample, numeric, penalty, max(1, len(sample) // leaves))


_TREE = ("cell int, axis array<int>, cut array<double>, left array<int>, right array<int>, "
         "low array<double>, high array<double>")


@dataclass(frozen=True)
class _Space:
    """Where the rows lie: ``placed`` has ``(row_id, x, cell, leaf, block)``.

    ``fine`` holds the trees of the crowded cells, one row each; without crowded cells
    it is None, and every row lies in leaf 0 of its cell.
    """

    coarse: object
    fine: DataFrame | None
    placed: DataFrame


def _crowded(cells: DataFrame, block_rows: int) -> DataFrame:
    return cells.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > block_rows)


def _fine_trees(cells: DataFrame, crowded: DataFrame, coarse, block_rows: int,
                max_leaves: int) -> DataFrame:
    """A tree for each crowded cell, grown in a task of its own.

    A cell's sample is the rows with the lowest md5 keys, by a share that gives some
    ``max_leaves * SAMPLE_PER_LEAF`` rows at the most.
    """

    def grow(pdf: pd.DataFrame) -> pd.DataFrame:
        above, cell = coarse(), int(pdf["cell"].iloc[0])
        sample = _matrix(pdf.sort_values("row_id")["x"])
        leaves = min(max_leaves, math.ceil(pdf["n"].iloc[0] / block_rows))
        tree = _grow(sample, above.numeric, above.penalty, max(1, len(sample) // leaves),
                     above.low[cell], above.high[cell])
        return pd.DataFrame({
            "cell": [cell], "axis": [tree.axis], "cut": [tree.cut], "left": [tree.left],
            "right": [tree.right], "low": [tree.low.ravel()], "high": [tree.high.ravel()]})

    key = F.conv(F.substring(order_key("row_id"), 1, 8), 16, 10).cast("double") / float(16**8)
    sample = cells.join(crowded, "cell").where(
        key < _sampled_share(F.col("n"), block_rows, max_leaves))
    return materialize(sample.groupBy("cell").applyInPandas(grow, _TREE), "fine-trees")


def _unpacked(row, numeric: int, penalty: float) -> _Tree:
    """A fine tree from its row."""
    nodes = len(row["axis"])
    return _Tree(numeric, penalty, *[np.asarray(row[c]) for c in ("axis", "cut", "left", "right")],
                 *[np.asarray(row[c]).reshape(nodes, -1) for c in ("low", "high")])


def _through_trees(rows: DataFrame, fine: DataFrame, coarse, schema: str, find) -> DataFrame:
    """Rows of crowded cells beside what ``find(tree, x, rows)`` gives for each.

    A cell's rows come in parts of bounded size, each beside its own copy of the tree.
    ``schema`` are the columns of the result, ``found`` the column that ``find`` fills.
    """
    parts = rows.groupBy("cell").agg(
        F.ceil(F.count("*") / DESCENT_ROWS).cast("int").alias("parts"))
    dealt = rows.join(parts, "cell").withColumn(
        "part", F.pmod(F.xxhash64("row_id"), "parts").cast("int")).drop("parts")
    trees = fine.join(parts, "cell").withColumn(
        "part", F.explode(F.expr("sequence(0, parts - 1)"))).drop("parts")
    names = [c.split()[0] for c in schema.split(", ")]

    def descend(pdf: pd.DataFrame, tree: pd.DataFrame) -> pd.DataFrame:
        if pdf.empty or tree.empty:
            return pd.DataFrame({c: [] for c in names})
        above = coarse()
        own = _unpacked(tree.iloc[0], above.numeric, above.penalty)
        return pdf.assign(found=find(own, _matrix(pdf["x"]), pdf))[names]

    return dealt.groupBy("cell", "part").cogroup(
        trees.groupBy("cell", "part")).applyInPandas(descend, schema)


def _space(points: DataFrame, n: int, numeric: int, penalty: float, block_rows: int,
           max_leaves: int) -> _Space:
    """Place every row in a cell, a leaf of the cell's own tree, and a block of the leaf."""
    coarse = ship(points.sparkSession,
                  _fit_tree(points, n, numeric, penalty, block_rows, max_leaves))

    def assign(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = coarse()
        for pdf in batches:
            if len(pdf):
                yield pdf.assign(cell=tree.leaf_of(_matrix(pdf["x"])))

    cells = materialize(
        points.select("row_id", "x").mapInPandas(
            assign, "row_id string, x array<double>, cell int"
        ),
        "neighbour-cells",
    )
    crowded = materialize(_crowded(cells, block_rows), "crowded-cells")
    fine, leaves = None, cells.withColumn("leaf", F.lit(0))
    if not crowded.isEmpty():
        fine = _fine_trees(cells, crowded, coarse, block_rows, max_leaves)
        inside = cells.join(fine.select("cell"), "cell", "left_semi")
        schema = "row_id string, x array<double>, cell int, found int"
        leaves = materialize(_through_trees(
            inside, fine, coarse, schema, lambda tree, x, _: tree.leaf_of(x)
        ).withColumnRenamed("found", "leaf").unionByName(
            leaves.join(fine.select("cell"), "cell", "left_anti")), "neighbour-leaves")
    sizes = leaves.groupBy("cell", "leaf").agg(
        F.ceil(F.count("*") / block_rows).cast("int").alias("blocks")
    )
    placed = leaves.join(sizes, ["cell", "leaf"]).withColumn(
        "block", F.pmod(F.xxhash64("row_id"), "blocks").cast("int")
    ).drop("blocks")
    return _Space(coarse, fine, placed)


def _asked(space: _Space, own: DataFrame) -> DataFrame:
    """``(cell, leaf, block, row_id, x, radius)``: the other blocks in which a row must search on."""

    def reach(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tree = coarse()
        for pdf in batches:
            if len(pdf):
                near = tree.near_leaves(_matrix(pdf["x"]), pdf["radius"].to_numpy())
                yield pdf.assign(cells=near)

    coarse = space.coarse
    home = "home int, home_leaf int, home_block int"
    # nothing is nearer than a copy, so rows among copies search no further
    near = (
        own.where("radius > 0").drop("distance", "neighbour", "near")
        .mapInPandas(reach, f"row_id string, x array<double>, {home}, radius double, "
                            "cells array<int>")
        .withColumn("cell", F.explode("cells")).drop("cells")
    )
    if space.fine is None:
        leaves = near.withColumn("leaf", F.lit(0))
    else:
        near = materialize(near, "near-cells")
        inside = near.join(space.fine.select("cell"), "cell", "left_semi")
        schema = f"row_id string, x array<double>, {home}, radius double, cell int, found array<int>"
        leaves = _through_trees(
            inside, space.fine, coarse, schema,
            lambda tree, x, pdf: tree.near_leaves(x, pdf["radius"].to_numpy())
        ).withColumn("leaf", F.explode("found")).drop("found").unionByName(
            near.join(space.fine.select("cell"), "cell", "left_anti")
            .withColumn("leaf", F.lit(0)))
    blocks = space.placed.select("cell", "leaf", "block").distinct()
    return (
        leaves.join(blocks, ["cell", "leaf"])
        .where("not (cell = home and leaf = home_leaf and block = home_block)")
        .select("cell", "leaf", "block", "row_id", "x", "radius")
    )


def _metric(points: DataFrame, numeric: int, k: int) -> tuple[int, float]:
    """How many rows there are, and the penalty of a nominal that differs."""
    moments = points.selectExpr(
        "count(*) as n", *[f"stddev_pop(x[{j}])" for j in range(numeric)]
    ).first()
    n, deviations = moments["n"], [d or 0.0 for d in moments[1:]]
    if n <= k:
        raise ValueError(f"{n} rows are too few for {k} neighbours")
    return n, float(np.median(deviations)) ** 2


def search_effort(points: DataFrame, numeric: int, k: int = NEIGHBOURS,
                  block_rows: int = BLOCK_ROWS, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """``(row_id, compared)``: with how many rows :func:`nearest_neighbours` compares each."""
    n, penalty = _metric(points, numeric, k)
    space = _space(points, n, numeric, penalty, block_rows, max_leaves)
    place = ["cell", "leaf", "block"]
    sizes = materialize(space.placed.groupBy(*place).agg(F.count("*").alias("size")), "block-sizes")
    asked = _asked(space, _own(points, space, numeric, penalty, k)).select(*place, "row_id")
    return space.placed.select(*place, "row_id").unionByName(asked).join(sizes, place).groupBy(
        "row_id").agg(F.sum("size").alias("compared"))


def _own(points: DataFrame, space: _Space, numeric: int, penalty: float, k: int) -> DataFrame:
    """Every row beside the best of its own block and the radius that is left to search."""
    pivots = points.orderBy(order_key("row_id"), "row_id").limit(PIVOTS).collect()
    pivot_x = np.array([p["x"] for p in pivots])
    pivot_ids = np.array([p["row_id"] for p in pivots], dtype=object)

    def search_own(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids = _matrix(pdf["x"]), pdf["row_id"].to_numpy()
        i, j, d = _nearest(x, ids, x, ids, k, numeric, penalty)
        far = _distances(x, pivot_x, numeric, penalty)
        far[ids[:, None] == pivot_ids[None, :]] = np.inf
        bound = np.sort(far, axis=1)[:, k - 1] if far.shape[1] >= k else np.full(len(x), np.inf)
        kth = np.full(len(x), np.inf)
        full = np.bincount(i, minlength=len(x)) == k
        last = np.searchsorted(i, np.arange(len(x)), side="right") - 1
        kth[full] = d[last[full]]
        cuts = np.searchsorted(i, np.arange(1, len(x)))
        return pd.DataFrame({
            "row_id": ids, "x": list(x), "home": pdf["cell"], "home_leaf": pdf["leaf"],
            "home_block": pdf["block"],
            "radius": np.sqrt(np.minimum(bound, kth)),
            "distance": np.split(d, cuts), "neighbour": np.split(ids[j], cuts),
            "near": [x[part].ravel() for part in np.split(j, cuts)],
        })

    return materialize(
        space.placed.groupBy("cell", "leaf", "block").applyInPandas(
            search_own,
            "row_id string, x array<double>, home int, home_leaf int, home_block int, "
            "radius double, distance array<double>, neighbour array<string>, near array<double>",
        ),
        "neighbours-own",
    )


def nearest_neighbours(points: DataFrame, numeric: int, k: int = NEIGHBOURS,
                       block_rows: int = BLOCK_ROWS, max_leaves: int = MAX_LEAVES) -> DataFrame:
    """Exact k nearest neighbours among ``points`` (``row_id, x``).

    Returns ``(row_id, distance, neighbour, nx, place)``. Among equally near
    rows the choice is free but settled by id and block. The first ``numeric`` entries of ``x`` are numbers, the others
    nominal codes.
    """
    n, penalty = _metric(points, numeric, k)
    space = _space(points, n, numeric, penalty, block_rows, max_leaves)
    own, place = _own(points, space, numeric, penalty, k), ["cell", "leaf", "block"]

    # a row's neighbours lie end to end in one flat array
    first = own.select("row_id", "near", F.size("x").alias("width"), F.posexplode(
        F.arrays_zip("distance", "neighbour")).alias("n", "found")).select(
        "row_id", "found.distance", "found.neighbour",
        F.expr("slice(near, n * width + 1, width)").alias("nx"))
    queries = _asked(space, own)
    # many rows may search one block: cut them into parts of bounded size and
    # give each part its own copy of the block
    parts = queries.groupBy(*place).agg(
        F.ceil(F.count("*") / QUERY_ROWS).cast("int").alias("parts")
    )
    asked = queries.join(parts, place).select(
        *place, F.pmod(F.xxhash64("row_id"), "parts").cast("int").alias("part"),
        "row_id", "x", "radius",
    )
    copies = space.placed.join(parts, place).select(
        *[F.col(c).alias(f"in_{c}") for c in place],
        F.explode(F.expr("sequence(0, parts - 1)")).alias("in_part"),
        F.col("row_id").alias("other_id"), F.col("x").alias("y"),
    )

    def search_other(query: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if query.empty or block.empty:
            return pd.DataFrame({"row_id": [], "distance": [], "neighbour": [], "nx": []})
        x, ids = _matrix(query["x"]), query["row_id"].to_numpy()
        y, other = _matrix(block["y"]), block["other_id"].to_numpy()
        i, j, d = _nearest(x, ids, y, other, k, numeric, penalty, query["radius"].to_numpy())
        return pd.DataFrame(
            {"row_id": ids[i], "distance": d, "neighbour": other[j], "nx": list(y[j])}
        )

    second = (
        asked.groupBy(*place, "part")
        .cogroup(copies.groupBy(*[f"in_{c}" for c in place], "in_part"))
        .applyInPandas(search_other, _FOUND)
    )
    best = Window.partitionBy("row_id").orderBy("distance", "neighbour")
    return (
        first.unionByName(second)
        .withColumn("place", F.row_number().over(best))
        .where(F.col("place") <= k)
    )


def _mode_of_neighbours(numeric: int, width: int) -> str:
    """Most frequent neighbour value per nominal, the smallest on a tie."""
    values = "transform(near, n -> n.nx[j])"
    ranked = (f"transform(array_distinct({values}), "
              f"v -> struct(-size(filter({values}, w -> w = v)) as c, v as v))")
    return f"transform(sequence({numeric}, {width - 1}), j -> array_min({ranked}).v)"


def synthesize(points: DataFrame, wanted: int, numeric: int, width: int,
               k: int = NEIGHBOURS, seed: int = S.SEED,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``wanted`` synthetic rows ``(row_id, x, base, neighbour, u)``.

    Every row serves as base equally often, up to one; which rows serve once
    more, the neighbour and the place between them follow from md5.
    """
    near = nearest_neighbours(points, numeric, k, block_rows).groupBy("row_id").agg(
        # exactly k entries per row
        F.sort_array(F.collect_list(F.struct("place", "neighbour", "nx"))).alias("near")
    )
    n = points.count()
    # copy i of all wanted ones goes to base i modulo n in md5 order, so the copies are
    # spread however few the bases are
    numbered = ranked(points.withColumn("one", F.lit(1)), "one", "row_id", seed).select(
        (F.col("place") - 1).alias("number"), "row_id", "x")
    copies = points.sparkSession.range(wanted).select(
        (F.col("id") % n).alias("number"), F.floor(F.col("id") / n).cast("int").alias("copy"))
    drawn = (
        copies.join(numbered.join(near, "row_id"), "number")
        .withColumn("copy", F.col("copy") + 1)
        .withColumn("h", F.md5(F.concat_ws(":", F.lit(str(seed)), "row_id", "copy")))
        .selectExpr(
            "row_id as base", "x", "near",
            "concat(row_id, '~', copy) as row_id",
            f"near[int(bigint(conv(substr(h, 1, 8), 16, 10)) % {k})] as chosen",
            "bigint(conv(substr(h, 9, 8), 16, 10)) / 4294967296D as u",
        )
    )
    numbers = (f"transform(sequence(0, {numeric - 1}), "
               "j -> x[j] + u * (chosen.nx[j] - x[j]))")
    mixed = numbers
    if width > numeric:
        mixed = f"concat({numbers}, {_mode_of_neighbours(numeric, width)})"
    return drawn.selectExpr("row_id", f"{mixed} as x", "base", "chosen.neighbour", "u")


def oversample(train: DataFrame, numeric: int, k: int = NEIGHBOURS, seed: int = S.SEED,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Training rows plus synthetic ones until both classes are equally large."""
    counts = {r["label"]: r["count"] for r in train.groupBy("label").count().collect()}
    if len(counts) != 2:
        raise ValueError(f"need two classes to balance, found {sorted(counts)}")
    minority = min(counts, key=lambda v: (counts[v], v))
    wanted = max(counts.values()) - counts[minority]
    if not wanted:
        return train
    points = materialize(
        train.where(F.col("label") == minority).select(
            F.col(S.ROW_ID).alias("row_id"), vector_to_array("features").alias("x")
        ),
        "minority",
    )
    width = len(points.first()["x"])
    made = synthesize(points, wanted, numeric, width, k, seed, block_rows).select(
        F.col("row_id").alias(S.ROW_ID),
        F.lit(minority).cast(dict(train.dtypes)["label"]).alias("label"),
        array_to_vector("x").alias("features"),
    )
    return train.select(S.ROW_ID, "label", "features").unionByName(made)
