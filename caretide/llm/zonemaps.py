"""Exact centroid clustering over zone maps along a Hilbert curve.

Vectors are put in order along a space-filling curve through their most varied
components and cut into blocks, each written with the least and greatest value of every
component: its box. In a round, the box alone bounds the distances of all the block's
vectors to every centroid. A centroid whose least distance to the box is more than another's
greatest, or that is farther than another from every corner of the box, cannot be the nearest
of any vector in it; the rest are the block's candidates. Only
with them its vectors are compared, exactly, as matrices. A block with one candidate is
assigned by its stored sums.

Components are ``floor(scale * x)``. Distances are whole numbers, made in floats where
these are exact, else in longs, else in Python's integers; sums are decimals. The curve only
places vectors: its axes and cells come from a sample of ``SAMPLE`` vectors, those with the
smallest hashes, but every vector is in a block, and no result depends on the sample.

Cases: vectors that are null, have another length than ``dim``, or hold a null or a
non-finite component take no part; rows without id are clustered like others but seed no
centroid; repeated rows are assigned each for itself, and may seed several equal centroids;
equally near centroids: the smaller number; equal hashes: the smaller vector; copies, however
many, are spread over blocks by their ids, and a block of copies has a box without width; with
fewer than k vectors with an id there are as many centroids, and with none there is nothing to
cluster to and no row comes out, as from an empty table; there is no text, and a component of
2^53 or more is an error; other columns of the input are not looked at.
"""

from __future__ import annotations

import hashlib
import math
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide.llm import vectors as V
from caretide.llm.common import Batches, map_batches, parts_for
from caretide.session import materialize

BLOCK = 256
AXES, BITS = 8, 7
SAMPLE = 4_096

_BLOCKS = "n int, low binary, high binary, sums array<long>, ids array<long>, vectors binary"


def hilbert(cells: np.ndarray, bits: int) -> np.ndarray:
    """The place on the Hilbert curve of each row of ``cells``, of ``bits`` bits an axis.

    Skilling's transform: from the highest bit down the curve's turns are undone, then
    the axes' bits, as a Gray code, are interleaved.
    """
    axes = [cells[:, a].astype(np.uint64) for a in range(cells.shape[1])]
    one = np.uint64(1)
    for bit in range(bits - 1, 0, -1):
        below = np.uint64((1 << bit) - 1)
        for a in range(len(axes)):
            turned = (axes[a] >> np.uint64(bit)) & one == one
            swap = np.where(turned, np.uint64(0), (axes[0] ^ axes[a]) & below)
            axes[0] = np.where(turned, axes[0] ^ below, axes[0] ^ swap)
            axes[a] = axes[a] ^ swap if a else axes[0]
    for a in range(1, len(axes)):
        axes[a] = axes[a] ^ axes[a - 1]
    flip = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, 0, -1):
        turned = (axes[-1] >> np.uint64(bit)) & one == one
        flip = np.where(turned, flip ^ np.uint64((1 << bit) - 1), flip)
    key = np.zeros(len(cells), np.uint64)
    for bit in range(bits - 1, -1, -1):
        for axis in axes:
            key = (key << one) | (((axis ^ flip) >> np.uint64(bit)) & one)
    return key.astype(np.int64)


@dataclass(frozen=True)
class Curve:
    """The axes of the curve, and the range of each that its cells divide."""

    axes: np.ndarray
    low: np.ndarray
    width: np.ndarray
    bits: int

    def keys(self, rows: np.ndarray) -> np.ndarray:
        part = (rows[:, self.axes] - self.low) / self.width
        cells = np.clip(np.floor(part * (1 << self.bits)), 0, (1 << self.bits) - 1)
        return hilbert(cells.astype(np.uint64), self.bits)


def fit_curve(sample: np.ndarray, axes: int = AXES, bits: int = BITS) -> Curve:
    """Through the components of greatest spread, 2.5 deviations to either side."""
    if axes * bits > 62:
        raise ValueError("a place on the curve has at most 62 bits")
    spread, middle = sample.std(axis=0), sample.mean(axis=0)
    chosen = np.argsort(-spread, kind="stable")[:axes]
    wide = np.where(spread[chosen] > 0, 5 * spread[chosen], 1.0)
    return Curve(chosen, middle[chosen] - wide / 2, wide, bits)


# --- blocks -----------------------------------------------------------------------------


def whole_vectors(table: DataFrame, dim: int, scale: int, id_col: str = "vec_id",
                  vector_col: str = "embedding") -> DataFrame:
    """``vec_id`` (may be null) and ``vector`` (array of long) of the rows that take part."""
    fine = F.forall(vector_col, lambda x: x.isNotNull() & ~F.isnan(x.cast("double"))
                    & (F.abs(x.cast("double")) < math.inf))
    return table.where((F.size(vector_col) == dim) & fine).select(
        F.col(id_col).cast("long").alias("vec_id"),
        F.transform(vector_col, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))
        .cast("array<long>").alias("vector"))


def _laid(curve: Curve, dim: int):
    """Vectors in, packed ones with their place on the curve out."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            rows = batch.column("vector").flatten().to_numpy().reshape(-1, dim)
            if rows.size and max(int(rows.max()), -int(rows.min())) >= 1 << 53:
                raise OverflowError("a component is too large to be exact")
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(curve.keys(rows)), pa.array(V.pack(rows), pa.binary())],
                names=["vec_id", "place", "packed"])

    return run


def _blocked(dim: int, size: int):
    """Vectors in the curve's order in, blocks of ``size`` with their boxes out."""

    def block(ids: list, cells: list[bytes]) -> dict:
        rows = V.unpack(cells, dim)
        low, high = rows.min(axis=0).astype(np.int64), rows.max(axis=0).astype(np.int64)
        packed = b"".join(V.pack(rows))
        return {"n": len(ids), "low": low.tobytes(), "high": high.tobytes(),
                "sums": rows.sum(axis=0, dtype=np.int64), "ids": ids, "vectors": packed}

    def run(batches: Batches) -> Batches:
        ids, cells = [], []
        for batch in batches:
            ids += batch.column("vec_id").to_pylist()
            cells += batch.column("packed").to_pylist()
            full = len(ids) // size * size
            if full:
                yield _batch([block(ids[a:a + size], cells[a:a + size])
                              for a in range(0, full, size)])
                ids, cells = ids[full:], cells[full:]
        if ids:
            yield _batch([block(ids, cells)])

    return run


def _batch(blocks: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(blocks, pa.schema([
        ("n", pa.int32()), ("low", pa.binary()), ("high", pa.binary()),
        ("sums", pa.list_(pa.int64())), ("ids", pa.list_(pa.int64())), ("vectors", pa.binary())]))


def blocks(rows: DataFrame, curve: Curve, dim: int, size: int = BLOCK) -> DataFrame:
    """The zone map: blocks of neighbours on the curve, to be written once.

    Ranges are of place and hashed id, so that copies are spread over them.
    """
    placed = map_batches(rows, _laid(curve, dim), "vec_id long, place long, packed binary")
    tie = F.xxhash64("vec_id")
    ordered = placed.repartitionByRange(parts_for(rows), "place", tie).sortWithinPartitions("place")
    return map_batches(ordered, _blocked(dim, size), _BLOCKS)


# --- rounds -----------------------------------------------------------------------------


class Centroids:
    """Centroids in the narrowest kind of number in which distances are exact."""

    def __init__(self, rows: list[tuple[int, ...]]):
        self.rows = rows
        self.top = max((abs(x) for row in rows for x in row), default=0)
        self._made: dict = {}

    def kind(self, top: int):
        """For components up to ``top``: floats, longs or Python's integers."""
        bound = 8 * len(self.rows[0]) * (2 * max(top, self.top)) ** 2  # of any sum below
        return np.float64 if bound < 2**53 else np.int64 if bound < 2**63 else object

    def matrix(self, kind) -> np.ndarray:
        if kind not in self._made:
            self._made[kind] = np.array(self.rows, dtype=object).astype(kind)
        return self._made[kind]

    def candidates(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Numbers of the centroids that may be nearest to a vector in the box."""
        kind = self.kind(max(abs(int(low.min())), abs(int(high.max())), abs(int(low.max()))))
        c, low, high = self.matrix(kind), low.astype(kind), high.astype(kind)
        near = np.maximum(np.maximum(low - c, c - high), 0)
        far = np.maximum(c - low, high - c)
        least, greatest = (near * near).sum(axis=1), (far * far).sum(axis=1)
        # how much nearer than a centroid another is changes linearly over the box, so its
        # least value lies in a corner; the other is the one nearest to the middle
        middle, size = low + high, (c * c).sum(axis=1)
        best = int(np.argmin(size - (c * middle).sum(axis=1)))
        apart = c - c[best]
        lead = size - size[best] - (apart * middle).sum(axis=1) - (abs(apart) * (high - low)).sum(axis=1)
        return np.flatnonzero((least <= greatest.min()) & (lead <= 0))

    def nearest(self, rows: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each row's nearest of the chosen, the smaller number on ties, and distance."""
        kind = self.kind(max(abs(int(rows.min())), abs(int(rows.max()))))
        c, x = self.matrix(kind)[chosen], rows.astype(kind)
        if kind is np.float64:
            gaps = (x * x).sum(axis=1)[:, None] - 2 * (x @ c.T) + (c * c).sum(axis=1)
        else:
            gaps = np.stack([((x - one) ** 2).sum(axis=1) for one in c], axis=1)
        at = np.argmin(gaps, axis=1)
        found = gaps[np.arange(len(x)), at]
        if kind is object and any(d >= 1 << 63 for d in found):
            raise OverflowError("a squared distance does not fit a long")
        return chosen[at], found.astype(np.int64)


def _assigned(batches: Batches, centroids: Centroids, dim: int, whole: bool) -> Iterator[tuple]:
    """Each block with its vectors' clusters and distances; without ``whole``, a block
    with one candidate comes with this only."""
    for batch in batches:
        for row in batch.to_pylist():
            low, high = np.frombuffer(row["low"], np.int64), np.frombuffer(row["high"], np.int64)
            chosen = centroids.candidates(low, high)
            if len(chosen) == 1 and not whole:
                yield row, chosen, None, None, None
                continue
            size = len(row["vectors"]) // (row["n"] * dim)
            rows = np.frombuffer(row["vectors"], np.dtype(f"i{size}")).reshape(row["n"], dim)
            yield row, chosen, rows, *centroids.nearest(rows, chosen)


def _round(centroids: Centroids, dim: int):
    """Blocks in; per task the sum of each cluster's components (its size at place -1),
    and at cluster -1 the pairs compared."""

    def run(batches: Batches) -> Batches:
        sums, compared = defaultdict(lambda: [0] * (dim + 1)), 0
        for row, chosen, rows, cluster, _ in _assigned(batches, centroids, dim, False):
            if rows is None:
                parts = [(chosen[0], row["n"], row["sums"])]
            else:
                compared += len(chosen) * row["n"]
                parts = [
                    (c, int((cluster == c).sum()), rows[cluster == c].sum(axis=0, dtype=np.int64).tolist())
                    for c in np.unique(cluster)]
            for c, n, more in parts:
                sums[int(c)] = [a + b for a, b in zip(sums[int(c)], [n, *more])]
        out = [(c, place - 1, total) for c, totals in sums.items() for place, total in enumerate(totals)]
        out.append((-1, -1, compared))
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[0] for x in out], pa.int32()), pa.array([x[1] for x in out], pa.int32()),
             pa.array([Decimal(x[2]) for x in out], pa.decimal128(38, 0))],
            names=["cluster", "place", "total"])

    return run


def _final(centroids: Centroids, dim: int):
    def run(batches: Batches) -> Batches:
        for row, _, _, cluster, distance in _assigned(batches, centroids, dim, True):
            yield pa.RecordBatch.from_arrays(
                [pa.array(row["ids"], pa.int64()), pa.array(cluster.astype(np.int32)),
                 pa.array(distance)], names=["vec_id", "cluster", "distance"])

    return run


@dataclass(frozen=True)
class Clustering:
    """The final centroids, each vector's cluster and distance, and how many pairs of
    vectors and centroids each round compared, of all."""

    spark: SparkSession
    centroids: list[tuple[int, ...]]
    assigned: DataFrame
    compared: list[int]
    pairs: int


def _lowest(rows: DataFrame, total: int, wanted: int, least: int, seed: str) -> list:
    """Up to ``wanted`` vectors with the lowest hashes, ``least`` of them if there are.

    Hashes above twice the share wanted of ``total`` rows are left out where they lie, so
    that not every task sends as many rows to the driver. Where too few are left, because
    many rows have one id or take no part, all are asked.
    """
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    keyed = rows.where(F.col("vec_id").isNotNull()).select(key.alias("key"), "vector")
    some = keyed
    if 2 * wanted < total:
        some = keyed.where(F.col("key") < f"{2 * wanted * 16**15 // total:015x}")
    found = some.orderBy("key", "vector").limit(wanted).collect()
    if len(found) < least and some is not keyed:
        found = keyed.orderBy("key", "vector").limit(least).collect()
    return found


def cluster(table: DataFrame, k: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64,
            seed: str = "1", block: int = BLOCK) -> Clustering:
    """Lloyd's rounds from the k vectors whose ids, with the seed, hash lowest.

    A round gives each vector to the nearest centroid and moves every centroid that has
    vectors to the floor of their mean. After the last one vectors are assigned again.
    """
    spark = table.sparkSession
    rows = whole_vectors(table, dim, scale)
    first = _lowest(rows, table.count(), max(k, SAMPLE), k, seed)
    now = [tuple(r["vector"]) for r in first[:k]]
    if not now:
        none = spark.createDataFrame([], "vec_id long, cluster int, distance long")
        return Clustering(spark, [], none, [], 0)
    curve = fit_curve(np.array([r["vector"] for r in first], float))
    made = materialize(blocks(rows, curve, dim, block), "vector-blocks")
    compared = []
    for _ in range(rounds):
        parts = map_batches(
            made.drop("ids"), _round(Centroids(now), dim), "cluster int, place int, total decimal(38,0)")
        found = {(r["cluster"], r["place"]): int(r["total"]) for r in parts.groupBy(
            "cluster", "place").agg(F.sum("total").alias("total")).collect()}  # k * (dim + 1) rows
        compared.append(found[-1, -1])
        now = [
            tuple(found[c, i] // found[c, -1] for i in range(dim)) if (c, -1) in found else old
            for c, old in enumerate(now)]
    done = map_batches(made, _final(Centroids(now), dim), "vec_id long, cluster int, distance long")
    pairs = len(now) * int(made.agg(F.sum("n")).first()[0])
    return Clustering(spark, now, materialize(done, "vector-clusters"), compared, pairs)


def report(found: Clustering) -> DataFrame:
    """Each vector with its cluster, its distance, both sums of distances, and the hash of
    its centroid."""
    sums = {r["cluster"]: r["sum"] for r in found.assigned.groupBy("cluster").agg(
        F.sum("distance").alias("sum")).collect()}  # one row for each centroid
    total = sum(sums.values())
    digest = [
        (c, sums.get(c, 0), total, hashlib.sha256(",".join(map(str, row)).encode()).hexdigest())
        for c, row in enumerate(found.centroids)]
    about = found.spark.createDataFrame(
        digest, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return found.assigned.join(F.broadcast(about), "cluster").select(  # k rows
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
