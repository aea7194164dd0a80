"""Integer vectors, packed, and exact inner products of many with many.

``packed`` makes one row for each vector, its components in the narrowest type that
holds them. ``products`` deals candidates into shards and queries into groups; each
cell of this grid is one task, which holds its shard and multiplies it tile by tile with
the queries streaming through. A candidate is copied once for each group and a query once
for each shard; their numbers follow from the tasks wanted and from the two tables' sizes,
so that with a given number of tasks the copies grow as the rows do. More shards are made
only where one would not fit a task's memory.

Scores fall into slots, ranges that a query's upper limits cut out of all scores: a
score belongs to the smallest limit that is not below it. A task keeps the best k of each
slot; a score that is already below the k-th of its slot is dropped before any sorting.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from caretide.llm.common import Batches, map_batches, parts_for

#: Packed bytes of one shard.
SHARD_BYTES = 64 << 20
#: Queries multiplied at once, and candidates beside them; the first block is small, so
#: that the next ones meet a bound.
TILE_ROWS = 256
BLOCK_ROWS = 8_192
FIRST_ROWS = 1_024
#: Pairs below which another task is not worth its start.
TASK_PAIRS = 1 << 22
LEAST, MOST = -(1 << 63), (1 << 63) - 1
ANY, SAME, OTHER = "any", "same", "other"

_KINDS = (np.int8, np.int16, np.int32, np.int64)
_PACKED = "vec_id long, label long, dim int, packed binary"


def pack(matrix: np.ndarray) -> list[bytes]:
    """A matrix of integers as one string of bytes a row, in the narrowest type."""
    if not matrix.size:
        return [b""] * len(matrix)
    low, high = int(matrix.min()), int(matrix.max())
    kind = next(k for k in _KINDS if np.iinfo(k).min <= low and high <= np.iinfo(k).max)
    data, size = matrix.astype(kind).tobytes(), matrix.shape[1] * np.dtype(kind).itemsize
    return [data[at:at + size] for at in range(0, len(data), size)]


def unpack(cells: list[bytes], dim: int) -> np.ndarray:
    """The matrix of packed rows, in the widest type among them."""
    if not dim or not cells:
        return np.zeros((len(cells), dim), np.int8)
    sizes = np.array([len(c) for c in cells]) // dim
    if (sizes == sizes[0]).all():
        kind = np.dtype(f"i{sizes[0]}")
        return np.frombuffer(b"".join(cells), kind).reshape(len(cells), dim)
    out = np.empty((len(cells), dim), np.dtype(f"i{sizes.max()}"))
    for row, (cell, size) in enumerate(zip(cells, sizes)):
        out[row] = np.frombuffer(cell, np.dtype(f"i{size}"))
    return out


def _smallest(ids: np.ndarray, labels: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """For each id, the place of its row with the smallest label and vector, by id."""
    order = np.argsort(ids, kind="stable")
    cuts = np.flatnonzero(np.diff(ids[order])) + 1
    if len(cuts) == len(ids) - 1:
        return order
    return np.array([
        part[0] if len(part) == 1 else min(part, key=lambda at: (labels[at], *rows[at].tolist()))
        for part in np.split(order, cuts)
    ])


def packed(vectors: DataFrame) -> DataFrame:
    """``vec_id``, ``label`` (0 if there is none), ``dim`` and ``packed`` of integer vectors.

    Of the rows of one id and length only the smallest counts; most go here, within
    their batch, so that an id with very many rows does not travel.
    """
    label = F.col("label").cast("long") if "label" in vectors.columns else F.lit(0).cast("long")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            ids, labels = batch.column("vec_id").to_numpy(), batch.column("label").to_numpy()
            for dim in np.unique(dims):
                at = np.flatnonzero(dims == dim)
                cells = batch.column("vector").take(pa.array(at)).flatten().to_numpy()
                rows = cells.reshape(len(at), dim)
                kept = _smallest(ids[at], labels[at], rows)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": pa.array(ids[at][kept]), "label": pa.array(labels[at][kept]),
                    "dim": pa.array(np.full(len(kept), dim, np.int32)),
                    "packed": pa.array(pack(rows[kept]), pa.binary()),
                })

    return map_batches(vectors.select("vec_id", label.alias("label"), "dim", "vector"), run, _PACKED)


def inner(queries: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact inner products; floats where they are exact, Python's integers where longs
    might not be."""
    if not queries.shape[1]:
        return np.zeros((len(queries), len(rows)), np.int64)
    top = [max(abs(int(x.max())), abs(int(x.min()))) if len(x) else 0 for x in (queries, rows)]
    widest = top[0] * top[1] * queries.shape[1]
    if widest < 2**53:
        kind = np.float32 if widest < 2**24 else np.float64
        return (queries.astype(kind) @ rows.astype(kind).T).astype(np.int64)
    exact = queries.astype(object) @ rows.astype(object).T
    if widest >= 2**63 and max(map(abs, exact.ravel()), default=0) >= 2**63:
        raise OverflowError("an inner product does not fit a long")
    return exact.astype(np.int64)


class _Lists:
    """The best k of each slot of a tile's queries; blocks come by ascending id."""

    def __init__(self, upper: np.ndarray, lower: np.ndarray, k: int):
        self.upper, self.lower, self.k = upper, lower, k
        self.bound = np.full(upper.shape, LEAST)
        self.kept = [np.zeros(0, np.int64)] * 4  # query, slot, score, id

    def add(self, scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray) -> None:
        rows, slots = self.upper.shape
        slot = np.zeros(scores.shape, np.int8)
        for s in range(slots):
            slot += scores <= self.upper[:, s, None]
        slot -= 1
        allowed &= slot >= 0
        for s in range(slots):
            low, full = self.lower[:, s, None], self.bound[:, s, None]
            here = (scores >= low) & ((scores > full) | (full == LEAST))
            allowed &= (slot != s) | here
        row, col = np.nonzero(allowed)
        if not len(row):
            return
        new = (row, slot[row, col].astype(np.int64), scores[row, col], ids[col])
        row, slot, score, ids = (np.concatenate(x) for x in zip(self.kept, new))
        order = np.lexsort((ids, ~score, slot, row))  # ~score falls as the score rises
        group = (row * slots + slot)[order]
        opens = np.flatnonzero(np.diff(group, prepend=-1))
        place = np.arange(len(group)) - np.repeat(opens, np.diff(opens, append=len(group)))
        order = order[place < self.k]
        self.kept = [x[order] for x in (row, slot, score, ids)]
        last = place[place < self.k] == self.k - 1
        row, slot, score, _ = (x[last] for x in self.kept)
        self.bound[row, slot] = score


class _Shard:
    """A cell's candidates: by id, or by label and id where only equal labels meet."""

    def __init__(self, held: list[tuple], dim: int, relation: str):
        ids, labels, rows = (np.concatenate(x) for x in zip(*held)) if held else (
            np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros((0, dim), np.int8))
        kept = _smallest(ids, labels, rows) if len(ids) else np.zeros(0, np.int64)
        if relation == SAME:
            kept = kept[np.argsort(labels[kept], kind="stable")]
        self.ids, self.labels, self.rows = ids[kept], labels[kept], rows[kept]
        self.relation = relation

    def blocks(self, label: int) -> Iterator[slice]:
        low, high = 0, len(self.ids)
        if self.relation == SAME:
            low, high = np.searchsorted(self.labels, [label, label + 1])
        step = FIRST_ROWS
        while low < high:
            yield slice(low, min(low + step, high))
            low, step = low + step, BLOCK_ROWS

    def best(self, ids, label: int, rows, upper, lower, k: int) -> list[np.ndarray]:
        lists = _Lists(upper, lower, k)
        for at in self.blocks(label):
            allowed = ids[:, None] != self.ids[None, at]
            if self.relation == OTHER:
                allowed &= self.labels[at] != label
            lists.add(inner(rows, self.rows[at]), self.ids[at], allowed)
        return lists.kept


def _cells(k: int, tile_rows: int, relation: str):
    """Sorted rows in, each cell's candidates before its queries; best k per slot out."""

    def run(batches: Batches) -> Batches:
        cell, shard, held = None, None, []
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "shard", "team", "is_query")])
            labels = batch.column("label").to_numpy()
            ids = batch.column("vec_id").to_numpy()
            change = np.any(keys[:, 1:] != keys[:, :-1], axis=0)
            # tiles of queries hold one label
            change |= (keys[3, 1:] == 1) & (labels[1:] != labels[:-1])
            cuts = np.flatnonzero(change) + 1
            for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
                if a == b:
                    continue
                dim, number, team, is_query = (int(x) for x in keys[:, a])
                if cell != (dim, number, team):
                    cell, shard, held = (dim, number, team), None, []
                part = batch.slice(a, b - a)
                rows = unpack(part.column("packed").to_pylist(), dim)
                if not is_query:
                    held.append((ids[a:b], labels[a:b], rows))
                    continue
                if shard is None:
                    shard, held = _Shard(held, dim, relation), []
                upper, lower = (
                    part.column(c).flatten().to_numpy().reshape(b - a, -1) for c in ("upper", "lower"))
                for at in range(0, b - a, tile_rows):
                    tile = slice(at, at + tile_rows)
                    own = ids[a:b][tile]
                    row, slot, score, found = shard.best(
                        own, int(labels[a]), rows[tile], upper[tile], lower[tile], k)
                    yield pa.RecordBatch.from_pydict({
                        "query_id": pa.array(own[row], pa.int64()),
                        "slot": pa.array(slot, pa.int32()),
                        "part": pa.array(np.full(len(row), number), pa.int32()),
                        "vec_id": pa.array(found, pa.int64()), "score": pa.array(score, pa.int64()),
                    })

    return run


def grid(n: int, q: int, size: int, tasks: int, shard_bytes: int = SHARD_BYTES) -> tuple[int, int]:
    """How many shards of ``n`` candidates of ``size`` bytes, and groups of ``q`` queries.

    With s shards and g groups, s * g tasks, n * g + q * s rows travel; that is least
    where s / g = n / q.
    """
    tasks = max(1, min(tasks, math.ceil(n * q / TASK_PAIRS)))
    shards = min(tasks, max(1, round(math.sqrt(tasks * n / max(q, 1)))))
    shards = max(shards, math.ceil(size / shard_bytes))
    return shards, max(1, math.ceil(tasks / shards))


def products(
    candidates: DataFrame, queries: DataFrame, k: int, relation: str = ANY,
    shape: tuple[int, int] | None = None, tile_rows: int = TILE_ROWS,
) -> tuple[DataFrame, int]:
    """Each shard's best k of each query's slots, and the number of shards.

    ``candidates`` as from ``packed``, written; ``queries`` too, with ``upper``, the
    falling upper limits of the slots, and ``lower``, the least score of use in each,
    both of the same length in every row. Rows of the query's own id are left out, and of
    other candidates those whose label stands not in the ``relation`` to the query's.
    ``query_id, slot, part, vec_id, score``, ``part`` being the shard's number.
    """
    if shape is None:
        found = candidates.agg(F.count(F.lit(1)), F.sum(F.length("packed"))).first()
        shape = grid(found[0], queries.count(), found[1] or 0, parts_for(candidates))
    shards, teams = shape

    def dealt(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("vec_id", F.lit(salt)), F.lit(n)).cast("int")

    def each(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    none = F.lit(None).cast("array<long>")
    held = candidates.select(
        "dim", dealt(shards, 0).alias("shard"), each(teams).alias("team"), F.lit(0).alias("is_query"),
        "label", "vec_id", "packed", none.alias("upper"), none.alias("lower"))
    asked = queries.withColumn("team", dealt(teams, 1)).select(
        "dim", each(shards).alias("shard"), "team", F.lit(1).alias("is_query"),
        "label", "vec_id", "packed", "upper", "lower")
    ordered = (
        held.unionByName(asked)
        .repartition(max(shards * teams, parts_for(candidates)), "dim", "shard", "team")
        .sortWithinPartitions("dim", "shard", "team", "is_query", "label", "vec_id")
    )
    lists = map_batches(
        ordered, _cells(k, tile_rows, relation),
        "query_id long, slot int, part int, vec_id long, score long")
    return lists, shards
