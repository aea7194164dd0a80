"""Zone-map clustering and hard negatives against brute force and SQL."""

import hashlib
import itertools
import math

import numpy as np
import pytest

import __spark_entry__ as entry
from caretide.llm import negatives, vectors, zonemaps
from tests.llm.conftest import SF_DIR, ordered
from tests.oracle_check import connect, differences

SCHEMA = "vec_id long, embedding array<double>, label int, place long, packed string, slot int"


def frame(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    return df.repartition(3)


def ints(vector, scale):
    return [math.floor(scale * x) for x in vector]


# --- clusters ---------------------------------------------------------------------------


def lloyd(rows, k, rounds, dim, scale):
    fine = [(i, ints(v, scale)) for i, v, _ in rows
            if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v)]
    key = lambda r: (hashlib.sha256(f"1:{r[0]}".encode()).hexdigest(), r[1])
    now = [v for _, v in sorted((r for r in fine if r[0] is not None), key=key)[:k]]
    if not now:
        return []
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        near = [min((gap(v, c), n) for n, c in enumerate(now)) for _, v in fine]
        if turn == rounds:
            break
        for n in range(len(now)):
            own = [v for (_, v), (_, c) in zip(fine, near) if c == n]
            if own:
                now[n] = [sum(x) // len(own) for x in zip(*own)]
    out = []
    for (i, _), (d, c) in zip(fine, near):
        digest = hashlib.sha256(",".join(map(str, now[c])).encode()).hexdigest()
        out.append((i, c, d, sum(x for x, n in near if n == c), sum(x for x, _ in near), digest))
    return out


def crowd(rng, dim, n=300, scale=1.0, offset=0.0):
    middles = offset + rng.normal(size=(5, dim)) * scale
    rows = [(i, (middles[i % 5] + 0.1 * scale * rng.normal(size=dim)).tolist(), i % 3)
            for i in range(n)]
    rows += [(1000 + i, [offset + 0.25 * scale] * dim, 1) for i in range(150)]  # a third are copies
    rows += [(2000, None, 1), (2001, [1.0] * (dim - 1), 1), (2002, [None] + [1.0] * (dim - 1), 1),
             (2003, [math.nan] * dim, 1), (2004, [math.inf] * dim, 1), (2005, [], 1),
             (None, [offset] * dim, 1), (None, [offset] * dim, None), (7, [offset + 0.1] * dim, 2), rows[3], rows[3]]
    return rows


@pytest.mark.parametrize("dim, k, scale, offset, block", [
    (6, 4, 1.0, 0.0, 16), (64, 16, 1.0, 0.0, 7), (3, 9, 1e6, 0.0, 50), (2, 3, 1e3, 1e8, 64)])
def test_clusters_equal_brute_force(spark, dim, k, scale, offset, block):
    rows = crowd(np.random.default_rng(dim), dim, scale=scale, offset=offset)
    found = zonemaps.cluster(frame(spark, rows), k, 3, dim, 64, "1", block)
    assert ordered(zonemaps.report(found).collect()) == ordered(lloyd(rows, k, 3, dim, 64))
    assert all(0 <= n <= found.pairs for n in found.compared)


def test_boxes_spare_comparisons(spark):
    rng = np.random.default_rng(1)
    middles = 20 * rng.normal(size=(8, 16))
    rows = [(i, (middles[i % 8] + 0.01 * rng.normal(size=16)).tolist(), 0) for i in range(4000)]
    found = zonemaps.cluster(frame(spark, rows), 8, 2, 16, 64, block=100)
    assert max(found.compared) < found.pairs / 4


def test_fewer_vectors_than_centroids_and_none(spark):
    rows = [(4, [1.0, 2.0], 0), (None, [0.0, 0.0], 0)]
    assert ordered(zonemaps.report(zonemaps.cluster(frame(spark, rows), 16, 3, 2, 64)).collect()) == (
        ordered(lloyd(rows, 16, 3, 2, 64)))
    for none in (rows[1:], []):
        assert zonemaps.report(zonemaps.cluster(frame(spark, none), 16, 3, 2, 64)).collect() == []


def test_too_large(spark):
    with pytest.raises(Exception, match="too large to be exact"):
        zonemaps.cluster(frame(spark, [(1, [1e300, 0.0], 0)]), 2, 1, 2, 64)
    with pytest.raises(Exception, match="does not fit a long"):
        rows = [(1, [1e13, 0.0], 0), (2, [-1e13, 0.0], 0)]
        zonemaps.report(zonemaps.cluster(frame(spark, rows), 1, 1, 2, 64)).collect()


@pytest.mark.parametrize("axes, bits", [(1, 5), (2, 4), (3, 3), (5, 2)])
def test_hilbert_curve_steps_to_neighbours(axes, bits):
    cells = np.array(list(itertools.product(range(1 << bits), repeat=axes)))
    keys = zonemaps.hilbert(cells, bits)
    assert sorted(keys.tolist()) == list(range(len(cells)))
    walk = cells[np.argsort(keys)]
    assert (np.abs(np.diff(walk, axis=0)).sum(axis=1) == 1).all()


# --- hard negatives ---------------------------------------------------------------------


def mined(rows, positives=5, k=10, low=30, high=90, step=100):
    best = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(
                x is None or not math.isfinite(x) for x in v):
            continue
        one = (lab, ints(v, 256))
        best[i, len(v)] = min(best.get((i, len(v)), one), one)
    out = []
    anchors = {}
    for (i, _), one in best.items():
        if i % step == 0:
            anchors[i] = min(anchors.get(i, one), one)
    for a, (lab, v) in anchors.items():
        near = sorted((-sum(x * y for x, y in zip(v, w)), i, other)
                      for (i, n), (other, w) in best.items() if i != a and n == len(v))
        for s, p, _ in [x for x in near if x[2] == lab][:positives]:
            hard = [(-t, i) for t, i, other in near
                    if other != lab and low * -s <= 100 * -t <= high * -s][:k]
            out += [(a, p, n + 1, i, -s, t) for n, (t, i) in enumerate(hard)]
    return out


def got(spark, rows, **how):
    df = negatives.labelled_vectors(frame(spark, rows))
    return ordered(negatives.hard_negatives(df, df.where("vec_id % 100 = 0"), **how).collect())


@pytest.mark.parametrize("seed, shape, tile", [(0, None, 256), (1, (4, 3), 2), (2, (9, 1), 5)])
def test_negatives_equal_brute_force(spark, seed, shape, tile):
    rng = np.random.default_rng(seed)
    middle = rng.normal(size=6)
    rows = [(i, (middle + rng.normal(size=6)).round(1).tolist(), int(rng.integers(3)))
            for i in range(0, 900, 3)]
    rows += [(1, [0.0] * 6, 0), (2, None, 0), (4, [1.0] * 6, None), (5, [math.nan] * 6, 1),
             (7, [None] * 6, 1), (None, [1.0] * 6, 1), (8, [1.0, 2.0], 1), (200, [1.0, 2.0], 2),
             (1100, [0.0] * 6, 1), (1200, (-middle).tolist(), 1), rows[5], rows[5], (300, [0.1] * 6, 0)]
    rows += [(5000 + i, [0.5] * 6, i % 2) for i in range(120)]  # copies tie
    for k, positives in ((10, 5), (3, 2)):
        want = ordered(mined(rows, positives, k))
        assert got(spark, rows, positives=positives, negatives=k, shape=shape, tile_rows=tile,
                   fan=2) == want
        assert want


def test_blocks_of_a_shard_change_nothing(spark, monkeypatch):
    rng = np.random.default_rng(5)
    lists = vectors._Lists(np.full((4, 1), vectors.MOST), np.full((4, 1), vectors.LEAST), 3)
    scores = rng.integers(-3, 3, size=(4, 60))
    for a, b in ((0, 1), (1, 20), (20, 60)):
        lists.add(scores[:, a:b], np.arange(a, b), np.ones((4, b - a), bool))
    want = [(r, -s, c) for r in range(4) for s, c in sorted(zip(-scores[r], range(60)))[:3]]
    row, _, score, ids = lists.kept
    assert list(zip(row, score, ids)) == want


def test_no_negatives(spark):
    assert got(spark, []) == []
    assert got(spark, [(0, [1.0], 1), (100, [2.0], 2)]) == []
    assert got(spark, [(0, [1.0], 1), (1, [-1.0], 1), (2, [-0.5], 2)]) == []


def test_copies_grow_with_the_rows():
    for n, q in ((10**6, 20_000), (10**8, 2 * 10**6), (10**10, 2 * 10**8)):
        shards, teams = vectors.grid(n, q, 0, 1_000)
        assert shards * teams <= 1_250 and n * teams + q * shards < 12 * n
    assert vectors.grid(0, 0, 0, 8) == (1, 1)
    assert vectors.grid(10**9, 10, 64 << 30, 100)[0] == 1024


@pytest.mark.parametrize("name", ["op12_centroid_clusters", "op13_hard_negatives"])
def test_query_matches_sql(spark, name):
    con = connect(SF_DIR)
    assert differences(entry.queries()[name](spark, SF_DIR), con, entry.oracle_sql()[name]) == []
