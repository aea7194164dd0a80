"""SimHash near-dedup against all pairs."""

import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from caretide.llm import graph, simhash


def brute_fingerprint(text):
    lower = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lower)
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or (
        [" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(nodes, pairs):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {n: find(n) for n in nodes}


def expected(rows):
    fps = [brute_fingerprint(t) for _, t in rows]
    pairs = [(i, j) for i in range(len(fps)) for j in range(i)
             if (fps[i] ^ fps[j]).bit_count() <= 3]
    root = roots(range(len(rows)), pairs)
    ids = {}
    for n, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            ids[root[n]] = min(ids.get(root[n], doc_id), doc_id)
    return sorted([(doc_id, f"{fps[n]:016x}", ids.get(root[n]))
                   for n, (doc_id, _) in enumerate(rows)], key=repr)


def test_clashing_columns_and_odd_texts(docs, rows):
    got = simhash.near_duplicates(docs).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_documents(documents):
    rows = [(r.doc_id, r.text) for r in documents.collect()]
    got = simhash.near_duplicates(documents).collect()
    assert sorted((tuple(r) for r in got), key=repr) == expected(rows)


def test_keep_one_leaves_the_smallest_of_each_group(docs, rows):
    docs = docs.withColumn("kept_", F.lit("kept_"))  # a name that it would use itself
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    found = kept.collect()
    ids = sorted(r.doc_id for r in found if r.doc_id is not None)
    assert ids == sorted({c for _, _, c in expected(rows) if c is not None})
    # rows without an id stay only where their whole group has none
    lone = {f for d, f, c in expected(rows) if c is None}
    assert sum(r.doc_id is None for r in found) == len(lone) == 1


@pytest.mark.parametrize("limit", [2_048, 50, 5])
def test_large_postings_lose_no_link(limit):
    rng = np.random.default_rng(limit)
    fps = np.unique(np.array([
        0x0123456789ABCDEF ^ sum(1 << int(b) for b in 24 + rng.choice(40, rng.integers(0, 6), False))
        for _ in range(500)], np.uint64))
    u, v = simhash.posting_links(fps, 0, 3, limit)
    nodes = [int(f) for f in fps]
    near = [(a, b) for i, a in enumerate(nodes) for b in nodes[:i] if (a ^ b).bit_count() <= 3]
    found = [(int(a), int(b)) for a, b in zip(u, v)]
    assert all((a ^ b).bit_count() <= 3 for a, b in found)
    assert len(found) < len(nodes) * 10 or limit > 5
    assert roots(nodes, found) == roots(nodes, near)


@pytest.mark.parametrize("large", [3, 100])
def test_dealing_large_postings_anew_changes_nothing(spark, large):
    rng = np.random.default_rng(large)
    fps = sorted({
        0x0123456789ABCDEF ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(0, 5), False))
        for _ in range(400)})
    df = spark.createDataFrame([(f,) for f in fps], "fp long").repartition(3)
    near = [(a, b) for i, a in enumerate(fps) for b in fps[:i] if (a ^ b).bit_count() <= 3]
    found = [tuple(r) for r in simhash.links(df, 3, limit=20, large=large).collect()]
    assert roots(fps, found) == roots(fps, near)


def test_components_of_long_paths_and_stars(spark):
    pairs = [(n, n + 1) for n in range(60)] + [(500, n) for n in range(501, 560)] + [(900, 900)]
    df = spark.createDataFrame(pairs, "u long, v long").repartition(5)
    got = {r.node: r.root for r in graph.components(df).collect()}
    assert all(got.get(n, 0) == 0 for n in range(61))
    assert all(got[n] == 500 for n in range(501, 560)) and 900 not in got


def test_empty(none):
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.keep_one(none).collect() == []
