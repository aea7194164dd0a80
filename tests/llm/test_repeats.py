"""Substring and suffix-array dedup against brute force."""

from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from caretide.llm import phrases, repeats, suffixes
from tests.llm.conftest import frame, ordered


def brute_bytes(rows, width):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(b[p:p + width] for _, b in raw for p in range(len(b) - width + 1))
    out = []
    for i, b in raw:
        gone = [False] * len(b)
        for p in range(len(b) - width + 1):
            if seen[b[p:p + width]] > 1:
                gone[p:p + width] = [True] * width
        spans = sum(1 for p in range(len(b)) if gone[p] and not (p and gone[p - 1]))
        out.append((i, len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def brute_words(rows, width):
    key = lambda i: repeats.NO_ID if i is None else i
    split = [(i, (t or "").encode().split()) for i, t in rows]
    low = {}
    for i, w in split:
        for p in range(len(w) - width + 1):
            s = tuple(w[p:p + width])
            low[s] = min(low.get(s, key(i)), key(i))
    out = []
    for i, w in split:
        gone = [False] * len(w)
        for p in range(len(w) - width + 1):
            if low[tuple(w[p:p + width])] < key(i):
                gone[p:p + width] = [True] * width
        kept = b" ".join(x for x, g in zip(w, gone) if not g).decode()
        out.append((i, len(w), sum(gone), kept))
    return out


@pytest.mark.parametrize("width, gram, bucket, hot", [
    (40, 12, 10**6, 50_000), (40, 12, 500, 1), (25, 25, 300, 50_000), (8, 1, 100, 3)])
def test_bytes(docs, rows, width, gram, bucket, hot):
    got = suffixes.remove_repeats(docs, width, gram, bucket, hot).drop("text").collect()
    assert ordered((*r[:-1], bytes(r[-1])) for r in got) == ordered(brute_bytes(rows, width))


@pytest.mark.parametrize("width, gram, shard, hot", [
    (13, 4, 20_000, 50_000), (13, 4, 20_000, 1), (5, 2, 10, 50_000), (3, 3, 7, 50_000)])
def test_words(docs, rows, width, gram, shard, hot):
    got = phrases.remove_repeats(docs, width, gram, shard, hot).drop("text").collect()
    assert ordered(got) == ordered(brute_words(rows, width))


def test_crowded_anchors_change_nothing(docs, rows):
    got = suffixes.remove_repeats(docs, 40, 12, crowd=5, sample=2).drop("text").collect()
    assert ordered((*r[:-1], bytes(r[-1])) for r in got) == ordered(brute_bytes(rows, 40))
    got = phrases.remove_repeats(docs, 13, 4, crowd=5, sample=2).drop("text").collect()
    assert ordered(got) == ordered(brute_words(rows, 13))


def test_stretches_and_small_tasks_change_nothing(docs, rows, monkeypatch):
    """Long texts are hashed in stretches; tasks settle copies more than once."""
    monkeypatch.setattr(repeats, "STRETCH", 64)
    monkeypatch.setattr(repeats, "GATHER", 50)
    monkeypatch.setattr(repeats, "GROUP_BYTES", 100)
    units = repeats.byte_units([b"abcab" * 60, b"x" * 500])
    found = list(repeats.segments(units, 40, 7))
    windows = sorted(int(low) + n for _, _, lows, counts in found
                     for low, c in zip(lows, counts) for n in range(c))
    whole = [p for p in range(800 - 39) if p + 40 <= 300 or p >= 300]
    assert windows == whole


def test_empty(none):
    assert suffixes.remove_repeats(none).collect() == []
    assert phrases.remove_repeats(none).collect() == []


def test_lowest_is_first_of_equals():
    values = np.array([5, 3, 3, 9, 1, 1, 7, 7], np.uint64) << np.uint64(10)
    assert repeats.lowest(values, 3).tolist() == [1, 1, 4, 4, 4, 5]


def test_multikey_ties():
    a = np.array([1, 1, 2, 1, 2], np.uint64)
    b = np.array([5, 6, 7, 5, 8], np.uint64)
    tied = suffixes.multikey_ties([lambda at: a[at], lambda at: b[at]], 5)
    assert tied.tolist() == [True, False, False, True, False]


def test_rows_without_id_whose_hashes_collide(spark):
    """Two texts with equal 32-bit hashes, both without id, are two texts."""
    base = ("alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho "
            "sigma tau upsilon ") * 6
    planted = [(None, base + "37589"), (None, base + "41576"), (3, "x " * 9 + base[30:500])]
    planted += [(None, "short"), (4, base[:90] + "end")]
    df = frame(spark, planted)
    first, second = df.where("text like '%37589' or text like '%41576'").select(
        F.hash("text")).collect()
    assert first == second
    got = suffixes.remove_repeats(df, 100, 25).drop("text").collect()
    assert ordered((*r[:-1], bytes(r[-1])) for r in got) == ordered(brute_bytes(planted, 100))
    got = phrases.remove_repeats(df).drop("text").collect()
    assert ordered(got) == ordered(brute_words(planted, 13))


def test_passages_of_fifty_to_two_hundred_words(spark):
    """Passages as they are planted in corpora: each stands in several documents."""
    r = np.random.default_rng(7)
    words = np.array([f"w{n}" for n in range(5_000)] + ["the", "of", "and", "é"])
    say = lambda n: " ".join(r.choice(words, n))
    passages = [say(n) for n in (51, 60, 75, 100, 150, 200)]
    planted = [(i, f"{say(80)} {passages[i % 6]} {say(80)}") for i in range(36)]
    planted += [(100 + i, say(200)) for i in range(12)]
    df = frame(spark, planted)
    rows = suffixes.remove_repeats(df, 400).drop("text").collect()
    assert ordered((*x[:-1], bytes(x[-1])) for x in rows) == ordered(brute_bytes(planted, 400))
    hit = {x.doc_id: x.n_removed for x in rows}
    long = {i for i in range(36) if len(passages[i % 6].encode()) >= 400}
    assert {i for i, n in hit.items() if n} >= long and not any(hit[i] for i in range(100, 112))
    rows = phrases.remove_repeats(df).drop("text").collect()
    assert ordered(rows) == ordered(brute_words(planted, 13))
    assert all(x.n_removed for x in rows if 6 <= x.doc_id < 36)
