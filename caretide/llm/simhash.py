"""SimHash near-dedup with a byte-position inverted index and count filtering.

A fingerprint has eight bytes. Two that differ in at most three bits share at least
five bytes at the same positions. The index posts each distinct fingerprint under
groups of three positional bytes, chosen so that any five positions hold one whole
group: the triples within the first and within the last four positions. Under each
posting the shared positional bytes of pairs are tallied, pairs that reach the
guaranteed minimum stay, and their bits are compared.

A large posting is posted anew under two more positions, very large ones before they
are dealt to tasks. What is large still leaves 24 bits free, so each of its members
looks up all its neighbours instead of being compared with all others. Of the links in a posting only those that connect
something new are passed on.

Cases: a null or empty text, or one of white space alone, has fingerprint zero and
links like any other; repeated rows and equal texts share a fingerprint; a null
``doc_id`` is never a component's smallest unless all its ids are null; a very long
text has one fingerprint like any other; an empty table gives no rows. Other columns
are dropped by ``near_duplicates`` and stay, whatever their names, in ``keep_one``,
which of rows with the same id and text keeps any one.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from caretide.llm.common import Batches, map_batches, parts_for, texts
from caretide.llm.graph import components
from caretide.session import materialize

SHINGLE = 3
MAX_BITS = 3
SEED = 42
BYTES = 8
#: Every choice of five positions has three in one half, hence a whole triple.
TRIPLES = [*combinations(range(4), 3), *combinations(range(4, 8), 3)]
#: Postings up to this size are compared member by member.
POSTING = 2_048
#: Postings above this size are dealt anew, by two more positions. What is dealt then
#: holds at most 2^24 fingerprints, as three bytes are free.
LARGE = 100_000
FURTHER = 1 << 60


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's word shingles, as a signed 64-bit number."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle:
        hashes = np.array([xxhash.xxh64_intdigest(joined, seed)], np.uint64)
    else:
        ends = np.cumsum([len(w) + 1 for w in words]) - 1
        starts = np.concatenate([[0], ends[:-1] + 1])
        digest = xxhash.xxh64_intdigest
        spans = zip(starts[:len(words) - shingle + 1].tolist(), ends[shingle - 1:].tolist())
        hashes = np.array([digest(joined[a:b], seed) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        block = hashes[at:at + 65_536]
        ones += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(
            axis=0, dtype=np.int64)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, seed: int = SEED) -> DataFrame:
    """``doc_id``, ``mark`` (tells apart texts of one id) and ``fp`` of every row."""
    source = texts(docs).withColumn("mark", F.xxhash64("text"))

    def run(batches: Batches) -> Batches:
        for batch in batches:
            made = [fingerprint(t.as_py(), shingle, seed) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array(made, pa.int64())],
                names=["doc_id", "mark", "fp"],
            )

    return map_batches(source, run, "doc_id long, mark long, fp long")


def _post(batches: Batches) -> Batches:
    """Each fingerprint under its eight keys: the triple's number and its bytes."""
    for batch in batches:
        fp = batch.column("fp").to_numpy()
        raw = _bytes(fp)
        for number, places in enumerate(TRIPLES):
            yield pa.RecordBatch.from_arrays(
                [pa.array((number << 24) | _joined(raw, places)), batch.column("fp")],
                names=["key", "fp"])


def _post_further(batches: Batches) -> Batches:
    """Members of large postings under two more positions each, in ten ways."""
    for batch in batches:
        fp, key = batch.column("fp").to_numpy(), batch.column("key").to_numpy()
        raw = _bytes(fp)
        for number, triple in enumerate(TRIPLES):
            own = (key >> 24) == number
            for way, pair in enumerate(combinations(_others(triple), 2)):
                code = FURTHER | ((number * 10 + way) << 40) | _joined(raw[own], (*triple, *pair))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code), pa.array(fp[own])], names=["key", "fp"])


def _bytes(fps: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(fps).view(np.uint8).reshape(-1, BYTES).astype(np.int64)


def _joined(raw: np.ndarray, places: tuple[int, ...]) -> np.ndarray:
    code = np.zeros(len(raw), np.int64)
    for p in places:
        code = (code << 8) | raw[:, p]
    return code


def _others(places: tuple[int, ...]) -> list[int]:
    return [p for p in range(BYTES) if p not in places]


def _linked(x: np.ndarray, y: np.ndarray, max_bits: int) -> np.ndarray:
    """Tallies shared positional bytes, keeps pairs that reach the minimum, verifies bits."""
    differ = x ^ y
    out = np.zeros(differ.shape, bool)
    apart = sum(((differ >> np.uint64(8 * i)) & np.uint64(255)) != 0 for i in range(BYTES))
    enough = apart <= max_bits  # at least BYTES - max_bits bytes are shared
    out[enough] = np.bitwise_count(differ[enough]) <= max_bits
    return out


class _Forest:
    """Keeps of a posting's links those that join two of its parts."""

    def __init__(self, size: int):
        self.label, self.edges = np.arange(size), []

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            new = self.label[i] != self.label[j]
            if not new.any():
                return
            i, j = i[new], j[new]
            a, b = self.label[i], self.label[j]
            high, low = np.maximum(a, b), np.minimum(a, b)
            # one link for each part that is to be hung below another
            order = np.lexsort((low, high))
            first = order[np.concatenate([[True], high[order][1:] != high[order][:-1]])]
            self.edges.append((i[first], j[first]))
            parent = np.arange(len(self.label))
            parent[high[first]] = low[first]
            while True:
                up = parent[parent]
                if (up == parent).all():
                    break
                parent = up
            self.label = parent[self.label]


def _by_pairs(fps: np.ndarray, forest: _Forest, at: np.ndarray, max_bits: int) -> None:
    members = fps[at]
    for k in range(len(at) - 1):
        near = np.flatnonzero(_linked(members[k + 1:], members[k], max_bits)) + k + 1
        if len(near):
            forest.add(np.full(len(near), at[k]), at[near])


def _by_lookup(
    fps: np.ndarray, forest: _Forest, at: np.ndarray, free: list[int], max_bits: int
) -> None:
    """Members that differ in the free bytes only look up every neighbour in reach."""
    code = _joined(_bytes(fps[at]), tuple(free))
    order = np.argsort(code)
    code, at = code[order], at[order]
    for count in range(1, max_bits + 1):
        for bits in combinations(range(8 * len(free)), count):
            other = code ^ sum(1 << b for b in bits)
            place = np.minimum(np.searchsorted(code, other), len(code) - 1)
            hit = (code[place] == other) & (code < other)
            if hit.any():
                forest.add(at[hit], at[place[hit]])


def _by_five(
    fps: np.ndarray, forest: _Forest, at: np.ndarray, places: tuple[int, ...], max_bits: int,
    limit: int,
) -> None:
    """Links among members that share the bytes at five places."""
    if len(at) <= limit:
        _by_pairs(fps, forest, at, max_bits)
    else:
        _by_lookup(fps, forest, at, _others(places), max_bits)


def _groups(keys: np.ndarray):
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    return (g for g in np.split(order, cuts) if len(g) > 1)


def posting_links(
    fps: np.ndarray, key: int, max_bits: int = MAX_BITS, limit: int = POSTING
) -> tuple[np.ndarray, np.ndarray]:
    """Links (a spanning part of them) between the distinct fingerprints of one posting."""
    forest, everyone = _Forest(len(fps)), np.arange(len(fps))
    if key & FURTHER:
        triple, way = divmod((key ^ FURTHER) >> 40, 10)
        pair = [*combinations(_others(TRIPLES[triple]), 2)][way]
        _by_five(fps, forest, everyone, (*TRIPLES[triple], *pair), max_bits, limit)
    elif len(fps) <= limit:
        _by_pairs(fps, forest, everyone, max_bits)
    else:
        triple, raw = TRIPLES[key >> 24], _bytes(fps)
        for pair in combinations(_others(triple), 2):  # five shared: two beside the triple
            for group in _groups(_joined(raw, pair)):
                _by_five(fps, forest, group, (*triple, *pair), max_bits, limit)
    if not forest.edges:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    i, j = (np.concatenate(x) for x in zip(*forest.edges))
    return fps[i], fps[j]


def _compare(max_bits: int, limit: int):
    """Sorted postings in, links out. A posting may go over several batches."""

    def run(batches: Batches) -> Batches:
        key, held = None, []

        def links() -> pa.RecordBatch | None:
            fps = np.concatenate(held)
            if len(fps) < 2:
                return None
            u, v = posting_links(fps, key, max_bits, limit)
            return pa.RecordBatch.from_arrays(
                [pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for batch in batches:
            keys = batch.column("key").to_numpy()
            fps = np.ascontiguousarray(batch.column("fp").to_numpy()).view(np.uint64)
            starts = np.concatenate([[0], np.flatnonzero(np.diff(keys)) + 1])
            ends = np.concatenate([starts[1:], [len(keys)]])
            whole = (ends - starts > 1) | (starts == 0) | (ends == len(keys))
            for a, b in zip(starts[whole].tolist(), ends[whole].tolist()):
                if key is not None and keys[a] != key:
                    if (out := links()) is not None:
                        yield out
                    held = []
                key = int(keys[a])
                held.append(fps[a:b])
        if key is not None and (out := links()) is not None:
            yield out

    return run


def links(
    distinct: DataFrame, max_bits: int = MAX_BITS, limit: int = POSTING, large: int = LARGE
) -> DataFrame:
    """``u``, ``v``: links that connect what pairs within ``max_bits`` connect.

    ``distinct`` holds each fingerprint once. The guarantee of five shared bytes
    holds for at most three bits.
    """
    if not 0 <= max_bits <= BYTES - 5:
        raise ValueError("the index covers distances of 0 to 3 bits")
    kind = "key long, fp long"
    posted = map_batches(distinct, _post, kind)
    crowded = materialize(
        posted.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > large)
        .select("key"), "large-postings")
    if not crowded.isEmpty():
        further = map_batches(posted.join(crowded, "key", "left_semi"), _post_further, kind)
        posted = posted.join(crowded, "key", "left_anti").unionByName(further)
    ordered = posted.repartition(parts_for(distinct), "key").sortWithinPartitions("key", "fp")
    return map_batches(ordered, _compare(max_bits, limit), "u long, v long")


def groups(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    """The fingerprint of every row, and of each fingerprint its group and first ``doc_id``.

    A group's ``root`` is one of its fingerprints.
    """
    made = materialize(fingerprints(docs, shingle, seed), "fingerprints")
    first = made.groupBy("fp").agg(F.min("doc_id").alias("low"))
    joined = components(links(first.select("fp"), max_bits))
    return made, first.join(joined.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (hex digits) and ``component_id`` of every row."""
    made, of = groups(docs, shingle, max_bits, seed)
    lowest = of.groupBy("root").agg(F.min("low").alias("component_id"))
    ids = of.join(lowest, "root").select("fp", "component_id")
    return made.join(ids, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, seed: int = SEED
) -> DataFrame:
    """The rows of ``docs`` without all but one of each group: that with the smallest id.

    Rows without an id stay only where their whole group has none; of repeated rows
    one stays.
    """
    name = "kept"
    while name in docs.columns:
        name += "_"
    made, of = groups(docs, shingle, max_bits, seed)
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    chosen = (
        made.groupBy("fp").agg(F.min(order).alias("best")).join(of.select("fp", "root"), "fp")
        .groupBy("root").agg(F.min("best").alias("best"))
        # a mark is never null; said so, the two keys have one type and need no cast
        .select(F.struct("best.doc_id", F.coalesce("best.mark", F.lit(0).cast("long")).alias(
            "mark")).alias(name))
    )
    # one key column, by which the rows are dealt once for both steps
    key = F.struct(F.col("doc_id").cast("long").alias("doc_id"),
                   F.xxhash64(F.col("text").cast("string")).alias("mark"))
    return (
        docs.withColumn(name, key).join(chosen, name, "left_semi")
        .dropDuplicates([name]).drop(name)
    )
