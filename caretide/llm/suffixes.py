"""Suffix-array dedup over bytes.

Every byte goes that a string of ``width`` bytes covers which also starts anywhere
else, in the same document or another; what is judged is the input. Suffixes are
compared up to ``width`` bytes and never across documents:

1. A suffix is led by its token, the hash of the ``gram`` bytes that are its anchor
   (``repeats``). Neighbouring suffixes led by the same token go as one segment.
   Segments that are equal as a whole are settled at once; only those that share
   their leading token and differ go on.
2. Splitters sampled from the leading tokens range-partition these.
3. A bucket sorts the suffixes in its segments by multikey quicksort, a character
   being the hash of a block of a quarter of the width: suffixes are sorted by their
   first character, ties by the second, and so on. Neighbours that tie in all four
   are repeats.
4. Ranges end between tokens, so equal suffixes meet in one bucket. A token with more
   than ``hot`` different segments is cut up, and equal suffixes are found across
   these cuts by grouping their hashes.

The order is that of tokens, not of bytes: it serves as well, since equal strings
have equal tokens and so stand side by side.

Cases: a null or empty text has no bytes; repeated rows are repeats of each other;
texts shorter than a string stay; a very long text is hashed in stretches; an empty
table gives no rows; other columns are dropped. What is left of a text need not be
valid UTF-8, so it is binary.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caretide.llm import repeats
from caretide.llm.common import Batches, map_batches, parts_for
from caretide.session import materialize

WIDTH = 400
GRAM = 100
#: Suffixes sorted at once, unless one token alone leads more.
BUCKET = 1_500_000
CHARACTERS = 4


def multikey_ties(characters: list, n: int) -> np.ndarray:
    """Which of ``n`` suffixes equal another one in all characters.

    ``characters[c](at)`` gives character c of the suffixes ``at``. Each round sorts
    only the suffixes still tied, within their tie, by the next character.
    """
    at, tie = np.arange(n), np.zeros(n, np.int64)
    for character in characters:
        key = character(at)
        order = np.lexsort((key, tie)) if tie.any() else np.argsort(key)
        at, tie, key = at[order], tie[order], key[order]
        split = (np.diff(tie) != 0) | (np.diff(key) != 0)
        opens = np.concatenate([[True], split])
        shared = ~(opens & np.concatenate([split, [True]]))
        at, tie = at[shared], (np.cumsum(opens) - 1)[shared]
        if not len(at):
            break
    out = np.zeros(n, bool)
    out[at] = True
    return out


def _repeated(rows: dict[str, list], width: int) -> tuple[np.ndarray, ...]:
    """Segment, start and length of repeated stretches in a bucket's tested segments."""
    size = np.array([len(c) for c in rows["content"]])
    data = np.frombuffer(b"".join(rows["content"]), np.uint8)
    low = np.cumsum(size) - size
    count = size - width + 1  # suffixes of full length in each segment
    first = np.cumsum(count) - count
    owner = np.repeat(np.arange(len(size)), count)
    place = np.arange(count.sum()) - first[owner] + low[owner]
    hashed = repeats.Hasher(data)
    cuts = [width * c // CHARACTERS for c in range(CHARACTERS + 1)]
    characters = [
        lambda at, a=a, b=b: hashed(place[at] + a, place[at] + b) for a, b in zip(cuts, cuts[1:])
    ]
    tied = multikey_ties(characters, len(place)) & np.array(rows["test"])[owner]
    # runs of neighbouring tied suffixes are one stretch
    edge = np.diff(tied.astype(np.int8), prepend=0, append=0)
    edge[first[1:]] = np.where(tied[first[1:]] & tied[first[1:] - 1], 2, edge[first[1:]])
    opens, closes = np.flatnonzero(edge >= 1), np.flatnonzero((edge == -1) | (edge == 2)) - 1
    own = owner[opens]
    start = np.array(rows["start"])[own] + opens - first[own]
    return own, start, closes - opens + width


def _buckets(width: int, bucket: int):
    """Segments sorted by token in, repeated stretches out."""

    def run(batches: Batches) -> Batches:
        held = {c: [] for c in ("anchor", *repeats.KEY, "start", "test", "content")}
        size = 0

        def settle() -> pa.RecordBatch:
            own, start, units = _repeated(held, width)
            keys = {c: np.array(held[c])[own] for c in repeats.KEY}
            for rows in held.values():
                rows.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(keys["id"], pa.int64()), pa.array(keys["mark"], pa.int64()),
                 pa.array(keys["more"], pa.int32()), pa.array(start, pa.int64()),
                 pa.array(units, pa.int64())],
                names=[*repeats.KEY, "start", "units"])

        for batch in batches:
            for row in batch.to_pylist():
                if size >= bucket and row["anchor"] != held["anchor"][-1]:
                    yield settle()
                    size = 0
                for name, rows in held.items():
                    rows.append(row[name])
                size += len(row["content"]) - width + 1
        if size:
            yield settle()

    return run


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, bucket: int = BUCKET,
    hot: int = repeats.HOT, **sampling: int,
) -> DataFrame:
    """``doc_id``, ``text``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (binary)."""
    source = repeats.keyed(docs)
    lay = repeats.byte_units
    segments = repeats.segment_rows(source, lay, width, gram, repeats.ANYWHERE, hot, **sampling)
    spans = materialize(segments, "byte-segments")
    settled = spans.where(F.col("anchor").isNull()).select(*repeats.KEY, "start", "units")
    open_ = spans.where(F.col("anchor").isNotNull())
    dealt = repeats.contents(source, open_.where(~F.col("hot")), lay)
    ordered = (
        dealt.withColumn("token", F.xxhash64("anchor"))
        .repartitionByRange(parts_for(docs), "token").sortWithinPartitions("token", "anchor")
    ).drop("token")
    found = settled.unionByName(map_batches(
        ordered, _buckets(width, bucket), "id long, mark long, more int, start long, units long"))
    if not open_.where("hot").isEmpty():
        found = found.unionByName(repeats.by_window(
            repeats.contents(source, open_.where("hot"), lay), lay, width, repeats.ANYWHERE))
    return map_batches(
        repeats.stretches(source, found), _keep,
        "doc_id long, text string, n_bytes long, n_removed long, n_spans long, kept binary")


def _keep(batches: Batches) -> Batches:
    for batch in batches:
        n_bytes, n_removed, n_spans, kept = [], [], [], []
        for text, cell in zip(batch.column("text"), batch.column("found")):
            raw = (text.as_py() or "").encode()
            gone = repeats.covered(len(raw), cell.as_py())
            n_bytes.append(len(raw))
            n_removed.append(int(gone.sum()))
            n_spans.append(int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()))
            kept.append(np.frombuffer(raw, np.uint8)[~gone].tobytes() if gone.any() else raw)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(n_bytes, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()),
             pa.array(kept, pa.binary())],
            names=["doc_id", "text", "n_bytes", "n_removed", "n_spans", "kept"])
