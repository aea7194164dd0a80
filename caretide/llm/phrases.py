"""Substring dedup with automata over recurring phrases.

A window is ``width`` consecutive words of one document. It goes wherever the same
words also start in a document with a smaller id; what is judged is the input, not
what is left. Three steps:

1. Recurring passages are found by anchors (``repeats``): segments that a smaller id
   has as a whole are settled there; segments that share an anchor but differ go on.
2. These are dealt by anchor. Each shard confirms its windows that occur in two
   documents, numbers its words, and compiles an Aho-Corasick automaton over the
   confirmed phrases, each with the smallest id that has it.
3. The shard's segments, from all documents, stream through the automaton, which
   locates every occurrence.

Cases: a null or empty text has no words; a null id comes after all others, and
rows with the same id are one document as far as "smaller" goes; repeated rows are
treated alike; texts shorter than a window stay; a very long text is hashed in
stretches; an empty table gives no rows; other columns are dropped.
"""

from __future__ import annotations

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caretide.llm import repeats
from caretide.llm.common import Batches, map_batches, parts_for
from caretide.session import materialize

WIDTH = 13
GRAM = 4
#: Segments in one shard's automaton, unless one anchor alone has more.
SHARD = 20_000


def _occurrences(rows: list[dict], width: int) -> list[tuple[dict, int]]:
    """Where, in a shard's segments, windows start that a smaller id has too."""
    numbers: dict[bytes, int] = {}
    lines = [
        tuple(numbers.setdefault(w, len(numbers)) for w in row["content"].split(b" "))
        for row in rows
    ]
    smallest: dict[tuple, int] = {}
    recurring: set[tuple] = set()
    for row, line in zip(rows, lines):
        for at in range(len(line) - width + 1):
            phrase, own = line[at:at + width], row["id"]
            seen = smallest.setdefault(phrase, own)
            if seen != own:
                recurring.add(phrase)
                smallest[phrase] = min(seen, own)
    if not recurring:
        return []
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    values = []
    for phrase in recurring:
        automaton.add_word(phrase, len(values))
        values.append(smallest[phrase])
    automaton.make_automaton()
    return [
        (row, end - width + 1)
        for row, line in zip(rows, lines) if row["test"]
        for end, number in automaton.iter(line) if values[number] < row["id"]
    ]


def _shards(width: int, shard: int):
    """Segments sorted by anchor in, repeated stretches out."""

    def run(batches: Batches) -> Batches:
        held: list[dict] = []

        def settle() -> pa.RecordBatch:
            found = _occurrences(held, width)
            return pa.RecordBatch.from_pydict({
                "id": pa.array([r["id"] for r, _ in found], pa.int64()),
                "mark": pa.array([r["mark"] for r, _ in found], pa.int64()),
                "more": pa.array([r["more"] for r, _ in found], pa.int32()),
                "start": pa.array([r["start"] + at for r, at in found], pa.int64()),
                "units": pa.array([width] * len(found), pa.int64()),
            })

        for batch in batches:
            for row in batch.to_pylist():
                if len(held) >= shard and row["anchor"] != held[-1]["anchor"]:
                    yield settle()
                    held.clear()
                held.append(row)
        if held:
            yield settle()

    return run


def remove_repeats(
    docs: DataFrame, width: int = WIDTH, gram: int = GRAM, shard: int = SHARD,
    hot: int = repeats.HOT, **sampling: int,
) -> DataFrame:
    """``doc_id``, ``text``, ``n_words``, ``n_removed`` and ``kept`` of every row.

    ``kept`` holds the words that stay, joined by single spaces.
    """
    source = repeats.keyed(docs)
    lay = repeats.word_units
    segments = repeats.segment_rows(source, lay, width, gram, repeats.SMALLER, hot, **sampling)
    spans = materialize(segments, "phrase-segments")
    settled = spans.where(F.col("anchor").isNull()).select(*repeats.KEY, "start", "units")
    open_ = spans.where(F.col("anchor").isNotNull())
    dealt = repeats.contents(source, open_.where(~F.col("hot")), lay)
    ordered = dealt.repartition(parts_for(docs), "anchor").sortWithinPartitions("anchor", "id")
    found = settled.unionByName(map_batches(
        ordered, _shards(width, shard), "id long, mark long, more int, start long, units long"))
    if not open_.where("hot").isEmpty():
        found = found.unionByName(repeats.by_window(
            repeats.contents(source, open_.where("hot"), lay), lay, width, repeats.SMALLER))
    return map_batches(
        repeats.stretches(source, found), _keep,
        "doc_id long, text string, n_words long, n_removed long, kept string")


def _keep(batches: Batches) -> Batches:
    for batch in batches:
        n_words, n_removed, kept = [], [], []
        for text, cell in zip(batch.column("text"), batch.column("found")):
            units = repeats.word_units([(text.as_py() or "").encode()])
            gone = repeats.covered(len(units), cell.as_py())
            n_words.append(len(gone))
            n_removed.append(int(gone.sum()))
            stay = np.ones(len(units.data), bool)
            if gone.any():  # a word goes with the space behind it
                size = units.stop - units.start
                size = np.minimum(size + 1, len(units.data) - units.start)
                stay = np.repeat(~gone, size)
            kept.append(units.data[stay].tobytes().rstrip(b" ").decode())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("text"), pa.array(n_words, pa.int64()),
             pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
            names=["doc_id", "text", "n_words", "n_removed", "kept"])
