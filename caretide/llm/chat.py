"""Chat formatting by assembling tokens.

Every role and text is escaped and encoded apart, so no merge crosses a segment;
the turn marks are reserved ids above the vocabulary, spliced in between. The
loss mask comes from prefix sums over the segments' lengths.

A conversation reads ``<s>``, then for each turn ``<|start|>`` role ``<|message|>``
text ``</s>``. Where a content holds a control string, a backslash goes behind
the string's first character; one more goes in if some are there already, so
taking one out again gives the content back.

Cases: a null text or role is an empty one; a null turn comes first; turns with
the same number come in the order of their ids; rows of a null ``conv_id`` form one
conversation; an empty table gives no rows; other columns are dropped.
A conversation is one row of the result and is held by one task as a whole; its
texts are encoded before that, wherever their rows lie, a very long one like any other.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caretide.llm.bpe import token_bytes, tokenizer
from caretide.llm.common import Batches, map_batches

MARKS = ("<s>", "<|start|>", "<|message|>", "</s>")
BEGIN, START, MESSAGE, END = range(4)
#: Strings that no formatted content may hold: the marks, and those of common templates.
CONTROL = (*MARKS, "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>")
TRAINED = ("assistant",)

_BEHIND = "|".join(
    re.escape(c) + r"(?=\\*(?:" + "|".join(re.escape(x[1:]) for x in CONTROL if x[0] == c) + "))"
    for c in sorted({x[0] for x in CONTROL})
)
_PLAIN = re.compile(f"(?:{_BEHIND})")
_ESCAPED = re.compile(_BEHIND.replace(r"(?=\\*", r"\\(?=\\*"))


def escape(content: str) -> str:
    return _PLAIN.sub(lambda m: m.group() + "\\", content)


def unescape(content: str) -> str:
    return _ESCAPED.sub(lambda m: m.group()[:-1], content)


def segments(turns: DataFrame, vocab: str, pattern: str, trained=TRAINED) -> DataFrame:
    """Each row's role and text as ids, and whether its text is trained on."""
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )

    def run(batches: Batches) -> Batches:
        encoding = tokenizer(vocab, pattern)

        def ids(contents: list[str]) -> pa.Array:
            return pa.array(
                [encoding.encode_ordinary(escape(c)) for c in contents], pa.list_(pa.int32())
            )

        for batch in batches:
            roles = batch.column("role").to_pylist()
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), batch.column("turn"), ids(roles),
                 ids(batch.column("text").to_pylist()),
                 pa.array([r in trained for r in roles], pa.bool_())],
                names=["conv_id", "turn", "role_ids", "text_ids", "trained"],
            )

    return map_batches(
        rows, run,
        "conv_id long, turn long, role_ids array<int>, text_ids array<int>, trained boolean",
    )


def _lists(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Where each list begins and the last one ends, and all lists' values."""
    offsets = column.offsets.to_numpy()
    return offsets - offsets[0], column.flatten()


def _assembled(turns: pa.ListArray, first: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, mask, and where each conversation begins in them.

    Every conversation is a row of segments: ``<s>``, then five for each turn. A
    running sum over the segments' lengths says where they lie, one over the
    edges of trained segments which ids are trained.
    """
    bounds, rows = _lists(turns)
    role_at, roles = _lists(rows.field("role_ids"))
    text_at, text = _lists(rows.field("text_ids"))
    trained = rows.field("trained").to_numpy(zero_copy_only=False)
    n, size = len(rows), np.diff(bounds)
    # the segment that a turn's <|start|> is; conversation c has c + 1 <s> before its turns
    head = 5 * np.arange(n) + np.repeat(np.arange(len(size)) + 1, size)
    length = np.ones(5 * n + len(size), np.int64)
    length[head + 1], length[head + 3] = np.diff(role_at), np.diff(text_at)
    end = np.cumsum(length)
    begin = end - length
    opens = 5 * bounds[:-1] + np.arange(len(size))  # the segment that <s> is
    ids = np.empty(int(end[-1]) if len(end) else 0, np.int32)
    for mark, segment in (
        (BEGIN, opens), (START, head), (MESSAGE, head + 2), (END, head + 4)
    ):
        ids[begin[segment]] = first + mark
    for at, values, segment in ((role_at, roles, head + 1), (text_at, text, head + 3)):
        count = np.diff(at)
        ids[np.repeat(begin[segment] - at[:-1], count) + np.arange(at[-1])] = values.to_numpy()
    chosen = (head + 3)[trained]
    step = np.zeros(len(ids) + 1, np.int64)
    np.add.at(step, begin[chosen], 1)
    np.add.at(step, end[chosen], -1)
    where = np.append(begin[opens], len(ids))
    return ids, np.cumsum(step[:-1]).astype(bool), where


def assemble(
    turns: DataFrame, vocab: str, pattern: str, first_reserved: int, trained=TRAINED
) -> DataFrame:
    """``conv_id``, ``ids`` (array of int) and ``mask`` (array of boolean, trained ids)."""
    grouped = segments(turns, vocab, pattern, trained).groupBy("conv_id").agg(
        F.sort_array(F.collect_list(F.struct("turn", "role_ids", "text_ids", "trained")))
        .alias("turns")
    )

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, mask, where = _assembled(batch.column("turns"), first_reserved)
            where = pa.array(where, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"), pa.ListArray.from_arrays(where, pa.array(ids)),
                 pa.ListArray.from_arrays(where, pa.array(mask))],
                names=["conv_id", "ids", "mask"],
            )

    return map_batches(grouped, run, "conv_id long, ids array<int>, mask array<boolean>")


def read_back(coded: DataFrame, vocab: str, first_reserved: int) -> DataFrame:
    """From ids and mask alone: the formatted text, its turns and the trained text."""

    def run(batches: Batches) -> Batches:
        of = token_bytes(vocab)
        of.update({first_reserved + i: m.encode() for i, m in enumerate(MARKS)})
        size_of = np.zeros(max(of) + 1, np.int64)
        size_of[list(of)] = [len(t) for t in of.values()]
        turn = pa.list_(pa.struct([("role", pa.string()), ("text", pa.string())]))

        for batch in batches:
            where, flat = _lists(batch.column("ids"))
            ids = flat.to_numpy()
            mask = _lists(batch.column("mask"))[1].to_numpy(zero_copy_only=False)
            raw = b"".join(map(of.__getitem__, ids.tolist()))
            byte = np.append(0, np.cumsum(size_of[ids]))  # where each id's bytes begin

            def texts(low: np.ndarray, high: np.ndarray) -> list[str]:
                return [raw[a:b].decode() for a, b in zip(byte[low].tolist(), byte[high].tolist())]

            start, message, end = (
                np.flatnonzero(ids == first_reserved + m) for m in (START, MESSAGE, END))
            roles, contents = texts(start + 1, message), texts(message + 1, end)
            turns = [{"role": unescape(r), "text": unescape(t)} for r, t in zip(roles, contents)]
            of_conv = np.searchsorted(start, where)
            edges = np.flatnonzero(np.diff(mask.astype(np.int8), prepend=0, append=0))
            learned = [unescape(t) for t in texts(edges[::2], edges[1::2])]
            of_run = np.searchsorted(edges[::2], where)
            yield pa.RecordBatch.from_arrays(
                [batch.column("conv_id"),
                 pa.array(texts(where[:-1], where[1:]), pa.string()),
                 pa.array([turns[a:b] for a, b in zip(of_conv, of_conv[1:])], turn),
                 pa.array(["".join(learned[a:b]) for a, b in zip(of_run, of_run[1:])], pa.string())],
                names=["conv_id", "formatted", "turns", "trained_text"],
            )

    return map_batches(
        coded, run,
        "conv_id long, formatted string, turns array<struct<role:string,text:string>>, "
        "trained_text string",
    )


def digests(read: DataFrame) -> DataFrame:
    line = lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(F.transform("turns", line), ""), 256).alias("turns_sha256"),
        F.length("trained_text").cast("long").alias("loss_chars"),
        F.sha2("trained_text", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )
