"""Byte-level BPE encoding and decoding by overlapping chunks.

A text of at most ``chunk`` bytes is encoded where it lies. A longer one is cut
into chunks that overlap; the chunks are dealt to tasks and pre-tokenised in
parallel. Two neighbours agree on the first pre-token boundary that both see in
their overlap: from there on the pattern, which never looks back, goes on alike.
Pieces between such boundaries are encoded apart and their ids joined in order.
If two neighbours agree nowhere (one pre-token fills the overlap), what follows
is joined into one piece, so the result is always that of the whole text.

Cases: a null text is an empty one; an empty text has no ids; repeated rows give
repeated rows; an empty table gives no rows; other columns of the input are dropped.
"""

from __future__ import annotations

import base64

import pyarrow as pa
import regex
import tiktoken
import tiktoken.registry
from pyspark.sql import DataFrame, Window, functions as F

from caretide.llm.common import Batches, map_batches, texts

CHUNK = 32_768
OVERLAP = 1_024
#: Characters beyond a match's end that the pattern may have looked at.
LOOKAHEAD = 4


def tokenizer(vocab: str, pattern: str) -> tiktoken.Encoding:
    """The encoding for a rank file, built once in each worker process."""
    name = f"{vocab}\n{pattern}"
    kept = tiktoken.registry.ENCODINGS
    if name not in kept:
        kept[name] = tiktoken.Encoding(
            name, pat_str=pattern, mergeable_ranks=ranks(vocab), special_tokens={}
        )
    return kept[name]


def ranks(vocab: str) -> dict[bytes, int]:
    with open(vocab, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines) if a}


def token_bytes(vocab: str) -> dict[int, bytes]:
    """The bytes of each id; decoding needs no more of a tokenizer than this."""
    return {i: t for t, i in ranks(vocab).items()}


def _id_lists(encoding: tiktoken.Encoding, column: pa.Array) -> pa.Array:
    return pa.array(
        [encoding.encode_ordinary(t or "") for t in column.to_pylist()], pa.list_(pa.int32())
    )


def _encoder(vocab: str, pattern: str, source: str, keep: list[str]):
    def run(batches: Batches) -> Batches:
        encoding = tokenizer(vocab, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                yield pa.RecordBatch.from_arrays(
                    [part.column(c) for c in keep] + [_id_lists(encoding, part.column(source))],
                    names=[*keep, "ids"],
                )

    return run


def _cutter(chunk: int, overlap: int):
    """Rows of one chunk each; the last chunk of a text has no overlap."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            ids, marks = batch.column("doc_id").to_pylist(), batch.column("mark").to_pylist()
            for doc_id, mark, text in zip(ids, marks, batch.column("text")):
                text = text.as_py()
                starts = range(0, len(text), chunk)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array([doc_id] * len(starts), pa.int64()),
                    "mark": pa.array([mark] * len(starts), pa.string()),
                    "no": pa.array(range(len(starts)), pa.int32()),
                    "start": pa.array(starts, pa.int64()),
                    "piece": pa.array([text[s:s + chunk + overlap] for s in starts], pa.string()),
                })

    return run


def _boundaries(text: str, pattern: str) -> list[int]:
    return [m.start() for m in regex.finditer(pattern, text)]


def _edges(pattern: str, chunk: int, overlap: int):
    """Adds to each chunk the boundaries it sees in the overlaps at its two ends.

    A boundary counts only behind a character that is no white space, since
    white space before a cut would be matched differently once cut off, and only
    if no match before it touched the end of the chunk's text.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            heads, tails = [], []
            for start, text in zip(batch.column("start").to_pylist(), batch.column("piece")):
                text = text.as_py()
                seen = [
                    b for b in _boundaries(text, pattern)
                    if 0 < b <= len(text) - LOOKAHEAD and not text[b - 1].isspace()
                ]
                heads.append([start + b for b in seen if b <= overlap - LOOKAHEAD])
                tails.append([start + b for b in seen if b > chunk])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(heads, pa.list_(pa.int64())),
                 pa.array(tails, pa.list_(pa.int64()))],
                names=[*batch.schema.names, "heads", "tails"],
            )

    return run


def pieces(long: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Texts cut where neighbouring chunks agree: doc_id, mark, copies, no, piece.

    ``mark`` tells apart texts under one ``doc_id``; ``copies`` counts repeated rows.
    """
    marked = long.select("doc_id", F.sha2("text", 256).alias("mark"), "text")
    cut = map_batches(
        marked, _cutter(chunk, overlap),
        "doc_id long, mark string, no int, start long, piece string",
    )
    dealt = cut.groupBy("doc_id", "mark", "no", "start").agg(
        F.first("piece").alias("piece"), F.count(F.lit(1)).alias("copies")
    )
    seen = map_batches(
        dealt, _edges(pattern, chunk, overlap),
        "doc_id long, mark string, no int, start long, piece string, copies long, "
        "heads array<long>, tails array<long>",
    )
    order = Window.partitionBy("doc_id", "mark").orderBy("no")
    agreed = F.array_min(F.array_intersect("tails", F.lead("heads").over(order)))
    last = F.lead("no").over(order).isNull()
    # once neighbours disagree, later boundaries are not proven either
    sure = F.min(F.when(F.col("last") | F.col("cut").isNotNull(), 1).otherwise(0)).over(order)
    bounded = (
        seen.withColumns({"cut": agreed, "last": last})
        .withColumn("sure", sure)
        .withColumn("cut", F.when(F.col("sure") == 1, F.col("cut")))
        .withColumn("low", F.coalesce(F.lag("cut").over(order), F.col("start")))
        .withColumn("high", F.coalesce(F.col("cut"), F.col("start") + F.lit(chunk)))
        # chunks from the first disagreement on share one number
        .withColumn("group", F.when(F.col("sure") == 1, F.col("no")).otherwise(
            F.min(F.when(F.col("sure") == 0, F.col("no"))).over(order)))
        .withColumn("piece", F.expr(
            "substring(piece, int(low - start) + 1, int(high - low))"))
    )
    return (
        bounded.groupBy("doc_id", "mark", "copies", "group")
        .agg(F.sort_array(F.collect_list(F.struct("no", "piece"))).alias("parts"))
        .select("doc_id", "mark", "copies", F.col("group").alias("no"),
                F.array_join(F.col("parts.piece"), "").alias("piece"))
    )


def encode(
    docs: DataFrame, vocab: str, pattern: str, chunk: int = CHUNK, overlap: int = OVERLAP
) -> DataFrame:
    """``doc_id`` and ``ids`` (array of int) of every text, without special tokens."""
    source = texts(docs).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    is_long = F.octet_length("text") > chunk
    short = map_batches(
        source.where(~is_long), _encoder(vocab, pattern, "text", ["doc_id"]),
        "doc_id long, ids array<int>",
    )
    cut = pieces(source.where(is_long), pattern, chunk, overlap)
    coded = map_batches(
        cut, _encoder(vocab, pattern, "piece", ["doc_id", "mark", "copies", "no"]),
        "doc_id long, mark string, copies long, no int, ids array<int>",
    )
    joined = coded.groupBy("doc_id", "mark", "copies").agg(
        F.sort_array(F.collect_list(F.struct("no", "ids"))).alias("p")
    ).select(
        "doc_id", F.flatten(F.col("p.ids")).alias("ids"),
        F.explode(F.array_repeat(F.lit(1), F.col("copies").cast("int"))).alias("copy"),
    )
    return short.unionByName(joined.drop("copy"))


def decode(coded: DataFrame, vocab: str) -> DataFrame:
    """Adds ``bytes``: the tokens' raw bytes, concatenated. A null list decodes to no bytes."""
    keep = [c for c in coded.columns if c != "bytes"]
    schema = coded.select(*keep).schema.add("bytes", "binary")

    def run(batches: Batches) -> Batches:
        of = token_bytes(vocab).__getitem__
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                raw = [b"".join(map(of, x or ())) for x in part.column("ids").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(raw, pa.binary())],
                    names=[*part.schema.names, "bytes"],
                )

    return map_batches(coded.select(*keep), run, schema)


def digests(coded: DataFrame) -> DataFrame:
    """Counts and digests of encoded and decoded documents."""
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )
