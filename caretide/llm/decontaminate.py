"""Benchmark decontamination as a prefix-filtered set join.

A window is ``size`` consecutive words of a benchmark item (or the whole item, if it
has fewer). A document contains a window only if it has all of the window's words,
so one necessary prefix token decides whether a pair is a candidate: the window's
word that fewest documents hold, whose place in the window and the window's length
are known. A document's words look up these tokens; a candidate's place follows from
the token's place (positional bound) and must leave room for the whole window (length
bound). What then passes a filter of whole windows is joined with the windows by all
its words, which verifies it.

The documents are read three times, however many items there are: to count the
benchmark's words, to find candidates, and to give them their hits. Neither windows
nor counts visit the driver. Documents meet words and tokens in filters of a fixed
number of bits; what these let through by mistake finds no partner in the joins. Only
candidates are shuffled, those of equal texts once, and the windows stand in the join
``SALTS`` times, so that a frequent one is spread over as many tasks.

Words: A-Z lower-cased, then runs of digits, a-z and characters beyond ASCII.

Cases: a null or empty text has no words, an item without words no window; equal
items are all named; rows without an ``item_id`` take no part; equally rare words of
a window are taken by name, then by place; repeated documents give repeated rows; a
very long text is one row like any other; an empty table gives no rows, and without
any benchmark item nothing is contaminated. Other columns are dropped, but for those
to be kept; one of these named ``n_words``, ``hits``, ``doc_id`` or ``text`` gives way.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F, types as T

from caretide.llm.common import Batches, map_batches, texts
from caretide.session import materialize, ship

WINDOW = 10
#: Bits of a filter, 8 MB in each task that uses it.
BITS = 1 << 26
#: Tasks over which the candidates of one window are spread.
SALTS = 16
#: Words a task remembers, or counts, before it starts anew.
REMEMBERED = 300_000

_WORD = [c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)]
_TABLE = bytes(_WORD[c + 32 if 0x41 <= c <= 0x5A else c] for c in range(256))
HITS = T.ArrayType(T.StructType([
    T.StructField("start", T.IntegerType()), T.StructField("stop", T.IntegerType()),
    T.StructField("item_id", T.StringType()),
]))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


@F.arrow_udf(T.LongType())
def _number_of_words(column: pa.Array) -> pa.Array:
    return pa.array([len(words(text.as_py())) for text in column], pa.int64())


def windows(items: DataFrame, size: int = WINDOW) -> DataFrame:
    """``window`` (words joined by spaces) and ``item_id``, each pair once."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for item_id, text in zip(batch.column("item_id").to_pylist(), batch.column("text")):
                found = words(text.as_py())
                made = {
                    b" ".join(found[i:i + size]) for i in range(max(1, len(found) - size + 1))
                } if found else set()
                yield pa.RecordBatch.from_pydict({
                    "window": pa.array([m.decode() for m in made], pa.string()),
                    "item_id": pa.array([item_id] * len(made), pa.string()),
                })

    rows = items.where(F.col("item_id").isNotNull()).select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    )
    return map_batches(rows, run, "window string, item_id string").distinct()


def _shaped(word: bytes, place: int, length: int) -> bytes:
    """What a filter holds of a token at a place of a window (words have no spaces)."""
    return b"%d %d %s" % (place, length, word)


class Filter:
    """A set of byte strings in a fixed number of bits; tells some strangers for members."""

    def __init__(self, bits: int, slots: np.ndarray, masks: np.ndarray):
        self.bits, self.slots, self.masks = bits, slots, masks

    @staticmethod
    def places(key: bytes, bits: int) -> tuple[int, int]:
        digest = xxhash.xxh3_64_intdigest(key)
        return (digest & 0xFFFFFFFF) % bits, (digest >> 32) % bits

    @classmethod
    def of(cls, entries: DataFrame, bits: int) -> Filter:
        """From ``word``; if ``window`` is there, also from the word's place in it and from itself.

        Bits are gathered by Spark; at most one row per 64 of them reaches the driver.
        """
        shaped = "window" in entries.columns

        def run(batches: Batches) -> Batches:
            for batch in batches:
                keys = [w.encode() for w in batch.column("word").to_pylist()]
                if shaped:
                    at = zip(batch.column("place").to_pylist(), batch.column("length").to_pylist())
                    keys += [_shaped(w, p, n) for w, (p, n) in zip(keys, at)]
                    keys += [w.encode() for w in batch.column("window").to_pylist()]
                set_bits = np.array([b for k in keys for b in cls.places(k, bits)], np.uint64)
                masks = (np.uint64(1) << (set_bits & np.uint64(63))).view(np.int64)
                yield pa.RecordBatch.from_pydict({
                    "slot": pa.array((set_bits >> np.uint64(6)).astype(np.int64)),
                    "mask": pa.array(masks),
                })

        gathered = map_batches(entries, run, "slot long, mask long").groupBy("slot").agg(
            F.bit_or("mask").alias("mask")).toArrow()
        return cls(bits, gathered["slot"].to_numpy(), gathered["mask"].to_numpy())

    def opened(self):
        """A test of membership."""
        table = np.zeros(self.bits // 64 + 1, "<i8")
        table[self.slots] = self.masks
        held, bits, digest = table.tobytes(), self.bits, xxhash.xxh3_64_intdigest

        def holds(key: bytes) -> bool:
            # spelled out, as it runs for every word a task has not seen before
            mark = digest(key)
            bit = (mark & 0xFFFFFFFF) % bits
            if not held[bit >> 3] >> (bit & 7) & 1:
                return False
            bit = (mark >> 32) % bits
            return bool(held[bit >> 3] >> (bit & 7) & 1)

        return holds


def _document_counts(docs: DataFrame, vocabulary: Filter) -> DataFrame:
    """How many documents hold each word that passes the filter: ``word`` and ``n``."""
    shared = ship(docs.sparkSession, vocabulary)

    def run(batches: Batches) -> Batches:
        holds, checked, known, seen = shared().opened(), set(), set(), Counter()

        def counted() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({
                "word": pa.array([w.decode() for w in seen], pa.string()),
                "n": pa.array(list(seen.values()), pa.int64()),
            })

        for batch in batches:
            for text in batch.column("text"):
                found = set(words(text.as_py()))
                new = found - checked
                checked |= new
                known.update(w for w in new if holds(w))
                seen.update(known & found)
                if len(checked) > REMEMBERED:
                    checked, known = set(), set()
                if len(seen) > REMEMBERED:
                    yield counted()
                    seen.clear()
        yield counted()

    return map_batches(docs.select("text"), run, "word string, n long").groupBy("word").agg(
        F.sum("n").alias("n"))


def _prefix_tokens(pairs: DataFrame, docs: DataFrame, bits: int) -> DataFrame:
    """Per ``window`` that may occur: its rarest ``word``, that word's ``place``, its ``length``."""
    parts = pairs.select("window").distinct().select(
        "window", F.posexplode(F.split("window", " ")).alias("place", "word"))
    vocabulary = Filter.of(parts.select("word").distinct(), bits)
    counted = parts.join(_document_counts(docs, vocabulary), "word", "left")
    rarest = F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "word", "place")).alias("t")
    tokens = counted.groupBy("window").agg(rarest, F.count(F.lit(1)).cast("int").alias("length"))
    return tokens.where(F.col("t.n") > 0).select("window", "t.word", "t.place", "length")


def _candidates(docs: DataFrame, mark: str, tokens: Filter, lengths: Iterable[int]) -> DataFrame:
    """Stretches in which a prefix token stands at its place and that pass the filter as a whole."""
    shared = ship(docs.sparkSession, tokens)
    shapes = [(place, length) for length in lengths for place in range(length)]

    def run(batches: Batches) -> Batches:
        holds, checked, known = shared().opened(), set(), {}
        for batch in batches:
            marks, starts, stops, held = [], [], [], []
            for key, text in zip(batch.column(mark), batch.column("text")):
                found = words(text.as_py())
                new = set(found) - checked
                checked |= new
                for w in new:
                    if holds(w):
                        at = [s for s in shapes if holds(_shaped(w, *s))]
                        if at:
                            known[w] = at
                made = {
                    (i - place, i - place + length)
                    for i, w in enumerate(found) if w in known for place, length in known[w]
                    if place <= i <= len(found) - length + place
                } if not known.keys().isdisjoint(found) else ()
                for start, stop in made:
                    window = b" ".join(found[start:stop])
                    if holds(window):
                        marks.append(key.as_py())
                        starts.append(start)
                        stops.append(stop)
                        held.append(window.decode())
                if len(checked) > REMEMBERED:
                    checked, known = set(), {}
            yield pa.RecordBatch.from_pydict({
                "mark": pa.array(marks, pa.binary()), "start": pa.array(starts, pa.int32()),
                "stop": pa.array(stops, pa.int32()), "window": pa.array(held, pa.string()),
            })

    schema = "mark binary, start int, stop int, window string"
    return map_batches(docs.select(mark, "text"), run, schema)


def _marked(docs: DataFrame, *keep: str) -> tuple[DataFrame, str]:
    """The rows with the digest of their text, in a column of a name that is not kept."""
    mark = "mark"
    while mark in keep:
        mark += "_"
    source = texts(docs, *keep, own=("n_words", "hits"))
    return source.withColumn(mark, F.unhex(F.sha2("text", 256))), mark


def _hits(marked: DataFrame, mark: str, items: DataFrame, size: int, bits: int) -> DataFrame:
    """All occurrences: ``mark`` of the text, ``start``, ``stop`` and ``item_id``, each once."""
    pairs = materialize(windows(items, size), "windows")
    tokens = materialize(_prefix_tokens(pairs, marked, bits), "prefix-tokens")
    lengths = sorted(r["length"] for r in tokens.select("length").distinct().collect())  # <= size
    entries = Filter.of(tokens, bits)
    # copies of a text have the same candidates: they go on once
    salt = F.pmod(F.xxhash64("mark", "start"), F.lit(SALTS)).cast("int")
    candidates = _candidates(marked, mark, entries, lengths).distinct().withColumn("salt", salt)
    salted = pairs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return candidates.join(salted, ["window", "salt"]).select(
        F.col("mark").alias(mark), "start", "stop", "item_id")


def find(
    docs: DataFrame, items: DataFrame, *keep: str, size: int = WINDOW, bits: int = BITS,
) -> DataFrame:
    """``doc_id``, ``text``, ``keep``, ``n_words`` and ``hits``: all occurrences of windows.

    ``bits`` is the size of the filters; it changes what is shuffled, not what is found.
    If the hits are too many to be broadcast, the columns that are read of the result
    are shuffled once with the documents.
    """
    marked, mark = _marked(docs, *keep)
    hit = F.sort_array(F.collect_list(F.struct("start", "stop", "item_id"))).alias("hits")
    # written first, so that their size is known when the join with the documents is planned
    hits = materialize(_hits(marked, mark, items, size, bits).groupBy(mark).agg(hit), "hits")
    return marked.withColumn("n_words", _number_of_words("text")).join(hits, mark, "left").drop(mark).withColumn(
        "hits", F.coalesce("hits", F.array().cast(HITS)))


def uncontaminated(
    docs: DataFrame, items: DataFrame, *keep: str, size: int = WINDOW, bits: int = BITS,
) -> DataFrame:
    """``doc_id``, ``text`` and ``keep`` of the rows whose text holds no window."""
    marked, mark = _marked(docs, *keep)
    marks = materialize(_hits(marked, mark, items, size, bits).select(mark).distinct(), "marks")
    return marked.join(marks, mark, "left_anti").drop(mark)


def report(found: DataFrame) -> DataFrame:
    """Per document: words, words hit, items hit, and whether any word is hit."""
    # hits are in the order of their starts: what one adds begins where those before it end
    zero = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
    covered = F.aggregate("hits", zero, lambda seen, hit: F.struct(
        F.greatest(seen["end"], hit["stop"]).alias("end"),
        (seen["n"] + F.greatest(F.lit(0), hit["stop"] - F.greatest(seen["end"], hit["start"]))
         ).alias("n")))
    return found.select(
        "doc_id", "n_words", covered["n"].cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.col("hits.item_id"))).alias("items"),
    ).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )
