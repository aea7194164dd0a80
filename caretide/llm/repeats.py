"""Finding repeated windows of units (words or bytes) without sorting every window.

Of each window's ``k``-grams the one with the smallest hash is the window's anchor.
Equal windows have the same anchor at the same place, so only windows with a common
anchor need comparing. Neighbouring windows mostly share their anchor; together
they are a segment, and one row per segment (about two for every ``width - k``
units) stands for all its windows.

``segment_rows`` deals these rows by their anchor's hash, packed into arrays. What is
equal as a whole is settled on the way, first within a task and then within a
bucket, so that copies, however many, never meet as rows. What is left are
segments of one anchor that differ; they are compared window by window, by each
operator in its own way, from their content (``contents``).

Hashes are 64-bit polynomials over bytes, mixed; segments count as equal if both
their anchors' and their own hashes are.

A text is known by its id and a mark of 96 bits, two hashes of the text, that tells apart
rows of one id or without id. Equal rows have equal marks and are treated alike.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from caretide.llm.common import Batches, map_batches, parts_for

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
#: Units hashed at once; a longer text is hashed in overlapping stretches.
STRETCH = 1 << 20
#: Bytes of text laid end to end before hashing.
GROUP_BYTES = 1 << 20
#: Segments a task gathers before it settles copies and passes on the rest.
GATHER = 600_000
#: A null id, which comes after all others.
NO_ID = (1 << 63) - 1
#: Differing segments of one anchor beyond which windows are compared by Spark instead.
HOT = 50_000
#: Rows of one anchor, as estimated from every SAMPLE-th text, beyond which they are
#: dealt by their segments. This only steers: any choice gives the same result.
CROWD = 2_000_000
SAMPLE = 1_024
SMALLER, ANYWHERE = "smaller", "anywhere"

#: What a text is known by.
KEY = ("id", "mark", "more")
SPANS = "id long, mark long, more int, start long, units long, anchor long, test boolean, hot boolean"
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base^0, base^1, ... modulo 2^64."""
    if base not in _powers or len(_powers[base]) < n:
        out = np.empty(max(n + n // 4, 1 << 10), np.uint64)
        out[0] = 1
        done = 1
        while done < len(out):
            more = min(done, len(out) - done)
            out[done:done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
            done += more
        _powers[base] = out
    return _powers[base][:n]


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


class Hasher:
    """Hashes of any stretches of an array of bytes."""

    def __init__(self, data: np.ndarray):
        n = len(data)
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _power(BASE, n), out=self.sums[1:])
        self.undo = _power(INVERSE, n + 1)

    def __call__(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        return mixed((self.sums[stop] - self.sums[start]) * self.undo[start])


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` values the place of the lowest, the first on ties.

    Minima from both ends of blocks of ``width``; the place within the block is kept
    in the lowest ten bits.
    """
    if not 0 < width <= 1024:
        raise ValueError("at most 1024 places in a window")
    n = len(values)
    blocks = -(-n // width)
    keys = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    low = np.uint64(1023)
    keys[:n] = (values & ~low) | (np.arange(n, dtype=np.uint64) % np.uint64(width))
    table = keys.reshape(blocks, width)
    head = np.minimum.accumulate(table, axis=1).ravel()
    tail = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    first = np.arange(n - width + 1)
    a, b = tail[first], head[first + width - 1]
    left = (a >> np.uint64(10)) <= (b >> np.uint64(10))
    block = np.where(left, first, first + width - 1) // width
    return block * width + (np.where(left, a, b) & low).astype(np.int64)


class Units:
    """Texts laid end to end as units: bytes, where each unit lies, whose it is.

    ``first`` holds the number of each text's first unit and of all units.
    """

    def __init__(self, data, start, stop, first: np.ndarray):
        self.data, self.start, self.stop, self.first = data, start, stop, first

    def __len__(self) -> int:
        return int(self.first[-1])

    def owners(self, low: int, high: int) -> np.ndarray:
        """The texts that the units from ``low`` to ``high`` belong to."""
        if low >= high:
            return np.zeros(0, np.int64)
        own = np.searchsorted(self.first, [low, high - 1], side="right") - 1
        ends = np.clip(self.first[own[0]:own[1] + 2], low, high)
        return np.repeat(np.arange(own[0], own[1] + 1), np.diff(ends))


class _Places:
    """The numbers from ``shift`` on, made only where they are looked at."""

    def __init__(self, shift: int):
        self.shift = shift

    def __getitem__(self, at):
        if isinstance(at, slice):
            return np.arange(at.start + self.shift, at.stop + self.shift)
        return at + self.shift


def byte_units(texts: list[bytes]) -> Units:
    data = np.frombuffer(b"".join(texts), np.uint8)
    first = np.cumsum([0, *(len(t) for t in texts)])
    return Units(data, _Places(0), _Places(1), first)


_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_units(texts: list[bytes]) -> Units:
    """Words as runs of other than white space, joined by single spaces."""
    raw = np.frombuffer(b"\n".join([*texts, b""]), np.uint8)
    space = _SPACE[raw]
    edge = np.diff(space.astype(np.int8), prepend=1, append=1)
    begin, end = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
    kept = ~space
    kept[end[end < len(raw)]] = True  # one separator behind each word
    data = np.where(space, np.uint8(0x20), raw)[kept]
    size = end - begin
    stop = np.cumsum(size + 1) - 1
    bounds = np.cumsum([len(t) + 1 for t in texts])
    first = np.append(0, np.searchsorted(begin, bounds))
    return Units(data, stop - size, stop, first)


def segments(units: Units, width: int, k: int) -> Iterator[tuple[np.ndarray, ...]]:
    """Arrays of anchor, segment hash, first window's unit, windows, by stretch."""
    total = len(units)
    for at in range(0, max(0, total - width + 1), STRETCH):
        last = min(at + STRETCH, total - width + 1)  # windows start in [at, last)
        upto = last + width - 1
        base = int(units.start[at])
        start, stop = units.start[at:upto] - base, units.stop[at:upto] - base
        hashed = Hasher(units.data[base:base + int(stop[-1])])
        grams = hashed(start[:len(start) - k + 1], stop[k - 1:])
        place = lowest(grams, width - k + 1)
        owner = units.owners(at, upto)
        fine = np.flatnonzero(owner[:last - at] == owner[width - 1:])
        if not len(fine):
            continue
        new = np.ones(len(fine), bool)
        new[1:] = (np.diff(fine) != 1) | (np.diff(place[fine]) != 0)
        new[1:] |= owner[fine[1:]] != owner[fine[:-1]]
        opens = np.flatnonzero(new)
        closes = np.append(opens[1:], len(fine)) - 1
        low, high = fine[opens], fine[closes]
        yield (grams[place[low]], hashed(start[low], stop[high + width - 1]),
               low + at, high - low + 1)


_FIELDS = (
    ("anchor", np.uint64), ("seg", np.uint64), ("id", np.int64), ("mark", np.int64),
    ("more", np.int32), ("start", np.int64), ("windows", np.int64), ("many", np.bool_),
)


def _slim(array: np.ndarray) -> np.ndarray:
    """The narrowest unsigned type that holds an array of offsets."""
    top = int(array.max()) if len(array) else 0
    kind = next(t for t in (np.uint8, np.uint16, np.uint32, np.uint64) if top <= np.iinfo(t).max)
    return array.astype(kind)


def _pack(rows: dict[str, np.ndarray]) -> dict[str, bytes | int | str]:
    """One row of packed arrays; ids as offsets from the smallest."""
    low = int(rows["id"].min())
    offset = rows["id"].astype(np.uint64) - np.uint64(low % (1 << 64))
    arrays = {
        "anchor": rows["anchor"], "seg": rows["seg"], "id": _slim(offset), "mark": rows["mark"],
        "more": rows["more"], "start": _slim(rows["start"]), "windows": _slim(rows["windows"]),
        "many": np.packbits(rows["many"]),
    }
    kinds = "".join(f"{a.dtype.char}" for a in arrays.values())
    return {"low": low, "n": len(rows["id"]), "kinds": kinds,
            "packed": b"".join(a.tobytes() for a in arrays.values())}


def _unpack(low: int, n: int, kinds: str, packed: bytes) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for (name, kind), code in zip(_FIELDS, kinds):
        count = -(-n // 8) if name == "many" else n
        array = np.frombuffer(packed, np.dtype(code), count, at)
        at += array.nbytes
        out[name] = np.unpackbits(array, count=n).astype(bool) if name == "many" else (
            array.astype(kind, copy=False))
    out["id"] = (out["id"].astype(np.uint64) + np.uint64(low % (1 << 64))).view(np.int64)
    return out


def _in_order(rows: dict[str, np.ndarray]) -> tuple[dict, np.ndarray, np.ndarray]:
    """Rows by anchor, segment, id; the number of each row's segment class and anchor."""
    order = np.lexsort((rows["id"], rows["seg"], rows["anchor"]))
    rows = {c: a[order] for c, a in rows.items()}
    anchor = np.concatenate([[0], np.cumsum(np.diff(rows["anchor"]) != 0)])
    split = (np.diff(rows["anchor"]) != 0) | (np.diff(rows["seg"]) != 0)
    return rows, np.concatenate([[0], np.cumsum(split)]), anchor


def _settle(rows: dict, cls: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Rows whose whole segment is a repeat, and rows that go on, by the rule.

    smaller: a segment is a repeat if a smaller id has an equal one; those of the
    smallest id go on. anywhere: it is one if any other is equal; one goes on.
    """
    first = np.flatnonzero(np.concatenate([[True], np.diff(cls) != 0]))
    if rule == SMALLER:
        smallest = rows["id"][first][cls]
        return rows["id"] > smallest, rows["id"] == smallest
    seen = np.bincount(cls) + np.bincount(cls, weights=rows["many"]).astype(np.int64)
    several = (seen > 1)[cls]
    rows["many"] = rows["many"] | several
    on = np.zeros(len(cls), bool)
    on[first] = True
    return several, on


def _merged(rows: dict[str, np.ndarray], width: int) -> dict[str, np.ndarray]:
    """Overlapping or adjoining stretches of one text as one row."""
    order = np.lexsort((rows["start"], rows["more"], rows["mark"], rows["id"]))
    ids, mark, more = (rows[c][order] for c in KEY)
    start = rows["start"][order]
    stop = start + rows["windows"][order] + width - 1
    split = (np.diff(ids) != 0) | (np.diff(mark) != 0) | (np.diff(more) != 0)
    text = np.concatenate([[0], np.cumsum(split)])
    # the furthest end so far within each text
    far = int(stop.max()) + 1 if len(stop) else 1
    reach = np.maximum.accumulate(stop + text * far) - text * far
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(text) != 0) | (start[1:] > reach[:-1])
    opens = np.flatnonzero(new)
    closes = np.append(opens[1:], len(ids)) - 1
    return {"id": ids[opens], "mark": mark[opens], "more": more[opens], "start": start[opens],
            "units": reach[closes] - start[opens]}


_PACKED = "bucket int, low long, n int, kinds string, packed binary"


def _anchors(lay: Callable, width: int, k: int):
    """Texts in, the anchor of each segment out."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for units, _ in _laid(batch, lay):
                for anchor, _, _, _ in segments(units, width, k):
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(anchor.view(np.int64))], names=["anchor"])

    return run


def _gather(lay: Callable, width: int, k: int, rule: str, buckets: int, crowded: np.ndarray):
    """Texts in, packed segments by bucket out; settled stretches have no anchor."""

    def run(batches: Batches) -> Batches:
        held: list[dict[str, np.ndarray]] = []

        def flush() -> pa.RecordBatch:
            rows = {c: np.concatenate([h[c] for h in held]) for c, _ in _FIELDS}
            held.clear()
            rows, cls, _ = _in_order(rows)
            repeat, on = _settle(rows, cls, rule)
            out = []
            if repeat.any():
                done = _merged({c: a[repeat] for c, a in rows.items()}, width)
                zero = np.zeros(len(done["id"]), np.uint64)
                done |= {"anchor": zero, "seg": zero, "windows": done.pop("units"),
                         "many": zero.astype(bool)}
                bucket = mixed(done["id"].view(np.uint64)) % np.uint64(buckets)
                out += [(-1 - b, part) for b, part in _by(bucket, done)]
            going = {c: a[on] for c, a in rows.items()}
            # an anchor is the lowest of many hashes, so it is mixed once more
            bucket = mixed(going["anchor"])
            apart = np.isin(going["anchor"], crowded)
            bucket[apart] = mixed(bucket[apart] ^ going["seg"][apart])
            bucket %= np.uint64(buckets)
            out += list(_by(bucket, going))
            packed = [{"bucket": b, **_pack(part)} for b, part in out]
            return pa.RecordBatch.from_pylist(packed, pa.schema([
                ("bucket", pa.int32()), ("low", pa.int64()), ("n", pa.int32()),
                ("kinds", pa.string()), ("packed", pa.binary())]))

        size = 0
        for batch in batches:
            keys = {c: batch.column(c).to_numpy() for c in KEY}
            for units, rows in _laid(batch, lay):
                for anchor, seg, low, windows in segments(units, width, k):
                    own = np.searchsorted(units.first, low, side="right") - 1
                    held.append({
                        "anchor": anchor, "seg": seg,
                        **{c: array[rows][own] for c, array in keys.items()}, "start": low - units.first[own],
                        "windows": windows, "many": np.zeros(len(low), bool),
                    })
                    size += len(low)
                if size >= GATHER:
                    yield flush()
                    size = 0
        if size:
            yield flush()

    return run


def _by(bucket: np.ndarray, rows: dict[str, np.ndarray]):
    order = np.argsort(bucket, kind="stable")
    cuts = np.flatnonzero(np.diff(bucket[order])) + 1
    for part in np.split(order, cuts):
        if len(part):
            yield int(bucket[part[0]]), {c: a[part] for c, a in rows.items()}


def _laid(batch: pa.RecordBatch, lay: Callable):
    """Groups of whole texts of about GROUP_BYTES as units, with their rows in the batch."""
    column = batch.column("text")
    group, size, first = [], 0, 0
    for n, cell in enumerate(column):
        group.append((cell.as_py() or "").encode())
        size += len(group[-1])
        if size >= GROUP_BYTES or n == len(column) - 1:
            yield lay(group), slice(first, n + 1)
            group, size, first = [], 0, n + 1


def _differing(width: int, rule: str, hot: int, crowded: np.ndarray):
    """A bucket's packed rows in; settled stretches and differing segments out.

    Segments of a crowded anchor lie in many buckets. Equal ones are settled all the
    same; one of each goes on to be compared window by window.
    """

    def settled(rows: dict[str, np.ndarray]) -> pa.RecordBatch:
        n = len(rows["id"])
        return _spans(rows, slice(None), rows["units"],
                      pa.nulls(n, pa.int64()), np.zeros(n, bool), np.zeros(n, bool))

    def bucket(held: list[dict]) -> Iterator[pa.RecordBatch]:
        rows = {c: np.concatenate([h[c] for h in held]) for c, _ in _FIELDS}
        rows, cls, anchor = _in_order(rows)
        already = rows["many"].copy()
        repeat, on = _settle(rows, cls, rule)
        if rule == ANYWHERE:
            repeat &= ~already  # else settled in its task
        if repeat.any():
            yield settled(_merged({c: a[repeat] for c, a in rows.items()}, width))
        first = np.concatenate([[True], np.diff(cls) != 0])
        classes = np.bincount(anchor[first])[anchor]
        apart = np.isin(rows["anchor"], crowded)
        if rule == SMALLER:
            smallest = np.full(anchor[-1] + 1, NO_ID)
            np.minimum.at(smallest, anchor, rows["id"])
            test = on & (apart | (rows["id"] > smallest[anchor]))
        else:
            test = on & ~rows["many"]
        tested = np.bincount(anchor, weights=test)[anchor] > 0
        going = (test | (on & first)) & (apart | ((classes > 1) & tested))
        if going.any():
            yield _spans(
                rows, going, rows["windows"][going] + width - 1,
                pa.array(rows["anchor"][going].view(np.int64)), test[going],
                (apart | (classes > hot))[going])

    def run(batches: Batches) -> Batches:
        now, held = None, []
        for batch in batches:
            for row in batch.to_pylist():
                rows = _unpack(row["low"], row["n"], row["kinds"], row["packed"])
                if row["bucket"] < 0:
                    rows["units"] = rows["windows"]
                    yield settled(rows)
                    continue
                if row["bucket"] != now and held:
                    yield from bucket(held)
                    held = []
                now = row["bucket"]
                held.append(rows)
        if held:
            yield from bucket(held)

    return run


def _spans(rows: dict, chosen, units, anchor, test, hot) -> pa.RecordBatch:
    kinds = {"mark": pa.int64(), "more": pa.int32()}
    fields = {c: pa.array(rows[c][chosen], kinds.get(c, pa.int64())) for c in (*KEY, "start")}
    return pa.RecordBatch.from_pydict({
        **fields, "units": pa.array(units, pa.int64()), "anchor": anchor,
        "test": pa.array(test), "hot": pa.array(hot)})


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and the key of a text: its id and the mark that tells apart rows."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"),
    ).withColumns({
        "id": F.coalesce("doc_id", F.lit(NO_ID)), "mark": F.xxhash64("text"),
        "more": F.hash("text"),
    })


def segment_rows(
    source: DataFrame, lay: Callable, width: int, k: int, rule: str, hot: int = HOT,
    crowd: int = CROWD, sample: int = SAMPLE,
) -> DataFrame:
    """Stretches known to be repeats (``anchor`` null) and segments still to be compared.

    Columns as in SPANS: ``units`` from ``start`` on; ``test`` marks segments to be
    judged, others are there to be compared with; ``hot`` those whose anchor has
    more than ``hot`` different segments, or is crowded.
    """
    parts = parts_for(source)
    buckets = 4 * parts
    some = source.where(F.pmod(F.xxhash64(*KEY), F.lit(sample)) == 0)
    often = map_batches(some.select("text"), _anchors(lay, width, k), "anchor long").groupBy(
        "anchor").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") * sample > crowd)
    # their number is bounded by all rows divided by ``crowd``
    crowded = np.array([r["anchor"] for r in often.collect()], np.int64).view(np.uint64)
    packed = map_batches(
        source.select(*KEY, "text"), _gather(lay, width, k, rule, buckets, crowded),
        _PACKED)
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return map_batches(dealt, _differing(width, rule, hot, crowded), SPANS)


def contents(source: DataFrame, spans: DataFrame, lay: Callable) -> DataFrame:
    """The bytes of segments: ``anchor``, KEY, ``start, test, content``."""
    wanted = spans.groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "units", "anchor", "test")).alias("segments"))
    # the same columns and kind of join as in stretches(), so that one shuffle of the
    # texts serves both
    joined = source.join(wanted, list(KEY), "left")

    def run(batches: Batches) -> Batches:
        for batch in batches:
            keys = zip(*[batch.column(c).to_pylist() for c in KEY])
            for (own, mark, more), text, cell in zip(keys, batch.column("text"), batch.column("segments")):
                asked = cell.as_py()
                units = lay([(text.as_py() or "").encode()])
                raw = units.data.tobytes()
                low = [int(units.start[s["start"]]) for s in asked]
                high = [int(units.stop[s["start"] + s["units"] - 1]) for s in asked]
                n = len(asked)
                yield pa.RecordBatch.from_pydict({
                    "anchor": pa.array([s["anchor"] for s in asked], pa.int64()),
                    "id": pa.array([own] * n, pa.int64()), "mark": pa.array([mark] * n, pa.int64()),
                    "more": pa.array([more] * n, pa.int32()),
                    "start": pa.array([s["start"] for s in asked], pa.int64()),
                    "test": pa.array([s["test"] for s in asked], pa.bool_()),
                    "content": pa.array([raw[a:b] for a, b in zip(low, high)], pa.binary()),
                })

    return map_batches(
        joined.where(F.col("segments").isNotNull()), run,
        "anchor long, id long, mark long, more int, start long, test boolean, content binary")


def by_window(segments_: DataFrame, lay: Callable, width: int, rule: str) -> DataFrame:
    """Repeated windows of hot anchors, by grouping the windows' 128-bit hashes.

    No task holds an anchor's segments: windows are counted with partial sums and
    joined back on their hashes.
    """

    def run(batches: Batches) -> Batches:
        for batch in batches:
            for row in batch.select([*KEY, "start", "test", "content"]).to_pylist():
                units = lay([row["content"]])
                count = len(units) - width + 1
                hashed, again = Hasher(units.data), Hasher(units.data ^ np.uint8(0x5A))
                ends = units.start[0:count], units.stop[width - 1:len(units)]
                yield pa.RecordBatch.from_pydict({
                    "a": pa.array(hashed(*ends).view(np.int64)),
                    "b": pa.array(again(*ends).view(np.int64)),
                    "id": pa.array([row["id"]] * count, pa.int64()),
                    "mark": pa.array([row["mark"]] * count, pa.int64()),
                    "more": pa.array([row["more"]] * count, pa.int32()),
                    "start": pa.array(row["start"] + np.arange(count), pa.int64()),
                    "test": pa.array([row["test"]] * count, pa.bool_()),
                })

    windows = map_batches(
        segments_, run, "a long, b long, id long, mark long, more int, start long, test boolean")
    seen = windows.groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("smallest"))
    repeat = F.col("id") > F.col("smallest") if rule == SMALLER else F.col("n") > 1
    return windows.where("test").join(seen, ["a", "b"]).where(repeat).select(
        *KEY, "start", F.lit(width).cast("long").alias("units"))


def stretches(source: DataFrame, found: DataFrame) -> DataFrame:
    """``doc_id``, ``text`` and ``found``: an array of (start, units), null if there is none."""
    listed = found.groupBy(*KEY).agg(
        F.collect_list(F.struct("start", "units")).alias("found"))
    return source.join(listed, list(KEY), "left").select("doc_id", "text", "found")


def covered(total: int, found: list[dict] | None) -> np.ndarray:
    """Which of ``total`` units lie in a found stretch."""
    if not found:
        return np.zeros(total, bool)
    start = np.array([f["start"] for f in found])
    step = np.zeros(total + 1, np.int64)
    np.add.at(step, start, 1)
    np.add.at(step, start + np.array([f["units"] for f in found]), -1)
    return np.cumsum(step[:-1]) > 0
