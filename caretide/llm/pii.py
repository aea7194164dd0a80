"""Personal data by weak supervision.

Fixed patterns give the base spans, which always stay. Looser patterns give further
candidates. Regex, gazetteer and context labelers vote on every candidate (the base
spans among them): for, against, or not at all. Expectation-maximisation estimates,
for each kind, how often a labeler votes which way on true and on false spans, from
the counts of vote patterns over all documents. The resulting probabilities train
the final span classifier, a logistic regression on votes and shape, and further
candidates that it accepts and that overlap no base span are added.

Vote patterns are counted by Spark; what reaches the driver is one row per pattern,
whose number the labelers fix, not the documents.

Cases: a null or empty text has no spans; offsets are code points, the end
exclusive; spans of different kinds may overlap; of accepted candidates that
overlap, the first stays; repeated rows give repeated rows; a very long text is one
row and read whole; without candidates nothing is added; an empty table gives no rows.
Other columns are dropped, but for those to be kept; one of these named ``base``,
``spans``, ``doc_id`` or ``text`` gives way.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from caretide.llm.common import Batches, map_batches, texts

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# The base patterns (the parts of the e-mail pattern around its @).
LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
# no match can start within a run of digits where none starts at its first digit
IP_BASE = re.compile(r"(?<![0-9])[0-9]++(\.[0-9]++)(\.[0-9]++)(\.[0-9]++)")
CARD_BASE = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE_BASE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")

#: Stretches that hold every match of a pattern that starts with a digit.
ZONE = re.compile(r"[0-9][\x20().0-9-]*")
LOOSE_PHONE = re.compile(
    r"(?<![0-9+.-])(?:\([0-9]{3}\)\x20?|[0-9]{3}[\x20.-])[0-9]{3}[\x20.-][0-9]{4}(?![0-9])")
LOOSE_CARD = re.compile(r"(?<![0-9.])[0-9]{4}(?:([\x20.-])[0-9]{4})(?:\1[0-9]{4}){2}(?![0-9])")
_AT = r"\x20?(?:\(at\)|\[at\]|\x20at\x20)\x20?"
_DOT = r"\x20?(?:\(dot\)|\[dot\]|\x20dot\x20)\x20?"
_LABEL = r"[A-Za-z0-9-]{1,63}"  # a domain has 127 at most
LOOSE_EMAIL = re.compile(
    rf"([A-Za-z0-9._%+-]{{1,64}}{_AT}{_LABEL})(?:{_DOT}{_LABEL}){{0,125}}{_DOT}[A-Za-z]{{2,24}}",
    re.IGNORECASE)
SPELLED_AT = re.compile(_AT, re.IGNORECASE)
SPELLED_PART = re.compile(rf"{_DOT}({_LABEL})", re.IGNORECASE)
IPV6 = re.compile(
    r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")

# Gazetteers.
TOP_DOMAINS = set(
    "com org net edu gov mil int info biz io co de fr es it nl be at ch uk us ca au jp cn in "
    "br ru se no dk fi pl pt gr ie eu example test".split())
CALLING_CODES = set(
    "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 53 54 55 56 57 58 60 61 62 "
    "63 64 65 66 81 82 84 86 90 91 92 93 94 95 98 351 352 353 354 358 359 380 420 421".split())
ISSUERS = ("34", "37", "4", "51", "52", "53", "54", "55", "6011", "65", "35", "62")
# Words before a span that speak for it, and words that speak against any.
CUES = (
    "mail contact write reach correo courriel adresse".split(),
    "ip address host server login from".split(),
    "card visa credit debit payment tarjeta carte karte".split(),
    "phone call tel fax mobile telefon telefono ring".split(),
)
AGAINST = "version isbn order invoice serial model build release chapter section".split()
REACH = 32

SPANS = T.ArrayType(T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("start", T.IntegerType()),
    T.StructField("stop", T.IntegerType()),
]))

LABELERS = 5
VOTES = (-1, 0, 1)


def _luhn(digits: str) -> bool:
    total = 0
    for n, c in enumerate(reversed(digits)):
        d = int(c) * (1 + n % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(span: str) -> str:
    return "".join(c for c in span if "0" <= c <= "9")


def base_emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of LOCAL @ DOMAIN, found from each @ so that long runs cost once."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and LOCAL.match(text[start - 1]):
            start -= 1
        end = DOMAIN.match(text, at + 1) if start < at else None
        if end:
            found.append((start, end.end()))
            done = end.end()
        else:
            done = max(done, at + 1)
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the base patterns, sorted."""
    found = [(a, EMAIL, b) for a, b in base_emails(text)] if "@" in text else []
    for zone in ZONE.finditer(text):
        if zone.end() - zone.start() < 7:
            continue
        for m in IP_BASE.finditer(text, *zone.span()):
            if all(len(p.lstrip("0")) < 4 and int(p[-4:]) <= 255 for p in m.group().split(".")):
                found.append((m.start(), IP, m.end()))
        for m in CARD_BASE.finditer(text, *zone.span()):
            if m.end() - m.start() >= 12:
                digits = _digits(m.group())
                if 12 <= len(digits) <= 19 and _luhn(digits):
                    found.append((m.start(), CARD, m.end()))
    if "+" in text:
        for m in PHONE_BASE.finditer(text):
            if 9 <= len(_digits(m.group())) <= 15:
                found.append((m.start(), PHONE, m.end()))
    return sorted(found)


def loose_emails(text: str) -> list[tuple[int, int]]:
    """Spelled-out addresses, up to the last known top domain, else to the last label.

    A label before a spelled-out @ begins the next address.
    """
    found, at = [], 0
    while m := LOOSE_EMAIL.search(text, at):
        ends = [(p.end(), p[1].lower()) for p in SPELLED_PART.finditer(text, m.end(1), m.end())
                if re.fullmatch("[A-Za-z]{2,24}", p[1])]
        ends = [e for e in ends if not SPELLED_AT.match(text, e[0])] or ends[:1]
        known = [e for e in ends if e[1] in TOP_DOMAINS]
        at = (known or ends or [(m.end(), "")])[-1][0]
        found.append((m.start(), at))
    return found


def loose_spans(text: str) -> list[tuple[int, int, int]]:
    """Further candidates, sorted."""
    found = []
    for zone in ZONE.finditer(text):
        if zone.end() - zone.start() >= 12:
            low = max(0, zone.start() - 1)  # an opening bracket may stand before
            found += [(m.start(), PHONE, m.end()) for m in LOOSE_PHONE.finditer(text, low, zone.end())]
            found += [(m.start(), CARD, m.end()) for m in LOOSE_CARD.finditer(text, *zone.span())]
    lower = text.lower()
    if "(dot)" in lower or "[dot]" in lower or " dot " in lower:
        found += [(a, EMAIL, b) for a, b in loose_emails(text)]
    if text.count(":") >= 7:
        found += [(m.start(), IP, m.end()) for m in IPV6.finditer(text)]
    return sorted(set(found))


def candidates(text: str) -> tuple[list, list]:
    """The base spans, and the further candidates that overlap none of them."""
    base = base_spans(text)
    loose = loose_spans(text)
    if not base or not loose:
        return base, loose
    starts = [a for a, _, _ in base]
    reach = list(accumulate((b for _, _, b in base), max))  # furthest end so far
    free = []
    for a, kind, b in loose:
        n = bisect_left(starts, b)  # base spans that start before this one's end
        if n == 0 or reach[n - 1] <= a:
            free.append((a, kind, b))
    return base, free


def votes(text: str, start: int, kind: int, end: int, is_base: bool) -> tuple[int, ...]:
    """Regex (strict form, usual shape), gazetteer, context, boundary."""
    span, digits = text[start:end], _digits(text[start:end])
    strict = 1 if is_base else 0
    if kind == EMAIL:
        last = re.split(r"[^A-Za-z]+", span)[-1].lower()
        shape = 1 if re.search(r"[A-Za-z]", span.split("@")[0]) else -1
        known = 1 if last in TOP_DOMAINS else -1
    elif kind == IP:
        parts = span.split(".")
        shape = 1 if len(parts) != 4 or all(p == "0" or p[0] != "0" for p in parts) else -1
        known = -1 if len(parts) == 4 and all(int(p[-4:]) < 10 for p in parts) else 1
    elif kind == CARD:
        shape = 1 if len(digits) in (15, 16) else -1
        known = 1 if digits.startswith(ISSUERS) and _luhn(digits) else -1
    else:
        shape = 1 if 10 <= len(digits) <= 13 else -1
        plus = span.startswith("+") and any(digits[:n] in CALLING_CODES for n in (1, 2, 3))
        known = 1 if plus else 0 if len(digits) == 10 and digits[0] not in "01" else -1
    before = text[max(0, start - REACH):start].lower()
    context = (1 if any(w in before for w in CUES[kind]) else 0) - any(w in before for w in AGAINST)
    near = text[max(0, start - 1):start] + text[end:end + 1]
    edge = -1 if any(c.isalnum() or c in "#_/=" for c in near) else 1
    return strict, shape, known, context, edge


def pattern(text: str, start: int, kind: int, end: int, is_base: bool) -> int:
    """Kind, length class and votes as one number: what the classifier sees of a span."""
    code = kind * 4 + min(3, (end - start) // 8)
    for vote in votes(text, start, kind, end, is_base):
        code = code * 3 + vote + 1
    return code


def _unpack(code: int) -> tuple[int, int, tuple[int, ...]]:
    cast = []
    for _ in range(LABELERS):
        code, v = divmod(code, 3)
        cast.append(v - 1)
    return code // 4, code % 4, tuple(reversed(cast))


def pattern_counts(docs: DataFrame) -> dict[int, int]:
    """How many candidates of all documents have each pattern."""

    def run(batches: Batches) -> Batches:
        seen: dict[int, int] = {}
        for batch in batches:
            for cell in batch.column("text"):
                if not (text := cell.as_py()):
                    continue
                for spans, is_base in zip(candidates(text), (True, False)):
                    for span in spans:
                        code = pattern(text, *span, is_base)
                        seen[code] = seen.get(code, 0) + 1
        yield pa.RecordBatch.from_pydict({
            "code": pa.array(list(seen), pa.int32()), "n": pa.array(list(seen.values()), pa.int64())
        })

    counts = map_batches(texts(docs).select("text"), run, "code int, n long")
    return {r["code"]: r["n"] for r in counts.groupBy("code").agg(F.sum("n").alias("n")).collect()}


def estimate(cast: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Expectation-maximisation over vote patterns: each pattern's probability to be true.

    Starts from the majority of the votes; one count is added to every cell.
    """
    total = cast.sum(axis=1)
    p = 1 / (1 + np.exp(-total.astype(float)))
    one_hot = np.stack([cast == v for v in VOTES], axis=2).astype(float)  # pattern, labeler, vote
    for _ in range(rounds):
        prior = ((counts * p).sum() + 1) / (counts.sum() + 2)
        logs = []
        for weight, share in ((counts * p, prior), (counts * (1 - p), 1 - prior)):
            cells = np.einsum("n,njv->jv", weight, one_hot) + 1
            rates = np.log(cells / cells.sum(axis=1, keepdims=True))
            logs.append(np.log(share) + np.einsum("njv,jv->n", one_hot, rates))
        p = 1 / (1 + np.exp(np.clip(logs[1] - logs[0], -50, 50)))
    return p


def _design(codes: list[int]) -> np.ndarray:
    rows = []
    for kind, length, cast in map(_unpack, codes):
        row = [float(kind == k) for k in range(len(KINDS))]
        row += [float(length == n) for n in range(4)]
        row += [float(v == x) for v, x in product(cast, VOTES)]
        rows.append(row)
    return np.array(rows)


def fit(docs: DataFrame, threshold: float = 0.5) -> frozenset[int]:
    """The patterns whose spans the trained classifier accepts."""
    counted = pattern_counts(docs)
    if not counted:
        return frozenset()
    codes = sorted(counted)
    counts = np.array([counted[c] for c in codes], float)
    cast = np.array([_unpack(c)[2] for c in codes])
    kind = np.array([_unpack(c)[0] for c in codes])
    truth = np.zeros(len(codes))
    for k in range(len(KINDS)):
        if (own := kind == k).any():
            truth[own] = estimate(cast[own], counts[own])
    x, share = _design(codes), counts / counts.sum()
    weights = np.zeros(x.shape[1])
    for _ in range(2_000):  # logistic regression on the estimated probabilities
        p = 1 / (1 + np.exp(-x @ weights))
        weights -= 0.5 * (x.T @ (share * (p - truth)) + 1e-4 * weights)
    accepted = 1 / (1 + np.exp(-x @ weights)) >= threshold
    return frozenset(c for c, ok in zip(codes, accepted) if ok)


def all_spans(text: str | None, accepted: frozenset[int]) -> tuple[list, list]:
    """The base spans, and these together with the accepted further ones, sorted."""
    if not text:
        return [], []
    base, free = candidates(text)
    added, done = [], 0
    for span in free:
        if span[0] >= done and pattern(text, *span, False) in accepted:
            added.append(span)
            done = span[2]
    return base, sorted(base + added)


def annotate(docs: DataFrame, accepted: frozenset[int], *keep: str) -> DataFrame:
    """``doc_id``, ``text``, the columns ``keep``, then ``base`` and ``spans`` of each row."""
    source = texts(docs, *keep, own=("base", "spans"))
    shape = T.StructType([
        *source.schema.fields, T.StructField("base", SPANS), T.StructField("spans", SPANS)])

    def run(batches: Batches) -> Batches:
        cell = pa.list_(pa.struct([
            ("kind", pa.string()), ("start", pa.int32()), ("stop", pa.int32())]))

        def rows(spans: list) -> list[dict]:
            return [{"kind": KINDS[k], "start": a, "stop": b} for a, k, b in spans]

        for batch in batches:
            both = [all_spans(t.as_py(), accepted) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([rows(x[0]) for x in both], cell),
                 pa.array([rows(x[1]) for x in both], cell)],
                names=[*batch.schema.names, "base", "spans"],
            )

    return map_batches(source, run, shape)


def digests(found: DataFrame) -> DataFrame:
    def joined(column: str):
        return F.array_join(F.transform(
            column, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.stop.cast("string"))
        ), ",")

    def number(kind: str):
        return F.size(F.filter("base", lambda s: s.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in KINDS],
        F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"),
    )


def redact(found: DataFrame) -> DataFrame:
    """Replaces each span (overlapping ones as one, by the first's kind) in ``text``."""

    def run(batches: Batches) -> Batches:
        for batch in batches:
            out = []
            spans = batch.column("spans").to_pylist()
            for cell, own in zip(batch.column("text"), spans):
                text, parts, done, n = cell.as_py(), [], 0, 0
                while n < len(own):
                    first, stop = own[n], own[n]["stop"]
                    n += 1
                    while n < len(own) and own[n]["start"] < stop:
                        stop = max(stop, own[n]["stop"])
                        n += 1
                    parts += [text[done:first["start"]], f"[{first['kind'].upper()}]"]
                    done = stop
                out.append("".join([*parts, text[done:]]) if own else text)
            at = batch.schema.names.index("text")
            yield pa.RecordBatch.from_arrays(
                [pa.array(out, pa.string()) if n == at else c for n, c in enumerate(batch.columns)],
                names=batch.schema.names,
            )

    return map_batches(found, run, found.schema)
