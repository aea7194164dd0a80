"""Language identification in two steps: the family, then the language within it.

Texts become vectors of hashed character n-grams (one to three letters, word
boundaries included). One-versus-one linear support vector machines choose among
the families; those of the chosen family choose among its languages. Each machine
is fitted in a task of its own, on a bounded sample of labelled rows: at most
``per_language`` texts of each language, taken by the order of a hash, each as a
whole and as a few short pieces, so that short texts are learned too.

A text's language is predicted from the text alone, as a whole. The score is the
lowest confidence (a logistic function of the margin) of the choices on the way.

Cases: a null text, or one without a letter, is ``und`` with score 0; rows without
a label are not learned from; a single language is predicted for all texts with
letters; without any labelled text everything is ``und``; ties go to the name that
sorts first; repeated rows are all predicted; a very long text is read whole; an
empty table gives no rows; columns not named by the caller are dropped.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from caretide.llm.common import Batches, map_batches
from caretide.session import materialize

UND = "und"
DIMS = 4_096
GRAMS = 3
#: Bounds of the sample the machines are fitted on.
PER_LANGUAGE = 250
PIECES = (30, 80, 250)
SLOPE = 4.0
#: Letters whose n-grams are counted at once.
STRETCH = 1 << 20

# Families of common languages by ISO 639-1 code. Any other code is a
# family of its own.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "fy", "is", "lb", "nb", "nl", "nn", "no", "sv", "yi"],
    "romance": ["ca", "es", "fr", "gl", "it", "la", "oc", "pt", "ro"],
    "slavic": ["be", "bg", "bs", "cs", "hr", "mk", "pl", "ru", "sk", "sl", "sr", "uk"],
    "uralic": ["et", "fi", "hu"],
    "baltic": ["lt", "lv"],
    "turkic": ["az", "kk", "tr", "uz"],
    "indic": ["bn", "gu", "hi", "mr", "ne", "pa", "ur"],
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes}


def family_of(lang: str) -> str:
    return FAMILY_OF.get(lang.lower().split("-")[0], lang)


def _letters() -> np.ndarray:
    """Which of the code points up to U+FFFF are letters."""
    return np.array([chr(c).isalpha() for c in range(0x10000)])


def features(text: str | None, letters: np.ndarray, dims: int = DIMS) -> np.ndarray | None:
    """The unit vector of a text's n-gram counts (square roots), or None without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le"), np.uint32)
    is_letter = letters[np.minimum(codes, 0xFFFF)]
    if (beyond := np.flatnonzero(codes > 0xFFFF)).size:
        is_letter[beyond] = [chr(c).isalpha() for c in codes[beyond]]
    if not is_letter.any():
        return None
    # anything else is a boundary; runs of boundaries count once
    kept = is_letter.copy()
    kept[1:] |= is_letter[:-1]
    line = np.concatenate([[0], np.where(is_letter, codes, 0)[kept], [0]]).astype(np.uint32)
    counts = np.zeros(dims)
    for at in range(0, len(line), STRETCH):  # long texts in stretches that overlap
        part = line[at:at + STRETCH + GRAMS - 1].astype(np.uint64)
        gram = np.zeros(len(part), np.uint64)
        for size in range(1, GRAMS + 1):
            gram = gram[:len(part) - size + 1] * np.uint64(0x110000) + part[size - 1:]
            mixed = (gram[:STRETCH] + np.uint64(size)) * np.uint64(0x9E3779B97F4A7C15)
            mixed ^= mixed >> np.uint64(29)
            mixed *= np.uint64(0xBF58476D1CE4E5B9)
            counts += np.bincount((mixed >> np.uint64(40)) % np.uint64(dims), minlength=dims)
    weights = np.sqrt(counts)
    return weights / np.linalg.norm(weights)


def _pieces(text: str, lengths=PIECES) -> list[str]:
    """The text itself and a few short stretches spread over it."""
    places = [len(text) * (n + 1) // (len(lengths) + 1) for n in range(len(lengths))]
    return [text, *(text[p:p + n] for p, n in zip(places, lengths))]


def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most ``per_language`` rows of each language: those with the lowest hashes.

    The languages are counted first; the hash bound that lets through about twice
    the wanted rows keeps the ranking small, whatever the table's size.
    """
    rows = labelled.select("doc_id", "text", "lang").where(F.col("lang").isNotNull())
    sizes = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}
    place = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1_000_000))
    bound = F.lit(None)
    for lang, size in sorted(sizes.items()):
        share = min(1.0, (2 * per_language + 20) / size)
        bound = F.when(F.col("lang") == lang, math.ceil(share * 1_000_000)).otherwise(bound)
    chosen = rows.withColumn("place", place).where(
        F.col("text").isNotNull() & (F.col("place") < bound))
    low = chosen.groupBy("lang").agg(
        F.sort_array(F.collect_list(F.struct("place", "doc_id", "text"))).alias("rows"))
    return low.select("lang", F.explode(F.slice("rows", 1, per_language)).alias("r")).select(
        "lang", F.col("r.text").alias("text"))


def fit_machine(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, steps: int = 150):
    """A linear support vector machine with squared hinge loss, by accelerated gradient.

    The last column of ``x`` is constant, so the last weight is the bias. Both sides
    weigh the same.
    """
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    rate = np.float32(1 / (2 * 2 + penalty))  # rows have length sqrt(2), shares sum to one
    penalty = np.float32(penalty)
    share = share.astype(x.dtype)
    at = ahead = np.zeros(x.shape[1], x.dtype)
    for step in range(steps):
        slack = np.maximum(0, 1 - y * (x @ ahead))
        new = ahead - rate * (penalty * ahead - 2 * x.T @ (share * slack * y))
        at, ahead = new, new + np.float32(step / (step + 3)) * (new - at)
    return at


def fit(
    labelled: DataFrame, family=family_of, per_language: int = PER_LANGUAGE, dims: int = DIMS
) -> dict:
    """Learns from ``doc_id`` (for the sample), ``text`` and ``lang``.

    The model holds one weight vector for each pair of families and for each pair
    of languages of one family: its size depends on the languages, not on the rows.
    """
    rows = materialize(sample(labelled, per_language), "language-sample")
    langs = sorted(r["lang"] for r in rows.select("lang").distinct().collect())
    families: dict[str, list[str]] = {}
    for lang in langs:
        families.setdefault(family(lang), []).append(lang)
    pairs = [("", a, b) for a, b in combinations(sorted(families), 2)]
    pairs += [(f, a, b) for f, group in families.items() for a, b in combinations(group, 2)]
    model = {"families": families, "machines": {}, "dims": dims}
    if not pairs:
        return model
    taught = {lang: [] for lang in langs}  # the machines each language is an example for
    for n, (group, a, b) in enumerate(pairs):
        for lang in langs:
            name = family(lang) if group == "" else lang
            if name in (a, b):
                taught[lang].append((n, 1 if name == a else -1))
    sides = F.create_map(*[
        x for lang in langs for x in (F.lit(lang), F.array(*[
            F.struct(F.lit(n).alias("pair"), F.lit(side).alias("side"))
            for n, side in taught[lang]
        ]))
    ])
    dealt = rows.select("text", F.explode(sides[F.col("lang")]).alias("s")).select(
        "s.pair", "s.side", "text")

    def machine(group: pd.DataFrame) -> pd.DataFrame:
        letters = _letters()
        group = group.sort_values(["side", "text"])
        x = np.ones((len(group) * (len(PIECES) + 1), dims + 1), np.float32)
        y = np.zeros(len(x), np.float32)
        n = 0
        for side, text in zip(group["side"], group["text"]):
            for piece in _pieces(text):
                if (vector := features(piece, letters, dims)) is not None:
                    x[n, :-1], y[n] = vector, side
                    n += 1
        weights = fit_machine(x[:n], y[:n])
        return pd.DataFrame({"pair": [group["pair"].iloc[0]], "weights": [weights.tolist()]})

    fitted = dealt.groupBy("pair").applyInPandas(machine, "pair int, weights array<double>")
    for row in fitted.collect():
        model["machines"][pairs[row["pair"]]] = np.array(row["weights"])
    return model


def _choose(machines: list, vector: np.ndarray, names: list[str]) -> tuple[str, float]:
    """The name that wins most of the pairs, and its lowest confidence in them."""
    if len(names) == 1:
        return names[0], 1.0
    won = {n: [0, 0.0, 1.0] for n in names}  # pairs, sum of margins, lowest confidence
    for a, b, weights in machines:
        margin = float(weights[:-1] @ vector + weights[-1])
        for name, own in ((a, margin), (b, -margin)):
            tally = won[name]
            tally[0] += own > 0 or (own == 0 and name == a)
            tally[1] += own
            tally[2] = min(tally[2], 1 / (1 + math.exp(-max(-50.0, min(50.0, SLOPE * own)))))
    best = min(names, key=lambda n: (-won[n][0], -won[n][1], n))
    return best, won[best][2]


def predict(docs: DataFrame, model: dict, *keep: str | Column) -> DataFrame:
    """The columns ``keep``, then ``lang_pred`` and ``score`` of each row's ``text``."""
    source = docs.select(*keep)
    names = source.columns
    shape = T.StructType([
        *source.schema.fields, T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()),
    ])
    if "text" not in names:
        source = docs.select(*keep, F.col("text").cast("string").alias("text"))
    families, dims = model["families"], model["dims"]
    by_family = {
        f: [(a, b, w) for (g, a, b), w in model["machines"].items() if g == f]
        for f in ["", *families]
    }

    def run(batches: Batches) -> Batches:
        letters = _letters()
        for batch in batches:
            langs, scores = [], []
            for text in batch.column("text"):
                vector = features(text.as_py(), letters, dims)
                if vector is None or not families:
                    langs.append(UND)
                    scores.append(0.0)
                    continue
                family, sure = _choose(by_family[""], vector, sorted(families))
                lang, surer = _choose(by_family[family], vector, families[family])
                langs.append(lang)
                scores.append(min(sure, surer))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names),
                 pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                names=[*names, "lang_pred", "score"],
            )

    return map_batches(source, run, shape)


def held_out(doc_id: str | Column = "doc_id") -> Column:
    """Rows that are never learned from: a remainder of 1 of the id's checksum by 3."""
    column = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    sum_ = F.crc32(column.cast("long").cast("string").cast("binary"))
    return F.coalesce(sum_ % 3 == 1, F.lit(False))
