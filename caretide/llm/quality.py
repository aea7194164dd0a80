"""Quality rules as a ledger of failure bits.

Every rule is evaluated once for every document. The ledger stores the measurements
and, in one integer, a bit for each rule that the document fails. Policies, which have
versions, are masks over these bits: applying one, or finding what it would keep
without one of its rules, reads the ledger and never the texts.

Only DataFrame functions run here, without a shuffle: all that is measured lies in one
text. Words are runs of other than white space. A window's words are first compared
by hash; only texts in which two hashes agree compare, by sorting, the windows
themselves, so that the counts are exact.

Cases: a null or empty text has no words and no lines, all its measurements are 0 and
it fails ``few_words`` only; a very long text is measured whole, in one row, with its
windows held in memory (about the width times its length); repeated rows, rows of one
id and rows without id are each measured and kept or not by themselves; there are no
ties to break; an empty table gives no rows and no ablations; other columns of the
input, whatever their names, are left aside or, in ``keep_good``, come out unchanged.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from caretide.llm.common import texts

WIDTH = 5
_SPACE = r"\x20\x09-\x0D"
_SPACES = " \t\n\x0b\x0c\r"

MEASURES = (
    "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper",
    "n_marks",
)


@dataclass(frozen=True)
class Rule:
    """A document fails where ``fails``, a condition on measurements, is true."""

    name: str
    fails: str


#: A rule's place is its bit; new rules go to the end, so that old ledgers stay readable.
RULES = (
    Rule("few_words", "n_words < 10"),
    Rule("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 12 * n_words"),
    Rule("symbols", "10 * n_symbols > n_words"),
    Rule("duplicate_lines", "10 * n_dup_lines > 3 * n_lines"),
    Rule("upper_case", "2 * n_upper > word_chars"),
    Rule("marks", "4 * n_marks > n_words"),
)


@dataclass(frozen=True)
class Policy:
    """Rejects what fails a rule of ``reject`` or more than ``allowed`` of ``counted``."""

    version: str
    reject: tuple[str, ...]
    counted: tuple[str, ...] = ()
    allowed: int = 0


BASE = Policy("1-base", ("few_words", "repeated_words"))
STRICT = Policy(
    "2-strict", ("few_words", "repeated_words", "symbols", "upper_case", "marks"),
    counted=("short_words", "long_words", "duplicate_lines"), allowed=1,
)
POLICIES = (BASE, STRICT)


def mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    places = {rule.name: place for place, rule in enumerate(rules)}
    return sum(1 << places[name] for name in names)


# --- measurements -----------------------------------------------------------------------


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body uses it."""
    return F.transform(F.array(value), body)[0]


def _windows(words: str, width: int, made: Callable[..., Column]) -> Column:
    """``made`` of the words of every window of ``width`` words."""
    count = F.greatest(F.size(words) - (width - 1), F.lit(0))
    side = F.arrays_zip(*[F.slice(words, k + 1, count).alias(f"w{k}") for k in range(width)])
    return F.transform(side, lambda x: made(*[x[f"w{k}"] for k in range(width)]))


def _covered(words: str, width: int) -> Column:
    """How many words lie in a window that is found twice or more."""
    spelled = _windows(words, width, lambda *w: F.concat_ws(" ", *w))
    placed = F.sort_array(F.transform(spelled, lambda w, i: F.struct(w.alias("w"), i.alias("i"))))
    pairs = _let(placed, lambda p: F.arrays_zip(
        p.alias("a"), F.slice(p, F.lit(2), F.greatest(F.size(p), F.lit(0))).alias("b")))
    equal = F.filter(pairs, lambda p: p["a"]["w"] == p["b"]["w"])
    starts = F.sort_array(F.array_distinct(F.flatten(
        F.transform(equal, lambda p: F.array(p["a"]["i"], p["b"]["i"])))))
    return F.aggregate(
        starts,
        F.struct(F.lit(0).cast("long").alias("total"), F.lit(-width).alias("last")),
        lambda seen, at: F.struct(
            (seen["total"] + F.least(F.lit(width), at - seen["last"])).alias("total"),
            at.alias("last")),
        lambda seen: seen["total"],
    )


def _outside(text: Column, keep: str) -> Column:
    """Characters of ``text`` left when all but those of ``keep`` are dropped."""
    return F.length(F.regexp_replace(text, f"[^{keep}]+", "")).cast("long")


def _measured(rows: DataFrame, width: int) -> DataFrame:
    """Adds MEASURES to rows with a ``text``; drops the text."""
    whole = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(whole, F.lit(_SPACES))
    said = F.filter(F.split(whole, "\n", -1), lambda line: line.rlike(f"[^{_SPACE}]"))
    none = F.array().cast("array<string>")
    laid = rows.withColumns({
        "words": F.when(trimmed == "", none).otherwise(F.split(trimmed, f"[{_SPACE}]+")),
        "lines": said,
        "word_chars": F.length(F.regexp_replace(whole, f"[{_SPACE}]+", "")).cast("long"),
        "n_symbols": _outside(whole, r"#*$%&|<>"),
        "n_upper": _outside(whole, "A-Z"),
        "n_marks": _outside(whole, "!?"),
    }).drop("text")
    hashed = laid.withColumn("hashes", _windows("words", width, F.xxhash64))
    alone = F.size(F.array_distinct("hashes")) == F.size("hashes")
    return hashed.withColumns({
        "n_words": F.size("words").cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_repeat_words": F.when(alone, F.lit(0).cast("long")).otherwise(_covered("words", width)),
    }).drop("words", "lines", "hashes")


def _failures(rules: tuple[Rule, ...]) -> Column:
    """The rules' bits; a condition that is null does not fail."""
    bits = F.lit(0).cast("long")
    for place, rule in enumerate(rules):
        bit = F.when(F.expr(rule.fails), F.lit(1 << place).cast("long"))
        bits = bits.bitwiseOR(F.coalesce(bit, F.lit(0).cast("long")))
    return bits


def ledger(docs: DataFrame, rules: tuple[Rule, ...] = RULES, width: int = WIDTH) -> DataFrame:
    """``doc_id``, MEASURES and ``failures`` of every row, to be written once."""
    if len(rules) > 62:
        raise ValueError("a ledger holds at most 62 rules")
    measured = _measured(texts(docs), width).withColumn("failures", _failures(rules))
    return measured.select("doc_id", *MEASURES, "failures")


# --- policies -----------------------------------------------------------------------------


def _accepted(failures: Column, reject: Column, counted: Column, allowed: Column) -> Column:
    return (failures.bitwiseAND(reject) == 0) & (
        F.bit_count(failures.bitwiseAND(counted)) <= allowed)


def _masks(policy: Policy, rules: tuple[Rule, ...]) -> tuple[Column, Column, Column]:
    return (F.lit(mask(policy.reject, rules)).cast("long"),
            F.lit(mask(policy.counted, rules)).cast("long"), F.lit(policy.allowed))


def passes(policy: Policy, rules: tuple[Rule, ...] = RULES) -> Column:
    """Whether a row of a ledger made with ``rules`` is kept."""
    return _accepted(F.col("failures"), *_masks(policy, rules))


def keep_good(docs: DataFrame, policy: Policy = STRICT, rules: tuple[Rule, ...] = RULES,
              width: int = WIDTH) -> DataFrame:
    """The documents that a policy keeps, with all their columns."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("text").cast("string").alias("text"))
    judged = _measured(rows, width).withColumn("failures", _failures(rules))
    return judged.where(passes(policy, rules)).select("row.*")


def ablations(book: DataFrame, policies: tuple[Policy, ...] = POLICIES,
              rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """What each policy keeps whole and without one of its rules.

    ``version``, ``rule`` (null: the whole policy), ``n_failed`` (documents that fail the
    rule, or that the policy rejects), ``n_kept`` without the rule, and ``n_regained`` by
    leaving it out. The ledger is counted by its bits, at most one row for each set of
    failures; all else are operations on these few rows.
    """
    counts = book.groupBy("failures").agg(F.count(F.lit(1)).alias("n"))
    asked = [
        F.struct(
            F.lit(p.version).alias("version"), rule.alias("rule"), F.lit(bit).cast("long").alias("bit"),
            *[m.alias(n) for m, n in zip(_masks(p, rules), ("reject", "counted", "allowed"))])
        for p in policies
        for rule, bit in [
            (F.lit(None).cast("string"), 0),
            *((F.lit(name), mask((name,), rules)) for name in (*p.reject, *p.counted))]
    ]
    rows = counts.select("failures", "n", F.inline(F.array(*asked)))
    without = F.bitwise_not(F.col("bit"))
    whole = _accepted(F.col("failures"), F.col("reject"), F.col("counted"), F.col("allowed"))
    less = _accepted(F.col("failures"), F.col("reject").bitwiseAND(without),
                     F.col("counted").bitwiseAND(without), F.col("allowed"))
    failed = F.when(F.col("rule").isNull(), ~whole).otherwise(
        F.col("failures").bitwiseAND(F.col("bit")) != 0)
    total = lambda condition: F.sum(F.when(condition, F.col("n")).otherwise(0))
    return rows.groupBy("version", "rule").agg(
        total(failed).alias("n_failed"), total(less).alias("n_kept"),
        total(less & ~whole).alias("n_regained"))


def by_group(book: DataFrame, group: Column, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each group of ledger rows: ``n``, the bits that ``any`` row fails, those that
    ``all`` rows fail, and how many rows fail each rule (``n_<rule>``)."""
    return book.groupBy(group.alias("group")).agg(
        F.count(F.lit(1)).alias("n"), F.bit_or("failures").alias("any"),
        F.bit_and("failures").alias("all"),
        *[F.sum(F.col("failures").bitwiseAND(F.lit(1 << place).cast("long")).cast("boolean")
                .cast("long")).alias(f"n_{rule.name}") for place, rule in enumerate(rules)])
