"""Seeded stratified splits and folds.

Rows are ordered inside each label by ``md5(seed:row_id)``, so a row's place
depends only on its id and the seed, not on partitioning or retries. A fit
finds the md5 values at which the parts end; assigning a part is then a
comparison with literals, with no shuffle of the table itself.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window, functions as F

from caretide import schema as S
from caretide.functions.clinical import column

_DIGITS = 4  # hex digits added at a time: at most 65 536 counts per label
_SORTED = 100_000  # rows in one prefix above which it is counted by longer prefixes


def order_key(row_id: str = S.ROW_ID, seed: int = S.SEED) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), column(row_id).cast("string")))


@dataclass(frozen=True)
class Cuts:
    """The last md5 value of each part but the final one, per label."""

    label: str
    row_id: str
    seed: int
    names: tuple
    ends: dict

    def part(self) -> Column:
        """The name of a row's part, or null for a row without label."""
        key = order_key(self.row_id, self.seed)
        chosen = F.lit(None)
        for value, ends in self.ends.items():
            inner = F.lit(self.names[-1])
            for name, end in reversed(list(zip(self.names, ends))):
                if end is not None:
                    inner = F.when(key <= end, F.lit(name)).otherwise(inner)
            chosen = F.when(column(self.label) == value, inner).otherwise(chosen)
        return chosen


def fit_cuts(df: DataFrame, names: list, ends_of: Callable[[int], list[int]],
             label: str = S.LABEL, row_id: str = S.ROW_ID, seed: int = S.SEED) -> Cuts:
    """Cut each label into parts; ``ends_of`` gives the last ranks of all but the last.

    Rows are counted by the first digits of their md5 value, and the few prefixes in
    which a part ends by further digits, until such a prefix holds few rows. Only
    these rows are then put in order. Counts on the driver are bounded by the digits.
    """
    if label not in df.columns:
        raise ValueError(f"label column {label!r} not found")
    keyed = df.where(column(label).isNotNull()).select(
        column(label).alias("label"), order_key(row_id, seed).alias("key")
    )
    counts = _prefix_counts(keyed, _DIGITS)
    sizes = {value: sum(by.values()) for value, by in counts.items()}
    # (label, part): the prefix in which the part ends, and the rank inside it
    homes = {
        (value, i): _home(counts[value], rank)
        for value, total in sizes.items() for i, rank in enumerate(ends_of(total)) if rank > 0
    }
    digits = _DIGITS
    while any(n > _SORTED for _, _, n in homes.values()) and digits < 32:
        digits += _DIGITS
        inner = _prefix_counts(_inside(keyed, homes), digits)
        homes = {
            (value, i): _home(
                {p: n for p, n in inner[value].items() if p.startswith(prefix)}, nth)
            for (value, i), (prefix, nth, _) in homes.items()
        }
    ends = {value: [None] * len(ends_of(total)) for value, total in sizes.items()}
    if homes:
        inside = Window.partitionBy("label", "prefix").orderBy("key")
        wanted = F.lit(False)
        for (value, _), (prefix, nth, _) in homes.items():
            wanted |= (F.col("label") == value) & (F.col("prefix") == prefix) & (F.col("r") == nth)
        rows = (
            _inside(keyed, homes).withColumn("prefix", F.substring("key", 1, digits))
            .withColumn("r", F.row_number().over(inside)).where(wanted).collect()
        )
        keys = {(row["label"], row["prefix"], row["r"]): row["key"] for row in rows}
        for (value, i), (prefix, nth, _) in homes.items():
            ends[value][i] = keys[(value, prefix, nth)]
    return Cuts(label, row_id, seed, tuple(names), {v: tuple(e) for v, e in ends.items()})


def _prefix_counts(keyed: DataFrame, digits: int) -> dict:
    """Rows per label and md5 prefix."""
    counts: dict = {}
    for row in keyed.groupBy("label", F.substring("key", 1, digits).alias("prefix")).count().collect():
        counts.setdefault(row["label"], {})[row["prefix"]] = row["count"]
    return counts


def _home(counts: dict[str, int], rank: int) -> tuple[str, int, int]:
    """The prefix that holds the rank, the rank inside it, and its rows."""
    for prefix in sorted(counts):
        if rank <= counts[prefix]:
            return prefix, rank, counts[prefix]
        rank -= counts[prefix]
    raise AssertionError("rank beyond the last row")


def _inside(keyed: DataFrame, homes: dict) -> DataFrame:
    """The rows whose label and prefix hold the end of a part."""
    chosen = F.lit(False)
    for value, prefix in {(value, prefix) for (value, _), (prefix, _, _) in homes.items()}:
        chosen |= (F.col("label") == value) & F.col("key").startswith(prefix)
    return keyed.where(chosen)


def share_ends(shares: list[Fraction]) -> Callable[[int], list[int]]:
    """Parts that end at their shares, each rounded up to whole rows."""

    def ends(total: int) -> list[int]:
        out, last = [], 0
        for share in shares:
            last = min(total, last + math.ceil(total * share))
            out.append(last)
        return out

    return ends


def even_ends(parts: int) -> Callable[[int], list[int]]:
    """Parts whose sizes differ by one at most: part i ends at floor(total (i+1) / parts)."""
    return lambda total: [total * (i + 1) // parts for i in range(parts - 1)]


def fit_split(df: DataFrame, label: str = S.LABEL, row_id: str = S.ROW_ID,
              seed: int = S.SEED, test: str = S.TEST_SHARE,
              validation: str = S.VALIDATION_SHARE) -> Cuts:
    ends = share_ends([Fraction(test), Fraction(validation)])
    return fit_cuts(df, ["test", "val", "train"], ends, label, row_id, seed)


def split_data(df: DataFrame, **options) -> DataFrame:
    """Add ``split``: 15 % test, 15 % validation, the rest for training."""
    return df.withColumn("split", fit_split(df, **options).part())


def fold_data(df: DataFrame, folds: int = 5, label: str = S.LABEL,
              row_id: str = S.ROW_ID, seed: int = S.SEED) -> DataFrame:
    """Add ``fold`` 0 … folds-1, each label spread evenly over the folds."""
    if label not in df.columns:
        raise ValueError(f"label column {label!r} not found")
    cuts = fit_folds(df, folds, label, row_id, seed)
    return df.withColumn("fold", cuts.part())


def fit_folds(df: DataFrame, folds: int = 5, label: str = S.LABEL,
              row_id: str = S.ROW_ID, seed: int = S.SEED) -> Cuts:
    return fit_cuts(df, list(range(folds)), even_ends(folds), label, row_id, seed)


def split_report(split: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Rows, share of all rows and positive rate of each split."""
    sizes = split.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.avg(column(label)).alias("positive_rate")
    )
    # at most one row per split name reaches this window
    return sizes.withColumn(
        "share", F.col("n_rows") / F.sum("n_rows").over(Window.partitionBy(F.lit(1)))
    )


def split_overlap(split: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    """Row ids that occur in more than one split; empty when all is well."""
    return (
        split.groupBy(row_id).agg(
            F.min("split").alias("first_split"), F.max("split").alias("last_split")
        ).where("first_split <> last_split")
    )


def overlap_counts(split: DataFrame, row_id: str = S.ROW_ID) -> DataFrame:
    """How many row ids each pair of splits shares: ``(split_a, split_b, n)``.

    Only the sets of splits meet after the shuffle, at most one of each per id.
    """
    sets = split.groupBy(row_id).agg(F.sort_array(F.collect_set("split")).alias("s"))
    pairs = sets.where(F.size("s") > 1).groupBy("s").agg(F.count("*").alias("n")).select(
        "n", "s", F.explode("s").alias("split_a"))
    return (
        pairs.select("n", "split_a", F.explode("s").alias("split_b"))
        .where("split_a < split_b").groupBy("split_a", "split_b").agg(F.sum("n").alias("n"))
    )


def ranked(df: DataFrame, label: str = S.LABEL, row_id: str = S.ROW_ID,
           seed: int = S.SEED) -> DataFrame:
    """Add ``place``, a row's rank from 1 among the rows of its label.

    Ranks are counted inside md5 prefixes and added to the counts of the prefixes
    before, so that no label is put in order by one task.
    """
    keyed = df.withColumn("key__", order_key(row_id, seed)).withColumn(
        "prefix__", F.substring("key__", 1, _DIGITS))
    rising = Window.partitionBy(label).orderBy("prefix__")  # at most 65 536 rows per label
    before = F.sum("n__").over(rising.rowsBetween(Window.unboundedPreceding, -1))
    offsets = keyed.groupBy(label, "prefix__").agg(F.count("*").alias("n__")).select(
        label, "prefix__", F.coalesce(before, F.lit(0)).alias("before__"))
    inside = Window.partitionBy(label, "prefix__").orderBy("key__")
    return (
        keyed.withColumn("place", F.row_number().over(inside))
        .join(offsets, [label, "prefix__"])
        .withColumn("place", F.col("place") + F.col("before__"))
        .drop("key__", "prefix__", "before__")
    )


def class_weights(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    """Balanced weights ``n / (classes * n_class)`` per label."""
    counts = df.where(column(label).isNotNull()).groupBy(label).agg(F.count("*").alias("n"))
    alone = Window.partitionBy(F.lit(1))  # one row per label
    return counts.withColumn(
        "weight",
        F.sum("n").over(alone) / (F.count("*").over(alone) * F.col("n")),
    )


def with_class_weight(df: DataFrame, label: str = S.LABEL) -> DataFrame:
    weights = {r[label]: r["weight"] for r in class_weights(df, label).collect()}
    weight = F.lit(None).cast("double")
    for value, w in weights.items():
        weight = F.when(column(label) == value, F.lit(w)).otherwise(weight)
    return df.withColumn("weight", weight)
