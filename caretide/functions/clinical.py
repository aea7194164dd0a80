"""Scalar clinical expressions: each takes columns and returns a column.

All are built-in Spark expressions, so they stay inside code generation. Null
handling is explicit, because a comparison with null must count as "no" here
and not as unknown.
"""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, functions as F

from caretide import schema as S


def column(name: str) -> Column:
    """A column by its exact name, also when the name holds a hyphen or dot."""
    return F.col(f"`{name}`")


def quoted(names: list[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def lookup(value: Column, mapping: dict) -> Column:
    """``mapping[value]``, null for keys the mapping does not hold."""
    pairs = [F.lit(part) for pair in mapping.items() for part in pair]
    return F.try_element_at(F.create_map(*pairs), value)


def is_true(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def total(terms: list[Column]) -> Column:
    return reduce(add, terms)


def texts(values: list[str]) -> str:
    """The values as a SQL list of text literals."""
    return ", ".join(f"'{v}'" for v in values)


def null_sentinel(name: str, literals: list[str]) -> Column:
    """Null where the text is one of the literals that stand for missing."""
    return F.expr(f"case when `{name}` not in ({texts(literals)}) then `{name}` end")


def label_30day(value: Column) -> Column:
    """1 for a return within 30 days; everything else, also null, is 0."""
    return value.eqNullSafe(F.lit("<30")).cast("int")


def label_mapped(value: Column) -> Column:
    """The map variant of the label: values it does not know stay null."""
    return lookup(value, S.LABEL_VALUES)


def age_midpoint(value: Column) -> Column:
    return lookup(value, S.AGE_MIDPOINTS)


def age_band(midpoint: Column) -> Column:
    """The inverse of :func:`age_midpoint`."""
    return lookup(midpoint, {m: band for band, m in S.AGE_MIDPOINTS.items()})


def age_lower_bound(value: Column) -> Column:
    """The number a band such as ``[70-80)`` starts with, null if it has none."""
    digits = F.regexp_extract(value, r"^\[(\d+)", 1)
    return F.nullif(digits, F.lit("")).cast("int")


def prior_visits(*counts: Column) -> Column:
    return total([F.coalesce(c, F.lit(0)) for c in counts])


def high_utilizer(inpatient: Column) -> Column:
    return is_true(inpatient >= 2)


def medication_burden(names: list[str] = S.MEDICATIONS) -> Column:
    """How many doses are neither absent nor steady; a null dose counts."""
    return F.expr(" + ".join(f"if(`{m}` in ('No', 'Steady'), 0, 1)" for m in names))


def active_medications(names: list[str] = S.MEDICATIONS) -> Column:
    """How many doses differ from ``No``; a null dose counts."""
    return F.expr(" + ".join(f"if(`{m}` = 'No', 0, 1)" for m in names))


def insulin_level(dose: Column) -> Column:
    return F.coalesce(lookup(dose, S.INSULIN_LEVELS), F.lit(0))


def equals_flag(value: Column, wanted: str) -> Column:
    return is_true(value == wanted)


def lab_tested(result: Column) -> Column:
    return is_true(result != "None")


def lab_abnormal(result: Column, abnormal: list[str]) -> Column:
    return is_true(result.isin(*abnormal))


def discharge_group(disposition: Column) -> Column:
    chosen = F.lit("Other")
    for name, ids in S.DISCHARGE_GROUPS.items():
        chosen = F.when(disposition.isin(*ids), name).otherwise(chosen)
    return chosen


def admission_group(admission_type: Column) -> Column:
    return F.coalesce(lookup(admission_type, S.ADMISSION_GROUPS), F.lit("Other"))


def specialty_group(specialty: Column) -> Column:
    known = F.coalesce(specialty, F.lit("Unknown"))
    return F.when(known.isin(*S.KEPT_SPECIALTIES), known).otherwise("Other")


def clipped_default(value: Column, low: int, high: int) -> Column:
    """Round half to even, then clip into ``[low, high]``."""
    rounded = F.bround(value, 0).cast("int")
    return F.least(F.greatest(rounded, F.lit(low)), F.lit(high))


def risk_band(score: Column, threshold: Column) -> Column:
    return (
        F.when(score >= threshold * 1.5, "High risk")
        .when(score >= threshold, "Watchlist")
        .otherwise("Lower risk")
    )


def outcome_text(label: Column) -> Column:
    return F.when(label == 1, "Readmitted < 30 Days").otherwise(
        "Not Readmitted / > 30 Days"
    )
