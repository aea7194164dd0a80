"""Diagnosis-code grouping and comorbidity scoring as column expressions.

The functions take column names and build one SQL expression each: the rules
are long lists, and a single text is parsed much faster than a tree that is
put together call by call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from caretide import schema as S
from caretide.functions.clinical import is_true, texts, total

# Spark's cast reads a trailing D or F as a Java type suffix, so only text
# that is a plain decimal number is cast.
_DECIMAL = r"^[+-]?([0-9]+[.]?[0-9]*|[.][0-9]+)([eE][+-]?[0-9]+)?$"
_BLANKS = r"concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))"
# Codes are joined by a character no code holds, so that one match per
# category covers all of a row's codes.
_SEPARATOR = "\x01"


def _normalized(code: str) -> str:
    return f"upper(btrim(`{code}`, {_BLANKS}))"


def _matching(code: str) -> str:
    missing = f"`{code}` is null or `{code}` = '{S.MISSING}' or lower(`{code}`) = 'nan'"
    return f"if({missing}, '', {_normalized(code)})"


def normalized(code: str) -> Column:
    return F.expr(_normalized(code))


def matching_code(code: str) -> Column:
    """The code as the comorbidity prefixes expect it; missing becomes ``""``."""
    return F.expr(_matching(code))


def code_number(code: str) -> Column:
    """The code as a number, null where it is none.

    Codes that start with V or E are no numbers and so fall into ``Other``.
    """
    text = _normalized(code)
    return F.expr(f"if({text} rlike '{_DECIMAL}', try_cast({text} as double), null)")


def diagnosis_group(code: str, number: str) -> Column:
    """The clinical group of one ICD-9 code and its :func:`code_number`.

    The number comes as a column of its own, because every rule looks at it.
    Ranges end on whole codes: 459.81 lies past 459 and is ``Other``.
    """
    whens = [
        f"when `{code}` is null or `{code}` in ({texts(S.MISSING_DIAGNOSES)}) then 'Missing'",
    ]
    for name, low, high, closed, single in S.DIAGNOSIS_GROUPS:
        inside = f"`{number}` >= {low}D and `{number}` {'<=' if closed else '<'} {high}D"
        if single is not None:
            inside = f"({inside}) or `{number}` = {single}D"
        whens.append(f"when {inside} then '{name}'")
    return F.expr(f"case {' '.join(whens)} else 'Other' end")


def with_diagnosis_groups(df: DataFrame, codes: dict[str, str]) -> DataFrame:
    """Add a group column per code column: ``{code: group}`` names."""
    numbers = {code: f"_number_{i}" for i, code in enumerate(codes)}
    return (
        df.withColumns({n: code_number(code) for code, n in numbers.items()})
        .withColumns({group: diagnosis_group(code, numbers[code]) for code, group in codes.items()})
        .drop(*numbers.values())
    )


def any_diabetes(groups: list[Column]) -> Column:
    return F.greatest(*[is_true(g == "Diabetes") for g in groups])


def joined_codes(codes: list[str]) -> Column:
    return F.expr(f"concat_ws('{_SEPARATOR}', {', '.join(_matching(c) for c in codes)})")


def comorbidity_flags(codes: str) -> dict[str, Column]:
    """One 0/1 column per category over the text of :func:`joined_codes`."""
    flags = {}
    for name, prefixes in S.COMORBIDITY_PREFIXES.items():
        starts = "|".join(p.replace(".", "[.]") for p in prefixes)
        flags[name] = F.expr(f"int(`{codes}` rlike '(?:^|{_SEPARATOR})(?:{starts})')")
    return flags


def comorbidity_score(codes: str) -> Column:
    """The weighted score; a category counts once per row."""
    flags = comorbidity_flags(codes)
    terms = [
        flags[name] * weight
        for name, weight in S.COMORBIDITY_WEIGHTS.items()
        if weight and name in flags
    ]
    return total(terms).cast("double")
