"""Attribution tables and the data jobs of the serving side."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide import schema as S
from caretide.operators import attribute as X, serve as V
from caretide.operators.encode import fill_numeric, numeric_moments
from caretide.plans import tables as T
from caretide.plans.evaluation_queries import _test_scores
from caretide.plans.oracle import COEFFICIENTS, LABEL_CASE, q, r6, sql
from caretide.plans.registry import query, rounded
from caretide.session import materialize
from caretide.sources.lookups import source_labels
from caretide.sources.order_view import encounters

_BASE = -2.0


def _impacts(spark, sf_dir):
    """Attributions of a linear model with stand-in coefficients."""
    table = materialize(
        fill_numeric(T.modelling(spark, sf_dir).select(S.ROW_ID, *S.NUMERIC)), "numerics"
    )
    return X.long_form(_entries(spark, sf_dir, table))


def _entries(spark, sf_dir, table=None):
    if table is None:
        table = materialize(
            fill_numeric(T.modelling(spark, sf_dir).select(S.ROW_ID, *S.NUMERIC)), "numerics"
        )
    means = {c: mean for c, (mean, _) in numeric_moments(table).items()}
    return X.linear_entries(table, COEFFICIENTS, means)


@query("x02_linear_attributions", sql("""SELECT row_id, feature, round(value, 6) AS value,
    round(impact, 6) AS impact FROM t_impacts"""))
def _(spark, sf_dir):
    return rounded(_impacts(spark, sf_dir))


@query("x03_global_importance",
       sql("SELECT feature, round(importance, 6) AS importance FROM t_importance"))
def _(spark, sf_dir):
    return rounded(X.global_importance(_impacts(spark, sf_dir)))


@query("a24_mean_absolute_impact",
       sql(f"SELECT feature, {r6('avg(abs(impact))')} AS importance FROM t_impacts GROUP BY 1"))
def _(spark, sf_dir):
    return rounded(X.global_importance(_impacts(spark, sf_dir)))


@query("k03_top_features", sql("""SELECT feature, round(importance, 6) AS importance
    FROM t_importance ORDER BY t_importance.importance DESC, feature LIMIT 5"""))
def _(spark, sf_dir):
    return rounded(X.top_features(_impacts(spark, sf_dir)))


_TOP = "(SELECT feature FROM t_importance ORDER BY importance DESC, feature LIMIT {})"


@query("x04_beeswarm", sql(f"""SELECT row_id, feature, round(value, 6) AS value,
    round(impact, 6) AS impact FROM t_impacts WHERE feature IN {_TOP.format(20)}"""))
def _(spark, sf_dir):
    return rounded(X.beeswarm(_impacts(spark, sf_dir)))


@query("x05_dependence", sql(f"""SELECT row_id, feature, round(value, 6) AS value,
    round(impact, 6) AS impact FROM t_impacts WHERE feature IN {_TOP.format(5)}"""))
def _(spark, sf_dir):
    return rounded(X.dependence(_impacts(spark, sf_dir)))


_CONTRIBUTIONS = """SELECT row_id, feature, round(t.impact, 6) AS impact, CAST(row_number() OVER
    (PARTITION BY row_id ORDER BY abs(t.impact) DESC, feature) AS INT) AS rank FROM t_impacts t
    QUALIFY rank <= {}"""


@query("k04_top_contributions", sql(_CONTRIBUTIONS.format(10)))
def _(spark, sf_dir):
    return rounded(X.top_contributions(_entries(spark, sf_dir)).drop("value"))


@query("x08_top_contributors", sql(_CONTRIBUTIONS.format(10)))
def _(spark, sf_dir):
    return rounded(X.top_contributions(_entries(spark, sf_dir), 10).drop("value"))


_CASES = "SELECT outcome, row_id, label, round(score, 6) AS score FROM t_cases"


@query("k05_first_cases", sql(_CASES))
def _(spark, sf_dir):
    return rounded(X.representative_cases(_test_scores(spark, sf_dir)))


@query("x06_representative_cases", sql(_CASES))
def _(spark, sf_dir):
    return rounded(X.representative_cases(_test_scores(spark, sf_dir)))


@query("x07_waterfall", sql(f"""SELECT row_id, feature, round(i.impact, 6) AS impact,
    CAST(row_number() OVER w AS INT) AS step, {r6(f'{_BASE} + sum(i.impact) OVER w')} AS running
    FROM t_impacts i WHERE row_id IN (SELECT row_id FROM t_cases)
    WINDOW w AS (PARTITION BY row_id ORDER BY abs(i.impact), feature DESC)"""))
def _(spark, sf_dir):
    cases = materialize(X.representative_cases(_test_scores(spark, sf_dir)), "cases")
    return rounded(X.waterfall(_impacts(spark, sf_dir), cases, _BASE).drop("value"))


# --- serving -----------------------------------------------------------------------

_NUMBERS = [*S.NUMERIC, *S.BINARY, "admission_source_id"]
_TEXTS = [c for c in S.CATEGORICAL if c != "admission_source_id"]
_DEFAULTS = " UNION ALL ".join(
    [f"SELECT '{c}' AS \"column\", median({c}::DOUBLE) AS number, NULL::VARCHAR AS text FROM t_model"
     for c in _NUMBERS]
    + [f"SELECT '{c}', NULL::DOUBLE, (SELECT {c} FROM t_model WHERE {c} IS NOT NULL GROUP BY {c} "
       f"ORDER BY count(*) DESC, {c} LIMIT 1)" for c in _TEXTS]
)


def _default(name):
    part = "number" if name in _NUMBERS else "text"
    return f"(SELECT {part} FROM t_defaults WHERE \"column\" = '{name}')"


def _features(spark, sf_dir):
    return T.modelling(spark, sf_dir).drop(S.LABEL)


def _defaults(table):
    return V.defaults_dict(V.form_defaults(table.drop(S.ROW_ID)))


@query("v01_form_defaults", sql("""SELECT "column", round(number, 6) AS number, text
    FROM t_defaults""", t_defaults=_DEFAULTS))
def _(spark, sf_dir):
    table = materialize(_features(spark, sf_dir).drop(S.ROW_ID), "features")
    return rounded(V.form_defaults(table))


@query("v02_form_options", sql("""SELECT attribute, value, CAST(row_number() OVER (PARTITION BY
    attribute ORDER BY TRY_CAST(value AS BIGINT) NULLS FIRST, value) AS INT) AS position
    FROM (""" + " UNION ".join(
    f"SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value FROM t_model WHERE {c} IS NOT NULL"
    for c in S.FORM_OPTIONS) + ")"))
def _(spark, sf_dir):
    return V.form_options(_features(spark, sf_dir))


@query("v03_source_labels", sql("""SELECT id, description FROM t_lookup_rows
    WHERE id_column = 'admission_source_id'"""))
def _(spark, sf_dir):
    return source_labels(T.lookups(spark, sf_dir))


_HIDDEN = {"race": 3, "time_in_hospital": 4, "number_inpatient": 5, "a1c_tested": 2,
           "gender": 7, "admission_source_id": 6}


def _profiles(table):
    """Features with some fields left out by rule, as a short form would."""
    number = F.col(S.ROW_ID).cast("bigint")
    hidden = {c: F.when(number % m != 0, F.col(c)) for c, m in _HIDDEN.items()}
    return table.withColumns(hidden).drop("polypharmacy_score")


def _filled_sql(name):
    kind = "DOUBLE" if name in _NUMBERS else "VARCHAR"
    if name == "polypharmacy_score":
        return _default(name)
    value = q(name)
    if name in _HIDDEN:
        value = f"CASE WHEN CAST(row_id AS BIGINT) % {_HIDDEN[name]} <> 0 THEN {name} END"
    return f"coalesce(CAST({value} AS {kind}), {_default(name)})"


_FILLED = f"SELECT row_id, {', '.join(f'{_filled_sql(c)} AS {c}' for c in S.FEATURES)} FROM t_model"


@query("v04_backfill", sql("SELECT * FROM t_filled", t_defaults=_DEFAULTS, t_filled=_FILLED))
def _(spark, sf_dir):
    table = materialize(_features(spark, sf_dir), "features")
    return V.backfill(_profiles(table), _defaults(table))


@query("j07_defaults_fill", sql("""SELECT race, gender, count(*) AS n FROM t_filled
    GROUP BY race, gender""", t_defaults=_DEFAULTS, t_filled=_FILLED))
def _(spark, sf_dir):
    table = materialize(_features(spark, sf_dir), "features")
    filled = V.backfill(_profiles(table), _defaults(table))
    return filled.groupBy("race", "gender").agg(F.count("*").alias("n"))


@query("v05_recompute_dependents", sql("""SELECT row_id,
    number_outpatient + number_emergency + number_inpatient AS total_prior_visits,
    CAST(a1c_tested = 1 AND a1c_abnormal = 1 AS INT) AS a1c_abnormal,
    CAST(glu_tested = 1 AND glu_abnormal = 1 AS INT) AS glu_abnormal,
    CAST(number_inpatient >= 2 AS INT) AS high_utilizer_flag FROM t_filled""",
    t_defaults=_DEFAULTS, t_filled=_FILLED))
def _(spark, sf_dir):
    table = materialize(_features(spark, sf_dir), "features")
    filled = V.backfill(_profiles(table), _defaults(table))
    return V.recompute_dependents(filled).select(
        S.ROW_ID, "total_prior_visits", "a1c_abnormal", "glu_abnormal", "high_utilizer_flag"
    )


_COHORT = """SELECT row_id, label, score, CAST(row_number() OVER
    (ORDER BY CAST(row_id AS BIGINT)) - 1 AS INT) AS position FROM t_test_scored
    ORDER BY CAST(row_id AS BIGINT) LIMIT 501"""


def _cohort(spark, sf_dir):
    return V.cohort(_test_scores(spark, sf_dir).select(S.ROW_ID, "label", "score"))


@query("k06_cohort", sql("SELECT row_id, label, round(score, 6) AS score, position FROM t_cohort",
                         t_cohort=_COHORT))
def _(spark, sf_dir):
    return rounded(_cohort(spark, sf_dir))


@query("k07_cohort_row", sql("""SELECT row_id, label, round(score, 6) AS score, position
    FROM t_cohort WHERE position = 10""", t_cohort=_COHORT))
def _(spark, sf_dir):
    return rounded(V.cohort_row(_cohort(spark, sf_dir), 10))


@query("v07_cohort_view", sql("""SELECT position, row_id, round(score, 6) AS score,
    CASE WHEN score >= 0.4::DOUBLE * 1.5 THEN 'High risk' WHEN score >= 0.4::DOUBLE
    THEN 'Watchlist' ELSE 'Lower risk' END AS risk_band, CASE WHEN label = 1
    THEN 'Readmitted < 30 Days' ELSE 'Not Readmitted / > 30 Days' END AS actual_outcome
    FROM t_cohort""", t_cohort=_COHORT))
def _(spark, sf_dir):
    return rounded(V.cohort_view(_test_scores(spark, sf_dir), 0.4))


@query("v08_overview", sql(f"""SELECT count(*) AS n_rows, {r6(f'avg({LABEL_CASE})')} AS base_rate,
    {S.EXPECTED_COLUMNS} AS n_columns FROM t_raw"""))
def _(spark, sf_dir):
    return rounded(V.overview(encounters(spark, sf_dir)))
