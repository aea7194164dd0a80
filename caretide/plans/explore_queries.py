"""Exploratory queries: rates, histograms, correlation, top-k, joins, sets."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide import schema as S
from caretide.functions import clinical as C
from caretide.operators import clean as CL, explore as X, sketch as K
from caretide.plans import tables as T
from caretide.plans.oracle import ACTIVE, BURDEN, VISITS, q, r6, sql
from caretide.plans.registry import query, rounded
from caretide.session import materialize
from caretide.sources.lookups import decode_ids
from caretide.sources.order_view import encounters

_BIN = "readmitted_binary"
_DEMOGRAPHICS = ["race", "gender", "age", "admission_type_id"]
_CATEGORIES = [
    "race", "gender", "age", "A1Cresult", "max_glu_serum", "change", "diabetesMed",
    "admission_type_id_label", "discharge_disposition_id_label",
    "admission_source_id_label",
]
_CORRELATED = [*S.RAW_NUMERIC, _BIN]


def _union(columns, table, kind="VARCHAR"):
    return " UNION ALL ".join(
        f"SELECT '{c}' AS attribute, CAST({q(c)} AS {kind}) AS value FROM {table}"
        for c in columns
    )


def _rate(key, name="value", table="t_labeled"):
    return (f"SELECT {q(key)} AS {name}, {r6(f'avg({_BIN})')} AS rate, count(*) AS n "
            f"FROM {table} WHERE {q(key)} IS NOT NULL GROUP BY 1")


@query("flagship_rate_by_age", sql(f"""SELECT age AS value, {r6(f'avg({S.LABEL})')} AS rate,
    count(*) AS n FROM t_clean WHERE age IS NOT NULL GROUP BY age"""))
def _(spark, sf_dir):
    columns = ["encounter_id", "patient_nbr", "age", "discharge_disposition_id", S.RAW_LABEL]
    df = CL.clean(encounters(spark, sf_dir, columns))
    return rounded(X.rate_by(df, "age", S.LABEL))


@query("a01_missing_percent", sql("SELECT \"column\", round(p, 6) AS missing_pct FROM (" + " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", avg(CAST({q(c)} IS NULL AS INT)) * 100 AS p FROM t_null"
    for c in S.RAW_COLUMNS) + ") WHERE p > 0"))
def _(spark, sf_dir):
    return rounded(X.missing_percent(T.loaded(spark, sf_dir)))


@query("a02_label_shares", sql("""SELECT readmitted, count(*) AS n,
    round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM t_null), 6) AS pct FROM t_null
    GROUP BY readmitted"""))
def _(spark, sf_dir):
    return rounded(X.label_shares(T.loaded(spark, sf_dir, S.RAW_LABEL)))


@query("a03_class_balance", sql("""SELECT count(*) FILTER (readmitted_binary = 0) AS negatives,
    count(*) FILTER (readmitted_binary = 1) AS positives,
    round(count(*) FILTER (readmitted_binary = 0)::DOUBLE
        / count(*) FILTER (readmitted_binary = 1), 6) AS imbalance_ratio,
    round(count(*) FILTER (readmitted_binary = 1) * 100.0::DOUBLE / count(*), 6)
        AS positive_pct FROM t_labeled"""))
def _(spark, sf_dir):
    return rounded(X.class_balance(T.labeled(spark, sf_dir), _BIN))


@query("a04_rate_by_race", sql(_rate("race")))
def _(spark, sf_dir):
    return rounded(X.rate_by(T.labeled(spark, sf_dir, "race"), "race", _BIN))


@query("a05_rate_by_demographics", sql(f"""SELECT attribute, value, {r6(f'avg({_BIN})')} AS rate,
    count(*) AS n, (SELECT {r6(f'avg({_BIN})')} FROM t_labeled) AS overall_rate FROM (""" + " UNION ALL ".join(
    f"SELECT '{c}' AS attribute, CAST({c} AS VARCHAR) AS value, {_BIN} FROM t_labeled"
    for c in _DEMOGRAPHICS) + ") WHERE value IS NOT NULL GROUP BY attribute, value"))
def _(spark, sf_dir):
    df = T.labeled(spark, sf_dir, *_DEMOGRAPHICS)
    return rounded(X.rate_by_attributes(df, _DEMOGRAPHICS, _BIN))


@query("a06_histograms", sql(f"""SELECT attribute, CAST((SELECT count(*) FROM range(1, 30) t(i)
    WHERE low + i * width <= value) AS INT) AS bin, count(*) AS n FROM t_values
    JOIN t_limits USING (attribute) GROUP BY 1, 2""",
    t_values=f"SELECT * FROM ({_union(S.RAW_NUMERIC, 't_null', 'DOUBLE')}) WHERE value IS NOT NULL",
    t_limits="""SELECT attribute, min(value) AS low, (max(value) - min(value)) / 30 AS width
        FROM t_values GROUP BY attribute"""))
def _(spark, sf_dir):
    return X.histograms(T.loaded(spark, sf_dir, *S.RAW_NUMERIC)).drop("bin_low")


@query("a07_top_values", sql(f"""SELECT attribute, value, count(*) AS n, CAST(row_number() OVER
    (PARTITION BY attribute ORDER BY count(*) DESC, value ASC NULLS LAST) AS INT) AS rank
    FROM ({_union(_CATEGORIES, 't_decoded')}) GROUP BY attribute, value QUALIFY rank <= 10"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, *_CATEGORIES[:7], *S.ID_COLUMNS)
    return X.top_values(decode_ids(df, T.lookups(spark, sf_dir)), _CATEGORIES)


@query("a08_burden_distribution",
       sql(f"SELECT {BURDEN} AS score, count(*) AS n FROM t_null GROUP BY 1"))
def _(spark, sf_dir):
    return X.burden_distribution(T.loaded(spark, sf_dir, *S.MEDICATIONS))


@query("a09_active_distribution",
       sql(f"SELECT {ACTIVE} AS active, count(*) AS n FROM t_null GROUP BY 1"))
def _(spark, sf_dir):
    return X.active_distribution(T.loaded(spark, sf_dir, *S.MEDICATIONS))


@query("a10_top_code_rates", sql(_rate("diag_1", "diag_1") + " ORDER BY n DESC, diag_1 LIMIT 20"))
def _(spark, sf_dir):
    return rounded(X.top_key_rates(T.labeled(spark, sf_dir, "diag_1"), "diag_1", _BIN))


@query("a11_correlations", sql("SELECT \"row\", \"column\", round(c, 6) AS corr FROM (" + " UNION ALL ".join(
    f"SELECT '{b}' AS \"row\", '{a}' AS \"column\", corr({a}, {b}) AS c FROM t_labeled"
    for i, a in enumerate(_CORRELATED) for b in _CORRELATED[i + 1:]) + ")"))
def _(spark, sf_dir):
    return rounded(X.correlations(T.labeled(spark, sf_dir, *S.RAW_NUMERIC), _CORRELATED))


@query("a12_rate_by_disposition", sql(
    _rate("discharge_disposition_id_label", "disposition", "t_decoded")
    + " ORDER BY rate DESC, disposition LIMIT 15"))
def _(spark, sf_dir):
    df = T.labeled(spark, sf_dir, "discharge_disposition_id")
    named = decode_ids(df, T.lookups(spark, sf_dir), ["discharge_disposition_id"])
    rates = rounded(X.rate_by(named, "discharge_disposition_id_label", _BIN, "disposition"))
    return rates.orderBy(F.desc("rate"), "disposition").limit(15)


@query("a13_rate_by_inpatient", sql(_rate("number_inpatient")))
def _(spark, sf_dir):
    df = T.labeled(spark, sf_dir, "number_inpatient")
    return rounded(X.rate_by(df, "number_inpatient", _BIN)).orderBy("value")


@query("a14_rate_by_age", sql(_rate("age").replace(
    "SELECT", "SELECT CAST(regexp_extract(age, '(\\d+)', 1) AS INT) AS lower_bound,", 1)
    + ", 2"))
def _(spark, sf_dir):
    rates = rounded(X.rate_by(T.labeled(spark, sf_dir, "age"), "age", _BIN))
    return rates.withColumn("lower_bound", C.age_lower_bound(F.col("value"))).orderBy("lower_bound")


@query("a15_rate_by_a1c", sql(_rate("A1Cresult")))
def _(spark, sf_dir):
    return rounded(X.rate_by(T.labeled(spark, sf_dir, "A1Cresult"), "A1Cresult", _BIN))


@query("a16_leakage_audit", sql(f"""SELECT count(*) FILTER (t) AS n_terminal,
    round(count(*) FILTER (t) * 100.0::DOUBLE / count(*), 6) AS pct_terminal,
    CAST(sum(CASE WHEN t THEN {_BIN} ELSE 0 END) AS BIGINT) AS label_sum FROM
    (SELECT {_BIN}, coalesce(discharge_disposition_id IN (11, 13, 14, 19, 20, 21), FALSE) AS t
    FROM t_labeled)"""))
def _(spark, sf_dir):
    return rounded(X.leakage_audit(T.labeled(spark, sf_dir, "discharge_disposition_id"), _BIN))


@query("a17_patient_duplicates", sql("""SELECT count(*) AS encounters,
    count(DISTINCT patient_nbr) AS patients, count(*) - count(DISTINCT patient_nbr) AS repeats,
    round((count(*) - count(DISTINCT patient_nbr)) * 100.0::DOUBLE / count(*), 6) AS repeat_pct
    FROM t_null"""))
def _(spark, sf_dir):
    return rounded(X.patient_duplicates(T.loaded(spark, sf_dir, "patient_nbr")))


_COUNTED = ["patient_nbr", "diag_1", "medical_specialty"]
_SHARES = [0.25, 0.5, 0.75]


@query("a17b_sketched_distinct")
def _(spark, sf_dir):
    """Distinct patients, first diagnoses and specialties from stored sketches, one for each
    kind of admission, merged: estimates and their stated error."""
    df = T.loaded(spark, sf_dir, *_COUNTED, "admission_type_id")
    sketches = materialize(K.distinct_sketches(df, _COUNTED, "admission_type_id"), "sketches")
    return K.distinct_estimates(sketches).withColumn("stated_error", F.lit(K.DISTINCT_ERROR))


@query("a17c_sketch_errors", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS attribute, count({q(c)}) AS n, count(DISTINCT {q(c)}) AS exact, "
    f"1 AS within_error FROM t_null" for c in _COUNTED)))
def _(spark, sf_dir):
    """The merged estimates beside the exact counts: none is off by more than is stated."""
    df = materialize(T.loaded(spark, sf_dir, *_COUNTED, "admission_type_id"), "counted")
    sketches = materialize(K.distinct_sketches(df, _COUNTED, "admission_type_id"), "sketches")
    exact = df.select(*_COUNTED).selectExpr(*[f"string(`{c}`) as `{c}`" for c in _COUNTED]).unpivot(
        [], _COUNTED, "attribute", "value").groupBy("attribute").agg(
        F.count_distinct("value").alias("exact"))
    off = F.abs(F.col("distinct") - F.col("exact"))
    return K.distinct_estimates(sketches).join(exact, "attribute").select(
        "attribute", "n", "exact",
        (off <= F.greatest(F.lit(1.0), F.col("exact") * K.DISTINCT_ERROR)).cast("int")
        .alias("within_error"))


@query("a18_describe_encounters", sql("""SELECT count(*) AS "count", round(avg(n), 6) AS mean,
    round(stddev_samp(n), 6) AS std, min(n) AS "min", max(n) AS "max",
    round(quantile_cont(n::DOUBLE, 0.25), 6) AS q25, round(quantile_cont(n::DOUBLE, 0.5), 6) AS q50,
    round(quantile_cont(n::DOUBLE, 0.75), 6) AS q75
    FROM (SELECT count(*) AS n FROM t_null GROUP BY patient_nbr)"""))
def _(spark, sf_dir):
    return rounded(X.describe_group_sizes(T.loaded(spark, sf_dir, "patient_nbr")))


@query("a19_encounters_per_patient", sql("""SELECT size, count(*) AS n FROM
    (SELECT count(*) AS size FROM t_null GROUP BY patient_nbr) GROUP BY size
    ORDER BY size LIMIT 15"""))
def _(spark, sf_dir):
    return X.group_size_head(T.loaded(spark, sf_dir, "patient_nbr"))


@query("a21_medians", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", {r6(f'median({q(c)}::DOUBLE)')} AS median FROM t_model"
    for c in S.NUMERIC + S.BINARY)))
def _(spark, sf_dir):
    return rounded(X.medians(T.modelling(spark, sf_dir), S.NUMERIC + S.BINARY))


@query("a21b_sketched_quantiles")
def _(spark, sf_dir):
    """Quartiles of the numeric columns from stored sketches, one for each kind of admission."""
    df = T.loaded(spark, sf_dir, *S.RAW_NUMERIC, "admission_type_id")
    sketches = materialize(
        K.quantile_sketches(df, S.RAW_NUMERIC, "admission_type_id"), "sketches")
    return K.quantile_estimates(sketches, _SHARES)


@query("a21c_quantile_errors", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS attribute, {p}::DOUBLE AS share, count({q(c)}) AS n, 1 AS within_error, "
    f"1 AS is_a_value FROM t_null" for c in S.RAW_NUMERIC for p in _SHARES)))
def _(spark, sf_dir):
    """The exact rank of no estimate is off by more than is stated; estimates are values that
    stand in the column."""
    df = materialize(T.loaded(spark, sf_dir, *S.RAW_NUMERIC, "admission_type_id"), "numbers")
    sketches = materialize(
        K.quantile_sketches(df, S.RAW_NUMERIC, "admission_type_id"), "sketches")
    found = materialize(K.quantile_estimates(sketches, _SHARES), "quantiles")
    return found.join(K.rank_errors(df, found).drop("value"), ["attribute", "share"]).select(
        "attribute", "share", "n",
        (F.col("rank_error") <= K.RANK_ERROR).cast("int").alias("within_error"),
        (F.col("n_equal") > 0).cast("int").alias("is_a_value"))


@query("a22_modes", sql(" UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", (SELECT CAST({q(c)} AS VARCHAR) FROM t_null WHERE {q(c)} IS NOT NULL "
    f"GROUP BY {q(c)} ORDER BY count(*) DESC, CAST({q(c)} AS VARCHAR) LIMIT 1) AS mode"
    for c in [*_CATEGORIES[:7], "diag_1", "diag_2", "medical_specialty"])))
def _(spark, sf_dir):
    names = [*_CATEGORIES[:7], "diag_1", "diag_2", "medical_specialty"]
    return X.modes(T.loaded(spark, sf_dir, *names), names)


@query("a23_distinct_values", sql(f"""SELECT attribute, value, CAST(row_number() OVER (PARTITION BY
    attribute ORDER BY TRY_CAST(value AS BIGINT) NULLS FIRST, value) AS INT) AS position
    FROM (SELECT DISTINCT * FROM ({_union(S.FORM_OPTIONS, 't_model')}) WHERE value IS NOT NULL)"""))
def _(spark, sf_dir):
    return X.distinct_values(T.modelling(spark, sf_dir), S.FORM_OPTIONS)


# --- joins, top-k, sets, reshaping -------------------------------------------


@query("j01_lookup_join", sql("""SELECT admission_source_id_label AS label, count(*) AS n
    FROM t_decoded GROUP BY 1"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, "admission_source_id")
    named = decode_ids(df, T.lookups(spark, sf_dir), ["admission_source_id"])
    return named.groupBy(F.col("admission_source_id_label").alias("label")).agg(
        F.count("*").alias("n")
    )


@query("j03_semi_join", sql("""SELECT patient_nbr, count(*) AS n FROM t_null WHERE patient_nbr IN
    (SELECT patient_nbr FROM t_null WHERE discharge_disposition_id IN (11, 13, 14, 19, 20, 21))
    GROUP BY patient_nbr"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, "patient_nbr", "discharge_disposition_id")
    ended = df.where(CL.is_terminal()).select("patient_nbr").distinct()
    return CL.keep_values(df, ended, "patient_nbr").groupBy("patient_nbr").agg(
        F.count("*").alias("n")
    )


@query("k01_top_codes", sql("""SELECT diag_1, count(*) AS n FROM t_null WHERE diag_1 IS NOT NULL
    GROUP BY diag_1 ORDER BY n DESC, diag_1 LIMIT 20"""))
def _(spark, sf_dir):
    return X.top_keys(T.loaded(spark, sf_dir, "diag_1"), "diag_1")


@query("u02_value_difference", sql("""SELECT DISTINCT diag_1 AS code FROM t_null
    WHERE diag_1 NOT IN (SELECT diag_2 FROM t_null WHERE diag_2 IS NOT NULL)"""))
def _(spark, sf_dir):
    df = T.loaded(spark, sf_dir, "diag_1", "diag_2")
    return X.value_difference(df, "diag_1", "diag_2").withColumnRenamed("value", "code")


@query("w02_top_three_per_attribute", sql(f"""SELECT attribute, value, n, rank FROM
    (SELECT attribute, value, count(*) AS n, CAST(row_number() OVER (PARTITION BY attribute
    ORDER BY count(*) DESC, value ASC NULLS LAST) AS INT) AS rank
    FROM ({_union(S.DIAGNOSES, 't_null')}) GROUP BY 1, 2) WHERE rank <= 3"""))
def _(spark, sf_dir):
    return X.top_values(T.loaded(spark, sf_dir, *S.DIAGNOSES), S.DIAGNOSES, 3)


@query("w04_share_of_total", sql("""SELECT attribute, value, round(n * 100.0::DOUBLE
    / sum(n) OVER (PARTITION BY attribute), 6) AS pct FROM (SELECT attribute, value, count(*) AS n
    FROM (""" + _union(["race", "gender", "age"], "t_null") + ") GROUP BY 1, 2)"))
def _(spark, sf_dir):
    names = ["race", "gender", "age"]
    return rounded(X.value_shares(T.loaded(spark, sf_dir, *names), names)).drop("n")
