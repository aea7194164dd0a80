"""Building blocks of the SQL that the queries are checked against.

:func:`sql` puts the named tables a statement uses in front of it. The tables
restate the semantics in plain SQL and share only the rules of the test view
and the fixed values with the Spark side.
"""

from __future__ import annotations

import re

from caretide import schema as S
from caretide.sources.order_view import COLUMN_RULES, SCORE_RULES

CODE_COLUMNS = S.DIAGNOSES
TEXT_COLUMNS = [
    f.name for f in S.RAW_SCHEMA.fields if f.dataType.simpleString() == "string"
]


def q(name: str) -> str:
    return f'"{name}"'


def columns(names, prefix: str = "") -> str:
    return ", ".join(prefix + q(n) for n in names)


def values(items) -> str:
    return ", ".join(f"'{i}'" if isinstance(i, str) else str(i) for i in items)


def case_map(value: str, mapping: dict, default: str = "NULL") -> str:
    whens = " ".join(f"WHEN {values([k])} THEN {values([v])}" for k, v in mapping.items())
    return f"CASE {value} {whens} ELSE {default} END"


def r6(expression: str) -> str:
    return f"round(CAST({expression} AS DOUBLE), 6)"


def code_number(code: str) -> str:
    return f"TRY_CAST(upper(trim({code})) AS DOUBLE)"


def icd_group(code: str) -> str:
    number = code_number(code)
    whens = []
    for name, low, high, closed, single in S.DIAGNOSIS_GROUPS:
        test = f"({number} >= {low} AND {number} {'<=' if closed else '<'} {high})"
        if single:
            test += f" OR {number} = {single}"
        whens.append(f"WHEN {test} THEN '{name}'")
    return (
        f"CASE WHEN {code} IS NULL OR {code} IN ({values(S.MISSING_DIAGNOSES)}) THEN 'Missing' "
        f"WHEN upper(trim({code})) SIMILAR TO '[VE].*' THEN 'Other' {' '.join(whens)} "
        "ELSE 'Other' END"
    )


def category_flag(category: str) -> str:
    tests = [
        f"starts_with(upper(trim(coalesce({c}, ''))), '{p}')"
        for c in CODE_COLUMNS for p in S.COMORBIDITY_PREFIXES[category]
    ]
    return f"CAST({' OR '.join(tests)} AS INT)"


def comorbidity() -> str:
    terms = [
        f"{w} * {category_flag(c)}" for c, w in S.COMORBIDITY_WEIGHTS.items()
        if w and c in S.COMORBIDITY_PREFIXES
    ]
    return f"CAST({' + '.join(terms)} AS DOUBLE)"


BURDEN = " + ".join(
    f"CASE WHEN {q(m)} IN ('No', 'Steady') THEN 0 ELSE 1 END" for m in S.MEDICATIONS
)
ACTIVE = " + ".join(f"CASE WHEN {q(m)} = 'No' THEN 0 ELSE 1 END" for m in S.MEDICATIONS)
INSULIN = case_map("insulin", S.INSULIN_LEVELS, "0")
MIDPOINT = case_map("age", S.AGE_MIDPOINTS)
VISITS = " + ".join(f"coalesce({c}, 0)" for c in S.VISIT_COLUMNS)
UTILIZER = "CASE WHEN number_inpatient >= 2 THEN 1 ELSE 0 END"
DISCHARGE = "CASE " + " ".join(
    f"WHEN discharge_disposition_id IN ({values(ids)}) THEN '{name}'"
    for name, ids in S.DISCHARGE_GROUPS.items()
) + " ELSE 'Other' END"
ADMISSION = case_map("admission_type_id", S.ADMISSION_GROUPS, "'Other'")
SPECIALTY = (
    f"CASE WHEN medical_specialty IS NULL THEN 'Unknown' WHEN medical_specialty IN "
    f"({values(S.KEPT_SPECIALTIES)}) THEN medical_specialty ELSE 'Other' END"
)
FLAGS = {
    "change_binary": "CASE WHEN change = 'Ch' THEN 1 ELSE 0 END",
    "diabetesMed_binary": "CASE WHEN \"diabetesMed\" = 'Yes' THEN 1 ELSE 0 END",
}
LABS = {
    "a1c_tested": "CASE WHEN \"A1Cresult\" IS NOT NULL AND \"A1Cresult\" <> 'None' THEN 1 ELSE 0 END",
    "a1c_abnormal": "CASE WHEN \"A1Cresult\" IN ('>7', '>8') THEN 1 ELSE 0 END",
    "glu_tested": "CASE WHEN max_glu_serum IS NOT NULL AND max_glu_serum <> 'None' THEN 1 ELSE 0 END",
    "glu_abnormal": "CASE WHEN max_glu_serum IN ('>200', '>300') THEN 1 ELSE 0 END",
}
NOT_TERMINAL = (
    "(discharge_disposition_id IS NULL OR discharge_disposition_id NOT IN "
    f"({values(S.TERMINAL_DISPOSITIONS)}))"
)
LABEL_CASE = "CASE WHEN readmitted = '<30' THEN 1 ELSE 0 END"
LABEL_MAP = case_map("readmitted", S.LABEL_VALUES)

_RAW_RULES = {c: COLUMN_RULES[c] for c in S.RAW_COLUMNS}


def _select(rules: dict[str, str]) -> str:
    return ", ".join(f"{rule} AS {q(name)}" for name, rule in rules.items())


_KEPT = [c for c in S.RAW_COLUMNS
         if c not in (*S.SPARSE_COLUMNS, "encounter_id", "patient_nbr", S.RAW_LABEL)]
_GROUPS = {f"{c}_group": icd_group(c) for c in S.DIAGNOSES}
_SPLIT = """CASE WHEN r <= (15 * n + 99) // 100 THEN 'test'
    WHEN r <= (15 * n + 99) // 100 + (15 * n + 99) // 100 THEN 'val' ELSE 'train' END"""
SEEDED = f"md5('{S.SEED}:' || row_id)"

# Stand-in coefficients of a linear model over the numerics, as fixed numbers.
COEFFICIENTS = {c: ((7 * i) % 11 - 4.5) / 10 for i, c in enumerate(S.NUMERIC)}
_IMPACTS = " UNION ALL ".join(
    f"SELECT row_id, '{c}' AS feature, coalesce({c}, 0)::DOUBLE AS value, "
    f"{w}::DOUBLE * (coalesce({c}, 0) - avg(coalesce({c}, 0)) OVER ()) AS impact FROM t_model"
    for c, w in COEFFICIENTS.items()
)

# Named tables in dependency order.
TABLES: dict[str, str] = {
    "t_base": """SELECT o_orderkey AS k, o_custkey AS c, o_orderpriority AS p,
        o_orderdate AS d, lead(o_orderdate) OVER
        (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS nx FROM orders""",
    "t_lines": "SELECT l_orderkey AS k, count(*) AS n FROM lineitem GROUP BY 1",
    "t_order": """SELECT b.k, b.c, b.p, cu.c_nationkey AS nation, l.n,
        CASE WHEN nx IS NULL THEN 'NO' WHEN nx <= d + INTERVAL '30' DAY THEN '<30'
        ELSE '>30' END AS readmitted
        FROM t_base b JOIN customer cu ON cu.c_custkey = b.c LEFT JOIN t_lines l ON l.k = b.k""",
    "t_raw": f"SELECT {_select(_RAW_RULES)} FROM t_order",
    "t_null": "SELECT * REPLACE (" + ", ".join(
        f"nullif({q(c)}, '?') AS {q(c)}" for c in TEXT_COLUMNS) + ") FROM t_raw",
    "t_labeled": f"SELECT *, {LABEL_MAP} AS readmitted_binary FROM t_null",
    "t_eligible": f"SELECT * FROM t_null WHERE {NOT_TERMINAL}",
    "t_first": """SELECT * FROM t_eligible QUALIFY row_number() OVER
        (PARTITION BY patient_nbr ORDER BY CAST(encounter_id AS BIGINT)) = 1""",
    "t_clean": f"""SELECT encounter_id AS row_id, {columns(_KEPT)},
        {LABEL_CASE} AS {S.LABEL} FROM t_first""",
    "t_grouped": f"SELECT *, {_select(_GROUPS)} FROM t_clean",
    "t_engineered": f"""SELECT * EXCLUDE ({columns(S.MEDICATIONS)})
        REPLACE (coalesce(race, 'Unknown') AS race),
        CAST('Diabetes' IN (diag_1_group, diag_2_group, diag_3_group) AS INT) AS has_diabetes_diag,
        {MIDPOINT} AS age_midpoint, {VISITS} AS total_prior_visits,
        {UTILIZER} AS high_utilizer_flag, {BURDEN} AS polypharmacy_score,
        {ACTIVE} AS num_active_medications, {INSULIN} AS insulin_intensity,
        {_select(FLAGS)}, {_select(LABS)}, {DISCHARGE} AS discharge_category,
        {ADMISSION} AS admission_category, {SPECIALTY} AS medical_specialty_grouped,
        {comorbidity()} AS elixhauser_score FROM t_grouped""",
    "t_model": f"SELECT row_id, {columns(S.FEATURES)}, {S.LABEL} FROM t_engineered",
    "t_impacts": _IMPACTS,
    "t_importance": "SELECT feature, avg(abs(impact)) AS importance FROM t_impacts GROUP BY 1",
    "t_ranked": f"""SELECT *, row_number() OVER
        (PARTITION BY {S.LABEL} ORDER BY {SEEDED}) AS r,
        count(*) OVER (PARTITION BY {S.LABEL}) AS n FROM t_engineered""",
    "t_split": f"SELECT * EXCLUDE (r, n), {_SPLIT} AS split FROM t_ranked",
    "t_lookup_rows": """SELECT 'admission_type_id' AS id_column,
        CAST(r_regionkey + 1 AS INT) AS id, r_name AS description FROM region
        UNION ALL SELECT 'discharge_disposition_id', CAST(p_size AS INT),
        min(p_type) || ', ' || max(p_brand) FROM part GROUP BY p_size
        UNION ALL SELECT 'admission_source_id', CAST(n_nationkey + 1 AS INT), n_name
        FROM nation""",
    "t_decoded": """SELECT r.*, a.description AS admission_type_id_label,
        d.description AS discharge_disposition_id_label,
        s.description AS admission_source_id_label FROM t_labeled r
        LEFT JOIN t_lookup_rows a ON a.id_column = 'admission_type_id'
            AND a.id = r.admission_type_id
        LEFT JOIN t_lookup_rows d ON d.id_column = 'discharge_disposition_id'
            AND d.id = r.discharge_disposition_id
        LEFT JOIN t_lookup_rows s ON s.id_column = 'admission_source_id'
            AND s.id = r.admission_source_id""",
    "t_wide_scores": f"""SELECT encounter_id AS row_id, {LABEL_CASE} AS label,
        race, gender, age, score, score_b FROM (SELECT {_select(
            {**{c: COLUMN_RULES[c] for c in ('encounter_id', 'race', 'gender', 'age', 'readmitted')},
             **SCORE_RULES})} FROM t_order)""",
    "t_scored": """SELECT row_id, label, race, gender, age, 'Boosted Trees' AS model, score
        FROM t_wide_scores UNION ALL SELECT row_id, label, race, gender, age,
        'Logistic Regression', score_b FROM t_wide_scores""",
    "t_points": """SELECT model, score, sum(label) AS pos, sum(1 - label) AS neg
        FROM t_scored GROUP BY model, score""",
    "t_curve": """SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
        sum(pos) OVER (PARTITION BY model) AS pos_total,
        sum(neg) OVER (PARTITION BY model) AS neg_total,
        lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg FROM t_points
        WINDOW w AS (PARTITION BY model ORDER BY score DESC)""",
    "t_cost": f"""SELECT model, score AS threshold, 5.0::DOUBLE * (pos_total - tp) + fp AS cost
        FROM t_curve UNION ALL SELECT model, {S.ALERT_NOBODY}::DOUBLE,
        max(5.0::DOUBLE * pos_total) FROM t_curve GROUP BY model""",
    "t_threshold": """SELECT model, threshold, cost FROM t_cost QUALIFY row_number()
        OVER (PARTITION BY model ORDER BY cost, threshold) = 1""",
    "t_predicted": """SELECT s.*, t.threshold, CAST(s.score >= t.threshold AS INT) AS predicted
        FROM t_scored s JOIN t_threshold t USING (model)""",
    "t_counts": """SELECT model, count(*) FILTER (label = 0 AND predicted = 0) AS tn,
        count(*) FILTER (label = 0 AND predicted = 1) AS fp,
        count(*) FILTER (label = 1 AND predicted = 0) AS fn,
        count(*) FILTER (label = 1 AND predicted = 1) AS tp
        FROM t_predicted GROUP BY model""",
    "t_auroc": """SELECT model, CAST(sum(pos * (neg_total - fp + neg / 2.0::DOUBLE)) AS DOUBLE)
        / (max(pos_total) * max(neg_total)) AS auroc,
        sum(pos::DOUBLE / pos_total * (tp::DOUBLE / (tp + fp))) AS auprc
        FROM t_curve GROUP BY model""",
    "t_metrics": """SELECT model, auroc AS AUROC, auprc AS AUPRC,
        coalesce(2.0::DOUBLE * tp / nullif(2 * tp + fp + fn, 0), 0) AS F1, brier AS Brier,
        coalesce(tp::DOUBLE / nullif(tp + fn, 0), 0) AS Sensitivity,
        coalesce(tn::DOUBLE / nullif(tn + fp, 0), 0) AS Specificity,
        coalesce(tp::DOUBLE / nullif(tp + fp, 0), 0) AS PPV,
        coalesce(tn::DOUBLE / nullif(tn + fn, 0), 0) AS NPV, threshold AS Opt_Threshold
        FROM t_counts JOIN t_auroc USING (model) JOIN t_threshold USING (model)
        JOIN (SELECT model, avg((score - label) * (score - label)) AS brier
        FROM t_scored GROUP BY model) USING (model)""",
    # the audit runs on the test split of the cleaned table
    "t_test_scored": """SELECT s.row_id, s.label, s.score, p.race, p.gender, p.age
        FROM t_wide_scores s JOIN t_split p ON p.row_id = s.row_id WHERE p.split = 'test'""",
    "t_cases": """SELECT outcome, row_id, label, score FROM (SELECT *,
        CASE WHEN score > 0.1::DOUBLE AND label = 1 THEN 'TP'
        WHEN score <= 0.1::DOUBLE AND label = 0 THEN 'TN'
        WHEN score > 0.1::DOUBLE AND label = 0 THEN 'FP' END AS outcome
        FROM t_test_scored) WHERE outcome IS NOT NULL QUALIFY row_number() OVER
        (PARTITION BY outcome ORDER BY CAST(row_id AS BIGINT)) = 1""",
    "t_members": """SELECT 'Race' AS Attribute, race AS Subgroup, label, score FROM t_test_scored
        UNION ALL SELECT 'Gender', gender, label, score FROM t_test_scored
        UNION ALL SELECT 'Age', age, label, score FROM t_test_scored""",
    "t_audit_cut": """SELECT threshold AS cut FROM t_threshold WHERE model = 'Boosted Trees'""",
    "t_group_pairs": """SELECT a.Attribute, a.Subgroup, avg(CASE WHEN a.score > b.score THEN 1.0
        WHEN a.score = b.score THEN 0.5 ELSE 0 END::DOUBLE) AS AUROC
        FROM t_members a JOIN t_members b USING (Attribute, Subgroup)
        WHERE a.label = 1 AND b.label = 0 GROUP BY 1, 2""",
    "t_audit": """SELECT m.Attribute, m.Subgroup, count(*) AS N, max(g.AUROC) AS AUROC,
        coalesce(count(*) FILTER (label = 1 AND score >= cut)
            / nullif(count(*) FILTER (label = 1), 0)::DOUBLE, 0) AS TPR,
        coalesce(count(*) FILTER (label = 0 AND score >= cut)
            / nullif(count(*) FILTER (label = 0), 0)::DOUBLE, 0) AS FPR,
        coalesce(count(*) FILTER (label = 1 AND score >= cut)
            / nullif(count(*) FILTER (score >= cut), 0)::DOUBLE, 0) AS PPV
        FROM t_members m LEFT JOIN t_group_pairs g USING (Attribute, Subgroup), t_audit_cut
        WHERE m.Subgroup IS NOT NULL GROUP BY m.Attribute, m.Subgroup""",
}
_NAMES = re.compile(r"\bt_[a-z_]+\b")


def sql(body: str, **extra: str) -> str:
    """``body`` with the tables it uses, directly or not, in a WITH clause."""
    tables = {**TABLES, **extra}
    needed: set[str] = set()
    open_names = set(_NAMES.findall(body))
    while open_names:
        name = open_names.pop()
        if name in tables and name not in needed:
            needed.add(name)
            open_names |= set(_NAMES.findall(tables[name]))
    order = [*[n for n in tables if n not in extra or n in TABLES], *extra]
    parts = [f"{n} AS MATERIALIZED ({tables[n]})" for n in order if n in needed]
    return f"WITH {', '.join(parts)} {body}" if parts else body
