"""Encounter, lookup and score tables derived from the order tables.

One encounter per order: the order is the encounter, its customer the patient,
and the label follows from the gap to the customer's next order. See
``FIXTURES.md`` for the rules.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.window import Window

from caretide import schema as S

_DIAGNOSIS_FACTORS = [37, 53, 71]


def _diagnosis(j: int) -> str:
    return f"""case (k + 7*{j}) % 20 when 0 then '250.' || cast(k % 100 as string)
        when 1 then 'V45' when 2 then 'E900' when 3 then '?' when 4 then '459.81'
        when 5 then '428' when 6 then '250D' when 7 then '276'
        else cast(140 + (k*{_DIAGNOSIS_FACTORS[j - 1]}) % 860 as string) end"""


def _dose(i: int) -> str:
    s = f"((k*{2 * i + 3} + {i * i}) % 11)"
    return f"""case when k % 101 = {i} then null when {s} < 8 then 'No'
        when {s} = 8 then 'Steady' when {s} = 9 then 'Up' else 'Down' end"""


# Rules of the view, as SQL text over: k order key, c customer key, n line
# count, p order priority, nation customer's nation, readmitted the label.
COLUMN_RULES: dict[str, str] = {
    "encounter_id": "cast(k as string)",
    "patient_nbr": "cast(c as string)",
    "race": """case c % 7 when 0 then 'AfricanAmerican' when 1 then 'Asian'
        when 2 then 'Hispanic' when 3 then 'Other' when 4 then null
        else 'Caucasian' end""",
    "gender": "case when c % 2 = 0 then 'Female' else 'Male' end",
    "age": """'[' || cast(c % 10 * 10 as string) || '-'
        || cast(c % 10 * 10 + 10 as string) || ')'""",
    "weight": "case when k % 33 = 0 then '[75-100)' else '?' end",
    "admission_type_id": "cast(substr(p, 1, 1) as int)",
    "discharge_disposition_id":
        "cast(case when k % 97 = 0 then null else 1 + (k*7) % 30 end as int)",
    "admission_source_id": "cast(1 + nation as int)",
    "time_in_hospital": "cast(1 + (k*17) % 14 as int)",
    "payer_code": "case when k % 5 < 2 then '?' else 'MC' end",
    "medical_specialty": """case k % 9 when 0 then '?' when 1 then 'InternalMedicine'
        when 2 then 'Emergency/Trauma' when 3 then 'Family/GeneralPractice'
        when 4 then 'Cardiology' when 5 then 'Surgery-General'
        when 6 then 'Nephrology' when 7 then '?' else 'Urology' end""",
    "num_lab_procedures": "cast(1 + (k*13) % 120 as int)",
    "num_procedures": "cast(k % 7 as int)",
    "num_medications": "cast(1 + coalesce(n, 0) as int)",
    "number_outpatient":
        "cast(case when k % 89 = 0 then null else (k*3) % 11 end as int)",
    "number_emergency": "cast((k*5) % 4 as int)",
    "number_inpatient": """cast(case when k % 83 = 0 then null
        when (k*11) % 10 < 6 then 0 else (k*11) % 10 - 5 end as int)""",
    **{f"diag_{j}": _diagnosis(j) for j in (1, 2, 3)},
    "number_diagnoses": "cast(1 + k % 16 as int)",
    "max_glu_serum": """case k % 4 when 0 then '>200' when 1 then '>300'
        when 2 then 'Norm' else 'None' end""",
    "A1Cresult": """case k % 5 when 0 then '>7' when 1 then '>8'
        when 2 then 'Norm' else 'None' end""",
    **{name: _dose(i) for i, name in enumerate(S.MEDICATIONS)},
    "change": "case when k % 2 = 0 then 'Ch' else 'No' end",
    "diabetesMed": "case when k % 4 = 0 then 'No' else 'Yes' end",
    "readmitted": "readmitted",
}
SCORE_RULES = {
    "score": """(cast((k*7919) % 1000 as double)
        + case when readmitted = '<30' then 150 else 0 end) / 1200""",
    "score_b": """(cast((k*104729) % 997 as double)
        + case when readmitted = '<30' then 250 else 0 end) / 1300""",
}
_USES_LABEL = {"readmitted", *SCORE_RULES}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _with_label(orders: DataFrame, every: DataFrame) -> DataFrame:
    """Add ``readmitted`` from the gap to the customer's next order among ``every`` order.

    Orders of one day follow each other, so only a day's last order needs the
    next day. That makes the window run over one row per customer and day,
    however many orders a customer has.
    """
    days = every.groupBy("c", "day").agg(F.max("k").alias("last_k"))
    in_order = Window.partitionBy("c").orderBy("day")
    days = days.withColumn("next_day", F.lead("day").over(in_order))
    next_day = F.when(F.col("k") < F.col("last_k"), F.col("day")).otherwise(
        F.col("next_day")
    )
    label = (
        F.when(next_day.isNull(), "NO")
        .when(next_day <= F.col("day") + F.expr("interval '30' day"), "<30")
        .otherwise(">30")
    )
    return orders.join(days, ["c", "day"]).withColumn("readmitted", label)


def encounters(spark: SparkSession, sf_dir: str, columns: list[str] | None = None,
               chosen: DataFrame | None = None, labelled: bool = False) -> DataFrame:
    """The raw encounter table, or some of its columns.

    With ``chosen``, a table of one column, only encounters whose id is in it: other orders
    are left out before columns are derived, but still end the gap of an earlier order.
    Orders without a day or customer have no label; ``labelled`` leaves them out even where
    no column needs it.

    Orders are joined to their customers, and to line counts and the next order's
    day where a column needs them. A customer with very many orders is one key of
    the first join only; adaptive execution splits it over tasks.
    """
    wanted = columns or S.RAW_COLUMNS
    rules = {**COLUMN_RULES, **SCORE_RULES}
    base = _table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("k"),
        F.col("o_custkey").alias("c"),
        F.col("o_orderdate").alias("day"),
        F.col("o_orderpriority").alias("p"),
    )
    orders = base
    if chosen is not None:
        ids = chosen.toDF("chosen")
        own = F.expr(rules["encounter_id"])
        base = base.join(ids, own.eqNullSafe(F.col("chosen")), "left_semi")
    if _USES_LABEL & set(wanted):
        base = _with_label(base, orders)
    elif labelled:
        base = base.dropna(subset=["c", "day"])
    customers = _table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("c"), F.col("c_nationkey").alias("nation")
    )
    base = base.join(customers, "c")
    if "num_medications" in wanted:
        lines = (
            _table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("k"))
            .agg(F.count("*").alias("n"))
        )
        base = base.join(lines, "k", "left")
    return base.selectExpr(*[f"{rules[name]} as `{name}`" for name in wanted])


def lookup_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a sectioned lookup file: ``(file, line_no, line)``.

    Admission types come from regions, sources from nations and dispositions
    from part sizes; the descriptions hold commas and quotes.
    """
    regions = _table(spark, sf_dir, "region").select(
        F.lit(0).alias("section"), (F.col("r_regionkey") + 1).alias("id"),
        F.col("r_name").alias("text"),
    )
    dispositions = (
        _table(spark, sf_dir, "part").groupBy("p_size")
        .agg(F.min("p_type").alias("type"), F.max("p_brand").alias("brand"))
        .select(
            F.lit(1).alias("section"), F.col("p_size").alias("id"),
            F.concat(F.lit('"'), "type", F.lit(", "), "brand", F.lit('"')).alias("text"),
        )
    )
    sources = _table(spark, sf_dir, "nation").select(
        F.lit(2).alias("section"), (F.col("n_nationkey") + 1).alias("id"),
        F.col("n_name").alias("text"),
    )
    rows = regions.unionByName(dispositions).unionByName(sources).select(
        "section", F.col("id").cast("int").alias("id"),
        F.concat_ws(",", "id", "text").alias("line"),
    )
    framing = [
        line
        for section, name in enumerate(S.ID_COLUMNS)
        for line in ((section, -2, "," if section == 2 else ""),
                     (section, -1, f"{name},description"))
    ]
    framing_rows = spark.createDataFrame(framing, "section int, id int, line string")
    return rows.unionByName(framing_rows).select(
        F.lit("lookup").alias("file"),
        (F.col("section") * 1_000_000 + F.col("id")).alias("line_no"),
        "line",
    )


def scored_long(spark: SparkSession, sf_dir: str, extra: list[str] = ()) -> DataFrame:
    """Two stand-in models' scores: ``(row_id, label, …extra, model, score)``."""
    wide = encounters(
        spark, sf_dir, ["encounter_id", S.RAW_LABEL, *SCORE_RULES, *extra]
    ).select(
        F.col("encounter_id").alias(S.ROW_ID),
        F.col(S.RAW_LABEL).eqNullSafe(F.lit("<30")).cast("int").alias("label"),
        *extra,
        F.col("score").alias("Boosted Trees"),
        F.col("score_b").alias("Logistic Regression"),
    )
    ids = [S.ROW_ID, "label", *extra]
    return wide.unpivot(ids, ["Boosted Trees", "Logistic Regression"], "model", "score")
