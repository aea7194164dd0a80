"""Splits, scores, metrics and the subgroup audit."""

from __future__ import annotations

from pyspark.sql import functions as F

from caretide import schema as S
from caretide.operators import audit as H, evaluate as E, split as D
from caretide.operators.ranking import score_curve
from caretide.plans import tables as T
from caretide.plans.oracle import SEEDED, columns, r6, sql
from caretide.plans.registry import query, rounded
from caretide.session import materialize, scratch_path
from caretide.sources.bucketed import bucketed

_METRICS = ["AUROC", "AUPRC", "F1", "Brier", "Sensitivity", "Specificity", "PPV", "NPV",
            "Opt_Threshold"]
_ROUNDED = ", ".join(f"round({m}, 6) AS {m}" for m in _METRICS)
_EDGES = "[" + ", ".join(f"{i}::DOUBLE * 0.1::DOUBLE" for i in range(1, 10)) + "]"


def _labels(spark, sf_dir):
    return materialize(T.modelling(spark, sf_dir).select(S.ROW_ID, S.LABEL), "labels")


def _split(spark, sf_dir):
    return D.split_data(_labels(spark, sf_dir))


# --- splits and folds --------------------------------------------------------


@query("d01_test_rows", sql("SELECT row_id FROM t_split WHERE split = 'test'"))
def _(spark, sf_dir):
    return _split(spark, sf_dir).where("split = 'test'").select("row_id")


@query("d02_split", sql(f"SELECT row_id, {S.LABEL}, split FROM t_split"))
def _(spark, sf_dir):
    return _split(spark, sf_dir)


# fold sizes differ by one at most: fold i ends at rank floor(n (i + 1) / 5)
@query("d04_folds", sql(f"""SELECT row_id, {S.LABEL}, CAST(
    (SELECT count(*) FROM range(1, 5) AS f(i) WHERE r > n * i // 5) AS INT) AS fold
    FROM t_ranked"""))
def _(spark, sf_dir):
    return D.fold_data(_labels(spark, sf_dir))


@query("d03_missing_label", sql(f"""SELECT count(*) AS n_rows,
    'label column ''{S.LABEL}'' not found' AS message FROM t_model"""))
def _(spark, sf_dir):
    unlabelled = _labels(spark, sf_dir).drop(S.LABEL)
    try:
        D.split_data(unlabelled)
    except ValueError as error:
        return unlabelled.agg(F.count("*").alias("n_rows")).withColumn(
            "message", F.lit(str(error)))
    raise AssertionError("a missing label column must be an error")


@query("d05_class_weights", sql(f"""SELECT {S.LABEL}, count(*) AS n, round(sum(count(*)) OVER ()
    / (2.0::DOUBLE * count(*)), 6) AS weight FROM t_model GROUP BY {S.LABEL}"""))
def _(spark, sf_dir):
    return rounded(D.class_weights(T.modelling(spark, sf_dir)))


@query("a20_split_report", sql(f"""SELECT split, count(*) AS n_rows, {r6(f'avg({S.LABEL})')}
    AS positive_rate, round(count(*) / (sum(count(*)) OVER ())::DOUBLE, 6) AS share
    FROM t_split GROUP BY split"""))
def _(spark, sf_dir):
    return rounded(D.split_report(_split(spark, sf_dir)))


# every seventh row is planted in a second split, so that there is an overlap to find
@query("j04_split_overlap", sql("""SELECT a.split AS split_a, b.split AS split_b,
    count(*) AS n FROM t_twice a JOIN t_twice b ON a.row_id = b.row_id AND a.split < b.split
    GROUP BY 1, 2""", t_twice="""SELECT row_id, split FROM t_split UNION SELECT row_id,
    CASE WHEN CAST(row_id AS BIGINT) % 2 = 0 THEN 'train' ELSE 'val' END FROM t_split
    WHERE CAST(row_id AS BIGINT) % 7 = 0"""))
def _(spark, sf_dir):
    split = _split(spark, sf_dir).select(S.ROW_ID, "split")
    number = F.col(S.ROW_ID).cast("bigint")
    planted = split.where(number % 7 == 0).withColumn(
        "split", F.when(number % 2 == 0, "train").otherwise("val"))
    return D.overlap_counts(split.unionByName(planted))


@query("j04b_split_disjoint", sql("""SELECT count(*) AS n_rows, count(DISTINCT row_id) AS n_ids,
    0::BIGINT AS n_shared FROM t_split"""))
def _(spark, sf_dir):
    split = _split(spark, sf_dir)
    shared = D.split_overlap(split).agg(F.count("*").alias("n_shared"))
    return split.agg(
        F.count("*").alias("n_rows"), F.count_distinct(S.ROW_ID).alias("n_ids"),
    ).withColumn("n_shared", shared.scalar())


@query("w05_rank_order", sql(f"SELECT row_id, {S.LABEL}, r AS place FROM t_ranked"))
def _(spark, sf_dir):
    return D.ranked(_labels(spark, sf_dir))


# --- metrics -------------------------------------------------------------------


@query("g01_auroc", sql("SELECT model, round(auroc, 6) AS auroc FROM t_auroc"))
def _(spark, sf_dir):
    return rounded(E.auroc(T.scored(spark, sf_dir)))


@query("g02_average_precision", sql("SELECT model, round(auprc, 6) AS auprc FROM t_auroc"))
def _(spark, sf_dir):
    return rounded(E.average_precision(T.scored(spark, sf_dir)))


@query("g03_brier", sql(f"""SELECT model, {r6('avg((score - label) * (score - label))')} AS brier
    FROM t_scored GROUP BY model"""))
def _(spark, sf_dir):
    return rounded(E.brier(T.scored(spark, sf_dir)))


@query("g04_best_threshold", sql("""SELECT model, round(threshold, 6) AS threshold, cost
    FROM t_threshold"""))
def _(spark, sf_dir):
    return rounded(E.best_threshold(T.scored(spark, sf_dir)))


@query("g05_apply_threshold", sql("""SELECT row_id, label, model, predicted FROM t_predicted"""))
def _(spark, sf_dir):
    return _predicted(spark, sf_dir).select("row_id", "label", "model", "predicted")


def _predicted(spark, sf_dir):
    scored = T.scored(spark, sf_dir)
    # one threshold per model, so the broadcast is as long as the model list
    cuts = F.broadcast(E.best_threshold(scored).select("model", "threshold"))
    return E.apply_threshold(scored.join(cuts, "model"), F.col("threshold"))


@query("g06_confusion", sql("SELECT * FROM t_counts"))
def _(spark, sf_dir):
    return E.confusion(_predicted(spark, sf_dir))


@query("g07_clinical_rates", sql("""SELECT model, round(Sensitivity, 6) AS sensitivity,
    round(Specificity, 6) AS specificity, round(PPV, 6) AS ppv, round(NPV, 6) AS npv
    FROM t_metrics"""))
def _(spark, sf_dir):
    rates = E.clinical_rates(E.confusion(_predicted(spark, sf_dir)))
    return rounded(rates.select("model", "sensitivity", "specificity", "ppv", "npv"))


@query("g08_f1", sql("SELECT model, round(F1, 6) AS f1 FROM t_metrics"))
def _(spark, sf_dir):
    rates = E.clinical_rates(E.confusion(_predicted(spark, sf_dir)))
    return rounded(rates.select("model", "f1"))


@query("g09_metric_table", sql(f"SELECT model, {_ROUNDED} FROM t_metrics"))
def _(spark, sf_dir):
    return rounded(E.metric_table(T.scored(spark, sf_dir)))


@query("g10_roc_points", sql("""SELECT model, round(fpr, 6) AS fpr, round(tpr, 6) AS tpr,
    CASE WHEN isinf(threshold) THEN threshold ELSE round(threshold, 6) END AS threshold FROM
    (SELECT model, fp::DOUBLE / neg_total AS fpr, tp::DOUBLE / pos_total AS tpr, score AS threshold
    FROM t_curve WHERE next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
        OR (tp = pos AND fp = neg)
    UNION ALL SELECT DISTINCT model, 0::DOUBLE, 0::DOUBLE, 'inf'::DOUBLE FROM t_curve)"""))
def _(spark, sf_dir):
    return rounded(E.roc_points(T.scored(spark, sf_dir)))


@query("g11_pr_points", sql("""SELECT model, round(tp::DOUBLE / (tp + fp), 6) AS precision,
    round(tp::DOUBLE / pos_total, 6) AS recall, round(score, 6) AS threshold FROM t_curve
    UNION ALL SELECT DISTINCT model, 1::DOUBLE, 0::DOUBLE, NULL::DOUBLE FROM t_curve"""))
def _(spark, sf_dir):
    return rounded(E.pr_points(T.scored(spark, sf_dir)))


@query("g12_prevalence", sql(f"SELECT model, {r6('avg(label)')} AS prevalence FROM t_scored GROUP BY model"))
def _(spark, sf_dir):
    return rounded(E.prevalence(T.scored(spark, sf_dir)))


@query("g13_calibration", sql(f"""SELECT model, CAST(len(list_filter({_EDGES}, lambda e: e < score))
    AS INT) AS bin, {r6('avg(score)')} AS mean_score, {r6('avg(label)')} AS observed_rate,
    count(*) AS n FROM t_scored GROUP BY 1, 2"""))
def _(spark, sf_dir):
    return rounded(E.calibration(T.scored(spark, sf_dir)))


@query("g14_score_histogram", sql(f"""SELECT model, CAST(len(list_filter({_EDGES},
    lambda e: e <= score)) AS INT) AS bin, count(*) AS n FROM t_scored
    WHERE score BETWEEN 0 AND 1 GROUP BY 1, 2"""))
def _(spark, sf_dir):
    return E.score_histogram(T.scored(spark, sf_dir))


@query("w03_cumulative_counts", sql("""SELECT model, round(score, 6) AS score, CAST(tp AS BIGINT) AS tp,
    CAST(fp AS BIGINT) AS fp, CAST(pos AS BIGINT) AS pos, CAST(neg AS BIGINT) AS neg FROM t_curve"""))
def _(spark, sf_dir):
    curve = score_curve(T.scored(spark, sf_dir))
    return rounded(curve.select("model", "score", "tp", "fp", "pos", "neg"))


@query("e13_quick_metrics",
       sql("SELECT model, round(auroc, 6) AS auroc, round(auprc, 6) AS auprc FROM t_auroc"))
def _(spark, sf_dir):
    return rounded(E.quick_metrics(T.scored(spark, sf_dir)))


@query("u01_union_metrics", sql(f"SELECT model, {_ROUNDED} FROM t_metrics"))
def _(spark, sf_dir):
    scored = T.scored(spark, sf_dir)
    tables = [
        E.metric_table(scored.where(F.col("model") == name))
        for name in ("Boosted Trees", "Logistic Regression")
    ]
    return rounded(E.union_metrics(*tables))


# rows are left out on either side and labels turned over, so that there are faults to find
@query("j05_alignment", sql("""SELECT count(*) FILTER (k % 5 <> 0 AND k % 11 <> 0) AS matched,
    count(*) FILTER (k % 5 <> 0 AND k % 11 = 0) AS only_left,
    count(*) FILTER (k % 5 = 0 AND k % 11 <> 0) AS only_right,
    count(*) FILTER (k % 5 <> 0 AND k % 11 <> 0 AND k % 7 = 0) AS label_mismatch
    FROM (SELECT CAST(row_id AS BIGINT) AS k FROM t_wide_scores)"""))
def _(spark, sf_dir):
    scored = T.scored(spark, sf_dir)
    k = F.col(S.ROW_ID).cast("bigint")
    left = scored.where((F.col("model") == "Boosted Trees") & (k % 5 != 0))
    right = scored.where((F.col("model") != "Boosted Trees") & (k % 11 != 0)).withColumn(
        "label", F.when(k % 7 == 0, 1 - F.col("label")).otherwise(F.col("label")))
    return E.alignment(left, right)


@query("v09_metric_view", sql("SELECT model, " + ", ".join(
    f"round({m}, 4) AS {m}" for m in _METRICS) + ", " + ", ".join(
    f"CAST(round({m}, 4) = max(round({m}, 4)) OVER () AS INT) AS best_{m}"
    for m in ("AUROC", "AUPRC", "F1")) + " FROM t_metrics"))
def _(spark, sf_dir):
    return E.metric_view(E.metric_table(T.scored(spark, sf_dir)))


@query("a25_fold_summary", sql("""SELECT round(avg(auroc), 6) AS mean_auroc,
    round(stddev_pop(auroc), 6) AS std_auroc, round(avg(auprc), 6) AS mean_auprc,
    round(stddev_pop(auprc), 6) AS std_auprc, CAST(stddev_pop(auprc) > 0.05 AS INT) AS high_variance
    FROM t_auroc"""))
def _(spark, sf_dir):
    return rounded(E.fold_summary(E.quick_metrics(T.scored(spark, sf_dir))))


# --- subgroup audit --------------------------------------------------------------


def _test_scores(spark, sf_dir, scored=None):
    """Scores of the test split with the attributes of their rows."""
    scored = T.boosted_scores(spark, sf_dir) if scored is None else scored
    table = materialize(
        T.engineered(spark, sf_dir).select(S.ROW_ID, S.LABEL, "race", "gender", "age"),
        "people",
    )
    return H.attach_demographics(scored, D.split_data(table).drop(S.LABEL))


def _audit(spark, sf_dir):
    scored = materialize(T.boosted_scores(spark, sf_dir), "scored")
    return H.audit_table(_test_scores(spark, sf_dir, scored), E.threshold_of(scored))


_AUDIT = """SELECT Attribute, Subgroup, N, round(AUROC, 6) AS AUROC, round(TPR, 6) AS TPR,
    round(FPR, 6) AS FPR, round(PPV, 6) AS PPV"""


@query("j02_demographics_join", sql("""SELECT row_id, label, round(score, 6) AS score, race, gender,
    age FROM t_test_scored"""))
def _(spark, sf_dir):
    return rounded(_test_scores(spark, sf_dir).drop("model"))


@query("h01_attach_demographics", sql("""SELECT race, gender, count(*) AS n,
    CAST(sum(label) AS BIGINT) AS positives FROM t_test_scored GROUP BY race, gender"""))
def _(spark, sf_dir):
    return _test_scores(spark, sf_dir).groupBy("race", "gender").agg(
        F.count("*").alias("n"), F.sum("label").alias("positives")
    )


def _in_buckets(spark, sf_dir):
    """Attributes with their split, and scores, both laid out in buckets of the row."""
    people = materialize(
        T.engineered(spark, sf_dir).select(S.ROW_ID, S.LABEL, "race", "gender", "age"), "people")
    people = bucketed(D.split_data(people).drop(S.LABEL), scratch_path(spark, "people-by-row"))
    return people, bucketed(T.boosted_scores(spark, sf_dir), scratch_path(spark, "scores-by-row"))


@query("j02b_bucketed_join", sql("""SELECT row_id, label, round(score, 6) AS score, race, gender,
    age FROM t_test_scored"""))
def _(spark, sf_dir):
    """The join of j02 between tables in buckets: neither side is moved."""
    people, scored = _in_buckets(spark, sf_dir)
    return rounded(H.attach_demographics(scored, people).drop("model"))


@query("h01b_bucketed_demographics", sql("""SELECT race, gender, count(*) AS n,
    CAST(sum(label) AS BIGINT) AS positives FROM t_test_scored GROUP BY race, gender"""))
def _(spark, sf_dir):
    """h01 between tables in buckets: only the counts are shuffled."""
    people, scored = _in_buckets(spark, sf_dir)
    return H.attach_demographics(scored, people).groupBy("race", "gender").agg(
        F.count("*").alias("n"), F.sum("label").alias("positives"))


@query("h02_subgroups", sql("""SELECT Attribute, Subgroup, count(*) AS n FROM t_members
    WHERE Subgroup IS NOT NULL GROUP BY 1, 2"""))
def _(spark, sf_dir):
    return H.subgroups(_test_scores(spark, sf_dir)).groupBy("Attribute", "Subgroup").agg(
        F.count("*").alias("n")
    )


@query("u04_unpivot_attributes", sql("""SELECT Attribute, Subgroup, label, round(score, 6) AS score
    FROM t_members WHERE Subgroup IS NOT NULL"""))
def _(spark, sf_dir):
    return rounded(H.subgroups(_test_scores(spark, sf_dir)).drop("row_id"))


@query("h03_subgroup_metrics", sql(f"{_AUDIT} FROM t_audit"))
def _(spark, sf_dir):
    return rounded(_audit(spark, sf_dir))


@query("h04_report_view", sql(f"{_AUDIT} FROM t_audit WHERE N >= 50"))
def _(spark, sf_dir):
    return rounded(H.report_view(_audit(spark, sf_dir)))


@query("h05_weak_groups", sql(f"{_AUDIT}, CAST(coalesce(AUROC < 0.6, FALSE) AS INT) AS weak_auroc FROM t_audit"))
def _(spark, sf_dir):
    return rounded(H.flag_weak_groups(_audit(spark, sf_dir)))


_GAPS = """SELECT Attribute, max(TPR) - min(TPR) AS a, max(PPV) - min(PPV) AS b FROM t_audit
    WHERE N > 100 GROUP BY Attribute"""


@query("h06_disparities", sql(f"""SELECT Attribute, round(a, 6) AS tpr_gap, round(b, 6) AS ppv_gap
    FROM ({_GAPS})"""))
def _(spark, sf_dir):
    return rounded(H.disparities(_audit(spark, sf_dir)).select("Attribute", "tpr_gap", "ppv_gap"))


@query("h07_violations", sql(f"""SELECT Attribute, CAST(a > 0.05 AS INT) AS equalized_odds_violated,
    CAST(b > 0.05 AS INT) AS predictive_parity_violated FROM ({_GAPS})"""))
def _(spark, sf_dir):
    return H.disparities(_audit(spark, sf_dir)).drop("tpr_gap", "ppv_gap")


@query("h08_audit_view", sql("""SELECT Attribute, Subgroup, N, round(AUROC, 3) AS AUROC,
    round(TPR, 3) AS TPR, round(FPR, 3) AS FPR, round(PPV, 3) AS PPV,
    CAST(N < 100 AS INT) AS small_sample, CAST(coalesce(round(AUROC, 3)
    = min(round(AUROC, 3)) OVER (PARTITION BY Attribute), FALSE) AS INT) AS lowest_auroc
    FROM t_audit"""))
def _(spark, sf_dir):
    return H.audit_view(_audit(spark, sf_dir))


@query("h09_whole_audit", sql(f"""{_AUDIT}, CAST(N >= 50 AS INT) AS reported,
    CAST(coalesce(AUROC < 0.6, FALSE) AS INT) AS weak_auroc, CAST(coalesce(a > 0.05, FALSE) AS INT)
    AS equalized_odds_violated, CAST(coalesce(b > 0.05, FALSE) AS INT) AS predictive_parity_violated
    FROM t_audit LEFT JOIN ({_GAPS}) USING (Attribute)"""))
def _(spark, sf_dir):
    scored = materialize(T.boosted_scores(spark, sf_dir), "scored")
    people = _test_scores(spark, sf_dir, scored)
    return rounded(H.full_audit(people, E.threshold_of(scored)))


@query("k08_audit_order", sql("""SELECT Attribute, Subgroup, N, CAST(row_number() OVER
    (PARTITION BY Attribute ORDER BY N DESC, Subgroup) AS INT) AS place FROM t_audit"""))
def _(spark, sf_dir):
    return H.ordered_groups(_audit(spark, sf_dir)).select("Attribute", "Subgroup", "N", "place")
