"""Subgroup audit at one global threshold."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from caretide import schema as S
from caretide.functions.clinical import column
from caretide.operators.evaluate import _auroc, _ratio
from caretide.operators.ranking import score_curve


def attach_demographics(scored: DataFrame, table: DataFrame, split: str | None = "test",
                        row_id: str = S.ROW_ID) -> DataFrame:
    """Scores of one split joined to the attributes of their rows."""
    present = [c for c in S.AUDIT_ATTRIBUTES.values() if c in table.columns]
    people = table if split is None else table.where(F.col("split") == split)
    return scored.join(people.select(row_id, *present), row_id)


def subgroups(scored: DataFrame) -> DataFrame:
    """One row per scored row and audit attribute; unknown groups are left out."""
    present = {
        name: c for name, c in S.AUDIT_ATTRIBUTES.items() if c in scored.columns
    }
    wide = scored.select(
        S.ROW_ID, "label", "score",
        *[column(c).cast("string").alias(name) for name, c in present.items()],
    )
    return wide.unpivot(
        [S.ROW_ID, "label", "score"], list(present), "Attribute", "Subgroup"
    ).where("Subgroup is not null")


def audit_table(scored: DataFrame, threshold: float) -> DataFrame:
    """N, AUROC, TPR, FPR and PPV of every subgroup.

    All subgroups come from one curve; a large subgroup is spread over its
    score ranges. A group with one class keeps its row, with a null AUROC.
    """
    keys = ["Attribute", "Subgroup"]
    alert = F.col("score") >= threshold
    groups = score_curve(subgroups(scored), keys).groupBy(*keys).agg(
        F.sum(F.col("pos") + F.col("neg")).alias("N"),
        _auroc().alias("AUROC"),
        F.sum(F.when(alert, F.col("pos")).otherwise(0)).alias("tp"),
        F.sum(F.when(alert, F.col("neg")).otherwise(0)).alias("fp"),
        F.max("pos_total").alias("p"), F.max("neg_total").alias("n_neg"),
    )
    return groups.select(
        *keys, "N", "AUROC",
        _ratio(F.col("tp"), F.col("p")).alias("TPR"),
        _ratio(F.col("fp"), F.col("n_neg")).alias("FPR"),
        _ratio(F.col("tp"), F.col("tp") + F.col("fp")).alias("PPV"),
    )


def report_view(audit: DataFrame, smallest: int = 50) -> DataFrame:
    """Groups of at least ``smallest`` rows, the largest first per attribute."""
    return audit.where(F.col("N") >= smallest).orderBy(
        "Attribute", F.desc("N"), "Subgroup"
    )


def flag_weak_groups(audit: DataFrame, floor: float = 0.60) -> DataFrame:
    return audit.withColumn(
        "weak_auroc", F.coalesce((F.col("AUROC") < floor).cast("int"), F.lit(0))
    )


def disparities(audit: DataFrame, above: int = 100, gap: float = 0.05) -> DataFrame:
    """Largest TPR and PPV gap per attribute, with violation flags."""
    gaps = audit.where(F.col("N") > above).groupBy("Attribute").agg(
        (F.max("TPR") - F.min("TPR")).alias("tpr_gap"),
        (F.max("PPV") - F.min("PPV")).alias("ppv_gap"),
    )
    return gaps.withColumns({
        "equalized_odds_violated": (F.col("tpr_gap") > gap).cast("int"),
        "predictive_parity_violated": (F.col("ppv_gap") > gap).cast("int"),
    })


def audit_view(audit: DataFrame, small: int = 100, digits: int = 3) -> DataFrame:
    """Rounded audit, with small groups and each attribute's lowest AUROC marked."""
    rates = ["AUROC", "TPR", "FPR", "PPV"]
    per_attribute = Window.partitionBy("Attribute")  # one row per subgroup
    return (
        audit.withColumns({c: F.round(c, digits) for c in rates})
        .withColumn("small_sample", (F.col("N") < small).cast("int"))
        .withColumn(
            "lowest_auroc",
            F.coalesce(
                (F.col("AUROC") == F.min("AUROC").over(per_attribute)).cast("int"), F.lit(0)
            ),
        )
    )


def ordered_groups(audit: DataFrame) -> DataFrame:
    """Each subgroup's place by size within its attribute."""
    by_size = Window.partitionBy("Attribute").orderBy(F.desc("N"), "Subgroup")
    return audit.withColumn("place", F.row_number().over(by_size))


def full_audit(scored: DataFrame, threshold: float) -> DataFrame:
    """The audit with report, weakness and disparity flags on every subgroup."""
    audit = audit_table(scored, threshold)
    flags = disparities(audit).drop("tpr_gap", "ppv_gap")
    # one row per audited attribute is broadcast
    joined = flag_weak_groups(audit).join(F.broadcast(flags), "Attribute", "left")
    return joined.withColumn("reported", (F.col("N") >= 50).cast("int")).na.fill(
        0, ["equalized_odds_violated", "predictive_parity_violated"]
    )
