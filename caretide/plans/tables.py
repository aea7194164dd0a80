"""The derived input tables that the registered queries share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide import schema as S
from caretide.functions import clinical as C
from caretide.operators.clean import clean, replace_sentinel
from caretide.operators.features import engineered_table, modelling_table
from caretide.sources.lookups import parse_lookup_lines
from caretide.sources.order_view import encounters, lookup_lines, scored_long


def loaded(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Raw encounters (or some columns) with missing values as null."""
    return replace_sentinel(encounters(spark, sf_dir, list(columns) or None))


def labeled(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """:func:`loaded` plus the mapped label ``readmitted_binary``."""
    df = loaded(spark, sf_dir, *dict.fromkeys([*columns, S.RAW_LABEL]))
    return df.withColumn("readmitted_binary", C.label_mapped(F.col(S.RAW_LABEL)))


def lookups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_lookup_lines(lookup_lines(spark, sf_dir))


def first_encounters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw encounters that cleaning keeps, with whatever else bears their ids.

    Ids are chosen by the three columns that decide, and the others are derived for the
    chosen encounters only. Cleaning still has to follow. Null is an id like any other.
    """
    deciding = ["encounter_id", "patient_nbr", "discharge_disposition_id"]
    kept = clean(encounters(spark, sf_dir, deciding, labelled=True)).select(S.ROW_ID)
    return encounters(spark, sf_dir, chosen=kept)


def engineered(spark: SparkSession, sf_dir: str) -> DataFrame:
    return engineered_table(first_encounters(spark, sf_dir))


def modelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return modelling_table(first_encounters(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored_long(spark, sf_dir)


def boosted_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scored(spark, sf_dir).where("model = 'Boosted Trees'")
