"""Fitted encoders for the modelling table and the prepared training data."""

from __future__ import annotations

import json
from dataclasses import dataclass
from functools import cached_property

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.feature import OneHotEncoder, VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import (
    DefaultParamsReadable,
    DefaultParamsReader,
    DefaultParamsWritable,
    DefaultParamsWriter,
    MLReadable,
    MLWritable,
)
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide import schema as S
from caretide.functions.clinical import column
from caretide.operators.explore import distinct_values
from caretide.operators.oversample import oversample
from caretide.operators.split import split_data
from caretide.session import materialize, scratch_path

KINDS = ("lr", "xgb")


def check_kind(kind: str) -> str:
    if kind not in KINDS:
        raise ValueError(f"kind must be one of {KINDS}, not {kind!r}")
    return kind


def numeric_moments(df: DataFrame, columns: list[str] = S.NUMERIC) -> dict[str, tuple]:
    """Mean and population deviation per column; 1 stands in for deviation 0."""
    row = df.selectExpr(*[
        part for c in columns for part in (f"avg(`{c}`)", f"stddev_pop(`{c}`)")
    ]).first()
    return {
        c: (row[2 * i], row[2 * i + 1] or 1.0) for i, c in enumerate(columns)
    }


def dictionary(df: DataFrame, columns: list[str] = S.CATEGORICAL) -> str:
    """Write the sorted distinct values of each column, numbers in number order; its path.

    ``value`` and ``position`` (from 1), partitioned by ``attribute``, so that a column's
    part can be read, and its size known, alone. Null is no value here.
    """
    numbers = [c for c, kind in df.dtypes if c in columns and kind != "string"]
    path = scratch_path(df.sparkSession, "dictionary")
    distinct_values(df, columns, numbers).write.partitionBy("attribute").parquet(path)
    return path


class EncounterEncoder(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the encoding of one model kind on training rows.

    ``lr``: standardised numerics and one-hot categories without the first.
    ``xgb``: numerics as they are and categories by their sorted position.
    """

    kind = Param(Params._dummy(), "kind", "lr or xgb", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, kind: str = "xgb"):
        super().__init__()
        self._set(kind=check_kind(kind))

    def _fit(self, dataset: DataFrame) -> "EncounterEncoderModel":
        kind = self.getOrDefault(self.kind)
        numeric_ids = [
            c for c, t in dataset.dtypes if c in S.CATEGORICAL and t != "string"
        ]
        nulls = dataset.agg(*[
            F.coalesce(F.bool_or(F.col(f"`{c}`").isNull()), F.lit(False)) for c in S.CATEGORICAL
        ]).first()
        path = dictionary(dataset)
        counts = dict(_read_dictionary(dataset.sparkSession, path).groupBy("attribute").agg(
            F.count("*")).collect())  # one row for each column
        state = {
            "kind": kind,
            "moments": numeric_moments(dataset) if kind == "lr" else {},
            "known": {c: counts.get(c, 0) for c in S.CATEGORICAL},
            "null": dict(zip(S.CATEGORICAL, nulls)),
            "numeric_ids": numeric_ids,
        }
        return EncounterEncoderModel(state=json.dumps(state), path=path)


def _read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("value string, position int, attribute string").parquet(path)


class _Writer(DefaultParamsWriter):
    """Saves the dictionary beside the parameters."""

    def saveImpl(self, path: str) -> None:
        model = self.instance
        state = {"state": model.getOrDefault(model.state), "path": ""}
        self.saveMetadata(model, path, self.sparkSession, paramMap=state)
        model.values().write.partitionBy("attribute").parquet(f"{path}/dictionary")


class _Reader(DefaultParamsReader):
    def load(self, path: str) -> "EncounterEncoderModel":
        return super().load(path)._set(path=f"{path}/dictionary")


class EncounterEncoderModel(Model, MLReadable, MLWritable):
    """Adds the ``features`` vector: numerics, categories, then flags.

    The categories are a written table, saved and loaded with the model. Each column is
    joined with its part of it: the optimizer sends a small part to the tasks, by its size
    in the files, and shuffles on the value where the part is large. Of the values
    themselves the driver holds none.
    """

    state = Param(Params._dummy(), "state", "fitted values as JSON", TypeConverters.toString)
    path = Param(Params._dummy(), "path", "where the categories lie", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, state: str = "{}", path: str = ""):
        super().__init__()
        self._set(state=state, path=path)

    def write(self) -> _Writer:
        return _Writer(self)

    @classmethod
    def read(cls) -> _Reader:
        return _Reader(cls)

    def fitted(self) -> dict:
        return json.loads(self.getOrDefault(self.state))

    def values(self) -> DataFrame:
        """``value``, ``position`` (from 1) and ``attribute`` of the categories."""
        return _read_dictionary(SparkSession.active(), self.getOrDefault(self.path))

    def _number_rules(self, fitted: dict) -> dict[str, str]:
        """Numerics, then flags, as SQL."""
        out = {}
        for c in S.NUMERIC:
            if fitted["kind"] == "lr":
                mean, deviation = fitted["moments"][c]
                out[f"num__{c}"] = (
                    f"(double(`{c}`) - double('{mean!r}')) / double('{deviation!r}')"
                )
            else:
                out[f"num__{c}"] = f"double(`{c}`)"
        for c in S.BINARY:
            out[f"bin__{c}"] = f"double(`{c}`)"
        return out

    def names(self) -> list[str]:
        """The features' names in vector order; as many as a linear model has weights."""
        fitted = self.fitted()
        rules = self._number_rules(fitted)
        coded = [f"cat__{c}" for c in S.CATEGORICAL]
        if fitted["kind"] == "lr":
            coded = [name for _, _, name in self._one_hot(fitted)]
        return [*[n for n in rules if n.startswith("num__")], *coded,
                *[n for n in rules if n.startswith("bin__")]]

    def _one_hot(self, fitted: dict) -> list[tuple[str, int, str]]:
        """Column, place (from 0) and name of each category but a column's first; null is
        the last."""
        shown = {c: [] for c in S.CATEGORICAL}
        rest = self.values().where(F.col("position") > 1)
        for r in rest.orderBy("attribute", "position").toLocalIterator():
            c = r["attribute"]
            text = f"{float(r['value'])}" if c in fitted["numeric_ids"] else r["value"]
            shown[c].append((c, r["position"] - 1, f"cat__{c}_{text}"))
        for c in S.CATEGORICAL:
            if fitted["null"][c] and fitted["known"][c]:
                shown[c].append((c, fitted["known"][c], f"cat__{c}_nan"))
        return [entry for c in S.CATEGORICAL for entry in shown[c]]

    def _placed(self, df: DataFrame) -> DataFrame:
        """Adds ``_t0``, ``_t1`` … (the category as text) and ``_i0`` … (its place from 0,
        null if unknown)."""
        placed = df.withColumns({
            f"_t{i}": column(c).cast("string") for i, c in enumerate(S.CATEGORICAL)})
        for i, c in enumerate(S.CATEGORICAL):
            part = self.values().where(F.col("attribute") == c).select(
                F.col("value").alias(f"_t{i}"), (F.col("position") - 1).cast("double").alias(f"_i{i}"))
            placed = placed.join(part, f"_t{i}", "left")
        return placed

    def encoded(self, df: DataFrame, *keep: str) -> DataFrame:
        """The encoding as one column per feature, next to ``keep``."""
        fitted = self.fitted()
        rules = self._number_rules(fitted)
        numbers = {name: F.expr(rule) for name, rule in rules.items()}
        if fitted["kind"] == "lr":
            number = {c: i for i, c in enumerate(S.CATEGORICAL)}
            coded = {}
            for c, place, name in self._one_hot(fitted):
                own, last = F.col(f"_i{number[c]}"), place == fitted["known"][c]
                test = F.col(f"_t{number[c]}").isNull() if last else own == place
                coded[name] = F.coalesce(test, F.lit(False)).cast("double")
        else:
            coded = {f"cat__{c}": F.coalesce(f"_i{i}", F.lit(-1.0))
                     for i, c in enumerate(S.CATEGORICAL)}
        whole = {**{n: r for n, r in numbers.items() if n.startswith("num__")}, **coded, **numbers}
        return self._placed(df).select(
            *[column(k) for k in keep], *[rule.alias(name) for name, rule in whole.items()])

    def _transform(self, dataset: DataFrame) -> DataFrame:
        """One-hot categories are sparse vectors, so that their number does not widen the
        plan."""
        fitted = self.fitted()
        linear = fitted["kind"] == "lr"
        rules = self._number_rules(fitted)
        numbers = {name: f"_n{i}" for i, name in enumerate(rules)}
        wide = self._placed(dataset.selectExpr(
            *[f"`{c}`" for c in dataset.columns],
            *[f"{rules[name]} as {part}" for name, part in numbers.items()]))
        places = range(len(S.CATEGORICAL))
        slots, sizes = {}, {}
        for i, c in enumerate(S.CATEGORICAL):
            index, n = F.col(f"_i{i}"), fitted["known"][c]
            size = n + int(fitted["null"][c])
            if not linear:
                slots[f"_c{i}"] = F.coalesce(index, F.lit(-1.0))
                continue
            missing = F.lit(float(n)) if size > n else F.lit(0.0)  # null may be the last category
            place = F.when(F.col(f"_t{i}").isNull(), missing).otherwise(F.coalesce(index, F.lit(0.0)))
            # the first category, like an unknown one, takes the last slot, which is dropped
            slots[f"_c{i}"] = F.when(place >= 1, place - 1).otherwise(F.lit(float(size - 1)))
            sizes[f"_c{i}"] = size
        wide = wide.withColumns(slots)
        coded = [f"_c{i}" for i in places]
        if linear:
            coded = [c for c in coded if sizes[c] > 1]
            wide = wide.withColumns({c: F.col(c).alias(c, metadata={
                "ml_attr": {"type": "nominal", "num_vals": sizes[c], "name": c}}) for c in coded})
            hot = [f"{c}_hot" for c in coded]
            if coded:
                wide = OneHotEncoder(inputCols=coded, outputCols=hot).fit(wide).transform(wide)
            coded = hot
        first = [p for name, p in numbers.items() if name.startswith("num__")]
        last = [p for name, p in numbers.items() if name.startswith("bin__")]
        # a missing number is an error for the linear model; trees accept it
        assembler = VectorAssembler(
            inputCols=[*first, *coded, *last], outputCol="features",
            handleInvalid="error" if linear else "keep")
        return assembler.transform(wide).select(*dataset.columns, "features")


def feature_names(names: list[str], width: int) -> list[str]:
    """The names, or generic ones when their number does not fit the vector."""
    return list(names) if len(names) == width else [f"Feature_{i}" for i in range(width)]


@dataclass(frozen=True)
class Prepared:
    """Training data of one model kind.

    ``table`` holds ``row_id, split, label, features`` of real rows, ``train``
    the rows to fit on, which for ``xgb`` include synthetic ones. They are made
    and written when first asked for.
    """

    kind: str
    table: DataFrame
    encoder: EncounterEncoderModel
    balance: bool = True

    @cached_property
    def names(self) -> list[str]:
        """The features' names, made when first asked for."""
        return self.encoder.names()

    @cached_property
    def train(self) -> DataFrame:
        rows = self.part("train").select(S.ROW_ID, "label", "features")
        if self.kind == "xgb" and self.balance:
            return materialize(oversample(rows, len(S.NUMERIC)), "balanced")
        return rows

    def part(self, split: str) -> DataFrame:
        return self.table.where(F.col("split") == split)


def fill_numeric(df: DataFrame) -> DataFrame:
    """Zero for missing counts, as the visit totals already read them."""
    return df.na.fill(0, [c for c in S.NUMERIC if c in df.columns])


def prepare(modelling: DataFrame, kind: str, balance: bool = True) -> Prepared:
    """Split, encode and (for trees) oversample a modelling table.

    The table is written once after the split; every later step and every
    training round reads it instead of the raw encounters.
    """
    check_kind(kind)
    rows = materialize(modelling, "modelling")
    rows = split_data(rows)
    encoder = EncounterEncoder(kind=kind).fit(rows.where("split = 'train'"))
    encoded = encoder.transform(rows).select(
        S.ROW_ID, "split", column(S.LABEL).alias("label"), "features"
    )
    return Prepared(kind, materialize(encoded, "encoded"), encoder, balance)
