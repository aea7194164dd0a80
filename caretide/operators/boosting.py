"""Boosted trees that go on from where they are.

An ensemble is grown in blocks of rounds. Its opening is one fit of Spark's classifier;
every later block starts from written tables that hold, beside features and label, the
margin of the ensemble so far. A round fits one tree to the residuals of the margin, with
the seed that the classifier would use in this round, so that no round is ever fitted
twice. After a block its margins are added to the written ones, for training and validation
rows alike, and the block's rounds are measured on validation by one job.

With a folder each block is kept there: trees, margins, and last the measurements, which
say that the block is whole. A fit that finds blocks in its folder goes on after the last.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import DecisionTreeRegressionModel, RandomForestRegressor
from pyspark.ml.util import Identifiable
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide import schema as S
from caretide.operators import evaluate as E, tree_attribution as TA
from caretide.session import folder_names, materialize, shared_folder, ship

#: The first tree counts whole, later ones by the learning rate.
FIRST_WEIGHT = 1.0
#: Residuals are whole multiples of one over this.
GRID = float(1 << 30)
#: Rows below which a piece of the training table is not worth a task of its own.
PIECE_ROWS = 10_000


def _checkpoints(spark: SparkSession) -> None:
    """Let boosting cut its lineage in the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def boosted(parameters: dict, seed: int = S.SEED, **options) -> GBTClassifier:
    """The classifier for a parameter set; absent ones take their defaults."""
    p = {**S.BOOSTED_DEFAULTS, **parameters}
    share = float(p["colsample"])
    return GBTClassifier(
        labelCol="label", maxDepth=int(p["max_depth"]), stepSize=float(p["learning_rate"]),
        maxIter=int(p["n_estimators"]), subsamplingRate=float(p["subsample"]),
        featureSubsetStrategy="all" if share >= 1 else f"{share:.4f}",
        minInstancesPerNode=int(p["min_child_weight"]), minInfoGain=float(p["min_info_gain"]),
        seed=seed, checkpointInterval=10, maxMemoryInMB=512, **options,
    )


def _one_tree(parameters: dict) -> RandomForestRegressor:
    """The learner of one round, under the classifier's settings."""
    like = boosted(parameters)
    return RandomForestRegressor(
        labelCol="residual", featuresCol="features", numTrees=1, bootstrap=False,
        maxDepth=like.getMaxDepth(), subsamplingRate=like.getSubsamplingRate(),
        featureSubsetStrategy=like.getFeatureSubsetStrategy(), maxMemoryInMB=512,
        minInstancesPerNode=like.getMinInstancesPerNode(), minInfoGain=like.getMinInfoGain(),
    )


def ensemble(trees: list[DecisionTreeRegressionModel], weights: list[float],
             n_features: int) -> GBTClassificationModel:
    """A boosted classifier of given trees."""
    context = SparkSession.active().sparkContext
    ml, gateway = context._jvm.org.apache.spark.ml, context._gateway
    made = gateway.new_array(ml.regression.DecisionTreeRegressionModel, len(trees))
    counts = gateway.new_array(context._jvm.double, len(trees))
    for i, (tree, weight) in enumerate(zip(trees, weights)):
        made[i], counts[i] = tree._java_obj, float(weight)
    name = Identifiable().uid.replace("Identifiable", "GBTClassifier")
    model = GBTClassificationModel(
        ml.classification.GBTClassificationModel(name, made, counts, n_features, 2))
    model._resetUid(name)
    return model


def first_trees(model: GBTClassificationModel, n: int) -> GBTClassificationModel:
    """The ensemble cut to its first ``n`` trees."""
    if n >= model.getNumTrees:
        return model
    return ensemble(model.trees[:n], list(model.treeWeights)[:n], model.numFeatures)


def _with_margin(rows: DataFrame, model: GBTClassificationModel, name: str = "margin") -> DataFrame:
    """Adds the model's margin; a column of that name is added to."""
    quiet = model.copy()
    quiet.setRawPredictionCol("own__").setProbabilityCol("").setPredictionCol("")
    own = vector_to_array("own__")[1]
    whole = F.col(name) + own if name in rows.columns else own
    return quiet.transform(rows).withColumn(name, whole).drop("own__")


def grow(rows: DataFrame, parameters: dict, first: int, count: int, seed: int,
         n_features: int) -> GBTClassificationModel:
    """Rounds ``first`` (from 0) to ``first + count - 1`` after the ``margin`` of ``rows``.

    ``rows`` has ``label``, ``features`` and ``margin``; it is kept for the block and can be
    made again from its files.
    """
    learner, rate = _one_tree(parameters), boosted(parameters).getStepSize()
    side = (2 * F.col("label") - 1).cast("double")
    kept = rows.select("features", "margin", side.alias("side")).persist(StorageLevel.MEMORY_AND_DISK)
    trees: list[DecisionTreeRegressionModel] = []
    weights: list[float] = []
    try:
        for at in range(first, first + count):
            now = kept
            if trees:
                now = _with_margin(kept, ensemble(trees, weights, n_features))
            slope = 4 * F.col("side") / (1 + F.exp(2 * F.col("side") * F.col("margin")))
            # the first tree fits the labels; later ones rounded slopes, so that splits that
            # gain the same do not depend on the order in which margins were summed
            residual = F.rint(slope * GRID) / GRID if at else F.col("side")
            fitted = learner.copy({learner.seed: seed + at}).fit(
                now.select("features", residual.alias("residual")))
            trees.append(fitted.trees[0])
            weights.append(rate if at else FIRST_WEIGHT)
    finally:
        kept.unpersist()
    return ensemble(trees, weights, n_features)


def staged(rows: DataFrame, model: GBTClassificationModel, first: int = 0) -> DataFrame:
    """``(label, round, score)`` after each round of a block, beside the ``margin`` before it."""
    start = F.col("margin") if "margin" in rows.columns else F.lit(0.0)
    shared = ship(rows.sparkSession, TA.collect_nodes(rows.sparkSession, model))

    def stages(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nodes = shared()
        for pdf in batches:
            if pdf.empty:
                continue
            odds = TA.tree_margins(np.stack(pdf["x"].to_numpy()), nodes).cumsum(axis=1)
            odds += 2 * pdf["margin"].to_numpy()[:, None]
            yield pd.DataFrame({"label": pdf["label"], "scores": list(1.0 / (1.0 + np.exp(-odds)))})

    plain = rows.select(F.col("label").cast("int").alias("label"), start.alias("margin"),
                        vector_to_array("features").alias("x"))
    return plain.mapInPandas(stages, "label int, scores array<double>").select(
        "label", F.posexplode("scores").alias("at", "score")).select(
        "label", (F.col("at") + first + 1).alias("round"), "score")


def decide(precision: dict[int, float | None], patience: int) -> tuple[int, bool]:
    """The best round, the first of equals, and whether patience ran out after it."""
    best, best_at = -1.0, 1
    for at in sorted(precision):
        if precision[at] is not None and precision[at] > best:
            best, best_at = precision[at], at
        elif at - best_at >= patience:
            return best_at, True
    return best_at, False


def measure(rows: DataFrame, model: GBTClassificationModel, first: int = 0) -> dict[int, float]:
    """Average precision after each round, by one job."""
    found = E.average_precision(staged(rows, model, first), ["round"]).collect()
    return {r["round"]: r["auprc"] for r in found}


@dataclass(frozen=True)
class Fitted:
    """A model cut at its best round, and the precision of every round that was tried."""

    model: GBTClassificationModel
    precision: dict[int, float]


class _Blocks:
    """The blocks of a fit in its folder, each named by the rounds it ends with."""

    def __init__(self, spark: SparkSession, folder: str | None, parameters: dict, seed: int):
        self.spark, self.folder = spark, folder
        if folder is None:
            return
        asked = json.dumps({**parameters, "seed": seed}, sort_keys=True)
        if "parameters" in folder_names(spark, folder):
            stored = spark.read.text(f"{folder}/parameters").first()["value"]
            if stored != asked:
                raise ValueError(f"{folder} holds a fit with other parameters: {stored}")
        else:
            row = spark.createDataFrame([(asked,)], "value string")
            row.coalesce(1).write.mode("overwrite").text(f"{folder}/parameters")

    def last(self) -> tuple | None:
        """Rounds, ensemble, both tables and measurements of the last whole block."""
        if self.folder is None:
            return None
        whole = [
            int(name) for name in folder_names(self.spark, self.folder) if name.isdigit()
            and "_SUCCESS" in folder_names(self.spark, f"{self.folder}/{name}/rounds")]
        if not whole:
            return None
        path = f"{self.folder}/{max(whole)}"
        rounds = {r["round"]: r["auprc"] for r in self.spark.read.parquet(f"{path}/rounds").collect()}
        return (max(whole), GBTClassificationModel.load(f"{path}/ensemble"),
                *[self.spark.read.parquet(f"{path}/{part}") for part in ("train", "held")], rounds)

    def write(self, n: int, model: GBTClassificationModel, train: DataFrame, held: DataFrame,
              precision: dict[int, float]) -> tuple[DataFrame, DataFrame]:
        """Both tables as written; with a folder the block is kept."""
        if self.folder is None:
            return materialize(train, "margins"), materialize(held, "held-margins")
        path = f"{self.folder}/{n}"
        for name, table in (("train", train), ("held", held)):
            table.write.mode("overwrite").parquet(f"{path}/{name}")
        model.write().overwrite().save(f"{path}/ensemble")
        rounds = self.spark.createDataFrame(sorted(precision.items()), "round int, auprc double")
        rounds.coalesce(1).write.mode("overwrite").parquet(f"{path}/rounds")
        return tuple(self.spark.read.schema(t.schema).parquet(f"{path}/{p}")
                     for p, t in (("train", train), ("held", held)))


def fit(train: DataFrame, validation: DataFrame, parameters: dict | None = None,
        patience: int = 20, seed: int = S.SEED, folder: str | None = None,
        opening: int | None = None, block: int | None = None) -> Fitted:
    """Boosted trees cut at the round with the best average precision on validation.

    Boosting stops once ``patience`` rounds brought nothing better, or at
    ``n_estimators``. ``opening`` rounds are fitted first, by default three times the
    patience, then ``block`` at a time (two thirds of it).
    """
    spark = train.sparkSession
    _checkpoints(spark)
    parameters = {**S.BOOSTED_DEFAULTS, **(parameters or {})}
    most = int(parameters["n_estimators"])
    opening = min(most, opening or max(1, 3 * patience))
    block = block or max(1, patience * 2 // 3)
    blocks = _Blocks(spark, folder, parameters, seed)
    held = validation.select("label", "features")
    found = blocks.last()
    if found:
        rounds, model, rows, held, precision = found
    else:
        rows = train.select("label", "features")
        # a small table in many pieces costs a task for each of them at every level
        rows = rows.coalesce(max(1, math.ceil(rows.count() / PIECE_ROWS)))
        model = boosted({**parameters, "n_estimators": opening}, seed).fit(rows)
        rounds, precision = opening, measure(held, model)
        going = not decide(precision, patience)[1] and rounds < most
        if going or folder is not None:
            rows, held = blocks.write(
                rounds, model, _with_margin(rows, model), _with_margin(held, model), precision)
    while True:
        best, stopped = decide(precision, patience)
        if stopped or rounds >= most:
            return Fitted(first_trees(model, best), precision)
        count = min(block, most - rounds)
        more = grow(rows, parameters, rounds, count, seed, model.numFeatures)
        precision = {**precision, **measure(held, more, rounds)}
        model = ensemble([*model.trees, *more.trees], [*model.treeWeights, *more.treeWeights],
                         model.numFeatures)
        rounds += count
        rows, held = blocks.write(
            rounds, model, _with_margin(rows, more), _with_margin(held, more), precision)
