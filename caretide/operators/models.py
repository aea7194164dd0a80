"""Training, search, cross-validation and scoring of the risk models.

Fits are Spark ML fits over prepared tables. Scores always come out as the
long table ``(row_id, model, label, score)``, so that any number of models,
trials or folds is measured by one job.
"""

from __future__ import annotations

import random
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import PipelineModel
from pyspark.ml.classification import (
    GBTClassificationModel,
    LogisticRegression,
    LogisticRegressionModel,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, functions as F

from caretide import schema as S
from caretide.operators import boosting, evaluate as E, side_by_side
from caretide.operators.boosting import boosted, decide, first_trees, measure  # noqa: F401
from caretide.operators.encode import Prepared, feature_names
from caretide.operators.oversample import oversample
from caretide.operators.ranking import score_curve
from caretide.operators.side_by_side import Binned, Grown
from caretide.operators.split import fit_folds, with_class_weight
from caretide.session import folder_names, materialize, scratch_path
from caretide.sources import sinks


#: Rounds without gain after which a fit stops: in search, folds and refit alike, so that
#: the refit is the fit that the search measured.
TUNED_PATIENCE = 30


# --- fits -----------------------------------------------------------------------


def fit_logistic(train: DataFrame, strength: float = 1.0,
                 max_iter: int = 1000) -> LogisticRegressionModel:
    """Class-weighted logistic regression with an L2 penalty.

    The penalty matches ``sum(weight * loss) + |w|^2 / (2 * strength)``;
    Spark divides by the total weight, which is the row count when the class
    weights are balanced.
    """
    weighted = with_class_weight(train, "label")
    total = weighted.agg(F.sum("weight")).first()[0]
    return LogisticRegression(
        labelCol="label", weightCol="weight", maxIter=max_iter, standardization=False,
        regParam=1.0 / (strength * total), elasticNetParam=0.0,
    ).fit(weighted)


def logistic_gradient(model: LogisticRegressionModel, train: DataFrame,
                      strength: float = 1.0) -> DataFrame:
    """``(place, gradient)`` of the penalised loss at the fitted coefficients."""
    weights = [float(w) for w in model.coefficients]
    rows = model.transform(with_class_weight(train, "label")).select(
        (F.col("weight") * (vector_to_array("probability")[1] - F.col("label"))).alias("slope"),
        F.posexplode(vector_to_array("features")).alias("place", "x"),
    )
    own = F.get(F.array(*[F.lit(w) for w in weights]), "place")
    return rows.groupBy("place").agg(F.sum(F.col("slope") * F.col("x")).alias("loss")).select(
        "place", (F.col("loss") + own / strength).alias("gradient"))


def coefficient_table(model: LogisticRegressionModel, names: list[str]) -> DataFrame:
    """``(feature, coefficient)``, the largest absolute value first."""
    spark = SparkSession.getActiveSession()
    values = [float(c) for c in model.coefficients]
    rows = list(zip(feature_names(names, len(values)), values))
    table = spark.createDataFrame(rows, "feature string, coefficient double")
    return table.orderBy(F.desc(F.abs("coefficient")), "feature")


def top_coefficients(table: DataFrame, n: int = 10) -> DataFrame:
    return table.orderBy(F.desc(F.abs("coefficient")), "feature").limit(n)


def best_round(model: GBTClassificationModel, validation: DataFrame,
               patience: int = 20) -> tuple[int, bool]:
    """The round with the best average precision, and whether patience ran out after it.

    All rounds are scored and measured in one job.
    """
    return decide(measure(validation.select("label", "features"), model), patience)


def fit_boosted(train: DataFrame, validation: DataFrame, parameters: dict | None = None,
                patience: int = 20, seed: int = S.SEED, folder: str | None = None,
                opening: int | None = None, binned: Binned | None = None,
                keep: bool = True) -> GBTClassificationModel | Grown:
    """Boosted trees cut at the round with the best average precision on validation.

    No round is fitted twice; with a ``folder``, a fit that was cut short goes on there.
    ``opening`` is how many rounds are fitted before the first measurement. With both tables
    ``binned`` the fit is one task, which needs neither; its trees are left there if not to
    ``keep``.
    """
    if binned is not None:
        return side_by_side.fit(train.sparkSession, binned, parameters, patience, seed, keep)
    return boosting.fit(train, validation, parameters, patience, seed, folder, opening).model


# --- scoring ----------------------------------------------------------------------


def score(model, rows: DataFrame, name: str) -> DataFrame:
    """Probability of the positive class: ``(row_id, model, label, score)``."""
    return model.transform(rows).select(
        S.ROW_ID, F.lit(name).alias("model"), F.col("label").cast("int").alias("label"),
        vector_to_array("probability")[1].alias("score"),
    )


def serving_pipeline(prepared: Prepared, model) -> PipelineModel:
    """Encoder and model as one: modelling columns in, probability out."""
    return PipelineModel([prepared.encoder, model])


# --- search and cross-validation ---------------------------------------------------


def draw_parameters(trials: int, seed: int = S.SEED) -> list[dict]:
    """Seeded draws from the search ranges; ``log`` ones are log-uniform."""
    rng = random.Random(seed)
    drawn = []
    for _ in range(trials):
        row = {}
        for name, (kind, low, high) in S.SEARCH_RANGES.items():
            if kind == "int":
                row[name] = rng.randint(low, high)
            elif kind == "log":
                row[name] = low * (high / low) ** rng.random()
            else:
                row[name] = rng.uniform(low, high)
        drawn.append(row)
    return drawn


@dataclass(frozen=True)
class SearchResult:
    best: dict
    trials: DataFrame


def search(prepared: Prepared, trials: int = 50, parallel: int | None = None,
           patience: int = TUNED_PATIENCE, seed: int = S.SEED,
           folder: str | None = None) -> SearchResult:
    """Random search for the best average precision on the validation rows.

    Candidates are fitted side by side, ``parallel`` at a time. Over tables that Spark would
    broadcast each is a task, and all cores are used; over larger ones each is a distributed
    fit, eight at a time. With a ``folder`` every finished trial is a row of the table
    ``trials`` there, and unfinished distributed fits keep their blocks beside it: a search that
    lost its driver is taken up by calling this again.
    """
    spark = prepared.table.sparkSession
    candidates = draw_parameters(trials, seed)
    held = prepared.part("val")
    kinds = ", ".join(f"{n} double" for n in S.SEARCH_RANGES)
    schema = f"trial int, auprc double, auroc double, rounds int, {kinds}"
    home = folder or scratch_path(spark, "search")
    done = {int(name) for name in folder_names(spark, f"{home}/trials") if name.isdigit()
            and "_SUCCESS" in folder_names(spark, f"{home}/trials/{name}")}

    binned = side_by_side.binned(prepared.train, held) if len(done) < trials else None
    if parallel is None:
        parallel = max(8, spark.sparkContext.defaultParallelism) if binned else 8

    def run(number: int) -> None:
        own, options = candidates[number], {}
        if binned:
            options = {"binned": binned, "keep": False}
        elif folder:
            options = {"folder": f"{home}/fits/{number}"}
        model = fit_boosted(prepared.train, held, own, patience, seed, **options)
        if isinstance(model, Grown):
            found = {"auroc": model.auroc, "auprc": model.auprc}
        else:
            scores = materialize(score(model, held, str(number)), "trial-scores")
            found = E.quick_metrics(scores).first()
        row = (number, found["auprc"], found["auroc"], model.getNumTrees,
               *[float(own[n]) for n in S.SEARCH_RANGES])
        spark.createDataFrame([row], schema).coalesce(1).write.mode("overwrite").parquet(
            f"{home}/trials/{number}")

    # slow learners need the most rounds, so they begin
    left = sorted(set(range(trials)) - done, key=lambda n: candidates[n]["learning_rate"])
    with ThreadPoolExecutor(parallel) as pool:
        list(pool.map(run, left))
    found = spark.read.schema(schema).parquet(*[f"{home}/trials/{n}" for n in range(trials)])
    best = found.orderBy(F.desc("auprc"), "trial").first()
    for name, value in candidates[best["trial"]].items():
        if float(value) != best[name]:
            raise ValueError(f"{home} holds trials of another search")
    return SearchResult(candidates[best["trial"]], found.orderBy(F.desc("auprc"), "trial"))


def cross_validate(prepared: Prepared, parameters: dict, folds: int = 5,
                   balance_inside: bool = False, parallel: int = 5,
                   patience: int = TUNED_PATIENCE, seed: int = S.SEED) -> DataFrame:
    """AUROC and average precision per fold: ``(fold, auroc, auprc, n_rows)``.

    By default the folds are cut from the training rows as prepared, synthetic
    ones included. ``balance_inside`` balances each fold's training part on
    its own instead, so that no synthetic row has seen its held-out rows.

    Distributed fits open with six times the patience: with synthetic rows among the held-out
    ones precision goes on rising long, and rounds of the opening cost less than later ones.
    """
    rows = prepared.part("train") if balance_inside else prepared.train
    rows = rows.select(S.ROW_ID, "label", "features")
    cuts = fit_folds(rows, folds, "label", S.ROW_ID, seed)
    rows = materialize(rows.withColumn("fold", cuts.part()), "folds")

    def run(fold: int) -> DataFrame | tuple:
        """The scores of the fold's rows, or their metrics if a task made both."""
        train, held = rows.where(F.col("fold") != fold), rows.where(F.col("fold") == fold)
        if balance_inside:
            train = materialize(oversample(train.drop("fold"), len(S.NUMERIC)), "balanced")
        binned = side_by_side.binned(train, held)
        options = {"binned": binned, "keep": False} if binned else {"opening": 6 * patience}
        model = fit_boosted(train, held, parameters, patience, seed, **options)
        if isinstance(model, Grown):
            return fold, model.auroc, model.auprc
        return score(model, held, str(fold))

    with ThreadPoolExecutor(parallel) as pool:
        made = list(pool.map(run, range(folds)))
    ranked = [m for m in made if isinstance(m, tuple)]
    scores = [m for m in made if isinstance(m, DataFrame)]
    found = rows.sparkSession.createDataFrame(ranked, "fold int, auroc double, auprc double")
    if scores:
        scores = materialize(reduce(DataFrame.unionByName, scores), "fold-scores")
        found = found.unionByName(E.quick_metrics(scores).select(
            F.col("model").cast("int").alias("fold"), "auroc", "auprc"))
    sizes = rows.groupBy("fold").agg(F.count("*").alias("n_rows"))
    return found.join(sizes, "fold").select("fold", "auroc", "auprc", "n_rows")


# --- the evaluation suite ------------------------------------------------------------


def evaluation_suite(scored: DataFrame) -> dict[str, DataFrame]:
    """Every evaluation table of two or more aligned models."""
    scored = materialize(scored, "scored")
    E.check_models_align(scored)
    curve = materialize(score_curve(scored), "curve")
    metrics = materialize(E.metric_table(scored, curve=curve), "metrics")
    cuts = metrics.select("model", F.col("Opt_Threshold").alias("threshold"))
    predicted = E.apply_threshold(scored.join(cuts, "model"), F.col("threshold"))
    return {
        "metrics": metrics,
        "roc": E.roc_points(scored, curve=curve),
        "precision_recall": E.pr_points(scored, curve=curve),
        "prevalence": E.prevalence(scored),
        "calibration": E.calibration(scored),
        "histogram": E.score_histogram(scored),
        "confusion": E.confusion(predicted),
    }


def refit_and_save(prepared: Prepared, parameters: dict, path: str, log: str,
                   run: str = "Boosted Trees (Tuned)", patience: int = TUNED_PATIENCE) -> dict:
    """Refit on all training rows, save the pipeline, and log the run."""
    spark = prepared.table.sparkSession
    held = prepared.part("val")
    binned = side_by_side.binned(prepared.train, held)
    options = {"binned": binned} if binned else {}
    model = fit_boosted(prepared.train, held, parameters, patience, **options)
    if isinstance(model, Grown):
        model = side_by_side.classifier(spark, model, binned.cuts)
    sinks.save_model(serving_pipeline(prepared, model), path)
    row = E.quick_metrics(score(model, held, run)).first()
    metrics = {
        "auroc": row["auroc"], "auprc": row["auprc"], "rounds": model.getNumTrees
    }
    sinks.log_run(spark, log, run, parameters, metrics)
    return metrics
