"""Training, tuning, scoring and judging the risk model."""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import asdict, dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from riskengine.constants import FEATURES, MODEL_TARGETS
from riskengine.operators.prefix import prefix_sums
from riskengine.plans import reports
from riskengine.plans.profile import class_weight
from riskengine.session import shared_dir


#: Rounds of boosting that may bring nothing better.
PATIENCE = 20


@dataclass(frozen=True)
class Params:
    """Boosted-tree settings. Spark's trees have no L1/L2 penalty and no monotone constraint."""

    depth: int = 4
    step: float = 0.1
    row_share: float = 0.8
    feature_share: float = 0.8
    min_rows: int = 5
    rounds: int = 50


def random_params(n: int, seed: int = 42, rounds: int = 50) -> list[Params]:
    """Trials drawn from the search ranges; the step is drawn on a log scale."""
    rng = random.Random(seed)
    return [
        Params(
            depth=rng.randint(3, 5),
            step=0.01 * 30 ** rng.random(),
            row_share=rng.uniform(0.6, 1.0),
            feature_share=rng.uniform(0.6, 1.0),
            min_rows=rng.randint(3, 15),
            rounds=rounds,
        )
        for _ in range(n)
    ]


def assembler() -> VectorAssembler:
    return VectorAssembler(inputCols=list(FEATURES), outputCol="features")


def train(
    rows: DataFrame, params: Params = Params(), validation: DataFrame | None = None, seed: int = 42
) -> PipelineModel:
    """Fits on rows with the nine features and ``is_fraud``; positives weigh as many as the negatives per positive.

    With a validation set, boosting stops once it no longer helps there.
    """
    weight = class_weight(rows).first().class_weight or 1
    data = rows.select(*FEATURES, "is_fraud").withColumn("_held_out", F.lit(False))
    if validation is not None:
        held = validation.select(*FEATURES, "is_fraud").withColumn("_held_out", F.lit(True))
        data = data.unionByName(held)
    data = data.withColumn("label", F.col("is_fraud").cast("double")).withColumn(
        "weight", F.when(F.col("is_fraud"), float(weight)).otherwise(1.0)
    )
    trees = GBTClassifier(
        labelCol="label", weightCol="weight", maxDepth=params.depth, stepSize=params.step, maxIter=params.rounds,
        subsamplingRate=params.row_share, featureSubsetStrategy=str(params.feature_share),
        minInstancesPerNode=params.min_rows, seed=seed,
    )
    if validation is not None:
        trees = trees.setValidationIndicatorCol("_held_out")
    data = data.persist()
    try:
        return Pipeline(stages=[assembler(), trees]).fit(data)
    finally:
        data.unpersist()


def score(model: PipelineModel, rows: DataFrame, name: str = "ml_score") -> DataFrame:
    """Adds the probability of fraud."""
    scored = model.transform(rows).withColumn(name, vector_to_array("probability")[1])
    return scored.drop("features", "rawPrediction", "probability", "prediction")


@dataclass(frozen=True)
class Trees:
    """A fitted model's trees as arrays, for scoring many rows at once in a task. A leaf points to itself."""

    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    roots: np.ndarray
    weights: np.ndarray
    depth: int

    def margins(self, rows: np.ndarray) -> np.ndarray:
        """For each row the sums over the first tree, the first two and so on."""
        out = np.empty((len(rows), len(self.roots)))
        which = np.arange(len(rows))
        for i, root in enumerate(self.roots.tolist()):
            at = np.full(len(rows), root)
            for _ in range(self.depth):
                at = np.where(rows[which, self.feature[at]] <= self.threshold[at], self.left[at], self.right[at])
            out[:, i] = self.value[at] * self.weights[i]
        return np.cumsum(out, axis=1)

    def scores(self, rows: np.ndarray) -> np.ndarray:
        """The probability of fraud, as :func:`score` gives it."""
        return _probability(self.margins(rows)[:, -1])


def _probability(margin: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-2.0 * margin))


def trees_of(model: PipelineModel) -> Trees:
    """Reads the trees out of the model's saved form. A model has some hundred nodes per tree."""
    boosted = model.stages[-1]
    spark = SparkSession.getActiveSession()
    path = shared_dir(spark, "trees")
    boosted.write().save(path)
    nodes = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*").orderBy("treeID", "id").collect()
    first, place = {}, {}
    for i, n in enumerate(nodes):
        first.setdefault(n.treeID, i)
        place[n.treeID, n.id] = i
    leaf = [n.leftChild < 0 for n in nodes]
    if any(not end and n.split.numCategories >= 0 for n, end in zip(nodes, leaf)):
        raise ValueError("trees that split by category")
    child = lambda n, c, i: i if c < 0 else place[n.treeID, c]
    return Trees(
        np.array([0 if end else n.split.featureIndex for n, end in zip(nodes, leaf)]),
        np.array([np.inf if end else n.split.leftCategoriesOrThreshold[0] for n, end in zip(nodes, leaf)]),
        np.array([child(n, n.leftChild, i) for i, n in enumerate(nodes)]),
        np.array([child(n, n.rightChild, i) for i, n in enumerate(nodes)]),
        np.array([n.prediction for n in nodes]),
        np.array([first[t] for t in sorted(first)]), np.array(boosted.treeWeights), boosted.getMaxDepth(),
    )


def staged_precision(trees: Trees, validation: DataFrame) -> DataFrame:
    """The average precision on the validation rows after each round: (round, auc_pr). Rows are scored once for all rounds;
    equal scores are counted in the task before the shuffle."""
    rounds = len(trees.roots)

    def run(batches):
        for batch in batches:
            matrix = np.column_stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(len(FEATURES))]).astype(float)
            fraud = batch.column(len(FEATURES)).to_numpy(zero_copy_only=False).astype(bool)
            scores = _probability(trees.margins(matrix))
            for i in range(rounds):
                value, which = np.unique(scores[:, i], return_inverse=True)
                pos = np.bincount(which, fraud, len(value)).astype(np.int64)
                n = np.bincount(which, minlength=len(value)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"round": pa.array(np.full(len(value), i + 1), pa.int32()), "score": value, "pos": pos, "n": n})

    rows = validation.select(*[F.col(f).cast("double").alias(f) for f in FEATURES], "is_fraud").filter("is_fraud IS NOT NULL")
    counts = rows.mapInArrow(run, "round int, score double, pos long, n long").groupBy("round", "score").agg(F.sum("pos").alias("pos"), F.sum("n").alias("n"))
    path = shared_dir(validation.sparkSession, "staged")
    counts.write.parquet(path)
    ranked = prefix_sums(validation.sparkSession.read.parquet(path), "score", ["pos", "n"], ["round"], descending=True)
    precision = (F.col("pos_before") + F.col("pos")) / (F.col("n_before") + F.col("n"))
    return ranked.groupBy("round").agg((F.sum(F.col("pos") * precision) / F.nullif(F.sum("pos"), F.lit(0))).alias("auc_pr"))


def best_round(precision: Sequence[float | None], patience: int = PATIENCE) -> int:
    """The round, from 1, of the best value before ``patience`` rounds bring no better one; of equal values the first."""
    best, at = None, 0
    for i, value in enumerate(precision, 1):
        if value is not None and (best is None or value > best):
            best, at = value, i
        elif i - at >= patience:
            break
    return max(at, 1)


def train_patiently(
    rows: DataFrame, validation: DataFrame, params: Params = Params(), patience: int = PATIENCE, seed: int = 42
) -> tuple[PipelineModel, list[float]]:
    """Boosts up to ``params.rounds`` rounds and keeps the prefix with the best average precision on the validation rows,
    looking no further than ``patience`` rounds without a better one. Returns it with the precision by round.

    A round depends on those before it and the seed alone, so fitting again with fewer rounds gives that very prefix.
    """
    whole = train(rows, params, None, seed)
    staged = staged_precision(trees_of(whole), validation).orderBy("round").collect()
    precision = [r.auc_pr for r in staged]
    keep = best_round(precision, patience)
    return (whole if keep == params.rounds else train(rows, replace(params, rounds=keep), None, seed)), precision


def tune(
    rows: DataFrame, validation: DataFrame, trials: Sequence[Params], seed: int = 42, final_rounds: int | None = None
) -> tuple[PipelineModel, list[dict]]:
    """Fits every trial and keeps the one with the best average precision on the validation set.

    With ``final_rounds``, the best settings are fitted again with up to so many rounds.
    """
    best, log = None, []
    for params in trials:
        model = train(rows, params, validation, seed)
        value = reports.auc_pr(score(model, validation)).first().auc_pr or 0.0
        log.append({**asdict(params), "auc_pr": value})
        if best is None or value > best[0]:
            best = (value, model, params)
    if final_rounds is not None:
        return train(rows, replace(best[2], rounds=final_rounds), validation, seed), log
    return best[1], log


def evaluate(scored: DataFrame) -> DataFrame:
    """Best threshold, the figures there, both areas, and whether each beats its target.

    Scores and labels are written once, so the model is applied once for all figures.
    """
    path = shared_dir(scored.sparkSession, "evaluated")
    scored.select("is_fraud", "ml_score").write.parquet(path)
    scored = scored.sparkSession.read.parquet(path)
    best = reports.best_threshold(scored).first()
    at = reports.classification_report(scored, best.threshold, MODEL_TARGETS)
    out = at.select(
        F.lit(best.threshold).alias("threshold"), "*", reports.auc_roc(scored).scalar().alias("auc_roc"),
        reports.auc_pr(scored).scalar().alias("auc_pr"),
    )
    return out.select("*", *[(F.col(m) > MODEL_TARGETS[m]).alias(f"{m}_ok") for m in ("auc_roc", "auc_pr")])


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)
