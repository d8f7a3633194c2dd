"""Training, tuning and scoring with ``pyspark.ml``."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from functools import reduce
from itertools import product
from multiprocessing.pool import ThreadPool
from threading import RLock

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    GBTClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from modelwatch.operators.encoding import FeatureEncoder, FeatureEncoderModel
from modelwatch.operators.metrics import classification_metrics
from modelwatch.operators.profile import class_weights
from modelwatch.session import scratch_root, stage_table

WEIGHT = "class_weight"
PARALLELISM = 4
#: Rows of a training partition: few while there are few partitions, up to ROWS_PER_LARGE_PART on large data.
ROWS_PER_PART, SMALL_PARTS, ROWS_PER_LARGE_PART = 5_000, 64, 1_000_000


def stable_layout(df: DataFrame, key: str, rows: int) -> DataFrame:
    """Same rows in the same partitions in the same order, whatever the input layout.

    Seeded learners draw per partition, so a repeatable fit needs this. The number
    of partitions follows from the row count alone, not from a session setting or
    run-time coalescing.
    """
    parts = max(1, min(SMALL_PARTS, math.ceil(rows / ROWS_PER_PART)), math.ceil(rows / ROWS_PER_LARGE_PART))
    return df.repartition(parts, key).sortWithinPartitions(key)


def with_class_weight(df: DataFrame, label: str, counts: Row | dict | None = None) -> DataFrame:
    """Balanced weight n / (2 n_c) per row; the two weights are literals."""
    w = counts or class_weights(df, label).first()
    return df.withColumn(
        WEIGHT, F.when(F.col(label) == 1, F.lit(w["weight_1"] or 1.0)).otherwise(F.lit(w["weight_0"] or 1.0))
    )


def random_forest(label: str, trees: int = 150, depth: int = 12, seed: int = 42, weighted: bool = True, **kw) -> Estimator:
    extra = {"weightCol": WEIGHT} if weighted else {}
    return RandomForestClassifier(labelCol=label, numTrees=trees, maxDepth=depth, seed=seed, **extra, **kw)


def logistic_regression(
    label: str, c: float = 1.0, penalty: str = "l2", weighted: bool = False, max_iter: int = 1000
) -> Estimator:
    """``c`` is the inverse strength on the summed loss. Spark averages the loss, so ``fit_model`` sets 1 / (c n) for
    the n rows that it counts."""
    extra = {"weightCol": WEIGHT} if weighted else {}
    learner = LogisticRegression(
        labelCol=label, maxIter=max_iter, elasticNetParam=1.0 if penalty == "l1" else 0.0, standardization=False, **extra
    )
    learner.inverse_strength = c
    return learner


def decision_tree(label: str, depth: int = 5, seed: int = 42, weighted: bool = True) -> Estimator:
    extra = {"weightCol": WEIGHT} if weighted else {}
    return DecisionTreeClassifier(labelCol=label, maxDepth=depth, seed=seed, **extra)


def boosted_trees(
    label: str,
    rounds: int = 100,
    depth: int = 3,
    step: float = 0.1,
    subsample: float = 1.0,
    columns: str = "all",
    seed: int = 42,
    weighted: bool = True,
    checkpoint_interval: int = 10,
) -> Estimator:
    """Each round's residuals rest on the round before; every ``checkpoint_interval`` rounds they are written to the shared
    checkpoint folder, so that neither the plan nor what a lost executor costs grows with ``rounds``."""
    extra = {"weightCol": WEIGHT} if weighted else {}
    return GBTClassifier(
        checkpointInterval=checkpoint_interval,
        labelCol=label,
        maxIter=rounds,
        maxDepth=depth,
        stepSize=step,
        subsamplingRate=subsample,
        featureSubsetStrategy=columns,
        seed=seed,
        **extra,
    )


def fit_model(df: DataFrame, key: str, label: str, encoder: Estimator | None, learner: Estimator) -> PipelineModel:
    """Encoder and learner fitted on the training rows only, repeatably.

    The columns in use are kept (memory, then local disk) while class weights,
    encoder statistics and the layout read them, so the input is computed once.
    """
    inputs = encoder.input_columns() if encoder is not None else [learner.getFeaturesCol()]
    slim = df.select(*dict.fromkeys([key, label, *inputs])).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = class_weights(slim, label).first()
        rows, stages = with_class_weight(slim, label, counts), []
        if encoder is not None:
            fitted = encoder.fit(slim)
            rows, stages = fitted.transform(rows), [fitted]
        total = counts["negatives"] + counts["positives"]
        laid_out = stable_layout(rows.select(key, label, WEIGHT, learner.getFeaturesCol()), key, total)
        return PipelineModel([*stages, *_fit_learner(laid_out, key, label, None, learner, total).stages])
    finally:
        slim.unpersist()


def _fit_learner(rows: DataFrame, key: str, label: str, encoder: Model | None, learner: Estimator, total: int) -> PipelineModel:
    """Fits on rows that are laid out and weighted."""
    if (c := getattr(learner, "inverse_strength", None)) is not None:
        learner = learner.copy({learner.regParam: 1.0 / (c * max(total, 1))})
    context = rows.sparkSession.sparkContext
    if learner.hasParam("checkpointInterval") and not context.getCheckpointDir():
        # Boosting and deep forests cut their lineage there every ``checkpointInterval`` rounds.
        context.setCheckpointDir(scratch_root(rows.sparkSession))
    if encoder is not None:
        rows = encoder.transform(rows)
    fitted = learner.fit(rows.select(key, label, WEIGHT, learner.getFeaturesCol()))
    return PipelineModel([*([encoder] if encoder is not None else []), fitted])


def score(model: Model, df: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Raw columns plus ``churn_probability`` and ``prediction``."""
    kept = [c for c in df.columns if c not in ("prediction", "churn_probability")]
    out = model.transform(df.select(*kept))
    p = vector_to_array("probability")[1]
    return out.select(*kept, p.alias("churn_probability"), (p >= threshold).cast("int").alias("prediction"))


def majority_class(df: DataFrame, label: str) -> DataFrame:
    """The constant baseline: every row predicted as the most frequent class (0 on a tie)."""
    top = df.agg((F.count_if(F.col(label) == 1) > F.count_if(F.col(label) == 0)).cast("int")).scalar()
    return df.withColumn("prediction", top)


def cross_validate(
    folded: DataFrame,
    key: str,
    label: str,
    models: dict[str, tuple[Estimator | None, Estimator]],
    fold: str = "fold",
    threshold: float = 0.5,
    parallelism: int = PARALLELISM,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """accuracy, precision, recall, f1 per model and fold; ``prepare`` runs on the training rows of each fold only.

    The folded rows are written once and laid out once (see ``FoldedRows``); every
    fit is a Spark job over that layout, a few at a time; all held-out predictions
    are evaluated in one aggregate.
    """
    rows = FoldedRows(folded, key, label, [m for pair in models.values() for m in _inputs(*pair)], fold, prepare)

    def held_out(task: tuple[str, object]) -> DataFrame:
        name, f = task
        scored = score(rows.fit(f, *models[name]), rows.held_out(f), threshold)
        return scored.select(F.lit(name).alias("model"), fold, label, "prediction")

    with rows:
        tasks = [(name, f) for name in models for f in rows.folds]
        parts = _in_parallel(rows.rows.sparkSession, held_out, tasks, parallelism)
    return classification_metrics(reduce(DataFrame.unionByName, parts), label, "prediction", ["model", fold])


def cv_summary(per_fold: DataFrame, metrics: Sequence[str] = ("f1", "recall")) -> DataFrame:
    """Mean and population std per model."""
    return per_fold.groupBy("model").agg(
        *[f(m).alias(f"{m}_{n}") for m in metrics for f, n in ((F.avg, "mean"), (F.stddev_pop, "std"))]
    )


def _inputs(encoder: Estimator | None, learner: Estimator) -> list[str]:
    return encoder.input_columns() if encoder is not None else [learner.getFeaturesCol()]


class FoldedRows:
    """Folded rows for any number of fits.

    The rows are written once, and shuffled once into the layout that repeatable
    fits need; a fold's training rows are a filter over it. Class sizes of all
    folds are one aggregate. Encoders, and ``prepare``, run once a fold and serve
    all candidates. The layout is kept on the executors; what a lost one held is
    computed again from the written rows.
    """

    def __init__(self, folded: DataFrame, key: str, label: str, inputs: Sequence[str], fold: str, prepare: Callable[[DataFrame], DataFrame] | None):
        self.key, self.label, self.fold, self.prepare = key, label, fold, prepare
        self.rows = stage_table(folded, "folds")
        counted = self.rows.groupBy(fold).agg(F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives"))
        self.counts = {r[fold]: r for r in counted.collect()}  # a row for each fold
        self.folds = sorted(self.counts)
        slim = self.rows if prepare else self.rows.select(*dict.fromkeys([key, label, fold, *inputs]))
        self.kept = [stable_layout(slim, key, sum(r["negatives"] + r["positives"] for r in self.counts.values())).persist(StorageLevel.MEMORY_AND_DISK)]
        self.given: dict = {}
        self.encoders: dict = {}
        self.lock = RLock()

    def __enter__(self) -> "FoldedRows":
        return self

    def __exit__(self, *_: object) -> None:
        for df in self.kept:
            df.unpersist()

    def held_out(self, value) -> DataFrame:
        return self.rows.where(F.col(self.fold) == value)

    def training(self, value) -> tuple[DataFrame, dict]:
        """The fold's training rows, laid out, and their class sizes."""
        with self.lock:
            if value not in self.given:
                train = self.kept[0].where(F.col(self.fold) != value)
                sizes = {c: sum(r[c] for f, r in self.counts.items() if f != value) for c in ("negatives", "positives")}
                if self.prepare:
                    made = self.prepare(train)
                    sizes = made.agg(F.count_if(F.col(self.label) == 0).alias("negatives"), F.count_if(F.col(self.label) == 1).alias("positives")).first().asDict()
                    train = stable_layout(made, self.key, sum(sizes.values())).persist(StorageLevel.MEMORY_AND_DISK)
                    self.kept.append(train)
                self.given[value] = train, sizes
            return self.given[value]

    def fit(self, value, encoder: Estimator | None, learner: Estimator) -> PipelineModel:
        train, sizes = self.training(value)
        fitted = None
        if encoder is not None:
            with self.lock:
                if (value, encoder.uid) not in self.encoders:
                    self.encoders[value, encoder.uid] = encoder.fit(train)
            fitted = self.encoders[value, encoder.uid]
        total = sizes["negatives"] + sizes["positives"]
        weights = {f"weight_{c}": total / (2 * n) if n else 1.0 for c, n in ((0, sizes["negatives"]), (1, sizes["positives"]))}
        return _fit_learner(with_class_weight(train, self.label, weights), self.key, self.label, fitted, learner, total)


def fold_values(folded: DataFrame, fold: str) -> list:
    """The distinct folds; each is one fit."""
    return [r[0] for r in folded.select(fold).distinct().orderBy(fold).collect()]


def _in_parallel(spark: SparkSession, fn: Callable, tasks: Sequence, parallelism: int) -> list:
    """Run driver-side calls that each start Spark jobs, a few at a time."""
    with ThreadPool(min(parallelism, len(tasks))) as pool:
        return pool.map(inheritable_thread_target(spark)(fn), tasks)


def out_of_fold(
    folded: DataFrame,
    key: str,
    label: str,
    encoder: Estimator | None,
    learner: Estimator,
    fold: str = "fold",
    threshold: float = 0.5,
    prepare: Callable[[DataFrame], DataFrame] | None = None,
    parallelism: int = PARALLELISM,
) -> DataFrame:
    """Every row scored by a model that never saw its fold.

    ``prepare`` runs on the training rows only (oversampling, for example).
    """
    with FoldedRows(folded, key, label, _inputs(encoder, learner), fold, prepare) as rows:

        def held_out(value) -> DataFrame:
            return score(rows.fit(value, encoder, learner), rows.held_out(value), threshold)

        return reduce(DataFrame.unionByName, _in_parallel(rows.rows.sparkSession, held_out, rows.folds, parallelism))


def param_grid(**choices: Sequence) -> list[dict]:
    """All combinations, first name varying slowest."""
    return [dict(zip(choices, values)) for values in product(*choices.values())]


def param_draws(n: int, seed: int, **choices: Sequence) -> list[dict]:
    """``n`` different combinations drawn with a seed; all of them if there are fewer."""
    import random

    grid = param_grid(**choices)
    return grid if n >= len(grid) else random.Random(seed).sample(grid, n)


def search(
    folded: DataFrame,
    key: str,
    label: str,
    encoder: Estimator | None,
    build: Callable[..., Estimator],
    candidates: Sequence[dict],
    metric: str = "f1",
) -> tuple[dict, DataFrame]:
    """(best parameters, mean metric per candidate). The first candidate wins a tie."""
    models = {str(i): (encoder, build(**c)) for i, c in enumerate(candidates)}
    # Written once: the held-out rows are scored for the best candidate and for the table in one go.
    per_fold = stage_table(cross_validate(folded, key, label, models), "search")
    table = per_fold.groupBy(F.col("model").cast("int").alias("candidate")).agg(F.avg(metric).alias(metric))
    rows = table.orderBy(F.col(metric).desc(), "candidate").collect()
    labels = F.create_map(*[x for i, c in enumerate(candidates) for x in (F.lit(i), F.lit(str(c)))])
    return candidates[rows[0]["candidate"]], table.withColumn("params", F.element_at(labels, F.col("candidate")))


def feature_importance(model: PipelineModel, names: Sequence[str], top: int = 20) -> DataFrame:
    """The ``top`` encoded features by importance. The model already lives on the driver."""
    values = [float(v) for v in model.stages[-1].featureImportances.toArray()]
    pairs = list(zip(names, values))
    df = SparkSession.active().createDataFrame(pairs, "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(top)


def encoder_of(model: PipelineModel) -> FeatureEncoderModel:
    return next(s for s in model.stages if isinstance(s, FeatureEncoderModel))


def same_predictions(a: DataFrame, b: DataFrame, key: str) -> bool:
    """Do two scored tables agree on every row?"""
    cols = [key, "prediction", "churn_probability"]
    return a.select(*cols).exceptAll(b.select(*cols)).isEmpty() and b.select(*cols).exceptAll(a.select(*cols)).isEmpty()


def default_encoder(numeric: Sequence[str], categorical: Sequence[str], ordinal: Sequence[str] = ()) -> FeatureEncoder:
    return FeatureEncoder(
        numericCols=list(numeric), categoricalCols=list(categorical), ordinalCols=list(ordinal), outputCol="features"
    )
