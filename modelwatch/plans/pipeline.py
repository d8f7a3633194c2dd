"""A training run as a series of stages that can be started again after a failure.

Each stage leaves a record under the run's folder when it has ended; the record is its commit marker. Started again, a
run skips the stages whose record stands and goes on with the first one that has none. A failed attempt leaves a record
of its own, which stops nothing.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.ml import Estimator, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.operators.checks import require_schema
from modelwatch.operators.joins import mark_members
from modelwatch.operators.membership import frozen_ids
from modelwatch.operators.metrics import METRICS, evaluate
from modelwatch.operators.training import fit_model, score
from modelwatch.plans.ingest import ingest, start_table
from modelwatch.plans.lifecycle import quality_gate
from modelwatch.schema import TableSpec
from modelwatch.sources.snapshots import read_current, read_version, snapshot_path
from modelwatch.sources.tables import path_exists

STAGES = ("load", "validate", "split", "fit", "evaluate", "gate", "registry")
RECORD = "run string, stage string, passed boolean, outcome string, values map<string,double>, error string"


class Run:
    """The stage records of one run."""

    def __init__(self, spark: SparkSession, root: str, name: str):
        self.spark, self.name, self.path = spark, name, f"{root}/runs/{name}"
        self.ran: list[str] = []  # what this start has done itself

    def stage(self, stage: str, work: Callable[[], tuple[str, dict[str, float]]]) -> tuple[str, dict[str, float]]:
        """(outcome, values) of a stage: from its record, or from ``work``, which is recorded then."""
        marker = f"{self.path}/{stage}"
        if path_exists(self.spark, f"{marker}/_SUCCESS"):
            row = self.spark.read.schema(RECORD).json(marker).first()
            return row["outcome"], row["values"] or {}
        try:
            outcome, values = work()
        except Exception as error:
            self._write(f"{self.path}/failures/{stage}-{uuid.uuid4().hex}", stage, False, None, {}, str(error)[:500])
            raise
        self._write(marker, stage, True, outcome, values, None)
        self.ran.append(stage)
        return outcome, values

    def _write(self, path: str, *record: object) -> None:
        self.spark.createDataFrame([(self.name, *record)], RECORD).coalesce(1).write.mode("overwrite").json(path)

    def log(self) -> DataFrame:
        """(run, stage, passed, outcome, values, error): stages that ended; a failure counts while its stage has not."""
        parts = [f"{self.path}/{s}" for s in STAGES if path_exists(self.spark, f"{self.path}/{s}/_SUCCESS")]
        done = self.spark.read.schema(RECORD).json(parts) if parts else self.spark.createDataFrame([], RECORD)
        if not path_exists(self.spark, f"{self.path}/failures"):
            return done
        failed = self.spark.read.schema(RECORD).json(f"{self.path}/failures/*").dropDuplicates(["stage"])
        return done.unionByName(failed.join(done.select("stage"), "stage", "left_anti").select(*done.columns))


def train_run(
    spark: SparkSession,
    root: str,
    name: str,
    original: DataFrame,
    batch: DataFrame | None,
    key: str,
    label: str,
    encoder: Estimator | None,
    learner: Estimator,
    *,
    holdout: Callable[[DataFrame], DataFrame],
    spec: TableSpec | None = None,
    metric: str = "recall",
    minimum: float = 0.70,
    threshold: float = 0.5,
    model_name: str = "churn_model",
) -> Run:
    """Take a batch in, check, split, fit, evaluate, judge, and register the version if it passes the gate.

    ``holdout`` makes the held-out ids from the first version; they are frozen then. A batch that is known, or none,
    ends the run after loading. What a stage makes for the next ones is in the run's folder: nothing is handed on in memory.
    """
    run = Run(spark, root, name)

    def load() -> tuple[str, dict[str, float]]:
        if not path_exists(spark, f"{snapshot_path(root, 1)}/_SUCCESS"):
            start_table(original, root)
        report = ingest(spark, batch, root, key, spec=spec, source=name).first()
        return report["status"], {"current_rows": float(report["current_rows"] or 0)}

    def validate() -> tuple[str, dict[str, float]]:
        if spec is not None:
            require_schema(read_current(spark, root), spec)
        return "valid", {}

    def split() -> tuple[str, dict[str, float]]:
        ids = frozen_ids(spark, f"{root}/holdout", lambda: holdout(read_version(spark, root, 1)).select(key))
        return "frozen", {"held_out": float(ids.count())}

    def sides() -> DataFrame:
        return mark_members(read_current(spark, root), spark.read.parquet(f"{root}/holdout"), key, "_held_out")

    def fit() -> tuple[str, dict[str, float]]:
        train = sides().where("not _held_out").drop("_held_out")
        fit_model(train, key, label, encoder, learner).write().overwrite().save(f"{run.path}/model")
        return "fitted", {}

    def evaluate_model() -> tuple[str, dict[str, float]]:
        rows = sides().where("_held_out").drop("_held_out")
        scored = score(PipelineModel.load(f"{run.path}/model"), rows, threshold)
        row = evaluate(scored, label, "prediction", "churn_probability").first()
        return "evaluated", {m: float(row[m]) for m in METRICS if row[m] is not None}

    outcome, _ = run.stage("load", load)
    if outcome != "ingested":
        return run
    run.stage("validate", validate)
    run.stage("split", split)
    run.stage("fit", fit)
    _, values = run.stage("evaluate", evaluate_model)

    def gate() -> tuple[str, dict[str, float]]:
        table = spark.createDataFrame(list(values.items()), "metric string, value double")
        row = quality_gate(table, metric, minimum).first()
        return row["status"], {metric: row["value"], "minimum": row["minimum"]}

    verdict, _ = run.stage("gate", gate)

    def register() -> tuple[str, dict[str, float]]:
        if verdict != "PASSED":
            return "not_registered", {}
        versions = read_versions(spark, root)
        number = (versions.where(F.col("name") == model_name).agg(F.max("version")).first()[0] or 0) + 1
        entry = [(model_name, number, "Staging", name, f"{run.path}/model", values)]
        # The run names the folder: a repeated stage overwrites its own entry.
        spark.createDataFrame(entry, VERSION_ROW).coalesce(1).write.mode("overwrite").json(f"{root}/registry/run={name}")
        return "registered", {"version": float(number)}

    run.stage("registry", register)
    return run


VERSION_ROW = "name string, version int, stage string, run_id string, path string, metrics map<string,double>"


def read_versions(spark: SparkSession, root: str) -> DataFrame:
    """The registered versions with their metrics."""
    if not path_exists(spark, f"{root}/registry"):
        return spark.createDataFrame([], VERSION_ROW)
    return spark.read.schema(VERSION_ROW).json(f"{root}/registry/run=*")


def version_metric_rows(versions: DataFrame) -> DataFrame:
    """(run_id, metric, value), as registry decisions read them."""
    return versions.select("run_id", F.explode("metrics").alias("metric", "value"))
