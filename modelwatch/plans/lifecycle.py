"""Registry decisions as tables: gate, champion against challenger, stage changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.operators.joins import null_safe_join

STAGES = ("None", "Staging", "Production", "Archived")


def quality_gate(metrics: DataFrame, metric: str = "recall", minimum: float = 0.70) -> DataFrame:
    """One row from a (metric, value) table; an absent metric counts as 0."""
    value = F.coalesce(F.max(F.when(F.col("metric") == metric, F.col("value"))), F.lit(0.0))
    return metrics.agg(value.alias("value")).select(
        F.lit(metric).alias("metric"),
        "value",
        F.lit(minimum).alias("minimum"),
        (F.col("value") >= minimum).alias("passed"),
        F.when(F.col("value") >= minimum, "PASSED").otherwise("FAILED").alias("status"),
    )


def version_metrics(versions: DataFrame, metrics: DataFrame, metric: str) -> DataFrame:
    """Every version with the value of one metric; a missing value is 0."""
    wanted = metrics.where(F.col("metric") == metric).groupBy("run_id").agg(F.max("value").alias("score"))
    return versions.join(wanted, "run_id", "left").withColumn("score", F.coalesce("score", F.lit(0.0)))


def by_version_desc(versions: DataFrame) -> DataFrame:
    return versions.orderBy(F.col("version").cast("int").desc())


def intake(versions: DataFrame) -> DataFrame:
    """New versions enter Staging."""
    return versions.withColumn("stage", F.when(F.col("stage") == "None", "Staging").otherwise(F.col("stage")))


def best_version(scored: DataFrame, by: list[str], floor: float = -1.0) -> DataFrame:
    """Per group the highest score strictly above ``floor``; the lowest version wins a tie."""
    best = F.max_by(F.struct("version", "run_id", "score"), F.struct(F.col("score"), -F.col("version")))
    return scored.where(F.col("score") > floor).groupBy(*by).agg(best.alias("b")).select(*by, "b.*")


def production_check(versions: DataFrame) -> DataFrame:
    """One row per model: how many Production versions, and is it exactly one?"""
    return versions.groupBy("name").agg(F.count_if(F.col("stage") == "Production").alias("production")).withColumn(
        "valid", F.col("production") == 1
    )


def require_one_production(versions: DataFrame) -> None:
    bad = production_check(versions).where(~F.col("valid")).limit(1).collect()
    if bad:
        raise ValueError(f"{bad[0]['name']}: {bad[0]['production']} Production versions, expected 1")


def decide(
    versions: DataFrame, metrics: DataFrame, metric: str = "recall", min_metric: float | None = None
) -> DataFrame:
    """One lifecycle row per model name.

    The best staged version is promoted when it is strictly better than the one in
    Production or when there is none; otherwise archived; with nothing staged the
    decision is NO_CANDIDATE. ``min_metric`` optionally keeps weak versions out.
    """
    scored = version_metrics(intake(versions), metrics, metric)
    staged = F.col("stage") == "Staging"
    if min_metric is not None:
        staged = staged & (F.col("score") >= min_metric)
    entry = F.struct("version", "run_id", "score")
    order = F.struct(F.col("score"), -F.col("version"))
    eligible = staged & (F.col("score") > -1.0)
    rows = scored.groupBy("name").agg(
        F.max_by(F.when(eligible, entry), F.when(eligible, order)).alias("candidate"),
        F.min_by(
            F.when(F.col("stage") == "Production", entry), F.when(F.col("stage") == "Production", F.col("version"))
        ).alias("production"),
    )
    cand, prod = F.col("candidate"), F.col("production")
    promoted = F.coalesce(
        cand.isNotNull() & (prod.isNull() | (cand["score"] > prod["score"])), F.lit(False)
    )
    return rows.select(
        "name",
        F.lit(metric).alias("decision_metric"),
        cand["version"].alias("candidate_version"),
        cand["run_id"].alias("candidate_run_id"),
        cand["score"].alias("candidate_metric"),
        prod["version"].alias("production_version_before"),
        prod["score"].alias("production_metric_before"),
        promoted.alias("promoted"),
        F.when(cand.isNull(), "NO_CANDIDATE").when(promoted, "PROMOTED").otherwise("ARCHIVED").alias("decision"),
        F.when(promoted, cand["version"]).otherwise(prod["version"]).alias("production_version_after"),
    )


def apply_decision(versions: DataFrame, decision: DataFrame) -> DataFrame:
    """The registry afterwards: winner to Production, old Production and all Staging to Archived."""
    known = decision.select("name", "promoted", "decision", "candidate_version")
    rows = null_safe_join(intake(versions), known, ["name"])
    won = F.col("promoted") & (F.col("version") == F.col("candidate_version"))
    replaced = F.col("promoted") & (F.col("stage") == "Production")
    passed_over = (F.col("decision") != "NO_CANDIDATE") & (F.col("stage") == "Staging")
    stage = F.when(won, "Production").when(replaced | passed_over, "Archived").otherwise(F.col("stage"))
    return rows.select(*[stage.alias("stage") if c == "stage" else F.col(c) for c in versions.columns])


def candidate_record(
    candidate: DataFrame,
    versions: DataFrame,
    metrics: DataFrame,
    metric: str = "recall",
    minimum: float = 0.70,
    first_version: int = 1,
) -> DataFrame:
    """Registration record of retrained candidates (name, version, run_id, source_run_id, metric values).

    ``candidate`` carries ``score`` (decision metric) and ``recall``. It is staged
    whatever the gate says; Production does not change here.
    """
    scored = version_metrics(versions, metrics, metric)
    here = scored.groupBy("name").agg(
        F.min(F.when(F.col("stage") == "Production", F.col("version"))).alias("production_version"),
        F.min_by(
            F.when(F.col("stage") == "Production", F.col("score")),
            F.when(F.col("stage") == "Production", F.col("version")),
        ).alias("production_score"),
        F.max(F.when(F.col("version") == first_version, F.col("score"))).alias("first_score"),
    )
    rows = null_safe_join(candidate, here, ["name"], "left")
    improves = F.coalesce(F.col("score") > F.col("production_score"), F.lit(True))
    return rows.select(
        "name",
        F.col("version").alias("registered_version"),
        F.col("run_id").alias("registered_run_id"),
        F.col("source_run_id").alias("source_retraining_run_id"),
        F.lit("Staging").alias("stage"),
        F.col("production_version").alias("production_version_before"),
        F.col("production_version").alias("production_version_after"),
        F.lit(metric).alias("decision_metric"),
        F.col("score").alias("candidate_metric"),
        F.col("recall").alias("candidate_recall"),
        F.when(F.col("recall") >= minimum, "PASSED").otherwise("FAILED").alias("quality_gate"),
        improves.alias("improves_production"),
        F.when(improves, "IMPROVED").otherwise("NOT_IMPROVED").alias("comparison_with_production"),
        (F.col("score") - F.col("first_score")).alias("delta_to_first"),
        F.lit(False).alias("promotion_to_production"),
    )


def production_report(versions: DataFrame, metrics: DataFrame, names: tuple[str, ...]) -> DataFrame:
    """Each Production version with its run and metrics; a missing metric is 0."""
    live = versions.where(F.col("stage") == "Production")

    def value(m: str) -> Column:
        return F.coalesce(F.max(F.when(F.col("metric") == m, F.col("value"))), F.lit(0.0)).alias(m)

    return live.join(metrics, "run_id", "left").groupBy("name", "version", "run_id").agg(*[value(m) for m in names])
