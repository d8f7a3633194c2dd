"""Inference log: event construction and the three reports over it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.operators.joins import null_safe_join
from modelwatch.operators.ordered import ROWS_PER_BLOCK, exact_quantiles
from modelwatch.operators.profile import describe


def to_log_events(
    scored: DataFrame,
    features: Sequence[str],
    *,
    model_name: str,
    model_version: str,
    run_id: str,
    latency_ms: Column | None = None,
    error: Column | None = None,
    request_id: Column | None = None,
) -> DataFrame:
    """One event per scored row. The payload leaves the id out; a failure has no prediction."""
    failed = error.isNotNull() if error is not None else F.lit(False)
    empty = F.lit(None)
    return scored.select(
        (request_id if request_id is not None else F.substring(F.replace(F.uuid(), F.lit("-"), F.lit("")), 1, 12)).alias(
            "request_id"
        ),
        F.current_timestamp().alias("timestamp"),
        F.struct(*features).alias("input"),
        F.when(~failed, F.col("prediction")).cast("int").alias("prediction"),
        F.when(~failed, F.col("churn_probability")).cast("double").alias("churn_probability"),
        (latency_ms if latency_ms is not None else empty).cast("double").alias("latency_ms"),
        F.when(failed, "failure").otherwise("success").alias("status"),
        (error if error is not None else empty).cast("string").alias("error"),
        F.lit(model_name).alias("model_name"),
        F.lit(model_version).alias("model_version"),
        F.lit(run_id).alias("run_id"),
    )


def latency_summary(log: DataFrame, by: Sequence[str] = (), rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Mean, median, p95, min and max of the latencies present."""
    by = list(by)
    plain = (
        log.where(F.col("latency_ms").isNotNull())
        .groupBy(*by)
        .agg(
            F.count("latency_ms").alias("measured"),
            F.avg("latency_ms").alias("mean_ms"),
            F.min("latency_ms").alias("min_ms"),
            F.max("latency_ms").alias("max_ms"),
        )
    )
    marks = exact_quantiles(log, ["latency_ms"], [0.5, 0.95], by, rows_per_block=rows_per_block).select(
        *by, F.col("q0").alias("median_ms"), F.col("q1").alias("p95_ms")
    )
    if by:
        return null_safe_join(plain, marks, by)
    one = marks.agg(F.struct(F.max("median_ms").alias("m"), F.max("p95_ms").alias("p"))).scalar()
    return plain.select("*", one.getField("m").alias("median_ms"), one.getField("p").alias("p95_ms"))


def reliability(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Requests, successes, failures and their percentages."""
    return (
        log.groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(F.col("status") == "success").alias("successes"),
            F.count_if(F.col("status") == "failure").alias("failures"),
        )
        .select(
            "*",
            F.try_divide(F.col("successes") * 100.0, "requests").alias("success_percent"),
            F.try_divide(F.col("failures") * 100.0, "requests").alias("failure_percent"),
        )
    )


def status_distribution(log: DataFrame) -> DataFrame:
    return log.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def throughput(log: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Events per second between the first and the last one; NULL when they coincide."""
    span = (F.unix_micros(F.max("timestamp")) - F.unix_micros(F.min("timestamp"))) / 1e6
    return log.groupBy(*by).agg(
        F.count(F.lit(1)).alias("requests"),
        span.alias("elapsed_s"),
        F.try_divide(F.count(F.lit(1)).cast("double"), span).alias("requests_per_s"),
    )


def service_report(log: DataFrame, by: Sequence[str] = ("model_version",)) -> DataFrame:
    """Reliability, throughput and latency together, per group."""
    by = list(by)
    rel = reliability(log, by)
    thr = throughput(log, by).drop("requests")
    return null_safe_join(null_safe_join(rel, thr, by), latency_summary(log, by), by, "left")


def prediction_counts(log: DataFrame) -> DataFrame:
    """Count per predicted class and its share of all events, failures included, to 2 places."""
    total = log.agg(F.count(F.lit(1))).scalar()
    return (
        log.where(F.col("prediction").isNotNull())
        .groupBy("prediction")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("percent", F.round(F.col("n") * 100.0 / total, 2))
    )


def probability_profile(log: DataFrame) -> DataFrame:
    return describe(log, ["churn_probability"])


def latest_model(log: DataFrame, tie: str = "request_id") -> DataFrame:
    """Model identity on the latest event."""
    newest = F.max_by(F.struct("model_name", "model_version", "run_id"), F.struct("timestamp", tie))
    return log.agg(newest.alias("m")).select("m.*")


def prediction_report(log: DataFrame) -> DataFrame:
    """One row per class with the probability profile and the latest model beside it."""
    profile = describe(log, ["churn_probability"]).agg(
        F.struct(*[F.max(c).alias(c) for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")])
    )
    model = latest_model(log).select(F.struct("*"))
    p, m = profile.scalar(), model.scalar()
    return prediction_counts(log).select(
        "*",
        *[p.getField(c).alias(f"probability_{c}") for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")],
        *[m.getField(c).alias(c) for c in ("model_name", "model_version", "run_id")],
    )


HISTORY = ("request_id", "timestamp", "prediction", "churn_probability", "latency_ms", "status", "model_version")
FAILURES = ("request_id", "timestamp", "status", "error", "model_version")


def last_events(log: DataFrame, n: int = 10) -> DataFrame:
    """The newest ``n`` events; equal times are ordered by request id."""
    return log.select(*HISTORY).orderBy(F.col("timestamp").desc(), F.col("request_id").desc()).limit(n)


def failures(log: DataFrame) -> DataFrame:
    return log.where(F.col("status") == "failure").select(*FAILURES)


def find_request(log: DataFrame, request_id: str) -> DataFrame:
    return log.where(F.col("request_id") == request_id)


def history_report(log: DataFrame, n: int = 10) -> DataFrame:
    """The newest events with the totals of the whole log beside each."""
    totals = log.agg(
        F.struct(F.count(F.lit(1)).alias("t"), F.count_if(F.col("status") == "failure").alias("f"))
    ).scalar()
    return last_events(log, n).select(
        "*", totals.getField("t").alias("total_events"), totals.getField("f").alias("total_failures")
    )
