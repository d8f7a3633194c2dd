"""Retrain trigger and stage roll-up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.functions.scalars import any_cell_equals
from modelwatch.operators.drift import NO_DATA


def trigger_status(
    analysed: Column, drift: Column, has_batch: Column, load_status: Column, run_passed: Column
) -> Column:
    """The outcome of one monitoring cycle."""
    ingested = F.coalesce(load_status == "ingested", F.lit(False))
    passed = F.coalesce(run_passed, F.lit(False))
    return (
        F.when(~analysed, "drift_analysis_failed")
        .when(~drift, "no_drift")
        .when(~has_batch, "drift_waiting_for_data")
        .when(ingested & passed, "retraining_completed")
        .when(ingested, "retraining_failed")
        .otherwise("no_new_data_retraining_skipped")
    )


def trigger_decision(cycles: DataFrame) -> DataFrame:
    """Decision row per cycle from (analysed, drift_detected, new_data_present, data_load_status, run_passed)."""
    called = F.col("analysed") & F.col("drift_detected") & F.col("new_data_present")
    ingested = called & F.coalesce(F.col("data_load_status") == "ingested", F.lit(False))
    status = trigger_status(
        F.col("analysed"),
        F.col("drift_detected"),
        F.col("new_data_present"),
        F.col("data_load_status"),
        F.col("run_passed"),
    )
    return cycles.select(
        *[c for c in cycles.columns if c not in ("drift_detected",)],
        (F.col("analysed") & F.col("drift_detected")).alias("drift_detected"),
        status.alias("status"),
        called.alias("pipeline_called"),
        F.when(called, F.when(F.col("run_passed"), "passed").otherwise("failed")).alias("pipeline_status"),
        ingested.alias("new_data_ingested"),
        (ingested & F.coalesce("run_passed", F.lit(False))).alias("retraining_executed"),
    )


def run_cycle(summary: DataFrame, has_batch: bool, retrain: Callable[[], tuple[str, bool]]) -> DataFrame:
    """Check the drift summary and call ``retrain`` only on drift with a batch at hand.

    ``retrain`` returns (load status, passed). The analysis has failed where the
    job that makes the summary fails, or a feature had no data on one side.
    """
    try:
        analysed = not any_cell_equals(summary, NO_DATA).first()["found"]
        drift = analysed and bool(any_cell_equals(summary, "DRIFT").first()["found"])
    except PySparkException:
        analysed = drift = False
    load_status, passed = retrain() if drift and has_batch else (None, None)
    schema = (
        "analysed boolean, drift_detected boolean, new_data_present boolean, data_load_status string, run_passed boolean"
    )
    cycle = summary.sparkSession.createDataFrame([(analysed, drift, has_batch, load_status, passed)], schema)
    return trigger_decision(cycle).withColumn("timestamp", F.current_timestamp())


def stage_rollup(stage_log: DataFrame, expected: list[str], stop_after: str = "load") -> DataFrame:
    """Per run: NO_NEW_DATA when loading passed and found nothing new, PASSED when all expected stages passed, else FAILED.

    ``stage_log``: run, stage, passed, outcome.
    """
    nothing_new = (F.col("stage") == stop_after) & F.col("outcome").isin("already_ingested", "no_new_data")
    known = F.col("stage").isin(*expected)
    runs = stage_log.groupBy("run").agg(
        F.count_distinct(F.when(known & F.col("passed"), F.col("stage"))).alias("stages_passed"),
        F.coalesce(F.bool_and("passed"), F.lit(False)).alias("_all"),
        F.coalesce(F.bool_or(nothing_new), F.lit(False)).alias("stopped_early"),
    )
    complete = F.col("_all") & (F.col("stages_passed") == len(expected))
    return runs.select(
        "run",
        "stages_passed",
        F.lit(len(expected)).alias("stages_expected"),
        "stopped_early",
        F.when(F.col("_all") & F.col("stopped_early"), "NO_NEW_DATA").when(complete, "PASSED").otherwise("FAILED").alias("status"),
    )
