"""Registry decisions, trigger outcomes, stage roll-up."""

import pytest

from modelwatch.plans import lifecycle, trigger

VERSION = "name string, version int, stage string, run_id string"
METRIC = "run_id string, metric string, value double"


def decide(spark, versions, metrics, **kw):
    v = spark.createDataFrame([("m", n, s, f"r{n}") for n, s in versions], VERSION)
    m = spark.createDataFrame([(f"r{n}", "recall", x) for n, x in metrics], METRIC)
    d = lifecycle.decide(v, m, **kw)
    after = {r["version"]: r["stage"] for r in lifecycle.apply_decision(v, d).collect()}
    return d.first(), after


def test_recorded_decision(spark):
    d, after = decide(spark, [(17, "None"), (1, "Production")], [(17, 0.72193), (1, 0.78075)])
    assert (d["decision"], d["promoted"], d["production_version_after"]) == ("ARCHIVED", False, 1)
    assert (d["candidate_version"], d["candidate_metric"]) == (17, 0.72193)
    assert after == {17: "Archived", 1: "Production"}


def test_better_candidate_replaces_production(spark):
    d, after = decide(spark, [(3, "Staging"), (2, "Staging"), (1, "Production")], [(3, 0.9), (2, 0.8), (1, 0.7)])
    assert (d["decision"], d["production_version_after"]) == ("PROMOTED", 3)
    assert after == {3: "Production", 2: "Archived", 1: "Archived"}


def test_tie_is_not_promoted(spark):
    d, _ = decide(spark, [(2, "Staging"), (1, "Production")], [(2, 0.8), (1, 0.8)])
    assert d["decision"] == "ARCHIVED"


def test_equal_candidates_lowest_version_wins(spark):
    d, _ = decide(spark, [(5, "Staging"), (4, "Staging")], [(5, 0.8), (4, 0.8)])
    assert (d["decision"], d["candidate_version"]) == ("PROMOTED", 4)


def test_nothing_staged(spark):
    d, after = decide(spark, [(1, "Production"), (2, "Archived")], [(1, 0.8)])
    assert (d["decision"], d["production_version_after"]) == ("NO_CANDIDATE", 1)
    assert after == {1: "Production", 2: "Archived"}


def test_missing_metric_counts_as_zero(spark):
    d, _ = decide(spark, [(2, "Staging"), (1, "Production")], [(2, 0.1)])
    assert (d["decision"], d["production_metric_before"]) == ("PROMOTED", 0.0)


def test_optional_floor_keeps_weak_versions_out(spark):
    d, _ = decide(spark, [(2, "Staging")], [(2, 0.5)], min_metric=0.7)
    assert d["decision"] == "NO_CANDIDATE"


def test_recorded_gate(spark):
    m = spark.createDataFrame([("recall", 0.7219)], "metric string, value double")
    row = lifecycle.quality_gate(m).first()
    assert (row["status"], row["passed"]) == ("PASSED", True)
    assert lifecycle.quality_gate(m, "f1").first()["value"] == 0.0


def test_production_must_be_unique(spark):
    v = spark.createDataFrame([("m", 1, "Production", "a"), ("m", 2, "Production", "b")], VERSION)
    with pytest.raises(ValueError):
        lifecycle.require_one_production(v)
    lifecycle.require_one_production(v.where("version = 1"))


@pytest.mark.parametrize(
    "cycle, status",
    [
        ((False, False, True, None, None), "drift_analysis_failed"),
        ((True, False, True, None, None), "no_drift"),
        ((True, True, False, None, None), "drift_waiting_for_data"),
        ((True, True, True, "ingested", True), "retraining_completed"),
        ((True, True, True, "ingested", False), "retraining_failed"),
        ((True, True, True, "already_ingested", True), "no_new_data_retraining_skipped"),
    ],
)
def test_trigger_outcomes(spark, cycle, status):
    schema = "analysed boolean, drift_detected boolean, new_data_present boolean, data_load_status string, run_passed boolean"
    row = trigger.trigger_decision(spark.createDataFrame([cycle], schema)).first()
    assert row["status"] == status
    assert row["retraining_executed"] == (status == "retraining_completed")


def test_cycle_calls_retraining_only_when_needed(spark):
    calls = []

    def retrain():
        calls.append(1)
        return "ingested", True

    quiet = spark.createDataFrame([("a", "OK")], "metric string, status string")
    loud = spark.createDataFrame([("a", " drift ")], "metric string, status string")
    assert trigger.run_cycle(quiet, True, retrain).first()["status"] == "no_drift"
    assert trigger.run_cycle(loud, False, retrain).first()["status"] == "drift_waiting_for_data"
    assert not calls
    assert trigger.run_cycle(loud, True, retrain).first()["status"] == "retraining_completed"
    assert len(calls) == 1
    empty_side = spark.createDataFrame([("a", "DRIFT"), ("b", "NO_DATA")], "metric string, status string")
    broken = spark.range(1).selectExpr("'a' AS metric", "raise_error('no baseline') AS status")
    for summary in (empty_side, broken):
        assert trigger.run_cycle(summary, True, retrain).first()["status"] == "drift_analysis_failed"
    assert len(calls) == 1


def test_stage_rollup(spark):
    rows = [
        ("full", "load", True, "ingested"),
        ("full", "fit", True, None),
        ("broken", "load", True, "ingested"),
        ("broken", "fit", False, None),
        ("short", "load", True, "ingested"),
        ("idle", "load", True, "no_new_data"),
    ]
    df = spark.createDataFrame(rows, "run string, stage string, passed boolean, outcome string")
    got = {r["run"]: r["status"] for r in trigger.stage_rollup(df, ["load", "fit"]).collect()}
    assert got == {"full": "PASSED", "broken": "FAILED", "short": "FAILED", "idle": "NO_NEW_DATA"}
