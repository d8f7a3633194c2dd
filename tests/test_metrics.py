"""Metrics and drift against recorded values and numpy brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelwatch.operators import drift, metrics


def expand(spark, tn, fp, fn, tp):
    cells = spark.createDataFrame([(0, 0, tn), (0, 1, fp), (1, 0, fn), (1, 1, tp)], "y int, p int, n int")
    return cells.select("y", "p", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))


def test_recorded_confusion_matrix(spark):
    row = metrics.classification_metrics(expand(spark, 811, 224, 104, 270), "y", "p").first()
    assert (row["tn"], row["fp"], row["fn"], row["tp"]) == (811, 224, 104, 270)
    assert round(row["accuracy"], 4) == 0.7672
    assert round(row["precision"], 4) == 0.5466
    assert round(row["recall"], 4) == 0.7219
    assert round(row["f1"], 4) == 0.6221


def test_zero_denominators_are_zero(spark):
    df = spark.createDataFrame([(0, 0), (0, 0)], "y int, p int")
    row = metrics.classification_metrics(df, "y", "p").first()
    assert (row["accuracy"], row["precision"], row["recall"], row["f1"]) == (1.0, 0.0, 0.0, 0.0)


def brute_auc(y, s):
    pos, neg = s[y == 1], s[y == 0]
    return np.mean([(p > neg).mean() + 0.5 * (p == neg).mean() for p in pos])


def brute_ap(y, s):
    total, last = 0.0, 0.0
    for t in sorted(set(s), reverse=True):
        hit = s >= t
        recall, precision = y[hit].sum() / y.sum(), y[hit].mean()
        total, last = total + (recall - last) * precision, recall
    return total


@pytest.mark.parametrize("cuts", [[], [0.2, 0.5, 0.9]])
def test_ranking_metrics_equal_brute_force(spark, cuts):
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 300)
    s = np.round(rng.random(300) * 0.6 + y * 0.3, 2)
    s[:100] = 0.5
    df = spark.createDataFrame([(int(a), float(b), int(b >= 0.5)) for a, b in zip(y, s)], "y int, s double, p int")
    given = {"s": cuts}
    assert math.isclose(metrics.roc_auc(df, "y", "s", cuts=given).first()["roc_auc"], brute_auc(y, s), abs_tol=1e-12)
    ap = metrics.average_precision(df, "y", "s", cuts=given).first()["average_precision"]
    assert math.isclose(ap, brute_ap(y, s), abs_tol=1e-12)
    row = metrics.evaluate(df, "y", "p", "s", cuts=given).first()
    assert row["samples"] == 300 and math.isclose(row["roc_auc"], brute_auc(y, s), abs_tol=1e-12)


def test_auc_with_one_class_is_null(spark):
    df = spark.createDataFrame([(1, 0.2), (1, 0.4)], "y int, s double")
    assert metrics.roc_auc(df, "y", "s").first()["roc_auc"] is None


def test_sweep_has_sixteen_thresholds(spark):
    df = spark.createDataFrame([(1, 0.45), (0, 0.45), (1, 0.9), (0, 0.05)], "y int, s double")
    rows = {round(r["threshold"], 2): r for r in metrics.threshold_sweep(df, "y", "s").collect()}
    assert len(rows) == 16 and min(rows) == 0.1 and max(rows) == 0.85
    assert (rows[0.45]["tp"], rows[0.45]["fp"]) == (2, 1)
    assert (rows[0.5]["tp"], rows[0.5]["fp"], rows[0.5]["fn"], rows[0.5]["tn"]) == (1, 0, 1, 2)


def brute_ks(a, b):
    grid = np.unique(np.concatenate([a, b]))
    return max(abs((a <= g).mean() - (b <= g).mean()) for g in grid)


@pytest.mark.parametrize("cuts", [{"v": []}, {"v": [-1.0, 0.0, 0.7]}])
def test_ks_equals_brute_force(spark, cuts):
    rng = np.random.default_rng(8)
    a = np.concatenate([rng.normal(size=200), np.full(100, 0.5)])
    b = np.concatenate([rng.normal(0.3, 1, size=150), np.full(20, 0.5)])
    mine = spark.createDataFrame([(float(x),) for x in a] + [(None,), (float("nan"),)], "v double")
    other = spark.createDataFrame([(float(x),) for x in b], "v double")
    row = drift.ks_statistic(drift.two_tables(mine, other), ["v"], cuts=cuts).first()
    assert math.isclose(row["score"], brute_ks(a, b), abs_tol=1e-12)
    assert (row["n_baseline"], row["n_current"]) == (300, 170)
    x = math.sqrt(300 * 170 / 470) * row["score"]
    assert math.isclose(
        row["p_value"], 2 * sum((-1) ** (j - 1) * math.exp(-2 * j * j * x * x) for j in range(1, 101)), abs_tol=1e-9
    )


def test_ks_with_many_blocks_and_columns(spark):
    """Cuts from the data itself; only some blocks are looked into, the answer is the same."""
    rng = np.random.default_rng(11)
    a, b = rng.normal(size=(400, 3)), rng.normal(0.1, 1.2, size=(300, 3))
    b[:, 2] = np.where(rng.random(300) < 0.4, 0.25, b[:, 2])
    cols = ["u", "v", "w"]

    def frame(m):
        return spark.createDataFrame([tuple(map(float, r)) for r in m], "u double, v double, w double")

    both = drift.two_tables(frame(a), frame(b))
    cuts = drift.block_cuts(both, cols, rows_per_block=50, max_blocks=20)
    got = {r["feature"]: r["score"] for r in drift.ks_statistic(both, cols, cuts=cuts).collect()}
    for i, c in enumerate(cols):
        assert math.isclose(got[c], brute_ks(a[:, i], b[:, i]), abs_tol=1e-12)


@pytest.mark.parametrize("shift", [0.0, 0.05, 2.0])
def test_ks_cuts_crowded_blocks_again(spark, shift):
    """Few first cuts, a hot value and a long tail; a narrow gap hides inside one block."""
    rng = np.random.default_rng(12)
    a = np.r_[np.exp(rng.normal(0, 4, 1500)), np.full(400, 2.0), rng.uniform(5, 5.001, 300)]
    b = np.r_[np.exp(rng.normal(shift, 4, 1300)), np.full(100, 2.0), rng.uniform(5.0005, 5.0015, 500)]
    both = drift.two_tables(*(spark.createDataFrame([(float(x),) for x in m], "v double") for m in (a, b)))
    row = drift.ks_statistic(both, ["v"], cuts={"v": [1.0, 100.0]}, rows_per_block=25).first()
    assert math.isclose(row["score"], brute_ks(a, b), abs_tol=1e-12)


def test_equal_samples_do_not_drift(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("v"), (F.col("id") % 3).cast("string").alias("c"))
    rows = drift.data_drift_report(drift.two_tables(df, df), ["v"], ["c"]).collect()
    assert {(r["feature"], r["score"], r["status"]) for r in rows} == {("v", 0.0, "OK"), ("c", 0.0, "OK")}
    assert [r["p_value"] for r in rows if r["feature"] == "v"] == [1.0]


def test_js_with_disjoint_categories_is_one(spark):
    a = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    b = spark.createDataFrame([("z",)], "c string")
    row = drift.js_divergence(drift.two_tables(a, b), ["c"]).first()
    assert math.isclose(row["score"], 1.0) and row["status"] == "DRIFT"


def test_empty_side_gives_null(spark):
    a = spark.createDataFrame([("x", 1.0)], "c string, v double")
    empty = a.where("v > 5")
    assert drift.js_divergence(drift.two_tables(a, empty), ["c"]).first()["score"] is None
    assert drift.ks_statistic(drift.two_tables(a, empty), ["v"]).first()["score"] is None


def test_concept_drift_tolerance(spark):
    concept = spark.createDataFrame([("recall", 0.8, 0.79, -0.01)], "metric string, baseline double, evolved double, change double")
    data = spark.createDataFrame([("v", "OK")], "feature string, status string")
    pred = spark.createDataFrame(
        [(0.01, "OK", 0.02, "OK")],
        "prediction_distribution_ks double, prediction_distribution_status string, "
        "probability_distribution_ks double, probability_distribution_status string",
    )
    assert drift.overall_status(drift.drift_summary(data, pred, concept)).first()["drift_detected"]
    assert not drift.overall_status(drift.drift_summary(data, pred, concept, 0.05)).first()["drift_detected"]
