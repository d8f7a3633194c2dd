"""Order statistics against brute force, with and without blocks, with hot values."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from modelwatch.operators import ordered, profile

VALUES = st.lists(
    st.one_of(st.integers(-5, 5).map(float), st.floats(-1e6, 1e6, allow_nan=False)), min_size=1, max_size=60
)


def column(spark, values, name="v"):
    return spark.createDataFrame([(float(v),) for v in values], f"{name} double")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=VALUES)
def test_quantiles_equal_numpy(spark, values):
    probs = [0.0, 0.25, 0.5, 0.95, 1.0]
    df = column(spark, values)
    expected = np.quantile(np.array(values), probs)
    for cuts in ({"v": []}, {"v": [-3.0, 0.0, 2.0, 1000.0]}):
        row = ordered.exact_quantiles(df, ["v"], probs, cuts=cuts).first()
        assert row["n"] == len(values)
        assert np.allclose([row[f"q{i}"] for i in range(5)], expected, rtol=1e-9, atol=1e-9)


def test_quantiles_per_group_with_hot_value_and_null_group(spark):
    rng = np.random.default_rng(1)
    rows = [(g, float(v)) for g in ("a", "b", None) for v in np.concatenate([np.full(50, 7.0), rng.normal(size=100)])]
    df = spark.createDataFrame(rows, "g string, v double")
    cuts = ordered.block_cuts(df, ["v"], rows_per_block=40)
    assert cuts["v"]
    for r in ordered.exact_quantiles(df, ["v"], [0.1, 0.5], ["g"], cuts).collect():
        mine = np.array([v for g, v in rows if g == r["g"]])
        assert np.allclose([r["q0"], r["q1"]], np.quantile(mine, [0.1, 0.5]))
        assert r["n"] == 150


def test_nan_and_null_are_missing(spark):
    df = spark.createDataFrame([(1.0,), (None,), (float("nan"),), (3.0,)], "v double")
    row = ordered.exact_quantiles(df, ["v"], [0.5]).first()
    assert (row["n"], row["q0"]) == (2, 2.0)


def test_cuts_only_appear_when_data_is_large(spark):
    df = spark.range(1000).select(F.col("id").cast("double").alias("v"))
    assert ordered.block_cuts(df, ["v"]) == {"v": []}
    cuts = ordered.block_cuts(df, ["v"], rows_per_block=100, max_blocks=10)["v"]
    assert 5 <= len(cuts) <= 9 and cuts == sorted(set(cuts))


@pytest.mark.parametrize("cuts", [[], [2.0, 5.0, 7.5]])
def test_running_totals(spark, cuts):
    rows = [(g, float(v), v * 2 + 1) for g in ("a", "b") for v in range(10)]
    df = ordered.with_block(spark.createDataFrame(rows, "g string, v double, n long"), "v", cuts)
    got = {(r["g"], r["v"]): (r["cum_n"], r["total_n"]) for r in ordered.running_totals(df, "v", ["n"], ["g"]).collect()}
    for g, v, _ in rows:
        assert got[(g, v)] == (sum(2 * i + 1 for i in range(int(v) + 1)), 100)


def test_positions_are_dense_with_a_hot_order_value(spark):
    rows = [(1 if i % 3 == 0 else i, i) for i in range(300)]
    df = spark.createDataFrame(rows, "a int, id int").repartition(7)
    got = [(r["position"], r["a"], r["id"]) for r in ordered.with_position(df, ["a", "id"]).orderBy("position").collect()]
    assert got == [(i, a, n) for i, (a, n) in enumerate(sorted(rows))]


@pytest.mark.parametrize("n, k, sizes", [(11, 3, [4, 4, 3]), (2, 3, [1, 1]), (9, 3, [3, 3, 3])])
def test_equal_windows(spark, n, k, sizes):
    df = spark.range(n)
    got = ordered.equal_windows(df, ["id"], k).groupBy("window").count().orderBy("window").collect()
    assert [r["count"] for r in got] == sizes


def test_describe_keeps_a_column_without_values(spark):
    rows = spark.createDataFrame([(1.0, None), (3.0, None)], "a double, b double")
    got = {r["column"]: r for r in profile.describe(rows, ["a", "b"]).collect()}
    assert (got["a"]["count"], got["a"]["mean"], got["a"]["q50"]) == (2, 2.0, 2.0)
    assert (got["b"]["count"], got["b"]["mean"], got["b"]["q50"]) == (0, None, None)


@pytest.mark.parametrize("first", [2, 6])
def test_crowded_blocks_are_cut_again(spark, monkeypatch, first):
    """Coarse first cuts, hot values, a long tail and unlike groups: exact, and no block that is ordered is large."""
    rng = np.random.default_rng(4)
    groups = {"a": np.exp(rng.normal(0, 6, 3000)), "b": np.r_[np.full(2500, 3.0), rng.normal(3, 1e-9, 500)], None: rng.normal(1e6, 1, 50)}
    rows = [(g, float(v)) for g, values in groups.items() for v in values]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    cuts = ordered.block_cuts(df, ["v"], rows_per_block=20, max_blocks=first)
    sizes, split = [], ordered.split_blocks

    def watched(rows, crowded, keys, small):
        sizes.append(crowded.agg(F.max("_in_block")).first()[0])
        return split(rows, crowded, keys, small)

    monkeypatch.setattr(ordered, "split_blocks", watched)
    probs = [0.0, 0.01, 0.5, 0.77, 1.0]
    for r in ordered.exact_quantiles(df, ["v"], probs, ["g"], cuts, rows_per_block=20).collect():
        assert r["n"] == len(groups[r["g"]])
        assert np.allclose([r[f"q{i}"] for i in range(5)], np.quantile(groups[r["g"]], probs), rtol=1e-12, atol=0)
    assert len(sizes) >= 2 and sizes == sorted(sizes, reverse=True) and sizes[-1] < sizes[0] / 20
