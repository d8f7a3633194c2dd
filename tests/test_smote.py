import numpy as np
import pytest
from pyspark.sql import functions as F

from modelwatch.operators import neighbours as search
from modelwatch.operators.neighbours import _in_buckets, _keyed, _planes, blocked_points, exact_neighbours, hashed_neighbours, nearest_distances
from modelwatch.operators.smote import oversampled, smote


def brute(x: np.ndarray, k: int) -> list[tuple[int, float]]:
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    d.sort(axis=1)
    return sorted((r + 1, round(float(row[r]), 9)) for row in d for r in range(k))


def frame(spark, x, y=None):
    y = y if y is not None else [1] * len(x)
    return spark.createDataFrame([(list(map(float, a)), int(b)) for a, b in zip(x, y)], "x array<double>, y int")


@pytest.mark.parametrize("copies", [0, 40])
def test_neighbours_match_brute_force(spark, copies):
    """Small blocks force visits; a third of the rows may be one point."""
    rng = np.random.default_rng(3)
    x = np.vstack([rng.normal(size=(80, 4)), np.tile(rng.normal(size=4), (copies, 1))])
    got = nearest_distances(frame(spark, x), "x", 5, block_points=16).collect()
    flat = sorted((r["rank"], round(r["distance"], 9)) for r in got for _ in range(r["rows"]))
    assert flat == brute(x, 5)


@pytest.mark.parametrize("d", [2, 24])
def test_blocks_that_all_meet_are_not_shuffled_by_pairs(spark, monkeypatch, d):
    """Packs of points meet by reading; what is shuffled are the points and the neighbours found, once a task."""
    monkeypatch.setattr(search, "PACK_POINTS", 32)
    monkeypatch.setattr(search, "HOST_POINTS", 100)
    rng = np.random.default_rng(8)
    x = np.vstack([rng.normal(size=(500, d)), np.tile(rng.normal(size=d), (40, 1)), np.zeros((3, d))])
    near = exact_neighbours(blocked_points(frame(spark, x), "x", 8), 5)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" in plan and "CoGroups" not in plan
    got = nearest_distances(frame(spark, x), "x", 5, block_points=8).collect()
    assert sorted((r["rank"], round(r["distance"], 9)) for r in got for _ in range(r["rows"])) == brute(x, 5)


def test_smote_balances_and_interpolates(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(100, 3))
    y = [1] * 30 + [0] * 70
    out = smote(frame(spark, x, y), "y", "x", k=5, block_points=8).cache()
    assert {r["y"]: r["count"] for r in out.groupBy("y").count().collect()} == {0: 70, 1: 70}
    assert out.where(~F.col("synthetic")).count() == 100
    made = np.array([r["x"] for r in out.where("synthetic").collect()])
    few = x[:30]
    d = np.sqrt(((few[:, None] - few[None]) ** 2).sum(axis=2))
    np.fill_diagonal(d, np.inf)
    for m in made:
        on_segment = False
        for i in range(30):
            for j in np.argsort(d[i])[:5]:
                leg = few[j] - few[i]
                t = np.dot(m - few[i], leg) / np.dot(leg, leg)
                if -1e-9 <= t <= 1 + 1e-9 and np.allclose(few[i] + t * leg, m, atol=1e-9):
                    on_segment = True
        assert on_segment
    again = smote(frame(spark, x, y), "y", "x", k=5, block_points=8)
    assert out.exceptAll(again).isEmpty()


def test_smote_with_hot_copies(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([np.tile([1.0, 2.0], (12, 1)), rng.normal(size=(18, 2)), rng.normal(size=(91, 2))])
    y = [1] * 30 + [0] * 91
    out = smote(frame(spark, x, y), "y", "x", k=4, block_points=4)
    assert out.where("y = 1").count() == 91


def test_smote_needs_enough_rows(spark):
    with pytest.raises(ValueError):
        smote(frame(spark, np.eye(6), [1, 1, 0, 0, 0, 0]), "y", "x", k=5).count()


def curved(rng, n, d=48):
    """Points of three dimensions, bent into many."""
    t = rng.uniform(size=(n, 3))
    return np.sin(t @ rng.normal(size=(3, d)) * 2) + rng.normal(size=(n, d)) * 0.01


def truth(x, k):
    d = ((x[:, None, :] - x[None, :, :]) ** 2).sum(axis=2)
    np.fill_diagonal(d, np.inf)
    return np.sqrt(np.sort(d, axis=1)[:, :k])


@pytest.mark.parametrize("copies", [0, 500])
def test_hashed_neighbours_find_nearly_all(spark, copies):
    """Against brute force: distances are exact, and at least 95 % of the true ones are there."""
    rng = np.random.default_rng(8)
    x = curved(rng, 1500)
    x = np.vstack([x, np.tile(x[3], (copies, 1))])
    blocks = blocked_points(frame(spark, x), "x", 64)
    near = hashed_neighbours(blocks, 5, bucket_points=12, probes=3)
    assert "hashed-near" in near.inputFiles()[0]  # not the exact search
    ids = {r["id"]: np.array(r["x"]) for r in blocks.collect()}
    wanted = {tuple(np.round(a, 9)): b for a, b in zip(x, truth(x, 5))}
    hits, total = 0, 0
    lists = {}
    for r in near.collect():
        assert abs(np.linalg.norm(ids[r["id"]] - ids[r["nid"]]) - r["d"]) < 1e-9
        lists.setdefault(r["id"], []).extend([r["d"]] * min(r["copies"], 5 - r["start"]))
    for i, p in ids.items():
        want = wanted[tuple(np.round(p, 9))]
        total += len(want)
        hits += sum(d <= want[-1] + 1e-9 for d in lists.get(i, []))
    assert hits >= 0.95 * total


def test_hashed_work_is_linear(spark):
    """Twice the points, about twice the pairs in all buckets; no bucket is large, not even with a dense cluster."""
    work = []
    for n in (1000, 2000, 4000):
        rng = np.random.default_rng(9)
        x = curved(rng, n)
        x[: n // 3] = x[0] + rng.normal(size=(n // 3, x.shape[1])) * 1e-6
        blocks = blocked_points(frame(spark, x), "x")
        bits = int(np.ceil(np.log2(n / 32)))
        keyed = _keyed(blocks, range(4), bits, _planes(blocks, range(4), bits + 12, 1), 3)
        groups = _in_buckets(keyed, bits, bits + 12, 32).groupBy("table", "top", "rest", "share")
        sizes = groups.agg(F.count_if("host").alias("hosts"), F.count("*").alias("rows")).toPandas()
        assert sizes["hosts"].max() <= 32 * 8
        work.append(int((sizes["hosts"] * sizes["rows"]).sum()))
    assert work[1] < 2.8 * work[0] and work[2] < 2.8 * work[1]


def test_hashed_falls_back_to_all_points(spark):
    """Without structure in many dimensions hashing cannot win; the result is exact."""
    x = np.random.default_rng(10).normal(size=(300, 40))
    near = hashed_neighbours(blocked_points(frame(spark, x), "x", 64), 4, bucket_points=16)
    assert np.allclose(sorted(r["d"] for r in near.collect()), np.sort(truth(x, 4).ravel()))


def test_exact_visits_by_spans(spark, monkeypatch):
    from modelwatch.operators import neighbours

    monkeypatch.setattr(neighbours, "SPAN_BLOCKS", 3)
    x = np.random.default_rng(11).normal(size=(200, 2))
    near = exact_neighbours(blocked_points(frame(spark, x), "x", 8), 5)
    assert np.allclose(sorted(r["d"] for r in near.collect()), np.sort(truth(x, 5).ravel()))


@pytest.mark.parametrize("kind", ["bigint", "string"])
def test_oversampled_keeps_keys(spark, kind):
    rng = np.random.default_rng(12)
    x = rng.normal(size=(90, 3))
    df = frame(spark, x, [1] * 20 + [0] * 70).withColumn("key", F.monotonically_increasing_id().cast(kind)).cache()
    out = oversampled(df, "key", "y", "x", k=3).collect()
    assert len(out) == 140 and len({r["key"] for r in out}) == 140 and None not in {r["key"] for r in out}
    given = {r["key"]: r["x"] for r in df.collect()}
    assert sum(r["key"] in given for r in out) == 90
    assert all(list(r["x"]) == given[r["key"]] for r in out if r["key"] in given)
