"""Splits, samples, encoding, training and scoring."""

import hashlib
import math

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from modelwatch.operators import encoding, profile, sampling, training
from modelwatch.plans import monitor, prepare
from modelwatch.schema import CATEGORICAL_FEATURES, NUMERIC_FEATURES
from modelwatch.session import scratch_path
from modelwatch.sources import models, tables
from tests.customers import customer, landed

COUNTS = {(0, "test"): 1035, (1, "test"): 374}


def test_split_has_the_recorded_class_sizes(spark):
    """7044 rows with 1869 positives: 1409 held out, 1035 and 374 per class."""
    df = spark.range(7044).select(F.col("id").cast("string").alias("id"), (F.col("id") < 1869).cast("int").alias("y"))
    out = sampling.stratified_split(df, "id", "y", 0.2, 42).cache()
    got = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert got[(0, "test")] + got[(1, "test")] == 1409
    assert abs(got[(0, "test")] - COUNTS[(0, "test")]) <= 1 and abs(got[(1, "test")] - COUNTS[(1, "test")]) <= 1
    again = sampling.stratified_split(df.repartition(9), "id", "y", 0.2, 42)
    assert out.exceptAll(again).isEmpty()


def test_largest_remainder(spark):
    sizes = spark.createDataFrame([("0", 7), ("1", 4), ("2", 4)], "stratum string, n long")
    got = {r["stratum"]: r["quota"] for r in sampling.largest_remainder(sizes, 0.34).collect()}
    assert sum(got.values()) == math.ceil(0.34 * 15) and got["0"] == 3


@pytest.mark.parametrize("n", [0, 1, 37, 200, 500])
def test_sample_sizes(spark, n):
    df = spark.range(200).withColumnRenamed("id", "k")
    assert sampling.sample_rows(df, "k", n, 7).count() == min(n, 200)


def test_draws_fall_back_to_replacement(spark):
    df = spark.range(10).withColumnRenamed("id", "k")
    assert sampling.draw_rows(df, "k", 4).distinct().count() == 4
    assert sampling.draw_rows(df, "k", 25).count() == 25
    assert sampling.sample_with_replacement(df, "k", 1000, 3).groupBy("k").count().count() == 10


def test_upper_slice_falls_back_when_nothing_qualifies(spark):
    rows = [(i, float(i), float(-i)) for i in range(10)] + [(99, None, 5.0)]
    df = spark.createDataFrame(rows, "k int, a double, b double")
    assert {r["k"] for r in sampling.upper_slice(df, {"a": 0.6, "b": 0.0}, "a").collect()} == {6, 7, 8, 9}
    assert {r["k"] for r in sampling.upper_slice(df, {"a": 0.9, "b": 0.9}, "a").collect()} == set(range(10))


def test_folds_are_even_and_complete(spark):
    df = spark.range(103).select("id", (F.col("id") % 4 == 0).cast("int").alias("y"))
    out = sampling.stratified_folds(df, "id", "y", 5)
    sizes = [r["count"] for r in out.groupBy("y", "fold").count().collect()]
    assert out.count() == 103 and len(sizes) == 10
    assert {r["m"] for r in out.groupBy("y", "fold").count().groupBy("y").agg((F.max("count") - F.min("count")).alias("m")).collect()} <= {0, 1}


def test_duplicate_listing_splits_hot_groups(spark):
    df = spark.createDataFrame([("a", 1)] * 25 + [("b", 2)] * 2 + [("c", 3)], "x string, n int")
    rows = profile.duplicate_rows(df, chunk=4).collect()
    assert [(r["x"], r["copy"]) for r in rows] == [("a", i) for i in range(1, 26)] + [("b", 1), ("b", 2)]
    assert profile.duplicate_count(df).first()["duplicates"] == 25


def test_encoder_follows_the_fitted_levels(spark):
    train = spark.createDataFrame([(0.0, "b"), (1.0, "a"), (2.0, "c"), (None, "a")], "n double, c string")
    model = encoding.FeatureEncoder(numericCols=["n"], categoricalCols=["c"], outputCol="f").fit(train)
    assert model.feature_names() == ["n", "c_b", "c_c"]
    filled = np.array([0.0, 1.0, 2.0, 0.0])
    new = spark.createDataFrame([(None, "zzz"), (2.0, "c"), (1.0, None)], "n double, c string")
    got = [r["x"] for r in model.transform(new).select(vector_to_array("f").alias("x")).collect()]
    scale = [(v - filled.mean()) / filled.std() for v in (0.0, 2.0, 1.0)]
    assert np.allclose(got, [[scale[0], 0, 0], [scale[1], 0, 1], [scale[2], 0, 0]])


def test_constant_column_is_divided_by_one(spark):
    df = spark.createDataFrame([(5.0,), (5.0,)], "n double")
    assert encoding.numeric_stats(df, ["n"]).first()["divisor"] == 1.0


def test_ordinal_rejects_unseen_levels(spark):
    model = encoding.FeatureEncoder(ordinalCols=["c"], outputCol="f").fit(spark.createDataFrame([("b",), ("a",)], "c string"))
    ok = model.transform(spark.createDataFrame([("b",)], "c string")).select(vector_to_array("f")[0].alias("x")).first()
    assert ok["x"] == 1.0
    with pytest.raises(Exception, match="unknown level in c: z"):
        model.transform(spark.createDataFrame([("z",)], "c string")).collect()


def test_any_number_of_levels(spark):
    df = spark.range(20_000).select(F.concat(F.lit("it's "), F.col("id").cast("string")).alias("c"))
    model = encoding.FeatureEncoder(categoricalCols=["c"], outputCol="f").fit(df)
    names = model.feature_names()
    rows = spark.createDataFrame([("it's 7",), ("unseen",), (None,)], "c string")
    got = [r["f"].toArray() for r in model.transform(rows).collect()]
    assert [x.sum() for x in got] == [1.0, 0.0, 0.0] and len(names) == 19_999
    assert names[got[0].argmax()] == "c_it's 7"


def test_levels_as_a_table(spark, monkeypatch):
    """Beyond the literal bound nothing changes but the form: sparse vectors, levels in a folder of their own."""
    rng = np.random.default_rng(2)
    rows = [(float(i), rng.choice(["a", "b", "Ä", None]), f"n{i:04d}" if i % 9 else None, str(rng.integers(5))) for i in range(400)]
    df = spark.createDataFrame(rows, "v double, c string, name string, o string")
    seen = df.where("v < 300")
    build = lambda: encoding.FeatureEncoder(numericCols=["v"], categoricalCols=["c", "name"], ordinalCols=["o"], outputCol="f")
    plain = build().fit(seen)
    monkeypatch.setattr(encoding, "LITERAL_LEVELS", 50)
    tabled = build().fit(seen)
    assert plain.level_table is None and tabled.level_table is not None and len(tabled.getOrDefault("state")) < 200
    read = lambda m: {r["v"]: r["f"] for r in m.transform(df).select("v", "f").collect()}
    a, b = read(plain), read(tabled)
    assert all(np.array_equal(a[v].toArray(), b[v].toArray()) for v in a) and len(b[17.0].indices) <= 4
    assert tabled.feature_names() == plain.feature_names()
    path = scratch_path(spark, "encoder")
    tabled.write().overwrite().save(path)
    again = read(encoding.FeatureEncoderModel.load(path))
    assert all(np.array_equal(a[v].toArray(), again[v].toArray()) for v in a)
    with pytest.raises(Exception, match="unknown level in o: 9"):
        tabled.transform(spark.createDataFrame([(1.0, "a", "n0001", "9")], df.schema)).collect()


def test_hot_and_missing_levels_join(spark):
    df = spark.createDataFrame([("hot",)] * 500 + [(None,)] * 300 + [(f"l{i}",) for i in range(200)], "c string")
    levels = encoding.indexed_levels(df, ["c"])
    placed = encoding.join_places(df, levels, ["c"]).groupBy("_place_c").count().collect()
    counts = {r["_place_c"]: r["count"] for r in placed}
    assert counts[None] == 300 and counts[1] == 500 and len(counts) == 202 and sum(counts.values()) == 1000


@pytest.fixture(scope="module")
def prepared(spark):
    raw = landed(spark, [customer(i) for i in range(400)])
    clean = prepare.clean_customers(raw).cache()
    encoder = training.default_encoder(NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    train, test = clean.where("substr(customerID, 3, 1) <> '0'"), clean.where("substr(customerID, 3, 1) = '0'")
    model = training.fit_model(train, "customerID", "Churn", encoder, training.random_forest("Churn", trees=8, depth=4))
    return model, train, test


def test_encoded_width_is_thirty(prepared):
    model, _, test = prepared
    assert len(training.encoder_of(model).feature_names()) == 30
    row = training.encoder_of(model).transform(test).first()
    assert len(row["features"]) == 30


def test_scores_are_probabilities_and_keep_raw_columns(prepared):
    model, _, test = prepared
    out = training.score(model, test)
    assert set(test.columns) < set(out.columns) and out.count() == test.count()
    assert out.where("churn_probability < 0 or churn_probability > 1").isEmpty()
    assert out.where("prediction <> int(churn_probability >= 0.5)").isEmpty()


def test_equal_records_get_equal_predictions(spark, prepared):
    model, _, _ = prepared
    same = landed(spark, [customer(7, customerID=f"{i:04d}-TWINS") for i in range(20)])
    out = training.score(model, prepare.clean_customers(same).drop("Churn"))
    assert out.count() == 20 and out.select("churn_probability").distinct().count() == 1


def test_two_fits_agree(prepared):
    model, train, test = prepared
    encoder = training.default_encoder(NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    learner = training.random_forest("Churn", trees=8, depth=4)
    again = training.fit_model(train.repartition(3), "customerID", "Churn", encoder, learner)
    assert training.same_predictions(training.score(model, test), training.score(again, test), "customerID")


def test_bundle_roundtrip_and_log(spark, prepared):
    model, _, test = prepared
    path = scratch_path(spark, "bundle")
    models.save_bundle(spark, model, path, name="churn_model", version="7", run_id="r7", threshold=0.45)
    scored = models.score_with_bundle(spark, path, test)
    assert scored.where("prediction <> int(churn_probability >= 0.45)").isEmpty()
    features = [c for c in test.columns if c not in ("customerID", "Churn")]
    events = monitor.to_log_events(scored, features, model_name="churn_model", model_version="7", run_id="r7")
    out = scratch_path(spark, "log")
    tables.write_log(events, out)
    back = tables.read_log(spark, out)
    assert back.count() == test.count()
    assert back.where("status <> 'success' or prediction is null or length(request_id) <> 12").isEmpty()
    assert "customerID" not in back.schema["input"].dataType.names


def test_folds_never_score_their_own_rows(spark):
    df = spark.range(60).select("id", F.array(F.col("id") / 60.0, F.lit(1.0)).alias("x"), (F.col("id") > 29).cast("int").alias("y"))
    from pyspark.ml.functions import array_to_vector

    rows = sampling.stratified_folds(df.withColumn("features", array_to_vector("x")), "id", "y", 3)
    out = training.out_of_fold(rows, "id", "y", None, training.decision_tree("y", depth=2))
    assert out.count() == 60 and out.select("id").distinct().count() == 60


def test_one_layout_for_all_folds_and_candidates(spark, monkeypatch):
    """Rows are shuffled once; encoders and preparation run once a fold; results are those of separate fits."""
    rng = np.random.default_rng(6)
    rows = [(i, int(rng.random() < 0.4), float(rng.normal()), rng.choice(["a", "b"])) for i in range(300)]
    folded = sampling.stratified_folds(spark.createDataFrame(rows, "id long, y int, n double, c string"), "id", "y", 3).cache()
    encoder = encoding.FeatureEncoder(numericCols=["n"], categoricalCols=["c"], outputCol="features")
    layouts, fits, prepared = [], [], []
    layout, fit = training.stable_layout, encoding.FeatureEncoder._fit
    monkeypatch.setattr(training, "stable_layout", lambda *a: layouts.append(1) or layout(*a))
    monkeypatch.setattr(encoding.FeatureEncoder, "_fit", lambda self, df: fits.append(1) or fit(self, df))
    grid = {str(c): (encoder, training.logistic_regression("y", c=c, weighted=True, max_iter=20)) for c in (0.01, 0.1, 1.0, 10.0)}
    got = {(r["model"], r["fold"]): r["f1"] for r in training.cross_validate(folded, "id", "y", grid).collect()}
    assert len(got) == 12 and len(layouts) == 1 and len(fits) == 3
    kept = training.FoldedRows(folded, "id", "y", ["n", "c"], "fold", None)
    plan = kept.training(0)[0]._jdf.queryExecution().executedPlan().toString()
    assert "InMemoryTableScan" in plan.split("InMemoryRelation")[0] and "Exchange" not in plan.split("InMemoryRelation")[0]
    for f in range(3):
        model = training.fit_model(folded.where(F.col("fold") != f), "id", "y", *grid["1.0"])
        alone = training.classification_metrics(training.score(model, folded.where(F.col("fold") == f)), "y", "prediction").first()
        assert math.isclose(alone["f1"], got["1.0", f], abs_tol=1e-9)
    layouts.clear()
    training.cross_validate(folded, "id", "y", grid, prepare=lambda t: prepared.append(1) or t.where("id % 2 = 0")).collect()
    assert len(prepared) == 3 and len(layouts) == 4


def test_boosting_cuts_its_lineage(spark):
    """A hundred rounds: residuals are checkpointed in the shared folder, and the depth of their lineage stays bounded."""
    rows = [(i, int((i * 7 % 100) > 40), float(i * 7 % 100), float(i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, "id long, y int, a double, b double")
    encoder = encoding.FeatureEncoder(numericCols=["a", "b"], outputCol="features")
    model = training.fit_model(df, "id", "y", encoder, training.boosted_trees("y", rounds=100, depth=2))
    assert spark.sparkContext.getCheckpointDir()
    assert model.stages[-1].getNumTrees == 100
    assert training.score(model, df).where("prediction <> y").count() == 0


def test_param_candidates():
    assert len(training.param_grid(c=[0.001, 0.01, 0.1, 1, 10, 100], penalty=["l1", "l2"])) == 12
    draws = training.param_draws(30, 42, a=list(range(10)), b=list(range(10)))
    assert len(draws) == 30 and draws == training.param_draws(30, 42, a=list(range(10)), b=list(range(10)))


def test_engineered_columns(spark):
    rows = [customer(1, tenure=t) for t in ("0", "12", "13", "24", "48", "49")]
    out = prepare.engineer(prepare.clean_customers(landed(spark, rows)))
    assert [r["TenureBucket"] for r in out.collect()] == ["0-1yr", "0-1yr", "1-2yr", "1-2yr", "2-4yr", "4yr+"]
    row = customer(3, PhoneService="Yes", MultipleLines="No", InternetService="DSL")
    services = prepare.engineer(prepare.clean_customers(landed(spark, [row]))).first()["TotalServices"]
    assert services == sum(row[c] not in ("No", "No internet service", "No phone service") for c in
                           ("PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup",
                            "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies"))


def test_shared_and_missing_keys(spark):
    rows = spark.createDataFrame([(None if i % 4 == 0 else i // 3, "ab"[i % 2]) for i in range(40)], "k int, y string")
    folds = sampling.stratified_folds(rows, "k", "y", 5).groupBy("y", "fold").count().collect()
    assert sum(r["count"] for r in folds) == 40 and {r["count"] for r in folds} == {4}
    same = spark.createDataFrame([(7,)] * 10, "k int")
    with pytest.raises(ValueError, match="share a k"):
        sampling.sample_rows(same, "k", 3)
    assert sampling.sample_rows(same, "k", 10).count() == 10
    with pytest.raises(Exception, match="repeated or missing"):
        sampling.sample_with_replacement(same, "k", 3).collect()


def test_rows_without_any_key(spark):
    """A digest and an occurrence number order them: exact sizes, many buckets, whatever the layout of the rows."""
    rows = spark.createDataFrame([(None, "ab"[i % 2], i // 5) for i in range(400)], "k string, y string, v int")
    rows = rows.unionByName(spark.createDataFrame([(None, "a", 7)] * 200, rows.schema))  # one row many times
    out = sampling.stratified_split(rows.repartition(6), "k", "y", 0.25)
    assert out.columns == ["k", "y", "v", "split"] and out.count() == 600
    counts = {(r["y"], r["split"]): r["count"] for r in out.groupBy("y", "split").count().collect()}
    assert counts == {("a", "test"): 100, ("a", "train"): 300, ("b", "test"): 50, ("b", "train"): 150}
    again = sampling.stratified_split(rows.repartition(3), "k", "y", 0.25)
    assert out.exceptAll(again).isEmpty() and again.exceptAll(out).isEmpty()
    own = sampling._keyed(sampling.with_own_keys(rows, "k"), "k", 42, None)
    assert own.select("bucket").distinct().count() > 550
    folds = sampling.stratified_folds(rows, "k", "y", 4).groupBy("y", "fold").count().collect()
    assert {r["count"] for r in folds} == {100, 50}
    assert sampling.sample_rows(rows, "k", 77).count() == 77


@pytest.mark.parametrize("literal", [3, 10_000])
def test_many_strata(spark, monkeypatch, literal):
    """Cuts joined to the rows select what cuts in an expression select."""
    monkeypatch.setattr(sampling, "LITERAL_STRATA", literal)
    rows = spark.range(4000).select("id", (F.col("id") % 700).cast("string").alias("s"))
    rows = rows.withColumn("s", F.when(F.col("id") < 300, "hot").when(F.col("id") < 320, F.lit(None)).otherwise(F.col("s")))
    out = sampling.stratified_split(rows, "id", "s", 0.3).where("split = 'test'")
    assert out.count() == 1200
    per = {r["s"]: r["count"] for r in out.groupBy("s").count().collect()}
    sizes = {r["s"]: r["count"] for r in rows.groupBy("s").count().collect()}
    assert all(abs(per.get(s, 0) - 0.3 * n) < 1 for s, n in sizes.items())
    chosen = sampling.flag_fraction_where(rows, "id", F.col("s") == "hot", 0.5)
    assert chosen.where("chosen").count() == 150 and chosen.where("chosen and s <> 'hot'").isEmpty()


def test_draws_come_from_drawn_buckets(spark):
    rows = spark.range(500).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), "id").repartition(5)
    ordered = [r["k"] for r in rows.orderBy(F.md5(F.concat("k", F.lit("|3"))), "k").collect()]
    want = [ordered[int(hashlib.md5(f"{i}|3".encode()).hexdigest()[:15], 16) % 500] for i in range(900)]
    got = sampling.sample_with_replacement(rows, "k", 900, 3)
    assert got.columns == ["k", "id", "draw"] and [r["k"] for r in got.orderBy("draw").collect()] == want
    with pytest.raises(ValueError):
        sampling.sample_with_replacement(rows.where("id < 0"), "k", 3)


def test_layout_does_not_depend_on_the_session(spark):
    rows = spark.range(20_000).withColumnRenamed("id", "k")
    sizes = set()
    for parts in ("1", "8", "50"):
        other = spark.newSession()
        other.conf.set("spark.sql.shuffle.partitions", parts)
        sizes.add(training.stable_layout(other.range(20_000).withColumnRenamed("id", "k"), "k", rows.count()).rdd.getNumPartitions())
    assert sizes == {4}
