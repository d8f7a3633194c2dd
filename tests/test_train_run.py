"""A training run that is started again: stages whose record stands are skipped."""

import pytest

from modelwatch.operators import encoding, training
from modelwatch.plans import lifecycle, pipeline
from modelwatch.session import scratch_path
from modelwatch.sources.snapshots import read_current


def customers(spark, lo, hi):
    rows = [(i, "ab"[i % 2], int(i % 2 == 0 if i % 7 else i % 2)) for i in range(lo, hi)]
    return spark.createDataFrame(rows, "id long, c string, y int")


def run(spark, root, name, batch, **options):
    encoder = encoding.FeatureEncoder(categoricalCols=["c"], outputCol="features")
    return pipeline.train_run(
        spark, root, name, customers(spark, 0, 200), batch, "id", "y", encoder, training.decision_tree("y", depth=1, weighted=False),
        holdout=lambda first: first.where("id % 5 = 0"), **options,
    )


def test_run_goes_on_where_it_stopped(spark, monkeypatch):
    root, batch = scratch_path(spark, "run"), customers(spark, 200, 260)
    broken = monkeypatch.context()
    with broken as m:
        m.setattr(pipeline, "evaluate", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            run(spark, root, "r1", batch)
    failed = pipeline.Run(spark, root, "r1").log().collect()
    assert {r["stage"]: r["passed"] for r in failed} == {"load": True, "validate": True, "split": True, "fit": True, "evaluate": False}
    again = run(spark, root, "r1", batch)
    assert again.ran == ["evaluate", "gate", "registry"]
    log = {r["stage"]: r for r in again.log().collect()}
    assert list(sorted(log)) == sorted(pipeline.STAGES) and all(r["passed"] for r in log.values())
    assert log["gate"]["outcome"] == "PASSED" and log["registry"]["outcome"] == "registered"
    assert run(spark, root, "r1", batch).ran == []
    assert read_current(spark, root).count() == 260
    versions = pipeline.read_versions(spark, root).collect()
    assert [(v["version"], v["stage"], v["run_id"]) for v in versions] == [(1, "Staging", "r1")]
    # The recall that the record holds is that of the rates.
    held = [r for r in customers(spark, 0, 200).collect() if r["id"] % 5 == 0]
    train = [r for r in customers(spark, 0, 260).collect() if not (r["id"] % 5 == 0 and r["id"] < 200)]
    rate = {c: sum(r["y"] for r in train if r["c"] == c) / sum(r["c"] == c for r in train) for c in "ab"}
    hits = [rate[r["c"]] >= 0.5 for r in held if r["y"]]
    assert log["evaluate"]["values"]["recall"] == pytest.approx(sum(hits) / len(hits))


def test_known_batch_and_closed_gate(spark):
    root, batch = scratch_path(spark, "run"), customers(spark, 200, 260)
    refused = run(spark, root, "r1", batch, minimum=1.01)
    assert {r["stage"]: r["outcome"] for r in refused.log().collect()}["registry"] == "not_registered"
    assert pipeline.read_versions(spark, root).count() == 0
    known = run(spark, root, "r2", batch)
    assert known.ran == ["load"] and known.log().first()["outcome"] == "already_ingested"
    more = run(spark, root, "r3", customers(spark, 300, 340))
    metrics = pipeline.version_metric_rows(pipeline.read_versions(spark, root))
    decision = lifecycle.decide(pipeline.read_versions(spark, root).select("name", "version", "run_id", "stage"), metrics).first()
    assert more.ran[-1] == "registry" and decision["promoted"] and decision["candidate_version"] == 1
