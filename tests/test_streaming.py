"""Streaming jobs: replays, late rows, quarantine."""

import json

from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.plans import ingest
from modelwatch.schema import CUSTOMER_SPEC, log_schema
from modelwatch.session import scratch_path
from modelwatch.sources.snapshots import read_current, read_ledger
from modelwatch.streaming import jobs
from tests.customers import customer, landed

INPUT = T.StructType([T.StructField("k", T.IntegerType())])


def event(i, minute, k=1, status="success"):
    return {
        "request_id": f"r{i}",
        "timestamp": f"2025-01-01T{minute // 60:02d}:{minute % 60:02d}:00.000000+00:00",
        "input": {"k": k},
        "prediction": i % 2 if status == "success" else None,
        "latency_ms": float(i),
        "status": status,
    }


def land(folder, name, events):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join(json.dumps(e) for e in events) + "\n\n")


def test_windows_continue_over_restarts(spark, tmp_path):
    land(tmp_path / "in", "a.json", [event(i, i) for i in range(10)] + [event(90, 65, status="failure")])
    stream = jobs.stream_table(spark, str(tmp_path / "in"), log_schema(INPUT), fmt="json")
    out, check = scratch_path(spark, "o"), scratch_path(spark, "c")
    jobs.run_windowed_log(stream, out, check, "1 hour").awaitTermination()
    assert {r["events"] for r in jobs.read_windows(spark, out).collect()} == {10, 1}
    land(tmp_path / "in", "b.json", [event(i, i) for i in range(20, 25)])
    jobs.run_windowed_log(stream, out, check, "1 hour").awaitTermination()
    rows = jobs.read_windows(spark, out).orderBy("window_start").collect()
    assert [r["events"] for r in rows] == [15, 1] and [r["failure_rate"] for r in rows] == [0.0, 1.0]


def test_same_request_id_with_another_payload_is_kept(spark, tmp_path):
    land(tmp_path / "in", "a.json", [event(1, 1, k=1), event(1, 1, k=2), event(1, 1, k=1)])
    stream = jobs.stream_table(spark, str(tmp_path / "in"), log_schema(INPUT), fmt="json")
    out, check = scratch_path(spark, "o"), scratch_path(spark, "c")
    jobs.run_append(jobs.deduplicated(stream, ["input"], "1 hour"), out, check).awaitTermination()
    land(tmp_path / "in", "b.json", [event(1, 2, k=2)])
    jobs.run_append(jobs.deduplicated(stream, ["input"], "1 hour"), out, check).awaitTermination()
    assert sorted(r["k"] for r in spark.read.parquet(out).select("input.k").collect()) == [1, 2]


def test_landing_replay_has_no_effect(spark, tmp_path):
    root = scratch_path(spark, "root")
    ingest.start_table(landed(spark, [customer(i) for i in range(20)]), root)
    batch = landed(spark, [customer(i) for i in range(100, 110)]).coalesce(1)
    folder = str(tmp_path / "landing")
    statuses = []

    def run(check):
        stream = jobs.stream_table(spark, folder, batch.schema, files_per_trigger=1)
        jobs.run_landing(
            stream,
            root,
            "customerID",
            check,
            spec=CUSTOMER_SPEC,
            reports=lambda r: statuses.extend(x["status"] for x in r.collect()),
        ).awaitTermination()

    batch.write.mode("append").parquet(folder)
    run(scratch_path(spark, "c1"))
    run(scratch_path(spark, "c2"))
    assert statuses == ["ingested", "already_ingested"]
    assert read_current(spark, root).count() == 30 and read_ledger(spark, root).count() == 1


def test_landing_takes_the_new_file_beside_an_old_one(spark, tmp_path):
    root, folder, statuses = scratch_path(spark, "root"), str(tmp_path / "landing"), []
    ingest.start_table(landed(spark, [customer(i) for i in range(20)]), root)
    batches = [landed(spark, [customer(i) for i in range(k, k + 10)]).coalesce(1) for k in (100, 200, 105)]

    def run():
        stream = jobs.stream_table(spark, folder, batches[0].schema, name_files=True)
        jobs.run_landing(stream, root, "customerID", check, spec=CUSTOMER_SPEC, reports=lambda r: statuses.extend(x["status"] for x in r.collect())).awaitTermination()

    check = scratch_path(spark, "c")
    batches[0].write.mode("append").parquet(folder)
    run()
    for b in batches:  # delivered again, new, and with ids of the first
        b.write.mode("append").parquet(folder)
    run()
    assert sorted(statuses) == ["already_ingested", "ingested", "ingested", "rejected"]
    assert read_current(spark, root).count() == 40


def test_state_of_closed_windows_goes(spark, tmp_path):
    """The watermark advances with every file: the state keeps open windows only, the folder all of them."""
    folder, check, out = tmp_path / "in", scratch_path(spark, "c"), scratch_path(spark, "o")
    for i in range(8):
        land(folder, f"{i}.json", [event(100 * i + j, i * 180 + j * 9) for j in range(20)])
        stream = jobs.stream_table(spark, str(folder), log_schema(INPUT), fmt="json")
        query = jobs.run_windowed_log(stream, out, check, "1 hour")
        query.awaitTermination()
    kept = [p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress if p["stateOperators"]]
    windows = jobs.read_windows(spark, out)
    assert windows.agg(F.sum("events")).first()[0] == 160 and windows.count() == 24
    assert kept[-1] <= 5
    jobs.fold_windows(spark, out, scratch_path(spark, "folded"))


def test_fifty_files_in_one_trigger(spark, tmp_path):
    """One trigger: repeated files are skipped, broken ones quarantined, order of names decides between files that share ids."""
    root, folder, reports = scratch_path(spark, "root"), tmp_path / "landing", []
    folder.mkdir()
    ingest.start_table(landed(spark, [customer(i) for i in range(20)]), root)
    schema = landed(spark, [customer(0)]).schema

    def put(name, customers):
        path = str(tmp_path / f"w-{name}")
        landed(spark, customers).coalesce(1).write.parquet(path)
        part = next(p for p in (tmp_path / f"w-{name}").iterdir() if p.name.startswith("part-"))
        part.rename(folder / f"{name}.parquet")

    for i in range(44):
        put(f"f{i:02d}", [customer(1000 + 10 * i + j) for j in range(3)])
    put("g0", [customer(1000 + j) for j in range(3)])  # f00 again
    put("g1", [customer(1011), customer(5000)])  # shares an id with f01
    put("g2", [customer(5000), customer(5001)])  # g1 was refused: it may come in
    put("g3", [customer(5001), customer(5002)])  # shares an id with g2
    put("g4", [customer(6000), customer(6000)])  # an id twice
    put("g5", [customer(7000, gender="X")])  # breaks the schema

    def run(check):
        stream = jobs.stream_table(spark, str(folder), schema, name_files=True)
        jobs.run_landing(stream, root, "customerID", check, spec=CUSTOMER_SPEC, reports=lambda r: reports.extend(r.collect())).awaitTermination()

    run(scratch_path(spark, "c1"))
    got = {r["source_file"].rsplit("/", 1)[1][:-8]: (r["status"], r["reason"]) for r in reports}
    assert len(reports) == len(got) == 50
    assert {got[f"f{i:02d}"][0] for i in range(44)} == {"ingested"} and got["g2"][0] == "ingested"
    assert got["g0"][0] == "already_ingested"
    assert {n for n, (s, _) in got.items() if s == "rejected"} == {"g1", "g3", "g4", "g5"}
    assert "schema" in got["g5"][1] and "repeated" in got["g4"][1] and "present" in got["g1"][1]
    assert read_current(spark, root).count() == 20 + 44 * 3 + 2
    ledger = read_ledger(spark, root)
    assert ledger.count() == 45
    sound = ingest.lineage_invariants(ledger)
    assert sound.where("sums_hold and continues and hash_unique").count() == 45
    assert spark.read.parquet(f"{root}/quarantine").count() == 2 + 2 + 2 + 1
    reports.clear()
    run(scratch_path(spark, "c2"))  # the same files to a stream without memory
    assert {r["status"] for r in reports} == {"already_ingested", "rejected"}
    assert read_current(spark, root).count() == 20 + 44 * 3 + 2 and read_ledger(spark, root).count() == 45


def test_quarantine_keeps_every_row(spark):
    rows = landed(spark, [customer(i, **({"gender": "X"} if i % 4 == 0 else {})) for i in range(40)])
    source, good, bad = (scratch_path(spark, n) for n in ("in", "good", "bad"))
    rows.write.parquet(source)
    stream = jobs.stream_table(spark, source, rows.schema)
    jobs.run_quarantine(stream, CUSTOMER_SPEC, good, bad, scratch_path(spark, "c")).awaitTermination()
    assert spark.read.parquet(good).count() == 30
    found = spark.read.parquet(bad).select(F.explode("errors").alias("e")).select("e.field").distinct().collect()
    assert spark.read.parquet(bad).count() == 10 and [r["field"] for r in found] == ["gender"]


def test_closed_windows_are_compared_once(spark, tmp_path):
    events = [dict(event(i, i % 50, k=i % 3), status=("success", "failure")[i % 2]) for i in range(60)]
    land(tmp_path / "in", "a.json", events + [event(99, 300)])
    stream = jobs.stream_table(spark, str(tmp_path / "in"), log_schema(INPUT), fmt="json")
    baseline = spark.createDataFrame([("success",)] * 3 + [("other",)], "status string")
    out = scratch_path(spark, "o")
    jobs.windowed_drift(
        stream, baseline, "status", out, scratch_path(spark, "c"), width="1 hour", delay="10 minutes"
    ).awaitTermination()
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 1
    p, q = {"success": 0.75, "other": 0.25}, {"success": 0.5, "failure": 0.5}
    from math import isclose, log2

    expected = 0.0
    for c in {*p, *q}:
        a, b = p.get(c, 0.0), q.get(c, 0.0)
        expected += sum(x * log2(x / ((a + b) / 2)) / 2 for x in (a, b) if x > 0)
    assert isclose(rows[0]["score"], expected, abs_tol=1e-12)
