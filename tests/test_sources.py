"""Readers, sinks, snapshots, ingestion."""

import gzip
import hashlib

import pytest
from pyspark.sql import functions as F

from modelwatch.functions import scalars as S
from modelwatch.operators import membership
from modelwatch.plans import ingest
from modelwatch.schema import CUSTOMER_SPEC
from modelwatch.session import scratch_path, scratch_root
from modelwatch.sources import fingerprint, models, snapshots, tables
from tests.customers import COLUMNS, customer, landed

EVENT = '{"request_id": "a1", "timestamp": "2025-01-02T03:04:05.678901+00:00", "input": {%s}, "prediction": %s, "status": "%s"}'


def test_shared_folder_comes_from_the_session(spark):
    assert scratch_root(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_csv_lands_as_text(spark, tmp_path):
    path = tmp_path / "c.csv"
    rows = [customer(i) for i in range(5)]
    path.write_text("\n".join([",".join(COLUMNS)] + [",".join(r[c] for c in COLUMNS) for r in rows]) + "\n")
    df = tables.read_csv_table(spark, str(path), CUSTOMER_SPEC)
    assert df.count() == 5 and set(dict(df.dtypes).values()) == {"string"}
    assert df.where("customerID = '0000-ABCDE'").first()["TotalCharges"] == " "


def test_csv_files_with_other_headers_and_quotes(spark, tmp_path):
    (tmp_path / "one.csv").write_text('x,y\n1,"say ""hi"", twice"\n')
    assert tables.read_csv_table(spark, str(tmp_path)).first()["y"] == 'say "hi", twice'
    (tmp_path / "two.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="header"):
        tables.read_csv_table(spark, str(tmp_path)).collect()


def test_broken_log_line_is_an_error(spark, tmp_path):
    (tmp_path / "log.jsonl").write_text(EVENT % ('"tenure": 3', "1", "success") + '\n{"request_id": "cut')
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        tables.read_log(spark, str(tmp_path)).collect()


def test_microseconds_are_part_of_a_fingerprint(spark):
    at = "CAST('2024-01-01 00:00:00.000001' AS {})"
    for kind in ("timestamp", "timestamp_ntz"):
        one = spark.sql(f"SELECT {at.format(kind)} AS t")
        two = spark.sql(f"SELECT {at.format(kind)} + INTERVAL '0.000001' SECOND AS t")
        assert fingerprint.table_fingerprint(one).first()["fingerprint"] != fingerprint.table_fingerprint(two).first()["fingerprint"]


def test_missing_and_empty_csv_are_errors(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        tables.read_csv_table(spark, str(tmp_path / "none.csv"))
    (tmp_path / "e.csv").write_text("a,b\n")
    with pytest.raises(ValueError):
        tables.read_csv_table(spark, str(tmp_path / "e.csv"))


def test_log_skips_blank_lines_and_keeps_micros(spark, tmp_path):
    lines = [EVENT % ('"tenure": 3', "1", "success"), "", EVENT % ("", "null", "failure"), ""]
    (tmp_path / "log.jsonl").write_text("\n".join(lines))
    df = tables.read_log(spark, str(tmp_path))
    rows = df.select("request_id", F.unix_micros("timestamp").alias("us"), "input.tenure", "prediction", "status").collect()
    assert [(r["tenure"], r["prediction"], r["status"]) for r in rows] == [(3, 1, "success"), (None, None, "failure")]
    assert rows[0]["us"] % 1_000_000 == 678901
    (tmp_path / "empty").mkdir()
    (tmp_path / "empty" / "log.jsonl").write_text("\n\n")
    with pytest.raises(ValueError):
        tables.read_log(spark, str(tmp_path / "empty"))


def test_lineage_absent_is_empty_and_corrupt_fails(spark, tmp_path):
    assert tables.read_lineage(spark, str(tmp_path / "none.json")).count() == 0
    (tmp_path / "ok.json").write_text('[{"dataset_version": "v02", "new_rows": 100}, {"dataset_version": "v03"}]')
    assert tables.read_lineage(spark, str(tmp_path / "ok.json")).count() == 2
    (tmp_path / "bad.json").write_text('[{"dataset_version": ')
    with pytest.raises(Exception):
        tables.read_lineage(spark, str(tmp_path / "bad.json")).collect()


def test_file_fingerprint_is_sha256(spark, tmp_path):
    (tmp_path / "f.csv").write_bytes(b"a,b\n1,2\n")
    row = fingerprint.file_fingerprints(spark, str(tmp_path / "f.csv")).first()
    assert row["sha256"] == hashlib.sha256(b"a,b\n1,2\n").hexdigest()


@pytest.mark.parametrize("whole_bytes", [0, 100, 1 << 20])
def test_file_fingerprints_in_parts(spark, tmp_path, whole_bytes):
    """Files as one value or read in parts of 7 bytes, packed ones as they are, odd names included; empty files are left out."""
    (tmp_path / "empty.csv").write_bytes(b"")
    contents = {"a.csv": b"a", "b c%20d.csv": b"x" * 99, "e.csv": bytes(range(256)) * 9, "f.csv.gz": gzip.compress(b"packed" * 40)}
    for name, content in contents.items():
        (tmp_path / name).write_bytes(content)
    rows = fingerprint.file_fingerprints(spark, str(tmp_path), whole_bytes, 7).collect()
    assert {r["sha256"]: r["length"] for r in rows} == {hashlib.sha256(c).hexdigest(): len(c) for c in contents.values()}
    assert len(rows) == 4


def test_file_fingerprint_beyond_two_gigabytes(spark, tmp_path):
    """No value and no buffer can hold such a file."""
    size = (1 << 31) + 4321
    with (tmp_path / "large.bin").open("wb") as file:
        file.truncate(size)  # a hole: it takes no disk
        file.seek(1 << 30)
        file.write(b"something")
    want = hashlib.sha256()
    with (tmp_path / "large.bin").open("rb") as file:
        while part := file.read(1 << 24):
            want.update(part)
    row = fingerprint.file_fingerprints(spark, str(tmp_path)).first()
    assert row["length"] == size and row["sha256"] == want.hexdigest()


def test_table_fingerprint_ignores_order_but_not_content(spark):
    df = landed(spark, [customer(i) for i in range(40)])
    one = fingerprint.table_fingerprint(df).first()
    assert one == fingerprint.table_fingerprint(df.repartition(5).orderBy(F.rand(1))).first()
    assert one != fingerprint.table_fingerprint(df.union(df.limit(1))).first()
    assert one != fingerprint.table_fingerprint(df.withColumn("gender", F.lit("Male"))).first()
    nulls = spark.createDataFrame([("a", None)], "x string, y string")
    swapped = spark.createDataFrame([(None, "a")], "x string, y string")
    assert fingerprint.table_fingerprint(nulls).first() != fingerprint.table_fingerprint(swapped).first()


def test_loader_needs_every_part(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        models.load_bundle(spark, str(tmp_path / "m"))


def test_column_lookup():
    assert S.resolve_column([" CustomerID ", "x"], ["customerid", "customer_id"]) == " CustomerID "
    assert S.resolve_column(["x"], ["y"]) is None


def test_roles(spark):
    df = spark.createDataFrame([(1, 2.0, "a")], "a int, b double, c string")
    assert S.columns_by_role(df.schema, exclude=["a"]) == (["b"], ["c"])


@pytest.fixture
def store(spark):
    root = scratch_path(spark, "store")
    ingest.start_table(landed(spark, [customer(i) for i in range(50)]), root)
    return root


def take(spark, root, rows):
    return ingest.ingest(spark, landed(spark, rows), root, "customerID", spec=CUSTOMER_SPEC).first()


def test_ingestion_and_replay(spark, store):
    batch = [customer(i) for i in range(100, 120)]
    first = take(spark, store, batch)
    assert (first["status"], first["dataset_version"], first["previous_rows"], first["current_rows"]) == ("ingested", "v02", 50, 70)
    again = take(spark, store, batch[::-1])
    assert (again["status"], again["ingestion_performed"], again["current_rows"]) == ("already_ingested", False, 70)
    second = take(spark, store, [customer(i) for i in range(200, 205)])
    assert (second["dataset_version"], second["current_rows"]) == ("v03", 75)
    assert snapshots.read_current(spark, store).count() == 75
    assert ingest.ingest(spark, None, store, "customerID").first()["status"] == "no_new_data"
    checked = ingest.lineage_invariants(snapshots.read_ledger(spark, store)).collect()
    assert len(checked) == 2 and all(r["sums_hold"] and r["continues"] and r["hash_unique"] for r in checked)


def test_rejected_batches_leave_no_trace(spark, store):
    for bad, text in (
        ([customer(100, Contract="Lifetime")], "schema"),
        ([customer(1)], "already present"),
        ([customer(100), customer(100)], "repeated in the new batch"),
        ([], "new batch is empty"),
    ):
        with pytest.raises(ValueError, match=text):
            take(spark, store, bad)
    assert snapshots.read_current(spark, store).count() == 50
    assert snapshots.read_ledger(spark, store).count() == 0


def test_crash_before_the_ledger_row_is_harmless(spark, store, monkeypatch):
    batch = [customer(i) for i in range(100, 110)]

    def crash(*_):
        raise RuntimeError("executor gone")

    with monkeypatch.context() as m:
        m.setattr(ingest, "append_lineage", crash)
        with pytest.raises(RuntimeError):
            take(spark, store, batch)
    assert snapshots.read_current(spark, store).count() == 50
    assert take(spark, store, batch)["status"] == "ingested"
    assert snapshots.read_current(spark, store).count() == 60


def test_corrupt_ledger_stops_ingestion(spark, store):
    from pathlib import Path

    folder = Path(snapshots.lineage_path(store))
    folder.mkdir(parents=True)
    (folder / "part-0.json").write_text('{"dataset_version": ')
    with pytest.raises(Exception):
        take(spark, store, [customer(100)])


def test_holdout_stays_frozen(spark):
    path = scratch_path(spark, "ids")
    first = spark.createDataFrame([("a",), ("b",)], "id string")
    membership.frozen_ids(spark, path, lambda: first).count()
    later = membership.frozen_ids(spark, path, lambda: first.where("false"))
    assert {r["id"] for r in later.collect()} == {"a", "b"}
    rows = spark.createDataFrame([("a", 1), ("c", 2), (None, 3)] + [("b", 4)] * 200, "id string, n int")
    assert membership.holdout_side(rows, later, "id").count() == 201
    assert {r["n"] for r in membership.training_side(rows, later, "id").collect()} == {2, 3}
    with pytest.raises(ValueError):
        membership.require_holdout(rows.where("n = 2"), later, "id")
