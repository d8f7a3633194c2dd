"""Idempotent ingestion of one batch into the versioned current table."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.operators.checks import any_failure, require_schema
from modelwatch.operators.membership import require_identity, require_new_ids
from modelwatch.schema import TableSpec
from modelwatch.session import stage_table
from modelwatch.sources.fingerprint import grouped_fingerprints, table_fingerprint
from modelwatch.sources.snapshots import (
    VERSION,
    append_lineage,
    last_commit,
    publish_batch,
    publish_batches,
    read_ledger,
    read_version,
    snapshot_path,
)

REPORT = T.StructType(
    [
        T.StructField("status", T.StringType()),
        T.StructField("ingestion_performed", T.BooleanType()),
        T.StructField("dataset_version", T.StringType()),
        T.StructField("new_data_hash", T.StringType()),
        T.StructField("previous_rows", T.LongType()),
        T.StructField("new_rows", T.LongType()),
        T.StructField("current_rows", T.LongType()),
    ]
)


def start_table(df: DataFrame, root: str) -> str:
    """Version 1, which needs no lineage row."""
    return publish_batch(df, root, 1)


def _report(spark: SparkSession, status: str, **fields) -> DataFrame:
    row = tuple(
        status if f.name == "status" else status == "ingested" if f.name == "ingestion_performed" else fields.get(f.name)
        for f in REPORT.fields
    )
    return spark.createDataFrame([row], REPORT)


def rejected(spark: SparkSession, rows: int) -> DataFrame:
    """Report of a batch that breaks the identity rules."""
    return _report(spark, "rejected", new_rows=rows)


def lineage_record(
    spark: SparkSession, *, version: int, archive: str, source: str, fingerprint: str, previous: int, new: int
) -> DataFrame:
    """The ledger row of an accepted batch: current = previous + new."""
    row = spark.createDataFrame(
        [(f"v{version:02d}", archive, source, fingerprint, previous, new, previous + new)],
        "dataset_version string, archive_file string, source_file string, new_data_hash string, "
        "previous_rows long, new_rows long, current_rows long",
    )
    return row.withColumn("timestamp", F.current_timestamp())


def ingest(
    spark: SparkSession,
    batch: DataFrame | None,
    root: str,
    key: str,
    *,
    spec: TableSpec | None = None,
    source: str = "batch",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Take one batch in, exactly once; returns a one-row report.

    Fingerprint first: a known batch ends here. Then schema, identity against the
    current table, the batch's own folder, and last the ledger row that makes it
    visible. A crash before that row leaves nothing to undo. The first batch
    checks the ids of the whole table; later ones only their own ids against it.
    """
    last = last_commit(spark, root)
    old = int(last["dataset_version"][1:]) if last else 1
    current = read_version(spark, root, old)
    if batch is None:
        return _report(spark, "no_new_data", current_rows=last["current_rows"] if last else current.count())
    cols = list(columns or batch.columns)
    stamp = table_fingerprint(batch.select(*cols)).first()
    if not read_ledger(spark, root).where(F.col("new_data_hash") == stamp["fingerprint"]).isEmpty():
        return _report(
            spark,
            "already_ingested",
            new_data_hash=stamp["fingerprint"],
            new_rows=stamp["rows"],
            current_rows=last["current_rows"],
        )
    if spec is not None:
        require_schema(batch, spec)
    if last:
        previous, new = last["current_rows"], require_new_ids(batch, current, key)
    else:
        sizes = require_identity(batch, current, key)
        previous, new = sizes["current_rows"], sizes["new_rows"]
    publish_batch(batch.select(*current.columns), root, old + 1)
    record = lineage_record(
        spark,
        version=old + 1,
        archive=snapshot_path(root, old),
        source=source,
        fingerprint=stamp["fingerprint"],
        previous=previous,
        new=new,
    )
    append_lineage(record, root)
    return _report(
        spark,
        "ingested",
        dataset_version=f"v{old + 1:02d}",
        new_data_hash=stamp["fingerprint"],
        previous_rows=previous,
        new_rows=new,
        current_rows=previous + new,
    )


FILE_REPORT = T.StructType([T.StructField("source_file", T.StringType()), *REPORT.fields, T.StructField("reason", T.StringType())])


def _file_verdicts(rows: DataFrame, file: str, key: str, spec: TableSpec | None, known: DataFrame, cols: Sequence[str]) -> list[Row]:
    """Per file, in order of names: its size, fingerprint, and why it cannot be taken; one grouped aggregate."""
    broken = any_failure(rows, spec) | F.lit(any(c not in rows.columns for c in spec.columns)) if spec else F.lit(False)
    per_id = rows.groupBy(file, F.col(key).cast("string").alias("_id")).agg(F.count(F.lit(1)).alias("n"))
    repeated = per_id.groupBy(file).agg(F.count_if(F.col("n") > 1).alias("repeated"))
    invalid = rows.groupBy(file).agg(F.count_if(broken).alias("invalid"))
    stamps = grouped_fingerprints(rows, [file], cols)
    stamps = stamps.join(known.select(F.col("new_data_hash").alias("fingerprint")).distinct().withColumn("known", F.lit(True)), "fingerprint", "left")
    return stamps.join(repeated, file).join(invalid, file).orderBy(file).collect()  # a row for each file of a trigger


def _without_shared_ids(rows: DataFrame, current: DataFrame, file: str, key: str, candidates: list[str]) -> tuple[list[str], list[str]]:
    """(taken, refused) as if the files came one after another: an id may be in the table or in one taken file only.

    A round takes every file all of whose ids come first in it, and refuses what shares an id with one taken. The first
    file left is taken in any case, so that rounds end; mostly there is one.
    """
    ids = rows.select(F.col(file).alias("_f"), F.col(key).cast("string").alias("_id")).distinct()
    ids = stage_table(ids, "landing-ids")
    present = ids.join(current.select(F.col(key).cast("string").alias("_id")), "_id", "left_semi")
    refused = {r["_f"] for r in present.select("_f").distinct().collect()} & set(candidates)
    taken, left = [], [f for f in candidates if f not in refused]
    while left:
        mine = ids.where(F.col("_f").isin(left))
        firsts = mine.groupBy("_id").agg(F.min("_f").alias("_first"))
        later = {r["_f"] for r in mine.join(firsts, "_id").where("_f <> _first").select("_f").distinct().collect()}
        now = [f for f in left if f not in later]
        taken += now
        left = [f for f in left if f in later]
        if left:
            used = ids.where(F.col("_f").isin(now)).select("_id")
            shared = ids.where(F.col("_f").isin(left)).join(used, "_id", "left_semi")
            clash = {r["_f"] for r in shared.select("_f").distinct().collect()}
            refused |= clash
            left = [f for f in left if f not in clash]
    return sorted(taken), sorted(refused)


def ingest_files(
    spark: SparkSession, batch: DataFrame, root: str, key: str, file: str, *, spec: TableSpec | None = None, quarantine: str | None = None
) -> DataFrame:
    """Take the files of one micro-batch in, each exactly once, with the result of taking them one by one by name.

    ``file`` is the column with the file's name. Rows are written once to the scratch folder; fingerprints, schema and
    identity of all files come from a few aggregates over them; accepted files become versions by one partitioned write,
    visible by one write of the ledger. Files that equal an earlier one, or one taken before, change nothing; broken ones
    go to ``quarantine``. Returns a report row for each file, with the reason for a refusal.
    """
    rows = stage_table(batch, "landing")
    last = last_commit(spark, root)
    old = int(last["dataset_version"][1:]) if last else 1
    current = read_version(spark, root, old)
    columns = [c for c in rows.columns if c != file]
    verdicts = _file_verdicts(rows, file, key, spec, read_ledger(spark, root), columns)
    reasons: dict[str, str] = {}
    twins: dict[str, str] = {}
    if last is None:
        own = current.groupBy(F.col(key).cast("string")).count().where("count > 1")
        if not own.isEmpty():
            reasons = {v[file]: "ids repeated in the current table" for v in verdicts}
    candidates, seen = [], {}
    for v in verdicts:
        name = v[file]
        if v["known"]:
            twins[name] = v["fingerprint"]
        elif name in reasons:
            continue
        elif v["invalid"]:
            reasons[name] = f"schema validation failed ({v['invalid']} rows)"
        elif v["repeated"]:
            reasons[name] = f"ids repeated in the new batch ({v['repeated']})"
        elif v["fingerprint"] in seen:
            seen[v["fingerprint"]].append(name)
        else:
            seen[v["fingerprint"]] = [name]
            candidates.append(name)
    taken, refused = _without_shared_ids(rows, current, file, key, candidates) if candidates else ([], [])
    reasons |= {name: "ids already present" for name in refused}
    by_name = {v[file]: v for v in verdicts}
    for name in candidates:
        for twin in seen[by_name[name]["fingerprint"]][1:]:
            if name in taken:
                twins[twin] = by_name[name]["fingerprint"]
            else:
                reasons[twin] = reasons[name]
    if refused_files := sorted(reasons):
        if quarantine:
            rows.where(F.col(file).isin(refused_files)).write.mode("overwrite").parquet(quarantine)
    total = last["current_rows"] if last else current.count() if taken or twins else None
    records, reports = [], {}
    for i, name in enumerate(taken):
        stamp = by_name[name]
        version = old + 1 + i
        common = dict(dataset_version=f"v{version:02d}", new_data_hash=stamp["fingerprint"], previous_rows=total, new_rows=stamp["rows"], current_rows=total + stamp["rows"])
        records.append(
            lineage_record(
                spark, version=version, archive=snapshot_path(root, version - 1), source=name, fingerprint=stamp["fingerprint"], previous=total, new=stamp["rows"]
            )
        )
        reports[name] = ("ingested", common, None)
        total += stamp["rows"]
    for name, fingerprint in twins.items():
        reports[name] = ("already_ingested", dict(new_data_hash=fingerprint, new_rows=by_name[name]["rows"], current_rows=total), None)
    for name, reason in reasons.items():
        reports[name] = ("rejected", dict(new_rows=by_name[name]["rows"]), reason)
    if taken:
        versions = spark.createDataFrame([(n, old + 1 + i) for i, n in enumerate(taken)], f"`{file}` string, `{VERSION}` int")
        accepted = rows.join(F.broadcast(versions), file).select(*current.columns, VERSION)
        publish_batches(accepted, root)
        append_lineage(reduce(DataFrame.unionByName, records), root)
    out = [(name, status, status == "ingested", *[fields.get(f.name) for f in REPORT.fields[2:]], reason) for name, (status, fields, reason) in sorted(reports.items())]
    return spark.createDataFrame(out, FILE_REPORT)


def lineage_invariants(ledger: DataFrame) -> DataFrame:
    """Per ledger row: sums hold, it continues the preceding version, its hash is unique."""
    number = F.substring("dataset_version", 2, 20).cast("int")
    rows = ledger.withColumn("version", number)
    # A ledger has a row per batch; the row before is the one of the next smaller version, whatever its number.
    preceding = Window.orderBy("version")
    rows = rows.select("*", F.lag("version").over(preceding).alias("_last"), F.lag("current_rows").over(preceding).alias("_before"))
    repeated = rows.groupBy("new_data_hash").agg((F.count(F.lit(1)) == 1).alias("hash_unique"))
    return (
        rows.join(repeated, "new_data_hash")
        .select(
            "dataset_version",
            (F.col("current_rows") == F.col("previous_rows") + F.col("new_rows")).alias("sums_hold"),
            F.coalesce((F.col("_before") == F.col("previous_rows")) & (F.col("_last") + 1 == F.col("version")), F.col("_last").isNull()).alias("continues"),
            "hash_unique",
        )
    )
