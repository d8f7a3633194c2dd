"""Structured Streaming forms of the log, ingestion, validation, scoring and drift jobs.

Sources and sinks are folders. Every job takes a checkpoint folder and runs with
``availableNow`` by default, so the same code serves a scheduled catch-up and a
long-running query.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from modelwatch.operators.checks import quarantine
from modelwatch.operators.drift import js_against_baseline
from modelwatch.operators.training import score
from modelwatch.plans.ingest import ingest_files
from modelwatch.plans.monitor import to_log_events
from modelwatch.schema import TableSpec
from modelwatch.session import stage_table
from modelwatch.sources.fingerprint import row_digest

FILE = "_file"


def stream_table(
    spark: SparkSession,
    folder: str,
    schema: T.StructType,
    fmt: str = "parquet",
    glob: str | None = None,
    files_per_trigger: int | None = None,
    name_files: bool = False,
) -> DataFrame:
    """A folder as a stream; with ``name_files`` each row says which file it is from, in column ``FILE``."""
    reader = spark.readStream.schema(schema).format(fmt)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    rows = reader.load(folder)
    return rows.select("*", F.col("_metadata.file_path").alias(FILE)) if name_files else rows


def _start(writer, checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()


def windowed_log(events: DataFrame, width: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Count, failure rate, latency mean and maximum, positive share per event-time window.

    Events that are later than ``delay`` behind the newest one may be left out.
    """
    span = F.window("timestamp", width, slide) if slide else F.window("timestamp", width)
    return (
        events.withWatermark("timestamp", delay)
        .groupBy(span.alias("w"))
        .agg(
            F.count(F.lit(1)).alias("events"),
            F.avg(F.when(F.col("status") == "failure", 1.0).otherwise(0.0)).alias("failure_rate"),
            F.avg("latency_ms").alias("mean_ms"),
            F.max("latency_ms").alias("max_ms"),
            F.avg(F.col("prediction").cast("double")).alias("positive_share"),
        )
        .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "*")
        .drop("w")
    )


def run_windowed_log(
    events: DataFrame, out: str, checkpoint: str, width: str, slide: str | None = None, trigger: dict | None = None
) -> StreamingQuery:
    """Update mode: a trigger writes the windows that it changed, and the state drops windows that the watermark has closed.

    The batch's number names its folder, so that a repeated batch overwrites itself. ``read_windows`` reads the folders;
    ``fold_windows`` makes one of them.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    writer = windowed_log(events, width, slide).writeStream.outputMode("update").foreachBatch(write)
    return _start(writer, checkpoint, trigger)


def read_windows(spark: SparkSession, out: str) -> DataFrame:
    """The newest state of every window, closed or still open. A later batch holds all that an earlier one knew of a window."""
    rows = spark.read.option("basePath", out).parquet(f"{out}/batch=*")
    values = F.struct(*[c for c in rows.columns if c not in ("batch", "window_start", "window_end")])
    newest = rows.groupBy("window_start", "window_end").agg(F.max_by(values, F.col("batch")).alias("v"))
    return newest.select("window_start", "window_end", "v.*")


def fold_windows(spark: SparkSession, out: str, to: str) -> None:
    """Writes the newest state of all windows as one table, for readers that come after the stream has ended."""
    read_windows(spark, out).write.mode("overwrite").parquet(to)


def deduplicated(events: DataFrame, payload: Sequence[str], delay: str) -> DataFrame:
    """One event per (request id, payload). The id alone is not a key: rows of one batch may share it."""
    keyed = events.withColumn("input_hash", row_digest(payload))
    return keyed.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["request_id", "input_hash"])


def run_append(df: DataFrame, out: str, checkpoint: str, fmt: str = "parquet", trigger: dict | None = None) -> StreamingQuery:
    """Append rows to a folder; the file sink's own log makes each batch count once."""
    return _start(df.writeStream.outputMode("append").format(fmt).option("path", out), checkpoint, trigger)


def run_landing(
    stream: DataFrame,
    root: str,
    key: str,
    checkpoint: str,
    *,
    spec: TableSpec | None = None,
    reports: Callable[[DataFrame], None] | None = None,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Ingest each micro-batch, as a whole, or as one batch per file if the stream names its files.

    A batch or file that was taken before has a known fingerprint and changes nothing. One that breaks the schema or the
    identity rules is written to ``<root>/quarantine`` and reported as rejected. All files of a trigger are judged by the
    same few aggregates, published by one write and committed by one write of the ledger (see ``ingest_files``).
    """

    def take(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():
            return
        if FILE not in batch.columns:
            batch = batch.withColumn(FILE, F.lit(f"micro-batch {batch_id}"))
        report = ingest_files(
            batch.sparkSession, batch, root, key, FILE, spec=spec, quarantine=f"{root}/quarantine/batch={batch_id}"
        )
        if reports:
            reports(report)

    return _start(stream.writeStream.foreachBatch(take), checkpoint, trigger)


def run_quarantine(
    stream: DataFrame, spec: TableSpec, good: str, bad: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Split rows into a good and a quarantine folder; the batch id names the target, so a replay overwrites."""

    def split(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        passed, failed = quarantine(batch, spec)
        passed.write.mode("overwrite").parquet(f"{good}/batch={batch_id}")
        failed.write.mode("overwrite").parquet(f"{bad}/batch={batch_id}")
        batch.unpersist()

    return _start(stream.writeStream.foreachBatch(split), checkpoint, trigger)


def scored_events(
    stream: DataFrame, model: PipelineModel, features: Sequence[str], key: Column, **identity: str
) -> DataFrame:
    """Stream of log events for scored rows."""
    return to_log_events(score(model, stream), features, request_id=key.cast("string"), **identity)


def windowed_drift(
    stream: DataFrame,
    baseline: DataFrame,
    column: str,
    out: str,
    checkpoint: str,
    *,
    width: str,
    delay: str,
    time: str = "timestamp",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Jensen-Shannon divergence of a categorical column per closed window against a fixed baseline.

    The stream keeps one counter per (window, category). Windows reach the batch
    function once, when the watermark closes them.
    """
    # A row per category, written once: the baseline is not scanned again for each micro-batch.
    shares = stage_table(
        baseline.where(F.col(column).isNotNull()).groupBy(F.col(column).cast("string").alias("category")).agg(F.count(F.lit(1)).alias("base")),
        "baseline-shares",
    )
    counts = (
        stream.withWatermark(time, delay)
        .where(F.col(column).isNotNull())
        .groupBy(F.window(time, width).alias("w"), F.col(column).cast("string").alias("category"))
        .agg(F.count(F.lit(1)).alias("cur"))
        .select(F.col("w.start").alias("window_start"), "category", "cur")
    )

    def compare(batch: DataFrame, batch_id: int) -> None:
        drift = js_against_baseline(batch, shares, ["window_start"])
        drift.write.mode("overwrite").parquet(f"{out}/batch={batch_id}")

    return _start(counts.writeStream.outputMode("append").foreachBatch(compare), checkpoint, trigger)
