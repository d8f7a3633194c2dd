"""Readers and writers for raw batches, encoded matrices, logs, reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.schema import LINEAGE_SCHEMA, TableSpec, log_schema


LOG_TIME = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Is there anything at the path? Asks the file system that owns it."""
    try:
        spark.read.format("binaryFile").load(path).schema
        return True
    except AnalysisException as exc:
        if exc.getCondition() == "PATH_NOT_FOUND":
            return False
        raise


def require_rows(df: DataFrame, what: str) -> DataFrame:
    """The frame itself, or an error when it has no row. Reads one row."""
    if df.isEmpty():
        raise ValueError(f"{what} is empty")
    return df


def read_header(spark: SparkSession, path: str) -> list[str]:
    """Column names in a CSV header, without scanning the data."""
    return spark.read.option("header", True).csv(path).columns


def read_csv_table(spark: SparkSession, path: str, spec: TableSpec | None = None) -> DataFrame:
    """Land a CSV as text columns; the header decides the columns.

    A missing path or a table without rows is an error, and so are files of one
    folder whose headers differ. A quote in a quoted value is doubled. Lines that
    do not parse are kept in ``_corrupt_record``.
    """
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    names = read_header(spark, path)
    if not names and spec is not None:
        names = spec.columns
    fields = [T.StructField(n, T.StringType()) for n in names] + [T.StructField("_corrupt_record", T.StringType())]
    df = (
        spark.read.schema(T.StructType(fields))
        .option("header", True)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return require_rows(df, path)


def read_log(spark: SparkSession, path: str, input_type: T.DataType | None = None) -> DataFrame:
    """Inference events from JSON lines; blank lines are skipped, no events and a line that does not parse are errors."""
    if not path_exists(spark, path):
        raise FileNotFoundError(path)
    schema = T.StructType(log_schema(input_type).fields + [T.StructField("_corrupt_record", T.StringType())])
    df = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    return require_rows(df, path)


def write_log(events: DataFrame, path: str) -> None:
    """Append events, one JSON line per scored row."""
    events.write.mode("append").option("timestampFormat", LOG_TIME).json(path)


def read_lineage(spark: SparkSession, path: str) -> DataFrame:
    """The ledger: a JSON array or JSON lines; absent means no batch yet, unreadable is an error."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], LINEAGE_SCHEMA)
    return (
        spark.read.schema(LINEAGE_SCHEMA).option("multiLine", True).option("mode", "FAILFAST").json(path)
    )


def write_matrix(df: DataFrame, path: str, key: str, features: str, label: str) -> None:
    """Encoded features next to id and label, so rows never need matching by position."""
    df.select(key, features, label).write.mode("overwrite").parquet(path)


def read_matrix(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A report table as one CSV with a header. Reports hold a few rows."""
    report.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_document(document: DataFrame, path: str) -> None:
    """A one-row nested report as JSON."""
    document.coalesce(1).write.mode("overwrite").json(path)


def evaluation_document(metrics: DataFrame, model_type: str) -> DataFrame:
    """Nested evaluation report: metric map plus [[tn, fp], [fn, tp]]."""
    names = ["accuracy", "precision", "recall", "f1_score", "roc_auc"]
    pairs = [item for n in names if n in metrics.columns for item in (F.lit(n), F.col(n))]
    return metrics.select(
        F.lit(model_type).alias("model_type"),
        F.create_map(*pairs).alias("metrics"),
        F.array(F.array("tn", "fp"), F.array("fn", "tp")).alias("confusion_matrix"),
        (F.col("tn") + F.col("fp") + F.col("fn") + F.col("tp")).alias("test_rows"),
    )
