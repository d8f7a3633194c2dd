"""The current table as a series of batches. The lineage row is the commit marker.

Version v is the union of the folders ``version=1`` to ``version=v``: taking in a
batch writes only that batch, and every earlier version stays readable.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from modelwatch.schema import LINEAGE_SCHEMA
from modelwatch.sources.tables import path_exists

VERSION = "version"


def snapshot_path(root: str, version: int) -> str:
    return f"{root}/snapshots/{VERSION}={version}"


def lineage_path(root: str) -> str:
    return f"{root}/lineage"


def publish_batch(df: DataFrame, root: str, version: int) -> str:
    """Write the rows a version adds. Nothing reads them before their lineage row exists, so a retry overwrites."""
    path = snapshot_path(root, version)
    df.write.mode("overwrite").parquet(path)
    return path


def publish_batches(df: DataFrame, root: str) -> None:
    """The same for several versions at once; column ``VERSION`` names them. Folders of other versions stay."""
    writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(VERSION).parquet(f"{root}/snapshots")


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    path = lineage_path(root)
    if not path_exists(spark, path):
        return spark.createDataFrame([], LINEAGE_SCHEMA)
    return spark.read.schema(LINEAGE_SCHEMA).option("mode", "FAILFAST").json(path)


def append_lineage(record: DataFrame, root: str) -> None:
    record.coalesce(1).write.mode("append").json(lineage_path(root))


def version_of(tag: str) -> Column:
    return F.substring(tag, 2, 20).cast("int")


def last_commit(spark: SparkSession, root: str) -> Row | None:
    """The newest lineage row; None while there is only the first version."""
    return read_ledger(spark, root).orderBy(version_of("dataset_version").desc()).first()


def committed_version(spark: SparkSession, root: str) -> int:
    last = last_commit(spark, root)
    return int(last["dataset_version"][1:]) if last else 1


def read_version(spark: SparkSession, root: str, version: int) -> DataFrame:
    """The table as of a version; later and uncommitted folders are pruned."""
    table = spark.read.option("basePath", f"{root}/snapshots").parquet(f"{root}/snapshots")
    return table.where(F.col(VERSION) <= version).drop(VERSION)


def read_current(spark: SparkSession, root: str) -> DataFrame:
    """The newest committed version."""
    return read_version(spark, root, committed_version(spark, root))
