"""Identity, overlap and holdout membership."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.operators.joins import membership
from modelwatch.sources.fingerprint import row_digest
from modelwatch.sources.tables import path_exists


def _tagged(a: DataFrame, b: DataFrame, cols: Sequence[str]) -> DataFrame:
    return a.select(*cols, F.lit(1).alias("_a"), F.lit(0).alias("_b")).unionByName(
        b.select(*cols, F.lit(0).alias("_a"), F.lit(1).alias("_b"))
    )


def _ids(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).cast("string").alias("id"))


def identity_report(new: DataFrame, current: DataFrame, key: str) -> DataFrame:
    """One row: row counts, ids repeated in either side, ids in both, and the verdict.

    A single shuffle of (id, counts) that were already combined per task, so a
    repeated id costs one row per task. Ids are compared as text.
    """
    ids = _tagged(_ids(new, key), _ids(current, key), ["id"])
    per_id = ids.groupBy("id").agg(F.sum("_a").alias("a"), F.sum("_b").alias("b"))
    counts = per_id.agg(
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("new_rows"),
        F.coalesce(F.sum("b"), F.lit(0)).cast("bigint").alias("current_rows"),
        F.count_if(F.col("a") > 1).alias("repeated_new"),
        F.count_if(F.col("b") > 1).alias("repeated_current"),
        F.count_if((F.col("a") > 0) & (F.col("b") > 0)).alias("overlap"),
    )
    problem = (
        F.when(F.col("new_rows") == 0, "new batch is empty")
        .when(F.col("current_rows") == 0, "current table is empty")
        .when(F.col("repeated_new") > 0, "ids repeated in the new batch")
        .when(F.col("repeated_current") > 0, "ids repeated in the current table")
        .when(F.col("overlap") > 0, "ids already present")
    )
    return counts.select("*", F.coalesce(problem, F.lit("ok")).alias("identity"))


def require_identity(new: DataFrame, current: DataFrame, key: str) -> dict:
    row = identity_report(new, current, key).first()
    if row["identity"] != "ok":
        raise ValueError(f"{row['identity']} (overlap {row['overlap']}, repeated {row['repeated_new']})")
    return row.asDict()


def require_new_ids(new: DataFrame, current: DataFrame, key: str) -> int:
    """Rows of the batch, or an error. For a current table whose own ids were checked when it grew.

    Only the ids of the batch meet the current table, so a small batch is a
    broadcast filter over one column of it.
    """
    counts = _ids(new, key).groupBy("id").agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.agg(F.sum("n").alias("rows"), F.count_if(F.col("n") > 1).alias("repeated")).first()
    if not sizes["rows"]:
        raise ValueError("new batch is empty")
    if sizes["repeated"]:
        raise ValueError(f"ids repeated in the new batch ({sizes['repeated']})")
    overlap = _ids(current, key).join(counts.select("id"), "id", "left_semi").agg(F.count_distinct("id")).first()[0]
    if overlap:
        raise ValueError(f"ids already present ({overlap})")
    return sizes["rows"]


def row_overlap(new: DataFrame, holdout: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One row: how many new rows equal some holdout row in all ``cols`` (NULL equals NULL).

    Columns of different types meet in their common type, so 5 equals 5.0. Only 256-bit digests are shuffled, combined
    per task first.
    """
    both = _tagged(new, holdout, cols).select(row_digest(cols).alias("d"), "_a", "_b")
    per_row = both.groupBy("d").agg(F.sum("_a").alias("a"), F.max("_b").alias("b"))
    return per_row.agg(
        F.coalesce(F.sum("a"), F.lit(0)).cast("bigint").alias("new_rows"),
        F.coalesce(F.sum(F.when(F.col("b") == 1, F.col("a"))), F.lit(0)).cast("bigint").alias("overlapping_rows"),
    )


def common_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Distinct ids present on both sides."""
    ids = _tagged(a.select(key), b.select(key), [key]).where(F.col(key).isNotNull())
    per_id = ids.groupBy(key).agg(F.max("_a").alias("a"), F.max("_b").alias("b"))
    return per_id.where("a = 1 and b = 1").select(key)


def all_categories(a: DataFrame, b: DataFrame, column: str) -> DataFrame:
    """Distinct non-null values of either side."""
    return a.select(column).unionByName(b.select(column)).where(F.col(column).isNotNull()).distinct()


def append_batch(current: DataFrame, batch: DataFrame) -> DataFrame:
    """Bag union by column name."""
    return current.unionByName(batch)


def already_seen(batch_prints: DataFrame, lineage: DataFrame) -> DataFrame:
    """Fingerprints that are in the ledger."""
    known = lineage.select(F.col("new_data_hash").alias("fingerprint")).distinct()
    return batch_prints.join(known, "fingerprint", "left_semi")


def holdout_side(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """Rows whose id is frozen as holdout. The id table grows with the data, so no broadcast is forced."""
    return membership(df, ids, key, keep_members=True)


def training_side(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    """All other rows; rows without id train."""
    return membership(df, ids, key, keep_members=False)


def require_holdout(df: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    test = holdout_side(df, ids, key)
    if test.isEmpty():
        raise ValueError("none of the frozen holdout ids occur in the data")
    return test


def frozen_ids(spark: SparkSession, path: str, make_ids) -> DataFrame:
    """The holdout ids: made and written once, only read afterwards. An unfinished write does not count."""
    if not path_exists(spark, f"{path}/_SUCCESS"):
        make_ids().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)
