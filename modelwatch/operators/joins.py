"""Joins used by several operators."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def null_safe_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join that also matches NULL with NULL; key columns come from the left."""
    renamed = right.select(*[F.col(c).alias(f"_r_{c}") if c in keys else F.col(c) for c in right.columns])
    condition = reduce(lambda a, b: a & b, [left[k].eqNullSafe(renamed[f"_r_{k}"]) for k in keys])
    return left.join(renamed, condition, how).drop(*[f"_r_{k}" for k in keys])


def membership(left: DataFrame, keys: DataFrame, key: str, *, keep_members: bool) -> DataFrame:
    """Rows of ``left`` whose ``key`` is (or is not) in ``keys``; a row without key is never a member.

    One semi or anti join on undistinguished keys: a hot key of ``left`` is split by adaptive execution, which sees the
    true partition sizes, and neither side needs a pass of its own.
    """
    how = "left_semi" if keep_members else "left_anti"
    return left.join(keys.select(key), key, how).select(*left.columns)


def mark_members(left: DataFrame, keys: DataFrame, key: str, out: str) -> DataFrame:
    """``left`` with a boolean ``out``: is the row's ``key`` in ``keys``? A row without key is never a member. One join."""
    known = keys.select(F.col(key).alias("_member")).where("_member is not null").distinct()
    joined = left.join(known, left[key] == known["_member"], "left")
    return joined.withColumn(out, F.col("_member").isNotNull()).drop("_member")
