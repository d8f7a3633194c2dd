"""Descriptive aggregates over tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.operators.joins import null_safe_join
from modelwatch.operators.ordered import ROWS_PER_BLOCK, exact_quantiles, few_groups, long_numeric, with_names


def class_distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percentage per value; missing values are in neither number."""
    present = df.where(F.col(column).isNotNull())
    total = df.agg(F.count(column)).scalar()
    counts = present.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.withColumn("percent", F.col("n") * 100.0 / total)


def rate_by(df: DataFrame, cols: Sequence[str], flag: Column) -> DataFrame:
    """Positive rate per value of each column; all columns in one pass. A row without flag is in n, not in the rate."""
    slim = df.select(flag.cast("int").alias("_flag"), *[F.col(c).cast("string").alias(c) for c in cols])
    tall = slim.unpivot(["_flag"], list(cols), "column", "value").where(F.col("value").isNotNull())
    return tall.groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.coalesce("_flag", F.lit(0))).cast("bigint").alias("positives"),
        F.avg("_flag").alias("rate"),
    )


def describe(df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """count, mean, sample std, min, q25, q50, q75, max per column (and group); quartiles are exact.

    One aggregate over the columns side by side gives the moments. A column without
    values has count 0.
    """
    by = list(by)

    def moments(c: str) -> Column:
        v = F.col(c).cast("double") + F.lit(0.0)
        return F.struct(
            F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
        )

    wide = df.groupBy(*by).agg(*[moments(c).alias(f"_m{i}") for i, c in enumerate(cols)])
    each = [F.struct(F.lit(c).alias("column"), F.col(f"_m{i}.*")) for i, c in enumerate(cols)]
    stats = wide.select(*by, F.explode(F.array(*each)).alias("_s")).select(*by, "_s.*")
    quarts = exact_quantiles(df, cols, [0.25, 0.5, 0.75], by, rows_per_block=rows_per_block).select(
        *by, "column", F.col("q0").alias("q25"), F.col("q1").alias("q50"), F.col("q2").alias("q75")
    )
    return null_safe_join(stats, quarts, by + ["column"], "left")


def dataset_summary(datasets: dict[str, DataFrame], label: str) -> DataFrame:
    """Rows, positives, negatives and positive rate (6 places) of several tables."""
    tagged = [df.select(F.lit(name).alias("dataset"), F.col(label).alias("y")) for name, df in datasets.items()]
    return (
        reduce(DataFrame.unionByName, tagged)
        .groupBy("dataset")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("y") == 1).alias("churn"),
            F.count_if(F.col("y") == 0).alias("non_churn"),
            F.round(F.avg("y"), 6).alias("churn_rate"),
        )
    )


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson correlation of every column pair, over rows where both are present."""
    pairs = list(combinations(cols, 2))
    row = df.agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    tall = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r")
    parts = F.split("pair", r"\|")
    return tall.select(parts[0].alias("a"), parts[1].alias("b"), "r")


def histogram(df: DataFrame, column: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts in equal-width bins; the last bin includes its upper edge."""
    value = F.col(column).cast("double")
    number = F.least(F.width_bucket(value, F.lit(float(lo)), F.lit(float(hi)), F.lit(bins)), F.lit(bins))
    inside = df.where((value >= lo) & (value <= hi))
    return inside.groupBy(number.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


def box_numbers(df: DataFrame, column: str, by: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Quartiles, whisker ends within 1.5 IQR, and the number of outliers per class."""
    quarts = exact_quantiles(df, [column], [0.25, 0.5, 0.75], [by], rows_per_block=rows_per_block).select(
        by,
        "n",
        F.col("q0").alias("q1"),
        F.col("q1").alias("median"),
        F.col("q2").alias("q3"),
    )
    fences = quarts.select(
        "*",
        (F.col("q1") - 1.5 * (F.col("q3") - F.col("q1"))).alias("_lo"),
        (F.col("q3") + 1.5 * (F.col("q3") - F.col("q1"))).alias("_hi"),
    )
    if few_groups(df, [by]):
        fences = F.broadcast(fences)
    # Equal values share one row from here on, so a class is joined value by value.
    values = long_numeric(df, [column], [by]).groupBy(by, "value").agg(F.count(F.lit(1)).alias("rows"))
    inside = (F.col("value") >= F.col("_lo")) & (F.col("value") <= F.col("_hi"))
    return (
        null_safe_join(values, fences, [by])
        .groupBy(by, "n", "q1", "median", "q3")
        .agg(
            F.min(F.when(inside, F.col("value"))).alias("whisker_low"),
            F.max(F.when(inside, F.col("value"))).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("rows"))), F.lit(0)).cast("bigint").alias("outliers"),
        )
    )


def duplicate_count(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: how many rows repeat an earlier one. Texts travel as 256-bit digests."""
    types = dict(df.dtypes)
    keys = [F.sha2(c, 256).alias(c) if types[c] == "string" else F.col(c) for c in (cols or df.columns)]
    groups = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies"))
    return groups.agg(F.coalesce(F.sum(F.col("copies") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def duplicate_rows(df: DataFrame, cols: Sequence[str] | None = None, chunk: int = 100_000) -> DataFrame:
    """Every member of every group of equal rows, sorted by all columns; ``copy`` numbers the members.

    Copies are counted per task before the shuffle and written out again in
    chunks, so a huge group is spread over many tasks. ``copy`` also lets the
    range sort split it.
    """
    cols = list(cols or df.columns)
    groups = df.groupBy(*cols).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    starts = groups.withColumn("_from", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"), F.lit(chunk).cast("bigint"))))
    spread = starts.repartition("_from", *cols)
    last = F.least(F.col("_from") + chunk - 1, F.col("copies"))
    rows = spread.select(*cols, "copies", F.explode(F.sequence("_from", last)).alias("copy"))
    return rows.orderBy(*cols, "copy")


def distinct_values(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Distinct values of each column in long form, with their counts."""
    slim = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return slim.unpivot([], list(cols), "column", "value").groupBy("column", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def table_profile(df: DataFrame) -> DataFrame:
    """One row per column: position, type, rows, non-null values."""
    items = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(c).alias("column"),
            F.lit(t).alias("dtype"),
            F.count(F.lit(1)).alias("rows"),
            F.count(c).alias("non_null"),
        )
        for i, (c, t) in enumerate(df.dtypes)
    ]
    return df.agg(F.array(*items).alias("columns")).select(F.explode("columns").alias("c")).select("c.*")


def prediction_summary(scored: DataFrame, prediction: str, probability: str) -> DataFrame:
    """One row: total, class counts and percentages, probability mean, median, population std, min, max."""
    median = exact_quantiles(scored, [probability], [0.5]).agg(F.max("q0")).scalar()
    counted = scored.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(prediction) == 1).alias("positives"),
        F.count_if(F.col(prediction) == 0).alias("negatives"),
        F.avg(probability).alias("mean_probability"),
        F.stddev_pop(probability).alias("std_probability"),
        F.min(probability).alias("min_probability"),
        F.max(probability).alias("max_probability"),
    )
    return counted.select(
        "*",
        (F.col("positives") * 100.0 / F.col("total")).alias("positive_percent"),
        (F.col("negatives") * 100.0 / F.col("total")).alias("negative_percent"),
        median.alias("median_probability"),
    )


def class_weights(df: DataFrame, label: str) -> DataFrame:
    """One row: class sizes, imbalance ratio, and balanced weights n / (2 * n_c)."""
    n = df.agg(
        F.count_if(F.col(label) == 0).alias("negatives"), F.count_if(F.col(label) == 1).alias("positives")
    )
    both = F.col("negatives") + F.col("positives")
    return n.select(
        "*",
        F.try_divide("negatives", "positives").alias("imbalance"),
        F.try_divide(both, 2 * F.col("negatives")).alias("weight_0"),
        F.try_divide(both, 2 * F.col("positives")).alias("weight_1"),
    )


def mean_shift(both: DataFrame, cols: Sequence[str], side: str = "is_baseline") -> DataFrame:
    """Mean of each column on both sides (marked 1 and 0) and the difference."""
    means = long_numeric(both, cols, [side]).groupBy("column").agg(
        F.avg(F.when(F.col(side) == 1, F.col("value"))).alias("baseline_mean"),
        F.avg(F.when(F.col(side) == 0, F.col("value"))).alias("incoming_mean"),
    )
    return with_names(means, cols).withColumn("shift", F.col("incoming_mean") - F.col("baseline_mean"))


def check_rollup(results: DataFrame, repetition: str, passed: str) -> DataFrame:
    """Did all checks pass, per repetition and overall (repetition NULL)?"""
    per_run = results.groupBy(F.col(repetition).alias("repetition")).agg(
        F.count(F.lit(1)).alias("checks"), F.bool_and(passed).alias("passed")
    )
    overall = per_run.agg(
        F.lit(None).cast(results.schema[repetition].dataType).alias("repetition"),
        F.coalesce(F.sum("checks"), F.lit(0)).cast("bigint").alias("checks"),
        F.coalesce(F.bool_and("passed"), F.lit(True)).alias("passed"),
    )
    return per_run.unionByName(overall).withColumn(
        "status", F.when(F.col("passed"), "PASSED").otherwise("FAILED")
    )


def dataset_profile(train: DataFrame, test: DataFrame, features: str, label: str) -> DataFrame:
    """Rows, positives and encoded width of both sides of a split."""
    tagged = train.select(F.lit("train").alias("split"), features, label).unionByName(
        test.select(F.lit("test").alias("split"), features, label)
    )
    return tagged.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"),
        F.sum(label).cast("bigint").alias("positives"),
        F.max(F.size(features)).alias("width"),
    )
