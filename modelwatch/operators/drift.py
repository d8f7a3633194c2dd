"""Distribution drift between a baseline and a current side.

All operators take one table whose ``is_baseline`` column (1 or 0) marks the
side: ``two_tables`` stacks two frames, ``one_table`` marks the rows of one and
so needs a single scan.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from modelwatch.operators.joins import null_safe_join
from modelwatch.operators.metrics import evaluate, side_by_side
from modelwatch.operators.ordered import (
    LEVELS,
    ROWS_PER_BLOCK,
    Cuts,
    block_cuts,
    block_offsets,
    block_sizes,
    crowded_blocks,
    inside_parents,
    long_numeric,
    running_totals,
    split_blocks,
    with_names,
)
from modelwatch.session import stage_table

KS_THRESHOLD = 0.10
JS_THRESHOLD = 0.10
SERIES_TERMS = 100


SIDE = "is_baseline"
#: A feature of which a side has no value has no score.
NO_DATA = "NO_DATA"


def two_tables(baseline: DataFrame, current: DataFrame) -> DataFrame:
    return baseline.select("*", F.lit(1).alias(SIDE)).unionByName(current.select("*", F.lit(0).alias(SIDE)))


def one_table(df: DataFrame, baseline: Column) -> DataFrame:
    """A row without a verdict belongs to the current side."""
    return df.withColumn(SIDE, F.coalesce(baseline, F.lit(False)).cast("int"))


def _status(score: Column, threshold: float) -> Column:
    return F.when(score >= threshold, "DRIFT").when(score.isNull(), NO_DATA).otherwise("OK")


def _all_features(stats: DataFrame, cols: Sequence[str]) -> DataFrame:
    """A row per feature, also for one without any value."""
    names = stats.sparkSession.createDataFrame([(c,) for c in cols], "feature string")
    return names.join(stats, "feature", "left")


def ks_p_value(d: Column, n1: Column, n2: Column) -> Column:
    """Asymptotic two-sided p-value: the Kolmogorov series at sqrt(n1 n2 / (n1 + n2)) * d.

    For a very small argument the alternating series does not settle; its limit is 1.
    """
    n1, n2 = n1.cast("double"), n2.cast("double")
    x = F.sqrt(n1 * n2 / (n1 + n2)) * d
    terms = F.transform(
        F.sequence(F.lit(1), F.lit(SERIES_TERMS)),
        lambda j: F.when(j % 2 == 1, F.lit(2.0)).otherwise(F.lit(-2.0)) * F.exp(F.lit(-2.0) * j * j * x * x),
    )
    series = F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)
    return F.when(x < 0.2, F.lit(1.0)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), series)))


def _side_counts(tall: DataFrame, keys: Sequence[str]) -> DataFrame:
    return tall.groupBy(*keys).agg(
        F.sum(SIDE).cast("bigint").alias("base"), F.sum(1 - F.col(SIDE)).cast("bigint").alias("cur")
    )


def _lead(base: Column, cur: Column) -> Column:
    """How far the baseline distribution is ahead of the current one."""
    return F.try_divide(base, "total_base") - F.try_divide(cur, "total_cur")


def _all_gaps(tall: DataFrame) -> DataFrame:
    run = running_totals(_side_counts(tall, ["column", "value"]), "value", ["base", "cur"], ["column"])
    return run.select("column", F.abs(_lead("cum_base", "cum_cur")).alias("gap"), "total_base", "total_cur")


def _largest_gaps(tall: DataFrame, rows_per_block: int) -> DataFrame:
    """Gaps at all block ends, and at all values of the blocks that may exceed them.

    A block that starts with lead d and holds shares p and q of the two sides keeps
    its lead within [d - q, d + p]. Blocks whose bound does not exceed the largest
    gap at a block end cannot hold the maximum and are not looked into at all;
    crowded ones among the others are cut again, and judged again, before any row
    is sorted.
    """
    values, keys = ["base", "cur"], ["column", "_block"]
    totals = ["total_base", "total_cur"]
    rows, parents, ends = tall, None, []
    for level in range(LEVELS):
        sides = [F.sum(SIDE).cast("bigint").alias("base"), F.sum(1 - F.col(SIDE)).cast("bigint").alias("cur")]
        sizes = block_sizes(rows, keys, *sides)
        offsets = [f"_off_{v}" for v in values]
        if parents is None:
            blocks = block_offsets(sizes, values, ["column"]).withColumn("_earlier", F.lit(0.0))
        else:
            parent = parents.select(*keys, *offsets, *totals, F.col("_best").alias("_earlier"))
            blocks = inside_parents(sizes, parent, ["column"], values, offsets)
        start = _lead("_off_base", "_off_cur")
        bound = F.greatest(
            F.abs(start + F.try_divide("base", "total_base")), F.abs(start - F.try_divide("cur", "total_cur"))
        )
        end = F.abs(_lead(F.col("_off_base") + F.col("base"), F.col("_off_cur") + F.col("cur")))
        known = blocks.select("*", end.alias("gap"), bound.alias("_bound"))
        best = F.greatest(F.max("gap").over(W.partitionBy("column")), "_earlier")
        known = stage_table(known.withColumn("_best", best).drop("_earlier"), "ks-blocks")
        ends.append(known.select("column", "gap", *totals))
        parents = known.where("_bound > _best")
        # A row per column and open block, while a block has more than one.
        reached = F.broadcast(parents.select(*keys))
        hit = null_safe_join(rows, reached, keys, "left_semi")
        crowded = crowded_blocks(parents, F.col("base") + F.col("cur"), rows_per_block)
        if level + 1 == LEVELS or crowded.isEmpty():
            break
        rows = split_blocks(stage_table(hit, "ks-rows"), crowded, keys, True)
    counts = _side_counts(hit, [*keys, "value"])
    inside = W.partitionBy(*keys).orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    summed = counts.select(*keys, *[F.sum(v).over(inside).alias(v) for v in values])
    refined = summed.join(F.broadcast(parents.select(*keys, *offsets, *totals)), keys)
    lead = _lead(F.col("_off_base") + F.col("base"), F.col("_off_cur") + F.col("cur"))
    return reduce(DataFrame.unionByName, [*ends, refined.select("column", F.abs(lead).alias("gap"), *totals)])


def ks_statistic(
    both: DataFrame,
    cols: Sequence[str],
    threshold: float = KS_THRESHOLD,
    cuts: Cuts | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Two-sample Kolmogorov-Smirnov per numeric column, missing values dropped.

    Counts per (column, value) and their running sums give both empirical
    distributions at every value; the score is their largest gap. On large data
    only the blocks that can hold that gap are looked into. A side without values
    gives a NULL score.
    """
    if cuts is None:
        cuts = block_cuts(both, cols, rows_per_block)
    tall = long_numeric(both, cols, [SIDE], cuts)
    run = _all_gaps(tall) if "_block" not in tall.columns else _largest_gaps(tall, rows_per_block)
    stats = run.groupBy("column").agg(
        F.max("gap").alias("score"), F.max("total_base").alias("n_baseline"), F.max("total_cur").alias("n_current")
    )
    stats = _all_features(with_names(stats, cols, "feature"), cols)
    p = ks_p_value(F.col("score"), F.col("n_baseline"), F.col("n_current"))
    return stats.select(
        "feature",
        "score",
        F.when(F.col("score").isNotNull(), p).alias("p_value"),
        F.coalesce("n_baseline", F.lit(0)).alias("n_baseline"),
        F.coalesce("n_current", F.lit(0)).alias("n_current"),
        _status(F.col("score"), threshold).alias("status"),
    )


def category_counts(both: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Counts of both sides per (feature, category): the union of categories, absent ones 0."""
    slim = both.select(SIDE, *[F.col(c).cast("string").alias(c) for c in cols])
    tall = slim.unpivot([SIDE], list(cols), "feature", "category").where(F.col("category").isNotNull())
    return tall.groupBy("feature", "category").agg(
        F.sum(SIDE).cast("bigint").alias("base"), F.sum(1 - F.col(SIDE)).cast("bigint").alias("cur")
    )


def js_from_counts(counts: DataFrame, by: Sequence[str]) -> DataFrame:
    """Base-2 Jensen-Shannon divergence per group of (base, cur) category counts.

    With the category totals per group known, each category adds its own term, so
    categories are never gathered. NULL when a side is empty. The totals hold one
    row per group (a feature, or a feature in a time window), not per category, and
    are therefore broadcast: a hot feature is not shuffled to one task.
    """
    by = list(by)
    totals = counts.groupBy(*by).agg(F.sum("base").alias("_nb"), F.sum("cur").alias("_nc"))
    p, q = F.try_divide("base", "_nb"), F.try_divide("cur", "_nc")
    m = (p + q) / 2

    def part(x: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).when(x == 0, F.lit(0.0))

    return (
        counts.join(F.broadcast(totals), by)
        .groupBy(*by)
        .agg(F.sum((part(p) + part(q)) / 2).alias("score"))
    )


def js_against_baseline(counts: DataFrame, shares: DataFrame, by: Sequence[str]) -> DataFrame:
    """Divergence per group of (category, cur) counts from fixed (category, base) counts.

    Only categories a group has seen are joined. Those it has not seen hold the
    rest of the baseline mass, and each adds half its share: log2(p / (p / 2)) = 1.
    """
    by = list(by)
    n_base = shares.agg(F.sum("base")).scalar()
    totals = counts.groupBy(*by).agg(F.sum("cur").alias("_nc"))
    p, q = F.try_divide(F.coalesce("base", F.lit(0)), n_base), F.try_divide("cur", "_nc")
    m = (p + q) / 2
    term = F.when(p > 0, p * F.log2(p / m)).otherwise(0.0) + F.when(q > 0, q * F.log2(q / m)).otherwise(0.0)
    return (
        counts.join(F.broadcast(totals), by)
        .join(shares, "category", "left")
        .groupBy(*by)
        .agg(((F.sum(term) + 1.0 - F.sum(p)) / 2).alias("score"))
    )


def js_divergence(both: DataFrame, cols: Sequence[str], threshold: float = JS_THRESHOLD) -> DataFrame:
    scores = _all_features(js_from_counts(category_counts(both, cols), ["feature"]), cols)
    return scores.select("feature", "score", _status(F.col("score"), threshold).alias("status"))


def data_drift_report(
    both: DataFrame,
    numeric: Sequence[str],
    categorical: Sequence[str],
    ks_threshold: float = KS_THRESHOLD,
    js_threshold: float = JS_THRESHOLD,
) -> DataFrame:
    """feature, type, metric, score, p_value, threshold, status; scores to 6 places."""
    ks = ks_statistic(both, numeric, ks_threshold).select(
        "feature",
        F.lit("numerical").alias("type"),
        F.lit("KS").alias("metric"),
        F.round("score", 6).alias("score"),
        F.round("p_value", 6).alias("p_value"),
        F.lit(ks_threshold).alias("threshold"),
        "status",
    )
    js = js_divergence(both, categorical, js_threshold).select(
        "feature",
        F.lit("categorical").alias("type"),
        F.lit("JS").alias("metric"),
        F.round("score", 6).alias("score"),
        F.lit(None).cast("double").alias("p_value"),
        F.lit(js_threshold).alias("threshold"),
        "status",
    )
    return ks.unionByName(js)


def prediction_drift(
    both: DataFrame, prediction: str, probability: str, threshold: float = KS_THRESHOLD
) -> DataFrame:
    """One row: KS, p-value and status of the predicted classes and of the probabilities."""
    ks = ks_statistic(both, [prediction, probability], threshold)

    def pick(column: str, out: str, feature: str) -> Column:
        return F.max(F.when(F.col("feature") == feature, F.col(column))).alias(out)

    return ks.agg(
        *[
            pick(column, f"{name}_distribution_{suffix}", feature)
            for name, feature in (("prediction", prediction), ("probability", probability))
            for column, suffix in (("score", "ks"), ("p_value", "p_value"), ("status", "status"))
        ]
    )


def concept_drift(both: DataFrame, label: str, prediction: str, probability: str) -> DataFrame:
    """metric, baseline, evolved, change for the five metrics on two labelled, scored sides."""
    evaluated = evaluate(both, label, prediction, probability, [SIDE])
    named = evaluated.withColumn("dataset", F.when(F.col(SIDE) == 1, "baseline").otherwise("evolved"))
    return side_by_side(named, "dataset", "baseline", "evolved", ("baseline", "evolved"), "change")


def _listed(report: DataFrame, name: str, keep: Column) -> Column:
    """Names that satisfy ``keep``, in name order; reports have a row per feature or metric."""
    return F.array_join(F.array_sort(F.collect_list(F.when(keep, F.col(name)))), ", ")


def drift_summary(
    data: DataFrame, prediction: DataFrame, concept: DataFrame, tolerance: float = 0.0
) -> DataFrame:
    """Four rows (category, metric, value, status, details) over the three reports."""
    drifted = F.col("status") == "DRIFT"
    features = data.agg(
        F.lit("Data Drift").alias("category"),
        F.lit("Features with drift").alias("metric"),
        F.count_if(drifted).cast("double").alias("value"),
        F.when(F.count_if(F.col("status") == NO_DATA) > 0, NO_DATA).when(F.count_if(drifted) > 0, "DRIFT").otherwise("OK").alias("status"),
        _listed(data, "feature", drifted).alias("details"),
    )
    two = F.array(
        *[
            F.struct(
                F.lit(title).alias("metric"),
                F.col(f"{n}_distribution_ks").alias("value"),
                F.col(f"{n}_distribution_status").alias("status"),
            )
            for n, title in (("prediction", "Prediction distribution"), ("probability", "Probability distribution"))
        ]
    )
    predictions = prediction.select(F.explode(two).alias("r")).select(
        F.lit("Prediction Drift").alias("category"), "r.*", F.lit("KS statistic").alias("details")
    )
    worse = F.col("change") < -tolerance
    metrics = concept.agg(
        F.lit("Concept Drift").alias("category"),
        F.lit("Degraded performance metrics").alias("metric"),
        F.count_if(worse).cast("double").alias("value"),
        F.when(F.count_if(worse) > 0, "DRIFT").otherwise("OK").alias("status"),
        _listed(concept, "metric", worse).alias("details"),
    )
    return features.unionByName(predictions).unionByName(metrics)


def overall_status(summary: DataFrame) -> DataFrame:
    """One row: did anything drift?"""
    found = F.coalesce(F.bool_or(F.col("status") == "DRIFT"), F.lit(False))
    return summary.agg(found.alias("drift_detected")).withColumn(
        "overall_status", F.when(F.col("drift_detected"), "DRIFT").otherwise("OK")
    )
