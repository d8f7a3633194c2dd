"""Exact metrics of a binary classifier over a scored table.

A scored table has a label (0/1), a prediction (0/1) and a probability. Every
function takes ``by`` columns and so evaluates many models, datasets or windows
in one pass. Counts are aggregated per distinct score before anything is
ordered.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelwatch.operators.joins import null_safe_join
from modelwatch.operators.ordered import Cuts, block_cuts, running_totals, with_block

METRICS = ("accuracy", "precision", "recall", "f1", "roc_auc")


def ratio(a: Column | str, b: Column | str) -> Column:
    """Zero where the denominator is zero."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def ratios(tp: Column, fp: Column, fn: Column, tn: Column) -> dict[str, Column]:
    """Each from its counts alone: f1 = 2tp / (2tp + fp + fn)."""
    return {
        "accuracy": ratio(tp + tn, tp + tn + fp + fn),
        "precision": ratio(tp, tp + fp),
        "recall": ratio(tp, tp + fn),
        "f1": ratio(2 * tp, 2 * tp + fp + fn),
    }


def _with_ratios(df: DataFrame) -> DataFrame:
    counts = [F.col(c) for c in ("tp", "fp", "fn", "tn")]
    return df.select("*", *[v.alias(k) for k, v in ratios(*counts).items()])


def confusion(scored: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    y, p = F.col(label), F.col(prediction)
    return scored.groupBy(*by).agg(
        F.count_if((y == 0) & (p == 0)).alias("tn"),
        F.count_if((y == 0) & (p == 1)).alias("fp"),
        F.count_if((y == 1) & (p == 0)).alias("fn"),
        F.count_if((y == 1) & (p == 1)).alias("tp"),
    )


def classification_metrics(scored: DataFrame, label: str, prediction: str, by: Sequence[str] = ()) -> DataFrame:
    """Confusion counts, accuracy, precision, recall and f1."""
    return _with_ratios(confusion(scored, label, prediction, by))


def score_totals(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = (), cuts: Cuts | None = None
) -> DataFrame:
    """Per distinct score: pos, neg, their running sums from the lowest score, and totals."""
    if cuts is None:
        cuts = block_cuts(scored, [score])
    rows = scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    slim = rows.select(*by, label, (F.col(score).cast("double") + F.lit(0.0)).alias("score"))
    slim = with_block(slim, "score", next(iter(cuts.values())))
    per_score = (
        slim.groupBy(*[c for c in slim.columns if c != label])
        .agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) == 0).alias("neg"),
        )
    )
    return running_totals(per_score, "score", ["pos", "neg"], by)


def roc_auc(scored: DataFrame, label: str, score: str, by: Sequence[str] = (), cuts: Cuts | None = None) -> DataFrame:
    """Probability that a positive outranks a negative, ties counted half; NULL with one class only."""
    totals = score_totals(scored, label, score, by, cuts)
    wins = F.col("pos").cast("decimal(38,1)") * (2 * (F.col("cum_neg") - F.col("neg")) + F.col("neg"))
    return totals.groupBy(*by).agg(
        F.try_divide(
            F.sum(wins).cast("double"), 2.0 * F.max("total_pos").cast("double") * F.max("total_neg")
        ).alias("roc_auc")
    )


def average_precision(
    scored: DataFrame, label: str, score: str, by: Sequence[str] = (), cuts: Cuts | None = None
) -> DataFrame:
    """Sum over descending scores of (recall step) * precision."""
    totals = score_totals(scored, label, score, by, cuts)
    tp = F.col("total_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("total_neg") - F.col("cum_neg") + F.col("neg")
    return totals.groupBy(*by).agg(
        F.sum(F.try_divide("pos", "total_pos") * F.try_divide(tp, tp + fp)).alias("average_precision")
    )


def roc_points(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """fpr and tpr when every score >= threshold counts as positive; one point per distinct score."""
    totals = score_totals(scored, label, score, by)
    tp = F.col("total_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("total_neg") - F.col("cum_neg") + F.col("neg")
    return totals.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(fp, "total_neg").alias("fpr"),
        F.try_divide(tp, "total_pos").alias("tpr"),
    )


def pr_points(scored: DataFrame, label: str, score: str, by: Sequence[str] = ()) -> DataFrame:
    """precision and recall per distinct threshold."""
    totals = score_totals(scored, label, score, by)
    tp = F.col("total_pos") - F.col("cum_pos") + F.col("pos")
    fp = F.col("total_neg") - F.col("cum_neg") + F.col("neg")
    return totals.select(
        *by,
        F.col("score").alias("threshold"),
        F.try_divide(tp, tp + fp).alias("precision"),
        F.try_divide(tp, "total_pos").alias("recall"),
    )


def evaluate(
    scored: DataFrame,
    label: str,
    prediction: str,
    probability: str,
    by: Sequence[str] = (),
    cuts: Cuts | None = None,
) -> DataFrame:
    """All five metrics plus the confusion counts and the number of samples.

    One pass over the scored rows: counts per (group, score, label, prediction)
    feed both the confusion counts and the ranking.
    """
    by = list(by)
    if cuts is None:
        cuts = block_cuts(scored, [probability])
    y, p = F.col(label), F.col(prediction)
    slim = scored.select(*by, label, prediction, (F.col(probability).cast("double") + F.lit(0.0)).alias("score"))
    slim = with_block(slim, "score", next(iter(cuts.values())))
    per_score = (
        slim.groupBy(*[c for c in slim.columns if c not in (label, prediction)])
        .agg(
            F.count(F.lit(1)).alias("samples"),
            F.count_if((y == 0) & (p == 0)).alias("tn"),
            F.count_if((y == 0) & (p == 1)).alias("fp"),
            F.count_if((y == 1) & (p == 0)).alias("fn"),
            F.count_if((y == 1) & (p == 1)).alias("tp"),
            F.count_if((y == 1) & F.col("score").isNotNull()).alias("pos"),
            F.count_if((y == 0) & F.col("score").isNotNull()).alias("neg"),
        )
    )
    # Rows without score are counted as samples, but have no place in the ranking.
    totals = running_totals(per_score, "score", ["neg"], by)
    wins = F.col("pos").cast("decimal(38,1)") * (2 * (F.col("cum_neg") - F.col("neg")) + F.col("neg"))
    out = totals.groupBy(*by).agg(
        *[F.sum(c).cast("bigint").alias(c) for c in ("samples", "tn", "fp", "fn", "tp")],
        F.try_divide(
            F.sum(wins).cast("double"),
            2.0 * F.sum("pos").cast("double") * F.sum("neg"),
        ).alias("roc_auc"),
    )
    return _with_ratios(out).select(*by, "samples", "tn", "fp", "fn", "tp", *METRICS)


def long_metrics(wide: DataFrame, by: Sequence[str] = (), metrics: Sequence[str] = METRICS) -> DataFrame:
    """(by, metric, value)."""
    slim = wide.select(*by, *[F.col(m).cast("double").alias(m) for m in metrics])
    return slim.unpivot(list(by), list(metrics), "metric", "value")


def class_report(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """Precision, recall, f1 and support per class, then macro and weighted averages."""
    c = confusion(scored, label, prediction)
    sides = F.array(
        F.struct(
            F.lit("0").alias("class"),
            F.col("tn").alias("tp"),
            F.col("fn").alias("fp"),
            F.col("fp").alias("fn"),
            F.col("tp").alias("tn"),
        ),
        F.struct(
            F.lit("1").alias("class"),
            F.col("tp").alias("tp"),
            F.col("fp").alias("fp"),
            F.col("fn").alias("fn"),
            F.col("tn").alias("tn"),
        ),
    )
    rows = c.select(F.explode(sides).alias("s")).select("s.*")
    per_class = _with_ratios(rows).select(
        "class", "precision", "recall", "f1", (F.col("tp") + F.col("fn")).alias("support")
    )
    three = ("precision", "recall", "f1")
    macro = per_class.agg(
        F.lit("macro avg").alias("class"),
        *[F.avg(m).alias(m) for m in three],
        F.sum("support").cast("bigint").alias("support"),
    )
    weighted = per_class.agg(
        F.lit("weighted avg").alias("class"),
        *[ratio(F.sum(F.col(m) * F.col("support")), F.sum("support")).alias(m) for m in three],
        F.sum("support").cast("bigint").alias("support"),
    )
    return per_class.unionByName(macro).unionByName(weighted)


def misclassified(scored: DataFrame, label: str, prediction: str) -> DataFrame:
    """False negatives and false positives with all their columns."""
    y, p = F.col(label), F.col(prediction)
    return scored.where(((y == 1) & (p == 0)) | ((y == 0) & (p == 1))).withColumn(
        "error", F.when(y == 1, "false_negative").otherwise("false_positive")
    )


SWEEP_PERCENT = tuple(range(10, 90, 5))


def threshold_sweep(
    scored: DataFrame,
    label: str,
    probability: str,
    percents: Sequence[int] = SWEEP_PERCENT,
    by: Sequence[str] = (),
) -> DataFrame:
    """Confusion counts and f1, recall, precision at each threshold (given in percent).

    A row only needs to know how many thresholds it reaches; counts per that
    number are summed up per threshold afterwards, on a handful of rows.
    """
    marks = sorted(percents)
    reached = F.lit(0)
    for m in marks:
        reached = reached + (F.col(probability) >= F.lit(m / 100.0)).cast("int")
    per_level = (
        scored.where(F.col(probability).isNotNull())
        .groupBy(*by, reached.alias("_level"))
        .agg(F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg"))
    )
    spread = per_level.select(
        *by, "_level", "pos", "neg", F.posexplode(F.array(*[F.lit(m) for m in marks])).alias("_i", "percent")
    )
    hit = F.col("_level") > F.col("_i")

    def total(side: str, when: Column, name: str) -> Column:
        return F.sum(F.when(when, F.col(side)).otherwise(0)).cast("bigint").alias(name)

    counts = spread.groupBy(*by, "percent").agg(
        total("pos", hit, "tp"), total("neg", hit, "fp"), total("pos", ~hit, "fn"), total("neg", ~hit, "tn")
    )
    return _with_ratios(counts).withColumn("threshold", F.col("percent") / F.lit(100.0)).drop("percent", "accuracy")


def two_thresholds(scored: DataFrame, label: str, probability: str, default: int = 50, chosen: int = 45) -> DataFrame:
    """f1, recall and precision side by side at two thresholds (percent)."""
    swept = threshold_sweep(scored, label, probability, [default, chosen])
    tall = long_metrics(swept, ["threshold"], ("f1", "recall", "precision"))
    return tall.groupBy("metric").agg(
        F.max(F.when(F.col("threshold") == default / 100.0, F.col("value"))).alias("default_threshold"),
        F.max(F.when(F.col("threshold") == chosen / 100.0, F.col("value"))).alias("chosen_threshold"),
    )


def generalisation_gap(scored: DataFrame, label: str, prediction: str, model: str, split: str) -> DataFrame:
    """Train f1, test f1 and their difference per model."""
    m = classification_metrics(scored, label, prediction, [model, split])
    sides = m.groupBy(model).agg(
        F.max(F.when(F.col(split) == "train", F.col("f1"))).alias("train_f1"),
        F.max(F.when(F.col(split) == "test", F.col("f1"))).alias("test_f1"),
    )
    return sides.withColumn("gap", F.col("train_f1") - F.col("test_f1"))


def metric_changes(a: DataFrame, b: DataFrame, names: tuple[str, str], change: str = "change") -> DataFrame:
    """Align two (metric, value) tables and subtract."""
    left = a.select("metric", F.col("value").alias(names[0]))
    right = b.select("metric", F.col("value").alias(names[1]))
    return null_safe_join(left, right, ["metric"]).withColumn(change, F.col(names[1]) - F.col(names[0]))


def side_by_side(evaluated: DataFrame, tag: str, first: str, second: str, names: tuple[str, str], change: str) -> DataFrame:
    """The same from one table evaluated ``by=[tag]``: no join at all."""
    tall = long_metrics(evaluated, [tag])
    wide = tall.groupBy("metric").agg(
        F.max(F.when(F.col(tag) == first, F.col("value"))).alias(names[0]),
        F.max(F.when(F.col(tag) == second, F.col("value"))).alias(names[1]),
    )
    return wide.withColumn(change, F.col(names[1]) - F.col(names[0]))


def compare_models(scored: DataFrame, label: str, prediction: str, probability: str, model: str, v1: str, v2: str) -> DataFrame:
    evaluated = evaluate(scored, label, prediction, probability, [model])
    return side_by_side(evaluated, model, v1, v2, ("model_v1", "model_v2"), "change_v2_minus_v1")


def comparison_gate(comparison: DataFrame, minimum: float = 0.70, metric: str = "recall") -> DataFrame:
    """One row: does each model pass the gate, and is the second strictly better?"""
    row = comparison.where(F.col("metric") == metric)
    return row.select(
        "metric",
        F.lit(minimum).alias("threshold"),
        (F.col("model_v1") >= minimum).alias("v1_passed"),
        (F.col("model_v2") >= minimum).alias("v2_passed"),
        (F.col("model_v2") > F.col("model_v1")).alias("v2_improved_over_v1"),
    )


def stack(frames: dict[str, DataFrame], tag: str) -> DataFrame:
    """Union of frames, each marked with its name."""
    return reduce(DataFrame.unionByName, [df.select(F.lit(n).alias(tag), "*") for n, df in frames.items()])


def trend_change(per_window: DataFrame, window: str, metric: str) -> DataFrame:
    """One row: the metric in the first and last window, the change, and a verdict."""
    ends = per_window.agg(F.min_by(metric, window).alias("first"), F.max_by(metric, window).alias("last"))
    change = F.col("last") - F.col("first")
    return ends.select(
        "first",
        "last",
        change.alias("change"),
        F.when(change < 0, "decreased").when(change > 0, "increased").otherwise("unchanged").alias("verdict"),
    )
