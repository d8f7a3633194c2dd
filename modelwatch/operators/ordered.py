"""Exact order statistics without a single-task sort.

A window with no partition key, or with a handful of keys, would pull the data
into a few tasks. Everything here first cuts the value range into blocks and
then works inside ``(group, block)``; offsets between blocks come from one tiny
aggregate. Results are exact wherever the cuts fall: cuts only decide how the
work is spread. The first cuts are the same for all groups and bounded in number;
a block that is looked into and still holds too many rows is cut again, by
quantiles of its own that stay a table, until none does or only equal values are
left.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from modelwatch.operators.joins import null_safe_join
from modelwatch.session import stage_table

ROWS_PER_BLOCK = 1_000_000
MIN_BLOCKS = 256
#: Cuts of the first level, which become an expression, and of one block at the levels below.
FIRST_CUTS, MORE_CUTS = 4096, 64
#: A block becomes up to so many: a value that is a cut is a block of its own.
FAN = 2 * MORE_CUTS + 2
LEVELS = 6  # block numbers stay within 64 bits
BROADCAST_GROUPS = 20_000

Cuts = dict[str, list[float]]


def block_cuts(
    df: DataFrame,
    cols: Sequence[str],
    rows_per_block: int = ROWS_PER_BLOCK,
    max_blocks: int = FIRST_CUTS,
) -> Cuts:
    """Approximate quantile boundaries per column; empty lists while the data is small.

    A row count decides; past one block, a column-pruned aggregate gives at most
    ``len(cols) * max_blocks`` numbers to the driver.
    """
    rows = df.count()
    if rows <= rows_per_block:
        return {c: [] for c in cols}
    blocks = min(max(math.ceil(rows / rows_per_block), MIN_BLOCKS), max_blocks)
    probs = [i / blocks for i in range(1, blocks)]
    row = df.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), probs, 4 * blocks).alias(f"q{i}")
            for i, c in enumerate(cols)
        ]
    ).first()
    return {c: sorted(set(row[f"q{i}"] or [])) for i, c in enumerate(cols)}


def with_block(df: DataFrame, value: str, cuts: Sequence[float], out: str = "_block") -> DataFrame:
    """Add the number of the block a value falls in (binary search over the cuts)."""
    inner = [c for c in cuts if math.isfinite(c)]
    if not inner:
        return df
    edges = [-math.inf, *inner, math.inf]
    return Bucketizer(splits=edges, inputCol=value, outputCol=out, handleInvalid="keep").transform(df).withColumn(
        out, F.col(out).cast("int")
    )


def attach(df: DataFrame, small: DataFrame, by: Sequence[str]) -> DataFrame:
    """Add the columns of a bounded table: by group, or its single row when there is no group."""
    if by:
        return null_safe_join(df, F.broadcast(small), list(by))
    row = small.agg(F.struct(*[F.max(c).alias(c) for c in small.columns])).scalar()
    return df.select("*", *[row.getField(c).alias(c) for c in small.columns])


def block_offsets(per_block: DataFrame, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Add, per block, the sums ``_off_<v>`` of the blocks before it and the group totals ``total_<v>``."""
    before = W.partitionBy(*by).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    return per_block.select(
        "*",
        *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_off_{v}") for v in values],
        *[F.sum(v).over(W.partitionBy(*by)).alias(f"total_{v}") for v in values],
    )


def running_totals(df: DataFrame, order: str, values: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Inclusive running sums ``cum_<v>`` and group totals ``total_<v>``.

    ``df`` holds one row per ``(by, order)``. With a ``_block`` column (see
    ``with_block``) a running sum is the sum inside the block plus the totals of
    the blocks before it; without one the data is known to be small.
    """
    by = list(by)
    up_to_here = W.unboundedPreceding, W.currentRow
    if "_block" not in df.columns:
        run = W.partitionBy(*by).orderBy(order).rowsBetween(*up_to_here)
        totals = df.groupBy(*by).agg(*[F.sum(v).alias(f"total_{v}") for v in values])
        summed = df.select("*", *[F.sum(v).over(run).alias(f"cum_{v}") for v in values])
        return attach(summed, totals, by)
    keys = by + ["_block"]
    offsets = block_offsets(df.groupBy(*keys).agg(*[F.sum(v).alias(v) for v in values]), values, by).drop(*values)
    inside = W.partitionBy(*keys).orderBy(order).rowsBetween(*up_to_here)
    summed = df.select("*", *[F.sum(v).over(inside).alias(f"_in_{v}") for v in values])
    if set(by) <= {"column"}:
        # One row per numeric column and block.
        offsets = F.broadcast(offsets)
    joined = null_safe_join(summed, offsets, keys)
    out = joined.select("*", *[(F.col(f"_in_{v}") + F.col(f"_off_{v}")).alias(f"cum_{v}") for v in values])
    return out.drop("_block", *[f"_in_{v}" for v in values], *[f"_off_{v}" for v in values])


def long_numeric(
    df: DataFrame, cols: Sequence[str], by: Sequence[str] = (), cuts: Cuts | None = None
) -> DataFrame:
    """One row per (group, column number, value); NULL and NaN left out, -0.0 folded into 0.0.

    ``column`` is the position in ``cols`` (a short grouping key); ``with_names``
    turns it back. With cuts a value also carries its ``_block``, found while the
    columns are still side by side.
    """
    wide = df.select(*by, *[(F.col(c).cast("double") + F.lit(0.0)).alias(f"_v{i}") for i, c in enumerate(cols)])
    blocks = bool(cuts) and any(cuts.values())
    entries = []
    for i, c in enumerate(cols):
        fields = [F.lit(i).alias("column"), F.col(f"_v{i}").alias("value")]
        if blocks:
            wide = with_block(wide, f"_v{i}", cuts[c], f"_b{i}")
            known = f"_b{i}" in wide.columns
            fields.append((F.col(f"_b{i}") if known else F.lit(0)).alias("_block"))
        entries.append(F.struct(*fields).alias(f"_e{i}"))
    tall = wide.select(*by, *entries).unpivot(list(by), [f"_e{i}" for i in range(len(cols))], "_n", "_e")
    flat = tall.select(*by, "_e.*")
    return flat.where(F.col("value").isNotNull() & ~F.isnan("value"))


def with_names(df: DataFrame, cols: Sequence[str], out: str = "column") -> DataFrame:
    """Column numbers back to names."""
    name = F.element_at(F.array(*[F.lit(c) for c in cols]), F.col("column") + 1)
    return df.select(*[name.alias(out) if c == "column" else F.col(c) for c in df.columns])


def _located_small(tall: DataFrame, group: list[str]) -> DataFrame:
    """Per distinct value its first rank, its rows, and the group size."""
    counted = tall.groupBy(*group, "value").agg(F.count(F.lit(1)).alias("_rows"))
    run = running_totals(counted, "value", ["_rows"], group)
    return run.select(*group, "value", "_rows", (F.col("cum__rows") - F.col("_rows")).alias("_first"), F.col("total__rows").alias("n"))


def few_groups(df: DataFrame, by: Sequence[str]) -> bool:
    """Is a table with a few rows per group small enough to broadcast? Measured, not assumed."""
    if not by:
        return True
    return df.agg(F.approx_count_distinct(F.struct(*by))).first()[0] <= BROADCAST_GROUPS


def block_sizes(rows: DataFrame, keys: Sequence[str], *counts: Column) -> DataFrame:
    """Rows per block, its smallest and its largest value."""
    return rows.groupBy(*keys).agg(
        *(counts or [F.count(F.lit(1)).alias("_in_block")]), F.min("value").alias("_lo"), F.max("value").alias("_hi")
    )


def crowded_blocks(blocks: DataFrame, size: Column, rows_per_block: int) -> DataFrame:
    """Blocks that hold more rows than they should and more than one value."""
    return blocks.where((size > rows_per_block) & (F.col("_lo") < F.col("_hi")))


def split_blocks(rows: DataFrame, crowded: DataFrame, keys: Sequence[str], small: bool) -> DataFrame:
    """``rows`` with ``_block`` numbered anew, in the same order: crowded blocks are cut at quantiles of their own.

    A hot value is a cut and so a block of its own; every other part is smaller than the whole.
    """
    keys = list(keys)
    probs = [i / (MORE_CUTS + 1) for i in range(1, MORE_CUTS + 1)]
    keyed = crowded.select(*keys)
    inside = null_safe_join(rows, F.broadcast(keyed) if small else keyed, keys, "left_semi")
    cuts = inside.groupBy(*keys).agg(F.array_distinct(F.percentile_approx("value", probs, 16 * MORE_CUTS)).alias("_cuts"))
    joined = null_safe_join(rows, F.broadcast(cuts) if small else cuts, keys, "left")
    below = F.size(F.filter("_cuts", lambda c: c < F.col("value")))
    part = F.when(F.col("_cuts").isNull(), F.lit(0)).otherwise(2 * below + F.array_contains("_cuts", F.col("value")).cast("int"))
    return joined.withColumn("_block", F.col("_block").cast("bigint") * FAN + part).drop("_cuts")


def inside_parents(sizes: DataFrame, parents: DataFrame, group: Sequence[str], values: Sequence[str], offsets: Sequence[str]) -> DataFrame:
    """Adds, to the blocks that ``split_blocks`` made, their parent's columns; ``offsets`` count what is before a block."""
    up = [*group, "_up"]
    before = W.partitionBy(*up).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
    placed = sizes.withColumn("_up", F.floor(F.col("_block") / FAN))
    placed = placed.select("*", *[F.coalesce(F.sum(v).over(before), F.lit(0)).alias(f"_in_{v}") for v in values])
    joined = null_safe_join(placed, parents.withColumnRenamed("_block", "_up"), up)
    moved = {o: F.col(o) + F.col(f"_in_{v}") for v, o in zip(values, offsets, strict=True)}
    return joined.withColumns(moved).drop("_up", *[f"_in_{v}" for v in values])


def _located_in_blocks(
    tall: DataFrame, group: list[str], probs: Sequence[float], small: bool, rows_per_block: int
) -> DataFrame:
    """The same, but only for values in blocks that hold a wanted rank; those are cut again while they are crowded."""
    keys = group + ["_block"]
    rows, wanted = tall, None
    for level in range(LEVELS):
        sizes = block_sizes(rows, keys)
        if wanted is None:
            before = W.partitionBy(*group).orderBy("_block").rowsBetween(W.unboundedPreceding, -1)
            placed = sizes.select(
                "*",
                F.coalesce(F.sum("_in_block").over(before), F.lit(0)).alias("_start"),
                F.sum("_in_block").over(W.partitionBy(*group)).alias("n"),
            )
        else:
            placed = inside_parents(sizes, wanted.select(*keys, "_start", "n"), group, ["_in_block"], ["_start"])
        ranks = [f(F.lit(float(p)) * (F.col("n") - 1)) for p in probs for f in (F.floor, F.ceil)]
        holds = [(r >= F.col("_start")) & (r < F.col("_start") + F.col("_in_block")) for r in ranks]
        wanted = stage_table(placed.where(reduce(lambda a, b: a | b, holds)), "wanted-blocks")
        hit = null_safe_join(rows, F.broadcast(wanted.select(*keys)) if small else wanted.select(*keys), keys, "left_semi")
        crowded = crowded_blocks(wanted, F.col("_in_block"), rows_per_block)
        if level + 1 == LEVELS or crowded.isEmpty():
            break
        rows = split_blocks(stage_table(hit, "wanted-rows"), crowded, keys, small)
    counted = hit.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_rows"))
    inside = W.partitionBy(*keys).orderBy("value").rowsBetween(W.unboundedPreceding, W.currentRow)
    ordered = counted.withColumn("_end", F.sum("_rows").over(inside))
    starts = wanted.select(*keys, "_start", "n")
    return null_safe_join(ordered, F.broadcast(starts) if small else starts, keys).select(
        *group, "value", "_rows", (F.col("_start") + F.col("_end") - F.col("_rows")).alias("_first"), "n"
    )


def exact_quantiles(
    df: DataFrame,
    cols: Sequence[str],
    probs: Sequence[float],
    by: Sequence[str] = (),
    cuts: Cuts | None = None,
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """Linear-interpolated quantiles ``q0, q1, ...`` (order of ``probs``) per group and column.

    Distributed selection: count rows per block, keep only the blocks that hold a
    wanted rank, and order those. No group is ever held whole by one task.
    """
    by = list(by)
    if cuts is None:
        cuts = block_cuts(df, cols, rows_per_block)
    group = by + ["column"]
    tall = long_numeric(df, cols, by, cuts)
    if any(cuts.values()):
        located = _located_in_blocks(tall, group, probs, few_groups(df, by), rows_per_block)
    else:
        located = _located_small(tall, group)
    spots = [F.lit(float(p)) * (F.col("n") - 1) for p in probs]

    def value_at(rank: Column, name: str) -> Column:
        covers = (F.col("_first") <= rank) & (rank < F.col("_first") + F.col("_rows"))
        return F.max(F.when(covers, F.col("value"))).alias(name)

    parts = [value_at(f(s), f"{n}{i}") for i, s in enumerate(spots) for f, n in ((F.floor, "_lo"), (F.ceil, "_hi"))]
    picked = located.groupBy(*group, "n").agg(*parts)
    between = [
        (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * (spot % 1)).alias(f"q{i}")
        for i, spot in enumerate(spots)
    ]
    return with_names(picked.select(*group, "n", *between), cols)


def with_position(df: DataFrame, order: Sequence[str | Column], position: str = "position") -> DataFrame:
    """Zero-based position of every row in the given order, plus ``total_rows``.

    A range shuffle sorts the rows; the sorted rows are written once so that
    their numbering cannot change between uses; part sizes (at most one row per
    shuffle partition) give the offsets.
    """
    numbered = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_mono", F.monotonically_increasing_id())
    )
    staged = stage_table(numbered, "position").withColumn("_part", F.shiftright("_mono", 33))
    sizes = staged.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
    ordered = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    offsets = sizes.select(
        "_part",
        F.coalesce(F.sum("_rows").over(ordered), F.lit(0)).alias("_off"),
        F.sum("_rows").over(W.partitionBy()).alias("total_rows"),
    )
    within = F.col("_mono").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        staged.join(F.broadcast(offsets), "_part")
        .withColumn(position, F.col("_off") + within)
        .drop("_mono", "_part", "_off")
    )


def equal_windows(df: DataFrame, order: Sequence[str | Column], k: int, out: str = "window") -> DataFrame:
    """Number ordered rows 1..k in nearly equal runs; the first ``n mod k`` get one more."""
    size, extra = F.floor(F.col("total_rows") / k), F.col("total_rows") % k
    big = extra * (size + 1)
    number = F.when(F.col("position") < big, F.floor(F.col("position") / (size + 1))).otherwise(
        extra + F.floor((F.col("position") - big) / F.greatest(size, F.lit(1)))
    )
    return (
        with_position(df, order)
        .withColumn(out, (number + 1).cast("int"))
        .drop("position", "total_rows")
    )
