"""Hard negatives: for an anchor and one of its positives, the best rows of other labels a little below the positive.

The windows of an anchor's positives overlap. Their upper limits cut the scores into disjoint slots, so a row's score
belongs to one slot only, whatever number of windows it lies in. Every task keeps the first k of each slot; merged, the
slots stand in falling order, and what a window returns is the beginning of its own slot and all slots below it.

Anchors are cut into blocks of bounded size. A block goes to all executors, which pass once over the rows for positives
and once for slots; scores are products of integer matrices.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelwatch.llm.common import stage_table
from modelwatch.session import scratch_path

#: Bytes of the anchors of a block, which every executor holds.
BLOCK_BYTES = 16 << 20
#: Stands for a missing id, which comes last among equal scores.
NO_ID = (1 << 63) - 1
NEVER = -(1 << 63)


class Best:
    """The first k of every key: higher scores first, then smaller ids."""

    def __init__(self, keys: int, k: int):
        self.k = k
        self.floor = np.full(keys, NEVER, np.int64)  # a score below it has no chance any more
        self.key = self.score = self.id = np.zeros(0, np.int64)

    def add(self, key: np.ndarray, score: np.ndarray, id: np.ndarray) -> None:
        likely = score >= self.floor[key]
        key, score, id = (np.concatenate([a, b[likely]]) for a, b in ((self.key, key), (self.score, score), (self.id, id)))
        order = np.lexsort((id, -score, key))
        key = key[order]
        first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]]) if len(key) else np.zeros(0, np.int64)
        rank = np.arange(len(key)) - np.repeat(first, np.diff(np.r_[first, len(key)]))
        self.key, self.score, self.id = key[rank < self.k], score[order][rank < self.k], id[order][rank < self.k]
        last = rank == self.k - 1
        self.floor[key[last]] = score[order][last]


def _by_length(vectors: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, matrix) of the vectors of each length; entries so large that products might overflow are bounded."""
    lengths = vectors.value_lengths().to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        flat = vectors.take(pa.array(at)).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        most = isqrt(((1 << 63) - 1) // max(1, int(d)))
        yield at, np.clip(flat, -most, most).reshape(len(at), d)


def _scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products: in doubles, which are faster, where none can round."""
    if a.shape[1] * int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) < 1 << 53:
        return (a.astype(float) @ b.T.astype(float)).astype(np.int64)
    return a @ b.T


def _pairs(asked: pa.Table, batches: Iterator[pa.RecordBatch], rows: int = 4096, anchors: int = 256):
    """(anchors, rows' labels, rows' ids, scores) of all blocks of anchors and rows of equal length."""
    wanted = {m.shape[1]: (at, m) for at, m in _by_length(asked["vector"].combine_chunks())}
    for batch in batches:
        label, id = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        for at, m in _by_length(batch.column(2)):
            own, vectors = wanted.get(m.shape[1], (None, None))
            for start in range(0, len(at) if own is not None else 0, rows):
                part = at[start : start + rows]
                for begin in range(0, len(own), anchors):
                    cut = slice(begin, begin + anchors)
                    yield own[cut], label[part], id[part], _scores(vectors[cut], m[start : start + rows])


def _found(best: Best, numbers: np.ndarray, slots: int) -> Iterator[pa.RecordBatch]:
    columns = {"anchor": numbers[best.key // slots], "slot": best.key % slots, "score": best.score, "id": best.id}
    yield pa.RecordBatch.from_pydict({name: pa.array(column.astype(np.int64)) for name, column in columns.items()})


FOUND = "anchor bigint, slot bigint, score bigint, id bigint"


def _same_label(rows: DataFrame, asked: pa.Table, k: int) -> DataFrame:
    """Of each task, the first k rows of an anchor's label, the anchor itself among them."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, labels = asked["number"].to_numpy(), asked["label"].to_numpy()
        best = Best(len(numbers), k)
        for own, label, id, score in _pairs(asked, batches):
            for one in np.unique(labels[own]):
                i, j = np.flatnonzero(labels[own] == one), np.flatnonzero(label == one)
                if not len(j):
                    continue
                part = score[np.ix_(i, j)]
                floor = best.floor[own[i]]
                if len(j) > k:
                    floor = np.maximum(floor, np.partition(part, len(j) - k, axis=1)[:, len(j) - k])
                x, y = np.nonzero(part >= floor[:, None])
                best.add(own[i][x], part[x, y], id[j][y])
        yield from _found(best, numbers, 1)

    return rows.mapInArrow(task, FOUND)


def _slots(rows: DataFrame, asked: pa.Table, k: int, window: tuple[int, int, int]) -> DataFrame:
    """Of each task, the first k rows of other labels in every slot of an anchor."""
    low, high, of = window

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers, labels = asked["number"].to_numpy(), asked["label"].to_numpy()
        positives = asked["positives"].to_pylist()
        slots = max(map(len, positives))
        upper, lower = np.full((len(numbers), slots), NEVER, np.int64), np.full((len(numbers), slots), NO_ID, np.int64)
        for i, scores in enumerate(positives):
            for j, score in enumerate(scores):  # falling; Python's integers cannot overflow
                upper[i, j] = max(NEVER, min(NO_ID, high * score // of))
                lower[i, j] = max(NEVER, min(NO_ID, -(-low * score // of)))
        best = Best(upper.size, k)
        for own, label, id, score in _pairs(asked, batches):
            x, y = np.nonzero((score <= upper[own, 0][:, None]) & (score >= lower[own].min(axis=1)[:, None]))
            found = score[x, y]
            other = labels[own[x]] != label[y]
            x, y, found = x[other], y[other], found[other]
            slot = (upper[own[x]] >= found[:, None]).sum(axis=1) - 1
            inside = found >= lower[own[x], slot]  # windows of higher positives begin higher
            best.add((own[x] * slots + slot)[inside], found[inside], id[y][inside])
        yield from _found(best, numbers, slots)

    return rows.mapInArrow(task, FOUND)


def _in_blocks(asked: DataFrame, blocks: int, passed: Callable[[pa.Table], DataFrame], label: str) -> DataFrame:
    """``passed(anchors of a block)`` for one block after another, each written before the next is sent out."""
    spark, path = asked.sparkSession, scratch_path(asked.sparkSession, label)
    for b in range(blocks):
        passed(asked.where(F.col("block") == b).drop("block").toArrow()).write.parquet(f"{path}/block={b}")
    return spark.read.schema(FOUND).parquet(path)


def _first(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k)


def mine(
    rows: DataFrame,
    anchor: str | Column,
    *,
    vec_id: str = "vec_id",
    label: str = "label",
    vector: str = "vector",
    positives: int = 5,
    negatives: int = 5,
    window: tuple[int, int, int] = (80, 100, 100),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) of the rows for which ``anchor`` holds.

    ``vector`` is an array of integers, ``label`` an integer; scores are inner products. Higher scores come first, then
    smaller ids. An anchor's positives are its first other rows of the same label; for each, the first rows of other
    labels with low * positive <= of * negative <= high * positive, where (low, high, of) is ``window`` and low <= high.

    Rows whose label or vector is null, or whose vector holds a null, take no part; a null id takes part, comes last
    among equal scores and comes back as null (as does 2^63-1). ``anchor`` null is no. Vectors of different lengths do
    not meet. Rows that repeat are rows of their own: an anchor that comes twice is asked twice, and its copy is a
    positive. Entries whose product could leave 64 bits (beyond 3.8e8 in 64 dimensions) are bounded there. An empty
    table gives an empty result. Columns of other names are not looked at.
    """
    if not 0 <= window[0] <= window[1] or window[2] <= 0:
        raise ValueError("window wants 0 <= low <= high and of > 0")
    holds = F.expr(anchor) if isinstance(anchor, str) else anchor
    live = rows.select(
        rows[label].cast("bigint").alias("label"),
        F.coalesce(rows[vec_id].cast("bigint"), F.lit(NO_ID)).alias("id"),
        rows[vector].cast("array<bigint>").alias("vector"),
        F.coalesce(holds, F.lit(False)).alias("asks"),
    ).where(F.col("label").isNotNull() & F.coalesce(~F.exists("vector", lambda x: x.isNull()), F.lit(False)))
    asks, live = live.where("asks").drop("asks"), live.drop("asks")
    size = asks.agg(F.count("*").alias("n"), F.sum(8 * F.size("vector") + 64).alias("bytes")).first()
    blocks = max(1, -(-(size["bytes"] or 0) // block_bytes))
    # Dealt out in turn, so that no id, label or vector can fill a block.
    asked = stage_table(
        asks.repartition(blocks).withColumns({"number": F.monotonically_increasing_id(), "block": F.spark_partition_id()}), "mining-anchors"
    )
    found = _first(_in_blocks(asked, blocks, lambda a: _same_label(live, a, positives + 1), "mining-positives"), positives + 1)

    # The anchor itself goes: one row with its id and score, if it is among them.
    own = F.aggregate("vector", F.lit(0).cast("bigint"), lambda s, x: F.try_add(s, F.try_multiply(x, x)))
    anchors = asked.select(F.col("number").alias("anchor"), F.col("id").alias("anchor_id"), own.alias("own"))
    same = (F.col("id") == F.col("anchor_id")) & F.coalesce(F.col("score") == F.col("own"), F.lit(True))
    ranked = found.join(anchors, "anchor").withColumn("itself", F.min(F.when(same, F.col("place"))).over(Window.partitionBy("anchor")))
    ranked = ranked.where(F.col("itself").isNull() | (F.col("place") != F.col("itself")))
    near = ranked.withColumn("place", F.row_number().over(Window.partitionBy("anchor").orderBy("place"))).where(F.col("place") <= positives)
    listed = near.groupBy("anchor").agg(F.sort_array(F.collect_list(F.struct("place", "score", "id"))).alias("positives"))
    asked = asked.join(listed, F.col("number") == F.col("anchor")).drop("anchor")
    asked = stage_table(asked, "mining-asked")
    slots = _in_blocks(
        asked.select("number", "block", "id", "label", "vector", F.col("positives.score").alias("positives")),
        blocks,
        lambda a: _slots(live, a, negatives, window) if a.num_rows else live.sparkSession.createDataFrame([], FOUND),
        "mining-slots",
    )

    # Slots in falling order; what a positive gets begins with its own.
    row = F.struct("slot", (-F.col("score")).alias("less"), F.col("id").alias("negative_id"))
    slots = _first(slots, negatives).groupBy("anchor").agg(F.sort_array(F.collect_list(row)).alias("slots"))
    answers = asked.join(slots, F.col("number") == F.col("anchor")).select(
        F.col("id").alias("anchor_id"), "slots", F.posexplode("positives").alias("slot", "positive")
    )
    suffix = F.slice(F.filter("slots", lambda s: s["slot"] >= F.col("slot")), 1, negatives)
    wide = F.col("positive.score").cast("decimal(38,0)") * window[0]
    inside = F.filter(suffix, lambda s: -s["less"].cast("decimal(38,0)") * window[2] >= wide)
    answers = answers.select("anchor_id", "positive", F.posexplode(inside).alias("rank", "negative"))
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c))
    return answers.select(
        known("anchor_id").alias("anchor_id"),
        known("positive.id").alias("positive_id"),
        (F.col("rank") + 1).cast("int").alias("rank"),
        known("negative.negative_id").alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        (-F.col("negative.less")).alias("negative_score"),
    )
