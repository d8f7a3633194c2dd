"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.session import stage_table

__all__ = ["carried", "pick", "read", "splitmix", "stage_table", "star_components", "text_bytes", "uncarried", "utf8_slices"]


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def pick(df: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names; other columns, whatever they are called, stay out."""
    return df.select(*[df[source].alias(name) for name, source in columns.items()])


def carried(df: DataFrame, text: str) -> DataFrame:
    """(text, rest): the text column, and all others as one struct, so that their names meet none of the operator's."""
    others = [df[c] for c in df.columns if c != text]
    return df.select(df[text].alias("text"), F.struct(*(others or [F.lit(0).alias("none")])).alias("rest"))


def uncarried(df: DataFrame, columns: list[str], text: str) -> DataFrame:
    """The columns that ``carried`` packed, in their order."""
    return df.select(*[F.col("text").alias(c) if c == text else F.col("rest").getField(c).alias(c) for c in columns])


def splitmix(x: np.ndarray) -> np.ndarray:
    """A mixing of 64-bit numbers (the finaliser of the splitmix generator)."""
    with np.errstate(over="ignore"):
        x = x ^ (x >> np.uint64(30))
        x *= np.uint64(0xBF58476D1CE4E5B9)
        x ^= x >> np.uint64(27)
        x *= np.uint64(0x94D049BB133111EB)
        x ^= x >> np.uint64(31)
        return x


def give_back() -> None:
    """Returns freed memory to the system: workers live on between tasks, and what one stage needed would stay theirs."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the C library of GNU
        pass


def utf8_slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``max_bytes`` of text at most; one longer text is a batch of its own."""
    give_back()
    for batch in batches:
        if not batch.num_rows:
            continue
        size = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, start = np.cumsum(size), 0
        while start < batch.num_rows:
            done = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, done + max_bytes, "right")))
            yield batch.slice(start, stop - start)
            start = stop
        del batch
    give_back()


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts behind one another, and n+1 offsets; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    if column.offset:
        column = pa.concat_arrays([column])
    if column.offset:
        column = column.take(pa.array(np.arange(len(column))))
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[ends[0] : ends[-1]], ends - ends[0]


def star_components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of ``edges(u, v)``: rows (node, root), root the smallest node reachable; lone nodes are absent.

    Alternating large-star and small-star rounds; each round joins and groups on nodes, so a hub is pre-aggregated and
    its join is split like any skewed join. Every round is written to the shared folder.
    """
    # Both ways, without loops: later rounds keep u > v.
    now = stage_table(
        edges.where(F.col("u") != F.col("v")).select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
        f"{label}-edges",
    )
    mark = _checksum(now)
    while mark[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        small = small.unionByName(least.select("u", F.col("m").alias("v"))).distinct()
        now = stage_table(small, f"{label}-round")
        before, mark = mark, _checksum(now)
        if before == mark:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _checksum(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
    return row[0], row[1] or 0
