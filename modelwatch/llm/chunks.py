"""A corpus in chunks of consecutive documents, and questions that chunks ask about one another's keys.

Chunks hold whole documents in ascending doc_id order, a few MB each, and are written once, bucketed by chunk number. A
chunk sends its distinct keys to buckets, where those of all chunks meet; the bucket answers with one bit for each key.
So a key that a third of all documents hold counts once for each chunk, and nothing of a chunk's text moves again.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.llm.common import give_back, pick, stage_table, text_bytes, utf8_slices
from modelwatch.session import scratch_path

#: Keys of a bucket, about.
BUCKET = 1 << 19


class Chunk(NamedTuple):
    """Documents of a chunk in order: ids (None for a null id), texts behind one another with offsets, 16-byte digests."""

    number: int
    doc_ids: list
    data: np.ndarray
    offsets: np.ndarray
    digests: np.ndarray
    rest: pa.Array | None


def pack(docs: DataFrame, doc_id: str, text: str, label: str, size: int = 4 << 20, rest: list[str] | None = None) -> DataFrame:
    """The table of chunks of about ``size`` bytes of text; a longer document is a chunk of its own.

    Rows without doc_id come last; rows of one doc_id are ordered by a hash of their text. ``rest`` names columns that
    travel along as one struct.
    """
    rows = pick(docs, doc_id=doc_id, text=text).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    if rest:
        rows = docs.select(docs[doc_id].cast("bigint").alias("doc_id"), docs[text].alias("text"), F.struct(*[docs[c] for c in rest]).alias("rest"))
    target, along = size, bool(rest)
    order = [F.asc_nulls_last("doc_id"), F.xxhash64("text")]
    spread = rows.repartitionByRange(order[0]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, count, held, size = TaskContext.get().partitionId(), 0, [], 0

        def out() -> pa.RecordBatch:
            ids = pa.concat_arrays([b.column("doc_id") for b in held])
            texts = pa.concat_arrays([b.column("text").cast(pa.large_binary()) for b in held])
            data, offsets = text_bytes(texts)
            whole = data.tobytes()
            digests = b"".join(xxhash.xxh128_digest(whole[a:b]) for a, b in zip(offsets, offsets[1:]))
            row = [[part << 32 | count], [ids.to_pylist()], [offsets.tobytes()], [whole], [digests], [len(whole)]]
            cells = [pa.array(c, t) for c, t in zip(row, (pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary(), pa.int64()))]
            if along:
                others = pa.concat_arrays([b.column("rest") for b in held])
                cells.append(pa.ListArray.from_arrays(pa.array([0, len(others)], pa.int32()), others))
            return pa.record_batch(cells, names)

        names = ["chunk", "doc_ids", "offsets", "data", "digests", "n_bytes", *(["rest"] if along else [])]
        for piece in utf8_slices(batches, "text", 1 << 20):
            held.append(piece)
            size += piece.column("text").nbytes
            if size >= target:
                yield out()
                count, held, size = count + 1, [], 0
        if held:
            yield out()

    schema = T.StructType.fromDDL("chunk bigint, doc_ids array<bigint>, offsets binary, data binary, digests binary, n_bytes bigint")
    if along:
        schema = schema.add("rest", T.ArrayType(rows.schema["rest"].dataType))
    packed = spread.mapInArrow(run, schema)
    spark, name = docs.sparkSession, f"chunks_{label}_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    packed.write.format("parquet").option("path", scratch_path(spark, name)).bucketBy(buckets, "chunk").saveAsTable(name)
    return spark.table(name)


def bucket_count(packed: DataFrame, keys_per_byte: float) -> int:
    """Buckets that hold about ``BUCKET`` keys each, for so many keys from each byte of text."""
    total = packed.agg(F.sum("n_bytes")).first()[0] or 0
    return max(12, int(total * keys_per_byte / BUCKET) + 1)


def each(packed: DataFrame, replies: DataFrame | None, fn: Callable[[Chunk, dict], Iterator[pa.RecordBatch]], schema: str | T.StructType, rest: bool = False) -> DataFrame:
    """``fn(chunk, answers)`` for every chunk; answers[kind] has the answer of each bucket."""
    rows, told = packed, replies is not None
    if told:
        grouped = replies.groupBy("chunk").agg(F.collect_list(F.struct("kind", "bucket", "bits")).alias("answers"))
        rows = packed.join(grouped, "chunk", "left")
    columns = ["chunk", "doc_ids", "offsets", "data", "digests", *(["answers"] if told else []), *(["rest"] if rest else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        give_back()
        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in columns}
                answers: dict[str, dict[int, bytes]] = {}
                for x in (row["answers"].as_py() or []) if told else []:
                    answers.setdefault(x["kind"], {})[x["bucket"]] = x["bits"]
                chunk = Chunk(
                    row["chunk"].as_py(),
                    row["doc_ids"].as_py(),
                    np.frombuffer(row["data"].as_buffer(), np.uint8),
                    np.frombuffer(row["offsets"].as_buffer(), np.int64),
                    np.frombuffer(row["digests"].as_buffer(), np.uint64).reshape(-1, 2),
                    row["rest"].values if rest else None,
                )
                yield from fn(chunk, answers)

    return rows.select(*columns).mapInArrow(run, schema)


class Keys:
    """The distinct keys of a chunk (rows of one or two 64-bit numbers), sorted by bucket and key.

    ``of`` maps each key that was given to its distinct one, ``first`` each distinct one to where it first stands.
    """

    def __init__(self, keys: np.ndarray, buckets: int):
        keys = keys if keys.ndim == 2 else keys[:, None]
        order = np.lexsort(keys.T)
        ordered = keys[order]
        new = np.ones(len(keys), bool)
        new[1:] = (ordered[1:] != ordered[:-1]).any(axis=1)
        group = np.cumsum(new) - 1
        self.of = np.empty(len(keys), np.int64)
        self.of[order] = group
        self.keys = ordered[new]
        self.first = np.minimum.reduceat(order, np.flatnonzero(new)) if len(keys) else order
        self.count = np.bincount(group, minlength=len(self.keys))
        where = ((self.keys[:, 0] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        self.by_bucket = np.argsort(where, kind="stable")
        self.cuts = np.searchsorted(where[self.by_bucket], np.arange(buckets + 1))
        self.buckets = buckets

    def batch(self, chunk: int) -> pa.RecordBatch:
        """(bucket, chunk, keys): one row for each bucket that gets keys."""
        used = np.flatnonzero(np.diff(self.cuts))
        blobs = [self.keys[self.by_bucket[self.cuts[b] : self.cuts[b + 1]]].tobytes() for b in used]
        return pa.record_batch([pa.array(used, pa.int32()), pa.array(np.full(len(used), chunk)), pa.array(blobs, pa.binary())], ["bucket", "chunk", "keys"])

    def answered(self, bits: dict[int, bytes]) -> np.ndarray:
        """The answer to each key that was given."""
        own = np.zeros(len(self.keys), bool)
        for b, got in bits.items():
            at = self.by_bucket[self.cuts[b] : self.cuts[b + 1]]
            own[at] = np.unpackbits(np.frombuffer(got, np.uint8), count=len(at)).astype(bool)
        return own[self.of]


KEYS = "bucket int, chunk bigint, keys binary"


def ask(keys: DataFrame, kind: str, width: int, earlier: bool, label: str, hot: int | None = None) -> DataFrame:
    """(chunk, kind, bucket, bits): for each key sent, whether an earlier chunk (or any other) has it too.

    With ``hot``, answers of the kind ``...-hot`` say which keys more than ``hot`` chunks have.
    """

    def run(table: pa.Table) -> pa.Table:
        chunk = table.column("chunk").to_numpy()
        order = np.argsort(chunk, kind="stable")
        blobs = table.column("keys")
        parts = [np.frombuffer(blobs[int(i)].as_buffer(), np.uint64).reshape(-1, width) for i in order]
        size = np.array([len(p) for p in parts])
        every = np.concatenate(parts)
        by_key = np.lexsort(every.T)  # stable: the chunks of a key stay in order
        ordered = every[by_key]
        same = np.zeros(len(every), bool)
        same[1:] = (ordered[1:] == ordered[:-1]).all(axis=1)
        found = same.copy()
        if not earlier:
            found[:-1] |= same[1:]
        cuts = np.r_[0, np.cumsum(size)]
        bucket = table.column("bucket")[0].as_py()

        def told(found: np.ndarray, kind: str) -> pa.Table:
            answer = np.empty(len(every), bool)
            answer[by_key] = found
            bits = [np.packbits(answer[a:b]).tobytes() for a, b in zip(cuts, cuts[1:])]
            n = len(bits)
            return pa.table([pa.array(chunk[order]), pa.array([kind] * n), pa.array([bucket] * n, pa.int32()), pa.array(bits, pa.binary())], ["chunk", "kind", "bucket", "bits"])

        answers = [told(found, kind)]
        if hot is not None:
            group = np.cumsum(~same) - 1
            often = np.bincount(group)[group] > hot
            if often.any():
                answers.append(told(often, f"{kind}-hot"))
        return pa.concat_tables(answers)

    answers = keys.groupBy("bucket").applyInArrow(run, "chunk bigint, kind string, bucket int, bits binary")
    return stage_table(answers, label)


def copies(packed: DataFrame, buckets: int, label: str) -> DataFrame:
    """Answers of kind ``copy``: whether an earlier chunk has a document of the same text (by a 128-bit digest)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, digests in zip(batch.column("chunk").to_pylist(), batch.column("digests").to_pylist()):
                yield Keys(np.frombuffer(digests, np.uint64).reshape(-1, 2), buckets).batch(number)

    return ask(packed.select("chunk", "digests").mapInArrow(run, KEYS), "copy", 2, True, label)


def is_copy(chunk: Chunk, answers: dict, buckets: int) -> np.ndarray:
    """For each document whether an earlier one has the same text."""
    keys = Keys(chunk.digests, buckets)
    out = keys.answered(answers.get("copy", {}))
    out |= keys.first[keys.of] != np.arange(len(out))
    return out
