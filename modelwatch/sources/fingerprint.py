"""Content fingerprints of a batch."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def _open(path: str) -> pa.NativeFile:
    """The file as it is, not unpacked; schemes are those of Arrow's file systems (file, hdfs, s3, gs, ...)."""
    local = re.match(r"^(?:file:)?/*(/.*)$", path) if path.startswith(("file:", "/")) else None
    if local:
        return fs.LocalFileSystem().open_input_stream(local[1], compression=None, buffer_size=0)
    system, inner = fs.FileSystem.from_uri(path)
    return system.open_input_stream(inner, compression=None, buffer_size=0)


def _stream_digests(read_bytes: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """SHA-256 of files that are never in memory as a whole."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, lengths = [], []
            for path in batch.column(0).to_pylist():
                digest, length = hashlib.sha256(), 0
                with _open(path) as file:
                    while part := file.read(read_bytes):
                        digest.update(part)
                        length += len(part)
                digests.append(digest.hexdigest())
                lengths.append(length)
            columns = [batch.column(0), pa.array(lengths, pa.int64()), pa.array(digests, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=["path", "length", "sha256"])

    return task


def file_fingerprints(spark: SparkSession, path: str, whole_bytes: int = 64 << 20, read_bytes: int = 1 << 20) -> DataFrame:
    """(path, length, sha256) of every file under the path, computed where the file is read.

    Files of up to ``whole_bytes`` are values of Spark's file reader, from any store that it knows. Larger ones, of any
    size, are read in parts of ``read_bytes`` by a task that holds one part; only their names and lengths come from the reader.
    Spark's listing leaves empty files out, and so does this.
    """
    files = spark.read.format("binaryFile").load(path)
    small = files.where(F.col("length") <= whole_bytes).select("path", "length", F.sha2("content", 256).alias("sha256"))
    large = files.where(F.col("length") > whole_bytes).select("path")
    return small.unionByName(large.mapInArrow(_stream_digests(read_bytes), "path string, length bigint, sha256 string"))


def row_text(cols: Sequence[str]) -> Column:
    """Canonical text of a row: JSON with NULL fields kept and times to the microsecond."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false", "timestampFormat": MICROS + "XXX", "timestampNTZFormat": MICROS})


def row_digest(cols: Sequence[str]) -> Column:
    """SHA-256 of the canonical row text; NULL fields are part of it."""
    return F.sha2(row_text(cols), 256)


def digest_sums(digest: Column, prefix: str = "h") -> list[Column]:
    """Order-free aggregate of a hex digest: exact sums of its first four 32-bit words."""
    return [
        F.sum(F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("decimal(38,0)")).alias(f"{prefix}{i}")
        for i in range(4)
    ]


def table_fingerprint(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """One row: row count and a fingerprint that does not depend on row order or file layout."""
    return grouped_fingerprints(df, (), cols)


def grouped_fingerprints(df: DataFrame, by: Sequence[str], cols: Sequence[str] | None = None) -> DataFrame:
    """The same for every group: what its rows would give as a table of their own."""
    cols = list(cols or [c for c in df.columns if c not in by])
    sums = df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), *digest_sums(row_digest(cols)))
    words = [F.coalesce(F.col(f"h{i}"), F.lit(0)).cast("string") for i in range(4)]
    stamp = F.sha2(F.concat_ws(":", F.col("rows").cast("string"), *words), 256)
    return sums.select(*by, "rows", stamp.alias("fingerprint"))
