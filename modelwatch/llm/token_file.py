"""Token ids of a corpus in files: one concatenated id array with Elias-Fano encoded document boundaries."""

from __future__ import annotations

import json
import re
import string
import struct
import sys
import types
import zlib
from array import array
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwatch.llm.common import pick, stage_table, utf8_slices

#: Ids of a shard, about: the documents of some slices of text.
SHARD = 1 << 22
#: Set bits between two entries of the select directory.
STEP = 256
#: Words whose ids a worker keeps, about.
KEPT = 500_000
#: Normalisers and splits (by letters, single digits and other signs) of a kind of tokenizer file.
LETTERS_APART = [
    ["NFC", None, None, None, None, None],
    ["Replace", {"Regex": "\\s+"}, None, None, None, None],
    ["Lowercase", None, None, None, None, None],
    ["Split", {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "Removed", True, None, None],
    ["ByteLevel", None, None, None, False, False],
]
#: Letters up to U+017F, less the one whose small form is two characters, and ASCII punctuation but the apostrophe.
LETTERS = "".join(chr(c) for c in range(0x180) if chr(c).isalpha() and chr(c) != "İ")
SIGNS = string.punctuation.replace("'", "")
MAGIC = b"EFID"


# The file: magic, n documents, n ids, width of an id, low bits, then length-prefixed sections
# (doc ids as signed 64-bit numbers with a null map, low bits, high bits, select directory, ids).


def elias_fano(ends: np.ndarray, universe: int) -> tuple[int, bytes, bytes, bytes]:
    """(low bits, low part, high part, directory) of non-decreasing ``ends``, each at most ``universe``."""
    n = len(ends)
    low = max(0, (universe // n).bit_length() - 1) if n else 0
    ends = ends.astype(np.uint64)
    bits = (ends[:, None] >> np.arange(low, dtype=np.uint64)) & np.uint64(1)
    high = np.zeros((n + (universe >> low) + 8) // 8 * 8, np.uint8)
    ones = (ends >> np.uint64(low)).astype(np.int64) + np.arange(n)
    high[ones] = 1
    return low, np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes(), np.packbits(high, bitorder="little").tobytes(), ones[::STEP].astype("<u4").tobytes()


class Boundaries:
    """Document ends read from their Elias-Fano form; ``select`` finds one without unpacking the others."""

    def __init__(self, n: int, low: int, lows: bytes, highs: bytes, directory: bytes):
        self.n, self.low = n, low
        self.lows, self.highs = np.frombuffer(lows, np.uint8), np.frombuffer(highs, np.uint8)
        self.directory = np.frombuffer(directory, "<u4")

    def _low(self, i: np.ndarray) -> np.ndarray:
        at = np.asarray(i, np.int64)[:, None] * self.low + np.arange(self.low)
        return (((self.lows[at >> 3] >> (at & 7)) & 1).astype(np.int64) << np.arange(self.low)).sum(axis=1)

    def select(self, i: int) -> int:
        """The end of document ``i``: the directory gives a set bit at most STEP - 1 before; bytes are counted from there."""
        at = int(self.directory[i // STEP])
        left = i % STEP
        byte = at >> 3
        first = int(self.highs[byte]) >> (at & 7) << (at & 7)
        while (ones := first.bit_count()) <= left:
            left -= ones
            byte += 1
            first = int(self.highs[byte])
        for _ in range(left):
            first &= first - 1
        place = byte * 8 + (first & -first).bit_length() - 1
        return (place - i << self.low) + int(self._low(np.array([i]))[0])

    def all(self) -> np.ndarray:
        ones = np.flatnonzero(np.unpackbits(self.highs, bitorder="little"))[: self.n]
        return (ones - np.arange(self.n) << self.low) + self._low(np.arange(self.n))


def write_shard(doc_ids: list, lengths: Sequence[int], ids: np.ndarray) -> bytes:
    """The bytes of one file."""
    ends = np.cumsum(np.array(lengths, np.int64))
    n, wide = len(doc_ids), 2 if not len(ids) or int(ids.max()) < 1 << 16 else 4
    low, lows, highs, directory = elias_fano(ends, len(ids))
    names = struct.pack(f"<{n}q", *(0 if d is None else d for d in doc_ids))
    nulls = bytes(d is None for d in doc_ids) if None in doc_ids else b""
    out = [MAGIC, struct.pack("<QQBB", n, len(ids), wide, low)]
    for section in (names, nulls, lows, highs, directory, ids.astype(f"<u{wide}").tobytes()):
        out += [struct.pack("<Q", len(section)), section]
    return b"".join(out)


class Shard:
    """A file's documents: ``document(i)`` gives the ids of one of them."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a token file")
        self.n, self.total, wide, low = struct.unpack_from("<QQBB", data, 4)
        sections, at = [], 22
        for _ in range(6):
            (size,) = struct.unpack_from("<Q", data, at)
            sections.append(memoryview(data)[at + 8 : at + 8 + size])
            at += 8 + size
        names, nulls, lows, highs, directory, ids = sections
        missing = bytes(nulls) or bytes(self.n)
        self.doc_ids = [None if gone else name for (name,), gone in zip(struct.iter_unpack("<q", names), missing)]
        self.boundaries = Boundaries(self.n, low, lows, highs, directory)
        self.ids = np.frombuffer(ids, f"<u{wide}")

    def document(self, i: int) -> np.ndarray:
        return self.ids[self.boundaries.select(i - 1) if i else 0 : self.boundaries.select(i)]


class Encoder:
    """Ids of texts. The library's ids of whole texts, for any tokenizer file.

    In files of the kind ``LETTERS_APART`` nothing crosses ASCII white space, so the distinct words of a batch are
    encoded and their ids put in place by their offsets. Ids of words stay in memory, about ``KEPT`` of them; beyond
    that the memory starts anew. With any other file whole texts go to the library.
    """

    def __init__(self, path: str):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        added = [t["content"] for t in spec["added_tokens"]]
        self.apart = _shape(spec) == LETTERS_APART and not any(re.search(r"\s", t) for t in added)
        # A plain word, letters and then signs, holds no added token if none is letters and then signs.
        self.plain = self.apart and all(t.lstrip(LETTERS).strip(SIGNS) for t in added)
        self.spelled = {c: ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(chr(c))[0][0] for c in range(0x80, 0x180) if chr(c).strip()}
        self._forget()

    def _forget(self) -> None:
        """Row k of the memory is flat[at[k] : at[k + 1]]; row 0 is the empty word."""
        self.row, self.flat, self.at = {"": 0}, array("I"), array("q", [0, 0])

    def _model(self, parts: list[str]) -> Iterator[list[int]]:
        """Ids of words of small letters, or of punctuation: the model's, as no other step changes or cuts them."""
        tokenize, spelled = self.tokenizer.model.tokenize, self.spelled
        for part in parts:
            yield [t.id for t in tokenize(part if part.isascii() else part.translate(spelled))]

    def _library(self, texts: list[str]) -> Iterator[list[int]]:
        for at in range(0, len(texts), 4096):
            for got in self.tokenizer.encode_batch_fast(texts[at : at + 4096], add_special_tokens=False):
                yield got.ids

    def _rows(self, names: list[str], ids_of: Callable[[list[str]], Iterator[list[int]]]) -> np.ndarray:
        row, flat, at = self.row, self.flat, self.at
        missing = [n for n in names if n not in row]
        for name, ids in zip(missing, ids_of(missing)):
            row[name] = len(at) - 1
            flat.extend(ids)
            at.append(len(flat))
        return np.fromiter(map(row.__getitem__, names), np.int64, len(names))

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids behind one another, how many each) of distinct words."""
        if len(self.row) > KEPT:
            self._forget()
        rows = np.zeros((len(words), 2), np.int64)
        # Plain words are letters, which the normalisers only make small, and closing punctuation, where the split is.
        core, tail = pc.utf8_rtrim(words, characters=SIGNS), pc.utf8_ltrim(words, characters=LETTERS)
        size, core_size, tail_size = (pc.binary_length(x).to_numpy() for x in (words, core, tail))
        plain = (core_size + tail_size == size) & self.plain
        if plain.any():
            for k, part in enumerate((pc.utf8_lower(core), tail)):
                part = part.filter(pa.array(plain)).dictionary_encode()
                rows[plain, k] = self._rows(part.dictionary.to_numpy(zero_copy_only=False).tolist(), self._model)[part.indices.to_numpy()]
        rows[~plain, 0] = self._rows(words.filter(pa.array(~plain)).to_numpy(zero_copy_only=False).tolist(), self._library)
        at = np.frombuffer(self.at, np.int64)
        size = at[rows + 1] - at[rows]
        return _gather(np.frombuffer(self.flat, np.uint32), at[rows].ravel(), size.ravel()), size.sum(axis=1)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts behind one another, how many each); a null is an empty text."""
        texts = pc.fill_null(texts, "")
        if not self.apart:
            ids = [np.array(i, np.uint32) for i in self._library(texts.to_pylist())]
            return np.concatenate(ids) if ids else np.zeros(0, np.uint32), np.array([len(i) for i in ids], np.int64)
        words = pc.ascii_split_whitespace(texts)
        every = words.flatten().dictionary_encode()
        flat, size = self._words(every.dictionary)
        start, which = np.cumsum(size) - size, every.indices.to_numpy()
        ids = _gather(flat, start[which], size[which])
        ends = np.r_[0, np.cumsum(size[which])][np.cumsum(pc.list_value_length(words).to_numpy())]
        return ids, np.diff(ends, prepend=0)


def _gather(flat: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs flat[start : start + size] behind one another."""
    at = np.repeat(start - (np.cumsum(size) - size), size)
    at += np.arange(len(at))
    return flat[at]


def _shape(spec: dict) -> list:
    """What a tokenizer's normalisers and splits are."""
    steps = (spec.get("normalizer") or {}).get("normalizers", []) + (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return [[s["type"], s.get("pattern"), s.get("behavior"), s.get("invert"), s.get("add_prefix_space"), s.get("use_regex")] for s in steps]


def encoder(path: str) -> Encoder:
    """One encoder for each worker process and file: its words are used again by later tasks."""
    kept = sys.modules.setdefault("_token_encoders", types.ModuleType("_token_encoders"))
    if not hasattr(kept, "by_path"):
        kept.by_path = {}
    if path not in kept.by_path:
        kept.by_path[path] = Encoder(path)
    return kept.by_path[path]


def write(docs: DataFrame, path: str, end_id: int, doc_id: str = "doc_id", text: str = "text", parts: int | None = None) -> DataFrame:
    """(part, before, n_ids, file): the corpus as files in ascending doc_id order, each a row of a written table.

    ``before`` is the number of ids in earlier files of the same part. ``path`` is a file of the tokenizers library, readable on every executor. Each document's ids are followed by
    ``end_id``. Rows without doc_id come first. Null texts are empty.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    rows = rows.withColumn("doc_id", F.col("doc_id").cast("bigint"))
    order = [F.asc_nulls_first("doc_id"), F.xxhash64("text")]
    spread = rows.repartitionByRange(*([parts] if parts else []), order[0]).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import os

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encode, names, lengths, ids, total, before = encoder(path).encode, [], [], [], 0, 0

        def flush() -> pa.RecordBatch:
            file = write_shard(names, np.concatenate(lengths), np.concatenate(ids))
            return pa.record_batch([pa.array([before], pa.int64()), pa.array([total], pa.int64()), pa.array([file], pa.binary())], ["before", "n_ids", "file"])

        for part in utf8_slices(batches, "text"):
            got, size = encode(part.column("text"))
            ends = np.cumsum(size + 1)
            whole = np.full(len(got) + len(size), end_id, np.uint32)
            inner = np.ones(len(whole), bool)
            inner[ends - 1] = False
            whole[inner] = got
            names += part.column("doc_id").to_pylist()
            lengths.append(size + 1)
            ids.append(whole)
            total += len(whole)
            if total >= SHARD:
                yield flush()
                names, lengths, ids, total, before = [], [], [], 0, before + total
        if names:
            yield flush()

    files = spread.mapInArrow(run, "before bigint, n_ids bigint, file binary").withColumn("part", F.spark_partition_id())
    return stage_table(files, "token-files")


def offsets(files: DataFrame) -> dict[int, int]:
    """Ids before the first document of each part; one number for each part that was written."""
    sums = {r.part: r.n for r in files.groupBy("part").agg(F.sum("n_ids").alias("n")).collect()}
    out, before = {}, 0
    for part in sorted(sums):
        out[part], before = before, before + sums[part]
    return out


def documents(files: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, read from the files."""
    first = files.sparkSession.sparkContext.broadcast(offsets(files))  # a number for each part

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, before, data in zip(*(batch.column(c) for c in ("part", "before", "file"))):
                shard = Shard(data.as_py())
                base = first.value[part.as_py()] + before.as_py()
                ends = shard.boundaries.all()
                starts = np.r_[0, ends[:-1]]
                ids = shard.ids.astype("<u4")
                crc = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts.tolist(), ends.tolist())]
                yield pa.record_batch([pa.array(shard.doc_ids, pa.int64()), pa.array(starts + base), pa.array(ends - starts), pa.array(crc, pa.int64())], ["doc_id", "start", "n_tokens", "ids_crc32"])

    return files.select("part", "before", "file").mapInArrow(run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
