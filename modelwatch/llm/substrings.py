"""Exact removal of repeated word sequences, with anchors at the positions of a difference cover."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from modelwatch.llm import chunks
from modelwatch.llm.chunks import Chunk, Keys, is_copy
from modelwatch.llm.hashing import SPACE, Rolling, byte_symbols, words

#: Perfect difference sets by their period; every residue is a difference of two members.
COVERS = {
    3: (0, 1),
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    21: (0, 1, 4, 14, 16),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}
#: Bytes whose words are hashed at a time.
PIECE = 1 << 20


def cover_for(window: int) -> tuple[int, tuple[int, ...]]:
    """The largest period that leaves an anchor of about a third of the window or more."""
    fit = [p for p in COVERS if 3 * (window - p + 1) >= window]
    return (max(fit), COVERS[max(fit)]) if fit else (1, (0,))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """64-bit hash of each word, some words at a time."""
    table, out, at = byte_symbols(salt), np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        stop = max(at + 1, int(np.searchsorted(ends, starts[at] + PIECE, "right")))
        lo = starts[at]
        out[at:stop] = Rolling(table[data[lo : ends[stop - 1]]], salt).slices(starts[at:stop] - lo, ends[at:stop] - lo)
        at = stop
    return out


class Words:
    """The words of a chunk, and where windows of ``window`` words and anchors can start."""

    def __init__(self, chunk: Chunk, window: int):
        self.starts, self.ends, self.document = words(chunk.data, chunk.offsets, ~SPACE)
        n = len(self.starts)
        self.count = np.bincount(self.document, minlength=len(chunk.doc_ids))
        room = np.cumsum(self.count)[self.document] - np.arange(n) if n else np.zeros(0, np.int64)
        self.hashes = word_hashes(chunk.data, self.starts, self.ends, 0)
        self.rolling = Rolling(self.hashes)
        self.room, self.window = room, window
        self.period, self.cover = cover_for(window)
        self.anchor = window - self.period + 1

    def anchors(self, skip: np.ndarray) -> np.ndarray:
        """Starts of anchors: cover positions modulo the period, in documents that are not skipped.

        Equal windows at s and t have some k below the period with s + k and t + k both at cover positions, so the two
        share the anchor there.
        """
        at = np.arange(len(self.starts))
        ok = np.isin(at % self.period, self.cover) & (self.room >= self.anchor) & ~skip[self.document]
        return np.flatnonzero(ok)

    def anchor_keys(self, at: np.ndarray) -> np.ndarray:
        return self.rolling.slices(at, at + self.anchor)

    def windows(self, repeated: np.ndarray, skip: np.ndarray) -> np.ndarray:
        """Starts of windows that hold a repeated anchor; ``repeated`` has the starts of those."""
        n = len(self.starts)
        marks = np.zeros(n + self.period + 1, np.int64)
        marks[repeated + 1] = 1
        sums = np.cumsum(marks)
        s = np.arange(n)
        return np.flatnonzero((sums[s + self.period] > sums[s]) & (self.room >= self.window) & ~skip[self.document])

    def window_keys(self, chunk: Chunk, at: np.ndarray) -> np.ndarray:
        """128-bit hashes of whole windows."""
        second = Rolling(word_hashes(chunk.data, self.starts, self.ends, 1), 1)
        return np.stack([self.rolling.slices(at, at + self.window), second.slices(at, at + self.window)], axis=1)


def covered(starts: np.ndarray, length: int, n: int) -> np.ndarray:
    """Which of n positions lie in a window."""
    marks = np.zeros(n + 1, np.int64)
    np.add.at(marks, starts, 1)
    np.add.at(marks, np.minimum(starts + length, n), -1)
    return np.cumsum(marks[:n]) > 0


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 20) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept (the words left, joined by one space), kept_sha256.

    Words are runs of bytes other than ASCII white space. A word goes if it is covered by ``window`` consecutive words
    of one document that also start earlier: in a smaller doc_id, or earlier in the same one. Windows are judged on the
    input. Documents of the same text as an earlier one are known by a digest; of the others, anchors at the cover
    positions are compared across all chunks, and whole windows only where an anchor repeats.

    Null, empty and short texts lose nothing. Rows without doc_id count as after all others; rows of one doc_id are
    ordered by a hash of their text, and each is a document. An empty table gives no rows.
    """
    packed = chunks.pack(docs, doc_id, text, "substrings")
    copy_buckets = chunks.bucket_count(packed, 1 / 2000)
    known = chunks.copies(packed, copy_buckets, "substrings-copies")
    period, cover = cover_for(window)
    anchor_buckets = chunks.bucket_count(packed, len(cover) / period / 6)
    window_buckets = chunks.bucket_count(packed, 0.3 / 6)

    def send_anchors(chunk: Chunk, answers: dict) -> Iterator[pa.RecordBatch]:
        w = Words(chunk, window)
        at = w.anchors(is_copy(chunk, answers, copy_buckets))
        yield Keys(w.anchor_keys(at), anchor_buckets).batch(chunk.number)

    anchors = chunks.ask(chunks.each(packed, known, send_anchors, chunks.KEYS), "anchor", 1, False, "substrings-anchors")
    known = known.unionByName(anchors)

    def candidates(chunk: Chunk, answers: dict) -> tuple[Words, np.ndarray, np.ndarray, Keys]:
        w, skip = Words(chunk, window), is_copy(chunk, answers, copy_buckets)
        at = w.anchors(skip)
        keys = Keys(w.anchor_keys(at), anchor_buckets)
        repeated = at[keys.answered(answers.get("anchor", {})) | (keys.count[keys.of] > 1)]
        starts = w.windows(repeated, skip)
        return w, skip, starts, Keys(w.window_keys(chunk, starts), window_buckets)

    def send_windows(chunk: Chunk, answers: dict) -> Iterator[pa.RecordBatch]:
        yield candidates(chunk, answers)[3].batch(chunk.number)

    windows = chunks.ask(chunks.each(packed, known, send_windows, chunks.KEYS), "window", 2, True, "substrings-windows")
    known = known.unionByName(windows)

    def cut(chunk: Chunk, answers: dict) -> Iterator[pa.RecordBatch]:
        w, skip, starts, keys = candidates(chunk, answers)
        later = keys.answered(answers.get("window", {})) | (keys.first[keys.of] != np.arange(len(starts)))
        gone = covered(starts[later], window, len(w.starts))
        gone |= (skip & (w.count >= window))[w.document]
        removed = np.bincount(w.document, gone, minlength=len(chunk.doc_ids)).astype(np.int64)
        data, ends, kept = chunk.data.tobytes(), np.r_[0, np.cumsum(w.count)], []
        for d in range(len(chunk.doc_ids)):
            left = np.flatnonzero(~gone[ends[d] : ends[d + 1]]) + ends[d]
            kept.append(b" ".join([data[a:b] for a, b in zip(w.starts[left].tolist(), w.ends[left].tolist())]))
        yield pa.record_batch(
            [
                pa.array(chunk.doc_ids, pa.int64()),
                pa.array(w.count, pa.int64()),
                pa.array(removed),
                pa.array(kept, pa.binary()).cast(pa.string()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
            ],
            ["doc_id", "n_words", "n_removed", "kept", "kept_sha256"],
        )

    return chunks.each(packed, known, cut, "doc_id bigint, n_words bigint, n_removed bigint, kept string, kept_sha256 string")
