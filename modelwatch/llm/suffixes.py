"""Exact removal of repeated byte strings: sorted, front-coded runs of suffixes merged by loser trees that know prefixes."""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.llm import chunks
from modelwatch.llm.chunks import Chunk, Keys, is_copy
from modelwatch.llm.common import stage_table
from modelwatch.llm.hashing import Rolling, byte_symbols

#: Bytes of text of a chunk, about.
CHUNK = 1 << 20
#: Suffix records of a merge, about; a start that more chunks than HOT share is dealt out by whole windows. Records
#: whose windows are compared at a time, about.
RECORDS, HOT, COMPARED = 25_000, 4096, 8_000


def gram_of(length: int) -> int:
    """Bytes of the strings that choose the anchors of windows of ``length`` bytes."""
    return max(1, length * 36 // 100)


class Windows:
    """Windows of a chunk, each with its anchor: where the smallest hash of its grams stands, the first of equal ones.

    Equal windows have their anchors at the same distance from the start. Windows that share an anchor follow one
    another and are one span of text, so that one suffix record stands for all of them.
    """

    def __init__(self, chunk: Chunk, length: int, skip: np.ndarray):
        self.length, self.gram = length, gram_of(length)
        n = len(chunk.data)
        size = np.diff(chunk.offsets)
        valid = np.zeros(n + 1, np.int8)
        long = (size >= length) & ~skip
        np.add.at(valid, chunk.offsets[:-1][long], 1)
        np.add.at(valid, chunk.offsets[1:][long] - length + 1, -1)
        self.starts = np.flatnonzero(np.cumsum(valid, dtype=np.int8)[:n])
        self.rolling = Rolling(byte_symbols()[chunk.data])
        if not len(self.starts):
            self.anchor = self.first = self.last = self.keys = self.starts
            self.keys = self.keys.astype(np.uint64)
            return
        least = self.rolling.every(self.gram)
        least &= np.uint64(0xFFFFFFFF00000000)
        least |= np.arange(len(least), dtype=np.uint64)
        need, have = length - self.gram + 1, 1
        while 2 * have <= need:
            least = np.minimum(least[: len(least) - have], least[have:])
            have *= 2
        least = np.minimum(least[: n - length + 1], least[need - have : need - have + n - length + 1])
        anchor = (least[self.starts] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        new = np.r_[True, anchor[1:] != anchor[:-1]]
        begins = np.flatnonzero(new)
        #: By span: its anchor, first and last window start, and the hash of the gram at the anchor.
        self.anchor, self.first = anchor[begins], self.starts[begins]
        self.last = self.starts[np.r_[begins[1:], len(new)] - 1]
        self.keys = self.rolling.slices(self.anchor, self.anchor + self.gram)


def shared_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, given that ``known`` bytes are."""
    n = min(len(a), len(b))
    x = int.from_bytes(a[known:n], "big") ^ int.from_bytes(b[known:n], "big")
    return n - (x.bit_length() + 7) // 8


def front_code(records: list[bytes]) -> bytes:
    """Sorted distinct records: for each the length it shares with the one before, and the rest."""
    lcp, before = [], b""
    for r in records:
        lcp.append(shared_prefix(before, r, 0))
        before = r
    rest = [len(r) - h for r, h in zip(records, lcp)]
    return struct.pack("<I", len(records)) + np.array([lcp, rest], "<u2").tobytes() + b"".join(r[h:] for r, h in zip(records, lcp))


def front_decode(blob: bytes) -> Iterator[tuple[bytes, int]]:
    """(record, length shared with the one before), one at a time."""
    (n,) = struct.unpack_from("<I", blob)
    lcp, rest = np.frombuffer(blob, "<u2", 2 * n, 4).reshape(2, n).tolist()
    at, record = 4 + 4 * n, b""
    for h, size in zip(lcp, rest):
        record = record[:h] + blob[at : at + size]
        at += size
        yield record, h


def merge_runs(runs: list[Iterator[tuple[bytes, int]]]) -> Iterator[tuple[bytes, int, int]]:
    """(record, run, length shared with the record before) in sorted order; of equal records the earlier run first.

    A loser tree whose nodes also hold how much the loser shares with the last record that came out. A longer share
    wins without a look at the text, and equal shares are compared from there on: no known prefix is read again.
    """
    width = 1
    while width < len(runs):
        width *= 2
    heads: list[bytes | None] = [None] * width
    shares = [0] * width
    for k, run in enumerate(runs):
        heads[k], shares[k] = next(run, (None, 0))
    tree = [0] * width

    def beats(a: int, b: int) -> bool:
        """Whether the head of a comes before that of b; sets what the loser shares with the winner."""
        x, y = heads[a], heads[b]
        if x is None or y is None:
            return y is None and (x is not None or a < b)
        p, q = shares[a], shares[b]
        if p != q:
            return p > q
        h = shared_prefix(x, y, p)
        first = (x[h:], a) < (y[h:], b)
        shares[b if first else a] = h
        return first

    winners = list(range(width))
    level = width
    while level > 1:
        level //= 2
        for k in range(level):
            a, b = winners[2 * k], winners[2 * k + 1]
            won = beats(a, b)
            tree[level + k] = b if won else a
            winners[k] = a if won else b
    top = winners[0]
    while heads[top] is not None:
        yield heads[top], top, shares[top]
        heads[top], shares[top] = next(runs[top], (None, 0)) if top < len(runs) else (None, 0)
        node = (top + width) // 2
        while node:
            other = tree[node]
            if beats(other, top):
                tree[node], top = top, other
            node //= 2


def _records(chunk: Chunk, w: Windows, spans: np.ndarray, hot: np.ndarray, buckets: int) -> dict[int, tuple[list[bytes], list[list[int]], list[list[int]]]]:
    """By bucket: sorted distinct records, and for each the first window starts and the numbers of windows it stands for.

    A record is the suffix from the anchor to the end of the span's last window, what stands before the anchor, and the
    length of the former. The windows of a hot span are records of their own, dealt out by their own hash.
    """
    data, found = chunk.data.tobytes(), {}

    def add(bucket: int, anchor: int, first: int, last: int) -> None:
        right = data[anchor : last + w.length]
        record = right + data[first:anchor] + struct.pack(">H", len(right))
        found.setdefault(bucket, {}).setdefault(record, []).append((first, last - first + 1))

    cold = spans[~hot]
    bucket = ((w.keys[cold] >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).tolist()
    for b, anchor, first, last in zip(bucket, w.anchor[cold].tolist(), w.first[cold].tolist(), w.last[cold].tolist()):
        add(b, anchor, first, last)
    for span in spans[hot]:
        at = np.arange(w.first[span], w.last[span] + 1)
        hashes = w.rolling.slices(at, at + w.length)
        for b, s in zip(((hashes >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).tolist(), at.tolist()):
            add(b, s, s, s)
    out = {}
    for b, own in found.items():
        records = sorted(own)
        out[b] = (records, [[s for s, _ in own[r]] for r in records], [own[r][0][1] for r in records])
    return out


def _window_firsts(records: list[bytes], earliest: list[int], length: int) -> list[np.ndarray]:
    """For each record, the earliest run that has each of its windows, over all the records together."""
    spans = []
    for r in records:
        (right,) = struct.unpack(">H", r[-2:])
        spans.append(r[right:-2] + r[:right])
    size = np.array([len(s) for s in spans])
    count = size - length + 1
    text = np.frombuffer(b"".join(spans), np.uint8)
    at = np.repeat(np.cumsum(size) - size, count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    keys = [Rolling(byte_symbols(salt)[text], salt).slices(at, at + length) for salt in (0, 1)]
    run = np.repeat(np.array(earliest), count)
    order = np.lexsort((run, keys[1], keys[0]))
    new = np.r_[True, (keys[0][order][1:] != keys[0][order][:-1]) | (keys[1][order][1:] != keys[1][order][:-1])]
    first = np.empty(len(order), np.int64)
    first[order] = run[order][np.flatnonzero(new)][np.cumsum(new) - 1]
    return np.split(first, np.cumsum(count)[:-1])


def _merged(table: pa.Table, length: int) -> pa.Table:
    """One bucket: the answer to each chunk's records is a state (0: no window is in an earlier chunk, 1: all are,
    2: some) and, for state 2, a bit for each window."""
    chunk = table.column("chunk").to_numpy()
    order = np.argsort(chunk, kind="stable")
    blobs = [table.column("keys")[int(i)].as_py() for i in order]
    kinds: list[bytes] = []  # distinct records
    earliest: list[int] = []
    group: list[int] = []
    of_run: list[list[int]] = [[] for _ in blobs]
    gram = gram_of(length)
    before, number = b"", -1
    for record, run, share in merge_runs([front_decode(b) for b in blobs]):
        if share != len(record) or len(before) != share:
            number += share < gram or not kinds
            kinds.append(record)
            earliest.append(run)
            group.append(number)
            before = record
        of_run[run].append(len(kinds) - 1)
    # A suffix whose gram has one context only needs no look into its windows.
    members = np.bincount(np.array(group, np.int64), minlength=number + 1)
    mixed = np.flatnonzero(members[group] > 1) if kinds else np.zeros(0, np.int64)
    firsts: dict[int, np.ndarray] = {}
    at = 0
    while at < len(mixed):  # whole groups at a time
        stop = min(at + COMPARED, len(mixed))
        while stop < len(mixed) and group[mixed[stop]] == group[mixed[stop - 1]]:
            stop += 1
        some = mixed[at:stop].tolist()
        firsts.update(zip(some, _window_firsts([kinds[i] for i in some], [earliest[i] for i in some], length)))
        at = stop
    out = []
    for run, own in enumerate(of_run):
        states, bits = bytearray(), []
        for k in own:
            if k in firsts:
                later = firsts[k] < run
                state = 1 if later.all() else 2 if later.any() else 0
                if state == 2:
                    bits.append(np.packbits(later).tobytes())
            else:
                state = int(earliest[k] < run)
            states.append(state)
        out.append(bytes(states) + b"".join(bits))
    n = len(out)
    bucket = table.column("bucket")[0].as_py()
    return pa.table([pa.array(chunk[order]), pa.array(["suffix"] * n), pa.array([bucket] * n, pa.int32()), pa.array(out, pa.binary())], ["chunk", "kind", "bucket", "bits"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100, rest: list[str] | None = None) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes, n_removed, n_spans, kept (bytes), kept_sha256;
    with ``rest``, also kept_text and those columns, as one struct.

    A byte of a text's UTF-8 form goes if it is covered by a string of ``length`` bytes, within one document, that also
    starts earlier: in a smaller doc_id, or earlier in the same one. Strings are judged on the input. n_spans counts
    the maximal removed runs.

    Null, empty and short texts lose nothing. Rows without doc_id count as after all others; rows of one doc_id are
    ordered by a hash of their text, and each is a document. An empty table gives no rows.

    Each chunk of documents sorts the suffixes at the anchors of its windows (see ``Windows``) whose gram is repeated
    anywhere, and exchanges them as front-coded runs; a bucket merges the runs of all chunks. Suffixes that share a
    gram become neighbours; where their contexts differ, the windows in them are compared one by one.
    """
    packed = chunks.pack(docs, doc_id, text, "suffixes", CHUNK, rest)
    copy_buckets = chunks.bucket_count(packed, 1 / 2000)
    known = chunks.copies(packed, copy_buckets, "suffixes-copies")
    gram_buckets = chunks.bucket_count(packed, 2 / (length - gram_of(length) + 2))
    merge_buckets = chunks.bucket_count(packed, 0.3 * 2 / (length - gram_of(length) + 2) * chunks.BUCKET / RECORDS)

    def spans(chunk: Chunk, answers: dict) -> tuple[np.ndarray, Windows, Keys]:
        skip = is_copy(chunk, answers, copy_buckets)
        w = Windows(chunk, length, skip)
        return skip, w, Keys(w.keys, gram_buckets)

    def send_grams(chunk: Chunk, answers: dict) -> Iterator[pa.RecordBatch]:
        yield spans(chunk, answers)[2].batch(chunk.number)

    grams = chunks.ask(chunks.each(packed, known, send_grams, chunks.KEYS), "gram", 1, False, "suffixes-grams", HOT)
    known = known.unionByName(grams)

    def chosen(chunk: Chunk, answers: dict):
        skip, w, keys = spans(chunk, answers)
        here = keys.count[keys.of] > 1
        there = keys.answered(answers.get("gram", {}))
        sent = np.flatnonzero(there)
        hot = keys.answered(answers.get("gram-hot", {}))[sent]
        return skip, w, here, _records(chunk, w, sent, hot, merge_buckets)

    def send_runs(chunk: Chunk, answers: dict) -> Iterator[pa.RecordBatch]:
        records = chosen(chunk, answers)[3]
        rows = [(b, chunk.number, front_code(r)) for b, (r, _, _) in records.items()]
        yield pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate((pa.int32(), pa.int64(), pa.binary()))], ["bucket", "chunk", "keys"])

    runs = chunks.each(packed, known, send_runs, chunks.KEYS)
    answered = runs.groupBy("bucket").applyInArrow(lambda t: _merged(t, length), "chunk bigint, kind string, bucket int, bits binary")
    known = known.unionByName(stage_table(answered, "suffixes-merged"))

    def cut(chunk: Chunk, answers: dict) -> Iterator[pa.RecordBatch]:
        skip, w, here, records = chosen(chunk, answers)
        n = len(chunk.data)
        later = np.zeros(n, bool)
        told = answers.get("suffix", {})
        for b, (own, starts, counts) in records.items():
            answer = told[b]
            at = len(own)
            for k, state in enumerate(answer[: len(own)]):
                if not state:
                    continue
                m = counts[k]
                bits = True
                if state == 2:
                    size = (m + 7) // 8
                    bits = np.unpackbits(np.frombuffer(answer, np.uint8, size, at), count=m).astype(bool)
                    at += size
                for s in starts[k]:
                    later[s : s + m] |= bits
        # Within the chunk: windows whose gram stands here more than once.
        twice = np.flatnonzero(here)
        if len(twice):
            size = w.last[twice] - w.first[twice] + 1
            at = np.repeat(w.first[twice] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            second = Rolling(byte_symbols(1)[chunk.data], 1)
            keys = Keys(np.stack([r.slices(at, at + length) for r in (w.rolling, second)], axis=1), 1)
            later[at[keys.first[keys.of] != np.arange(len(at))]] = True
        starts = np.flatnonzero(later)
        marks = np.zeros(n + 1, np.int32)
        marks[starts] += 1
        np.add.at(marks, starts + length, -1)
        gone = np.cumsum(marks[:n]) > 0
        size = np.diff(chunk.offsets)
        gone |= np.repeat(skip & (size >= length), size)
        begins = gone & ~np.r_[False, gone[:-1]]
        heads = chunk.offsets[:-1][size > 0]
        begins[heads] = gone[heads]
        sums, runs_ = np.r_[0, np.cumsum(gone)], np.r_[0, np.cumsum(begins)]
        kept = [chunk.data[a:b][~gone[a:b]].tobytes() for a, b in zip(chunk.offsets, chunk.offsets[1:])]
        lo, hi = chunk.offsets[:-1], chunk.offsets[1:]
        yield pa.record_batch(
            [
                pa.array(chunk.doc_ids, pa.int64()),
                pa.array(size),
                pa.array(sums[hi] - sums[lo], pa.int64()),
                pa.array(runs_[hi] - runs_[lo], pa.int64()),
                pa.array(kept, pa.binary()),
                pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                *([pa.array([k.decode("utf-8", "ignore") for k in kept], pa.string()), chunk.rest] if along else []),
            ],
            ["doc_id", "n_bytes", "n_removed", "n_spans", "kept", "kept_sha256", *(["kept_text", "rest"] if along else [])],
        )

    along = bool(rest)
    schema = T.StructType.fromDDL("doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary, kept_sha256 string")
    if along:
        schema = schema.add("kept_text", T.StringType()).add("rest", packed.schema["rest"].dataType.elementType)
    return chunks.each(packed, known, cut, schema, along)


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = 100) -> DataFrame:
    """``docs`` with the kept bytes as text (see ``remove_repeats``); characters cut in half go, null texts stay null."""
    others = [c for c in docs.columns if c != text]
    own = docs.select(
        docs[doc_id].alias("doc_id"), docs[text].alias("text"), docs[text].isNull().alias("none"), F.struct(*[docs[c] for c in others]).alias("others")
    )
    cut = remove_repeats(own, "doc_id", "text", length, ["none", "others"])
    kept = F.when(~F.col("rest.none"), F.col("kept_text"))
    return cut.select(*[kept.alias(c) if c == text else F.col("rest.others").getField(c).alias(c) for c in docs.columns])
