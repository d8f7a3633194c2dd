"""Language of a text by error-correcting output codes over binary n-gram classifiers."""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.llm.common import carried, pick, stage_table, text_bytes, uncarried, utf8_slices
from modelwatch.llm.hashing import LETTER

#: Lengths in bytes of the n-grams, and the number of hash buckets they share.
GRAMS = (2, 3)
BUCKETS = 1 << 16
#: Labelled rows to fit on, about; fewer are all used.
SAMPLE = 20_000
#: Bytes whose n-grams are looked up at a time, and the bound on a margin.
STRIDE, MARGIN = 1 << 20, 8.0
UNKNOWN = "und"


class Model(NamedTuple):
    """languages, codes (language x bit, of 1 and -1), weights (bucket x bit; the last row is zero), trust (language x bit)."""

    languages: list[str]
    codes: np.ndarray
    weights: np.ndarray
    trust: np.ndarray


def code_book(n: int, seed: int = 11) -> np.ndarray:
    """Codewords of n classes: all distinct splits up to 6 classes, else the best of some random books.

    No column is constant or the complement of another; more classes get about 10 log2(n) bits.
    """
    if n == 1:
        return np.ones((1, 1))
    if n <= 6:
        bits = 2 ** (n - 1) - 1
        book = np.array([[1 if i == 0 else -1 if (b >> (i - 1)) & 1 else 1 for b in range(1, bits + 1)] for i in range(n)])
        return book.astype(float)
    bits, rng, best, far = math.ceil(10 * math.log2(n)), np.random.default_rng(seed), None, -1
    for _ in range(200):
        book = rng.choice([-1.0, 1.0], (n, bits))
        if (np.abs(book.sum(axis=0)) == n).any():
            continue
        apart = (bits - book @ book.T) / 2 + np.eye(n) * bits
        if apart.min() > far:
            best, far = book, apart.min()
    return best


def _buckets(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """For pieces of ``data``: (first position, buckets (n-gram length x position)); BUCKETS where there is no n-gram."""
    table = np.full(256, 0x20, np.uint8)
    table[LETTER] = np.flatnonzero(LETTER)
    n, most = len(data), max(GRAMS)
    end = offsets[1:]
    for at in range(0, n, STRIDE):
        stop = min(n, at + STRIDE)
        part = table[data[at : min(n, stop + most)]].astype(np.uint64)
        size = stop - at
        room = end[np.searchsorted(end, np.arange(at, stop), "right")] - np.arange(at, stop)
        out = np.full((len(GRAMS), size), BUCKETS, np.int64)
        for row, g in enumerate(GRAMS):
            m = min(size, len(part) - g + 1)
            if m <= 0:
                continue
            code, blank = np.zeros(m, np.uint64), np.ones(m, bool)
            for k in range(g):
                code = code << np.uint64(8) | part[k : k + m]
                blank &= part[k : k + m] == 0x20
            with np.errstate(over="ignore"):
                bucket = ((code + np.uint64(g << 40)) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)
            out[row, :m] = np.where(blank | (room[:m] < g), BUCKETS, bucket.astype(np.int64))
        yield at, out


def margins(data: np.ndarray, offsets: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Document x bit: the sum of the weights of its n-grams over the root of their number."""
    docs, bits = len(offsets) - 1, weights.shape[1]
    total, count = np.zeros((docs, bits)), np.zeros(docs)
    for at, buckets in _buckets(data, offsets):
        size = buckets.shape[1]
        lo, hi = np.searchsorted(offsets, at, "right") - 1, np.searchsorted(offsets, at + size, "left")
        starts = np.clip(offsets[lo:hi] - at, 0, None)
        full = np.flatnonzero(np.diff(np.r_[starts, size]) > 0)
        own = lo + full
        for row in buckets:
            total[own] += np.add.reduceat(weights.take(row, axis=0), starts[full], axis=0)
            count[own] += np.add.reduceat(row < BUCKETS, starts[full])
    return np.clip(total / np.sqrt(np.maximum(count, 1))[:, None], -MARGIN, MARGIN)


def _counted(rows: DataFrame) -> DataFrame:
    """(lang, counts): n-gram counts of each part of the rows, one row per language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, np.ndarray] = {}
        for part in utf8_slices(batches, "text"):
            data, offsets = text_bytes(part.column("text"))
            langs = np.array(part.column("lang").to_pylist())
            names, which = np.unique(langs, return_inverse=True)
            of = np.repeat(which, np.diff(offsets))
            for at, buckets in _buckets(data, offsets):
                own = of[at : at + buckets.shape[1]]
                for row in buckets:
                    both = np.bincount(own * (BUCKETS + 1) + row, minlength=len(names) * (BUCKETS + 1)).reshape(len(names), -1)
                    for k, name in enumerate(names.tolist()):
                        counts[name] = counts.get(name, 0) + both[k, :BUCKETS]
        if counts:
            yield pa.record_batch([pa.array(list(counts)), pa.array([c.astype(np.int64).tobytes() for c in counts.values()], pa.binary())], ["lang", "counts"])

    return rows.mapInArrow(run, "lang string, counts binary")


def fit(rows: DataFrame, sample: int = SAMPLE, parts: int = 12) -> Model | None:
    """Fit on about ``sample`` rows of ``rows(doc_id, text, lang)``; null without labelled rows.

    Each bit is a naive Bayes classifier over n-grams, the languages on its two sides weighing the same. trust is the
    share of a language's sampled documents that a bit gets right, normalised over the bits.
    """
    known = rows.where("lang IS NOT NULL AND text IS NOT NULL")
    count = known.count()
    if not count:
        return None
    share = min(1.0, sample / count)
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    chosen = stage_table(chosen.select(F.lower("text").alias("text"), "lang").repartition(parts, F.xxhash64("doc_id")), "language-sample")
    counts: dict[str, np.ndarray] = {}
    for row in _counted(chosen).toLocalIterator():
        counts[row.lang] = counts.get(row.lang, 0) + np.frombuffer(row.counts, np.int64)
    languages = sorted(counts)
    if not languages:
        return None
    tall = np.stack([counts[x] for x in languages]) + 0.5
    dist = tall / tall.sum(axis=1, keepdims=True)
    codes = code_book(len(languages))
    weights = np.zeros((BUCKETS + 1, codes.shape[1]), np.float32)
    for b in range(codes.shape[1]):
        yes, no = dist[codes[:, b] > 0], dist[codes[:, b] < 0]
        if len(yes) and len(no):
            weights[:-1, b] = np.log(yes.mean(axis=0)) - np.log(no.mean(axis=0))
    flat = Model(languages, codes, weights, np.full(codes.shape, 1 / codes.shape[1]))
    right = np.ones(codes.shape) * 0.5
    total = np.ones(len(languages))
    for row in _bits_right(chosen, flat).toLocalIterator():
        k = languages.index(row.lang)
        right[k] += np.frombuffer(row.hits, np.float64)
        total[k] += row.n
    trust = right / total[:, None]
    return flat._replace(trust=trust / trust.sum(axis=1, keepdims=True))


def _bits_right(rows: DataFrame, model: Model) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in utf8_slices(batches, "text"):
            m = margins(*text_bytes(part.column("text")), model.weights)
            langs = np.array(part.column("lang").to_pylist())
            names = np.unique(langs).tolist()
            hits = [((m[langs == x] * model.codes[model.languages.index(x)]) > 0).sum(axis=0).astype(np.float64) for x in names]
            yield pa.record_batch([pa.array(names), pa.array([h.tobytes() for h in hits], pa.binary()), pa.array([int((langs == x).sum()) for x in names])], ["lang", "hits", "n"])

    return rows.mapInArrow(run, "lang string, hits binary, n bigint")


def decode(m: np.ndarray, model: Model) -> np.ndarray:
    """Document x language: shares, from the inverse of the trust-weighted exponential loss of each codeword."""
    loss = np.stack([(np.exp(-m * code) * trust).sum(axis=1) for code, trust in zip(model.codes, model.trust)], axis=1)
    share = 1 / loss
    return share / share.sum(axis=1, keepdims=True)


def predict(docs: DataFrame, model: Model | None, text: str = "text", gap: float = 0.1) -> DataFrame:
    """``docs`` with _lang_pred, _score (share of the nearest codeword, 0 to 1) and _ambiguous.

    _ambiguous: the second codeword's share is less than ``gap`` behind. ``und`` with score 0 where text is null or has
    no letter, or where nothing was learned. Of equal shares the first language in alphabetical order is taken.
    """
    names = [c for c in docs.columns]
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(None if model is None else tuple(model))  # fixed size: buckets x bits
    mine = {"_low": F.lower(docs[text]), "_ok": F.coalesce(docs[text].rlike(r"\p{L}"), F.lit(False))}
    rows = docs.withColumns(mine)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value and Model(*sent.value)
        for part in utf8_slices(batches, "_low"):
            ok = part.column("_ok").to_numpy(zero_copy_only=False).astype(bool)
            pred, score, unsure = np.full(len(ok), UNKNOWN, object), np.zeros(len(ok)), np.zeros(len(ok), bool)
            if model is not None:
                share = decode(margins(*text_bytes(part.column("_low")), model.weights), model)
                best = share.argmax(axis=1)
                top = np.sort(share, axis=1)[:, ::-1]
                second = top[:, 1] if top.shape[1] > 1 else np.zeros(len(ok))
                pred[ok] = np.array(model.languages, object)[best[ok]]
                score[ok], unsure[ok] = top[ok, 0], (top[:, 0] - second < gap)[ok]
            yield pa.record_batch([*(part.column(c) for c in names), pa.array(pred, pa.string()), pa.array(score), pa.array(unsure)], [*names, "_lang_pred", "_score", "_ambiguous"])

    more = T.StructType.fromDDL("_lang_pred string, _score double, _ambiguous boolean")
    return rows.mapInArrow(run, T.StructType([*docs.schema, *more]))


def accepted(docs: DataFrame, model: Model, text: str = "text", gap: float = 0.1) -> DataFrame:
    """Rows of ``docs`` with a language: those that ``predict`` calls neither unknown nor ambiguous. Columns may have any names."""
    judged = predict(carried(docs, text), model, gap=gap)
    return uncarried(judged.where((F.col("_lang_pred") != UNKNOWN) & ~F.col("_ambiguous")), docs.columns, text)


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def identify(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred, score, ambiguous.

    Learns from text and non-null lang of rows whose crc32(doc_id) modulo 3 is not 1 (held_out is that remainder being
    1); predictions see the text only. A row without doc_id is neither learned from nor held out. Null texts, texts
    without a letter and everything in a table without labels get ``und``, score 0. Repeated rows come back repeated;
    an empty table gives no rows.
    """
    rows = pick(docs, doc_id=doc_id, text=text, lang=lang)
    model = fit(rows.where(fold(F.col("doc_id"), 3) != 1), sample)
    judged = predict(rows.select("doc_id", "text", F.coalesce(fold(F.col("doc_id"), 3) == 1, F.lit(False)).alias("held_out")), model)
    return judged.select("doc_id", "held_out", *[F.col(f"_{c}").alias(c) for c in ("lang_pred", "score", "ambiguous")])
