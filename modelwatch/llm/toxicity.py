"""Toxicity of a text: a factorization machine over hashed terms."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwatch.llm.common import pick, splitmix, stage_table, text_bytes, utf8_slices
from modelwatch.llm.hashing import LETTER, Rolling, byte_symbols, distinct, words
from modelwatch.llm.language import fold

#: Hash buckets of terms, and the length of the factor of each.
BUCKETS, FACTORS = 1 << 18, 8
#: Labelled rows to fit on, about; fewer are all used.
SAMPLE = 10_000
#: Lengths in bytes of the word beginnings that are terms too: invented and inflected words share them.
BEGINNINGS = (4, 5, 6)
#: A term takes part if so many sampled documents have it.
LEAST = 3
#: Weight of a term that says nothing alone.
FLOOR = 0.02


def terms(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(document, bucket) of the distinct hashed words (runs of letters) and word beginnings of each text, in order."""
    starts, ends, document = words(data, offsets, LETTER)
    rolling = Rolling(byte_symbols()[data])
    found = [document.astype(np.uint64) << np.uint64(18) | rolling.slices(starts, ends) >> np.uint64(46)]
    for length in BEGINNINGS:
        long = np.flatnonzero(ends - starts > length)
        begun = rolling.slices(starts[long], starts[long] + length)
        found.append(document[long].astype(np.uint64) << np.uint64(18) | splitmix(begun) >> np.uint64(46))
    both = distinct(np.concatenate(found))
    return (both // np.uint64(BUCKETS)).astype(np.int64), (both % np.uint64(BUCKETS)).astype(np.int64)


class Machine:
    """score = sigmoid(bias + sum w_i x_i + sum over pairs <v_i, v_j> x_i x_j); x_i is a weight of the term.

    ``linear`` and ``factors`` hold the weights times x_i, so that a text's score needs only its distinct terms.
    """

    def __init__(self, bias: float, linear: np.ndarray, factors: np.ndarray):
        self.bias, self.linear, self.factors = bias, linear, factors

    def scores(self, document: np.ndarray, bucket: np.ndarray, n: int) -> np.ndarray:
        raw = np.full(n, self.bias)
        raw += np.bincount(document, self.linear[bucket], minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[bucket, f]
            raw += 0.5 * (np.bincount(document, v, minlength=n) ** 2 - np.bincount(document, v * v, minlength=n))
        return 1 / (1 + np.exp(-np.clip(raw, -30, 30)))


def term_weights(document: np.ndarray, bucket: np.ndarray, label: np.ndarray) -> np.ndarray:
    """x of each bucket, 0 to 1: how far its log ratio of document rates between the classes is from chance.

    A term that says nothing alone still gets ``FLOOR``, for what it may say together with another; a term that fewer
    than ``LEAST`` documents have gets 0.
    """
    often = np.bincount(bucket, minlength=BUCKETS)
    yes = np.bincount(bucket, label[document], minlength=BUCKETS)
    no = often - yes
    ratio = np.log((yes + 0.5) / (label.sum() + 1)) - np.log((no + 0.5) / (len(label) - label.sum() + 1))
    sure = np.abs(ratio) - 2 * np.sqrt(1 / (yes + 1) + 1 / (no + 1))
    return np.where(often >= LEAST, np.clip(sure / 4, FLOOR, 1), 0.0)


def train(indptr: np.ndarray, bucket: np.ndarray, label: np.ndarray, epochs: int = 8, batch: int = 64, rate: float = 0.3, ridge: float = 1e-4, seed: int = 5) -> Machine:
    """Fit by AdaGrad on the logistic loss; rows are documents in the compressed form (indptr, bucket).

    A pair's factors start near zero and grow by their product, so that the steps must be large for pairs of rarer words.
    """
    n = len(label)
    rate0 = (label.sum() + 1) / (n + 2)
    x_of = term_weights(np.repeat(np.arange(n), np.diff(indptr)), bucket, label)
    live = np.flatnonzero(x_of)
    at = np.full(BUCKETS, -1)
    at[live] = np.arange(len(live))
    x_live, rng = x_of[live], np.random.default_rng(seed)
    w, v = np.zeros(len(live)), rng.normal(0, 0.01, (len(live), FACTORS))
    gw, gv, gb = np.full(len(live), 1e-2), np.full(v.shape, 1e-2), 1e-2
    bias = float(np.log(rate0 / (1 - rate0)))
    for _ in range(epochs if len(live) else 0):
        order = rng.permutation(n)
        for lo in range(0, n, batch):
            rows = order[lo : lo + batch]
            size = indptr[rows + 1] - indptr[rows]
            row = np.repeat(np.arange(len(rows)), size)
            cell = at[bucket[np.repeat(indptr[rows], size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]]
            row, cell = row[cell >= 0], cell[cell >= 0]
            x = x_live[cell]
            xv = v[cell] * x[:, None]
            sums = np.stack([np.bincount(row, xv[:, f], minlength=len(rows)) for f in range(FACTORS)], axis=1)
            squares = np.bincount(row, (xv * xv).sum(axis=1), minlength=len(rows))
            raw = bias + np.bincount(row, w[cell] * x, minlength=len(rows)) + 0.5 * ((sums**2).sum(axis=1) - squares)
            error = 1 / (1 + np.exp(-np.clip(raw, -30, 30))) - label[rows]
            used, place = np.unique(cell, return_inverse=True)
            dw = np.bincount(place, error[row] * x, minlength=len(used)) + ridge * w[used]
            side = (error[row] * x)[:, None] * (sums[row] - xv)
            dv = np.stack([np.bincount(place, side[:, f], minlength=len(used)) for f in range(FACTORS)], axis=1) + ridge * v[used]
            gw[used] += dw * dw
            gv[used] += dv * dv
            gb += error.sum() ** 2
            w[used] -= rate * dw / np.sqrt(gw[used])
            v[used] -= 0.5 * rate * dv / np.sqrt(gv[used])
            bias -= rate * error.sum() / np.sqrt(gb)
    linear, factors = np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32)
    linear[live], factors[live] = w * x_live, v * x_live[:, None]
    return Machine(bias, linear, factors)


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, parts: int = 12) -> Machine:
    """Fit on about ``sample`` rows of ``docs(doc_id, text)`` joined with ``labels(doc_id, toxic)``.

    Texts become term buckets on the executors; only the sampled rows' buckets reach the driver, which fits on them.
    """
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").distinct()
    count = known.count()
    share = min(1.0, sample / max(count, 1))
    chosen = known.where(F.pmod(F.xxhash64("doc_id", F.lit("sample")), F.lit(1 << 30)) < int(share * (1 << 30)) + (share == 1.0))
    rows = docs.join(chosen, "doc_id").select("doc_id", F.lower("text").alias("text"), "toxic").repartition(parts, F.xxhash64("doc_id"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in utf8_slices(batches, "text"):
            document, bucket = terms(*text_bytes(part.column("text")))
            cut = np.searchsorted(document, np.arange(part.num_rows + 1))
            cells = [bucket[a:b].astype(np.int32).tobytes() for a, b in zip(cut, cut[1:])]
            yield pa.record_batch([part.column("doc_id").cast(pa.string()), pa.array(cells, pa.binary()), part.column("toxic").cast(pa.int32())], ["doc_id", "cells", "toxic"])

    seen = stage_table(rows.mapInArrow(run, "doc_id string, cells binary, toxic int"), "toxicity-sample").toPandas()
    seen = seen.sort_values(["doc_id", "toxic", "cells"])  # the same order in every run
    size = np.array([len(c) // 4 for c in seen["cells"]], np.int64)
    bucket = np.frombuffer(b"".join(seen["cells"]), np.int32).astype(np.int64)
    return train(np.r_[0, np.cumsum(size)].astype(np.int64), bucket, (seen["toxic"].to_numpy() > 0).astype(float))


def score(rows: DataFrame, machine: Machine) -> DataFrame:
    """``rows`` with _toxicity (0 to 1) instead of text; null and empty texts get what the bias alone says."""
    rest = [c for c in rows.columns if c != "text"]
    sent = rows.sparkSession.sparkContext.broadcast((machine.bias, machine.linear, machine.factors))  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*sent.value)
        for part in utf8_slices(batches, "text"):
            own = machine.scores(*terms(*text_bytes(part.column("text"))), part.num_rows)
            yield pa.record_batch([*(part.column(c) for c in rest), pa.array(own)], [*rest, "_toxicity"])

    fields = "".join(f"`{c}` {rows.schema[c].dataType.simpleString()}, " for c in rest)
    return rows.withColumn("text", F.lower("text")).mapInArrow(run, fields + "_toxicity double")


def judge(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic", sample: int = SAMPLE) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted (1 if score >= 0.5).

    Learns from labelled rows whose crc32(doc_id) modulo 5 is not 0 (held_out is that remainder being 0); a score sees
    the text only. Null labels and ids are not learned from; a document with several different labels counts with each.
    Without labels every score is 0.5. Null and empty texts
    are scored like texts without known terms. Repeated rows come back repeated; an empty table gives no rows.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    known = pick(labels, doc_id=doc_id, toxic=toxic)
    learn = F.coalesce(fold(F.col("doc_id"), 5) != 0, F.lit(False))
    machine = fit(rows.where(learn), known.where(learn), sample)
    judged = score(rows.withColumn("held_out", F.coalesce(fold(F.col("doc_id"), 5) == 0, F.lit(False))), machine)
    return judged.select("doc_id", "held_out", F.col("_toxicity").alias("score"), (F.col("_toxicity") >= 0.5).cast("int").alias("predicted"))
