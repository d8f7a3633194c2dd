"""Benchmark leaks: passages of every document against a BM25 index of test items, with block-max WAND."""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwatch.llm.common import carried, pick, text_bytes, uncarried, utf8_slices
from modelwatch.llm.hashing import LETTER, Rolling, distinct, words
from modelwatch.llm.substrings import word_hashes

#: Saturation and length normalisation of BM25.
K1, B = 1.2, 0.75
#: Words of a shingle, share of an item's shingles that a leak has, and items of an index block.
SHINGLE, SHARE, ITEMS = 5, 0.8, 4
#: Pairs of a passage and a block whose bounds are added up at a time.
BOUNDS = 1 << 20
#: Bytes of item texts of one index, which is broadcast; more items make more indexes, each with its own pass.
INDEX_BYTES = 32 << 20
#: Runs of letters and digits are words.
WORD = LETTER.copy()
WORD[[*range(ord("0"), ord("9") + 1)]] = True


def question_and_answer(text: str) -> tuple[str, str]:
    """An item's last sentence is its answer, the rest the question; one sentence alone is a question."""
    ends = [m.end() for m in re.finditer(r"[.!?]\s+", text.strip())]
    return (text.strip()[: ends[-1]], text.strip()[ends[-1] :]) if ends else (text.strip(), "")


def _hashes(text: str) -> np.ndarray:
    data = np.frombuffer(text.lower().encode(), np.uint8)
    starts, ends, _ = words(data, np.array([0, len(data)]), WORD)
    return word_hashes(data, starts, ends, 0)


def shingles(hashes: np.ndarray) -> np.ndarray:
    """Distinct hashes of ``SHINGLE`` consecutive words; of fewer words, the whole sequence."""
    n = len(hashes)
    if not n:
        return hashes
    size = min(SHINGLE, n)
    at = np.arange(n - size + 1)
    return distinct(Rolling(hashes).slices(at, at + size))


class Index:
    """Inverted index of test items. A posting's impact is its BM25 weight over its item's threshold: 1 is retrieved.

    The threshold of an item is its score for itself less that of its heaviest words that may be missing where
    ``SHARE`` of its shingles are found: an unmatched shingle leaves one word at most without a matched one. So
    whatever passes the shingle check is retrieved.
    """

    def __init__(self, items: list[tuple[int, str]]):
        parts = [(i, *map(_hashes, question_and_answer(t))) for i, t in items]
        parts = [(i, q, a) for i, q, a in parts if len(q) + len(a)]
        self.ids = np.array([i for i, _, _ in parts], np.int64)
        self.question = [shingles(q) for _, q, _ in parts]
        self.answer = [shingles(a) for _, _, a in parts]
        whole = [np.concatenate([q, a]) for _, q, a in parts]
        self.longest = max((len(w) for w in whole), default=1)
        self.terms, where = np.unique(np.concatenate(whole) if whole else np.zeros(0, np.uint64), return_inverse=True)
        item = np.repeat(np.arange(len(whole)), [len(w) for w in whole])
        pair, tf = np.unique(where * max(len(whole), 1) + item, return_counts=True)
        term, item = np.divmod(pair, max(len(whole), 1))
        n, df = len(whole), np.bincount(term, minlength=len(self.terms))
        size = np.array([len(w) for w in whole], float)
        idf = np.log(1 + (n - df + 0.5) / (df + 0.5))
        norm = K1 * (1 - B + B * size / size.mean()) if n else size
        impact = idf[term] * tf * (K1 + 1) / (tf + norm[item])
        for k in range(n):
            own = np.flatnonzero(item == k)
            grams = len(self.question[k]) + len(self.answer[k])
            # A repeated word counts as often as it stands there; rounding up leaves room for the cut between the parts.
            free = int(np.ceil((1 - SHARE) * grams)) + 2
            heavy = np.sort(impact[own])[::-1]
            impact[own] /= max(heavy[free:].sum(), heavy[-1], 1e-9)
        self.n = n
        order = np.lexsort((item, term))
        self.item, self.impact = item[order], impact[order]
        self.cuts = np.searchsorted(term[order], np.arange(len(self.terms) + 1))
        #: Block maxima, for each term the blocks that have it; rounded up, so that they bound in any order of adding.
        term = term[order]
        cell, where = np.unique(term * (n // ITEMS + 1) + self.item // ITEMS, return_inverse=True)
        self.peak = np.zeros(len(cell))
        np.maximum.at(self.peak, where, self.impact * (1 + 1e-9))
        cell_term, self.block = np.divmod(cell, n // ITEMS + 1)
        self.block_cuts = np.searchsorted(cell_term, np.arange(len(self.terms) + 1))
        self.top = np.maximum.reduceat(self.peak, self.block_cuts[:-1]) if len(cell) else self.peak
        self.opened: dict[tuple[int, int], tuple[list[int], list[float], float]] = {}

    def lookup(self, hashes: np.ndarray) -> np.ndarray:
        """Term numbers; -1 for a word that no item has."""
        if not len(self.terms):
            return np.full(len(hashes), -1)
        at = np.minimum(np.searchsorted(self.terms, hashes), len(self.terms) - 1)
        return np.where(self.terms[at] == hashes, at, -1)

    def bounds(self, begins: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(query, block) where the block's maxima add up to 1; queries are runs of ``terms`` from each of ``begins`` on."""
        query = np.repeat(np.arange(len(begins)), np.diff(np.r_[begins, len(terms)]))
        lo, size = self.block_cuts[terms], self.block_cuts[terms + 1] - self.block_cuts[terms]
        at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
        blocks = self.n // ITEMS + 1
        total = np.bincount(np.repeat(query, size) * blocks + self.block[at], self.peak[at], minlength=len(begins) * blocks)
        return np.divmod(np.flatnonzero(total >= 1 - 1e-6), blocks)

    def postings(self, term: int, block: int) -> tuple[list[int], list[float], float]:
        """A term's items and impacts in a block, and the largest of these."""
        key = (term, block)
        if key not in self.opened:
            lo, hi = self.cuts[term], self.cuts[term + 1]
            a, b = lo + np.searchsorted(self.item[lo:hi], [block * ITEMS, (block + 1) * ITEMS])
            self.opened[key] = (self.item[a:b].tolist(), self.impact[a:b].tolist(), float(self.impact[a:b].max()) if b > a else 0.0)
        return self.opened[key]

    def wand(self, terms: list[int], block: int) -> list[tuple[int, float]]:
        """Items of a block that score 1 or more: WAND over the terms' postings, with the block's maxima as bounds."""
        lists = [[items, impacts, 0, peak] for items, impacts, peak in (self.postings(t, block) for t in terms) if items]
        found = []
        while lists:
            lists.sort(key=lambda x: x[0][x[2]])
            bound, pivot = 0.0, None
            for x in lists:
                bound += x[3]
                if bound >= 1 - 1e-6:
                    pivot = x[0][x[2]]
                    break
            if pivot is None:
                break
            if lists[0][0][lists[0][2]] == pivot:
                score = sum(x[1][x[2]] for x in lists if x[0][x[2]] == pivot)
                if score >= 1 - 1e-6:
                    found.append((pivot, score))
                step = pivot + 1
            else:
                step = pivot
            for x in lists:
                while x[2] < len(x[0]) and x[0][x[2]] < step:
                    x[2] += 1
            lists = [x for x in lists if x[2] < len(x[0])]
        return found


def _overlap(wanted: np.ndarray, there: np.ndarray) -> float:
    return float(np.isin(wanted, there).mean()) if len(wanted) else 1.0


def _search(index: Index, data: np.ndarray, offsets: np.ndarray) -> dict[int, dict[int, tuple[float, float, float]]]:
    """By document: {item: (score, question overlap, answer overlap)} of the verified leaks."""
    starts, ends, document = words(data, offsets, WORD)
    if not len(starts) or not index.n:
        return {}
    hashes = word_hashes(data, starts, ends, 0)
    stride = max(64, index.longest)
    docs = len(offsets) - 1
    count = np.bincount(document, minlength=docs)
    first = np.cumsum(count) - count
    # Passages: two strides of words, one stride apart, so that every item-long run of words lies in one.
    passages = np.maximum(1, -(-(count - stride) // stride))
    base = np.cumsum(passages) - passages
    local = np.arange(len(starts)) - first[document]
    term = index.lookup(hashes)
    hit = np.flatnonzero(term >= 0)
    step = local[hit] // stride
    last = base[document[hit]] + passages[document[hit]] - 1
    own = base[document[hit]] + step
    size = len(index.terms)
    both = np.concatenate([(own * size + term[hit])[own <= last], ((own - 1) * size + term[hit])[step > 0]])
    both = distinct(both)
    passage, t = np.divmod(both, size)
    # Shallow step for all passages at once: maxima bound the scores, first over all items, then block by block.
    begins = np.flatnonzero(np.r_[True, passage[1:] != passage[:-1]]) if len(passage) else np.zeros(0, np.int64)
    if not len(begins):
        return {}
    closes = np.r_[begins[1:], len(passage)]
    open_ = np.flatnonzero(np.add.reduceat(index.top[t], begins) >= 1 - 1e-6)
    out: dict[int, dict[int, tuple[float, float, float]]] = {}
    queries = max(1, BOUNDS // (index.n // ITEMS + 1))
    for at in range(0, len(open_), queries):
        some = open_[at : at + queries]
        length = closes[some] - begins[some]
        heads = np.cumsum(length) - length
        terms = t[np.repeat(begins[some] - heads, length) + np.arange(length.sum())]
        for k, block in zip(*(x.tolist() for x in index.bounds(heads, terms))):
            k = some[k]
            retrieved = index.wand(t[begins[k] : closes[k]].tolist(), block)
            if not retrieved:
                continue
            p = int(passage[begins[k]])
            d = int(np.searchsorted(base, p, "right")) - 1
            lo = first[d] + (p - base[d]) * stride
            own_words = hashes[lo : min(lo + 2 * stride, first[d] + count[d])]
            grams = {n: distinct(Rolling(own_words).slices(np.arange(len(own_words) - n + 1), np.arange(n, len(own_words) + 1))) for n in range(1, SHINGLE + 1) if n <= len(own_words)}
            for item, score in retrieved:
                q, a = _found(index, item, grams)
                if q >= SHARE and a >= SHARE:
                    best = out.setdefault(d, {}).get(item, (0.0, 0.0, 0.0))
                    out[d][item] = max(best, (score, q, a))
    return out


def _found(index: Index, item: int, grams: dict[int, np.ndarray]) -> tuple[float, float]:
    """Shares of the question's and the answer's shingles in a passage; a short part is one shingle of its length."""

    def share(wanted: np.ndarray) -> float:
        return max((_overlap(wanted, there) for there in grams.values()), default=0.0) if len(wanted) == 1 else _overlap(wanted, grams.get(SHINGLE, wanted[:0]))

    return share(index.question[item]), share(index.answer[item])


def mark(docs: DataFrame, items: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """``docs`` with _leaks, an array of (item, score, question, answer) in order of items; empty without a leak.

    Each whole text is cut into overlapping passages; each passage queries the index with its distinct words, and gets
    all items whose BM25 score reaches the item's threshold. An item is a leak if ``SHARE`` of the five-word shingles
    of its question and of its answer (see ``question_and_answer``) are in the passage. score is over the threshold.

    Words are runs of letters and digits in lower case. Null and empty texts have no leaks, items without words leak
    nowhere, nor do
    items without id; a repeated item is reported as often as it stands there. Repeated rows come
    back repeated; an empty table gives no rows, and without items there are no leaks.
    """
    names = list(docs.columns)
    tests = pick(items, item=item_id, words=item_text).where("words IS NOT NULL AND item IS NOT NULL").withColumn("item", F.col("item").cast("bigint"))
    size = tests.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    groups = size // INDEX_BYTES + 1
    spark, rows = docs.sparkSession, docs.withColumn("_leaks", F.expr("array()").cast("array<struct<item:bigint,score:double,question:double,answer:double>>"))
    for g in range(groups):
        own = tests if groups == 1 else tests.where(F.pmod(F.xxhash64("item", "words"), F.lit(groups)) == g)
        rows = _marked(rows, names, text, spark.sparkContext.broadcast([(r.item, r.words) for r in own.orderBy("item", "words").collect()]))
    return rows


def _marked(rows: DataFrame, names: list[str], text: str, sent) -> DataFrame:
    low = rows.withColumn("_low", F.lower(rows[text]))
    kind = pa.list_(pa.struct([("item", pa.int64()), ("score", pa.float64()), ("question", pa.float64()), ("answer", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(sent.value)
        for part in utf8_slices(batches, "_low"):
            found = _search(index, *text_bytes(part.column("_low")))
            leaks = part.column("_leaks").to_pylist()
            for d, own in found.items():
                more = [dict(item=int(index.ids[i]), score=s, question=q, answer=a) for i, (s, q, a) in sorted(own.items())]
                leaks[d] = sorted(leaks[d] + more, key=lambda x: x["item"])
            yield pa.record_batch([*(part.column(c) for c in names), pa.array(leaks, kind)], [*names, "_leaks"])

    return low.mapInArrow(run, rows.schema)


def clean(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """Rows of ``docs`` into which no item leaks (see ``mark``). Columns may have any names."""
    return uncarried(mark(carried(docs, text), items).where(F.size("_leaks") == 0), docs.columns, text)


def find(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per document and item that leaks into it: doc_id, item_id, score, question_overlap, answer_overlap.

    See ``mark`` for what a leak is and for nulls and repeats.
    """
    rows = mark(pick(docs, doc_id=doc_id, text=text), items, "text", item_id, item_text)
    rows = rows.select("doc_id", F.explode("_leaks").alias("x"))
    return rows.select("doc_id", F.col("x.item").alias("item_id"), F.col("x.score").alias("score"), F.col("x.question").alias("question_overlap"), F.col("x.answer").alias("answer_overlap"))
