"""Repeated word windows and byte strings against brute force."""

import hashlib
import random

import numpy as np
import pytest

from modelwatch.llm import chunks, substrings, suffixes
from tests.llm.awkward import FIELDS, rows


def in_order(data):
    """Rows as documents in order: by id, nulls last. Rows of one id are compared as a set below."""
    return sorted(data, key=lambda r: (r[0] is None, r[0] or 0))


def windows_gone(sequences, size):
    seen, out = set(), []
    for s in sequences:
        gone = [False] * len(s)
        for i in range(len(s) - size + 1):
            key = tuple(s[i : i + size]) if isinstance(s, list) else s[i : i + size]
            if key in seen:
                gone[i : i + size] = [True] * size
            seen.add(key)
        out.append(gone)
    return out


@pytest.fixture
def single_ids():
    """Awkward rows, but each id once, so that the order of documents is known."""
    data, seen = [], set()
    for r in rows():
        if r[0] not in seen:
            seen.add(r[0])
            data.append(r)
    return data


def test_word_windows(spark, single_ids):
    for size in (20, 3):
        got = {r.doc_id: r for r in substrings.remove_repeats(spark.createDataFrame(single_ids, FIELDS), window=size).collect()}
        docs = in_order(single_ids)
        split = [(r[1] or "").encode().split() for r in docs]
        assert len(got) == len(docs)
        for r, words, gone in zip(docs, split, windows_gone(split, size)):
            kept = b" ".join(w for w, g in zip(words, gone) if not g)
            own = got[r[0]]
            assert (own.n_words, own.n_removed, own.kept.encode()) == (len(words), sum(gone), kept)
            assert own.kept_sha256 == hashlib.sha256(kept).hexdigest()


def test_byte_strings(spark, single_ids, monkeypatch):
    monkeypatch.setattr(suffixes, "CHUNK", 2000)
    monkeypatch.setattr(suffixes, "COMPARED", 3)
    check_bytes(spark, single_ids, 100)


def check_bytes(spark, data, size):
    got = {r.doc_id: r for r in suffixes.remove_repeats(spark.createDataFrame(data, FIELDS), length=size).collect()}
    docs = in_order(data)
    texts = [(r[1] or "").encode() for r in docs]
    assert len(got) == len(docs)
    for r, text, gone in zip(docs, texts, windows_gone(texts, size)):
        kept = bytes(b for b, g in zip(text, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        own = got[r[0]]
        assert (own.n_bytes, own.n_removed, own.n_spans, bytes(own.kept)) == (len(text), sum(gone), spans, kept)
        assert own.kept_sha256 == hashlib.sha256(kept).hexdigest()


@pytest.mark.parametrize("hot", [0, 4096])
def test_byte_strings_of_small_alphabets(spark, monkeypatch, hot):
    """Many contexts of each gram, over many chunks; with hot = 0 every shared gram is dealt out by windows."""
    monkeypatch.setattr(suffixes, "CHUNK", 300)
    monkeypatch.setattr(suffixes, "HOT", hot)
    rng = random.Random(5)
    data = [(i, "".join(rng.choice("aab") for _ in range(rng.randrange(0, 200))), *[None] * 21) for i in range(120)]
    check_bytes(spark, data, 10)


def test_repeated_ids(spark):
    data = [(1, "x" * 150, *[None] * 21), (1, "x" * 150, *[None] * 21), (1, None, *[None] * 21)]
    got = sorted((r.n_bytes, r.n_removed) for r in suffixes.remove_repeats(spark.createDataFrame(data, FIELDS)).collect())
    # Within the first, all but its first byte is covered by a later start of the same string.
    assert got == [(0, 0), (150, 149), (150, 150)]
    words = sorted((r.n_words, r.n_removed) for r in substrings.remove_repeats(spark.createDataFrame(data, FIELDS), window=1).collect())
    assert words == [(0, 0), (1, 0), (1, 1)]


def test_empty(spark):
    none = spark.createDataFrame([], FIELDS)
    assert substrings.remove_repeats(none).collect() == []
    assert suffixes.remove_repeats(none).collect() == []
    assert suffixes.without_repeats(none).columns == none.columns


def test_whole_rows(spark, single_ids):
    table = spark.createDataFrame(single_ids, FIELDS)
    cut = suffixes.without_repeats(table)
    assert cut.schema.simpleString() == table.schema.simpleString()
    by_id = {r[0]: r for r in single_ids}
    for r in cut.collect():
        assert (r.text is None) == (by_id[r.doc_id][1] is None)
        assert tuple(r)[2:] == by_id[r.doc_id][2:]


def test_cover_reaches_every_pair():
    for period, cover in substrings.COVERS.items():
        assert {(a - b) % period for a in cover for b in cover} == set(range(period))
    assert substrings.cover_for(20) == (13, (0, 1, 3, 9))


def test_merge_never_rereads():
    rng = random.Random(3)
    for _ in range(150):
        runs = [sorted({bytes(rng.choice(b"ab") for _ in range(rng.randrange(0, 9))) for _ in range(rng.randrange(0, 9))}) for _ in range(rng.randrange(1, 8))]
        out = list(suffixes.merge_runs([suffixes.front_decode(suffixes.front_code(r)) for r in runs]))
        assert [(r, k) for r, k, _ in out] == sorted((x, k) for k, r in enumerate(runs) for x in r)
        before = b""
        for record, _, share in out:
            assert share == suffixes.shared_prefix(before, record, 0)
            before = record


def test_keys():
    keys = chunks.Keys(np.array([5, 9, 5, 1], np.uint64), 4)
    assert keys.keys.ravel().tolist() == [1, 5, 9] and keys.of.tolist() == [1, 2, 1, 0] and keys.first.tolist() == [3, 0, 1]
    assert keys.count.tolist() == [1, 2, 1]
