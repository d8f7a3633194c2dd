"""Hard negatives against plain lists of integers."""

import random

import pytest
from pyspark.sql import functions as F

from modelwatch.llm import mining

FIELDS = "vec_id bigint, label int, vector array<bigint>, anchor boolean, slot int, score string, id int, block int, number int, positives int"


def plain(rows, positives=5, negatives=5, window=(80, 100, 100)):
    low, high, of = window
    live = [(i, lab, v, a) for i, lab, v, a, *_ in rows if lab is not None and v is not None and None not in v]
    order = lambda t: (-t[0], mining.NO_ID if t[1] is None else t[1])
    out = []
    for at, (i, lab, v, asks) in enumerate(live):
        if not asks:
            continue
        others = [(sum(x * y for x, y in zip(v, w, strict=True)), j, m) for k, (j, m, w, _) in enumerate(live) if k != at and len(w) == len(v)]
        others.sort(key=order)
        for p, j, _ in [t for t in others if t[2] == lab][:positives]:
            good = [t for t in others if t[2] != lab and low * p <= of * t[0] <= high * p]
            out += [(i, j, r + 1, n, p, s) for r, (s, n, _) in enumerate(good[:negatives])]
    return sorted(out, key=str)


def fixture(seed, n=220, values=4, d=3):
    rng = random.Random(seed)
    rest = (1, "x", 2, 3, 4, 5)
    rows = []
    for i in range(n):
        v = [rng.randrange(-1, values) for _ in range(d)]
        rows.append((i, rng.choice([0, 1, 1, 1, 2, None]), v, i % 9 == 0, *rest))
    rows += [rows[9], rows[9], rows[18], rows[19]]  # repeated rows, anchors among them
    rows += [(None, 1, [3] * d, None, *rest), (None, 0, [2] * d, True, *rest), (500, 1, None, True, *rest), (501, 1, [1, None, 2], True, *rest)]
    rows += [(502, 1, [], True, *rest), (503, 1, [], False, *rest), (504, 2, [], None, *rest), (505, 1, [7] * (d + 1), True, *rest), (506, 2, [6] * (d + 1), False, *rest)]
    rows += [(507, 1, [-3] * d, True, *rest), (9, 1, [5] * d, True, *rest)]  # negative scores; an id that has another row
    return rows


@pytest.mark.parametrize(
    ("seed", "values", "d", "bytes", "window"),
    [(1, 4, 3, 1 << 20, (80, 100, 100)), (2, 40, 3, 900, (80, 100, 100)), (3, 2, 2, 600, (0, 100, 100)), (4, 300, 8, 2000, (60, 90, 100))],
)
def test_plain(spark, seed, values, d, bytes, window):
    rows = fixture(seed, values=values, d=d)
    table = spark.createDataFrame(rows, FIELDS).repartition(5)
    got = mining.mine(table, "anchor", block_bytes=bytes, window=window)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, window=window)


def test_one_score(spark):
    """Everything ties: smaller ids come first, whatever task saw them."""
    rows = [(i, i % 2, [1, 1], i % 50 == 0, 1, "x", 1, 1, 1, 1) for i in range(400)]
    got = mining.mine(spark.createDataFrame(rows, FIELDS).repartition(7), "anchor", positives=2, negatives=3)
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows, 2, 3)


def test_large_entries(spark):
    rows = [(i, i % 2, [1 << 50, i << 20], i == 0, 1, "x", 1, 1, 1, 1) for i in range(12)]
    got = mining.mine(spark.createDataFrame(rows, FIELDS), "anchor").collect()
    assert {r["anchor_id"] for r in got} == {0} and len(got) == 25 and all(r["negative_score"] > 0 for r in got)


def test_empty(spark):
    none = spark.createDataFrame([], FIELDS)
    assert mining.mine(none, "anchor").collect() == []
    rows = spark.createDataFrame(fixture(1), FIELDS)
    assert mining.mine(rows, F.lit(False)).collect() == []
    with pytest.raises(ValueError):
        mining.mine(none, "anchor", window=(100, 80, 100))
