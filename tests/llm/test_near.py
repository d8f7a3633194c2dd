"""SimHash groups and neighbours against brute force."""

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from modelwatch.llm import neighbours, simhash
from tests.llm.awkward import FIELDS, rows


def fingerprint(text, size=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + size]) for i in range(len(words) - size + 1)] or ([b" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(fps, bits):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for k in range(i):
            if (fps[i] ^ fps[k]).bit_count() <= bits:
                root[find(i)] = find(k)
    return [find(i) for i in range(len(fps))]


def test_groups(spark):
    data = rows()
    got = simhash.near_duplicates(spark.createDataFrame(data, FIELDS)).collect()
    fps = [fingerprint(r[1]) for r in data]
    root = components(fps, 3)
    least = {}
    for r, c in zip(data, root):
        if r[0] is not None:
            least[c] = min(least.get(c, r[0]), r[0])
    want = sorted((str(r[0]), f"{f:016x}", str(least.get(c))) for r, f, c in zip(data, fps, root))
    assert sorted((str(r.doc_id), r.fingerprint, str(r.component_id)) for r in got) == want


def test_one_of_each(spark):
    data = rows()
    kept = simhash.one_of_each(spark.createDataFrame(data, FIELDS)).collect()
    root = components([fingerprint(r[1]) for r in data], 3)
    assert len(kept) == len(set(root))
    of = {}
    for r, c in zip(data, root):
        of.setdefault(c, []).append(r[0])
    want = sorted(str(min((i for i in ids if i is not None), default=None)) for ids in of.values())
    assert sorted(str(r.doc_id) for r in kept) == want


def test_empty(spark):
    none = spark.createDataFrame([], FIELDS)
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.one_of_each(none).collect() == []


def test_links_of_dense_buckets(spark, monkeypatch):
    """Blocks of a few rows: every pair of blocks is worked on, and components stay those of all links."""
    rng = np.random.default_rng(4)
    centre = rng.integers(0, 1 << 63, 6, dtype=np.uint64)
    fps = set()
    for _ in range(900):
        x = int(rng.choice(centre))
        for b in rng.integers(0, 64, rng.integers(0, 7)):
            x ^= 1 << int(b)
        fps.add(x)
    fps = sorted(fps)
    monkeypatch.setattr(simhash, "BLOCK", 8)
    table = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp bigint")
    for bits in (0, 1, 3):
        edges = simhash.links(table, bits).collect()
        place = {x - (1 << 64) if x >> 63 else x: i for i, x in enumerate(fps)}
        assert all((fps[place[e.u]] ^ fps[place[e.v]]).bit_count() <= 64 for e in edges)
        root = list(range(len(fps)))

        def find(x, root=root):
            while root[x] != x:
                x = root[x]
            return x

        for e in edges:
            root[find(place[e.u])] = find(place[e.v])
        want = components(fps, bits)
        assert len({find(i) for i in range(len(fps))}) == len(set(want))
        assert all((find(i) == find(k)) == (want[i] == want[k]) for i in range(0, len(fps), 7) for k in range(0, i, 5))


def test_neighbours_recall_and_scores(spark):
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(12, 24))
    x = (centres[rng.integers(0, 12, 3000)] + 0.7 * rng.normal(size=(3000, 24))).astype(np.float32)
    x[500:900] = x[0]  # a group of copies
    data = [(i, v.tolist(), 1) for i, v in enumerate(x)]
    data[40] = (40, None, 1)
    data[60] = (60, [0.0] * 24, 1)
    data[80] = (80, [float("nan")] + [1.0] * 23, 1)
    data[100] = (100, [None] + [1.0] * 23, 1)
    data += [(None, x[1].tolist(), 1), (7, x[7].tolist(), 1)]
    table = spark.createDataFrame(data, "vec_id bigint, embedding array<float>, node int")
    got = {}
    for r in neighbours.nearest(table, k=20).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    ok = np.setdiff1d(np.arange(3000), [40, 60, 80, 100])
    wide = x.astype(np.float64)
    hit = 0
    assert set(got) == {int(i) for i in ok if i % 20 == 0}
    for q, found in got.items():
        found.sort()
        assert [r for r, _, _ in found] == list(range(1, 21)) and q not in [v for _, v, _ in found]
        score = wide @ wide[q]
        assert all(abs(s - score[v]) < 1e-9 for _, v, s in found)
        assert [(-s, v) for _, v, s in found] == sorted((-s, v) for _, v, s in found)
        others = ok[ok != q]
        hit += len(set(others[np.lexsort((others, -score[others]))[:20]].tolist()) & {v for _, v, _ in found})
    assert hit / (20 * len(got)) >= 0.9


def test_neighbours_without_clusters(spark):
    """Unit vectors in all directions of 64 dimensions, as the given tables have: the hard case of a neighbour graph."""
    x = np.random.default_rng(3).normal(size=(8000, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>")
    score = x[::20] @ x.T
    score[np.arange(400), np.arange(0, 8000, 20)] = -2
    want = np.argsort(-score, axis=1)[:, :20]
    got = {}
    for r in neighbours.nearest(table, k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    assert np.mean([len(got[20 * i] & set(want[i].tolist())) / 20 for i in range(400)]) >= 0.9


@pytest.mark.parametrize("lengths", ["outlier", "log-normal"])
def test_vectors_of_uneven_length(spark, lengths):
    """One vector a hundred thousand times longer than the others, and lengths that differ by orders of magnitude."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(1500, 32))
    x /= np.linalg.norm(x, axis=1)[:, None]
    if lengths == "outlier":
        x[77] *= 1e5
    else:
        x *= np.exp(rng.normal(0, 2, 1500))[:, None]
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>")
    got = {}
    for r in neighbours.nearest(table, k=20).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    score = x[::20] @ x.T
    score[np.arange(75), np.arange(0, 1500, 20)] = -np.inf
    want = np.argsort(-score, axis=1)[:, :20]
    assert np.mean([len(got[20 * i] & set(want[i].tolist())) / 20 for i in range(75)]) >= 0.9


def test_scan_in_blocks(spark):
    rng = np.random.default_rng(5)
    x = rng.integers(-3, 4, (700, 5)).astype(float)
    nodes = spark.createDataFrame(list(enumerate(x.tolist())), "node bigint, vec array<double>").repartition(3)
    queries = nodes.where("node % 10 = 0").withColumnRenamed("node", "query")
    got = {}
    for r in neighbours.scan_all(nodes, queries, 6, block_bytes=400).collect():
        got.setdefault(r.query, []).append(x[r.query] @ x[r.node])
    for q, s in got.items():
        assert sorted(s, reverse=True) == np.sort(x @ x[q])[::-1][:6].tolist()
    assert len(got) == 70


def test_few_and_no_vectors(spark):
    kind = "vec_id bigint, embedding array<double>"
    assert neighbours.nearest(spark.createDataFrame([], kind)).collect() == []
    assert neighbours.nearest(spark.createDataFrame([(20, [1.0, 2.0])], kind)).collect() == []
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [3.0, 0.0]), (3, None)], kind)
    got = neighbours.nearest(few).orderBy("rank").collect()
    assert [(r.query_id, r.rank, r.vec_id, r.score) for r in got] == [(0, 1, 2, 3.0), (0, 2, 1, 1.0)]


def test_other_queries(spark):
    few = spark.createDataFrame([(i, [float(i), 1.0]) for i in range(30)], "vec_id bigint, embedding array<double>")
    got = neighbours.nearest(few, is_query=F.col("id") == 3, k=2).orderBy("rank").collect()
    assert [(r.query_id, r.vec_id) for r in got] == [(3, 29), (3, 28)]


def test_search_rounds_shuffle_little(spark, monkeypatch):
    """A round of the search deals its pairs three times and shuffles neither lists nor vectors; few queries are searched for once."""
    plans, stage = {}, neighbours.stage_table

    def staged(df, label):
        if label.startswith("search-"):
            plans.setdefault(label, []).append(df._jdf.queryExecution().executedPlan().toString())
        return stage(df, label)

    monkeypatch.setattr(neighbours, "stage_table", staged)
    x = np.random.default_rng(6).normal(size=(600, 8))
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>")
    assert neighbours.nearest(table, k=5).count() == 150
    assert len(plans["search-queries"]) == 1
    assert all(label.split("-")[1].isdigit() or label == "search-queries" for label in plans)
    for label, own in plans.items():
        for plan in own:
            # The queries' vectors may be a fourth.
            assert sum(line.lstrip(" +-:").startswith("Exchange ") for line in plan.splitlines()) <= 4, (label, plan)


def _answers(table, **args):
    got = {}
    for r in neighbours.nearest(table, **args).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    return got


def _true(x, k):
    want = {}
    for q in range(0, len(x), 20):
        score = np.array([x[q] @ v for v in x])
        score[q] = -np.inf
        want[q] = np.lexsort((np.arange(len(x)), -score))[:k].tolist()
    return want


@pytest.mark.parametrize("size", [1.0, 1e140, 1e-140])
def test_few_queries_are_answered_exactly_and_in_few_steps(spark, monkeypatch, size):
    """A scan finds all neighbours, however large the numbers, without rounds that each write a table."""
    labels, stage = [], neighbours.stage_table
    monkeypatch.setattr(neighbours, "stage_table", lambda df, label: (labels.append(label), stage(df, label))[1])
    x = np.random.default_rng(8).normal(size=(2000, 48)) * size
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>")
    assert _answers(table, k=20) == _true(x, 20)
    assert len(labels) <= 8, labels


@pytest.mark.parametrize("kind", ["even", "clusters", "uneven", "hidden"])
def test_many_queries_are_searched_for_in_cells(spark, monkeypatch, kind):
    """Recall holds for any vectors, all queries have all their rows, and only vectors that cells don't help are scanned."""
    monkeypatch.setattr(neighbours, "SCANNED", 100)
    monkeypatch.setattr(neighbours, "COMPARED", 700)
    monkeypatch.setattr(neighbours, "LEARNED", 600)
    rng = np.random.default_rng(9)
    x = rng.normal(size=(6000, 16))
    if kind == "clusters":
        x = rng.normal(size=(30, 16))[rng.integers(0, 30, 6000)] + 0.2 * x
        x[700:760] = x[0]  # a group of copies
    if kind == "uneven":
        x *= np.exp(rng.normal(0, 3, 6000))[:, None]
    if kind == "hidden":  # queries whose guessed bound is too high are answered by a scan
        bounded = neighbours.Space.bounded
        high = F.when(F.col("query") % 600 == 0, 1e9).otherwise(F.col("guess"))
        monkeypatch.setattr(neighbours.Space, "bounded", lambda self, queries, k: bounded(self, queries, k).withColumn("guess", high))
    looks, look = [], neighbours.Space.look
    monkeypatch.setattr(neighbours.Space, "look", lambda self, q, asked, k, b, label, *rest: (looks.append((label, asked)), look(self, q, asked, k, b, label, *rest))[1])
    monkeypatch.setattr(neighbours, "SAMPLED", 60)
    monkeypatch.setattr(neighbours, "BLOCK_BYTES", 150 * 64)  # two passes
    table = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>")
    got, want = _answers(table, k=10), _true(x, 10)
    assert set(got) == set(want) and all(len(set(v)) == 10 and q not in v for q, v in got.items())
    assert np.mean([len(set(got[q]) & set(want[q])) / 10 for q in want]) >= 0.87
    if kind == "hidden":
        assert all(got[q] == want[q] for q in want if q % 600 == 0) and looks[-1] == ("neighbours-scan", 10)
    assert looks[1][0] == "search-0"
    if kind in ("even", "clusters"):
        assert max([asked for label, asked in looks[2:] if label == "neighbours-scan"], default=0) < 30, looks


def test_vectors_of_different_lengths_are_an_error(spark):
    table = spark.createDataFrame([(i, [1.0] * (2 + i % 2)) for i in range(40)], "vec_id bigint, embedding array<double>").repartition(40, "vec_id")
    with pytest.raises(Exception, match="ValueError"):
        neighbours.nearest(table).collect()
