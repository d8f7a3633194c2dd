"""Nearest neighbours among the rows of one table, for oversampling.

Equal points are one point with a number of copies; a point is its own neighbour through its other copies.

*Exact search* sorts the points along a unit direction u into blocks of bounded size. Since |u.x - u.y| <= |x - y|, a
point whose k-th candidate is r away only has to visit blocks closer than r along u. That prunes well in few dimensions
and not at all in many. Blocks that reach few others are shuffled to them; else points are written in packs, and tasks
read the packs that meet, so that what is shuffled grows with the points although the comparisons are all pairs.

*Hashed search* is for many dimensions. In each of several tables a point's key is the sides it takes of random
hyperplanes; it is compared with the points of its own bucket and of the buckets behind the hyperplanes that it lies
closest to. Distances of all candidates are exact. Buckets are bounded, so the work of a table grows with the points;
tables are added until a sample, compared with all points, finds the wanted share of its true neighbours. Where more
tables would compare more pairs than there are, the exact search answers.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from modelwatch.operators.ordered import with_position
from modelwatch.session import stage_table

BLOCK_POINTS = 2048
#: Blocks of one span; the ends of the spans, few, are what a task knows of all points.
SPAN_BLOCKS = 1024
CELLS = 1 << 23
#: Where a block reaches more blocks than this on average, packs of points meet without a shuffle; points of a pack, and hosts compared at once.
MANY_BLOCKS, PACK_POINTS, HOST_POINTS = 8, 2048, 16384

BUCKET_POINTS = 256
TABLES, PROBES = 8, 4
SAMPLE_POINTS, SPLIT_POINTS = 256, 4096
#: Hyperplanes beyond those that the number of points asks for; they divide overfull buckets.
SPARE_BITS = 12
BROADCAST_KEYS = 100_000

NEAR = "d array<double>, nid array<bigint>, copies array<bigint>"


def _main_direction(points: DataFrame) -> list[float]:
    """The direction of largest variance spreads the blocks best; any unit vector is correct."""
    fitted = PCA(k=1, inputCol="v", outputCol="_pc").fit(points.select(array_to_vector("x").alias("v")))
    u = fitted.pc.toArray()[:, 0]
    size = float(np.linalg.norm(u))
    return [float(a) / size for a in u] if size > 0 else [1.0] + [0.0] * (len(u) - 1)


def _dot(x: str, u: list[float]) -> Column:
    products = F.zip_with(x, F.array(*[F.lit(a) for a in u]), lambda a, b: a * b)
    return F.aggregate(products, F.lit(0.0), lambda total, a: total + a)


def _closest(
    x: np.ndarray, ids: np.ndarray, y: np.ndarray, y_ids: np.ndarray, y_copies: np.ndarray, k: int
) -> Iterator[tuple[list[float], list[int], list[int]]]:
    """Per row of x: distances, ids and copies of the nearest points until k copies are reached.

    Products of matrices choose: all points that rounding could let be among the first. Their distances are exact.
    """
    xx, yy = (x * x).sum(axis=1), (y * y).sum(axis=1)
    slack = 16 * x.shape[1] * np.finfo(float).eps * (xx + yy.max())
    step = max(1, CELLS // max(1, len(y)))
    for at in range(0, len(x), step):
        part = x[at : at + step]
        squares = xx[at : at + step, None] + yy[None, :] - 2 * (part @ y.T)
        # k + 1 points always hold k copies besides the point itself.
        last = np.partition(squares, k, axis=1)[:, k] if len(y) > k + 1 else np.full(len(part), np.inf)
        likely = squares <= (last + 2 * slack[at : at + step])[:, None]
        for row, keep, own in zip(part, likely, ids[at : at + step]):
            near = np.flatnonzero(keep)
            gaps = np.sqrt(((y[near] - row) ** 2).sum(axis=1))
            order = np.lexsort((y_ids[near], gaps))
            near, gaps = near[order], gaps[order]
            copies = y_copies[near] - (y_ids[near] == own)
            keep = (copies > 0) & (np.cumsum(copies) - copies < k)
            yield gaps[keep].tolist(), y_ids[near][keep].tolist(), copies[keep].tolist()


def _as_rows(near: DataFrame) -> DataFrame:
    zipped = F.explode(F.arrays_zip("d", "nid", "copies"))
    return near.select("id", zipped.alias("n")).select("id", "n.d", "n.nid", "n.copies")


def _first_copies(rows: DataFrame, k: int) -> DataFrame:
    """(id, nid, d, copies, start): neighbours in order of distance; ``start`` copies come before, fewer than k."""
    before = W.partitionBy("id").orderBy("d", "nid").rowsBetween(W.unboundedPreceding, -1)
    counted = rows.withColumn("start", F.coalesce(F.sum("copies").over(before), F.lit(0)))
    return counted.where(F.col("start") < k).select("id", "nid", "d", "copies", "start")


def blocked_points(df: DataFrame, features: str, block_points: int = BLOCK_POINTS) -> DataFrame:
    """Distinct points with their copies, numbered from 0 and blocked along the main direction."""
    points = (
        df.select(F.col(features).cast("array<double>").alias("x"))
        .groupBy("x")
        .agg(F.count(F.lit(1)).alias("copies"))
    )
    points = stage_table(points, "points")
    placed = with_position(points.withColumn("p", _dot("x", _main_direction(points))), ["p", "x"], "id")
    return stage_table(placed.select("id", "x", "copies", "p", F.floor(F.col("id") / block_points).alias("block")), "blocks")


def exact_neighbours(blocks: DataFrame, k: int) -> DataFrame:
    """All true neighbours of ``blocked_points``, as in ``_first_copies``."""

    def at_home(pdf: pd.DataFrame) -> pd.DataFrame:
        x, ids, copies = np.stack(pdf["x"].to_numpy()), pdf["id"].to_numpy(), pdf["copies"].to_numpy()
        near = pd.DataFrame(list(_closest(x, ids, x, ids, copies, k)), columns=["d", "nid", "copies"])
        # Strictly closer points only: a slack covers rounding of the projections.
        radius = [(d[-1] * (1 + 1e-9) + 1e-12 if d[-1] > 0 else -1.0) if sum(c) >= k else math.inf for d, _, c in near.itertuples(index=False)]
        return near.assign(id=ids, x=pdf["x"].to_numpy(), own=copies, p=pdf["p"].to_numpy(), radius=radius, home=pdf["block"].to_numpy())

    home = stage_table(
        blocks.groupBy("block").applyInPandas(at_home, f"{NEAR}, id bigint, x array<double>, own bigint, p double, radius double, home bigint"),
        "near",
    )
    # Which blocks reach which: blocks meet by spans of blocks, the few ends of which are an expression.
    span = F.floor(F.col("home") / SPAN_BLOCKS)
    ends = home.groupBy("home").agg(
        F.min("p").alias("lo"), F.max("p").alias("hi"), F.min(F.col("p") - F.col("radius")).alias("from"), F.max(F.col("p") + F.col("radius")).alias("to")
    )
    ends = stage_table(ends.withColumn("span", span), "block-ends")
    spans = ends.groupBy("span").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect()
    known = F.array(*[F.struct(F.lit(s["span"]).alias("span"), F.lit(s["lo"]).alias("lo"), F.lit(s["hi"]).alias("hi")) for s in spans])
    reached = F.filter(known, lambda s: (s["lo"] <= F.col("to")) & (s["hi"] >= F.col("from")))
    asks = ends.select(F.col("home").alias("guest"), "from", "to", F.explode(F.transform(reached, lambda s: s["span"])).alias("span"))
    hosts = ends.select(F.col("home").alias("host"), "span", "lo", "hi")
    meet = (F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from")) & (F.col("guest") != F.col("host"))
    pairs = asks.join(hosts, "span").where(meet).select("guest", "host", "lo", "hi")
    if pairs.count() > MANY_BLOCKS * ends.count():
        return _first_copies(_as_rows(_met_in_packs(home, k)), k)
    pairs = stage_table(pairs, "block-pairs")
    visits = home.select("id", "x", "p", "radius", F.col("home").alias("guest")).join(pairs, "guest")
    visits = visits.where((F.col("lo") <= F.col("p") + F.col("radius")) & (F.col("hi") >= F.col("p") - F.col("radius")))
    points = blocks.select(F.col("block").alias("host"), "id", "x", "copies").join(pairs.select("guest", "host"), "host")

    def on_visit(guests: pd.DataFrame, points: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(guests) and len(points):
            x, y = np.stack(guests["x"].to_numpy()), np.stack(points["x"].to_numpy())
            found = list(_closest(x, guests["id"].to_numpy(), y, points["id"].to_numpy(), points["copies"].to_numpy(), k))
        return pd.DataFrame(found, columns=["d", "nid", "copies"]).assign(id=guests["id"].to_numpy()[: len(found)])

    away = (
        visits.select("guest", "host", "id", "x")
        .groupBy("guest", "host")
        .cogroup(points.groupBy("guest", "host"))
        .applyInPandas(on_visit, f"{NEAR}, id bigint")
    )
    return _first_copies(_as_rows(home).unionByName(_as_rows(away)), k)


def _met_in_packs(home: DataFrame, k: int) -> DataFrame:
    """(id, d, nid, copies), as lists: the nearest of each point among the points of a task, all points being met in some task.

    ``home`` has the points with a radius that holds their neighbours. Two packs meet by a product of partitions, which
    reads the written packs and shuffles none; a task keeps the first k copies of each point.
    """

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("id")
        p, radius = pdf["p"].to_numpy(), pdf["radius"].to_numpy()
        row = {c: pdf[c].to_numpy().tobytes() for c in ("id", "own", "p", "radius")} | {"x": np.stack(pdf["x"].to_numpy()).tobytes()}
        return pd.DataFrame([row | {"pack": pdf["pack"].iloc[0], "lo": p.min(), "hi": p.max(), "from": (p - radius).min(), "to": (p + radius).max()}])

    kind = "pack bigint, id binary, own binary, p binary, radius binary, x binary, lo double, hi double, from double, to double"
    points = home.select(F.floor(F.col("id") / PACK_POINTS).alias("pack"), "id", "own", "p", "radius", "x")
    packs = stage_table(points.groupBy("pack").applyInPandas(pack, kind), "packs")
    guests = packs.select(F.col("pack").alias("guest"), F.col("id").alias("guests"), F.col("p").alias("at"), "radius", F.col("x").alias("gx"), "from", "to")
    hosts = packs.select(F.col("pack").alias("host"), "id", "own", "x", "lo", "hi")
    reach = (F.col("guest") == F.col("host")) | (F.col("lo") <= F.col("to")) & (F.col("hi") >= F.col("from"))
    meet = guests.hint("shuffle_replicate_nl").join(hosts, reach)

    def merge(a: tuple | None, b: tuple) -> tuple:
        if a is None:
            return b
        kept, copies = [], 0
        for row in sorted([*zip(*a), *zip(*b)]):
            kept.append(row)
            copies += row[2]
            if copies >= k:
                break
        return tuple(map(list, zip(*kept))) if kept else a

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, x, at, radius, found, held, visits = None, None, None, None, None, [], [], None

        def compare() -> None:
            if held and visits.any():
                who = np.flatnonzero(visits)
                near = _closest(x[who], ids[who], *(np.concatenate(c) for c in zip(*held)), k)
                for i, own in zip(who.tolist(), near):
                    found[i] = merge(found[i], own)
            held.clear()

        def out() -> pa.RecordBatch:
            who = [i for i, f in enumerate(found) if f is not None]
            lists = [pa.array([found[i][c] for i in who], pa.list_(t)) for c, t in enumerate((pa.float64(), pa.int64(), pa.int64()))]
            return pa.record_batch([pa.array(ids[who], pa.int64()), *lists], ["id", "d", "nid", "copies"])

        for batch in batches:
            for i in range(batch.num_rows):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                if row["guest"].as_py() != now:
                    if now is not None:
                        compare()
                        yield out()
                    now = row["guest"].as_py()
                    ids = np.frombuffer(row["guests"].as_py(), np.int64)
                    x, at, radius = (np.frombuffer(row[c].as_py(), np.float64) for c in ("gx", "at", "radius"))
                    x, found, visits = x.reshape(len(ids), -1), [None] * len(ids), np.zeros(len(ids), bool)
                if not held:
                    visits = np.zeros(len(ids), bool)
                host, copies = (np.frombuffer(row[c].as_py(), np.int64) for c in ("id", "own"))
                visits |= (row["host"].as_py() == now) | (row["lo"].as_py() <= at + radius) & (row["hi"].as_py() >= at - radius)
                held.append((np.frombuffer(row["x"].as_py(), np.float64).reshape(len(host), -1), host, copies))
                if sum(len(h[1]) for h in held) >= HOST_POINTS:
                    compare()
        if now is not None:
            compare()
            yield out()

    columns = ["guest", "guests", "at", "radius", "gx", "host", "id", "own", "x", "lo", "hi"]
    return meet.select(*columns).mapInArrow(run, "id bigint, d array<double>, nid array<bigint>, copies array<bigint>")


def _planes(points: DataFrame, tables: range, bits: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Directions (table, bit, dimension), and offsets that halve a bounded sample."""
    sample = points.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SPLIT_POINTS).select("x").toPandas()["x"]
    sample = np.stack(sample.to_numpy())
    drawn = [np.random.default_rng([seed, t]).standard_normal((bits, sample.shape[1])) for t in tables]
    directions = np.stack(drawn)
    return directions, np.median(np.einsum("nd,tbd->tbn", sample, directions), axis=2)


def _keyed(points: DataFrame, tables: range, bits: int, planes: tuple[np.ndarray, np.ndarray], probes: int) -> DataFrame:
    """(table, code, host, id, copies, x): every point under its own key, as host, and under those next to it."""
    directions, offsets = planes
    width = directions.shape[1]
    powers = 1 << np.arange(width - 1, -1, -1, dtype=np.int64)

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column(2).flatten().to_numpy().reshape(batch.num_rows, -1)
            for t, table in enumerate(tables):
                away = x @ directions[t].T - offsets[t]
                code = (away > 0) @ powers
                # The keys that differ where a hyperplane is nearest, for its length.
                order = np.argsort(np.abs(away[:, :bits]) / np.linalg.norm(directions[t, :bits], axis=1), axis=1)[:, :probes]
                codes = np.hstack([code[:, None], code[:, None] ^ powers[order]])
                each = pa.array(np.repeat(np.arange(len(x)), codes.shape[1]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.full(codes.size, table, np.int32)),
                        pa.array(codes.ravel()),
                        pa.array(np.tile(np.arange(codes.shape[1]) == 0, len(x))),
                        *[batch.column(i).take(each) for i in range(3)],
                    ],
                    names=["table", "code", "host", "id", "copies", "x"],
                )

    return points.select("id", "copies", "x").mapInArrow(task, "table int, code bigint, host boolean, id bigint, copies bigint, x array<double>")


def _overfull(keyed: DataFrame, keys: list[str], most: int) -> tuple[DataFrame, bool]:
    """Keys with more than ``most`` hosts, and whether there are any; broadcast where the measured number is small."""
    hosts = keyed.where("host").groupBy(*keys).agg(F.count(F.lit(1)).alias("hosts")).where(F.col("hosts") > most)
    staged = stage_table(hosts, "overfull")
    n = staged.count()
    return F.broadcast(staged) if n <= BROADCAST_KEYS else staged, n > 0


def _in_buckets(keyed: DataFrame, bits: int, width: int, bucket_points: int) -> DataFrame:
    """Adds (top, rest, share): the first bits of the key; where these hold too many points, more of them, then shares by id."""
    placed = keyed.withColumns({"top": F.expr(f"shiftright(code, {width - bits})"), "rest": F.lit(0).cast("bigint"), "share": F.lit(0)})
    full, any_full = _overfull(placed, ["table", "top"], 4 * bucket_points)
    if not any_full:
        return placed
    more = F.least(F.lit(width - bits), F.ceil(F.log2(F.col("hosts") / F.lit(float(bucket_points))))).cast("int")
    placed = placed.join(full.withColumn("more", more).drop("hosts"), ["table", "top"], "left")
    placed = placed.withColumn("rest", F.expr(f"coalesce(shiftright(code, {width - bits} - more), 0)")).drop("more")
    full, any_full = _overfull(placed, ["table", "top", "rest"], 4 * bucket_points)
    if not any_full:
        return placed
    shares = F.ceil(F.col("hosts") / F.lit(float(bucket_points))).cast("int")
    placed = placed.join(full.withColumn("shares", shares).drop("hosts"), ["table", "top", "rest"], "left")
    return placed.withColumn("share", F.coalesce(F.pmod(F.xxhash64("id", "table"), F.col("shares")).cast("int"), F.lit(0))).drop("shares")


def _in_tables(points: DataFrame, k: int, tables: range, bits: int, bucket_points: int, probes: int, seed: int) -> DataFrame:
    """Candidates (id, d, nid, copies) that the tables bring together."""
    width = bits + SPARE_BITS
    keyed = _keyed(points, tables, bits, _planes(points, tables, width, seed), min(probes, bits))
    placed = _in_buckets(keyed, bits, width, bucket_points)

    def in_bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        host = pdf["host"].to_numpy()
        x, ids = np.stack(pdf["x"].to_numpy()), pdf["id"].to_numpy()
        found = _closest(x, ids, x[host], ids[host], pdf["copies"].to_numpy()[host], k) if host.any() else ()
        return pd.DataFrame(list(found), columns=["d", "nid", "copies"]).assign(id=ids if host.any() else ids[:0])

    return _as_rows(placed.groupBy("table", "top", "rest", "share").applyInPandas(in_bucket, f"{NEAR}, id bigint"))


def _true_sample(points: DataFrame, k: int, seed: int) -> DataFrame:
    """The true neighbours of a bounded sample: one scan, of which each task returns its first few."""
    sample = points.orderBy(F.xxhash64("id", F.lit(seed + 1)), "id").limit(SAMPLE_POINTS).select("id", "x").toPandas()
    x, ids = np.stack(sample["x"].to_numpy()), sample["id"].to_numpy()

    def task(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for at in range(0, len(pdf), 4096):
                part = pdf[at : at + 4096]
                y = np.stack(part["x"].to_numpy())
                found = _closest(x, ids, y, part["id"].to_numpy(), part["copies"].to_numpy(), k)
                yield pd.DataFrame(list(found), columns=["d", "nid", "copies"]).assign(id=ids)

    rows = points.select("id", "copies", "x").mapInPandas(task, f"{NEAR}, id bigint")
    return stage_table(_first_copies(_as_rows(rows), k), "near-sample")


def hashed_neighbours(
    blocks: DataFrame,
    k: int,
    recall: float = 0.95,
    bucket_points: int = BUCKET_POINTS,
    probes: int = PROBES,
    seed: int = 42,
) -> DataFrame:
    """Neighbours of ``blocked_points``, as in ``_first_copies``: at least the share ``recall`` of a sample's true ones."""
    n = blocks.count()
    bits = max(0, math.ceil(math.log2(max(1, n) / bucket_points)))
    if not bits:
        return exact_neighbours(blocks, k)
    truth, found, done = _true_sample(blocks, k, seed), None, 0
    total = truth.count()
    while True:
        # Every table compares a point with some 2 (1 + probes) buckets' points; doubling keeps the number of rounds low.
        if (done + TABLES) * (1 + probes) * 2 * bucket_points > n:
            return exact_neighbours(blocks, k)
        tables = range(done, max(TABLES, 2 * done))
        rows = _in_tables(blocks, k, tables, bits, bucket_points, probes, seed)
        rows = rows if found is None else rows.unionByName(found.select("id", "d", "nid", "copies"))
        rows = rows.groupBy("id", "nid").agg(F.min("d").alias("d"), F.max("copies").alias("copies"))
        found, done = stage_table(_first_copies(rows, k), "hashed-near"), tables.stop
        if truth.join(found, ["id", "nid"]).count() >= recall * total:
            return found


def nearest_distances(df: DataFrame, features: str, k: int, block_points: int = BLOCK_POINTS) -> DataFrame:
    """(rank, distance) of the k nearest neighbours of every row, copies counted."""
    blocks = blocked_points(df, features, block_points)
    near = exact_neighbours(blocks, k).join(blocks.select("id", F.col("copies").alias("_m")), "id")
    last = F.least(F.col("start") + F.col("copies"), F.lit(k))
    ranked = near.select("_m", "d", F.explode(F.sequence(F.col("start") + 1, last)).alias("rank"))
    return ranked.groupBy("rank", F.col("d").alias("distance")).agg(F.sum("_m").cast("bigint").alias("rows"))
