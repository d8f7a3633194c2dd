"""Seeded, exact-size sampling and splitting by hash order.

Rows are ordered by md5(key | seed). The first four hex digits put each row in
one of 65,536 evenly filled buckets, so "the first m rows per class" needs only
counts per bucket plus a ranking of the one bucket where the quota ends. The
outcome is a table with a cut per class: few cuts become an expression and the
split itself a plain filter; many are joined to the rows by class.

Rows without key have their content for a key: a digest, and the number of the
occurrence among equal rows. They spread over the buckets like any other.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from modelwatch.operators.ordered import ROWS_PER_BLOCK, exact_quantiles, with_position
from modelwatch.session import stage_table
from modelwatch.sources.fingerprint import row_digest

PREFIX = 4
BUCKETS = 16**PREFIX
#: Cuts of so many strata may become part of an expression.
LITERAL_STRATA = 1_000
#: The text that orders a row, where it is not simply its key.
OWN = "_own_key"


def key_text(df: DataFrame, key: str) -> Column:
    """What orders the rows: the key as text, or what ``with_own_keys`` gave instead."""
    text = F.col(key).cast("string")
    return F.coalesce(text, F.col(OWN)) if OWN in df.columns else F.coalesce(text, F.lit(""))


def order_hash(text: Column, seed: int) -> Column:
    return F.md5(F.concat(text, F.lit(f"|{seed}")))


def with_own_keys(df: DataFrame, key: str) -> DataFrame:
    """``df``, and where rows have no key, ``OWN`` for those.

    Equal rows are numbered: inside a part of the written rows, after what earlier parts hold of them. Which of them gets
    which number is without effect.
    """
    keyless = df.where(F.col(key).isNull())
    if keyless.isEmpty():
        return df
    rows = stage_table(keyless.withColumns({"_digest": row_digest(df.columns), "_id": F.monotonically_increasing_id()}), "keyless")
    rows = rows.withColumn("_part", F.shiftright("_id", 33))
    sizes = rows.groupBy("_digest", "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = W.partitionBy("_digest").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sizes.select("_digest", "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(W.partitionBy("_digest", "_part").orderBy("_id"))
    numbered = rows.withColumn("_within", within).join(starts, ["_digest", "_part"])
    own = F.concat(F.lit("\0"), "_digest", F.lit("|"), (F.col("_start") + F.col("_within")).cast("string"))
    keyed = df.where(F.col(key).isNotNull()).withColumn(OWN, F.lit(None).cast("string"))
    # Written: the numbers must not change between uses.
    return keyed.unionByName(stage_table(numbered.select(*df.columns, own.alias(OWN)), "own-keys"))


def _stratum(by: str | None) -> Column:
    return F.coalesce(F.col(by).cast("string"), F.lit("")) if by else F.lit("")


@dataclass(frozen=True)
class HashCut:
    """Per stratum, the last (hash, key) inside the quota; strata without quota are absent.

    Rows of one key lie on one side, so a quota that ends between them cannot be
    met: ``hash_cut`` raises then, and only then. ``cuts`` is a table (stratum, h,
    k); ``few`` has its rows where they are few.
    """

    key: str
    seed: int
    by: str | None
    cuts: DataFrame
    few: list[tuple[str, str, str]] | None

    def mark(self, df: DataFrame, out: str) -> DataFrame:
        """``df`` with ``out``: is the row inside its stratum's quota?"""
        text = key_text(df, self.key)
        h = order_hash(text, self.seed)
        if self.few is None:
            own = self.cuts.select(F.col("stratum").alias("_stratum"), F.col("h").alias("_cut_h"), F.col("k").alias("_cut_k"))
            df = df.join(own, _stratum(self.by) == F.col("_stratum"), "left")
            cut_h, cut_k = F.col("_cut_h"), F.col("_cut_k")
        elif not self.few:
            return df.withColumn(out, F.lit(False))
        else:
            cut = F.try_element_at(F.create_map(*[x for s, ch, ck in self.few for x in (F.lit(s), F.struct(F.lit(ch).alias("h"), F.lit(ck).alias("k")))]), _stratum(self.by))
            cut_h, cut_k = cut["h"], cut["k"]
        inside = F.coalesce((h < cut_h) | ((h == cut_h) & (text <= cut_k)), F.lit(False))
        return df.withColumn(out, inside).drop("_stratum", "_cut_h", "_cut_k")


def _keyed(df: DataFrame, key: str, seed: int, by: str | None) -> DataFrame:
    text = key_text(df, key)
    keyed = df.select(_stratum(by).alias("stratum"), order_hash(text, seed).alias("h"), text.alias("k"))
    return keyed.withColumn("bucket", F.substring("h", 1, PREFIX))


def _bucket_rows(keyed: DataFrame) -> DataFrame:
    return keyed.groupBy("stratum", "bucket").agg(F.count(F.lit(1)).alias("rows"))


def _placed(counts: DataFrame) -> DataFrame:
    """Rows per (stratum, bucket) with the number of rows before and in the stratum."""
    run = W.partitionBy("stratum").orderBy("bucket").rowsBetween(W.unboundedPreceding, W.currentRow)
    return counts.select(
        "*",
        (F.sum("rows").over(run) - F.col("rows")).alias("start"),
        F.sum("rows").over(W.partitionBy("stratum")).alias("n"),
    )


def hash_cut(
    df: DataFrame, key: str, quota: Callable[[DataFrame], DataFrame], seed: int, by: str | None = None
) -> HashCut:
    """Cut that takes a quota of rows per stratum.

    ``quota`` turns stratum sizes (stratum, n) into (stratum, quota).
    """
    keyed = _keyed(df, key, seed, by)
    counts = stage_table(_bucket_rows(keyed), "bucket-rows")
    sizes = counts.groupBy("stratum").agg(F.sum("rows").alias("n"))
    placed = _placed(counts).join(quota(sizes).select("stratum", F.col("quota").alias("_q")), "stratum")
    placed = placed.withColumn("quota", F.least("_q", "n"))
    ends_here = (F.col("start") < F.col("quota")) & (F.col("quota") <= F.col("start") + F.col("rows"))
    edges = placed.where(ends_here).select("stratum", "bucket", (F.col("quota") - F.col("start")).alias("rank"))
    # One bucket per stratum is left: 1 / 65,536 of its rows.
    near = keyed.join(edges, ["stratum", "bucket"])
    in_order = W.partitionBy("stratum", "bucket").orderBy("h", "k")
    ranked = near.withColumn("rn", F.row_number().over(in_order)).withColumn("next", F.lead("k").over(in_order))
    last = ranked.where(F.col("rn") == F.col("rank"))
    cuts = stage_table(last.select("stratum", "h", "k", F.coalesce(F.col("next") == F.col("k"), F.lit(False)).alias("shared")), "cuts")
    if not cuts.where("shared").isEmpty():
        raise ValueError(f"rows that share a {key} stand where the quota ends: no exact sample")
    few = cuts.select("stratum", "h", "k").limit(LITERAL_STRATA + 1).collect()
    return HashCut(key, seed, by, cuts, [tuple(r) for r in few] if len(few) <= LITERAL_STRATA else None)


def largest_remainder(sizes: DataFrame, fraction: float) -> DataFrame:
    """ceil(fraction * total) places shared out over the strata by largest remainder.

    The total is one aggregate; only the strata's order by remainder needs all of them, and that is a range shuffle.
    """
    rows = sizes.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("strata")).first()
    all_rows, strata = rows["rows"] or 0, rows["strata"]
    total = F.ceil(F.round(F.lit(fraction) * F.lit(all_rows), 9))
    exact = F.col("n") * total / F.lit(all_rows)
    shared = sizes.withColumn("exact", exact)
    base = shared.withColumn("base", F.floor("exact")).withColumn("rest", F.round(F.col("exact") - F.col("base"), 9))
    order = [F.col("rest").desc(), F.col("stratum")]
    left = total - F.lit(base.agg(F.sum("base")).first()[0] or 0)
    if strata <= LITERAL_STRATA:
        placed = base.withColumn("position", F.row_number().over(W.orderBy(*order)) - 1)
    else:
        placed = with_position(base, order)
    return placed.select("stratum", (F.col("base") + (F.col("position") < left).cast("int")).alias("quota"))


def stratified_split(df: DataFrame, key: str, label: str, fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """Add ``split``: exactly ceil(fraction * n) rows are 'test', proportionally per class."""
    df = with_own_keys(df, key)
    cut = hash_cut(df, key, lambda sizes: largest_remainder(sizes, fraction), seed, label)
    marked = cut.mark(df, "_inside").withColumn("split", F.when(F.col("_inside"), "test").otherwise("train"))
    return marked.drop("_inside", OWN)


def sample_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the same ones for the same data and seed."""
    df = with_own_keys(df, key)
    cut = hash_cut(df, key, lambda sizes: sizes.select("stratum", F.least(F.lit(n), "n").alias("quota")), seed)
    return cut.mark(df, "_inside").where("_inside").drop("_inside", OWN)


def flag_fraction_where(df: DataFrame, key: str, where: Column, fraction: float, seed: int = 42) -> DataFrame:
    """Add ``chosen``: true for floor(fraction * count) of the rows that satisfy ``where``."""

    def share(sizes: DataFrame) -> DataFrame:
        return sizes.select("stratum", F.floor(F.round(F.col("n") * fraction, 9)).alias("quota"))

    df = with_own_keys(df, key)
    cut = hash_cut(df.where(where), key, share, seed)
    marked = cut.mark(df, "_inside")
    return marked.withColumn("chosen", F.coalesce(where, F.lit(False)) & F.col("_inside")).drop("_inside", OWN)


def stratified_folds(df: DataFrame, key: str, label: str, k: int = 5, seed: int = 42) -> DataFrame:
    """Add ``fold`` 0..k-1: classes are dealt out evenly in hash order."""
    ranked = _with_rank(with_own_keys(df, key), key, seed, label)
    return ranked.withColumn("fold", (F.col("_rank") % k).cast("int")).drop("_rank", OWN)


def _with_rank(df: DataFrame, key: str, seed: int, by: str) -> DataFrame:
    """Rows with their hash rank inside the stratum; rows travel once, to their own bucket."""
    text = key_text(df, key)
    h = order_hash(text, seed)
    marked = df.select(
        "*", _stratum(by).alias("stratum"), h.alias("_h"), text.alias("_k"), F.substring(h, 1, PREFIX).alias("bucket")
    )
    within = F.row_number().over(W.partitionBy("stratum", "bucket").orderBy("_h", "_k"))
    offsets = _placed(_bucket_rows(_keyed(df, key, seed, by))).select("stratum", "bucket", "start")
    return (
        marked.withColumn("_rn", within)
        .join(offsets, ["stratum", "bucket"])
        .withColumn("_rank", F.col("start") + F.col("_rn") - 1)
        .drop("stratum", "bucket", "start", "_h", "_k", "_rn")
    )


def sample_with_replacement(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``n`` draws; adds ``draw`` 0..n-1. Keys must be unique and not NULL.

    Draw i takes the row at hash-order position md5(i | seed) mod N. Counts per
    bucket, 65,536 at most, tell the bucket and the place in it; only rows of
    drawn buckets are moved and ranked, and a repeated key among them is an error.
    """
    if not df.where(F.col(key).isNull()).isEmpty():
        raise ValueError(f"{key} is repeated or missing: NULL")
    keyed = df.withColumn("_h", order_hash(F.col(key).cast("string"), seed))
    keyed = keyed.withColumn("_bucket", F.conv(F.substring("_h", 1, PREFIX), 16, 10).cast("int"))
    filled = keyed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("n")).orderBy("_bucket").collect()
    size = sum(r["n"] for r in filled)
    if not size:
        raise ValueError("there is no row to draw")
    starts, at = [], 0
    for r in filled:
        starts.append(at)
        at += r["n"]
    word = F.conv(F.substring(F.md5(F.concat(F.col("id").cast("string"), F.lit(f"|{seed}"))), 1, 15), 16, 10)
    draws = df.sparkSession.range(n).select(
        F.col("id").alias("draw"), F.pmod(word.cast("bigint"), F.lit(size)).alias("_rank")
    )
    # Which bucket: a binary search over their starts; up to 2^53 rows a double has them exactly.
    number = Bucketizer(splits=[-1.0, *map(float, starts), float(size)], inputCol="_place", outputCol="_index")
    draws = number.transform(draws.withColumn("_place", F.col("_rank").cast("double"))).drop("_place")
    known = [(i + 1.0, r["_bucket"], s) for i, (r, s) in enumerate(zip(filled, starts, strict=True))]
    index = df.sparkSession.createDataFrame(known, "_index double, _bucket int, _start bigint")
    draws = draws.join(F.broadcast(index), "_index").select("draw", "_bucket", (F.col("_rank") - F.col("_start")).alias("_rank"))
    drawn = draws.select("_bucket").distinct()
    near = keyed.join(F.broadcast(drawn), "_bucket", "left_semi")
    in_order = W.partitionBy("_bucket").orderBy("_h", F.col(key).cast("string"))
    text = F.col(key).cast("string")
    wrong = F.raise_error(F.concat(F.lit(f"{key} is repeated or missing: "), text)).cast("bigint")
    place = F.when(F.lag(text).over(in_order) == text, wrong).otherwise(F.row_number().over(in_order) - 1)
    return draws.join(near.withColumn("_rank", place), ["_bucket", "_rank"]).select(*df.columns, "draw")


def upper_slice(df: DataFrame, cutoffs: dict[str, float], fallback: str, rows_per_block: int = ROWS_PER_BLOCK) -> DataFrame:
    """Rows at or above a quantile in every column; if there are none, rows with ``fallback`` present."""
    cols = list(cutoffs)
    marks = exact_quantiles(df, cols, sorted(set(cutoffs.values())), rows_per_block=rows_per_block)
    index = {p: i for i, p in enumerate(sorted(set(cutoffs.values())))}
    edge = marks.agg(
        F.struct(*[F.max(F.when(F.col("column") == c, F.col(f"q{index[p]}"))).alias(c) for c, p in cutoffs.items()])
    ).scalar()
    eligible = F.lit(True)
    for c in cols:
        # A column without any value sets no condition.
        passes = F.col(c) >= edge.getField(c)
        eligible = eligible & F.coalesce(passes, edge.getField(c).isNull())
    eligible = eligible & F.col(fallback).isNotNull()
    found = df.agg(F.coalesce(F.bool_or(eligible), F.lit(False))).scalar()
    return df.where(eligible | (~found & F.col(fallback).isNotNull()))


def draw_rows(df: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """``n`` rows: without replacement if there are enough, else with."""
    if df.where(F.col(key).isNotNull()).count() >= n:
        return sample_rows(df, key, n, seed)
    return sample_with_replacement(df, key, n, seed).drop("draw")
