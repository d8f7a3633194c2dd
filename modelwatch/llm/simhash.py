"""Near-duplicates by SimHash fingerprints, with candidates from the pigeonring principle."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwatch.llm.common import pick, stage_table, star_components, utf8_slices

#: Fingerprints of one bucket that meet in one piece of work; larger buckets are dealt out by pairs of such blocks.
BLOCK = 2048
#: Shingle hashes whose bits are counted at a time.
HASHES = 1 << 16


def fingerprint(text: bytes, shingle: int, seed: int) -> int:
    """Bits set in over half of the shingles' XXH64; 0 without words."""
    words = text.lower().split()  # bytes: only A-Z and the six ASCII spaces
    if not words:
        return 0
    grams = zip(*(words[k:] for k in range(shingle))) if len(words) >= shingle else [words]
    digest, join = xxhash.xxh64_intdigest, b" ".join
    hashes = np.fromiter((digest(join(g), seed) for g in grams), "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), HASHES):
        part = hashes[at : at + HASHES].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(sum(1 << b for b in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(rows: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``rows`` with fp, a signed 64-bit number, instead of text; 0 for null, empty and blank texts."""
    rest = [c for c in rows.columns if c != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in utf8_slices(batches, "text"):
            fps = np.fromiter((fingerprint((t or "").encode(), shingle, seed) for t in part.column("text").to_pylist()), np.uint64, part.num_rows)
            yield pa.record_batch([*(part.column(c) for c in rest), pa.array(fps.view(np.int64))], [*rest, "fp"])

    return rows.mapInArrow(run, ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in rest) + ", fp bigint")


def _ring(bits: int) -> list[tuple[int, int, int]]:
    """Segments of the ring as (offset, width, width of the next); there are bits + 1 of them."""
    n = bits + 1
    edges = [i * 64 // n for i in range(n + 1)]
    width = [b - a for a, b in zip(edges, edges[1:])]
    return [(edges[i], width[i], width[(i + 1) % n]) for i in range(n)]


def _rotated(fp: str, by: int):
    if not by:
        return F.col(fp)
    return F.shiftleft(fp, by).bitwiseOR(F.shiftrightunsigned(fp, 64 - by))


def chain_keys(fps: DataFrame, bits: int) -> DataFrame:
    """(key, tag, fp): buckets in which any two fingerprints that differ in ``bits`` bits or fewer meet.

    Pigeonring: cut into bits + 1 segments on a ring, some segment starts a chain whose first l segments differ in
    floor(l * bits / (bits + 1)) bits or fewer, for every l. So the first is equal and the second differs in one bit at
    most, which leaves one of its halves equal: the key holds the first segment and one half of the second.
    """
    keys = []
    for tag, (offset, width, following) in enumerate(_ring(bits)):
        turned = _rotated("fp", offset)
        half = following // 2
        for part, skip, length in ((0, 0, half), (1, half, following - half)) if bits else ((0, 0, 0),):
            first = F.shiftrightunsigned(turned, 64 - width) if width < 64 else turned
            rest = F.shiftrightunsigned(F.shiftleft(turned, width + skip), 64 - length) if length else F.lit(0).cast("long")
            keys.append(F.struct(F.xxhash64(F.lit(2 * tag + part), first, rest).alias("key"), F.lit(tag).alias("tag")))
    return fps.select(F.explode(F.array(*keys)).alias("k"), "fp").select("k.key", "k.tag", "fp")


def _chained(x: np.ndarray, tag: np.ndarray, bits: int) -> np.ndarray:
    """Whether differences ``x`` keep the budget of every chain that starts at the segment ``tag``."""
    ring = _ring(bits)
    keep = np.ones(len(x), bool)
    for at, (offset, _, _) in enumerate(ring):
        own = np.flatnonzero(tag == at)
        if not len(own):
            continue
        turned = x[own] << np.uint64(offset) | (x[own] >> np.uint64(64 - offset) if offset else np.uint64(0))
        ok, length = np.ones(len(own), bool), 0
        for k in range(len(ring)):  # the last chain is the whole ring: the full distance
            length += ring[(at + k) % len(ring)][1]
            seen = turned >> np.uint64(64 - length)
            ok[ok] = np.bitwise_count(seen[ok]) <= (k + 1) * bits // len(ring)
        keep[own] = ok
    return keep


def _linked(group: np.ndarray, side: np.ndarray, tag: np.ndarray, fp: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges of a spanning forest of the links within each group (rows sorted by group).

    side is 0 or 1 in a group of two blocks, whose rows meet across only, and -1 where all rows meet.
    """
    n = len(fp)
    label = np.arange(n)
    ends = np.searchsorted(group, group, "right")
    rows, step = np.arange(n), 0
    while True:
        step += 1
        rows = rows[rows + step < ends[rows]]
        if not len(rows):
            break
        other = rows + step
        meet = (side[rows] < 0) | (side[rows] != side[other])
        a, b = rows[meet], other[meet]
        open_ = label[a] != label[b]
        a, b = a[open_], b[open_]
        if not len(a):
            continue
        near = _chained(fp[a] ^ fp[b], tag[a], bits)
        a, b = a[near], b[near]
        while len(a):
            low = np.minimum(label[a], label[b])
            np.minimum.at(label, label[a], low)
            np.minimum.at(label, label[b], low)
            label = label[label]
            while (label[label] != label).any():
                label = label[label]
            split = label[a] != label[b]
            a, b = a[split], b[split]
    joined = np.flatnonzero(label != np.arange(n))
    return fp[joined], fp[label[joined]]


def links(fps: DataFrame, bits: int = 3) -> DataFrame:
    """(u, v): edges between distinct fingerprints ``fps(fp)`` that connect the same ones as all links of ``bits`` or fewer.

    Buckets over ``BLOCK`` rows are dealt out as pairs of blocks; each piece of work returns a spanning forest, so a
    dense bucket never returns its pairs.
    """
    keys = stage_table(chain_keys(fps, bits), "simhash-keys")
    hot = keys.groupBy("key").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")).where("blocks > 1")
    dealt = (
        keys.join(hot, "key", "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("own", F.pmod(F.xxhash64("fp", "key"), F.col("blocks")).cast("int"))
        .select("key", "tag", "fp", "own", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
        .select("key", F.least("own", "other").alias("p"), F.greatest("own", "other").alias("q"), "own", "tag", "fp")
        .withColumn("side", F.expr("IF(p = q, -1, IF(own = p, 0, 1))"))
        .withColumn("piece", F.xxhash64("key", "p", "q"))
        .select("piece", "side", "tag", "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []

        def out(cols: tuple[np.ndarray, ...]) -> Iterator[pa.RecordBatch]:
            u, v = _linked(*cols, bits)
            if len(u):
                yield pa.record_batch([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        for batch in batches:
            piece, side, tag, fp = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("piece", "side", "tag", "fp"))
            held.append((piece, side, tag, fp.view(np.uint64)))
            if not len(piece) or held[0][0][0] == piece[-1]:
                continue
            cols = tuple(np.concatenate(x) for x in zip(*held))
            cut = int(np.flatnonzero(cols[0] != cols[0][-1])[-1]) + 1
            yield from out(tuple(x[:cut] for x in cols))
            held = [tuple(x[cut:] for x in cols)]
        if held:
            yield from out(tuple(np.concatenate(x) for x in zip(*held)))

    return dealt.repartition("piece").sortWithinPartitions("piece").mapInArrow(run, "u bigint, v bigint")


def _grouped(rows: DataFrame, shingle: int, bits: int, seed: int) -> DataFrame:
    """Rows without text, with fp, component_id and group_key (the same for all rows of a component)."""
    own = stage_table(fingerprints(rows, shingle, seed), "simhash-docs")
    fps = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    roots = star_components(links(fps.select("fp"), bits), "simhash")
    fps = fps.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("group_key", F.coalesce("root", "fp"))
    groups = fps.groupBy("group_key").agg(F.min("least").alias("component_id"))
    return own.join(fps.select("fp", "group_key").join(groups, "group_key"), "fp")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 3, seed: int = 42) -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased in A-Z and cut into words at ASCII white space; a fingerprint bit is set if it is set in over
    half of the XXH64 of the ``shingle``-word shingles, repeats included. Fingerprints that differ in ``bits`` bits or
    fewer are linked; component_id is the smallest doc_id of the connected component.

    Null, empty and blank texts have fingerprint 0 and are linked like others. A row without doc_id takes part through
    its fingerprint; component_id is null where no row of the component has one. Repeated rows come back repeated. An
    empty table gives no rows.
    """
    rows = _grouped(pick(docs, doc_id=doc_id, text=text), shingle, bits, seed)
    return rows.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = 3, bits: int = 3, seed: int = 42) -> DataFrame:
    """``docs`` with one row of each component of ``near_duplicates``: the one with the smallest doc_id.

    Of several rows with that id the one with the smallest hash over all columns stays, once. A row without id stays
    only if no row of its component has one.
    """
    # Maps have no hash, but a text.
    cells = [F.to_json(F.struct(docs[f.name])) if "map<" in f.dataType.simpleString() else docs[f.name] for f in docs.schema]
    whole = docs.select(
        docs[doc_id].alias("doc_id"), docs[text].alias("text"), F.xxhash64(*cells).alias("row1"), F.xxhash64(F.lit(1), *cells).alias("row2"),
        F.struct(*[docs[c] for c in docs.columns]).alias("rest"),
    )
    groups = _grouped(whole.drop("rest"), shingle, bits, seed).groupBy("group_key")
    first = groups.agg(F.min(F.struct(F.col("doc_id").isNull().alias("bare"), "doc_id", "row1", "row2")).alias("s")).select("s.row1", "s.row2")
    kept = whole.select("row1", "row2", "rest").join(first, ["row1", "row2"], "left_semi")
    once = kept.dropDuplicates(["row1", "row2"])
    return once.select(*[F.col("rest").getField(c).alias(c) for c in docs.columns])
