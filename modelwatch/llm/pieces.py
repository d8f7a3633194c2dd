"""SentencePiece encoding and decoding as a relational lattice over the distinct units of a corpus."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelwatch.llm.common import give_back, pick, text_bytes, utf8_slices
from modelwatch.session import scratch_path

#: The mark that stands for a space.
SPACE = "▁"
#: Bytes of text of a chunk and of a group of chunks that number their units together, about.
CHUNK, GROUP = 4 << 20, 16 << 20
#: Characters of a unit whose lattice fits a 64-bit set of positions.
LONG = 61
#: Units of a partition, about: their edges are sorted in a task's memory.
PART_UNITS = 60_000
#: Pieces of a model: the table is broadcast, so this bounds what is.
MOST = 1 << 20


class Model(NamedTuple):
    """Pieces that text can match as (piece, id, score), the ids of the 256 bytes (or none), all pieces' bytes, and
    whether scores are log probabilities (unigram, Viterbi) or merge ranks (BPE)."""

    pieces: list[tuple[str, int, float]]
    byte_ids: list[int]
    unknown: int
    spelled: list[bytes]
    unigram: bool


def load(path: str, unigram: bool = False) -> Model:
    """Read a model file of the sentencepiece library; the file's text normalisation must be the identity."""
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    n = sp.get_piece_size()
    if n > MOST:
        raise ValueError(f"{n} pieces; {MOST} at most")
    names = [sp.id_to_piece(i) for i in range(n)]
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i) for i in range(n)]
    byte_ids = {int(names[i][3:5], 16): i for i in range(n) if sp.is_byte(i)}
    pieces = [(names[i], i, sp.get_score(i)) for i in range(n) if not special[i] and not sp.is_byte(i)]
    spelled = [b"" if special[i] else bytes([int(names[i][3:5], 16)]) if sp.is_byte(i) else names[i].replace(SPACE, " ").encode() for i in range(n)]
    return Model(pieces, [byte_ids[b] for b in range(256)] if len(byte_ids) == 256 else [], sp.unk_id(), spelled, unigram)


def bigrams(model: Model) -> set[str]:
    """Neighbouring characters within pieces: between any others a text can be cut, as no piece crosses there."""
    return {p[i : i + 2] for p, _, _ in model.pieces for i in range(len(p) - 1)}


def words_of(texts: pa.Array) -> pa.Array:
    """The words of each text, without the mark in front; a run of spaces or marks leaves its others with the word behind.

    Empty and null texts have none.
    """
    empty = pc.fill_null(pc.equal(texts, ""), True).to_numpy(zero_copy_only=False)
    texts = texts.take(pa.array(np.arange(len(texts)), mask=empty))
    texts = pc.replace_substring(texts, SPACE, " ")
    if pc.any(pc.match_substring_regex(texts, "^ |  | $")).as_py():
        # The first space behind another sign is where words part; marks are free to say so.
        return pc.split_pattern(pc.replace_substring_regex(texts, "([^ ]) ", "\\1" + SPACE), SPACE)
    return pc.split_pattern(texts, " ")


def cut(words: pa.Array, inside: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """(units of all words behind one another, how many each), ``inside`` being sorted pairs of neighbours within pieces."""
    data, ends = text_bytes(words)
    signs = np.frombuffer(data.tobytes().decode().encode("utf-32-le"), "<u4").astype(np.int64)
    wide = 1 + (signs > 0x7F) + (signs > 0x7FF) + (signs > 0xFFFF)
    at = np.cumsum(wide) - wide
    first = np.ones(len(signs), bool)
    if len(inside) and len(signs):
        pairs = signs[:-1] << 32 | signs[1:]
        first[1:] = inside[np.minimum(np.searchsorted(inside, pairs), len(inside) - 1)] != pairs
    first[np.searchsorted(at, ends[:-1])] = True
    starts = at[first]
    offsets = np.r_[starts, len(data)].astype(np.int32)
    units = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes()))
    return units, np.diff(np.searchsorted(starts, ends))


def numbered(texts: pa.Array, inside: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct units, the texts as numbers of units behind one another, how many units each text has)."""
    words = words_of(texts)
    every = words.flatten().dictionary_encode()
    units, count = cut(pc.binary_join_element_wise(SPACE, pc.replace_substring(every.dictionary, " ", SPACE), ""), inside)
    units = units.dictionary_encode()
    which = every.indices.to_numpy()
    start, size = (np.cumsum(count) - count)[which], count[which]
    at = np.repeat(start - (np.cumsum(size) - size), size)
    at += np.arange(len(at))
    ends = np.r_[0, np.cumsum(size)][np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy())]
    return units.dictionary, units.indices.to_numpy()[at], np.diff(ends, prepend=0)


def alone(ch: str, model: Model) -> list[int]:
    """Ids of a character that is no piece."""
    return [model.byte_ids[b] for b in ch.encode()] if model.byte_ids else [model.unknown]


def edge_order(piece: str, score: float, tied: set[float]) -> tuple:
    """Sort key of a piece among a unit's edges; edges of one key go from left to right.

    BPE merges the best pair first, the leftmost of equal ones. A piece's parts have better scores than the piece, so
    one pass over the edges in this order does all merges. Pieces that share a score (runs of the space mark) come
    last, longest first, and take their characters at once.
    """
    return (1, 0.0, -len(piece)) if score in tied else (0, -score, 0)


def tied_scores(model: Model) -> set[float]:
    seen, tied = set(), set()
    for p, _, s in model.pieces:
        (tied if s in seen else seen).add(s)
    return tied


def fold_long(unit: str, table: dict[str, tuple[int, float]], tied: set[float], model: Model, longest: int) -> list[int]:
    """Ids of a unit that is too long for a 64-bit set: the same folds, over arrays of positions."""
    n = len(unit)
    edges = [(s, s + k, *table[unit[s : s + k]]) for s in range(n) for k in range(1, min(longest, n - s) + 1) if unit[s : s + k] in table]
    if model.unigram:
        best, back = [0.0] + [-np.inf] * n, [(0, -1)] * (n + 1)
        low = min((s for _, _, s in model.pieces), default=0.0) - 10
        known = {(s, e) for s, e, _, _ in edges}
        edges += [(s, s + 1, -1, low) for s in range(n) if (s, s + 1) not in known]
        for s, e, i, score in sorted(edges, key=lambda x: (x[1], x[0])):
            if best[s] + score > best[e]:
                best[e], back[e] = best[s] + score, (s, i)
        ids, at = [], n
        while at:
            s, i = back[at]
            ids.append([i] if i >= 0 else alone(unit[s:at], model))
            at = s
        return [i for own in reversed(ids) for i in own]
    after = list(range(1, n + 1))  # the next boundary
    on, name = [True] * (n + 1), {}
    for s, e, i, score in edges:
        name[s, e] = i
    ranked = sorted((edge_order(unit[s:e], score, tied), s, e) for s, e, _, score in edges if e - s > 1)
    ties = sorted((s, -e) for key, s, e in ranked if key[0])
    for key, s, e in [r for r in ranked if not r[0][0]] + [((1,), s, -e) for s, e in ties]:
        if on[s] and on[e] and (after[after[s]] == e if not key[0] else all(on[s + 1 : e])):
            for k in range(s + 1, e):
                on[k] = False
            after[s] = e
    ids, at = [], 0
    while at < n:
        ids += [name[at, after[at]]] if (at, after[at]) in name else alone(unit[at : after[at]], model)
        at = after[at]
    return ids


def chunked(docs: DataFrame, model: Model, doc_id: str, text: str, chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """The table of chunks: (chunks, doc_ids, first, units, n_units, long, lengths, numbers), bucketed by ``chunks``, a group.

    units are the distinct units that no earlier chunk of the group has, numbered from ``first`` (null where the unit
    is over ``LONG`` characters; long has those with their places); numbers (compressed) spells each text as a
    sequence of the group's units, and lengths has how many units each text is.
    """
    rows = pick(docs, doc_id=doc_id, text=text)
    inside = np.array(sorted(ord(x) << 32 | ord(y) for x, y in bigrams(model)), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size, whole_size = TaskContext.get().partitionId(), 0, [], 0, 0
        known: dict[str, int] = {}

        def out() -> pa.RecordBatch:
            ids = pa.concat_arrays([x.column("doc_id") for x in held])
            units, numbers, lengths = numbered(pa.concat_arrays([x.column("text") for x in held]), inside)
            first = len(known)
            place = np.array([known.setdefault(u, len(known)) for u in units.to_numpy(zero_copy_only=False)], np.int64)
            numbers, units = place[numbers], units.filter(pa.array(place >= first))
            whole = zstandard.ZstdCompressor(3).compress(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes())
            over = pc.greater(pc.utf8_length(units), LONG).to_numpy(zero_copy_only=False)
            far = [{"place": first + k, "unit": units[k].as_py()} for k in np.flatnonzero(over).tolist()]
            columns = {
                "chunks": pa.array([part << 32 | seq], pa.int64()),
                "doc_ids": pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids),
                "first": pa.array([first], pa.int32()),
                "units": pa.ListArray.from_arrays(pa.array([0, len(units)], pa.int32()), units.take(pa.array(np.arange(len(units)), mask=over))),
                "n_units": pa.array([len(units)], pa.int32()),
                "long": pa.array([far], pa.list_(pa.struct([("place", pa.int32()), ("unit", pa.string())]))),
                "lengths": pa.array([lengths.astype("<u4").tobytes()], pa.binary()),
                "numbers": pa.array([whole], pa.binary()),
            }
            return pa.record_batch(list(columns.values()), list(columns))

        for piece in utf8_slices(batches, "text", min(1 << 20, chunk)):
            held.append(piece)
            size += pc.sum(pc.binary_length(piece.column("text"))).as_py() or 0
            if size >= chunk:
                yield out()
                held, size, whole_size = [], 0, whole_size + size
            if whole_size >= group:
                seq, whole_size = seq + 1, 0
                known.clear()
        if held:
            yield out()

    kind = rows.schema["doc_id"].dataType.simpleString()
    table = rows.mapInArrow(run, f"chunks bigint, doc_ids array<{kind}>, first int, units array<string>, n_units int, long array<struct<place:int,unit:string>>, lengths binary, numbers binary")
    spark, name = docs.sparkSession, f"pieces_{uuid.uuid4().hex}"
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table.write.format("parquet").option("path", scratch_path(spark, name)).option("compression", "zstd").bucketBy(buckets, "chunks").saveAsTable(name)
    return spark.table(name)


def lattice(units: DataFrame, model: Model) -> DataFrame:
    """(unit, edges, places): every substring that is a piece, and every single character; ``units(unit, places)`` is partitioned by unit.

    edges are (late, rank, start, back, ends, inner, need, id): the order of merges, and the edge as sets of positions:
    its two ends, what lies between, and how many positions between must be open for it to merge. places, where the
    units have them, travel with the edge of the first character.
    """
    places = F.col("places") if "places" in units.columns else F.lit(None).cast("int").alias("places")
    tied = tied_scores(model)
    rows = [(p, i, float(s), int(s in tied)) for p, i, s in model.pieces]
    table = F.broadcast(units.sparkSession.createDataFrame(rows, "piece string, id int, score double, late int"))  # MOST bounds it
    # Substrings are bounded by the longest piece that begins with the same two characters.
    reach: dict[str, int] = {}
    for p, _, _ in model.pieces:
        if len(p) > 1:
            reach[p[:2]] = max(reach.get(p[:2], 0), len(p))
    heads = F.broadcast(units.sparkSession.createDataFrame(list(reach.items()), "head string, most int"))
    spans = units.select("unit", places, F.explode(F.expr("sequence(0, length(unit) - 1)")).alias("start"))
    spans = spans.withColumn("head", F.expr("substring(unit, start + 1, 2)")).join(heads, "head", "left")
    spans = spans.select("unit", "places", "start", F.explode(F.expr("sequence(1, least(coalesce(most, 1), length(unit) - start))")).alias("size"))
    spans = spans.withColumn("piece", F.expr("substring(unit, start + 1, size)"))
    edges = spans.join(table, "piece", "left").where("id IS NOT NULL OR size = 1")
    late = F.expr("CASE WHEN size = 1 THEN 0 ELSE late END")
    return (
        edges.select(
            "unit",
            F.struct(
                late.alias("late"),
                F.expr("CASE WHEN size = 1 THEN -1e300D WHEN late = 1 THEN 0D ELSE -score END").alias("rank"),
                F.col("start"),
                (-F.col("size")).alias("back"),
                F.expr("shiftleft(1L, start) | shiftleft(1L, start + size)").alias("ends"),
                F.expr("shiftleft(1L, start + size) - shiftleft(1L, start + 1)").alias("inner"),
                F.when(late == 1, F.col("size") - 1).otherwise(F.least(F.col("size") - 1, F.lit(1))).alias("need"),
                F.col("id"),
                F.expr("CASE WHEN id IS NULL THEN piece END").alias("spell"),
                F.coalesce("score", F.lit(min((s for _, _, s in model.pieces), default=0.0) - 10)).alias("score"),
            ).alias("edge"),
            F.expr("CASE WHEN start = 0 AND size = 1 THEN places END").alias("places"),
        )
        .groupBy("unit")
        .agg(F.sort_array(F.collect_list("edge")).alias("edges"), F.first("places", ignorenulls=True).alias("places"))
    )


def merged(edges: DataFrame) -> DataFrame:
    """(unit, path, places): the BPE segmentation, by a fold over the edges whose state is the set of open positions."""
    fold = """aggregate(edges, shiftleft(1L, length(unit) + 1) - 1L, (open, e) ->
        CASE WHEN (open & e.ends) = e.ends AND bit_count(open & e.inner) = e.need THEN open & ~e.inner ELSE open END)"""
    path = "filter(edges, e -> (open & e.ends) = e.ends AND (open & e.inner) = 0)"
    opened = edges.select("unit", "places", "edges", F.expr(fold).alias("open"))
    return opened.select("unit", "places", F.expr(f"sort_array(transform({path}, e -> struct(e.start, e.id, e.spell)))").alias("path"))


def viterbi(edges: DataFrame) -> DataFrame:
    """(unit, path, places): the segmentation of the largest total score, by a fold over the edges in order of their ends.

    The state has for every position the best score up to there and the edge that got it; of equal scores the one
    whose last piece starts first stays.
    """
    kind = "struct<total:double,edge:struct<start:int,back:int,id:int,spell:string>>"
    by_end = "array_sort(edges, (a, b) -> CASE WHEN a.start - a.back <> b.start - b.back THEN (a.start - a.back) - (b.start - b.back) ELSE a.start - b.start END)"
    start = f"transform(sequence(0, length(unit)), i -> CAST(named_struct('total', CASE WHEN i = 0 THEN 0D ELSE -1e300D END, 'edge', NULL) AS {kind}))"
    step = f"""CASE WHEN best[e.start].total + e.score > best[e.start - e.back].total THEN transform(best, (b, i) ->
        CASE WHEN i = e.start - e.back THEN CAST(named_struct('total', best[e.start].total + e.score, 'edge',
        named_struct('start', e.start, 'back', e.back, 'id', e.id, 'spell', e.spell)) AS {kind}) ELSE b END) ELSE best END"""
    best = edges.select("unit", "places", F.expr(f"aggregate({by_end}, {start}, (best, e) -> {step})").alias("best"))
    none = "CAST(array() AS array<struct<start:int,back:int,id:int,spell:string>>)"
    back = f"""aggregate(sequence(1, length(unit)), named_struct('at', length(unit), 'path', {none}), (acc, k) ->
        CASE WHEN acc.at = 0 THEN acc ELSE named_struct('at', best[acc.at].edge.start, 'path', concat(array(best[acc.at].edge), acc.path)) END).path"""
    return best.select("unit", "places", F.expr(back).alias("path"))


def segment(units: DataFrame, model: Model) -> DataFrame:
    """(unit, places, ids) of each of the distinct ``units(unit, places)`` of ``LONG`` characters at most, which are partitioned by unit."""
    edges = lattice(units, model)
    path = viterbi(edges) if model.unigram else merged(edges)
    if model.byte_ids:
        low = "array(" + ", ".join(map(str, model.byte_ids)) + ")"
        spelled = f"transform(sequence(1, octet_length(e.spell)), k -> {low}[CAST(conv(substring(hex(e.spell), 2 * k - 1, 2), 16, 10) AS int)])"
    else:
        spelled = f"array({model.unknown})"
    return path.select("unit", "places", F.expr(f"flatten(transform(path, e -> CASE WHEN e.id IS NULL THEN {spelled} ELSE array(e.id) END))").alias("ids"))


def segment_long(rows: DataFrame, model: Model) -> DataFrame:
    """``rows(chunks, place, unit)`` with ids instead of unit: units that no set of positions fits, by the same folds in Python."""
    table, tied, longest = {p: (i, s) for p, i, s in model.pieces}, tied_scores(model), max((len(p) for p, _, _ in model.pieces), default=1)
    plain = tuple(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Model(*plain)
        for batch in batches:
            ids = [fold_long(u, table, tied, own, longest) for u in batch.column("unit").to_pylist()]
            yield pa.record_batch([batch.column("chunks"), batch.column("place"), pa.array(ids, pa.list_(pa.int32()))], ["chunks", "place", "ids"])

    return rows.mapInArrow(run, "chunks bigint, place int, ids array<int>")


def encode(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text", chunk: int = CHUNK, group: int = GROUP) -> DataFrame:
    """(doc_id, ids): one row per row of ``docs``.

    The same ids as the sentencepiece library gives for the model. Each text gets a space in front, spaces become
    marks, and it is cut where no piece crosses. The distinct units of the corpus are segmented once; each group of
    chunks of documents then gets the ids of its own units back, so that no text and no unit's occurrences are shuffled.

    ``chunk`` and ``group`` are about how many bytes of text are worked on at once, and share numbers of units.

    Null and empty texts have no ids. Characters that are no piece become their bytes' pieces, or the unknown id.
    Repeated rows come back repeated; an empty table gives no rows.
    """
    table = chunked(docs, model, doc_id, text, chunk, group)
    # One shuffle of units, read once: their places go through the lattice with them.
    count = table.agg(F.sum("n_units")).first()[0] or 0
    parts = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-count // PART_UNITS))
    places = table.select("chunks", "first", F.posexplode("units").alias("at", "unit")).where("unit IS NOT NULL").select("chunks", F.expr("first + at").alias("place"), "unit").repartition(parts, "unit")
    groups = places.groupBy("unit").agg(F.collect_list(F.struct("chunks", "place")).alias("places"))
    answers = segment(groups, model).select(F.explode("places").alias("at"), "ids").select("at.*", "ids")
    far = table.select("chunks", F.explode("long").alias("at")).select("chunks", "at.*")
    answers = answers.unionByName(segment_long(far, model))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, count = [], 0

        def out() -> Iterator[pa.RecordBatch]:
            rows = pa.Table.from_batches(held).combine_chunks().sort_by("chunks")
            chunk, place, ids = rows["chunks"].to_numpy(), rows["place"].to_numpy(), rows["ids"].combine_chunks()
            size, flat = np.diff(ids.offsets.to_numpy()), ids.flatten().to_numpy()
            ends = np.cumsum(size)
            cuts = np.flatnonzero(np.r_[True, chunk[1:] != chunk[:-1], True])
            blobs = []
            for a, b in zip(cuts, cuts[1:]):
                order = np.argsort(place[a:b]) + a
                lo = ends[order] - size[order]
                at = np.repeat(lo - (np.cumsum(size[order]) - size[order]), size[order]) + np.arange(size[order].sum())
                body = [np.diff(place[order], prepend=0).astype("<u4"), size[order].astype("<u4"), flat[at].astype("<u4")]
                plain = np.array([b - a], "<u4").tobytes() + b"".join(x.view(np.uint8).reshape(-1, 4).T.tobytes() for x in body)
                blobs.append(zstandard.ZstdCompressor(3).compress(plain))
            yield pa.record_batch([pa.array(chunk[cuts[:-1]]), pa.array(blobs, pa.binary())], ["chunks", "blob"])

        give_back()
        for batch in batches:
            held.append(batch)
            count += batch.num_rows
            if count >= 1 << 18:
                yield from out()
                held, count = [], 0
        if count:
            yield from out()

    packed = answers.mapInArrow(pack, "chunks bigint, blob binary").groupBy("chunks").agg(F.collect_list("blob").alias("blobs"))
    kind = docs.schema[doc_id].dataType.simpleString()

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def wide(raw: bytes) -> np.ndarray:
            return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view("<u4").ravel()

        give_back()
        for batch in batches:
            for i in range(batch.num_rows):
                lengths = np.frombuffer(batch.column("lengths")[i].as_py(), "<u4").astype(np.int64)
                numbers = wide(zstandard.ZstdDecompressor().decompress(batch.column("numbers")[i].as_py())).astype(np.int64)
                place, size, flat = [], [], []
                for blob in batch.column("blobs")[i].as_py() or []:
                    plain = zstandard.ZstdDecompressor().decompress(blob)
                    n = int(np.frombuffer(plain, "<u4", 1)[0])
                    place.append(np.cumsum(wide(plain[4 : 4 + 4 * n]).astype(np.int64)))
                    size.append(wide(plain[4 + 4 * n : 4 + 8 * n]).astype(np.int64))
                    flat.append(wide(plain[4 + 8 * n :]))
                if place:
                    place, size, flat = (np.concatenate(x) for x in (place, size, flat))
                    lo, own = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
                    lo[place], own[place] = np.cumsum(size) - size, size
                else:
                    lo = own = flat = np.zeros(0, np.int64)
                ends = np.cumsum(lengths)
                names = batch.column("doc_ids")[i].values
                # Some documents at a time, about 131,072 units.
                steps = np.unique(np.r_[0, np.searchsorted(ends, np.arange(1 << 17, len(numbers), 1 << 17)) + 1, len(lengths)])
                for a, b in zip(steps, steps[1:]):
                    unit = numbers[ends[a] - lengths[a] : ends[b - 1]]
                    count = own[unit]
                    at = np.repeat(lo[unit] - (np.cumsum(count) - count), count) + np.arange(count.sum())
                    sums = np.r_[0, np.cumsum(count)][np.r_[0, np.cumsum(lengths[a:b])]]
                    out = pa.ListArray.from_arrays(pa.array(sums, pa.int32()), pa.array(flat[at].astype(np.int32)))
                    yield pa.record_batch([names.slice(a, b - a), out], ["doc_id", "ids"])

    joined = table.select("chunks", "doc_ids", "lengths", "numbers").join(packed, "chunks", "left").select("doc_ids", "lengths", "numbers", "blobs")
    return joined.mapInArrow(spell, f"doc_id {kind}, ids array<int>")


def decode(rows: DataFrame, model: Model, ids: str = "ids", to: str = "text") -> DataFrame:
    """``rows`` with the text of ``ids`` in column ``to``: pieces joined, marks as spaces, less the space in front.

    A null array gives null; bytes that are no UTF-8 become U+FFFD; an id outside the model is an error. Column
    expressions only: the pieces' bytes are one literal, as hexadecimal digits.
    """
    spelled = F.split(F.lit(",".join(s.hex() for s in model.spelled)), ",")
    digits = F.array_join(F.transform(ids, lambda i: F.element_at(spelled, i.cast("int") + 1)), "")
    text = F.make_valid_utf8(F.unhex(digits).cast("string"))
    return rows.withColumn(to, F.regexp_replace(text, "^ ", ""))
