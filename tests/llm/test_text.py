"""Tokens, pieces, languages, toxicity, leaks and urls against libraries, brute force and held-out accuracy."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer
from tokenizers.models import BPE
from tokenizers.pre_tokenizers import ByteLevel

from modelwatch.llm import language, leaks, pieces, token_file, toxicity, url_filters
from tests.llm.awkward import FIELDS, rows

SF = "/root/testdata/sf0.01"
WORD_BPE, PIECE_BPE = (public_tokenizers.path(f) for f in ("word_bpe_49k.json", "piece_bpe_32k.model"))


# Token files


def test_token_files_round_trip(spark):
    data = rows()
    files = token_file.write(spark.createDataFrame(data, FIELDS), WORD_BPE, end_id=1, parts=4)
    got = token_file.documents(files).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(WORD_BPE)
    want = {}
    for r in data:
        ids = np.array([*tokenizer.encode(r[1] or "", add_special_tokens=False).ids, 1], "<u4")
        want.setdefault(r[0], []).append((len(ids), zlib.crc32(ids.tobytes())))
    before, last = 0, -1
    for r in got:
        assert r.start == before and (r.doc_id is None or r.doc_id >= last)
        assert (r.n_tokens, r.ids_crc32) in want[r.doc_id]
        want[r.doc_id].remove((r.n_tokens, r.ids_crc32))
        before, last = before + r.n_tokens, -1 if r.doc_id is None else r.doc_id
    assert not any(want.values())
    assert token_file.documents(token_file.write(spark.createDataFrame([], FIELDS), WORD_BPE, end_id=1)).collect() == []


@pytest.mark.parametrize("lengths", [[], [0, 0, 0], [5], [1] * 700, [0, 300_000, 0, 2, 1]])
def test_boundaries(lengths):
    ids = np.arange(sum(lengths), dtype=np.uint32) % 70_000
    shard = token_file.Shard(token_file.write_shard(list(range(len(lengths))), lengths, ids))
    ends = np.cumsum(np.array(lengths, np.int64))
    assert shard.boundaries.all().tolist() == ends.tolist()
    for i in range(len(lengths)):
        assert shard.boundaries.select(i) == ends[i]
        assert (shard.document(i) == ids[ends[i] - lengths[i] : ends[i]]).all()


def test_boundaries_are_small():
    lengths = [random.Random(1).randrange(2000) for _ in range(5000)]
    low, lows, highs, directory = token_file.elias_fano(np.cumsum(lengths), sum(lengths))
    assert 8 * (len(lows) + len(highs)) <= 5000 * (2 + np.log2(sum(lengths) / 5000)) + 64
    assert len(directory) <= 4 * (5000 // token_file.STEP + 1)


def encoded(encoder, texts):
    ids, size = encoder.encode(pa.array(texts, pa.string()))
    return [part.tolist() for part in np.split(ids, np.cumsum(size)[:-1])] if texts else ids.tolist()


def test_words_encode_like_texts():
    rng = random.Random(1)
    signs = "abcXYZéÉßÄñÑİıŉſ'.,;:!?0129<|>-_漢Σς́  \x1c\x85½²ªº€      \n\t"
    texts = ["".join(rng.choice(signs) for _ in range(rng.randrange(60))) for _ in range(3000)] + ["<|endoftext|> a<|endoftext|>b", "it's 'S we'll"]
    tokenizer, encoder = Tokenizer.from_file(WORD_BPE), token_file.Encoder(WORD_BPE)
    texts += [chr(c) + end for c in range(0x21, 0x250) for end in ("", "a", "***", "'s", ".")]
    assert encoded(encoder, texts) == [x.ids for x in tokenizer.encode_batch(texts, add_special_tokens=False)]
    assert encoded(encoder, [None, ""]) == [[], []] and encoded(encoder, []) == []


def test_words_are_forgotten(monkeypatch):
    monkeypatch.setattr(token_file, "KEPT", 3)
    tokenizer, encoder = Tokenizer.from_file(WORD_BPE), token_file.Encoder(WORD_BPE)
    for texts in (["one two three four"], ["four, five"], ["one 1 漢"]):
        assert encoded(encoder, texts) == [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


@pytest.mark.parametrize("added", [None, "a b", "word", "!!"])
def test_other_tokenizer_files_give_ids_of_whole_texts(tmp_path, added):
    if added is None:  # spaces belong to the words behind them
        tokenizer = Tokenizer(BPE({c: i for i, c in enumerate(["Ġ", "a", "b", "Ġa", "ab"])}, [("Ġ", "a"), ("a", "b")]))
        tokenizer.pre_tokenizer = ByteLevel(add_prefix_space=False)
    else:
        tokenizer = Tokenizer.from_file(WORD_BPE)
        tokenizer.add_tokens([added])
    path = str(tmp_path / "t.json")
    tokenizer.save(path)
    texts = ["ab a  b", " a", "a b a b!!", "ab!! word words sword", ""]
    assert encoded(token_file.Encoder(path), texts) == [x.ids for x in Tokenizer.from_file(path).encode_batch(texts, add_special_tokens=False)]


# Pieces


def plain_units(text, inside):
    """Texts are cut in front of each run of marks, and between signs that are neighbours in no piece."""
    out = []
    for word in re.findall("▁+[^▁]*", "▁" + text.replace(" ", "▁")) if text else []:
        at = [0, *(i for i in range(1, len(word)) if word[i - 1 : i + 1] not in inside), len(word)]
        out += [word[a:b] for a, b in zip(at, at[1:])]
    return out


def test_chunks_of_a_group_share_units(spark):
    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE), pieces.load(PIECE_BPE)
    data = [(i, t) for i, (_, t, *_) in enumerate(rows(n=60))] + [(1000 + i, "a" * 70 + f" the same 漢{i % 3}") for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string").coalesce(2)
    table = pieces.chunked(docs, model, "doc_id", "text", chunk=200, group=1500)
    assert table.count() > table.select("chunks").distinct().count() > 2
    got = {r.doc_id: list(r.ids) for r in pieces.encode(docs, model, chunk=200, group=1500).collect()}
    assert got == {i: library.encode(t or "") for i, t in data}


def test_units_are_cut_where_no_piece_crosses():
    rng, pairs = random.Random(1), pieces.bigrams(pieces.load(PIECE_BPE))
    inside = np.array(sorted(ord(x) << 32 | ord(y) for x, y in pairs), np.int64)
    for n in range(200):
        texts = [None, "", " ", "▁", *("".join(rng.choice("abtheин漢👍▁  \n\tß.,x") for _ in range(rng.randrange(40))) for _ in range(n % 20))]
        texts = [t if n % 3 or t is None else " ".join(t.replace("▁", "").split()) for t in texts]
        for part in (pa.array(texts), pa.array(["a ", *texts, "b"])[1:-1]):  # the second has an offset
            units, numbers, lengths = pieces.numbered(part, inside)
            assert len(set(units.to_pylist())) == len(units)
            got = np.split(np.array([units[k].as_py() for k in numbers], object), np.cumsum(lengths)[:-1])
            assert [g.tolist() for g in got] == [plain_units(t, pairs) for t in texts]
    assert [len(x) for x in pieces.numbered(pa.array([], pa.string()), inside)] == [0, 0, 0]


def test_pieces_like_the_library(spark):
    library, model = sentencepiece.SentencePieceProcessor(model_file=PIECE_BPE), pieces.load(PIECE_BPE)
    texts = [r[1] for r in rows(n=25)] + [" ", "x" * 200 + " " * 300 + "漢字" * 40, "a" * 3000, "👍\u200b <s>", *(" " * k + "the" for k in range(58, 66))]
    data = [(i if i % 6 else None, t) for i, t in enumerate(texts)]
    got = pieces.decode(pieces.encode(spark.createDataFrame(data, "doc_id bigint, text string"), model), model).collect()
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == Counter((i, tuple(library.encode(t or ""))) for i, t in data)
    assert Counter((r.doc_id, r.text) for r in got) == Counter((i, t or "") for i, t in data)
    assert pieces.encode(spark.createDataFrame([], "doc_id bigint, text string"), model).collect() == []


def test_units_are_read_once(spark):
    """Places go through the lattice with their units; only chunks are joined to them."""
    docs = spark.createDataFrame([(1, "one two"), (2, "two three")], "doc_id bigint, text string")
    plan = pieces.encode(docs, pieces.load(PIECE_BPE))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("collect_list(struct(chunks") == 1
    assert {line.split("Join ")[1].split(",")[0] for line in plan.splitlines() if "Join " in line} == {"LeftOuter"}


def test_viterbi(spark):
    """A unigram model over a small alphabet, against every segmentation."""
    rng = random.Random(1)
    known = sorted({"".join(rng.choice("abc") for _ in range(rng.randrange(1, 5))) for _ in range(25)} | {"a", "b"})
    model = pieces.Model([(p, i, -rng.random() * (1 + len(p))) for i, p in enumerate(known)], [], 99, [], True)
    scores = {p: s for p, _, s in model.pieces}
    least = min(scores.values()) - 10

    def best(unit):
        if not unit:
            return 0.0
        return max(best(unit[k:]) + scores.get(unit[:k], least if k == 1 else -1e9) for k in range(1, min(4, len(unit)) + 1))

    units = sorted({"".join(rng.choice("abcd") for _ in range(rng.randrange(1, 10))) for _ in range(40)})
    table = spark.createDataFrame([(u,) for u in units], "unit string").repartition("unit")
    for r in pieces.segment(table, model).collect():
        total = sum(least if i == 99 else model.pieces[i][2] for i in r.ids)
        assert abs(total - best(r.unit)) < 1e-9


# Languages


def test_languages_on_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = language.identify(docs).join(docs.select("doc_id", "lang"), "doc_id")
    assert got.where("held_out AND lang_pred = lang").count() >= 0.97 * got.where("held_out").count()


def test_awkward_languages(spark):
    data = rows()
    got = language.identify(spark.createDataFrame(data, FIELDS)).collect()
    assert len(got) == len(data)
    assert sum(r.lang_pred == "und" for r in got) == sum(not re.search(r"[^\W\d_]", r[1] or "") for r in data)
    assert all(0 <= r.score <= 1 and r.lang_pred in ("und", "en", "de") for r in got)
    assert {r.doc_id: r.held_out for r in got} == {r[0]: r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 1 for r in data}
    none = spark.createDataFrame([], FIELDS)
    assert language.identify(none).collect() == []
    bare = spark.createDataFrame([(2, "words", None)], "doc_id bigint, text string, lang string")
    assert [(r.lang_pred, r.score) for r in language.identify(bare).collect()] == [("und", 0.0)]


@pytest.mark.parametrize("n", [1, 2, 4, 6, 9])
def test_code_books(n):
    book = language.code_book(n)
    assert len({tuple(r) for r in book}) == n
    if n > 2:
        assert min((book[i] != book[k]).sum() for i in range(n) for k in range(i)) >= 2


# Toxicity


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    got = toxicity.judge(docs, labels).join(labels.select("doc_id", "toxic"), "doc_id").where("held_out")
    counts = {(r.toxic, r.predicted): r["count"] for r in got.groupBy("toxic", "predicted").count().collect()}
    assert counts.get((1, 1), 0) >= 0.8 * (counts.get((1, 1), 0) + counts.get((1, 0), 0))
    assert counts.get((0, 1), 0) <= 0.01 * counts[0, 0]


def test_pairs_that_no_linear_model_sees():
    """Toxic if exactly one of two terms stands there: neither term says anything alone."""
    rng = np.random.default_rng(0)
    a, b = rng.integers(0, 2, 2000), rng.integers(0, 2, 2000)
    cells = [np.array([t for t, there in ((11, x), (22, y)) if there], np.int64) for x, y in zip(a, b)]
    size = np.array([len(c) for c in cells])
    indptr, bucket = np.r_[0, np.cumsum(size)], np.concatenate(cells)
    old, toxicity.FLOOR = toxicity.FLOOR, 1.0
    try:
        machine = toxicity.train(indptr, bucket, (a ^ b).astype(float), epochs=60)
    finally:
        toxicity.FLOOR = old
    score = machine.scores(np.repeat(np.arange(2000), size), bucket, 2000)
    assert ((score >= 0.5) == (a ^ b)).mean() > 0.95


@pytest.mark.parametrize(("share", "seed"), [(0.1, 1), (0.1, 2), (0.2, 1), (0.3, 1)])
def test_pairs_with_the_shipped_constants(share, seed):
    """Two words, each in a share of the texts and harmless alone, toxic together; beside a strong word in every tenth text."""
    rng, n = np.random.default_rng(seed), 20_000
    a, b, strong = rng.random(n) < share, rng.random(n) < share, rng.random(n) < 0.1
    label = ((a & b) | strong).astype(float)
    noise = rng.integers(1000, 6000, (n, 20))
    cells = [np.unique(np.r_[noise[i], [t for t, there in ((11, a[i]), (22, b[i]), (33, strong[i])) if there]]).astype(np.int64) for i in range(n)]
    size = np.array([len(c) for c in cells])
    half = n // 2
    machine = toxicity.train(np.r_[0, np.cumsum(size[:half])], np.concatenate(cells[:half]), label[:half])
    hit = machine.scores(np.repeat(np.arange(half), size[half:]), np.concatenate(cells[half:]), half) >= 0.5
    pair = (a & b & ~strong)[half:]
    assert hit[pair].mean() >= 0.8 and hit[label[half:] == 0].mean() <= 0.001


def test_scores_are_sums_over_all_pairs():
    rng = np.random.default_rng(3)
    linear, factors = rng.normal(size=toxicity.BUCKETS), rng.normal(size=(toxicity.BUCKETS, toxicity.FACTORS)) / 3
    texts = [rng.choice(500, size, replace=False) for size in (0, 1, 2, 9, 30)]
    got = toxicity.Machine(0.2, linear, factors).scores(np.repeat(np.arange(5), [len(t) for t in texts]), np.concatenate(texts).astype(np.int64), 5)
    for score, t in zip(got, texts):
        raw = 0.2 + sum(linear[i] for i in t) + sum(factors[i] @ factors[j] for at, i in enumerate(t) for j in t[:at])
        assert abs(score - 1 / (1 + np.exp(-np.clip(raw, -30, 30)))) < 1e-9


def test_awkward_toxicity(spark):
    data = rows()
    table = spark.createDataFrame(data, FIELDS)
    labels = spark.createDataFrame([(r[0], i % 2, "x") for i, r in enumerate(data)] + [(None, 1, "x"), (3, None, "x")], "doc_id bigint, toxic int, text string")
    got = toxicity.judge(table, labels).collect()
    assert len(got) == len(data) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    assert toxicity.judge(spark.createDataFrame([], FIELDS), labels).collect() == []
    assert {r.score for r in toxicity.judge(table, labels.limit(0)).collect()} == {0.5}


# Leaks


def grams(text, n=5):
    words = re.findall("[a-z0-9\u0080-\U0010ffff]+", text.lower())
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else ({tuple(words)} if words else set())


def brute_leaks(docs, items):
    out = set()
    for d, text in docs:
        words = re.findall("[a-z0-9\u0080-\U0010ffff]+", (text or "").lower())
        there = {tuple(words[i : i + n]) for n in range(1, 6) for i in range(len(words) - n + 1)}
        for i, item in items:
            parts = [grams(p) for p in leaks.question_and_answer(item)]
            if any(parts) and all(sum(g in there for g in p) >= 0.8 * len(p) for p in parts if p):
                out.add((d, i))
    return out


def test_leaks(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rng = random.Random(2)
    clean = [r.text for r in docs.orderBy("doc_id").limit(40).collect()]
    data = [(10_000 + k, f"{rng.choice(clean)} {items[k % 40][1].replace(' ', ' * ')} {rng.choice(clean)}") for k in range(40)]
    data += [(20_000, items[3][1]), (20_001, " ".join(items[5][1].split()[:8])), (None, items[4][1]), (20_002, None), (20_003, "")]
    table = docs.unionByName(spark.createDataFrame(data, docs.schema))
    more = [*items, (500, None), (501, ""), (502, "?!"), (None, "no id"), (503, items[0][1])]
    found = leaks.find(table, spark.createDataFrame(more, "item_id bigint, text string"))
    got = {(r.doc_id, r.item_id) for r in found.collect()}
    assert got == brute_leaks([(r.doc_id, r.text) for r in table.collect()], [*items, (503, items[0][1])])
    assert {(10_000 + k, items[k % 40][0]) for k in range(40)} <= got
    assert leaks.find(table.limit(0), spark.createDataFrame(more, "item_id bigint, text string")).collect() == []
    assert leaks.find(table, spark.createDataFrame([], "item_id bigint, text string")).collect() == []


def test_many_indexes(spark, monkeypatch):
    monkeypatch.setattr(leaks, "INDEX_BYTES", 2000)
    docs, items = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    several = {(r.doc_id, r.item_id) for r in leaks.find(docs, items).collect()}
    monkeypatch.setattr(leaks, "INDEX_BYTES", 1 << 30)
    assert several == {(r.doc_id, r.item_id) for r in leaks.find(docs, items).collect()} != set()


def test_wand_finds_all_above_the_threshold():
    rng = random.Random(6)
    items = [(i, " ".join(rng.choice("abcdefghijklmnopqrstuvwxyz") * rng.randrange(1, 3) for _ in range(rng.randrange(3, 30)))) for i in range(50)]
    index = leaks.Index(items)
    for _ in range(200):
        terms = sorted(rng.sample(range(len(index.terms)), rng.randrange(1, len(index.terms))))
        scores = Counter()
        for t in terms:
            for p in range(index.cuts[t], index.cuts[t + 1]):
                scores[int(index.item[p])] += index.impact[p]
        query, block = index.bounds(np.array([0]), np.array(terms))
        got = {i for b in block.tolist() for i, _ in index.wand(terms, b)}
        assert got == {i for i, s in scores.items() if s >= 1 - 1e-6}


# Urls


def test_rules(spark):
    data = [
        (1, "http://www.Example.com/en/x?q#f", "www.example.com/en/", "allow", "www.example.com", "/en/x"),
        (2, "https://EXAMPLE.com/en/", "example.com/en/", "block", "example.com", "/en/"),
        (3, "https://a.example.com/de/", "com/", "allow", "a.example.com", "/de/"),
        (4, "https://com/", "com/", "allow", "com", "/"),
        (5, "https://telecom/", None, "allow", "telecom", "/"),
        (6, "http://x.net/fr/1", "net/fr/", "block", "x.net", "/fr/1"),
        (7, "http://x.net/fr", None, "block", "x.net", "/fr"),
        (8, "x.net/fr/", None, "allow", "", ""),
        (9, None, None, "allow", "", ""),
        (10, "", None, "allow", "", ""),
        (11, "http://", None, "allow", "", ""),
        (12, "http://a.com", None, "allow", "a.com", ""),
        (13, "http://b.org?x://y/z", None, "allow", "b.org", ""),
        (None, "ftp://x.org/\nnet/#", None, "allow", "x.org", "/\nnet/"),
    ]
    got = url_filters.judge(spark.createDataFrame([(r[0], r[1], None, "h") for r in data], "page_id bigint, url string, html string, host string")).collect()
    assert sorted(map(str, [(r.page_id, r.rule, r.verdict, r.host, r.path) for r in got])) == sorted(map(str, [(r[0], *r[2:]) for r in data]))
    assert url_filters.judge(spark.createDataFrame([], "page_id bigint, url string, html string")).collect() == []


def brute_rank(edges, seeds, hosts, damping=0.85):
    total = sum(seeds.values())
    rank = {h: seeds.get(h, 0) / total for h in hosts}
    out = Counter()
    for (a, _), w in edges.items():
        out[a] += w
    for _ in range(200):
        moved = Counter()
        for (a, b), w in edges.items():
            moved[b] += damping * rank[a] * w / out[a]
        rest = 1 - sum(moved.values())
        rank = {h: moved[h] + rest * seeds.get(h, 0) / total for h in hosts}
    return rank


def test_trust_and_distrust_along_links(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.org" for i in range(30)] + ["good.com", "bad.net"]
    edges = Counter()
    pages = []
    for i in range(400):
        a = rng.choice(hosts)
        own = {rng.choice(hosts) for _ in range(rng.randrange(4))}
        for b in own - {a}:
            edges[a, b] += 1
        path = "/es/" if a == "bad.net" else "/"
        pages.append((i, f"http://{a}{path}{i}", "".join(f'<a HREF="https://{b.upper()}/x">' for b in own) + '<a href="/local">'))
    got = {r.host: r for r in url_filters.judge(spark.createDataFrame(pages, "page_id bigint, url string, html string")).collect()}
    good = {"good.com": sum(u.startswith("http://good.com/") for _, u, _ in pages)}
    bad = {"bad.net": sum(u.startswith("http://bad.net/es/") for _, u, _ in pages)}
    trust = brute_rank(edges, good, hosts)
    distrust = brute_rank({(b, a): w for (a, b), w in edges.items()}, bad, hosts)
    for h, r in got.items():
        assert abs(r.trust - trust[h]) < 1e-4 and abs(r.distrust - distrust[h]) < 1e-4
        if r.rule is None:
            assert r.verdict == ("block" if r.distrust > r.trust else "allow")
    assert {r.verdict for r in got.values()} == {"allow", "block"}


def test_ranks_along_a_long_chain(spark):
    """The tolerance ends the rounds: a host 55 links from the seed has its rank."""
    edges = spark.createDataFrame([(f"h{i}", f"h{i + 1}", 1.0) for i in range(55)], "src string, dst string, weight double").coalesce(1)
    seeds = spark.createDataFrame([("h0", 1.0)], "host string, weight double").coalesce(1)
    got = {r.host: r["rank"] for r in url_filters.personalised_rank(edges, seeds, tolerance=1e-4).collect()}
    whole = sum(0.85**i for i in range(56))
    assert len(got) == 56 and all(abs(got[f"h{i}"] - 0.85**i / whole) < 1e-4 for i in range(56))
