"""The pipeline stage by stage: each keeps the columns of documents, and its decisions take effect."""

import corpus_pipeline
import sentencepiece
import public_tokenizers

from tests.llm.awkward import FIELDS, rows
from tests.llm.test_near import components, fingerprint
from tests.llm.test_repeats import windows_gone
from tests.llm.test_text import SF, brute_leaks


def test_against_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("doc_id < 250")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    extra = [(100_000 + i, f"{t} the end of it", "en", "x", 1) for i, (_, t) in enumerate(items[:5])] + [(200_000, "12 34", "en", "x", 5), (200_001, None, "en", "x", 0)]
    docs = docs.unionByName(spark.createDataFrame(extra, docs.schema))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        kept = {r.doc_id: r for r in spark.read.parquet(f"{tmp_path}/{k}").collect()}
        order = sorted(before)
        if name == "language_id":
            assert 200_000 not in kept and 200_001 not in kept and len(kept) >= len(before) - 4
        elif name == "simhash_near_dedup":
            root = components([fingerprint(before[d].text) for d in order], 3)
            first = {}
            for d, r in zip(order, root):
                first.setdefault(r, d)
            assert set(kept) == set(first.values())
        elif name == "suffix_dedup":
            assert set(kept) == set(before)
            texts = [before[d].text.encode() for d in order]
            for d, text, gone in zip(order, texts, windows_gone(texts, 100)):
                want = bytes(b for b, g in zip(text, gone) if not g).decode("utf-8", "ignore")
                assert kept[d].text == want and kept[d].n_chars == len(want)
        elif name == "decontamination":
            leaked = {d for d, _ in brute_leaks([(d, before[d].text) for d in order], items)}
            assert set(kept) == set(before) - leaked and leaked >= {100_000 + i for i in range(5)}
        else:
            library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
            assert {d: r.ids for d, r in kept.items()} == {d: library.encode(r.text) for d, r in before.items()}
            assert all(kept[d].text == r.text for d, r in before.items())
            break
        assert spark.read.parquet(f"{tmp_path}/{k}").schema.simpleString() == docs.schema.simpleString()
        docs = spark.read.parquet(f"{tmp_path}/{k}")


def test_awkward_rows(spark):
    docs = spark.createDataFrame(rows(n=20), FIELDS)
    empty = docs.limit(0)
    given = {r["_score"]: r for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, empty, SF).collect() == []
        docs = stage(spark, docs, SF)
        assert docs.columns == empty.columns and docs.schema.simpleString() == empty.schema.simpleString()
        for r in docs.collect():  # no column that looks like an operator's own has another value
            before = given[r["_score"]].asDict()
            assert {c: v for c, v in r.asDict().items() if c not in ("text", "n_chars")} == {c: v for c, v in before.items() if c not in ("text", "n_chars")}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() == docs.count()


def test_languages_without_labels(spark):
    docs = spark.createDataFrame([(1, "clean words", None, "x", 11), (2, "12 34", None, "x", 5), (3, None, None, "x", 0), (4, "", None, "x", 0)], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    assert [r.doc_id for r in corpus_pipeline.identify_language(spark, docs, SF).collect()] == [1]
