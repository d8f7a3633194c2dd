"""A corpus pipeline: each stage's result is written as Parquet and read again as the next stage's documents."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.llm import language, leaks, pieces, simhash, suffixes
from modelwatch.llm.common import read, stage_table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language: those without a letter go, and those between two codewords.

    Learns from the documents' own labels (those whose fold is not held out); rows without doc_id are judged too.
    Null and empty texts go. Where no document has a label, nothing is learned and all with a letter stay.
    """
    rows = docs.select(docs["doc_id"], docs["text"], docs["lang"])
    model = language.fit(rows.where(language.fold(F.col("doc_id"), 3) != 1))
    if model is None:
        return docs.where(docs["text"].rlike(r"\p{L}"))
    return language.accepted(docs, model)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates (3-word shingles, 3 bits), the smallest doc_id."""
    return simhash.one_of_each(docs, shingle=3, bits=3)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, its text without 100-byte strings that start earlier; n_chars is that of the new text.

    A text that is removed whole is left empty.
    """
    cut = suffixes.without_repeats(docs, length=100)
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)) if "n_chars" in cut.columns else cut


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents into which no benchmark item leaks."""
    return leaks.clean(docs, read(spark, sf_dir, "benchmark"))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, text): the pieces of every document, and the text decoded from them."""
    model = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    ids = pieces.encode(docs, model).withColumn("n_tokens", F.size("ids"))
    return pieces.decode(ids.select("doc_id", "n_tokens", "ids"), model)


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("simhash_near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontaminate),
    ("sentencepiece", encode),
]

#: No SQL: languages are learned, fingerprints form components, thresholds come from an index.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage_table(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
