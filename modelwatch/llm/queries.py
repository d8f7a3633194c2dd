"""Registered queries of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.llm import language, leaks, main_text, mining, neighbours, pieces, simhash, substrings, suffixes, token_file, toxicity, url_filters, whitening
from modelwatch.llm.common import read

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_simhash")
def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    return simhash.near_duplicates(read(spark, sf_dir, "documents"))


@query("op6_url_filters")
def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict for every page."""
    return url_filters.judge(read(spark, sf_dir, "pages"), url_filters.RULES)


@query("op9_neighbours")
def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest of every vector whose id is divisible by 20."""
    return neighbours.nearest(read(spark, sf_dir, "embeddings"), k=20)


@query("op5_language")
def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document."""
    return language.identify(read(spark, sf_dir, "documents"))


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity.judge(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


@query("op4_token_files")
def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Boundaries and checksum of every document's ids, from files of the whole corpus."""
    import public_tokenizers

    files = token_file.write(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return token_file.documents(files)


OP3_SQL = r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^ \t\n\x0B\f\r]+') AS w FROM documents),
 p AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
 s AS (SELECT doc_id, i, row_number() OVER (PARTITION BY array_to_string(w[i:i + 19], ' ') ORDER BY doc_id, i) > 1 AS later
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d)),
 m AS (SELECT p.doc_id, p.i, p.word, coalesce(bool_or(s.later) OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 19 PRECEDING AND CURRENT ROW), false) AS gone
  FROM p LEFT JOIN s ON p.doc_id = s.doc_id AND p.i = s.i),
 t AS (SELECT doc_id, count(*) AS n, count_if(gone) AS r, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM m GROUP BY doc_id)
 SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_words, CAST(coalesce(r, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN t ON d.doc_id = t.doc_id"""


@query("op3_substrings", OP3_SQL)
def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without repeated 20-word windows."""
    return substrings.remove_repeats(read(spark, sf_dir, "documents"), window=20).drop("kept")


@query("op10_suffixes")
def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every document keeps without repeated 100-byte strings."""
    return suffixes.remove_repeats(read(spark, sf_dir, "documents"), length=100).drop("kept")


@query("op8_leaks")
def op8_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark items that leak into documents."""
    return leaks.find(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


@query("op2_pieces")
def op2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SentencePiece ids of every document, and the text decoded from them."""
    import public_tokenizers

    model = pieces.load(public_tokenizers.path("piece_bpe_32k.model"))
    ids = pieces.encode(read(spark, sf_dir, "documents"), model)
    return pieces.decode(ids.withColumn("n_tokens", F.size("ids")), model, to="decoded")


def finite(vector: str) -> Column:
    """The vector in doubles; null if it is null or any entry is null or not finite."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(~odd, F.col(vector).cast("array<double>"))


OP11_SQL = """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, [floor(256 * x::DOUBLE) FOR x IN embedding] AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
 s AS (SELECT a.vec_id AS anchor_id, e.vec_id AS other, a.label = e.label AS same, CAST(list_dot_product(a.v, e.v) AS BIGINT) AS score
  FROM e a JOIN e ON a.vec_id <> e.vec_id WHERE a.vec_id % 100 = 0),
 p AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5),
 w AS (SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
   row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS rank
  FROM p JOIN s n ON p.anchor_id = n.anchor_id AND NOT n.same AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score)
 SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM w WHERE rank <= 5"""


@query("op11_negatives", OP11_SQL)
def op11_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor whose id is divisible by 100."""
    rows = read(spark, sf_dir, "embeddings").select(
        "vec_id",
        F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("bigint") + 1) % 10).otherwise(F.col("label")).alias("label"),
        F.transform(finite("embedding"), lambda x: F.floor(256 * x)).alias("vector"),
    )
    return mining.mine(rows, F.col("vec_id") % 100 == 0)


# The given pages hold their text in an <article> without marked elements inside, and none of it recurs often enough for a template.
OP12_SQL = r"""WITH a AS (SELECT page_id, url, regexp_split_to_array(regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)(?:</article>|\z)', 1), '</?p>|<br>|</?h1>') AS b FROM pages),
 t AS (SELECT page_id, url, [trim(regexp_replace(replace(replace(replace(replace(regexp_replace(regexp_replace(x, '<[^>]*>', '', 'g'), '&amp([^;]|\z)', '&amp;\1', 'g'),
   '&quot;', '"'), '&lt;', '<'), '&gt;', '>'), '&amp;', '&'), '\s+', ' ', 'g')) FOR x IN b] AS b FROM a)
 SELECT page_id, url, array_to_string([x FOR x IN b IF x <> ''], chr(10) || chr(10)) AS text, CAST(length(array_to_string([x FOR x IN b IF x <> ''], chr(10) || chr(10))) AS BIGINT) AS n_chars FROM t"""


@query("op12_main_text", OP12_SQL)
def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    return main_text.extract(read(spark, sf_dir, "pages"))


@query("op13_whitening")
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened embeddings on up to 16 components."""
    rows = read(spark, sf_dir, "embeddings")
    # Bounded before the offset is added, so that huge entries cannot overflow.
    whole = F.transform(finite("embedding"), lambda x: F.floor(F.greatest(F.lit(-1e12), F.least(F.lit(1e12), 64 * x))) + 1_000_000)
    return whitening.whiten(rows.select("vec_id", whole.alias("vector")), components=16)
