"""Operators over inputs with gaps: missing scores, labels, keys, sides, ledger rows, and times that differ by a microsecond."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.catalog.proxies import CUST, SCORED, customers, rounded, scored, table
from modelwatch.catalog.q_sources import YEARLY, yearly_ledger
from modelwatch.catalog.registry import query
from modelwatch.operators import drift, encoding, membership, metrics, profile, sampling, training
from modelwatch.plans import ingest


@query(
    "j11_missing_scores_in_blocks",
    f"""WITH s AS (SELECT y, prediction, CASE WHEN id % 7 <> 0 THEN probability END AS score FROM ({SCORED})),
 ranked AS (SELECT y, score, rank() OVER (ORDER BY score) AS lo, count(*) OVER (PARTITION BY score) AS same FROM s WHERE score IS NOT NULL AND y IS NOT NULL)
 SELECT (SELECT count(*) FROM s) AS samples, (SELECT count(*) FROM s WHERE y = 1 AND prediction = 1) AS tp,
 (SELECT round((sum(CASE WHEN y = 1 THEN lo + (same - 1) / 2.0 END) - count_if(y = 1) * (count_if(y = 1) + 1) / 2.0) / (count_if(y = 1) * count_if(y = 0)), 6) FROM ranked) AS roc_auc""",
)
def j11_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Failed rows have no score: they count as samples and have no place in the ranking."""
    rows = scored(spark, sf).withColumn("score", F.when(F.col("id") % 7 != 0, F.col("probability")))
    out = metrics.evaluate(rows, "y", "prediction", "score", cuts={"score": [0.4, 0.5, 0.6]})
    return rounded(out.select("samples", "tp", "roc_auc"))


@query(
    "e3_missing_labels",
    f"""SELECT 'lang' AS "column", lang AS value, count(*) AS n, CAST(coalesce(sum(CAST(label AS INTEGER)), 0) AS BIGINT) AS positives, round(avg(CAST(label AS INTEGER)), 6) AS rate
 FROM (SELECT lang, CASE WHEN id % 5 <> 0 THEN y = 1 END AS label FROM ({SCORED})) WHERE lang IS NOT NULL GROUP BY lang""",
)
def e3_missing(spark: SparkSession, sf: str) -> DataFrame:
    label = F.when(F.col("id") % 5 != 0, F.col("y") == 1)
    return rounded(profile.rate_by(scored(spark, sf), ["lang"], label))


@query(
    "b11_microseconds_and_types",
    "SELECT count(*) AS new_rows, count(*) FILTER (o_orderkey % 2 <> 0) AS overlapping_rows FROM orders",
)
def b11_micros(spark: SparkSession, sf: str) -> DataFrame:
    """Half of the orders differ by a microsecond; the keys are whole numbers on one side and doubles on the other."""
    orders = table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    later = F.expr("CASE WHEN o_orderkey % 2 = 0 THEN o_orderdate + INTERVAL '0.000001' SECOND ELSE o_orderdate END")
    holdout = orders.withColumn("o_orderkey", F.col("o_orderkey").cast("double"))
    return membership.row_overlap(orders.withColumn("o_orderdate", later), holdout, ["o_orderkey", "o_orderdate"])


@query(
    "h6_folds_without_keys",
    f"SELECT lang, CAST(f AS INTEGER) AS fold, n // 5 + CAST(f < n % 5 AS INTEGER) AS n FROM (SELECT lang, count(*) AS n FROM ({SCORED}) GROUP BY 1), range(5) t(f) WHERE n // 5 + CAST(f < n % 5 AS INTEGER) > 0",
)
def h6_missing(spark: SparkSession, sf: str) -> DataFrame:
    """Rows without key, and rows that share one, are dealt out like all others."""
    key = F.when(F.col("id") % 9 != 0, F.floor(F.col("id") / 3))
    folds = sampling.stratified_folds(scored(spark, sf).withColumn("key", key), "key", "lang", 5)
    return folds.groupBy("lang", "fold").agg(F.count(F.lit(1)).alias("n"))


@query(
    "k1_empty_side",
    f"""SELECT 'here' AS feature, CAST(NULL AS DOUBLE) AS score, CAST(count_if(id % 2 = 0 AND probability IS NOT NULL) AS BIGINT) AS n_baseline, CAST(0 AS BIGINT) AS n_current, 'NO_DATA' AS status FROM ({SCORED})
 UNION ALL SELECT 'nowhere', NULL, CAST(0 AS BIGINT), CAST(0 AS BIGINT), 'NO_DATA'""",
)
def k1_empty(spark: SparkSession, sf: str) -> DataFrame:
    """A feature with values on one side, and one with none at all."""
    early = F.col("id") % 2 == 0
    rows = scored(spark, sf).select("id", F.when(early, F.col("probability")).alias("here"), F.lit(None).cast("double").alias("nowhere"))
    out = drift.ks_statistic(drift.one_table(rows, early), ["here", "nowhere"])
    return out.select("feature", "score", "n_baseline", "n_current", "status")


@query(
    "l10_ledger_gap",
    f"""SELECT dataset_version, TRUE AS sums_hold, dataset_version <> 'v1998' AS continues, TRUE AS hash_unique FROM ({YEARLY}) WHERE dataset_version <> 'v1997'""",
)
def l10_gap(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.lineage_invariants(yearly_ledger(spark, sf).where("dataset_version <> 'v1997'"))


@query(
    "i7_closed_form",
    f"SELECT contract, round(avg(y), 3) AS probability, count(*) AS n FROM ({CUST}) GROUP BY contract",
)
def i7_closed_form(spark: SparkSession, sf: str) -> DataFrame:
    """Without a penalty, a logistic regression on one category says its positive rate."""
    rows = customers(spark, sf).select("id", "contract", (F.col("churn") == "Yes").cast("int").alias("y"))
    encoder = encoding.FeatureEncoder(categoricalCols=["contract"], outputCol="features")
    model = training.fit_model(rows, "id", "y", encoder, training.logistic_regression("y", c=1e9, max_iter=200))
    scored_rows = training.score(model, rows)
    return scored_rows.groupBy("contract").agg(F.round(F.avg("churn_probability"), 3).alias("probability"), F.count(F.lit(1)).alias("n"))
