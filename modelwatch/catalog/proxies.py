"""The operators' inputs, derived from the given tables: once for Spark, once as SQL for the check."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelwatch.operators.drift import one_table
from modelwatch.schema import ColumnRule, TableSpec

DRIFT_DATE = "1998-06-01"
CHURN_DATE = "2000-11-01"


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """All double columns rounded, for comparison across engines."""
    return df.select(*[F.round(c, places).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# --- inference log from events ---------------------------------------------


def log(spark: SparkSession, sf: str) -> DataFrame:
    failed = F.col("event_type") == "error"
    version = (F.col("user_id") % 3).cast("string")
    return table(spark, sf, "events").select(
        F.col("event_id").cast("string").alias("request_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.from_json("props", "k int").alias("input"),
        F.when(~failed, (F.col("event_type") == "purchase").cast("int")).alias("prediction"),
        F.when(~failed, F.least(F.lit(1.0), F.col("value") / 500.0)).alias("churn_probability"),
        F.col("value").alias("latency_ms"),
        F.when(failed, "failure").otherwise("success").alias("status"),
        F.when(failed, F.lit("unavailable")).alias("error"),
        F.lit("churn_model").alias("model_name"),
        version.alias("model_version"),
        F.concat(F.lit("run-"), version).alias("run_id"),
    )


LOG = """SELECT CAST(event_id AS VARCHAR) AS request_id, ts, epoch_us(ts) AS us,
 CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
 CASE WHEN event_type <> 'error' THEN CAST(event_type = 'purchase' AS INTEGER) END AS prediction,
 CASE WHEN event_type <> 'error' THEN least(CAST(1 AS DOUBLE), value / CAST(500 AS DOUBLE)) END AS churn_probability,
 value AS latency_ms,
 CASE WHEN event_type = 'error' THEN 'failure' ELSE 'success' END AS status,
 CASE WHEN event_type = 'error' THEN 'unavailable' END AS error,
 'churn_model' AS model_name, CAST(user_id % 3 AS VARCHAR) AS model_version,
 'run-' || CAST(user_id % 3 AS VARCHAR) AS run_id FROM events"""


# --- customers with order history ------------------------------------------


def customers(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer: segment, nation, months of activity, mean and total charge, churn text."""

    def months(c: str):
        return F.year(c) * 12 + F.month(c)

    per = (
        table(spark, sf, "orders")
        .groupBy(F.col("o_custkey").alias("id"))
        .agg(
            F.min("o_orderdate").alias("first"),
            F.max("o_orderdate").alias("last"),
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("total"),
        )
    )
    who = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"),
        F.col("c_mktsegment").alias("contract"),
        F.col("c_nationkey").cast("string").alias("nation"),
        (F.col("c_nationkey") % 2).alias("senior"),
        F.col("c_acctbal").alias("balance"),
    )
    churned = F.col("last") < F.lit(CHURN_DATE).cast("timestamp_ntz")
    return who.join(per, "id").select(
        "id",
        "contract",
        "nation",
        "senior",
        "balance",
        (months("last") - months("first")).alias("tenure"),
        (F.col("total") / F.col("n")).alias("monthly"),
        "total",
        F.when(churned, "Yes").otherwise("No").alias("churn"),
        churned.cast("int").alias("y"),
    )


CUST = f"""SELECT id, contract, nation, senior, balance, tenure, total / n AS monthly, total, churn,
 CAST(churn = 'Yes' AS INTEGER) AS y FROM (
 SELECT c_custkey AS id, c_mktsegment AS contract, CAST(c_nationkey AS VARCHAR) AS nation,
  c_nationkey % 2 AS senior, c_acctbal AS balance, n, total,
  CAST((year(l) * 12 + month(l)) - (year(f) * 12 + month(f)) AS INTEGER) AS tenure,
  CASE WHEN l < TIMESTAMP '{CHURN_DATE}' THEN 'Yes' ELSE 'No' END AS churn
 FROM customer JOIN (SELECT o_custkey, min(o_orderdate) AS f, max(o_orderdate) AS l, count(*) AS n,
  CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS total FROM orders GROUP BY o_custkey) o
 ON c_custkey = o_custkey)"""


def closed(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with one category that says much about churn, for models whose scores are rates."""
    return customers(spark, sf).withColumn("stays", F.when(F.col("tenure") >= 60, "long").otherwise("short"))


CLOSED = f"SELECT *, CASE WHEN tenure >= 60 THEN 'long' ELSE 'short' END AS stays FROM ({CUST})"


# --- scored documents -------------------------------------------------------


def scored(spark: SparkSession, sf: str) -> DataFrame:
    """Two models' scores on labelled documents; the class is probability >= 0.5."""
    words = F.length("text") - F.length(F.replace("text", F.lit(" "), F.lit(""))) + 1
    docs = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        "source",
        "lang",
        (F.col("n_chars") / (F.col("n_chars") + 1000.0)).alias("probability"),
        (words / (words + 150.0)).alias("probability2"),
    )
    labels = table(spark, sf, "labels").select(
        F.col("doc_id").alias("id"), F.col("quality").alias("y"), F.col("toxic").alias("toxic")
    )
    return docs.join(labels, "id").select(
        "*",
        (F.col("probability") >= 0.5).cast("int").alias("prediction"),
        (F.col("probability2") >= 0.5).cast("int").alias("prediction2"),
    )


SCORED = """SELECT id, source, lang, y, toxic, probability, probability2,
 CAST(probability >= 0.5 AS INTEGER) AS prediction, CAST(probability2 >= 0.5 AS INTEGER) AS prediction2 FROM (
 SELECT d.doc_id AS id, d.source, d.lang, l.quality AS y, l.toxic,
  CAST(n_chars AS DOUBLE) / (CAST(n_chars AS DOUBLE) + 1000) AS probability,
  CAST(w AS DOUBLE) / (CAST(w AS DOUBLE) + 150) AS probability2
 FROM (SELECT *, length(text) - length(replace(text, ' ', '')) + 1 AS w FROM documents) d
 JOIN labels l ON d.doc_id = l.doc_id)"""


def two_models(spark: SparkSession, sf: str) -> DataFrame:
    """Scored rows of both models, one below the other, from one read of the documents."""
    both = F.array(
        F.struct(F.lit("v1").alias("model"), F.col("probability"), F.col("prediction")),
        F.struct(
            F.lit("v2").alias("model"),
            F.col("probability2").alias("probability"),
            F.col("prediction2").alias("prediction"),
        ),
    )
    return scored(spark, sf).select("id", "y", "toxic", F.explode(both).alias("m")).select("id", "y", "toxic", "m.*")


TWO = """SELECT id, y, toxic, 'v1' AS model, probability, prediction FROM scored
 UNION ALL SELECT id, y, toxic, 'v2', probability2, prediction2 FROM scored"""


# --- drift pairs ------------------------------------------------------------


def shipped(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem before and after a date: no drift."""
    items = table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice", "l_returnflag", "l_linestatus", "l_shipdate")
    return one_table(items, F.col("l_shipdate") < F.lit(DRIFT_DATE).cast("timestamp_ntz"))


def by_quantity(spark: SparkSession, sf: str) -> DataFrame:
    """lineitem with small and large quantities: order value and its band drift."""
    value = F.col("l_quantity") * F.col("l_extendedprice")
    items = table(spark, sf, "lineitem").select(
        "l_quantity",
        "l_discount",
        value.alias("value"),
        F.when(value < 500_000, "low").when(value < 1_500_000, "mid").otherwise("high").alias("band"),
        "l_returnflag",
    )
    return one_table(items, F.col("l_quantity") <= 25)


SHIP = f"""SELECT l_quantity, l_extendedprice, l_returnflag, l_linestatus,
 CAST(l_shipdate < TIMESTAMP '{DRIFT_DATE}' AS INTEGER) AS base FROM lineitem"""
QTY = """SELECT l_quantity, l_discount, value, l_returnflag, base,
 CASE WHEN value < 500000 THEN 'low' WHEN value < 1500000 THEN 'mid' ELSE 'high' END AS band FROM (
 SELECT l_quantity, l_discount, l_quantity * l_extendedprice AS value, l_returnflag,
  CAST(l_quantity <= 25 AS INTEGER) AS base FROM lineitem)"""


# --- registry ---------------------------------------------------------------


def registry(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """(versions, metrics): one model name per nation, suppliers as versions."""
    sup = table(spark, sf, "supplier")
    digit = F.col("s_suppkey") % 10
    firsts = sup.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("first"))
    versions = sup.join(firsts, "s_nationkey").select(
        F.concat(F.lit("model-"), F.col("s_nationkey").cast("string")).alias("name"),
        F.col("s_suppkey").cast("int").alias("version"),
        F.when((F.col("s_suppkey") == F.col("first")) & (F.col("s_nationkey") % 5 != 0), "Production")
        .when(digit.between(1, 3), "None")
        .when(digit.between(4, 6), "Staging")
        .otherwise("Archived")
        .alias("stage"),
        F.concat(F.lit("run-"), F.col("s_suppkey").cast("string")).alias("run_id"),
    )
    present = sup.where(F.col("s_suppkey") % 7 != 0)
    metric = F.array(
        F.struct(F.lit("recall").alias("metric"), (F.col("s_acctbal") / 10000.0).alias("value")),
        F.struct(F.lit("accuracy").alias("metric"), (F.col("s_acctbal") / 30000.0).alias("value")),
    )
    metrics = present.select(
        F.concat(F.lit("run-"), F.col("s_suppkey").cast("string")).alias("run_id"), F.explode(metric).alias("m")
    ).select("run_id", "m.*")
    return versions, metrics


REG = """versions AS (SELECT 'model-' || CAST(s_nationkey AS VARCHAR) AS name, CAST(s_suppkey AS INTEGER) AS version,
  CASE WHEN s_suppkey = first AND s_nationkey % 5 <> 0 THEN 'Production' WHEN s_suppkey % 10 BETWEEN 1 AND 3 THEN 'None'
   WHEN s_suppkey % 10 BETWEEN 4 AND 6 THEN 'Staging' ELSE 'Archived' END AS stage,
  'run-' || CAST(s_suppkey AS VARCHAR) AS run_id
  FROM (SELECT *, min(s_suppkey) OVER (PARTITION BY s_nationkey) AS first FROM supplier)),
 metrics AS (SELECT 'run-' || CAST(s_suppkey AS VARCHAR) AS run_id, 'recall' AS metric, s_acctbal / CAST(10000 AS DOUBLE) AS value
  FROM supplier WHERE s_suppkey % 7 <> 0 UNION ALL
  SELECT 'run-' || CAST(s_suppkey AS VARCHAR), 'accuracy', s_acctbal / CAST(30000 AS DOUBLE) FROM supplier WHERE s_suppkey % 7 <> 0),
 scoredv AS (SELECT v.name, v.version, CASE WHEN v.stage = 'None' THEN 'Staging' ELSE v.stage END AS stage, v.run_id,
  coalesce(m.value, 0) AS score FROM versions v LEFT JOIN (SELECT * FROM metrics WHERE metric = 'recall') m ON v.run_id = m.run_id),
 best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY name ORDER BY score DESC, version) AS rn
  FROM scoredv WHERE stage = 'Staging' AND score > -1) WHERE rn = 1),
 prod AS (SELECT * FROM scoredv WHERE stage = 'Production'),
 decision AS (SELECT n.name, b.version AS candidate_version, b.run_id AS candidate_run_id, b.score AS candidate_metric,
  p.version AS production_version_before, p.score AS production_metric_before,
  (b.version IS NOT NULL AND (p.version IS NULL OR b.score > p.score)) AS promoted,
  CASE WHEN b.version IS NULL THEN 'NO_CANDIDATE' WHEN p.version IS NULL OR b.score > p.score THEN 'PROMOTED'
   ELSE 'ARCHIVED' END AS decision,
  CASE WHEN b.version IS NOT NULL AND (p.version IS NULL OR b.score > p.score) THEN b.version ELSE p.version END
   AS production_version_after
  FROM (SELECT DISTINCT name FROM versions) n LEFT JOIN best b ON n.name = b.name LEFT JOIN prod p ON n.name = p.name)"""


# --- landed text with faults ------------------------------------------------

DOC_SPEC = TableSpec(
    name="documents",
    key="doc_id",
    rules=(
        ColumnRule("doc_id", "int", lo=0),
        ColumnRule("lang", allowed=("en", "fr", "de")),
        ColumnRule("source"),
        ColumnRule("n_chars", "int", lo=20, hi=50_000),
        ColumnRule("rate", "float", lo=0),
        ColumnRule("note", "numeric_text", nullable=True),
    ),
)


def landed(spark: SparkSession, sf: str) -> DataFrame:
    """Document facts as text, some rows broken by a rule on the id."""
    slot = F.col("doc_id") % 50
    n = F.col("n_chars").cast("string")
    return table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("doc_id"),
        "lang",
        F.when(slot != 7, F.col("source")).alias("source"),
        F.when(slot == 0, "One Hundred").when(slot == 1, "-5").when(slot == 2, "12.5").otherwise(n).alias("n_chars"),
        F.when(slot == 3, "INVALID_NUMBER").when(slot == 4, "-0.5").otherwise(F.concat(n, F.lit(".5"))).alias("rate"),
        F.when(slot == 5, " ").when(slot == 6, F.lit(None)).when(slot == 8, "x1").otherwise(n).alias("note"),
    )


LANDED = """SELECT CAST(doc_id AS VARCHAR) AS doc_id, lang, CASE WHEN doc_id % 50 <> 7 THEN source END AS source,
 CASE doc_id % 50 WHEN 0 THEN 'One Hundred' WHEN 1 THEN '-5' WHEN 2 THEN '12.5' ELSE CAST(n_chars AS VARCHAR) END AS n_chars,
 CASE doc_id % 50 WHEN 3 THEN 'INVALID_NUMBER' WHEN 4 THEN '-0.5' ELSE CAST(n_chars AS VARCHAR) || '.5' END AS rate,
 CASE doc_id % 50 WHEN 5 THEN ' ' WHEN 6 THEN NULL WHEN 8 THEN 'x1' ELSE CAST(n_chars AS VARCHAR) END AS note FROM documents"""

NUM = r"'^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$'"
INT = r"'^[+-]?[0-9]+$'"

# Every check of DOC_SPEC, spelled out: (column, check, failing value condition).
DOC_FAILURES = "\n UNION ALL ".join(
    f"SELECT doc_id AS key, 'Column' AS schema_context, '{c}' AS \"column\", '{k}' AS \"check\", {c} AS failure_case FROM landed WHERE {w}"
    for c, k, w in (
        ("doc_id", "not_nullable", "doc_id IS NULL"),
        ("doc_id", "dtype(int)", f"NOT regexp_full_match(trim(doc_id), {INT})"),
        ("doc_id", "ge(0)", "TRY_CAST(doc_id AS DOUBLE) < 0"),
        ("lang", "not_nullable", "lang IS NULL"),
        ("lang", "isin", "lang NOT IN ('en', 'fr', 'de')"),
        ("source", "not_nullable", "source IS NULL"),
        ("n_chars", "not_nullable", "n_chars IS NULL"),
        ("n_chars", "dtype(int)", f"NOT regexp_full_match(trim(n_chars), {INT})"),
        ("n_chars", "ge(20)", "TRY_CAST(n_chars AS DOUBLE) < 20"),
        ("n_chars", "le(50000)", "TRY_CAST(n_chars AS DOUBLE) > 50000"),
        ("rate", "not_nullable", "rate IS NULL"),
        ("rate", "dtype(float)", f"NOT regexp_full_match(trim(rate), {NUM})"),
        ("rate", "ge(0)", "TRY_CAST(rate AS DOUBLE) < 0"),
        ("note", "blank_or_numeric", f"trim(note) <> '' AND NOT regexp_full_match(trim(note), {NUM})"),
    )
)


# --- embeddings as encoded features ----------------------------------------


def encoded(spark: SparkSession, sf: str) -> DataFrame:
    """id, 64 features as array<double>, y = (label < 5), split by id."""
    return table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("id"),
        F.col("embedding").cast("array<double>").alias("x"),
        (F.col("label") < 5).cast("int").alias("y"),
        F.when(F.col("vec_id") % 5 == 0, "test").otherwise("train").alias("split"),
    )


ENC = """SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS x, CAST(label < 5 AS INTEGER) AS y,
 CASE WHEN vec_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM embeddings"""


def with_sql(body: str, **ctes: str) -> str:
    """A query over named sub-queries."""
    return "WITH " + ", ".join(f"{n} AS ({q})" for n, q in ctes.items()) + " " + body
