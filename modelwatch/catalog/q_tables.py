"""Cleaning, membership, profiles, order, sampling."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.catalog.proxies import (
    CUST,
    DRIFT_DATE,
    LANDED,
    LOG,
    NUM,
    REG,
    SCORED,
    SHIP,
    customers,
    landed,
    log,
    registry,
    rounded,
    scored,
    shipped,
    table,
    with_sql,
)
from modelwatch.catalog.registry import query
from modelwatch.functions import scalars as S
from modelwatch.operators import drift, membership, metrics, ordered, profile, sampling
from modelwatch.plans import lifecycle
from modelwatch.sources.fingerprint import row_digest

# --- cleaning and scalar functions ------------------------------------------


@query("c1_drop_identity", with_sql("SELECT contract, nation, senior, tenure FROM cust", cust=CUST))
def c1(spark: SparkSession, sf: str) -> DataFrame:
    slim = customers(spark, sf).select("id", "contract", "nation", "senior", "tenure", "churn")
    return S.drop_identity(slim, "id", "churn")


@query(
    "c2_text_to_number",
    with_sql(
        f"""SELECT doc_id, CASE WHEN regexp_full_match(trim(n_chars), {NUM}) THEN TRY_CAST(trim(n_chars) AS DOUBLE) END AS n_chars,
 CASE WHEN regexp_full_match(trim(note), {NUM}) THEN TRY_CAST(trim(note) AS DOUBLE) END AS note FROM landed""",
        landed=LANDED,
    ),
)
def c2(spark: SparkSession, sf: str) -> DataFrame:
    return landed(spark, sf).select("doc_id", S.parse_number("n_chars").alias("n_chars"), S.parse_number("note").alias("note"))


@query(
    "c3_label_encoding",
    with_sql(
        """SELECT id, CAST(churn = 'Yes' AS INTEGER) AS lenient, CAST(senior = 1 OR churn = 'Yes' AS INTEGER) AS either,
 CASE WHEN contract = 'MACHINERY' THEN 1 WHEN contract = 'BUILDING' THEN 0 END AS strict FROM cust""",
        cust=CUST,
    ),
)
def c3(spark: SparkSession, sf: str) -> DataFrame:
    mixed = F.when(F.col("senior") == 1, F.lit("1")).otherwise(F.concat(F.lit(" "), F.upper("churn")))
    return customers(spark, sf).select(
        "id",
        S.encode_label("churn").alias("lenient"),
        S.encode_label(mixed, ("1", "yes")).alias("either"),
        S.encode_label("contract", ("MACHINERY",), ("BUILDING",), strict=True).alias("strict"),
    )


@query(
    "c4_fill_zero",
    with_sql(
        f"SELECT doc_id, coalesce(CASE WHEN regexp_full_match(trim(note), {NUM}) THEN TRY_CAST(trim(note) AS DOUBLE) END, 0) AS note FROM landed",
        landed=LANDED,
    ),
)
def c4(spark: SparkSession, sf: str) -> DataFrame:
    return landed(spark, sf).select("doc_id", S.fill_zero(S.parse_number("note")).alias("note"))


@query("c5_map_values", with_sql("SELECT id, CASE senior WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS senior FROM cust", cust=CUST))
def c5(spark: SparkSession, sf: str) -> DataFrame:
    return customers(spark, sf).select("id", S.map_values("senior", {0: "No", 1: "Yes"}).alias("senior"))


BUCKET_SQL = """CASE WHEN tenure <= 12 THEN '0-1yr' WHEN tenure <= 24 THEN '1-2yr' WHEN tenure <= 48 THEN '2-4yr' ELSE '4yr+' END"""


@query("c6_bucketize", with_sql(f"SELECT id, {BUCKET_SQL} AS bucket FROM cust", cust=CUST))
def c6(spark: SparkSession, sf: str) -> DataFrame:
    from modelwatch.schema import TENURE_EDGES, TENURE_LABELS

    return customers(spark, sf).select("id", S.bucketize("tenure", TENURE_EDGES, TENURE_LABELS).alias("bucket"))


@query(
    "c7_count_active",
    """SELECT l_returnflag, l_linestatus, CAST((CASE WHEN l_returnflag IN ('N', 'O') THEN 0 ELSE 1 END)
 + (CASE WHEN l_linestatus IN ('N', 'O') THEN 0 ELSE 1 END) AS INTEGER) AS active, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""",
)
def c7(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    active = S.count_active(["l_returnflag", "l_linestatus"], ["N", "O"])
    return items.groupBy("l_returnflag", "l_linestatus", active.alias("active")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "c9_derived_total",
    "SELECT p_partkey, round_even(p_size * 12.5 + 0.125, 2) AS total FROM (SELECT p_partkey, CAST(p_size AS DOUBLE) AS p_size FROM part)",
)
def c9(spark: SparkSession, sf: str) -> DataFrame:
    monthly = F.col("p_size") * 12.5 + 0.125
    return table(spark, sf, "part").select("p_partkey", S.derived_total(monthly, F.lit(1)).alias("total"))


@query(
    "c10_clip_round",
    "SELECT c_custkey, CAST(round_even(least(greatest(c_acctbal / 100, 0), 72), 0) AS INTEGER) AS clipped FROM customer",
)
def c10(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").select("c_custkey", S.clip_to_int(F.col("c_acctbal") / 100, 0.0, 72.0).alias("clipped"))


@query("c11_strip_key", with_sql("SELECT request_id, k FROM log", log=LOG))
def c11(spark: SparkSession, sf: str) -> DataFrame:
    events = log(spark, sf).withColumn("payload", F.struct("request_id", F.col("input.k").alias("k")))
    return events.select("request_id", S.strip_key("payload", "request_id").alias("p")).select("request_id", "p.*")


@query(
    "c12_any_cell_equals",
    """SELECT (SELECT count(*) FROM customer AS c, unnest(json_extract_string(to_json(c), '$.*')) AS t(v) WHERE upper(trim(v)) = 'MACHINERY') > 0 AS found""",
)
def c12(spark: SparkSession, sf: str) -> DataFrame:
    return S.any_cell_equals(table(spark, sf, "customer"), "machinery")


@query("c13_ordered_names", "SELECT r_name AS region, string_agg(n_name, ', ' ORDER BY n_nationkey) AS names FROM nation JOIN region ON n_regionkey = r_regionkey GROUP BY 1")
def c13(spark: SparkSession, sf: str) -> DataFrame:
    nation, region = table(spark, sf, "nation"), table(spark, sf, "region")
    joined = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    return joined.groupBy(F.col("r_name").alias("region")).agg(S.ordered_names("n_name", "n_nationkey").alias("names"))


@query("c14_to_class", with_sql("SELECT id, CAST(probability >= 0.45 AS INTEGER) AS prediction FROM scored", scored=SCORED))
def c14(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("id", S.to_class("probability", 0.45).alias("prediction"))


@query("c15_rounding", with_sql("SELECT id, round(probability, 4) AS p4, round(probability2, 6) AS p6 FROM scored", scored=SCORED))
def c15(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("id", F.round("probability", 4).alias("p4"), F.round("probability2", 6).alias("p6"))


@query(
    "c16_next_version",
    """SELECT CAST(max(CASE WHEN doc_id % 3 = 0 THEN doc_id % 60 ELSE 0 END) AS INTEGER) AS highest,
 printf('v%02d', max(CASE WHEN doc_id % 3 = 0 THEN doc_id % 60 ELSE 0 END) + 1) AS next_tag FROM documents""",
)
def c16(spark: SparkSession, sf: str) -> DataFrame:
    number = F.format_string("%02d", F.col("doc_id") % 60)
    name = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit("archive/churn_v"), number, F.lit(".csv"))).otherwise(
        F.concat(F.lit("archive/notes_"), number, F.lit(".txt"))
    )
    return S.next_version(table(spark, sf, "documents").select(name.alias("file")), "file", "churn")


@query("c17_parse_timestamp", with_sql("SELECT request_id, us - 3600000000 AS us FROM log", log=LOG))
def c17(spark: SparkSession, sf: str) -> DataFrame:
    text = F.concat(F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+01:00"))
    return log(spark, sf).select("request_id", F.unix_micros(S.parse_timestamp(text)).alias("us"))


@query("c18_flatten_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def c18(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "props")
    return S.flatten_json(events, "props", T.StructType([T.StructField("k", T.IntegerType())]))


# --- joins and membership ----------------------------------------------------

IDS = "SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT'"


def _ids(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").where("o_orderpriority = '1-URGENT'").select(F.col("o_custkey").alias("c_custkey"))


@query("d1_holdout_side", f"SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey IN ({IDS})")
def d1(spark: SparkSession, sf: str) -> DataFrame:
    who = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return membership.require_holdout(who, _ids(spark, sf), "c_custkey")


@query("d2_training_side", f"SELECT c_custkey, c_mktsegment FROM customer WHERE c_custkey NOT IN ({IDS})")
def d2(spark: SparkSession, sf: str) -> DataFrame:
    who = table(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    return membership.training_side(who, _ids(spark, sf), "c_custkey")


@query("d3_id_overlap", "SELECT count(*) AS n FROM (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 25 INTERSECT SELECT l_orderkey FROM lineitem WHERE l_quantity <= 25)")
def d3(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    both = membership.common_ids(items.where("l_quantity > 25"), items.where("l_quantity <= 25"), "l_orderkey")
    return both.agg(F.count(F.lit(1)).alias("n"))


@query("d4_already_seen", "SELECT DISTINCT sha256(CAST(to_json(struct_pack(text := text)) AS VARCHAR)) AS fingerprint FROM documents WHERE doc_id % 2 = 1 AND text IN (SELECT text FROM documents WHERE doc_id % 2 = 0)")
def d4(spark: SparkSession, sf: str) -> DataFrame:
    digests = table(spark, sf, "documents").select("doc_id", row_digest(["text"]).alias("fingerprint"))
    ledger = digests.where("doc_id % 2 = 0").select(F.col("fingerprint").alias("new_data_hash"))
    return membership.already_seen(digests.where("doc_id % 2 = 1").select("fingerprint").distinct(), ledger)


@query("d5_version_metrics", f"WITH {REG} SELECT v.name, v.version, v.stage, v.run_id, round(coalesce(m.value, 0), 6) AS score FROM versions v LEFT JOIN (SELECT * FROM metrics WHERE metric = 'recall') m ON v.run_id = m.run_id")
def d5(spark: SparkSession, sf: str) -> DataFrame:
    versions, metric_rows = registry(spark, sf)
    return rounded(lifecycle.version_metrics(versions, metric_rows, "recall"))


@query(
    "d6_align_categories",
    """SELECT 'c_mktsegment' AS feature, c_mktsegment AS category, CAST(sum(CAST(c_acctbal < 0 AS INTEGER)) AS BIGINT) AS base,
 CAST(sum(CAST(c_acctbal >= 0 AS INTEGER)) AS BIGINT) AS cur FROM customer GROUP BY 2""",
)
def d6(spark: SparkSession, sf: str) -> DataFrame:
    who = table(spark, sf, "customer").select("c_mktsegment", "c_acctbal")
    both = drift.two_tables(who.where("c_acctbal < 0"), who.where("c_acctbal >= 0"))
    return drift.category_counts(both, ["c_mktsegment"])


@query(
    "d7_metric_changes",
    with_sql(
        """SELECT metric, round(a, 6) AS quality, round(b, 6) AS toxic, round(b - a, 6) AS change FROM (
 SELECT 'accuracy' AS metric, avg(CAST(y = prediction AS INTEGER)) AS a, avg(CAST(toxic = prediction AS INTEGER)) AS b FROM scored
 UNION ALL SELECT 'recall', avg(prediction) FILTER (y = 1), avg(prediction) FILTER (toxic = 1) FROM scored)""",
        scored=SCORED,
    ),
)
def d7(spark: SparkSession, sf: str) -> DataFrame:
    rows = scored(spark, sf)
    names = ("accuracy", "recall")
    a = metrics.long_metrics(metrics.classification_metrics(rows, "y", "prediction"), (), names)
    b = metrics.long_metrics(metrics.classification_metrics(rows, "toxic", "prediction"), (), names)
    return rounded(metrics.metric_changes(a, b, ("quality", "toxic")))


@query("d8_attach_predictions", with_sql("SELECT id, source, lang, y, prediction FROM scored", scored=SCORED))
def d8(spark: SparkSession, sf: str) -> DataFrame:
    return scored(spark, sf).select("id", "source", "lang", "y", "prediction")


# --- aggregates ----------------------------------------------------------------


@query(
    "e1_class_distribution",
    with_sql(
        "SELECT source AS value, count(*) AS n, round(count(*) * 100.0 / (SELECT count(source) FROM landed), 6) AS percent FROM landed WHERE source IS NOT NULL GROUP BY 1",
        landed=LANDED,
    ),
)
def e1(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.class_distribution(landed(spark, sf), "source"))


def _rate_sql(cols: tuple[str, ...], source: str = "cust") -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", CAST({c} AS VARCHAR) AS value, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives,
 round(avg(y), 6) AS rate FROM {source} GROUP BY 2"""
        for c in cols
    )


@query("e2_rate_by", with_sql(_rate_sql(("contract", "nation", "senior")), cust=CUST))
def e2(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.rate_by(customers(spark, sf), ["contract", "nation", "senior"], F.col("churn") == "Yes"))


@query(
    "e3_rate_by_bucket",
    with_sql(
        f"SELECT 'bucket' AS \"column\", {BUCKET_SQL} AS value, count(*) AS n, CAST(sum(y) AS BIGINT) AS positives, round(avg(y), 6) AS rate FROM cust GROUP BY 2",
        cust=CUST,
    ),
)
def e3(spark: SparkSession, sf: str) -> DataFrame:
    from modelwatch.schema import TENURE_EDGES, TENURE_LABELS

    rows = customers(spark, sf).withColumn("bucket", S.bucketize("tenure", TENURE_EDGES, TENURE_LABELS))
    return rounded(profile.rate_by(rows, ["bucket"], F.col("y") == 1))


def _describe_sql(cols: tuple[str, ...], source: str, by: str = "") -> str:
    lead = f"{by}, " if by else ""
    tail = f" GROUP BY {by}" if by else ""
    return " UNION ALL ".join(
        f"""SELECT {lead}'{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
 round(CAST(min({c}) AS DOUBLE), 6) AS min, round(CAST(max({c}) AS DOUBLE), 6) AS max,
 round(quantile_cont(CAST({c} AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST({c} AS DOUBLE), 0.5), 6) AS q50,
 round(quantile_cont(CAST({c} AS DOUBLE), 0.75), 6) AS q75 FROM {source}{tail}"""
        for c in cols
    )


@query("e4_describe", _describe_sql(("l_quantity", "l_extendedprice", "l_discount"), "lineitem"))
def e4(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@query("e4_describe_in_blocks", _describe_sql(("l_quantity", "l_extendedprice", "l_discount"), "lineitem"))
def e4_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The path of large data: only blocks that hold a quartile are looked into, and cut again while they are crowded."""
    return rounded(profile.describe(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"], rows_per_block=150))


@query("e4_describe_by_group", _describe_sql(("value",), "events", "event_type"))
def e4_by(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.describe(table(spark, sf, "events"), ["value"], ["event_type"]))


@query(
    "e8_dataset_summary",
    with_sql(
        " UNION ALL ".join(
            f"""SELECT '{n}' AS dataset, count(*) AS rows, count(*) FILTER (y = 1) AS churn, count(*) FILTER (y = 0) AS non_churn,
 round(avg(y), 6) AS churn_rate FROM cust WHERE {w}"""
            for n, w in (("original", "senior = 0"), ("batch", "senior = 1"), ("updated", "true"))
        ),
        cust=CUST,
    ),
)
def e8(spark: SparkSession, sf: str) -> DataFrame:
    rows = customers(spark, sf)
    a, b = rows.where("senior = 0"), rows.where("senior = 1")
    return profile.dataset_summary({"original": a, "batch": b, "updated": membership.append_batch(a, b)}, "y")


@query(
    "e9_corr_matrix",
    " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, round(corr({a}, {b}), 6) AS r FROM lineitem"
        for a, b in (("l_quantity", "l_extendedprice"), ("l_quantity", "l_discount"), ("l_extendedprice", "l_discount"))
    ),
)
def e9(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.corr_matrix(table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"]))


@query(
    "e10_histogram",
    "SELECT CAST(least(floor(l_quantity / 5) + 1, 10) AS INTEGER) AS bin, count(*) AS n FROM lineitem WHERE l_quantity BETWEEN 0 AND 50 GROUP BY 1",
)
def e10(spark: SparkSession, sf: str) -> DataFrame:
    return profile.histogram(table(spark, sf, "lineitem"), "l_quantity", 0, 50, 10)


@query(
    "e11_box_numbers",
    """SELECT event_type, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 round(min(value) FILTER (value >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low, round(max(value) FILTER (value <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
 count(*) FILTER (value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outliers
 FROM events JOIN (SELECT event_type, count(*) AS n, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS median,
 quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1) USING (event_type) GROUP BY event_type, n, q1, median, q3""",
)
def e11(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.box_numbers(table(spark, sf, "events"), "value", "event_type"))


@query(
    "e11_box_in_blocks",
    """SELECT l_returnflag, n, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3,
 round(min(l_extendedprice) FILTER (l_extendedprice >= q1 - 1.5 * (q3 - q1)), 6) AS whisker_low,
 round(max(l_extendedprice) FILTER (l_extendedprice <= q3 + 1.5 * (q3 - q1)), 6) AS whisker_high,
 count(*) FILTER (l_extendedprice < q1 - 1.5 * (q3 - q1) OR l_extendedprice > q3 + 1.5 * (q3 - q1)) AS outliers
 FROM lineitem JOIN (SELECT l_returnflag, count(*) AS n, quantile_cont(l_extendedprice, 0.25) AS q1, quantile_cont(l_extendedprice, 0.5) AS median,
 quantile_cont(l_extendedprice, 0.75) AS q3 FROM lineitem GROUP BY 1) USING (l_returnflag) GROUP BY l_returnflag, n, q1, median, q3""",
)
def e11_blocks(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.box_numbers(table(spark, sf, "lineitem"), "l_extendedprice", "l_returnflag", rows_per_block=20))


@query("e12_duplicate_count", "SELECT CAST(count(*) - count(DISTINCT text) AS BIGINT) AS duplicates FROM documents")
def e12(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_count(table(spark, sf, "documents"), ["text"])


@query(
    "e12_duplicate_rows",
    """SELECT l_orderkey, l_linenumber, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS copies,
 row_number() OVER (PARTITION BY l_orderkey, l_linenumber) AS copy FROM lineitem
 QUALIFY count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1""",
)
def e12_rows(spark: SparkSession, sf: str) -> DataFrame:
    return profile.duplicate_rows(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query(
    "e13_distinct_values",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {c} AS value, count(*) AS n FROM documents GROUP BY 2" for c in ("lang", "source")
    ),
)
def e13(spark: SparkSession, sf: str) -> DataFrame:
    return profile.distinct_values(table(spark, sf, "documents"), ["lang", "source"])


@query(
    "e14_table_profile",
    with_sql(
        " UNION ALL ".join(
            f"SELECT {i} AS position, '{c}' AS \"column\", 'string' AS dtype, count(*) AS rows, count({c}) AS non_null FROM landed"
            for i, c in enumerate(("doc_id", "lang", "source", "n_chars", "rate", "note"))
        ),
        landed=LANDED,
    ),
)
def e14(spark: SparkSession, sf: str) -> DataFrame:
    return profile.table_profile(landed(spark, sf))


@query(
    "e15_prediction_summary",
    with_sql(
        """SELECT count(*) AS total, count(*) FILTER (prediction = 1) AS positives, count(*) FILTER (prediction = 0) AS negatives,
 round(avg(probability), 6) AS mean_probability, round(stddev_pop(probability), 6) AS std_probability,
 round(min(probability), 6) AS min_probability, round(max(probability), 6) AS max_probability,
 round(count(*) FILTER (prediction = 1) * 100.0 / count(*), 6) AS positive_percent,
 round(count(*) FILTER (prediction = 0) * 100.0 / count(*), 6) AS negative_percent,
 round(quantile_cont(probability, 0.5), 6) AS median_probability FROM scored""",
        scored=SCORED,
    ),
)
def e15(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.prediction_summary(scored(spark, sf), "prediction", "probability"))


@query(
    "e16_class_weights",
    """SELECT count(*) FILTER (quality = 0) AS negatives, count(*) FILTER (quality = 1) AS positives,
 round(count(*) FILTER (quality = 0) / count(*) FILTER (quality = 1), 6) AS imbalance,
 round(count(*) / (2 * count(*) FILTER (quality = 0)), 6) AS weight_0,
 round(count(*) / (2 * count(*) FILTER (quality = 1)), 6) AS weight_1 FROM labels""",
)
def e16(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.class_weights(table(spark, sf, "labels"), "quality"))


@query(
    "e17_mean_shift",
    with_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", round(avg({c}) FILTER (base = 1), 6) AS baseline_mean,
 round(avg({c}) FILTER (base = 0), 6) AS incoming_mean, round(avg({c}) FILTER (base = 0) - avg({c}) FILTER (base = 1), 6) AS shift FROM ship"""
            for c in ("l_quantity", "l_extendedprice")
        ),
        ship=SHIP,
    ),
)
def e17(spark: SparkSession, sf: str) -> DataFrame:
    return rounded(profile.mean_shift(shipped(spark, sf), ["l_quantity", "l_extendedprice"]))


@query(
    "e18_check_rollup",
    """SELECT l_linenumber AS repetition, count(*) AS checks, bool_and(l_discount < 0.1) AS passed,
 CASE WHEN bool_and(l_discount < 0.1) THEN 'PASSED' ELSE 'FAILED' END AS status FROM lineitem GROUP BY 1
 UNION ALL SELECT NULL, count(*), bool_and(l_discount < 0.1), CASE WHEN bool_and(l_discount < 0.1) THEN 'PASSED' ELSE 'FAILED' END FROM lineitem""",
)
def e18(spark: SparkSession, sf: str) -> DataFrame:
    results = table(spark, sf, "lineitem").select("l_linenumber", (F.col("l_discount") < 0.1).alias("passed"))
    return profile.check_rollup(results, "l_linenumber", "passed")


# --- order, windows, top-k -----------------------------------------------------


@query(
    "f1_equal_windows",
    """SELECT CAST(w AS INTEGER) AS "window", count(*) AS n, min(event_id) AS first_id, max(event_id) AS last_id,
 CAST(sum(event_id) AS BIGINT) AS id_sum FROM (SELECT event_id, ntile(7) OVER (ORDER BY value, event_id) AS w FROM events) GROUP BY 1""",
)
def f1(spark: SparkSession, sf: str) -> DataFrame:
    events = table(spark, sf, "events").select("event_id", "value")
    return ordered.equal_windows(events, ["value", "event_id"], 7).groupBy("window").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_id").alias("first_id"),
        F.max("event_id").alias("last_id"),
        F.sum("event_id").alias("id_sum"),
    )


@query("f7_top_by_value", "SELECT p_name, p_brand, p_partkey, round(p_retailprice, 6) AS importance FROM part ORDER BY p_retailprice DESC, p_partkey LIMIT 20")
def f7(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select("p_name", "p_brand", "p_partkey", F.col("p_retailprice").alias("importance"))
    return rounded(part.orderBy(F.col("importance").desc(), "p_partkey").limit(20))


@query("f8_versions_desc", f"WITH {REG} SELECT name, version, stage, run_id FROM versions")
def f8(spark: SparkSession, sf: str) -> DataFrame:
    return lifecycle.by_version_desc(registry(spark, sf)[0])


@query("f6_arg_max", f"WITH {REG} SELECT name, version, run_id, round(score, 6) AS score FROM best")
def f6(spark: SparkSession, sf: str) -> DataFrame:
    versions, metric_rows = registry(spark, sf)
    staged = lifecycle.version_metrics(lifecycle.intake(versions), metric_rows, "recall").where("stage = 'Staging'")
    return rounded(lifecycle.best_version(staged, ["name"]))


@query(
    "f9_empirical_cdf",
    with_sql(
        """SELECT value, sum(b) OVER w AS cum_base, sum(c) OVER w AS cum_cur, (SELECT sum(base) FROM ship)::BIGINT AS total_base,
 (SELECT sum(1 - base) FROM ship)::BIGINT AS total_cur FROM (SELECT l_quantity AS value, sum(base) AS b, sum(1 - base) AS c FROM ship GROUP BY 1)
 WINDOW w AS (ORDER BY value)""",
        ship=SHIP,
    ).replace("sum(b) OVER w", "CAST(sum(b) OVER w AS BIGINT)").replace("sum(c) OVER w", "CAST(sum(c) OVER w AS BIGINT)"),
)
def f9(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    early = (F.col("l_shipdate") < F.lit(DRIFT_DATE).cast("timestamp_ntz")).cast("int")
    per_value = items.groupBy(F.col("l_quantity").alias("value")).agg(
        F.sum(early).alias("base"), F.sum(1 - early).alias("cur")
    )
    # Cuts are given here so that the block path runs at every scale.
    blocked = ordered.with_block(per_value, "value", [10.0, 20.0, 30.0])
    return ordered.running_totals(blocked, "value", ["base", "cur"]).drop("base", "cur")


@query(
    "f10_average_rank",
    with_sql(
        """SELECT probability AS score, n, round(c - n + (n + 1) / 2, 6) AS average_rank FROM (
 SELECT round(probability, 12) AS probability, n, sum(n) OVER (ORDER BY probability) AS c FROM (
 SELECT probability, count(*) AS n FROM scored GROUP BY 1))""",
        scored=SCORED,
    ),
)
def f10(spark: SparkSession, sf: str) -> DataFrame:
    totals = metrics.score_totals(scored(spark, sf), "y", "probability")
    n, c = F.col("pos") + F.col("neg"), F.col("cum_pos") + F.col("cum_neg")
    return totals.select(
        F.round("score", 12).alias("score"), n.alias("n"), F.round(c - n + (n + 1) / 2, 6).alias("average_rank")
    )


# --- set operations --------------------------------------------------------------


@query("g1_append_batch", "SELECT o_orderstatus, count(*) AS n FROM (SELECT o_orderstatus FROM orders UNION ALL SELECT o_orderstatus FROM orders WHERE o_orderkey % 10 = 0) GROUP BY 1")
def g1(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    both = membership.append_batch(orders, orders.where("o_orderkey % 10 = 0"))
    return both.groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@query("g2_all_categories", "SELECT DISTINCT source FROM documents")
def g2(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return membership.all_categories(docs.where("doc_id % 2 = 0"), docs.where("doc_id % 2 = 1"), "source")


@query("g3_common_ids", "SELECT l_suppkey FROM lineitem WHERE l_discount >= 0.05 INTERSECT SELECT l_suppkey FROM lineitem WHERE l_discount < 0.05")
def g3(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    return membership.common_ids(items.where("l_discount >= 0.05"), items.where("l_discount < 0.05"), "l_suppkey")


# --- sampling and splitting --------------------------------------------------------


def _hash(key: str, seed: int) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|{seed}')"


QUOTA = """sizes AS (SELECT y, count(*) AS n FROM cust GROUP BY 1),
 exact AS (SELECT y, n, ceil(0.2 * sum(n) OVER ()) AS t, n * ceil(0.2 * sum(n) OVER ()) / sum(n) OVER () AS e FROM sizes),
 quota AS (SELECT y, floor(e) + CASE WHEN row_number() OVER (ORDER BY round(e - floor(e), 9) DESC, y) <= t - sum(floor(e)) OVER () THEN 1 ELSE 0 END AS q FROM exact)"""


@query(
    "h1_stratified_split",
    f"""WITH cust AS ({CUST}), {QUOTA} SELECT id, c.y, CASE WHEN row_number() OVER (PARTITION BY c.y ORDER BY {_hash("id", 42)}, CAST(id AS VARCHAR)) <= q
 THEN 'test' ELSE 'train' END AS split FROM cust c JOIN quota USING (y)""",
)
def h1(spark: SparkSession, sf: str) -> DataFrame:
    rows = customers(spark, sf).select("id", "y")
    return sampling.stratified_split(rows, "id", "y", 0.2, 42)


@query(
    "h1_split_many_strata",
    """WITH d AS (SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders), sizes AS (SELECT day, count(*) AS n FROM d GROUP BY 1),
 exact AS (SELECT day, n, ceil(0.15 * sum(n) OVER ()) AS t, n * ceil(0.15 * sum(n) OVER ()) / sum(n) OVER () AS e FROM sizes),
 quota AS (SELECT day, floor(e) + CASE WHEN row_number() OVER (ORDER BY round(e - floor(e), 9) DESC, day) <= t - sum(floor(e)) OVER () THEN 1 ELSE 0 END AS q FROM exact)
 SELECT o_orderkey, CASE WHEN row_number() OVER (PARTITION BY d.day ORDER BY """
    + _hash("o_orderkey", 3)
    + """, CAST(o_orderkey AS VARCHAR)) <= q THEN 'test' ELSE 'train' END AS split FROM d JOIN quota USING (day)""",
)
def h1_many(spark: SparkSession, sf: str) -> DataFrame:
    """A stratum for every day: cuts are a table that is joined to the rows."""
    rows = table(spark, sf, "orders").select("o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))
    return sampling.stratified_split(rows, "o_orderkey", "day", 0.15, 3).select("o_orderkey", "split")


@query(
    "h2_frozen_holdout",
    f"""WITH cust AS (SELECT * FROM ({CUST}) WHERE senior = 0), {QUOTA}, ids AS (SELECT id FROM (SELECT id, q,
 row_number() OVER (PARTITION BY y ORDER BY {_hash("id", 42)}, CAST(id AS VARCHAR)) AS rn FROM cust JOIN quota USING (y)) WHERE rn <= q)
 SELECT id, CASE WHEN id IN (SELECT id FROM ids) THEN 'test' ELSE 'train' END AS side FROM ({CUST})""",
)
def h2(spark: SparkSession, sf: str) -> DataFrame:
    """Ids are frozen on the first data; a later batch only ever trains."""
    from modelwatch.session import scratch_path

    rows = customers(spark, sf).select("id", "y", "senior")
    path = scratch_path(spark, "h2")

    def make() -> DataFrame:
        first = rows.where("senior = 0").select("id", "y")
        return sampling.stratified_split(first, "id", "y").where("split = 'test'").select("id")

    membership.frozen_ids(spark, path, make)
    ids = membership.frozen_ids(spark, path, make)
    sides = {
        "test": membership.holdout_side(rows, ids, "id"),
        "train": membership.training_side(rows, ids, "id"),
    }
    return metrics.stack(sides, "side").select("id", "side")


@query("h3_sample_rows", f"SELECT c_custkey, c_name FROM customer ORDER BY {_hash('c_custkey', 7)}, CAST(c_custkey AS VARCHAR) LIMIT 37")
def h3(spark: SparkSession, sf: str) -> DataFrame:
    who = table(spark, sf, "customer").select("c_custkey", "c_name")
    return sampling.sample_rows(who, "c_custkey", 37, 7)


@query(
    "h4_sample_with_replacement",
    f"""SELECT draw, c_custkey FROM (SELECT i AS draw,
 CAST('0x' || substr(md5(CAST(i AS VARCHAR) || '|11'), 1, 15) AS BIGINT) % (SELECT count(*) FROM customer) AS r FROM range(400) t(i)) d
 JOIN (SELECT c_custkey, row_number() OVER (ORDER BY {_hash('c_custkey', 11)}, CAST(c_custkey AS VARCHAR)) - 1 AS r FROM customer) c ON d.r = c.r""",
)
def h4(spark: SparkSession, sf: str) -> DataFrame:
    who = table(spark, sf, "customer").select("c_custkey")
    return sampling.sample_with_replacement(who, "c_custkey", 400, 11).select("draw", "c_custkey")


@query(
    "h5_upper_slice",
    with_sql(
        """SELECT id FROM cust WHERE monthly >= (SELECT quantile_cont(monthly, 0.6) FROM cust)
 AND tenure >= (SELECT quantile_cont(CAST(tenure AS DOUBLE), 0.5) FROM cust)""",
        cust=CUST,
    ),
)
def h5(spark: SparkSession, sf: str) -> DataFrame:
    rows = customers(spark, sf).select("id", "monthly", "tenure")
    return sampling.upper_slice(rows, {"monthly": 0.6, "tenure": 0.5}, "monthly").select("id")


@query(
    "h5_upper_slice_in_blocks",
    """SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_extendedprice >= (SELECT quantile_cont(CAST(l_extendedprice AS DOUBLE), 0.6) FROM lineitem)
 AND l_quantity >= (SELECT quantile_cont(CAST(l_quantity AS DOUBLE), 0.5) FROM lineitem)""",
)
def h5_blocks(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice", "l_quantity")
    cutoffs = {"l_extendedprice": 0.6, "l_quantity": 0.5}
    return sampling.upper_slice(rows, cutoffs, "l_extendedprice", rows_per_block=100).select("l_orderkey", "l_linenumber")


@query(
    "h6_stratified_folds",
    f"""SELECT doc_id, quality, CAST((row_number() OVER (PARTITION BY quality ORDER BY {_hash('doc_id', 42)}, CAST(doc_id AS VARCHAR)) - 1) % 5 AS INTEGER) AS fold FROM labels""",
)
def h6(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.stratified_folds(labels, "doc_id", "quality", 5, 42)


@query(
    "h7_fraction_where",
    f"""SELECT doc_id, quality = 0 AND coalesce(rn <= floor(0.25 * n), false) AS chosen FROM (SELECT doc_id, quality,
 row_number() OVER (PARTITION BY quality ORDER BY {_hash('doc_id', 5)}, CAST(doc_id AS VARCHAR)) AS rn, count(*) OVER (PARTITION BY quality) AS n FROM labels)""",
)
def h7(spark: SparkSession, sf: str) -> DataFrame:
    labels = table(spark, sf, "labels").select("doc_id", "quality")
    return sampling.flag_fraction_where(labels, "doc_id", F.col("quality") == 0, 0.25, 5).select("doc_id", "chosen")
