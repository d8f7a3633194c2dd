"""Sources, sinks and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from modelwatch.catalog.proxies import (
    CUST,
    DOC_FAILURES,
    DOC_SPEC,
    ENC,
    LANDED,
    LOG,
    SCORED,
    customers,
    encoded,
    landed,
    log,
    rounded,
    scored,
    table,
    with_sql,
)
from modelwatch.catalog.registry import query
from modelwatch.functions.scalars import columns_by_role, resolve_column
from modelwatch.operators import checks, membership, metrics, profile
from modelwatch.operators.ordered import running_totals
from modelwatch.operators.training import fit_model, logistic_regression, score
from modelwatch.schema import ColumnRule, TableSpec
from modelwatch.session import scratch_path
from modelwatch.sources import fingerprint, models, snapshots, tables


@query(
    "a1_csv_scan",
    "SELECT c_custkey, c_name, c_nationkey, round(c_acctbal, 6) AS c_acctbal, c_mktsegment FROM customer",
)
def a1(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "a1")
    table(spark, sf, "customer").write.option("header", True).csv(path)
    types = {"c_custkey": "bigint", "c_nationkey": "int", "c_acctbal": "double"}
    back = tables.read_csv_table(spark, path).drop("_corrupt_record")
    return rounded(back.select(*[F.col(c).cast(types.get(c, "string")).alias(c) for c in back.columns]))


@query(
    "a2_log_scan",
    with_sql("SELECT request_id, us, k, prediction, round(churn_probability, 6) AS churn_probability, status FROM log", log=LOG),
)
def a2(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "a2")
    tables.write_log(log(spark, sf), path)
    back = tables.read_log(spark, path, T.StructType([T.StructField("k", T.IntegerType())]))
    return rounded(
        back.select(
            "request_id",
            F.unix_micros("timestamp").alias("us"),
            F.col("input.k").alias("k"),
            "prediction",
            "churn_probability",
            "status",
        )
    )


YEARLY = """SELECT 'v' || CAST(y AS VARCHAR) AS dataset_version, n AS new_rows,
 CAST(sum(n) OVER (ORDER BY y) - n AS BIGINT) AS previous_rows, CAST(sum(n) OVER (ORDER BY y) AS BIGINT) AS current_rows
 FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1)"""


def yearly_ledger(spark: SparkSession, sf: str) -> DataFrame:
    """A ledger with one batch per order year."""
    years = table(spark, sf, "orders").groupBy(F.year("o_orderdate").alias("y")).agg(F.count(F.lit(1)).alias("n"))
    total = running_totals(years, "y", ["n"])
    return total.select(
        F.concat(F.lit("v"), F.col("y").cast("string")).alias("dataset_version"),
        F.lit("archive").alias("archive_file"),
        F.lit("orders").alias("source_file"),
        F.sha2(F.col("y").cast("string"), 256).alias("new_data_hash"),
        (F.col("cum_n") - F.col("n")).alias("previous_rows"),
        F.col("n").alias("new_rows"),
        F.col("cum_n").alias("current_rows"),
        F.lit(None).cast("timestamp").alias("timestamp"),
    )


@query("a3_lineage_scan", f"SELECT dataset_version, previous_rows, new_rows, current_rows FROM ({YEARLY})")
def a3(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "a3")
    ledger = yearly_ledger(spark, sf)
    ledger.agg(F.to_json(F.collect_list(F.struct(*ledger.columns)))).coalesce(1).write.text(path)
    return tables.read_lineage(spark, path).select("dataset_version", "previous_rows", "new_rows", "current_rows")


@query(
    "a4_matrix_roundtrip",
    with_sql("SELECT id, y, len(x) AS width, round(x[1], 6) AS first, round(x[64], 6) AS last FROM enc", enc=ENC),
)
def a4(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "a4")
    tables.write_matrix(encoded(spark, sf), path, "id", "x", "y")
    back = tables.read_matrix(spark, path)
    return rounded(
        back.select(
            "id",
            "y",
            F.size("x").cast("bigint").alias("width"),
            F.element_at("x", 1).alias("first"),
            F.element_at("x", 64).alias("last"),
        )
    )


@query("a5_report_csv", "SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1")
def a5(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "a5")
    tables.write_report(profile.class_distribution(table(spark, sf, "customer"), "c_mktsegment"), path)
    return tables.read_csv_table(spark, path).select("value", F.col("n").cast("bigint").alias("n"))


@query("a6_log_append", with_sql("SELECT status, model_version, count(*) AS n FROM log GROUP BY 1, 2", log=LOG))
def a6(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "a6")
    events = log(spark, sf)
    first = F.col("latency_ms") < 10
    tables.write_log(events.where(first), path)
    tables.write_log(events.where(~first), path)
    back = tables.read_log(spark, path, T.StructType([T.StructField("k", T.IntegerType())]))
    return back.groupBy("status", "model_version").agg(F.count(F.lit(1)).alias("n"))


@query(
    "a7_snapshot_visibility",
    "SELECT 'before' AS moment, count(*) AS n FROM orders WHERE o_orderkey % 4 <> 0 UNION ALL SELECT 'after', count(*) FROM orders",
)
def a7(spark: SparkSession, sf: str) -> DataFrame:
    """A published version is invisible until its lineage row is there."""
    root = scratch_path(spark, "a7")
    orders = table(spark, sf, "orders")
    old, new = orders.where("o_orderkey % 4 <> 0"), orders.where("o_orderkey % 4 = 0")
    snapshots.publish_batch(old, root, 1)
    snapshots.publish_batch(new, root, 2)
    before = snapshots.read_current(spark, root)
    record = spark.createDataFrame([("v02",)], "dataset_version string")
    snapshots.append_lineage(record, root)
    after = snapshots.read_current(spark, root)
    return metrics.stack({"before": before, "after": after}, "moment").groupBy("moment").agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    "a8_table_fingerprint",
    "SELECT n AS rows, sha256(concat_ws(':', CAST(n AS VARCHAR), w0, w1, w2, w3)) AS fingerprint FROM (SELECT count(*) AS n, "
    + ", ".join(f"CAST(sum(CAST('0x' || substr(d, {1 + 8 * i}, 8) AS BIGINT)) AS VARCHAR) AS w{i}" for i in range(4))
    + """ FROM (SELECT sha256(CAST(to_json(struct_pack(o_orderkey := o_orderkey, o_custkey := o_custkey,
 o_orderstatus := o_orderstatus)) AS VARCHAR)) AS d FROM orders))""",
)
def a8(spark: SparkSession, sf: str) -> DataFrame:
    cols = ["o_orderkey", "o_custkey", "o_orderstatus"]
    return fingerprint.table_fingerprint(table(spark, sf, "orders"), cols)


@query(
    "a8_file_fingerprint",
    """SELECT 'nation=' || c_nationkey AS file, CAST(strlen(t) AS BIGINT) AS length, sha256(t) AS sha256 FROM (SELECT c_nationkey,
 string_agg(c_custkey || '|' || c_name || '|' || c_mktsegment || chr(10), '' ORDER BY c_custkey) AS t FROM customer GROUP BY 1)""",
)
def a8_files(spark: SparkSession, sf: str) -> DataFrame:
    """Files of customers, one a nation; the larger ones are read in parts."""
    path = scratch_path(spark, "a8")
    line = F.concat_ws("|", "c_custkey", "c_name", "c_mktsegment").alias("value")
    rows = table(spark, sf, "customer").select(line, F.col("c_nationkey").alias("nation"), "c_custkey").repartition("nation")
    rows.sortWithinPartitions("nation", "c_custkey").drop("c_custkey").write.partitionBy("nation").text(path)
    files = fingerprint.file_fingerprints(spark, f"{path}/*/*.txt", whole_bytes=2_000, read_bytes=512)
    return files.select(F.element_at(F.split("path", "/"), -2).alias("file"), "length", "sha256")


@query(
    "a9_evaluation_document",
    with_sql(
        """SELECT 'rule' AS model_type, tp + fp + fn + tn AS test_rows, tn, fp, fn, tp,
 round(tp / (tp + fn), 6) AS recall, round((tp + tn) / (tp + fp + fn + tn), 6) AS accuracy FROM (
 SELECT count(*) FILTER (y = 0 AND prediction = 0) AS tn, count(*) FILTER (y = 0 AND prediction = 1) AS fp,
 count(*) FILTER (y = 1 AND prediction = 0) AS fn, count(*) FILTER (y = 1 AND prediction = 1) AS tp FROM scored)""",
        scored=SCORED,
    ),
)
def a9(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "a9")
    doc = tables.evaluation_document(metrics.classification_metrics(scored(spark, sf), "y", "prediction"), "rule")
    tables.write_document(doc, path)
    back = spark.read.schema(
        "model_type string, metrics map<string,double>, confusion_matrix array<array<bigint>>, test_rows bigint"
    ).json(path)
    cell = F.col("confusion_matrix")
    return rounded(
        back.select(
            "model_type",
            "test_rows",
            cell[0][0].alias("tn"),
            cell[0][1].alias("fp"),
            cell[1][0].alias("fn"),
            cell[1][1].alias("tp"),
            F.col("metrics")["recall"].alias("recall"),
            F.col("metrics")["accuracy"].alias("accuracy"),
        )
    )


@query("a10_model_bundle", with_sql("SELECT count(*) AS n, count(*) AS same FROM enc", enc=ENC))
def a10(spark: SparkSession, sf: str) -> DataFrame:
    """A saved and reloaded model scores every row as the fitted one does."""
    from pyspark.ml.functions import array_to_vector

    path = scratch_path(spark, "a10")
    df = encoded(spark, sf).withColumn("features", array_to_vector("x"))
    model = fit_model(df.where("split = 'train'"), "id", "y", None, logistic_regression("y", max_iter=20))
    models.save_bundle(spark, model, path, name="m", version="1", run_id="r1")
    fresh = score(model, df).select("id", F.col("churn_probability").alias("p"))
    both = models.score_with_bundle(spark, path, df).join(fresh, "id")
    return both.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("p") == F.col("churn_probability")).alias("same"))


@query(
    "a11_dataset_profile",
    with_sql(
        "SELECT split, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives, CAST(max(len(x)) AS INTEGER) AS width FROM enc GROUP BY 1",
        enc=ENC,
    ),
)
def a11(spark: SparkSession, sf: str) -> DataFrame:
    df = encoded(spark, sf)
    return profile.dataset_profile(df.where("split = 'train'"), df.where("split = 'test'"), "x", "y")


# --- validation -------------------------------------------------------------

STRICT = TableSpec("customer", "c_custkey", (ColumnRule("c_custkey", "int"), ColumnRule("c_mktsegment"), ColumnRule("Contract")))


@query(
    "b1_column_set",
    """SELECT CASE WHEN column_name = 'Contract' THEN 'column_in_dataframe' ELSE 'column_in_schema' END AS "check",
 column_name AS "column" FROM (SELECT 'Contract' AS column_name UNION ALL
 SELECT column_name FROM (DESCRIBE customer) WHERE column_name NOT IN ('c_custkey', 'c_mktsegment'))""",
)
def b1(spark: SparkSession, sf: str) -> DataFrame:
    return checks.validate(table(spark, sf, "customer"), STRICT).select("check", "column")


def _checks_named(*names: str):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return checks.failures_per_check(landed(spark, sf), DOC_SPEC).where(F.col("check").isin(*names))

    return run


def _checks_sql(*names: str) -> str:
    quoted = ", ".join(f"'{n}'" for n in names)
    return with_sql(
        f'SELECT "column", "check", count(*) AS n FROM ({DOC_FAILURES}) WHERE "check" IN ({quoted}) GROUP BY 1, 2',
        landed=LANDED,
    )


for _name, _wanted in {
    "b2_type_check": ("dtype(int)", "dtype(float)"),
    "b3_domain_check": ("isin",),
    "b4_lower_bound": ("ge(0)", "ge(20)"),
    "b5_not_null": ("not_nullable",),
    "b6_blank_or_numeric": ("blank_or_numeric",),
}.items():
    query(_name, _checks_sql(*_wanted))(_checks_named(*_wanted))


@query("b7_validate_failures", with_sql(DOC_FAILURES, landed=LANDED))
def b7(spark: SparkSession, sf: str) -> DataFrame:
    return checks.validate(landed(spark, sf), DOC_SPEC)


@query(
    "b7_verdict",
    with_sql(
        f"""SELECT (SELECT count(*) FROM landed) AS rows, count(DISTINCT key) AS failed_rows, count(*) AS failures,
 0 AS column_failures, 'FAIL' AS verdict FROM ({DOC_FAILURES})""",
        landed=LANDED,
    ),
)
def b7_verdict(spark: SparkSession, sf: str) -> DataFrame:
    return checks.verdict(landed(spark, sf), DOC_SPEC)


IDENTITY = """SELECT CAST(sum(a) AS BIGINT) AS new_rows, CAST(sum(b) AS BIGINT) AS current_rows,
 count(*) FILTER (a > 1) AS repeated_new, count(*) FILTER (b > 1) AS repeated_current,
 count(*) FILTER (a > 0 AND b > 0) AS overlap, '{verdict}' AS identity FROM (
 SELECT id, sum(a) AS a, sum(b) AS b FROM (SELECT {key} AS id, 1 AS a, 0 AS b FROM {new}
 UNION ALL SELECT {key}, 0, 1 FROM {cur}) GROUP BY id)"""


@query(
    "b8_identity_ok",
    IDENTITY.format(
        key="o_orderkey",
        new="orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
        cur="orders WHERE o_orderdate < TIMESTAMP '2000-01-01'",
        verdict="ok",
    ),
)
def b8(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    late = F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz")
    return membership.identity_report(orders.where(late), orders.where(~late), "o_orderkey")


@query(
    "b8_identity_repeated",
    IDENTITY.format(
        key="l_orderkey",
        new="lineitem WHERE l_linenumber >= 4",
        cur="lineitem WHERE l_linenumber < 6",
        verdict="ids repeated in the new batch",
    ),
)
def b8_repeated(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    return membership.identity_report(items.where("l_linenumber >= 4"), items.where("l_linenumber < 6"), "l_orderkey")


RANGES = TableSpec(
    "lineitem",
    "l_orderkey",
    (
        ColumnRule("l_discount", "float", lo=0.02, hi=0.08),
        ColumnRule("l_quantity", "float", lo=0, hi=45),
    ),
)


@query(
    "b10_range_checks",
    """SELECT 'l_discount' AS "column", 'ge(0.02)' AS "check", count(*) AS n FROM lineitem WHERE l_discount < CAST(0.02 AS DOUBLE)
 UNION ALL SELECT 'l_discount', 'le(0.08)', count(*) FROM lineitem WHERE l_discount > CAST(0.08 AS DOUBLE)
 UNION ALL SELECT 'l_quantity', 'le(45)', count(*) FROM lineitem WHERE l_quantity > 45""",
)
def b10(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_discount", "l_quantity")
    return checks.failures_per_check(items, RANGES)


@query(
    "b10_all_null",
    with_sql(
        """SELECT 'source' AS "column", count(source) AS non_null, false AS all_null FROM landed
 UNION ALL SELECT 'note', count(note), false FROM landed
 UNION ALL SELECT 'empty', 0, true""",
        landed=LANDED,
    ),
)
def b10_nulls(spark: SparkSession, sf: str) -> DataFrame:
    df = landed(spark, sf).withColumn("empty", F.nullif(F.col("doc_id"), F.col("doc_id")))
    return checks.all_null_columns(df, ["source", "note", "empty"])


@query(
    "b11_row_overlap",
    """SELECT count(*) AS new_rows, count(*) FILTER (text IN (SELECT text FROM documents WHERE doc_id % 2 = 0))
 AS overlapping_rows FROM documents WHERE doc_id % 2 = 1""",
)
def b11(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    return membership.row_overlap(docs.where("doc_id % 2 = 1"), docs.where("doc_id % 2 = 0"), ["text"])


@query(
    "b12_encoded_check",
    with_sql(
        "SELECT "
        + ", ".join(
            f"count(*) FILTER (split = '{s}') AS {s}_rows, CAST(min(len(x)) FILTER (split = '{s}') AS INTEGER) AS {s}_min_width, "
            f"CAST(max(len(x)) FILTER (split = '{s}') AS INTEGER) AS {s}_max_width, CAST(0 AS BIGINT) AS {s}_missing, "
            f"CAST(0 AS BIGINT) AS {s}_unlabelled"
            for s in ("train", "test")
        )
        + ", '' AS errors, 'PASSED' AS validation_status FROM enc",
        enc=ENC,
    ),
)
def b12(spark: SparkSession, sf: str) -> DataFrame:
    df = encoded(spark, sf)
    return checks.check_encoded(df.where("split = 'train'"), df.where("split = 'test'"), "x", "y")


@query(
    "b14_batch_verdicts",
    with_sql(
        f"""SELECT b.batch, CAST(coalesce(records, 0) AS BIGINT) AS records, CAST(coalesce(errors, 0) AS BIGINT) AS errors,
 CASE WHEN coalesce(records, 0) > 0 AND coalesce(errors, 0) = 0 THEN 'accepted' ELSE 'rejected' END AS status
 FROM (SELECT DISTINCT doc_id % 211 + h * 500 AS batch FROM documents, (SELECT unnest([0, 1]) AS h)) b
 LEFT JOIN (SELECT CAST(doc_id AS BIGINT) % 211 AS batch, count(*) AS records FROM landed GROUP BY 1) r ON b.batch = r.batch
 LEFT JOIN (SELECT CAST(key AS BIGINT) % 211 AS batch, count(*) AS errors FROM ({DOC_FAILURES}) GROUP BY 1) e ON b.batch = e.batch""",
        landed=LANDED,
    ),
)
def b14(spark: SparkSession, sf: str) -> DataFrame:
    """Twice as many batches are announced as have records."""
    number = F.col("doc_id") % 211
    both = F.explode(F.array(number, number + 500)).alias("batch")
    announced = table(spark, sf, "documents").select(both).distinct()
    records = landed(spark, sf).withColumn("batch", F.col("doc_id").cast("bigint") % 211)
    return checks.batch_verdicts(announced, records, DOC_SPEC, "batch", "doc_id")


@query(
    "b14_batch_errors",
    with_sql(
        f"""SELECT CAST(key AS BIGINT) % 211 AS batch, 'customers.' || key || '.' || "column" AS field,
 CASE "check" WHEN 'not_nullable' THEN 'field required' WHEN 'dtype(int)' THEN 'not a valid integer'
 WHEN 'dtype(float)' THEN 'not a valid number' WHEN 'isin' THEN 'not one of the permitted values' ELSE "check" END AS message
 FROM ({DOC_FAILURES})""",
        landed=LANDED,
    ),
)
def b14_errors(spark: SparkSession, sf: str) -> DataFrame:
    records = landed(spark, sf).withColumn("batch", F.col("doc_id").cast("bigint") % 211)
    return checks.batch_errors(records, DOC_SPEC, "batch", "doc_id")


@query(
    "b14_accepted_records",
    with_sql(
        f"""SELECT doc_id, lang FROM landed WHERE CAST(doc_id AS BIGINT) % 211 NOT IN
 (SELECT CAST(key AS BIGINT) % 211 FROM ({DOC_FAILURES}))""",
        landed=LANDED,
    ),
)
def b14_accepted(spark: SparkSession, sf: str) -> DataFrame:
    records = landed(spark, sf).withColumn("batch", F.col("doc_id").cast("bigint") % 211)
    return checks.accepted_records(records, DOC_SPEC, "batch", "doc_id").select("doc_id", "lang")


@query(
    "b15_blank_profile",
    with_sql(
        """SELECT lang, count(*) FILTER (trim(note) = '') AS blank,
 count(*) FILTER (note IS NULL OR trim(note) <> '') AS not_numeric FROM landed
 WHERE note IS NULL OR NOT regexp_full_match(trim(note), '^[0-9]+$') GROUP BY 1""",
        landed=LANDED,
    ),
)
def b15(spark: SparkSession, sf: str) -> DataFrame:
    return checks.blank_profile(landed(spark, sf), "note", "lang")


@query(
    "b16_implication",
    """SELECT c AS "column", count(*) FILTER (v = 'F') AS value_rows, count(*) FILTER (f) AS flag_rows,
 count(*) FILTER (v = 'F' AND f) AS both_rows,
 count(*) FILTER (v = 'F') = count(*) FILTER (v = 'F' AND f) AND count(*) FILTER (f) = count(*) FILTER (v = 'F' AND f) AS equivalent
 FROM (SELECT 'l_linestatus' AS c, l_linestatus AS v, l_linestatus <> 'O' AS f FROM lineitem
 UNION ALL SELECT 'l_returnflag', l_returnflag, l_linestatus <> 'O' FROM lineitem) GROUP BY 1""",
)
def b16(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem").select("l_linestatus", "l_returnflag")
    return checks.implication_check(items, ["l_linestatus", "l_returnflag"], "F", F.col("l_linestatus") != "O")


@query(
    "b17_consistency",
    with_sql(
        """SELECT count(g) AS count, round(avg(g), 6) AS mean, round(stddev_samp(g), 6) AS std, round(min(g), 6) AS min,
 round(max(g), 6) AS max, round(quantile_cont(g, 0.25), 6) AS q25, round(quantile_cont(g, 0.5), 6) AS q50,
 round(quantile_cont(g, 0.75), 6) AS q75 FROM (SELECT abs(total / tenure - monthly) / 1000 AS g FROM cust WHERE tenure > 0)""",
        cust=CUST,
    ),
)
def b17(spark: SparkSession, sf: str) -> DataFrame:
    scaled = customers(spark, sf).select(
        "tenure", (F.col("total") / 1000).alias("total"), (F.col("monthly") / 1000).alias("monthly")
    )
    return rounded(checks.consistency_profile(scaled, "total", "tenure", "monthly"))


# --- metadata checks, each applied to a whole table ---------------------------


@query("b9_resolve_column", "SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1")
def b9(spark: SparkSession, sf: str) -> DataFrame:
    """The segment column is found under another spelling."""
    who = table(spark, sf, "customer").withColumnRenamed("c_mktsegment", " C_MktSegment ")
    name = resolve_column(who.columns, ["segment", "c_mktsegment"])
    return who.groupBy(F.col(f"`{name}`").alias("value")).agg(F.count(F.lit(1)).alias("n"))


@query(
    "b13_same_schema",
    """SELECT 'same' AS pair, 0 AS differences, count(*) AS rows FROM orders
 UNION ALL SELECT 'other order', 1, count(*) FROM orders UNION ALL SELECT 'fewer rows', 1, count(*) FROM orders""",
)
def b13(spark: SparkSession, sf: str) -> DataFrame:
    orders = table(spark, sf, "orders")
    pairs = {
        "same": checks.same_schema(orders, orders, same_rows=True),
        "other order": checks.same_schema(orders, orders.select(*reversed(orders.columns))),
        "fewer rows": checks.same_schema(orders, orders.where("o_orderstatus = 'F'"), same_rows=True),
    }
    found = F.array(*[F.struct(F.lit(n).alias("pair"), F.lit(len(e)).alias("differences")) for n, e in pairs.items()])
    total = orders.agg(F.count(F.lit(1)).alias("rows"))
    return total.select("rows", F.explode(found).alias("p")).select("p.*", "rows")


@query(
    "b18_raw_split_presence",
    with_sql("SELECT split, true AS present, count(*) AS rows FROM enc GROUP BY 1 UNION ALL SELECT 'extra', false, 0", enc=ENC),
)
def b18(spark: SparkSession, sf: str) -> DataFrame:
    root = scratch_path(spark, "b18")
    rows = encoded(spark, sf)
    for side in ("train", "test"):
        rows.where(F.col("split") == side).write.parquet(f"{root}/{side}")
    counts = []
    for side in ("train", "test", "extra"):
        present = tables.path_exists(spark, f"{root}/{side}")
        part = spark.read.parquet(f"{root}/{side}") if present else rows.where("false")
        counts.append(part.agg(F.lit(side).alias("split"), F.lit(present).alias("present"), F.count(F.lit(1)).alias("rows")))
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


LINEITEM_ROLES = {
    "numeric": ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    "categorical": ("l_returnflag", "l_linestatus"),
}


@query(
    "c8_column_roles",
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{role}' AS role, count({c}) AS non_null FROM lineitem"
        for role, names in LINEITEM_ROLES.items()
        for c in names
    ),
)
def c8(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "lineitem")
    numeric, categorical = columns_by_role(items.schema)
    roles = F.when(F.col("column").isin(numeric), "numeric").when(F.col("column").isin(categorical), "categorical")
    counts = profile.table_profile(items.select(*numeric, *categorical))
    return counts.select("column", roles.alias("role"), "non_null")
