"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the tables (default sf0.1), BENCH_CPUS the local threads.
"""

from __future__ import annotations

import json
import os
import sys
import time

HEADLINE = (
    "b7_verdict",
    "b8_identity_ok",
    "b11_row_overlap",
    "d2_training_side",
    "e2_rate_by",
    "e4_describe",
    "e9_corr_matrix",
    "e12_duplicate_count",
    "f1_equal_windows",
    "h1_stratified_split",
    "i5_encode_sides",
    "i6_random_forest",
    "i20_batch_scoring",
    "j3_roc_auc",
    "j9_threshold_sweep",
    "j13_model_comparison",
    "k1_ks_statistic",
    "k3_js_divergence",
    "k4_data_drift_report",
    "l5_lifecycle_report",
    "m1_prediction_report",
    "m2_service_report",
    "s1_windowed_log",
    "s6_windowed_drift",
)


def scoring_throughput(spark, sf: str) -> dict[str, float]:
    """Rows per second through encoder and a 150-tree, depth-12 forest, fitted beforehand."""
    from pyspark.sql import functions as F

    from modelwatch.operators import training

    items = spark.read.parquet(f"{sf}/lineitem.parquet").select(
        F.monotonically_increasing_id().alias("id"),
        "l_quantity",
        "l_extendedprice",
        "l_discount",
        "l_tax",
        "l_linestatus",
        F.year("l_shipdate").cast("string").alias("year"),
        (F.col("l_returnflag") == "R").cast("int").alias("y"),
    )
    encoder = training.default_encoder(["l_quantity", "l_extendedprice", "l_discount", "l_tax"], ["l_linestatus", "year"])
    # The forest is only the means here: a thirtieth of the rows is enough to grow it.
    train = items.where(F.pmod(F.xxhash64("id"), F.lit(30)) == 0)
    model = training.fit_model(train, "id", "y", encoder, training.random_forest("y", trees=150, depth=12))
    rows = items.count()
    start = time.perf_counter()
    training.score(model, items.repartition(spark.sparkContext.defaultParallelism)).agg(F.avg("churn_probability"), F.sum("prediction")).collect()
    seconds = time.perf_counter() - start
    return {"rows": rows, "seconds": round(seconds, 3), "rows_per_s": round(rows / seconds, 1)}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
    from modelwatch.catalog import QUERIES
    from modelwatch.session import build_session

    spark = build_session("bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{sf}/lineitem.parquet").groupBy("l_returnflag").count().collect()

    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf).collect()
        times[name] = round(time.perf_counter() - start, 3)
    total = round(sum(times.values()), 3)
    result = {"metric": "headline_total", "value": total, "unit": "sec", "queries": times}
    result["sf"] = os.path.basename(sf.rstrip("/"))
    result["batch_scoring"] = scoring_throughput(spark, sf)
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
