"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the test data, BENCH_CPUS the local cores. Each query runs
to a sink that discards rows, once, after two small queries to start the session.
BENCH_COPIES=N times the summaries and the customer view on N shifted copies of
the lending tables instead, to reach the row counts of the full inputs.
"""

import json
import os
import tempfile
import time

from pyspark.sql import functions as F

from creditloom.plans import catalog
from creditloom.session import build_session

HEADLINE = [
    "agg_bureau", "agg_previous", "agg_pos", "agg_card", "agg_installments", "customer_360", "features_full",
    "cohort_default_rates", "missing_profile", "medians", "quantiles", "encode_onehot", "impute_median",
    "winsorise", "rate_by_age", "pivot_age_employment", "top_correlations", "class_histogram", "roc_auc",
    "avg_precision", "cumulative_gain", "top20_capture", "fbeta_sweep", "stratified_split", "export_slim",
    "cohort_default_rates_published", "dq_report",
]
# Stage tables are timed by themselves, before the first query that reads them.
STAGES = {"missing_profile": catalog.Data.engineered, "winsorise": catalog.Data.prepared}
SCALE = ["agg_bureau", "agg_previous", "agg_pos", "agg_card", "agg_installments", "customer_360", "features_full"]
# Key columns that move with each copy, and the table whose key range they move by.
SHIFTED = {
    "customer": {"c_custkey": "customer"},
    "orders": {"o_orderkey": "orders", "o_custkey": "customer"},
    "lineitem": {"l_orderkey": "orders"},
    "events": {"event_id": "events", "user_id": "users"},
}


def copied(spark, folder, copies):
    """The lending tables, each ``copies`` times with keys of their own."""
    size = {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in SHIFTED}
    size["users"] = size["customer"] // 10
    target = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    for table, keys in SHIFTED.items():
        df = spark.read.parquet(f"{folder}/{table}.parquet").withColumn(
            "copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1)))
        )
        moved = {k: F.col(k) + F.col("copy") * size[of] for k, of in keys.items()}
        df.repartition(16).withColumns(moved).drop("copy").write.parquet(f"{target}/{table}.parquet")
    return target


def timed(spark, name, folder):
    start = time.perf_counter()
    catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def staged(build, data):
    start = time.perf_counter()
    build(data)
    return round(time.perf_counter() - start, 3)


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    copies = int(os.environ.get("BENCH_COPIES", "0"))
    spark = build_session(
        "creditloom-bench", f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": os.environ.get("BENCH_PARTITIONS", cpus),
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.driver.memory": "20g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    label = os.path.basename(folder.rstrip("/")).removeprefix("sf")
    if copies:
        folder, label = copied(spark, folder, copies), f"{label} x {copies}"
    for name in ("scan_parquet", "count_if"):
        timed(spark, name, folder)
    times = {}
    for name in SCALE if copies else HEADLINE:
        if name in STAGES:
            times[STAGES[name].__name__ + "_stage"] = staged(STAGES[name], catalog.data(spark, folder))
        times[name] = timed(spark, name, folder)
    print(json.dumps({
        "metric": "total time of headline queries", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": label, "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
