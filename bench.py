"""Headline timings: prints one JSON line.

BENCH_SF_DIR selects the data, BENCH_CPUS the local cores.  Every query is planned, run to
completion into a no-op sink, and timed including the construction of its plan.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from shelfspark.plans import registry

HEADLINE = [
    "clean_offers", "clean_catalog", "clean_corrections", "packaging_decide", "packaging_audit", "diff_plan",
    "category_names", "item_ids", "dedupe_products", "validate_findings", "crawl_cumulative", "identity_dedupe",
    "log_progress", "log_errors", "alert_reasons", "page_text", "page_links", "extract_pages", "listing_explode",
]
# Tables whose rows the job works through, for rows per second.
INPUTS = {"clean_offers": "lineitem", "clean_catalog": "part", "packaging_decide": "part", "extract_pages": "part", "diff_plan": "part", "page_text": "pages"}


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 4))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    spark.range(1000).selectExpr("sum(id)").collect()
    timings = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - start, 3)
    rates = {
        name: round(spark.read.parquet(f"{sf_dir}/{table}.parquet").count() / timings[name]) for name, table in INPUTS.items()}
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "rows_per_sec": rates, "sf": os.path.basename(sf_dir.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
