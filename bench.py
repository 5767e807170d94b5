"""Times the warehouse build and the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from starloom.plans.catalog import QUERIES  # noqa: E402
from starloom.plans.warehouse import open_warehouse  # noqa: E402

HEADLINES = [
    "monthly_trend",
    "same_store_sales",
    "category_monthly",
    "cagr",
    "cagr_ttm",
    "product_rank",
    "brand_top5",
    "top5_per_brand",
    "top_brands_per_category",
    "rank_movement",
    "sales_gaps",
    "abc_revenue",
    "abc_summary",
    "customer_pareto",
    "daily_pareto",
    "monthly_pareto",
    "abc_movement",
    "rfm",
    "rfm_summary",
    "cohort_long",
    "cohort_triangle",
    "category_rollup",
    "category_margin",
    "cancellation",
    "scd2_attribution",
    "basket_category",
    "basket_substitutes",
    "basket_product",
    "basket_sizes",
    "scd2_idempotent",
    "fact_upsert",
    "reconcile_store",
    "reconcile_month",
    "validate_report",
    "business_rules",
    "distribution_sanity",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    shared = tempfile.mkdtemp(prefix="bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", f"file://{shared}")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).groupBy().count().collect()  # start the executor threads

    seconds: dict[str, float] = {}

    def timed(name, action) -> None:
        start = time.perf_counter()
        action()
        seconds[name] = round(time.perf_counter() - start, 3)

    warehouse = open_warehouse(spark, folder)
    timed("build_warehouse", warehouse.star)
    names = sys.argv[1:] or HEADLINES
    for name in names:
        # The sink takes every row and column, without a transfer to the driver.
        timed(name, lambda: QUERIES[name](warehouse).write.format("noop").mode("overwrite").save())
    print(
        json.dumps(
            {
                "metric": "warehouse build and headline queries, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": folder.rsplit("sf", 1)[-1],
            }
        )
    )
    warehouse.scratch.close()
    spark.stop()


if __name__ == "__main__":
    main()
