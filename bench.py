"""Time the headline queries and print one JSON line.

BENCH_SF_DIR is the data directory, BENCH_CPUS the number of local cores.  Each query
is planned and collected once; starting the session and a first look at the tables are
not timed.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import SparkSession  # noqa: E402

from ebbline.plans.catalog import catalog  # noqa: E402

HEADLINES = (
    "lcr_baseline",
    "lcr_what_if",
    "lcr_what_if_all",
    "hqla_summary",
    "hqla_summary_by_level",
    "net_cashflow",
    "lcr_change_analysis",
    "baseline_versus_scenarios",
    "lcr_drivers",
    "hqla_by_level",
    "top_unit_by_hqla",
    "largest_outflows_by_counterparty",
    "net_outflow_by_unit",
    "flows_by_counterparty_type",
    "flows_by_maturity_bucket",
    "exposure_by_security_type",
    "semantic_outflows_by_region",
    "relationship_orphans",
    "missing_fields",
    "reconciliation",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ebbline-bench")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("ebbline.lineitem.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")  # no call site per expression
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    for table in ("lineitem", "orders", "customer"):
        spark.read.parquet(f"{sf_dir}/{table}.parquet").count()
    queries, seconds = catalog(), {}
    for name in HEADLINES:
        start = time.perf_counter()
        queries[name](spark, sf_dir).collect()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": Path(sf_dir).name.removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
