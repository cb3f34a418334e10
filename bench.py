"""Time the headline queries and print one JSON line.

The raw filing tables are first derived from the given tables and stored as
Parquet, as a load of raw tables would do; this is timed as ``store_raw_tables``.
Every query then runs over the stored tables, once to warm up and once timed,
while all its rows go to a sink that discards them. BENCH_SF_DIR and BENCH_CPUS
choose data and cores, BENCH_QUERIES (comma-separated) the queries.
"""

from __future__ import annotations

import json
import os
import time

from pyspark.sql import SparkSession

from finfacts.fixtures.registry import BUILDS
from finfacts.fixtures.tables import filing_tables
from finfacts.sources.raw import store_tables, stored_tables
from finfacts.sources.sinks import scratch_folder

HEADLINE = (
    "m1_stg_balance_sheet", "m4_fct_financial_statements", "m5_company_metrics",
    "m5_company_metrics_from_facts", "m7_fact_financials", "m8_filing_documents",
    "m9_financial_metadata", "m10_financial_data", "d9_assemble_documents",
    "h1_flatten_documents", "c5_lookup_presentation", "n1_recent_filings",
    "n2_top_companies", "n3_values_by_tag", "n4_tag_usage", "n5_data_points",
    "n6_balance_sheet_analysis", "n7_cash_flow_metrics", "n8_company_health",
    "n9_quarterly_trends", "n10_balance_sheet_key_metrics", "n13_financial_overview",
    "n14_health_indicators", "n14_health_indicators_corrected", "q13_all_checks",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    root = scratch_folder(spark)
    source = filing_tables(spark, sf_dir)
    begin = time.perf_counter()
    store_tables(source, root)
    stored = round(time.perf_counter() - begin, 3)
    tables = stored_tables(spark, root, list(source))
    cold, warm = {}, {"store_raw_tables": stored}
    for name in names:
        for times in (cold, warm):
            begin = time.perf_counter()
            BUILDS[name](tables).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - begin, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(warm.values()), 3),
        "unit": "sec", "queries": warm, "cold": cold,
        "sf": os.path.basename(sf_dir).removeprefix("sf"), "cpus": int(cpus),
        "shuffle_partitions": int(cpus), "driver_memory": "16g",
    }))
    spark.stop()


if __name__ == "__main__":
    main()
