"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the threads.
Every query starts from the tables: bundles are built, parsed, flattened and mapped each time.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from clinlake.plans import registry  # noqa: E402

HEADLINE = [
    "bronze_resources", "silver_patient", "silver_encounter", "silver_condition", "silver_medication_request",
    "silver_observation", "gold_person", "gold_visit_occurrence", "gold_condition_occurrence", "gold_drug_exposure",
    "gold_measurement", "gold_observation", "lineage_audit", "upsert_latest", "quality_mapping_rates",
    "quality_unresolved_references", "report_top_conditions", "report_top_measurements", "report_visit_record_counts",
    "ext_map_source_to_standard",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("clinlake-bench")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = registry.queries()
    queries["silver_patient"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # start the JVM

    seconds: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)

    rows = queries["quality_row_counts"](spark, sf_dir).filter("table_name = 'TOTAL'").first()["row_count"]
    gold = sum(s for name, s in seconds.items() if name.startswith("gold_"))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "gold_rows": rows,
                "gold_rows_per_sec": round(rows / gold),
            }
        )
    )


if __name__ == "__main__":
    main()
