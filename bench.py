"""Times the headline steps and queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession

from strata.session import build_session
from strata.suite import QUERIES
from strata.suite.registry import STAR, layers

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

# Layer builds come first, in load order; the queries after them read the built layers.
HEADLINE = [
    "dedup_latest", "bronze_envelope", "parse_payload", "silver_fact_earnings", "assign_surrogate_keys",
    "merge_dimension_scd1", "gold_fact_earnings", "fk_lookup", "snapshot_change_feed", "merge_dimension_scd2",
    "api_quota_usage", "check_duplicates", "check_orphans", "check_layer_reconciliation", "check_suite_report",
    "quality_scorecard", "q_period_earnings", "q_ytd_by_department", "q_net_pay", "q_employee_period",
    "q_employee_history", "q_period_totals", "q_multi_fact", "q_count_variance", "rls_role_department",
    "mask_columns", "pii_scan", "cluster_zorder", "compact_files", "stream_bronze_to_silver",
]


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(work) -> float:
    start = time.perf_counter()
    work()
    return round(time.perf_counter() - start, 3)


def build_steps(spark: SparkSession) -> dict:
    held = layers(spark, SF_DIR)
    facts = list(STAR)
    return {
        "build_raw": lambda: [held.bronze(f) for f in facts],
        "build_dimensions": lambda: held.gold("dwh_dim_employee"),
        "build_typed": lambda: [held.silver(f) for f in facts],
        "build_facts": lambda: [held.gold(STAR[f]) for f in facts],
    }


def main() -> None:
    spark = build_session(
        "strata-bench", f"local[{CPUS}]",
        **{"spark.sql.shuffle.partitions": CPUS, "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
           "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    drain(spark.read.parquet(f"{SF_DIR}/lineitem.parquet").groupBy("l_returnflag").count())
    times = {name: timed(step) for name, step in build_steps(spark).items()}
    for name in HEADLINE:
        times[name] = timed(lambda n=name: drain(QUERIES[n](spark, SF_DIR)))
    spark.stop()
    print(json.dumps({
        "metric": "strata_headline_total", "value": round(sum(times.values()), 3), "unit": "sec",
        "queries": times, "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": int(CPUS),
    }))


if __name__ == "__main__":
    main()
