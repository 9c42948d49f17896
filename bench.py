"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables, BENCH_CPUS the local cores. Every query runs to
completion into a sink that discards rows. `stage_and_build_mart` reads the raw
tables, writes the purchase log and the mart; the queries after it read those,
except q_mart, which builds the mart again from the purchase log.
"""

from __future__ import annotations

import json
import os
import tempfile
import time

from pyspark.sql import SparkSession

from offerwise.registry import inputs
from offerwise.registry.queries import QUERIES
from offerwise.session import clear_stored

HEADLINE = [
    "q_staging",
    "q_catalog_price",
    "q_purchase_sequence_ltv",
    "q_customer_action",
    "q_mart",
    "q_mart_incremental",
    "q_mart_bucketed",
    "q_class_distribution",
    "q_stratified_split",
    "q_expected_value",
    "q_optimal_discount",
    "q_optimal_discount_unrolled",
    "q_discount_distribution",
    "q_target_list",
    "q_strategy_comparison",
    "q_alpha_sensitivity_static",
    "q_alpha_sensitivity_rescored",
    "q_alpha_envelope_rescored",
    "q_alpha_envelope_fine",
    "q_monotone_offers",
    "q_calibrated_fixed_offers",
    "q_attribution_reasons",
    "q_elasticity_curve",
    "q_class_report",
    "q_partial_dependence",
    "q_constrained_scores",
    "q_calibrated_scores",
    "q_calibrated_offers",
    "q_boosted_scores",
    "q_tuning",
    "q_train_report",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    timings: dict[str, float] = {}

    def timed(name, job) -> None:
        start = time.perf_counter()
        job()
        timings[name] = round(time.perf_counter() - start, 3)

    def run(name):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    spark.range(1000).selectExpr("sum(id)").collect()  # start-up is not measured
    timed("stage_and_build_mart", lambda: inputs.mart(spark, sf_dir))
    for name in HEADLINE:
        timed(name, lambda: run(name))
    print(
        json.dumps(
            {
                "metric": "total wall-clock of headline queries",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "sf": sf_dir.rsplit("sf", 1)[-1],
            }
        )
    )
    clear_stored(spark)
    spark.stop()


if __name__ == "__main__":
    main()
