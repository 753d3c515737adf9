"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the local cores. The
stand-in tables are written before the clock starts; each query then runs whole into a noop
sink, so that no time goes into collecting rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

from entitymill.plans import standins
from entitymill.plans.catalogue import QUERIES
from entitymill.plans.registry import Tables
from entitymill.session import build_session

HEADLINE = [
    "n13_company_key", "src20_stacked_registries", "d01_first_per_phone", "d02_phone_else_name",
    "d04_phone_then_domain", "d05_fuzzy_leaders", "d06_multi_signal_leaders", "d08_components",
    "d09_brand_overlap", "d11_source_overlap", "d07_upsert", "j01_priority_match",
    "j03_dealer_licence_fuzzy", "j04_dealer_licence_exact", "j05_licence_dealers",
    "j09_brand_import", "j16_master_list", "j20_nested_children", "g02_name_score_hvac",
    "g06_enhanced_score", "g08_composite_score", "c03_trade_count", "a01_multi_category",
    "a10_multi_state_rollup", "q11_collector_health", "q14_pipeline_health",
    "r03_return_on_investment", "x04_change_log", "x10_time_in_previous_stage",
    "e03_customer_match", "st1_incremental_import",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("bench", cpus=cpus)
    tables = Tables(spark, sf_dir)
    started = time.time()
    for name in standins.TABLES:
        getattr(tables, name)
    prepared = time.time() - started
    timings = {}
    for name in HEADLINE:
        started = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.time() - started, 3)
        print(f"{name} {timings[name]}", file=sys.stderr, flush=True)
    spark.stop()
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
        "queries": timings, "prepare_sec": round(prepared, 3), "sf": sf,
    }))


if __name__ == "__main__":
    main()
