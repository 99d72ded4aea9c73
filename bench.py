"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (default /root/testdata/sf0.1) and ``BENCH_CPUS`` (default 8) choose data
and cores. Each query is run to the end into a no-op sink, the better of two runs counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from lotledger.plans.catalog import QUERIES  # noqa: E402
from lotledger.session import build_session  # noqa: E402

HEADLINE = [
    "flagship_inventory",     # listing pages -> vehicles per dealer
    "c3_page_platform",       # 25 page signatures
    "c5_fingerprint",         # host, page and rendered tiers
    "c10_cascade_layer",
    "c17_clean_html",
    "u7_candidate_endpoints",
    "x2_two_layout_merge",
    "x8_generic_cards",
    "x9_wide_cards",
    "x12_pagination_cut",
    "x13_routed_platforms",
    "j3_ld_projection",       # JSON-LD -> vehicles
    "j4_state_blobs",         # script state -> vehicles
    "j8_records_in_order",    # arrays in JSON responses
    "n8_normalize_vehicle",
    "n10_normalize_many",
    "k7_result_rows",
    "m4_record_results",
    "m6_upsert_with_vin",     # 600k listings, two runs
    "m9_fold_batch",
    "r3_dealer_counts",
    "t3_incremental_upsert",
    "e2e_inventory_run",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("lotledger-bench", f"local[{cpus}]")
    spark.sparkContext.setLogLevel("ERROR")
    names = sys.argv[1:] or HEADLINE
    seconds: dict[str, float] = {}
    for name in names:
        best = None
        for _ in range(2):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            took = time.perf_counter() - start
            best = took if best is None else min(best, took)
        seconds[name] = round(best, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_query_seconds", "value": round(sum(seconds.values()), 3),
        "unit": "sec", "queries": seconds, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
