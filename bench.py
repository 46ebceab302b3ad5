"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ["votes_per_place", "votes_per_region", "candidate_results", "territory_rollup", "nearest_region_per_address",
            "nearest_supplier_per_customer", "address_counts", "index_runs", "index_streets", "resolve_addresses",
            "asof_events", "ambiguous_coverage", "order_price_percentiles", "live_results", "comparable_text",
            "reconcile_totals"]


def prepared_index(spark, sf_dir: str) -> dict[str, float]:
    """Seconds to store the street index, and to answer ten requests and all of them from it."""
    from meshtally.plans.prepared import open_index, resolve_prepared, store_index
    from meshtally.registry.index_queries import stored_index
    from meshtally.registry.scenario import Scenario

    s, out = Scenario(spark, sf_dir), {}
    built = stored_index(s)
    start = time.time()
    index = open_index(spark, store_index(built))
    out["store"] = round(time.time() - start, 3)
    for name, asked in (("ten_requests", s.request.limit(10)), ("all_requests", s.request)):
        start = time.time()
        resolve_prepared(asked, index).write.format("noop").mode("overwrite").save()
        out[name] = round(time.time() - start, 3)
    return out


def main() -> None:
    from meshtally.registry import registered
    from meshtally.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = build_session("bench", cores=cpus, partitions=cpus, memory="16g")
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    # Start the executors and the SQL front end before timing.
    spark.range(1000).selectExpr("id % 7 AS k", "id").groupBy("k").sum("id").collect()
    times = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        start = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - start, 3)
    print(json.dumps({"metric": "total_wall_clock", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "prepared_index": prepared_index(spark, sf_dir), "sf": os.path.basename(sf_dir.rstrip("/")).replace("sf", "")}))
    spark.stop()


if __name__ == "__main__":
    main()
