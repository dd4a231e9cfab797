"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores. Each query
runs twice and writes all its rows to nowhere; the faster run counts, so that
start-up of the engine is left out.
"""

from __future__ import annotations

import json
import os
import time

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")

HEADLINE = (
    "links", "node_counts", "link_counts", "first_link_per_url", "clean_documents", "doc_prices",
    "normalized_prices", "discount_labels", "price_scores", "best_pairs", "order_frontier",
    "limit_per_parent", "event_positions", "json_walk", "shop_details", "shop_listings",
    "crawl_campaigns", "crawl_products",
)
# What a rate counts: the table whose rows go through the query.
RATES = {
    "links": "pages", "node_counts": "pages", "doc_prices": "documents", "normalized_prices": "part",
    "price_scores": "lineitem", "best_pairs": "lineitem", "shop_details": "part",
}


def main() -> None:
    from shelfmill.plans.catalog import all_queries
    from shelfmill.session import build_session

    spark = build_session(
        "shelfmill-bench", f"local[{CPUS}]",
        **{
            "spark.ui.enabled": "false",
            "spark.sql.shuffle.partitions": CPUS,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    runs = all_queries()
    seconds = {}
    for name in HEADLINE:
        times = []
        for _ in range(2):
            start = time.perf_counter()
            runs[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(min(times), 3)
    rows = {t: spark.read.parquet(f"{SF_DIR}/{t}.parquet").count() for t in set(RATES.values())}
    rates = {f"{q}_{t}_per_sec": round(rows[t] / seconds[q]) for q, t in RATES.items()}
    print(json.dumps({
        "metric": "total_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "rates": rates, "cpus": int(CPUS), "sf": os.path.basename(SF_DIR.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
