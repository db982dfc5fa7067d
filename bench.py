"""Time the headline queries: ``BENCH_SF_DIR``, ``BENCH_CPUS``; prints one JSON line.

Each query is built and run to a sink that discards its rows, twice in one
session. ``value`` and ``queries`` are the second (warm) times; the first ones,
which include code generation and class loading, are under ``cold``. ``load`` is
the once-per-session write of the small derived base tables.
"""

from __future__ import annotations

import json
import os
import time

from ledgerloom.session import build_session
from workload.fixtures import LOADED, view
from workload.queries import QUERIES

HEADLINE = (
    "exchange_rates", "full_category_mapping", "positions", "allocation", "trade_income",
    "balance_report", "reconciliation", "validation_report", "adjustment_flag",
    "adjusted_validation", "upsert_balances", "price_unpivot",
)


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session("ledgerloom-bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": "16g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")

    def run(name: str) -> float:
        return timed(lambda: QUERIES[name](spark, sf_dir)
                     .write.format("noop").mode("overwrite").save())

    load = timed(lambda: [view(spark, sf_dir, name) for name in LOADED])
    cold = {name: run(name) for name in HEADLINE}
    warm = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "ledger queries, warm total", "value": round(sum(warm.values()), 3),
        "unit": "sec", "queries": warm, "cold": cold, "load": load,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
