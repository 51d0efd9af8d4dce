"""Time the registered queries: warm median, one JSON line.

BENCH_SF_DIR, BENCH_CPUS and BENCH_QUERIES (comma-separated) choose what is run; all queries of
the library by default. Results go to Spark's noop sink, so no result passes the driver. A query
runs once to warm up, then three times, or once where the first run took over SLOW seconds.
With BENCH_DUCKDB=1 the oracle's time in DuckDB is given beside.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pixeltally.session import local_session  # noqa: E402
from pixeltally.workload.registry import ORACLES, QUERIES  # noqa: E402
from pixeltally.workload.tables import responses, star, wide_sales  # noqa: E402

RUNS = 3
SLOW = 4.0


def seconds(run) -> float:
    start = time.perf_counter()
    run()
    return time.perf_counter() - start


def warm_median(run) -> float:
    runs = RUNS if seconds(run) <= SLOW else 1
    return round(statistics.median(seconds(run) for _ in range(runs)), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = chosen.split(",") if chosen else list(QUERIES)
    scratch = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    spark = local_session(
        cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8, **{"spark.checkpoint.dir": scratch})

    # What queries read from the scratch folder is written once; its cost is part of the sum.
    staging = {
        "stage_wide": round(seconds(lambda: wide_sales(spark, sf_dir)), 3),
        "stage_responses": round(seconds(lambda: responses(spark, sf_dir)), 3),
        "stage_star": round(seconds(lambda: star(spark, sf_dir)), 3),
    }

    def run(name: str):
        return lambda: QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()

    times = {name: warm_median(run(name)) for name in names}
    result = {
        "metric": "sum of warm median seconds over the queries, and of staging", "unit": "sec",
        "value": round(sum(times.values()) + sum(staging.values()), 3),
        "queries": {**times, **staging}, "sf": sf_dir.rsplit("sf", 1)[-1], "cpus": cpus, "cores": os.cpu_count(),
    }
    if os.environ.get("BENCH_DUCKDB"):
        sys.path.insert(0, str(Path(__file__).resolve().parent / "tests"))
        from compare import connect
        duck = connect(sf_dir)
        duck.execute(f"SET threads = {cpus}")
        result["duckdb"] = {
            name: warm_median(lambda: duck.sql(ORACLES[name]).to_arrow_table()) for name in names}
    spark.stop()
    print(json.dumps(result))


if __name__ == "__main__":
    main()
