"""Headline queries at one scale factor; prints one JSON line.

The reports are timed on the derived parcel tables written to Parquet once (its time is reported apart), which is how
they are meant to read their facts. Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_TABLES_DIR (where the derived tables go). `plan` has the seconds of each mart that pass before its job starts.
"""

from __future__ import annotations

import contextlib
import json
import os
import tempfile
import time
from collections.abc import Callable

from pyspark.sql import DataFrame

from parceltrail.checks import domain, queries
from parceltrail.checks.marts import MARTS
from parceltrail.session import local_session
from parceltrail.sources.tables import SCHEMAS, Tables

OPERATORS = [
    "star_summary",
    "scan_summary_onepass",
    "latest_version",
    "full_merge",
    "lag_lead_path",
    "dwell_top3",
    "attempt_rank",
    "attempt_pivot",
    "running_extrema",
    "role_lookup",
    "heavy_right_join",
    "status_ladder",
]


def seconds(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def plan_seconds(build: Callable[[], DataFrame]) -> float:
    start = time.perf_counter()
    build()._jdf.queryExecution().executedPlan()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, "bench", shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    known = queries()
    seconds(lambda: known["group_sum_multi"](spark, sf_dir))

    timings = {name: seconds(lambda name=name: known[name](spark, sf_dir)) for name in OPERATORS}
    shared = os.environ.get("BENCH_TABLES_DIR")  # a folder all executors see; a local session needs none
    with contextlib.nullcontext(shared) if shared else tempfile.TemporaryDirectory(prefix="bench-") as root:
        start = time.perf_counter()
        derived = domain.tables(spark, sf_dir)
        for name in SCHEMAS:
            derived[name].write.mode("overwrite").parquet(f"{root}/{name}")
        prepared = round(time.perf_counter() - start, 3)
        t = Tables.from_parquet(spark, root)
        timings.update({name: seconds(lambda mart=mart: mart(t)) for name, mart in MARTS.items()})
        plans = {name: plan_seconds(lambda mart=mart: mart(t)) for name, mart in MARTS.items()}
        spark.stop()
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "prepare_tables": prepared,
        "plan": plans,
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
