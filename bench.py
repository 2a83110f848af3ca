"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Prints ONE JSON line:
  {"metric": "headline_total_sec", "value": N, "unit": "sec", "queries": {...}, "sf": ...}

What is timed (median of $BENCH_REPEATS runs after one warm-up each):

* ``store_build`` - the six normalised tables derived from the driver
  tables and written in the store layout (partitioned / range-sorted parquet);
* ``n6_load``     - the dirty wide feed (about one row per order, written
  beforehand as a header CSV) read, cleaned, normalised and appended to an
  empty store, dimensions first (one run);
* ``q1 q2 q3 d1 d2 d4 d5 d6`` - the ranking and dashboard queries over the
  stored tables, collected to the driver as the dashboard would;
* ``k``           - the integrity report (K1-K4) over the stored tables;
* ``t7``          - the star-schema fact table over the stored tables,
  executed in full into a no-op sink.

``value`` is the sum of all of them: storing the tables, loading a feed and
answering everything once.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time
import uuid

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from crashlake.operators import dashboard as D  # noqa: E402
from crashlake.operators import quality as K  # noqa: E402
from crashlake.operators import rankings as R  # noqa: E402
from crashlake.operators import star as T  # noqa: E402
from crashlake.plans import params as P  # noqa: E402
from crashlake.plans.load import load_feed  # noqa: E402
from crashlake.session import ensure_checkpoint_dir, local_session  # noqa: E402
from crashlake.sources import store  # noqa: E402
from crashlake.sources.fixtures import fixture_tables, fx_raw  # noqa: E402


def _sf_label(sf_dir: str) -> str:
    base = os.path.basename(sf_dir.rstrip("/"))
    return base[2:] if base.startswith("sf") else base


def timed(fn) -> float:
    t0 = time.perf_counter()
    fn()
    return time.perf_counter() - t0


def median_of(fn, repeats: int) -> float:
    fn()  # warm-up
    return statistics.median(timed(fn) for _ in range(repeats))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    spark = local_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", cpus)),
                          app="crashlake-bench")
    shared = ensure_checkpoint_dir(spark).rstrip("/")
    root = f"{shared}/bench-store-{uuid.uuid4().hex}"
    load_root = f"{shared}/bench-load-{uuid.uuid4().hex}"

    results: dict[str, float] = {}

    def build_store(src: str, dst: str):
        fx = fixture_tables(spark, src)
        for name in ("boroughs", "vehicle_types", "factors", "collisions",
                     "collision_vehicles", "collision_factors"):
            store.write_table(name, getattr(fx, name), dst, mode="overwrite")

    # JVM warm-up (class loading, JIT) on the smallest tables; not timed.
    warm = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    def feed_csv(src: str) -> str:
        """The dirty feed as the CSV file the loader is given (in file order)."""
        path = f"{shared}/bench-feed-{uuid.uuid4().hex}"
        fx_raw(spark, src).orderBy("src_seq").drop("src_seq").write.option("header", True).csv(path)
        return path

    if os.path.isdir(warm) and os.path.abspath(warm) != os.path.abspath(sf_dir):
        build_store(warm, f"{shared}/bench-warm-{uuid.uuid4().hex}")
        load_feed(spark, feed_csv(warm), f"{shared}/bench-warm-{uuid.uuid4().hex}")

    results["store_build"] = timed(lambda: build_store(sf_dir, root))
    t = store.read_tables(spark, root)

    csv_path = feed_csv(sf_dir)
    results["n6_load"] = timed(lambda: load_feed(spark, csv_path, load_root))

    queries = {
        "q1": lambda: R.street_severity_rank(t, P.Q1_FROM, P.Q1_TO, 10).collect(),
        "q2": lambda: R.factor_fatality_rank(t).collect(),
        "q3": lambda: R.vehicle_severity_rank(t).collect(),
        "d1": lambda: D.kpi_summary(t, P.DASH_START, P.DASH_END, P.DASH_BOROUGH).collect(),
        "d2": lambda: D.daily_trend(t, P.DASH_START, P.DASH_END, "All").collect(),
        "d4": lambda: D.crashes_by_borough(t, P.DASH_START, P.DASH_END).collect(),
        "d5": lambda: D.top_factors(t, P.DASH_START, P.DASH_END, "All", P.TOP_N).collect(),
        "d6": lambda: D.latest_collisions(t, P.DASH_START, P.DASH_END, "All").collect(),
        "k": lambda: K.validate(t).collect(),
        "t7": lambda: T.fact_collisions(t).write.mode("overwrite").format("noop").save(),
    }
    for name, fn in queries.items():
        results[name] = median_of(fn, repeats)

    total = sum(results.values())
    out = {
        "metric": "headline_total_sec",
        "value": round(total, 3),
        "unit": "sec",
        "queries": {k: round(v, 3) for k, v in results.items()},
        "sf": _sf_label(sf_dir),
        "cpus": cpus,
        "repeats": repeats,
    }
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
