"""Command line: load a feed, check the tables, run a query, build the star.

  python -m crashlake load     --feed PATH --store ROOT [--mode quarantine|fail]
  python -m crashlake validate --store ROOT
  python -m crashlake query    NAME --store ROOT [--start D --end D --borough B
                               --top-n N --metric M] [--csv OUT] [--show N]
  python -m crashlake bucket   --store ROOT --database DB [--buckets N]
  python -m crashlake star     --store ROOT --out ROOT2

Query names: q1 q2 q3 kpi trend metric by-borough top-factors latest bounds
boroughs window.  Dates left out take the dashboard's default window (q1: its
own default range).  Results are printed whole - each is bounded by days,
names or a limit - unless ``--show N`` asks for the first N, which says how
many there are; ``--csv`` has the executors write the result.  ``bucket`` stores the tables in buckets of the
collision id; a query with ``--database`` reads those, and joins the facts
without a shuffle.
"""

from __future__ import annotations

import argparse
import sys

from crashlake.operators import dashboard as D
from crashlake.operators import quality as K
from crashlake.operators import rankings as R
from crashlake.operators import rollup as U
from crashlake.schema import ALL_BOROUGHS, RANKING_FROM, RANKING_TO, TOP_FACTORS_DEFAULT


def _queries(a):
    return {
        "q1": lambda t: R.street_severity_rank(t, a.start or RANKING_FROM, a.end or RANKING_TO, a.k),
        "q2": R.factor_fatality_rank,
        "q3": R.vehicle_severity_rank,
        "kpi": lambda t: D.kpi_summary(t, a.start, a.end, a.borough),
        "trend": lambda t: D.daily_trend(t, a.start, a.end, a.borough),
        "metric": lambda t: D.trend_metric(t, a.start, a.end, a.borough, a.metric),
        "by-borough": lambda t: D.crashes_by_borough(t, a.start, a.end),
        "top-factors": lambda t: D.top_factors(t, a.start, a.end, a.borough, a.top_n),
        "latest": lambda t: D.latest_collisions(t, a.start, a.end, a.borough),
        "bounds": D.date_bounds,
        "boroughs": D.borough_list,
        "window": lambda t: D.default_window(t, a.end, start=a.start),
    }


def _rolled(a):
    """What a store's daily rollup answers."""
    return {
        "kpi": lambda days, b: U.kpi_summary(days, b, a.start, a.end, a.borough),
        "trend": lambda days, b: U.daily_trend(days, b, a.start, a.end, a.borough),
        "metric": lambda days, b: U.trend_metric(days, b, a.start, a.end, a.borough, a.metric),
        "by-borough": lambda days, b: U.crashes_by_borough(days, b, a.start, a.end),
    }


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="crashlake")
    sub = p.add_subparsers(dest="cmd", required=True)
    ld = sub.add_parser("load")
    ld.add_argument("--feed", required=True)
    ld.add_argument("--store", required=True)
    ld.add_argument("--mode", default="quarantine", choices=["quarantine", "fail"])
    va = sub.add_parser("validate")
    va.add_argument("--store", required=True)
    qu = sub.add_parser("query")
    qu.add_argument("name")
    at = qu.add_mutually_exclusive_group(required=True)
    at.add_argument("--store")
    at.add_argument("--database")
    qu.add_argument("--start")
    qu.add_argument("--end")
    qu.add_argument("--borough", default=ALL_BOROUGHS)
    qu.add_argument("--top-n", dest="top_n", type=int, default=TOP_FACTORS_DEFAULT)
    qu.add_argument("--k", type=int, default=10)
    qu.add_argument("--metric", default="Crashes")
    qu.add_argument("--csv")
    qu.add_argument("--show", type=int)
    bu = sub.add_parser("bucket")
    bu.add_argument("--store", required=True)
    bu.add_argument("--database", required=True)
    bu.add_argument("--buckets", type=int, default=200)
    st = sub.add_parser("star")
    st.add_argument("--store", required=True)
    st.add_argument("--out", required=True)
    for name in ("compact", "cluster", "vacuum"):
        sub.add_parser(name).add_argument("--store", required=True)
    de = sub.add_parser("delete")
    de.add_argument("--store", required=True)
    de.add_argument("--ids", required=True, help="CSV with a header and a column collision_id")
    a = p.parse_args(argv)

    from pyspark.sql import SparkSession

    from crashlake.session import ensure_checkpoint_dir
    from crashlake.sources import store

    spark = (SparkSession.builder.appName(f"crashlake-{a.cmd}")
             .config("spark.ui.enabled", "false").getOrCreate())
    ensure_checkpoint_dir(spark)
    if a.cmd == "load":
        from crashlake.plans.load import load_feed
        print("load id", load_feed(spark, a.feed, a.store, mode=a.mode))
    elif a.cmd == "validate":
        report = K.validate(store.read_tables(spark, a.store))
        report.groupBy("table_name", "rule").sum("n_rows").show(100, truncate=False)
    elif a.cmd == "query":
        queries, rolled = _queries(a), _rolled(a)
        if a.name not in queries:
            p.error(f"unknown query {a.name!r}; one of {sorted(queries)}")
        tables = store.read_tables(spark, a.store) if a.store else store.read_bucketed(spark, a.database)
        if a.name not in ("q1", "q2", "q3", "bounds", "boroughs", "window"):
            window = D.default_window(tables, a.end, start=a.start).first()
            a.start, a.end = window.start_date, window.end_date
        if a.name == "bounds" and a.store:  # no scan: the bounds kept for the store's files
            from crashlake.sources import key_index
            df = key_index.date_bounds(spark, a.store)
        elif a.name in rolled and a.store:  # the daily rollup, not the collisions
            from crashlake.sources import day_index
            df = rolled[a.name](day_index.daily(spark, a.store, a.start, a.end), tables.boroughs)
        else:
            df = queries[a.name](tables)
        if a.csv:
            store.export_csv(df, a.csv)
        rows = df.count()
        shown = rows if a.show is None else min(a.show, rows)
        df.show(max(shown, 1), truncate=False)
        print(f"{shown} of {rows} rows")
    elif a.cmd == "bucket":
        store.write_bucketed(spark, store.read_tables(spark, a.store), a.database, a.buckets)
    elif a.cmd in ("compact", "cluster", "vacuum", "delete"):
        from crashlake.sources import rewrites
        if a.cmd == "vacuum":
            print(rewrites.vacuum(spark, a.store), "removed")
            return 0
        if a.cmd == "compact":
            done = rewrites.compact(spark, a.store)
        elif a.cmd == "cluster":
            done = {name: rewrites.cluster(spark, a.store, name) for name in store.FACT_TABLES}
        else:
            ids = spark.read.option("header", True).csv(a.ids).selectExpr("try_cast(collision_id AS bigint) AS collision_id")
            done = rewrites.delete_collisions(spark, a.store, ids)
        for name, (new, old) in done.items():
            print(f"{name}: {old} files became {new}")
    elif a.cmd == "star":
        from crashlake.plans.star_build import build_star, grain_ok
        for name, path in build_star(spark, a.store, a.out).items():
            print(name, path)
        print("grain ok" if grain_ok(spark, a.store, a.out) else "GRAIN BROKEN")
    return 0


if __name__ == "__main__":
    sys.exit(main())
