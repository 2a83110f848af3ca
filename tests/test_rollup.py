"""The daily rollup of a store against scans of its collisions."""

import os

import pytest

from crashlake.operators import dashboard as D
from crashlake.operators import rollup as U
from crashlake.plans.load import load_feed
from crashlake.sources import day_index, key_index, store
from helpers import base_row, rows, tables
from test_load import write_csv

SPAN = ("2019-12-31", "2022-06-30")
NAMES = [(1, "BRONX"), (2, "QUEENS"), (3, "UNKNOWN")]


def some(spark, first, n):
    """Collisions of every borough and none, some without a date or figures."""
    return tables(spark, boroughs=NAMES, collisions=[
        {"collision_id": first + i, "crash_date": None if i % 11 == 10 else f"20{19 + i % 5}-0{1 + i % 9}-1{i % 3}", "borough_id": [1, 2, 3, None][i % 4],
         "number_of_persons_injured": i % 3, "number_of_motorist_injured": None if i % 5 else 2} for i in range(n)])


def append(spark, root, first, n):
    rows = some(spark, first, n).collisions
    store.write_table("collisions", rows, root, num_files=2)


def new_store(spark, scratch):
    root = os.path.join(scratch, "store")
    store.create_tables(spark, root)
    store.write_table("boroughs", some(spark, 0, 0).boroughs, root, num_files=1)
    return root


def same_as_scan(spark, root, start=SPAN[0], end=SPAN[1], borough="BRONX"):
    t = store.read_tables(spark, root)
    days = day_index.daily(spark, root, start, end)
    assert rows(U.daily_trend(days, t.boroughs, start, end, borough)) == rows(D.daily_trend(t, start, end, borough))
    assert rows(U.crashes_by_borough(days, t.boroughs, start, end)) == rows(D.crashes_by_borough(t, start, end))


def test_two_loads(spark, scratch):
    root = new_store(spark, scratch)
    for first in (0, 40):
        append(spark, root, first, 40)
        day_index.refresh(spark, root)
    day_index.refresh(spark, root)  # nothing waits
    same_as_scan(spark, root)
    t, days = store.read_tables(spark, root), day_index.daily(spark, root, *SPAN)
    assert rows(U.kpi_summary(days, t.boroughs, *SPAN)) == rows(D.kpi_summary(t, *SPAN))
    assert rows(U.trend_metric(days, t.boroughs, *SPAN, "All", "Persons Injured")) == rows(D.trend_metric(t, *SPAN, "All", "Persons Injured"))
    same_as_scan(spark, root, "1990-01-01", "1990-12-31", "All")
    assert days.inputFiles() and all("/_rollup/" in f for f in days.inputFiles())  # no collision is read


def test_a_load_rolls_its_files_up(spark, scratch):
    root, path = os.path.join(scratch, "store"), os.path.join(scratch, "a.csv")
    write_csv(path, [base_row(i, crash_date=f"2020-03-0{1 + i % 3}", number_of_persons_killed="1") for i in range(9)])
    load_feed(spark, path, root)
    days = day_index.daily(spark, root, *SPAN)
    assert all("/_rollup/" in f for f in days.inputFiles())
    assert rows(days.groupBy("crash_date").sum("crashes", "persons_killed").select("sum(crashes)", "sum(persons_killed)")) == [(3, 3)] * 3


def test_waiting_twice_rolled_and_vanished_files(spark, scratch):
    root = new_store(spark, scratch)
    append(spark, root, 0, 30)
    day_index.refresh(spark, root)
    append(spark, root, 1000, 10)  # a load that died before its refresh
    same_as_scan(spark, root)
    day_index.refresh(spark, root)
    same_as_scan(spark, root)
    # a second run that rolled the same files up, and one that died before it named its files
    names = day_index._read(spark, root, "files", day_index.FILES)
    for part in ("days", "files"):
        again = day_index._read(spark, root, part, day_index.DAYS if part == "days" else day_index.FILES).withColumn("run", store.F.lit("later"))
        writer = again.write.mode("append")
        (writer.partitionBy("crash_year") if part == "days" else writer).parquet(store.table_path(root, f"_rollup/{part}"))
    day_index._read(spark, root, "days", day_index.DAYS).withColumn("run", store.F.lit("0 dead")).write.mode("append").partitionBy("crash_year").parquet(
        store.table_path(root, "_rollup/days"))
    assert names.select("file").distinct().count() == len(key_index.stored_files(spark, root, "collisions"))
    same_as_scan(spark, root)
    # a rewrite takes a file away
    store.remove(spark, f"{root}/collisions/{key_index.stored_files(spark, root, 'collisions')[0]}")
    spark.catalog.refreshByPath(f"{root}/collisions")
    same_as_scan(spark, root)


def test_empty_store_and_unknown_metric(spark, scratch):
    root = os.path.join(scratch, "store")
    store.create_tables(spark, root)
    day_index.refresh(spark, root)
    same_as_scan(spark, root)
    with pytest.raises(ValueError, match="unknown trend metric"):
        U.trend_metric(day_index.daily(spark, root, *SPAN), store.read_tables(spark, root).boroughs, *SPAN, "All", "Nothing")
