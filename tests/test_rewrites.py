"""Deletes, compaction and two-key order over stored files."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from crashlake import schema as S
from crashlake.__main__ import main
from crashlake.functions.curve import interleave
from crashlake.operators import quality as K
from crashlake.operators import rankings as Q
from crashlake.operators import rollup as U
from crashlake.plans.load import load_feed
from crashlake.sources import day_index, files, key_index, rewrites, store
from crashlake.sources.files import stored_files
from helpers import base_row, tables
from test_load import write_csv


def load(spark, scratch, root, name, ids, **values):
    path = os.path.join(scratch, f"{name}.csv")
    write_csv(path, [base_row(i, vehicle_type_code1="Sedan", contributing_factor_vehicle_1="Speeding", **values) for i in ids])
    load_feed(spark, path, root)


def keys(t):
    return {name: sorted(tuple(r)[:2] for r in getattr(t, name).collect()) for name in store.FACT_TABLES}


@pytest.fixture()
def root(spark, scratch):
    """Six files of each table, with a year and a far stretch of ids each."""
    root, ids = os.path.join(scratch, "store"), [(k, k * 10 * key_index.BLOCK + i) for k in range(6) for i in range(4)]
    t = tables(spark, boroughs=[(1, "BRONX")], vehicle_types=[(1, "Sedan")], factors=[(1, "Speeding")],
               collisions=[{"collision_id": i, "crash_date": f"202{k}-03-01", "borough_id": 1, **{c: 0 for c in S.COUNT_COLUMNS}} for k, i in ids],
               vehicles=[(i, 1, 1) for _, i in ids], factor_rows=[(i, 1, 1) for _, i in ids])
    for name, df in t.items():
        if name in store.FACT_TABLES:
            for k in range(6):
                store.write_table(name, df.where(F.floor(F.col("collision_id") / (10 * key_index.BLOCK)) == k), root, num_files=1)
        else:
            store.write_table(name, df, root, num_files=1)
    key_index.refresh(spark, root)
    day_index.refresh(spark, root)
    return root


def test_delete_touches_only_the_files_concerned(spark, root):
    before = store.read_tables(spark, root)
    ids = spark.createDataFrame([(1,), (1,), (2 * 10 * key_index.BLOCK,), (None,), (77,)], "collision_id bigint")
    want = keys(K.delete_cascade(before, ids.where("collision_id is not null")))
    listed = {name: set(stored_files(spark, root, name)) for name in store.FACT_TABLES}
    done = rewrites.delete_collisions(spark, root, ids)
    assert set(done) == set(store.FACT_TABLES) and all(old == 2 for _, old in done.values())
    assert keys(store.read_tables(spark, root)) == want
    for name in store.FACT_TABLES:
        now = set(stored_files(spark, root, name))
        assert len(listed[name] - now) == 2 and len(listed[name] & now) == len(listed[name]) - 2
    # a reader that planned before sees its own state, whole
    assert before.collisions.count() == 24 and before.collision_factors.count() == 24
    # bounds, rollup and a further load follow
    days = day_index.daily(spark, root, "2020-01-01", "2030-01-01")
    assert all("/_rollup/" in f or "/_rewrites/" in f for f in days.inputFiles())
    assert U.kpi_summary(days, store.read_tables(spark, root).boroughs, "2020-01-01", "2030-01-01", "All").first().total_crashes == 22


def test_delete_of_nothing(spark, root):
    ids = spark.createDataFrame([(999,), (None,)], "collision_id bigint")
    before = keys(store.read_tables(spark, root))
    assert rewrites.delete_collisions(spark, root, ids) == {}
    assert rewrites.delete_collisions(spark, root, ids.limit(0)) == {}
    assert keys(store.read_tables(spark, root)) == before and not files.rewritten(spark, root)


def test_delete_all_then_load_again(spark, scratch, root):
    ids = store.read_tables(spark, root).collisions.select("collision_id")
    rewrites.delete_collisions(spark, root, ids)
    t = store.read_tables(spark, root)
    assert t.collisions.count() == t.collision_vehicles.count() == t.collision_factors.count() == 0
    assert key_index.date_bounds(spark, root).first().min_date is None
    load(spark, scratch, root, "again", range(4), crash_date="2020-03-01")  # a deleted id is new again
    t = store.read_tables(spark, root)
    assert t.collisions.count() == 4 and t.collision_vehicles.count() == 4 and K.validate(t).count() == 0


def test_compaction(spark, scratch):
    root = os.path.join(scratch, "store")
    for k in range(3):
        load(spark, scratch, root, f"f{k}", [k * 100 + i for i in range(20)], crash_date=f"202{k % 2}-0{1 + k}-01")
    before, old = store.read_tables(spark, root), {n: stored_files(spark, root, n) for n in store.FACT_TABLES}
    want = {n: sorted(map(str, getattr(before, n).collect())) for n in store.FACT_TABLES}
    done = rewrites.compact(spark, root)
    after = store.read_tables(spark, root)
    assert {n: sorted(map(str, getattr(after, n).collect())) for n in store.FACT_TABLES} == want
    assert {n: sorted(map(str, getattr(before, n).collect())) for n in store.FACT_TABLES} == want  # the earlier state
    assert len(stored_files(spark, root, "collisions")) == 2  # a file a year
    assert len(stored_files(spark, root, "collision_vehicles")) == len(stored_files(spark, root, "collision_factors")) == 1
    assert done["collision_vehicles"] == (1, len(old["collision_vehicles"]))
    assert rewrites.compact(spark, root) == {}  # nothing small is left beside another
    # a delete reaches into merged files, a load goes on, old files go
    rewrites.delete_collisions(spark, root, spark.createDataFrame([(0,)], "collision_id bigint"))
    load(spark, scratch, root, "more", [0, 1, 1000])
    assert store.read_tables(spark, root).collisions.count() == 61
    assert rewrites.vacuum(spark, root) > 0 and rewrites.vacuum(spark, root) == 0
    t = store.read_tables(spark, root)
    assert t.collisions.count() == 61 and t.collision_factors.count() == 61 and K.validate(t).count() == 0


def test_bins_hold_neighbours_up_to_the_target():
    found = [(f"f{i}", "y1", i, 30) for i in range(10)] + [("big", "y1", 3, 90), ("lone", "y2", 0, 10), ("u", "y1", None, 30)]
    got = rewrites.bins(found, 100)
    assert got == [["f0", "f1", "f2"], ["f3", "f4", "f5"], ["f6", "f7", "f8"], ["f9", "u"]]
    assert rewrites.bins([], 100) == []


def test_unpublished_files_are_not_seen(spark, root):
    before = keys(store.read_tables(spark, root))
    t = store.read_tables(spark, root)
    rewrites._put(spark, root, "died", "collisions", t.collisions, [])  # a rewrite that died before its log
    assert keys(store.read_tables(spark, root)) == before
    assert rewrites.vacuum(spark, root) == 1 and keys(store.read_tables(spark, root)) == before


def test_reset_forgets_rewrites(spark, root):
    rewrites.compact(spark, root)
    rewrites.delete_collisions(spark, root, spark.createDataFrame([(1,)], "collision_id bigint"))
    store.create_tables(spark, root)
    assert [df.count() for _, df in store.read_tables(spark, root).items()] == [0] * 6


def test_interleaved_bits(spark):
    got = spark.range(64).select(F.col("id").alias("a"), (63 - F.col("id")).alias("b")).select("a", "b", interleave([F.col("a"), F.col("b")]).alias("z"))
    def plain(a, b):
        return int("".join(x + y for x, y in zip(f"{a:06b}", f"{b:06b}")), 2)
    assert all(r.z == plain(r.a, r.b) for r in got.collect())


def _rows_scanned(df):
    plan = df._jdf.queryExecution().executedPlan()
    df._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_filter_on_either_column_skips_rows(spark, scratch):
    root, n = os.path.join(scratch, "store"), 6000
    day = dt.date(2023, 1, 1)
    crashes = [{"collision_id": i, "crash_date": day + dt.timedelta(i % 360), "borough_id": None if i % 97 == 0 else 1 + (i // 360) % 5} for i in range(n)]
    t = tables(spark, boroughs=[(b, f"B{b}") for b in range(1, 6)], collisions=crashes,
               factors=[(f, f"F{f}") for f in range(1, 41)], factor_rows=[(i, 1, 1 + (i * 7) % 40) for i in range(n)])
    store.append_new(t, root, num_files=8)
    plain = store.read_tables(spark, root)
    asked = {  # a filter on the column that the load's order does not serve, and on the one it does
        "collisions": ["borough_id = 3", "crash_date between '2023-03-01' and '2023-03-20'"],
        "collision_factors": ["factor_id = 11", "collision_id between 100 and 300"]}
    before = {c: _rows_scanned(getattr(plain, name).where(c)) for name, cs in asked.items() for c in cs}
    want = keys(plain)
    for name in asked:
        new, old = rewrites.cluster(spark, root, name, target_bytes=max(1, sum(rewrites._sizes(spark, root, name, stored_files(spark, root, name)).values()) // 32))
        assert new >= 16 and old > 0
    after = store.read_tables(spark, root)
    assert keys(after) == want
    for name, cs in asked.items():
        for c in cs:
            assert _rows_scanned(getattr(after, name).where(c)) < 0.6 * n
            assert getattr(after, name).where(c).count() == getattr(plain, name).where(c).count()
    assert before["borough_id = 3"] > 0.9 * n and before["factor_id = 11"] > 0.9 * n


def test_curve_of_empty_tables_and_outliers(spark, scratch):
    root = os.path.join(scratch, "store")
    store.create_tables(spark, root)
    for name in store.FACT_TABLES:
        rewrites.cluster(spark, root, name)
        assert getattr(store.read_tables(spark, root), name).count() == 0
    t = tables(spark, factors=[(1, "F")], factor_rows=[(i, 1, 1) for i in [-5, 0, 2**40, 2**62]], collisions=[{"collision_id": 2**62, "crash_date": None}])
    store.append_new(t, root)
    for name in store.FACT_TABLES:
        rewrites.cluster(spark, root, name, target_bytes=1)
    now = store.read_tables(spark, root)
    assert now.collision_factors.count() == 4 and now.collisions.first().collision_id == 2**62


def test_command_line(spark, scratch, root, capsys):
    with open(os.path.join(scratch, "ids.csv"), "w") as fh:
        fh.write("collision_id\n1\nx\n\n")
    main(["compact", "--store", root])
    main(["cluster", "--store", root])
    main(["delete", "--store", root, "--ids", os.path.join(scratch, "ids.csv")])
    main(["vacuum", "--store", root])
    out = capsys.readouterr().out
    assert "became" in out and "removed" in out
    assert store.read_tables(spark, root).collisions.count() == 23


def test_compacting_and_ranking_a_store_send_no_collisions_to_the_driver(spark, root, monkeypatch):
    put, plans = rewrites._put, []

    def seen(spark, root, run, name, rows, by):
        plans.append(rows._jdf.queryExecution().sparkPlan().toString())
        return put(spark, root, run, name, rows, by)
    monkeypatch.setattr(rewrites, "_put", seen)
    late = spark.createDataFrame([(2, 2, 1)], "collision_id bigint, factor_order int, factor_id int")
    store.write_table("collision_factors", late, root, num_files=1)
    store.write_table("collisions", store.read_tables(spark, root).collisions.where("collision_id = 2").withColumn("collision_id", F.lit(9).cast("bigint")), root, num_files=1)
    before = keys(store.read_tables(spark, root))
    assert set(rewrites.compact(spark, root)) == set(store.FACT_TABLES)
    assert len(plans) == 3 and all("BroadcastHashJoin" in p and "BuildRight" in p and "BuildLeft" not in p for p in plans)
    t = store.read_tables(spark, root)
    assert keys(t) == before
    plan = Q.factor_fatality_rank(t, 1)._jdf.queryExecution().sparkPlan().toString()
    assert "SortMergeJoin [collision_id" in plan and "BroadcastHashJoin [collision_id" not in plan
    assert [tuple(r) for r in Q.factor_fatality_rank(t, 1).collect()] == [("Speeding", 25, 0, 0.0, 1)]
