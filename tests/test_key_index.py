"""The index of stored files: what an append reads, and bounds without a scan."""

import os

from crashlake.operators import dashboard as D
from crashlake.plans.load import load_feed
from crashlake.sources import key_index, store
from helpers import base_row
from test_load import write_csv


def load(spark, scratch, root, name, ids, **values):
    path = os.path.join(scratch, f"{name}.csv")
    write_csv(path, [base_row(i, vehicle_type_code1="Sedan", contributing_factor_vehicle_1="Speeding", **values) for i in ids])
    load_feed(spark, path, root)
    return path


def test_an_old_id_beside_new_ones_touches_few_files(spark, scratch):
    root, block = os.path.join(scratch, "store"), key_index.BLOCK
    for k in range(6):
        load(spark, scratch, root, f"f{k}", [k * 10 * block + i for i in range(3)], crash_date=f"202{k}-03-01")
    files = key_index.stored_files(spark, root, "collisions")
    assert len(files) >= 6 and key_index.unknown_files(spark, root, "collisions") == []
    ids = spark.createDataFrame([(1,), (500 * block,), (None,)], "collision_id bigint")  # first file, and beyond all
    for name in store.FACT_TABLES:
        touched = key_index.near(spark, root, name, ids)
        assert 0 < len(touched.inputFiles()) < len(key_index.stored_files(spark, root, name)) / 2
        assert {r.collision_id for r in touched.collect()} >= {1}
    # the load of such a feed adds the new id only
    load(spark, scratch, root, "mixed", [1, 500 * block])
    t = store.read_tables(spark, root)
    assert t.collisions.count() == 19 and t.collision_vehicles.count() == 19 and t.collision_factors.count() == 19


def test_unindexed_files_are_read(spark, scratch):
    root = os.path.join(scratch, "store")
    load(spark, scratch, root, "a", range(5))
    row = store.read_tables(spark, root).collisions.limit(1).withColumn("collision_id", store.F.lit(10**12)).withColumn("crash_date", store.F.lit("2031-01-01").cast("date"))
    store.write_table("collisions", row.drop("crash_year"), root)  # a load that died before it indexed
    assert len(key_index.unknown_files(spark, root, "collisions")) == 1
    ids = spark.createDataFrame([(10**12,)], "collision_id bigint")
    assert [r.collision_id for r in key_index.near(spark, root, "collisions", ids).collect()] == [10**12]
    assert str(key_index.date_bounds(spark, root).first().max_date) == "2031-01-01"
    load(spark, scratch, root, "b", [10**12, 7])
    assert key_index.unknown_files(spark, root, "collisions") == []
    assert store.read_tables(spark, root).collisions.count() == 7


def test_bounds_need_no_scan(spark, scratch):
    root = os.path.join(scratch, "store")
    assert key_index.date_bounds(spark, root).first().asDict() == {"min_date": None, "max_date": None}
    load(spark, scratch, root, "a", range(5), crash_date="2020-02-29")
    load(spark, scratch, root, "b", range(5, 9), crash_date="2024-07-01")
    bounds = key_index.date_bounds(spark, root)
    assert bounds.first() == D.date_bounds(store.read_tables(spark, root)).first()
    assert all("/_index/" in f for f in bounds.inputFiles())


def test_ids_far_apart(spark, scratch):
    root = os.path.join(scratch, "store")
    ids = [-5, 0, 2**40, 2**62]
    load(spark, scratch, root, "a", ids)
    load(spark, scratch, root, "b", [*ids, 2**50])
    assert sorted(r.collision_id for r in store.read_tables(spark, root).collisions.select("collision_id").collect()) == [-5, 0, 2**40, 2**50, 2**62]
