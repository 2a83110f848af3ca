import csv
import os

import pytest

from crashlake import schema as S
from crashlake.plans.load import load_feed
from crashlake.sources import store
from crashlake.sources.feed import read_feed
from crashlake.streaming.incremental import start_incremental_load
from helpers import base_row


def write_csv(path, rows, columns=S.FEED_COLUMNS):
    with open(path, "w", newline="") as fh:
        w = csv.writer(fh)
        w.writerow(columns)
        for r in rows:
            w.writerow(["" if r.get(c) is None else r.get(c) for c in columns])


def counts(spark, root):
    t = store.read_tables(spark, root)
    return {name: df.count() for name, df in t.items()}


BATCH1 = [
    base_row("1", vehicle_type_code1="Sedan", contributing_factor_vehicle_1="Speeding"),
    base_row("2", borough=" QUEENS ", vehicle_type_code1=None, contributing_factor_vehicle_1="Unspecified"),
    base_row("2", crash_date="2024-05-05", vehicle_type_code1="Bus"),
    base_row("3", number_of_persons_killed="-1", vehicle_type_code1="Taxi"),
    base_row("n/a"),
]


def test_read_feed_by_header_name(spark, scratch):
    path = os.path.join(scratch, "feed.csv")
    cols = list(reversed(S.FEED_COLUMNS[:-3]))  # other order, three slot columns missing
    write_csv(path, BATCH1, cols)
    f = read_feed(spark, path)
    assert f.columns == list(S.FEED_COLUMNS) + ["_corrupt_record", "_order"]
    got = [(r.collision_id, r.vehicle_type_code_5) for r in f.orderBy("_order").collect()]
    assert got[0] == ("1", None) and len(got) == 5


def test_missing_file_is_an_error(spark, scratch):
    try:
        read_feed(spark, os.path.join(scratch, "nope.csv"))
    except Exception as e:  # noqa: BLE001
        assert "PATH_NOT_FOUND" in str(e) or "does not exist" in str(e)
    else:
        raise AssertionError("expected an error")


def test_load_twice_is_a_no_op_and_second_batch_appends(spark, scratch):
    root = os.path.join(scratch, "store")
    p1 = os.path.join(scratch, "b1.csv")
    write_csv(p1, BATCH1)
    load_feed(spark, p1, root)
    first = counts(spark, root)
    assert first == {"boroughs": 2, "collisions": 2, "vehicle_types": 3, "collision_vehicles": 2,
                     "factors": 1, "collision_factors": 1}
    load_feed(spark, p1, root)
    assert counts(spark, root) == first
    t = store.read_tables(spark, root)
    old_types = {r.vehicle_type_desc: r.vehicle_type_id for r in t.vehicle_types.collect()}

    p2 = os.path.join(scratch, "b2.csv")
    write_csv(p2, [base_row("2", vehicle_type_code2="Truck"), base_row("9", borough="BROOKLYN",
                                                                       vehicle_type_code1="Sedan")])
    load_feed(spark, p2, root)
    t = store.read_tables(spark, root)
    types = {r.vehicle_type_desc: r.vehicle_type_id for r in t.vehicle_types.collect()}
    assert {k: types[k] for k in old_types} == old_types and "Truck" in types
    assert sorted(r.collision_id for r in t.collisions.collect()) == [1, 2, 9]
    assert sorted(tuple(r) for r in t.collision_vehicles.select("collision_id", "vehicle_order").collect()) == \
        [(1, 1), (2, 1), (2, 2), (9, 1)]
    rej = spark.read.parquet(store.table_path(root, "_rejects")).select("collision_id", "reason").distinct()
    assert [tuple(r) for r in rej.collect()] == [(3, "number_of_persons_killed_negative")]


def test_quoted_fields_and_headers_per_file(spark, scratch):
    street = 'MAIN "A" ST, 2\nNORTH'
    write_csv(os.path.join(scratch, "a.csv"), [base_row("1", on_street_name=street)])
    write_csv(os.path.join(scratch, "b.csv"), [base_row("2", on_street_name=street, borough="QUEENS")], S.FEED_COLUMNS[::-1])
    got = {r.collision_id: (r.borough, r.on_street_name, r._corrupt_record) for r in read_feed(spark, scratch).collect()}
    assert got == {"1": ("BRONX", street, None), "2": ("QUEENS", street, None)}
    with open(os.path.join(scratch, "c.csv"), "w") as fh:
        fh.write("3,no,header\n")
    with pytest.raises(ValueError, match="no header"):
        read_feed(spark, scratch)


def test_broken_rows_become_rejects(spark, scratch):
    path, root = os.path.join(scratch, "f.csv"), os.path.join(scratch, "store")
    write_csv(path, [base_row("1"), base_row("2")])
    with open(path, "a", newline="") as fh:
        fh.write("only,three,fields\r\n" + ",".join(["x"] * 40) + "\r\n")
    load_feed(spark, path, root)
    assert counts(spark, root)["collisions"] == 2
    got = spark.read.parquet(store.table_path(root, "_rejects")).groupBy("reason").count().collect()
    assert [tuple(r) for r in got] == [("corrupt_record", 2)]


def folders(path):
    return sorted(os.listdir(path)) if os.path.isdir(path) else []


def test_replay_leaves_rejects_and_staging_as_they_were(spark, scratch):
    root, path = os.path.join(scratch, "store"), os.path.join(scratch, "f.csv")
    write_csv(path, BATCH1)
    assert load_feed(spark, path, root) == load_feed(spark, path, root)
    assert spark.read.parquet(store.table_path(root, "_rejects")).count() == 1
    assert folders(os.path.join(root, "_staging")) == folders(os.path.join(root, "_lock")) == []


@pytest.mark.parametrize("rows", [
    [base_row("1"), base_row("1", number_of_persons_killed="-5")],  # the losing copy of an id
    [base_row("1", number_of_persons_injured="3.7f")],
])
def test_fail_mode_looks_at_every_row_before_writing(spark, scratch, rows):
    root, path = os.path.join(scratch, "store"), os.path.join(scratch, "f.csv")
    write_csv(path, rows)
    with pytest.raises(ValueError, match="breaks table rules"):
        load_feed(spark, path, root, mode="fail")
    assert not any(folders(os.path.join(root, d)) for d in ("boroughs", "collisions", "_staging", "_lock"))


def test_fail_mode_sees_rows_of_stored_ids(spark, scratch):
    root = os.path.join(scratch, "store")
    for name, rows in (("a.csv", [base_row("1")]), ("b.csv", [base_row("1", number_of_persons_killed="-5")])):
        write_csv(os.path.join(scratch, name), rows)
    load_feed(spark, os.path.join(scratch, "a.csv"), root, mode="fail")
    with pytest.raises(ValueError):
        load_feed(spark, os.path.join(scratch, "b.csv"), root, mode="fail")


def test_second_load_at_once_is_refused(spark, scratch):
    root = os.path.join(scratch, "store")
    with store.one_load(spark, root, "first"):
        with pytest.raises(RuntimeError):
            with store.one_load(spark, root, "second"):
                pass
    assert folders(os.path.join(root, "_lock")) == []


def test_stream_needs_a_lasting_checkpoint(scratch):
    class Unset:
        conf = {}

    with pytest.raises(ValueError, match="checkpoint"):
        start_incremental_load(Unset, scratch, os.path.join(scratch, "store"))


def test_incremental_stream(spark, scratch):
    landing = os.path.join(scratch, "landing")
    os.makedirs(landing)
    root = os.path.join(scratch, "store")
    ckpt = os.path.join(scratch, "ckpt")
    write_csv(os.path.join(landing, "a.csv"), BATCH1)
    q = start_incremental_load(spark, landing, root, checkpoint_location=ckpt)
    q.awaitTermination(300)
    assert counts(spark, root)["collisions"] == 2
    write_csv(os.path.join(landing, "b.csv"), [base_row("10"), base_row("1", crash_date="2020-01-01")])
    q = start_incremental_load(spark, landing, root, checkpoint_location=ckpt)
    q.awaitTermination(300)
    t = store.read_tables(spark, root)
    assert sorted(r.collision_id for r in t.collisions.collect()) == [1, 2, 10]
    assert [str(r.crash_date) for r in t.collisions.filter("collision_id = 1").collect()] == ["2023-01-15"]


def test_file_order_survives_many_splits_and_files(spark, scratch):
    """First-wins needs file order; with tiny splits Spark packs the
    pieces of two files into tasks out of order, the order key must not care."""
    for i, rng in enumerate((range(0, 1500), range(1500, 2200))):
        write_csv(os.path.join(scratch, f"part-{i}.csv"), [base_row(str(k)) for k in rng])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        f = read_feed(spark, scratch)
        assert f.select("_order.file", "_order.block").distinct().count() > 17
        ids = [int(r.collision_id) for r in f.orderBy("_order").select("collision_id").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert ids == list(range(2200))
