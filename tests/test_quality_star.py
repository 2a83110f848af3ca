import datetime as dt

from pyspark.sql import functions as F

from crashlake.operators import quality as K
from crashlake.operators import star as T
from crashlake.operators.ids import assign_ids
from helpers import rows, tables


def _c(cid, **kw):
    base = {"collision_id": cid, "crash_date": "2023-01-07", "borough_id": 1, "zip_code": "10001",
            "on_street_name": "MAIN", "number_of_persons_injured": 0, "number_of_persons_killed": 0}
    base.update(kw)
    return base


def test_checks_find_planted_violations(spark):
    t = tables(spark, boroughs=[(1, "A"), (2, "A")],
               collisions=[_c(1), _c(1), _c(2, number_of_persons_injured=-2), _c(3, borough_id=9)],
               vehicle_types=[(1, "Sedan")],
               vehicles=[(1, 1, 1), (2, 6, 1), (4, 1, 1), (3, 1, 7)])
    got = {(r.table_name, r.rule, r.key) for r in K.validate(t).collect()}
    assert ("boroughs", "unique(borough_name)", "A") in got
    assert ("collisions", "unique(collision_id)", "1") in got
    assert ("collisions", "range(number_of_persons_injured>=0)", "2") in got
    assert ("collisions", "foreign_key(borough_id->boroughs.borough_id)", "9") in got
    assert ("collision_vehicles", "foreign_key(collision_id->collisions.collision_id)", "4") in got
    assert ("collision_vehicles", "foreign_key(vehicle_type_id->vehicle_types.vehicle_type_id)", "7") in got
    assert ("collision_vehicles", "range(vehicle_order 1..5)", "2|6") in got
    assert len(got) == 7


def test_delete_cascade(spark):
    t = tables(spark, boroughs=[(1, "A")], collisions=[_c(1), _c(2)], vehicle_types=[(1, "S")],
               vehicles=[(1, 1, 1), (2, 1, 1)], factors=[(1, "F")], factor_rows=[(1, 1, 1), (2, 2, 1)])
    out = K.delete_cascade(t, spark.createDataFrame([(1,)], "collision_id long"))
    assert rows(out.collisions.select("collision_id")) == [(2,)]
    assert rows(out.collision_vehicles) == [(2, 1, 1)]
    assert rows(out.collision_factors) == [(2, 2, 1)]


def test_fact_grain_and_counts(spark):
    t = tables(spark, boroughs=[(1, "A")],
               collisions=[_c(1, on_street_name="A ST"), _c(2, on_street_name="B ST"),
                           _c(3, zip_code=None, on_street_name=None, borough_id=None)],
               vehicle_types=[(1, "S"), (2, "B")], vehicles=[(1, 1, 1), (1, 2, 2), (1, 3, 1)],
               factors=[(1, "F"), (2, "G")], factor_rows=[(1, 1, 1), (1, 2, 2), (1, 3, 1)])
    fact = T.fact_collisions(t)
    out = {r.collision_id: r for r in fact.collect()}
    assert set(out) == {1, 2, 3}
    assert (out[1].vehicle_count, out[1].factor_count) == (3, 2)
    assert (out[2].vehicle_count, out[2].factor_count) == (0, 0)
    assert out[1].date_key == 20230107
    assert out[3].location_key is not None and out[3].borough_key is None
    assert len({r.location_key for r in out.values()}) == 3
    assert dict(rows(T.fact_grain_check(fact, t.collisions))) == \
        {"fact_rows": 3, "collision_rows": 3, "duplicate_keys": 0}


def test_dim_date(spark):
    t = tables(spark, collisions=[_c(1, crash_date="2023-01-06"), _c(2, crash_date="2023-01-09")])
    d = rows(T.dim_date(t.collisions), "full_date")
    assert [r[0] for r in d] == [20230106, 20230107, 20230108, 20230109]
    assert [(r[5], r[6]) for r in d] == [(5, False), (6, True), (7, True), (1, False)]


def test_assign_ids_dense_unique_and_stable(spark):
    vals = spark.range(1000).select((F.col("id") % 300).cast("string").alias("v"))
    ids = assign_ids(vals, ["v"], "id")
    a = rows(ids, "v")
    assert sorted(r[0] for r in a) == list(range(1, 301))
    assert a == rows(ids, "v")  # recomputation gives the same ids
    existing = ids.filter(F.col("id") <= 100)
    more = assign_ids(vals, ["v"], "id", existing=existing)
    assert sorted(r[0] for r in more.collect()) == list(range(101, 301))


def test_hot_locations_take_the_broadcast_path(spark):
    coll = [_c(i, zip_code=None, on_street_name=None) for i in range(1, 8)] + [_c(20), _c(21, on_street_name="B")]
    t = tables(spark, boroughs=[(1, "A")], collisions=coll)
    plain = rows(T.fact_collisions(t, hot_rows=10**9).select("collision_id", "location_key"), "collision_id")
    split = rows(T.fact_collisions(t, hot_rows=2).select("collision_id", "location_key"), "collision_id")
    assert len(split) == 9 and len({k for _, k in split[:7]}) == 1
    # same grouping of collisions into locations either way
    def groups(r):
        by = {}
        for cid, k in r:
            by.setdefault(k, set()).add(cid)
        return sorted(map(sorted, by.values()))
    assert groups(plain) == groups(split)


def test_ids_do_not_depend_on_physical_partitioning(spark):
    vals = spark.range(3000).select((F.col("id") * 7 % 1000).cast("string").alias("v"))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "3")
        a = rows(assign_ids(vals.repartition(5), ["v"], "id", num_partitions=8), "v")
        spark.conf.set("spark.sql.shuffle.partitions", "11")
        b = rows(assign_ids(vals.repartition(2), ["v"], "id", num_partitions=8), "v")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert a == b and sorted(r[0] for r in a) == list(range(1, 1001))


def test_lookup_ids_hot_and_cold_paths_agree(spark):
    from crashlake.operators.lookup import lookup_ids
    rows_df = spark.createDataFrame(
        [(i, 1, "Sedan") for i in range(50)] + [(i, 2, "Bus") for i in range(5)] + [(99, 1, "Nope")],
        "collision_id long, vehicle_order int, vehicle_type_desc string")
    dim = spark.createDataFrame([(1, "Sedan"), (2, "Bus")], "vehicle_type_id int, vehicle_type_desc string")
    def run(hot):
        return rows(lookup_ids(rows_df, dim, "vehicle_type_desc", "vehicle_type_id",
                               ["collision_id", "vehicle_order"], hot_rows=hot)
                    .select("collision_id", "vehicle_order", "vehicle_type_id"), "collision_id", "vehicle_order")
    assert run(10) == run(10**9)
    assert len(run(10)) == 55 and {r[2] for r in run(10)} == {1, 2}


def test_lookup_keeps_unmatched_rows_when_asked(spark):
    from crashlake.operators.lookup import lookup_ids
    rows_df = spark.createDataFrame([(1, "A"), (2, "B"), (3, None), (4, "Z")] + [(i, "A") for i in range(10, 40)], "id long, name string")
    dim = spark.createDataFrame([(1, "A"), (2, "B")], "dim_id int, name string")
    for hot in (5, 10**9):
        got = rows(lookup_ids(rows_df, dim, "name", "dim_id", ["id"], hot_rows=hot, keep_unmatched=True).select("id", "dim_id"), "id")
        assert got[:4] == [(1, 1), (2, 2), (3, None), (4, None)] and len(got) == 34


def test_locations_without_counts_are_refused(spark):
    import pytest
    t = tables(spark, boroughs=[(1, "A")], collisions=[_c(1)])
    with pytest.raises(ValueError, match="n_collisions"):
        T.fact_collisions(t, locations=T.dim_location(T.stg_tables(t).collisions))


def test_rebuilt_star_keeps_location_keys_and_its_readers(spark, scratch):
    from crashlake.plans.star_build import build_star, current_version, grain_ok, read_star
    from crashlake.sources import store
    root, out = f"{scratch}/store", f"{scratch}/star"

    def put(collisions):
        for name, df in tables(spark, boroughs=[(1, "A")], collisions=collisions).items():
            store.write_table(name, df, root, mode="overwrite")

    def keys():
        return {r[0]: r[1:] for r in rows(read_star(spark, out)["dim_location"].select("on_street_name", "location_key"))}

    put([_c(1, on_street_name="M"), _c(2, on_street_name="Z")])
    build_star(spark, root, out)
    first, version = keys(), current_version(spark, out)
    put([_c(1, on_street_name="M"), _c(2, on_street_name="Z"), _c(3, on_street_name="B"), _c(4, on_street_name=None)])
    build_star(spark, root, out)
    assert current_version(spark, out) != version and {k: v for k, v in keys().items() if k in first} == first
    assert len(set(keys().values())) == 4 and grain_ok(spark, root, out)
    star = read_star(spark, out)
    assert star["dim_location"].columns == ["location_key", *T.LOCATION_COLUMNS]
    placed = star["fact_collisions"].join(star["dim_location"], "location_key")
    assert sorted((r.collision_id, r.on_street_name) for r in placed.collect()) == [(1, "M"), (2, "Z"), (3, "B"), (4, None)]
