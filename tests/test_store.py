import os

from pyspark.sql import functions as F

from crashlake.sources import store
from crashlake.sources.fixtures import fixture_tables
from crashlake.operators import dashboard as D

SF = "/root/testdata/sf0.001"


def test_layout_partitions_collisions_by_year_and_prunes(spark, scratch):
    root = os.path.join(scratch, "store")
    fx = fixture_tables(spark, SF)
    for name, df in fx.items():
        store.write_table(name, df, root, mode="overwrite")
    years = sorted(d for d in os.listdir(os.path.join(root, "collisions")) if d.startswith("crash_year="))
    assert years[0] == "crash_year=1995" and len(years) >= 5
    t = store.read_tables(spark, root)
    assert t.collisions.count() == fx.collisions.count()
    q = D.kpi_summary(t, "1997-01-01", "1997-12-31")
    plan = q._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(crash_year" in plan and "(crash_year" in plan
    assert q.collect() == D.kpi_summary(fx, "1997-01-01", "1997-12-31").collect()


def test_export_csv(spark, scratch):
    out = os.path.join(scratch, "detail")
    fx = fixture_tables(spark, SF)
    df = D.latest_collisions(fx, "1997-01-01", "1997-12-31")
    store.export_csv(df, out)
    back = spark.read.option("header", True).csv(out)
    assert back.count() == df.count() and back.columns == df.columns


def test_bucketed_tables_join_without_shuffle(spark, scratch):
    fx = fixture_tables(spark, SF)
    store.write_bucketed(spark, fx, "crashlake_test", 4)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        c = spark.table("crashlake_test.collisions")
        f = spark.table("crashlake_test.collision_factors")
        j = c.join(f, "collision_id")
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert j.count() == fx.collisions.join(fx.collision_factors, "collision_id").count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_star_build_writes_all_tables_with_the_grain(spark, scratch):
    from crashlake.plans.star_build import STAR_TABLES, build_star, grain_ok
    root, out = os.path.join(scratch, "store"), os.path.join(scratch, "star")
    fx = fixture_tables(spark, SF)
    for name, df in fx.items():
        store.write_table(name, df, root, mode="overwrite")
    paths = build_star(spark, root, out)
    assert set(paths) == set(STAR_TABLES)
    assert grain_ok(spark, root, out)
    fact = spark.read.parquet(paths["fact_collisions"])
    assert fact.filter(F.col("location_key").isNull()).count() == 0
    loc = spark.read.parquet(paths["dim_location"])
    assert loc.select("location_key").distinct().count() == loc.count()
