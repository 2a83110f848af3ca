"""SURVEY §5 invariants on the driver-derived tables (sf0.001)."""

from pyspark.sql import functions as F

from crashlake.operators import dashboard as D
from crashlake.operators import normalize as N
from crashlake.operators import quality as K
from crashlake.operators import rankings
from crashlake.plans import params as P
from crashlake.sources import store
from crashlake.sources.fixtures import fixture_tables, fx_raw

SF = "/root/testdata/sf0.001"


def test_kpi_equals_trend_and_borough_totals(spark):
    t = fixture_tables(spark, SF)
    for borough in ("All", P.DASH_BOROUGH):
        kpi = D.kpi_summary(t, P.DASH_START, P.DASH_END, borough).first()
        trend = D.daily_trend(t, P.DASH_START, P.DASH_END, borough).agg(
            F.sum("crashes"), F.sum("persons_injured"), F.sum("persons_killed")).first()
        assert tuple(kpi) == tuple(trend)
    by_borough = D.crashes_by_borough(t, P.DASH_START, P.DASH_END).agg(F.sum("crashes")).first()[0]
    no_borough = t.collisions.filter(F.col("borough_id").isNull()
                                     & F.col("crash_date").between(P.DASH_START, P.DASH_END)).count()
    assert by_borough + no_borough == D.kpi_summary(t, P.DASH_START, P.DASH_END).first()[0]


def test_load_output_satisfies_every_table_rule(spark):
    res = N.normalize_feed(N.clean_feed(fx_raw(spark, SF), order_col="src_seq"))
    assert K.validate(res.dims).count() == 0
    assert res.rejects.count() > 0  # the dirty feed does contain rule breakers


def test_fixture_tables_satisfy_every_rule(spark):
    assert K.validate(fixture_tables(spark, SF)).count() == 0


def test_every_line_is_one_child_row(spark):
    """No row of lineitem or orders is lost or doubled on the way to the tables."""
    t, lines = fixture_tables(spark, SF), spark.read.parquet(f"{SF}/lineitem.parquet")
    assert t.collision_vehicles.count() == t.collision_factors.count() == lines.count()
    assert t.collision_vehicles.select("collision_id", "vehicle_order").distinct().count() == lines.count()
    assert t.collisions.filter("collision_id < 1099511627776").count() == spark.read.parquet(f"{SF}/orders.parquet").count()
    assert t.collision_vehicles.join(t.collisions, "collision_id", "left_anti").count() == 0


def test_rankings_join_the_facts_once(spark, scratch):
    """Q2 and Q3 rank a rate they have just counted: the counts are shuffled once and read twice."""
    root = f"{scratch}/store"
    for name, df in fixture_tables(spark, SF).items():
        store.write_table(name, df, root, mode="overwrite")
    t = store.read_tables(spark, root)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for query in (rankings.factor_fatality_rank, rankings.vehicle_severity_rank):
            df = query(t)
            df.collect()
            plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert plan.count("ReusedExchange") >= 1
            scans = [x for x in plan.splitlines() if "FileScan" in x and f"{root}/collisions" in x]
            assert len(scans) == 1, plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
