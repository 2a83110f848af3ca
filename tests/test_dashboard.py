import datetime as dt

import pytest

from crashlake.operators import dashboard as D
from helpers import rows, tables


def _c(cid, borough, date, time="10:00:00", inj=1, killed=0):
    return {"collision_id": cid, "crash_date": date, "crash_time": time, "borough_id": borough,
            "number_of_persons_injured": inj, "number_of_persons_killed": killed,
            "number_of_pedestrians_injured": 0, "number_of_cyclist_injured": 0,
            "number_of_motorist_injured": 0}


@pytest.fixture()
def t(spark):
    coll = [_c(1, 1, "2023-01-01"), _c(2, 2, "2023-01-01", killed=1), _c(3, None, "2023-01-02"),
            _c(4, 3, "2023-01-03", time=None), _c(5, 3, "2023-01-03", time="09:00:00"),
            _c(6, 1, "2023-01-10", inj=None)]
    return tables(spark, boroughs=[(1, "BRONX"), (2, "QUEENS"), (3, "UNKNOWN")], collisions=coll,
                  factors=[(1, "A"), (2, "B")],
                  factor_rows=[(1, 1, 1), (2, 1, 1), (2, 2, 2), (3, 1, 2), (6, 1, 1)])


def test_kpi_empty_all_and_named(t):
    assert rows(D.kpi_summary(t, "2020-01-01", "2020-12-31")) == [(0, 0, 0)]
    assert rows(D.kpi_summary(t, "2023-01-01", "2023-01-10")) == [(6, 5, 1)]
    assert rows(D.kpi_summary(t, "2023-01-01", "2023-01-10", "BRONX")) == [(2, 1, 0)]


def test_trend_and_metric(t):
    out = rows(D.daily_trend(t, "2023-01-01", "2023-01-03", "All"))
    assert [r[0] for r in out] == [dt.date(2023, 1, d) for d in (1, 2, 3)]
    assert out[0][1:3] == (2, 2)
    assert rows(D.trend_metric(t, "2023-01-01", "2023-01-03", "All", "Persons Killed")) == \
        [(dt.date(2023, 1, 1), 1), (dt.date(2023, 1, 2), 0), (dt.date(2023, 1, 3), 0)]
    with pytest.raises(ValueError):
        D.trend_metric(t, "2023-01-01", "2023-01-03", "All", "Bogus")


def test_by_borough_excludes_null_and_unknown(t):
    assert rows(D.crashes_by_borough(t, "2023-01-01", "2023-01-10")) == [("BRONX", 2), ("QUEENS", 1)]


def test_top_factors(t):
    assert rows(D.top_factors(t, "2023-01-01", "2023-01-10", "All", 5)) == [("A", 3), ("B", 2)]
    assert rows(D.top_factors(t, "2023-01-01", "2023-01-01", "QUEENS", 5)) == [("A", 1), ("B", 1)]
    with pytest.raises(ValueError):
        D.top_factors(t, "2023-01-01", "2023-01-10", "All", 4)


def test_latest_null_time_first(t):
    out = rows(D.latest_collisions(t, "2023-01-01", "2023-01-03"))
    assert [r[0] for r in out] == [4, 5, 3, 2, 1]
    assert out[0][3] == "UNKNOWN"


def test_bounds_list_and_window(t):
    assert rows(D.date_bounds(t)) == [(dt.date(2023, 1, 1), dt.date(2023, 1, 10))]
    assert rows(D.borough_list(t)) == [("All",), ("BRONX",), ("QUEENS",), ("UNKNOWN",)]
    assert rows(D.default_window(t))[0][2:] == (dt.date(2023, 1, 1), dt.date(2023, 1, 10))
    with pytest.raises(Exception):
        D.default_window(t, "2024-01-01").collect()


def test_run_sql_params(spark, t):
    out = D.run_sql(spark, t, "SELECT count(*) AS n FROM collisions WHERE crash_date >= :d LIMIT :k",
                    {"d": dt.date(2023, 1, 3), "k": 1})
    assert rows(out) == [(3,)]


def test_sql_leaves_the_callers_views(spark):
    t = tables(spark, boroughs=[(1, "BRONX"), (2, "QUEENS")])
    spark.range(3).createOrReplaceTempView("boroughs")
    spark.range(5).createOrReplaceTempView("own")
    sql = """WITH named AS (SELECT borough_name FROM boroughs WHERE borough_id >= :least)
             SELECT borough_name, (SELECT count(*) FROM own) AS n FROM named ORDER BY borough_name DESC LIMIT :k; """
    got = D.run_sql(spark, t, sql, {"least": 1, "k": 5})
    assert rows(got) == [("QUEENS", 5), ("BRONX", 5)]
    assert spark.table("boroughs").count() == 3
    assert not [v.name for v in spark.catalog.listTables() if v.name.startswith("crashlake_")]
    for name in ("boroughs", "own"):
        spark.catalog.dropTempView(name)
