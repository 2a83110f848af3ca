from pyspark.sql import Window
from pyspark.sql import functions as F

from crashlake import schema as S
from crashlake.operators import rankings as R
from crashlake.operators.rank import rank_desc_bounded
from crashlake.tables import CollisionTables
from helpers import rows, tables


def _c(cid, borough, street, inj, killed, date="2023-03-01"):
    return {"collision_id": cid, "crash_date": date, "borough_id": borough, "on_street_name": street,
            "number_of_persons_injured": inj, "number_of_persons_killed": killed}


def test_q1_ties_null_severity_and_null_borough(spark):
    coll = []
    cid = 0
    # borough 1: s1..s9 severities 20..12, s10 and s11 tie at 5 -> 11 rows
    for i, sev in enumerate([20, 19, 18, 17, 16, 15, 14, 13, 12, 5, 5], start=1):
        cid += 1
        coll.append(_c(cid, 1, f"s{i}", sev, 0))
    # borough 2: a street whose only collision has NULL severity ranks first
    coll += [_c(100, 2, "nullst", None, 0), _c(101, 2, "big", 50, 1)]
    # NULL borough is its own partition; outside the window is ignored
    coll += [_c(200, None, "nob", 1, 0), _c(201, 1, "late", 99, 0, date="2025-01-01")]
    t = tables(spark, boroughs=[(1, "A"), (2, "B")], collisions=coll)
    out = rows(R.street_severity_rank(t, "2023-01-01", "2025-01-01"))
    a = [r for r in out if r[0] == "A"]
    assert len(a) == 11 and {r[1] for r in a[-2:]} == {"s10", "s11"}
    b = [r for r in out if r[0] == "B"]
    assert b[0] == ("B", "nullst", 1, None) and b[1] == ("B", "big", 1, 51)
    assert out[-1] == (None, "nob", 1, 1)
    assert "late" not in {r[1] for r in out}


def _factor_table(spark, groups):
    """groups: list of (factor name, n rows, n fatal); one collision per row."""
    coll, frows, facs = [], [], []
    cid = 0
    for fid, (name, n, fatal) in enumerate(groups, start=1):
        facs.append((fid, name))
        for i in range(n):
            cid += 1
            coll.append(_c(cid, 1, "x", 0, 1 if i < fatal else 0))
            frows.append((cid, 1, fid))
    return tables(spark, boroughs=[(1, "A")], collisions=coll, factors=facs, factor_rows=frows)


def test_q2_rounding_min_count_and_rank(spark):
    t = _factor_table(spark, [("f800", 800, 1), ("f4000", 4000, 23), ("f49", 49, 49), ("f50", 50, 0)])
    out = rows(R.factor_fatality_rank(t))
    assert out == [("f4000", 4000, 23, 0.58, 1), ("f800", 800, 1, 0.13, 2), ("f50", 50, 0, 0.0, 3)]


def test_q2_201_of_20000(spark):
    t = _factor_table(spark, [("f", 20000, 201)])
    assert rows(R.factor_fatality_rank(t)) == [("f", 20000, 201, 1.01, 1)]


def test_q2_same_factor_in_two_slots_counts_twice(spark):
    coll = [_c(i, 1, "x", 0, 1 if i == 1 else 0) for i in range(1, 26)]
    frows = [(i, s, 1) for i in range(1, 26) for s in (1, 2)]
    t = tables(spark, boroughs=[(1, "A")], collisions=coll, factors=[(1, "F")], factor_rows=frows)
    assert rows(R.factor_fatality_rank(t)) == [("F", 50, 2, 4.0, 1)]


def test_q3_exclusive_classes_and_slot_one(spark):
    coll, veh = [], []
    for i in range(1, 51):
        killed = 1 if i <= 2 else (None if i <= 5 else 0)
        injured = 3 if i <= 10 else (None if i <= 12 else 0)
        coll.append(_c(i, 1, "x", injured, killed))
        veh.append((i, 1, 1))
        veh.append((i, 2, 2))  # slot 2 is ignored
    t = tables(spark, boroughs=[(1, "A")], collisions=coll, vehicle_types=[(1, "Sedan"), (2, "Bus")],
               vehicles=veh)
    # fatal: ids 1-2 (also injured -> fatal only); injury: 3..10 (killed NULL for 3-5 falls through)
    assert rows(R.vehicle_severity_rank(t)) == [("Sedan", 50, 2, 8, 4.0, 16.0, 1)]


def test_bounded_rank_equals_window_rank(spark):
    df = spark.range(5000).select(
        F.col("id"), (F.floor(F.rand(7) * 300) / 100).alias("pct"))
    df = df.withColumn("pct", F.when(F.col("id") % 97 == 0, None).otherwise(F.col("pct")))
    got = rank_desc_bounded(df, "pct", "r").select("id", "r")
    want = df.select("id", F.rank().over(Window.orderBy(F.col("pct").desc_nulls_first())).cast("bigint").alias("r"))
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
