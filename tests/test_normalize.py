import datetime as dt

from crashlake.operators import normalize as N
from helpers import base_row, feed, rows


def test_first_row_wins_but_blank_slot_is_filled(spark):
    f = N.clean_feed(feed(spark, [
        base_row("5", crash_date="2023-01-01", vehicle_type_code1=None, vehicle_type_code2="Bus"),
        base_row("5", crash_date="2023-06-01", vehicle_type_code1="Sedan", vehicle_type_code2="Taxi"),
    ]))
    res = N.normalize_feed(f)
    c = res.new.collisions.collect()
    assert len(c) == 1 and c[0].crash_date == dt.date(2023, 1, 1)
    v = rows(N.vehicles_long(f), "vehicle_order")
    assert v == [(5, 1, "Sedan"), (5, 2, "Bus")]
    # the losing value still becomes a type, as get-or-create runs before the skipped insert
    types = {r.vehicle_type_desc for r in res.dims.vehicle_types.collect()}
    assert types == {"Sedan", "Bus", "Taxi"}


def test_factor_unspecified_and_vehicle_case(spark):
    f = N.clean_feed(feed(spark, [
        base_row("1", contributing_factor_vehicle_1="Unspecified",
                 contributing_factor_vehicle_2=" UNSPECIFIED ",
                 contributing_factor_vehicle_3="unspecified", contributing_factor_vehicle_4="  ",
                 contributing_factor_vehicle_5="Driver Inattention",
                 vehicle_type_code1="Unspecified", vehicle_type_code2="Sedan", vehicle_type_code_3="SEDAN"),
    ]))
    assert rows(N.factors_long(f)) == [(1, 5, "Driver Inattention")]
    assert rows(N.vehicles_long(f), "vehicle_order") == [(1, 1, "Unspecified"), (1, 2, "Sedan"), (1, 3, "SEDAN")]


def test_borough_lookup_trims_both_sides(spark):
    f = N.clean_feed(feed(spark, [
        base_row("1", borough=" BRONX "), base_row("2", borough="  "), base_row("3", borough=""),
        base_row("4", borough="None"), base_row("5", borough="BRONX"),
    ]))
    res = N.normalize_feed(f)
    assert rows(res.dims.boroughs.select("borough_name")) == [("BRONX",)]
    got = dict(rows(res.new.collisions.select("collision_id", "borough_id")))
    assert got[1] == got[5] == 1 and got[2] is None and got[3] is None and got[4] is None


def test_quarantine_and_fail_modes(spark):
    f = N.clean_feed(feed(spark, [
        base_row("1", number_of_persons_injured="-1", vehicle_type_code1="Sedan"),
        base_row("2", vehicle_type_code1="Bus"),
    ]))
    res = N.normalize_feed(f)
    assert rows(res.new.collisions.select("collision_id")) == [(2,)]
    assert rows(res.new.collision_vehicles.select("collision_id")) == [(2,)]
    assert rows(res.rejects) == [(1, "number_of_persons_injured_negative")]
    try:
        N.normalize_feed(f, mode="fail")
    except ValueError as e:
        assert "number_of_persons_injured_negative" in str(e)
    else:
        raise AssertionError("fail mode should raise")


def test_existing_rows_win_and_ids_continue(spark):
    first = N.normalize_feed(N.clean_feed(feed(spark, [base_row("1", vehicle_type_code1="Sedan")])))
    existing = first.dims
    second = N.normalize_feed(N.clean_feed(feed(spark, [
        base_row("1", crash_date="2024-01-01", vehicle_type_code1="Bus"),
        base_row("2", vehicle_type_code1="Sedan", vehicle_type_code2="Bus", borough="QUEENS"),
    ])), existing)
    assert rows(second.new.collisions.select("collision_id")) == [(2,)]
    assert rows(second.new.vehicle_types) == [(2, "Bus")]
    assert rows(second.new.boroughs) == [(2, "QUEENS")]
    assert rows(second.new.collision_vehicles, "vehicle_order") == [(2, 1, 1), (2, 2, 2)]
