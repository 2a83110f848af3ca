"""Hand-built inputs for unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

from crashlake import schema as S
from crashlake.tables import CollisionTables


def feed(spark, rows: list[dict]):
    """Wide feed rows (strings) in the given order; ``_order`` = position."""
    data = [tuple(r.get(c) for c in S.FEED_COLUMNS) + (i,) for i, r in enumerate(rows)]
    schema = T.StructType(S.FEED_SCHEMA.fields + [T.StructField("_order", T.LongType())])
    return spark.createDataFrame(data, schema)


def base_row(cid, **kw) -> dict:
    row = {"collision_id": str(cid), "crash_date": "2023-01-15", "crash_time": "10:30",
           "borough": "BRONX", "zip_code": "10451", "latitude": "40.8", "longitude": "-73.9",
           "on_street_name": "MAIN ST", **{c: "0" for c in S.COUNT_COLUMNS}}
    row.update(kw)
    return row


def tables(spark, boroughs=(), collisions=(), vehicle_types=(), vehicles=(), factors=(), factor_rows=()):
    """CollisionTables from tuples in table column order (collision dicts may
    omit columns; dates given as ISO text)."""
    cols = [f.name for f in S.COLLISIONS.fields]
    crows = []
    for c in collisions:
        r = dict(c)
        if isinstance(r.get("crash_date"), str):
            r["crash_date"] = dt.date.fromisoformat(r["crash_date"])
        crows.append(tuple(r.get(k) for k in cols))
    return CollisionTables(
        boroughs=spark.createDataFrame(list(boroughs), S.BOROUGHS),
        collisions=spark.createDataFrame(crows, S.COLLISIONS),
        vehicle_types=spark.createDataFrame(list(vehicle_types), S.VEHICLE_TYPES),
        collision_vehicles=spark.createDataFrame(list(vehicles), S.COLLISION_VEHICLES),
        factors=spark.createDataFrame(list(factors), S.FACTORS),
        collision_factors=spark.createDataFrame(list(factor_rows), S.COLLISION_FACTORS),
    )


def rows(df, *order):
    df = df.orderBy(*order) if order else df
    return [tuple(r) for r in df.collect()]
