"""Collision-shaped tables derived from the driver's TPC-H-style parquet tables.

The reference ships no data, so the registered queries run on a deterministic
mapping of the driver tables (region, nation, customer, part, orders,
lineitem) onto the collision schema.  Every row of orders / lineitem appears
exactly once in the clean tables: the lines of an order are numbered, a
collision takes five of them (the feed has five slots), and further lines go
to further collisions of the same order.  Modulo tests on the keys only decide
which *values* a row gets (NULLs, dirty spellings, blank factors, duplicates),
never whether a row is kept.

Each column is one SQL expression understood by both Spark SQL and DuckDB, so
the oracle statements (plans/oracle.py) build the very same inputs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crashlake.operators.ids import extend_dimension
from crashlake.operators.lookup import lookup_ids
from crashlake.schema import FACTOR_COLUMNS, VEHICLE_COLUMNS
from crashlake.tables import CollisionTables

# --- clean tables (fx_*) ------------------------------------------------------

# region -> boroughs
BOROUGH_COLUMNS = (
    ("borough_id", "CAST(r_regionkey + 1 AS INT)"),
    ("borough_name", "r_name"),
)

# orders JOIN customer JOIN nation -> collisions.  e numbers an order's
# collisions from 0; ids of further ones lie beyond every order key.
ID_STRIDE = 2**40
COLLISION_ID = f"o_orderkey + e * {ID_STRIDE}"
COLLISION_COLUMNS = (
    ("collision_id", COLLISION_ID),
    ("crash_date", "CAST(o_orderdate AS DATE)"),
    ("crash_time", "CASE WHEN o_orderkey % 29 = 0 THEN CAST(NULL AS STRING) ELSE "
                   "concat(lpad(CAST(o_orderkey * 37 % 24 AS STRING), 2, '0'), ':', "
                   "lpad(CAST(o_orderkey * 53 % 60 AS STRING), 2, '0'), ':00') END"),
    ("borough_id", "CAST(CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE n_regionkey + 1 END AS INT)"),
    ("zip_code", "CASE WHEN o_orderkey % 13 = 0 THEN CAST(NULL AS STRING) "
                 "ELSE CAST(10000 + c_custkey % 60 AS STRING) END"),
    ("latitude", "CAST(CASE WHEN o_orderkey % 43 = 0 THEN NULL "
                 "ELSE 40.5 + (c_custkey % 50) * 0.001 END AS DECIMAL(9,6))"),
    ("longitude", "CAST(CASE WHEN o_orderkey % 43 = 0 THEN NULL "
                  "ELSE -74.0 + (c_custkey % 50) * 0.001 END AS DECIMAL(9,6))"),
    ("location", "CAST(NULL AS STRING)"),
    ("on_street_name", "CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS STRING) "
                       "ELSE concat(c_mktsegment, ' ST ', CAST(c_custkey % 7 AS STRING)) END"),
    ("off_street_name", "CAST(NULL AS STRING)"),
    ("cross_street_name", "CASE WHEN o_orderkey % 2 = 0 THEN CAST(NULL AS STRING) "
                          "ELSE concat('CROSS ', CAST(c_custkey % 5 AS STRING)) END"),
    ("number_of_persons_injured", "CAST(CASE WHEN o_orderkey % 23 = 0 THEN NULL ELSE o_orderkey * 7 % 5 END AS INT)"),
    ("number_of_persons_killed", "CAST(CASE WHEN o_orderkey % 31 = 0 THEN NULL "
                                 "WHEN o_orderkey * 13 % 41 = 0 THEN 1 "
                                 "WHEN o_orderkey * 13 % 83 = 0 THEN 2 ELSE 0 END AS INT)"),
    ("number_of_pedestrians_injured", "CAST(o_orderkey % 3 AS INT)"),
    ("number_of_pedestrians_killed", "CAST(CASE WHEN o_orderkey % 211 = 0 THEN 1 ELSE 0 END AS INT)"),
    ("number_of_cyclist_injured", "CAST(CASE WHEN o_orderkey % 7 = 6 THEN 1 ELSE 0 END AS INT)"),
    ("number_of_cyclist_killed", "CAST(CASE WHEN o_orderkey % 223 = 0 THEN 1 ELSE 0 END AS INT)"),
    ("number_of_motorist_injured", "CAST(o_orderkey % 4 AS INT)"),
    ("number_of_motorist_killed", "CAST(CASE WHEN o_orderkey % 227 = 0 THEN 1 ELSE 0 END AS INT)"),
)

# lineitem JOIN part.  An order's lines in the order of these columns have
# positions 0, 1, ...: slot = position % 5 + 1 of its collision position / 5.
LINE_ORDER = ("l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", "l_extendedprice")
LINE_PAYLOAD = ("p_partkey", "p_name", "p_brand", "p_type")
LINE_POSITION = f"row_number() OVER (PARTITION BY l_orderkey ORDER BY {', '.join(LINE_ORDER)}) - 1"
LINE_COLUMNS = (
    ("collision_id", f"l_orderkey + CAST(floor(position / 5) AS BIGINT) * {ID_STRIDE}"),
    ("slot", "CAST(position % 5 + 1 AS INT)"),
)

VEHICLE_DESC = "CASE WHEN p_partkey % 5 = 0 THEN p_brand ELSE p_type END"
FACTOR_DESC = "p_name"

# --- dirty wide feed (fx_raw) ---------------------------------------------------
# A row per collision above, plus a second copy of those of every order with
# k % 20 = 0 (c = 1).  Slots come from the lines above; some of their texts are
# blank or unspecified here, so that the load has something to drop.

RAW_COPIES = "CASE WHEN o_orderkey % 20 = 0 THEN array(0, 1) ELSE array(0) END"

RAW_COLUMNS = (
    ("src_seq", f"({COLLISION_ID}) * 2 + c"),
    ("collision_id", "CASE WHEN o_orderkey % 101 = 0 THEN 'n/a' "
                     f"WHEN o_orderkey % 103 = 0 THEN concat(CAST({COLLISION_ID} AS STRING), '.0') "
                     f"WHEN o_orderkey % 107 = 0 THEN concat(CAST({COLLISION_ID} AS STRING), '.7') "
                     f"WHEN o_orderkey % 109 = 0 THEN concat(CAST({COLLISION_ID} AS STRING), 'd') "
                     "WHEN o_orderkey % 113 = 0 THEN '0x1p3' "
                     f"ELSE CAST({COLLISION_ID} AS STRING) END"),
    ("crash_date", "CASE WHEN o_orderkey % 37 = 0 THEN '02/30/1997' "
                   "WHEN c = 1 THEN '01/01/2000' "
                   "WHEN o_orderkey % 5 = 1 THEN concat(CAST(month(o_orderdate) AS STRING), '/', "
                   "CAST(day(o_orderdate) AS STRING), '/', CAST(year(o_orderdate) AS STRING)) "
                   "WHEN o_orderkey % 5 = 2 THEN concat(CAST(CAST(o_orderdate AS DATE) AS STRING), 'T00:00:00.000') "
                   "ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END"),
    ("crash_time", "CASE WHEN o_orderkey % 29 = 0 THEN 'zz' "
                   "WHEN o_orderkey % 7 = 3 THEN concat(CAST(o_orderkey * 37 % 24 AS STRING), ':', "
                   "lpad(CAST(o_orderkey * 53 % 60 AS STRING), 2, '0'), ':', "
                   "lpad(CAST(o_orderkey % 60 AS STRING), 2, '0')) "
                   "ELSE concat(CAST(o_orderkey * 37 % 24 AS STRING), ':', "
                   "lpad(CAST(o_orderkey * 53 % 60 AS STRING), 2, '0')) END"),
    ("borough", "CASE WHEN o_orderkey % 11 = 0 THEN CAST(NULL AS STRING) "
                "WHEN o_orderkey % 19 = 0 THEN '  ' "
                "WHEN o_orderkey % 47 = 0 THEN 'None' "
                "WHEN o_orderkey % 3 = 0 THEN concat(' ', r_name, '\t') "
                "ELSE r_name END"),
    ("zip_code", "CASE WHEN o_orderkey % 13 = 0 THEN 'NA' "
                 "WHEN o_orderkey % 5 = 0 THEN concat(CAST(10000 + c_custkey % 60 AS STRING), '.0') "
                 "ELSE CAST(10000 + c_custkey % 60 AS STRING) END"),
    ("latitude", "CASE WHEN o_orderkey % 43 = 0 THEN 'NaN' "
                 "WHEN o_orderkey % 59 = 0 THEN '1234.5' "
                 "ELSE CAST(40.5 + (c_custkey % 50) * 0.001 + (o_orderkey % 10) * 0.000001 AS STRING) END"),
    ("longitude", "CASE WHEN o_orderkey % 43 = 0 THEN CAST(NULL AS STRING) "
                  "WHEN o_orderkey % 61 = 0 THEN 'abc' "
                  "ELSE CAST(-74.0 + (c_custkey % 50) * 0.001 AS STRING) END"),
    ("location", "CAST(NULL AS STRING)"),
    ("on_street_name", "CASE WHEN o_orderkey % 17 = 0 THEN CAST(NULL AS STRING) "
                       "ELSE concat(c_mktsegment, ' ST ', CAST(c_custkey % 7 AS STRING)) END"),
    ("cross_street_name", "CASE WHEN o_orderkey % 2 = 0 THEN CAST(NULL AS STRING) "
                          "ELSE concat('CROSS ', CAST(c_custkey % 5 AS STRING)) END"),
    ("off_street_name", "CASE WHEN o_orderkey % 9 = 0 THEN 'null' ELSE CAST(NULL AS STRING) END"),
    ("number_of_persons_injured", "CASE WHEN o_orderkey % 23 = 0 THEN CAST(NULL AS STRING) "
                                  "WHEN o_orderkey % 97 = 0 THEN '-1' "
                                  "WHEN o_orderkey % 89 = 0 THEN '3.7f' "
                                  "WHEN o_orderkey % 6 = 1 THEN concat(CAST(o_orderkey * 7 % 5 AS STRING), '.0') "
                                  "ELSE CAST(o_orderkey * 7 % 5 AS STRING) END"),
    ("number_of_persons_killed", "CASE WHEN o_orderkey % 31 = 0 THEN 'N/A' "
                                 "WHEN o_orderkey * 13 % 41 = 0 THEN '1' "
                                 "WHEN o_orderkey * 13 % 83 = 0 THEN '2' ELSE '0' END"),
    ("number_of_pedestrians_injured", "CAST(o_orderkey % 3 AS STRING)"),
    ("number_of_pedestrians_killed", "CASE WHEN o_orderkey % 211 = 0 THEN '1' ELSE '0' END"),
    ("number_of_cyclist_injured", "CASE WHEN o_orderkey % 7 = 6 THEN '1' ELSE '0' END"),
    ("number_of_cyclist_killed", "CASE WHEN o_orderkey % 223 = 0 THEN '1' ELSE '0' END"),
    ("number_of_motorist_injured", "CAST(o_orderkey % 4 AS STRING)"),
    ("number_of_motorist_killed", "CASE WHEN o_orderkey % 227 = 0 THEN '1' ELSE '0' END"),
)


def _vehicle_text(p: str) -> str:
    return (f"CASE WHEN {p}_partkey IS NULL THEN CAST(NULL AS STRING) "
            f"WHEN {p}_partkey % 5 = 0 THEN {p}_brand "
            f"WHEN {p}_partkey % 7 = 0 THEN '   ' "
            f"ELSE concat(' ', {p}_type, ' ') END")


def _factor_text(p: str) -> str:
    return (f"CASE WHEN {p}_partkey IS NULL THEN CAST(NULL AS STRING) "
            f"WHEN {p}_partkey % 9 = 0 THEN 'Unspecified' "
            f"WHEN {p}_partkey % 10 = 0 THEN ' UNSPECIFIED ' "
            f"WHEN {p}_partkey % 11 = 0 THEN '' "
            f"WHEN {p}_name LIKE 'blue%' THEN 'unspecified' "
            f"ELSE concat({p}_name, ' ') END")


def raw_vehicle_value(slot: int) -> str:
    """Dirty vehicle text for one slot, from that slot's part columns."""
    return _blank_first_slot(slot, _vehicle_text(f"s{slot}"))


def raw_factor_value(slot: int) -> str:
    """Dirty factor text for one slot."""
    return _blank_first_slot(slot, _factor_text(f"s{slot}"))


def _blank_first_slot(slot: int, value: str) -> str:
    # Slot 1 of the first copy is blank for even keys, so a duplicate row fills it.
    if slot != 1:
        return value
    return f"CASE WHEN c = 0 AND o_orderkey % 2 = 0 THEN CAST(NULL AS STRING) ELSE {value} END"


def raw_slot_columns():
    cols = [(VEHICLE_COLUMNS[i - 1], raw_vehicle_value(i)) for i in range(1, 6)]
    cols += [(FACTOR_COLUMNS[i - 1], raw_factor_value(i)) for i in range(1, 6)]
    return tuple(cols)


SLOT_PIVOT = tuple(
    (f"s{i}_{c}", f"min(CASE WHEN slot = {i} THEN p_{c} END)")
    for i in range(1, 6) for c in ("partkey", "name", "brand", "type")
)


# --- Spark builders ---------------------------------------------------------------


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _select(df: DataFrame, columns) -> DataFrame:
    return df.select(*[F.expr(sql).alias(name) for name, sql in columns])


def fx_boroughs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_read(spark, sf_dir, "region"), BOROUGH_COLUMNS)


def _orders_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = _read(spark, sf_dir, "orders")
    customer = _read(spark, sf_dir, "customer")
    nation = _read(spark, sf_dir, "nation")
    # customers grow with the data: a compressed file's size must not have them sent to the driver
    return (orders.join(customer.hint("merge"), orders.o_custkey == customer.c_custkey)
            .join(nation, customer.c_nationkey == nation.n_nationkey))


def _collisions_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per collision: each order ``e = 0 ..`` as often as its lines fill five slots, at least once."""
    lines = _read(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    orders = _orders_wide(spark, sf_dir)
    last = F.expr("greatest(CAST(ceil(coalesce(n, 0) / 5) AS BIGINT), 1) - 1")
    return (orders.join(lines, orders.o_orderkey == lines.l_orderkey, "left")
            .withColumn("e", F.explode(F.sequence(F.lit(0).cast("bigint"), last))))


def fx_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(_collisions_wide(spark, sf_dir), COLLISION_COLUMNS)


def _line_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lineitem = _read(spark, sf_dir, "lineitem")
    part = _read(spark, sf_dir, "part")
    # parts grow with the data, as customers do
    return lineitem.join(part.hint("merge"), lineitem.l_partkey == part.p_partkey)


def fx_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(collision_id, slot, p_partkey, p_name, p_brand, p_type), one row per line."""
    placed = _line_parts(spark, sf_dir).withColumn("position", F.expr(LINE_POSITION))
    return placed.select(*[F.expr(sql).alias(name) for name, sql in LINE_COLUMNS], *LINE_PAYLOAD)


def fx_vehicles(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = lines if lines is not None else fx_lines(spark, sf_dir)
    return lines.select("collision_id", F.col("slot").alias("vehicle_order"),
                        F.expr(VEHICLE_DESC).alias("vehicle_type_desc"))


def fx_factors(spark: SparkSession, sf_dir: str, lines: DataFrame | None = None) -> DataFrame:
    lines = lines if lines is not None else fx_lines(spark, sf_dir)
    return lines.select(
        "collision_id", F.col("slot").alias("factor_order"), F.expr(FACTOR_DESC).alias("factor_desc"))


def fixture_tables(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], DataFrame] | None = None) -> CollisionTables:
    """The six normalised tables; dimension ids come from the get-or-create
    operator (ids are never compared, only the names they lead back to).
    ``write`` (a frame and a label) stages what several tables are made of."""
    write = write or (lambda df, label: df)
    lines = write(fx_lines(spark, sf_dir), "lines")
    vehicles = fx_vehicles(spark, sf_dir, lines)
    factors = fx_factors(spark, sf_dir, lines)
    vehicle_types = write(extend_dimension(None, vehicles, "vehicle_type_desc", "vehicle_type_id"), "vehicle-types")
    factor_dim = write(extend_dimension(None, factors, "factor_desc", "factor_id"), "factors")
    return CollisionTables(
        boroughs=fx_boroughs(spark, sf_dir),
        collisions=fx_collisions(spark, sf_dir),
        vehicle_types=vehicle_types,
        collision_vehicles=lookup_ids(vehicles, vehicle_types, "vehicle_type_desc", "vehicle_type_id",
                                      ["collision_id", "vehicle_order"])
        .select("collision_id", "vehicle_order", "vehicle_type_id"),
        factors=factor_dim,
        collision_factors=lookup_ids(factors, factor_dim, "factor_desc", "factor_id",
                                     ["collision_id", "factor_order"])
        .select("collision_id", "factor_order", "factor_id"),
    )


def _raw_slots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(collision_id, v1 .. v5, f1 .. f5): a row per collision with lines.  Its
    five lines follow each other in their order's window, which is read once."""
    lines = _line_parts(spark, sf_dir).select(
        "l_orderkey", *LINE_ORDER, F.expr(_vehicle_text("p")).alias("v1"), F.expr(_factor_text("p")).alias("f1"))
    window = Window.partitionBy("l_orderkey").orderBy(*LINE_ORDER)
    behind = {f"s{i}": F.lead(F.struct("v1", "f1"), i - 1).over(window) for i in range(2, 6)}
    placed = lines.withColumns({"position": F.expr(LINE_POSITION), **behind}).filter("position % 5 = 0")
    name, sql = LINE_COLUMNS[0]
    texts = [F.col(f"s{i}.{t}1").alias(f"{t}{i}") for i in range(2, 6) for t in "vf"]
    return placed.select(F.expr(sql).alias(name), "v1", "f1", *texts)


def fx_raw(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The dirty wide feed: all strings plus ``src_seq`` (file order).  ``write`` (a
    frame and a label) stages the slots, so that lines and orders are not shuffled at once."""
    slots = _raw_slots(spark, sf_dir)
    slots = write(slots, "slots") if write else slots
    region = _read(spark, sf_dir, "region")
    wide = _collisions_wide(spark, sf_dir).join(region, F.col("n_regionkey") == region.r_regionkey)
    wide = wide.join(slots, F.expr(COLLISION_ID) == slots.collision_id, "left").drop("collision_id")
    wide = wide.withColumn("c", F.explode(F.expr(RAW_COPIES)))
    texts = [(c, _blank_first_slot(i, f"{t}{i}")) for t, columns in (("v", VEHICLE_COLUMNS), ("f", FACTOR_COLUMNS))
             for i, c in enumerate(columns, start=1)]
    return _select(wide, (*RAW_COLUMNS, *texts))
