"""Table contracts and fixed vocabularies.

Every normalised table has an explicit StructType; nothing is inferred.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values (must equal the reference's behaviour) -------------------

# NA tokens the reference's CSV reader turns into missing values (the public
# pandas.read_csv default list), plus the empty string.
NA_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
)

# Factor values that mean "no factor"; compared case-insensitively after trim.
UNSPECIFIED_FACTOR = "UNSPECIFIED"

# Sentinel borough parameter meaning "no borough filter".
ALL_BOROUGHS = "All"

# Label the by-borough query gives to collisions without a borough.
UNKNOWN_BOROUGH = "UNKNOWN"

# Trend metric labels -> column of the daily trend result.
TREND_METRICS = {
    "Crashes": "crashes",
    "Persons Injured": "persons_injured",
    "Persons Killed": "persons_killed",
    "Pedestrians Injured": "pedestrians_injured",
    "Cyclists Injured": "cyclists_injured",
    "Motorists Injured": "motorists_injured",
}

# Minimum occurrences before a factor / vehicle type is ranked.
MIN_RANKED_OCCURRENCES = 50

# Top-N slider bounds and default for the top-factors query.
TOP_FACTORS_MIN, TOP_FACTORS_MAX, TOP_FACTORS_DEFAULT = 5, 20, 10

# Rows in the latest-collisions table.
LATEST_LIMIT = 500

# Default look-back of the dashboard window, in days.
DEFAULT_WINDOW_DAYS = 30

# Slots per collision in the wide feed.
SLOTS = 5

# Wide-feed column names for the vehicle and factor slots (slots 1-2 of the
# vehicle columns have no underscore before the digit).
VEHICLE_COLUMNS = (
    "vehicle_type_code1", "vehicle_type_code2", "vehicle_type_code_3",
    "vehicle_type_code_4", "vehicle_type_code_5",
)
FACTOR_COLUMNS = (
    "contributing_factor_vehicle_1", "contributing_factor_vehicle_2",
    "contributing_factor_vehicle_3", "contributing_factor_vehicle_4",
    "contributing_factor_vehicle_5",
)

# Casualty count columns, in table order.
COUNT_COLUMNS = (
    "number_of_persons_injured", "number_of_persons_killed",
    "number_of_pedestrians_injured", "number_of_pedestrians_killed",
    "number_of_cyclist_injured", "number_of_cyclist_killed",
    "number_of_motorist_injured", "number_of_motorist_killed",
)

# Text length limits from the table definitions.
BOROUGH_NAME_MAX = 50
ZIP_CODE_MAX = 10

# numeric(9,6): |value| < 10^3.
COORD_PRECISION, COORD_SCALE = 9, 6

# --- wide feed -------------------------------------------------------------

FEED_COLUMNS = (
    "crash_date", "crash_time", "borough", "zip_code", "latitude", "longitude",
    "location", "on_street_name", "cross_street_name", "off_street_name",
    *COUNT_COLUMNS, "collision_id", *FACTOR_COLUMNS, *VEHICLE_COLUMNS,
)

FEED_SCHEMA = T.StructType([T.StructField(c, T.StringType(), True) for c in FEED_COLUMNS])

# --- normalised tables ------------------------------------------------------

BOROUGHS = T.StructType([
    T.StructField("borough_id", T.IntegerType(), False),
    T.StructField("borough_name", T.StringType(), False),
])

COLLISIONS = T.StructType([
    T.StructField("collision_id", T.LongType(), False),
    T.StructField("crash_date", T.DateType(), True),
    T.StructField("crash_time", T.StringType(), True),  # HH:mm:ss text
    T.StructField("borough_id", T.IntegerType(), True),
    T.StructField("zip_code", T.StringType(), True),
    T.StructField("latitude", T.DecimalType(COORD_PRECISION, COORD_SCALE), True),
    T.StructField("longitude", T.DecimalType(COORD_PRECISION, COORD_SCALE), True),
    T.StructField("location", T.StringType(), True),
    T.StructField("on_street_name", T.StringType(), True),
    T.StructField("off_street_name", T.StringType(), True),
    T.StructField("cross_street_name", T.StringType(), True),
    *[T.StructField(c, T.IntegerType(), True) for c in COUNT_COLUMNS],
])

VEHICLE_TYPES = T.StructType([
    T.StructField("vehicle_type_id", T.IntegerType(), False),
    T.StructField("vehicle_type_desc", T.StringType(), False),
])

COLLISION_VEHICLES = T.StructType([
    T.StructField("collision_id", T.LongType(), False),
    T.StructField("vehicle_order", T.IntegerType(), False),
    T.StructField("vehicle_type_id", T.IntegerType(), False),
])

FACTORS = T.StructType([
    T.StructField("factor_id", T.IntegerType(), False),
    T.StructField("factor_desc", T.StringType(), False),
])

COLLISION_FACTORS = T.StructType([
    T.StructField("collision_id", T.LongType(), False),
    T.StructField("factor_order", T.IntegerType(), False),
    T.StructField("factor_id", T.IntegerType(), False),
])

TABLES = {
    "boroughs": BOROUGHS,
    "collisions": COLLISIONS,
    "vehicle_types": VEHICLE_TYPES,
    "collision_vehicles": COLLISION_VEHICLES,
    "factors": FACTORS,
    "collision_factors": COLLISION_FACTORS,
}

# Parents before children: the order tables are written in.
LOAD_ORDER = ("boroughs", "vehicle_types", "factors", "collisions",
              "collision_vehicles", "collision_factors")

# Default half-open range of the street ranking (fixed values).
RANKING_FROM, RANKING_TO = "2023-01-01", "2025-01-01"
