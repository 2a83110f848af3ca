"""Build the star schema from a store and write it (T1-T8 as one job chain).

Every build writes a fresh version folder and switches a pointer at the end:
readers see the old star or the new one, never facts of one with dimensions
of the other, and a build that dies leaves the old one in place.  Locations
known to the version before keep their keys.  ``dim_location`` is written and
read back before the fact table joins to it, so its keys are computed once;
the two finer-grain facts take their keys from the written fact table.  The
fact is partitioned by year and sorted by date key, as date windows ask for.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.operators import star as T
from crashlake.sources import store

STAR_TABLES = ("dim_date", "dim_borough", "dim_location", "dim_vehicle", "dim_factor",
               "fact_collisions", "fact_collision_vehicles", "fact_collision_factors")
POINTER = "_current"


def _write(df: DataFrame, path: str, key: str | None = None) -> DataFrame:
    (df.repartition(key) if key else df).write.mode("error").parquet(path)
    return df.sparkSession.read.parquet(path)


def current_version(spark: SparkSession, out: str) -> str | None:
    """Folder of the star that readers should use; None before the first build."""
    pointer = store.table_path(out, POINTER)
    return spark.read.text(pointer).first()[0] if store.path_exists(spark, pointer) else None


def read_star(spark: SparkSession, out: str) -> dict[str, DataFrame]:
    version = current_version(spark, out)
    if version is None:
        raise ValueError(f"no star schema under {out}")
    return {name: spark.read.parquet(f"{version}/{name}") for name in STAR_TABLES}


def build_star(spark: SparkSession, root: str, out: str) -> dict[str, str]:
    """Read the six tables at ``root`` and write the star schema under
    ``out``.  Returns table name -> path."""
    t = store.read_tables(spark, root)
    staged = T.stg_tables(t)
    before = current_version(spark, out)
    known = spark.read.parquet(f"{before}/dim_location") if before else None
    version = store.table_path(out, f"version-{uuid.uuid4().hex}")
    _write(T.dim_date(t.collisions), f"{version}/dim_date")
    _write(T.dim_borough(t), f"{version}/dim_borough")
    _write(T.dim_vehicle(t), f"{version}/dim_vehicle")
    _write(T.dim_factor(t), f"{version}/dim_factor")
    # the counts steer the fact's join and are no part of the dimension
    counted = _write(T.dim_location(staged.collisions, with_counts=True, existing=known), f"{version}/_locations", "location_key")
    _write(counted.drop("n_collisions"), f"{version}/dim_location")
    dated = T.fact_collisions(t, locations=counted).withColumn("date_year", F.floor(F.col("date_key") / 10000).cast("int"))
    path = f"{version}/fact_collisions"
    dated.repartitionByRange("date_key", "collision_id").sortWithinPartitions("date_key").write.partitionBy("date_year").parquet(path)
    fact = spark.read.parquet(path)
    _write(T.fact_collision_vehicles(t, fact), f"{version}/fact_collision_vehicles", "collision_id")
    _write(T.fact_collision_factors(t, fact), f"{version}/fact_collision_factors", "collision_id")
    store.remove(spark, f"{version}/_locations")
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("overwrite").text(store.table_path(out, POINTER))
    return {name: f"{version}/{name}" for name in STAR_TABLES}


def grain_ok(spark: SparkSession, root: str, out: str) -> bool:
    """The written fact table has one row per collision, and every collision
    has one (three numbers come back to the driver)."""
    fact = read_star(spark, out)["fact_collisions"]
    m = dict(tuple(r) for r in T.fact_grain_check(fact, store.read_tables(spark, root).collisions).collect())
    return m["duplicate_keys"] == 0 and m["fact_rows"] == m["collision_rows"]
