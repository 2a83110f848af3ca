"""Dashboard queries D1-D9 and the parameterised SQL entry point.

Date ranges are inclusive at both ends; the borough parameter is a name or
the 'All' sentinel.  Every function returns a lazy DataFrame; only the caller
collects (the results are small: one row, one row per day, per borough, or a
top-N)."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.operators.filters import borough_rows, date_range, to_date
from crashlake.schema import (
    ALL_BOROUGHS, DEFAULT_WINDOW_DAYS, LATEST_LIMIT, TOP_FACTORS_DEFAULT, TOP_FACTORS_MAX,
    TOP_FACTORS_MIN, TREND_METRICS, UNKNOWN_BOROUGH,
)
from crashlake.tables import CollisionTables


def _filtered(t: CollisionTables, start, end, borough: str) -> DataFrame:
    return borough_rows(date_range(t.collisions, start, end), t.boroughs, borough)


def _sum0(col: str, alias: str):
    return F.coalesce(F.sum(col), F.lit(0)).cast("bigint").alias(alias)


def kpi_summary(t: CollisionTables, start, end, borough: str = ALL_BOROUGHS) -> DataFrame:
    """One row of totals; zeros (not NULLs) on an empty range."""
    return _filtered(t, start, end, borough).agg(
        F.count(F.lit(1)).alias("total_crashes"),
        _sum0("number_of_persons_injured", "total_injured"),
        _sum0("number_of_persons_killed", "total_killed"),
    )


def daily_trend(t: CollisionTables, start, end, borough: str = ALL_BOROUGHS) -> DataFrame:
    """Per day with crashes, the crash count and five casualty sums."""
    return (
        _filtered(t, start, end, borough)
        .groupBy(F.col("crash_date").alias("day"))
        .agg(
            F.count(F.lit(1)).alias("crashes"),
            _sum0("number_of_persons_injured", "persons_injured"),
            _sum0("number_of_persons_killed", "persons_killed"),
            _sum0("number_of_pedestrians_injured", "pedestrians_injured"),
            _sum0("number_of_cyclist_injured", "cyclists_injured"),
            _sum0("number_of_motorist_injured", "motorists_injured"),
        )
        .orderBy("day")
    )


def trend_metric(t: CollisionTables, start, end, borough: str, metric: str) -> DataFrame:
    """D3: (day, value) for one named metric of D2.  The other sums are
    pruned from the aggregate by the optimizer."""
    if metric not in TREND_METRICS:
        raise ValueError(f"unknown trend metric {metric!r}; one of {sorted(TREND_METRICS)}")
    return daily_trend(t, start, end, borough).select(
        "day", F.col(TREND_METRICS[metric]).alias("value")
    )


def crashes_by_borough(t: CollisionTables, start, end) -> DataFrame:
    """Crashes per named borough, most first.  Ignores the borough
    parameter; collisions without a (known) borough and a borough literally
    named UNKNOWN are left out.  Counting by id before the join means only
    one row per borough ever meets the dimension."""
    per_id = date_range(t.collisions, start, end).groupBy("borough_id").agg(
        F.count(F.lit(1)).alias("crashes"))
    return (
        per_id.join(t.boroughs, "borough_id")
        .filter(F.col("borough_name") != F.lit(UNKNOWN_BOROUGH))
        .select(F.col("borough_name").alias("borough"), "crashes")
        .orderBy(F.col("crashes").desc_nulls_first(), F.col("borough").asc_nulls_last())
    )


def top_factors(t: CollisionTables, start, end, borough: str = ALL_BOROUGHS,
                top_n: int = TOP_FACTORS_DEFAULT) -> DataFrame:
    """The top-N factors by occurrences in the window (N in 5..20).
    Ties on the count are broken by factor name so the cut is stable."""
    if not TOP_FACTORS_MIN <= int(top_n) <= TOP_FACTORS_MAX:
        raise ValueError(f"top_n must be in {TOP_FACTORS_MIN}..{TOP_FACTORS_MAX}, got {top_n}")
    in_window = _filtered(t, start, end, borough).select("collision_id")
    per_factor = (
        t.collision_factors.select("collision_id", "factor_id")
        .join(in_window, "collision_id", "left_semi")  # collision ids are unique
        .groupBy("factor_id")
        .agg(F.count(F.lit(1)).alias("crashes"))
    )
    return (
        per_factor.join(t.factors, "factor_id")
        .select(F.col("factor_desc").alias("factor"), "crashes")
        .orderBy(F.col("crashes").desc_nulls_first(), F.col("factor").asc_nulls_last())
        .limit(int(top_n))
    )


DETAIL_COLUMNS = (
    "collision_id", "crash_date", "crash_time", "borough", "zip_code", "on_street_name",
    "cross_street_name", "off_street_name", "number_of_persons_injured",
    "number_of_persons_killed", "number_of_pedestrians_injured", "number_of_cyclist_injured",
    "number_of_motorist_injured",
)


def latest_collisions(t: CollisionTables, start, end, borough: str = ALL_BOROUGHS,
                      limit: int = LATEST_LIMIT) -> DataFrame:
    """Newest collisions (date desc, time desc, NULL first; id desc as
    the tie-break).  Planned as a top-k on the collisions alone - each
    partition keeps its own best ``limit`` rows before the final merge - and
    only those rows are joined to the borough names."""
    order = [F.col("crash_date").desc_nulls_first(), F.col("crash_time").desc_nulls_first(),
             F.col("collision_id").desc_nulls_first()]
    top = _filtered(t, start, end, borough).orderBy(*order).limit(int(limit))
    return (
        top.join(t.boroughs, "borough_id", "left")
        .withColumnRenamed("borough_name", "borough")
        .select(*DETAIL_COLUMNS)
        .orderBy(*order)
    )


def date_bounds(t: CollisionTables) -> DataFrame:
    """Min and max crash date (one global aggregate, partial per task)."""
    return t.collisions.agg(F.min("crash_date").alias("min_date"), F.max("crash_date").alias("max_date"))


def borough_list(t: CollisionTables) -> DataFrame:
    """D8: 'All' followed by the borough names in order."""
    spark = t.boroughs.sparkSession
    sentinel = spark.range(1).select(F.lit(ALL_BOROUGHS).alias("borough"), F.lit(0).alias("_grp"))
    names = t.boroughs.select(F.col("borough_name").alias("borough"), F.lit(1).alias("_grp"))
    return sentinel.unionByName(names).orderBy("_grp", F.col("borough").asc_nulls_last()).drop("_grp")


def default_window(t: CollisionTables, end: str | dt.date | None = None,
                   days: int = DEFAULT_WINDOW_DAYS, start: str | dt.date | None = None) -> DataFrame:
    """The dashboard's range.  end defaults to the last crash date, start
    to the later of the first crash date and end - days.  A chosen end outside
    the data, or a chosen start outside first date .. end, is an error
    (raised when the row is computed)."""
    b = date_bounds(t)
    end_col = F.col("max_date") if end is None else F.lit(to_date(end))
    in_range = (end_col >= F.col("min_date")) & (end_col <= F.col("max_date"))
    checked_end = F.when(in_range, end_col).otherwise(
        F.raise_error(F.lit("end date outside the data range")).cast("date"))
    default_start = F.greatest(F.col("min_date"), F.date_sub(checked_end, days))
    chosen = F.lit(to_date(start)) if start is not None else default_start
    checked_start = chosen if start is None else F.when((chosen >= F.col("min_date")) & (chosen <= checked_end), chosen).otherwise(
        F.raise_error(F.lit("start date outside first date .. end date")).cast("date"))
    return b.select(
        "min_date", "max_date", checked_start.alias("start_date"),
        checked_end.alias("end_date"),
    )


def run_sql(spark: SparkSession, t: CollisionTables, sql: str, params: dict | None = None) -> DataFrame:
    """A named-parameter query over the six tables (``:name`` markers).

    The tables are named in a WITH clause around the query, over views that are
    dropped once it is analysed: the caller's own views, also of these names,
    stay as they are, and the query sees its other ones."""
    views = {name: f"crashlake_{uuid.uuid4().hex}" for name, _ in t.items()}
    for name, df in t.items():
        df.createOrReplaceTempView(views[name])
    named = ", ".join(f"{name} AS (SELECT * FROM {view})" for name, view in views.items())
    try:
        return spark.sql(f"WITH {named} (\n{sql.strip().rstrip(';')}\n)", args=params or {})
    finally:
        for view in views.values():
            spark.catalog.dropTempView(view)
