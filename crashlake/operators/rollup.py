"""Crashes and casualties by day and borough: D1-D4 without the collisions.

A rollup row holds a day, a borough id (or null) and additive figures, so rollups
of disjoint sets of collisions are merged by adding; the dashboard's sums over any
window and borough are sums of its rows. Collisions without a date lie in no
window and are left out. Results equal those of operators.dashboard."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlake.operators.filters import borough_rows, date_range
from crashlake.schema import ALL_BOROUGHS, TREND_METRICS, UNKNOWN_BOROUGH

#: Figures of a rollup row: name -> column of the collisions.
SUMS = {
    "persons_injured": "number_of_persons_injured",
    "persons_killed": "number_of_persons_killed",
    "pedestrians_injured": "number_of_pedestrians_injured",
    "cyclists_injured": "number_of_cyclist_injured",
    "motorists_injured": "number_of_motorist_injured",
}


def daily_rollup(collisions: DataFrame, *keys: str) -> DataFrame:
    """One row per (``keys``, day, borough) with crashes and casualties."""
    figures = [F.coalesce(F.sum(c), F.lit(0)).cast("bigint").alias(name) for name, c in SUMS.items()]
    return collisions.filter("crash_date IS NOT NULL").groupBy(*keys, "crash_date", "borough_id").agg(F.count(F.lit(1)).alias("crashes"), *figures)


def _total(column: str, alias: str):
    return F.coalesce(F.sum(column), F.lit(0)).cast("bigint").alias(alias)


def _window(rollup: DataFrame, boroughs: DataFrame, start, end, borough: str) -> DataFrame:
    return borough_rows(date_range(rollup, start, end), boroughs, borough)


def kpi_summary(rollup: DataFrame, boroughs: DataFrame, start, end, borough: str = ALL_BOROUGHS) -> DataFrame:
    """D1 from a rollup."""
    return _window(rollup, boroughs, start, end, borough).agg(
        _total("crashes", "total_crashes"), _total("persons_injured", "total_injured"), _total("persons_killed", "total_killed"))


def daily_trend(rollup: DataFrame, boroughs: DataFrame, start, end, borough: str = ALL_BOROUGHS) -> DataFrame:
    """D2 from a rollup."""
    rows = _window(rollup, boroughs, start, end, borough).groupBy(F.col("crash_date").alias("day"))
    return rows.agg(*[_total(c, c) for c in ("crashes", *SUMS)]).orderBy("day")


def trend_metric(rollup: DataFrame, boroughs: DataFrame, start, end, borough: str, metric: str) -> DataFrame:
    """D3 from a rollup."""
    if metric not in TREND_METRICS:
        raise ValueError(f"unknown trend metric {metric!r}; one of {sorted(TREND_METRICS)}")
    return daily_trend(rollup, boroughs, start, end, borough).select("day", F.col(TREND_METRICS[metric]).alias("value"))


def crashes_by_borough(rollup: DataFrame, boroughs: DataFrame, start, end) -> DataFrame:
    """D4 from a rollup."""
    per_id = date_range(rollup, start, end).groupBy("borough_id").agg(_total("crashes", "crashes"))
    named = per_id.join(boroughs, "borough_id").filter(F.col("borough_name") != F.lit(UNKNOWN_BOROUGH))
    return named.select(F.col("borough_name").alias("borough"), "crashes").orderBy(F.col("crashes").desc_nulls_first(), F.col("borough").asc_nulls_last())
