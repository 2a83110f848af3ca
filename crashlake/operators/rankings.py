"""Ranking queries Q1-Q3.

Ordering follows the reference database: NULL sorts as the largest value, so
every DESC key is ``desc_nulls_first`` and every ASC key ``asc_nulls_last``.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from crashlake.functions.numeric import pct_half_up
from crashlake.operators.filters import date_range
from crashlake.operators.rank import rank_desc_bounded
from crashlake.schema import MIN_RANKED_OCCURRENCES
from crashlake.tables import CollisionTables


def street_severity_rank(
    t: CollisionTables, date_from: str | dt.date, date_to: str | dt.date, k: int = 10
) -> DataFrame:
    """Q1: per borough, streets ranked by injured + killed over [from, to).

    RANK keeps ties, so a borough can return more than k rows; the NULL
    borough is a partition of its own.  The rank filter becomes a
    WindowGroupLimit that already trims each map partition to its top k per
    borough before the shuffle, so a borough holding most of the rows does
    not bring all its streets into one task."""
    c = date_range(t.collisions, date_from, date_to, end_inclusive=False).filter(
        F.col("on_street_name").isNotNull()
    )
    c = c.join(t.boroughs, "borough_id", "left")
    per_street = c.groupBy("borough_name", "on_street_name").agg(
        F.count(F.lit(1)).alias("total_collisions"),
        F.sum(F.col("number_of_persons_injured") + F.col("number_of_persons_killed"))
        .cast("bigint").alias("total_severity"),
    )
    w = Window.partitionBy("borough_name").orderBy(
        F.col("total_severity").desc_nulls_first(), F.col("total_collisions").desc_nulls_first()
    )
    return (
        per_street.withColumn("_rnk", F.rank().over(w))
        .filter(F.col("_rnk") <= k)
        .drop("_rnk")
        .orderBy(F.col("borough_name").asc_nulls_last(), F.col("total_severity").desc_nulls_first(),
                 F.col("total_collisions").desc_nulls_first(), F.col("on_street_name").asc_nulls_last())
    )


def factor_fatality_rank(t: CollisionTables, min_count: int = MIN_RANKED_OCCURRENCES) -> DataFrame:
    """Q2: share of factor occurrences whose collision killed someone.

    Counts rows of collision_factors (one factor in two slots counts twice).
    Aggregates by factor id before touching the factor dimension (map-side
    partial aggregation collapses a hot factor), then names, filters >=
    min_count and ranks globally through the bounded-domain rank.  Collisions
    are joined by sorting: two columns of a compressed file pass for a table
    small enough to be sent to the driver when they hold millions of rows."""
    fatal = t.collisions.select(
        "collision_id", (F.col("number_of_persons_killed") > 0).alias("_fatal")
    )
    per_factor = (
        t.collision_factors.select("collision_id", "factor_id")
        .join(fatal.hint("merge"), "collision_id")
        .groupBy("factor_id")
        .agg(
            F.count(F.lit(1)).alias("factor_collision_count"),
            F.sum(F.when(F.col("_fatal"), 1).otherwise(0)).cast("bigint").alias("fatal_collisions"),
        )
    )
    rates = (
        per_factor.join(t.factors.filter(F.col("factor_desc").isNotNull()), "factor_id")
        .filter(F.col("factor_collision_count") >= min_count)
        .select(
            "factor_desc", "factor_collision_count", "fatal_collisions",
            pct_half_up("fatal_collisions", "factor_collision_count").alias("fatal_rate_pct"),
        )
    )
    return rank_desc_bounded(rates, "fatal_rate_pct", "fatality_rank").orderBy(
        "fatality_rank", F.col("factor_desc").asc_nulls_last()
    )


def vehicle_severity_rank(t: CollisionTables, min_count: int = MIN_RANKED_OCCURRENCES) -> DataFrame:
    """Q3: fatal / injury shares per primary (slot 1) vehicle type.

    Severity classes are exclusive: fatal if anyone was killed, else injury
    if anyone was injured, else property damage only (NULL counts fall
    through)."""
    killed, injured = F.col("number_of_persons_killed"), F.col("number_of_persons_injured")
    severity = t.collisions.select(
        "collision_id", F.when(killed > 0, 2).when(injured > 0, 1).otherwise(0).alias("_class"))
    # counted by class first: the ranking, which needs the fatal rate alone,
    # then reads the same shuffled counts instead of joining the facts again
    per_class = (
        t.collision_vehicles.filter(F.col("vehicle_order") == 1)
        .select("collision_id", "vehicle_type_id")
        .join(severity, "collision_id")
        .groupBy("vehicle_type_id", "_class").agg(F.count(F.lit(1)).alias("_n"))
    )

    def of_class(k: int):
        return F.sum(F.when(F.col("_class") == k, F.col("_n")).otherwise(0)).cast("bigint")

    per_type = per_class.groupBy("vehicle_type_id").agg(
        F.sum("_n").cast("bigint").alias("total_collisions"),
        of_class(2).alias("fatal_collisions"), of_class(1).alias("injury_collisions"))
    rates = (
        per_type.join(t.vehicle_types.filter(F.col("vehicle_type_desc").isNotNull()), "vehicle_type_id")
        .filter(F.col("total_collisions") >= min_count)
        .select(
            "vehicle_type_desc", "total_collisions", "fatal_collisions", "injury_collisions",
            pct_half_up("fatal_collisions", "total_collisions").alias("fatal_rate_pct"),
            pct_half_up("injury_collisions", "total_collisions").alias("injury_rate_pct"),
        )
    )
    return rank_desc_bounded(rates, "fatal_rate_pct", "fatality_rank").orderBy(
        "fatality_rank", F.col("vehicle_type_desc").asc_nulls_last()
    )
