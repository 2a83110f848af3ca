"""Shared predicates: date ranges (with partition pruning) and the borough
parameter."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlake.schema import ALL_BOROUGHS

YEAR_PARTITION = "crash_year"


def to_date(value: str | dt.date) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def date_range(df: DataFrame, start, end, end_inclusive: bool = True, column: str = "crash_date") -> DataFrame:
    """Rows with start <= column <= end (or < end).  When the table is laid
    out by crash year, the equivalent year predicate is added so directory
    pruning applies; Spark does not derive it from the date predicate."""
    s, e = to_date(start), to_date(end)
    col = F.col(column)
    cond = (col >= F.lit(s)) & ((col <= F.lit(e)) if end_inclusive else (col < F.lit(e)))
    if YEAR_PARTITION in df.columns:
        last_year = e.year if (end_inclusive or (e.month, e.day) != (1, 1)) else e.year - 1
        cond = cond & F.col(YEAR_PARTITION).between(s.year, last_year)
    return df.filter(cond)


def borough_rows(collisions: DataFrame, boroughs: DataFrame, borough: str) -> DataFrame:
    """Collisions in the named borough, or all of them for the 'All' sentinel.

    With 'All' the borough table is not touched at all: borough ids are
    unique, so the left join could neither drop nor repeat a row.  A named
    borough becomes a semi join against the (tiny, filtered) dimension."""
    if borough == ALL_BOROUGHS:
        return collisions
    ids = boroughs.filter(F.col("borough_name") == F.lit(borough)).select("borough_id")
    return collisions.join(ids, "borough_id", "left_semi")
