"""Numeric helpers shared by the ranking queries."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def pct_half_up(part: str, whole: str) -> Column:
    """100 * part / whole rounded to 2 places, half up, as DOUBLE.

    Exact-decimal rounding done in integers: (20000*part + whole) div
    (2*whole), then / 100.  A plain round() on a double differs for values
    such as 201/20000.  whole = 0 gives NULL.  Both inputs are counts >= 0.
    """
    return F.expr(
        f"CASE WHEN `{whole}` <> 0 THEN "
        f"CAST((20000 * CAST(`{part}` AS BIGINT) + `{whole}`) div (2 * CAST(`{whole}` AS BIGINT)) AS DOUBLE) / 100 "
        f"END"
    )
