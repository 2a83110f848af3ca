"""Global RANK over a column with a small, known domain.

``rank() over (order by v desc)`` without a partition moves every row into one
task.  When v can take only a bounded set of values (a percentage with two
decimals has at most 10,001) the rank of a row is 1 + the number of rows with
a strictly larger v.  Counting rows per value gives a table of at most that
many rows; a running sum over it is the rank, and that small table is
broadcast back onto the rows.  Same result as the window, no hot task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

PCT_DOMAIN = 10_001  # values 0.00 .. 100.00


def rank_desc_bounded(df: DataFrame, value_col: str, rank_col: str) -> DataFrame:
    """Add ``rank_col`` = RANK() OVER (ORDER BY value_col DESC NULLS FIRST).

    ``value_col`` must have a bounded domain (see PCT_DOMAIN)."""
    per_value = df.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
    above = Window.orderBy(F.col(value_col).desc_nulls_first()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    ranks = per_value.select(
        F.col(value_col).alias("_v"),
        (F.coalesce(F.sum("_n").over(above), F.lit(0)) + 1).cast("bigint").alias(rank_col),
    )
    return df.join(F.broadcast(ranks), df[value_col].eqNullSafe(ranks["_v"])).drop("_v")
