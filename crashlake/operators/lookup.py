"""Value -> id lookups that stay balanced when one value dominates.

Child rows are joined to a dimension on a text value (a vehicle type, a
factor).  One value can carry a third of all rows ('Sedan'); a shuffle join
would send all of them to one task.  The lookup therefore splits:

* the HOT_KEYS most frequent values with more than ``hot_rows`` rows are found
  by a grouped count (partial on the map side) and matched against the
  dimension by a broadcast join of that constant size on the map side;
* the remaining rows go through an ordinary join, where no value has more
  than ``hot_rows`` rows or a HOT_KEYS-th of them all; rows already matched,
  and rows without a value, carry a route number spread by a hash, so they
  scatter instead of meeting in one task.

When the dimension is small Spark broadcasts the second join as well; the
split only matters when it is not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

HOT_VALUE_ROWS = 1_000_000
#: Most keys that are ever matched by broadcast, however many rows there are.
HOT_KEYS = 1_000


def lookup_ids(rows: DataFrame, dim: DataFrame, value_col: str, id_col: str,
               spread_by: list[str], hot_rows: int = HOT_VALUE_ROWS, keep_unmatched: bool = False) -> DataFrame:
    """Join of ``rows`` with ``dim`` (unique on ``value_col``): rows plus
    ``id_col``; rows whose value is not in the dimension are dropped, or
    with ``keep_unmatched`` have a NULL id.
    ``spread_by`` columns scatter the matched hot rows in the shuffle."""
    spark = rows.sparkSession
    spread = int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot_values = (rows.groupBy(value_col).agg(F.count(F.lit(1)).alias("_n"))
                  .filter((F.col("_n") > hot_rows) & F.col(value_col).isNotNull())
                  .orderBy(F.desc("_n"), value_col).limit(HOT_KEYS).select(value_col))
    hot = dim.join(hot_values, value_col, "left_semi").select(
        F.col(value_col).alias("_h_value"), F.col(id_col).alias("_h_id"))
    tagged = rows.join(F.broadcast(hot), rows[value_col] == hot["_h_value"], "left").drop("_h_value")
    tagged = tagged.withColumn("_route", F.when(F.col("_h_id").isNull() & F.col(value_col).isNotNull(), F.lit(0)).otherwise(
        F.lit(1) + F.pmod(F.xxhash64(*spread_by), F.lit(spread))))
    cold = dim.select(F.col(value_col).alias("_c_value"), F.col(id_col).alias("_c_id"),
                      F.lit(0).cast("long").alias("_c_route"))
    joined = tagged.join(cold, (tagged[value_col] == cold["_c_value"]) & (tagged["_route"] == cold["_c_route"]),
                         "left")
    found = joined.withColumn(id_col, F.coalesce("_h_id", "_c_id"))
    return ((found if keep_unmatched else found.filter(F.col(id_col).isNotNull()))
            .drop("_h_id", "_route", "_c_value", "_c_id", "_c_route"))
