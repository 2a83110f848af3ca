"""Dense surrogate ids without a single-partition window.

The reference allocates ids from a database sequence, one value at a time.
Here a whole set of new values is numbered at once, and every id is a pure
function of the data (not of how Spark happens to lay out partitions):

1. distinct values not yet in the dimension (null-safe anti join);
2. each value falls in one of n buckets by a hash of the value;
3. inside a bucket, values are numbered in key order (``row_number`` over a
   window partitioned by bucket - n windows of about distinct/n values);
4. values per bucket (one row per bucket) become offsets through a running
   sum; that table has n + 1 rows, so it is broadcast back.  The current
   maximum id of the dimension is folded in as an extra row, so new ids
   continue after it.

Ids are dense (1..k after the existing maximum) but carry no meaning; natural
keys are the contract.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _null_safe_on(left: DataFrame, right: DataFrame, keys: list[str]):
    return reduce(lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys])


def assign_ids(
    values: DataFrame,
    keys: list[str],
    id_col: str,
    existing: DataFrame | None = None,
    id_type: str = "int",
    num_partitions: int | None = None,
    count_col: str | None = None,
) -> DataFrame:
    """Rows (id_col, *keys) for every distinct key tuple of ``values`` that is
    not in ``existing``; ids continue after ``max(existing[id_col])``.
    With ``count_col`` the rows also carry how many input rows had the key
    (the same partial aggregate that finds the distinct keys)."""
    spark = values.sparkSession
    if count_col:
        new = values.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
    else:
        new = values.select(*keys).distinct()
    if existing is not None:
        old = existing.select(*keys)
        new = new.join(old, _null_safe_on(new, old, keys), "left_anti")
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))

    new = new.withColumn("_bucket", F.pmod(F.xxhash64(*keys), F.lit(n)))
    in_bucket = Window.partitionBy("_bucket").orderBy(*[F.col(k).asc_nulls_first() for k in keys])
    numbered = new.withColumn("_local", F.row_number().over(in_bucket))
    counts = new.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    if existing is not None:
        base = existing.agg(F.coalesce(F.max(id_col).cast("bigint"), F.lit(0).cast("bigint")).alias("_n"))
    else:
        base = spark.range(1).select(F.lit(0).cast("bigint").alias("_n"))
    base = base.select(F.lit(-1).cast("bigint").alias("_bucket"), "_n")
    # one row per bucket (+1): bounded by n, so a global window and a broadcast are safe
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.unionByName(base).select(
        "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off")
    )
    return numbered.join(F.broadcast(offsets), "_bucket").select(
        (F.col("_off") + F.col("_local")).cast(id_type).alias(id_col), *keys,
        *([count_col] if count_col else []),
    )


def extend_dimension(
    existing: DataFrame | None, values: DataFrame, value_col: str, id_col: str
) -> DataFrame:
    """Existing dimension rows plus new ones for unseen values (get-or-create
    for a whole set of values at once)."""
    new = assign_ids(values.select(value_col), [value_col], id_col, existing)
    return new if existing is None else existing.select(id_col, value_col).unionByName(new)
