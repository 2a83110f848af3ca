"""Contiguous shards of nearly equal bytes by global prefix sums.

Rows are laid in one global order (checksum of the text, size, id), which keeps equal
texts together. Each range partition sums its own sizes as it is written; the
partitions' totals, one row each, give every partition its global start, and
so every row its global byte position. Cuts lie at equal targets: a row
belongs to the shard that holds its middle. A cut within a group of equal texts moves
to the group's nearer border, unless the group is too large for that. Only ids, sizes and checksums are
shuffled."""

from __future__ import annotations

from functools import reduce
from operator import or_

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crashlake.llm.common import stage

SHARDS, EXTRA = 24, 8
#: A group of equal texts stays in one shard if it fills at most one part in so many of a shard.
WIDEST = 32


def _running(batches):
    """Adds each row's byte position and number within its partition."""
    size_at = row_at = 0
    for batch in batches:
        size = batch.column("size").to_numpy()
        ends = size_at + np.cumsum(size)
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(ends - size), pa.array(row_at + np.arange(len(size), dtype=np.int64))],
            [*batch.schema.names, "local_start", "local_row"])
        if len(size):
            size_at, row_at = int(ends[-1]), row_at + len(size)


def shard_by_bytes(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", shards: int = SHARDS, extra: int = EXTRA) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot for every row of ``docs``.

    Size: UTF-8 bytes and ``extra``; a null text counts as an empty one. Repeated
    rows take a place each; slots are gapless in every shard; fewer rows than
    shards leave some empty; an empty table gives none."""
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    keys = docs.select(F.col(doc_id).alias("doc_id"), (F.octet_length(body) + extra).cast("long").alias("size"), F.crc32(body).alias("text_crc32"),
                       F.xxhash64(F.monotonically_increasing_id()).alias("tie"))  # splits runs of equal rows
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = ["text_crc32", "size", "doc_id", "tie"]
    laid = keys.repartitionByRange(n, *order).sortWithinPartitions(*order).select("doc_id", "size", "text_crc32", F.spark_partition_id().alias("part"))
    runs = stage(laid.mapInArrow(_running, "doc_id bigint, size bigint, text_crc32 bigint, part int, local_start bigint, local_row bigint"), "runs")
    totals = runs.groupBy("part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    before = Window.partitionBy(F.lit(0)).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = totals.select("part", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("part_start"), F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("part_row"))
    placed = runs.join(F.broadcast(starts), "part")  # at most n rows
    placed = placed.select("doc_id", "size", "text_crc32", (F.col("part_start") + F.col("local_start")).alias("start"), (F.col("part_row") + F.col("local_row")).alias("row"))
    middle = 2 * F.col("start") + F.col("size")
    shard = sum([(middle >= c).cast("int") for c in _cuts(placed, totals.agg(F.sum("bytes")).first()[0] or 0, shards)], F.lit(0))
    placed = placed.select("doc_id", "size", "text_crc32", shard.alias("shard"), "row")
    firsts = placed.groupBy("shard").agg(F.min("row").alias("first"))
    return placed.join(F.broadcast(firsts), "shard").select("doc_id", "size", "text_crc32", "shard", (F.col("row") - F.col("first")).alias("slot"))


def _cuts(placed: DataFrame, total: int, shards: int) -> list[int]:
    """Twice the positions where shards 1, 2, ... begin: the equal targets, moved to
    the nearer border of a group of equal texts that a target divides. Groups are
    told by checksum and size; at most one a target is looked at, and one of over
    1 / WIDEST of a shard stays divided, as moving its cut would unbalance shards."""
    even = [-(-2 * total * k // shards) for k in range(1, shards)]
    if not total or not even:
        return even
    last = 2 * (F.col("start") + F.col("size"))
    divided = placed.where(reduce(or_, [(2 * F.col("start") < c) & (last >= c) for c in even])).select("text_crc32", "size").distinct()
    spans = placed.join(F.broadcast(divided), ["text_crc32", "size"]).groupBy("text_crc32", "size").agg(
        F.min("start").alias("first"), F.max(F.col("start") + F.col("size")).alias("end")).collect()  # a row a target at most
    small = [(2 * x["first"], 2 * x["end"]) for x in spans if (x["end"] - x["first"]) * shards * WIDEST <= total]
    return [next((a if c - a <= b - c else b for a, b in small if a < c < b), c) for c in even]
