"""What each stored file holds: its ids' blocks, its rows, and its date bounds.

Inserting what is absent asks which stored files could hold a feed's ids. A
range of ids answers badly as soon as one old id arrives with the new ones, so
for every file of the three fact tables the blocks of BLOCK neighbouring ids
that it holds are kept: a sketch without misses, mergeable by union, of one row
a block - at most one row an id however the ids are spread. A load's anti joins
then read only the files that share a block with the feed.

The index is itself two Parquet tables a table, to which :func:`refresh` adds the
files that are not in it yet, and of which nothing is ever changed. Files that it
does not know - of a load that died, or older than the index - are read whenever
it matters, so an incomplete index costs time and never a row.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.sources import store
from crashlake.sources.files import read_files, stored_files

#: Neighbouring ids in a block.
BLOCK = 4096
FILES = "file string, rows bigint, min_id bigint, max_id bigint, min_date date, max_date date"
BLOCKS = "file string, block bigint"


def _index_path(root: str, name: str, part: str) -> str:
    return store.table_path(root, f"_index/{name}/{part}")


def _read(spark: SparkSession, root: str, name: str, part: str, schema: str) -> DataFrame:
    path = _index_path(root, name, part)
    return spark.read.schema(schema).parquet(path) if store.path_exists(spark, path) else spark.createDataFrame([], schema)


def known_files(spark: SparkSession, root: str, name: str) -> DataFrame:
    """One row for each indexed file, also if two runs indexed it."""
    return _read(spark, root, name, "files", FILES).dropDuplicates(["file"])


def unknown_files(spark: SparkSession, root: str, name: str, stored: list[str] | None = None) -> list[str]:
    """Files not indexed yet; the driver gets file names, as from any listing."""
    known = {r.file for r in known_files(spark, root, name).select("file").collect()}
    return [f for f in (stored_files(spark, root, name) if stored is None else stored) if f not in known]


def _index_new(spark: SparkSession, root: str, name: str) -> None:
    new = unknown_files(spark, root, name)
    if not new:
        return
    rows = read_files(spark, root, name, new, "file")
    date = F.col("crash_date") if name == "collisions" else F.lit(None).cast("date")
    seen = rows.select("file", "collision_id", date.alias("date"))
    blocks = seen.select("file", F.floor(F.col("collision_id") / BLOCK).alias("block")).distinct()
    blocks.coalesce(1 + len(new) // 64).write.mode("append").parquet(_index_path(root, name, "blocks"))
    # the files' rows last: a file is known once all its blocks are
    files = seen.groupBy("file").agg(F.count(F.lit(1)).alias("rows"), F.min("collision_id").alias("min_id"), F.max("collision_id").alias("max_id"),
                                     F.min("date").alias("min_date"), F.max("date").alias("max_date"))
    empty = spark.createDataFrame([(f,) for f in new], "file string").join(files, "file", "left").withColumn("rows", F.coalesce("rows", F.lit(0)))
    empty.coalesce(1 + len(new) // 1024).write.mode("append").parquet(_index_path(root, name, "files"))


def refresh(spark: SparkSession, root: str) -> None:
    """Index the files that are not indexed yet; only those are read."""
    with ThreadPoolExecutor(len(store.FACT_TABLES)) as pool:
        for done in [pool.submit(_index_new, spark, root, name) for name in store.FACT_TABLES]:
            done.result()


def near_files(spark: SparkSession, root: str, name: str, ids: DataFrame, log: list | None = None) -> list[str]:
    """The files of ``name`` that may hold one of ``ids`` (collision_id)."""
    stored = stored_files(spark, root, name, log)
    if not stored:
        return []
    asked = ids.select(F.floor(F.col("collision_id") / BLOCK).alias("block")).distinct()
    hit = _read(spark, root, name, "blocks", BLOCKS).join(asked, "block", "left_semi").select("file").distinct()
    wanted = {r.file for r in hit.collect()} | set(unknown_files(spark, root, name, stored))
    return [f for f in stored if f in wanted]


def near(spark: SparkSession, root: str, name: str, ids: DataFrame) -> DataFrame:
    """The stored rows of ``name`` in the files that may hold one of ``ids``."""
    return read_files(spark, root, name, near_files(spark, root, name, ids))


def date_bounds(spark: SparkSession, root: str) -> DataFrame:
    """D7 from the index: first and last crash date. Of the table itself only files are read that are not indexed."""
    unknown = set(unknown_files(spark, root, "collisions"))
    gone = F.col("file").isin(sorted(unknown)) if unknown else F.lit(False)
    stored = spark.createDataFrame([(f,) for f in stored_files(spark, root, "collisions")], "file string")
    known = known_files(spark, root, "collisions").filter(~gone).join(stored, "file", "left_semi").select("min_date", "max_date")
    rest = read_files(spark, root, "collisions", sorted(unknown)).select(F.col("crash_date").alias("min_date"), F.col("crash_date").alias("max_date"))
    every = known.unionByName(rest) if unknown else known
    return every.agg(F.min("min_date").alias("min_date"), F.max("max_date").alias("max_date"))
