"""The daily rollup of a store, kept up by file.

Stored files never change, so the rollup of a file is worked out once, by the
first :func:`refresh` after it was written: a load pays for its own files only.
The rollup of the table is the sum over the files that it has now. A file that a
delete or a rewrite took away drops out, one not rolled up yet is read itself: a
refresh that did not happen costs time and never a row.

``_rollup/days`` holds the rows, in folders by year; ``_rollup/files`` says which
run rolled which file up, and is written after that run's rows. Rows of a run
that died before, or of a second run over one file, are not read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.operators.filters import YEAR_PARTITION, date_range
from crashlake.operators.rollup import SUMS, daily_rollup
from crashlake.sources import key_index, store

FILES = "file string, run string"
DAYS = "file string, run string, crash_date date, borough_id int, crashes bigint, " + ", ".join(f"{name} bigint" for name in SUMS) + f", {YEAR_PARTITION} int"


def _read(spark: SparkSession, root: str, part: str, schema: str) -> DataFrame:
    path = store.table_path(root, f"_rollup/{part}")
    return spark.read.schema(schema).parquet(path) if store.path_exists(spark, path) else spark.createDataFrame([], schema)


def _rolled(spark: SparkSession, root: str) -> DataFrame:
    """One row a file: the run whose rows count."""
    return _read(spark, root, "files", FILES).groupBy("file").agg(F.min("run").alias("run"))


def _waiting(spark: SparkSession, root: str) -> tuple[list[str], list[str]]:
    """The table's files, and those of them not rolled up; the driver gets file names, as from any listing."""
    stored = key_index.stored_files(spark, root, "collisions")
    done = {r.file for r in _rolled(spark, root).select("file").collect()}
    return stored, [f for f in stored if f not in done]


def refresh(spark: SparkSession, root: str) -> None:
    """Roll up the files that are not rolled up yet; only those are read."""
    _, new = _waiting(spark, root)
    if not new:
        return
    run = uuid.uuid4().hex
    rows = key_index.read_files(spark, root, "collisions", new, "file")
    days = daily_rollup(rows, "file").withColumn("run", F.lit(run)).withColumn(YEAR_PARTITION, F.year("crash_date"))
    by_day = days.repartitionByRange("crash_date").sortWithinPartitions("crash_date", "borough_id")
    by_day.write.mode("append").partitionBy(YEAR_PARTITION).parquet(store.table_path(root, "_rollup/days"))
    names = spark.createDataFrame([(f, run) for f in new], FILES)
    names.coalesce(1 + len(new) // 1024).write.mode("append").parquet(store.table_path(root, "_rollup/files"))


def daily(spark: SparkSession, root: str, start, end) -> DataFrame:
    """Rollup rows of the days from start to end, both included, to be added up by
    the functions of operators.rollup. Of the collisions only files are read that
    wait for a refresh."""
    stored, waiting = _waiting(spark, root)
    counted = spark.createDataFrame([(f,) for f in stored if f not in set(waiting)], "file string").join(_rolled(spark, root), "file")
    days = date_range(_read(spark, root, "days", DAYS), start, end).join(counted, ["file", "run"], "left_semi")
    columns = ["crash_date", "borough_id", "crashes", *SUMS]
    if not waiting:
        return days.select(*columns)
    rest = date_range(key_index.read_files(spark, root, "collisions", waiting), start, end)
    return days.select(*columns).unionByName(daily_rollup(rest).select(*columns))
