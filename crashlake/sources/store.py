"""The table store: six parquet tables under one root.

Layout (S6, in place of the reference's B-tree indexes):

* ``collisions`` is directory-partitioned by ``crash_year`` and, inside each
  task, range-partitioned and sorted on ``crash_date`` - date-range filters
  prune directories and then row groups through parquet min/max statistics.
  Range partitioning on (date, id) spreads a busy year over many tasks
  instead of funnelling it into one.
* ``collision_vehicles`` / ``collision_factors`` are range-partitioned and
  sorted on ``collision_id``: each file and row group covers a narrow id
  range, so the loader's id-range filter and id lookups skip the rest.  ``write_bucketed`` additionally
  offers catalog tables bucketed on ``collision_id`` (same bucket count for
  the three tables) for shuffle-free joins where a metastore is available.
* ``sources/rewrites.py`` merges small files, orders a table along a curve
  through two columns (date and borough; collision id and factor or vehicle
  type), and deletes by rewriting only the files concerned.
* dimensions are hash-partitioned on their id (few, adaptive-sized files).

Appends are insert-if-absent (S2): the normaliser only emits keys the store
does not have, so replaying a feed is a no-op, and a load that died half way
is finished by simply running it again.
"""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake import schema as S
from crashlake.operators.filters import YEAR_PARTITION
from crashlake.sources.files import path_exists, read_files, rewritten, stored_files, table_path, table_schema
from crashlake.tables import CollisionTables

FACT_TABLES = ("collisions", "collision_vehicles", "collision_factors")


def _by_range(df: DataFrame, cols, num_files: int | None) -> DataFrame:
    # Without an explicit count the shuffle uses spark.sql.shuffle.partitions
    # and adaptive execution merges small ranges, so file count follows data size.
    return df.repartitionByRange(num_files, *cols) if num_files else df.repartitionByRange(*cols)


def layout(name: str, df: DataFrame, num_files: int | None = None) -> DataFrame:
    """The physical order a table is written in."""
    if name == "collisions":
        if YEAR_PARTITION not in df.columns:
            df = df.withColumn(YEAR_PARTITION, F.year("crash_date"))
        return _by_range(df, ["crash_date", "collision_id"], num_files).sortWithinPartitions("crash_date")
    if name in ("collision_vehicles", "collision_factors"):
        # id ranges per file: the loader's id-range filter and id lookups
        # skip whole row groups
        return _by_range(df, ["collision_id"], num_files).sortWithinPartitions("collision_id")
    # dimensions: hash on the id (no sampling pass); adaptive execution packs
    # the few new values of a load into one or a handful of files
    key = df.columns[0]
    by_key = df.repartition(num_files, key) if num_files else df.repartition(key)
    return by_key.sortWithinPartitions(key)


def write_table(name: str, df: DataFrame, root: str, mode: str = "append",
                num_files: int | None = None) -> None:
    writer = layout(name, df, num_files).write.mode(mode)
    if name == "collisions":
        writer = writer.partitionBy(YEAR_PARTITION)
    writer.parquet(table_path(root, name))


def create_tables(spark: SparkSession, root: str) -> None:
    """S3: drop and recreate the six tables empty (children first, as the
    schema script does).  Only ever called for an explicit reset."""
    remove(spark, table_path(root, "_rewrites"))  # what it names goes too
    for name in reversed(S.LOAD_ORDER):
        empty = spark.createDataFrame([], S.TABLES[name])
        if name == "collisions":
            empty = empty.withColumn(YEAR_PARTITION, F.lit(None).cast("int"))
            empty.write.mode("overwrite").partitionBy(YEAR_PARTITION).parquet(table_path(root, name))
        else:
            empty.write.mode("overwrite").parquet(table_path(root, name))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this run's own making."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def read_tables(spark: SparkSession, root: str, missing_ok: bool = False) -> CollisionTables:
    """The six tables with their declared schemas (``collisions`` also
    carries the ``crash_year`` partition column).  With ``missing_ok`` a
    table not written yet reads as empty.  All tables show one state of the
    store's rewrites."""
    log = rewritten(spark, root)

    def read(name: str) -> DataFrame:
        sch, path = table_schema(name), table_path(root, name)
        if missing_ok and not path_exists(spark, path):
            return spark.createDataFrame([], sch)
        if any(r.table_name == name for r in log):
            return read_files(spark, root, name, stored_files(spark, root, name, log))
        return spark.read.schema(sch).parquet(path)
    return CollisionTables(**{name: read(name) for name in S.TABLES})


def append_new(new: CollisionTables, root: str, num_files: int | None = None) -> None:
    """Append rows whose keys are absent; parents before children."""
    for name in S.LOAD_ORDER:
        write_table(name, getattr(new, name), root, mode="append", num_files=num_files)


@contextmanager
def one_load(spark: SparkSession, root: str, run: str):
    """Holds the store's lock: ids continue after the largest stored one, so two
    loads must not run at once.  A load that died leaves its lock; the same
    load takes it over, another one needs it removed."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table_path(root, f"_lock/{run}"))
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(p)
    others = [x.getPath().getName() for x in fs.listStatus(p.getParent()) if x.getPath().getName() != run]
    if others:
        fs.delete(p, True)
        raise RuntimeError(f"another load holds {root}: {others}")
    try:
        yield
    finally:
        fs.delete(p, True)


class Staging:
    """Intermediate results of one run as parquet in the store's shared folder:
    cuts the lineage (a lost executor re-reads the file instead of re-parsing
    the source) and fixes values that must not be recomputed.  ``close``
    removes what the run staged."""

    def __init__(self, spark: SparkSession, root: str, run: str):
        self.spark, self.path = spark, table_path(root, f"_staging/{run}-{uuid.uuid4().hex}")

    def write(self, df: DataFrame, label: str) -> DataFrame:
        df.write.mode("error").parquet(f"{self.path}/{label}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{label}")

    def close(self) -> None:
        remove(self.spark, self.path)


def export_csv(df: DataFrame, path: str) -> None:
    """A result set as CSV with a header, written by the executors (a
    directory of part files; nothing passes through the driver)."""
    df.write.mode("overwrite").option("header", True).csv(path)


def write_bucketed(spark: SparkSession, t: CollisionTables, database: str, buckets: int) -> None:
    """S6 (catalog variant): the three fact tables bucketed and sorted on
    collision_id with one bucket count, so joins among them need no shuffle.
    Rows are dealt by the bucket key first: one file per bucket."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    for name in FACT_TABLES:
        (getattr(t, name).repartition(buckets, "collision_id").write.mode("overwrite")
         .bucketBy(buckets, "collision_id").sortBy("collision_id").saveAsTable(f"{database}.{name}"))
    for name in ("boroughs", "vehicle_types", "factors"):
        getattr(t, name).write.mode("overwrite").saveAsTable(f"{database}.{name}")


def read_bucketed(spark: SparkSession, database: str) -> CollisionTables:
    """The six tables of :func:`write_bucketed`."""
    return CollisionTables(**{name: spark.table(f"{database}.{name}") for name in S.TABLES})
