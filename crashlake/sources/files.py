"""Which files a table of the store consists of.

A table is the files below its folder, as long as nothing was rewritten. A
rewrite (:mod:`crashlake.sources.rewrites`) puts new files into a folder
``_r-<run>`` of the table, which a plain listing does not see, and then adds one
file to ``_rewrites``: from that moment on the new files count and the ones they
replace do not, for all tables of the rewrite at once. Nothing is overwritten,
so a query planned before goes on reading what it listed.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from crashlake import schema as S
from crashlake.operators.filters import YEAR_PARTITION

#: One row for each file that a rewrite added or replaced.
LOG = "run string, table_name string, file string, added boolean"
PREFIX = "_r-"


def table_path(root: str, name: str) -> str:
    return f"{root.rstrip('/')}/{name}"


def path_exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def rewritten(spark: SparkSession, root: str) -> list:
    """The log of rewrites; the driver gets file names, as from any listing."""
    path = table_path(root, "_rewrites")
    return spark.read.schema(LOG).parquet(path).collect() if path_exists(spark, path) else []


def within(name: str, path: str) -> str:
    """A file's path below its table's folder."""
    return path.rsplit(f"/{name}/", 1)[1]


def table_schema(name: str) -> T.StructType:
    if name != "collisions":
        return S.TABLES[name]
    return T.StructType([*S.TABLES[name].fields, T.StructField(YEAR_PARTITION, T.IntegerType())])


def stored_files(spark: SparkSession, root: str, name: str, log: list | None = None) -> list[str]:
    """The table's files, as paths below its folder."""
    path = table_path(root, name)
    if not path_exists(spark, path):
        return []
    log = [r for r in (rewritten(spark, root) if log is None else log) if r.table_name == name]
    listed = {within(name, f) for f in spark.read.schema(S.TABLES[name]).parquet(path).inputFiles()}
    return sorted((listed | {r.file for r in log if r.added}) - {r.file for r in log if not r.added})


def read_files(spark: SparkSession, root: str, name: str, files: list[str], file_column: str | None = None) -> DataFrame:
    """The rows of some of a table's files; with ``file_column``, which file each is from."""
    base, schema = table_path(root, name), table_schema(name)
    columns = [F.col(c) for c in schema.fieldNames()]
    if file_column:
        schema = schema if files else T.StructType([*schema.fields, T.StructField(file_column, T.StringType())])
    if not files:
        return spark.createDataFrame([], schema)
    runs: dict[str, list[str]] = {}
    for f in files:
        runs.setdefault(f"{base}/{f.split('/', 1)[0]}" if f.startswith(PREFIX) else base, []).append(f"{base}/{f}")
    if file_column:
        columns.append(F.regexp_extract(F.col("_metadata.file_path"), f"/{name}/(.+)$", 1).alias(file_column))
    return reduce(DataFrame.unionByName, [spark.read.schema(schema).option("basePath", at).parquet(*some).select(*columns) for at, some in runs.items()])
