"""Rewriting stored files: deletes, compaction, two-key order.

Each function holds the store's lock, writes new files beside the old ones and
publishes them, for all its tables, by adding one file to the log of
:mod:`crashlake.sources.files`. One that dies before has changed nothing; its
files are removed by :func:`vacuum`, which also removes what later rewrites replaced."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from math import ceil

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.functions.curve import curve_key
from crashlake.operators.filters import YEAR_PARTITION
from crashlake.sources import day_index, files, key_index, store

#: Size that a stored file should have.
TARGET_BYTES = 128 << 20
#: The two columns of each table that queries choose rows by.
CURVES = {
    "collisions": ["crash_day", "borough_id"],
    "collision_vehicles": ["collision_id", "vehicle_type_id"],
    "collision_factors": ["collision_id", "factor_id"],
}


def _put(spark: SparkSession, root: str, run: str, name: str, rows: DataFrame, by: list[str]) -> list[str]:
    """Write a table's new files, which nobody sees yet; their paths below its folder."""
    at = f"{files.table_path(root, name)}/{files.PREFIX}{run}"
    rows.write.mode("error").partitionBy(*by, *([YEAR_PARTITION] if name == "collisions" else [])).parquet(at)
    return [files.within(name, f) for f in spark.read.schema(rows.schema).parquet(at).inputFiles()]


def _rewrite(spark: SparkSession, root: str, step: Callable[[str, list], dict[str, tuple[list[str], list[str]]]]) -> dict[str, tuple[int, int]]:
    """Run ``step``(run, log) -> table: (new files, files they replace) under the lock
    and publish what it wrote. Returns the number of both for each table."""
    run = uuid.uuid4().hex
    with store.one_load(spark, root, f"rewrite-{run}"):
        done = step(run, files.rewritten(spark, root))
        log = [(run, name, f, added) for name, both in done.items() for some, added in zip(both, (True, False)) for f in some]
        if log:  # one file, so all of it is seen at once
            spark.createDataFrame(log, files.LOG).coalesce(1).write.mode("append").parquet(files.table_path(root, "_rewrites"))
        key_index.refresh(spark, root)
        day_index.refresh(spark, root)
    return {name: (len(new), len(old)) for name, (new, old) in done.items()}


def delete_collisions(spark: SparkSession, root: str, ids: DataFrame) -> dict[str, tuple[int, int]]:
    """K5 over a store: take away the collisions of ``ids`` (collision_id; nulls and
    ids not stored change nothing) with their vehicle and factor rows.

    The index names the files that share a block with the ids; of those only the
    files that hold one are rewritten. Returns for each table the number of files
    written and replaced."""
    def step(run: str, log: list) -> dict:
        staging = store.Staging(spark, root, f"delete-{run}")
        try:
            gone = staging.write(ids.select("collision_id").where("collision_id is not null").distinct(), "ids")
            out = {}
            for name in reversed(store.FACT_TABLES):
                near = files.read_files(spark, root, name, key_index.near_files(spark, root, name, gone, log), "file")
                held = sorted(r.file for r in near.join(gone, "collision_id", "left_semi").select("file").distinct().collect())
                if held:
                    stay = files.read_files(spark, root, name, held).join(gone, "collision_id", "left_anti")
                    out[name] = _put(spark, root, run, name, store.layout(name, stay), []), held
            return out
        finally:
            staging.close()
    return _rewrite(spark, root, step)


def _sizes(spark: SparkSession, root: str, name: str, some: list[str]) -> dict[str, int]:
    """Bytes of files, from a listing that Spark spreads; no content is read."""
    if not some:
        return {}
    at = [f"{files.table_path(root, name)}/{f}" for f in some]
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(at)
    return {files.within(name, r.path): r.length for r in listed.select("path", "length").collect()}


def bins(found: list[tuple[str, str, object, int]], target: int) -> list[list[str]]:
    """Files to merge, from (file, group, place, bytes): in each group, files under
    half the target are taken in the order of their places until the next would
    pass the target. Neighbours stay together, so a merged file covers a narrow
    range; two bins that follow each other hold more than the target between
    them. A bin of one file is left alone."""
    out: list[list[str]] = []
    last, held = None, 0
    for file, group, _, size in sorted(found, key=lambda f: (f[1], f[2] is None, f[2] if f[2] is not None else 0, f[0])):
        if 2 * size >= target:
            continue
        if group != last or held + size > target:
            out.append([])
            held = 0
        out[-1].append(file)
        last, held = group, held + size
    return [b for b in out if len(b) > 1]


def compact(spark: SparkSession, root: str, target_bytes: int = TARGET_BYTES) -> dict[str, tuple[int, int]]:
    """Merge small files of a year (collisions) or of neighbouring ids (their
    vehicles and factors) into files of at most ``target_bytes``, sorted like those
    of a load. Returns for each table the number of files written and replaced."""
    key_index.refresh(spark, root)  # the places of files come from their bounds

    def step(run: str, log: list) -> dict:
        out = {}
        for name in store.FACT_TABLES:
            stored = files.stored_files(spark, root, name, log)
            size = _sizes(spark, root, name, stored)
            order = "min_date" if name == "collisions" else "min_id"
            place = {r.file: r[order] for r in key_index.known_files(spark, root, name).select("file", order).collect()}
            place = {f: p.toordinal() if hasattr(p, "toordinal") else p for f, p in place.items()}
            group = {f: next((x for x in f.split("/") if x.startswith(f"{YEAR_PARTITION}=")), "") for f in stored}
            merged = bins([(f, group[f], place.get(f), size[f]) for f in stored], target_bytes)
            if not merged:
                continue
            bin_of = spark.createDataFrame([(f, k) for k, b in enumerate(merged) for f in b], "file string, bin int")
            old = sorted(f for b in merged for f in b)
            # one row a file is sent, never the rows, which Spark would take for the smaller side
            rows = files.read_files(spark, root, name, old, "file").join(F.broadcast(bin_of), "file").drop("file")
            sort = [YEAR_PARTITION, "crash_date"] if name == "collisions" else ["collision_id"]
            # a bin, of at most the target's size, lies whole in one task and becomes one file
            out[name] = _put(spark, root, run, name, rows.repartition(len(merged), "bin").sortWithinPartitions("bin", *sort), ["bin"]), old
        return out
    return _rewrite(spark, root, step)


def cluster(spark: SparkSession, root: str, name: str, target_bytes: int = TARGET_BYTES) -> tuple[int, int]:
    """Rewrite a table along a curve through the two columns that queries choose
    by (CURVES), so that a filter on either skips files and row groups. Collisions
    stay in their years. Returns the number of files written and replaced."""
    def step(run: str, log: list) -> dict:
        old = files.stored_files(spark, root, name, log)
        if not old:
            return {}
        rows = files.read_files(spark, root, name, old)
        years = [YEAR_PARTITION] if name == "collisions" else []
        if years:  # the day within its year: each year has its own stretch of the curve
            rows = rows.withColumn("crash_day", F.dayofyear("crash_date"))
        n = max(1, ceil(sum(_sizes(spark, root, name, old).values()) / target_bytes))
        # ids last: rows of one place on the curve can be cut between tasks
        keyed = rows.withColumn("curve", curve_key(rows, CURVES[name]))
        laid = keyed.repartitionByRange(n, *years, "curve", "collision_id").sortWithinPartitions(*years, "curve", "collision_id")
        return {name: (_put(spark, root, run, name, laid.drop("curve", "crash_day"), []), old)}
    return _rewrite(spark, root, step).get(name, (0, 0))


def vacuum(spark: SparkSession, root: str) -> int:
    """Remove the files that rewrites replaced or left unpublished, once no reader
    of an earlier state is left. Returns how many files and folders were removed."""
    removed = 0
    with store.one_load(spark, root, f"rewrite-{uuid.uuid4().hex}"):
        log = files.rewritten(spark, root)
        for r in log:
            path = f"{files.table_path(root, r.table_name)}/{r.file}"
            if not r.added and files.path_exists(spark, path):
                store.remove(spark, path)
                removed += 1
        published = {f"{files.PREFIX}{r.run}" for r in log}
        for name in store.FACT_TABLES:
            p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(files.table_path(root, name))
            fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
            for entry in fs.listStatus(p) if fs.exists(p) else []:
                folder = entry.getPath().getName()
                if folder.startswith(files.PREFIX) and folder not in published:
                    store.remove(spark, f"{files.table_path(root, name)}/{folder}")
                    removed += 1
    return removed
