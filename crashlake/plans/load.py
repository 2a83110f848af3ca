"""N6 + S2 against a store: load a feed into the six tables.

Order of work (each step one Spark job, parents before children):

1. clean the feed and stage it as parquet in the store (lineage cut; the
   file order column is fixed once); in ``fail`` mode any row that breaks a
   rule, also one that would lose to another or is stored already, stops the
   load here, before anything is written;
2. append new dimension values, then read the dimensions back, so every
   fact row joins to ids that are already on disk (ids never recomputed);
3. stage the first-wins collision candidates once; write the rejected ones
   to ``_rejects`` (partition = load id, replaced as a whole), append the
   accepted ones, then their vehicle and factor rows, skipping rejected ids;
4. index the new files (sources.key_index), add them to the daily rollup
   (sources.day_index) and remove the run's staging folder.

The load id is a function of the input (a feed's file list, a stream's batch),
every append is insert-if-absent, so a crashed load is repaired by running
it again, and replaying a feed adds nothing and leaves its rejects as they
were.  New ids continue after the largest stored one: a store takes one load
at a time, and a load that finds another's lock refuses to start.
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.operators import normalize as N
from crashlake.session import small_methods
from crashlake.sources import day_index, key_index, store
from crashlake.sources.feed import compact_order, feed_files, has_file_order, read_feed


def at_once(*jobs):
    """Results of Spark jobs that do not depend on each other, started together."""
    with ThreadPoolExecutor(len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def feed_id(spark: SparkSession, path: str) -> str:
    """The load id of a path: a digest of its files' names, sizes and times, so that a
    file delivered again with other content is another load."""
    files = spark.read.format("binaryFile").load(path).select("path", "length", "modificationTime")
    one = F.sha2(F.concat_ws("|", "path", F.col("length").cast("string"), F.unix_micros("modificationTime").cast("string")), 256)
    return files.agg(F.sha2(F.array_join(F.sort_array(F.collect_list(one)), ""), 256)).first()[0][:32]


def load_feed(spark: SparkSession, feed: DataFrame | str, root: str, mode: str = "quarantine",
              order_col: str = "_order", num_files: int | None = None, load_id: str | None = None) -> str:
    """Load one feed (a path to CSV, or an all-string DataFrame with an order
    column, whose ``load_id`` the caller names if replays are to be known) into
    the store at ``root``.  Returns the load id."""
    if mode not in ("quarantine", "fail"):
        raise ValueError("mode must be 'quarantine' or 'fail'")
    load_id = load_id or (feed_id(spark, feed) if isinstance(feed, str) else uuid.uuid4().hex)
    with store.one_load(spark, root, load_id):
        staging = store.Staging(spark, root, load_id)
        try:
            if isinstance(feed, str):
                feed = read_feed(spark, feed, staging.write)
            _load(spark, feed, root, mode, order_col, num_files, load_id, staging)
        finally:
            staging.close()
    return load_id


def _load(spark: SparkSession, feed: DataFrame, root: str, mode: str, order_col: str, num_files: int | None,
          load_id: str, staging: store.Staging) -> None:
    with small_methods(spark):  # before any step that runs beside another
        cleaned = staging.write(N.clean_feed(feed, order_col=order_col), "feed")
    staged, broken = N.whole_rows(cleaned)
    if mode == "fail":
        N.raise_on_rejects(broken.unionByName(N.rejects_of(staged)))
    if has_file_order(staged):
        staged = compact_order(staged, staging.write(feed_files(staged), "files"))
    before = store.read_tables(spark, root, missing_ok=True)  # a first load starts from nothing
    # Stored rows can only conflict in the files that share a block of ids with
    # the feed: the index names them, also when one old id comes with new ones.
    ids = staged.select("collision_id")
    stored = dict(zip(store.FACT_TABLES, at_once(*[lambda name=name: key_index.near(spark, root, name, ids) for name in store.FACT_TABLES])))

    # 1. what several steps read is written once, tables that do not depend on
    #    each other at the same time
    vehicles, factors, repeated = at_once(
        lambda: staging.write(N.vehicle_values(staged), "vehicle-values"),
        lambda: staging.write(N.factor_values(staged), "factor-values"),
        lambda: staging.write(N.repeated_ids(staged), "repeated"))

    # 2. dimensions: new values only, then read back (ids are fixed on disk)
    new = N.new_dimension_rows(staged, before, vehicles, factors)
    at_once(*[lambda name=name, rows=rows: store.write_table(name, rows, root, num_files=num_files) for name, rows in new.items()])
    now = store.read_tables(spark, root, missing_ok=True)

    # 3. collisions: first-wins candidates staged once, then split into
    #    rejects and accepted rows (no second aggregation of the feed)
    candidates = staging.write(N.new_collision_candidates(staged, now.boroughs, stored["collisions"], repeated), "candidates")
    rejects = N.rejects_of(candidates).unionByName(broken)
    at_once(
        lambda: rejects.write.mode("overwrite").parquet(f"{store.table_path(root, '_rejects')}/load_id={load_id}"),
        lambda: store.write_table("collisions", N.accepted(candidates), root, num_files=num_files))
    bad_ids = candidates.filter(F.size(N.ISSUES_COL) > 0).select("collision_id")

    # 4. children of accepted collisions
    at_once(
        lambda: store.write_table("collision_vehicles", N.new_vehicle_rows(
            staged, now.vehicle_types, stored["collision_vehicles"], bad_ids, repeated, vehicles), root, num_files=num_files),
        lambda: store.write_table("collision_factors", N.new_factor_rows(
            staged, now.factors, stored["collision_factors"], bad_ids, repeated, factors), root, num_files=num_files))

    # 5. the files just written join the index and the rollup (those of a load that died here are indexed by the next one)
    at_once(lambda: key_index.refresh(spark, root), lambda: day_index.refresh(spark, root))
