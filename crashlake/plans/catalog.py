"""Query catalog: name -> callable(spark, sf_dir) -> DataFrame.

Each callable derives the collision tables from the driver parquet files
(sources.fixtures) and runs one operator over them, lazily; nothing is
collected."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from crashlake.operators import dashboard as D
from crashlake.operators import normalize as N
from crashlake.operators import quality as K
from crashlake.operators import rankings
from crashlake.operators import rollup as U
from crashlake.operators import star as T
from crashlake.operators.lookup import lookup_ids
from crashlake.plans import params as P
from crashlake.plans.load import load_feed
from crashlake.schema import COUNT_COLUMNS, FEED_COLUMNS
from crashlake.session import ensure_checkpoint_dir, shuffles_end, small_methods
from crashlake.sources import day_index, key_index, rewrites, store
from crashlake.sources.feed import read_feed
from crashlake.sources.fixtures import fixture_tables, fx_raw
from crashlake.tables import CollisionTables

Query = Callable[[SparkSession, str], DataFrame]


def _on_tables(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(fixture_tables(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/crashlake-{name}-{uuid.uuid4().hex}"


def _staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once and read back: what several steps of a query read."""
    path = _scratch(df.sparkSession, name)
    with small_methods(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _staged_only(*labels: str):
    """Stages frames of these labels and leaves others, which are read once or never."""
    return lambda df, label: _staged(df, label) if label in labels else df


def _on_feed(fn) -> Query:
    """A query over the cleaned feed, which is staged as the load does."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_staged(N.clean_feed(fx_raw(spark, sf_dir), order_col="src_seq"), "feed"))
    run.__doc__ = fn.__doc__
    return run


def _clean_view(feed: DataFrame) -> DataFrame:
    return feed.select(
        "collision_id", F.col(N.ORDER_COL).alias("src_seq"), "crash_date", "crash_time", "borough",
        "zip_code", "latitude", "longitude", "off_street_name", *COUNT_COLUMNS,
        F.array_join(N.ISSUES_COL, ",").alias("issues"))


def _collisions_view(feed: DataFrame) -> DataFrame:
    boroughs = N.extend_dimension(None, N.borough_names(feed), "borough_name", "borough_id")
    rows = N.collisions_table(feed, boroughs).join(boroughs, "borough_id", "left")
    return rows.select(
        "collision_id", "crash_date", "crash_time", "borough_name", "zip_code", "latitude",
        "longitude", "on_street_name", "cross_street_name", "off_street_name", *COUNT_COLUMNS,
        F.array_join(N.ISSUES_COL, ",").alias("issues"))


def _dimension_ids(feed: DataFrame) -> DataFrame:
    """Ids are dense and unique: per dimension, rows = distinct ids = max id, min id = 1."""
    dims = {
        "boroughs": N.extend_dimension(None, N.borough_names(feed), "borough_name", "borough_id")
        .select(F.col("borough_id").alias("id")),
        "vehicle_types": N.extend_dimension(None, N.vehicle_values(feed), "vehicle_type_desc",
                                            "vehicle_type_id").select(F.col("vehicle_type_id").alias("id")),
        "factors": N.extend_dimension(None, N.factor_values(feed), "factor_desc", "factor_id")
        .select(F.col("factor_id").alias("id")),
    }
    out = None
    for name, d in dims.items():
        row = d.agg(F.lit(name).alias("dimension"), F.count(F.lit(1)).alias("n_rows"),
                    F.countDistinct("id").alias("n_ids"), F.min("id").cast("bigint").alias("min_id"),
                    F.max("id").cast("bigint").alias("max_id"))
        out = row if out is None else out.unionByName(row)
    return out


def _load_summary(feed: DataFrame) -> DataFrame:
    res = N.normalize_feed(feed, write=_staged)
    parts = [df.agg(F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"))
             for name, df in res.new.items()]
    parts.append(res.rejects.agg(F.lit("rejects").alias("table_name"), F.count(F.lit(1)).alias("n_rows")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _load_vehicles_named(feed: DataFrame) -> DataFrame:
    res = N.normalize_feed(feed, write=_staged_only("repeated", "vehicle-values", "vehicle-types"))
    return (res.new.collision_vehicles.join(res.dims.vehicle_types, "vehicle_type_id")
            .select("collision_id", "vehicle_order", "vehicle_type_desc"))


def _load_collisions(feed: DataFrame) -> DataFrame:
    res = N.normalize_feed(feed)
    return res.new.collisions.join(res.dims.boroughs, "borough_id", "left").drop("borough_id")


def _load_factors_named(feed: DataFrame) -> DataFrame:
    res = N.normalize_feed(feed, write=_staged_only("repeated", "factor-values", "factors"))
    return (res.new.collision_factors.join(res.dims.factors, "factor_id")
            .select("collision_id", "factor_order", "factor_desc"))


def _unchecked(feed: DataFrame):
    """Tables straight from the cleaned feed with nothing deduplicated or
    quarantined: what the integrity checks are meant to catch."""
    vehicles, factors = _staged(N.vehicle_values(feed), "vehicle-values"), _staged(N.factor_values(feed), "factor-values")
    boroughs = _staged(N.extend_dimension(None, N.borough_names(feed), "borough_name", "borough_id"), "dimension")
    vt = _staged(N.extend_dimension(None, vehicles, "vehicle_type_desc", "vehicle_type_id"), "dimension")
    fd = _staged(N.extend_dimension(None, factors, "factor_desc", "factor_id"), "dimension")
    collisions = N.collision_columns(feed.join(
        boroughs.select(F.col("borough_name").alias("borough"), "borough_id"), "borough", "left"))
    return CollisionTables(
        boroughs=boroughs, collisions=collisions, vehicle_types=vt,
        collision_vehicles=lookup_ids(vehicles, vt, "vehicle_type_desc", "vehicle_type_id",
                                      ["collision_id", "vehicle_order", N.ORDER_COL])
        .select("collision_id", "vehicle_order", "vehicle_type_id"),
        factors=fd,
        collision_factors=lookup_ids(factors, fd, "factor_desc", "factor_id",
                                     ["collision_id", "factor_order", N.ORDER_COL])
        .select("collision_id", "factor_order", "factor_id"))


def _stored(t: CollisionTables) -> CollisionTables:
    """The tables written once each, as a report reads them."""
    return CollisionTables(**{name: _staged(df, name) for name, df in t.items()})


def _stored_fixture(spark: SparkSession, sf_dir: str) -> CollisionTables:
    """The clean tables written once each; the lines that four of them are made of are placed once."""
    return _stored(fixture_tables(spark, sf_dir, _staged))


def _on_stored_tables(fn) -> Query:
    """A query that reads the clean tables many times."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(_stored_fixture(spark, sf_dir))
    run.__doc__ = fn.__doc__
    return run


def _planted(t: CollisionTables) -> CollisionTables:
    """The clean tables with a violation of every kind of rule."""
    def where(n: int, yes: str, no: str):
        return F.expr(f"CASE WHEN collision_id % {n} = 0 THEN {yes} ELSE {no} END")

    again = t.collision_factors.filter("collision_id % 547 = 0")
    return CollisionTables(
        boroughs=t.boroughs.withColumn("borough_name", F.expr("CASE WHEN borough_id = 1 THEN repeat(borough_name, 20) ELSE borough_name END")),
        collisions=t.collisions.withColumn("zip_code", where(503, "repeat('9', 11)", "zip_code"))
        .withColumn("number_of_persons_injured", where(509, "-1", "number_of_persons_injured"))
        .withColumn("collision_id", where(499, "CAST(NULL AS BIGINT)", "collision_id")),
        vehicle_types=t.vehicle_types,
        collision_vehicles=t.collision_vehicles.withColumn("vehicle_order", where(521, "vehicle_order + 5", "vehicle_order"))
        .withColumn("vehicle_type_id", where(523, "CAST(NULL AS INT)", "vehicle_type_id"))
        .withColumn("collision_id", where(541, f"collision_id + {2**50}", "collision_id")),
        factors=t.factors, collision_factors=t.collision_factors.unionByName(again))


def _gone(t) -> DataFrame:
    return t.collisions.filter(F.col("crash_date") < F.lit(P.DELETE_BEFORE).cast("date"))


def _keys_of(kept) -> DataFrame:
    slots = {"collisions": F.lit(0), "collision_vehicles": F.col("vehicle_order"), "collision_factors": F.col("factor_order")}
    return reduce(DataFrame.unionByName, [
        getattr(kept, name).select(F.lit(name).alias("table_name"), "collision_id", slot.cast("int").alias("slot"))
        for name, slot in slots.items()])


def _filled(spark: SparkSession, sf_dir: str, loads: int = 1) -> str:
    """A store of the clean tables, written and indexed in some loads that share out the collisions."""
    root, t = _scratch(spark, "store"), _stored_fixture(spark, sf_dir)
    for k in range(loads):
        for name, df in t.items():
            if name in store.FACT_TABLES:
                store.write_table(name, df.filter(F.pmod("collision_id", F.lit(loads)) == k), root)
            elif k == 0:
                store.write_table(name, df, root)
        key_index.refresh(spark, root)
    return root


def _deleted_in_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """K5 over a store: only the files that hold a deleted collision are written anew."""
    root = _filled(spark, sf_dir)
    rewrites.delete_collisions(spark, root, _gone(store.read_tables(spark, root)))
    return _keys_of(store.read_tables(spark, root))


def _compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q2 over a store whose small files were merged."""
    root = _filled(spark, sf_dir, loads=4)
    rewrites.compact(spark, root)
    return rankings.factor_fatality_rank(store.read_tables(spark, root))


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D5 of a borough over a store whose tables lie along a curve through the columns it filters by."""
    root = _filled(spark, sf_dir)
    for name in store.FACT_TABLES:
        rewrites.cluster(spark, root, name, target_bytes=1 << 20)
    return D.top_factors(store.read_tables(spark, root), P.DASH_START, P.DASH_END, P.DASH_BOROUGH, 5)


def _located(t, facts: DataFrame, locations: DataFrame | None = None) -> DataFrame:
    """Facts with the natural columns of their location in place of its key."""
    locations = locations if locations is not None else T.dim_location(T.stg_tables(t).collisions)
    return facts.join(locations, "location_key", "left").drop("location_key")


def _star_fact(t) -> DataFrame:
    locations = _staged(T.dim_location(T.stg_tables(t).collisions, with_counts=True), "locations")
    return _located(t, T.fact_collisions(t, locations), locations.drop("n_collisions"))


def _star_child(t, kind: str) -> DataFrame:
    fact = T.fact_collisions(t)
    if kind == "vehicles":
        rows = T.fact_collision_vehicles(t, fact).join(T.dim_vehicle(t), "vehicle_key").drop("vehicle_key")
    else:
        rows = T.fact_collision_factors(t, fact).join(T.dim_factor(t), "factor_key").drop("factor_key")
    return _located(t, rows)


def quoted_feed(spark: SparkSession, sf_dir: str, write: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """The dirty feed with commas, quotes and line ends inside a street name."""
    street = F.expr("CASE WHEN src_seq % 3 = 0 THEN concat(on_street_name, ' \"A\", \"\"') "
                    "WHEN src_seq % 3 = 1 THEN concat(on_street_name, ',\n', on_street_name) ELSE on_street_name END")
    return fx_raw(spark, sf_dir, write).withColumn("on_street_name", street)


def _read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quoted feed written as two CSV folders of different column order, and read as one feed."""
    feed, paths = _staged(quoted_feed(spark, sf_dir).select("src_seq", *FEED_COLUMNS), "quoted"), []
    for half, columns in enumerate((FEED_COLUMNS, FEED_COLUMNS[::-1])):
        paths.append(_scratch(spark, "feed"))
        writer = feed.filter(F.col("src_seq") % 2 == half).select(*columns).write.option("header", True)
        writer.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(paths[-1])
    return read_feed(spark, paths).select(*FEED_COLUMNS, F.col("_corrupt_record").isNotNull().alias("broken"))


def _one_partition(feed: DataFrame, write: Callable[[DataFrame, str], DataFrame] = _staged) -> DataFrame:
    """The rows in one partition, to be written as one file: made by many tasks and staged,
    so that the single task holds no sort or join, only the rows that pass through it."""
    return write(feed, "quoted").coalesce(1)


def _read_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quoted feed written as one CSV file, which is read by many tasks.  What was
    staged to make the file is removed once it is written."""
    path, staging = _scratch(spark, "feed"), store.Staging(spark, _scratch(spark, "made"), "quoted")

    def write(df: DataFrame, label: str) -> DataFrame:
        with small_methods(spark), shuffles_end(spark):
            return staging.write(df, label)
    try:
        writer = _one_partition(quoted_feed(spark, sf_dir, write).select(*FEED_COLUMNS), write).write.option("header", True)
        writer.options(escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    finally:
        staging.close()
    return read_feed(spark, path).select(*FEED_COLUMNS, F.col("_corrupt_record").isNotNull().alias("broken"))


def _append_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feed's first rows loaded, loaded again, then the whole feed; what the store holds."""
    root, feed = _scratch(spark, "store"), _staged(fx_raw(spark, sf_dir), "raw")
    first = feed.filter(F.col("src_seq") < P.S2_FIRST_BATCH)
    for rows, load_id in ((first, "first"), (first, "first"), (feed, "whole")):
        load_feed(spark, rows, root, order_col="src_seq", load_id=load_id)
    t = store.read_tables(spark, root)
    rejects = spark.read.parquet(f"{root}/_rejects/load_id=whole")
    shape = ["table_name", "collision_id", "slot", "value"]
    parts = [
        t.collisions.select(F.lit("collisions"), "collision_id", F.lit(0), F.col("crash_date").cast("string")),
        t.collision_vehicles.join(t.vehicle_types, "vehicle_type_id").select(F.lit("collision_vehicles"), "collision_id", "vehicle_order", "vehicle_type_desc"),
        t.collision_factors.join(t.factors, "factor_id").select(F.lit("collision_factors"), "collision_id", "factor_order", "factor_desc"),
        rejects.select(F.lit("rejects"), "collision_id", F.lit(0), "reason")]
    return reduce(DataFrame.union, parts).toDF(*shape)


def _indexed_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D7 over a store: the bounds kept for its files."""
    root = _scratch(spark, "store")
    store.write_table("collisions", fixture_tables(spark, sf_dir).collisions, root)
    key_index.refresh(spark, root)
    return key_index.date_bounds(spark, root)


def _on_rollup(fn) -> Query:
    """D1-D4 over the daily rollup of a store written in two loads."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        root, t = _scratch(spark, "store"), fixture_tables(spark, sf_dir)
        for half in (0, 1):
            store.write_table("collisions", t.collisions.filter(F.col("collision_id") % 2 == half), root)
            day_index.refresh(spark, root)
        return fn(day_index.daily(spark, root, P.DASH_START, P.DASH_END), t.boroughs)
    return run


def _touched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored rows that an old and a new stretch of ids can conflict with, and no others."""
    root, t = _scratch(spark, "store"), fixture_tables(spark, sf_dir)
    store.write_table("collision_factors", t.collision_factors, root, num_files=16)
    key_index.refresh(spark, root)
    ends = t.collisions.agg(F.min("collision_id").alias("lo"), F.max("collision_id").alias("hi"))
    ids = ends.select(F.explode(F.array(F.col("lo"), F.col("lo") + 1, F.col("hi"), F.col("hi") + 1)).alias("collision_id"))
    return key_index.near(spark, root, "collision_factors", ids).join(ids, "collision_id", "left_semi").select("collision_id", "factor_order")


def _create_and_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: six empty tables with their declared columns, then filled from the clean ones."""
    root = _scratch(spark, "store")
    store.create_tables(spark, root)
    empty = {name: df.count() for name, df in store.read_tables(spark, root).items()}
    store.append_new(fixture_tables(spark, sf_dir), root)
    rows = [df.agg(F.lit(name).alias("table_name"), F.lit(empty[name]).cast("bigint").alias("n_before"), F.count(F.lit(1)).alias("n_rows"))
            for name, df in store.read_tables(spark, root).items()]
    return reduce(DataFrame.unionByName, rows)


def _export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest collisions written as CSV with a header and read again."""
    latest, path = D.latest_collisions(fixture_tables(spark, sf_dir), P.DASH_START, P.DASH_END), _scratch(spark, "export")
    store.export_csv(latest, path)
    return spark.read.schema(latest.schema).option("header", True).csv(path)


def _bucketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables stored in buckets of the collision id, and Q2 over them."""
    database = f"crashlake_{uuid.uuid4().hex}"
    store.write_bucketed(spark, fixture_tables(spark, sf_dir), database, 8)
    return rankings.factor_fatality_rank(store.read_bucketed(spark, database))


def _location_keys(t) -> DataFrame:
    d = T.dim_location(T.stg_tables(t).collisions)
    return d.agg(F.count(F.lit(1)).alias("n_rows"), F.countDistinct("location_key").alias("n_ids"),
                 F.min("location_key").alias("min_id"), F.max("location_key").alias("max_id"))


QUERIES: dict[str, Query] = {
    "q1_street_severity_rank": _on_tables(
        lambda t: rankings.street_severity_rank(t, P.Q1_FROM, P.Q1_TO, 10)),
    "q2_factor_fatality_rank": _on_tables(rankings.factor_fatality_rank),
    "q3_vehicle_severity_rank": _on_tables(rankings.vehicle_severity_rank),
    "d1_kpi_summary_all": _on_tables(
        lambda t: D.kpi_summary(t, P.DASH_START, P.DASH_END, "All")),
    "d1_kpi_summary_borough": _on_tables(
        lambda t: D.kpi_summary(t, P.DASH_START, P.DASH_END, P.DASH_BOROUGH)),
    "d1_kpi_summary_empty": _on_tables(
        lambda t: D.kpi_summary(t, "1990-01-01", "1990-12-31", "All")),
    "d2_daily_trend": _on_tables(
        lambda t: D.daily_trend(t, P.DASH_START, P.DASH_END, "All")),
    "d2_daily_trend_borough": _on_tables(
        lambda t: D.daily_trend(t, P.DASH_START, P.DASH_END, P.DASH_BOROUGH)),
    "d3_trend_metric": _on_tables(
        lambda t: D.trend_metric(t, P.DASH_START, P.DASH_END, P.DASH_BOROUGH, "Persons Injured")),
    "d4_crashes_by_borough": _on_tables(
        lambda t: D.crashes_by_borough(t, P.DASH_START, P.DASH_END)),
    "d5_top_factors": _on_tables(
        lambda t: D.top_factors(t, P.DASH_START, P.DASH_END, "All", P.TOP_N)),
    "d5_top_factors_borough": _on_tables(
        lambda t: D.top_factors(t, P.DASH_START, P.DASH_END, P.DASH_BOROUGH, 5)),
    "d6_latest_collisions": _on_tables(
        lambda t: D.latest_collisions(t, P.DASH_START, P.DASH_END, "All")),
    "d6_latest_collisions_borough": _on_tables(
        lambda t: D.latest_collisions(t, P.DASH_START, P.DASH_END, P.DASH_BOROUGH)),
    "d1_kpi_summary_rollup": _on_rollup(lambda days, b: U.kpi_summary(days, b, P.DASH_START, P.DASH_END, P.DASH_BOROUGH)),
    "d2_daily_trend_rollup": _on_rollup(lambda days, b: U.daily_trend(days, b, P.DASH_START, P.DASH_END)),
    "d3_trend_metric_rollup": _on_rollup(lambda days, b: U.trend_metric(days, b, P.DASH_START, P.DASH_END, P.DASH_BOROUGH, "Persons Injured")),
    "d4_crashes_by_borough_rollup": _on_rollup(lambda days, b: U.crashes_by_borough(days, b, P.DASH_START, P.DASH_END)),
    "d7_date_bounds": _on_tables(D.date_bounds),
    "d7_date_bounds_indexed": _indexed_bounds,
    "d8_borough_list": _on_tables(D.borough_list),
    "d9_default_window": _on_tables(D.default_window),
    "d9_default_window_chosen_start": _on_tables(lambda t: D.default_window(t, P.D9_END, start=P.D9_START)),
    "d9_default_window_chosen_end": _on_tables(lambda t: D.default_window(t, P.D9_END)),
    "s1_read_feed": _read_back,
    "s1_read_one_file": _read_one,
    "s2_append_new": _append_new,
    "s2_touched_rows": _touched_rows,
    "s3_create_tables": _create_and_fill,
    "s4_export_csv": _export,
    "s6_layout": _bucketed,
    "s6_compacted": _compacted,
    "s6_clustered": _clustered,
    "s5_run_sql": lambda spark, sf_dir: D.run_sql(
        spark, fixture_tables(spark, sf_dir),
        "SELECT b.borough_name, count(*) AS crashes FROM collisions c "
        "JOIN boroughs b ON c.borough_id = b.borough_id "
        "WHERE c.crash_date BETWEEN :start AND :end GROUP BY b.borough_name",
        {"start": dt.date.fromisoformat(P.DASH_START), "end": dt.date.fromisoformat(P.DASH_END)}),
    "c1_c5_clean_feed": _on_feed(_clean_view),
    "n1_borough_names": _on_feed(N.borough_names),
    "n2_collisions_table": _on_feed(_collisions_view),
    "n3_vehicles_long": _on_feed(N.vehicles_long),
    "n4_factors_long": _on_feed(N.factors_long),
    "n5_vehicle_types": _on_feed(lambda f: N.extend_dimension(
        None, N.vehicle_values(f), "vehicle_type_desc", "vehicle_type_id").select("vehicle_type_desc")),
    "n5_dimension_ids": _on_feed(_dimension_ids),
    "n6_normalize_feed": _on_feed(_load_summary),
    "n6_rejects": _on_feed(lambda f: N.normalize_feed(f).rejects),
    "n6_collision_vehicles": _on_feed(_load_vehicles_named),
    "n6_collisions": _on_feed(_load_collisions),
    "n6_collision_factors": _on_feed(_load_factors_named),
    "k1_k4_validate_planted": lambda spark, sf_dir: K.validate(_stored(_planted(fixture_tables(spark, sf_dir, _staged)))),
    "k1_k4_validate_raw": _on_feed(lambda f: K.validate(_stored(_unchecked(f)))),
    "k1_k4_validate_fixture": _on_stored_tables(K.validate),
    "k5_delete_cascade": _on_tables(lambda t: _keys_of(K.delete_cascade(t, _gone(t)))),
    "k5_delete_cascade_store": _deleted_in_store,
    "t1_dim_date": _on_tables(lambda t: T.dim_date(t.collisions)),
    "t2_dim_borough": _on_tables(T.dim_borough),
    "t3_dim_location": _on_tables(
        lambda t: T.dim_location(T.stg_tables(t).collisions).select(*T.LOCATION_COLUMNS)),
    "t3_location_keys": _on_tables(_location_keys),
    "t4_dim_vehicle": _on_tables(lambda t: T.dim_vehicle(t).select("vehicle_type_desc")),
    "t5_dim_factor": _on_tables(lambda t: T.dim_factor(t).select("factor_desc")),
    "t6_stg_collisions": _on_tables(lambda t: T.stg_tables(t).collisions),
    "t6_stg_vehicles": _on_tables(lambda t: T.stg_tables(t).collision_vehicles.join(t.vehicle_types, "vehicle_type_id").drop("vehicle_type_id")),
    "t6_stg_factors": _on_tables(lambda t: T.stg_tables(t).collision_factors.join(t.factors, "factor_id").drop("factor_id")),
    "t6_stg_boroughs": _on_tables(lambda t: T.stg_tables(t).boroughs),
    "t7_fact_collisions": _on_stored_tables(_star_fact),
    "t7_fact_grain": _on_tables(lambda t: T.fact_grain_check(T.fact_collisions(t), t.collisions)),
    "t8_fact_collision_vehicles": _on_tables(lambda t: _star_child(t, "vehicles")),
    "t8_fact_collision_factors": _on_tables(lambda t: _star_child(t, "factors")),
}
