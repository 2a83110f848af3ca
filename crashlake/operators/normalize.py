"""Wide feed -> six normalised tables (C1-C5 applied, N1-N6).

The reference walks the file row by row and issues one SELECT/INSERT per
value.  Here each table is one set-based job:

* boroughs / vehicle types / factors: distinct cleaned values, new ones get
  ids from the get-or-create operator (operators.ids);
* collisions: one row per id, the first in file order wins;
* vehicles / factors: the five slot columns become rows, blanks are dropped,
  and per (id, slot) the first non-blank value wins - so a slot left blank by
  the first copy of an id is filled by a later copy, as in the reference.

Ids are almost unique, so the wide rows are not shuffled to find that out: a
count per id (one narrow hash aggregate) gives the repeated ids, and only
their rows meet in an aggregate (``min_by`` over the order column - partial on
the map side, so a heavily repeated id is collapsed there).  The rows of all
other ids pass through an anti join with those ids, which Spark broadcasts
while they are few.

Nothing is iterated on the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlake.functions import clean as C
from crashlake.operators.ids import assign_ids, extend_dimension
from crashlake.operators.lookup import lookup_ids
from crashlake.schema import (
    BOROUGH_NAME_MAX, COLLISIONS, COUNT_COLUMNS, FACTOR_COLUMNS, UNSPECIFIED_FACTOR,
    VEHICLE_COLUMNS, ZIP_CODE_MAX,
)
from crashlake.tables import CollisionTables

ORDER_COL = "_order"
ISSUES_COL = "_issues"
CORRUPT_COL, CORRUPT_ISSUE = "_corrupt_record", "corrupt_record"


def clean_feed(raw: DataFrame, order_col: str = ORDER_COL,
               date_formats=C.DATE_FORMATS, time_formats=C.TIME_FORMATS) -> DataFrame:
    """Typed columns, rows without a usable id dropped.

    ``_issues`` lists the rules a row breaks (value present but not storable):
    non-numeric or out-of-range coordinates and counts, negative counts,
    over-long zip or borough.  Dates and times that do not parse are just
    NULL, as in the reference.  Rows that the reader marked as broken are kept
    with that issue, even without an id, for :func:`whole_rows` to part."""
    # step 1: NA spellings -> NULL once per column (later steps reuse the column)
    text = [c for c in raw.columns if c not in (order_col, CORRUPT_COL)]
    corrupt = F.col(CORRUPT_COL).isNotNull() if CORRUPT_COL in raw.columns else F.lit(False)
    nulled = raw.select(*[C.na_to_null(c).alias(c) for c in text], F.col(order_col).alias(ORDER_COL), corrupt.alias("_corrupt"))
    # step 2: typed values
    typed = nulled.select(
        C.parse_id("collision_id").alias("collision_id"),
        C.parse_date("crash_date", date_formats).alias("crash_date"),
        C.parse_time("crash_time", time_formats).alias("crash_time"),
        C.stripped_or_null("borough").alias("borough"),
        C.parse_zip("zip_code").alias("zip_code"),
        C.parse_coordinate("latitude").alias("latitude"),
        C.parse_coordinate("longitude").alias("longitude"),
        "location", "on_street_name", "off_street_name", "cross_street_name",
        *[C.parse_count(c).alias(c) for c in COUNT_COLUMNS],
        *[F.col(c).alias(f"_raw_{c}") for c in ("latitude", "longitude", *COUNT_COLUMNS)],
        *VEHICLE_COLUMNS, *FACTOR_COLUMNS, ORDER_COL, "_corrupt",
    ).filter(F.col("collision_id").isNotNull() | F.col("_corrupt"))
    # step 3: rule violations from the typed values and their raw text
    checks = [
        (F.col("_corrupt"), CORRUPT_ISSUE),
        (C.invalid(F.col("_raw_latitude"), F.col("latitude")), "latitude_invalid"),
        (C.invalid(F.col("_raw_longitude"), F.col("longitude")), "longitude_invalid"),
        (F.length("zip_code") > ZIP_CODE_MAX, "zip_code_too_long"),
        (F.length("borough") > BOROUGH_NAME_MAX, "borough_too_long"),
    ]
    for c in COUNT_COLUMNS:
        checks.append((C.invalid(F.col(f"_raw_{c}"), F.col(c)), f"{c}_invalid"))
        checks.append((F.col(c) < 0, f"{c}_negative"))
    # most rows break no rule: the list, which is not compiled code, is made for the others only
    found = F.array_compact(F.array(*[F.when(cond, F.lit(code)) for cond, code in checks]))
    none = reduce(lambda a, b: a & b, [~F.coalesce(cond, F.lit(False)) for cond, _ in checks])
    issues = F.when(none, F.array().cast("array<string>")).otherwise(found)
    return typed.select(
        "collision_id", "crash_date", "crash_time", "borough", "zip_code", "latitude", "longitude",
        "location", "on_street_name", "off_street_name", "cross_street_name", *COUNT_COLUMNS,
        *VEHICLE_COLUMNS, *FACTOR_COLUMNS, issues.alias(ISSUES_COL), ORDER_COL,
    )


def whole_rows(feed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows read whole, broken rows as rejects: collision_id if it could be read, reason)."""
    broken = F.array_contains(ISSUES_COL, CORRUPT_ISSUE)
    return feed.filter(~broken), feed.filter(broken).select("collision_id", F.lit(CORRUPT_ISSUE).alias("reason"))


def borough_names(feed: DataFrame) -> DataFrame:
    """Distinct trimmed, non-blank borough names (storable length)."""
    return (feed.select(F.col("borough").alias("borough_name"))
            .filter(F.col("borough_name").isNotNull()
                    & (F.length("borough_name") <= BOROUGH_NAME_MAX))
            .distinct())


_RECORD = [f.name for f in COLLISIONS.fields if f.name not in ("collision_id", "borough_id")]


def repeated_ids(feed: DataFrame) -> DataFrame:
    """Ids of more than one row (stage it where several steps need it)."""
    return (feed.groupBy("collision_id").agg(F.count(F.lit(1)).alias("_n"))
            .filter("_n > 1").select("collision_id"))


def _once_and_again(rows: DataFrame, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ids that occur once, rows of repeated ids)."""
    return rows.join(repeated, "collision_id", "left_anti"), rows.join(repeated, "collision_id", "left_semi")


def first_records(feed: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """One row per collision id: the first in file order (all its fields,
    NULLs included), plus its borough name and issues."""
    columns = [*_RECORD, "borough", ISSUES_COL]
    once, again = _once_and_again(feed, repeated if repeated is not None else repeated_ids(feed))
    first = again.groupBy("collision_id").agg(F.min_by(F.struct(*columns), F.col(ORDER_COL)).alias("_r"))
    return once.select("collision_id", *columns).unionByName(first.select("collision_id", "_r.*"))


def collisions_table(feed: DataFrame, boroughs: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    """Collisions rows with borough ids looked up by (trimmed) name;
    an unknown name gives a NULL id.  Keeps ``borough`` and ``_issues`` for
    the caller; ``collision_columns`` projects the table."""
    return lookup_ids(first_records(feed, repeated), boroughs.select(F.col("borough_name").alias("borough"), "borough_id"),
                      "borough", "borough_id", ["collision_id"], keep_unmatched=True)


def collision_columns(df: DataFrame) -> DataFrame:
    return df.select(*[F.col(f.name).cast(f.dataType) for f in COLLISIONS.fields])


def _slots_long(feed: DataFrame, columns, slot_col: str, value_col: str) -> DataFrame:
    """Five slot columns -> (collision_id, slot, value, order), blanks dropped."""
    slots = F.array(*[F.struct(F.lit(i).alias(slot_col), F.col(c).alias("_raw"))
                      for i, c in enumerate(columns, start=1)])
    return (feed.select("collision_id", ORDER_COL, F.inline(slots))
            .select("collision_id", slot_col, C.stripped_or_null("_raw").alias(value_col), ORDER_COL)
            .filter(F.col(value_col).isNotNull()))


def _first_per_slot(values: DataFrame, repeated: DataFrame, slot_col: str, value_col: str) -> DataFrame:
    once, again = _once_and_again(values, repeated)
    first = again.groupBy("collision_id", slot_col).agg(F.min_by(value_col, F.col(ORDER_COL)).alias(value_col))
    return once.select("collision_id", slot_col, value_col).unionByName(first)


def vehicle_values(feed: DataFrame) -> DataFrame:
    """Every non-blank vehicle value of every row (losing duplicates too:
    the reference creates the type before its slot insert is skipped)."""
    return _slots_long(feed, VEHICLE_COLUMNS, "vehicle_order", "vehicle_type_desc")


def factor_values(feed: DataFrame) -> DataFrame:
    return _slots_long(feed, FACTOR_COLUMNS, "factor_order", "factor_desc").filter(
        F.upper("factor_desc") != F.lit(UNSPECIFIED_FACTOR))


def vehicles_long(feed: DataFrame, repeated: DataFrame | None = None, values: DataFrame | None = None) -> DataFrame:
    """(collision_id, vehicle_order, vehicle_type_desc), first non-blank
    value per slot.  Case is kept: 'Sedan' and 'SEDAN' are two types.
    ``repeated`` and ``values``: repeated_ids and vehicle_values of the feed, if staged."""
    ids = repeated if repeated is not None else repeated_ids(feed)
    return _first_per_slot(values if values is not None else vehicle_values(feed), ids, "vehicle_order", "vehicle_type_desc")


def factors_long(feed: DataFrame, repeated: DataFrame | None = None, values: DataFrame | None = None) -> DataFrame:
    """As N3 for factors, without 'Unspecified' in any case."""
    ids = repeated if repeated is not None else repeated_ids(feed)
    return _first_per_slot(values if values is not None else factor_values(feed), ids, "factor_order", "factor_desc")


@dataclass(frozen=True)
class LoadResult:
    """New rows per table (what an append must add) and rejected collisions."""
    new: CollisionTables
    rejects: DataFrame          # collision_id, reason
    dims: CollisionTables       # full dimension tables after the load (fact fields = new rows)


def _anti(df: DataFrame, existing: DataFrame | None, keys: list[str]) -> DataFrame:
    return df if existing is None else df.join(existing.select(*keys), keys, "left_anti")


def new_collision_candidates(feed: DataFrame, boroughs: DataFrame,
                             existing: DataFrame | None = None, repeated: DataFrame | None = None) -> DataFrame:
    """First-wins collision rows whose id is not stored yet, with borough ids
    and ``_issues`` (insert-if-absent: a stored row always wins)."""
    return _anti(collisions_table(feed, boroughs, repeated), existing, ["collision_id"])


def rejects_of(candidates: DataFrame) -> DataFrame:
    """(collision_id, reason) for candidates that break a table rule."""
    return candidates.filter(F.size(ISSUES_COL) > 0).select(
        "collision_id", F.explode(ISSUES_COL).alias("reason"))


def accepted(candidates: DataFrame) -> DataFrame:
    return collision_columns(candidates.filter(F.size(ISSUES_COL) == 0))


def new_vehicle_rows(feed: DataFrame, vehicle_types: DataFrame, existing: DataFrame | None = None,
                     rejected_ids: DataFrame | None = None, repeated: DataFrame | None = None,
                     values: DataFrame | None = None) -> DataFrame:
    """collision_vehicles rows to insert: first value per new (id, slot),
    not belonging to a rejected collision, with the type id."""
    rows = _anti(vehicles_long(feed, repeated, values), existing, ["collision_id", "vehicle_order"])
    rows = _anti(rows, rejected_ids, ["collision_id"])
    return lookup_ids(rows, vehicle_types, "vehicle_type_desc", "vehicle_type_id",
                      ["collision_id", "vehicle_order"]).select(
        "collision_id", F.col("vehicle_order").cast("int"), "vehicle_type_id")


def new_factor_rows(feed: DataFrame, factors: DataFrame, existing: DataFrame | None = None,
                    rejected_ids: DataFrame | None = None, repeated: DataFrame | None = None,
                    values: DataFrame | None = None) -> DataFrame:
    rows = _anti(factors_long(feed, repeated, values), existing, ["collision_id", "factor_order"])
    rows = _anti(rows, rejected_ids, ["collision_id"])
    return lookup_ids(rows, factors, "factor_desc", "factor_id",
                      ["collision_id", "factor_order"]).select(
        "collision_id", F.col("factor_order").cast("int"), "factor_id")


def dimensions(feed: DataFrame, existing: CollisionTables | None = None):
    """(boroughs, vehicle_types, factors): existing rows plus new values."""
    ex = existing
    return (
        extend_dimension(ex and ex.boroughs, borough_names(feed), "borough_name", "borough_id"),
        extend_dimension(ex and ex.vehicle_types, vehicle_values(feed), "vehicle_type_desc", "vehicle_type_id"),
        extend_dimension(ex and ex.factors, factor_values(feed), "factor_desc", "factor_id"),
    )


def new_dimension_rows(feed: DataFrame, existing: CollisionTables, vehicles: DataFrame, factors: DataFrame) -> dict[str, DataFrame]:
    """Per dimension the rows that ``existing`` lacks; ``vehicles`` and ``factors``:
    vehicle_values and factor_values of the feed."""
    return {
        "boroughs": assign_ids(borough_names(feed), ["borough_name"], "borough_id", existing.boroughs),
        "vehicle_types": assign_ids(vehicles.select("vehicle_type_desc"), ["vehicle_type_desc"], "vehicle_type_id", existing.vehicle_types),
        "factors": assign_ids(factors.select("factor_desc"), ["factor_desc"], "factor_id", existing.factors),
    }


def normalize_feed(feed: DataFrame, existing: CollisionTables | None = None, mode: str = "quarantine",
                   write: Callable[[DataFrame, str], DataFrame] | None = None) -> LoadResult:
    """The whole load in dependency order - boroughs, collisions,
    vehicles, factors - against the tables already stored (``existing``).

    Only keys not yet stored are produced (insert-if-absent), so running the
    same feed twice adds nothing.  ``mode='quarantine'`` diverts collisions
    that break a table rule (and their vehicle/factor rows) to ``rejects``;
    ``mode='fail'`` raises instead, like the reference's aborted transaction.
    ``write`` (a frame and a label) stages what several of the tables are made of.
    (plans.load runs the same steps against a store, materialising each
    table before the next one reads it.)"""
    if mode not in ("quarantine", "fail"):
        raise ValueError("mode must be 'quarantine' or 'fail'")
    ex = existing
    write = write or (lambda df, label: df)
    repeated = write(repeated_ids(feed), "repeated")
    vehicle_texts, factor_texts = write(vehicle_values(feed), "vehicle-values"), write(factor_values(feed), "factor-values")
    boroughs = write(extend_dimension(ex and ex.boroughs, borough_names(feed), "borough_name", "borough_id"), "boroughs")
    vehicle_types = write(extend_dimension(ex and ex.vehicle_types, vehicle_texts, "vehicle_type_desc", "vehicle_type_id"), "vehicle-types")
    factors = write(extend_dimension(ex and ex.factors, factor_texts, "factor_desc", "factor_id"), "factors")
    candidates = write(new_collision_candidates(feed, boroughs, ex and ex.collisions, repeated), "candidates")
    rejects = rejects_of(candidates)
    if mode == "fail":
        raise_on_rejects(rejects_of(feed))
    bad_ids = candidates.filter(F.size(ISSUES_COL) > 0).select("collision_id")
    collisions = accepted(candidates)
    vehicles = new_vehicle_rows(feed, vehicle_types, ex and ex.collision_vehicles, bad_ids, repeated, vehicle_texts)
    factor_rows = new_factor_rows(feed, factors, ex and ex.collision_factors, bad_ids, repeated, factor_texts)

    def only_new(dim: DataFrame, old: DataFrame | None, key: str) -> DataFrame:
        return _anti(dim, old, [key])

    new = CollisionTables(
        boroughs=only_new(boroughs, ex and ex.boroughs, "borough_id"),
        collisions=collisions,
        vehicle_types=only_new(vehicle_types, ex and ex.vehicle_types, "vehicle_type_id"),
        collision_vehicles=vehicles,
        factors=only_new(factors, ex and ex.factors, "factor_id"),
        collision_factors=factor_rows,
    )
    dims = CollisionTables(boroughs=boroughs, collisions=collisions, vehicle_types=vehicle_types,
                           collision_vehicles=vehicles, factors=factors, collision_factors=factor_rows)
    return LoadResult(new=new, rejects=rejects, dims=dims)


def raise_on_rejects(rejects: DataFrame) -> None:
    """'fail' mode: stop at the first rule violation (a bounded look)."""
    sample = [r.asDict() for r in rejects.limit(5).collect()]
    if sample:
        raise ValueError(f"feed breaks table rules, e.g. {sample}")
