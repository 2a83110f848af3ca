"""Integrity checks K1-K5: the table contracts as data-quality jobs.

Every check returns violations in one shape:
    table_name, rule, key (text), n_rows (bigint)
so the checks union into one report.  Nothing is collected; an empty report
means the tables satisfy the contract.

Key-based checks aggregate before they join: duplicate keys are found with a
grouped count (partial on the map side), and a foreign-key check counts rows
per referenced value first, so one value that a third of the child rows
points at is a single row by the time it meets the parent table.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from crashlake.schema import BOROUGH_NAME_MAX, COUNT_COLUMNS, SLOTS, ZIP_CODE_MAX
from crashlake.tables import CollisionTables

UNIQUE_KEYS = (
    ("boroughs", ("borough_id",)),
    ("boroughs", ("borough_name",)),
    ("collisions", ("collision_id",)),
    ("vehicle_types", ("vehicle_type_id",)),
    ("vehicle_types", ("vehicle_type_desc",)),
    ("collision_vehicles", ("collision_id", "vehicle_order")),
    ("factors", ("factor_id",)),
    ("factors", ("factor_desc",)),
    ("collision_factors", ("collision_id", "factor_order")),
)

NOT_NULL = (
    ("boroughs", ("borough_id",), "borough_id"),
    ("boroughs", ("borough_id",), "borough_name"),
    ("collisions", ("collision_id",), "collision_id"),
    ("vehicle_types", ("vehicle_type_id",), "vehicle_type_id"),
    ("vehicle_types", ("vehicle_type_id",), "vehicle_type_desc"),
    ("collision_vehicles", ("collision_id", "vehicle_order"), "collision_id"),
    ("collision_vehicles", ("collision_id", "vehicle_order"), "vehicle_order"),
    ("collision_vehicles", ("collision_id", "vehicle_order"), "vehicle_type_id"),
    ("factors", ("factor_id",), "factor_id"),
    ("factors", ("factor_id",), "factor_desc"),
    ("collision_factors", ("collision_id", "factor_order"), "collision_id"),
    ("collision_factors", ("collision_id", "factor_order"), "factor_order"),
    ("collision_factors", ("collision_id", "factor_order"), "factor_id"),
)

FOREIGN_KEYS = (
    ("collisions", "borough_id", "boroughs", "borough_id"),
    ("collision_vehicles", "collision_id", "collisions", "collision_id"),
    ("collision_vehicles", "vehicle_type_id", "vehicle_types", "vehicle_type_id"),
    ("collision_factors", "collision_id", "collisions", "collision_id"),
    ("collision_factors", "factor_id", "factors", "factor_id"),
)


def _key_text(cols) -> F.Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("<null>")) for c in cols])


def _union(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def _shape(df: DataFrame, table: str, rule: F.Column | str, key: F.Column, n: F.Column) -> DataFrame:
    rule = F.lit(rule) if isinstance(rule, str) else rule
    return df.select(F.lit(table).alias("table_name"), rule.alias("rule"),
                     key.alias("key"), n.cast("bigint").alias("n_rows"))


def _row_rules(df: DataFrame, table: str, keys, rules) -> DataFrame:
    """Row-level rules of one table in a single pass: rows breaking any rule
    are selected once (the OR of the rules is pushed to the scan) and emit
    one violation per rule they break."""
    conds = [F.coalesce(cond, F.lit(False)) for cond, _ in rules]
    labels = F.array_compact(F.array(*[F.when(c, F.lit(r)) for c, (_, r) in zip(conds, rules)]))
    return (df.filter(reduce(lambda a, b: a | b, conds))
            .select(F.lit(table).alias("table_name"), F.explode(labels).alias("rule"),
                    _key_text(keys).alias("key"), F.lit(1).cast("bigint").alias("n_rows")))


def _null_rules() -> dict[str, list]:
    rules: dict[str, list] = {}
    for table, _, col in NOT_NULL:
        rules.setdefault(table, []).append((F.col(col).isNull(), f"not_null({col})"))
    return rules


def _range_rules() -> dict[str, list]:
    """K4: counts >= 0, slots 1..5, text lengths.  (Coordinates are decimal(9,6)
    columns, which cannot hold a value out of range; the cleaning step rejects
    such text.)"""
    slots = [("collision_vehicles", "vehicle_order"), ("collision_factors", "factor_order")]
    return {
        "collisions": [(F.col(c) < 0, f"range({c}>=0)") for c in COUNT_COLUMNS]
        + [(F.length("zip_code") > ZIP_CODE_MAX, f"length(zip_code<={ZIP_CODE_MAX})")],
        "boroughs": [(F.length("borough_name") > BOROUGH_NAME_MAX, f"length(borough_name<={BOROUGH_NAME_MAX})")],
        **{table: [(~F.col(slot).between(1, SLOTS), f"range({slot} 1..{SLOTS})")] for table, slot in slots},
    }


def _check_rows(t: CollisionTables, *rule_sets: dict[str, list]) -> DataFrame:
    keys = {table: keys for table, keys, _ in NOT_NULL}
    per_table = {table: [r for rules in rule_sets for r in rules.get(table, [])] for table in keys}
    return _union([_row_rules(getattr(t, table), table, keys[table], rules) for table, rules in per_table.items() if rules])


def _counts(t: CollisionTables) -> dict[tuple, DataFrame]:
    """Rows per unique key, one aggregate each; the references of a child's key
    column to its collision are summed from them, not counted anew."""
    out = {(table, keys): getattr(t, table).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")) for table, keys in UNIQUE_KEYS}
    for child, col, _, _ in FOREIGN_KEYS:
        wider = next((k for k in out if k[0] == child and k[1][0] == col and len(k[1]) > 1), None)
        out[(child, (col,))] = (out[wider].groupBy(col).agg(F.sum("_n").alias("_n")) if wider
                                else getattr(t, child).groupBy(col).agg(F.count(F.lit(1)).alias("_n")))
    return out


def _duplicates(counts: dict[tuple, DataFrame]) -> DataFrame:
    return _union([_shape(counts[(table, keys)].filter("_n > 1"), table, f"unique({','.join(keys)})", _key_text(keys), F.col("_n"))
                   for table, keys in UNIQUE_KEYS])


def _orphans(t: CollisionTables, counts: dict[tuple, DataFrame]) -> DataFrame:
    frames = []
    for child, col, parent, pcol in FOREIGN_KEYS:
        parents = getattr(t, parent).select(F.col(pcol).alias(col))
        orphans = counts[(child, (col,))].filter(F.col(col).isNotNull()).join(parents, col, "left_anti")
        frames.append(_shape(orphans, child, f"foreign_key({col}->{parent}.{pcol})",
                             F.col(col).cast("string"), F.col("_n")))
    return _union(frames)


def check_unique(t: CollisionTables) -> DataFrame:
    """K1: primary and unique keys."""
    return _duplicates(_counts(t))


def check_not_null(t: CollisionTables) -> DataFrame:
    """K2: NOT NULL columns."""
    return _check_rows(t, _null_rules())


def check_foreign_keys(t: CollisionTables) -> DataFrame:
    """K3: every non-NULL reference exists in its parent table."""
    return _orphans(t, _counts(t))


def check_ranges(t: CollisionTables) -> DataFrame:
    """K4: counts >= 0, slots 1..5, text lengths."""
    return _check_rows(t, _range_rules())


def validate(t: CollisionTables) -> DataFrame:
    """K1-K4 together, the full violation report: one pass over each table for
    the rules on single rows, one aggregate for each key."""
    counts = _counts(t)
    return _union([_duplicates(counts), _orphans(t, counts), _check_rows(t, _null_rules(), _range_rules())])


def delete_cascade(t: CollisionTables, collision_ids: DataFrame) -> CollisionTables:
    """K5: the tables without the given collisions and their vehicle and
    factor rows (ON DELETE CASCADE).  Returns new DataFrames; the caller
    writes them to a new location, never over the path being read."""
    ids = collision_ids.select("collision_id").distinct()
    return CollisionTables(
        boroughs=t.boroughs,
        collisions=t.collisions.join(ids, "collision_id", "left_anti"),
        vehicle_types=t.vehicle_types,
        collision_vehicles=t.collision_vehicles.join(ids, "collision_id", "left_anti"),
        factors=t.factors,
        collision_factors=t.collision_factors.join(ids, "collision_id", "left_anti"),
    )
