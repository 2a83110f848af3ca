"""Read the wide collision feed (header CSV) as all-string rows.

Columns are taken by each file's own header, so column order does not matter,
not even between the files of one feed; a column a file lacks is NULL (the
reference reads rows with ``dict.get``).  Quoted fields may hold commas,
doubled quotes and line ends (sources.csv_records), and a large file is still
read by many tasks.  A row with too many or too few fields keeps its text in
``_corrupt_record``, which the load turns into a reject.  A missing path, or
a file - also a single one - whose header names no collision id, is an error.
Nothing is inferred: every column is text until the cleaning step types it.

The text is read once and staged with what each line says about the
records' borders; records, headers and fields come from that.

``_order`` records file order (path, split start, position inside the split),
which "first row wins" needs: splits can be packed into tasks out of file
order, so the generated id alone is not enough.
"""

from __future__ import annotations

import csv
import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from crashlake.schema import FEED_COLUMNS
from crashlake.session import ensure_checkpoint_dir, shuffles_end
from crashlake.sources.csv_records import read_lines, records

ORDER_COL = "_order"
CORRUPT_COL = "_corrupt_record"
ID_COLUMN = "collision_id"
#: Quoted CSV as spreadsheets and databases write it; every column is parsed, so that broken rows show.
CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "columnPruning": False, "columnNameOfCorruptRecord": CORRUPT_COL}
#: Writes a frame under a label and reads it back.
Write = Callable[[DataFrame, str], DataFrame]


def _scratch_write(df: DataFrame, label: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/crashlake-{label}-{uuid.uuid4().hex}"
    with shuffles_end(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _parsed(rows: DataFrame, header: str) -> DataFrame:
    """The fields of ``rows`` (value, ...) under the names of their header."""
    names = [n for n in next(csv.reader([header]))]
    taken = [n if names.index(n) == i and n != CORRUPT_COL else f"_again{i}" for i, n in enumerate(names)]
    schema = ", ".join(f"`{n.replace('`', '``')}` string" for n in [*taken, CORRUPT_COL])
    fields = rows.select(F.from_csv("value", schema, {k: str(v) for k, v in CSV_OPTIONS.items() if k != "columnPruning"}).alias("_f"), ORDER_COL)
    has = set(taken)
    cols = [(F.col("_f").getField(c) if c in has else F.lit(None).cast("string")).alias(c) for c in FEED_COLUMNS]
    return fields.select(*cols, F.col("_f").getField(CORRUPT_COL).alias(CORRUPT_COL), ORDER_COL)


def read_feed(spark: SparkSession, path: str | list[str], write: Write = _scratch_write) -> DataFrame:
    """The feed's rows.  ``write`` stages the text; the driver gets a file
    name's header per file, as for any file listing."""
    text, n_files = read_lines(spark, path)
    lines = write(text, "feed-lines")
    found = records(lines).withColumn(ORDER_COL, F.struct("file", "block", "row"))
    first = records(lines.filter(F.col("block") == 0)).groupBy("file").agg(F.min(F.struct("block", "row", "value")).alias("h"))
    heads = write(first.select("file", F.col("h.block").alias("_block"), F.col("h.row").alias("_row"), F.col("h.value").alias("_header")), "feed-headers")
    counted = {r._header: r["count"] for r in heads.groupBy("_header").count().collect()}
    good = [h for h in counted if ID_COLUMN in next(csv.reader([h]))]
    if sum(counted[h] for h in good) != n_files:
        raise ValueError(f"some of the {n_files} feed files have no header that names {ID_COLUMN}")
    body = found.join(heads, "file").filter((F.col("block") != F.col("_block")) | (F.col("row") != F.col("_row")))
    if len(good) == 1:
        return _parsed(body, good[0])
    return reduce(DataFrame.unionByName, [_parsed(body.filter(F.col("_header") == h), h) for h in sorted(good)])


def select_feed_columns(raw: DataFrame, with_file_order: bool = False) -> DataFrame:
    present = set(raw.columns)
    cols = [F.col(f"`{c}`").cast("string").alias(c) if c in present
            else F.lit(None).cast("string").alias(c) for c in FEED_COLUMNS]
    if ORDER_COL in present and not with_file_order:
        cols.append(F.col(ORDER_COL))
    if CORRUPT_COL in present:
        cols.append(F.col(CORRUPT_COL))
    if with_file_order:
        cols.append(F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias(ORDER_COL))
    return raw.select(*cols)


def has_file_order(df: DataFrame) -> bool:
    """True when ``_order`` is the (file path, split start, row) struct."""
    field = next((f for f in df.schema.fields if f.name == ORDER_COL), None)
    return field is not None and getattr(field.dataType, "names", None) == ["file", "block", "row"]


def feed_files(df: DataFrame) -> DataFrame:
    """(file, file_rank): the feed's input files in path order.  One row per
    input file - bounded by the load's file listing, not by the data."""
    # (sorted in one task: fine for the millions of files a listing can hold)
    files = df.select(F.col(f"{ORDER_COL}.file").alias("file")).distinct()
    return files.select("file", F.row_number().over(Window.orderBy("file")).cast("int").alias("file_rank"))


def compact_order(df: DataFrame, files: DataFrame) -> DataFrame:
    """Swap the file path inside ``_order`` for its rank, so the shuffles
    that pick first rows move three numbers per row instead of a path."""
    f = files.select(F.col("file").alias("_file"), "file_rank")
    joined = df.join(F.broadcast(f), df[f"{ORDER_COL}.file"] == f["_file"])
    return joined.withColumn(ORDER_COL, F.struct(
        F.col("file_rank").alias("file"), F.col(f"{ORDER_COL}.block").alias("block"),
        F.col(f"{ORDER_COL}.row").alias("row"))).drop("_file", "file_rank")
