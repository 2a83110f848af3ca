"""Helpers shared by the operators of this package.

Word rule used everywhere: a word is a maximal run of characters other than
space, tab, line feed, vertical tab, form feed and carriage return."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from crashlake.session import ensure_checkpoint_dir

#: ASCII white space between words: \x20 and \x09-\x0D.
BLANKS = " \t\n\x0b\f\r"
#: Rows and bytes of text that one numpy step holds.
CHUNK_ROWS, CHUNK_BYTES = 2000, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Folders staged within the innermost :func:`scratch` of this thread of work.
_scope: ContextVar[list[str] | None] = ContextVar("scratch", default=None)


def _remove(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def stage(df: DataFrame, name: str, keep: bool = False) -> DataFrame:
    """Write ``df`` into the shared checkpoint folder and read it back: cuts the
    lineage, is computed once and survives lost executors. With ``keep`` it
    outlives the :func:`scratch` around it."""
    spark = df.sparkSession
    root = ensure_checkpoint_dir(spark).rstrip("/")
    path = f"{root}/llm-{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    if not keep and _scope.get() is not None:
        _scope.get().append(path)
    found = spark.read.schema(df.schema).parquet(path)
    found.staged_at = path
    return found


def unstage(*frames: DataFrame) -> None:
    """Remove what :func:`stage` wrote for ``frames``, once nothing will read it again."""
    for df in frames:
        path = getattr(df, "staged_at", None)
        if path:
            _remove(df.sparkSession, path)


@contextmanager
def scratch(spark: SparkSession):
    """Removes at its end what was staged inside it by this thread of work, and nothing that others staged."""
    token = _scope.set([])
    try:
        yield
    finally:
        for path in _scope.get():
            _remove(spark, path)
        _scope.reset(token)


def numbered(rows: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """``rows``, written once, with each one's position in the order of ``order``
    within ``by``, that group's size and a number of the group that follows its order."""
    keys = [F.col(c).asc_nulls_first() for c in [*by, *order]]
    n = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    laid = rows.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    # ascending over the ranges and within each; fixed by being written
    laid = stage(laid.withColumn("at", F.monotonically_increasing_id()).withColumn("part", F.spark_partition_id()), "ordered")
    runs = laid.groupBy(*by, "part").agg(F.min("at").alias("start"), F.count("*").alias("rows"))
    group = Window.partitionBy(*(by or [F.lit(0)]))  # a row for each group and partition
    before = F.coalesce(F.sum("rows").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select(*[F.col(c).alias(f"__{c}") for c in by], F.col("part").alias("__part"), (F.col("start") - before).alias("zero"),
                       F.sum("rows").over(group).alias("n"), F.min("start").over(group).alias("tree"))
    same = F.col("part") == F.col("__part")
    for c in by:
        same = same & F.col(c).eqNullSafe(F.col(f"__{c}"))
    return laid.join(runs, same).withColumn("pos", F.col("at") - F.col("zero")).drop("at", "part", "zero", "__part", *[f"__{c}" for c in by])


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def words(text: Column) -> Column:
    """The words of a text in order; a null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+", -1), "")


def held_out(doc_id: Column) -> Column:
    """crc32 of the id's decimal text is divisible by five; a null id counts as held out, so it trains nothing."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(True))


def chunks(text: pa.Array, size: int | None = None):
    """(first row, texts) of slices holding at most CHUNK_ROWS rows and about ``size`` (CHUNK_BYTES) bytes (one longer text stands alone)."""
    # cast before slicing: an Arrow cast of a slice keeps offsets that some kernels then misread
    parts = text.chunks if isinstance(text, pa.ChunkedArray) else [text]
    text = pa.concat_arrays([*parts, pa.array([], text.type)]).cast(pa.large_string())
    ends = np.cumsum(np.asarray(pc.fill_null(pc.binary_length(text), 0), dtype=np.int64))
    at = 0
    while at < len(ends):
        base = ends[at - 1] if at else 0
        to = min(at + CHUNK_ROWS, max(at + 1, int(np.searchsorted(ends, base + (size or CHUNK_BYTES), "right"))))
        yield at, text.slice(at, to - at)
        at = to


def split_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """All words of the texts (a slice of :func:`chunks`) in one flat array, and each text's number of words (null: 0)."""
    lists = pc.ascii_split_whitespace(pc.fill_null(text, ""))
    flat = lists.flatten()
    real = np.asarray(pc.not_equal(pc.binary_length(flat), 0))
    sums = np.concatenate([[0], np.cumsum(real)])
    offsets = np.asarray(lists.offsets) - lists.offsets[0].as_py()
    return flat.filter(pa.array(real)), sums[offsets[1:]] - sums[offsets[:-1]]
