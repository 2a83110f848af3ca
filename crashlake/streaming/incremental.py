"""Load feed files as they land in a directory (Structured Streaming).

The reference loads one file per run.  The same load, driven by a file
stream, picks up only files not seen before (the stream's checkpoint keeps
the list) and hands each micro-batch to the batch loader through
``foreachBatch``.  The loader only inserts keys that are absent, so a
micro-batch replayed after a failure adds nothing twice: the sink is
idempotent and the whole pipeline is effectively exactly-once.

Rows already stored win over later files, which is the reference's
"first row wins" carried across batches.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from crashlake.plans.load import load_feed
from crashlake.schema import FEED_COLUMNS
from crashlake.sources.feed import CORRUPT_COL, CSV_OPTIONS, ORDER_COL, select_feed_columns


def feed_stream(spark: SparkSession, landing_dir: str, columns=FEED_COLUMNS,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming CSV reader.  A stream needs its schema up front: ``columns``
    lists the header names in file order (all read as text)."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in (*columns, CORRUPT_COL)])
    reader = (spark.readStream.schema(schema).options(**CSV_OPTIONS).option("header", True).option("multiLine", True)
              .option("enforceSchema", False))  # a file with another header is an error
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    raw = reader.csv(landing_dir)
    return raw.select("*", F.col("_metadata.file_path").alias("_file"),
                      F.col("_metadata.file_block_start").alias("_block"))


def _load_batch(root: str, mode: str, name: str):
    def run(batch: DataFrame, epoch_id: int) -> None:
        ordered = batch.withColumn(ORDER_COL, F.struct(
            F.col("_file").alias("file"), F.col("_block").alias("block"),
            F.monotonically_increasing_id().alias("row")))
        feed = select_feed_columns(ordered.drop("_file", "_block"))
        load_feed(batch.sparkSession, feed, root, mode=mode, order_col=ORDER_COL, load_id=f"{name}-{epoch_id}")
    return run


def start_incremental_load(spark: SparkSession, landing_dir: str, root: str, *, name: str = "feed",
                           columns=FEED_COLUMNS, mode: str = "quarantine", available_now: bool = True,
                           processing_time: str | None = None,
                           checkpoint_location: str | None = None,
                           max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream.  ``available_now`` processes what is there and stops
    (scheduled runs); otherwise it polls every ``processing_time``."""
    if checkpoint_location is None:
        shared = spark.conf.get("spark.checkpoint.dir", None)
        if not shared:  # a folder of this session would forget the files already loaded
            raise ValueError("name a checkpoint_location, or set spark.checkpoint.dir to a shared folder")
        checkpoint_location = f"{shared.rstrip('/')}/crashlake-stream-{name}"
    stream = feed_stream(spark, landing_dir, columns, max_files_per_trigger)
    writer = (stream.writeStream.queryName(f"crashlake_{name}")
              .option("checkpointLocation", checkpoint_location)
              .foreachBatch(_load_batch(root, mode, name)))
    writer = writer.trigger(availableNow=True) if available_now else \
        writer.trigger(processingTime=processing_time or "1 minute")
    return writer.start()
