"""Event de-duplication inside an interval of event time.

The first event of a key passes; further ones are dropped until the watermark is past
the first one's time plus the interval.  The state store holds the keys seen within the
interval (not all keys ever seen) and is restored from the stream's checkpoint, so a
restarted stream still knows them.  Events older than the watermark are late and dropped.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def start_dedup(spark: SparkSession, source_path: str, schema: T.StructType, out_path: str,
                checkpoint_location: str, keys: list[str], ts_col: str,
                within: str = "5 minutes", fmt: str = "parquet",
                max_files_per_trigger: int | None = None,
                available_now: bool = True) -> StreamingQuery:
    """Stream ``source_path`` to ``out_path`` (Parquet) without repeats of ``keys``.

    Every repeat within the interval of its first event is dropped; one after it passes
    as soon as the watermark (the greatest time of earlier micro-batches less the
    interval) has left the first one behind.  Which of several equal-keyed events of one
    micro-batch passes is not defined.  Times without zone are UTC; NULL times have no
    place in event time and are dropped; NULL keys are one key.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    events = reader.load(source_path)
    if not isinstance(events.schema[ts_col].dataType, T.TimestampType):
        events = events.withColumn(ts_col, F.col(ts_col).cast("timestamp"))
    fresh = (events.where(F.col(ts_col).isNotNull()).withWatermark(ts_col, within)
             .dropDuplicatesWithinWatermark(keys))
    writer = (fresh.writeStream.format("parquet").outputMode("append")
              .option("path", out_path).option("checkpointLocation", checkpoint_location))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(
        processingTime="1 minute")
    return writer.start()
