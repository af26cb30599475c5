"""Live tables with Structured Streaming: upserts, late results, rolling form and new entities."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.keyed_table import KeyedTable

P = F.col


def stream_files(spark: SparkSession, path: str, schema, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def live_upsert(stream: DataFrame, target: str, checkpoint: str, keys: Sequence[str], updated: str, compact_after: int = 8):
    """Merge every micro-batch into the keyed table ``target``, which then holds the batch's rows as one more layer of
    files. Late rows replace earlier ones if their time is later. A batch that is repeated after a failure is
    known by the checkpoint's path and its number and merged once; with a new checkpoint the table goes on. Every
    ``compact_after`` batches the buckets with most layers are folded."""

    def merge(batch: DataFrame, number: int) -> None:
        table = KeyedTable(batch.sparkSession, target, keys, updated)
        table.apply(batch, f"{checkpoint}#{number}")
        if (number + 1) % compact_after == 0:
            table.compact()
            table.vacuum()

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def latest_version(spark: SparkSession, target: str) -> DataFrame:
    """The table that live_upsert keeps, as it is now."""
    return KeyedTable(spark, target).read()


def enrich_new(stream: DataFrame, known: str, checkpoint: str, key: str):
    """Append to the table ``known`` (it must exist) the rows of each micro-batch whose id it lacks, one row an id;
    a repeated batch finds its ids known."""

    def add(batch: DataFrame, number: int) -> None:
        fresh = batch.dropDuplicates([key]).join(batch.sparkSession.read.parquet(known).select(key), key, "left_anti")
        fresh.write.mode("append").parquet(known)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def rolling_form(stream: DataFrame, key: str, time: str, late: str = "7 days", width: str = "30 days", slide: str = "1 day") -> DataFrame:
    """Runs and wins of each entity in sliding windows; rows later than ``late`` are left out. Works on
    streams and, with the same result, on tables."""
    p = P("position")
    return (
        stream.withWatermark(time, late)
        .groupBy(key, F.window(time, width, slide).alias("w"))
        .agg(F.count(F.lit(1)).alias("runs"), F.count_if(p == 1).alias("wins"))
        .select(key, P("w.start").alias("window_start"), P("w.end").alias("window_end"), "runs", "wins")
    )


def event_windows(events: DataFrame, time: str, key: str, width: str, late: str) -> DataFrame:
    """Counts and sums of tumbling windows."""
    return events.withWatermark(time, late).groupBy(key, F.window(time, width).alias("w")).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(key, P("w.start").alias("window_start"), "n", "total")


def new_entities(stream: DataFrame, key: str, time: str, late: str = "7 days") -> DataFrame:
    """The first row of each id that the stream shows within the watermark."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])
