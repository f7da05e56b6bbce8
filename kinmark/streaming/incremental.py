"""Incremental processing as file streams that stop when everything is read."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def process_available(spark: SparkSession, folder: str, schema: str, step: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """Run ``step`` over the parquet files that came since the last call and append its result.

    The checkpoint remembers what was read (the progress flag of a loop over
    batches); each batch writes into its own folder, so a batch that is run
    again after a failure replaces itself.
    """

    def write(batch: DataFrame, number: int) -> None:
        step(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(folder)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_arrivals(records: DataFrame, width: str = "30 days", late: str = "10 days") -> DataFrame:
    """collection_id, from, to, n: records by time of arrival; works on streams (with a watermark) and on tables alike."""
    timed = records.withWatermark("created_at", late) if records.isStreaming else records
    out = timed.groupBy("collection_id", F.window("created_at", width).alias("w")).agg(F.count("*").alias("n"))
    return out.select("collection_id", F.col("w.start").alias("from_ts"), F.col("w.end").alias("to_ts"), "n")


def postprocess(groups: DataFrame, step: Callable[[DataFrame], DataFrame], start: int | None = None, end: int | None = None) -> DataFrame:
    """Apply a function to the valid groups of a range of ids."""
    out = groups.where("coalesce(g_type, '') <> 'invalid'")
    if start is not None:
        out = out.where(F.col("id") >= start)
    if end is not None:
        out = out.where(F.col("id") <= end)
    return out.transform(step)
