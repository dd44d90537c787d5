"""Streaming merge of connected records: a chain of records of one platform ends when nothing follows within the gap.
The watermark bounds the state; chains leave in append mode once they are complete, so late data up to the delay count."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def chains(records: DataFrame, platform: str, time: str, gap: str = "10 seconds", delay: str = "1 hour") -> DataFrame:
    """platform, start_time, stop_time, n_records of every completed chain. Works on static tables as well."""
    w = F.session_window(F.col(time), gap)
    base = records.withWatermark(time, delay) if records.isStreaming else records
    out = base.groupBy(F.col(platform), w.alias("w")).agg(F.count(F.lit(1)).alias("n_records"), F.min(time).alias("start_time"), F.max(time).alias("stop_time"))
    return out.select(platform, "start_time", "stop_time", "n_records")


def grid_counts(records: DataFrame, cell, time: str, window: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Per-cell counts and means of a value by time window."""
    base = records.withWatermark(time, delay) if records.isStreaming else records
    return base.groupBy(F.window(time, window).alias("w"), cell.alias("cell")).agg(F.count("value").alias("n"), F.avg("value").alias("value_mean"))


def write_batches(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Each micro-batch to its own folder: a replayed batch replaces itself, so the sink holds every row once."""

    def save(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={number}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
