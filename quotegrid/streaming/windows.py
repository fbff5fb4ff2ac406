"""Last-value downsampling on a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def downsample_last_stream(rows: DataFrame, freq: str, delay: str = "1 second") -> DataFrame:
    """Last whole row per symbol and tumbling window, stamped with the window's start.

    A window is sent once the watermark has passed its end.
    """
    rest = [c for c in rows.columns if c not in ("symbol", "timestamp")]
    at = F.timestamp_micros(F.call_function("div", F.col("timestamp"), F.lit(1000).cast("bigint")))
    last = (
        rows.withColumn("event_time", at)
        .withWatermark("event_time", delay)
        .groupBy("symbol", F.window("event_time", freq).alias("w"))
        .agg(F.max_by(F.struct(*rest), "timestamp").alias("r"))
    )
    start = F.unix_micros("w.start") * 1000
    return last.select("symbol", start.alias("timestamp"), *[F.col(f"r.{c}").alias(c) for c in rest])
