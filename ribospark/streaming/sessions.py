"""Islands in time: the streaming twin of the island operator, as session windows with a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def event_sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """Sessions of each user (batch or stream): start, end, events and their sum; late rows are dropped by the watermark."""
    x = events.withColumn("ts", F.col("ts").cast("timestamp"))
    x = x.withWatermark("ts", late) if events.isStreaming else x
    g = x.groupBy("user_id", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"), F.sum("value").alias("total"))
    return g.select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")
