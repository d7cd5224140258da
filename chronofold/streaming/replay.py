"""Structured Streaming over revisioned facts: late data are new revisions and are never dropped."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

#: Names of timeframes and their windows; a day is a session and joins the calendar instead.
TIMEFRAMES = {"1m": "1 minute", "2m": "2 minutes", "5m": "5 minutes", "15m": "15 minutes", "1h": "1 hour"}


def tick_stream(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files of ticks as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def bars(ticks: DataFrame, timeframe: str, lateness: str, key: str = "instrument_id", ts: str = "event_ts", price: str = "price", order: str = "source_sequence") -> DataFrame:
    """Open, high, low, close and count of each key and window; a window is emitted once the watermark has passed it.

    Opening and close follow (ts, order), so they do not depend on the order of arrival."""
    at = F.struct(ts, order)
    timed = ticks.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness)
    got = timed.groupBy(key, F.window(ts, TIMEFRAMES[timeframe]).alias("w")).agg(
        F.min_by(price, at).alias("open_price"), F.max(price).alias("high_price"), F.min(price).alias("low_price"), F.max_by(price, at).alias("close_price"), F.count(F.lit(1)).alias("trade_count"),
    )
    return got.select(key, F.col("w.start").alias("bar_open_ts"), F.col("w.end").alias("bar_close_ts"), "open_price", "high_price", "low_price", "close_price", "trade_count")


def append_revisions(revisions: DataFrame, store: str, checkpoint: str) -> StreamingQuery:
    """Append a stream of revisions to a Parquet store by month, once each: a batch replayed after a failure overwrites
    its own folder and nothing else. Readers see them through a point-in-time read."""

    def write(batch: DataFrame, number: int) -> None:
        out = batch.withColumn("event_month", F.date_format("bar_open_ts", "yyyy-MM"))
        out.write.mode("overwrite").partitionBy("event_month").parquet(f"{store}/batch_id={number}")

    return revisions.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def deduplicated(stream: DataFrame, keys: list[str], ts: str, lateness: str) -> DataFrame:
    """Each request once, within the lateness that is kept in state."""
    return stream.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, lateness).dropDuplicatesWithinWatermark(keys)


def replay(stream: DataFrame, store: str, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Work off what there is, and stop."""
    return stream.writeStream.format("parquet").option("path", store).option("checkpointLocation", checkpoint).outputMode(mode).trigger(availableNow=True).start()
