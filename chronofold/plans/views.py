"""Domain views over the TPC-H-like tables, for Spark and, as SQL, for DuckDB.

bars: every event of a user on a day is one more revision of that user's daily bar. ticks, quotes, identifiers, orders,
fills and features follow the same idea. All timestamps are without zone and read as UTC.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_ts(c: str | Column) -> Column:
    """A timestamp as text, the same in both engines."""
    return F.date_format(F.col(c) if isinstance(c, str) else c, "yyyy-MM-dd HH:mm:ss")


def sql_ts(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S')"


def day_of(c: str) -> Column:
    return F.col(c).cast("date").cast("timestamp_ntz")


def hours(c: Column) -> Column:
    return F.make_dt_interval(hours=c.cast("int"))


def money(c: str | Column) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("decimal(18,2)")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.select(F.col("user_id").alias("bar_series_id"), F.col("ts").alias("event_ts"), "event_id", money("value").alias("price"), "event_type")


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ticks(spark, sf_dir).withColumn("bar_open_ts", day_of("event_ts"))
    by = Window.partitionBy("bar_series_id", "bar_open_ts").orderBy("event_ts", "event_id")
    run = by.rowsBetween(Window.unboundedPreceding, 0)
    n = F.row_number().over(by)
    out = t.select(
        "bar_series_id", "bar_open_ts", n.cast("bigint").alias("revision_no"),
        F.first("price").over(run).alias("open_price"), F.max("price").over(run).alias("high_price"),
        F.min("price").over(run).alias("low_price"), F.col("price").alias("close_price"),
        F.sum("price").over(run).cast("decimal(18,2)").alias("volume"), "event_id", "event_type",
    )
    return out.select(
        "bar_series_id", "bar_open_ts", (F.col("bar_open_ts") + hours(F.lit(24))).alias("bar_close_ts"), "revision_no",
        "open_price", "high_price", "low_price", "close_price", "volume",
        (F.col("bar_open_ts") + hours(24 + (F.col("revision_no") - 1) * 6)).alias("available_at"),
        (F.col("bar_open_ts") + hours(24 + (F.col("revision_no") - 1) * 6 + F.col("event_id") % 48)).alias("system_available_at"),
        (F.col("event_type") != "error").alias("is_final"), "event_id",
    )


BARS = """
    ticks AS (
        SELECT user_id AS bar_series_id, ts AS event_ts, event_id, CAST(value AS DECIMAL(18,2)) AS price, event_type FROM events
    ), numbered AS (
        SELECT *, date_trunc('day', event_ts)::TIMESTAMP AS bar_open_ts,
            row_number() OVER w AS revision_no, first_value(price) OVER w AS open_price,
            max(price) OVER w AS high_price, min(price) OVER w AS low_price, sum(price) OVER w AS volume
        FROM ticks
        WINDOW w AS (PARTITION BY bar_series_id, date_trunc('day', event_ts) ORDER BY event_ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
    ), bars AS (
        SELECT bar_series_id, bar_open_ts, bar_open_ts + INTERVAL 24 HOUR AS bar_close_ts, CAST(revision_no AS BIGINT) AS revision_no,
            open_price, high_price, low_price, price AS close_price, CAST(volume AS DECIMAL(18,2)) AS volume,
            bar_open_ts + to_hours(CAST(24 + (revision_no - 1) * 6 AS BIGINT)) AS available_at,
            bar_open_ts + to_hours(CAST(24 + (revision_no - 1) * 6 + event_id % 48 AS BIGINT)) AS system_available_at,
            event_type <> 'error' AS is_final, event_id
        FROM numbered
    )
"""


def identifiers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Symbols with validity: each order opens an interval of its customer's key of 30 days, or without end."""
    o = table(spark, sf_dir, "orders")
    return o.select(F.col("o_custkey").alias("key"), F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("valid_from"), F.when(F.col("o_orderkey") % 5 != 0, F.col("o_orderdate") + F.make_dt_interval(days=F.lit(30))).alias("valid_to"))


IDENTIFIERS = """
    identifiers AS (
        SELECT o_custkey AS key, o_orderkey AS id, o_orderdate AS valid_from,
            CASE WHEN o_orderkey % 5 <> 0 THEN o_orderdate + INTERVAL 30 DAY END AS valid_to
        FROM orders
    )
"""


def universe(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("valid_from"), F.max("o_orderdate").alias("valid_to"))
    return o.where("valid_from < valid_to").select(F.col("o_custkey").alias("instrument_id"), "valid_from", "valid_to")


UNIVERSE = """
    universe AS (
        SELECT o_custkey AS instrument_id, min(o_orderdate) AS valid_from, max(o_orderdate) AS valid_to
        FROM orders GROUP BY o_custkey HAVING min(o_orderdate) < max(o_orderdate)
    )
"""


def fills(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as fills of their orders; rows may repeat."""
    l = table(spark, sf_dir, "lineitem")
    return l.select(F.col("l_orderkey").alias("order_id"), F.col("l_suppkey").alias("instrument_id"), F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_quantity").cast("bigint").alias("quantity"), money("l_extendedprice").alias("notional"), F.col("l_shipdate").alias("fill_ts"), F.when(F.col("l_returnflag") == "R", "SELL").otherwise("BUY").alias("side"))


FILLS = """
    fills AS (
        SELECT l_orderkey AS order_id, l_suppkey AS instrument_id, CAST(l_linenumber AS BIGINT) AS line, CAST(l_quantity AS BIGINT) AS quantity,
            CAST(l_extendedprice AS DECIMAL(18,2)) AS notional, l_shipdate AS fill_ts, CASE WHEN l_returnflag = 'R' THEN 'SELL' ELSE 'BUY' END AS side
        FROM lineitem
    )
"""
