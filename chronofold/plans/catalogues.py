"""Queries of catalogue merges and of the SQL surface of the point-in-time read."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronofold.operators import merge, raw_events, sql_functions
from chronofold.plans.catalogue import query
from chronofold.plans.point_in_time import CUTOFF, FROM, SQL_CUTOFF, TO
from chronofold.plans.views import BARS, bars, sql_ts, table, text_ts

TABLES = [
    merge.Table("region", ("r_regionkey",), ("r_name",)), merge.Table("nation", ("n_nationkey",), ("n_name", "n_regionkey"), {"n_regionkey": "region"}),
    merge.Table("customer", ("c_custkey",), ("c_name", "c_nationkey"), {"c_nationkey": "nation"}),
]


@query("catalogue_merge", """WITH r AS (SELECT 'region' AS table_name, '{"r_regionkey":' || r_regionkey || '}' AS key, 1 AS rows, CASE WHEN r_regionkey < 3 THEN 'UNCHANGED' ELSE 'INSERTED' END AS outcome FROM region),
    n AS (SELECT 'nation', '{"n_nationkey":' || n_nationkey || '}', 1, CASE WHEN n_nationkey % 2 = 1 THEN 'INSERTED' WHEN n_nationkey % 10 = 4 THEN 'CONFLICT' ELSE 'UNCHANGED' END FROM nation),
    c AS (SELECT 'customer', '{"c_custkey":' || c_custkey || '}', CASE WHEN c_custkey % 40 = 1 THEN 2 ELSE 1 END, CASE WHEN c_custkey % 40 = 1 THEN 'DUPLICATE_CONFLICT' WHEN c_custkey % 3 = 0 AND c_custkey % 50 <> 7 THEN 'UNCHANGED' WHEN c_custkey % 3 = 0 THEN 'CONFLICT' WHEN c_custkey % 50 = 7 THEN 'MISSING_PARENT' ELSE 'INSERTED' END FROM customer)
    SELECT table_name, key, CAST(rows AS BIGINT) AS rows, outcome FROM (SELECT * FROM r UNION ALL SELECT * FROM n UNION ALL SELECT * FROM c)""")
def catalogue_merge(spark, d):
    """Three tables merged into a store that holds some of their rows; some candidates differ, repeat or lack their parent."""
    region, nation, customer = (table(spark, d, n) for n in ("region", "nation", "customer"))
    existing = {"region": region.where("r_regionkey < 3"), "nation": nation.where("n_nationkey % 2 = 0"), "customer": customer.where("c_custkey % 3 = 0")}
    renamed = nation.withColumn("n_name", F.when(F.col("n_nationkey") % 10 == 4, "OTHER").otherwise(F.col("n_name")))
    moved = customer.withColumn("c_nationkey", F.when(F.col("c_custkey") % 50 == 7, F.lit(99).cast(customer.schema["c_nationkey"].dataType)).otherwise(F.col("c_nationkey")))
    twice = moved.unionByName(moved.where("c_custkey % 40 = 1").withColumn("c_name", F.lit("other")))
    return merge.merged(TABLES, existing, {"region": region, "nation": renamed, "customer": twice})[0]


@query("bars_as_of_sql", f"""WITH {BARS}, r AS (SELECT *, row_number() OVER (PARTITION BY bar_series_id, bar_open_ts ORDER BY available_at DESC, revision_no DESC, system_available_at DESC) AS rk FROM bars
        WHERE is_final AND bar_open_ts >= TIMESTAMP '{FROM}' AND bar_open_ts < TIMESTAMP '{TO}' AND bar_close_ts <= {SQL_CUTOFF} AND available_at <= {SQL_CUTOFF})
    SELECT bar_series_id, {sql_ts('bar_open_ts')} AS bar_open_ts, revision_no, close_price FROM r WHERE rk = 1""")
def bars_as_of_sql(spark, d):
    """The read as a table function of SQL, for all series."""
    sql_functions.register_bars_as_of(spark, bars(spark, d), "bars_known")
    got = spark.sql(f"SELECT * FROM bars_known(NULL, TIMESTAMP_NTZ '{FROM}', TIMESTAMP_NTZ '{TO}', TIMESTAMP_NTZ '{CUTOFF}', 'PUBLIC_REPLAY')")
    return got.select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), "revision_no", "close_price")


@query("raw_event_identical", """WITH e AS (SELECT event_id, user_id % 50 AS feed_id, CASE WHEN event_id % 31 <> 0 THEN '{"type":"' || event_type || '","level":' || CAST(floor(value / 5) AS BIGINT) || '}' END AS payload FROM events),
    s AS (SELECT feed_id, payload, min(event_id) AS old FROM e WHERE event_id % 4 = 1 GROUP BY ALL),
    n AS (SELECT *, min(event_id) OVER (PARTITION BY feed_id, payload) AS first FROM e WHERE event_id % 4 <> 1)
    SELECT n.event_id, CASE WHEN n.payload IS NOT NULL THEN coalesce(s.old, CASE WHEN first < n.event_id THEN first END) END AS identical_to FROM n LEFT JOIN s ON s.feed_id = n.feed_id AND s.payload = n.payload""")
def raw_event_identical(spark, d):
    """Every event as a raw payload; a quarter is in the store, and which one each of the others repeats."""
    level = F.floor(F.col("value") / 5).cast("bigint").cast("string")
    payload = F.when(F.col("event_id") % 31 != 0, F.concat(F.lit('{"type":"'), F.col("event_type"), F.lit('","level":'), level, F.lit("}")))
    e = table(spark, d, "events").select("event_id", (F.col("user_id") % 50).alias("feed_id"), payload.alias("payload"))
    stored = e.where("event_id % 4 = 1").select("feed_id", raw_events.content(F.col("payload")).alias("content"), "event_id")
    return raw_events.find_identical(stored, e.where("event_id % 4 <> 1"), ["feed_id"], "payload", "event_id").select("event_id", "identical_to")
