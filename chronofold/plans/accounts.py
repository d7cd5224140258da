"""Queries of fill references with roles, of what changes touch, and of trades' performance."""

from __future__ import annotations

from pyspark.sql import functions as F

from chronofold.operators import integrity, ledger, pit
from chronofold.plans.catalogue import query
from chronofold.plans.data_quality import BY, CLOSED, INPUTS, ORDERED, _closed, _inputs
from chronofold.plans.point_in_time import CUTOFF, SQL_CUTOFF
from chronofold.plans.views import BARS, FILLS, bars, day_of, fills, table

#: Runs of three kinds; a series is bound for one or both of two roles.
ROLES = """roles AS (SELECT DISTINCT user_id % 3 AS run_id, user_id AS bar_series_id, CASE WHEN user_id % 4 = 0 THEN 'SIGNAL' ELSE 'EXECUTION' END AS series_role FROM events
        UNION SELECT DISTINCT user_id % 3, user_id, 'SIGNAL' FROM events WHERE user_id % 5 = 0)"""


def _roles(spark, d):
    user = F.col("user_id")
    e = table(spark, d, "events").select((user % 3).alias("run_id"), user.alias("bar_series_id")).distinct()
    one = e.withColumn("series_role", F.when(F.col("bar_series_id") % 4 == 0, "SIGNAL").otherwise("EXECUTION"))
    return one.unionByName(e.where("bar_series_id % 5 = 0").withColumn("series_role", F.lit("SIGNAL"))).distinct()


@query("decision_role_violations", f"""WITH {BARS}, {INPUTS}, {ROLES}, i AS (SELECT *, bar_series_id % 3 AS own_run FROM inputs), v AS (SELECT i.event_id, CASE WHEN b.available_at IS NULL THEN 'UNKNOWN_BAR' WHEN u.run_id IS NULL THEN 'UNBOUND_SERIES' WHEN b.available_at > i.decision_ts THEN 'LOOK_AHEAD'
    WHEN b.available_at > {SQL_CUTOFF} THEN 'AFTER_CUTOFF' END AS violation FROM i LEFT JOIN bars b USING (bar_series_id, bar_open_ts, revision_no) LEFT JOIN roles u ON u.series_role = 'SIGNAL' AND u.run_id = i.own_run AND u.bar_series_id = i.bar_series_id)
    SELECT * FROM v WHERE violation IS NOT NULL""")
def decision_role_violations(spark, d):
    """Decision inputs must be of a series that their run binds for signals."""
    b = bars(spark, d)
    inputs = _inputs(b).withColumn("run_id", F.col("bar_series_id") % 3)
    return integrity.decision_violations(inputs, b, _roles(spark, d), "available_at", pit.at(CUTOFF), role="SIGNAL").select("event_id", "violation")


@query("fill_reference_violations", f"""WITH {BARS}, {ROLES},
    f AS (SELECT user_id % 3 AS run_id, event_id AS fill_id, user_id AS instrument_id, date_trunc('day', ts)::TIMESTAMP + INTERVAL 40 HOUR AS fill_ts FROM events WHERE event_id % 19 <> 0),
    r AS (SELECT user_id % 3 AS run_id, event_id AS fill_id, user_id AS instrument_id, CASE event_id % 3 WHEN 0 THEN 'BAR' WHEN 1 THEN 'TICK' ELSE 'MODEL' END AS reference_type,
        CASE WHEN event_id % 3 = 2 AND event_id % 10 <> 0 THEN NULL ELSE event_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END END AS source_id, CASE WHEN event_id % 3 = 0 THEN user_id END AS bar_series_id FROM events),
    s AS (SELECT 'BAR' AS reference_type, event_id AS source_id, bar_series_id AS instrument_id, available_at AS effective_at FROM bars UNION ALL SELECT 'TICK', event_id, user_id, ts FROM events),
    c AS (SELECT unnest([0, 1, 2]) AS run_id, unnest([TIMESTAMP '2024-01-20', TIMESTAMP '2024-02-10', TIMESTAMP '2024-03-01']) AS cutoff),
    v AS (SELECT r.run_id, r.fill_id, CASE WHEN f.fill_ts IS NULL THEN 'NO_FILL' WHEN r.reference_type = 'MODEL' THEN CASE WHEN r.source_id IS NOT NULL THEN 'MODEL_WITH_SOURCE' END WHEN r.reference_type = 'BAR' AND u.run_id IS NULL THEN 'UNBOUND_SERIES'
            WHEN s.effective_at IS NULL THEN 'UNKNOWN_SOURCE' WHEN s.instrument_id <> r.instrument_id THEN 'OTHER_INSTRUMENT' WHEN s.effective_at > f.fill_ts THEN 'LOOK_AHEAD' WHEN s.effective_at > c.cutoff THEN 'AFTER_CUTOFF' END AS violation
        FROM r LEFT JOIN f ON f.run_id = r.run_id AND f.fill_id = r.fill_id AND f.instrument_id = r.instrument_id LEFT JOIN c ON c.run_id = r.run_id LEFT JOIN s ON s.reference_type = r.reference_type AND s.source_id = r.source_id
        LEFT JOIN roles u ON u.series_role = 'EXECUTION' AND u.run_id = r.run_id AND u.bar_series_id = r.bar_series_id)
    SELECT * FROM v WHERE violation IS NOT NULL""")
def fill_reference_violations(spark, d):
    e, b = table(spark, d, "events"), bars(spark, d)
    k, event, user = F.col("event_id") % 3, F.col("event_id"), F.col("user_id")
    own = e.where("event_id % 19 <> 0").select((user % 3).alias("run_id"), event.alias("fill_id"), user.alias("instrument_id"), (day_of("ts") + F.make_dt_interval(hours=F.lit(40))).alias("fill_ts"))
    source = F.when((k == 2) & (event % 10 != 0), None).otherwise(event + F.when(event % 13 == 0, 1).otherwise(0))
    refs = e.select((user % 3).alias("run_id"), event.alias("fill_id"), user.alias("instrument_id"), F.when(k == 0, "BAR").when(k == 1, "TICK").otherwise("MODEL").alias("reference_type"), source.alias("source_id"), F.when(k == 0, user).alias("bar_series_id"))
    sources = {"BAR": b.select(event.alias("source_id"), F.col("bar_series_id").alias("instrument_id"), F.col("available_at").alias("effective_at")), "TICK": e.select(event.alias("source_id"), user.alias("instrument_id"), F.col("ts").alias("effective_at"))}
    cutoffs = ["2024-01-20", "2024-02-10", "2024-03-01"]
    runs = spark.range(3).select(F.col("id").alias("run_id"), F.element_at(F.array(*[F.lit(c).cast("timestamp_ntz") for c in cutoffs]), (F.col("id") + 1).cast("int")).alias("cutoff"))
    return integrity.fill_reference_violations(refs, own, sources, _roles(spark, d), runs).select("run_id", "fill_id", "violation")


@query("touched_orders", "SELECT DISTINCT id AS order_id FROM (SELECT unnest([CASE WHEN l_linenumber % 3 <> 0 THEN l_orderkey END, CASE WHEN l_linenumber % 2 = 0 THEN l_suppkey END]) AS id FROM lineitem) WHERE id IS NOT NULL")
def touched_orders(spark, d):
    """Orders whose totals a change of their fills asks to judge again: the one that a fill had, and the one that it has."""
    changes = table(spark, d, "lineitem").select(F.when(F.col("l_linenumber") % 3 != 0, F.col("l_orderkey")).alias("before"), F.when(F.col("l_linenumber") % 2 == 0, F.col("l_suppkey")).alias("after"))
    return integrity.touched(changes, "before", "after", "order_id")


@query("trade_performance", f"""WITH {FILLS}, {CLOSED}, g AS (SELECT instrument_id, count(*) AS trades, count(*) FILTER (WHERE pnl > 0) AS wins, sum(CASE WHEN pnl > 0 THEN pnl ELSE 0 END) AS gained, sum(CASE WHEN pnl < 0 THEN -pnl ELSE 0 END) AS lost FROM closed GROUP BY instrument_id)
    SELECT instrument_id, trades, wins, round(CASE WHEN lost > 0 THEN CAST(gained AS DOUBLE) / CAST(lost AS DOUBLE) END, 9) AS profit_factor FROM g""")
def trade_performance(spark, d):
    return ledger.trade_performance(_closed(spark, d), ["instrument_id"]).select("instrument_id", "trades", "wins", F.round("profit_factor", 9).alias("profit_factor"))


@query("run_activity", f"""WITH {FILLS}, p AS (SELECT instrument_id, CAST(sum(CASE WHEN side = 'BUY' THEN notional ELSE -notional END) {BY} AS DECIMAL(28,2)) AS held, CAST(100000000 AS DECIMAL(28,2)) AS equity FROM fills),
    t AS (SELECT instrument_id, sum(abs(notional)) AS traded FROM fills GROUP BY instrument_id), m AS (SELECT instrument_id, avg(CAST(equity AS DOUBLE)) AS mean, avg(CAST(held AS DOUBLE) / CAST(equity AS DOUBLE)) AS exposure FROM p GROUP BY instrument_id)
    SELECT instrument_id, round(CAST(traded AS DOUBLE) / mean, 9) AS turnover, round(exposure, 9) AS exposure FROM m JOIN t USING (instrument_id)""")
def run_activity(spark, d):
    """Turnover and exposure of each instrument's fills against a fixed equity."""
    f = fills(spark, d)
    signed = F.when(F.col("side") == "BUY", F.col("notional")).otherwise(-F.col("notional"))
    points = ledger.running(f, ["instrument_id"], ORDERED, signed, "held", "decimal(28,2)").select("instrument_id", "held", F.lit("100000000").cast("decimal(28,2)").alias("equity"))
    return ledger.activity(f, points, ["instrument_id"]).select("instrument_id", F.round("turnover", 9).alias("turnover"), F.round("exposure", 9).alias("exposure"))
