"""Queries of ingestion, integrity rules, accounting, training data and text."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronofold.functions import canonical, text
from chronofold.operators import catalog, ingest, integrity, ledger, ml, pit
from chronofold.plans.catalogue import query
from chronofold.plans.point_in_time import CUTOFF, SQL_CUTOFF
from chronofold.plans.views import BARS, FILLS, bars, day_of, fills, money, sql_ts, table, text_ts

TOTALS = """orders_ AS (SELECT o_orderkey AS order_id, o_orderdate AS submitted_at, CAST(floor(o_totalprice / 2000) AS BIGINT) AS quantity,
        CASE o_orderstatus WHEN 'F' THEN 'FILLED' WHEN 'P' THEN 'PARTIAL' ELSE 'NEW' END AS status FROM orders),
    t AS (SELECT order_id, CAST(sum(quantity) AS BIGINT) AS filled_quantity, min(fill_ts) AS first_fill_ts FROM fills GROUP BY order_id),
    totals AS (SELECT o.*, coalesce(t.filled_quantity, 0) AS filled_quantity, t.first_fill_ts FROM orders_ o LEFT JOIN t USING (order_id))"""


def _orders(spark, d):
    status = F.when(F.col("o_orderstatus") == "F", "FILLED").when(F.col("o_orderstatus") == "P", "PARTIAL").otherwise("NEW")
    return table(spark, d, "orders").select(F.col("o_orderkey").alias("order_id"), F.col("o_orderdate").alias("submitted_at"), F.floor(F.col("o_totalprice") / 2000).cast("bigint").alias("quantity"), status.alias("status"))


@query("order_fill_totals", f"WITH {FILLS}, {TOTALS} SELECT order_id, status, quantity, filled_quantity, {sql_ts('first_fill_ts')} AS first_fill_ts FROM totals")
def order_fill_totals(spark, d):
    return integrity.order_totals(_orders(spark, d), fills(spark, d)).select("order_id", "status", "quantity", "filled_quantity", text_ts("first_fill_ts").alias("first_fill_ts"))


@query("order_fill_violations", f"""WITH {FILLS}, {TOTALS}, v AS (SELECT order_id, CASE WHEN first_fill_ts < submitted_at THEN 'FILL_BEFORE_SUBMISSION' WHEN filled_quantity > quantity THEN 'OVERFILLED'
    WHEN status = 'FILLED' AND filled_quantity <> quantity THEN 'FILLED_NOT_EQUAL' WHEN status = 'PARTIAL' AND NOT (filled_quantity > 0 AND filled_quantity < quantity) THEN 'PARTIAL_NOT_BETWEEN'
    WHEN status = 'NEW' AND filled_quantity <> 0 THEN 'UNEXPECTED_FILL' END AS violation FROM totals) SELECT * FROM v WHERE violation IS NOT NULL""")
def order_fill_violations(spark, d):
    return integrity.order_violations(integrity.order_totals(_orders(spark, d), fills(spark, d))).select("order_id", "violation")


INPUTS = """bound AS (SELECT 1 AS run_id, user_id AS bar_series_id FROM events WHERE user_id % 4 <> 0 GROUP BY user_id),
    inputs AS (SELECT 1 AS run_id, event_id, bar_series_id, bar_open_ts, revision_no + CASE WHEN event_id % 11 = 0 THEN 1000 ELSE 0 END AS revision_no, bar_close_ts + INTERVAL 12 HOUR AS decision_ts FROM bars)"""


def _inputs(b):
    shifted = F.col("revision_no") + F.when(F.col("event_id") % 11 == 0, 1000).otherwise(0)
    return b.select(F.lit(1).alias("run_id"), "event_id", "bar_series_id", "bar_open_ts", shifted.alias("revision_no"), (F.col("bar_close_ts") + F.make_dt_interval(hours=F.lit(12))).alias("decision_ts"))


def _bound(spark, d):
    return table(spark, d, "events").where("user_id % 4 <> 0").select(F.lit(1).alias("run_id"), F.col("user_id").alias("bar_series_id")).distinct()


@query("pit_decision_violations", f"""WITH {BARS}, {INPUTS}, v AS (SELECT i.event_id, CASE WHEN b.available_at IS NULL THEN 'UNKNOWN_BAR' WHEN u.run_id IS NULL THEN 'UNBOUND_SERIES' WHEN b.available_at > i.decision_ts THEN 'LOOK_AHEAD'
    WHEN b.available_at > {SQL_CUTOFF} THEN 'AFTER_CUTOFF' END AS violation FROM inputs i LEFT JOIN bars b USING (bar_series_id, bar_open_ts, revision_no) LEFT JOIN bound u ON u.run_id = i.run_id AND u.bar_series_id = i.bar_series_id)
    SELECT * FROM v WHERE violation IS NOT NULL""")
def pit_decision_violations(spark, d):
    b = bars(spark, d)
    return integrity.decision_violations(_inputs(b), b, _bound(spark, d), "available_at", pit.at(CUTOFF)).select("event_id", "violation")


@query("unbound_series_anti", f"WITH {BARS}, {INPUTS} SELECT i.event_id FROM inputs i ANTI JOIN bound u ON u.run_id = i.run_id AND u.bar_series_id = i.bar_series_id")
def unbound_series_anti(spark, d):
    return integrity.unbound_series(_inputs(bars(spark, d)), _bound(spark, d)).select("event_id")


REFS = """refs AS (SELECT event_id AS fill_id, CASE event_id % 3 WHEN 0 THEN 'BAR' WHEN 1 THEN 'TICK' ELSE 'MODEL' END AS reference_type, CASE WHEN event_id % 3 = 2 AND event_id % 10 <> 0 THEN NULL ELSE event_id + CASE WHEN event_id % 13 = 0 THEN 1 ELSE 0 END END AS source_id,
        user_id AS instrument_id, date_trunc('day', ts)::TIMESTAMP + INTERVAL 40 HOUR AS fill_ts FROM events),
    sources AS (SELECT 'BAR' AS reference_type, event_id AS source_id, bar_series_id AS instrument_id, available_at AS effective_at FROM bars UNION ALL SELECT 'TICK', event_id, user_id, ts FROM events)"""


@query("pit_fill_violations", f"""WITH {BARS}, {REFS}, v AS (SELECT r.fill_id, r.reference_type, CASE WHEN r.reference_type = 'MODEL' THEN CASE WHEN r.source_id IS NOT NULL THEN 'MODEL_WITH_SOURCE' END WHEN s.effective_at IS NULL THEN 'UNKNOWN_SOURCE'
    WHEN s.instrument_id <> r.instrument_id THEN 'OTHER_INSTRUMENT' WHEN s.effective_at > r.fill_ts THEN 'LOOK_AHEAD' WHEN s.effective_at > {SQL_CUTOFF} THEN 'AFTER_CUTOFF' END AS violation
    FROM refs r LEFT JOIN sources s ON s.reference_type = r.reference_type AND s.source_id = r.source_id) SELECT * FROM v WHERE violation IS NOT NULL""")
def pit_fill_violations(spark, d):
    e, b = table(spark, d, "events"), bars(spark, d)
    k = F.col("event_id") % 3
    source = F.when((k == 2) & (F.col("event_id") % 10 != 0), None).otherwise(F.col("event_id") + F.when(F.col("event_id") % 13 == 0, 1).otherwise(0))
    refs = e.select(F.col("event_id").alias("fill_id"), F.when(k == 0, "BAR").when(k == 1, "TICK").otherwise("MODEL").alias("reference_type"), source.alias("source_id"), F.col("user_id").alias("instrument_id"), (day_of("ts") + F.make_dt_interval(hours=F.lit(40))).alias("fill_ts"))
    sources = {"BAR": b.select(F.col("event_id").alias("source_id"), F.col("bar_series_id").alias("instrument_id"), F.col("available_at").alias("effective_at")), "TICK": e.select(F.col("event_id").alias("source_id"), F.col("user_id").alias("instrument_id"), F.col("ts").alias("effective_at"))}
    return integrity.fill_violations(refs, sources, pit.at(CUTOFF)).select("fill_id", "reference_type", "violation")


@query("series_resolution_star", """SELECT c.c_custkey, c.c_name, n.n_name, r.r_name, count(o.o_orderkey) AS n_orders FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
    JOIN nation n ON n.n_nationkey = c.c_nationkey JOIN region r ON r.r_regionkey = n.n_regionkey GROUP BY ALL""")
def series_resolution_star(spark, d):
    """Facts are counted before they meet the dimensions, which Spark broadcasts while they are small."""
    facts = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("o_orderkey").alias("n_orders"))
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return facts.join(c, "c_custkey").select("c_custkey", "c_name", "n_name", "r_name", "n_orders")


@query("adjustment_guard_left", f"""WITH {BARS}, s AS (SELECT DISTINCT bar_series_id FROM bars), a AS (SELECT c_custkey AS bar_series_id, TIMESTAMP '2024-01-01' + to_days(CAST(c_custkey % 40 AS INTEGER)) AS knowledge_cutoff FROM customer WHERE c_custkey % 2 = 0)
    SELECT s.bar_series_id, CASE WHEN a.bar_series_id IS NULL THEN 'RAW' WHEN a.knowledge_cutoff > {SQL_CUTOFF} THEN 'TOO_NEW' ELSE 'OK' END AS outcome FROM s LEFT JOIN a USING (bar_series_id)""")
def adjustment_guard_left(spark, d):
    s = table(spark, d, "events").select(F.col("user_id").alias("bar_series_id")).distinct()
    a = table(spark, d, "customer").where("c_custkey % 2 = 0").select(F.col("c_custkey").alias("bar_series_id"), (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval(days=(F.col("c_custkey") % 40).cast("int"))).alias("knowledge_cutoff"))
    outcome = F.when(F.col("knowledge_cutoff").isNull(), "RAW").when(F.col("knowledge_cutoff") > pit.at(CUTOFF), "TOO_NEW").otherwise("OK")
    return s.join(a, "bar_series_id", "left").select("bar_series_id", outcome.alias("outcome"))


@query("fill_pricing_bps", f"""WITH {FILLS}, e AS (SELECT *, CAST(notional AS DECIMAL(12,2)) AS ref FROM fills), x AS (SELECT *, CAST(ref * CAST(CASE WHEN side = 'BUY' THEN 1.0010 ELSE 0.9990 END AS DECIMAL(5,4)) AS DECIMAL(18,6)) AS px FROM e),
    n AS (SELECT *, CAST(px * CAST(quantity AS DECIMAL(6,0)) AS DECIMAL(24,6)) AS amount FROM x), c AS (SELECT *, CAST(amount * CAST(0.0005 AS DECIMAL(5,4)) AS DECIMAL(30,10)) AS fee, CAST(CASE WHEN side = 'SELL' THEN amount * CAST(0.0025 AS DECIMAL(5,4)) ELSE 0 END AS DECIMAL(30,10)) AS tax FROM n)
    SELECT order_id, line, side, px AS execution_price, amount AS notional, fee AS commission, tax, CAST(abs(px - ref) * CAST(quantity AS DECIMAL(6,0)) AS DECIMAL(24,6)) AS slippage,
    CAST(CASE WHEN side = 'BUY' THEN -(CAST(amount AS DECIMAL(30,10)) + fee + tax) ELSE CAST(amount AS DECIMAL(30,10)) - fee - tax END AS DECIMAL(30,10)) AS cash_delta FROM c""")
def fill_pricing_bps(spark, d):
    f = fills(spark, d).withColumn("reference_price", F.col("notional").cast("decimal(12,2)")).drop("notional")
    p = ledger.priced(f, 5, 10, 25)
    return p.select("order_id", "line", "side", F.col("execution_price").cast("decimal(18,6)").alias("execution_price"), "notional", F.col("commission").cast("decimal(30,10)").alias("commission"), "tax", "slippage", "cash_delta")


ORDERED = ["fill_ts", "order_id", "line", "quantity", "notional", "side"]
SIGNED = "CASE WHEN side = 'BUY' THEN -notional ELSE notional END"
SQL_ORDER = "fill_ts, order_id, line, quantity, notional, side"
BY = f"OVER (PARTITION BY instrument_id ORDER BY {SQL_ORDER} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


@query("cash_ledger_running", f"WITH {FILLS} SELECT instrument_id, order_id, line, {sql_ts('fill_ts')} AS fill_ts, CAST(sum({SIGNED}) {BY} AS DECIMAL(18,2)) AS cash FROM fills")
def cash_ledger_running(spark, d):
    signed = F.when(F.col("side") == "BUY", -F.col("notional")).otherwise(F.col("notional"))
    out = ledger.running(fills(spark, d), ["instrument_id"], ORDERED, signed, "cash", "decimal(18,2)")
    return out.select("instrument_id", "order_id", "line", text_ts("fill_ts").alias("fill_ts"), "cash")


@query("position_ledger_running", f"WITH {FILLS} SELECT instrument_id, order_id, line, {sql_ts('fill_ts')} AS fill_ts, CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) {BY} AS BIGINT) AS position FROM fills")
def position_ledger_running(spark, d):
    signed = F.when(F.col("side") == "BUY", F.col("quantity")).otherwise(-F.col("quantity"))
    out = ledger.running(fills(spark, d), ["instrument_id"], ORDERED, signed, "position", "bigint")
    return out.select("instrument_id", "order_id", "line", text_ts("fill_ts").alias("fill_ts"), "position")


@query("equity_exposure", f"""WITH {FILLS} SELECT instrument_id, CAST(sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS BIGINT) AS position, CAST(sum({SIGNED}) AS DECIMAL(18,2)) AS cash,
    CAST(max(notional) * sum(CASE WHEN side = 'BUY' THEN quantity ELSE -quantity END) AS DECIMAL(28,2)) AS market_value FROM fills GROUP BY instrument_id""")
def equity_exposure(spark, d):
    buy = F.col("side") == "BUY"
    position = F.sum(F.when(buy, F.col("quantity")).otherwise(-F.col("quantity")))
    return fills(spark, d).groupBy("instrument_id").agg(position.alias("position"), F.sum(F.when(buy, -F.col("notional")).otherwise(F.col("notional"))).cast("decimal(18,2)").alias("cash"), (F.max("notional") * position.cast("decimal(12,0)")).cast("decimal(28,2)").alias("market_value"))


CLOSED = f"""p AS (SELECT instrument_id, order_id, line, quantity, side, notional AS price, lag(side) OVER w AS before, lag(notional) OVER w AS entry_price FROM fills WINDOW w AS (PARTITION BY instrument_id ORDER BY {SQL_ORDER})),
    closed AS (SELECT *, CAST((price - entry_price) * quantity AS DECIMAL(28,2)) AS pnl FROM p WHERE side = 'SELL' AND before = 'BUY')"""


def _closed(spark, d):
    return ledger.closed_trades(fills(spark, d).withColumn("price", F.col("notional")), ["instrument_id"], ORDERED)


@query("closed_trade_pnl", f"WITH {FILLS}, {CLOSED} SELECT instrument_id, order_id, line, quantity, price, entry_price, pnl FROM closed")
def closed_trade_pnl(spark, d):
    return _closed(spark, d).select("instrument_id", "order_id", "line", "quantity", "price", "entry_price", "pnl")


@query("run_summary", f"""WITH {FILLS}, {CLOSED} SELECT instrument_id, count(*) AS trade_count, count(*) FILTER (WHERE pnl > 0) AS winning, count(*) FILTER (WHERE pnl < 0) AS losing,
    CAST(count(*) FILTER (WHERE pnl > 0) AS DOUBLE) / count(*) AS win_rate, CAST(sum(pnl) AS DECIMAL(28,2)) AS net_pnl FROM closed GROUP BY instrument_id""")
def run_summary(spark, d):
    out = _closed(spark, d).groupBy("instrument_id").agg(F.count(F.lit(1)).alias("trade_count"), F.count_if(F.col("pnl") > 0).alias("winning"), F.count_if(F.col("pnl") < 0).alias("losing"), F.sum("pnl").cast("decimal(28,2)").alias("net_pnl"))
    return out.withColumn("win_rate", F.col("winning").cast("double") / F.col("trade_count"))


@query("drawdown", f"""WITH s AS (SELECT l_suppkey AS supplier_id, l_shipdate AS day, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS total FROM lineitem GROUP BY ALL)
    SELECT supplier_id, {sql_ts('day')} AS day, CAST(total AS DECIMAL(18,2)) AS total, CAST(max(total) OVER (PARTITION BY supplier_id ORDER BY day) - total AS DECIMAL(18,2)) AS drawdown FROM s""")
def drawdown(spark, d):
    s = table(spark, d, "lineitem").groupBy(F.col("l_suppkey").alias("supplier_id"), F.col("l_shipdate").alias("day")).agg(F.sum(money("l_extendedprice")).cast("decimal(18,2)").alias("total"))
    return ledger.drawdown(s, ["supplier_id"], ["day"], "total").select("supplier_id", text_ts("day").alias("day"), "total", F.col("drawdown").cast("decimal(18,2)").alias("drawdown"))


STEPS = "n AS (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS k FROM events), stepped AS (SELECT *, k // 20 AS sample_no, k % 20 AS step_no FROM n)"


def _stepped(spark, d):
    return ml.steps(table(spark, d, "events"), ["user_id"], ["ts", "event_id"], 20)


@query("complete_window_having", f"WITH {STEPS} SELECT user_id, CAST(sample_no AS BIGINT) AS sample_no FROM stepped GROUP BY user_id, sample_no HAVING count(*) = 20 AND min(step_no) = 0 AND max(step_no) = 19")
def complete_window_having(spark, d):
    return ml.complete_samples(_stepped(spark, d), ["user_id"], 20)


@query("ordered_window_agg", f"WITH {STEPS} SELECT user_id, CAST(sample_no AS BIGINT) AS sample_no, string_agg(event_type, ',' ORDER BY step_no) AS steps, bool_and(event_type <> 'error') AS clean FROM stepped GROUP BY user_id, sample_no")
def ordered_window_agg(spark, d):
    got = _stepped(spark, d).groupBy("user_id", "sample_no").agg(ml.in_order("step_no", "event_type").alias("rows"), F.bool_and(F.col("event_type") != "error").alias("clean"))
    return got.select("user_id", "sample_no", F.array_join(F.col("rows.event_type"), ",").alias("steps"), "clean")


METRICS = "m AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY ALL), o AS (SELECT user_id, string_agg(event_type || ':' || n, ',' ORDER BY event_type) AS metrics FROM m GROUP BY user_id)"


def _metrics(spark, d):
    m = table(spark, d, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n"))
    as_map = m.groupBy("user_id").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("event_type", "n")))).alias("metrics"))
    entries = F.transform(F.map_entries("metrics"), lambda e: F.concat(e["key"], F.lit(":"), e["value"].cast("string")))
    return as_map.select("user_id", F.array_join(entries, ",").alias("metrics"))


@query("metric_object_agg", f"WITH {METRICS} SELECT * FROM o")
def metric_object_agg(spark, d):
    return _metrics(spark, d)


@query("strategy_report", f"""WITH {METRICS}, v AS (SELECT user_id, CAST(avg(value) AS DOUBLE) AS score FROM events WHERE event_type = 'purchase' GROUP BY user_id)
    SELECT c.c_custkey AS run_id, c.c_name, n.n_name, o.metrics, CAST(row_number() OVER (ORDER BY round(v.score, 6) DESC NULLS LAST, c.c_custkey) AS INTEGER) AS place FROM customer c JOIN nation n ON n.n_nationkey = c.c_nationkey LEFT JOIN o ON o.user_id = c.c_custkey LEFT JOIN v ON v.user_id = c.c_custkey
    QUALIFY place <= 100""")
def strategy_report(spark, d):
    """A report of the 100 best runs; metrics are aggregated before the join (a lateral aggregate, decorrelated)."""
    v = table(spark, d, "events").where("event_type = 'purchase'").groupBy("user_id").agg(F.avg("value").alias("score"))
    c = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    c = c.join(v.withColumnRenamed("user_id", "c_custkey"), "c_custkey", "left")
    best = c.orderBy(F.round("score", 6).desc_nulls_last(), "c_custkey").limit(100)
    best = best.join(_metrics(spark, d).withColumnRenamed("user_id", "c_custkey"), "c_custkey", "left")
    place = F.row_number().over(Window.orderBy(F.round("score", 6).desc_nulls_last(), "c_custkey"))
    return best.select(F.col("c_custkey").alias("run_id"), "c_name", "n_name", "metrics", place.cast("int").alias("place"))


@query("leakage_audit_count", f"WITH {BARS} SELECT count(*) AS leaks FROM bars s JOIN bars f ON f.bar_series_id = s.bar_series_id AND f.bar_open_ts = s.bar_open_ts WHERE s.revision_no = 1 AND f.available_at > s.bar_close_ts + INTERVAL 12 HOUR")
def leakage_audit_count(spark, d):
    b = bars(spark, d)
    keys = ["bar_series_id", "bar_open_ts"]
    samples = b.where("revision_no = 1").select(*keys, (F.col("bar_close_ts") + F.make_dt_interval(hours=F.lit(12))).alias("decision_ts"))
    return ml.leaks(samples, b.select(*keys, F.col("available_at").alias("feature_available_at")), keys).agg(F.count(F.lit(1)).alias("leaks"))


@query("feature_availability_violations", """WITH f AS (SELECT event_id, ts AS available_at, date_trunc('hour', ts) + INTERVAL 40 MINUTE AS window_end_ts, ts + to_minutes(CAST(event_id % 5 - 2 AS BIGINT)) AS source_available_at FROM events)
    SELECT event_id, CASE WHEN available_at < window_end_ts THEN 'BEFORE_WINDOW_END' ELSE 'BEFORE_SOURCE' END AS violation FROM f WHERE available_at < window_end_ts OR available_at < source_available_at""")
def feature_availability_violations(spark, d):
    hour = day_of("ts") + F.make_dt_interval(hours=F.hour("ts"), mins=F.lit(40))
    f = table(spark, d, "events").select("event_id", F.col("ts").alias("available_at"), hour.alias("window_end_ts"), (F.col("ts") + F.make_dt_interval(mins=(F.col("event_id") % 5 - 2).cast("int"))).alias("source_available_at"))
    return integrity.feature_violations(f).select("event_id", "violation")


@query("sliding_windows", f"""WITH {BARS}, c AS (SELECT * FROM bars WHERE revision_no = 1), n AS (SELECT *, row_number() OVER (PARTITION BY bar_series_id ORDER BY bar_open_ts) AS k, min(bar_open_ts) OVER w AS first_ts, sum(close_price) OVER w AS total FROM c WINDOW w AS (PARTITION BY bar_series_id ORDER BY bar_open_ts ROWS 4 PRECEDING))
    SELECT bar_series_id, {sql_ts('first_ts')} AS first_ts, {sql_ts('bar_open_ts')} AS last_ts, CAST(total AS DECIMAL(18,2)) AS total FROM n WHERE k >= 5 AND (k - 5) % 2 = 0""")
def sliding_windows(spark, d):
    out = ml.sliding(bars(spark, d).where("revision_no = 1"), ["bar_series_id"], "bar_open_ts", "close_price", 5, 2)
    return out.select("bar_series_id", text_ts("first_ts").alias("first_ts"), text_ts("last_ts").alias("last_ts"), F.col("total").cast("decimal(18,2)").alias("total"))


@query("walk_forward_folds", """WITH f AS (SELECT CAST(i AS INTEGER) AS fold, DATE '2024-01-01' + CAST(i * 7 AS INTEGER) AS a, DATE '2024-01-01' + CAST(i * 7 + 7 AS INTEGER) AS b FROM range(4) t(i)),
    p AS (SELECT fold, CASE WHEN d >= a AND d < b THEN 'TEST' WHEN d >= a - 2 AND d < a THEN 'PURGED' WHEN d >= b AND d < b + 1 THEN 'EMBARGOED' ELSE 'TRAIN' END AS part FROM (SELECT CAST(ts AS DATE) AS d FROM events) CROSS JOIN f)
    SELECT fold, part, count(*) AS n FROM p GROUP BY ALL""")
def walk_forward_folds(spark, d):
    days = table(spark, d, "events").groupBy(F.col("ts").cast("date").alias("day")).agg(F.count(F.lit(1)).alias("n"))
    folded = spark.range(1).select(F.inline(ml.folds("2024-01-01", 4, 7)))
    return ml.assigned(days, "day", folded, 2, 1).groupBy("fold", "part").agg(F.sum("n").alias("n"))


@query("adjusted_prices", f"""WITH {BARS}, f AS (SELECT bar_series_id, bar_open_ts AS effective_ts, CAST(1 + (bar_series_id % 3) AS DECIMAL(4,2)) / 2 AS unused, CAST(1 + bar_series_id % 3 AS DECIMAL(4,2)) AS multiplier, CAST(bar_series_id % 7 AS DECIMAL(4,2)) AS addend FROM bars WHERE revision_no = 1 AND day(bar_open_ts) % 5 = 0),
    g AS (SELECT *, lead(effective_ts) OVER (PARTITION BY bar_series_id ORDER BY effective_ts) AS until FROM f)
    SELECT b.bar_series_id, {sql_ts('b.bar_open_ts')} AS bar_open_ts, CAST(b.close_price * coalesce(g.multiplier, 1) + coalesce(g.addend, 0) AS DECIMAL(18,2)) AS adjusted_close FROM bars b
    LEFT JOIN g ON g.bar_series_id = b.bar_series_id AND g.effective_ts <= b.bar_open_ts AND (g.until IS NULL OR g.until > b.bar_open_ts) WHERE b.revision_no = 1""")
def adjusted_prices(spark, d):
    b = bars(spark, d).where("revision_no = 1")
    f = b.where(F.dayofmonth("bar_open_ts") % 5 == 0).select("bar_series_id", F.col("bar_open_ts").alias("effective_ts"), (1 + F.col("bar_series_id") % 3).cast("decimal(4,2)").alias("multiplier"), (F.col("bar_series_id") % 7).cast("decimal(4,2)").alias("addend"))
    return ml.adjusted(b, f).select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), F.col("adjusted_close").cast("decimal(18,2)").alias("adjusted_close"))


@query("book_reconstruct", """WITH d AS (SELECT user_id % 10 AS book, ts, event_id, CASE WHEN event_id % 500 = 0 THEN 'CLEAR' WHEN event_type = 'error' THEN 'DELETE' ELSE 'SET' END AS action, CASE WHEN event_id % 2 = 0 THEN 'BID' ELSE 'ASK' END AS side, CAST(floor(value / 10) * 10 AS BIGINT) AS price, event_id % 100 AS quantity FROM events),
    c AS (SELECT book, max(row(ts, event_id)) AS cleared FROM d WHERE action = 'CLEAR' GROUP BY book),
    l AS (SELECT d.*, row_number() OVER (PARTITION BY d.book, side, price ORDER BY ts DESC, event_id DESC) AS rk FROM d LEFT JOIN c ON c.book = d.book WHERE action <> 'CLEAR' AND (c.cleared IS NULL OR row(ts, event_id) > c.cleared))
    SELECT book, side, price, quantity FROM l WHERE rk = 1 AND action = 'SET'""")
def book_reconstruct(spark, d):
    action = F.when(F.col("event_id") % 500 == 0, "CLEAR").when(F.col("event_type") == "error", "DELETE").otherwise("SET")
    deltas = table(spark, d, "events").select((F.col("user_id") % 10).alias("book"), "ts", "event_id", action.alias("action"), F.when(F.col("event_id") % 2 == 0, "BID").otherwise("ASK").alias("side"), (F.floor(F.col("value") / 10) * 10).cast("bigint").alias("price"), (F.col("event_id") % 100).alias("quantity"))
    return ml.book(deltas, ["book"], ["ts", "event_id"])


RAW = """r AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, l_quantity, l_orderkey % 20 AS batch FROM lineitem),
    c AS (SELECT *, price AS open, CAST(price + 5 AS DECIMAL(18,2)) AS high, CASE WHEN l_partkey % 29 = 0 THEN CAST(price + 9 AS DECIMAL(18,2)) ELSE CAST(price - 5 AS DECIMAL(18,2)) END AS low, CASE WHEN l_partkey % 31 = 0 THEN CAST(price + 6 AS DECIMAL(18,2)) ELSE price END AS close,
        CASE WHEN l_suppkey % 37 = 0 THEN -1 ELSE 1 END * CAST(l_quantity AS BIGINT) AS volume, CASE WHEN l_suppkey % 41 = 0 THEN 'other' ELSE 'asked' END AS symbol, CASE WHEN l_partkey % 43 = 0 THEN 6 ELSE 7 END AS declared FROM r)"""


def _raw(spark, d):
    l = table(spark, d, "lineitem")
    price = money("l_extendedprice")
    part, supp = F.col("l_partkey"), F.col("l_suppkey")
    return l.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", (F.col("l_orderkey") % 20).alias("batch"), price.alias("open"), money(price + 5).alias("high"),
        F.when(part % 29 == 0, money(price + 9)).otherwise(money(price - 5)).alias("low"), F.when(part % 31 == 0, money(price + 6)).otherwise(price).alias("close"),
        (F.when(supp % 37 == 0, -1).otherwise(1) * F.col("l_quantity").cast("bigint")).alias("volume"), F.when(supp % 41 == 0, "other").otherwise("asked").alias("symbol"),
        F.lit(2).alias("response_type"), F.when(part % 43 == 0, 6).otherwise(7).alias("declared_count"), F.lit("1403/01/01").alias("source_date"), F.lit("2024-03-20").cast("date").alias("trading_date"), F.lit(None).cast("string").alias("source_time"),
    )


ISSUES = """concat_ws(',', CASE WHEN symbol <> 'asked' THEN 'SYMBOL_MISMATCH:l18' END, CASE WHEN declared <> 7 THEN 'COUNT_MISMATCH:count' END, CASE WHEN volume < 0 THEN 'NEGATIVE_VOLUME:volume' END,
    CASE WHEN high < low THEN 'INVALID_OHLC:' END, CASE WHEN open < low OR open > high THEN 'INVALID_OHLC:open' END, CASE WHEN close < low OR close > high THEN 'INVALID_OHLC:close' END)"""


@query("row_validation_codes", f"WITH {RAW}, v AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, {ISSUES} AS codes FROM c) SELECT * FROM v WHERE codes <> ''")
def row_validation_codes(spark, d):
    got = _raw(spark, d).withColumn("issues", ingest.row_issues(F.lit("asked"), F.lit(7)))
    codes = F.array_join(F.transform("issues", lambda x: F.concat(x["code"], F.lit(":"), F.coalesce(x["field"], F.lit("")))), ",")
    return got.where(F.size("issues") > 0).select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", codes.alias("codes"))


@query("dedup_policy", """WITH k AS (SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS q, CAST(l_extendedprice AS DECIMAL(18,2)) AS p, l_suppkey FROM lineitem),
    g AS (SELECT l_orderkey, l_linenumber, count(*) AS n, min(sha256(concat_ws('|', q, p, l_suppkey))) = max(sha256(concat_ws('|', q, p, l_suppkey))) AS same FROM k GROUP BY ALL)
    SELECT l_orderkey, l_linenumber, CASE WHEN n = 1 THEN 'SINGLE' WHEN same THEN 'DUPLICATE_IDENTICAL' ELSE 'DUPLICATE_CONFLICT' END AS outcome, CAST(CASE WHEN n = 1 OR same THEN 1 ELSE 0 END AS BIGINT) AS used FROM g""")
def dedup_policy(spark, d):
    l = table(spark, d, "lineitem")
    digest = F.sha2(F.concat_ws("|", F.col("l_quantity").cast("bigint").cast("string"), money("l_extendedprice").cast("string"), F.col("l_suppkey").cast("string")), 256)
    got = ingest.apply_duplicate_policy(l.select("l_orderkey", "l_linenumber", digest.alias("digest"), F.lit(True).alias("accepted")), ["l_orderkey", "l_linenumber"], "digest", "digest")
    return got.groupBy("l_orderkey", "l_linenumber").agg(F.coalesce(F.max("duplicate_code"), F.lit("SINGLE")).alias("outcome"), F.count_if("included").alias("used"))


@query("batch_terminal_status", f"""WITH {RAW}, b AS (SELECT l_suppkey AS batch, count(*) AS received, count(*) FILTER (WHERE volume >= 0 AND symbol = 'asked' AND l_suppkey % 3 <> 0 OR l_suppkey % 3 = 1) AS accepted FROM c GROUP BY ALL)
    SELECT batch, received, accepted, received - accepted AS rejected, CASE WHEN accepted > 0 AND received > accepted THEN 'PARTIAL' WHEN received > accepted THEN 'QUARANTINED' ELSE 'SUCCEEDED' END AS status FROM b""")
def batch_terminal_status(spark, d):
    k = F.col("l_suppkey") % 3
    included = ((F.col("volume") >= 0) & (F.col("symbol") == "asked") & (k != 0)) | (k == 1)
    return ingest.batch_status(_raw(spark, d).withColumn("batch", F.col("l_suppkey")), ["batch"], included)


@query("append_if_changed", """WITH e AS (SELECT user_id, ts, event_id, CAST(floor(value / 25) AS BIGINT) AS level, event_type FROM events),
    stored AS (SELECT user_id, event_id % 4 + 1 AS revision_no, level, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id, event_id % 4 ORDER BY ts DESC, event_id DESC) AS rk FROM e) WHERE rk = 1 AND user_id % 3 <> 0),
    top AS (SELECT user_id, max(revision_no) AS base, arg_max(level, revision_no) AS level, arg_max(event_type, revision_no) AS event_type FROM stored GROUP BY user_id),
    every AS (SELECT user_id, base, level, event_type, NULL AS ts, NULL AS event_id, 0 AS fresh FROM top UNION ALL SELECT user_id, NULL, level, event_type, ts, event_id, 1 FROM e),
    x AS (SELECT *, row_number() OVER w AS pos, lag(level) OVER w AS l0, lag(event_type) OVER w AS t0, coalesce(max(base) OVER (PARTITION BY user_id), 0) AS b FROM every WINDOW w AS (PARTITION BY user_id ORDER BY fresh, ts, event_id)),
    k AS (SELECT *, CASE WHEN fresh = 1 AND (pos = 1 OR l0 <> level OR t0 <> event_type) THEN 1 ELSE 0 END AS kept FROM x),
    n AS (SELECT *, CAST(b + sum(kept) OVER (PARTITION BY user_id ORDER BY fresh, ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS revision_no FROM k)
    SELECT user_id, event_id, CASE WHEN kept = 0 THEN 'UNCHANGED' WHEN revision_no = 1 THEN 'INSERTED' ELSE 'CORRECTED' END AS outcome, revision_no FROM n WHERE fresh = 1""")
def append_if_changed(spark, d):
    """Against a store that holds up to four revisions of two users in three."""
    e = table(spark, d, "events").select("user_id", "ts", "event_id", F.floor(F.col("value") / 25).cast("bigint").alias("level"), "event_type")
    newest = F.max(F.struct("ts", "event_id", "level", "event_type")).alias("n")
    stored = e.where("user_id % 3 <> 0").groupBy("user_id", (F.col("event_id") % 4 + 1).alias("revision_no")).agg(newest).select("user_id", "revision_no", "n.level", "n.event_type")
    return ingest.append_if_changed(stored, e, ["user_id"], ["level", "event_type"], ["ts", "event_id"]).select("user_id", "event_id", "outcome", "revision_no")


@query("source_watermark", "SELECT user_id, strftime(max(ts), '%Y-%m-%d') AS watermark FROM events WHERE event_type <> 'error' GROUP BY user_id")
def source_watermark(spark, d):
    return table(spark, d, "events").where("event_type <> 'error'").groupBy("user_id").agg(F.date_format(F.max("ts"), "yyyy-MM-dd").alias("watermark"))


@query("insert_if_absent", "SELECT p.p_partkey FROM part p WHERE NOT EXISTS (SELECT 1 FROM supplier s WHERE s.s_suppkey = p.p_partkey)")
def insert_if_absent(spark, d):
    return ingest.insert_if_absent(table(spark, d, "supplier").select(F.col("s_suppkey").alias("p_partkey")), table(spark, d, "part").select("p_partkey"), ["p_partkey"])


@query("raw_event_latest_outcome", """SELECT c.c_custkey, arg_max(o.o_orderstatus, row(o.o_orderdate, o.o_orderkey)) AS outcome FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey""")
def raw_event_latest_outcome(spark, d):
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderdate", "o_orderkey", F.col("o_orderstatus").alias("outcome"))
    return ingest.latest_outcome(table(spark, d, "customer").select("c_custkey"), o, ["c_custkey"], ["o_orderdate", "o_orderkey"]).select("c_custkey", "outcome")


@query("manifest_set_diff", """(SELECT c_nationkey AS k, 'LEFT' AS side FROM customer EXCEPT ALL SELECT s_nationkey, 'LEFT' FROM supplier)
    UNION ALL (SELECT s_nationkey, 'RIGHT' FROM supplier EXCEPT ALL SELECT c_nationkey, 'RIGHT' FROM customer)""")
def manifest_set_diff(spark, d):
    return integrity.set_difference(table(spark, d, "customer").select(F.col("c_nationkey").alias("k")), table(spark, d, "supplier").select(F.col("s_nationkey").alias("k")))


@query("check_ohlc_violations", f"""WITH {RAW}, v AS (SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, concat_ws(',', CASE WHEN high < low THEN 'HIGH_BELOW_LOW' END, CASE WHEN open < low OR open > high THEN 'OPEN_OUTSIDE' END, CASE WHEN close < low OR close > high THEN 'CLOSE_OUTSIDE' END,
    CASE WHEN least(open, high, low, close) < 0 THEN 'NEGATIVE_PRICE' END, CASE WHEN volume < 0 THEN 'NEGATIVE_VOLUME' END) AS rules FROM c) SELECT * FROM v WHERE rules <> ''""")
def check_ohlc_violations(spark, d):
    return integrity.ohlc_violations(_raw(spark, d), "open", "high", "low", "close", "volume").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", "rules")


@query("check_num_nonnulls", "SELECT d.doc_id, CAST((l.quality IS NOT NULL)::INT + (l.toxic IS NOT NULL)::INT + (d.lang IS NOT NULL)::INT AS INTEGER) AS n FROM documents d LEFT JOIN labels l USING (doc_id)")
def check_num_nonnulls(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").join(table(spark, d, "labels"), "doc_id", "left").select("doc_id", integrity.num_nonnulls("quality", "toxic", "lang").alias("n"))


@query("check_vector_cardinality", "SELECT vec_id, CAST(len(embedding) AS INTEGER) AS length FROM embeddings WHERE len(embedding) <> 64 + CASE WHEN vec_id % 9 = 0 THEN 1 ELSE 0 END")
def check_vector_cardinality(spark, d):
    return integrity.vector_violations(table(spark, d, "embeddings"), "embedding", 64 + F.when(F.col("vec_id") % 9 == 0, 1).otherwise(0)).select("vec_id", "length")


@query("row_is_distinct", "SELECT c_custkey FROM customer WHERE row(c_nationkey, c_mktsegment) IS DISTINCT FROM row(c_custkey % 25, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END)")
def row_is_distinct(spark, d):
    a = [F.col("c_nationkey").cast("bigint"), F.col("c_mktsegment")]
    b = [F.col("c_custkey") % 25, F.when(F.col("c_custkey") % 2 == 0, F.col("c_mktsegment"))]
    return table(spark, d, "customer").where(integrity.is_distinct(a, b)).select("c_custkey")


@query("partition_month_routing", "SELECT strftime(ts, '%Y-%m') AS event_month, CAST(user_id % 8 AS INTEGER) AS bucket, count(*) AS n FROM events GROUP BY ALL")
def partition_month_routing(spark, d):
    return table(spark, d, "events").groupBy(F.date_format("ts", "yyyy-MM").alias("event_month"), (F.col("user_id") % 8).cast("int").alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query("snapshot_component_stats", f"WITH {BARS} SELECT bar_series_id, count(*) AS row_count, {sql_ts('max(available_at)')} AS max_available_at, {sql_ts('max(system_available_at)')} AS max_system_available_at FROM bars WHERE is_final GROUP BY bar_series_id")
def snapshot_component_stats(spark, d):
    return bars(spark, d).where("is_final").groupBy("bar_series_id").agg(F.count(F.lit(1)).alias("row_count"), text_ts(F.max("available_at")).alias("max_available_at"), text_ts(F.max("system_available_at")).alias("max_system_available_at"))


PLAIN = "regexp_replace(regexp_replace(CAST(close_price AS VARCHAR), '(\\.\\d*?)0+$', '\\1'), '\\.$', '')"
JSON = f"""'{{"bar_open_ts":"' || strftime(bar_open_ts, '%Y-%m-%dT%H:%M:%SZ') || '","bar_series_id":' || bar_series_id || ',"close_price":"' || {PLAIN} || '","revision_no":' || revision_no || '}}'"""


def _json_rows(spark, d):
    fields = {"bar_open_ts": canonical.quoted(F.date_format("bar_open_ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")), "bar_series_id": F.col("bar_series_id").cast("string"), "revision_no": F.col("revision_no").cast("string"), "close_price": canonical.quoted(canonical.plain_column(F.col("close_price")))}
    return bars(spark, d).where("is_final").select("bar_series_id", "bar_open_ts", "revision_no", canonical.json_object(fields).alias("line"))


@query("canonical_row_hash", f"WITH {BARS} SELECT bar_series_id, {sql_ts('bar_open_ts')} AS bar_open_ts, revision_no, sha256({JSON}) AS row_sha256 FROM bars WHERE is_final")
def canonical_row_hash(spark, d):
    return _json_rows(spark, d).select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), "revision_no", F.sha2("line", 256).alias("row_sha256"))


@query("snapshot_hash", f"WITH {BARS}, j AS (SELECT *, {JSON} AS line FROM bars WHERE is_final) SELECT bar_series_id, sha256(string_agg(line || chr(10), '' ORDER BY bar_open_ts, revision_no)) AS component_sha256 FROM j GROUP BY bar_series_id")
def snapshot_hash(spark, d):
    rows = F.array_sort(F.collect_list(F.struct("bar_open_ts", "revision_no", F.concat("line", F.lit("\n")).alias("line"))))
    return _json_rows(spark, d).groupBy("bar_series_id").agg(F.sha2(F.array_join(F.transform(rows, lambda x: x["line"]), ""), 256).alias("component_sha256"))


@query("metadata_merge", "SELECT event_id, CAST(json_extract_string(m, '$.k') AS BIGINT) AS k, json_extract_string(m, '$.z') AS z FROM (SELECT event_id, json_merge_patch(props, CASE WHEN event_id % 2 = 0 THEN '{\"k\":7}' ELSE '{\"z\":\"1\"}' END) AS m FROM events)")
def metadata_merge(spark, d):
    """A shallow merge in which the patch wins."""
    patch = F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("k"), F.lit("7"))).otherwise(F.create_map(F.lit("z"), F.lit("1")))
    merged = F.map_zip_with(F.from_json("props", "map<string,string>"), patch, lambda k, a, b: F.coalesce(b, a))
    return table(spark, d, "events").select("event_id", merged.alias("m")).select("event_id", F.col("m.k").cast("bigint").alias("k"), F.col("m.z").alias("z"))


@query("digit_normalize", "SELECT doc_id, sha256(translate(translate(coalesce(text, ''), '0123456789', '۰۱۲۳۴۵۶۷۸۹') || n_chars, '۰۱۲۳۴۵۶۷۸۹', '0123456789')) AS digest FROM documents")
def digit_normalize(spark, d):
    persian = F.translate(F.coalesce("text", F.lit("")), text.DIGITS, text.PERSIAN_DIGITS)
    return table(spark, d, "documents").select("doc_id", F.sha2(text.normalize_digits(F.concat(persian, F.col("n_chars").cast("string"))), 256).alias("digest"))


JALALI = """j AS (SELECT event_id, CAST(1300 + event_id % 120 AS INTEGER) AS y, CAST(1 + event_id % 13 AS INTEGER) AS m, CAST(1 + event_id % 31 AS INTEGER) AS d FROM events),
    v AS (SELECT *, y - 979 AS jy, y % 33 IN (1, 5, 9, 13, 17, 22, 26, 30) AS leap FROM j)"""


@query("jalali_parse", f"""WITH {JALALI} SELECT event_id, CASE WHEN m <= 12 AND d <= CASE WHEN m <= 6 THEN 31 WHEN m <= 11 OR leap THEN 30 ELSE 29 END
    THEN strftime(DATE '1600-03-20' + CAST(365 * jy + (jy // 33) * 8 + ((jy % 33) + 3) // 4 + CASE WHEN m <= 7 THEN 31 * (m - 1) ELSE 186 + 30 * (m - 7) END + d - 1 AS INTEGER), '%Y-%m-%d') END AS trading_date FROM v""")
def jalali_parse(spark, d):
    e = F.col("event_id")
    s = F.format_string("%04d/%02d/%02d", 1300 + e % 120, 1 + e % 13, 1 + e % 31)
    return table(spark, d, "events").select("event_id", F.date_format(text.jalali_date(F.translate(s, text.DIGITS, text.PERSIAN_DIGITS)), "yyyy-MM-dd").alias("trading_date"))


@query("source_time_parse", "WITH t AS (SELECT event_id, event_id % 26 AS h, event_id % 61 AS m FROM events) SELECT event_id, CAST(CASE WHEN h <= 23 AND m <= 59 THEN h * 3600 + m * 60 END AS INTEGER) AS seconds FROM t")
def source_time_parse(spark, d):
    e = F.col("event_id")
    return table(spark, d, "events").select("event_id", text.source_time(F.format_string("%02d:%02d", e % 26, e % 61)).cast("int").alias("seconds"))


@query("isin_normalize", "SELECT c_custkey, CASE WHEN c_custkey % 3 <> 0 THEN 'IR' || lpad(CAST(c_custkey AS VARCHAR), 10, '0') END AS isin FROM customer")
def isin_normalize(spark, d):
    raw = F.concat(F.when(F.col("c_custkey") % 3 != 0, " ir").otherwise("i-"), F.lpad(F.col("c_custkey").cast("string"), 10, "0"))
    return table(spark, d, "customer").select("c_custkey", text.normalize_isin(raw).alias("isin"))


@query("symbol_normalize")
def symbol_normalize(spark, d):
    return table(spark, d, "customer").select("c_custkey", text.normalize_symbol(F.concat(F.lit(" ك "), "c_name", F.lit(" ي۱ "))).alias("symbol"))


@query("record_key", "SELECT event_id, 'brsapi|candlestick|type=2|s' || user_id || '|' || CASE WHEN event_type = 'error' THEN 'unknown-date' ELSE strftime(ts, '%Y-%m-%d') END AS record_key FROM events")
def record_key(spark, d):
    day = F.when(F.col("event_type") != "error", F.date_format("ts", "yyyy-MM-dd"))
    return table(spark, d, "events").select("event_id", text.record_key(F.concat(F.lit("s"), F.col("user_id").cast("string")), day).alias("record_key"))


CATALOG = """ids AS (SELECT 'ISIN' AS kind, 'I' || c_custkey AS v, c_custkey AS instrument_id FROM customer WHERE c_custkey % 4 <> 0 UNION ALL SELECT 'SYMBOL', 'S' || c_custkey, CASE WHEN c_custkey % 7 = 0 THEN c_custkey + 1 ELSE c_custkey END FROM customer WHERE c_custkey % 5 <> 0),
    entries AS (SELECT c_custkey, 'I' || c_custkey AS isin, 'S' || c_custkey AS symbol, CASE WHEN c_custkey % 3 = 0 THEN 'P' END AS previous FROM customer)"""


@query("instrument_identity", f"""WITH {CATALOG} SELECT e.c_custkey, CASE WHEN i.instrument_id IS NULL AND s.instrument_id IS NULL THEN 'CREATE' WHEN i.instrument_id IS NULL THEN 'SYMBOL_WITHOUT_ISIN' WHEN s.instrument_id <> i.instrument_id THEN 'TWO_INSTRUMENTS'
    WHEN s.instrument_id IS NOT NULL THEN 'KNOWN' WHEN previous IS NULL THEN 'RENAME_NOT_ANNOUNCED' ELSE 'RENAME' END AS outcome FROM entries e LEFT JOIN ids i ON i.kind = 'ISIN' AND i.v = e.isin LEFT JOIN ids s ON s.kind = 'SYMBOL' AND s.v = e.symbol""")
def instrument_identity(spark, d):
    c = table(spark, d, "customer").select("c_custkey")
    text_of = lambda p: F.concat(F.lit(p), F.col("c_custkey").cast("string"))
    no_end = F.lit(None).cast("timestamp_ntz").alias("valid_to")
    since = F.lit("2020-01-01").cast("timestamp_ntz").alias("valid_from")
    key = F.col("c_custkey")
    isins = c.where("c_custkey % 4 <> 0").select(F.lit("ISIN").alias("identifier_type"), text_of("I").alias("identifier_value"), key.alias("instrument_id"), since, no_end)
    symbols = c.where("c_custkey % 5 <> 0").select(F.lit("SYMBOL").alias("identifier_type"), text_of("S").alias("identifier_value"), F.when(key % 7 == 0, key + 1).otherwise(key).alias("instrument_id"), since, no_end)
    entries = c.select("c_custkey", text_of("I").alias("isin"), text_of("S").alias("symbol"), F.when(key % 3 == 0, "P").alias("previous_symbol"), F.lit("2024-01-01").cast("timestamp_ntz").alias("valid_from"))
    return catalog.identity_outcomes(entries, isins.unionByName(symbols)).select("c_custkey", "outcome")


@query("symbol_cross_validation", """WITH m AS (SELECT c_custkey, CASE WHEN c_custkey % 11 = 0 THEN 'X' ELSE c_name END AS symbol, c_mktsegment AS isin, CASE WHEN c_custkey % 13 = 0 THEN -1 ELSE c_nationkey END AS venue, c_name FROM customer WHERE c_custkey % 6 <> 0)
    SELECT c.c_custkey AS stable_key, CASE WHEN m.symbol IS NULL THEN 'NO_METADATA' WHEN m.symbol <> c.c_name THEN 'SYMBOL_MISMATCH' WHEN c.c_custkey % 17 = 0 THEN 'ISIN_MISMATCH' ELSE 'MARKET_MISMATCH' END AS mismatch FROM customer c LEFT JOIN m USING (c_name)
    WHERE m.symbol IS NULL OR m.symbol <> c.c_name OR c.c_custkey % 17 = 0 OR m.venue <> c.c_nationkey""")
def symbol_cross_validation(spark, d):
    c, key = table(spark, d, "customer"), F.col("c_custkey")
    entries = c.select(key.alias("stable_key"), F.col("c_name").alias("symbol"), F.when(key % 17 == 0, "other").otherwise(F.col("c_mktsegment")).alias("isin"), F.col("c_nationkey").alias("venue"))
    metadata = c.where("c_custkey % 6 <> 0").select(F.col("c_name").alias("requested_symbol"), F.when(key % 11 == 0, "X").otherwise(F.col("c_name")).alias("symbol"), F.col("c_mktsegment").alias("isin"), F.when(key % 13 == 0, -1).otherwise(F.col("c_nationkey")).alias("venue"))
    return catalog.provider_mismatches(entries, metadata)


@query("performance_ratios", f"""WITH {BARS}, c AS (SELECT bar_series_id, bar_open_ts, CAST(close_price AS DOUBLE) AS p FROM bars WHERE revision_no = 1), r AS (SELECT bar_series_id, (p - lag(p) OVER w) / nullif(lag(p) OVER w, 0) AS r FROM c WINDOW w AS (PARTITION BY bar_series_id ORDER BY bar_open_ts)),
    a AS (SELECT bar_series_id, count(r) AS n, avg(r) AS m, stddev_samp(r) AS sd, sqrt(avg(pow(CASE WHEN r < 0 THEN r WHEN r >= 0 THEN 0 END, 2))) AS down FROM r GROUP BY bar_series_id)
    SELECT bar_series_id, n, round(sd * sqrt(252), 6) AS volatility, round(CASE WHEN sd > 0 THEN m / sd * sqrt(252) END, 6) AS sharpe, round(CASE WHEN down > 0 THEN m / down * sqrt(252) END, 6) AS sortino FROM a""")
def performance_ratios(spark, d):
    by = Window.partitionBy("bar_series_id").orderBy("bar_open_ts")
    p = F.col("close_price").cast("double")
    before = F.lag(p).over(by)
    r = bars(spark, d).where("revision_no = 1").select("bar_series_id", F.when(before != 0, (p - before) / before).alias("r"))
    out = ledger.performance(r, ["bar_series_id"], "r")
    return out.select("bar_series_id", "n", *[F.round(c, 6).alias(c) for c in ("volatility", "sharpe", "sortino")])
