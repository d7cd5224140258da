"""Queries of the point-in-time algebra and of as-of joins."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronofold.operators import asof, pit, temporal
from chronofold.plans.catalogue import query
from chronofold.plans.views import BARS, IDENTIFIERS, UNIVERSE, bars, identifiers, sql_ts, table, text_ts, universe

FROM, TO, CUTOFF = datetime(2024, 1, 3), datetime(2024, 1, 20), datetime(2024, 1, 20)
SQL_FROM, SQL_TO, SQL_CUTOFF = (f"TIMESTAMP '{x}'" for x in (FROM, TO, CUTOFF))
ORDER = {pit.PUBLIC: "available_at DESC, revision_no DESC, system_available_at DESC", pit.SYSTEM: "system_available_at DESC, revision_no DESC, available_at DESC"}
COLUMNS = ("bar_series_id", "revision_no", "open_price", "high_price", "low_price", "close_price", "volume")
SQL_COLUMNS = ", ".join(COLUMNS) + f", {sql_ts('bar_open_ts')} AS bar_open_ts"


def _shown(df, clock=None):
    extra = [text_ts(clock).alias("effective_available_at")] if clock else []
    return df.select(*COLUMNS, text_ts("bar_open_ts").alias("bar_open_ts"), *extra)


def _eligible_sql(mode: str) -> str:
    c = pit.CLOCK[mode]
    return f"""eligible AS (SELECT *, {c} AS effective FROM bars WHERE is_final AND bar_open_ts >= {SQL_FROM} AND bar_open_ts < {SQL_TO}
        AND bar_close_ts <= {SQL_CUTOFF} AND {c} <= {SQL_CUTOFF})"""


def _as_of_sql(mode: str) -> str:
    return f"""WITH {BARS}, {_eligible_sql(mode)}, ranked AS (
        SELECT *, row_number() OVER (PARTITION BY bar_series_id, bar_open_ts ORDER BY {ORDER[mode]}) AS rk FROM eligible)
        SELECT {SQL_COLUMNS}, {sql_ts('effective')} AS effective_available_at FROM ranked WHERE rk = 1"""


def _eligible(mode: str) -> str:
    return f"WITH {BARS}, {_eligible_sql(mode)} SELECT {SQL_COLUMNS}, {sql_ts('effective')} AS effective_available_at FROM eligible"


@query("bars_as_of_public", _as_of_sql(pit.PUBLIC))
def bars_as_of_public(spark, d):
    return _shown(pit.bars_as_of(bars(spark, d), None, FROM, TO, CUTOFF, pit.PUBLIC), "effective_available_at")


@query("bars_as_of_system", _as_of_sql(pit.SYSTEM))
def bars_as_of_system(spark, d):
    return _shown(pit.bars_as_of(bars(spark, d), None, FROM, TO, CUTOFF, pit.SYSTEM), "effective_available_at")


@query("eligible_revisions_public", _eligible(pit.PUBLIC))
def eligible_revisions_public(spark, d):
    return _shown(pit.eligible_revisions(bars(spark, d), None, FROM, TO, CUTOFF, pit.PUBLIC), "effective_available_at")


@query("eligible_revisions_system", _eligible(pit.SYSTEM))
def eligible_revisions_system(spark, d):
    return _shown(pit.eligible_revisions(bars(spark, d), None, FROM, TO, CUTOFF, pit.SYSTEM), "effective_available_at")


@query("current_bar", f"""WITH {BARS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY bar_series_id, bar_open_ts ORDER BY available_at DESC, revision_no DESC) AS rk FROM bars)
    SELECT {SQL_COLUMNS} FROM ranked WHERE rk = 1""")
def current_bar(spark, d):
    return _shown(pit.current_bar(bars(spark, d)))


@query("bars_with_decision_lag", f"""WITH {BARS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY bar_series_id, bar_open_ts ORDER BY {ORDER[pit.PUBLIC]}) AS rk FROM bars
    WHERE is_final AND available_at <= least(bar_close_ts + INTERVAL 7 HOUR, {SQL_CUTOFF})) SELECT {SQL_COLUMNS} FROM ranked WHERE rk = 1""")
def bars_with_decision_lag(spark, d):
    return _shown(pit.bars_with_decision_lag(bars(spark, d), F.lit(7 * 3600), CUTOFF, pit.PUBLIC))


@query("quote_as_of", f"""WITH {BARS}, ranked AS (SELECT *, row_number() OVER (PARTITION BY bar_series_id % 3, bar_series_id, bar_open_ts ORDER BY {ORDER[pit.SYSTEM]}) AS rk FROM bars
    WHERE system_available_at <= {SQL_CUTOFF}) SELECT bar_series_id % 3 AS feed_id, bar_series_id AS instrument_id, {sql_ts('bar_open_ts')} AS event_ts, revision_no, close_price AS bid_price FROM ranked WHERE rk = 1""")
def quote_as_of(spark, d):
    quotes = bars(spark, d).select((F.col("bar_series_id") % 3).alias("feed_id"), F.col("bar_series_id").alias("instrument_id"), F.col("bar_open_ts").alias("event_ts"), "revision_no", F.col("close_price").alias("bid_price"), "available_at", "system_available_at")
    return pit.quotes_as_of(quotes, CUTOFF, pit.SYSTEM).select("feed_id", "instrument_id", text_ts("event_ts").alias("event_ts"), "revision_no", "bid_price")


def _latest_sql(mode: str, name: str) -> str:
    return f"""{name} AS (SELECT bar_series_id, bar_open_ts, revision_no FROM (SELECT *, row_number() OVER (PARTITION BY bar_series_id, bar_open_ts ORDER BY {ORDER[mode]}) AS rk
        FROM bars WHERE is_final AND bar_open_ts >= {SQL_FROM} AND bar_open_ts < {SQL_TO} AND bar_close_ts <= {SQL_CUTOFF} AND {pit.CLOCK[mode]} <= {SQL_CUTOFF}) WHERE rk = 1)"""


@query("replay_mode_divergence", f"""WITH {BARS}, {_latest_sql(pit.PUBLIC, 'p')}, {_latest_sql(pit.SYSTEM, 's')}
    SELECT p.bar_series_id, {sql_ts('p.bar_open_ts')} AS bar_open_ts, p.revision_no AS public_revision, s.revision_no AS system_revision
    FROM p LEFT JOIN s USING (bar_series_id, bar_open_ts) WHERE p.revision_no IS DISTINCT FROM s.revision_no""")
def replay_mode_divergence(spark, d):
    b = bars(spark, d)
    p = pit.bars_as_of(b, None, FROM, TO, CUTOFF, pit.PUBLIC).select("bar_series_id", "bar_open_ts", F.col("revision_no").alias("public_revision"))
    s = pit.bars_as_of(b, None, FROM, TO, CUTOFF, pit.SYSTEM).select("bar_series_id", "bar_open_ts", F.col("revision_no").alias("system_revision"))
    out = p.join(s, ["bar_series_id", "bar_open_ts"], "left").where(~F.col("public_revision").eqNullSafe(F.col("system_revision")))
    return out.select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), "public_revision", "system_revision")


@query("decision_schedule", f"WITH {BARS} SELECT bar_series_id, {sql_ts('bar_open_ts')} AS bar_open_ts, {sql_ts('min(available_at)')} AS decision_ts FROM bars GROUP BY bar_series_id, bar_open_ts")
def decision_schedule(spark, d):
    s = asof.decision_schedule(bars(spark, d), "available_at")
    return s.select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), text_ts("decision_ts").alias("decision_ts"))


VISIBLE = f"""WITH {BARS}, decisions AS (SELECT bar_series_id, bar_open_ts AS trigger_open, min(available_at) AS decision_ts FROM bars GROUP BY ALL),
    seen AS (SELECT d.bar_series_id, d.decision_ts, b.bar_open_ts, max(b.revision_no) AS revision_no, arg_max(b.close_price, b.revision_no) AS close_price
        FROM (SELECT DISTINCT bar_series_id, decision_ts FROM decisions) d JOIN bars b ON b.bar_series_id = d.bar_series_id AND b.available_at <= d.decision_ts GROUP BY ALL)"""


@query("decision_visibility", VISIBLE + f" SELECT bar_series_id, {sql_ts('decision_ts')} AS decision_ts, {sql_ts('bar_open_ts')} AS bar_open_ts, revision_no, close_price FROM seen")
def decision_visibility(spark, d):
    b = bars(spark, d)
    out = asof.visible_at(asof.decision_schedule(b, "available_at"), b, "available_at", ["close_price"])
    return out.select("bar_series_id", text_ts("decision_ts").alias("decision_ts"), text_ts("bar_open_ts").alias("bar_open_ts"), "revision_no", "close_price")


@query("next_execution_bar", f"""WITH {BARS}, o AS (SELECT event_id AS order_id, bar_series_id, bar_open_ts AS signal_open_ts, available_at AS submitted_at FROM bars WHERE revision_no = 1),
    f AS (SELECT bar_series_id, bar_open_ts, min(available_at) AS first_seen FROM bars GROUP BY ALL)
    SELECT o.order_id, o.bar_series_id, {sql_ts('min(f.bar_open_ts)')} AS execution_open_ts, {sql_ts('arg_min(f.first_seen, f.bar_open_ts)')} AS execution_ts
    FROM o LEFT JOIN f ON f.bar_series_id = o.bar_series_id AND f.bar_open_ts > o.signal_open_ts AND f.first_seen >= o.submitted_at + INTERVAL 30 HOUR GROUP BY o.order_id, o.bar_series_id""")
def next_execution_bar(spark, d):
    b = bars(spark, d)
    orders = b.where("revision_no = 1").select(F.col("event_id").alias("order_id"), "bar_series_id", F.col("bar_open_ts").alias("signal_open_ts"), F.col("available_at").alias("submitted_at"))
    out = asof.next_execution_bar(orders, b, "available_at", F.lit(30 * 3600))
    return out.select("order_id", "bar_series_id", text_ts("execution_open_ts").alias("execution_open_ts"), text_ts("execution_ts").alias("execution_ts"))


@query("sma_signals", f"""WITH {BARS}, {_latest_sql(pit.PUBLIC, 'p')}, c AS (SELECT b.* FROM bars b JOIN p USING (bar_series_id, bar_open_ts, revision_no)),
    s AS (SELECT bar_series_id, bar_open_ts, count(*) OVER w3 AS n, CAST(sum(close_price) OVER w2 AS DOUBLE) / 2 AS fast, CAST(sum(close_price) OVER w3 AS DOUBLE) / 3 AS slow FROM c
        WINDOW w2 AS (PARTITION BY bar_series_id ORDER BY bar_open_ts ROWS 1 PRECEDING), w3 AS (PARTITION BY bar_series_id ORDER BY bar_open_ts ROWS 2 PRECEDING))
    SELECT bar_series_id, {sql_ts('bar_open_ts')} AS bar_open_ts, CASE WHEN n = 3 THEN fast END AS fast, CASE WHEN n = 3 THEN slow END AS slow, CAST(CASE WHEN n = 3 AND fast > slow THEN 100 ELSE 0 END AS INTEGER) AS target FROM s""")
def sma_signals(spark, d):
    b = pit.bars_as_of(bars(spark, d), None, FROM, TO, CUTOFF, pit.PUBLIC)
    by = Window.partitionBy("bar_series_id").orderBy("bar_open_ts")
    mean = lambda n: F.sum("close_price").over(by.rowsBetween(1 - n, 0)).cast("double") / n
    full = F.count(F.lit(1)).over(by.rowsBetween(-2, 0)) == 3
    s = b.select("bar_series_id", "bar_open_ts", full.alias("full"), mean(2).alias("fast"), mean(3).alias("slow"))
    target = F.when(F.col("full") & (F.col("fast") > F.col("slow")), 100).otherwise(0)
    return s.select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), F.when(F.col("full"), F.col("fast")).alias("fast"), F.when(F.col("full"), F.col("slow")).alias("slow"), target.cast("int").alias("target"))


@query("sma_cross_long_flat", VISIBLE + f""", r AS (SELECT *, row_number() OVER (PARTITION BY bar_series_id, decision_ts ORDER BY bar_open_ts DESC) AS rk FROM seen),
    m AS (SELECT bar_series_id, decision_ts, count(*) AS n, CAST(sum(close_price) FILTER (WHERE rk <= 2) AS DOUBLE) / 2 AS fast, CAST(sum(close_price) AS DOUBLE) / 3 AS slow FROM r WHERE rk <= 3 GROUP BY ALL)
    SELECT bar_series_id, {sql_ts('decision_ts')} AS decision_ts, CAST(CASE WHEN n = 3 AND fast > slow THEN 100 ELSE 0 END AS INTEGER) AS target FROM m""")
def sma_cross_long_flat(spark, d):
    """Targets from what each decision could see, so that a later correction never changes an earlier target."""
    b = bars(spark, d)
    last = asof.last_visible(asof.decision_schedule(b, "available_at"), b, "available_at", 3, ["close_price"]).withColumnRenamed("rank", "rk")
    m = last.groupBy("bar_series_id", "decision_ts").agg(F.count(F.lit(1)).alias("n"), (F.sum(F.when(F.col("rk") <= 2, F.col("close_price"))).cast("double") / 2).alias("fast"), (F.sum("close_price").cast("double") / 3).alias("slow"))
    return m.select("bar_series_id", text_ts("decision_ts").alias("decision_ts"), F.when((F.col("n") == 3) & (F.col("fast") > F.col("slow")), 100).otherwise(0).cast("int").alias("target"))


@query("exact_revision_join", f"""WITH {BARS}, refs AS (SELECT bar_series_id, bar_open_ts, max(revision_no) AS revision_no FROM bars WHERE is_final GROUP BY ALL)
    SELECT {SQL_COLUMNS} FROM refs JOIN bars USING (bar_series_id, bar_open_ts, revision_no)""")
def exact_revision_join(spark, d):
    b = bars(spark, d)
    keys = ["bar_series_id", "bar_open_ts", "revision_no"]
    refs = b.where("is_final").groupBy("bar_series_id", "bar_open_ts").agg(F.max("revision_no").alias("revision_no"))
    return _shown(refs.join(b, keys))


@query("asof_backward", f"""SELECT l.l_orderkey AS order_id, l.l_linenumber AS line, l.l_suppkey AS supplier_id, {sql_ts('l.l_shipdate')} AS fill_ts, max(o.o_orderdate) IS NOT NULL AS found, {sql_ts('max(o.o_orderdate)')} AS order_ts
    FROM lineitem l LEFT JOIN orders o ON o.o_orderkey = l.l_orderkey AND o.o_orderdate <= l.l_shipdate GROUP BY l.l_orderkey, l.l_linenumber, l.l_suppkey, l.l_shipdate""")
def asof_backward(spark, d):
    l = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("k"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("supplier_id"), F.col("l_shipdate").alias("fill_ts"))
    o = table(spark, d, "orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderdate").alias("order_ts"))
    out = asof.backward(l, o, ["k"], "fill_ts", "order_ts", ["order_ts"], ["k", "line", "supplier_id", "fill_ts"])
    out = out.distinct()  # line items may repeat
    return out.select(F.col("k").alias("order_id"), "line", "supplier_id", text_ts("fill_ts").alias("fill_ts"), F.col("order_ts").isNotNull().alias("found"), text_ts("order_ts").alias("order_ts"))


MOMENT = "TIMESTAMP '1997-06-01 00:00:00'"


@query("identifier_as_of", f"WITH {IDENTIFIERS} SELECT key, id FROM identifiers WHERE valid_from <= {MOMENT} AND (valid_to IS NULL OR valid_to > {MOMENT})")
def identifier_as_of(spark, d):
    return temporal.as_of(identifiers(spark, d), F.lit("1997-06-01").cast("timestamp_ntz")).select("key", "id")


@query("session_as_of", f"""WITH {IDENTIFIERS}, s AS (SELECT DISTINCT o_custkey AS key, date_trunc('day', o_orderdate) + INTERVAL 9 HOUR AS session_open_ts FROM orders)
    SELECT s.key, {sql_ts('s.session_open_ts')} AS session_open_ts, i.id FROM s JOIN identifiers i ON i.key = s.key AND i.valid_from <= s.session_open_ts AND (i.valid_to IS NULL OR i.valid_to > s.session_open_ts)""")
def session_as_of(spark, d):
    """The moment of the lookup is the opening of the joined session, never midnight."""
    s = table(spark, d, "orders").select(F.col("o_custkey").alias("key"), (F.col("o_orderdate").cast("date").cast("timestamp_ntz") + F.make_dt_interval(hours=F.lit(9))).alias("session_open_ts")).distinct()
    out = temporal.as_of(s.join(identifiers(spark, d), "key"), F.col("session_open_ts"))
    return out.select("key", text_ts("session_open_ts").alias("session_open_ts"), "id")


SPECS = """changes AS (SELECT o_custkey AS instrument_id, CAST(o_totalprice / 100000 AS BIGINT) AS lot, min(o_orderdate) AS effective_from FROM orders GROUP BY ALL),
    marked AS (SELECT *, lag(lot) OVER (PARTITION BY instrument_id ORDER BY effective_from, lot) AS before, row_number() OVER (PARTITION BY instrument_id ORDER BY effective_from, lot) AS n FROM changes),
    specs AS (SELECT instrument_id, lot, effective_from AS valid_from, lead(effective_from) OVER (PARTITION BY instrument_id ORDER BY effective_from, lot) AS valid_to FROM marked WHERE n = 1 OR lot IS DISTINCT FROM before)"""


def _specs(spark, d):
    o = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("instrument_id"), F.round(F.col("o_totalprice") / 100000).cast("bigint").alias("lot")).agg(F.min("o_orderdate").alias("effective_from"))
    return temporal.versions(o, ["instrument_id"], ["lot"], "effective_from")


@query("scd2_spec_version", f"WITH {SPECS} SELECT instrument_id, lot, {sql_ts('valid_from')} AS valid_from, {sql_ts('valid_to')} AS valid_to FROM specs")
def scd2_spec_version(spark, d):
    return _specs(spark, d).select("instrument_id", "lot", text_ts("valid_from").alias("valid_from"), text_ts("valid_to").alias("valid_to"))


@query("spec_as_of", f"WITH {SPECS} SELECT instrument_id, lot FROM specs WHERE valid_from <= {MOMENT} AND (valid_to IS NULL OR valid_to > {MOMENT})")
def spec_as_of(spark, d):
    return temporal.as_of(_specs(spark, d), F.lit("1997-06-01").cast("timestamp_ntz")).select("instrument_id", "lot")


@query("universe_as_of", f"WITH {UNIVERSE} SELECT instrument_id, {sql_ts('valid_from')} AS valid_from FROM universe WHERE valid_from <= {MOMENT} AND valid_to > {MOMENT}")
def universe_as_of(spark, d):
    return temporal.as_of(universe(spark, d), F.lit("1997-06-01").cast("timestamp_ntz")).select("instrument_id", text_ts("valid_from").alias("valid_from"))


@query("identifier_exists_semi", "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)")
def identifier_exists_semi(spark, d):
    return table(spark, d, "customer").join(identifiers(spark, d).select(F.col("key").alias("c_custkey")), "c_custkey", "left_semi").select("c_custkey", "c_name")


@query("ambiguous_identifiers", f"WITH {IDENTIFIERS} SELECT key, count(*) AS n FROM identifiers WHERE valid_from <= {MOMENT} AND (valid_to IS NULL OR valid_to > {MOMENT}) GROUP BY key HAVING count(*) > 1")
def ambiguous_identifiers(spark, d):
    return temporal.ambiguous_keys(temporal.as_of(identifiers(spark, d), F.lit("1997-06-01").cast("timestamp_ntz")), ["key"])


@query("interval_overlap_pairs", f"""WITH {IDENTIFIERS} SELECT a.key, a.id AS first_id, b.id AS second_id FROM identifiers a JOIN identifiers b ON a.key = b.key
    AND (a.valid_from < b.valid_from OR (a.valid_from = b.valid_from AND a.id < b.id))
    AND b.valid_from < coalesce(a.valid_to, TIMESTAMP '9999-12-31') AND a.valid_from < coalesce(b.valid_to, TIMESTAMP '9999-12-31')""")
def interval_overlap_pairs(spark, d):
    return temporal.overlap_pairs(identifiers(spark, d), ["key"], "id")


@query("interval_overlap_rows", f"""WITH {IDENTIFIERS}, r AS (SELECT *, max(coalesce(valid_to, TIMESTAMP '9999-12-31')) OVER (PARTITION BY key ORDER BY valid_from, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach FROM identifiers)
    SELECT key, id FROM r WHERE valid_from < reach""")
def interval_overlap_rows(spark, d):
    return temporal.overlapping_rows(identifiers(spark, d), ["key"], "id").select("key", "id")


@query("interval_overlap_proposed", f"""WITH {IDENTIFIERS} SELECT p.key, p.id FROM identifiers p WHERE p.id % 7 = 0 AND EXISTS (SELECT 1 FROM identifiers e WHERE e.id % 7 <> 0 AND e.key = p.key
    AND p.valid_from < coalesce(e.valid_to, TIMESTAMP '9999-12-31') AND e.valid_from < coalesce(p.valid_to, TIMESTAMP '9999-12-31'))""")
def interval_overlap_proposed(spark, d):
    i = identifiers(spark, d)
    return temporal.rejected_proposals(i.where("id % 7 = 0"), i.where("id % 7 <> 0"), ["key"]).select("key", "id")


@query("scd2_rename", f"""WITH {UNIVERSE}, i AS (SELECT instrument_id AS key, 'S' || instrument_id AS symbol, valid_from, CASE WHEN instrument_id % 2 = 0 THEN valid_to END AS valid_to FROM universe),
    r AS (SELECT instrument_id AS key, 'N' || instrument_id AS new_value, valid_to AS effective_from FROM universe WHERE instrument_id % 3 = 0),
    j AS (SELECT i.*, r.new_value, r.effective_from, r.key IS NOT NULL AND i.valid_to IS NULL AND i.valid_from < r.effective_from AS hit FROM i LEFT JOIN r USING (key))
    SELECT key, symbol, {sql_ts('valid_from')} AS valid_from, {sql_ts('CASE WHEN hit THEN effective_from ELSE valid_to END')} AS valid_to FROM j
    UNION ALL SELECT key, new_value, {sql_ts('effective_from')}, NULL FROM j WHERE hit""")
def scd2_rename(spark, d):
    u = universe(spark, d)
    i = u.select(F.col("instrument_id").alias("key"), F.concat(F.lit("S"), "instrument_id").alias("symbol"), "valid_from", F.when(F.col("instrument_id") % 2 == 0, F.col("valid_to")).alias("valid_to"))
    r = u.where("instrument_id % 3 = 0").select(F.col("instrument_id").alias("key"), F.concat(F.lit("N"), "instrument_id").alias("new_value"), F.col("valid_to").alias("effective_from"))
    return temporal.rename(i, r, "key", "symbol").select("key", "symbol", text_ts("valid_from").alias("valid_from"), text_ts("valid_to").alias("valid_to"))


@query("calendar_completeness", f"""WITH s AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders)
    SELECT strftime(g.day, '%Y-%m-%d') AS trading_date FROM (SELECT CAST(unnest(generate_series(TIMESTAMP '1991-07-01', TIMESTAMP '2000-06-30', INTERVAL 1 DAY)) AS DATE) AS day) g ANTI JOIN s ON s.day = g.day""")
def calendar_completeness(spark, d):
    days = table(spark, d, "orders").select(F.col("o_orderdate").alias("day"))
    return temporal.missing_days(days, "day", F.lit("1991-07-01"), F.lit("2000-06-30")).select(F.date_format("day", "yyyy-MM-dd").alias("trading_date"))


@query("reference_conflicts", """SELECT c_custkey, CASE WHEN s.c_custkey IS NULL THEN 'CREATED' WHEN c.c_mktsegment = s.seg AND c.c_nationkey = s.nat THEN 'UNCHANGED' ELSE 'CONFLICT' END AS outcome,
    CASE WHEN s.c_custkey IS NULL THEN '' ELSE concat_ws(',', CASE WHEN c.c_nationkey <> s.nat THEN 'c_nationkey' END, CASE WHEN c.c_mktsegment <> s.seg THEN 'c_mktsegment' END) END AS fields
    FROM customer c LEFT JOIN (SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN 'X' ELSE c_mktsegment END AS seg, CASE WHEN c_custkey % 9 = 0 THEN -1 ELSE c_nationkey END AS nat FROM customer WHERE c_custkey % 4 <> 0) s USING (c_custkey)""")
def reference_conflicts(spark, d):
    c = table(spark, d, "customer")
    stored = c.where("c_custkey % 4 <> 0").select("c_custkey", F.when(F.col("c_custkey") % 9 == 0, -1).otherwise(F.col("c_nationkey")).alias("c_nationkey"), F.when(F.col("c_custkey") % 5 == 0, "X").otherwise(F.col("c_mktsegment")).alias("c_mktsegment"))
    return temporal.reference_diff(c, stored, ["c_custkey"], ["c_nationkey", "c_mktsegment"])
