"""Queries of stateful streams, books as of an instant, lifecycles, features, labels and training windows."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from chronofold.operators import book, lifecycle, training
from chronofold.plans.catalogue import query
from chronofold.plans.views import BARS, bars, money, sql_ts, table, text_ts
from chronofold.sources import places
from chronofold.streaming import revisions

LEVELS_OF_STREAM = """e AS (SELECT user_id, date_trunc('day', ts)::TIMESTAMP AS bar_open_ts, ts, event_id, CAST(floor(value / 25) AS BIGINT) AS level, event_type FROM events),
    x AS (SELECT *, row_number() OVER w AS pos, lag(level) OVER w AS l0, lag(event_type) OVER w AS t0 FROM e WINDOW w AS (PARTITION BY user_id, bar_open_ts ORDER BY ts, event_id)),
    k AS (SELECT *, CASE WHEN pos = 1 OR l0 <> level OR t0 <> event_type THEN 1 ELSE 0 END AS kept FROM x),
    n AS (SELECT *, CAST(sum(kept) OVER (PARTITION BY user_id, bar_open_ts ORDER BY ts, event_id) AS BIGINT) AS revision_no FROM k)"""


@query("stream_revision_outcomes", f"WITH {LEVELS_OF_STREAM} SELECT user_id, event_id, CASE WHEN kept = 0 THEN 'UNCHANGED' WHEN revision_no = 1 THEN 'INSERTED' ELSE 'CORRECTED' END AS outcome, revision_no FROM n")
def stream_revision_outcomes(spark, d):
    """All events as a stream with a state for each user and day, which lives through a restart at every landing; the twin
    is the batch form. Events land in two parts, by their hour, so that most days have rows in both."""
    events = table(spark, d, "events")
    root = places.scratch(spark, "stream")
    early = F.hour("ts") < 12
    for part in (early, ~early):
        events.where(part).write.mode("append").parquet(f"{root}/landing")
        stream = spark.readStream.schema(events.schema).parquet(f"{root}/landing")
        rows = stream.select("user_id", F.col("ts").cast("date").alias("day"), "ts", "event_id", F.floor(F.col("value") / 25).cast("bigint").alias("level"), "event_type")
        changed = revisions.changes(rows, ["user_id", "day"], ["level", "event_type"], ["ts", "event_id"])
        revisions.start(changed, f"{root}/store", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema("user_id bigint, event_id bigint, outcome string, revision_no bigint").parquet(f"{root}/store").drop("batch_id")


#: Changes of books made of events: numbered by arrival, one number in 97 missing; an event in 60 is a snapshot, one in 7 a question.
BOOK = """e AS (SELECT user_id % 20 AS book, ts, event_id, event_type, value FROM events),
    m AS (SELECT *, row_number() OVER (PARTITION BY book ORDER BY ts, event_id) + count(*) FILTER (WHERE event_id % 97 = 0) OVER (PARTITION BY book ORDER BY ts, event_id) AS seq FROM e),
    c AS (SELECT book, ts, seq, event_id, CASE WHEN event_id % 700 = 0 THEN 'CLEAR' WHEN event_type = 'error' THEN 'DELETE' ELSE 'SET' END AS action, CASE WHEN event_id % 2 = 0 THEN 'BID' ELSE 'ASK' END AS side, CAST(floor(value / 10) * 10 AS BIGINT) AS price, event_id % 100 AS quantity FROM m),
    s AS (SELECT book, ts, seq FROM c WHERE event_id % 60 = 0 AND action <> 'CLEAR'),
    a AS (SELECT book, event_id AS ask_id, ts AS at FROM e WHERE event_id % 7 = 0),
    b AS (SELECT book, ts, seq, 0 AS o FROM s UNION ALL SELECT book, ts, seq, 1 FROM c WHERE action = 'CLEAR'),
    q AS (SELECT a.*, b.ts AS base_ts, b.seq AS base_seq FROM a LEFT JOIN b ON b.book = a.book AND b.ts <= a.at QUALIFY row_number() OVER (PARTITION BY ask_id ORDER BY b.ts DESC, b.o DESC, b.seq DESC) = 1),
    p AS (SELECT q.*, c.seq, c.action, c.side, c.price, c.quantity FROM q JOIN c ON c.book = q.book AND c.ts <= q.at AND c.seq > q.base_seq),
    g AS (SELECT ask_id, max(seq) AS last_seq, max(seq) - min(base_seq) <> count(DISTINCT seq) AS gap FROM p GROUP BY ask_id),
    l0 AS (SELECT ask_id, base_seq AS seq, 'SET' AS action, side, price, quantity FROM q JOIN s ON s.book = q.book AND s.ts = q.base_ts AND s.seq = q.base_seq, (VALUES ('BID', 10::BIGINT, 5::BIGINT), ('ASK', 90::BIGINT, 7::BIGINT)) v(side, price, quantity)),
    l AS (SELECT * FROM (SELECT * FROM l0 UNION ALL SELECT ask_id, seq, action, side, price, quantity FROM p) QUALIFY row_number() OVER (PARTITION BY ask_id, side, price ORDER BY seq DESC) = 1)"""


@query("book_as_of", f"""WITH {BOOK} SELECT q.ask_id, base_seq, CASE WHEN base_seq IS NOT NULL THEN coalesce(last_seq, base_seq) END AS last_seq,
        CASE WHEN base_seq IS NULL THEN 'NO_BASE' WHEN coalesce(gap, false) THEN 'GAP' ELSE 'OK' END AS status, l.side, l.price, l.quantity
    FROM q LEFT JOIN g USING (ask_id) LEFT JOIN l ON l.ask_id = q.ask_id AND l.action = 'SET'""")
def book_as_of(spark, d):
    """Books at many instants each, from snapshots of two levels and the changes since."""
    e = table(spark, d, "events").select((F.col("user_id") % 20).alias("book"), "ts", "event_id", "event_type", "value")
    by = Window.partitionBy("book").orderBy("ts", "event_id")
    so_far = by.rowsBetween(Window.unboundedPreceding, 0)
    numbered = e.withColumn("seq", F.row_number().over(by) + F.count_if(F.col("event_id") % 97 == 0).over(so_far))
    action = F.when(F.col("event_id") % 700 == 0, "CLEAR").when(F.col("event_type") == "error", "DELETE").otherwise("SET")
    changes = numbered.select("book", "ts", "seq", "event_id", action.alias("action"), F.when(F.col("event_id") % 2 == 0, "BID").otherwise("ASK").alias("side"), (F.floor(F.col("value") / 10) * 10).cast("bigint").alias("price"), (F.col("event_id") % 100).alias("quantity"))
    level = lambda side, price, quantity: F.struct(F.lit(side).alias("side"), F.lit(price).cast("bigint").alias("price"), F.lit(quantity).cast("bigint").alias("quantity"))
    snapshots = changes.where("event_id % 60 = 0 AND action <> 'CLEAR'").select("book", "ts", "seq", F.array(level("BID", 10, 5), level("ASK", 90, 7)).alias("levels"))
    asks = e.where("event_id % 7 = 0").select("book", F.col("event_id").alias("ask_id"), F.col("ts").alias("at"))
    return book.book_as_of(snapshots, changes, asks).select("ask_id", "base_seq", "last_seq", "status", "side", "price", "quantity")


#: Lifecycle events made of orders: a key is a customer, its events are its orders by number.
RUNS = """e AS (SELECT o_custkey AS code, o_orderkey AS event_no, CASE o_orderkey % {mod} {cases} END AS event, CASE WHEN o_orderkey % 11 = 0 THEN 'other' ELSE 'spec' END AS specification FROM orders)"""
RUN_EVENTS = ("REQUEST", "START", "REQUEST", "SUCCEED", "FAIL")
BATCH_EVENTS = ("REQUEST", "REQUEST", "SUCCEED", "PARTIAL", "QUARANTINE", "FAIL")


def _fold(machine: lifecycle.Machine, names: tuple[str, ...]) -> str:
    """SQL that folds the events of a key one after another, for the twin: recursive, so unlike the windows of the plan."""
    cases = " ".join(f"WHEN {i} THEN '{n}'" for i, n in enumerate(names))
    move = f"CASE WHEN n.event = 'REQUEST' THEN coalesce(f.state, '{machine.states[0]}') "
    move += " ".join(f"WHEN f.state = '{machine.states[i]}' AND n.event = '{s}' THEN '{machine.states[i + 1]}'" for i, s in enumerate(machine.starts))
    move += " " + " ".join(f"WHEN f.state = '{machine.states[-1]}' AND n.event = '{e}' THEN '{s}'" for e, s in machine.ends.items()) + " ELSE f.state END"
    working, again = ", ".join(f"'{s}'" for s in machine.states), ", ".join(f"'{s}'" for s in machine.replayed)
    asked = "WHEN f.state IS NULL THEN 'CREATED' " + ("WHEN n.specification <> f.spec THEN 'CONFLICT' " if machine.specification_first else "")
    asked += f"WHEN f.state IN ({working}) THEN 'IN_PROGRESS' WHEN n.specification = f.spec AND f.state IN ({again}) THEN 'REPLAYED' ELSE 'CONFLICT'"
    return f"""WITH RECURSIVE {RUNS.format(mod=len(names), cases=cases)}, n AS (SELECT *, row_number() OVER (PARTITION BY code ORDER BY event_no) AS k FROM e),
    f AS (SELECT code, 0::BIGINT AS k, NULL::BIGINT AS event_no, NULL::VARCHAR AS state, NULL::VARCHAR AS spec, NULL::VARCHAR AS outcome FROM n WHERE k = 1
        UNION ALL SELECT n.code, n.k, n.event_no, CASE WHEN f.state IS NULL AND n.event <> 'REQUEST' THEN NULL ELSE {move} END, CASE WHEN f.state IS NULL AND n.event = 'REQUEST' THEN n.specification ELSE f.spec END,
            CASE WHEN n.event = 'REQUEST' THEN CASE {asked} END WHEN f.state IS NOT NULL AND ({move}) <> f.state THEN 'TAKEN' ELSE 'REFUSED' END
        FROM f JOIN n ON n.code = f.code AND n.k = f.k + 1)
    SELECT code, event_no, outcome, state FROM f WHERE k > 0"""


def _lifecycle(spark, d, machine, names):
    event = F.element_at(F.array(*map(F.lit, names)), (F.col("o_orderkey") % len(names) + 1).cast("int"))
    events = table(spark, d, "orders").select(F.col("o_custkey").alias("code"), F.col("o_orderkey").alias("event_no"), event.alias("event"), F.when(F.col("o_orderkey") % 11 == 0, "other").otherwise("spec").alias("specification"))
    return lifecycle.outcomes(events, machine).select("code", "event_no", "outcome", "state")


@query("run_lifecycle", _fold(lifecycle.RUN, RUN_EVENTS))
def run_lifecycle(spark, d):
    return _lifecycle(spark, d, lifecycle.RUN, RUN_EVENTS)


@query("batch_lifecycle", _fold(lifecycle.BATCH, BATCH_EVENTS))
def batch_lifecycle(spark, d):
    return _lifecycle(spark, d, lifecycle.BATCH, BATCH_EVENTS)


HORIZON = 5
#: The newest revision of each bar, and its label: which of two barriers of 10 % the next bars touch first.
LABELS = f"""{BARS}, z AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY bar_series_id, bar_open_ts ORDER BY revision_no DESC) = 1),
    o AS (SELECT *, row_number() OVER (PARTITION BY bar_series_id ORDER BY bar_open_ts) AS k, close_price * 1.1 AS up, close_price * 0.9 AS down FROM z),
    t AS (SELECT a.bar_series_id, a.bar_open_ts, b.k - a.k AS n, CASE WHEN b.low_price <= a.down THEN -1 WHEN b.high_price >= a.up THEN 1 END AS side FROM o a JOIN o b ON b.bar_series_id = a.bar_series_id AND b.k > a.k AND b.k <= a.k + {HORIZON}),
    u AS (SELECT bar_series_id, bar_open_ts, min(n) FILTER (WHERE side IS NOT NULL) AS touched_after, arg_min(side, n) FILTER (WHERE side IS NOT NULL) AS side, max(n) AS ahead FROM t GROUP BY ALL),
    v AS (SELECT o.*, touched_after, CASE WHEN touched_after IS NOT NULL THEN side WHEN ahead = {HORIZON} THEN 0 END AS label FROM o LEFT JOIN u USING (bar_series_id, bar_open_ts)),
    labels AS (SELECT v.bar_series_id, v.bar_open_ts, v.available_at, v.label, v.touched_after,
            (SELECT max(b.bar_open_ts) FROM o b WHERE b.bar_series_id = v.bar_series_id AND b.k > v.k AND b.k <= v.k + coalesce(v.touched_after, {HORIZON}) AND v.label IS NOT NULL) AS outcome_end_ts,
            (SELECT max(b.available_at) FROM o b WHERE b.bar_series_id = v.bar_series_id AND b.k > v.k AND b.k <= v.k + coalesce(v.touched_after, {HORIZON}) AND v.label IS NOT NULL) AS label_available_at FROM v)"""


def _newest(spark, d):
    b = bars(spark, d)
    rest = [c for c in b.columns if c not in ("bar_series_id", "bar_open_ts")]
    return b.groupBy("bar_series_id", "bar_open_ts").agg(F.max_by(F.struct(*rest), "revision_no").alias("b")).select("bar_series_id", "bar_open_ts", "b.*")


def _labels(spark, d):
    price = F.col("close_price")
    return training.first_touch(_newest(spark, d), "bar_series_id", HORIZON, price * F.lit("1.1").cast("decimal(2,1)"), price * F.lit("0.9").cast("decimal(2,1)"))


@query("label_horizons", f"WITH {LABELS} SELECT bar_series_id, {sql_ts('bar_open_ts')} AS bar_open_ts, CAST(label AS INTEGER) AS label, CAST(touched_after AS INTEGER) AS touched_after, {sql_ts('outcome_end_ts')} AS outcome_end_ts, {sql_ts('label_available_at')} AS label_available_at FROM labels")
def label_horizons(spark, d):
    return _labels(spark, d).select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), "label", "touched_after", text_ts("outcome_end_ts").alias("outcome_end_ts"), text_ts("label_available_at").alias("label_available_at"))


@query("label_violations", f"""WITH {LABELS}, y AS (SELECT *, CASE WHEN bar_series_id % 5 = 0 THEN outcome_end_ts - INTERVAL 1 HOUR WHEN bar_series_id % 5 = 1 THEN label_available_at END AS known, CASE WHEN bar_series_id % 3 = 0 THEN bar_open_ts + INTERVAL 90 DAY ELSE available_at END AS decided FROM labels),
    w AS (SELECT bar_series_id, bar_open_ts, CASE WHEN label IS NOT NULL AND known IS NULL THEN 'WITHOUT_AVAILABILITY' WHEN label IS NOT NULL AND outcome_end_ts <= bar_open_ts THEN 'OUTCOME_NOT_AHEAD' WHEN known < outcome_end_ts THEN 'BEFORE_OUTCOME_END' WHEN known <= decided THEN 'KNOWN_AT_DECISION' END AS violation FROM y)
    SELECT bar_series_id, {sql_ts('bar_open_ts')} AS bar_open_ts, violation FROM w WHERE violation IS NOT NULL""")
def label_violations(spark, d):
    series = F.col("bar_series_id")
    known = F.when(series % 5 == 0, F.col("outcome_end_ts") - F.make_dt_interval(hours=F.lit(1))).when(series % 5 == 1, F.col("label_available_at"))
    decided = F.when(series % 3 == 0, F.col("bar_open_ts") + F.make_dt_interval(days=F.lit(90))).otherwise(F.col("available_at"))
    labels = _labels(spark, d).select("bar_series_id", "bar_open_ts", F.col("bar_open_ts").alias("anchor_ts"), decided.alias("decision_ts"), "outcome_end_ts", known.alias("available_at"), "label")
    return training.label_violations(labels).select("bar_series_id", text_ts("bar_open_ts").alias("bar_open_ts"), "violation")


#: Feature streams: revisions of bars' closes, events of views by hour, and the day's purchases; all with availability of their own.
STREAMS = {"close": "SELECT bar_series_id AS series, bar_open_ts AS event_ts, available_at, revision_no, close_price AS value FROM bars",
    "viewed": "SELECT user_id AS series, ts AS event_ts, ts + to_hours(CAST(event_id % 5 AS BIGINT)) AS available_at, event_id AS revision_no, CAST(value AS DECIMAL(18,2)) AS value FROM events WHERE event_type = 'view'",
    "bought": "SELECT user_id AS series, date_trunc('day', ts)::TIMESTAMP AS event_ts, date_trunc('day', ts)::TIMESTAMP + INTERVAL 30 HOUR AS available_at, 1::BIGINT AS revision_no, CAST(sum(CAST(value AS DECIMAL(18,2))) AS DECIMAL(18,2)) AS value FROM events WHERE event_type = 'purchase' GROUP BY ALL"}


def _streams(spark, d):
    e, b = table(spark, d, "events"), bars(spark, d)
    day = F.col("ts").cast("date").cast("timestamp_ntz")
    bought = e.where("event_type = 'purchase'").groupBy(F.col("user_id").alias("bar_series_id"), day.alias("event_ts")).agg(F.sum(money("value")).cast("decimal(18,2)").alias("value"))
    return {
        "close": b.select("bar_series_id", F.col("bar_open_ts").alias("event_ts"), "available_at", "revision_no", F.col("close_price").alias("value")),
        "viewed": e.where("event_type = 'view'").select(F.col("user_id").alias("bar_series_id"), F.col("ts").alias("event_ts"), (F.col("ts") + F.make_dt_interval(hours=(F.col("event_id") % 5).cast("int"))).alias("available_at"), F.col("event_id").alias("revision_no"), money("value").alias("value")),
        "bought": bought.select("bar_series_id", "event_ts", (F.col("event_ts") + F.make_dt_interval(hours=F.lit(30))).alias("available_at"), F.lit(1).cast("bigint").alias("revision_no"), "value"),
    }


_AS_OF = lambda name: f"(SELECT arg_max(f.value, row(f.event_ts, f.revision_no)) FROM ({STREAMS[name]}) f WHERE f.series = s.bar_series_id AND f.available_at <= s.available_at)"
LENGTH, TRAIN_CUTOFF = 4, "2024-02-20"


@query("training_windows", f"""WITH {LABELS}, s AS (SELECT *, (k - 1) // {LENGTH} AS sample_no, (k - 1) % {LENGTH} AS step_no FROM o),
    x AS (SELECT bar_series_id, sample_no, max(bar_open_ts) AS bar_open_ts, max(available_at) AS decision_ts FROM s GROUP BY ALL HAVING count(*) = {LENGTH}),
    y AS (SELECT x.*, l.label FROM x JOIN labels l USING (bar_series_id, bar_open_ts) WHERE l.label IS NOT NULL AND l.label_available_at > x.decision_ts AND l.label_available_at <= TIMESTAMP '{TRAIN_CUTOFF}')
    SELECT s.bar_series_id, CAST(s.sample_no AS BIGINT) AS sample_no, CAST(s.step_no AS BIGINT) AS step_no, {sql_ts('y.decision_ts')} AS decision_ts, s.close_price, {_AS_OF('close')} AS close, {_AS_OF('viewed')} AS viewed, {_AS_OF('bought')} AS bought, CAST(y.label AS INTEGER) AS label
    FROM s JOIN y ON y.bar_series_id = s.bar_series_id AND y.sample_no = s.sample_no""")
def training_windows(spark, d):
    """Samples of four bars with three feature streams as of each bar, and a first-touch label known by the cutoff."""
    got = _windows(spark, d)
    return got.select("bar_series_id", "sample_no", "step_no", text_ts("decision_ts").alias("decision_ts"), "close_price", F.col("close.value").alias("close"), F.col("viewed.value").alias("viewed"), F.col("bought.value").alias("bought"), "label")


def _windows(spark, d):
    return training.windows(_newest(spark, d), _streams(spark, d), _labels(spark, d), "bar_series_id", LENGTH, F.lit(TRAIN_CUTOFF).cast("timestamp_ntz"))


@query("training_leaks", f"""WITH {LABELS}, s AS (SELECT *, (k - 1) // {LENGTH} AS sample_no FROM o),
    x AS (SELECT bar_series_id, sample_no, max(bar_open_ts) AS bar_open_ts, max(available_at) AS decision_ts FROM s GROUP BY ALL HAVING count(*) = {LENGTH})
    SELECT CAST(0 AS BIGINT) AS leaks, {LENGTH} * count(*) AS steps FROM x JOIN labels l USING (bar_series_id, bar_open_ts) WHERE l.label IS NOT NULL AND l.label_available_at > x.decision_ts AND l.label_available_at <= TIMESTAMP '{TRAIN_CUTOFF}'""")
def training_leaks(spark, d):
    """No feature or label of the samples may break availability."""
    return _windows(spark, d).agg(training.leaks(["close", "viewed", "bought"]).alias("leaks"), F.count(F.lit(1)).alias("steps"))
