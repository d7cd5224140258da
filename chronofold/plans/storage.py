"""Queries of constraints, partitions and snapshots in tasks."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from chronofold.operators import constraints as c
from chronofold.plans.catalogue import query
from chronofold.plans.views import BARS, bars, sql_ts, table, text_ts
from chronofold.sources import places
from chronofold.sources.partitions import MonthTable
from chronofold.sources.snapshot_tree import SnapshotTree

#: Fill-like rows made of line items: of three kinds with columns of their own, some of which are given to the wrong kind.
FILL_ROWS = """f AS (SELECT l_orderkey AS id, CAST(l_linenumber AS BIGINT) AS line, l_returnflag AS kind, CASE WHEN l_returnflag = 'A' OR l_orderkey % 97 = 0 THEN l_partkey END AS bar_id, CASE WHEN l_returnflag = 'R' THEN l_suppkey END AS tick_id,
        l_shipdate AS opened, CASE WHEN l_linenumber % 5 <> 0 THEN l_shipdate + to_days(CAST(l_orderkey % 11 - 1 AS INTEGER)) END AS closed, CAST(l_quantity AS BIGINT) AS wanted, CAST(l_orderkey % 50 AS BIGINT) AS done, CAST(l_partkey % 13 AS BIGINT) AS left_over,
        CAST(l_tax * 100 AS BIGINT) AS low, CAST(l_discount * 100 AS BIGINT) AS rate, CAST(8 AS BIGINT) AS high, CASE WHEN l_orderkey % 7 = 0 THEN 'done' END AS state, CASE WHEN l_orderkey % 21 <> 0 THEN sha256(CAST(l_orderkey AS VARCHAR)) ELSE 'none' END AS digest FROM lineitem)"""


def _fill_rows(spark, d):
    k = F.col("l_orderkey")
    days = F.make_dt_interval(days=(k % 11 - 1).cast("int"))
    return table(spark, d, "lineitem").select(
        k.alias("id"), F.col("l_linenumber").cast("bigint").alias("line"), F.col("l_returnflag").alias("kind"), F.when((F.col("l_returnflag") == "A") | (k % 97 == 0), F.col("l_partkey")).alias("bar_id"), F.when(F.col("l_returnflag") == "R", F.col("l_suppkey")).alias("tick_id"),
        F.col("l_shipdate").alias("opened"), F.when(F.col("l_linenumber") % 5 != 0, F.col("l_shipdate") + days).alias("closed"), F.col("l_quantity").cast("bigint").alias("wanted"), (k % 50).cast("bigint").alias("done"), (F.col("l_partkey") % 13).cast("bigint").alias("left_over"),
        F.round(F.col("l_tax") * 100).cast("bigint").alias("low"), F.round(F.col("l_discount") * 100).cast("bigint").alias("rate"), F.lit(8).cast("bigint").alias("high"), F.when(k % 7 == 0, "done").alias("state"), F.when(k % 21 != 0, F.sha2(k.cast("string"), 256)).otherwise("none").alias("digest"),
    )


def _rules():
    return [
        c.typed_by("kind", {"A": ["bar_id"], "R": ["tick_id"], "N": []}), c.ordered("opened", "closed"), c.total_within(["done", "left_over"], "wanted"), c.inside("rate", "low", "high"), c.above("wanted", 1), c.between("line", 1, 6),
        c.required_when("state", ["done"], ["closed"]), c.one_of("kind", "A", "R", "N"), c.sha256("digest"), c.given(["bar_id", "tick_id"], 0, 1), c.not_zero("done"), c.differ("done", "left_over"), c.together("bar_id", "tick_id"), c.absent_when("kind", ["N"], ["tick_id"]),
    ]


#: The same rules as SQL, by name; a rule is broken where it is false.
RULES_SQL = {
    "kind_TYPED": "(kind = 'A' AND bar_id IS NOT NULL AND tick_id IS NULL) OR (kind = 'R' AND bar_id IS NULL AND tick_id IS NOT NULL) OR (kind = 'N' AND bar_id IS NULL AND tick_id IS NULL)",
    "closed_AFTER_opened": "opened < closed", "done_left_over_WITHIN_wanted": "done + left_over <= wanted", "rate_INSIDE": "rate BETWEEN low AND high", "wanted_ABOVE": "wanted > 1", "line_BETWEEN": "line BETWEEN 1 AND 6",
    "closed_REQUIRED": "state NOT IN ('done') OR closed IS NOT NULL", "kind_ONE_OF": "kind IN ('A', 'R', 'N')", "digest_FORMAT": "regexp_matches(digest, '^[0-9a-f]{64}$')", "bar_id_tick_id_GIVEN": "CAST(bar_id IS NOT NULL AS INT) + CAST(tick_id IS NOT NULL AS INT) BETWEEN 0 AND 1",
    "done_NOT_ZERO": "done <> 0", "done_DIFFERS_left_over": "done <> left_over", "bar_id_tick_id_TOGETHER": "(bar_id IS NULL) = (tick_id IS NULL)", "tick_id_ABSENT": "kind NOT IN ('N') OR tick_id IS NULL",
}
BROKEN = "array_to_string(list_filter([" + ", ".join(f"CASE WHEN NOT ({v}) THEN '{k}' END" for k, v in RULES_SQL.items()) + "], lambda x: x IS NOT NULL), ',')"


@query("constraint_violations", f"WITH {FILL_ROWS}, b AS (SELECT id, line, {BROKEN} AS broken FROM f) SELECT * FROM b WHERE broken <> ''")
def constraint_violations(spark, d):
    return c.violations(_fill_rows(spark, d), _rules()).select("id", "line", F.array_join("broken", ",").alias("broken"))


@query("constraint_summary", f"WITH {FILL_ROWS} " + " UNION ALL ".join(f"SELECT '{k}' AS rule, count(*) FILTER (WHERE NOT ({v})) AS violations FROM f" for k, v in RULES_SQL.items()))
def constraint_summary(spark, d):
    return c.summary(_fill_rows(spark, d), _rules())


SINCE, UNTIL = datetime(2024, 1, 10), datetime(2024, 1, 25, 12)


@query("month_partitions", f"SELECT event_id, user_id, {sql_ts('ts')} AS ts, value FROM events WHERE ts >= TIMESTAMP '{SINCE}' AND ts < TIMESTAMP '{UNTIL}'")
def month_partitions(spark, d):
    """All events written by month and bucket, and a range read back."""
    events = table(spark, d, "events")
    out = MonthTable(spark, places.scratch(spark, "months"), "ts", "user_id")
    first, last = events.agg(F.min("ts"), F.max("ts")).first()
    for k in range(first.year * 12 + first.month - 1, last.year * 12 + last.month):
        out.register(f"{k // 12:04d}-{k % 12 + 1:02d}", 8 if k % 2 == 0 else 0)
    out.write(events)
    return out.read(SINCE, UNTIL).select("event_id", "user_id", text_ts("ts").alias("ts"), "value")


#: Revisions that are knowable at the cutoff; those that come later than a first cutoff's frozen days have drifted by the second.
FROZEN = f"""{BARS}, k AS (SELECT bar_series_id, bar_open_ts, is_final AND bar_close_ts <= TIMESTAMP '2024-01-20' AND available_at <= TIMESTAMP '2024-01-20' AND revision_no <> 2 AS held, is_final AND bar_close_ts <= TIMESTAMP '2024-01-20' AND available_at <= TIMESTAMP '2024-01-20' AS live FROM bars WHERE bar_open_ts < TIMESTAMP '2024-03-01')"""


def _frozen(spark, d):
    b = bars(spark, d)
    parts = b.select("bar_series_id").distinct().select(F.concat(F.lit("series-"), "bar_series_id").alias("component_key"), "bar_series_id", F.lit("2024-01-01").cast("timestamp_ntz").alias("event_from"), F.lit("2024-03-01").cast("timestamp_ntz").alias("event_to"), F.lit(True).alias("allow_empty"))
    store = SnapshotTree(spark, places.scratch(spark, "snapshots"))
    store.build("january", parts, b.where("revision_no <> 2"), datetime(2024, 1, 20), "PUBLIC_REPLAY")
    return store, b


@query("snapshot_components", f"WITH {FROZEN} SELECT 'series-' || bar_series_id AS component_key, count(*) FILTER (WHERE held) AS row_count, CAST(NULL AS VARCHAR) AS problem FROM k GROUP BY bar_series_id")
def snapshot_components(spark, d):
    """A component for each series, frozen and verified in tasks; problem is what verification finds."""
    store, _ = _frozen(spark, d)
    return store.components("january").join(store.verify("january"), "component_key", "left").select("component_key", "row_count", "problem")


@query("snapshot_drift", f"""WITH {FROZEN} SELECT 'series-' || bar_series_id AS component_key, strftime(bar_open_ts, '%Y-%m-%d') AS day, CASE WHEN count(*) FILTER (WHERE held) = 0 THEN 'ADDED' ELSE 'CHANGED' END AS change
    FROM k GROUP BY ALL HAVING count(*) FILTER (WHERE held) <> count(*) FILTER (WHERE live)""".replace("GROUP BY ALL", "GROUP BY bar_series_id, bar_open_ts"))
def snapshot_drift(spark, d):
    """The days on which bars give other lines than were frozen without second revisions."""
    store, b = _frozen(spark, d)
    return store.drift("january", b)
