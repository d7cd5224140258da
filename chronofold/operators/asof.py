"""As-of joins: what each decision could see, what an order executes on, the nearest earlier row.

Both sides of a key are put into one order and matched by one window over it, so that the work of a key is a sort and
not a product of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def backward(left: DataFrame, right: DataFrame, on: Sequence[str], left_ts: str, right_ts: str, payload: Sequence[str], left_id: Sequence[str]) -> DataFrame:
    """Each left row with the payload of the latest right row at or before it (of equally late ones the largest payload); null without one."""
    given = F.struct(*[F.col(p).alias(f"p{i}") for i, p in enumerate(payload)])
    asked = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(left_id)])
    names = [f"_k{i}" for i in range(len(on))]
    keys = [F.col(k).alias(n) for k, n in zip(on, names)]
    known = right.dropna(subset=list(on)).select(*keys, F.col(right_ts).alias("_ts"), given.alias("_given"))
    wanted = left.select(*keys, F.col(left_ts).alias("_ts"), asked.alias("_asked"))
    both = known.unionByName(wanted, allowMissingColumns=True)
    by = Window.partitionBy(*names).orderBy("_ts", F.col("_asked").isNotNull(), "_given").rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_found", F.last("_given", ignorenulls=True).over(by)).where("_asked IS NOT NULL")
    return found.select(*[F.col(f"_asked.c{i}").alias(c) for i, c in enumerate(left_id)], *[F.col(f"_found.p{i}").alias(p) for i, p in enumerate(payload)])


def decision_schedule(bars: DataFrame, clock: str) -> DataFrame:
    """One decision per bar, at the instant it can first be seen."""
    return bars.groupBy("bar_series_id", "bar_open_ts").agg(F.min(clock).alias("decision_ts"))


def visible_at(decisions: DataFrame, bars: DataFrame, clock: str, payload: Sequence[str]) -> DataFrame:
    """For each decision and bar of its series, the highest revision visible then.

    (A point-in-time read takes the latest available revision instead; the two differ where a lower revision becomes
    available later.)"""
    d = decisions.select("bar_series_id", "decision_ts").distinct()
    b = bars.select("bar_series_id", "bar_open_ts", F.col(clock).alias("_seen"), F.struct("revision_no", *payload).alias("_row"))
    joined = d.join(b, "bar_series_id").where("_seen <= decision_ts")
    best = joined.groupBy("bar_series_id", "decision_ts", "bar_open_ts").agg(F.max("_row").alias("_row"))
    return best.select("bar_series_id", "decision_ts", "bar_open_ts", "_row.*")


def last_visible(decisions: DataFrame, bars: DataFrame, clock: str, n: int, payload: Sequence[str]) -> DataFrame:
    """For each decision the newest n bars of its series that are visible then, each by its highest revision; rank 1 is the newest.

    A revision is visible from its own instant to the first one of a higher revision. Bars are numbered along a series; one
    window counts those that a decision can see and finds the newest, and where it sees all up to that one its bars are
    the last n numbers, an equal join of n rows a decision. Only decisions with a bar that is still to come meet all of
    their series' bars. Rows with a null clock are never seen."""
    series = Window.partitionBy("bar_series_id").orderBy("bar_open_ts")
    higher = Window.partitionBy("bar_series_id", "bar_open_ts").orderBy(F.desc("revision_no")).rowsBetween(Window.unboundedPreceding, -1)
    seen = bars.where(F.col(clock).isNotNull()).select("bar_series_id", "bar_open_ts", "revision_no", *payload, F.col(clock).alias("_from"))
    spans = seen.withColumn("_until", F.min("_from").over(higher)).withColumn("_k", F.dense_rank().over(series))
    spans = spans.where(F.col("_until").isNull() | (F.col("_until") > F.col("_from")))
    first = spans.groupBy("bar_series_id", "_k").agg(F.min("_from").alias("_ts"))
    asked = decisions.select("bar_series_id", F.col("decision_ts").alias("_ts")).distinct().withColumn("_asked", F.lit(True))
    run = Window.partitionBy("bar_series_id").orderBy("_ts", F.col("_asked").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    both = first.unionByName(asked, allowMissingColumns=True).withColumn("_newest", F.max("_k").over(run)).withColumn("_seen", F.count("_k").over(run))
    asked = both.where("_asked AND _seen > 0").select("bar_series_id", F.col("_ts").alias("decision_ts"), "_newest", "_seen")
    visible = (F.col("_from") <= F.col("decision_ts")) & (F.col("_until").isNull() | (F.col("_until") > F.col("decision_ts")))
    out = ["bar_series_id", "decision_ts", "rank", "bar_open_ts", "revision_no", *payload]
    whole = asked.where("_seen = _newest").withColumn("_k", F.explode(F.sequence(F.greatest(F.lit(1), F.col("_newest") - (n - 1)), F.col("_newest"))))
    plain = whole.join(spans, ["bar_series_id", "_k"]).where(visible).withColumn("rank", (F.col("_newest") - F.col("_k") + 1).cast("int"))
    by = Window.partitionBy("bar_series_id", "decision_ts").orderBy(F.desc("bar_open_ts"))
    rest = asked.where("_seen <> _newest").join(spans, "bar_series_id").where(visible).withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= n)
    return plain.select(*out).unionByName(rest.select(*out))


def next_execution_bar(orders: DataFrame, bars: DataFrame, clock: str, lag_seconds: Column) -> DataFrame:
    """For each order (order_id, bar_series_id, signal_open_ts, submitted_at) the first later bar that can first be seen at or after submission plus lag; null without one.

    Going back in time, a window keeps the earliest opening among the bars that are seen late enough. Where that bar
    opens after the signal's it is the answer; only orders to which an older bar still comes late meet their series' bars."""
    first = bars.groupBy("bar_series_id", "bar_open_ts").agg(F.min(clock).alias("first_seen"))
    asked = orders.select("bar_series_id", "order_id", "signal_open_ts", (F.col("submitted_at") + F.make_dt_interval(secs=lag_seconds)).alias("_ts"))
    known = first.select("bar_series_id", F.col("first_seen").alias("_ts"), F.struct("bar_open_ts", "first_seen").alias("_bar"))
    both = known.unionByName(asked.withColumn("_asked", F.lit(True)), allowMissingColumns=True)
    by = Window.partitionBy("bar_series_id").orderBy(F.desc("_ts"), F.col("_asked").isNotNull()).rowsBetween(Window.unboundedPreceding, 0)
    found = both.withColumn("_best", F.min("_bar").over(by)).where("_asked")
    late = F.coalesce(F.col("_best.bar_open_ts") <= F.col("signal_open_ts"), F.lit(False))
    plain = found.where(~late).select("order_id", "bar_series_id", F.col("_best").alias("_b"))
    rest = found.where(late).select("order_id", "bar_series_id", "signal_open_ts", "_ts").join(first, "bar_series_id")
    ok = (F.col("bar_open_ts") > F.col("signal_open_ts")) & (F.col("first_seen") >= F.col("_ts"))
    rest = rest.groupBy("order_id", "bar_series_id").agg(F.min(F.when(ok, F.struct("bar_open_ts", "first_seen"))).alias("_b"))
    return plain.unionByName(rest).select("order_id", "bar_series_id", F.col("_b.bar_open_ts").alias("execution_open_ts"), F.col("_b.first_seen").alias("execution_ts"))
