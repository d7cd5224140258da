"""Training data as of a decision: features of many streams, labels of a horizon, and windows that hold both.

A decision knows what was available by its instant. Features of all streams are found in one sorted pass over a key: rows of
all streams and decisions in the order of availability, and a running maximum for each stream. Labels look forward and
say when they became known themselves; a training set takes those that its own cutoff knows.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.operators import ml


def features_as_of(decisions: DataFrame, streams: dict[str, DataFrame], key: str, at: str) -> DataFrame:
    """decisions with, for each stream, the fact with the latest event that was available then (of one event its newest revision).

    streams: name -> key, event_ts, available_at, revision_no, value. Adds struct columns by name: event_ts, revision_no,
    value, available_at; null where nothing was known. What becomes available at the decision's instant is known. Rows
    with a null key, event or availability are no facts; a decision with a null key or instant knows nothing."""
    facts = []
    for name, s in streams.items():
        fact = F.struct("event_ts", "revision_no", "value", "available_at")
        facts.append(s.dropna(subset=[key, "event_ts", "available_at"]).select(F.col(key).alias("_key"), F.col("available_at").alias("_at"), F.lit(0).alias("_kind"), fact.alias(f"_s_{name}")))
    asked = decisions.select(F.col(key).alias("_key"), F.col(at).alias("_at"), F.lit(1).alias("_kind"), F.struct(*decisions.columns).alias("_row"))
    every = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), [*facts, asked])
    run = Window.partitionBy("_key").orderBy("_at", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    known = [F.max(f"_s_{name}").over(run).alias(name) for name in streams]
    valid = F.col("_key").isNotNull() & F.col("_at").isNotNull()
    out = every.select("_kind", "_row", valid.alias("_valid"), *known).where("_kind = 1")
    return out.select("_row.*", *[F.when(F.col("_valid"), F.col(name)).alias(name) for name in streams])


def first_touch(bars: DataFrame, key: str, horizon: int, up: Column, down: Column) -> DataFrame:
    """The label of each bar: which barrier the next horizon bars touch first.

    bars: key, bar_open_ts (one row each), high_price, low_price, close_price, available_at; up and down: the prices of the
    barriers. Adds label (1 up, -1 down, 0 neither within the horizon; both in one bar count as down), touched_after (bars),
    outcome_end_ts (the deciding bar's opening) and label_available_at: when all bars up to the deciding one were known.
    Without a touch and with fewer bars than the horizon the label is still open: null. A frame holds horizon bars."""
    ahead = Window.partitionBy(key).orderBy("bar_open_ts").rowsBetween(1, horizon)
    seen = F.collect_list(F.struct("bar_open_ts", "high_price", "low_price", "available_at")).over(ahead)
    rows = bars.select(*bars.columns, up.alias("_up"), down.alias("_down"), seen.alias("_ahead"))
    side = lambda x: F.when(x["low_price"] <= F.col("_down"), -1).when(x["high_price"] >= F.col("_up"), 1)
    touches = F.filter(F.transform("_ahead", lambda x, i: F.struct((i + 1).alias("n"), side(x).alias("side"))), lambda t: t["side"].isNotNull())
    rows = rows.withColumn("_first", F.get(touches, 0))
    rows = rows.withColumn("touched_after", F.col("_first.n"))
    label = F.when(F.col("_first").isNotNull(), F.col("_first.side")).when(F.size("_ahead") == horizon, 0)
    rows = rows.withColumn("label", label.cast("int")).withColumn("_last", F.when(F.col("label").isNotNull(), F.coalesce("touched_after", F.lit(horizon))))
    used = F.slice("_ahead", 1, F.coalesce("_last", F.lit(0)))
    rows = rows.withColumn("outcome_end_ts", F.array_max(F.transform(used, lambda x: x["bar_open_ts"]))).withColumn("label_available_at", F.array_max(F.transform(used, lambda x: x["available_at"])))
    return rows.drop("_up", "_down", "_ahead", "_first", "_last")


def label_violations(labels: DataFrame) -> DataFrame:
    """Labels (anchor_ts, decision_ts, outcome_end_ts, available_at, label) that break a rule of availability."""
    has = F.col("label").isNotNull()
    code = (
        F.when(has & F.col("available_at").isNull(), "WITHOUT_AVAILABILITY").when(has & (F.col("outcome_end_ts") <= F.col("anchor_ts")), "OUTCOME_NOT_AHEAD")
        .when(F.col("available_at") < F.col("outcome_end_ts"), "BEFORE_OUTCOME_END").when(F.col("available_at") <= F.col("decision_ts"), "KNOWN_AT_DECISION")
    )
    return labels.withColumn("violation", code).where("violation IS NOT NULL")


def windows(bars: DataFrame, streams: dict[str, DataFrame], labels: DataFrame, key: str, length: int, cutoff: Column) -> DataFrame:
    """Complete samples of length bars, a row a step: key, sample_no, step_no, the bar, features as known when the bar was, and the sample's label.

    labels: key, bar_open_ts, label, label_available_at. A sample is decided when its last bar is known; its label is the
    one of that bar, and samples whose label is open, not known by the cutoff, or known at the decision already are left out. decision_ts is the sample's;
    a feature is never newer than the step's own bar, so not than the decision."""
    steps = ml.steps(bars, [key], ["bar_open_ts"], length)
    known = features_as_of(steps, streams, key, "available_at")
    last = steps.groupBy(key, "sample_no").agg(F.count(F.lit(1)).alias("_n"), F.max("bar_open_ts").alias("bar_open_ts"), F.max("available_at").alias("decision_ts")).where(F.col("_n") == length)
    ready = labels.where(F.col("label").isNotNull() & (F.col("label_available_at") <= cutoff)).select(key, "bar_open_ts", "label", "label_available_at")
    samples = last.join(ready, [key, "bar_open_ts"]).where("label_available_at > decision_ts").select(key, "sample_no", "decision_ts", "label", "label_available_at")
    return known.join(samples, [key, "sample_no"])


def leaks(streams: Sequence[str]) -> Column:
    """How many features of windows() were not available at their sample's decision, or labels that were: an aggregate, 0 if all is well."""
    bad = [F.count_if(F.col(f"{s}.available_at") > F.col("decision_ts")) for s in streams] + [F.count_if(F.col("label_available_at") <= F.col("decision_ts"))]
    return reduce(lambda a, b: a + b, bad)
