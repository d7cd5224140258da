"""Validity intervals [from, to), an open end being null: lookups, overlaps, calendars, slowly changing dimensions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.errors import Ambiguous, NotFound

FOREVER = "9999-12-31 00:00:00"


def end(c: str | Column) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(FOREVER).cast("timestamp_ntz"))


def valid_at(start: Column, stop: Column, moment: Column) -> Column:
    """A null start is the beginning of time."""
    return (start.isNull() | (start <= moment)) & (stop.isNull() | (stop > moment))


def as_of(df: DataFrame, moment: Column, start: str = "valid_from", stop: str = "valid_to") -> DataFrame:
    return df.where(valid_at(F.col(start), F.col(stop), moment))


def the_one(df: DataFrame, what: str = "row"):
    """The only row; none or several are errors."""
    rows = df.limit(2).collect()
    if not rows:
        raise NotFound(f"no {what}")
    if len(rows) > 1:
        raise Ambiguous(f"more than one {what}")
    return rows[0]


def by_code(df: DataFrame, code: str, value: str, within: dict | None = None):
    """The one row with a natural key: a provider by code, a feed by code within its provider, a timeframe, a session."""
    for c, v in (within or {}).items():
        df = df.where(F.col(c).eqNullSafe(F.lit(v)))
    return the_one(df.where(F.col(code) == F.lit(value)), f"{code} {value!r}")


def sessions(calendar: DataFrame, venue: str, first, last, code: str = "REGULAR") -> DataFrame:
    """A venue's sessions of a code from one trading date to another, both included, in order."""
    held = (F.col("venue_code") == F.lit(venue)) & (F.col("session_code") == F.lit(code))
    return calendar.where(held & F.col("trading_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))).orderBy("trading_date")


def ambiguous_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that more than one row has, with the number: the batch form of the_one()."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def overlap_pairs(df: DataFrame, keys: Sequence[str], id_col: str, start: str = "valid_from", stop: str = "valid_to") -> DataFrame:
    """Pairs of a key's intervals that overlap: an equality join with the range as residual."""
    a, b = df.alias("a"), df.alias("b")
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    first = (F.col(f"a.{start}") < F.col(f"b.{start}")) | ((F.col(f"a.{start}") == F.col(f"b.{start}")) & (F.col(f"a.{id_col}") < F.col(f"b.{id_col}")))
    on = first & (F.col(f"b.{start}") < end(f"a.{stop}")) & (F.col(f"a.{start}") < end(f"b.{stop}"))
    for s in same:
        on = on & s
    return a.join(b, on).select(*[F.col(f"a.{k}").alias(k) for k in keys], F.col(f"a.{id_col}").alias("first_id"), F.col(f"b.{id_col}").alias("second_id"))


def overlapping_rows(df: DataFrame, keys: Sequence[str], id_col: str, start: str = "valid_from", stop: str = "valid_to") -> DataFrame:
    """Rows that begin before an earlier interval of their key has ended, by a running maximum: linear in the rows."""
    before = Window.partitionBy(*keys).orderBy(start, id_col).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn("_reach", F.max(end(stop)).over(before)).where(F.col(start) < F.col("_reach")).drop("_reach")


def rejected_proposals(proposed: DataFrame, existing: DataFrame, keys: Sequence[str], start: str = "valid_from", stop: str = "valid_to") -> DataFrame:
    """Proposed rows that overlap an existing interval of their key."""
    p, e = proposed.alias("p"), existing.alias("e")
    on = (F.col(f"p.{start}") < end(f"e.{stop}")) & (F.col(f"e.{start}") < end(f"p.{stop}"))
    for k in keys:
        on = on & F.col(f"p.{k}").eqNullSafe(F.col(f"e.{k}"))
    return p.join(e, on, "left_semi")


def missing_days(days: DataFrame, day_col: str, first: Column, last: Column) -> DataFrame:
    """Dates of the inclusive range that days lacks."""
    every = days.sparkSession.range(1).select(F.explode(F.sequence(first.cast("date"), last.cast("date"))).alias(day_col))
    return every.join(days.select(F.col(day_col).cast("date").alias(day_col)).distinct(), day_col, "left_anti")


def versions(changes: DataFrame, keys: Sequence[str], value: Sequence[str], start: str) -> DataFrame:
    """Dated values to adjacent intervals: unchanged values join the interval before, a change closes it (SCD2)."""
    by = Window.partitionBy(*keys).orderBy(start, *value)
    packed = F.struct(*value)
    first = F.row_number().over(by) == 1
    changed = changes.withColumn("_new", first | ~F.lag(packed).over(by).eqNullSafe(packed)).where("_new")
    return changed.select(*keys, *value, F.col(start).alias("valid_from"), F.lead(start).over(Window.partitionBy(*keys).orderBy(start, *value)).alias("valid_to"))


def rename(intervals: DataFrame, renames: DataFrame, key: str, value: str) -> DataFrame:
    """Close the open interval of each renamed key at the rename and open an adjacent one with the new value.

    renames: key, new_value, effective_from. History is never rewritten: only open intervals that began before the
    rename are closed."""
    joined = intervals.join(renames, key, "left")
    hit = F.col("new_value").isNotNull() & F.col("valid_to").isNull() & (F.col("valid_from") < F.col("effective_from")) & ~F.col("new_value").eqNullSafe(F.col(value))
    kept = joined.select(key, value, "valid_from", F.when(hit, F.col("effective_from")).otherwise(F.col("valid_to")).alias("valid_to"))
    opened = joined.where(hit).select(key, F.col("new_value").alias(value), F.col("effective_from").alias("valid_from"), F.lit(None).cast("timestamp_ntz").alias("valid_to"))
    return kept.unionByName(opened)


def reference_diff(wanted: DataFrame, stored: DataFrame, keys: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """keys, outcome (CREATED, UNCHANGED, CONFLICT) and the names of differing fields, for rows that must never change."""
    s = stored.select(*keys, *[F.col(f).alias(f"_{f}") for f in fields], F.lit(True).alias("_there"))
    differ = F.filter(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    out = wanted.join(s, list(keys), "left").withColumn("_differ", differ)
    outcome = F.when(F.col("_there").isNull(), "CREATED").when(F.size("_differ") == 0, "UNCHANGED").otherwise("CONFLICT")
    names = F.when(F.col("_there").isNull(), "").otherwise(F.array_join("_differ", ","))
    return out.select(*keys, outcome.alias("outcome"), names.alias("fields"))
