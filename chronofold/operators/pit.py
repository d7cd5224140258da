"""Point-in-time reads of revisioned facts: what was knowable at a cutoff, publicly or to this system."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chronofold.errors import InvalidArgument, NotFound, NullArgument

PUBLIC, SYSTEM = "PUBLIC_REPLAY", "SYSTEM_REPLAY"
#: Which clock each mode reads, and the order in which a later revision wins.
CLOCK = {PUBLIC: "available_at", SYSTEM: "system_available_at"}
WINNER = {
    PUBLIC: ("available_at", "revision_no", "system_available_at", "recorded_at", "ingestion_batch_id"),
    SYSTEM: ("system_available_at", "revision_no", "available_at", "recorded_at", "ingestion_batch_id"),
}


def clock(mode: str) -> str:
    """The availability column of a mode, chosen before planning so that filters on it reach the scan."""
    if mode is None:
        raise NullArgument("mode is null")
    if mode not in CLOCK:
        raise InvalidArgument(f"unknown replay mode {mode!r}")
    return CLOCK[mode]


def utc(value: datetime) -> datetime:
    """The instant without zone, in UTC, which is what tables hold; an argument without zone is one already."""
    return value if value.tzinfo is None else value.astimezone(timezone.utc).replace(tzinfo=None)


def checked_range(event_from: datetime, event_to: datetime, cutoff: datetime) -> None:
    for name, value in (("event_from", event_from), ("event_to", event_to), ("cutoff", cutoff)):
        if value is None:
            raise NullArgument(f"{name} is null")
        if not isinstance(value, datetime) or value.replace(tzinfo=None) in (datetime.min, datetime.max):
            raise InvalidArgument(f"{name} is not a finite timestamp")
    event_from, event_to, cutoff = utc(event_from), utc(event_to), utc(cutoff)
    if event_from >= event_to:
        raise InvalidArgument("event_from is not before event_to")
    if event_to > cutoff:
        raise InvalidArgument("event_to is after the cutoff")


def at(value: datetime) -> Column:
    return F.lit(utc(value).strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp_ntz")


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Of each key the row that is largest in order; columns of order that df lacks are passed over."""
    by = Window.partitionBy(*keys).orderBy(*[F.col(c).desc() for c in order if c in df.columns])
    return df.withColumn("_rank", F.row_number().over(by)).where("_rank = 1").drop("_rank")


def knowable(df: DataFrame, mode: str, cutoff: Column) -> DataFrame:
    """Final facts whose period has closed and that were available by the cutoff."""
    return df.where(F.col("is_final") & (F.col("bar_close_ts") <= cutoff) & (F.col(clock(mode)) <= cutoff))


def eligible_revisions(bars: DataFrame, series_ids: Iterable[int] | None, event_from: datetime, event_to: datetime, cutoff: datetime, mode: str) -> DataFrame:
    """Every revision that was knowable at the cutoff, with effective_available_at."""
    checked_range(event_from, event_to, cutoff)
    out = knowable(bars, mode, at(cutoff)).where((F.col("bar_open_ts") >= at(event_from)) & (F.col("bar_open_ts") < at(event_to)))
    if series_ids is not None:
        out = out.where(F.col("bar_series_id").isin(list(series_ids)))
    return out.withColumn("effective_available_at", F.col(clock(mode)))


def bars_as_of(bars: DataFrame, series_ids: Iterable[int] | None, event_from: datetime, event_to: datetime, cutoff: datetime, mode: str, series: DataFrame | None = None) -> DataFrame:
    """Of each bar the latest revision knowable at the cutoff.

    Filters come before the ranking, so that they reach the scan. series, if given, holds bar_series_id and
    adjustment_cutoff: unknown series, and adjustments made after the cutoff, are refused."""
    out = latest(eligible_revisions(bars, series_ids, event_from, event_to, cutoff, mode), ("bar_series_id", "bar_open_ts"), WINNER[mode])
    if series is not None and series_ids is not None:
        wanted = list(series_ids)
        known = {r[0]: r[1] for r in series.where(F.col("bar_series_id").isin(wanted)).select("bar_series_id", "adjustment_cutoff").collect()}
        for s in wanted:
            if s not in known:
                raise NotFound(f"unknown series {s}")
            if known[s] is not None and known[s] > utc(cutoff):
                raise InvalidArgument(f"the adjustment of series {s} was made after the cutoff")
    return out


def finite(*cols: str) -> Column:
    """Whether timestamps of rows are neither null nor one of the two that stand for infinity."""
    out = F.lit(True)
    for c in cols:
        out = out & F.col(c).isNotNull() & (F.col(c) > F.lit("0001-01-01").cast("timestamp_ntz")) & (F.col(c) < F.lit("9999-12-31 23:59:59.999999").cast("timestamp_ntz"))
    return out


def in_order(bars: DataFrame) -> DataFrame:
    """A read in its published order. Sorting is a shuffle of its own, so it is asked for and not part of the read."""
    return bars.orderBy("bar_open_ts", "bar_series_id", "revision_no")


def current_bar(bars: DataFrame) -> DataFrame:
    """The latest revision of each bar regardless of any cutoff, finality or the system's clock: not for history."""
    return latest(bars, ("bar_series_id", "bar_open_ts"), ("available_at", "revision_no"))


def bars_with_decision_lag(bars: DataFrame, lag_seconds: Column, cutoff: datetime, mode: str) -> DataFrame:
    """Of each bar the latest revision available by its close plus a lag, or the cutoff if that is sooner."""
    limit = F.least(F.col("bar_close_ts") + F.make_dt_interval(secs=lag_seconds), at(cutoff))
    return latest(bars.where("is_final").where(F.col(clock(mode)) <= limit), ("bar_series_id", "bar_open_ts"), WINNER[mode])


def quotes_as_of(quotes: DataFrame, cutoff: datetime, mode: str, keys: Sequence[str] = ("feed_id", "instrument_id", "event_ts")) -> DataFrame:
    """Of each quote the latest revision available at the cutoff."""
    return latest(quotes.where(F.col(clock(mode)) <= at(cutoff)), keys, WINNER[mode])
