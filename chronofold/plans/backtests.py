"""Backtest queries: a sweep of windows over all users' bars, one run for each user and pair of windows."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone
from decimal import Decimal

from pyspark.sql import functions as F

from chronofold.operators import backtest
from chronofold.plans.catalogue import query
from chronofold.plans.views import bars


def _journal(spark, d, *kinds):
    utc = timezone.utc
    costs = backtest.Costs(Decimal(5), Decimal(10), Decimal(25))
    frozen = bars(spark, d).where("is_final").select(F.col("bar_series_id").alias("instrument_id"), "bar_open_ts", "bar_series_id", "revision_no", "available_at", F.col("available_at").alias("effective_available_at"), "close_price")
    specs = [backtest.Spec(f"sma-{a}-{b}", datetime(2024, 1, 1, tzinfo=utc), datetime(2024, 3, 1, tzinfo=utc), Decimal(100000), a, b, Decimal(10), costs, ()) for a, b in ((1, 2), (2, 3), (2, 5), (3, 8))]
    return backtest.run_each(frozen, specs, timedelta(hours=1), kinds=kinds)


@query("backtest_simulate_fills")
def backtest_simulate_fills(spark, d):
    return _journal(spark, d, "fill").select("run_code", "seq", "instrument_id", "event_ts", "side", "quantity", "price", "cash")


@query("backtest_equity")
def backtest_equity(spark, d):
    return _journal(spark, d, "equity", "summary", "failed").select("run_code", "journal", "price", "cash", "payload")
