"""Relational accounting over fills: pricing, cash, positions, closed trades, equity, drawdown.

Exact decimals throughout. A running sum needs a total order of the rows; rows that are equal in every column are
interchangeable."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BPS = 10_000


def execution_price(price: Column, side: Column, slippage_bps: int) -> Column:
    """The reference price moved against the side by the slippage; price: decimal(12,2), result decimal(18,6)."""
    up, down = (F.lit(f"{1 + s * slippage_bps / BPS:.4f}").cast("decimal(5,4)") for s in (1, -1))
    return F.when(side == "BUY", price.cast("decimal(12,2)") * up).otherwise(price.cast("decimal(12,2)") * down)


def share(amount: Column, bps: int) -> Column:
    return amount * F.lit(f"{bps / BPS:.4f}").cast("decimal(5,4)")


def priced(fills: DataFrame, commission_bps: int, slippage_bps: int, sell_tax_bps: int) -> DataFrame:
    """fills (side, quantity, reference_price) with execution_price, notional, commission, tax, slippage, cash_delta."""
    q, side = F.col("quantity").cast("decimal(6,0)"), F.col("side")
    out = fills.withColumn("execution_price", execution_price(F.col("reference_price"), side, slippage_bps))
    out = out.withColumn("notional", (F.col("execution_price") * q).cast("decimal(24,6)"))
    out = out.withColumn("commission", share(F.col("notional"), commission_bps)).withColumn("tax", F.when(side == "SELL", share(F.col("notional"), sell_tax_bps)).otherwise(0).cast("decimal(30,10)"))
    out = out.withColumn("slippage", (F.abs(F.col("execution_price") - F.col("reference_price")) * q).cast("decimal(24,6)"))
    paid = F.col("commission") + F.col("tax")
    return out.withColumn("cash_delta", F.when(side == "BUY", -(F.col("notional") + paid)).otherwise(F.col("notional") - paid).cast("decimal(30,10)"))


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str], amount: Column, name: str, kind: str) -> DataFrame:
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn(name, F.sum(amount).over(by).cast(kind))


def closed_trades(fills: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Each SELL that directly follows a BUY of its key, with entry_price and pnl: a later BUY replaces an open entry."""
    by = Window.partitionBy(*keys).orderBy(*order)
    out = fills.withColumn("_side", F.lag("side").over(by)).withColumn("entry_price", F.lag("price").over(by))
    return out.where("side = 'SELL' AND _side = 'BUY'").drop("_side").withColumn("pnl", ((F.col("price") - F.col("entry_price")) * F.col("quantity")).cast("decimal(28,2)"))


def drawdown(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str) -> DataFrame:
    """How far value lies below its highest so far."""
    by = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return df.withColumn("peak", F.max(value).over(by)).withColumn("drawdown", F.col("peak") - F.col(value))


def performance(df: DataFrame, keys: Sequence[str], ret: str, periods: int = 252) -> DataFrame:
    """Mean, volatility, Sharpe and Sortino ratios of period returns, annualised; null where they are undefined.

    An extension: run summaries leave these columns empty."""
    down = F.sqrt(F.avg(F.pow(F.when(F.col(ret) < 0, F.col(ret)).when(F.col(ret) >= 0, 0.0), 2)))
    out = df.groupBy(*keys).agg(F.count(ret).alias("n"), F.avg(ret).alias("mean"), F.stddev_samp(ret).alias("sd"), down.alias("down"))
    year = F.sqrt(F.lit(float(periods)))
    ratio = lambda d: F.when(F.col(d) > 0, F.col("mean") / F.col(d) * year)
    return out.select(*keys, "n", (F.col("sd") * year).alias("volatility"), ratio("sd").alias("sharpe"), ratio("down").alias("sortino"))


def trade_performance(trades: DataFrame, keys: Sequence[str], pnl: str = "pnl") -> DataFrame:
    """Closed trades of each key: trades, wins, gained, lost, and the profit factor, null without a loss."""
    gained, lost = F.sum(F.when(F.col(pnl) > 0, F.col(pnl)).otherwise(0)), F.sum(F.when(F.col(pnl) < 0, -F.col(pnl)).otherwise(0))
    out = trades.groupBy(*keys).agg(F.count(F.lit(1)).alias("trades"), F.count_if(F.col(pnl) > 0).alias("wins"), gained.alias("gained"), lost.alias("lost"))
    return out.withColumn("profit_factor", F.when(F.col("lost") > 0, F.col("gained").cast("double") / F.col("lost").cast("double")))


def activity(fills: DataFrame, equity: DataFrame, keys: Sequence[str]) -> DataFrame:
    """turnover (notional traded over mean equity) and exposure (mean share of equity that is held) of each key.

    fills: keys, notional; equity: keys, equity, held (a row a point in time)."""
    traded = fills.groupBy(*keys).agg(F.sum(F.abs("notional")).alias("_traded"))
    points = equity.groupBy(*keys).agg(F.avg(F.col("equity").cast("double")).alias("_mean"), F.avg(F.when(F.col("equity") != 0, F.col("held").cast("double") / F.col("equity").cast("double"))).alias("exposure"))
    turnover = F.when(F.col("_mean") != 0, F.coalesce(F.col("_traded").cast("double"), F.lit(0.0)) / F.col("_mean"))
    return points.join(traded, list(keys), "left").select(*keys, turnover.alias("turnover"), "exposure")
