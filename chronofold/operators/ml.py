"""Training data from point-in-time facts: windows, leakage audit, adjustment factors, folds, order books."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def steps(df: DataFrame, keys: Sequence[str], order: Sequence[str], length: int) -> DataFrame:
    """Rows cut into consecutive samples of length steps: sample_no, step_no (from 0)."""
    n = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) - 1
    return df.withColumn("_n", n).withColumn("sample_no", F.floor(F.col("_n") / length).cast("bigint")).withColumn("step_no", (F.col("_n") % length).cast("bigint")).drop("_n")


def complete_samples(stepped: DataFrame, keys: Sequence[str], length: int) -> DataFrame:
    """Samples whose steps are exactly 0 to length - 1."""
    return stepped.groupBy(*keys, "sample_no").agg(F.count(F.lit(1)).alias("n"), F.min("step_no").alias("lo"), F.max("step_no").alias("hi")).where((F.col("n") == length) & (F.col("lo") == 0) & (F.col("hi") == length - 1)).select(*keys, "sample_no")


def in_order(order: str, *fields: str) -> Column:
    """An aggregate: the rows' fields as structs, sorted by order."""
    return F.transform(F.array_sort(F.collect_list(F.struct(order, *fields))), lambda x: F.struct(*[x[f].alias(f) for f in fields]))


def sliding(df: DataFrame, keys: Sequence[str], order: str, value: str, length: int, stride: int) -> DataFrame:
    """Windows of length rows, every stride rows: first, last, total of value."""
    by = Window.partitionBy(*keys).orderBy(order)
    frame = by.rowsBetween(1 - length, 0)
    out = df.withColumn("_n", F.row_number().over(by)).withColumn("first_ts", F.first(order).over(frame)).withColumn("last_ts", F.col(order)).withColumn("total", F.sum(value).over(frame))
    return out.where((F.col("_n") >= length) & ((F.col("_n") - length) % stride == 0)).select(*keys, "first_ts", "last_ts", "total")


def folds(first_day: str, n: int, test_days: int) -> Column:
    """An array of walk-forward folds: fold, test_from, test_to."""
    day = lambda k: F.date_add(F.lit(first_day).cast("date"), k.cast("int"))
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), lambda i: F.struct(i.alias("fold"), day(i * test_days).alias("test_from"), day((i + 1) * test_days).alias("test_to")))


def assigned(samples: DataFrame, day: str, folded: DataFrame, purge_days: int, embargo_days: int) -> DataFrame:
    """Each sample's part in each fold: TEST, PURGED (just before), EMBARGOED (just after) or TRAIN."""
    d = F.col(day)
    part = (
        F.when((d >= F.col("test_from")) & (d < F.col("test_to")), "TEST")
        .when((d >= F.date_sub("test_from", purge_days)) & (d < F.col("test_from")), "PURGED")
        .when((d >= F.col("test_to")) & (d < F.date_add("test_to", embargo_days)), "EMBARGOED").otherwise("TRAIN")
    )
    return samples.join(F.broadcast(folded), F.lit(True)).withColumn("part", part)


def leaks(samples: DataFrame, features: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sample and feature pairs where the feature was not yet available at the sample's decision: must be empty."""
    return samples.join(features, list(keys)).where("feature_available_at > decision_ts")


def adjusted(bars: DataFrame, factors: DataFrame) -> DataFrame:
    """Each bar with the factor in force at its opening (the latest effective one): price * multiplier + addend."""
    span = factors.withColumn("_until", F.lead("effective_ts").over(Window.partitionBy("bar_series_id").orderBy("effective_ts")))
    b, f = bars.alias("b"), span.alias("f")
    on = (F.col("b.bar_series_id") == F.col("f.bar_series_id")) & (F.col("f.effective_ts") <= F.col("b.bar_open_ts")) & (F.col("f._until").isNull() | (F.col("f._until") > F.col("b.bar_open_ts")))
    multiplier, addend = F.coalesce("f.multiplier", F.lit(1)), F.coalesce("f.addend", F.lit(0))
    return b.join(f, on, "left").select("b.*", (F.col("b.close_price") * multiplier + addend).alias("adjusted_close"))


def book(deltas: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Levels of an order book after its deltas (action SET, DELETE, CLEAR; side, price, quantity)."""
    seq = F.struct(*order)
    cleared = deltas.where("action = 'CLEAR'").groupBy(*keys).agg(F.max(seq).alias("_cleared"))
    live = deltas.where("action <> 'CLEAR'").join(cleared, list(keys), "left").where(F.col("_cleared").isNull() | (seq > F.col("_cleared")))
    last = live.groupBy(*keys, "side", "price").agg(F.max(F.struct(*order, "action", "quantity")).alias("_l"))
    return last.where("_l.action = 'SET'").select(*keys, "side", "price", F.col("_l.quantity").alias("quantity"))
