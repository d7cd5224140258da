"""Integrity rules as set-based queries: their rows are the violations, and a publish needs them empty."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def num_nonnulls(*cols: str | Column) -> Column:
    out = F.lit(0)
    for c in cols:
        out = out + (F.col(c) if isinstance(c, str) else c).isNotNull().cast("int")
    return out


def is_distinct(a: Sequence[Column], b: Sequence[Column]) -> Column:
    """ROW(a) IS DISTINCT FROM ROW(b)."""
    return ~F.struct(*[x.alias(f"c{i}") for i, x in enumerate(a)]).eqNullSafe(F.struct(*[x.alias(f"c{i}") for i, x in enumerate(b)]))


def ohlc_violations(df: DataFrame, o: str = "open_price", h: str = "high_price", l: str = "low_price", c: str = "close_price", v: str = "volume") -> DataFrame:
    """Rows whose prices are not ordered or negative, with the rules that they break; a null breaks none."""
    rules = {"HIGH_BELOW_LOW": F.col(h) < F.col(l), "OPEN_OUTSIDE": (F.col(o) < F.col(l)) | (F.col(o) > F.col(h)), "CLOSE_OUTSIDE": (F.col(c) < F.col(l)) | (F.col(c) > F.col(h)), "NEGATIVE_PRICE": F.least(o, h, l, c) < 0, "NEGATIVE_VOLUME": F.col(v) < 0}
    broken = F.filter(F.array(*[F.when(w, F.lit(k)) for k, w in rules.items()]), lambda x: x.isNotNull())
    return df.withColumn("rules", F.array_join(broken, ",")).where("rules <> ''")


def decision_violations(inputs: DataFrame, bars: DataFrame, bound: DataFrame, clock: str, cutoff: Column, role: str | None = None) -> DataFrame:
    """Decision inputs of a series that their run does not bind (for the role, if one is named), or that were not available
    by the decision and the cutoff."""
    keys = ["bar_series_id", "bar_open_ts", "revision_no"]
    if role is not None:
        bound = bound.where(F.col("series_role") == role).select("run_id", "bar_series_id").distinct()
    seen = inputs.join(bars.select(*keys, F.col(clock).alias("effective_at")), keys, "left").join(bound.withColumn("_bound", F.lit(True)), ["run_id", "bar_series_id"], "left")
    code = (
        F.when(F.col("effective_at").isNull(), "UNKNOWN_BAR").when(F.col("_bound").isNull(), "UNBOUND_SERIES")
        .when(F.col("effective_at") > F.col("decision_ts"), "LOOK_AHEAD").when(F.col("effective_at") > cutoff, "AFTER_CUTOFF")
    )
    return seen.withColumn("violation", code).where("violation IS NOT NULL").drop("_bound")


def fill_violations(refs: DataFrame, sources: dict[str, DataFrame], cutoff: Column) -> DataFrame:
    """Fill references (fill_id, reference_type, source_id, instrument_id, fill_ts) against the source of their type
    (source_id, instrument_id, effective_at); a MODEL reference has no source."""
    every = None
    for kind, s in sources.items():
        part = s.select(F.lit(kind).alias("reference_type"), "source_id", F.col("instrument_id").alias("_instrument"), "effective_at")
        every = part if every is None else every.unionByName(part)
    joined = refs.join(every, ["reference_type", "source_id"], "left")
    code = (
        F.when(F.col("reference_type") == "MODEL", F.when(F.col("source_id").isNotNull(), "MODEL_WITH_SOURCE"))
        .when(F.col("effective_at").isNull(), "UNKNOWN_SOURCE").when(F.col("_instrument") != F.col("instrument_id"), "OTHER_INSTRUMENT")
        .when(F.col("effective_at") > F.col("fill_ts"), "LOOK_AHEAD").when(F.col("effective_at") > cutoff, "AFTER_CUTOFF")
    )
    return joined.withColumn("violation", code).where("violation IS NOT NULL").drop("_instrument")


def fill_reference_violations(refs: DataFrame, fills: DataFrame, sources: dict[str, DataFrame], bound: DataFrame, runs: DataFrame) -> DataFrame:
    """References of fills (run_id, fill_id, instrument_id, reference_type, source_id, bar_series_id) that break a rule; the first one counts.

    fills: run_id, fill_id, instrument_id, fill_ts; a reference is of a fill of its own run and instrument. sources: type -> source_id,
    instrument_id, effective_at, of which a reference names one exactly; MODEL names none. bound: run_id, bar_series_id, series_role;
    a BAR is of a series that the run binds for EXECUTION. runs: run_id, cutoff."""
    every = None
    for kind, s in sources.items():
        part = s.select(F.lit(kind).alias("reference_type"), "source_id", F.col("instrument_id").alias("_instrument"), "effective_at")
        every = part if every is None else every.unionByName(part)
    roles = bound.where("series_role = 'EXECUTION'").select("run_id", "bar_series_id").distinct().withColumn("_bound", F.lit(True))
    own = fills.select("run_id", "fill_id", "instrument_id", "fill_ts")
    joined = refs.join(own, ["run_id", "fill_id", "instrument_id"], "left").join(runs.select("run_id", "cutoff"), "run_id", "left").join(every, ["reference_type", "source_id"], "left").join(roles, ["run_id", "bar_series_id"], "left")
    code = (
        F.when(F.col("fill_ts").isNull(), "NO_FILL").when(F.col("reference_type") == "MODEL", F.when(F.col("source_id").isNotNull(), "MODEL_WITH_SOURCE"))
        .when((F.col("reference_type") == "BAR") & F.col("_bound").isNull(), "UNBOUND_SERIES").when(F.col("effective_at").isNull(), "UNKNOWN_SOURCE")
        .when(F.col("_instrument") != F.col("instrument_id"), "OTHER_INSTRUMENT").when(F.col("effective_at") > F.col("fill_ts"), "LOOK_AHEAD").when(F.col("effective_at") > F.col("cutoff"), "AFTER_CUTOFF")
    )
    return joined.withColumn("violation", code).where("violation IS NOT NULL").select(*refs.columns, "violation")


def touched(changes: DataFrame, before: str, after: str, name: str) -> DataFrame:
    """The keys that changes touch, once each: those that rows had and those that they have now."""
    return changes.select(F.explode(F.array(before, after)).alias(name)).where(F.col(name).isNotNull()).distinct()


def order_totals(orders: DataFrame, fills: DataFrame) -> DataFrame:
    """orders with filled_quantity (0 without a fill) and first_fill_ts."""
    totals = fills.groupBy("order_id").agg(F.sum("quantity").alias("filled_quantity"), F.min("fill_ts").alias("first_fill_ts"))
    return orders.join(totals, "order_id", "left").withColumn("filled_quantity", F.coalesce("filled_quantity", F.lit(0)).cast("bigint"))


def order_violations(totals: DataFrame) -> DataFrame:
    """The first rule that an order with its totals breaks."""
    filled, wanted, status = F.col("filled_quantity"), F.col("quantity"), F.col("status")
    code = (
        F.when(F.col("first_fill_ts") < F.col("submitted_at"), "FILL_BEFORE_SUBMISSION").when(filled > wanted, "OVERFILLED")
        .when((status == "FILLED") & (filled != wanted), "FILLED_NOT_EQUAL").when((status == "PARTIAL") & ~((filled > 0) & (filled < wanted)), "PARTIAL_NOT_BETWEEN")
        .when(status.isin("NEW", "ACCEPTED", "REJECTED") & (filled != 0), "UNEXPECTED_FILL")
    )
    return totals.withColumn("violation", code).where("violation IS NOT NULL")


def unbound_series(used: DataFrame, bound: DataFrame, keys: Sequence[str] = ("run_id", "bar_series_id")) -> DataFrame:
    return used.join(bound.select(*keys).distinct(), list(keys), "left_anti")


def feature_violations(features: DataFrame) -> DataFrame:
    """Features that were available before their window ended or before their newest source was."""
    code = F.when(F.col("available_at") < F.col("window_end_ts"), "BEFORE_WINDOW_END").when(F.col("available_at") < F.col("source_available_at"), "BEFORE_SOURCE")
    return features.withColumn("violation", code).where("violation IS NOT NULL")


def vector_violations(df: DataFrame, vector: str, expected: Column) -> DataFrame:
    """Vectors of another length than declared, with their missing (null) elements."""
    return df.withColumn("length", F.size(vector)).withColumn("missing", F.size(F.filter(vector, lambda x: x.isNull()))).where(F.col("length") != expected)


def set_difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows that only one of two tables has, with multiplicity, and which."""
    return a.exceptAll(b).withColumn("side", F.lit("LEFT")).unionByName(b.exceptAll(a).withColumn("side", F.lit("RIGHT")))


def run_boundary_violations(runs: DataFrame, snapshots: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """Runs (run_id, snapshot_id, cutoff, mode) that do not replay a frozen snapshot at its own boundary, or that moved
    it after they had left QUEUED (before: run_id, snapshot_id, cutoff, mode and status as they were)."""
    s = snapshots.select("snapshot_id", F.col("status").alias("_status"), F.col("cutoff").alias("_cutoff"), F.col("mode").alias("_mode"))
    seen = runs.join(s, "snapshot_id", "left")
    code = F.when(~F.col("_status").eqNullSafe(F.lit("FROZEN")), "NOT_FROZEN").when(is_distinct([F.col("cutoff"), F.col("mode")], [F.col("_cutoff"), F.col("_mode")]), "OTHER_BOUNDARY")
    if before is not None:
        old = before.where("status <> 'QUEUED'").select("run_id", *[F.col(c).alias(f"_old_{c}") for c in ("snapshot_id", "cutoff", "mode")], F.lit(True).alias("_left"))
        seen = seen.join(old, "run_id", "left")
        names = ("snapshot_id", "cutoff", "mode")
        code = code.when(F.col("_left") & is_distinct([F.col(c) for c in names], [F.col(f"_old_{c}") for c in names]), "BOUNDARY_CHANGED")
    return seen.withColumn("violation", code).where("violation IS NOT NULL").select(*runs.columns, "violation")


def valuation_violations(valuations: DataFrame, bars: DataFrame, bound: DataFrame, clock: str, cutoff: Column) -> DataFrame:
    """Position valuations (run_id, instrument_id, snapshot_ts and a bar's keys) whose bar is missing, of another instrument, of
    a series that the run does not bind for VALUATION, or was not available at the valuation and the cutoff."""
    keys = ["bar_series_id", "bar_open_ts", "revision_no"]
    roles = bound.where("series_role = 'VALUATION'").select("run_id", "bar_series_id").distinct().withColumn("_bound", F.lit(True))
    b = bars.select(*keys, F.col("instrument_id").alias("_instrument"), F.col(clock).alias("effective_at"))
    seen = valuations.join(b, keys, "left").join(roles, ["run_id", "bar_series_id"], "left")
    code = (
        F.when(F.col("effective_at").isNull(), "UNKNOWN_BAR").when(F.col("_instrument") != F.col("instrument_id"), "OTHER_INSTRUMENT").when(F.col("_bound").isNull(), "UNBOUND_SERIES")
        .when(F.col("effective_at") > F.col("snapshot_ts"), "LOOK_AHEAD").when(F.col("effective_at") > cutoff, "AFTER_CUTOFF")
    )
    return seen.withColumn("violation", code).where("violation IS NOT NULL").drop("_bound", "_instrument")


def batch_count_violations(batches: DataFrame) -> DataFrame:
    """Batches with a negative count, or with more rows accepted and rejected than received."""
    r, a, x = F.col("received"), F.col("accepted"), F.col("rejected")
    code = F.when(F.least(r, a, x) < 0, "NEGATIVE_COUNT").when(a + x > r, "MORE_THAN_RECEIVED")
    return batches.withColumn("violation", code).where("violation IS NOT NULL")


def sequence_gaps(df: DataFrame, keys: Sequence[str], sequence: str, width: int | None = None) -> DataFrame:
    """keys, after and before: the ends of each gap in a key's sequence numbers.

    With a width a key's whole numbers are dealt by stretches of so many, and what lies between two stretches is found from their ends: for
    a key, or no key at all, that holds a whole table."""
    if width is None:
        by = Window.partitionBy(*keys).orderBy(sequence)
        return df.select(*keys, F.lag(sequence).over(by).alias("after"), F.col(sequence).alias("before")).where("before > after + 1")
    dealt = df.select(*keys, sequence, F.expr(f"`{sequence}` div {width}").alias("_stretch"))
    inside = sequence_gaps(dealt, [*keys, "_stretch"], sequence).drop("_stretch")
    ends = dealt.groupBy(*keys, "_stretch").agg(F.min(sequence).alias("before"), F.max(sequence).alias("_last"))
    between = ends.select(*keys, F.lag("_last").over(Window.partitionBy(*keys).orderBy("_stretch")).alias("after"), "before").where("before > after + 1")
    return inside.unionByName(between)


def outside_session(df: DataFrame, calendar: DataFrame, day: str, ts: str) -> DataFrame:
    """Rows whose timestamp lies in no session of their day; calendar: day, session_open_ts, session_close_ts."""
    return df.alias("x").join(calendar.alias("c"), (F.col(f"x.{day}") == F.col(f"c.{day}")) & (F.col(f"x.{ts}") >= F.col("c.session_open_ts")) & (F.col(f"x.{ts}") <= F.col("c.session_close_ts")), "left_anti")


def quality_gates(checks: dict[str, DataFrame]) -> DataFrame:
    """gate, violations and passed of each check, a DataFrame whose rows are violations. A dataset is frozen where all pass."""
    out = None
    for name, rows in checks.items():
        one = rows.agg(F.count(F.lit(1)).alias("violations")).select(F.lit(name).alias("gate"), "violations", (F.col("violations") == 0).alias("passed"))
        out = one if out is None else out.unionByName(one)
    return out
