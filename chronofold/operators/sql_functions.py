"""The point-in-time read as a table function of SQL.

The function is defined in SQL itself, so its arguments are bound while the call is planned: the replay mode picks its
clock by constant folding, and range, cutoff and series reach the scan as filters, as with operators.pit."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from chronofold.operators import pit


def register_bars_as_of(spark: SparkSession, bars: DataFrame, name: str = "bars_as_of") -> None:
    """name(series_ids, event_from, event_to, cutoff, mode) over bars: of each bar the newest revision that was knowable.

    series_ids: an array, or NULL for all. Arguments that may not be null, an empty range and an unknown mode are errors, as
    in pit.bars_as_of. Temporary: it lives as long as the session."""
    if not re.fullmatch(r"[A-Za-z_][A-Za-z0-9_]*", name):
        raise ValueError(f"{name!r} is no name of a function")
    bars.createOrReplaceTempView(f"{name}_rows")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in bars.schema.fields)
    chosen = ", ".join(f"`{c}`" for c in bars.columns)
    modes = list(pit.CLOCK.items())
    known = ", ".join(f"'{m}'" for m, _ in modes)
    fine = f"coalesce(event_from < event_to AND event_to <= cutoff AND mode IN ({known}), false)"
    error = "raise_error('a bound is null, the range is empty or the mode is unknown')"
    # a bad argument makes every bound an error, as a condition that is known to be false would let the plan drop the rest
    since, until, cutoff = (f"if({fine}, {b}, CAST({error} AS TIMESTAMP_NTZ))" for b in ("event_from", "event_to", "cutoff"))
    clock = "CASE mode " + " ".join(f"WHEN '{m}' THEN {c}" for m, c in modes) + f" ELSE CAST({error} AS TIMESTAMP_NTZ) END"
    order = ", ".join(f"{c} DESC" for c in ("_clock", "revision_no", "system_available_at"))
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION {name}(series_ids ARRAY<BIGINT>, event_from TIMESTAMP_NTZ, event_to TIMESTAMP_NTZ, cutoff TIMESTAMP_NTZ, mode STRING)
        RETURNS TABLE ({columns})
        RETURN SELECT {chosen} FROM (
            SELECT *, row_number() OVER (PARTITION BY bar_series_id, bar_open_ts ORDER BY {order}) AS _rank
            FROM (SELECT *, {clock} AS _clock FROM {name}_rows WHERE is_final AND bar_open_ts >= {since} AND bar_open_ts < {until} AND bar_close_ts <= {cutoff} AND {clock} <= {cutoff}
                AND (series_ids IS NULL OR array_contains(series_ids, bar_series_id)))
        ) WHERE _rank = 1
    """)
