"""Every query of the engine's own operators, with its DuckDB twin."""

from __future__ import annotations

from chronofold.plans import accounts, backtests, catalogue, catalogues, data_quality, governance, point_in_time, storage, training  # noqa: F401


def queries() -> dict:
    return dict(catalogue.QUERIES)


def oracle_sql() -> dict:
    return dict(catalogue.ORACLES)
