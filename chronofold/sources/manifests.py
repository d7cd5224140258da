"""Manifests: small, strict JSON documents of the control plane, read on the driver."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from decimal import Decimal, InvalidOperation
from zoneinfo import ZoneInfo

from chronofold.errors import ContractError
from chronofold.functions.canonical import sha256, snapshot_bytes
from chronofold.functions.text import is_safe_identifier
from chronofold.operators import backtest, pit
from chronofold.operators.ingest import strict_json


def document(body: bytes, required: set[str], optional: set[str] = frozenset()) -> dict:
    """The object of a manifest: version 1, all required fields, no unknown ones."""
    got = strict_json(body)
    if not isinstance(got, dict):
        raise ContractError("a manifest is an object")
    if type(got.get("schema_version")) is not int or got["schema_version"] != 1:
        raise ContractError("schema_version must be 1")
    fields_of(got, required | {"schema_version"}, optional)
    return got


def fields_of(got: dict, required: set[str], optional: set[str] = frozenset()) -> dict:
    if not isinstance(got, dict):
        raise ContractError("not an object")
    if missing := required - set(got):
        raise ContractError(f"missing {sorted(missing)}")
    if unknown := set(got) - required - set(optional):
        raise ContractError(f"unknown {sorted(unknown)}")
    return got


def instant(text: object) -> datetime:
    if not isinstance(text, str):
        raise ContractError("a timestamp is text")
    try:
        value = datetime.fromisoformat(text)
    except ValueError as e:
        raise ContractError(f"{text!r} is no timestamp") from e
    if value.tzinfo is None:
        raise ContractError(f"{text!r} has no zone")
    return value.astimezone(timezone.utc)


def decimal(text: object) -> Decimal:
    if not isinstance(text, str):
        raise ContractError("a decimal is text")
    try:
        value = Decimal(text)
    except InvalidOperation as e:
        raise ContractError(f"{text!r} is no decimal") from e
    if not value.is_finite():
        raise ContractError(f"{text!r} is not finite")
    return value


def identifier(value: object) -> str:
    if not isinstance(value, str) or not is_safe_identifier(value):
        raise ContractError(f"{value!r} is no safe identifier")
    return value


@dataclass(frozen=True)
class Component:
    key: str
    bar_series_id: int
    event_from: datetime
    event_to: datetime
    allow_empty: bool = False


@dataclass(frozen=True)
class SnapshotRequest:
    code: str
    cutoff: datetime
    mode: str
    components: tuple[Component, ...]

    def specification(self) -> str:
        """A hash of what is asked for; the code is not part of it."""
        parts = [[c.key, c.bar_series_id, c.event_from, c.event_to, c.allow_empty] for c in sorted(self.components, key=lambda c: c.key)]
        return sha256(snapshot_bytes({"cutoff": self.cutoff, "mode": self.mode, "components": parts}))


def snapshot(body: bytes) -> SnapshotRequest:
    got = document(body, {"snapshot_code", "knowledge_cutoff_ts", "availability_mode", "components"})
    if got["availability_mode"] not in pit.CLOCK:
        raise ContractError("unknown availability_mode")
    cutoff, components = instant(got["knowledge_cutoff_ts"]), []
    for c in got["components"]:
        fields_of(c, {"component_key", "kind", "bar_series_id", "event_from", "event_to"}, {"allow_empty"})
        if c["kind"] != "BAR_REVISION" or type(c["bar_series_id"]) is not int or type(c.get("allow_empty", False)) is not bool:
            raise ContractError("bad component")
        start, stop = instant(c["event_from"]), instant(c["event_to"])
        if not start < stop <= cutoff:
            raise ContractError("bad event range")
        components.append(Component(identifier(c["component_key"]), c["bar_series_id"], start, stop, c.get("allow_empty", False)))
    if not components or len({c.key for c in components}) != len(components):
        raise ContractError("components must exist and differ")
    return SnapshotRequest(identifier(got["snapshot_code"]), cutoff, got["availability_mode"], tuple(components))


def backtest_run(body: bytes) -> tuple[backtest.Spec, str, dict[int, dict[str, str]]]:
    """(run, snapshot code, for each instrument the component of each role)."""
    got = document(body, {"run_code", "snapshot_code", "universe_code", "base_currency_code", "event_from", "event_to", "initial_capital", "random_seed", "strategy", "execution_model", "transaction_cost_model", "instruments"})
    s, costs = fields_of(got["strategy"], {"kind", "parameters"}), fields_of(got["transaction_cost_model"], {"commission_bps", "slippage_bps", "sell_tax_bps"})
    p = fields_of(s["parameters"], {"fast_window", "slow_window", "target_quantity"})
    if s["kind"] != "SMA_CROSS_LONG_FLAT_V1" or fields_of(got["execution_model"], {"kind"})["kind"] != "NEXT_BAR_CLOSE_AT_AVAILABILITY_V1":
        raise ContractError("unknown strategy or execution model")
    if type(p["fast_window"]) is not int or type(p["slow_window"]) is not int:
        raise ContractError("windows are whole numbers")
    instruments, roles = [], {}
    for i in got["instruments"]:
        fields_of(i, {"instrument_id", "signal_component_key", "execution_component_key", "valuation_component_key", "execution_lag_seconds"})
        if type(i["execution_lag_seconds"]) is not int or i["execution_lag_seconds"] < 0 or i["instrument_id"] in roles:
            raise ContractError("bad instrument")
        instruments.append(backtest.Instrument(i["instrument_id"], timedelta(seconds=i["execution_lag_seconds"])))
        roles[i["instrument_id"]] = {r: identifier(i[f"{r.lower()}_component_key"]) for r in ("SIGNAL", "EXECUTION", "VALUATION")}
    bps = backtest.Costs(*(decimal(costs[k]) for k in ("commission_bps", "slippage_bps", "sell_tax_bps")))
    spec = backtest.Spec(identifier(got["run_code"]), instant(got["event_from"]), instant(got["event_to"]), decimal(got["initial_capital"]), p["fast_window"], p["slow_window"], decimal(p["target_quantity"]), bps, tuple(instruments))
    return spec, identifier(got["snapshot_code"]), roles


def local_to_utc(day: date, wall: time, zone: str, fold: int | None = None) -> datetime:
    """A wall time as UTC. A time that the zone skips is an error, and one that it has twice needs a fold."""
    z = ZoneInfo(zone)
    both = [datetime.combine(day, wall, z).replace(fold=f).astimezone(timezone.utc) for f in (0, 1)]
    real = [u for u in both if u.astimezone(z).replace(tzinfo=None) == datetime.combine(day, wall)]
    if not real:
        raise ContractError(f"{day} {wall} does not exist in {zone}")
    if len(set(real)) > 1:
        if fold not in (0, 1):
            raise ContractError(f"{day} {wall} is ambiguous in {zone}")
        return both[fold]
    return real[0]


def calendar(body: bytes) -> list[dict]:
    """Sessions of every date from date_from to date_to, none twice, with their opening and close in UTC."""
    got = document(body, {"calendar_id", "venue_code", "timezone", "date_from", "date_to", "sessions"})
    try:
        first, last = date.fromisoformat(got["date_from"]), date.fromisoformat(got["date_to"])
    except (TypeError, ValueError) as e:
        raise ContractError("bad date range") from e
    out = []
    for s in got["sessions"]:
        fields_of(s, {"trading_date", "session_code", "is_trading_day", "open_local_time", "close_local_time", "source_status"}, {"settlement_date", "open_fold", "close_fold", "metadata"})
        day = date.fromisoformat(s["trading_date"])
        row = {"venue_code": got["venue_code"], "trading_date": day, "session_code": s["session_code"], "is_trading_day": s["is_trading_day"], "session_open_ts": None, "session_close_ts": None}
        if s["is_trading_day"]:
            row["session_open_ts"] = local_to_utc(day, time.fromisoformat(s["open_local_time"]), got["timezone"], s.get("open_fold"))
            row["session_close_ts"] = local_to_utc(day, time.fromisoformat(s["close_local_time"]), got["timezone"], s.get("close_fold"))
            if row["session_open_ts"] >= row["session_close_ts"]:
                raise ContractError(f"{day} closes before it opens")
        out.append(row)
    days = [r["trading_date"] for r in out]
    wanted = {first + timedelta(k) for k in range((last - first).days + 1)}
    if len(set(days)) != len(days) or set(days) != wanted:
        raise ContractError("dates are missing, repeated or out of range")
    return out
