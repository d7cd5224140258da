"""Row constraints of a table, declared, and compiled to one column that holds all that a row breaks.

As a CHECK does, a rule rejects a row only where it is false: a null operand breaks nothing, unless the rule is about
nulls. All rules of a table are judged in one scan, in generated code, without a join or a shuffle; violations() keeps the rows
that break one, summary() counts them by rule.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """name: what a violation is called; columns: what it reads; holds: true, false or null for a row."""

    name: str
    columns: tuple[str, ...]
    holds: Column


def _cols(names: Sequence[str]) -> list[Column]:
    return [F.col(n) for n in names]


def one_of(column: str, *values: str) -> Rule:
    return Rule(f"{column}_ONE_OF", (column,), F.col(column).isin(*values))


def not_null(*columns: str) -> Rule:
    return Rule("_".join(columns) + "_NOT_NULL", columns, _every([c.isNotNull() for c in _cols(columns)]))


def above(column: str, least=0) -> Rule:
    return Rule(f"{column}_ABOVE", (column,), F.col(column) > F.lit(least))


def at_least(column: str, least=0) -> Rule:
    return Rule(f"{column}_AT_LEAST", (column,), F.col(column) >= F.lit(least))


def between(column: str, low, high) -> Rule:
    return Rule(f"{column}_BETWEEN", (column,), F.col(column).between(F.lit(low), F.lit(high)))


def not_zero(column: str) -> Rule:
    return Rule(f"{column}_NOT_ZERO", (column,), F.col(column) != 0)


def ordered(first: str, then: str, strictly: bool = True) -> Rule:
    """An interval's ends; an open end is no violation."""
    a, b = _cols((first, then))
    return Rule(f"{then}_AFTER_{first}", (first, then), a < b if strictly else a <= b)


def differ(a: str, b: str) -> Rule:
    return Rule(f"{a}_DIFFERS_{b}", (a, b), F.col(a) != F.col(b))


def inside(value: str, low: str, high: str) -> Rule:
    """A value between two others of the row."""
    return Rule(f"{value}_INSIDE", (value, low, high), F.col(value).between(F.col(low), F.col(high)))


def total_within(parts: Sequence[str], whole: str) -> Rule:
    sum_ = sum(_cols(parts[1:]), F.col(parts[0]))
    return Rule(f"{'_'.join(parts)}_WITHIN_{whole}", (*parts, whole), sum_ <= F.col(whole))


def equal_total(parts: Sequence[str], whole: str) -> Rule:
    sum_ = sum(_cols(parts[1:]), F.col(parts[0]))
    return Rule(f"{'_'.join(parts)}_EQUALS_{whole}", (*parts, whole), sum_ == F.col(whole))


def required_when(kind: str, values: Sequence[str], needed: Sequence[str]) -> Rule:
    """Rows of some kinds need columns that others may lack."""
    return Rule(f"{'_'.join(needed)}_REQUIRED", (kind, *needed), ~F.col(kind).isin(*values) | _every([c.isNotNull() for c in _cols(needed)]))


def absent_when(kind: str, values: Sequence[str], columns: Sequence[str]) -> Rule:
    return Rule(f"{'_'.join(columns)}_ABSENT", (kind, *columns), ~F.col(kind).isin(*values) | _every([c.isNull() for c in _cols(columns)]))


def typed_by(kind: str, columns: dict[str, Sequence[str]]) -> Rule:
    """Each kind has its own columns: those are given, and those of the other kinds only are null; an unknown kind breaks the rule."""
    every = list(dict.fromkeys(c for own in columns.values() for c in own))
    cases = [(F.col(kind) == F.lit(k)) & _every([F.col(c).isNotNull() if c in own else F.col(c).isNull() for c in every]) for k, own in columns.items()]
    out = F.lit(False)
    for c in cases:
        out = out | c
    return Rule(f"{kind}_TYPED", (kind, *every), F.when(F.col(kind).isNotNull(), out))


def given(columns: Sequence[str], least: int, most: int) -> Rule:
    """How many of some columns are not null."""
    n = sum((c.isNotNull().cast("int") for c in _cols(columns)), F.lit(0))
    return Rule(f"{'_'.join(columns)}_GIVEN", tuple(columns), n.between(least, most))


def together(*columns: str) -> Rule:
    """All null or all given."""
    n = sum((c.isNotNull().cast("int") for c in _cols(columns)), F.lit(0))
    return Rule(f"{'_'.join(columns)}_TOGETHER", columns, n.isin(0, len(columns)))


def length_is(array: str, expected: str) -> Rule:
    return Rule(f"{array}_LENGTH", (array, expected), F.when(F.col(array).isNotNull(), F.size(array) == F.col(expected)))


def matches(column: str, pattern: str) -> Rule:
    return Rule(f"{column}_FORMAT", (column,), F.col(column).rlike(pattern))


def sha256(column: str) -> Rule:
    return matches(column, "^[0-9a-f]{64}$")


def named(name: str, rule: Rule) -> Rule:
    return Rule(name, rule.columns, rule.holds)


def _every(conditions: list[Column]) -> Column:
    out = F.lit(True)
    for c in conditions:
        out = out & c
    return out


def broken(rules: Sequence[Rule]) -> Column:
    """The names of the rules that a row breaks, in their order."""
    if len({r.name for r in rules}) != len(rules):
        raise ValueError("two rules have one name")
    return F.array_compact(F.array(*[F.when(~r.holds, F.lit(r.name)) for r in rules])) if rules else F.array().cast("array<string>")


def violations(rows: DataFrame, rules: Sequence[Rule], into: str = "broken") -> DataFrame:
    """The rows that break a rule, with the rules' names."""
    return rows.select("*", broken(rules).alias(into)).where(F.size(into) > 0)


def summary(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """rule, violations: all rules of the table, from one scan."""
    broken(rules)
    counts = rows.agg(*[F.count_if(~r.holds).alias(f"c{i}") for i, r in enumerate(rules)])
    return counts.select(F.inline(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"c{i}").alias("violations")) for i, r in enumerate(rules)])))


#: The rules of some of the engine's tables; columns as in their schemas.
TABLES = {
    "timeframe": lambda: [one_of("calendar_unit", "FIXED", "SESSION", "DAY", "WEEK", "MONTH"), above("duration_seconds"), required_when("calendar_unit", ["FIXED"], ["duration_seconds"])],
    "instrument_identifier": lambda: [ordered("valid_from", "valid_to")],
    "instrument_spec_version": lambda: [ordered("effective_from", "effective_to"), above("price_tick"), above("quantity_step"), above("lot_size"), above("contract_multiplier"), ordered("lower_price_limit", "upper_price_limit", strictly=False)],
    "derivative_contract": lambda: [one_of("contract_type", "FUTURE", "OPTION", "SWAP", "FORWARD", "CFD"), one_of("option_side", "CALL", "PUT"), above("contract_size"), one_of("settlement_type", "CASH", "PHYSICAL"), required_when("contract_type", ["OPTION"], ["option_side", "strike_price"])],
    "data_snapshot": lambda: [one_of("availability_mode", "PUBLIC_REPLAY", "ACTUAL_SYSTEM_REPLAY"), one_of("status", "BUILDING", "FROZEN", "FAILED", "DEPRECATED"), required_when("status", ["FROZEN"], ["frozen_at", "manifest_sha256"])],
    "ingestion_batch": lambda: [one_of("status", "RUNNING", "SUCCEEDED", "PARTIAL", "FAILED", "QUARANTINED"), at_least("received_row_count"), at_least("accepted_row_count"), at_least("rejected_row_count"), ordered("requested_event_from", "requested_event_to"), ordered("started_at", "finished_at", strictly=False), total_within(["accepted_row_count", "rejected_row_count"], "received_row_count")],
    "bar_revision": lambda: [above("revision_no"), ordered("bar_open_ts", "bar_close_ts"), ordered("available_at", "system_available_at", strictly=False), ordered("low_price", "high_price", strictly=False), inside("open_price", "low_price", "high_price"), inside("close_price", "low_price", "high_price"), at_least("volume")],
    "adjustment_factor": lambda: [above("price_multiplier"), above("volume_multiplier")],
}
