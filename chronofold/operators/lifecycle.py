"""Lifecycles of runs and batches: which events of a key are taken, and what state they leave.

A key's first request creates it with the specification of that request. Moves are taken where the machine allows them
and refused elsewhere; terminal states stay. A later request is answered from the state that it finds.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

REQUEST = "REQUEST"
CREATED, REPLAYED, IN_PROGRESS, CONFLICT, TAKEN, REFUSED = "CREATED", "REPLAYED", "IN_PROGRESS", "CONFLICT", "TAKEN", "REFUSED"


@dataclass(frozen=True)
class Machine:
    """States in their order; starts: the event that leads from each state but the last working one to the next; ends: event -> terminal state."""

    states: tuple[str, ...]
    starts: tuple[str, ...]
    ends: dict[str, str]
    replayed: tuple[str, ...]
    #: Whether another specification is a conflict before a state in progress is reported.
    specification_first: bool

    def move(self, state: str, event: str) -> str | None:
        """The state after an event; None if it is refused."""
        if state == self.states[-1]:
            return self.ends.get(event)
        if state in self.states:
            at = self.states.index(state)
            return self.states[at + 1] if event == self.starts[at] else None
        return None

    def answer(self, state: str, same: bool) -> str:
        """What a request for a key in this state gets."""
        if not same and self.specification_first:
            return CONFLICT
        if state in self.states:
            return IN_PROGRESS
        return REPLAYED if same and state in self.replayed else CONFLICT


#: The states of backtest runs and of ingestion batches.
RUN = Machine(("QUEUED", "RUNNING"), ("START",), {"SUCCEED": "SUCCEEDED", "FAIL": "FAILED"}, ("SUCCEEDED",), False)
BATCH = Machine(("RUNNING",), (), {"SUCCEED": "SUCCEEDED", "PARTIAL": "PARTIAL", "QUARANTINE": "QUARANTINED", "FAIL": "FAILED"}, ("SUCCEEDED", "PARTIAL", "QUARANTINED", "FAILED"), True)


def outcomes(events: DataFrame, machine: Machine, key: str = "code", order: str = "event_no") -> DataFrame:
    """events (key, order, event, specification) with outcome (CREATED, REPLAYED, IN_PROGRESS, CONFLICT; TAKEN, REFUSED) and the state after each.

    The instants of a key's moves follow from one another: the first request, the first START behind it, the first end
    behind that. Each is a minimum over the key in the same partitioning and order, so a key of any size is streamed, not
    gathered. A move before the first request is refused and leaves no state. Null keys and orders take no part."""
    rows = events.dropna(subset=[key, order])
    whole = Window.partitionBy(key)
    at = lambda c: F.col(c)

    def first(df: DataFrame, name: str, when: Column) -> DataFrame:
        return df.withColumn(name, F.min(F.when(when, at(order))).over(whole))

    rows = first(rows, "_t0", F.col("event") == REQUEST)
    for i, start in enumerate(machine.starts):
        rows = first(rows, f"_t{i + 1}", (F.col("event") == start) & (at(order) > at(f"_t{i}")))
    last = f"_t{len(machine.starts)}"
    rows = rows.withColumn("_end", F.min(F.when(F.col("event").isin(*machine.ends) & (at(order) > at(last)), F.struct(order, "event"))).over(whole))
    rows = rows.withColumn("_spec", F.min(F.when(at(order) == at("_t0"), F.struct(F.col("specification").alias("s")))).over(whole)["s"])
    ended = F.create_map(*[F.lit(x) for pair in machine.ends.items() for x in pair])
    instants = [(f"_t{i}", state) for i, state in enumerate(machine.states)]

    def state(strictly: bool) -> Column:
        """The state before an event, or after it."""
        passed = lambda c: (c < at(order)) if strictly else (c <= at(order))
        out = F.when(passed(F.col(f"_end.{order}")), F.try_element_at(ended, F.col("_end.event")))
        for name, value in reversed(instants):
            out = out.when(passed(at(name)), value)
        return out

    before = state(True)
    same = F.col("specification").eqNullSafe(F.col("_spec"))
    busy = before.isin(*machine.states)
    asked = F.when(before.isNull(), CREATED)
    if machine.specification_first:
        asked = asked.when(~same, CONFLICT)
    asked = asked.when(busy, IN_PROGRESS).when(same & before.isin(*machine.replayed), REPLAYED).otherwise(CONFLICT)
    moves = [at(order) == at(f"_t{i + 1}") for i in range(len(machine.starts))] + [at(order) == F.col(f"_end.{order}")]
    taken = F.lit(False)
    for m in moves:
        taken = taken | F.coalesce(m, F.lit(False))
    outcome = F.when(F.col("event") == REQUEST, asked).when(taken, TAKEN).otherwise(REFUSED)
    return rows.select(*events.columns, outcome.alias("outcome"), state(False).alias("state"))
