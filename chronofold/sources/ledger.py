"""A ledger of lifecycles: each key a folder of numbered, immutable entries, the highest of which is its state.

A writer reads the entries, decides, and creates the next number; of several writers one can create it, and the others
read again and decide anew. So two workers cannot both create or start the same run, whatever machine they are on. Entries are
small JSON files; all() reads every key's as one DataFrame.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession

from chronofold.errors import Conflict, NotFound
from chronofold.functions.text import redacted_text
from chronofold.operators.lifecycle import CREATED, REQUEST, RUN, Machine
from chronofold.sources import places

SCHEMA = "key string, number int, event string, state string, specification string, at string, detail string"
#: Characters of an error that are kept, after redaction.
ERROR_CHARS = 512


class Ledger:
    def __init__(self, spark: SparkSession, root: str, machine: Machine = RUN, clock: Callable[[], datetime] = lambda: datetime.now(timezone.utc)):
        self.spark, self.root, self.machine, self.clock = spark, str(root).rstrip("/"), machine, clock

    def _folder(self, key: str) -> str:
        return f"{self.root}/{hashlib.sha256(key.encode()).hexdigest()}"

    def entries(self, key: str) -> list[dict]:
        folder = self._folder(key)
        return [json.loads(places.read(self.spark, f"{folder}/{name}")) for name in places.names(self.spark, folder)]

    def state(self, key: str) -> dict:
        """The newest entry of a key."""
        found = self.entries(key)
        if not found:
            raise NotFound(f"no entry of {key!r}")
        return found[-1]

    def _append(self, key: str, number: int, event: str, state: str, specification: str, detail: dict) -> dict | None:
        entry = {"key": key, "number": number, "event": event, "state": state, "specification": specification, "at": self.clock().isoformat(), "detail": json.dumps(detail, sort_keys=True)}
        done = places.create(self.spark, f"{self._folder(key)}/{number:08d}.json", json.dumps(entry, sort_keys=True).encode())
        return entry if done else None

    def request(self, key: str, specification: str, **detail) -> tuple[str, dict]:
        """(outcome, newest entry): CREATED, REPLAYED (finished, with the same specification) or IN_PROGRESS; a conflict raises."""
        while True:
            found = self.entries(key)
            if not found:
                made = self._append(key, 1, REQUEST, self.machine.states[0], specification, detail)
                if made:
                    return CREATED, made
                continue
            last = found[-1]
            outcome = self.machine.answer(last["state"], specification == found[0]["specification"])
            if outcome == "CONFLICT":
                raise Conflict(f"{key!r} is {last['state']} and cannot be used for this request")
            return outcome, last

    def move(self, key: str, event: str, **detail) -> dict:
        """The new entry; a move that the state does not allow, or no longer allows, raises a conflict."""
        while True:
            found = self.entries(key)
            if not found:
                raise NotFound(f"no entry of {key!r}")
            last = found[-1]
            state = self.machine.move(last["state"], event)
            if state is None:
                raise Conflict(f"{key!r} is {last['state']}: {event} is refused")
            made = self._append(key, last["number"] + 1, event, state, last["specification"], detail)
            if made:
                return made

    def run(self, key: str, specification: str, work: Callable[[], dict]) -> dict:
        """Do work once for a key: its newest entry, from before if it had succeeded with this specification.

        work returns details of its result. Where it fails the entry says why, without secrets, and the error is raised."""
        outcome, entry = self.request(key, specification)
        if outcome == "REPLAYED":
            return entry
        if outcome != CREATED:
            raise Conflict(f"{key!r} is already {entry['state']}")
        for start in self.machine.starts:
            self.move(key, start)
        try:
            detail = work()
        except BaseException as error:
            self.move(key, "FAIL", error=redacted_text(f"{type(error).__name__}: {error}", ERROR_CHARS))
            raise
        return self.move(key, "SUCCEED", **detail)

    def all(self) -> DataFrame:
        """Every entry of every key."""
        if not places.names(self.spark, self.root):
            return self.spark.createDataFrame([], SCHEMA)
        return self.spark.read.schema(SCHEMA).option("mode", "FAILFAST").json(f"{self.root}/*/*.json")
