"""Tables of a catalogue that are published together or not at all.

A version is one small file that names, for each table, the folders of rows that it adds; readers take all versions up to
the newest that they see. A publish writes its rows first and then creates the next version; if another writer was faster it
judges its candidates again, against what that one left. Requests are kept in a ledger: one that is run again gives the
recorded counts and adds nothing, another content under the same number is a conflict.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.errors import Conflict
from chronofold.operators import merge
from chronofold.operators.lifecycle import BATCH, CREATED
from chronofold.sources import places
from chronofold.sources.ledger import Ledger
from chronofold.sources.snapshot_tree import table_hash


class CatalogStore:
    def __init__(self, spark: SparkSession, root: str, tables: Sequence[merge.Table], schemas: dict[str, str]):
        """tables: in the order of their dependencies; schemas: name -> DDL of its columns."""
        self.spark, self.root, self.tables, self.schemas = spark, str(root).rstrip("/"), list(tables), schemas
        self.ledger = Ledger(spark, f"{self.root}/requests", BATCH)

    def versions(self) -> list[dict]:
        return [json.loads(places.read(self.spark, f"{self.root}/versions/{n}")) for n in places.names(self.spark, f"{self.root}/versions")]

    def read(self, name: str, version: int | None = None) -> DataFrame:
        """A table as of a version, the newest if none is named."""
        folders = [v["folders"][name] for v in self.versions()[:version] if name in v["folders"]]
        empty = self.spark.createDataFrame([], self.schemas[name])
        return self.spark.read.schema(empty.schema).parquet(*folders) if folders else empty

    def publish(self, request_id: str, candidates: dict[str, DataFrame]) -> dict[str, int]:
        """Counts by "table outcome". Where a row is refused nothing is published, the request is FAILED and a conflict is raised."""
        content = " ".join(f"{n}={table_hash(candidates[n])}" for n in sorted(candidates))
        outcome, entry = self.ledger.request(request_id, content)
        if outcome == "REPLAYED":
            detail = json.loads(entry["detail"])
            if entry["state"] == "FAILED":
                raise Conflict(f"{request_id} has failed: {detail}")
            return detail
        if outcome != CREATED:
            raise Conflict(f"{request_id} is {entry['state']}")
        try:
            return self.ledger.move(request_id, "SUCCEED", **(counts := self._attempts(candidates))) and counts
        except BaseException as error:
            if self.ledger.state(request_id)["state"] == "RUNNING":
                self.ledger.move(request_id, "FAIL", error=str(error)[:512])
            raise

    def _attempts(self, candidates: dict[str, DataFrame]) -> dict[str, int]:
        while True:
            base = len(self.versions())
            judged, fresh = merge.merged(self.tables, {t.name: self.read(t.name, base) for t in self.tables}, candidates)
            counts = {f"{r.table_name} {r.outcome}": r.n for r in judged.groupBy("table_name", "outcome").agg(F.count(F.lit(1)).alias("n")).collect()}
            refused = {k: n for k, n in counts.items() if k.split(" ")[1] in merge.REFUSED}
            if refused:
                raise Conflict(f"nothing is published: {refused}")
            folders = {}
            for name, rows in fresh.items():
                if counts.get(f"{name} {merge.INSERTED}"):
                    folders[name] = f"{self.root}/rows/{name}-{uuid.uuid4().hex}"
                    rows.write.parquet(folders[name])
            if not folders or places.create(self.spark, f"{self.root}/versions/{base + 1:08d}.json", json.dumps({"folders": folders}).encode()):
                return counts
            for folder in folders.values():
                places.delete(self.spark, folder)
