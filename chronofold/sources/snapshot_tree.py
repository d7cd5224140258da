"""Immutable snapshots built, verified and compared in tasks: no row and no file of one reaches the driver.

A component is a folder of canonical JSON lines, written by as many tasks as its range partitions. Its hash is the root of a
tree whose leaves do not depend on files: a leaf is a day's lines in their order, above it stand months and the component.
What a snapshot holds becomes true by one small file, the ledger's FREEZE entry, which carries the manifest; until then
readers see nothing of it, and a writer that dies leaves only a folder that no entry names.
"""

from __future__ import annotations

import json
import uuid
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.errors import Conflict, ContractError, NotFound
from chronofold.functions import canonical
from chronofold.operators import pit
from chronofold.operators.lifecycle import CREATED, Machine
from chronofold.sources import places, snapshots
from chronofold.sources.ledger import Ledger
from chronofold.sources.manifests import SnapshotRequest

#: The states of snapshots.
MACHINE = Machine(("BUILDING",), (), {"FREEZE": "FROZEN", "FAIL": "FAILED"}, ("FROZEN",), True)
ORDER = ["component_key", "bar_open_ts", "bar_series_id", "revision_no"]


def leaves(lines: DataFrame) -> DataFrame:
    """component_key, day, rows and sha256 of each day's lines (component_key, bar_open_ts, bar_series_id, revision_no, line).

    A day of one component is what a group holds: its revisions of one series."""
    one = F.struct("bar_open_ts", "bar_series_id", "revision_no", "line")
    days = lines.groupBy("component_key", F.substring("bar_open_ts", 1, 10).alias("day")).agg(F.array_sort(F.collect_list(one)).alias("l"), F.count(F.lit(1)).alias("rows"))
    return days.select("component_key", "day", "rows", F.sha2(F.concat(F.array_join("l.line", "\n"), F.lit("\n")), 256).alias("sha256"))


def roots(leaf: DataFrame) -> DataFrame:
    """component_key, row_count and sha256 of each component: of its months' hashes, each of its days' hashes."""
    named = lambda c: F.concat(F.col(c), F.lit(" "), F.col("sha256"))
    month = leaf.groupBy("component_key", F.substring("day", 1, 7).alias("month")).agg(F.sum("rows").alias("rows"), F.array_sort(F.collect_list(named("day"))).alias("l"))
    month = month.select("component_key", "month", "rows", F.sha2(F.array_join("l", "\n"), 256).alias("sha256"))
    root = month.groupBy("component_key").agg(F.sum("rows").alias("row_count"), F.array_sort(F.collect_list(named("month"))).alias("l"))
    return root.select("component_key", "row_count", F.sha2(F.array_join("l", "\n"), 256).alias("sha256"))


def _stamped(bars: DataFrame) -> DataFrame:
    """bars as lines, with what they are ordered by as text and numbers."""
    own = [c for c in bars.columns if c != "component_key"]
    lined = bars.select("component_key", F.date_format("bar_open_ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("bar_open_ts"), "bar_series_id", "revision_no", canonical.json_object(snapshots.line_fields(bars.select(*own))).alias("line"))
    return lined


def table_hash(rows: DataFrame) -> str:
    """One hash of a table's rows (as JSON), in no order: of 4096 groups' hashes, each of its rows' sorted hashes."""
    row = rows.select(F.sha2(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}), 256).alias("h"))
    groups = row.groupBy(F.substring("h", 1, 3).alias("g")).agg(F.array_join(F.array_sort(F.collect_list("h")), ",").alias("l")).select("g", F.sha2("l", 256).alias("h"))
    return groups.agg(F.sha2(F.array_join(F.array_sort(F.collect_list(F.concat("g", "h"))), ","), 256).alias("h")).first().h


class SnapshotTree:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, str(root).rstrip("/")
        self.ledger = Ledger(spark, f"{self.root}/ledger", MACHINE)

    def requested(self, request: SnapshotRequest) -> DataFrame:
        """A request's components as a table."""
        rows = [(c.key, c.bar_series_id, c.event_from.replace(tzinfo=None), c.event_to.replace(tzinfo=None), c.allow_empty) for c in request.components]
        return self.spark.createDataFrame(rows, "component_key string, bar_series_id bigint, event_from timestamp_ntz, event_to timestamp_ntz, allow_empty boolean")

    @staticmethod
    def _eligible(components: DataFrame, bars: DataFrame, cutoff: datetime, mode: str) -> DataFrame:
        """Bars of all components, from one read: every revision that was knowable at the cutoff."""
        known = pit.knowable(bars, mode, pit.at(cutoff)).withColumn("effective_available_at", F.col(pit.clock(mode)))
        c = components.select("component_key", F.col("bar_series_id").alias("_series"), "event_from", "event_to")
        inside = (F.col("bar_series_id") == F.col("_series")) & (F.col("bar_open_ts") >= F.col("event_from")) & (F.col("bar_open_ts") < F.col("event_to"))
        return known.join(c, inside).select("component_key", *known.columns)

    def build(self, code: str, components: DataFrame, bars: DataFrame, cutoff: datetime, mode: str) -> dict:
        """What is frozen under the code: made now, or before with the same specification; another one, or a build that goes on, is a conflict.

        components: component_key (unique), bar_series_id, event_from, event_to, allow_empty. They are frozen as a table beside the
        lines, with rows and hash of each."""
        own = components.select("component_key", "bar_series_id", "event_from", "event_to", "allow_empty")
        outcome, entry = self.ledger.request(code, f"{mode} {cutoff.isoformat()} {table_hash(own)}")
        if outcome == "REPLAYED":
            return json.loads(entry["detail"])
        if outcome != CREATED:
            raise Conflict(f"{code} is {entry['state']}")
        folder = f"{self.root}/data/{uuid.uuid4().hex}"
        try:
            # dealt before they become lines: what finds the ranges reads all rows once more, and lines are the greater part of the work
            dealt = self._eligible(own, bars, cutoff, mode).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)
            _stamped(dealt).write.parquet(f"{folder}/lines")
            summed = roots(leaves(self._lines(folder)))
            own.join(summed, "component_key", "left").withColumn("row_count", F.coalesce("row_count", F.lit(0))).write.parquet(f"{folder}/components")
            frozen = self._components(folder)
            empty = frozen.where("row_count = 0 AND NOT allow_empty").first()
            if empty is not None:
                raise ContractError(f"component {empty.component_key} is empty")
            n, rows = frozen.agg(F.count(F.lit(1)), F.sum("row_count")).first()
            manifest = {"folder": folder, "cutoff": cutoff.isoformat(), "mode": mode, "components": n, "row_count": rows, "sha256": table_hash(frozen)}
            self.ledger.move(code, "FREEZE", **manifest)
            return manifest
        except BaseException as error:
            places.delete(self.spark, folder)
            if self.ledger.state(code)["state"] == "BUILDING":
                self.ledger.move(code, "FAIL", error=type(error).__name__)
            raise

    def _lines(self, folder: str) -> DataFrame:
        return self.spark.read.schema("component_key string, bar_open_ts string, bar_series_id bigint, revision_no bigint, line string").parquet(f"{folder}/lines")

    def _components(self, folder: str) -> DataFrame:
        return self.spark.read.schema("component_key string, bar_series_id bigint, event_from timestamp_ntz, event_to timestamp_ntz, allow_empty boolean, row_count bigint, sha256 string").parquet(f"{folder}/components")

    def manifest(self, code: str) -> dict:
        entry = self.ledger.state(code)
        if entry["state"] != "FROZEN":
            raise NotFound(f"{code} is {entry['state']}")
        return json.loads(entry["detail"])

    def components(self, code: str) -> DataFrame:
        return self._components(self.manifest(code)["folder"])

    def lines(self, code: str) -> DataFrame:
        return self._lines(self.manifest(code)["folder"])

    def verify(self, code: str) -> DataFrame:
        """component_key and problem (CHANGED, MISSING, UNEXPECTED; MANIFEST with a null key) of what is not as it was frozen; empty if all is well."""
        m = self.manifest(code)
        held = self._components(m["folder"]).select("component_key", "row_count", "sha256")
        found = roots(leaves(self._lines(m["folder"]))).select("component_key", F.col("row_count").alias("_rows"), F.col("sha256").alias("_sha"))
        both = held.join(found, "component_key", "full_outer")
        problem = (
            F.when(F.col("row_count").isNull(), "UNEXPECTED").when((F.col("row_count") > 0) & F.col("_rows").isNull(), "MISSING")
            .when((F.col("row_count") > 0) & ((F.col("row_count") != F.col("_rows")) | (F.col("sha256") != F.col("_sha"))), "CHANGED")
        )
        wrong = both.select("component_key", problem.alias("problem")).where("problem IS NOT NULL")
        if table_hash(self._components(m["folder"])) != m["sha256"]:
            wrong = wrong.unionByName(self.spark.createDataFrame([(None, "MANIFEST")], "component_key string, problem string"))
        return wrong

    def drift(self, code: str, bars: DataFrame) -> DataFrame:
        """component_key, day and change (ADDED, GONE, CHANGED) of the days on which bars would give other lines now."""
        m = self.manifest(code)
        live = _stamped(self._eligible(self._components(m["folder"]), bars, datetime.fromisoformat(m["cutoff"]), m["mode"]))
        now = leaves(live).select("component_key", "day", F.col("sha256").alias("now"))
        held = leaves(self._lines(m["folder"])).select("component_key", "day", F.col("sha256").alias("held"))
        change = F.when(F.col("held").isNull(), "ADDED").when(F.col("now").isNull(), "GONE").when(F.col("held") != F.col("now"), "CHANGED")
        return held.join(now, ["component_key", "day"], "full_outer").select("component_key", "day", change.alias("change")).where("change IS NOT NULL")
