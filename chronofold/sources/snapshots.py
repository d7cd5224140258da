"""Immutable snapshots: one canonical JSON-lines file per component, a manifest with hashes, published by one rename.

Lines are made in parallel by Spark and come to the driver one after another, in order; nothing is held but the line at
hand, and the file is byte-exact for the same bars whatever wrote it."""

from __future__ import annotations

import hashlib
import json
import os
import shutil
from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chronofold.errors import Conflict, ContractError, NotFound
from chronofold.functions import canonical
from chronofold.functions.text import is_safe_identifier
from chronofold.operators import pit
from chronofold.sources.manifests import SnapshotRequest

STATES = ("BUILDING", "FROZEN", "FAILED")


def line_fields(bars: DataFrame) -> dict:
    """bars' columns as JSON text. Decimals and timestamps are text, of characters that need no escape."""
    bare = lambda *parts: F.concat(F.lit('"'), *parts, F.lit('"'))
    trimmed = lambda text: F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))

    def stamp(c: str):
        return bare(trimmed(F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")), F.lit("Z"))

    def decimal(c, scale: int):
        # cast() never writes an exponent for up to six places
        return bare(trimmed(c.cast("string")) if 0 < scale <= 6 else canonical.plain_column(c))

    fields = {}
    for f in bars.schema.fields:
        kind = f.dataType.typeName()
        c = F.col(f.name)
        if kind.startswith("timestamp"):
            fields[f.name] = stamp(f.name)
        elif kind == "decimal":
            fields[f.name] = decimal(c, f.dataType.scale)
        elif kind in ("string", "date"):
            fields[f.name] = canonical.quoted(c.cast("string"))
        else:
            fields[f.name] = c.cast("string")
    return fields


def lines(bars: DataFrame) -> DataFrame:
    """bars as canonical JSON lines, in the order of bar, series and revision."""
    order = ["bar_open_ts", "bar_series_id", "revision_no"]
    return bars.select(*order, canonical.json_object(line_fields(bars)).alias("line")).orderBy(*order).select("line")


class SnapshotStore:
    """Snapshots below a folder; each has a folder with state.json, manifest.json and component files."""

    def __init__(self, root: str | Path):
        self.root = Path(root)
        self.root.mkdir(parents=True, exist_ok=True)

    def folder(self, code: str) -> Path:
        if not is_safe_identifier(code):
            raise ContractError(f"{code!r} is no safe identifier")
        return self.root / code

    def state(self, code: str) -> dict:
        path = self.root / f"{code}.state.json"
        if not path.exists():
            raise NotFound(f"no snapshot {code!r}")
        return json.loads(path.read_text())

    def _set(self, code: str, **state) -> dict:
        path = self.root / f"{code}.state.json"
        part = path.with_suffix(".part")
        part.write_text(json.dumps(state, sort_keys=True))
        os.replace(part, path)
        return state

    def build(self, request: SnapshotRequest, bars: DataFrame) -> dict:
        """Build, or find built: the same code and specification give the same snapshot, another specification is a conflict."""
        target, wanted = self.folder(request.code), request.specification()
        try:
            old = self.state(request.code)
        except NotFound:
            old = None
        if old and old["specification"] != wanted:
            raise Conflict(f"{request.code} exists with another specification")
        if old and old["state"] == "FROZEN":
            return old
        self._set(request.code, state="BUILDING", specification=wanted)
        staging = self.root / f".{request.code}.staging"
        shutil.rmtree(staging, ignore_errors=True)
        staging.mkdir()
        try:
            components = []
            for number, c in enumerate(sorted(request.components, key=lambda c: c.key)):
                naive = [t.replace(tzinfo=None) for t in (c.event_from, c.event_to, request.cutoff)]
                rows = pit.eligible_revisions(bars, [c.bar_series_id], *naive, request.mode)
                stats = self._write(rows, staging / f"{number:04d}-{canonical.sha256(c.key.encode())}.jsonl")
                if not stats["row_count"] and not c.allow_empty:
                    raise ContractError(f"component {c.key} is empty")
                components.append({"component_key": c.key, "bar_series_id": c.bar_series_id, "event_from": c.event_from, "event_to": c.event_to, **stats})
            manifest = {"schema_version": 1, "snapshot_code": request.code, "cutoff": request.cutoff, "mode": request.mode, "specification": wanted, "components": components}
            (staging / "manifest.json").write_bytes(canonical.snapshot_bytes(manifest))
            os.rename(staging, target)
        except BaseException:
            shutil.rmtree(staging, ignore_errors=True)
            self._set(request.code, state="FAILED", specification=wanted)
            raise
        return self._set(request.code, state="FROZEN", specification=wanted)

    @staticmethod
    def _write(rows: DataFrame, path: Path) -> dict:
        digest, n = hashlib.sha256(), 0
        with path.open("xb") as f:
            for r in lines(rows).toLocalIterator():
                data = r["line"].encode() + b"\n"
                digest.update(data)
                f.write(data)
                n += 1
        return {"file": path.name, "row_count": n, "sha256": digest.hexdigest()}

    def manifest(self, code: str) -> dict:
        return json.loads((self.folder(code) / "manifest.json").read_text())

    def verify(self, code: str, bars: DataFrame | None = None) -> list[str]:
        """What is wrong with a snapshot's files; with bars, also where they differ from what would be frozen now."""
        wrong, folder = [], self.folder(code)
        if self.state(code)["state"] != "FROZEN":
            return ["not frozen"]
        manifest = self.manifest(code)
        files = {c["file"] for c in manifest["components"]} | {"manifest.json"}
        wrong += [f"unexpected {p.name}" for p in folder.iterdir() if p.name not in files]
        for c in manifest["components"]:
            path = folder / c["file"]
            if not path.exists():
                wrong.append(f"{c['component_key']}: missing")
                continue
            data = path.read_bytes()
            if hashlib.sha256(data).hexdigest() != c["sha256"] or data.count(b"\n") != c["row_count"]:
                wrong.append(f"{c['component_key']}: changed")
        if bars is not None and not wrong:
            for c in manifest["components"]:
                live = hashlib.sha256()
                times = [datetime.fromisoformat(t).replace(tzinfo=None) for t in (c["event_from"], c["event_to"], manifest["cutoff"])]
                rows = pit.eligible_revisions(bars, [c["bar_series_id"]], *times, manifest["mode"])
                for r in lines(rows).toLocalIterator():
                    live.update(r["line"].encode() + b"\n")
                if live.hexdigest() != c["sha256"]:
                    wrong.append(f"{c['component_key']}: drifted")
        return wrong


def load(spark: SparkSession, path: str, expected_series: int | None = None) -> DataFrame:
    """Bars of a component file: the fields that a backtest needs, prices exact, timestamps UTC. Bad rows are errors."""
    schema = "bar_open_ts string, bar_series_id bigint, revision_no bigint, available_at string, system_available_at string, effective_available_at string, close_price string"
    raw = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    times = [F.to_timestamp_ntz(F.rtrim(F.col(c), F.lit("Z")), F.lit("yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]")).alias(c) for c in ("bar_open_ts", "available_at", "system_available_at", "effective_available_at")]
    ok = (F.col("revision_no") >= 1) & F.col("close_price").rlike(r"^-?\d+(\.\d+)?$")
    if expected_series is not None:
        ok = ok & (F.col("bar_series_id") == expected_series)
    checked = raw.where(F.coalesce(ok, F.lit(False)) | F.raise_error(F.concat(F.lit("bad row of a component: "), F.to_json(F.struct("*")))).cast("boolean"))
    return checked.select(*times, "bar_series_id", "revision_no", F.col("close_price").cast("decimal(38,18)").alias("close_price"))

