"""Commands: manifests, catalogues, snapshots and backtests. A backtest runs once for a code and specification (see sources.ledger).

Exit codes: 0 done, 2 bad input, 3 partial, 4 failed, 5 not verified."""

from __future__ import annotations

import argparse
import json
import sys
from pathlib import Path

from chronofold.errors import ChronofoldError
from chronofold.functions.text import redacted_text
from chronofold.operators import backtest, ingest
from chronofold.session import build
from chronofold.sources import catalog_manifest, catalog_store, journals, ledger, manifests, snapshots


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="chronofold")
    p.add_argument("--json", action="store_true", help="print JSON")
    sub = p.add_subparsers(dest="command", required=True)
    sub.add_parser("config-check")
    for name, actions in (("calendar", ("validate",)), ("catalogue", ("validate", "publish")), ("snapshot", ("validate", "build", "show", "verify")), ("backtest", ("validate", "run")), ("ingest", ("decode",))):
        group = sub.add_parser(name).add_subparsers(dest="action", required=True)
        for action in actions:
            a = group.add_parser(action)
            a.add_argument("input", help="a manifest, a response or a snapshot's code")
            if name in ("catalogue", "snapshot", "backtest") and action != "validate":
                a.add_argument("--store", required=True)
            if name == "backtest" and action == "run":
                a.add_argument("--journals", help="where the run's journals are published")
            if action in ("build", "verify"):
                a.add_argument("--bars", required=action == "build", help="a Parquet table of bar revisions")
    return p


def _run(a: argparse.Namespace) -> tuple[int, dict]:
    if a.command == "config-check":
        spark = build()
        return 0, {"spark": spark.version, "timezone": spark.conf.get("spark.sql.session.timeZone"), "ansi": spark.conf.get("spark.sql.ansi.enabled")}
    if a.command == "calendar":
        return 0, {"sessions": len(manifests.calendar(Path(a.input).read_bytes()))}
    if a.command == "catalogue":
        name, rows = catalog_manifest.parse(Path(a.input).read_bytes())
        if a.action == "validate":
            return 0, {"manifest_id": name, **{section: len(r) for section, r in rows.items()}}
        spark = build()
        return 0, catalog_store.CatalogStore(spark, _uri(a.store), catalog_manifest.TABLES, catalog_manifest.SCHEMAS).publish(name, catalog_manifest.frames(spark, rows))
    if a.command == "ingest":
        return 0, {"rows": len(ingest.decode_envelope(Path(a.input).read_bytes()))}
    if a.command == "snapshot":
        if a.action in ("validate", "build"):
            request = manifests.snapshot(Path(a.input).read_bytes())
            if a.action == "validate":
                return 0, {"snapshot_code": request.code, "specification": request.specification()}
            return 0, snapshots.SnapshotStore(a.store).build(request, build().read.parquet(a.bars))
        store = snapshots.SnapshotStore(a.store)
        if a.action == "show":
            return 0, {**store.state(a.input), "manifest": store.manifest(a.input)}
        wrong = store.verify(a.input, build().read.parquet(a.bars) if a.bars else None)
        return (5 if wrong else 0), {"problems": wrong}
    spec, code, roles = manifests.backtest_run(Path(a.input).read_bytes())
    if a.action == "validate":
        return 0, {"run_code": spec.run_code, "snapshot_code": code, "run_spec_sha256": spec.identity()}
    store, spark, parts = snapshots.SnapshotStore(a.store), build(), []
    if wrong := store.verify(code):
        return 5, {"problems": wrong}
    files = {c["component_key"]: c for c in store.manifest(code)["components"]}
    for instrument, keys in roles.items():
        for role, key in keys.items():
            c = files[key]
            df = snapshots.load(spark, str(store.folder(code) / c["file"]), c["bar_series_id"])
            parts.append(df.selectExpr(f"CAST({instrument} AS BIGINT) AS instrument_id", *backtest.BAR_COLUMNS[1:], f"'{role}' AS role"))
    bars = parts[0]
    for df in parts[1:]:
        bars = bars.unionByName(df)

    def work() -> dict:
        journal = backtest.run(bars, [spec])
        if a.journals:
            journals.publish(journal, a.journals)
            journal = spark.read.parquet(a.journals)
        rows = journal.where("journal IN ('equity', 'summary')").collect()
        out = {r["journal"]: json.loads(r["payload"]) for r in rows} | {"equity": next(r["price"] for r in rows if r["journal"] == "equity")}
        return json.loads(json.dumps(out, default=str))

    return 0, json.loads(ledger.Ledger(spark, _uri(f"{a.store}/runs")).run(spec.run_code, spec.identity(), work)["detail"])


def _uri(path: str) -> str:
    """A path as a URI; a name without a scheme is a local one."""
    return path if "://" in path else Path(path).resolve().as_uri()


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    try:
        code, out = _run(a)
    except (ChronofoldError, OSError) as e:
        code, out = (2 if isinstance(e, ValueError) else 4), {"error": redacted_text(str(e)), "code": getattr(e, "code", type(e).__name__)}
    print(json.dumps(out, default=str, sort_keys=True) if a.json else "\n".join(f"{k}: {v}" for k, v in out.items()))
    return code


if __name__ == "__main__":
    sys.exit(main())
