"""Merges of several tables, the catalogue store, and the point-in-time read as a function of SQL."""

import json
import threading
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofold.errors import Conflict
from chronofold.operators import merge, pit, sql_functions
from chronofold.sources.catalog_store import CatalogStore

TABLES = [merge.Table("venue", ("code",), ("zone",)), merge.Table("series", ("id",), ("venue", "unit"), {"venue": "venue"})]
SCHEMAS = {"venue": "code string, zone string", "series": "id long, venue string, unit string"}


def frames(spark, venue=(), series=()):
    return {"venue": spark.createDataFrame(list(venue), SCHEMAS["venue"]), "series": spark.createDataFrame(list(series), SCHEMAS["series"])}


def test_outcomes_of_a_merge(spark):
    there = frames(spark, [("A", "UTC"), ("B", None)], [(1, "A", "d")])
    new = frames(spark, [("A", "UTC"), ("B", "x"), ("C", "z"), ("C", "z"), ("D", "1"), ("D", None), (None, "q")], [(1, "A", "d"), (2, "C", None), (3, "D", "d"), (4, None, "d"), (5, "Z", "d"), (1, "A", "d")])
    judged, fresh = merge.merged(TABLES, there, new)
    got = {(r.table_name, *json.loads(r.key).values()) if json.loads(r.key) else (r.table_name, None): (r.rows, r.outcome) for r in judged.collect()}
    assert got == {
        ("venue", "A"): (1, "UNCHANGED"), ("venue", "B"): (1, "CONFLICT"), ("venue", "C"): (2, "INSERTED"), ("venue", "D"): (2, "DUPLICATE_CONFLICT"), ("venue", None): (1, "NULL_KEY"),
        ("series", 1): (2, "UNCHANGED"), ("series", 2): (1, "INSERTED"), ("series", 3): (1, "MISSING_PARENT"), ("series", 4): (1, "INSERTED"), ("series", 5): (1, "MISSING_PARENT"),
    }
    assert sorted(r.id for r in fresh["series"].collect()) == [2, 4] and [tuple(r) for r in fresh["venue"].collect()] == [("C", "z")]
    assert merge.merged(TABLES, there, frames(spark))[0].count() == 0


def test_a_store_publishes_all_or_nothing(spark, tmp_path):
    store = CatalogStore(spark, f"file://{tmp_path}/c", TABLES, SCHEMAS)
    assert store.read("venue").count() == 0
    first = frames(spark, [("A", "UTC")], [(1, "A", "d")])
    assert store.publish("r1", first) == {"venue INSERTED": 1, "series INSERTED": 1}
    assert store.publish("r1", first) == {"venue INSERTED": 1, "series INSERTED": 1} and len(store.versions()) == 1
    with pytest.raises(Conflict):
        store.publish("r1", frames(spark, [("Q", "UTC")]))
    bad = frames(spark, [("B", "UTC")], [(1, "A", "other")])
    with pytest.raises(Conflict, match="nothing is published"):
        store.publish("r2", bad)
    assert store.ledger.state("r2")["state"] == "FAILED" and store.read("venue").count() == 1 and len(store.versions()) == 1
    with pytest.raises(Conflict, match="has failed"):
        store.publish("r2", bad)
    assert store.publish("r3", first) == {"venue UNCHANGED": 1, "series UNCHANGED": 1} and len(store.versions()) == 1
    store.publish("r4", frames(spark, [("B", None)], [(2, "B", None)]))
    assert store.read("series").count() == 2 and store.read("series", 1).count() == 1 and store.read("series", 0).count() == 0


def test_two_publishers_do_not_lose_each_other(spark, tmp_path):
    root, failed = f"file://{tmp_path}/c", []

    def publish(k):
        try:
            CatalogStore(spark, root, TABLES, SCHEMAS).publish(f"r{k}", frames(spark, [("A", "UTC"), (f"V{k}", "z")]))
        except Exception as e:  # noqa: BLE001
            failed.append(e)

    threads = [threading.Thread(target=publish, args=(k,)) for k in range(3)]
    [t.start() for t in threads], [t.join() for t in threads]
    rows = [r.code for r in CatalogStore(spark, root, TABLES, SCHEMAS).read("venue").collect()]
    assert not failed and sorted(rows) == ["A", "V0", "V1", "V2"]


DAY = datetime(2030, 1, 1)


def test_the_read_as_a_function_of_sql(spark, tmp_path):
    rows = [(s, DAY + timedelta(k), DAY + timedelta(k + 1), r, DAY + timedelta(k + 1 + 2 * r), DAY + timedelta(k + 2 + 3 * r), r != 3, 10 * k + r) for s in (1, 2, 3) for k in range(12) for r in (1, 2, 3)]
    schema = "bar_series_id long, bar_open_ts timestamp_ntz, bar_close_ts timestamp_ntz, revision_no long, available_at timestamp_ntz, system_available_at timestamp_ntz, is_final boolean, close_price int"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/bars")
    bars = spark.read.parquet(f"{tmp_path}/bars")
    sql_functions.register_bars_as_of(spark, bars)
    since, until, cutoff = DAY + timedelta(2), DAY + timedelta(9), DAY + timedelta(10)
    for mode in (pit.PUBLIC, *[m for m in pit.CLOCK if m != pit.PUBLIC]):
        for series in (None, [1, 3]):
            ids = "NULL" if series is None else f"array({', '.join(f'{s}L' for s in series)})"
            got = spark.sql(f"SELECT * FROM bars_as_of({ids}, TIMESTAMP_NTZ '{since}', TIMESTAMP_NTZ '{until}', TIMESTAMP_NTZ '{cutoff}', '{mode}')")
            want = pit.bars_as_of(bars, series, since, until, cutoff, mode).select(*bars.columns)
            assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and want.count() > 0
            plan = got._jdf.queryExecution().executedPlan().toString()
            pushed = plan.split("PushedFilters")[1][:600]
            assert pit.CLOCK[mode] in pushed and "bar_open_ts" in pushed and "Join" not in plan
    for args in ("NULL, NULL, TIMESTAMP_NTZ '2030-01-02', TIMESTAMP_NTZ '2030-01-03', 'PUBLIC_REPLAY'", "NULL, TIMESTAMP_NTZ '2030-01-03', TIMESTAMP_NTZ '2030-01-02', TIMESTAMP_NTZ '2030-01-03', 'PUBLIC_REPLAY'", "NULL, TIMESTAMP_NTZ '2030-01-01', TIMESTAMP_NTZ '2030-01-02', TIMESTAMP_NTZ '2030-01-03', 'OTHER'"):
        with pytest.raises(Exception, match="a bound is null"):
            spark.sql(f"SELECT * FROM bars_as_of({args})").collect()
    with pytest.raises(ValueError):
        sql_functions.register_bars_as_of(spark, bars, "x; DROP")
    assert spark.sql(f"SELECT count(*) AS n FROM range(3) q, LATERAL bars_as_of(NULL, TIMESTAMP_NTZ '{since}', TIMESTAMP_NTZ '{until}', TIMESTAMP_NTZ '{cutoff}', 'PUBLIC_REPLAY')").first().n == 3 * pit.bars_as_of(bars, None, since, until, cutoff, pit.PUBLIC).count()


def manifest(**change):
    instrument = {"stable_key": "i1", "provider_code": "p", "provider_symbol": "  ك۱ ", "isin": "ir0000000001", "name_fa": "x", "name_en": "y", "asset_type_code": "EQ", "venue_code": "V", "currency_code": "IRR", "status": "ACTIVE", "identifier_valid_from": "2030-01-01T00:00:00Z", "spec_effective_from": "2030-01-01T00:00:00Z", "contract_multiplier": "1"}
    got = {
        "schema_version": 1, "manifest_id": "m", "generated_at": "2030-01-01T00:00:00Z", "source": "s", "providers": [{"provider_code": "p", "display_name": "P", "provider_kind": "VENDOR", "metadata": {}}], "feeds": [],
        "currencies": [{"currency_code": "IRR", "display_name": "Rial", "minor_unit": 0, "is_fiat": True}], "asset_types": [{"asset_type_code": "EQ", "display_name": "Equity"}],
        "venues": [{"venue_code": "V", "display_name": "V", "timezone_name": "Asia/Tehran", "base_currency_code": "IRR"}], "timeframes": [{"timeframe_code": "1d", "display_name": "day", "calendar_unit": "SESSION", "session_aligned": True}],
        "provider_market_mappings": [], "instruments": [{**instrument, **change.pop("instrument", {})}],
    }
    return json.dumps({**got, **change}).encode()


def test_a_manifest_is_merged_into_the_catalogue(spark, tmp_path):
    from chronofold.sources import catalog_manifest as cm

    name, rows = cm.parse(manifest())
    assert name == "m" and rows["instruments"][0]["isin"] == "IR0000000001" and rows["instruments"][0]["provider_symbol"] == "ک1"
    store = CatalogStore(spark, f"file://{tmp_path}/c", cm.TABLES, cm.SCHEMAS)
    counts = store.publish(name, cm.frames(spark, rows))
    assert counts == {f"{s} INSERTED": 1 for s in ("providers", "currencies", "asset_types", "timeframes", "venues", "instruments")}
    assert str(store.read("instruments").first().contract_multiplier).startswith("1.0")
    with pytest.raises(Conflict, match="MISSING_PARENT"):
        store.publish("m2", cm.frames(spark, cm.parse(manifest(instrument={"stable_key": "i2", "isin": "IR0000000002", "venue_code": "W"}))[1]))
    assert store.read("instruments").count() == 1


@pytest.mark.parametrize(
    "change",
    [
        {"schema_version": 2}, {"more": 1}, {"feeds": {}}, {"instrument": {"isin": "BAD"}}, {"instrument": {"contract_multiplier": "0"}}, {"instrument": {"contract_multiplier": 1}}, {"instrument": {"previous_symbol": "x"}}, {"instrument": {"name_en": "a\nb"}},
        {"instrument": {"lower_price_limit": "2", "upper_price_limit": "1"}}, {"instrument": {"unknown": 1}}, {"timeframes": [{"timeframe_code": "1m", "display_name": "m", "calendar_unit": "FIXED", "session_aligned": False}]}, {"currencies": [{"currency_code": "A", "display_name": "a", "minor_unit": True, "is_fiat": True}]},
    ],
)
def test_bad_manifests_are_refused(change):
    from chronofold.errors import ContractError
    from chronofold.sources import catalog_manifest as cm

    with pytest.raises(ContractError):
        cm.parse(manifest(**change))


def test_catalogue_commands(spark, tmp_path, capsys):
    from chronofold import cli

    say = lambda *a: (cli.main(["--json", *a]), json.loads(capsys.readouterr().out))
    (tmp_path / "m.json").write_bytes(manifest())
    (tmp_path / "bad.json").write_bytes(manifest(instrument={"isin": "https://x.example?key=SECRET"}))
    assert say("catalogue", "validate", str(tmp_path / "m.json"))[1]["instruments"] == 1
    assert say("catalogue", "publish", str(tmp_path / "m.json"), "--store", str(tmp_path / "c"))[1]["instruments INSERTED"] == 1
    assert say("catalogue", "publish", str(tmp_path / "m.json"), "--store", str(tmp_path / "c"))[1]["instruments INSERTED"] == 1
    code, out = say("catalogue", "validate", str(tmp_path / "bad.json"))
    assert code == 2 and "SECRET" not in out["error"]
