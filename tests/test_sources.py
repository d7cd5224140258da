import json
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from chronofold import cli
from chronofold.errors import Conflict, ContractError, NotFound
from chronofold.functions import canonical
from chronofold.sources import fixtures, manifests, snapshots
from chronofold.streaming import replay

DAY = datetime(2030, 1, 1)


@pytest.fixture(scope="module")
def bars(spark):
    rows = [(7, DAY + timedelta(k), DAY + timedelta(k + 1), r, DAY + timedelta(k + 1 + (r - 1) * 2), DAY + timedelta(k + 1 + (r - 1) * 2), True, f"{10 + k}.{r}500") for k in range(5) for r in (1, 2)]
    df = spark.createDataFrame(rows, "bar_series_id long, bar_open_ts timestamp_ntz, bar_close_ts timestamp_ntz, revision_no long, available_at timestamp_ntz, system_available_at timestamp_ntz, is_final boolean, close string")
    return df.withColumn("close_price", F.col("close").cast("decimal(38,18)")).drop("close")


def manifest(**change):
    got = {"schema_version": 1, "snapshot_code": "daily", "knowledge_cutoff_ts": "2030-02-01T00:00:00Z", "availability_mode": "PUBLIC_REPLAY", "components": [{"component_key": "k", "kind": "BAR_REVISION", "bar_series_id": 7, "event_from": "2030-01-01T00:00:00Z", "event_to": "2030-01-20T00:00:00Z"}]}
    return json.dumps({**got, **change}).encode()


def test_snapshot_lifecycle(spark, bars, tmp_path):
    store = snapshots.SnapshotStore(tmp_path)
    with pytest.raises(NotFound):
        store.state("daily")
    assert store.build(manifests.snapshot(manifest()), bars)["state"] == "FROZEN"
    assert store.build(manifests.snapshot(manifest()), bars)["state"] == "FROZEN"
    with pytest.raises(Conflict):
        store.build(manifests.snapshot(manifest(knowledge_cutoff_ts="2030-03-01T00:00:00Z")), bars)
    assert store.verify("daily", bars) == []
    assert store.verify("daily", bars.where("revision_no = 1")) == ["k: drifted"]
    component = store.manifest("daily")["components"][0]
    path = store.folder("daily") / component["file"]
    lines = path.read_bytes().splitlines()
    assert component["row_count"] == len(lines) == 10
    first = json.loads(lines[0])
    assert first["close_price"] == "10.15" and first["bar_open_ts"] == "2030-01-01T00:00:00Z" and list(first) == sorted(first)
    other = snapshots.SnapshotStore(tmp_path / "other")
    other.build(manifests.snapshot(manifest(snapshot_code="again")), bars.repartition(7))
    assert other.manifest("again")["components"][0]["sha256"] == component["sha256"]
    got = snapshots.load(spark, str(path), 7)
    assert got.count() == 10 and str(got.orderBy("bar_open_ts", "revision_no").first().close_price).startswith("10.15")
    with pytest.raises(Exception, match="bad row"):
        snapshots.load(spark, str(path), 8).count()
    path.write_bytes(path.read_bytes().replace(b"10.15", b"10.16"))
    assert store.verify("daily") == ["k: changed"]


def test_a_failed_build_leaves_nothing(bars, tmp_path):
    store = snapshots.SnapshotStore(tmp_path)
    empty = manifests.snapshot(manifest(components=[{"component_key": "k", "kind": "BAR_REVISION", "bar_series_id": 99, "event_from": "2030-01-01T00:00:00Z", "event_to": "2030-01-20T00:00:00Z"}]))
    with pytest.raises(ContractError):
        store.build(empty, bars)
    assert store.state("daily")["state"] == "FAILED" and not store.folder("daily").exists()


@pytest.mark.parametrize("change", [{"schema_version": True}, {"schema_version": 2}, {"more": 1}, {"snapshot_code": "../x"}, {"availability_mode": "X"}, {"knowledge_cutoff_ts": "2030-01-01T00:00:00"}, {"components": []}])
def test_bad_snapshot_manifests(change):
    with pytest.raises(ContractError):
        manifests.snapshot(manifest(**change))


def test_duplicate_keys_are_refused():
    with pytest.raises(ContractError):
        manifests.snapshot(manifest().replace(b'"schema_version": 1', b'"schema_version": 1, "schema_version": 1'))


RUN = {
    "schema_version": 1, "run_code": "r", "snapshot_code": "daily", "universe_code": "u", "base_currency_code": "IRR", "event_from": "2030-01-01T00:00:00Z", "event_to": "2030-01-20T00:00:00Z", "initial_capital": "10000", "random_seed": 1,
    "strategy": {"kind": "SMA_CROSS_LONG_FLAT_V1", "parameters": {"fast_window": 2, "slow_window": 3, "target_quantity": "100"}}, "execution_model": {"kind": "NEXT_BAR_CLOSE_AT_AVAILABILITY_V1"}, "transaction_cost_model": {"commission_bps": "0", "slippage_bps": "0", "sell_tax_bps": "0"},
    "instruments": [{"instrument_id": 1, "signal_component_key": "k", "execution_component_key": "k", "valuation_component_key": "k", "execution_lag_seconds": 0}],
}


def test_commands(bars, tmp_path, capsys):
    (tmp_path / "s.json").write_bytes(manifest())
    (tmp_path / "r.json").write_text(json.dumps(RUN))
    bars.write.parquet(str(tmp_path / "bars"))
    store = str(tmp_path / "store")
    say = lambda *a: (cli.main(["--json", *a]), json.loads(capsys.readouterr().out))
    assert say("snapshot", "validate", str(tmp_path / "s.json"))[0] == 0
    assert say("snapshot", "build", str(tmp_path / "s.json"), "--store", store, "--bars", str(tmp_path / "bars"))[0] == 0
    assert say("snapshot", "verify", "daily", "--store", store, "--bars", str(tmp_path / "bars")) == (0, {"problems": []})
    code, out = say("backtest", "run", str(tmp_path / "r.json"), "--store", store)
    assert code == 0 and out["summary"]["result_sha256"] and out["equity"]
    assert say("backtest", "validate", str(tmp_path / "s.json"))[0] == 2
    file = next((tmp_path / "store" / "daily").glob("*.jsonl"))
    file.write_bytes(b"")
    assert say("snapshot", "verify", "daily", "--store", store)[0] == 5


def test_a_command_runs_a_backtest_once(spark, bars, tmp_path, capsys):
    (tmp_path / "s.json").write_bytes(manifest())
    (tmp_path / "r.json").write_text(json.dumps(RUN))
    bars.write.parquet(str(tmp_path / "bars"))
    store, at = str(tmp_path / "store"), str(tmp_path / "journals")
    say = lambda *a: (cli.main(["--json", *a]), json.loads(capsys.readouterr().out))
    assert say("snapshot", "build", str(tmp_path / "s.json"), "--store", store, "--bars", str(tmp_path / "bars"))[0] == 0
    first = say("backtest", "run", str(tmp_path / "r.json"), "--store", store, "--journals", at)
    assert first[0] == 0 and spark.read.parquet(at).where("journal = 'equity'").count() > 0
    assert say("backtest", "run", str(tmp_path / "r.json"), "--store", store, "--journals", at) == first  # the journals are not written again
    (tmp_path / "r.json").write_text(json.dumps({**RUN, "initial_capital": "77777"}))
    code, out = say("backtest", "run", str(tmp_path / "r.json"), "--store", store)
    assert code == 4 and out["code"] == "23505"


def calendar(**change):
    sessions = [{"trading_date": f"2030-01-0{k}", "session_code": "REGULAR", "is_trading_day": k != 2, "open_local_time": "09:00" if k != 2 else None, "close_local_time": "12:30" if k != 2 else None, "source_status": "x"} for k in (1, 2, 3)]
    return json.dumps({"schema_version": 1, "calendar_id": "c", "venue_code": "TSE", "timezone": "Asia/Tehran", "date_from": "2030-01-01", "date_to": "2030-01-03", "sessions": sessions, **change}).encode()


def test_calendar():
    got = manifests.calendar(calendar())
    assert got[0]["session_open_ts"] == datetime(2030, 1, 1, 5, 30, tzinfo=timezone.utc) and got[1]["session_open_ts"] is None
    with pytest.raises(ContractError):
        manifests.calendar(calendar(date_to="2030-01-04"))
    from datetime import date, time

    with pytest.raises(ContractError):
        manifests.local_to_utc(date(2024, 3, 10), time(2, 30), "America/New_York")
    with pytest.raises(ContractError):
        manifests.local_to_utc(date(2024, 11, 3), time(1, 30), "America/New_York")
    early, late = (manifests.local_to_utc(date(2024, 11, 3), time(1, 30), "America/New_York", f) for f in (0, 1))
    assert late - early == timedelta(hours=1)


def test_fixtures(spark, tmp_path):
    (tmp_path / "a.json").write_bytes(b'{"l18":"x","isin":"IRO1","m":"TSE"}')
    (tmp_path / "index.json").write_text(json.dumps({"schema_version": 1, "symbols": {" ك ": "a.json"}}))
    client = fixtures.IndexedFixtures(tmp_path, lambda: DAY)
    assert fixtures.symbol_metadata(client.fetch("ک").body)["isin"] == "IRO1"
    with pytest.raises(NotFound):
        client.fetch("other")
    (tmp_path / "index.json").write_text(json.dumps({"schema_version": 1, "symbols": {"a": "../a.json"}}))
    with pytest.raises(ContractError):
        fixtures.IndexedFixtures(tmp_path, lambda: DAY)
    assert fixtures.read_responses(spark, str(tmp_path / "a.json")).count() == 1


def test_three_canonical_forms():
    from decimal import Decimal

    row = {"b": Decimal("1.500"), "a": Decimal("0.00"), "c": [True, None, "é"]}
    assert canonical.snapshot_bytes(row).decode() == '{"a":"0","b":"1.5","c":[true,null,"é"]}'
    assert canonical.row_bytes(row).decode() == '{"a":0,"b":1.5,"c":[true,null,"é"]}'
    assert canonical.storage_bytes(row).decode() == '{"a":0.00,"b":1.500,"c":[true,null,"é"]}'


def test_json_of_columns_equals_that_of_values(spark):
    from pyspark.sql import functions as F

    values = [None, "", 'a"b\\c', "".join(map(chr, range(0x20))) + "\x7f", "é東😀\u2028", "\\u0001"]
    df = spark.createDataFrame([(v,) for v in values], "v string").select(canonical.json_object({"a": canonical.quoted(F.col("v")), "b": F.lit(None).cast("string")}).alias("x"))
    assert [r.x.encode() for r in df.collect()] == [canonical.snapshot_bytes({"a": v, "b": None}) for v in values]


def test_plain_decimals_and_instants():
    from decimal import Decimal

    assert [canonical.plain(Decimal(x)) for x in ("-0.00", "1E+3", "1.2300", "-5", "0.000000000000000001", "12345678901234567890.123456789012345678")] == ["0", "1000", "1.23", "-5", "0.000000000000000001", "12345678901234567890.123456789012345678"]
    assert canonical.instant(datetime(2030, 1, 1, 3, 30, 0, 500, tzinfo=timezone(timedelta(hours=3, minutes=30)))) == "2030-01-01T00:00:00.0005Z"
    with pytest.raises(ValueError):
        canonical.instant(datetime(2030, 1, 1))
    with pytest.raises(TypeError):
        canonical.row_bytes(datetime(2030, 1, 1, tzinfo=timezone.utc))


def test_streams(spark, tmp_path):
    ticks = [(1, DAY + timedelta(seconds=s), s, float(s % 7)) for s in range(0, 600, 10)]
    schema = "instrument_id long, event_ts timestamp_ntz, source_sequence long, price double"
    spark.createDataFrame(ticks, schema).write.parquet(str(tmp_path / "ticks"))
    made = replay.bars(replay.tick_stream(spark, str(tmp_path / "ticks"), schema), "1m", "0 seconds")
    replay.replay(made, str(tmp_path / "bars"), str(tmp_path / "cp")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "bars")).orderBy("bar_open_ts").collect()
    assert len(got) >= 9 and got[0].open_price == 0.0 and got[0].trade_count == 6
    spark.createDataFrame([(DAY, 1), (DAY + timedelta(40), 1)], "bar_open_ts timestamp_ntz, revision_no long").write.parquet(str(tmp_path / "revs"))
    stream = spark.readStream.schema("bar_open_ts timestamp_ntz, revision_no long").parquet(str(tmp_path / "revs"))
    replay.append_revisions(stream, str(tmp_path / "store"), str(tmp_path / "cp2")).awaitTermination()
    stored = spark.read.parquet(str(tmp_path / "store"))
    assert stored.count() == 2 and {r.event_month for r in stored.collect()} == {"2030-01", "2030-02"}
