"""What keeps a query's work in step with its input."""

import json
from datetime import datetime, timedelta, timezone
from decimal import Decimal

import pytest

from chronofold.functions import canonical
from chronofold.operators import backtest, integrity
from chronofold.plans import governance
from chronofold.sources import snapshot_tree, snapshots


@pytest.fixture(scope="module")
def events(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, datetime(2024, 1, 1) + timedelta(hours=7 * i), i % 7, "error" if i % 9 == 0 else "view", float(i % 50), "{}") for i in range(200)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{folder}/events.parquet")
    return folder


@pytest.mark.parametrize("name", ["canonicalize_batch", "canonical_batch_status"])
def test_provider_rows_are_parsed_once(spark, events, name):
    plan = getattr(governance, name)(spark, events)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") == 1


def test_gates_read_the_sequence_of_all_events():
    assert "FROM events) WHERE b > a + 1" in governance.GATES["continuous_sequence"] and "%" not in governance.GATES["continuous_sequence"]
    assert "conversations" in governance.GATES["continuous_turns"]


@pytest.mark.parametrize("width", [1, 4, 7, 1000])
def test_gaps_of_one_long_sequence_equal_those_of_one_group(spark, width):
    numbers = [None, -30, -9, -8, -1, 0, 1, 1, 2, 5, 6, 7, 8, 12, 12, 13, 28, 29, 500]
    df = spark.createDataFrame([(k, n) for k in ("a", "b") for n in numbers if k == "a" or n is None or n % 3], "k string, n bigint")
    rows = lambda found: sorted(map(tuple, found.collect()))
    want = rows(integrity.sequence_gaps(df, ["k"], "n"))
    assert rows(integrity.sequence_gaps(df, ["k"], "n", width)) == want and ("a", 29, 500) in want
    assert rows(integrity.sequence_gaps(df.where("k = 'a'"), [], "n", width)) == [r[1:] for r in want if r[0] == "a"]


T0 = datetime(2030, 1, 1, tzinfo=timezone.utc)
DAY = timedelta(days=1)


def sweep(n):
    bars = [backtest.Bar(T0 + k * DAY, 7, 1, T0 + (k + 1) * DAY, T0 + (k + 1) * DAY, Decimal(10 + k * k % 7)) for k in range(n)]
    spec = backtest.Spec("a", T0, T0 + n * DAY, Decimal(1000), 3, 8, Decimal(10), backtest.Costs(Decimal(5)), (backtest.Instrument(1),))
    return spec, {1: backtest.one_tape(bars)}


def test_a_run_writes_each_bar_once(monkeypatch):
    """A decision names up to 8 bars and is written into two texts: with each bar's text written anew that is some 20 objects a decision."""
    written, plain = [], canonical._object
    monkeypatch.setattr(canonical, "_object", lambda v, form: written.append(1) or plain(v, form))
    spec, tapes = sweep(100)
    r = backtest.simulate(spec, tapes)
    backtest.journal(spec, r)
    assert len(r.decisions) == 99 and len(written) < 10 * len(r.decisions)


def test_some_kinds_of_journals_are_those_of_all():
    spec, tapes = sweep(60)
    every = backtest.journal(spec, backtest.simulate(spec, tapes))
    assert {r[1] for r in every} == set(backtest.JOURNALS) - {"failed", "position"}
    for kinds in (("fill",), ("equity", "summary", "failed"), ("decision", "order"), ("signal", "valuation")):
        got = backtest.journal(spec, backtest.simulate(spec, tapes, hashed=not backtest.HASHED.isdisjoint(kinds)), kinds)
        assert got == [r for r in every if r[1] in kinds] and got


def test_known_text_is_that_of_a_plain_mapping():
    inner = {"b": Decimal("1.50"), "a": [T0, None, True, 1, "\"\n\u06f1"], "c": Decimal("-0.0")}
    known = canonical.Known(inner)
    for _ in range(2):
        assert canonical.snapshot_bytes({"x": [known, known]}) == canonical.snapshot_bytes({"x": [inner, inner]})
    assert json.loads(canonical.snapshot_bytes(known)) == {"a": ["2030-01-01T00:00:00Z", None, True, 1, "\"\n\u06f1"], "b": "1.5", "c": "0"}
    assert canonical.row_bytes({"d": known["b"]}) == b'{"d":1.5}' and canonical.storage_bytes({"d": known["b"]}) == b'{"d":1.50}'


def test_a_snapshot_deals_its_bars_before_they_become_lines(spark, tmp_path, monkeypatch):
    plans, stamped = [], snapshot_tree._stamped
    monkeypatch.setattr(snapshot_tree, "_stamped", lambda bars: plans.append(bars._jdf.queryExecution().optimizedPlan().toString()) or stamped(bars))
    bars = spark.createDataFrame([(1, datetime(2030, 1, k), datetime(2030, 1, k + 1), 1, True, datetime(2030, 1, k + 1), datetime(2030, 1, k + 1), Decimal(k)) for k in range(1, 9)], "bar_series_id bigint, bar_open_ts timestamp_ntz, bar_close_ts timestamp_ntz, revision_no bigint, is_final boolean, available_at timestamp_ntz, system_available_at timestamp_ntz, close_price decimal(18,2)")
    parts = spark.createDataFrame([("a", 1, datetime(2030, 1, 1), datetime(2030, 2, 1), False)], "component_key string, bar_series_id bigint, event_from timestamp_ntz, event_to timestamp_ntz, allow_empty boolean")
    store = snapshot_tree.SnapshotTree(spark, f"file://{tmp_path}/s")
    assert store.build("x", parts, bars, datetime(2030, 1, 20), "PUBLIC_REPLAY")["row_count"] == 8
    assert plans and "RepartitionByExpression" in plans[0]
    assert store.drift("x", bars).count() == 0 and store.drift("x", bars.where("revision_no = 1 AND bar_open_ts <> TIMESTAMP_NTZ'2030-01-03'")).collect()[0].change == "GONE"


@pytest.mark.parametrize("scale", [0, 1, 2, 6, 7, 18])
def test_lines_are_the_bytes_of_the_snapshot_form(spark, scale):
    numbers = [Decimal(n).scaleb(-scale) for n in (0, 1, -1, 10, 100, -1500, 120000, 1000000, 99999999)]
    stamps = [datetime(2024, 1, 1), datetime(2024, 1, 1, 0, 0, 10), datetime(2024, 10, 20, 10, 0, 0, 1), datetime(1999, 12, 31, 23, 59, 59, 100000)]
    rows = [(i, n, stamps[i % 4]) for i, n in enumerate(numbers)] + [(99, None, None)]
    df = spark.createDataFrame(rows, f"i int, d decimal(28,{scale}), t timestamp_ntz")
    got = [r[0] for r in df.select(canonical.json_object(snapshots.line_fields(df)).alias("l"), "i").orderBy("i").collect()]
    assert got == [canonical.snapshot_bytes({"i": i, "d": n, "t": t and t.replace(tzinfo=timezone.utc)}).decode() for i, n, t in rows]
