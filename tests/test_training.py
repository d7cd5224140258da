"""Stateful streams, books as of an instant, lifecycles and their ledger, features, labels and windows."""

import json
import random
import threading
import time
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from chronofold.errors import Conflict, NotFound
from chronofold.operators import book, ingest, lifecycle, training
from chronofold.sources import ledger, places
from chronofold.streaming import revisions

T = datetime(2030, 1, 1)
RND = random.Random(3)


def at(hours):
    return T + timedelta(hours=hours)


# streams

TICKS = "series long, bar_open_ts timestamp_ntz, arrived long, price decimal(18,2), note string"


def ticks(n, first=0):
    rows = []
    for k in range(first, first + n):
        rows.append((RND.choice([1, 1, 2, None]), at(24 * RND.randrange(3)), k, RND.choice([None, Decimal("1.00"), Decimal("1.50")]), RND.choice([None, "a"])))
    return rows


def batch(spark, rows, stored):
    b = ingest.append_if_changed(stored, spark.createDataFrame([r for r in rows if r[0] is not None], TICKS), ["series", "bar_open_ts"], ["price", "note"], ["arrived"])
    return sorted((r.arrived, r.outcome, r.revision_no) for r in b.collect())


def test_a_stream_gives_what_the_batch_gives_through_restarts(spark, tmp_path):
    stored = spark.createDataFrame([(1, at(0), 4, Decimal("1.00"), None), (1, at(0), 3, Decimal("9.00"), None), (2, at(24), 1, None, "a")], "series long, bar_open_ts timestamp_ntz, revision_no long, price decimal(18,2), note string")
    rows, land = ticks(60), str(tmp_path / "land")
    for k in range(3):
        spark.createDataFrame(rows[20 * k : 20 * k + 20], TICKS).write.mode("append").parquet(land)
        stream = spark.readStream.schema(TICKS).parquet(land).where("series IS NOT NULL")
        changed = revisions.changes(stream, ["series", "bar_open_ts"], ["price", "note"], ["arrived"], stored=stored)
        revisions.start(changed, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
        assert spark.conf.get(revisions.SETTING) != revisions.PROVIDER
    got = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r.arrived, r.outcome, r.revision_no) for r in got.collect()) == batch(spark, rows, stored)
    assert {r.outcome for r in got.collect()} == {"INSERTED", "CORRECTED", "UNCHANGED"}


def test_a_timer_says_when_a_key_is_settled(spark, tmp_path):
    land = str(tmp_path / "land")
    for k in range(2):
        spark.createDataFrame([(1 + k, at(0), k, Decimal("1.00"), None)], TICKS).write.mode("append").parquet(land)
        changed = revisions.changes(spark.readStream.schema(TICKS).parquet(land), ["series"], ["price"], ["arrived"], quiet_seconds=0.001)
        revisions.start(changed, str(tmp_path / "out"), str(tmp_path / "cp"), once=True).awaitTermination()
        time.sleep(0.05)
    settled = spark.read.parquet(str(tmp_path / "out")).where("outcome = 'SETTLED'").collect()
    assert [(r.series, r.arrived, r.revision_no) for r in settled] == [(1, None, 1)]


# books


def brute_book(snapshots, changes, ask):
    name, _, moment = ask
    bases = [(ts, 0, seq, levels) for b, ts, seq, levels in snapshots if b == name and ts <= moment] + [(ts, 1, seq, []) for b, ts, seq, action, *_ in changes if b == name and action == "CLEAR" and ts <= moment]
    if not bases:
        return None, None, "NO_BASE", {}
    ts0, kind, seq0, levels = max(bases, key=lambda x: x[:3])
    state, top, gap = {(s, p): q for s, p, q in levels}, seq0, False
    for b, ts, seq, action, side, price, quantity in sorted(changes, key=lambda c: (c[1], c[2])):
        if b != name or ts > moment or (ts, 1, seq) <= (ts0, kind, seq0) or seq <= top:
            continue
        gap, top = gap or seq > top + 1, seq
        state.pop((side, price), None)
        if action == "SET":
            state[side, price] = quantity
    return seq0, top, "GAP" if gap else "OK", state


def test_books_match_a_replay(spark):
    for seed in range(3):
        rnd = random.Random(seed)
        changes, snapshots, asks = [], [], []
        for name in (1, 2):
            seq = 0
            for h in range(120):
                seq += 1 if rnd.random() < 0.95 else 2
                number = seq if rnd.random() < 0.9 else max(1, seq - 4)  # some come again, late
                changes.append((name, at(h), number, "CLEAR" if rnd.random() < 0.03 else rnd.choice(["SET", "SET", "DELETE"]), rnd.choice(["BID", "ASK"]), rnd.randrange(4), rnd.randrange(50)))
                if rnd.random() < 0.06:
                    snapshots.append((name, at(h), seq, [("BID", 1, rnd.randrange(50)), ("ASK", 3, 7)][: rnd.randrange(3)]))
                if rnd.random() < 0.3 or h == 0:
                    asks.append((name, 1000 * name + h, at(h)))
        asks.append((9, 9, at(5)))
        got = book.book_as_of(
            spark.createDataFrame(snapshots, "book long, ts timestamp_ntz, seq long, levels array<struct<side:string,price:long,quantity:long>>"),
            spark.createDataFrame(changes + [(None, at(1), 1, "SET", "BID", 1, 1), (1, None, 1, "SET", "BID", 1, 1)], "book long, ts timestamp_ntz, seq long, action string, side string, price long, quantity long"),
            spark.createDataFrame(asks, "book long, ask_id long, at timestamp_ntz"),
        ).collect()
        found = {}
        for r in got:
            found.setdefault(r.ask_id, (r.base_seq, r.last_seq, r.status, {}))[3].update({(r.side, r.price): r.quantity} if r.side else {})
        assert found == {a[1]: brute_book(snapshots, changes, a) for a in asks}
    assert {v[2] for v in found.values()} >= {"NO_BASE", "OK"}


# lifecycles


def fold(machine, events):
    state, spec, out = None, None, []
    for no, event, given in events:
        if event == lifecycle.REQUEST:
            if state is None:
                state, spec, outcome = machine.states[0], given, "CREATED"
            else:
                outcome = machine.answer(state, given == spec)
        else:
            after = machine.move(state, event) if state else None
            outcome, state = ("TAKEN", after) if after else ("REFUSED", state)
        out.append((no, outcome, state))
    return out


@pytest.mark.parametrize("machine", [lifecycle.RUN, lifecycle.BATCH])
def test_lifecycles_match_a_fold(spark, machine):
    kinds = ["REQUEST", "REQUEST", *machine.starts, *machine.ends, "NONSENSE"]
    events = [(f"k{k}", no, RND.choice(kinds), RND.choice(["a", "a", "b", None])) for k in range(80) for no in range(RND.randrange(9))]
    df = spark.createDataFrame(events + [(None, 1, "REQUEST", "a"), ("k0", None, "REQUEST", "a")], "code string, event_no long, event string, specification string")
    got = sorted((r.code, r.event_no, r.outcome, r.state) for r in lifecycle.outcomes(df, machine).collect())
    want = [(k, *x) for k in sorted({e[0] for e in events}) for x in fold(machine, [e[1:] for e in events if e[0] == k])]
    assert got == sorted(want, key=lambda r: r[:2])


def test_a_ledger_runs_work_once(spark, tmp_path):
    book_ = ledger.Ledger(spark, f"file://{tmp_path}/runs")
    done = []
    work = lambda: done.append(1) or {"result_sha256": "x"}
    assert book_.run("r1", "spec", work)["state"] == "SUCCEEDED"
    assert book_.run("r1", "spec", work)["state"] == "SUCCEEDED" and done == [1]
    with pytest.raises(Conflict):
        book_.run("r1", "another", work)

    def broken():
        raise ValueError("https://x.example/a?key=SECRET&b=1 " + "y" * 900)

    with pytest.raises(ValueError):
        book_.run("r2", "spec", broken)
    detail = json.loads(book_.state("r2")["detail"])["error"]
    assert "SECRET" not in detail and len(detail) <= 512
    with pytest.raises(Conflict):
        book_.run("r2", "spec", work)
    with pytest.raises(NotFound):
        book_.move("r3", "START")
    book_.request("r4", "spec")
    assert book_.request("r4", "spec")[0] == "IN_PROGRESS"
    with pytest.raises(Conflict):
        book_.move("r4", "SUCCEED")
    states = {(r.key, r.number): r.state for r in book_.all().collect()}
    assert states["r1", 3] == "SUCCEEDED" and states["r2", 3] == "FAILED" and states["r4", 1] == "QUEUED"
    assert ledger.Ledger(spark, f"file://{tmp_path}/none").all().count() == 0
    batches = ledger.Ledger(spark, f"file://{tmp_path}/batches", lifecycle.BATCH)
    assert batches.request("feed|1", "AAA")[0] == "CREATED" and batches.request("feed|1", "AAA")[0] == "IN_PROGRESS"
    assert batches.move("feed|1", "PARTIAL", accepted=3)["state"] == "PARTIAL" and batches.request("feed|1", "AAA")[0] == "REPLAYED"
    with pytest.raises(Conflict):
        batches.request("feed|1", "BBB")


def test_of_many_writers_one_wins(spark, tmp_path):
    outcomes, done = [], []

    def worker():
        mine = ledger.Ledger(spark, f"file://{tmp_path}/runs")
        try:
            mine.run("r", "spec", lambda: done.append(1) or {})
            outcomes.append("ok")
        except Conflict:
            outcomes.append("conflict")

    threads = [threading.Thread(target=worker) for _ in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert done == [1] and outcomes.count("ok") >= 1 and len(outcomes) == 8
    assert [e["state"] for e in ledger.Ledger(spark, f"file://{tmp_path}/runs").entries("r")] == ["QUEUED", "RUNNING", "SUCCEEDED"]
    wins = []
    threads = [threading.Thread(target=lambda k=k: wins.append(places.create(spark, f"file://{tmp_path}/one", str(k).encode()))) for k in range(8)]
    [t.start() for t in threads], [t.join() for t in threads]
    assert sorted(wins) == [False] * 7 + [True] and len(places.read(spark, f"file://{tmp_path}/one")) == 1


# features, labels, windows


def test_features_of_many_streams_as_of_decisions(spark):
    streams, facts = {}, {}
    for name in ("a", "b"):
        rows = [(RND.choice([1, 2]), at(e := RND.randrange(40)), at(e + RND.randrange(20)), RND.randrange(3), RND.randrange(100)) for _ in range(60)]
        facts[name] = rows
        streams[name] = spark.createDataFrame(rows + [(None, at(0), at(0), 1, 5), (1, None, at(0), 1, 5), (1, at(0), None, 1, 5)], "series long, event_ts timestamp_ntz, available_at timestamp_ntz, revision_no long, value long")
    asked = [(RND.choice([1, 2, 3]), k, at(RND.randrange(60))) for k in range(40)] + [(None, 90, at(50)), (1, 91, None)]
    got = training.features_as_of(spark.createDataFrame(asked, "series long, id long, decision_ts timestamp_ntz"), streams, "series", "decision_ts").collect()
    assert len(got) == len(asked)
    for r in got:
        for name, rows in facts.items():
            known = [(e, n, v, a) for s, e, a, n, v in rows if s == r.series and r.decision_ts is not None and a <= r.decision_ts]
            want = max(known) if known else None
            assert (tuple(r[name]) if r[name] else None) == want


def test_first_touch_matches_a_walk(spark):
    rows = []
    for series in (1, 2):
        price = 100
        for k in range(50):
            price += RND.randrange(-6, 7)
            rows.append((series, at(24 * k), price + RND.randrange(6), price - RND.randrange(6), price, at(24 * k + 24 + RND.randrange(30))))
    df = spark.createDataFrame(rows, "series long, bar_open_ts timestamp_ntz, high_price long, low_price long, close_price long, available_at timestamp_ntz")
    got = {(r.series, r.bar_open_ts): r for r in training.first_touch(df, "series", 6, F.col("close_price") + 8, F.col("close_price") - 8).collect()}
    seen = set()
    for series in (1, 2):
        mine = [r for r in rows if r[0] == series]
        for k, r in enumerate(mine):
            label, n, ahead = None, None, mine[k + 1 : k + 7]
            for j, x in enumerate(ahead, 1):
                if x[3] <= r[4] - 8 or x[2] >= r[4] + 8:
                    label, n = (-1 if x[3] <= r[4] - 8 else 1), j
                    break
            if label is None and len(ahead) == 6:
                label = 0
            used = ahead[: n or 6] if label is not None else []
            want = (label, n, max((x[1] for x in used), default=None), max((x[5] for x in used), default=None))
            g = got[series, r[1]]
            assert (g.label, g.touched_after, g.outcome_end_ts, g.label_available_at) == want
            seen.add(label)
    assert seen == {-1, 0, 1, None}


def test_labels_keep_their_availability(spark):
    rows = [(1, at(0), at(1), at(5), at(6), 1), (2, at(0), at(1), at(5), None, 1), (3, at(0), at(1), at(0), at(6), 0), (4, at(0), at(1), at(5), at(4), 1), (5, at(0), at(6), at(5), at(6), 1), (6, at(0), at(1), None, None, None)]
    df = spark.createDataFrame(rows, "id int, anchor_ts timestamp_ntz, decision_ts timestamp_ntz, outcome_end_ts timestamp_ntz, available_at timestamp_ntz, label int")
    assert {r.id: r.violation for r in training.label_violations(df).collect()} == {2: "WITHOUT_AVAILABILITY", 3: "OUTCOME_NOT_AHEAD", 4: "BEFORE_OUTCOME_END", 5: "KNOWN_AT_DECISION"}


def test_windows_read_each_table_once(spark):
    from chronofold.plans import training as plans

    plan = plans._windows(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Window") < 40
