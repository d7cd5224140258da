"""The newest visible bars of decisions, and identical raw payloads, against brute force."""

import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from chronofold.operators import asof, raw_events

T = datetime(2030, 1, 1)
RND = random.Random(8)


def test_last_visible_matches_brute_force(spark):
    rows = []
    for series in range(1, 6):
        for k in range(25):
            late = 40 if series > 2 and RND.random() < 0.15 else 0  # a bar that comes after newer ones
            for r in range(1, RND.randrange(2, 5)):
                rows.append((series, T + timedelta(hours=k), r, T + timedelta(hours=k + 1 + late + RND.randrange(6)) if RND.random() < 0.95 else None, 100 * k + r))
    bars = spark.createDataFrame(rows, "bar_series_id long, bar_open_ts timestamp_ntz, revision_no long, seen timestamp_ntz, price long")
    asked = [(RND.randrange(1, 7), T + timedelta(hours=RND.randrange(-2, 70))) for _ in range(80)]
    got = {}
    for r in asof.last_visible(spark.createDataFrame(asked + asked[:5], "bar_series_id long, decision_ts timestamp_ntz"), bars, "seen", 3, ["price"]).collect():
        got.setdefault((r.bar_series_id, r.decision_ts), []).append((r["rank"], r.bar_open_ts, r.revision_no, r.price))
    for series, at in set(asked):
        best = {}
        for s, o, r, seen, p in rows:
            if s == series and seen is not None and seen <= at and r > best.get(o, (0, 0))[0]:
                best[o] = (r, p)
        want = [(i + 1, o, *best[o]) for i, o in enumerate(sorted(best, reverse=True)[:3])]
        assert sorted(got.get((series, at), [])) == want
    plan = asof.last_visible(spark.createDataFrame(asked, "bar_series_id long, decision_ts timestamp_ntz"), bars, "seen", 3, ["price"])._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_identical_payloads(spark):
    rows = [(k, RND.choice([1, 2, None]), RND.choice(["a", "b", "c", "", None]) or None if RND.random() < 0.9 else "x" * 50_000) for k in range(120)]
    df = spark.createDataFrame(rows, "id long, feed long, body string")
    stored = df.where("id % 5 = 0 OR id = 7")
    held = stored.select("feed", raw_events.content(F.col("body")).alias("content"), "id")
    for bits in (26, 15):
        got = {r.id: r.identical_to for r in raw_events.find_identical(held, df.where("id % 5 <> 0 AND id <> 7"), ["feed"], "body", "id", bits).collect()}
        old = [r for r in rows if r[0] % 5 == 0 or r[0] == 7]
        new = [r for r in rows if r not in old]
        assert set(got) == {r[0] for r in new}
        for i, feed, body in new:
            same = lambda r: r[1:] == (feed, body)
            want = None if feed is None or body is None else min([r[0] for r in old if same(r)], default=min([r[0] for r in new if same(r) and r[0] < i], default=None))
            assert got[i] == want
    assert raw_events.find_identical(held.limit(0), df, ["feed"], "body", "id").where("identical_to IS NULL").count() > 0
    assert raw_events.find_identical(held, df.limit(0), ["feed"], "body", "id").count() == 0
