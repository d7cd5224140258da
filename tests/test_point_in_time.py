from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofold.errors import InvalidArgument, NotFound, NullArgument
from chronofold.operators import asof, pit, temporal

DAY = "2042-01-10 "
#: opening, revision, available, system_available, close, final, closing price
ROWS = [
    ("10:00", 1, "10:01:00", "10:01:05", "10:01", True, 101), ("10:00", 2, "12:00:00", "12:05:00", "10:01", True, 102), ("10:01", 1, "10:02:00", "11:30:00", "10:02", True, 103),
    ("10:02", 1, "10:03:00", "10:03:00", "11:30", False, 104), ("10:03", 1, "14:00:00", "14:00:00", "10:04", True, 105), ("10:04", 1, "10:06:00", "10:06:00", "10:05", True, 200),
    ("10:04", 2, "10:06:00", "10:06:00", "10:05", True, 201), ("10:05", 1, "10:06:00", "10:06:00", "10:06", True, 202), ("10:06", 1, "10:08:00", "10:08:00", "10:07", False, 203), ("10:10", 1, "10:11:00", "10:11:00", "10:11", True, 204),
]


def t(clock):
    return datetime.fromisoformat(DAY + (clock if len(clock) > 5 else clock + ":00"))


@pytest.fixture(scope="module")
def bars(spark):
    rows = [(1, t(o), r, t(a), t(s), t(c), f, p) for o, r, a, s, c, f, p in ROWS]
    return spark.createDataFrame(rows, "bar_series_id long, bar_open_ts timestamp_ntz, revision_no long, available_at timestamp_ntz, system_available_at timestamp_ntz, bar_close_ts timestamp_ntz, is_final boolean, close_price long").cache()


def read(bars, start, stop, cutoff, mode=pit.PUBLIC):
    got = pit.bars_as_of(bars, [1], t(start), t(stop), t(cutoff), mode).orderBy("bar_open_ts").collect()
    return [(f"{r.bar_open_ts:%H:%M}", r.revision_no) for r in got]


def test_original_before_correction(bars):
    assert read(bars, "10:00", "10:01", "10:01:30") == [("10:00", 1)]


def test_latest_after_correction(bars):
    assert read(bars, "10:00", "10:01", "12:00") == [("10:00", 2)]


def test_modes_differ(bars):
    assert read(bars, "10:01", "10:02", "10:02") == [("10:01", 1)]
    assert read(bars, "10:01", "10:02", "10:02", pit.SYSTEM) == []
    assert read(bars, "10:01", "10:02", "11:30", pit.SYSTEM) == [("10:01", 1)]


def test_incomplete_and_future_bars_are_hidden(bars):
    assert read(bars, "10:02", "10:03", "11:00") == []
    assert read(bars, "10:03", "10:04", "13:00") == []


def test_tie_on_availability_goes_to_the_higher_revision(bars):
    assert read(bars, "10:04", "10:05", "10:06") == [("10:04", 2)]


def test_half_open_range_and_order(bars):
    assert read(bars, "10:00", "10:10", "10:30") == [("10:00", 1), ("10:01", 1), ("10:04", 2), ("10:05", 1)]


def test_current_is_not_history(bars):
    now = {f"{r.bar_open_ts:%H:%M}": r.revision_no for r in pit.current_bar(bars).collect()}
    assert now["10:00"] == 2 and read(bars, "10:00", "10:01", "11:00") == [("10:00", 1)] and "10:02" in now


def test_all_eligible_revisions(bars):
    assert pit.eligible_revisions(bars, [1], t("10:04"), t("10:05"), t("11:00"), pit.PUBLIC).count() == 2


@pytest.mark.parametrize("args, error", [
    ((None, t("10:00"), t("10:01")), NullArgument), ((t("09:00"), None, t("10:01")), NullArgument), ((t("09:00"), t("10:00"), None), NullArgument),
    ((t("10:00"), t("10:00"), t("11:00")), InvalidArgument), ((t("10:01"), t("10:00"), t("11:00")), InvalidArgument), ((t("09:00"), t("12:00"), t("11:00")), InvalidArgument), ((datetime.min, t("10:00"), t("11:00")), InvalidArgument),
])
def test_bad_ranges(bars, args, error):
    with pytest.raises(error):
        pit.bars_as_of(bars, [1], *args, pit.PUBLIC)


def test_bad_mode_and_series(spark, bars):
    with pytest.raises(InvalidArgument):
        pit.bars_as_of(bars, [1], t("09:00"), t("10:00"), t("11:00"), "OTHER")
    series = spark.createDataFrame([(1, None), (2, t("12:00"))], "bar_series_id long, adjustment_cutoff timestamp_ntz")
    with pytest.raises(NotFound):
        pit.bars_as_of(bars, [9], t("09:00"), t("10:00"), t("11:00"), pit.PUBLIC, series)
    with pytest.raises(InvalidArgument):
        pit.bars_as_of(bars, [2], t("09:00"), t("10:00"), t("11:00"), pit.PUBLIC, series)


def test_filters_reach_the_scan(spark, bars, tmp_path):
    path = str(tmp_path / "bars")
    bars.write.parquet(path)
    df = pit.bars_as_of(spark.read.parquet(path), [1], t("10:00"), t("10:10"), t("10:30"), pit.PUBLIC)
    plan = df._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan and "PushedFilters" in plan
    for c in ("is_final", "bar_open_ts", "bar_close_ts", "available_at"):
        assert c in plan.split("PushedFilters: [")[1].split("]")[0]


def test_zoned_arguments_are_instants(spark):
    from datetime import timezone

    tehran = timezone(timedelta(hours=3, minutes=30))
    local = datetime(2024, 1, 1, 3, 30, tzinfo=tehran)
    assert spark.range(1).select(pit.at(local) == pit.at(datetime(2024, 1, 1))).first()[0]
    with pytest.raises(InvalidArgument):
        pit.checked_range(datetime(2024, 1, 1), datetime(2024, 1, 1, 3, 30, tzinfo=tehran), datetime(2024, 1, 2))
    pit.checked_range(datetime(2024, 1, 1), datetime(2024, 1, 2, tzinfo=tehran), datetime(2024, 1, 2))


def test_finite_columns(spark):
    df = spark.sql("SELECT CAST(x AS TIMESTAMP_NTZ) AS t FROM VALUES ('2024-01-01'), (NULL), ('0001-01-01'), ('9999-12-31 23:59:59.999999') AS v(x)")
    assert df.where(pit.finite("t")).count() == 1


def test_natural_keys_and_sessions(spark):
    from chronofold.errors import Ambiguous, NotFound

    df = spark.createDataFrame([(1, "a", "f"), (2, "b", "f"), (3, "b", "g"), (4, "b", "g")], "id int, provider string, feed string")
    assert temporal.by_code(df, "feed", "f", {"provider": "b"}).id == 2
    with pytest.raises(NotFound):
        temporal.by_code(df, "feed", "x")
    with pytest.raises(Ambiguous):
        temporal.by_code(df, "feed", "g", {"provider": "b"})


def test_as_of_joins_equal_a_search_of_all_rows(spark):
    import random

    rnd = random.Random(3)
    left = [(rnd.choice([None, 1, 2]), i, rnd.randint(0, 20)) for i in range(80)]
    right = [(rnd.choice([None, 1, 2, 3]), rnd.randint(0, 20), rnd.randint(0, 5)) for _ in range(60)]
    l, r = spark.createDataFrame(left, "k int, id int, t int"), spark.createDataFrame(right, "k int, t int, v int")
    got = {x.id: x.v for x in asof.backward(l, r, ["k"], "t", "t", ["v"], ["id", "k"]).collect()}
    for k, i, t in left:
        seen = [(u, v) for j, u, v in right if k is not None and j == k and u <= t]
        assert got[i] == (max(seen)[1] if seen else None)
    day = lambda n: datetime(2024, 1, 1) + timedelta(hours=n)
    bars = [(s, day(24 * o), day(24 * o + rnd.choice([24, 24, 30, 100]) + 6 * n)) for s in (1, 2) for o in range(15) for n in range(2)]
    orders = [(i, rnd.choice([1, 2, 3]), day(24 * rnd.randint(0, 14)), day(rnd.randint(0, 400))) for i in range(120)]
    b = spark.createDataFrame(bars, "bar_series_id int, bar_open_ts timestamp_ntz, available_at timestamp_ntz")
    o = spark.createDataFrame(orders, "order_id int, bar_series_id int, signal_open_ts timestamp_ntz, submitted_at timestamp_ntz")
    first = {}
    for s, op, a in bars:
        first[s, op] = min(a, first.get((s, op), a))
    got = {x.order_id: (x.execution_open_ts, x.execution_ts) for x in asof.next_execution_bar(o, b, "available_at", F.lit(3600)).collect()}
    assert len(got) == len(orders)
    for i, s, signal, at in orders:
        fits = sorted((op, a) for (j, op), a in first.items() if j == s and op > signal and a >= at + timedelta(hours=1))
        assert got[i] == (fits[0] if fits else (None, None))
