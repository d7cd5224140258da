"""Constraints, partitions and snapshots in tasks."""

import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from chronofold.errors import Conflict, ContractError, InvalidArgument, NotFound
from chronofold.operators import constraints as c
from chronofold.sources import partitions
from chronofold.sources.snapshot_tree import SnapshotTree

DAY = datetime(2030, 1, 1)


def test_rules_follow_three_valued_logic(spark):
    rules = [
        c.one_of("kind", "A", "B"), c.above("x"), c.at_least("x"), c.between("x", 1, 5), c.not_zero("x"), c.ordered("a", "b"), c.differ("x", "y"), c.inside("x", "y", "z"), c.total_within(["x", "y"], "z"), c.equal_total(["x", "y"], "z"),
        c.required_when("kind", ["A"], ["s"]), c.absent_when("kind", ["B"], ["s"]), c.typed_by("kind", {"A": ["s"], "B": ["y"]}), c.given(["x", "y", "z"], 1, 2), c.together("a", "b"), c.length_is("v", "n"), c.sha256("s"), c.not_null("kind"), c.named("POSITIVE_X", c.above("x", -1)),
    ]
    schema = "id int, kind string, x int, y int, z int, a date, b date, s string, v array<int>, n int"
    d = [DAY.date() + timedelta(k) for k in range(3)]
    rows = [
        (0, None, None, None, None, None, None, None, None, None),
        (1, "A", 2, 1, 3, d[0], d[1], "a" * 64, [1], 1),
        (2, "B", 0, 0, 9, d[1], d[1], "bad", [1, 2], 3),
        (3, "C", 9, 10, None, d[2], None, None, [], 0),
        (4, "B", 5, 4, None, None, None, None, None, 2),
    ]
    df = spark.createDataFrame(rows, schema)
    got = {r.id: r.broken for r in c.violations(df, rules).collect()}
    assert got[0] == ["x_y_z_GIVEN", "kind_NOT_NULL"]
    assert got[1] == ["kind_TYPED", "x_y_z_GIVEN"]
    assert got[2] == ["x_ABOVE", "x_BETWEEN", "x_NOT_ZERO", "b_AFTER_a", "x_DIFFERS_y", "x_y_EQUALS_z", "s_ABSENT", "kind_TYPED", "x_y_z_GIVEN", "v_LENGTH", "s_FORMAT"]
    assert got[3] == ["kind_ONE_OF", "x_BETWEEN", "x_INSIDE", "kind_TYPED", "a_b_TOGETHER"]
    assert 4 not in got
    counts = {r.rule: r.violations for r in c.summary(df, rules).collect()}
    assert counts == {r.name: sum(r.name in b for b in got.values()) for r in rules}
    assert c.violations(df, []).count() == 0 and c.violations(df.limit(0), rules).count() == 0
    with pytest.raises(ValueError):
        c.violations(df, [c.above("x"), c.above("x")])


def test_rules_of_tables_are_one_scan(spark):
    spec = {"bar_revision": "revision_no int, bar_open_ts date, bar_close_ts date, available_at date, system_available_at date, low_price int, high_price int, open_price int, close_price int, volume int", "ingestion_batch": "status string, received_row_count int, accepted_row_count int, rejected_row_count int, requested_event_from date, requested_event_to date, started_at date, finished_at date"}
    for name, schema in spec.items():
        df = spark.createDataFrame([], schema)
        plan = c.violations(df, c.TABLES[name]())._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Exchange|Join|Python", plan)
    assert set(c.TABLES) >= {"timeframe", "data_snapshot", "derivative_contract"}


def test_month_tables(spark, tmp_path):
    t = partitions.MonthTable(spark, f"file://{tmp_path}/t", "ts", "series")
    for wrong in (1, -1, 65):
        with pytest.raises(InvalidArgument):
            t.register("2030-01", wrong)
    rows = spark.createDataFrame([(k % 5, DAY + timedelta(days=k), k) for k in range(70)], "series long, ts timestamp_ntz, n int")
    with pytest.raises(NotFound):
        t.write(rows)
    assert t.register("2030-01", 4) == 4 and t.register("2030-01", 2) == 4 and t.register(datetime(2030, 2, 5)) == 0
    with pytest.raises(NotFound, match="2030-03"):
        t.write(rows)
    assert not (tmp_path / "t" / "data").exists()
    with pytest.raises(NotFound):
        t.write(spark.createDataFrame([(1, None, 1)], "series long, ts timestamp_ntz, n int"))
    t.write(rows.where("n < 59"))
    got = t.read(DAY + timedelta(days=3), DAY + timedelta(days=40))
    assert sorted(r.n for r in got.collect()) == list(range(3, 40))
    assert {(r.event_month, r.bucket) for r in got.collect()} >= {("2030-02", 0)}
    t.write(rows.where("n < 31").withColumn("n", F.col("n") + 1000))  # replaces January only
    assert sorted(r.n for r in t.read(DAY, DAY + timedelta(days=59)).collect()) == [*range(31, 59), *range(1000, 1031)]
    one = t.read(DAY, DAY + timedelta(days=20), key=3)
    assert sorted(r.n for r in one.collect()) == [1003, 1008, 1013, 1018]
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*event_month", plan) and "bucket" in plan.split("PartitionFilters")[1][:400]


@pytest.fixture(scope="module")
def bars(spark):
    rows = [(s, DAY + timedelta(k), DAY + timedelta(k + 1), r, DAY + timedelta(k + 1 + (r - 1) * 2), True, f"{10 + k}.{r}500") for s in (7, 8) for k in range(40) for r in (1, 2)]
    df = spark.createDataFrame(rows, "bar_series_id long, bar_open_ts timestamp_ntz, bar_close_ts timestamp_ntz, revision_no long, available_at timestamp_ntz, is_final boolean, close string")
    return df.withColumn("system_available_at", F.col("available_at")).withColumn("close_price", F.col("close").cast("decimal(38,18)")).drop("close")


def parts(spark, *rows):
    return spark.createDataFrame([(f"k{s}", s, a, b, e) for s, a, b, e in rows], "component_key string, bar_series_id long, event_from timestamp_ntz, event_to timestamp_ntz, allow_empty boolean")


def test_snapshots_in_tasks(spark, bars, tmp_path):
    store, cutoff, end = SnapshotTree(spark, f"file://{tmp_path}/s"), DAY + timedelta(60), DAY + timedelta(50)
    wanted = parts(spark, (7, DAY, end, False), (8, DAY, DAY + timedelta(10), False), (9, DAY, end, True))
    made = store.build("daily", wanted, bars, cutoff, "PUBLIC_REPLAY")
    assert (made["components"], made["row_count"]) == (3, 100) and store.verify("daily").count() == 0
    assert store.build("daily", wanted.repartition(5), bars, cutoff, "PUBLIC_REPLAY") == made
    with pytest.raises(Conflict):
        store.build("daily", wanted, bars, DAY + timedelta(61), "PUBLIC_REPLAY")
    again = SnapshotTree(spark, f"file://{tmp_path}/other").build("x", wanted, bars.repartition(11), cutoff, "PUBLIC_REPLAY")
    assert again["sha256"] == made["sha256"]
    assert store.drift("daily", bars).count() == 0
    changed = bars.where("NOT (bar_series_id = 7 AND bar_open_ts = DATE'2030-01-03' AND revision_no = 2)").where("NOT (bar_series_id = 8 AND bar_open_ts = DATE'2030-01-02')")
    assert sorted(tuple(r) for r in store.drift("daily", changed).collect()) == [("k7", "2030-01-03", "CHANGED"), ("k8", "2030-01-02", "GONE")]
    lines = store.lines("daily").orderBy("component_key", "bar_open_ts", "revision_no").collect()
    assert len(lines) == 100 and '"close_price":"10.15"' in lines[0].line
    damaged = store.lines("daily").where("NOT (component_key = 'k7' AND revision_no = 2)").withColumn("component_key", F.when(F.col("component_key") == "k8", "k5").otherwise(F.col("component_key"))).collect()
    spark.createDataFrame(damaged, store.lines("daily").schema).write.mode("overwrite").parquet(f"{made['folder']}/lines")
    assert {tuple(r) for r in store.verify("daily").collect()} == {("k7", "CHANGED"), ("k8", "MISSING"), ("k5", "UNEXPECTED")}
    store.components("daily").withColumn("row_count", F.lit(1)).write.parquet(f"{tmp_path}/c")
    spark.read.parquet(f"{tmp_path}/c").write.mode("overwrite").parquet(f"{made['folder']}/components")
    assert (None, "MANIFEST") in {tuple(r) for r in store.verify("daily").collect()}


def test_a_failed_build_is_recorded_and_leaves_nothing(spark, bars, tmp_path):
    store = SnapshotTree(spark, f"file://{tmp_path}/s")
    with pytest.raises(ContractError):
        store.build("daily", parts(spark, (9, DAY, DAY + timedelta(5), False)), bars, DAY + timedelta(60), "PUBLIC_REPLAY")
    assert store.ledger.state("daily")["state"] == "FAILED" and not list((tmp_path / "s" / "data").iterdir())
    with pytest.raises(NotFound):
        store.lines("daily")
