import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from chronofold.errors import ContractError, ProviderError
from chronofold.functions import text
from chronofold.operators import ingest, temporal
from chronofold.plans import catalogue, governance

ROW = {"l18": "نماد", "type": 2, "count": 1, "date": "1403/01/01", "time": "12:30", "open": 10, "high": "12.5", "low": 9, "close": 11, "volume": 100}


def codes(spark, *rows, symbol="نماد"):
    df = spark.createDataFrame([(i, json.dumps({**ROW, **r} if isinstance(r, dict) else r)) for i, r in enumerate(rows)], "n int, raw_payload string")
    p = ingest.parse_rows(df).withColumn("more", ingest.row_issues(F.lit(symbol), F.lit(1)))
    return [sorted(x["code"] for x in [*r.issues, *r.more]) for r in p.orderBy("n").collect()]


def test_good_row(spark):
    assert codes(spark, {}) == [[]]


@pytest.mark.parametrize("change, code", [
    ({"volume": -1}, "NEGATIVE_VOLUME"), ({"high": 1}, "INVALID_OHLC"), ({"date": "1400/12/30"}, "INVALID_JALALI_DATE"), ({"open": True}, "INVALID_NUMERIC_VALUE"), ({"close": "x"}, "INVALID_NUMERIC_VALUE"),
    ({"l18": "دیگر"}, "SYMBOL_MISMATCH"), ({"l18": 5}, "INVALID_FIELD_TYPE"), ({"count": "a"}, "INVALID_FIELD_TYPE"), ({"count": 7}, "COUNT_MISMATCH"), ({"type": 3}, "RESPONSE_TYPE_IGNORED"), ({"time": "25:00"}, "INVALID_SOURCE_TIME"),
])
def test_codes(spark, change, code):
    assert code in codes(spark, change)[0]


def test_persian_digits_and_missing_fields(spark):
    assert codes(spark, {"volume": "۱۲۳", "count": "+۱"}) == [[]]
    row = {k: v for k, v in ROW.items() if k != "low"}
    df = spark.createDataFrame([(json.dumps(row),)], "raw_payload string")
    assert [(x.code, x.field) for x in ingest.parse_rows(df).first().issues] == [("MISSING_FIELD", "low")]


def test_envelopes():
    assert len(ingest.decode_envelope(b'[{"a":1.50}]')) == 1
    assert ingest.decode_envelope(b'{"code_http":200,"successful":true,"status":"no_data","message_error":null}') == []
    with pytest.raises(ProviderError):
        ingest.decode_envelope(b'{"successful":false,"code_http":429}')
    for bad in (b"[]", b"[1]", b"3", b"{}", b"nope", b'[{"a":1,"a":2}]', b'[{"a":NaN}]', b"\xff"):
        with pytest.raises(ContractError):
            ingest.decode_envelope(bad)


def test_envelopes_as_columns(spark):
    ok = '{"code_http":200,"successful":true,"status":"no_data"%s}'
    bodies = ['[{"a":1.50},{}]', "[]", "[1]", "[{},null]", ok % "", ok % ',"message_error":null', ok % ',"message_error":"x"', ok.replace("200", "200.0") % "", '{"status":"no_data"}', '{"successful":false}', '{"status":"failed"}', '{"message_error":0}', "{}", "3", "null", "x", '{"a":1,"a":2}', None]
    got = ingest.decoded(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()
    kinds = {ProviderError: "PROVIDER_ERROR", ContractError: "CONTRACT_ERROR"}
    for body, r in zip(bodies, got):
        try:
            want = "ROWS" if ingest.decode_envelope((body or "").encode()) else "NO_DATA"
        except (ProviderError, ContractError) as e:
            want = kinds[type(e)]
        assert (body, r.outcome) == (body, want)
    assert got[0].raw_rows == ['{"a":1.5}', "{}"] or got[0].raw_rows == ['{"a":1.50}', "{}"]


@pytest.mark.parametrize("jalali, day", [("1403/01/01", date(2024, 3, 20)), ("1399-12-30", date(2021, 3, 20)), ("۱۴۰۰/۰۱/۰۱", date(2021, 3, 21)), ("1400/12/30", None), ("１４００／０１／０１", date(2021, 3, 21)), ("0001/01/01", date(622, 3, 21)), (None, None), ("1403/13/01", None), ("1403/1/1", None), ("1403-01/01", None)])
def test_jalali(spark, jalali, day):
    assert spark.createDataFrame([(jalali,)], "s string").select(text.jalali_date(F.col("s"))).first()[0] == day


def test_symbols(spark):
    raw = " ك  ي ۰۱٢ "
    assert spark.createDataFrame([(raw,)], "s string").select(text.normalize_symbol(F.col("s"))).first()[0] == text.normalize_symbol_text(raw) == "ک ی 012"


def test_duplicates(spark):
    df = spark.createDataFrame([(1, "a", "h", True), (2, "a", "h", True), (3, "b", "x", True), (4, "b", "y", True), (5, "c", "z", True), (6, "c", "q", False)], "n int, k string, h string, accepted boolean")
    got = {r.n: (r.duplicate_code, r.included) for r in ingest.apply_duplicate_policy(df, ["k"], "h", "n").collect()}
    assert got == {1: ("DUPLICATE_IDENTICAL", True), 2: ("DUPLICATE_IDENTICAL", False), 3: ("DUPLICATE_CONFLICT", False), 4: ("DUPLICATE_CONFLICT", False), 5: (None, True), 6: (None, False)}


def test_append_if_changed(spark):
    old = spark.createDataFrame([("a", 1, 1), ("a", 2, 2)], "k string, v int, revision_no int")
    new = spark.createDataFrame([("a", 2, 1), ("a", 3, 2), ("a", 3, 3), ("a", 2, 4), ("b", 9, 1), ("b", None, 2)], "k string, v int, n int")
    got = [(r.k, r.n, r.outcome, r.revision_no) for r in ingest.append_if_changed(old, new, ["k"], ["v"], ["n"]).orderBy("k", "n").collect()]
    assert got == [("a", 1, "UNCHANGED", 2), ("a", 2, "CORRECTED", 3), ("a", 3, "UNCHANGED", 3), ("a", 4, "CORRECTED", 4), ("b", 1, "INSERTED", 1), ("b", 2, "CORRECTED", 2)]


@pytest.mark.parametrize("other, overlaps", [((1, 5), False), ((5, 9), False), ((12, 20), False), ((20, None), False), ((8, 15), True), ((10, 11), True), ((9, 12), True), ((1, None), True)])
def test_overlap_matrix(spark, other, overlaps):
    day = lambda n: None if n is None else f"2030-01-{n:02d} 00:00:00"
    make = lambda rows: spark.createDataFrame([(k, i, day(a), day(b)) for k, i, (a, b) in rows], "key string, id int, a string, b string").selectExpr("key", "id", "CAST(a AS TIMESTAMP_NTZ) valid_from", "CAST(b AS TIMESTAMP_NTZ) valid_to")
    held = make([("k", 1, (9, 12)), ("z", 3, (1, None))])
    assert (temporal.rejected_proposals(make([("k", 2, other)]), held, ["key"]).count() == 1) == overlaps
    both = held.unionByName(make([("k", 2, other)]))
    assert (temporal.overlap_pairs(both, ["key"], "id").count() == 1) == overlaps
    assert (temporal.overlapping_rows(both, ["key"], "id").count() == 1) == overlaps


def test_a_first_price_equal_to_the_stored_one_changes_nothing(spark, tmp_path):
    """The stored bars of the query have a price of 0; as SQL knows no volume of theirs, that must not count as a change."""
    duckdb = pytest.importorskip("duckdb")
    rows = [(i, datetime(2024, 1, 1), i % 10, "view", 0.0 if i % 7 < 4 else 1.5, "{}") for i in range(2000)]
    spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string").write.parquet(f"{tmp_path}/events.parquet")
    names = ["batch_id", "event_id", "code", "outcome", "revision_no"]
    got = [tuple(r[c] for c in names) for r in governance.canonicalize_batch(spark, str(tmp_path)).collect()]
    with duckdb.connect() as c:
        c.execute(f"CREATE VIEW events AS SELECT * FROM '{tmp_path}/events.parquet/*.parquet'")
        want = c.execute(f"SELECT {', '.join(names)} FROM ({catalogue.ORACLES['canonicalize_batch']})").fetchall()
    assert sorted(got, key=repr) == sorted(want, key=repr)
    # revision 1 is a stored one here, so UNCHANGED with it repeats a stored price
    assert any(batch // 4 % 4 == 1 and (event % 29 + 1) <= 10 and outcome == "UNCHANGED" and n == 1 for batch, event, _, outcome, n in got)
