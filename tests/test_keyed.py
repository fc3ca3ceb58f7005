import datetime as dt

from conftest import rows
from shelfwise.operators.keyed import dedup_keys, stamp, upsert_latest

D = dt.date
SCHEMA = "seller_id string, item_id string, units_sold int, revenue double, sale_date date"


def test_dedup_keeps_smallest_row_nulls_last_and_groups_null_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "z"), ("a", "b"), (None, "x"), (None, "c")], "k string, v string")
    assert rows(dedup_keys(df, ["k"])) == sorted([("a", "b"), (None, "c")], key=repr)


def test_latest_wins_and_tie_break(spark):
    inc = spark.createDataFrame([
        ("S1", "I1", 5, 5.0, D(2024, 1, 1)), ("S1", "I1", 9, 9.0, D(2024, 2, 1)),
        ("S1", "I1", 3, 3.0, D(2024, 2, 1)), ("S2", "I1", 1, 1.0, D(2023, 1, 1)),
    ], SCHEMA)
    out = upsert_latest(inc, ["seller_id", "item_id"], "sale_date")
    assert rows(out) == sorted([("S1", "I1", 3, 3.0, D(2024, 2, 1)), ("S2", "I1", 1, 1.0, D(2023, 1, 1))], key=repr)


def test_merge_with_existing_schema_evolution_and_idempotence(spark):
    existing = spark.createDataFrame([
        ("S1", "I1", 1, 1.0, D(2024, 3, 1)),   # newer than incoming: stays
        ("S2", "I2", 2, 2.0, D(2024, 1, 1)),   # older: replaced
        ("S3", "I3", 3, 3.0, D(2024, 1, 1)),   # untouched key
    ], SCHEMA)
    inc = spark.createDataFrame([
        ("S1", "I1", 7, 7.0, D(2024, 2, 1), "web"),
        ("S2", "I2", 8, 8.0, D(2024, 2, 1), "web"),
        ("S4", "I4", 9, 9.0, D(2024, 2, 1), "app"),
    ], SCHEMA + ", channel string")
    keys = ["seller_id", "item_id"]
    out = upsert_latest(inc, keys, "sale_date", existing=existing)
    assert sorted(out.columns) == sorted(existing.columns + ["channel"])
    cols = ["seller_id", "item_id", "units_sold", "sale_date", "channel"]
    want = sorted([
        ("S1", "I1", 1, D(2024, 3, 1), None),
        ("S2", "I2", 8, D(2024, 2, 1), "web"),
        ("S3", "I3", 3, D(2024, 1, 1), None),
        ("S4", "I4", 9, D(2024, 2, 1), "app"),
    ], key=repr)
    assert rows(out, *cols) == want
    again = upsert_latest(inc, keys, "sale_date", existing=out)
    assert rows(again, *cols) == want


def test_equal_precombine_incoming_wins(spark):
    existing = spark.createDataFrame([("S1", "I1", 1, 1.0, D(2024, 1, 1))], SCHEMA)
    inc = spark.createDataFrame([("S1", "I1", 9, 9.0, D(2024, 1, 1))], SCHEMA)
    out = upsert_latest(inc, ["seller_id", "item_id"], "sale_date", existing=existing)
    assert rows(out, "units_sold") == [(9,)]


def test_stamp_fixed_and_current(spark):
    df = spark.createDataFrame([(1,)], "x int")
    assert stamp(df, "2026-12-01").collect()[0]["ingestion_timestamp"] == dt.datetime(2026, 12, 1)
    assert stamp(df).collect()[0]["ingestion_timestamp"] is not None
