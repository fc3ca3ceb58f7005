import datetime as dt
import math

from conftest import rows
from shelfwise.functions import title_case
from shelfwise.operators import clean_company_sales, clean_competitor_sales, clean_seller_catalog

CAT = "seller_id string, item_id string, item_name string, category string, marketplace_price string, stock_qty string"
COM = "item_id string, units_sold string, revenue string, sale_date string"
CMP = "seller_id string, item_id string, units_sold string, revenue string, marketplace_price string, sale_date string"


def test_title_case_and_trim(spark):
    df = spark.createDataFrame([("o'neil-smith WIRELESS  mouse(usb)",), ("\tx y",), (None,)], "s string")
    got = [r[0] for r in df.select(title_case("s")).collect()]
    assert got == ["O'neil-smith Wireless  Mouse(usb)", "\tx Y", None]


def test_clean_catalog_types_fill_and_dedup(spark):
    df = spark.createDataFrame([
        ("  S1 ", " I1", " red WIDGET ", "tools", "10.5", None),
        ("S1", "I1", "Red Widget", "tools", "9.0", "3"),  # same key after trim: smaller price wins
        ("S2", "I1", None, None, "n/a", "many"),
        ("  ", "I2", "x", "y", "-1", "-3"),
    ], CAT)
    out = clean_seller_catalog(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string"] * 4 + ["double", "int"]
    assert rows(out) == sorted([
        ("S1", "I1", "Red Widget", "Tools", 9.0, 3),
        ("S2", "I1", None, None, None, 0),
        ("", "I2", "X", "Y", -1.0, -3),
    ], key=repr)


def test_clean_company_dedup_on_item_only(spark):
    df = spark.createDataFrame([
        (" I1 ", "5", "10.0", " 2024-01-05"),
        ("I1", "3", "12.0", "2024-01-06"),
        (None, "1", "1", "2024-01-01"),
        (None, "2", "NaN", "bad"),
        ("I2", "x", None, "2024-1-5 10:00"),
    ], COM)
    out = clean_company_sales(df)
    assert rows(out) == sorted([
        ("I1", 3, 12.0, dt.date(2024, 1, 6)),
        (None, 1, 1.0, dt.date(2024, 1, 1)),
        ("I2", 0, 0.0, dt.date(2024, 1, 5)),
    ], key=repr)


def test_clean_competitor_keeps_every_row_and_fills_nan(spark):
    df = spark.createDataFrame([
        ("S1", "I1", "2", "NaN", None, "2024-01-05"),
        ("S1", "I1", "2", "NaN", None, "2024-01-05"),
        ("S2 ", " I2", "1.9", "3", "free", "9999-12-31"),
    ], CMP)
    out = clean_competitor_sales(df)
    got = rows(out)
    assert len(got) == 3
    assert ("S2", "I2", 1, 3.0, 0.0, dt.date(9999, 12, 31)) in got
    assert all(not math.isnan(r[3]) for r in got)
