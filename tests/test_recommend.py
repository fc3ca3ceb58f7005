from conftest import SF001, rows
from shelfwise.operators.recommend import build_recommendations, seller_top_pairs
from shelfwise.plans.queries import _top

TOP = ("item_id string, item_name string, category string, market_price double, "
       "expected_units_sold double, expected_revenue double, total_units_sold double")


def _top_df(spark, ids):
    return spark.createDataFrame([(i, f"n{i}", "c", 2.0, 3.0, 6.0, 9.0) for i in ids], TOP)


def test_sellers_listing_all_none_some(spark):
    cat = spark.createDataFrame([("S1", "A"), ("S1", "B"), ("S2", "Z"), ("S3", "A")], "seller_id string, item_id string")
    top = _top_df(spark, ["A", "B"])
    recs = build_recommendations(cat, top)
    assert recs.columns == ["seller_id", "item_id", "item_name", "category", "market_price",
                            "expected_units_sold", "expected_revenue"]
    assert rows(recs, "seller_id", "item_id") == [("S2", "A"), ("S2", "B"), ("S3", "B")]


def test_null_seller_keeps_every_item(spark):
    cat = spark.createDataFrame([(None, "A"), ("S1", "A")], "seller_id string, item_id string")
    recs = build_recommendations(cat, _top_df(spark, ["A"]))
    assert rows(recs, "seller_id", "item_id") == [(None, "A")]


def test_empty_top_list(spark):
    cat = spark.createDataFrame([("S1", "A")], "seller_id string, item_id string")
    assert build_recommendations(cat, _top_df(spark, [])).count() == 0


def test_pairs_do_not_depend_on_the_number_of_chunks(spark):
    cat = spark.createDataFrame([(f"S{s}", f"I{i}") for s in range(7) for i in range(0, 30, s + 1)],
                                "seller_id string, item_id string")
    top = _top_df(spark, [f"I{i}" for i in range(25)])
    one = rows(build_recommendations(cat, top))
    many = rows(build_recommendations(cat, top, top_n=5_000))
    assert one == many and len(one) == 7 * 25 - cat.filter("cast(substr(item_id, 2) as int) < 25").count()
    assert seller_top_pairs(cat, top, exclude_listed=False, top_n=3_000).count() == 7 * 25


def test_null_top_item_is_dropped(spark):
    cat = spark.createDataFrame([("S1", "A"), ("S2", None)], "seller_id string, item_id string")
    for n in (10, 5_000):
        recs = build_recommendations(cat, _top_df(spark, ["A", None]), top_n=n)
        assert rows(recs, "seller_id", "item_id") == [("S2", "A")]


def test_integer_ids(spark):
    cat = spark.createDataFrame([(1, 10), (2, 20), (None, 10)], "seller_id long, item_id int")
    top = spark.createDataFrame([(10, "n", "c", 1.0, 1.0, 1.0, 1.0), (30, "m", "c", 1.0, 1.0, 1.0, 1.0)],
                                TOP.replace("item_id string", "item_id int"))
    assert rows(build_recommendations(cat, top), "seller_id", "item_id") == sorted(
        [(1, 30), (2, 10), (2, 30), (None, 10), (None, 30)], key=repr)


def test_flagship_counts_sf0001(spark):
    cat, top = _top(spark, SF001)
    recs = build_recommendations(cat, top)
    got = recs.collect()
    assert len(got) == 12 and len({r["seller_id"] for r in got}) == 9
    listed = {(r["seller_id"], r["item_id"]) for r in cat.collect()}
    assert not any((r["seller_id"], r["item_id"]) in listed for r in got)


def test_details_are_exact(spark):
    import math

    tricky = [
        ("I'1", "it's \\ \"quoted\"", "Ünïcødé ✓", 0.1, 1e-300, 1.7976931348623157e308, 123456789.123456789),
        ("I2", None, "c", float("nan"), float("inf"), float("-inf"), -0.0),
    ]
    top = spark.createDataFrame(tricky, TOP)
    cat = spark.createDataFrame([("S1", "Z")], "seller_id string, item_id string")
    got = {r["item_id"]: r for r in build_recommendations(cat, top).collect()}
    assert set(got) == {"I'1", "I2"}
    a = got["I'1"]
    assert (a["item_name"], a["category"]) == ("it's \\ \"quoted\"", "Ünïcødé ✓")
    assert (a["market_price"], a["expected_units_sold"], a["expected_revenue"]) == (0.1, 1e-300, 1.7976931348623157e308)
    b = got["I2"]
    assert b["item_name"] is None and math.isnan(b["market_price"])
    assert (b["expected_units_sold"], b["expected_revenue"]) == (math.inf, -math.inf)
