from conftest import rows
from shelfwise.operators.market import (
    build_company_metrics,
    build_competitor_metrics,
    build_item_dimension,
    build_item_metrics,
    build_seller_item_counts,
    compute_top_items,
    item_metrics,
)

CAT = "seller_id string, item_id string, item_name string, category string, marketplace_price double, stock_qty int"
COM = "item_id string, units_sold int, revenue double"
CMP = "seller_id string, item_id string, units_sold int, revenue double, marketplace_price double"


def _both(cat, com, cmp):
    stepwise = build_item_metrics(build_item_dimension(cat), build_company_metrics(com),
                                  build_competitor_metrics(cmp), build_seller_item_counts(cat))
    fused = item_metrics(cat, com, cmp)
    assert stepwise.columns == fused.columns
    a, b = rows(stepwise), rows(fused)
    assert a == b
    return {r[0]: dict(zip(stepwise.columns, r)) for r in a}


def test_market_price_priority_and_filters(spark):
    cat = spark.createDataFrame([
        ("S1", "A", "a", "c", 1.0, 1),   # competitor avg 5 -> 5
        ("S1", "B", "b", "c", 1.0, 1),   # competitor avg 0, company 100/4 -> 25
        ("S1", "C", "c", "c", 7.0, 1),   # competitor none, company 0/4 -> catalog 7
        ("S2", "C", "c", "c", 7.0, 1),
        ("S1", "D", "d", "c", 0.0, 1),   # every price 0 -> dropped
        ("S1", "E", "e", "c", 3.0, 1),   # no sales -> dropped
        ("S1", "G", None, None, 2.0, 1),  # unnamed item stays in metrics
    ], CAT)
    com = spark.createDataFrame([("B", 4, 100.0), ("C", 4, 0.0), ("D", 1, 0.0), ("Z", 9, 9.0),
                                 (None, 5, 5.0), ("G", 1, 4.0)], COM)
    cmp = spark.createDataFrame([("X", "A", 2, 10.0, 5.0), ("X", "B", 1, 0.0, 0.0), ("X", "D", 1, 0.0, 0.0),
                                 ("X", None, 3, 3.0, 3.0)], CMP)
    m = _both(cat, com, cmp)
    assert set(m) == {"A", "B", "C", "G"}
    assert m["A"]["market_price"] == 5.0 and m["A"]["company_units_sold"] == 0.0
    assert m["B"]["market_price"] == 25.0 and m["B"]["total_units_sold"] == 5.0
    assert m["C"]["market_price"] == 7.0 and m["C"]["company_price_estimate"] == 0.0
    assert m["C"]["seller_count"] == 2 and m["C"]["expected_units_sold"] == 2.0
    assert m["C"]["expected_revenue"] == 14.0
    assert m["A"]["competitor_avg_price"] == 5.0 and m["C"]["competitor_avg_price"] is None


def test_first_name_by_smallest_seller_and_null_seller_count(spark):
    cat = spark.createDataFrame([
        ("S2", "A", "Second", "Cat2", 4.0, 1),
        ("S1", "A", None, "Cat1", 2.0, 1),
        ("S3", "A", "Third", None, None, 1),
    ], CAT)
    dim = {r["item_id"]: r for r in build_item_dimension(cat).collect()}
    assert dim["A"]["item_name"] == "Second" and dim["A"]["category"] == "Cat1"
    assert dim["A"]["catalog_price"] == 3.0
    assert build_seller_item_counts(cat).collect()[0]["seller_count"] == 3


def test_top_items_ties_and_short_lists(spark):
    cat = spark.createDataFrame([("S", i, i, "c", 1.0, 1) for i in ("I3", "I1", "I2", "I4")], CAT)
    com = spark.createDataFrame([("I3", 5, 5.0), ("I1", 5, 5.0), ("I2", 9, 9.0), ("I4", 1, 1.0)], COM)
    cmp = spark.createDataFrame([], CMP)
    m = item_metrics(cat, com, cmp)
    assert [r["item_id"] for r in compute_top_items(m, 2).collect()] == ["I2", "I1"]
    assert [r["item_id"] for r in compute_top_items(m, 10).collect()] == ["I2", "I1", "I3", "I4"]


def test_first_name_deterministic_for_repeated_pairs(spark):
    cat = spark.createDataFrame([
        ("S1", "A", "Zeta", "c", 1.0, 1),
        ("S1", "A", "Alpha", "c", 1.0, 1),
        ("S2", "A", "Beta", "c", 1.0, 1),
    ], CAT)
    for parts in (1, 3):
        dim = build_item_dimension(cat.repartition(parts)).collect()[0]
        assert dim["item_name"] == "Alpha"
    assert build_seller_item_counts(cat).collect()[0]["seller_count"] == 2


def test_sold_catalog_gives_the_same_metrics(spark):
    from shelfwise.operators.market import sold_catalog

    cat = spark.createDataFrame([("S", f"I{i}", f"n{i}", "c", 1.0, 1) for i in range(20)] + [("S", None, "x", "c", 1.0, 1)], CAT)
    com = spark.createDataFrame([(f"I{i}", 100 - i, 0.0) for i in range(6)] + [(None, 3, 1.0)], COM)
    cmp = spark.createDataFrame([("X", "I9", 100, 50.0, 0.5)], CMP)
    sold = sold_catalog(cat, com, cmp)
    assert sold.count() == 7
    assert rows(item_metrics(sold, com, cmp)) == rows(item_metrics(cat, com, cmp))


def test_top_items_with_integer_ids(spark):
    cat = spark.createDataFrame([(1, i, f"n{i}", "c", 1.0, 1) for i in range(5)], CAT.replace("_id string", "_id long"))
    com = spark.createDataFrame([(i, i + 1, 1.0) for i in range(5)], COM.replace("item_id string", "item_id long"))
    cmp = spark.createDataFrame([], CMP.replace("_id string", "_id long"))
    assert [r["item_id"] for r in compute_top_items(item_metrics(cat, com, cmp), 2).collect()] == [4, 3]


def test_item_profile_over_groups_of_sellers(spark):
    """An item with more sellers than groups, NULL sellers and repeated pairs: the same in any number of tasks."""
    from shelfwise.operators.market import catalog_item_profile

    listed = [(f"S{i:02}", "A", None if i < 5 else f"n{i}", None if i < 9 else f"c{i}", float(i), 1) for i in range(40)]
    cat = spark.createDataFrame(listed + listed[:3] + [(None, "A", "late", "late", None, 1), (None, "B", "b", None, None, 1),
                                                       ("S1", None, "x", "x", 1.0, 1)], CAT)
    for tasks in (None, 1, 7):
        got = {r["item_id"]: tuple(r)[1:] for r in catalog_item_profile(cat, tasks=tasks).collect()}
        assert got == {"A": ("late", "late", 783 / 43, 40), "B": ("b", None, None, 0)}
        assert catalog_item_profile(cat, True, tasks).filter("item_id = 'A'").first()["seller_count"] == 43
