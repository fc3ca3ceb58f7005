"""Property tests over random small feeds (hypothesis)."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from conftest import rows
from shelfwise.operators import clean_competitor_sales, dq_split, upsert_latest
from shelfwise.operators.market import compute_top_items, item_metrics
from shelfwise.operators.quality import COMPETITOR_RULES
from shelfwise.operators.recommend import build_recommendations

_txt = st.one_of(st.none(), st.sampled_from(["", " ", "1", "-2", "3.5", "x", " 4 ", "NaN"]))
_date = st.one_of(st.none(), st.sampled_from(["2024-01-05", "bad", "9999-01-01", " 2024-1-5"]))
_id = st.one_of(st.none(), st.sampled_from(["S1", "S2", " S1", "S3"]))
_item = st.one_of(st.none(), st.sampled_from(["I1", "I2", "I3 "]))
_row = st.tuples(_id, _item, _txt, _txt, _txt, _date)
SCHEMA = "seller_id string, item_id string, units_sold string, revenue string, marketplace_price string, sale_date string"
SET = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SET
@given(st.lists(_row, max_size=25))
def test_split_is_a_partition_and_gold_keys_unique(spark, data):
    df = clean_competitor_sales(spark.createDataFrame(data, SCHEMA))
    valid, bad = dq_split(df, COMPETITOR_RULES, "2026-12-01")
    assert valid.count() + bad.count() == len(data)
    gold = upsert_latest(valid, ["seller_id", "item_id"], "sale_date")
    assert gold.count() == gold.select("seller_id", "item_id").distinct().count()
    assert gold.count() == valid.select("seller_id", "item_id").distinct().count()


_pair = st.tuples(st.sampled_from(["S1", "S2", "S3", "S4"]), st.sampled_from([f"I{i}" for i in range(8)]))
_sale = st.tuples(st.sampled_from([f"I{i}" for i in range(8)]), st.integers(0, 9), st.integers(0, 40))


@SET
@given(st.lists(_pair, min_size=1, max_size=20, unique=True), st.lists(_sale, max_size=20), st.integers(1, 5))
def test_recommendation_invariants(spark, pairs, sales, n):
    cat = spark.createDataFrame([(s, i, i, "c", 1.0, 1) for s, i in pairs],
                                "seller_id string, item_id string, item_name string, category string, "
                                "marketplace_price double, stock_qty int")
    com = spark.createDataFrame([(i, u, float(r)) for i, u, r in sales], "item_id string, units_sold int, revenue double")
    cmp = spark.createDataFrame([], "seller_id string, item_id string, units_sold int, revenue double, "
                                    "marketplace_price double")
    top = compute_top_items(item_metrics(cat, com, cmp), n)
    top_ids = [r["item_id"] for r in top.collect()]
    recs = rows(build_recommendations(cat, top), "seller_id", "item_id")
    sellers = {s for s, _ in pairs}
    listed = set(pairs)
    assert set(recs) == {(s, i) for s in sellers for i in top_ids if (s, i) not in listed}
    assert len(recs) == len(sellers) * len(top_ids) - len([p for p in listed if p[1] in top_ids])
    one_part = rows(build_recommendations(cat.coalesce(1), top), "seller_id", "item_id")
    assert one_part == recs


def test_result_independent_of_partitioning(spark):
    from conftest import SF001
    from shelfwise.plans.queries import q_recommendations

    base = rows(q_recommendations(spark, SF001))
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        assert rows(q_recommendations(spark, SF001)) == base
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
