"""Physical-plan checks: the shapes that matter at scale."""

from pyspark.sql import functions as F

from conftest import SF001
from shelfwise.operators import clean, keyed, market, quality, recommend
from shelfwise.plans import queries as Q
from shelfwise.sources import fixtures
from shelfwise.sources.fixtures import Fixtures


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _optimized(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_recommendations_have_no_cartesian_or_nested_loop_join(spark):
    p = _plan(Q.q_recommendations(spark, SF001))
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in p
    assert "Generate" in p  # chunks of the top list, exploded per seller


def test_recommendations_are_lazy(spark):
    """Building recommendations over given frames runs no job; only the top list
    that the registered queries pass in is written ahead."""
    cat, top = Q._top(spark, SF001)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("lazy", "plan only")
    recommend.build_recommendations(cat, top)
    jobs = tracker.getJobIdsForGroup("lazy")
    spark.sparkContext.setJobGroup("rest", "")
    assert len(jobs) == 0


def test_dq_metrics_derive_each_feed_once(spark):
    p = _plan(Q.q_dq_metrics(spark, SF001))
    # one derivation per feed, and one without a text column to count the raw rows of the two feeds
    # that cleaning deduplicates; their relations read the table twice themselves
    assert p.count("lineitem.parquet") == 5 + 4


def test_merge_reads_each_side_once(spark):
    p = _plan(Q.q_upsert_merge_existing(spark, SF001))
    assert p.count("FileScan parquet") == 2 and p.count("Exchange hashpartitioning") <= 3


def test_top_items_is_a_top_k_not_a_global_sort(spark):
    p = _plan(Q.q_top_items(spark, SF001))
    assert "TakeOrderedAndProject" in p


def test_upsert_cuts_keys_before_the_shuffle(spark):
    p = _plan(Q.q_upsert_latest_competitor(spark, SF001))
    assert "WindowGroupLimit" in p and "Partial" in p


def test_fused_metrics_join_reuses_aggregate_partitioning(spark):
    fx = Fixtures(spark, SF001)
    m = market.item_metrics(spark.read.parquet(f"{SF001}/part.parquet").select(
        F.col("p_partkey").cast("string").alias("seller_id"), F.col("p_partkey").cast("string").alias("item_id"),
        F.col("p_name").alias("item_name"), F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("marketplace_price")), fx.company_sales(), fx.competitor_sales())
    p = _plan(m)
    # sales aggregate (1) + catalog distinct-count aggregate (2) + the fixtures' own
    # aggregate (1); the join itself adds no exchange.
    stepwise = market.build_item_metrics(
        market.build_item_dimension(fx.seller_catalog()), market.build_company_metrics(fx.company_sales()),
        market.build_competitor_metrics(fx.competitor_sales()), market.build_seller_item_counts(fx.seller_catalog()))
    assert p.count("Exchange hashpartitioning") < _plan(stepwise).count("Exchange hashpartitioning")


def test_hot_seller_is_combined_map_side(spark):
    rows = [("HOT", f"I{i}") for i in range(300)] + [(f"S{i}", f"I{i}") for i in range(600)]
    cat = spark.createDataFrame(rows, "seller_id string, item_id string").repartition(4)
    top = spark.createDataFrame([(f"I{i}", "n", "c", 1.0, 1.0, 1.0, 1.0) for i in range(5)],
                                "item_id string, item_name string, category string, market_price double, "
                                "expected_units_sold double, expected_revenue double, total_units_sold double")
    recs = recommend.build_recommendations(cat, top)
    assert "keys=[seller_id" in _plan(recs)  # sellers are a distinct, combined before the shuffle
    assert recs.filter("seller_id = 'HOT'").count() == 0


def test_top_list_is_computed_once(spark):
    """The metrics (their demand filter) are no part of the recommendations' plan."""
    plan = _optimized(Q.q_recommendations(spark, SF001))
    assert "total_units_sold" not in plan.split("Relation")[0] and plan.count("expected_revenue") > 0
    assert "TakeOrderedAndProject" not in _plan(Q.q_recommendations(spark, SF001)) and "GlobalLimit" not in plan


def test_counts_use_no_sort_based_aggregate(spark):
    raw = spark.createDataFrame([("S1", "I1", "n", "c", "1", "2")] * 3 + [("S1", "I2", "n", None, "1", "2")],
                                "seller_id string, item_id string, item_name string, category string, marketplace_price string, stock_qty string")
    counts = quality.load_counts(quality.tag_quality(clean.clean_seller_catalog(raw), quality.CATALOG_RULES, "2026-12-01"), raw)
    assert tuple(counts.first()) == (4, 2, 1, 1)
    assert "SortAggregate" not in _plan(counts) and "WindowGroupLimit" in _plan(counts)


def test_quality_filter_stays_above_cleaning(spark):
    df = Q.q_dq_valid_competitor(spark, SF001)
    opt = _optimized(df)
    assert "CollectMetrics" in opt
    filter_part = opt[: opt.index("CollectMetrics")]
    assert "regexp_extract" not in filter_part


def test_filters_and_columns_reach_the_parquet_scan(spark):
    p = _plan(Fixtures(spark, SF001).competitor_sales().select("item_id"))
    pushed = p[p.index("PushedFilters: ["):]
    pushed = pushed[: pushed.index("]")]
    assert "Not(EqualTo(l_returnflag,N))" in pushed
    assert "ReadSchema: struct<l_partkey:bigint,l_returnflag:string>" in p


def test_observed_tagging_can_feed_both_branches_of_one_plan(spark):
    tagged = quality.tag_quality(
        spark.createDataFrame([("I1", 1, 1.0, None)], "item_id string, units_sold int, revenue double, sale_date date"),
        quality.COMPANY_RULES, "2026-12-01")
    both = quality.valid_rows(tagged).select("item_id").unionByName(
        quality.quarantine_rows(tagged, quality.COMPANY_RULES, "2026-12-01").select("item_id"))
    assert both.count() == 1
    assert keyed.dedup_keys(both, ["item_id"]).count() == 1


def test_catalog_tasks_follow_the_lines(spark, monkeypatch):
    """One task groups so many lines, however large the table and whatever the session's partitions."""
    rows = lambda: sorted(map(tuple, Fixtures(spark, SF001).seller_catalog().collect()))
    lines, before = spark.read.parquet(f"{SF001}/lineitem.parquet").count(), rows()
    monkeypatch.setattr(fixtures, "TASK_LINES", 500)
    p = _plan(market.build_item_dimension(Fixtures(spark, SF001).seller_catalog()))
    assert f"{-(-lines // 500)}), REPARTITION_BY_NUM" in p
    assert "Aggregate" not in p[p.index("REPARTITION_BY_NUM"):].split("lineitem.parquet")[0]  # nothing is held before the shuffle
    assert rows() == before


def test_item_profile_tasks_follow_the_lines(spark, monkeypatch):
    """Texts and sellers of the catalog are grouped by item in tasks of bounded size, not in the session's partitions."""
    monkeypatch.setattr(fixtures, "TASK_LINES", 500)
    tasks = Fixtures(spark, SF001).tasks()
    p = _plan(Q.q_item_metrics_fused(spark, SF001))
    dealt = [x for x in p.split("\n") if "Exchange hashpartitioning" in x and ("REPARTITION_BY_NUM" in x or "item_id" in x and "seller_id" not in x)]
    assert sum(f", {tasks}), REPARTITION_BY_NUM" in x for x in dealt) == 3  # lines, an item's groups of sellers, items
    assert sum("item_id" in x and "REPARTITION_BY_NUM" not in x for x in dealt) == 1  # the sales
