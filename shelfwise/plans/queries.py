"""Registered queries: one callable per operator, each ``(spark, sf_dir) ->
DataFrame`` over the test tables (see ``shelfwise.sources.fixtures``).

Every query runs over all rows of the tables it reads; the only ``limit`` is the
top-n of the recommendation feature itself, and the only row filter of the
fixtures routes sale lines to the company or to the competitors.  ``AS_OF`` pins "today" / "now" so that date
rules and ingestion stamps are reproducible.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.operators import clean, keyed, market, quality, recommend
from shelfwise.plans.storage import scratch_path, written_once
from shelfwise.schemas import (
    CATALOG_COLUMNS,
    COMPANY_COLUMNS,
    COMPETITOR_COLUMNS,
    COMPETITOR_KEYS,
    COMPETITOR_PRECOMBINE,
)
from shelfwise.sources.fixtures import Fixtures
from shelfwise.sources.io import csv_line, parse_lines

AS_OF = "2026-12-01"
TOP_N = 10
MERGE_EXISTING_BEFORE = "1998-01-01"
MERGE_INCOMING_FROM = "1997-01-01"

Query = Callable[[SparkSession, str], DataFrame]


# --------------------------------------------------------------- building blocks
def _fixtures(spark, sf_dir) -> Fixtures:
    return Fixtures(spark, sf_dir)


def _clean(spark, sf_dir, dataset):
    fx = _fixtures(spark, sf_dir)
    if dataset == quality.CATALOG_DATASET:
        return clean.clean_seller_catalog(fx.dirty_catalog())
    if dataset == quality.COMPANY_DATASET:
        return clean.clean_company_sales(fx.dirty_company())
    return clean.clean_competitor_sales(fx.dirty_competitor())


def _raw(spark, sf_dir, dataset):
    fx = Fixtures(spark, sf_dir)
    return {
        quality.CATALOG_DATASET: fx.dirty_catalog,
        quality.COMPANY_DATASET: fx.dirty_company,
        quality.COMPETITOR_DATASET: fx.dirty_competitor,
    }[dataset]()


def _tagged(spark, sf_dir, dataset):
    return quality.tag_quality(_clean(spark, sf_dir, dataset), quality.rules_for(dataset), AS_OF)


def _valid(spark, sf_dir, dataset):
    return keyed.stamp(quality.valid_rows(_tagged(spark, sf_dir, dataset)), AS_OF)


def _quarantine(spark, sf_dir, dataset):
    return quality.quarantine_rows(_tagged(spark, sf_dir, dataset), quality.rules_for(dataset), AS_OF)


def competitor_gold(competitor: DataFrame) -> DataFrame:
    """Competitor gold table: latest sale per (seller, item)."""
    return keyed.upsert_latest(competitor, COMPETITOR_KEYS, COMPETITOR_PRECOMBINE)


def _written_once(spark, df):
    return written_once(df, scratch_path(spark, "query"))


def _gold(fx):
    return fx.seller_catalog(), fx.company_sales(), competitor_gold(fx.competitor_sales())


def _top(spark, sf_dir):
    # The fixture catalog is grouped by (seller, item): one row per pair.
    fx = _fixtures(spark, sf_dir)
    cat, com, cmp = _gold(fx)
    top = market.compute_top_items(market.item_metrics(cat, com, cmp, catalog_is_keyed=True, tasks=fx.tasks()), TOP_N)
    return cat, _written_once(spark, top)


_DATASETS = (quality.CATALOG_DATASET, quality.COMPANY_DATASET, quality.COMPETITOR_DATASET)


# --------------------------------------------------------------------- queries
def _bronze(raw, columns):
    """The feed written as CSV lines and parsed as a bronze file is."""
    return parse_lines(raw.select(csv_line(*columns).alias("line")), "line", columns)


def q_bronze_parse_catalog(spark, sf_dir):
    return _bronze(_raw(spark, sf_dir, quality.CATALOG_DATASET), CATALOG_COLUMNS)


def q_bronze_parse_company(spark, sf_dir):
    return _bronze(_raw(spark, sf_dir, quality.COMPANY_DATASET), COMPANY_COLUMNS)


def q_bronze_parse_competitor(spark, sf_dir):
    return _bronze(_raw(spark, sf_dir, quality.COMPETITOR_DATASET), COMPETITOR_COLUMNS)


def q_clean_catalog(spark, sf_dir):
    return _clean(spark, sf_dir, quality.CATALOG_DATASET)


def q_clean_company_sales(spark, sf_dir):
    return _clean(spark, sf_dir, quality.COMPANY_DATASET)


def q_clean_competitor_sales(spark, sf_dir):
    return _clean(spark, sf_dir, quality.COMPETITOR_DATASET)


def q_dq_valid_catalog(spark, sf_dir):
    return _valid(spark, sf_dir, quality.CATALOG_DATASET)


def q_dq_valid_company(spark, sf_dir):
    return _valid(spark, sf_dir, quality.COMPANY_DATASET)


def q_dq_valid_competitor(spark, sf_dir):
    return _valid(spark, sf_dir, quality.COMPETITOR_DATASET)


def q_quarantine_catalog(spark, sf_dir):
    return _quarantine(spark, sf_dir, quality.CATALOG_DATASET)


def q_quarantine_company(spark, sf_dir):
    return _quarantine(spark, sf_dir, quality.COMPANY_DATASET)


def q_quarantine_competitor(spark, sf_dir):
    return _quarantine(spark, sf_dir, quality.COMPETITOR_DATASET)


def q_dq_metrics(spark, sf_dir):
    out = None
    for ds in _DATASETS:
        raw = None if ds == quality.COMPETITOR_DATASET else _raw(spark, sf_dir, ds)  # whose cleaning keeps every row
        one = quality.load_counts(_tagged(spark, sf_dir, ds), raw).select(F.lit(ds).alias("dataset_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def q_dq_reason_counts(spark, sf_dir):
    out = None
    for ds in _DATASETS:
        one = quality.reason_counts(_tagged(spark, sf_dir, ds)).select(F.lit(ds).alias("dataset_name"), "*")
        out = one if out is None else out.unionByName(one)
    return out


def q_upsert_latest_competitor(spark, sf_dir):
    return competitor_gold(Fixtures(spark, sf_dir).competitor_sales())


def q_upsert_merge_existing(spark, sf_dir):
    cs = Fixtures(spark, sf_dir).competitor_sales()
    existing = competitor_gold(cs.filter(F.col("sale_date") < F.lit(MERGE_EXISTING_BEFORE).cast("date")))
    incoming = cs.filter(F.col("sale_date") >= F.lit(MERGE_INCOMING_FROM).cast("date")).withColumn(
        "channel", F.lit("marketplace")
    )
    return keyed.upsert_latest(incoming, COMPETITOR_KEYS, COMPETITOR_PRECOMBINE, existing=existing)


def q_item_dimension(spark, sf_dir):
    fx = _fixtures(spark, sf_dir)
    return market.build_item_dimension(fx.seller_catalog(), fx.tasks())


def q_company_metrics(spark, sf_dir):
    return market.build_company_metrics(Fixtures(spark, sf_dir).company_sales())


def q_competitor_metrics(spark, sf_dir):
    _, _, cmp = _gold(_fixtures(spark, sf_dir))
    return market.build_competitor_metrics(cmp)


def q_seller_item_counts(spark, sf_dir):
    return market.build_seller_item_counts(Fixtures(spark, sf_dir).seller_catalog())


def q_sales_full_outer(spark, sf_dir):
    _, com, cmp = _gold(_fixtures(spark, sf_dir))
    return market.merge_sales(market.build_company_metrics(com), market.build_competitor_metrics(cmp))


def q_item_metrics(spark, sf_dir):
    fx = _fixtures(spark, sf_dir)
    cat, com, cmp = _gold(fx)
    return market.build_item_metrics(
        market.build_item_dimension(cat, fx.tasks()), market.build_company_metrics(com),
        market.build_competitor_metrics(cmp), market.build_seller_item_counts(cat),
    )


def q_item_metrics_fused(spark, sf_dir):
    fx = _fixtures(spark, sf_dir)
    return market.item_metrics(*_gold(fx), tasks=fx.tasks())


def q_item_metrics_keyed(spark, sf_dir):
    fx = _fixtures(spark, sf_dir)
    return market.item_metrics(*_gold(fx), catalog_is_keyed=True, tasks=fx.tasks())


def q_market_price(spark, sf_dir):
    fx = _fixtures(spark, sf_dir)
    cat, com, cmp = _gold(fx)
    m = market.sales_by_item(com, cmp).join(market.catalog_item_profile(cat, tasks=fx.tasks()), "item_id", "inner")
    m = market._sales_measures(m).withColumn("market_price", market.resolve_market_price())
    return m.select("item_id", "competitor_avg_price", "company_price_estimate", "catalog_price", "market_price")


def q_top_items(spark, sf_dir):
    fx = _fixtures(spark, sf_dir)
    cat, com, cmp = _gold(fx)
    return market.compute_top_items(market.item_metrics(cat, com, cmp, catalog_is_keyed=True, tasks=fx.tasks()), TOP_N)


def q_top_items_pruned(spark, sf_dir):
    fx = _fixtures(spark, sf_dir)
    cat, com, cmp = _gold(fx)
    sold = market.sold_catalog(cat, com, cmp)
    return market.compute_top_items(market.item_metrics(sold, com, cmp, catalog_is_keyed=True, tasks=fx.tasks()), TOP_N)


def q_candidate_pairs(spark, sf_dir):
    cat, top = _top(spark, sf_dir)
    return recommend.seller_top_pairs(cat, top, exclude_listed=False).select("seller_id", "item_id")


def q_missing_pairs(spark, sf_dir):
    cat, top = _top(spark, sf_dir)
    return recommend.seller_top_pairs(cat, top, exclude_listed=True).select("seller_id", "item_id")


def q_recommendations(spark, sf_dir):
    cat, top = _top(spark, sf_dir)
    return recommend.build_recommendations(cat, top)


def q_recommendations_uncollapsed(spark, sf_dir):
    fx = Fixtures(spark, sf_dir)
    cat = fx.seller_catalog()
    top = market.compute_top_items(market.item_metrics(cat, fx.company_sales(), fx.competitor_sales(), tasks=fx.tasks()), TOP_N)
    return recommend.build_recommendations(cat, _written_once(spark, top))


def q_recommendations_from_raw(spark, sf_dir):
    """Dirty feeds -> clean -> quality split -> gold tables -> recommendations.

    The valid catalog feeds the top list and the sellers, so it is written once to
    the shared scratch folder."""
    cat = _written_once(spark, _valid(spark, sf_dir, quality.CATALOG_DATASET))
    com = _valid(spark, sf_dir, quality.COMPANY_DATASET)
    cmp = competitor_gold(_valid(spark, sf_dir, quality.COMPETITOR_DATASET))
    # Cleaning deduplicates the catalog on (seller_id, item_id).
    tasks = _fixtures(spark, sf_dir).tasks()
    top = market.compute_top_items(market.item_metrics(cat, com, cmp, catalog_is_keyed=True, tasks=tasks), TOP_N)
    return recommend.build_recommendations(cat, _written_once(spark, top))


QUERIES: dict[str, Query] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
