from shelfwise.operators.clean import clean_company_sales, clean_competitor_sales, clean_seller_catalog
from shelfwise.operators.keyed import dedup_keys, stamp, upsert_latest
from shelfwise.operators.market import (
    build_company_metrics,
    build_competitor_metrics,
    build_item_dimension,
    build_item_metrics,
    build_seller_item_counts,
    compute_top_items,
    item_metrics,
)
from shelfwise.operators.quality import (
    CATALOG_RULES,
    COMPANY_RULES,
    COMPETITOR_RULES,
    dq_split,
    quarantine_rows,
    reason_counts,
    tag_quality,
    valid_rows,
)
from shelfwise.operators.recommend import build_recommendations, seller_top_pairs

__all__ = [
    "clean_seller_catalog", "clean_company_sales", "clean_competitor_sales",
    "dedup_keys", "stamp", "upsert_latest",
    "build_item_dimension", "build_company_metrics", "build_competitor_metrics",
    "build_seller_item_counts", "build_item_metrics", "item_metrics", "compute_top_items",
    "CATALOG_RULES", "COMPANY_RULES", "COMPETITOR_RULES", "dq_split", "tag_quality",
    "valid_rows", "quarantine_rows", "reason_counts",
    "build_recommendations", "seller_top_pairs",
]
