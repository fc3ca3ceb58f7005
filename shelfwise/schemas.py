"""Table schemas.

Bronze feeds are read as text (every column a string, names from the CSV
header).
"""

from __future__ import annotations

from pyspark.sql import types as T


def _strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType(), True) for n in names])


# Bronze (raw CSV) column sets.
CATALOG_COLUMNS = ("seller_id", "item_id", "item_name", "category", "marketplace_price", "stock_qty")
COMPANY_COLUMNS = ("item_id", "units_sold", "revenue", "sale_date")
COMPETITOR_COLUMNS = ("seller_id", "item_id", "units_sold", "revenue", "marketplace_price", "sale_date")

BRONZE_CATALOG = _strings(*CATALOG_COLUMNS)
BRONZE_COMPANY = _strings(*COMPANY_COLUMNS)
BRONZE_COMPETITOR = _strings(*COMPETITOR_COLUMNS)

# Record key and precombine (ordering) column of each gold table.
CATALOG_KEYS = ("seller_id", "item_id")
COMPANY_KEYS = ("item_id",)
COMPETITOR_KEYS = ("seller_id", "item_id")
CATALOG_PRECOMBINE = "ingestion_timestamp"
COMPANY_PRECOMBINE = "ingestion_timestamp"
COMPETITOR_PRECOMBINE = "sale_date"

RECOMMENDATION_COLUMNS = (
    "seller_id", "item_id", "item_name", "category",
    "market_price", "expected_units_sold", "expected_revenue",
)
TOP_ITEM_COLUMNS = (
    "item_id", "item_name", "category", "market_price",
    "expected_units_sold", "expected_revenue", "total_units_sold",
)
