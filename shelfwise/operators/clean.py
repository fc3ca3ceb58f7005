"""Cleaning (bronze text -> typed silver rows).

Each cleaner is one projection (``withColumns`` keeps column order and passes
unknown extra columns through) plus, for the catalog and company feeds, a
per-key dedup.  Numeric text uses the old non-ANSI cast rules and dates the
LEGACY parser rules (see ``shelfwise.functions.casts``), independent of the
session's ANSI / parser settings.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from shelfwise.functions import legacy_date, legacy_double, legacy_int, strip_spaces, title_case, zero_if_missing
from shelfwise.operators.keyed import dedup_keys
from shelfwise.schemas import CATALOG_KEYS, COMPANY_KEYS


def clean_seller_catalog(df: DataFrame) -> DataFrame:
    """Trim ids, title-case name and category, price -> double (NULL kept),
    stock -> int with NULL -> 0, one row per (seller_id, item_id)."""
    typed = df.withColumns({
        "seller_id": strip_spaces("seller_id"),
        "item_id": strip_spaces("item_id"),
        "item_name": title_case("item_name"),
        "category": title_case("category"),
        "marketplace_price": legacy_double("marketplace_price"),
        "stock_qty": zero_if_missing(legacy_int("stock_qty"), 0),
    })
    return dedup_keys(typed, CATALOG_KEYS)


def clean_company_sales(df: DataFrame) -> DataFrame:
    """Trim id and date text, units -> int, revenue -> double (missing -> 0),
    date parsed, one row per item_id."""
    typed = df.withColumns({
        "item_id": strip_spaces("item_id"),
        "sale_date": legacy_date(strip_spaces("sale_date")),
        "units_sold": zero_if_missing(legacy_int("units_sold"), 0),
        "revenue": zero_if_missing(legacy_double("revenue"), 0.0),
    })
    return dedup_keys(typed, COMPANY_KEYS)


def clean_competitor_sales(df: DataFrame) -> DataFrame:
    """Trim ids and date text, numbers cast with missing -> 0, date parsed.
    Every row is kept (no dedup)."""
    return df.withColumns({
        "item_id": strip_spaces("item_id"),
        "seller_id": strip_spaces("seller_id"),
        "sale_date": legacy_date(strip_spaces("sale_date")),
        "units_sold": zero_if_missing(legacy_int("units_sold"), 0),
        "revenue": zero_if_missing(legacy_double("revenue"), 0.0),
        "marketplace_price": zero_if_missing(legacy_double("marketplace_price"), 0.0),
    })
