"""Counts published in FIXTURES.md (A3), reproduced by the Spark queries."""

import pytest

from conftest import SF001, SF01
from shelfwise.plans import queries as Q

# FIXTURES.md A3: first-reason counts after cleaning (as_of 2026-12-01), sf0.001 / sf0.01.
REASONS = {
    "seller_catalog": {
        "VALID": (1720, 46792), "missing_seller_id": (21, 532), "missing_item_id": (10, 101),
        "missing_item_name": (21, 551), "missing_category": (22, 579), "missing_marketplace_price": (50, 1308),
        "negative_marketplace_price": (23, 641), "negative_stock_qty": (29, 792),
    },
    "company_sales": {
        "VALID": (146, 1440), "missing_item_id": (1, 1), "negative_units_sold": (10, 95),
        "negative_revenue": (9, 100), "missing_sale_date": (19, 201), "future_sale_date": (9, 99),
    },
    "competitor_sales": {
        "VALID": (3293, 33676), "missing_seller_id": (52, 412), "missing_item_id": (39, 394),
        "negative_marketplace_price": (87, 950), "negative_units_sold": (66, 689), "negative_revenue": (54, 557),
        "missing_sale_date": (241, 2424), "future_sale_date": (98, 972),
    },
}
# FIXTURES.md A3: relation sizes and flagship results, sf0.001 / sf0.01.
SIZES = {
    "upsert_latest_competitor": (1732, 36285),
    "item_metrics": (184, 1840),
    "recommendations": (12, 814),
    "recommendations_uncollapsed": (13, 807),
}


@pytest.mark.parametrize("col,sf", [(0, SF001), (1, SF01)])
def test_reason_counts(spark, col, sf):
    got = {(r["dataset_name"], r["outcome"]): r["rows"] for r in Q.q_dq_reason_counts(spark, sf).collect()}
    want = {(ds, o): n[col] for ds, m in REASONS.items() for o, n in m.items()}
    assert got == want


@pytest.mark.parametrize("col,sf", [(0, SF001), (1, SF01)])
def test_relation_sizes(spark, col, sf):
    for name, n in SIZES.items():
        assert getattr(Q, f"q_{name}")(spark, sf).count() == n[col], name
