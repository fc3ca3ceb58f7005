"""Data-quality rules: ordered checks, first failing reason, valid/invalid split.

A rule set is a table of ``(reason, violated)`` pairs in priority order.  One
projection adds ``dq_failure_reason`` (NULL for a valid row, else the first
violated rule), so valid and quarantined rows come from one pass over the
input and always partition it exactly.  Because "valid" is defined as "no
rule fires", an invalid row always has a named reason (a catch-all
``unknown_reason`` can never be produced).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.operators.keyed import date_value, timestamp_value

REASON = "dq_failure_reason"

# Dataset names written to the quarantine.
CATALOG_DATASET = "seller_catalog"
COMPANY_DATASET = "company_sales"
COMPETITOR_DATASET = "competitor_sales"


# Failure reasons of each feed, in the order they are checked
# (a row gets the first one that applies).
CATALOG_REASONS = (
    "missing_seller_id", "missing_item_id", "missing_item_name", "missing_category",
    "missing_marketplace_price", "negative_marketplace_price",
    "missing_stock_qty", "negative_stock_qty",
)
COMPANY_REASONS = (
    "missing_item_id",
    "missing_units_sold", "negative_units_sold",
    "missing_revenue", "negative_revenue",
    "missing_sale_date", "future_sale_date",
)
COMPETITOR_REASONS = (
    "missing_item_id", "missing_seller_id",
    "missing_marketplace_price", "negative_marketplace_price",
    "missing_units_sold", "negative_units_sold",
    "missing_revenue", "negative_revenue",
    "missing_sale_date", "future_sale_date",
)


@dataclass(frozen=True)
class Rule:
    reason: str
    violated: Callable[[Column], Column]  # today's date -> predicate


@dataclass(frozen=True)
class RuleSet:
    dataset: str
    rules: tuple[Rule, ...]


def rule_for(reason: str) -> Rule:
    """The check a reason names: ``missing_<col>`` (NULL), ``negative_<col>``
    (< 0) or ``future_<col>`` (after today)."""
    kind, column = reason.split("_", 1)
    if kind == "missing":
        return Rule(reason, lambda today: F.col(column).isNull())
    if kind == "negative":
        return Rule(reason, lambda today: F.col(column) < 0)
    if kind == "future":
        return Rule(reason, lambda today: F.col(column) > today)
    raise ValueError(f"unknown rule kind in {reason!r}")


def rule_set(dataset: str, reasons: Sequence[str]) -> RuleSet:
    return RuleSet(dataset, tuple(rule_for(r) for r in reasons))


CATALOG_RULES = rule_set(CATALOG_DATASET, CATALOG_REASONS)
COMPANY_RULES = rule_set(COMPANY_DATASET, COMPANY_REASONS)
COMPETITOR_RULES = rule_set(COMPETITOR_DATASET, COMPETITOR_REASONS)


def failure_reason(rules: RuleSet, as_of=None) -> Column:
    """First violated rule's reason, NULL when every rule holds.

    A rule whose predicate is NULL (e.g. ``price < 0`` on a NULL price) does
    not fire; the ``missing_*`` rule ahead of it covers that row.  NaN passes
    ``>= 0`` checks, as in Spark's ordering of doubles."""
    today = date_value(as_of)
    chain = None
    for r in rules.rules:
        cond = r.violated(today)
        chain = F.when(cond, F.lit(r.reason)) if chain is None else chain.when(cond, F.lit(r.reason))
    return chain


def tag_quality(df: DataFrame, rules: RuleSet, as_of=None) -> DataFrame:
    """Add ``dq_failure_reason`` (NULL = valid).

    The tagged rows publish their valid / invalid counts as observed metrics
    (``dq_<dataset>_<id>``, delivered to query-execution listeners).  The
    ``observe`` node also keeps the optimizer from pushing later
    ``valid`` / ``invalid`` filters below the cleaning projection, where the
    regex-based casts would be inlined into the predicate and evaluated
    several times per row."""
    tagged = df.withColumn(REASON, failure_reason(rules, as_of))
    return tagged.observe(f"dq_{rules.dataset}_{uuid.uuid4().hex[:8]}", *count_metrics())


def is_valid() -> Column:
    return F.col(REASON).isNull()


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(is_valid()).drop(REASON)


def quarantine_rows(tagged: DataFrame, rules: RuleSet, as_of=None) -> DataFrame:
    """Invalid rows + reason + ``ingestion_timestamp`` + ``dataset_name``."""
    return (
        tagged.filter(~is_valid())
        .withColumns({
            "ingestion_timestamp": timestamp_value(as_of),
            "dataset_name": F.lit(rules.dataset),
        })
        .select(*[c for c in tagged.columns if c != REASON], REASON, "ingestion_timestamp", "dataset_name")
    )


def dq_split(df: DataFrame, rules: RuleSet, as_of=None) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantined) from one tagging projection."""
    tagged = tag_quality(df, rules, as_of)
    return valid_rows(tagged), quarantine_rows(tagged, rules, as_of)


def reason_counts(tagged: DataFrame) -> DataFrame:
    """Rows per outcome: ``VALID`` or the failure reason."""
    return (
        tagged.groupBy(F.coalesce(F.col(REASON), F.lit("VALID")).alias("outcome"))
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def count_metrics() -> list[Column]:
    """Aggregate columns for ``DataFrame.observe`` on a tagged frame."""
    return [
        F.count(F.lit(1)).alias("after_clean"),
        F.count_if(is_valid()).alias("valid"),
        F.count_if(~is_valid()).alias("invalid"),
    ]


def load_counts(tagged: DataFrame, raw: DataFrame | None = None) -> DataFrame:
    """One row: raw, cleaned, valid and invalid rows.

    ``raw`` are the rows before cleaning, of which only the number is read (no column);
    without it cleaning has kept every row.  Both counts are plain aggregates combined
    map-side, so the deduplication in between stays a window that drops rows before
    its shuffle, and a task that runs again changes no count."""
    nothing, every = F.lit(0).cast("long"), F.count(F.lit(1))
    counts = tagged.agg(
        (every if raw is None else nothing).alias("raw_rows"), every.alias("clean_rows"),
        F.count_if(is_valid()).alias("valid_rows"), F.count_if(~is_valid()).alias("invalid_rows"),
    )
    if raw is None:
        return counts
    both = counts.union(raw.agg(every, *[nothing] * 3))
    return both.agg(*[F.sum(c).alias(c) for c in counts.columns])


def rules_for(dataset: str) -> RuleSet:
    return {r.dataset: r for r in (CATALOG_RULES, COMPANY_RULES, COMPETITOR_RULES)}[dataset]


def reasons(rules: RuleSet) -> Sequence[str]:
    return [r.reason for r in rules.rules]
