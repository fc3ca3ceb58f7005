"""Per-item market metrics and the global top items.

Two equivalent routes are offered:

* the step-by-step operators (``build_item_dimension``, ``build_company_metrics``,
  ``build_competitor_metrics``, ``build_seller_item_counts``,
  ``build_item_metrics``), each usable on its own; and
* ``item_metrics``, which computes the same table from two aggregates and one
  join, and reads every input once, instead of four aggregates and three joins
  of which one re-shuffles on ``coalesce(item_id, item_id)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.schemas import TOP_ITEM_COLUMNS

METRIC_COLUMNS = (
    "item_id", "company_units_sold", "company_revenue", "competitor_units_sold",
    "competitor_revenue", "competitor_avg_price", "total_units_sold",
    "company_price_estimate", "item_name", "category", "catalog_price",
    "seller_count", "market_price", "expected_units_sold", "expected_revenue",
)


#: groups that the sellers of an item are dealt into
SELLER_GROUPS = 8


def _first_by_seller(value: Column, seller: Column) -> Column:
    """``value`` of the result is a deterministic ``first(value, ignorenulls=True)``: the
    non-NULL value listed by the smallest seller_id (the smallest such value if that
    seller lists the item more than once).  Its buffer holds the text once."""
    return F.min(F.when(value.isNotNull(), F.struct(seller.alias("seller"), value.alias("value"))))


def _per_item(catalog: DataFrame, sellers: Column, tasks: int | None) -> DataFrame:
    """One row per non-NULL item_id: name, category, mean catalog price and the count
    ``sellers``, which must add up over groups of sellers.

    An item's rows are first aggregated by group of sellers, then these rows by item, so
    the sellers of an item listed by very many don't meet in one task and each row goes
    through the wide shuffle once.  With ``tasks`` both steps run in that many tasks: a
    number that follows the rows keeps what a task sorts the same at any size."""
    def dealt(df, *keys):
        return df.repartition(*keys) if tasks is None else df.repartition(tasks, *keys)

    seller, price = F.col("seller_id"), F.col("marketplace_price")
    rows = (
        catalog.select("seller_id", "item_id", "item_name", "category", "marketplace_price")
        .filter(F.col("item_id").isNotNull())
        .withColumn("group", F.pmod(F.xxhash64(seller), F.lit(SELLER_GROUPS)))
    )
    parts = dealt(rows, "item_id", "group").groupBy("item_id", "group").agg(
        _first_by_seller(F.col("item_name"), seller).alias("name"),
        _first_by_seller(F.col("category"), seller).alias("category"),
        F.sum(price).alias("total"), F.count(price).alias("prices"), sellers.alias("sellers"),
    )
    return dealt(parts, "item_id").groupBy("item_id").agg(
        F.min("name")["value"].alias("item_name"), F.min("category")["value"].alias("category"),
        F.try_divide(F.sum("total"), F.sum("prices")).alias("catalog_price"), F.sum("sellers").alias("seller_count"),
    )


# ----------------------------------------------------------------- step by step
def build_item_dimension(catalog: DataFrame, tasks: int | None = None) -> DataFrame:
    """One row per non-NULL item_id: name, category, mean catalog price."""
    return _per_item(catalog, F.count("seller_id"), tasks).drop("seller_count")


def build_company_metrics(company_sales: DataFrame) -> DataFrame:
    return company_sales.groupBy("item_id").agg(
        F.sum("units_sold").alias("company_units_sold"),
        F.sum("revenue").alias("company_revenue"),
    )


def build_competitor_metrics(competitor_sales: DataFrame) -> DataFrame:
    return competitor_sales.groupBy("item_id").agg(
        F.sum("units_sold").alias("competitor_units_sold"),
        F.sum("revenue").alias("competitor_revenue"),
        F.avg("marketplace_price").alias("competitor_avg_price"),
    )


def build_seller_item_counts(catalog: DataFrame) -> DataFrame:
    """Exact number of distinct sellers listing each item."""
    return catalog.groupBy("item_id").agg(F.count_distinct("seller_id").alias("seller_count"))


def merge_sales(company_metrics: DataFrame, competitor_metrics: DataFrame) -> DataFrame:
    """Full outer join of the two sales aggregates; missing measures -> 0.0,
    total units, and company price estimate (NULL unless units > 0)."""
    m = company_metrics.join(competitor_metrics, on="item_id", how="full_outer")
    return _sales_measures(m)


def _sales_measures(m: DataFrame) -> DataFrame:
    zero = F.lit(0.0)
    m = m.withColumns({
        "company_units_sold": F.coalesce(F.col("company_units_sold"), zero),
        "company_revenue": F.coalesce(F.col("company_revenue"), zero),
        "competitor_units_sold": F.coalesce(F.col("competitor_units_sold"), zero),
        "competitor_revenue": F.coalesce(F.col("competitor_revenue"), zero),
    })
    return m.withColumns({
        "total_units_sold": F.col("company_units_sold") + F.col("competitor_units_sold"),
        "company_price_estimate": F.when(
            F.col("company_units_sold") > 0, F.col("company_revenue") / F.col("company_units_sold")
        ),
    })


def resolve_market_price() -> Column:
    """Competitor mean price if > 0, else company estimate if > 0, else catalog price."""
    return (
        F.when(F.col("competitor_avg_price") > 0, F.col("competitor_avg_price"))
        .when(F.col("company_price_estimate") > 0, F.col("company_price_estimate"))
        .otherwise(F.col("catalog_price"))
    )


def _finish(m: DataFrame) -> DataFrame:
    """Seller-count default, market price, demand filter, expectations."""
    m = m.withColumns({
        "seller_count": F.when(F.col("seller_count").isNull() | (F.col("seller_count") <= 0), F.lit(1))
        .otherwise(F.col("seller_count")),
        "market_price": resolve_market_price(),
    })
    m = m.filter(
        (F.col("total_units_sold") > 0) & F.col("market_price").isNotNull() & (F.col("market_price") > 0)
    )
    expected_units = F.col("total_units_sold") / F.col("seller_count")
    m = m.withColumns({
        "expected_units_sold": expected_units,
        "expected_revenue": expected_units * F.col("market_price"),
    })
    return m.select(*METRIC_COLUMNS)


def build_item_metrics(
    item_dim: DataFrame,
    company_metrics: DataFrame,
    competitor_metrics: DataFrame,
    seller_counts: DataFrame,
) -> DataFrame:
    """Join the four per-item aggregates: sales items that are in the catalog,
    with demand and a positive market price."""
    m = merge_sales(company_metrics, competitor_metrics)
    m = m.join(item_dim, on="item_id", how="inner")
    m = m.join(seller_counts, on="item_id", how="left")
    return _finish(m)


# --------------------------------------------------------------------- fused
def catalog_item_profile(catalog: DataFrame, catalog_is_keyed: bool = False, tasks: int | None = None) -> DataFrame:
    """Item dimension and seller count in one pass over the catalog.

    ``catalog_is_keyed`` declares one row per (seller_id, item_id) (true of the
    gold catalog, whose record key is that pair).  The distinct seller count
    is then a plain non-NULL count.  ``tasks``: see ``_per_item``."""
    return _per_item(catalog, F.count("seller_id") if catalog_is_keyed else F.count_distinct("seller_id"), tasks)


def sales_by_item(company_sales: DataFrame, competitor_sales: DataFrame) -> DataFrame:
    """Company and competitor sums (and competitor mean price) per item from
    one hash aggregate over the union of both feeds (NULL item ids dropped)."""
    none = F.lit(None)
    rows = company_sales.select(
        "item_id", F.lit(True).alias("own"), F.col("units_sold").cast("long").alias("units"),
        F.col("revenue").cast("double").alias("revenue"), none.cast("double").alias("price"),
    ).unionByName(competitor_sales.select(
        "item_id", F.lit(False).alias("own"), F.col("units_sold").cast("long").alias("units"),
        F.col("revenue").cast("double").alias("revenue"),
        F.col("marketplace_price").cast("double").alias("price"),
    )).filter(F.col("item_id").isNotNull())
    own, other = F.col("own"), ~F.col("own")
    return rows.groupBy("item_id").agg(
        F.sum(F.when(own, F.col("units"))).alias("company_units_sold"),
        F.sum(F.when(own, F.col("revenue"))).alias("company_revenue"),
        F.sum(F.when(other, F.col("units"))).alias("competitor_units_sold"),
        F.sum(F.when(other, F.col("revenue"))).alias("competitor_revenue"),
        F.avg(F.when(other, F.col("price"))).alias("competitor_avg_price"),
    )


def item_metrics(catalog: DataFrame, company_sales: DataFrame, competitor_sales: DataFrame,
                 catalog_is_keyed: bool = False, tasks: int | None = None) -> DataFrame:
    """Same rows as ``build_item_metrics`` over the four builders, with fewer
    shuffles: the two sales feeds share one hash aggregate (replacing the
    full outer join), the catalog gives name, category, price and seller count
    in one pass, and the two meet in a single inner join on ``item_id``.  See
    ``catalog_item_profile`` for ``catalog_is_keyed`` and ``tasks``."""
    profile = catalog_item_profile(catalog, catalog_is_keyed, tasks)
    m = sales_by_item(company_sales, competitor_sales).join(profile, "item_id", "inner")
    return _finish(_sales_measures(m))


# --------------------------------------------------------------------- top n
def compute_top_items(metrics: DataFrame, top_n: int = 10) -> DataFrame:
    """Global top ``top_n`` items by total units (named, categorised items
    only); ties broken by the smaller item_id.  Planned as a per-partition
    top-k with a final merge of ``top_n`` rows per partition
    (``TakeOrderedAndProject``), never a full sort."""
    return (
        metrics.filter(F.col("item_name").isNotNull() & F.col("category").isNotNull())
        .orderBy(F.col("total_units_sold").desc(), F.col("item_id").asc())
        .limit(top_n)
        .select(*TOP_ITEM_COLUMNS)
    )


def sold_catalog(catalog: DataFrame, company_sales: DataFrame, competitor_sales: DataFrame) -> DataFrame:
    """Catalog rows of items that occur in a sales feed.  Metrics only keep such
    items, so a catalog cut down to them gives the same metrics, and listings
    that never sold stay out of the catalog aggregates."""
    sold = company_sales.select("item_id").unionByName(competitor_sales.select("item_id")).distinct()
    return catalog.join(sold, "item_id", "left_semi")
