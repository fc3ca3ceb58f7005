"""Per-seller recommendations: the global top items a seller does not list.

Result = {(seller, item) : seller in catalog, item in top} minus the pairs
already in the catalog, with the item's details attached.

One plan for every size (no cross join, nothing on the driver), which reads the
catalog once.  The top list is read twice, so callers pass one that is written
(``plans.storage.written_once``), not a plan that would run the metrics twice.

1. Catalog rows meet the ids of the top list; a row of another item keeps its seller
   only.  One distinct, combined map-side, leaves a row per seller and listed top
   item (and one for the seller), however large the catalog.
2. These become one row per seller with the top items it lists: ``top_n`` ids at most.
3. The top rows are packed into chunks of about ``CHUNK_ITEMS`` items (their number
   follows from the ``top_n`` parameter, not from the data) and replicated over
   ``SALTS``; sellers meet every chunk by an equi-join on (chunk, salt), the salt
   being a hash of the seller, so no chunk row receives all sellers.  The listed
   items of a chunk are left out as it is unpacked.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.schemas import RECOMMENDATION_COLUMNS

TOP_N = 10
CHUNK_ITEMS = 1_000
SALTS = 64
_DETAILS = [c for c in RECOMMENDATION_COLUMNS if c != "seller_id"]


def _chunk_of(item: Column | str, n_chunks: int) -> Column:
    return F.pmod(F.xxhash64(item), F.lit(n_chunks)).cast("int")


def _seller_lists(catalog: DataFrame, top: DataFrame) -> DataFrame:
    """``seller_id, listed``: the top items that each seller of the catalog lists.
    A NULL seller equals no catalog pair, so it lists nothing."""
    ids = top.select("item_id", F.col("item_id").alias("_top")).dropDuplicates(["item_id"])
    listings = catalog.select("seller_id", "item_id").join(ids, "item_id", "left").select("seller_id", "_top").distinct()
    listed = F.collect_list(F.when(F.col("seller_id").isNotNull(), F.col("_top")))
    return listings.groupBy("seller_id").agg(listed.alias("listed"))


def seller_top_pairs(
    catalog: DataFrame,
    top_items: DataFrame,
    exclude_listed: bool = True,
    top_n: int = TOP_N,
) -> DataFrame:
    """(seller_id, top-item details...) for every seller and top item; with
    ``exclude_listed`` the pairs present in the catalog are removed.

    ``top_n`` is the length the top list was asked for; it only sets the number
    of chunks.  Top rows without an item id are dropped.  A NULL seller keeps every
    item."""
    cols = [c for c in top_items.columns if c in _DETAILS]
    kind = top_items.schema["item_id"].dataType.simpleString()
    top = top_items.filter(F.col("item_id").isNotNull())
    n_chunks = max(1, math.ceil(top_n / CHUNK_ITEMS))
    chunks = (
        top.groupBy(_chunk_of("item_id", n_chunks).alias("_chunk"))
        .agg(F.collect_list(F.struct(*cols)).alias("items"))
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    )
    if exclude_listed:
        sellers = _seller_lists(catalog, top)
    else:
        sellers = catalog.select("seller_id").distinct().withColumn("listed", F.array().cast(f"array<{kind}>"))
    sellers = sellers.select(
        "seller_id", "listed", F.pmod(F.xxhash64("seller_id"), F.lit(SALTS)).cast("int").alias("_salt"),
        F.explode(F.sequence(F.lit(0), F.lit(n_chunks - 1))).alias("_chunk"),
    )
    if n_chunks > 1:
        sellers = sellers.withColumn("listed", F.filter("listed", lambda i: _chunk_of(i, n_chunks) == F.col("_chunk")))
    missing = F.filter("items", lambda t: ~F.array_contains(F.col("listed"), t["item_id"]))
    return (
        sellers.join(chunks, ["_chunk", "_salt"])
        .select("seller_id", F.explode(missing).alias("t"))
        .select("seller_id", *[F.col("t")[c].alias(c) for c in cols])
    )


def build_recommendations(catalog: DataFrame, top_items: DataFrame, top_n: int = TOP_N) -> DataFrame:
    """Top items each seller does not list yet, with item details."""
    recs = seller_top_pairs(catalog, top_items, exclude_listed=True, top_n=top_n)
    return recs.select(*[c for c in RECOMMENDATION_COLUMNS if c in recs.columns])
