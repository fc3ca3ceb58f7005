"""Keyed tables: one row per record key.

* ``dedup_keys``   – keep one row per key (deterministic choice).
* ``stamp``        – add ``ingestion_timestamp``.
* ``upsert_latest``– merge an incoming batch into an existing table, keeping
  per key the row with the greatest precombine value.

``dedup_keys`` and ``upsert_latest`` are a single ``row_number() == 1`` window per key.  Spark plans that
filter as a *partial* ``WindowGroupLimit`` before the exchange and a final one
after it, so a key that holds a large share of the rows is cut down to one row
per input partition before anything is shuffled.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RN = "__shelfwise_rn"
_SRC = "__shelfwise_src"


def _keep_first(df: DataFrame, keys: Sequence[str], order: list[Column]) -> DataFrame:
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def dedup_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates(keys)`` made deterministic: per key, the row that is
    smallest by all remaining columns (in column order, ascending, NULLs last).
    NULL keys form one group, as in ``dropDuplicates``."""
    rest = [c for c in df.columns if c not in keys]
    order = [F.col(c).asc_nulls_last() for c in rest] or [F.lit(0)]
    return _keep_first(df, keys, order)


def timestamp_value(as_of) -> Column:
    """``current_timestamp()`` or a fixed instant (for reproducible runs)."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, date) and not isinstance(as_of, datetime):
        as_of = datetime(as_of.year, as_of.month, as_of.day)
    return F.lit(as_of).cast("timestamp") if isinstance(as_of, datetime) else F.lit(str(as_of)).cast("timestamp")


def date_value(as_of) -> Column:
    """``current_date()`` or the date of a fixed instant."""
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, datetime):
        as_of = as_of.date()
    return F.lit(as_of).cast("date") if isinstance(as_of, date) else F.lit(str(as_of)).cast("timestamp").cast("date")


def stamp(df: DataFrame, as_of=None, column: str = "ingestion_timestamp") -> DataFrame:
    """Add (or replace) the ingestion timestamp."""
    return df.withColumn(column, timestamp_value(as_of))


def upsert_latest(
    incoming: DataFrame,
    keys: Sequence[str],
    precombine: str,
    existing: DataFrame | None = None,
) -> DataFrame:
    """Keyed upsert with a precombine column.

    Result: one row per key over ``existing`` ∪ ``incoming``.  Per key the row
    with the greatest ``precombine`` wins (NULL loses); on equal precombine an
    incoming row beats an existing one; remaining ties go to the row smallest
    by the other columns.  Columns present on one side only are kept and read
    NULL on the other (schema evolution).  Applying the same batch twice gives
    the same table.

    Both sides are read once: one union and one window over it, whose filter
    cuts every key to one row per map task before the shuffle.
    """
    keys = list(keys)
    both = incoming.withColumn(_SRC, F.lit(0))
    if existing is not None:
        both = both.unionByName(existing.withColumn(_SRC, F.lit(1)), allowMissingColumns=True)
    rest = [c for c in both.columns if c not in (*keys, precombine, _SRC)]
    order = [F.col(precombine).desc_nulls_last(), F.col(_SRC).asc(), *[F.col(c).asc_nulls_last() for c in rest]]
    return _keep_first(both, keys, order).drop(_SRC)
