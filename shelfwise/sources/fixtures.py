"""Marketplace-shaped relations derived from the TPC-H-like test tables.

Seller = supplier, item = part.  The clean relations stand in for gold
tables, the dirty ones for bronze CSV feeds (every column text, with NULLs,
blanks, bad numbers, bad and future dates and duplicate keys planted by rules
on a row key).  Every relation is a plain DataFrame plan over ``lineitem``
and ``part``, so its size grows with the scale factor.  No row is dropped: the
return flag routes a line to the company or to the competitors, and items that a
feed is to lack carry an id of that feed alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfwise.sources.io import read_table

#: lines that one task groups into catalog rows
TASK_LINES = 250_000


def _tag(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def _item(every: int, own: str, also: Column | None = None) -> Column:
    """Item id of a part; each ``every``-th part (and what ``also`` names) is one
    that only this feed has."""
    part = F.col("l_partkey")
    alone = part % every == 0 if also is None else (part % every == 0) | also
    return F.concat(F.when(alone, F.lit(own)).otherwise(F.lit("I")), part.cast("string"))


def _quarters(x: Column) -> Column:
    """Round down to a multiple of 0.25 (exact in binary floating point)."""
    return F.floor(x * 4).cast("double") / 4


def _case(default: Column, *cases: tuple[Column, Column]) -> Column:
    out = None
    for cond, val in cases:
        out = F.when(cond, val) if out is None else out.when(cond, val)
    return out.otherwise(default)


def _null() -> Column:
    return F.lit(None).cast("string")


class Fixtures:
    """Relations over one scale-factor directory."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._tables: dict[str, DataFrame] = {}
        self._tasks = 0

    def _table(self, name: str) -> DataFrame:
        # One reader per table (file listing and footer read happen once).
        if name not in self._tables:
            self._tables[name] = read_table(self.spark, self.sf_dir, name)
        return self._tables[name]

    def _lineitem(self) -> DataFrame:
        return self._table("lineitem")

    def _part(self) -> DataFrame:
        return self._table("part")

    def tasks(self) -> int:
        """Tasks of ``TASK_LINES`` lines that the lines make (counted once)."""
        self._tasks = self._tasks or max(1, -(-self._lineitem().count() // TASK_LINES))
        return self._tasks

    # ------------------------------------------------------------ clean (gold-like)
    def _part_by_key(self) -> DataFrame:
        """``part`` reduced to one row per key (min name / type / price and
        the number of part rows), so that aggregates over ``lineitem JOIN
        part`` grouped by (supplier, part) can aggregate lineitem first."""
        return self._part().groupBy("p_partkey").agg(
            F.min("p_name").alias("p_name"), F.min("p_type").alias("p_type"),
            F.min("p_retailprice").alias("p_retailprice"), F.count(F.lit(1)).alias("p_rows"),
        )

    def _supplier_part(self, lineitem: DataFrame) -> DataFrame:
        """``lineitem JOIN part GROUP BY l_suppkey, l_partkey`` with min part
        name / type / price and the joined count of open lines, computed by eager
        aggregation: lineitem is counted per (supplier, part) in a hash
        aggregate on two integers and only then joined to the per-key part
        summary (joined lines per group = open lines x part rows).

        Nearly every line is a pair of its own, so a count before the shuffle saves
        nothing and its table grows with the split.  The number of tasks follows the
        number of lines: what a task holds, catalog rows with texts included, does not
        grow with the input."""
        lines = lineitem.select("l_suppkey", "l_partkey", "l_linestatus").repartition(self.tasks(), "l_suppkey", "l_partkey")
        counts = lines.groupBy("l_suppkey", "l_partkey").agg(F.count_if(F.col("l_linestatus") == "O").alias("l_open"))
        return counts.join(self._part_by_key(), F.col("l_partkey") == F.col("p_partkey")).select(
            "l_suppkey", "l_partkey", "p_name", "p_type", "p_retailprice",
            (F.col("l_open") * F.col("p_rows")).alias("n"),
        )

    def seller_catalog(self) -> DataFrame:
        g = self._supplier_part(self._lineitem())
        return g.select(
            _tag("S", F.col("l_suppkey")).alias("seller_id"),
            _item(50, "C", F.col("n") == 0).alias("item_id"),
            F.col("p_name").alias("item_name"), F.col("p_type").alias("category"),
            (F.floor(F.col("p_retailprice") * (F.lit(100) + F.col("l_suppkey") % 7) / 25).cast("double") / 4)
            .alias("marketplace_price"),
            F.col("n").cast("int").alias("stock_qty"),
        )

    def company_sales(self) -> DataFrame:
        li = self._lineitem().filter(F.col("l_returnflag") == "N")
        return li.groupBy("l_partkey").agg(
            F.sum("l_quantity").cast("int").alias("units_sold"),
            F.sum(_quarters(F.col("l_extendedprice"))).alias("revenue"),
            F.max(F.col("l_shipdate").cast("date")).alias("sale_date"),
        ).select(_item(3, "X").alias("item_id"), "units_sold", "revenue", "sale_date")

    def competitor_sales(self) -> DataFrame:
        li = self._lineitem().filter(F.col("l_returnflag") != "N")
        return li.select(
            _tag("S", F.col("l_suppkey")).alias("seller_id"),
            _item(5, "Y").alias("item_id"),
            F.col("l_quantity").cast("int").alias("units_sold"),
            _quarters(F.col("l_extendedprice")).alias("revenue"),
            _quarters(F.col("l_extendedprice") / F.col("l_quantity")).alias("marketplace_price"),
            F.col("l_shipdate").cast("date").alias("sale_date"),
        )

    # ------------------------------------------------------------ dirty (bronze-like)
    def dirty_catalog(self) -> DataFrame:
        p = self._supplier_part(self._lineitem()).select(
            F.col("l_suppkey").alias("s"), F.col("l_partkey").alias("i"),
            (F.col("l_partkey") * 31 + F.col("l_suppkey")).alias("k"),
            F.col("p_name").alias("n"), F.col("p_type").alias("c"), F.col("p_retailprice").alias("pr"),
        )
        d = p.unionByName(p.filter(F.col("k") % 17 == 0).withColumn("pr", F.col("pr") + 1))
        k = F.col("k")
        s_txt, i_txt = F.col("s").cast("string"), F.col("i").cast("string")
        return d.select(
            _case(F.concat(F.lit("S"), s_txt), (k % 97 == 0, _null()),
                  (k % 103 == 0, F.lit("   ")),
                  (k % 11 == 0, F.concat(F.lit("  S"), s_txt, F.lit(" ")))).alias("seller_id"),
            _case(F.concat(F.lit("I"), i_txt), (k % 101 == 0, _null()),
                  (k % 13 == 0, F.concat(F.lit(" I"), i_txt))).alias("item_id"),
            _case(F.concat(F.lit(" "), F.col("n"), F.lit(" ")), (k % 89 == 0, _null()),
                  (k % 107 == 0, F.concat(F.lit("\t"), F.col("n"))),
                  (k % 3 == 0, F.upper("n"))).alias("item_name"),
            _case(F.lower("c"), (k % 83 == 0, _null())).alias("category"),
            _case(F.col("pr").cast("string"), (k % 79 == 0, F.lit("n/a")), (k % 73 == 0, _null()),
                  (k % 71 == 0, F.lit("-5.00")), (k % 47 == 0, F.lit(".5")), (k % 43 == 0, F.lit("1e2"))).alias("marketplace_price"),
            _case((k % 200).cast("string"), (k % 67 == 0, F.lit("many")), (k % 61 == 0, _null()),
                  (k % 59 == 0, F.lit("-3")), (k % 53 == 0, F.lit("12.7")), (k % 43 == 0, F.lit(".5")),
                  (k % 41 == 0, F.lit("+5")), (k % 37 == 0, F.lit("\t7")), (k % 31 == 0, F.lit("1e3"))).alias("stock_qty"),
        )

    def dirty_company(self) -> DataFrame:
        p = (
            self._lineitem().filter(F.col("l_returnflag") == "N")
            .groupBy("l_partkey")
            .agg(F.sum("l_quantity").alias("q"), F.sum(_quarters(F.col("l_extendedprice"))).alias("r"),
                 F.max(F.col("l_shipdate").cast("date")).alias("t"))
            .select(F.col("l_partkey").alias("i"), (F.col("l_partkey") * 13 + 5).alias("k"), "q", "r", "t")
        )
        d = p.unionByName(p.filter(F.col("k") % 9 == 0).withColumn("q", F.col("q") + 1))
        k = F.col("k")
        i_txt = F.col("i").cast("string")
        return d.select(
            _case(F.concat(F.lit("I"), i_txt), (k % 31 == 0, _null()),
                  (k % 11 == 0, F.concat(F.lit(" I"), i_txt, F.lit(" ")))).alias("item_id"),
            _case(F.col("q").cast("int").cast("string"), (k % 29 == 0, F.lit("many")), (k % 23 == 0, _null()),
                  (k % 19 == 0, F.lit("-3")), (k % 28 == 0, F.lit("12.7")), (k % 26 == 0, F.lit("+5")),
                  (k % 22 == 0, F.lit("."))).alias("units_sold"),
            _case(F.col("r").cast("decimal(18,2)").cast("string"), (k % 27 == 0, F.lit("n/a")),
                  (k % 25 == 0, _null()), (k % 17 == 0, F.lit("-5.5")), (k % 32 == 0, F.lit("NaN")),
                  (k % 34 == 0, F.lit("+.5"))).alias("revenue"),
            _case(F.concat(F.lit(" "), F.col("t").cast("string")), (k % 21 == 0, _null()),
                  (k % 37 == 0, F.lit("not-a-date")), (k % 15 == 0, F.lit("9999-12-31")),
                  (k % 16 == 0, F.lit("2024-1-5")), (k % 14 == 0, F.lit("2024-01-05abc")),
                  (k % 12 == 0, F.lit("2024-02-30"))).alias("sale_date"),
        )

    def dirty_competitor(self) -> DataFrame:
        d = self._lineitem().filter(F.col("l_returnflag") != "N").select(
            (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("k"),
            F.col("l_partkey").alias("i"), F.col("l_suppkey").alias("s"), F.col("l_quantity").alias("q"),
            _quarters(F.col("l_extendedprice")).alias("r"),
            _quarters(F.col("l_extendedprice") / F.col("l_quantity")).alias("pr"),
            F.col("l_shipdate").alias("t"),
        )
        k = F.col("k")
        s_txt, i_txt = F.col("s").cast("string"), F.col("i").cast("string")
        return d.select(
            _case(F.concat(F.lit("S"), s_txt), (k % 101 == 0, _null()), (k % 103 == 0, F.lit("  ")),
                  (k % 13 == 0, F.concat(F.lit("S"), s_txt, F.lit("  ")))).alias("seller_id"),
            _case(F.concat(F.lit("I"), i_txt), (k % 97 == 0, _null()),
                  (k % 11 == 0, F.concat(F.lit(" I"), i_txt))).alias("item_id"),
            _case(F.col("q").cast("int").cast("string"), (k % 67 == 0, F.lit("many")), (k % 61 == 0, _null()),
                  (k % 59 == 0, F.lit("-3")), (k % 53 == 0, F.lit("12.7")), (k % 51 == 0, F.lit(".5")),
                  (k % 49 == 0, F.lit("+5")), (k % 45 == 0, F.lit("\t8"))).alias("units_sold"),
            _case(F.col("r").cast("string"), (k % 79 == 0, F.lit("n/a")), (k % 73 == 0, _null()),
                  (k % 71 == 0, F.lit("-5.5")), (k % 69 == 0, F.lit("NaN"))).alias("revenue"),
            _case(F.col("pr").cast("string"), (k % 43 == 0, F.lit("free")),
                  (k % 41 == 0, F.lit("-1.0")), (k % 39 == 0, F.lit("NaN"))).alias("marketplace_price"),
            _case(F.col("t").cast("date").cast("string"), (k % 53 == 0, _null()),
                  (k % 47 == 0, F.lit("not-a-date")), (k % 37 == 0, F.lit("9999-12-31")),
                  (k % 35 == 0, F.lit("2024-1-5")), (k % 33 == 0, F.lit("2024-01-05abc")),
                  (k % 32 == 0, F.lit("2024- 1- 5")), (k % 31 == 0, F.lit("2024-13-01"))).alias("sale_date"),
        )
