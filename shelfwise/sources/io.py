"""Readers and writers.

* bronze feeds: CSV with a header line, every column read as text (column
  names from the header, no schema inference pass over the data);
* gold tables: Parquet (columnar, predicate and projection push-down);
* quarantine and recommendation outputs: CSV with a header line.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_bronze(spark: SparkSession, path: str, required: Sequence[str] = ()) -> DataFrame:
    """Raw CSV feed: header names, all columns strings.  Empty and ``""``
    fields read as NULL, blanks inside fields are kept, short rows are padded
    with NULL and surplus fields dropped.  ``required`` columns that the header
    lacks raise ``ValueError`` before any data is read."""
    df = spark.read.option("header", True).option("mode", "PERMISSIVE").csv(path)
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"{path}: missing column(s) {missing}; header has {df.columns}")
    return df


#: blanks at either end of a field are data
_KEEP_BLANKS = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def csv_line(*columns: str) -> Column:
    """The columns as one CSV line."""
    return F.to_csv(F.struct(*columns), _KEEP_BLANKS)


def parse_lines(lines: DataFrame, line: str, columns: Sequence[str]) -> DataFrame:
    """CSV lines in a column parsed by the rules of ``read_bronze``."""
    schema = ", ".join(f"`{c}` string" for c in columns)
    return lines.select(F.from_csv(line, schema, {**_KEEP_BLANKS, "mode": "PERMISSIVE"}).alias("row")).select("row.*")


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    """CSV with header, replacing ``path``.  ``single_file`` funnels the rows
    through one task into one part file (only for small outputs); otherwise
    every partition writes its own part file in parallel."""
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_quarantine(df: DataFrame, path: str) -> None:
    write_csv(df, path)


def write_recommendations(df: DataFrame, path: str, single_file: bool = False) -> None:
    write_csv(df, path, single_file=single_file)


def write_gold(df: DataFrame, path: str) -> None:
    """Keyed gold table as Parquet, replacing ``path``."""
    df.write.mode("overwrite").parquet(path)


def read_gold(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the test-data Parquet tables (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
