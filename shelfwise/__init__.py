"""shelfwise: marketplace catalog / sales cleaning, data-quality routing, keyed
gold tables and top-item recommendations, expressed as Spark DataFrame plans.

Subpackages
-----------
functions   column expressions (casts with the old non-ANSI rules, text rules)
operators   DataFrame -> DataFrame building blocks (clean, quality, keyed,
            market, recommend)
sources     CSV / Parquet readers and writers, fixture relations
plans       end-to-end jobs and the query registry used by the driver
llm         training-data operators (optional)
"""

__version__ = "0.1.0"
