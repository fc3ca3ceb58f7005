"""Run the jobs from a YAML configuration file laid out like the source's.

Example::

    seller_catalog:
      input_path: /data/raw/seller_catalog/seller_catalog.csv
      hudi_output_path: /data/processed/seller_catalog_hudi/
    company_sales:   {input_path: ..., hudi_output_path: ...}
    competitor_sales: {input_path: ..., hudi_output_path: ...}
    recommendation:
      seller_catalog_hudi: /data/processed/seller_catalog_hudi/
      company_sales_hudi: /data/processed/company_sales_hudi/
      competitor_sales_hudi: /data/processed/competitor_sales_hudi/
      output_csv: /data/processed/recommendations_csv/

The ``*_hudi`` paths hold this library's Parquet gold tables.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from shelfwise.plans import jobs

# Section and key names of the configuration file.
FEED_SECTIONS = ("seller_catalog", "company_sales", "competitor_sales")
INPUT_KEY = "input_path"
GOLD_KEY = "hudi_output_path"
RECOMMENDATION_SECTION = "recommendation"
RECOMMENDATION_KEYS = ("seller_catalog_hudi", "company_sales_hudi", "competitor_sales_hudi", "output_csv")

JOB_NAMES = FEED_SECTIONS + (RECOMMENDATION_SECTION, "all")


def load_config(path: str) -> dict:
    try:
        import yaml
    except ImportError as e:  # pragma: no cover - PyYAML is optional
        raise RuntimeError("reading a YAML config needs PyYAML") from e
    with open(path) as f:
        return yaml.safe_load(f)


def run_from_config(spark: SparkSession, job: str, config: dict, as_of=None, single_file: bool = False):
    """Run one job (or ``all`` four, feeds first) with paths from ``config``.
    Returns the ingestion ``LoadReport``s and/or the recommendation row count."""
    if job not in JOB_NAMES:
        raise ValueError(f"unknown job {job!r}; expected one of {JOB_NAMES}")
    results = []
    for feed in FEED_SECTIONS:
        if job in (feed, "all"):
            conf = config[feed]
            results.append(jobs.run_ingest_job(spark, feed, conf[INPUT_KEY], conf[GOLD_KEY], as_of=as_of))
    if job in (RECOMMENDATION_SECTION, "all"):
        conf = config[RECOMMENDATION_SECTION]
        catalog, company, competitor, output = (conf[k] for k in RECOMMENDATION_KEYS)
        results.append(jobs.run_recommendation_job(spark, catalog, company, competitor, output,
                                                   single_file=single_file))
    return results
