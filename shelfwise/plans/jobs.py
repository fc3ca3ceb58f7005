"""End-to-end jobs.

Ingestion (one per feed): bronze CSV -> clean -> quality tagging -> staged
once -> gold Parquet (valid rows, stamped, one row per key) + quarantine CSV
(invalid rows with the first failing reason).  The input is parsed, cleaned and
deduplicated once per run.  Load counts are aggregates over the staged table and,
where cleaning drops duplicates, a count of the raw lines that parses none, so a
task that runs again after a lost executor changes no count.

Recommendation: three gold tables -> item metrics -> global top items, written
once -> per-seller recommendations -> CSV.

Failures raise; the command-line wrapper prints the error with its traceback
and exits with status 1.
"""

from __future__ import annotations

import argparse
import sys
import traceback
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from shelfwise import schemas
from shelfwise.operators import clean, keyed, market, quality, recommend
from shelfwise.plans.storage import parent_of, remove_path, scratch_path, written_once
from shelfwise.sources import io

_VALID_FLAG = "_dq_valid"


@dataclass(frozen=True)
class Feed:
    dataset: str
    columns: tuple[str, ...]
    cleaner: object
    keys: tuple[str, ...]
    precombine: str
    unique_after_clean: bool  # cleaning already leaves one row per record key
    strict_paths: bool  # gold path must have at least three segments


FEEDS = {
    quality.CATALOG_DATASET: Feed(quality.CATALOG_DATASET, schemas.CATALOG_COLUMNS, clean.clean_seller_catalog,
                                  schemas.CATALOG_KEYS, schemas.CATALOG_PRECOMBINE, True, False),
    quality.COMPANY_DATASET: Feed(quality.COMPANY_DATASET, schemas.COMPANY_COLUMNS, clean.clean_company_sales,
                                  schemas.COMPANY_KEYS, schemas.COMPANY_PRECOMBINE, True, True),
    quality.COMPETITOR_DATASET: Feed(quality.COMPETITOR_DATASET, schemas.COMPETITOR_COLUMNS,
                                     clean.clean_competitor_sales, schemas.COMPETITOR_KEYS,
                                     schemas.COMPETITOR_PRECOMBINE, False, True),
}


@dataclass(frozen=True)
class LoadReport:
    dataset: str
    raw_rows: int
    clean_rows: int
    valid_rows: int
    invalid_rows: int
    gold_path: str
    quarantine_path: str


def reports_frame(spark: SparkSession, reports) -> DataFrame:
    """Load metrics of finished jobs as a DataFrame (one row per job)."""
    schema = ("dataset string, raw_rows long, clean_rows long, valid_rows long, invalid_rows long, "
              "gold_path string, quarantine_path string")
    return spark.createDataFrame([tuple(asdict(r).values()) for r in reports], schema)


def default_quarantine_path(gold_path: str, dataset: str, strict: bool = True) -> str:
    """``<gold path minus its last two segments>/quarantine/<dataset>/``."""
    parts = gold_path.rstrip("/").split("/")
    if strict and len(parts) < 3:
        raise ValueError(f"{gold_path}: needs three path segments to derive the quarantine folder from")
    return f"{'/'.join(parts[:-2])}/quarantine/{dataset}/"


def gold_rows(feed: Feed, valid: DataFrame, as_of=None, existing: DataFrame | None = None) -> DataFrame:
    """Stamp valid rows and apply the keyed upsert (skipped when cleaning has
    already made the keys unique and there is no existing table to merge)."""
    stamped = keyed.stamp(valid, as_of)
    if existing is None and feed.unique_after_clean:
        return stamped
    return keyed.upsert_latest(stamped, feed.keys, feed.precombine, existing=existing)


def run_ingest_job(
    spark: SparkSession,
    dataset: str,
    input_path: str,
    gold_path: str,
    quarantine_path: str | None = None,
    as_of=None,
    existing_gold_path: str | None = None,
) -> LoadReport:
    """Load one bronze feed.

    By default the gold table at ``gold_path`` is replaced by this batch.
    ``existing_gold_path`` (a different folder) merges the batch with an
    existing gold table into ``gold_path``."""
    feed = FEEDS[dataset]
    rules = quality.rules_for(dataset)
    quarantine_path = quarantine_path or default_quarantine_path(gold_path, dataset, feed.strict_paths)

    raw = io.read_bronze(spark, input_path, required=feed.columns)
    tagged = quality.tag_quality(feed.cleaner(raw), rules, as_of)

    stage = scratch_path(spark, f"stage-{dataset}", fallback=f"{parent_of(gold_path)}/_checkpoints")
    try:
        flagged = tagged.withColumn(_VALID_FLAG, quality.is_valid())
        flagged.write.mode("overwrite").partitionBy(_VALID_FLAG).parquet(stage)
        # The schema is given so the flag reads back as boolean and an empty
        # feed (no data files) still yields empty outputs.
        staged = spark.read.schema(flagged.schema).parquet(stage)
        counts = quality.load_counts(staged, raw if feed.unique_after_clean else None).first()
        valid = quality.valid_rows(staged.filter(F.col(_VALID_FLAG)).drop(_VALID_FLAG))
        invalid = staged.filter(~F.col(_VALID_FLAG)).drop(_VALID_FLAG)
        existing = io.read_gold(spark, existing_gold_path) if existing_gold_path else None
        io.write_gold(gold_rows(feed, valid, as_of, existing), gold_path)
        io.write_quarantine(quality.quarantine_rows(invalid, rules, as_of), quarantine_path)
    finally:
        remove_path(spark, stage)
    return LoadReport(dataset, *(int(counts[c]) for c in ("raw_rows", "clean_rows", "valid_rows", "invalid_rows")),
                      gold_path, quarantine_path)


def run_seller_catalog_job(spark, input_path, gold_path, quarantine_path=None, as_of=None, **kw) -> LoadReport:
    return run_ingest_job(spark, quality.CATALOG_DATASET, input_path, gold_path, quarantine_path, as_of, **kw)


def run_company_sales_job(spark, input_path, gold_path, quarantine_path=None, as_of=None, **kw) -> LoadReport:
    return run_ingest_job(spark, quality.COMPANY_DATASET, input_path, gold_path, quarantine_path, as_of, **kw)


def run_competitor_sales_job(spark, input_path, gold_path, quarantine_path=None, as_of=None, **kw) -> LoadReport:
    return run_ingest_job(spark, quality.COMPETITOR_DATASET, input_path, gold_path, quarantine_path, as_of, **kw)


def recommendations_from_gold(catalog: DataFrame, company: DataFrame, competitor: DataFrame,
                              top_n: int = 10, catalog_is_keyed: bool = True, top_path: str | None = None) -> DataFrame:
    """Recommendations from the three gold tables.  The gold catalog holds one
    row per (seller_id, item_id), its record key (``catalog_is_keyed``).  The top
    list is written to ``top_path`` (or the scratch folder), so the metrics run once."""
    top = market.compute_top_items(market.item_metrics(catalog, company, competitor, catalog_is_keyed), top_n)
    top = written_once(top, top_path or scratch_path(catalog.sparkSession, "top-items"))
    return recommend.build_recommendations(catalog.select("seller_id", "item_id"), top, top_n)


def run_recommendation_job(
    spark: SparkSession,
    catalog_gold: str,
    company_gold: str,
    competitor_gold: str,
    output_path: str,
    top_n: int = 10,
    single_file: bool = False,
    catalog_is_keyed: bool = True,
) -> int:
    """Write per-seller recommendations as CSV; returns the row count.
    Pass ``catalog_is_keyed=False`` for a catalog that may list a
    (seller, item) pair more than once."""
    written = Observation(f"recommendations_{uuid.uuid4().hex[:8]}")
    top_path = scratch_path(spark, "top-items", fallback=f"{parent_of(output_path)}/_checkpoints")
    try:
        recs = recommendations_from_gold(
            io.read_gold(spark, catalog_gold), io.read_gold(spark, company_gold),
            io.read_gold(spark, competitor_gold), top_n, catalog_is_keyed, top_path,
        )
        io.write_recommendations(recs.observe(written, F.count(F.lit(1)).alias("rows")), output_path, single_file)
    finally:
        remove_path(spark, top_path)
    return int(written.get["rows"])


# ------------------------------------------------------------------ CLI
def main(argv=None) -> int:
    ap = argparse.ArgumentParser(prog="python -m shelfwise.plans.jobs")
    sub = ap.add_subparsers(dest="job", required=True)
    for name in FEEDS:
        p = sub.add_parser(name)
        p.add_argument("input_path")
        p.add_argument("gold_path")
        p.add_argument("--quarantine-path")
        p.add_argument("--existing-gold-path")
    r = sub.add_parser("recommendation")
    r.add_argument("catalog_gold")
    r.add_argument("company_gold")
    r.add_argument("competitor_gold")
    r.add_argument("output_path")
    r.add_argument("--top-n", type=int, default=10)
    r.add_argument("--single-file", action="store_true")
    c = sub.add_parser("from-config", help="run a job (or all) with paths from a YAML config")
    c.add_argument("config_job", metavar="job")
    c.add_argument("config_path", metavar="config")
    c.add_argument("--single-file", action="store_true")
    args = ap.parse_args(argv)
    try:
        spark = SparkSession.builder.appName(f"shelfwise {args.job}").getOrCreate()
        if args.job == "from-config":
            from shelfwise.plans.config import load_config, run_from_config

            for result in run_from_config(spark, args.config_job, load_config(args.config_path),
                                          single_file=args.single_file):
                print(f"[SUCCESS] {asdict(result) if isinstance(result, LoadReport) else result}")
        elif args.job == "recommendation":
            n = run_recommendation_job(spark, args.catalog_gold, args.company_gold, args.competitor_gold,
                                       args.output_path, args.top_n, args.single_file)
            print(f"[SUCCESS] wrote {n} recommendations to {args.output_path}")
        else:
            report = run_ingest_job(spark, args.job, args.input_path, args.gold_path, args.quarantine_path,
                                    existing_gold_path=args.existing_gold_path)
            print(f"[SUCCESS] {asdict(report)}")
        return 0
    except Exception as e:  # noqa: BLE001 - report any failure and exit non-zero
        print(f"[ERROR] {args.job} failed: {e}")
        traceback.print_exc()
        return 1


if __name__ == "__main__":
    sys.exit(main())
