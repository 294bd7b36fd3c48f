"""End-to-end batch: ingest -> data-quality gate -> marts -> model tests -> result sets.

    python -m touchline.run --sources DIR --out DIR [--no-gate] [--preview N] [--bucket-users N] [--signups NAME]

``--sources`` holds the four source files (campaign_metadata.csv,
content_performance.csv, portfolio_revenue.csv, user_signups.json).  Raw
tables, the quality report, the marts and the results of the model tests are
written as Parquet to a new version under ``--out/versions``; a failing test ends the
run before any result is written, with the failing rows under ``failing_rows``.  Each
of the seven analysis result sets is written as one CSV (``results/<label>``).  A
version whose tests pass is published: ``--out/CURRENT`` names it.  Plain function composition, no scheduler.
"""
from __future__ import annotations

import argparse
import os

from pyspark.sql import DataFrame, SparkSession

from touchline.operators import quality
from touchline.plans import analytics, model_tests
from touchline.plans.marts import revenue_rollup, user_activity, user_numbers
from touchline.plans.warehouse import Warehouse
from touchline.sources import publish
from touchline.sources.files import ingest, load_sources, write_result_csv, write_table


def result_sets(w: Warehouse, rollup: DataFrame | None = None, activity: DataFrame | None = None) -> dict[str, DataFrame]:
    """The seven analysis result sets, by output label.  With ``rollup`` (see
    :func:`touchline.plans.marts.revenue_rollup`) the additive ones read it
    instead of the fact, with ``activity`` (:func:`touchline.plans.marts.user_activity`)
    the ones that count users do too."""
    fact, roi = w.fct_attributed_revenue, w.fct_campaign_roi
    sums = fact if rollup is None else rollup
    return {
        "channel_revenue_ranking": analytics.channel_revenue_ranking(sums),
        "campaign_roi": analytics.campaign_roi(roi),
        "campaign_roi_coverage": analytics.campaign_roi_coverage(roi, sums),
        "cac_by_channel_company": analytics.cac_by_channel_company(fact if activity is None else sums, w.stg_campaign_metadata, activity),
        "cohort_retention_by_channel": analytics.cohort_retention_by_channel(fact, activity=activity),
        "revenue_trend_by_channel": analytics.revenue_trend_by_channel(sums),
        "forecast_3mo_by_company": analytics.forecast_by_company(sums),
    }


def stored_activity(w: Warehouse, root: str) -> DataFrame:
    """The users' numbers and activity, written below ``root``; returns the activity."""
    numbers, activity = os.path.join(root, "_user_numbers"), os.path.join(root, "_user_activity")
    write_table(user_numbers(w.int_user_attribution), numbers)
    write_table(user_activity(w.fct_attributed_revenue, w.spark.read.parquet(numbers)), activity)
    return w.spark.read.parquet(activity)


def run(spark: SparkSession, sources: str, out: str, gate: bool = True, preview_rows: int = 0,
        bucket_users: int | None = None, file_names: dict[str, str] | None = None) -> Warehouse:
    raw, manifest = ingest(spark, load_sources(spark, sources, file_names), os.path.join(out, "raw"), bucket_users=bucket_users)
    write_table(manifest, os.path.join(out, "raw", "_ingest_manifest"))
    report = quality.dq_report(spark, raw)
    write_table(report, os.path.join(out, "raw", "data_quality_report"))
    if gate:
        quality.enforce_gate(spark.read.parquet(os.path.join(out, "raw", "data_quality_report")))
    w = Warehouse(spark, raw).materialize(os.path.join(out, "marts"), bucket_users=bucket_users, metrics=model_tests.metrics)
    tests = os.path.join(out, "marts", "_model_tests")
    write_table(model_tests.every_test(w), tests)

    def keep(test: str, model: str, column: str | None) -> None:
        name = ".".join(x for x in (test, model, column) if x)
        write_table(model_tests.failing_rows(w, test, model, column), os.path.join(out, "failing_rows", name))

    model_tests.enforce(spark.read.parquet(tests), keep)
    write_table(revenue_rollup(w.fct_attributed_revenue), os.path.join(out, "marts", "_revenue_rollup"))
    rollup = spark.read.parquet(os.path.join(out, "marts", "_revenue_rollup"))
    activity = stored_activity(w, os.path.join(out, "marts"))
    for label, df in result_sets(w, rollup, activity).items():
        # a row per campaign is not small
        write_result_csv(df, os.path.join(out, "results", label), one_file=label != "campaign_roi")
        if preview_rows:
            df.show(preview_rows, truncate=False)
    return w


def refresh(spark: SparkSession, sources: str, root: str, **options) -> Warehouse:
    """:func:`run` into a new version below ``root``, published (see
    :mod:`touchline.sources.publish`) when it has ended well. A run that fails leaves
    the published version as it was, and its own folder with the failing rows."""
    version = publish.new_version(root)
    w = run(spark, sources, version, **options)
    publish.publish(spark, root, version)
    return w


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    ap.add_argument("--sources", required=True)
    ap.add_argument("--out", required=True)
    ap.add_argument("--no-gate", action="store_true", help="do not fail on error-severity checks")
    ap.add_argument("--preview", type=int, default=0, help="print the first N rows of each result")
    ap.add_argument("--bucket-users", type=int, default=None,
                    help="store user-keyed tables bucketed by user_id into N buckets (shuffle-free user joins)")
    ap.add_argument("--signups", default=None,
                    help="file name of the signups, e.g. user_signups.jsonl (one object per line, splittable)")
    args = ap.parse_args(argv)
    from touchline.session import build_session
    spark = build_session(app="touchline-run")
    refresh(spark, args.sources, args.out, gate=not args.no_gate, preview_rows=args.preview,
        bucket_users=args.bucket_users, file_names={"raw_user_signups": args.signups} if args.signups else None)
    spark.stop()


if __name__ == "__main__":
    main()
