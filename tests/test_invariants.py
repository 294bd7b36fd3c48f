"""Whole-pipeline invariants on the driver's sf0.01 tables."""
import math

import pytest
from pyspark.sql import functions as F

from util import SF_CHECK
from touchline.plans import analytics, report
from touchline.registry import warehouse


@pytest.fixture(scope="module")
def w(spark):
    return warehouse(spark, SF_CHECK)


def test_both_models_reconcile_to_source_total(w):
    total = w.stg_portfolio_revenue.agg(F.sum(F.col("revenue_amount").cast("decimal(30,8)"))).first()[0]
    rows = analytics.channel_revenue_ranking(w.fct_attributed_revenue).collect()
    last = sum(r["last_touch_revenue"] or 0 for r in rows)
    first = sum(r["first_touch_revenue"] or 0 for r in rows)
    assert math.isclose(last, float(total), abs_tol=1e-6) and math.isclose(first, float(total), abs_tol=1e-6)
    assert math.isclose(sum(r["pct_of_total_last_touch"] for r in rows), 100.0, abs_tol=0.5)


def test_labels_partition_users(w):
    users = w.stg_user_signups.count()
    assert sum(r["users"] for r in report.quality_label_counts(w.int_user_attribution).collect()) == users


def test_cac_customers_are_the_paying_users(w):
    paying = w.fct_attributed_revenue.select("user_id").distinct().count()
    rows = analytics.cac_by_channel_company(w.fct_attributed_revenue, w.stg_campaign_metadata).collect()
    assert sum(r["customers_acquired"] for r in rows) == paying


def test_campaign_split_sums_back_to_user_total(w):
    per_user = (w.int_campaign_attribution.groupBy("user_id")
                .agg(F.sum("attributed_revenue").alias("s"), F.first("total_revenue").alias("t"),
                     F.first("n_campaign_matches").alias("n"), F.count(F.lit(1)).alias("rows"))
                .collect())
    assert per_user
    for r in per_user:
        assert r["rows"] == r["n"]
        assert abs(r["s"] - r["t"]) <= r["n"] * 0.00005 + 1e-9
    roi_total = sum(r["attributed_revenue"] for r in w.fct_campaign_roi.collect())
    split_total = sum(r["s"] for r in per_user)
    assert abs(roi_total - split_total) <= 0.005 * len(w.fct_campaign_roi.where("attributed_users > 0").collect())


def test_revenue_rollup_answers_additive_queries_exactly(w):
    from touchline.plans.marts import revenue_rollup
    fact = w.fct_attributed_revenue
    roll = revenue_rollup(fact)
    for q in (analytics.channel_revenue_ranking, analytics.revenue_trend_by_channel, analytics.forecast_by_company,
              analytics.channel_revenue_totals, report.monthly_revenue, report.top_channel_share):
        assert q(roll).collect() == q(fact).collect(), q.__name__
    assert (analytics.campaign_roi_coverage(w.fct_campaign_roi, roll).collect()
            == analytics.campaign_roi_coverage(w.fct_campaign_roi, fact).collect())
    assert sorted(report.channel_type_split(roll, w.dim_channel).collect()) == sorted(
        report.channel_type_split(fact, w.dim_channel).collect())
    assert sorted(report.company_revenue(roll, w.dim_company).collect()) == sorted(
        report.company_revenue(fact, w.dim_company).collect())


def test_production_layout_equals_registered_queries(spark, w):
    """Bucketed raw layer + progressive materialisation + rollup (the batch
    path) give the same seven result sets as the oracle-checked queries."""
    import tempfile

    import __spark_entry__ as E
    from touchline.plans.marts import revenue_rollup
    from touchline.plans.warehouse import Warehouse
    from touchline.run import result_sets
    from touchline.sources.files import ingest
    root = tempfile.mkdtemp(prefix="tl-prod-")
    raw, _ = ingest(spark, w.raw, root + "/raw", bucket_users=4, database="t_prod_raw")
    m = Warehouse(spark, raw).materialize(root + "/marts", bucket_users=4, database="t_prod_marts")
    got = result_sets(m, revenue_rollup(m.fct_attributed_revenue))
    names = {"forecast_3mo_by_company": "forecast_by_company"}
    for label, df in got.items():
        reg = E.queries()[names.get(label, label)](spark, SF_CHECK)
        assert sorted(df.collect()) == sorted(reg.collect()), label
