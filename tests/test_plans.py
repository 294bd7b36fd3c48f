"""Physical plan properties that matter at scale."""
import pytest

import __spark_entry__ as E
from util import SF_SMALL
from touchline.registry import warehouse

BAD = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython")


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(E.queries()))
def test_no_cartesian_no_python_udf(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    assert not any(b in text for b in BAD), name


def test_fact_scan_is_pruned(spark):
    w = warehouse(spark, SF_SMALL)
    df = w.fct_attributed_revenue.select("revenue_amount", "last_touch_channel")
    schemas = [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines()
               if "ReadSchema" in line]
    text = "\n".join(schemas)
    assert schemas, "expected parquet scans"
    # only the needed raw columns reach the parquet readers
    for unused in ("referral_source", "first_touch_content_id", "utm_medium", "revenue_type", "campaign_name",
                   "start_date"):
        assert unused not in text, unused


def test_salted_shuffle_path_equals_broadcast_path(spark):
    a = warehouse(spark, "/root/testdata/sf0.01", bucketed=True).int_campaign_attribution
    b = warehouse(spark, "/root/testdata/sf0.01", bucketed=True, max_broadcast_rows=0).int_campaign_attribution
    c = warehouse(spark, "/root/testdata/sf0.01", bucketed=False).int_campaign_attribution
    assert "BroadcastHashJoin" not in plan_text(b) or "__salt" in plan_text(b)
    assert sorted(a.collect()) == sorted(b.collect()) == sorted(c.collect())


def test_materialize_cuts_lineage(spark):
    w = warehouse(spark, SF_SMALL).materialize(names=("stg_portfolio_revenue", "int_user_attribution",
                                                     "fct_attributed_revenue"))
    text = plan_text(w.fct_attributed_revenue)
    assert "orders" not in text.lower() or "fct_attributed_revenue" in text
    assert w.fct_attributed_revenue.count() == warehouse(spark, SF_SMALL).fct_attributed_revenue.count()


def test_lookup_reduction_paths_agree(spark):
    # 0: no broadcast at all; 100: campaigns too big, reduced-to-user-tags side broadcast
    base = sorted(warehouse(spark, SF_SMALL).int_user_attribution.collect())
    for bound in (0, 100):
        w = warehouse(spark, SF_SMALL, max_broadcast_rows=bound)
        assert sorted(w.int_user_attribution.collect()) == base, bound
    from touchline.operators.joins import broadcast_lookup
    w = warehouse(spark, SF_SMALL)
    tags = w.stg_campaign_metadata.select("utm_campaign")
    side, small = broadcast_lookup(tags, w.stg_user_signups, "utm_campaign", "utm_campaign", max_rows=100)
    assert small and side.count() == 30  # 200 campaigns, 30 distinct user tags


def test_bucketed_layout_removes_user_id_shuffles(spark):
    import re
    import tempfile

    from touchline.plans.warehouse import Warehouse
    from touchline.sources import fixtures
    from touchline.sources.files import ingest
    raw, _ = ingest(spark, fixtures.from_tpch(spark, SF_SMALL), tempfile.mkdtemp(prefix="tl-bkt-"),
                    bucket_users=4, database="t_raw_bkt")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        w = Warehouse(spark, raw)
        for model in ("fct_attributed_revenue", "int_user_journey"):
            text = plan_text(w.model(model))
            assert not re.search(r"Exchange hashpartitioning\(user_id", text), model
        m = w.materialize(tempfile.mkdtemp(prefix="tl-bkt-m-"), bucket_users=4, database="t_marts_bkt")
        base = warehouse(spark, SF_SMALL)
        assert sorted(m.fct_attributed_revenue.collect()) == sorted(base.fct_attributed_revenue.collect())
        assert sorted(m.int_campaign_attribution.collect()) == sorted(base.int_campaign_attribution.collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_month_partitioned_fact_roundtrip_and_pruning(spark):
    import tempfile

    from pyspark.sql import functions as F
    base = warehouse(spark, SF_SMALL)
    m = base.materialize(tempfile.mkdtemp(prefix="tl-part-"), names=("fct_attributed_revenue",),
                         partition_fact_by_month=True)
    fact = m.fct_attributed_revenue
    def shape(df):
        return [(f.name, f.dataType) for f in df.schema.fields]
    assert shape(fact) == shape(base.fct_attributed_revenue)
    assert sorted(fact.collect()) == sorted(base.fct_attributed_revenue.collect())
    month = fact.select("revenue_month_str").first()[0]
    text = plan_text(fact.where(F.col("revenue_month_str") == month))
    assert "PartitionFilters: [isnotnull(revenue_month_str" in text


def test_interval_join_reduction_path(spark):
    from touchline.operators.joins import month_buckets
    sf = "/root/testdata/sf0.01"
    base = warehouse(spark, sf)
    full = month_buckets(base.stg_campaign_metadata, "start_date", "end_date", "m")
    users = base.int_user_journey.selectExpr("last_touch_channel AS channel", "company_id", "trunc(signup_date, 'month') AS m").distinct()
    reduced = full.join(users, ["channel", "company_id", "m"], "left_semi").count()
    assert reduced < full.count()
    # a bound below the full bucketed window side, not below its reduction to the users' months
    w = warehouse(spark, sf, max_broadcast_rows=reduced)
    assert sorted(w.int_campaign_attribution.collect()) == sorted(base.int_campaign_attribution.collect())
    assert "__salt" not in plan_text(w.int_campaign_attribution)  # the reduced side was broadcast


def test_company_filter_reaches_the_parquet_scans(spark):
    from touchline.plans import report
    w = warehouse(spark, SF_SMALL)
    df = report.company_cac(w.fct_attributed_revenue, w.stg_campaign_metadata, company_id="CTC-002")
    text = df._jdf.queryExecution().executedPlan().toString()
    pushed = [line for line in text.splitlines() if "PushedFilters" in line and "CTC-002" in line]
    assert len(pushed) >= 2, text  # revenue scan and campaign scan both filtered at the source
    assert {r["company_id"] for r in df.collect()} == {"CTC-002"}
