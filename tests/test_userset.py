"""Distinct users from stored bitmaps equal the counts over the fact."""

import pytest
from pyspark.sql import functions as F

from touchline.operators import userset
from touchline.plans import analytics, marts, report
from touchline.plans.warehouse import Warehouse
from touchline.registry import raw_layer, warehouse
from touchline.run import result_sets, stored_activity
from touchline.sources import fixtures
from util import SF_CHECK, SF_SMALL


def rows(df):
    return sorted(df.collect(), key=str)


def test_sets_are_exact_however_users_are_numbered(spark, tmp_path):
    seen = [(u, g, m) for u in range(70_000) for g, m in (("a", u % 3), ("b", 0))[: 1 + (u % 7 == 0)]]
    seen += [(5, "a", 9)] * 2000 + [(None, "a", 1)] + [(u, None, None) for u in range(40)]
    df = spark.createDataFrame(seen, "user_id long, g string, m int")
    numbered = userset.numbers(df, "user_id", ["g"])
    numbered.write.parquet(str(tmp_path / "n"))
    numbered = spark.read.parquet(str(tmp_path / "n"))
    assert numbered.count() == numbered.select("user_number").distinct().count() == 70_000
    sets = userset.pieces(df, ["g", "m"], "user_id", numbered)
    want = {(g, m): len({u for u, a, b in seen if (a, b) == (g, m) and u is not None}) for g, m in {(g, m) for _, g, m in seen}}
    assert {(r.g, r.m): r.n for r in userset.counted(sets, ["g", "m"], "n").collect()} == want
    union = {g: len({u for u, a, _ in seen if a == g and u is not None}) for g in {g for _, g, _ in seen}}
    assert {r.g: r.n for r in userset.counted(sets, ["g"], "n").collect()} == union
    # users of a group stand together: few pieces
    assert sets.filter("g = 'b' AND m = 0").count() <= 8


@pytest.mark.parametrize("dirty", [False, True])
def test_queries_read_the_activity_instead_of_the_fact(spark, tmp_path, dirty):
    w = Warehouse(spark, fixtures.dirtied(raw_layer(spark, SF_SMALL))) if dirty else warehouse(spark, SF_CHECK)
    w = w.materialize(str(tmp_path / "marts"), names=("stg_campaign_metadata", "int_user_attribution", "fct_attributed_revenue"))
    fact, campaigns = w.fct_attributed_revenue, w.stg_campaign_metadata
    activity = stored_activity(w, str(tmp_path))
    rollup = marts.revenue_rollup(fact)
    for by_fact, by_sets in [
            (analytics.cac_by_channel_company(fact, campaigns), analytics.cac_by_channel_company(rollup, campaigns, activity)),
            (analytics.cohort_retention_by_channel(fact), analytics.cohort_retention_by_channel(None, activity=activity)),
            (analytics.cohort_retention_by_channel(fact, 3), analytics.cohort_retention_by_channel(None, 3, activity)),
            (report.company_cac(fact, campaigns), report.company_cac(rollup, campaigns, activity=activity)),
            (report.company_cac(fact, campaigns, "CTC-002"), report.company_cac(rollup, campaigns, "CTC-002", activity)),
            (report.spend_verdict(fact, campaigns), report.spend_verdict(rollup, campaigns, activity=activity)),
            (report.pooled_retention(fact), report.pooled_retention(None, activity))]:
        assert by_sets.columns == by_fact.columns and by_sets.dtypes == by_fact.dtypes
        assert rows(by_sets) == rows(by_fact)


def test_the_batch_reads_the_fact_for_no_result(spark, tmp_path):
    w = warehouse(spark, SF_SMALL).materialize(str(tmp_path / "marts"))
    marts.revenue_rollup(w.fct_attributed_revenue).write.parquet(str(tmp_path / "roll"))
    activity = stored_activity(w, str(tmp_path))
    for label, df in result_sets(w, spark.read.parquet(str(tmp_path / "roll")), activity).items():
        assert "fct_attributed_revenue" not in df._jdf.queryExecution().toString(), label


def test_empty_fact(spark, tmp_path):
    w = warehouse(spark, SF_SMALL)
    none = marts.user_activity(w.fct_attributed_revenue.filter(F.lit(False)), spark.createDataFrame([], "user_id string, user_number long"))
    assert none.count() == 0 and analytics.retention_rows(None, activity=none).count() == 0
