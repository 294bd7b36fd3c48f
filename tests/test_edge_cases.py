"""Hand-written edge rows (FIXTURES.md section 3)."""
from pyspark.sql import functions as F

from touchline.plans import analytics
from touchline.plans.warehouse import Warehouse
from util import D, campaign, content, raw_tables, revenue, user


def wh(spark, **kw):
    return Warehouse(spark, raw_tables(spark, **kw))


def test_channel_normalisation_and_case_only_conflict(spark):
    w = wh(spark, users=[user("U1", "2024-01-05", first=" YouTube ", last="youtube"),
                         user("U2", "2024-01-05", first="Blog", last="BLOG ")])
    rows = {r["user_id"]: r for r in w.stg_user_signups.collect()}
    assert rows["U1"]["first_touch_channel"] == "youtube" and rows["U1"]["is_touch_conflict"] is False
    assert rows["U2"]["last_touch_channel"] == "blog" and rows["U2"]["is_touch_conflict"] is False


def test_tracking_loss_vs_organic_and_labels(spark):
    w = wh(spark, users=[
        user("U1", "2024-01-05", first="organic", last="organic", src=None),
        user("U2", "2024-01-05", first="youtube", last="youtube", src=None),
        user("U3", "2024-01-05", first="youtube", last="blog", src=None),
        user("U4", "2024-01-05", first="blog", last="blog", src="blog", ref="reddit"),
        user("U5", "2024-01-05", first="blog", last="blog", src="blog")])
    lab = {r["user_id"]: r["attribution_quality"] for r in w.int_user_attribution.collect()}
    assert lab == {"U1": "organic_no_utm", "U2": "utm_tracking_loss", "U3": "touch_conflict",
                   "U4": "referral_mismatch", "U5": "clean"}


def test_campaign_tag_trust_is_three_valued(spark):
    w = wh(spark, campaigns=[campaign("C1", "youtube", "CTC-001", 100, "2024-01-01", "2024-02-01", "cmp_1")],
           users=[user("U1", "2024-01-05", tag="cmp_1"), user("U2", "2024-01-05", tag="cmp_999"),
                  user("U3", "2024-01-05", tag=None), user("U4", "2024-01-05", company="CTC-002", tag="cmp_1"),
                  user("U5", "2024-01-05", tag="CMP_1")])  # the tag join is exact-case
    t = {r["user_id"]: r["is_campaign_tag_trustworthy"] for r in w.int_user_attribution.collect()}
    assert t == {"U1": True, "U2": None, "U3": False, "U4": False, "U5": None}


def _attribution(spark, bucketed, max_rows=2_000_000):
    camps = [campaign("C1", "youtube", "CTC-001", 100, "2024-01-10", "2024-03-31", "cmp_1"),
             campaign("C2", "youtube", "CTC-001", 200, "2024-03-01", "2024-04-30", "cmp_2"),
             campaign("C3", "youtube", "CTC-001", 300, "2024-03-15", "2024-03-15", "cmp_3"),
             campaign("C4", "blog", "CTC-001", 0, "2024-01-01", "2024-12-31", "cmp_4"),
             campaign("C5", "youtube", "CTC-001", 50, "2024-06-01", "2024-05-01", "cmp_5")]  # inverted
    users = [user("U1", "2024-01-10"),   # on C1's start date
             user("U2", "2024-03-31"),   # C1 end date + C2
             user("U3", "2024-03-15"),   # C1, C2, C3
             user("U4", "2024-05-15"),   # inside C5's inverted window: no match
             user("U5", "2024-03-15", company="CTC-002")]
    revs = [revenue("U1", "2024-01", 90.0), revenue("U2", "2024-04", 10.01), revenue("U3", "2024-03", 100.0)]
    w = Warehouse(spark, raw_tables(spark, campaigns=camps, users=users, revenues=revs),
                  bucketed=bucketed, max_broadcast_rows=max_rows)
    return w


def test_interval_join_edges_and_split(spark):
    for bucketed, max_rows in ((False, 2_000_000), (True, 2_000_000), (True, 0)):  # 0 forces the salted path
        w = _attribution(spark, bucketed, max_rows)
        got = sorted((r["user_id"], r["campaign_id"], r["n_campaign_matches"], r["attributed_revenue"])
                     for r in w.int_campaign_attribution.collect())
        assert got == [("U1", "C1", 1, 90.0), ("U2", "C1", 2, 5.005), ("U2", "C2", 2, 5.005),
                       ("U3", "C1", 3, 33.3333), ("U3", "C2", 3, 33.3333), ("U3", "C3", 3, 33.3333)], \
            (bucketed, max_rows)
        roi = {r["campaign_id"]: r for r in w.fct_campaign_roi.collect()}
        assert roi["C4"]["attributed_revenue"] == 0.0 and roi["C4"]["roi_ratio"] is None
        assert roi["C5"]["attributed_users"] == 0 and roi["C5"]["net_return"] == -50.0


def test_user_without_revenue_is_zero_filled(spark):
    w = wh(spark, users=[user("U1", "2024-01-05"), user("U2", "2024-01-05")],
           revenues=[revenue("U1", "2024-01", 10.0), revenue("U1", "2024-02", 20.0)])
    j = {r["user_id"]: r for r in w.int_user_journey.collect()}
    assert (j["U2"]["active_months"], j["U2"]["total_revenue"], j["U2"]["has_revenue"]) == (0, 0.0, False)
    assert (j["U1"]["active_months"], j["U1"]["total_revenue"], j["U1"]["avg_monthly_revenue"]) == (2, 30.0, 15.0)


def test_ctr_zero_views_and_missing_source(spark):
    w = wh(spark, contents=[content("K1", "blog", views=0, clicks=0, src=None),
                            content("K2", "blog", views=300, clicks=10, src="blog")])
    s = {r["content_id"]: r["click_through_rate"] for r in w.stg_content_performance.collect()}
    assert s == {"K1": 0.0, "K2": 0.0333}
    f = w.fct_content_performance.first()
    assert (f["content_pieces"], f["pieces_missing_utm_source"], f["blended_click_through_rate"]) == (2, 1, 0.0333)
    assert f["avg_click_through_rate"] == round((0.0 + 0.0333) / 2, 5) or f["avg_click_through_rate"] == 0.0167


def test_month_index_31st_to_1st(spark):
    w = wh(spark, users=[user("U1", "2024-01-31")],
           revenues=[revenue("U1", "2024-01", 5.0), revenue("U1", "2024-02", 5.0)])
    out = analytics.cohort_retention_by_channel(w.fct_attributed_revenue).collect()
    assert [(r["month_index"], r["active_users"]) for r in out] == [(0, 1), (1, 1)]


def test_channel_on_one_side_only_and_rank_ties(spark):
    w = wh(spark, users=[user("U1", "2024-01-05", first="referral", last="youtube"),
                         user("U2", "2024-01-05", first="blog", last="blog")],
           revenues=[revenue("U1", "2024-01", 50.0), revenue("U2", "2024-01", 50.0)])
    out = {r["channel"]: r for r in analytics.channel_revenue_ranking(w.fct_attributed_revenue).collect()}
    assert out["referral"]["last_touch_revenue"] is None and out["referral"]["last_minus_first"] is None
    assert out["youtube"]["first_touch_revenue"] is None
    assert out["youtube"]["last_touch_rank"] == out["blog"]["last_touch_rank"] == 1


def test_forecast_missing_month_shrinks_divisor(spark):
    w = wh(spark, users=[user("U1", "2024-01-05")],
           revenues=[revenue("U1", "2024-01", 30.0), revenue("U1", "2024-03", 60.0)])
    out = analytics.forecast_by_company(w.fct_attributed_revenue).where(F.col("row_type") == "forecast").collect()
    assert [(r["month"], r["revenue"]) for r in out] == [("2024-04", 45.0), ("2024-05", 45.0), ("2024-06", 45.0)]


def test_models_as_sql_views(spark):
    from util import SF_SMALL
    from touchline.registry import warehouse
    w = warehouse(spark, SF_SMALL)
    assert "v_fct_attributed_revenue" in w.register_views(prefix="v_")
    adhoc = spark.sql("SELECT last_touch_channel AS channel, sum(revenue_amount) AS revenue "
                      "FROM v_fct_attributed_revenue GROUP BY 1").collect()
    totals = {r["channel"]: r["revenue"] for r in analytics.channel_revenue_totals(w.fct_attributed_revenue).collect()}
    assert {r["channel"]: round(r["revenue"]) for r in adhoc} == {k: round(v) for k, v in totals.items()}


def test_literal_dimensions(spark):
    from touchline.plans import marts
    ch = {r["channel"]: r for r in marts.dim_channel(spark).collect()}
    assert len(ch) == 8 and ch["organic"]["channel_type"] == "earned" and ch["blog"]["is_paid_content_channel"]
    co = {r["company_id"]: r for r in marts.dim_company(spark).collect()}
    assert sorted(co) == ["CTC-001", "CTC-002", "CTC-003", "CTC-004"]
    assert co["CTC-002"]["avg_revenue_per_user_benchmark"] == 85


def test_amounts_below_a_cent_are_summed(spark):
    from touchline.functions.exprs import money_sum
    from touchline.operators import quality
    from util import raw_tables, revenue
    raw = raw_tables(spark, revenues=[revenue(f"u{i}", "2024-01", 0.004) for i in range(1000)] + [revenue("x", "2024-01", 1e-9)])
    assert raw.portfolio_revenue.agg(money_sum("revenue_amount")).first()[0] == 4.0
    assert tuple(quality.amount_precision(raw).first()) == (1001, 0, 1)


def test_null_months_are_no_part_of_means_and_null_keys_sort_last(spark):
    import datetime as dt

    from touchline.plans import analytics
    rows = [("a", "C1", dt.date(2024, m, 1), x) for m, x in ((1, 100.0), (2, None), (3, 300.0))] + [(None, None, dt.date(2024, 1, 1), 5.0)]
    fact = spark.createDataFrame(rows, "last_touch_channel string, company_id string, revenue_month date, revenue_amount double")
    trend = analytics.revenue_trend_by_channel(fact).collect()
    assert [(r.channel, r.trailing_3mo_avg) for r in trend] == [("a", 100.0), ("a", 100.0), ("a", 200.0), (None, 5.0)]
    forecast = analytics.forecast_by_company(fact).collect()
    assert [r.revenue for r in forecast if r.company_id == "C1" and r.row_type == "forecast"] == [200.0] * 3
    assert forecast[-1].company_id is None and forecast[0].company_id == "C1"


def test_a_checkpoint_folder_set_by_the_application_is_kept(spark):
    from touchline.plans.warehouse import shared_dir
    from touchline.session import checkpoint_dir, ensure_checkpoint_dir
    before = checkpoint_dir(spark)
    assert ensure_checkpoint_dir(spark) == before == shared_dir(spark) == ensure_checkpoint_dir(spark)


def test_size_probe_sends_one_row_per_task(spark):
    from touchline.operators.joins import bounded_broadcast, measured
    df = spark.range(1000).selectExpr("id", "cast(id AS string) AS name")
    rows, size = measured(df)
    assert rows == 1000 and size == 1000 * 32 + sum(len(str(i)) for i in range(1000))
    assert bounded_broadcast(df, 1000)[1] and not bounded_broadcast(df, 999)[1] and not bounded_broadcast(df, 1000, 1000)[1]
