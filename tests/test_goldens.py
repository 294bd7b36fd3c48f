"""Replays of published result rows: feed their input columns, compare the
derived columns (values copied from the reference's committed outputs)."""
import datetime as dt

from touchline.plans import analytics, marts

D = dt.date.fromisoformat

FACT_SCHEMA = ("user_id string, company_id string, revenue_month date, revenue_amount double, "
               "last_touch_channel string, first_touch_channel string, signup_month date")

# channel, month, revenue, mom_growth_pct, trailing_3mo_avg
TREND = [
    ("blog", "2024-01", 5381.86, None, 5381.86),
    ("blog", "2024-02", 8773.65, 63.0, 7077.75),
    ("blog", "2024-03", 12562.63, 43.2, 8906.05),
    ("blog", "2024-04", 14725.4, 17.2, 12020.56),
    ("blog", "2024-05", 19615.31, 33.2, 15634.45),
    ("blog", "2024-06", 21463.58, 9.4, 18601.43),
    ("blog", "2024-07", 20782.82, -3.2, 20620.57),
]


def test_trend_replay(spark):
    rows = [(f"u{i}", "CTC-001", D(m + "-01"), rev, ch, ch, D("2024-01-01")) for i, (ch, m, rev, _, _) in
            enumerate(TREND)]
    out = {r["month"]: r for r in analytics.revenue_trend_by_channel(spark.createDataFrame(rows, FACT_SCHEMA))
           .collect()}
    for ch, m, rev, mom, trail in TREND:
        assert out[m]["revenue"] == rev
        assert out[m]["mom_growth_pct"] == mom
        # the published means come from unrounded sums: a half-cent tie may go either way
        assert abs(out[m]["trailing_3mo_avg"] - trail) <= 0.01 + 1e-9


def test_forecast_replay(spark):
    actual = [("2026-01", 10880.13), ("2026-02", 7889.66), ("2026-03", 7258.38),
              ("2026-04", 5662.31), ("2026-05", 4965.02), ("2026-06", 3891.27)]
    earlier = [("2025-11", 12000.0), ("2025-12", 11000.0)]  # outside the 6 shown months
    rows = [(f"u{i}", "CTC-001", D(m + "-01"), v, "blog", "blog", D("2024-01-01"))
            for i, (m, v) in enumerate(earlier + actual)]
    out = analytics.forecast_by_company(spark.createDataFrame(rows, FACT_SCHEMA)).collect()
    got = [(r["month"], r["revenue"], r["row_type"]) for r in out]
    assert got == [(m, v, "actual") for m, v in actual] + [
        ("2026-07", 4839.53, "forecast"), ("2026-08", 4839.53, "forecast"), ("2026-09", 4839.53, "forecast")]


# channel, last_touch_revenue, first_touch_revenue, last_minus_first, ranks, pct
RANKING = [
    ("youtube", 671856.31, 730535.26, -58678.95, 1, 1, 16.7),
    ("instagram", 635641.46, 685870.8, -50229.34, 2, 2, 15.8),
    ("twitter", 507573.11, 524106.89, -16533.78, 3, 3, 12.7),
    ("podcast", 474972.69, 449835.91, 25136.78, 4, 5, 11.8),
    ("blog", 459833.41, 469482.1, -9648.69, 5, 4, 11.5),
    ("referral", 444068.28, 356429.23, 87639.05, 6, 8, 11.1),
    ("newsletter", 411670.25, 410929.37, 740.88, 7, 6, 10.3),
    ("organic", 406079.23, 384505.18, 21574.05, 8, 7, 10.1),
]


def _transport(rows_sum, cols_sum):
    """North-west corner: a (last, first) matrix in cents with the given margins."""
    r = [round(v * 100) for v in rows_sum]
    c = [round(v * 100) for v in cols_sum]
    i = j = 0
    cells = []
    while i < len(r) and j < len(c):
        q = min(r[i], c[j])
        if q:
            cells.append((i, j, q))
        r[i] -= q
        c[j] -= q
        if r[i] == 0:
            i += 1
        else:
            j += 1
    return cells


def test_ranking_replay(spark):
    chans = [g[0] for g in RANKING]
    cells = _transport([g[1] for g in RANKING], [g[2] for g in RANKING])
    rows = [(f"u{n}", "CTC-001", D("2024-01-01"), q / 100, chans[i], chans[j], D("2024-01-01"))
            for n, (i, j, q) in enumerate(cells)]
    out = {r["channel"]: r for r in analytics.channel_revenue_ranking(spark.createDataFrame(rows, FACT_SCHEMA))
           .collect()}
    for ch, lt, ft, delta, lr, fr, pct in RANKING:
        r = out[ch]
        assert (r["last_touch_revenue"], r["first_touch_revenue"], r["last_minus_first"]) == (lt, ft, delta)
        assert (r["last_touch_rank"], r["first_touch_rank"], r["pct_of_total_last_touch"]) == (lr, fr, pct)


# campaign_id, budget, attributed_revenue, roi_ratio, net_return
ROI = [("CMP-027", 2500, 22931.97, 9.173, 20431.97), ("CMP-009", 2500, 17741.77, 7.097, 15241.77),
       ("CMP-002", 2500, 16329.06, 6.532, 13829.06), ("CMP-016", 7500, 29122.22, 3.883, 21622.22)]


def test_roi_replay(spark):
    camps = spark.createDataFrame(
        [(c, c, "blog", "CTC-001", b, D("2024-01-01"), D("2024-02-01")) for c, b, _, _, _ in ROI],
        "campaign_id string, campaign_name string, channel string, company_id string, budget int, "
        "start_date date, end_date date")
    attr = spark.createDataFrame([(f"u{c}", c, a) for c, _, a, _, _ in ROI],
                                 "user_id string, campaign_id string, attributed_revenue double")
    out = {r["campaign_id"]: r for r in marts.fct_campaign_roi(camps, attr).collect()}
    for c, b, a, roi, net in ROI:
        assert (out[c]["attributed_revenue"], out[c]["roi_ratio"], out[c]["net_return"]) == (a, roi, net)
        assert out[c]["attributed_users"] == 1


def test_retention_rate_replay(spark):
    # cohort_users, active_users, retention_rate
    golden = [(728, 728, 1.0), (728, 442, 0.607), (728, 366, 0.503), (728, 311, 0.427)]
    rows = []
    for idx, (cohort, active, _) in enumerate(golden):
        month = D(f"2024-{idx + 1:02d}-01")
        rows += [(f"u{k}", "CTC-001", month, 1.0, "blog", "blog", D("2024-01-01")) for k in range(active)]
    out = analytics.cohort_retention_by_channel(spark.createDataFrame(rows, FACT_SCHEMA)).collect()
    assert [(r["cohort_users"], r["active_users"], r["retention_rate"]) for r in out] == golden


# per channel: cohort users (month 0), active at month 1, active at month 12
RETENTION_COUNTS = {"blog": (728, 442, 51), "instagram": (923, 568, 86), "newsletter": (677, 396, 52),
                    "organic": (636, 390, 48), "podcast": (728, 422, 54), "referral": (629, 398, 60),
                    "twitter": (817, 474, 56), "youtube": (1032, 611, 77)}
DASHBOARD_POOLED = {0: 1.0, 1: 0.6, 12: 0.078}


def test_pooled_retention_replay(spark):
    from touchline.plans import report
    rows = []
    for ch, (cohort, m1, m12) in RETENTION_COUNTS.items():
        for k in range(cohort):
            uid = f"{ch}-{k}"
            rows.append((uid, "CTC-001", D("2024-01-01"), 1.0, ch, ch, D("2024-01-01")))
            if k < m1:
                rows.append((uid, "CTC-001", D("2024-02-01"), 1.0, ch, ch, D("2024-01-01")))
            if k < m12:
                rows.append((uid, "CTC-001", D("2025-01-01"), 1.0, ch, ch, D("2024-01-01")))
    out = {r["month_index"]: r for r in report.pooled_retention(spark.createDataFrame(rows, FACT_SCHEMA)).collect()}
    assert {k: out[k]["retention_rate"] for k in DASHBOARD_POOLED} == DASHBOARD_POOLED
    assert out[0]["cohort_users"] == 6170


# V3: the dashboard's monthly totals (whole dollars) are the per-channel trend rows summed.
TREND_BY_MONTH = {
    "2024-01": [("blog", 5381.86), ("instagram", 8019.14), ("newsletter", 5389.09), ("organic", 4608.31),
                ("podcast", 7068.17), ("referral", 6401.84), ("twitter", 10136.26), ("youtube", 9170.8)],
    "2025-06": [("blog", 21453.61), ("instagram", 31340.91), ("newsletter", 19348.4), ("organic", 18731.71),
                ("podcast", 21987.98), ("referral", 20186.92), ("twitter", 22084.46), ("youtube", 31429.25)],
}
DASHBOARD_MONTHLY = {"2024-01": 56175, "2025-06": 186563}


def test_monthly_revenue_replay(spark):
    from touchline.plans import report
    rows = [(f"{m}-{ch}", "CTC-001", D(m + "-01"), v, ch, ch, D("2024-01-01"))
            for m, chans in TREND_BY_MONTH.items() for ch, v in chans]
    out = {r["month"]: r["revenue"] for r in report.monthly_revenue(spark.createDataFrame(rows, FACT_SCHEMA)).collect()}
    assert {m: round(v) for m, v in out.items()} == DASHBOARD_MONTHLY


# V6: published ROI rows (highest first) and the dashboard's top-8 campaign names.
ROI_ROWS = [
    ("CMP-027", "podcast_ctc004_feb2024", "podcast", 2500, 22931.97, 9.173),
    ("CMP-009", "instagram_ctc001_feb2024", "instagram", 2500, 17741.77, 7.097),
    ("CMP-002", "twitter_ctc002_mar2024", "twitter", 2500, 16329.06, 6.532),
    ("CMP-003", "blog_ctc001_oct2024", "blog", 2500, 11957.43, 4.783),
    ("CMP-016", "blog_ctc003_mar2024", "blog", 7500, 29122.22, 3.883),
    ("CMP-023", "podcast_ctc003_apr2024", "podcast", 10000, 35992.56, 3.599),
    ("CMP-001", "blog_ctc001_jan2024", "blog", 7500, 21521.25, 2.87),
    ("CMP-024", "newsletter_ctc004_mar2024", "newsletter", 5000, 14167.75, 2.834),
    ("CMP-011", "youtube_ctc004_oct2024", "youtube", 10000, 28125.89, 2.813),
    ("CMP-012", "youtube_ctc003_feb2025", "youtube", 15000, 39381.03, 2.625),
    ("CMP-018", "youtube_ctc002_sep2024", "youtube", 5000, 12404.73, 2.481),
    ("CMP-026", "podcast_ctc004_jul2024", "podcast", 5000, 10283.96, 2.057),
]
DASHBOARD_TOP = ["podcast_ctc004_feb2024", "instagram_ctc001_feb2024", "twitter_ctc002_mar2024",
                 "blog_ctc001_oct2024", "blog_ctc003_mar2024", "podcast_ctc003_apr2024",
                 "blog_ctc001_jan2024", "newsletter_ctc004_mar2024"]


def test_top_campaigns_replay(spark):
    from touchline.plans import report
    roi = spark.createDataFrame(list(reversed(ROI_ROWS)),
                                "campaign_id string, campaign_name string, channel string, budget int, "
                                "attributed_revenue double, roi_ratio double").repartition(3)
    assert [r["campaign_name"] for r in report.top_campaigns(roi).collect()] == DASHBOARD_TOP
