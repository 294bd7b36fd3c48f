"""Analysis queries over the marts (Q1-Q7).

Every query first aggregates the fact with a partial (map-side) aggregate:
sums go straight to a grain bounded by the domain (channels x companies x
months), distinct counts through a (group, user_id) level first.  Windows,
ranks and joins then run on the few aggregated rows only.  Sums stay exact
until the final projection, see :mod:`touchline.functions.exact`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import exact
from touchline.functions.exprs import month_index, month_str, round_dp, safe_div
from touchline.operators import userset


def channel_revenue_ranking(fact: DataFrame) -> DataFrame:
    """Q1 ordered by last-touch revenue (see :func:`channel_ranking_rows`)."""
    return channel_ranking_rows(fact).orderBy(F.desc_nulls_last("last_touch_revenue"))


def channel_ranking_rows(fact: DataFrame) -> DataFrame:
    """Q1: revenue per channel under last- and first-touch attribution, their
    difference, a rank per model and the share of the last-touch total.

    One scan of the fact: a partial aggregate per (last, first) channel pair
    (at most 8 x 8 groups) from which both per-model totals are rolled up.  A
    channel present under one model only has NULL on the other side.
    """
    pairs = (exact.ready(fact, "revenue_amount").groupBy(F.col("last_touch_channel").alias("l"), F.col("first_touch_channel").alias("f"))
             .agg(exact.total_of(fact, "revenue_amount").alias("amt")))
    last = pairs.groupBy(F.col("l").alias("channel")).agg(exact.add("amt").alias("l_amt"))
    first = pairs.groupBy(F.col("f").alias("channel")).agg(exact.add("amt").alias("f_amt"))
    everything = Window.partitionBy()  # <= 8 rows after aggregation
    both = (last.join(first, "channel", "full_outer")  # USING: channel is coalesced
            .select("channel", exact.value("l_amt").alias("l_rev"), exact.value("f_amt").alias("f_rev"),
                    exact.value(exact.minus("l_amt", "f_amt")).alias("difference"),
                    exact.add_over("l_amt", everything).alias("all_amt")))
    return both.select(
        "channel",
        round_dp("l_rev", 2).alias("last_touch_revenue"),
        round_dp("f_rev", 2).alias("first_touch_revenue"),
        round_dp("difference", 2).alias("last_minus_first"),
        F.rank().over(everything.orderBy(F.desc_nulls_last("l_rev"))).cast("bigint").alias("last_touch_rank"),
        F.rank().over(everything.orderBy(F.desc_nulls_last("f_rev"))).cast("bigint").alias("first_touch_rank"),
        round_dp(safe_div(F.lit(100.0) * F.col("l_rev"), exact.value("all_amt")), 1).alias("pct_of_total_last_touch"),
    )


def campaign_roi(roi: DataFrame) -> DataFrame:
    """Campaigns ranked by revenue per dollar of budget."""
    return (roi.select("campaign_id", "campaign_name", "channel", "company_id", "budget",
                       "attributed_users", "attributed_revenue", "roi_ratio", "net_return")
            .orderBy(F.desc_nulls_last("roi_ratio")))


def campaign_roi_coverage(roi: DataFrame, fact: DataFrame) -> DataFrame:
    """One row - revenue tied to any campaign, total revenue, % covered, spend.
    The fact total is a scalar subquery computed once."""
    total = exact.ready(fact, "revenue_amount").agg(exact.value(exact.total_of(fact, "revenue_amount"))).scalar()
    sums = exact.ready(roi, "attributed_revenue").agg(exact.total("attributed_revenue").alias("tied"), F.sum("budget").cast("double").alias("total_spend"))
    return sums.select(exact.value("tied").alias("tied"), "total_spend").select(
        round_dp("tied", 2).alias("revenue_tied_to_campaigns"),
        round_dp(total, 2).alias("total_revenue"),
        round_dp(safe_div(F.lit(100.0) * F.col("tied"), total), 1).alias("pct_covered"),
        "total_spend",
    )


def cac_by_channel_company(fact: DataFrame, campaigns: DataFrame, activity: DataFrame | None = None) -> DataFrame:
    """Q3 ordered by company, then CAC with NULLs last."""
    return cac_rows(fact, campaigns, activity).orderBy(F.asc_nulls_last("company_id"), F.asc_nulls_last("cac"))


def cac_rows(fact: DataFrame, campaigns: DataFrame, activity: DataFrame | None = None) -> DataFrame:
    """Q3: spend / distinct customers per company x last-touch channel; NULL CAC
    where there is no spend.  Spend and customers are aggregated separately,
    then joined on the two keys, so budgets never fan out over revenue rows.  With
    ``activity`` (:func:`touchline.plans.marts.user_activity`) customers are counted
    there, and ``fact`` may be the rollup."""
    groups = exact.ready(fact, "revenue_amount").groupBy(F.col("last_touch_channel").alias("channel"), "company_id")
    revenue = round_dp(exact.value(exact.total_of(fact, "revenue_amount")), 2).alias("attributed_revenue")
    if activity is None:
        acquired = groups.agg(F.count_distinct("user_id").alias("customers_acquired"), revenue)
    else:
        users = userset.counted(activity, ["channel", "company_id"], "n").select(
            F.col("channel").alias("__ch"), F.col("company_id").alias("__co"), "n")
        acquired = (groups.agg(revenue).join(users, F.col("channel").eqNullSafe(F.col("__ch")) & F.col("company_id").eqNullSafe(F.col("__co")), "left")
                    .withColumn("customers_acquired", F.coalesce("n", F.lit(0).cast("long"))).drop("__ch", "__co", "n"))
    spend = (campaigns.groupBy("channel", "company_id")
             .agg(F.sum("budget").cast("double").alias("total_spend")))
    j = acquired.join(spend, ["channel", "company_id"], "left")
    cust, sp, rev = F.col("customers_acquired"), F.col("total_spend"), F.col("attributed_revenue")
    return j.select(
        "company_id", "channel", "customers_acquired", "total_spend",
        F.when(sp.isNotNull() & (cust > 0), round_dp(safe_div(sp, cust), 2)).alias("cac"),
        round_dp(safe_div(rev, cust), 2).alias("revenue_per_customer"),
        F.when(sp > 0, round_dp(safe_div(rev, sp), 2)).alias("revenue_per_dollar_spent"),
    )


def cohort_retention_by_channel(fact: DataFrame, max_index: int = 12, activity: DataFrame | None = None) -> DataFrame:
    """Q4 ordered by channel and month index."""
    return retention_rows(fact, max_index, activity).orderBy(F.asc_nulls_last("channel"), F.asc_nulls_last("month_index"))


def retention_rows(fact: DataFrame | None, max_index: int = 12, activity: DataFrame | None = None) -> DataFrame:
    """Q4: distinct users active N month boundaries after their signup month,
    per last-touch channel, over the users active in month 0 of that channel.

    The month-0 cohort is the month-0 row of the same aggregate, attached with a
    window over <= 13 rows per channel (no self join); channels without month-0
    users drop out, as with an inner join.  With ``activity``
    (:func:`touchline.plans.marts.user_activity`) the fact is not read."""
    wanted = F.col("month_index").between(0, max_index)
    if activity is None:
        rev = fact.select(F.col("last_touch_channel").alias("channel"), "user_id",
                          month_index("signup_month", "revenue_month").alias("month_index"))
        active = rev.where(wanted).groupBy("channel", "month_index").agg(F.count_distinct("user_id").alias("active_users"))
    else:
        active = userset.counted(activity.where(wanted), ["channel", "month_index"], "active_users")
    cohort = F.max(F.when(F.col("month_index") == 0, F.col("active_users"))).over(Window.partitionBy("channel"))
    return (active.withColumn("cohort_users", cohort)
            .where(F.col("cohort_users").isNotNull())
            .select("channel", "month_index", "cohort_users", "active_users",
                    round_dp(safe_div("active_users", "cohort_users"), 3).alias("retention_rate")))


def revenue_trend_by_channel(fact: DataFrame) -> DataFrame:
    """Q5: monthly revenue per last-touch channel, month-over-month growth %
    and the trailing 3-row mean.  Row based, like the reference: a missing
    month makes lag look at the previous existing row."""
    monthly = (exact.ready(fact, "revenue_amount").groupBy(F.col("last_touch_channel").alias("channel"), "revenue_month")
               .agg(exact.total_of(fact, "revenue_amount").alias("amt"))
               .withColumn("rev", exact.value("amt")))
    w = Window.partitionBy("channel").orderBy("revenue_month")
    trailing = w.rowsBetween(-2, Window.currentRow)
    near = monthly.select(
        "channel", "revenue_month", "amt", "rev",
        F.lag("amt").over(w).alias("prev"), F.lag("rev").over(w).alias("prev_rev"),
        exact.add_over("amt", trailing).alias("near_amt"), F.count("rev").over(trailing).alias("near_months"))
    return near.select(
        "channel",
        month_str("revenue_month").alias("month"),
        round_dp("rev", 2).alias("revenue"),
        round_dp(safe_div(F.lit(100.0) * exact.value(exact.minus("amt", "prev")), "prev_rev"), 1).alias("mom_growth_pct"),
        round_dp(safe_div(exact.value("near_amt"), "near_months"), 2).alias("trailing_3mo_avg"),
        "revenue_month",
    ).orderBy(F.asc_nulls_last("channel"), F.asc_nulls_last("revenue_month")).drop("revenue_month")


def forecast_by_company(fact: DataFrame, horizon: int = 3, trailing_months: int = 3,
                        actual_months: int = 6) -> DataFrame:
    """Q6: flat projection of each company's mean monthly revenue over the
    calendar months >= last - (trailing_months - 1), for ``horizon`` months after
    its last month, plus its actuals from last - (actual_months - 1) on."""
    monthly = (exact.ready(fact, "revenue_amount").groupBy("company_id", "revenue_month")
               .agg(exact.total_of(fact, "revenue_amount").alias("amt"))
               .withColumn("rev", exact.value("amt"))
               .withColumn("last_month", F.max("revenue_month").over(Window.partitionBy("company_id"))))
    since = lambda n: F.col("revenue_month") >= F.add_months("last_month", -(n - 1))
    mean = (monthly.where(since(trailing_months))
            .groupBy("company_id", "last_month")
            .agg(round_dp(safe_div(exact.value(exact.add("amt")), F.count("rev")), 2).alias("avg_rev")))
    actual = monthly.where(since(actual_months)).select(
        "company_id", "revenue_month", round_dp("rev", 2).alias("revenue"),
        F.lit("actual").alias("row_type"))
    forecast = (mean.select("company_id", "last_month", "avg_rev",
                            F.explode(F.sequence(F.lit(1), F.lit(horizon))).alias("g"))
                .select("company_id", F.add_months("last_month", F.col("g")).alias("revenue_month"),
                        F.col("avg_rev").alias("revenue"), F.lit("forecast").alias("row_type")))
    return (actual.unionByName(forecast)
            .select("company_id", month_str("revenue_month").alias("month"), "revenue", "row_type")
            .orderBy(F.asc_nulls_last("company_id"), F.asc_nulls_last("month")))


def channel_revenue_totals(fact: DataFrame) -> DataFrame:
    """Q7: revenue per last-touch channel rounded to whole units, descending."""
    return (exact.ready(fact, "revenue_amount").groupBy(F.col("last_touch_channel").alias("channel"))
            .agg(round_dp(exact.value(exact.total_of(fact, "revenue_amount")), 0).alias("revenue"))
            .orderBy(F.desc_nulls_last("revenue")))
