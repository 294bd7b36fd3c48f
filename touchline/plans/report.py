"""Dashboard and one-pager aggregates.

Each is a small aggregate over the marts or over an analysis result; joins to
the channel / company dimensions broadcast those literal relations (their size
is fixed by construction).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import exact
from touchline.functions.exprs import month_str, round_dp, safe_div
from touchline.operators.joins import literal_broadcast
from touchline.plans import analytics

# Fixed values (as the dashboard defines them): spend-verdict thresholds on
# revenue per dollar of spend, and the channels whose combined share it headlines.
STOP_BELOW = 2.0
KEEP_ABOVE = 10.0
TOP_CHANNELS = ("youtube", "instagram")


def channel_view(fact: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """V1: channel ranking with display name and channel type."""
    r = analytics.channel_ranking_rows(fact)
    d = literal_broadcast(dim_channel.select("channel", "channel_display_name", "channel_type"))
    return (r.join(d, "channel", "left")
            .select("channel", "channel_display_name", "channel_type", "last_touch_revenue",
                    "first_touch_revenue", "pct_of_total_last_touch")
            .orderBy(F.desc_nulls_last("last_touch_revenue")))


def channel_type_split(fact: DataFrame, dim_channel: DataFrame) -> DataFrame:
    """V2: last-touch revenue per channel type (content vs earned).  The fact is
    aggregated to channel grain before the dimension join."""
    per_channel = (exact.ready(fact, "revenue_amount").groupBy(F.col("last_touch_channel").alias("channel"))
                   .agg(exact.total_of(fact, "revenue_amount").alias("amt")))
    d = literal_broadcast(dim_channel.select("channel", "channel_type"))
    return (per_channel.join(d, "channel", "left")
            .groupBy("channel_type")
            .agg(round_dp(exact.value(exact.add("amt")), 2).alias("revenue")))


def monthly_revenue(fact: DataFrame) -> DataFrame:
    """V3: total revenue per month."""
    return (exact.ready(fact, "revenue_amount").groupBy("revenue_month")
            .agg(round_dp(exact.value(exact.total_of(fact, "revenue_amount")), 2).alias("revenue"))
            .orderBy(F.asc_nulls_last("revenue_month"))
            .select(month_str("revenue_month").alias("month"), "revenue"))


def company_cac(fact: DataFrame, campaigns: DataFrame, company_id: str | None = None,
                activity: DataFrame | None = None) -> DataFrame:
    """V4: CAC rows that carry spend, for one company or (None) for all."""
    rows = analytics.cac_rows(fact, campaigns, activity).where(F.col("total_spend").isNotNull())
    if company_id is not None:
        rows = rows.where(F.col("company_id") == company_id)
    return rows.select("company_id", "channel", "customers_acquired", "total_spend", "cac",
                       "revenue_per_dollar_spent")


def spend_verdict(fact: DataFrame, campaigns: DataFrame, stop_below: float = STOP_BELOW,
                  keep_above: float = KEEP_ABOVE, activity: DataFrame | None = None) -> DataFrame:
    """V5: 'stop' below ``stop_below`` revenue per dollar, 'keep' above
    ``keep_above``, NULL in between, for every company x channel with spend."""
    rpd = F.col("revenue_per_dollar_spent")
    return company_cac(fact, campaigns, activity=activity).select(
        "company_id", "channel", "revenue_per_dollar_spent",
        F.when(rpd < stop_below, F.lit("stop")).when(rpd > keep_above, F.lit("keep")).alias("verdict"))


def top_campaigns(roi: DataFrame, k: int = 8) -> DataFrame:
    """V6: the ``k`` campaigns with the highest ROI (ties broken by campaign id).
    A top-k: Spark plans it as TakeOrderedAndProject (per-partition top-k, no
    full sort)."""
    return (roi.select("campaign_id", "campaign_name", "channel", "budget", "attributed_revenue", "roi_ratio")
            .orderBy(F.desc_nulls_last("roi_ratio"), F.asc_nulls_last("campaign_id"))
            .limit(k))


def pooled_retention(fact: DataFrame | None, activity: DataFrame | None = None) -> DataFrame:
    """V7: retention by month index pooled over channels: sum(active) / sum(cohort)."""
    r = analytics.retention_rows(fact, activity=activity)
    return (r.groupBy("month_index")
            .agg(F.sum("cohort_users").cast("bigint").alias("cohort_users"),
                 F.sum("active_users").cast("bigint").alias("active_users"))
            .select("month_index", "cohort_users", "active_users",
                    round_dp(safe_div("active_users", "cohort_users"), 3).alias("retention_rate"))
            .orderBy(F.asc_nulls_last("month_index")))


def quality_label_counts(attribution: DataFrame) -> DataFrame:
    """V8: users per attribution-quality label and their share in %."""
    counts = attribution.groupBy("attribution_quality").agg(F.count(F.lit(1)).alias("users"))
    total = F.sum("users").over(Window.partitionBy())  # <= 5 label rows
    return counts.select("attribution_quality", "users",
                         round_dp(safe_div(F.col("users") * 100.0, total), 1).alias("pct_of_users"))


def company_revenue(fact: DataFrame, dim_company: DataFrame) -> DataFrame:
    """V9: revenue per company with its name, descending."""
    per_company = (exact.ready(fact, "revenue_amount").groupBy("company_id")
                   .agg(round_dp(exact.value(exact.total_of(fact, "revenue_amount")), 2).alias("revenue")))
    d = literal_broadcast(dim_company.select("company_id", "company_name"))
    return (per_company.join(d, "company_id", "left")
            .select("company_id", "company_name", "revenue")
            .orderBy(F.desc_nulls_last("revenue")))


def top_channel_share(fact: DataFrame, channels: Sequence[str] = TOP_CHANNELS) -> DataFrame:
    """Last-touch revenue of the named channels and its share of the total."""
    quoted = ", ".join("'" + c.replace("\\", "\\\\").replace("'", "\\'") + "'" for c in channels)
    named = f"last_touch_channel IN ({quoted})" if quoted else "false"
    sums = exact.ready(fact, "revenue_amount").agg(exact.total_of(fact, "revenue_amount", when=named).alias("top"),
                    exact.total_of(fact, "revenue_amount").alias("total"))
    return sums.select(F.coalesce(exact.value("top"), F.lit(0.0)).alias("top"), exact.value("total").alias("total")).select(
        round_dp("top", 2).alias("top_revenue"),
        round_dp("total", 2).alias("total_revenue"),
        round_dp(safe_div(F.lit(100.0) * F.col("top"), "total"), 1).alias("pct_of_total"),
    )


def active_months_by_channel(journey: DataFrame) -> DataFrame:
    """Mean active revenue months per user, per last-touch channel and
    over all users (channel '(all)'); users without revenue count as 0."""
    def agg(df):
        return df.agg(F.count(F.lit(1)).alias("users"),
                      round_dp(safe_div(F.sum("active_months"), F.count("active_months")), 2)
                      .alias("avg_active_months"))
    per = agg(journey.groupBy(F.col("last_touch_channel").alias("channel")))
    overall = agg(journey).select(F.lit("(all)").alias("channel"), "users", "avg_active_months")
    return per.unionByName(overall)
