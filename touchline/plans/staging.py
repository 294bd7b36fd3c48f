"""Staging models (silver): typed, normalised, flagged; never drop a row.

Each function is a narrow projection over one raw table (no shuffle).
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions.exprs import month_from_str, month_start, norm, round_dp


def stg_campaign_metadata(raw: DataFrame) -> DataFrame:
    """M1: normalised channel, ``target_company`` renamed, typed budget and dates."""
    return raw.select(
        "campaign_id",
        "campaign_name",
        norm("channel").alias("channel"),
        F.col("target_company").alias("company_id"),
        F.col("budget").cast("int").alias("budget"),
        F.col("start_date").cast("date").alias("start_date"),
        F.col("end_date").cast("date").alias("end_date"),
        "utm_campaign",
    )


def stg_content_performance(raw: DataFrame) -> DataFrame:
    """M2: publish month, CTR = clicks / views at 4 dp (0 when views <= 0 or NULL)."""
    views, clicks = F.col("views").cast("bigint"), F.col("clicks").cast("bigint")
    ctr = F.when(views > 0, clicks.cast("double") / views.cast("double")).otherwise(F.lit(0.0))
    return raw.select(
        "content_id",
        "title",
        norm("channel").alias("channel"),
        F.col("publish_date").cast("date").alias("publish_date"),
        month_start("publish_date").alias("publish_month"),
        views.alias("views"),
        clicks.alias("clicks"),
        round_dp(ctr, 4).alias("click_through_rate"),
        "utm_source",
        "utm_medium",
        "utm_campaign",
        F.col("utm_source").isNotNull().alias("has_utm_source"),
    )


def stg_portfolio_revenue(raw: DataFrame) -> DataFrame:
    """M3: surrogate key md5(user_id || '|' || month), month text -> first-of-month date."""
    return raw.select(
        # concat is NULL-propagating like SQL ||; never concat_ws (skips NULLs).
        F.md5(F.concat(F.col("user_id"), F.lit("|"), F.col("revenue_month"))).alias("revenue_id"),
        "user_id",
        "company_id",
        F.col("revenue_month").alias("revenue_month_str"),
        month_from_str("revenue_month").alias("revenue_month"),
        F.col("revenue_amount").cast("double").alias("revenue_amount"),
        norm("revenue_type").alias("revenue_type"),
    )


def stg_user_signups(raw: DataFrame) -> DataFrame:
    """M4: typed signup with six data-quality flags (three-valued, not coalesced)."""
    first, last = norm("first_touch_channel"), norm("last_touch_channel")
    src_null = F.col("utm_source").isNull()
    return raw.select(
        "user_id",
        F.col("signup_date").cast("date").alias("signup_date"),
        month_start("signup_date").alias("signup_month"),
        "company_id",
        first.alias("first_touch_channel"),
        last.alias("last_touch_channel"),
        "first_touch_content_id",
        "last_touch_content_id",
        "utm_source",
        "utm_medium",
        "utm_campaign",
        "referral_source",
        (last == "organic").alias("is_organic"),
        (~src_null).alias("has_utm_source"),
        F.col("utm_campaign").isNotNull().alias("has_utm_campaign"),
        (first != last).alias("is_touch_conflict"),
        # NULL utm_source on a non-organic last touch = tracking loss
        (src_null & (last != "organic")).alias("is_utm_tracking_loss"),
        # referral source present while neither touch is referral
        (F.col("referral_source").isNotNull() & (first != "referral") & (last != "referral"))
        .alias("has_referral_mismatch"),
    )
