"""Marts (gold): the revenue fact, campaign ROI, content fact and dimensions."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import exact
from touchline.functions.exprs import month_index, month_str, round_dp, safe_div
from touchline.operators import userset
from touchline.operators.counted import carried, n_rows
from touchline.sources import schemas


def fct_attributed_revenue(revenue: DataFrame, attribution: DataFrame) -> DataFrame:
    """M9: one row per revenue record enriched with both attribution models.

    INNER equi join on user_id (sort-merge at scale, both sides hashed by the
    key).  Attribution is one row per user, so the fact never fans out; an
    orphan revenue row drops here and is caught by the reconciliation tests.  Its equal
    rows are counted if those of ``attribution`` are.
    """
    a = attribution.select(
        F.col("user_id").alias("__auser"), "signup_month",
        "first_touch_channel", "last_touch_channel",
        "first_touch_content_id", "last_touch_content_id",
        "attribution_quality", "is_touch_conflict", "utm_campaign", "is_campaign_tag_trustworthy", *carried(attribution))
    j = revenue.join(a, revenue["user_id"] == a["__auser"], "inner")
    return j.select(
        "revenue_id", "user_id", "company_id", "revenue_month", "revenue_month_str",
        "revenue_amount", "revenue_type", "signup_month",
        "first_touch_channel", "last_touch_channel",
        "first_touch_content_id", "last_touch_content_id",
        "attribution_quality", "is_touch_conflict",
        "utm_campaign", "is_campaign_tag_trustworthy",
        (F.col("first_touch_channel") == F.col("last_touch_channel")).alias("models_agree"),
        *carried(attribution),
    )


def revenue_rollup(fact: DataFrame) -> DataFrame:
    """Exact revenue per (company, month, last-touch, first-touch channel).

    Not a reference model: a physical shortcut for batch runs.  The additive
    analysis queries (channel ranking, coverage total, trend, forecast, ad-hoc
    totals and the additive dashboard aggregates) read the same columns from it
    as from the fact and give identical results, because sums of exact sums
    (:mod:`touchline.functions.exact`) are exact; it has at most channels^2 x companies x months rows, so one
    pass over the fact serves all of them.  Distinct users are in
    :func:`user_activity`.
    """
    return (exact.ready(fact, "revenue_amount").groupBy("company_id", "revenue_month", "last_touch_channel", "first_touch_channel")
            .agg(exact.total_of(fact, "revenue_amount").alias("revenue_amount"),
                 n_rows(fact).alias("revenue_rows")))


def user_numbers(attribution: DataFrame) -> DataFrame:
    """A number for each user, in runs by channel, company and signup month (write it
    before use, see :func:`touchline.operators.userset.numbers`)."""
    return userset.numbers(attribution, "user_id", ["last_touch_channel", "company_id", "signup_month"])


def user_activity(fact: DataFrame, numbers: DataFrame) -> DataFrame:
    """The users active per (company, last-touch channel, months since signup), as
    exact bitmaps over ``numbers``.

    Like :func:`revenue_rollup` a shortcut for batch runs: one pass over the fact
    serves all distinct-user queries (CAC, retention and the dashboard figures made
    of them).  A user takes a bit per month of activity.
    """
    rows = fact.select("user_id", "company_id", F.col("last_touch_channel").alias("channel"),
                       month_index("signup_month", "revenue_month").alias("month_index"))
    return userset.pieces(rows, ["company_id", "channel", "month_index"], "user_id", numbers)


def fct_campaign_roi(campaigns: DataFrame, campaign_attribution: DataFrame) -> DataFrame:
    """Spend vs attributed revenue per campaign.  Attribution is
    aggregated to campaign grain *before* the join, so budgets never fan out."""
    return campaign_roi_of(campaigns, exact.ready(campaign_attribution, "attributed_revenue").groupBy("campaign_id")
                           .agg(F.count_distinct("user_id").alias("attributed_users"),
                                exact.total("attributed_revenue").alias("attributed_revenue")))


def campaign_roi_of(campaigns: DataFrame, credit: DataFrame) -> DataFrame:
    """M10 of the users and the exact revenue of each campaign_id (see
    :func:`touchline.plans.intermediate.int_campaign_credit`)."""
    attributed = credit.select(F.col("campaign_id").alias("__cid"), "attributed_users",
                               round_dp(exact.value("attributed_revenue"), 2).alias("attributed_revenue"))
    j = campaigns.join(attributed, campaigns["campaign_id"] == attributed["__cid"], "left")
    rev = F.coalesce("attributed_revenue", F.lit(0.0))
    return j.select(
        "campaign_id", "campaign_name", "channel", "company_id", "budget", "start_date", "end_date",
        F.coalesce("attributed_users", F.lit(0).cast("bigint")).alias("attributed_users"),
        rev.alias("attributed_revenue"),
        round_dp(safe_div(rev, "budget"), 3).alias("roi_ratio"),
        round_dp(rev - F.col("budget").cast("double"), 2).alias("net_return"),
    )


def fct_content_performance(content: DataFrame) -> DataFrame:
    """Content output and engagement per channel x publish month."""
    return (exact.ready(content, "click_through_rate").groupBy("channel", "publish_month")
            .agg(F.count(F.lit(1)).alias("content_pieces"),
                 F.sum("views").cast("bigint").alias("total_views"),
                 F.sum("clicks").cast("bigint").alias("total_clicks"),
                 round_dp(exact.mean_of("click_through_rate"), 4).alias("avg_click_through_rate"),
                 round_dp(safe_div(F.sum("clicks"), F.sum("views")), 4).alias("blended_click_through_rate"),
                 F.count_if(~F.col("has_utm_source")).alias("pieces_missing_utm_source")))


DIM_CHANNEL_SCHEMA = T.StructType([
    T.StructField("channel", T.StringType(), False),
    T.StructField("channel_display_name", T.StringType(), False),
    T.StructField("channel_type", T.StringType(), False),
    T.StructField("is_paid_content_channel", T.BooleanType(), False),
])

DIM_COMPANY_SCHEMA = T.StructType([
    T.StructField("company_id", T.StringType(), False),
    T.StructField("company_name", T.StringType(), False),
    T.StructField("industry", T.StringType(), False),
    T.StructField("avg_revenue_per_user_benchmark", T.IntegerType(), False),
])


def dim_channel(spark: SparkSession) -> DataFrame:
    """The eight acquisition channels (inline literal relation)."""
    return spark.createDataFrame(schemas.CHANNELS, DIM_CHANNEL_SCHEMA)


def dim_company(spark: SparkSession) -> DataFrame:
    """The four portfolio companies (inline literal relation)."""
    return spark.createDataFrame(schemas.COMPANIES, DIM_COMPANY_SCHEMA)


def dim_time(revenue: DataFrame) -> DataFrame:
    """Gap-free month spine from the first to the last revenue month.

    The bounds are one global partial+final aggregate; the spine is generated
    from that single row (its length is the number of months, not of rows).
    """
    spine = (revenue.agg(F.min("revenue_month").alias("lo"), F.max("revenue_month").alias("hi"))
             .select(F.explode(F.sequence("lo", "hi", F.expr("INTERVAL 1 MONTH"))).alias("m")))
    m = F.col("m")
    return spine.select(
        m.cast("date").alias("month_date"),
        month_str(m).alias("month_str"),
        F.year(m).cast("int").alias("year"),
        F.month(m).cast("int").alias("month_num"),
        F.quarter(m).cast("int").alias("quarter"),
        F.concat(F.year(m).cast("string"), F.lit("-Q"), F.quarter(m).cast("string")).alias("year_quarter"),
    )


def dim_user_cohort(journey: DataFrame) -> DataFrame:
    """User -> signup-month cohort and acquisition channel under both models."""
    return journey.select(
        "user_id", "company_id", "signup_date",
        F.col("signup_month").alias("cohort_month"),
        F.col("last_touch_channel").alias("acquisition_channel_last_touch"),
        F.col("first_touch_channel").alias("acquisition_channel_first_touch"),
        "attribution_quality", "revenue_type", "active_months",
        "first_revenue_month", "last_revenue_month", "total_revenue", *carried(journey),
    )
