"""Raw-layer data-quality checks (D1-D25) and the report / gate.

The 21 checks run on the raw tables (before normalisation).  Instead of one
query per check, all single-table checks of a table fold into one aggregate
(one scan per table), the two content-id checks share one anti join, the
orphan-tag and the two campaign-tag checks share one join, and the orphan-revenue and
revenue-before-signup checks share one revenue -> signups join.  The per-table
results are unpivoted into long rows and unioned (no driver round trip).
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from touchline.functions import exact
from touchline.functions.exprs import MONEY, round_dp, safe_div
from touchline.operators.joins import (DEFAULT_BROADCAST_ROWS, bounded_broadcast, lookup_join,
                                      null_aware_anti_count)
from touchline.sources import schemas
from touchline.sources.tables import RawTables

# Check category, severity and meaning, in report order.
CHECKS = [
    ("ri_revenue_user_missing", "error", "revenue rows whose user is not among the signups"),
    ("ri_first_content_missing", "warn", "signups whose first-touch content id is not in content"),
    ("ri_last_content_missing", "warn", "signups whose last-touch content id is not in content"),
    ("ri_bad_company_id", "error", "signups with a company outside the portfolio"),
    ("ri_user_campaign_fk_orphan", "error", "signups whose utm_campaign is not a known campaign"),
    ("ri_content_campaign_fk_orphan", "error", "content whose utm_campaign is not a known campaign"),
    ("utm_source_channel_mismatch", "error", "signups whose utm_source disagrees with the last touch"),
    ("content_utm_source_channel_mismatch", "warn", "content whose utm_source disagrees with its channel"),
    ("missing_utm_source_total", "info", "signups without utm_source"),
    ("missing_utm_source_organic_expected", "info", "  of which organic (expected)"),
    ("missing_utm_source_tracking_loss", "warn", "  of which non-organic (tracking loss)"),
    ("missing_utm_campaign", "info", "signups without utm_campaign"),
    ("content_missing_utm_source", "info", "content without utm_source"),
    ("conflict_first_vs_last_touch", "info", "signups whose first and last touch differ"),
    ("referral_source_contradicts_utm", "warn", "referral source set but neither touch is referral"),
    ("campaign_channel_mismatch", "warn", "tagged campaign's channel matches neither touch"),
    ("campaign_company_mismatch", "warn", "tagged campaign targets another company"),
    ("signup_date_out_of_range", "warn", "signups dated outside the expected window"),
    ("revenue_before_signup", "warn", "revenue months before the user's signup month"),
    ("campaign_bad_window", "error", "campaigns ending before they start"),
    ("content_publish_out_of_range", "warn", "content published outside the expected window"),
]

REPORT_SCHEMA = T.StructType([
    T.StructField("category", T.StringType(), False),
    T.StructField("severity", T.StringType(), False),
    T.StructField("description", T.StringType(), False),
    T.StructField("check_order", T.IntegerType(), False),
])


class DataQualityError(RuntimeError):
    """Raised by :func:`enforce_gate` when an error-severity check fails."""


def _long(wide: DataFrame) -> DataFrame:
    """One-row wide frame of counts -> (category, record_count) rows."""
    cols = wide.columns
    return wide.select(*[F.col(c).cast("bigint").alias(c) for c in cols]).unpivot(
        [], cols, "category", "record_count")


def check_counts(raw: RawTables, date_range: tuple[str, str] = schemas.DATE_RANGE,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """(category, record_count) for all 21 checks."""
    u, c, k, r = raw.user_signups, raw.content_performance, raw.campaign_metadata, raw.portfolio_revenue
    lo, hi = F.lit(date_range[0]).cast("date"), F.lit(date_range[1]).cast("date")
    src, last, first = F.col("utm_source"), F.col("last_touch_channel"), F.col("first_touch_channel")

    users = u.agg(
        F.count_if(~F.col("company_id").isin(schemas.COMPANY_IDS)).alias("ri_bad_company_id"),
        F.count_if(src.isNotNull() & (src != last)).alias("utm_source_channel_mismatch"),
        F.count_if(src.isNull()).alias("missing_utm_source_total"),
        F.count_if(src.isNull() & (last == "organic")).alias("missing_utm_source_organic_expected"),
        F.count_if(src.isNull() & (last != "organic")).alias("missing_utm_source_tracking_loss"),
        F.count_if(F.col("utm_campaign").isNull()).alias("missing_utm_campaign"),
        F.count_if(first != last).alias("conflict_first_vs_last_touch"),
        F.count_if(F.col("referral_source").isNotNull() & (first != "referral") & (last != "referral"))
        .alias("referral_source_contradicts_utm"),
        F.count_if((F.col("signup_date") < lo) | (F.col("signup_date") > hi)).alias("signup_date_out_of_range"),
    )
    content = c.agg(
        F.count_if(F.col("utm_source").isNotNull() & (F.col("utm_source") != "")
                   & (F.col("utm_source") != F.col("channel"))).alias("content_utm_source_channel_mismatch"),
        F.count_if(F.col("utm_source").isNull()).alias("content_missing_utm_source"),
        F.count_if((F.col("publish_date") < lo) | (F.col("publish_date") > hi))
        .alias("content_publish_out_of_range"),
    )
    campaigns = k.agg(F.count_if(F.col("end_date") < F.col("start_date")).alias("campaign_bad_window"))

    # D2 + D3: both touch content ids in one anti join against content.
    touches = (u.select(F.explode(F.array(
        F.struct(F.lit("first").alias("touch"), F.col("first_touch_content_id").alias("cid")),
        F.struct(F.lit("last").alias("touch"), F.col("last_touch_content_id").alias("cid")))).alias("t"))
        .select("t.touch", "t.cid").where(F.col("cid").isNotNull()))
    # content ids broadcast when provably small: a popular content id would
    # otherwise be one hot partition of a shuffle anti join
    ids, _ = bounded_broadcast(c.select(F.col("content_id").alias("__cid")), max_broadcast_rows)
    missing_content = (touches.join(ids, touches["cid"] == ids["__cid"], "left_anti")
                       .agg(F.count_if(F.col("touch") == "first").alias("ri_first_content_missing"),
                            F.count_if(F.col("touch") == "last").alias("ri_last_content_missing")))

    # NOT IN (subquery) semantics over content tags.
    content_orphans = null_aware_anti_count(c.where(F.col("utm_campaign") != ""), k,
                                            "utm_campaign", "utm_campaign", max_broadcast_rows) \
        .withColumnRenamed("n", "ri_content_campaign_fk_orphan")

    # D5 + D16 + D17: one LEFT join of users to the campaign of their tag.  A
    # tagged user without a partner is an orphan (D5), unless the campaign tags
    # contain a NULL, which makes NOT IN never TRUE.
    tags = k.select(F.col("utm_campaign").alias("__tag"), F.col("channel").alias("__cch"),
                    F.col("target_company").alias("__cco"))
    tag_has_null = k.agg(F.max(F.col("utm_campaign").isNull().cast("int"))).scalar()
    tagged = (lookup_join(u, tags, "utm_campaign", "__tag", "left", max_broadcast_rows, salt_on="user_id")
              .agg(F.count_if(F.col("utm_campaign").isNotNull() & F.col("__tag").isNull())
                   .alias("ri_user_campaign_fk_orphan"),
                   F.count_if((F.col("__cch") != first) & (F.col("__cch") != last)).alias("campaign_channel_mismatch"),
                   F.count_if(F.col("__cco") != F.col("company_id")).alias("campaign_company_mismatch"))
              .withColumn("ri_user_campaign_fk_orphan",
                          F.when(F.coalesce(tag_has_null, F.lit(0)) == 1, F.lit(0).cast("bigint"))
                          .otherwise(F.col("ri_user_campaign_fk_orphan"))))

    # D1 + D19: one revenue -> signups join (left: unmatched rows are D1).
    su = u.select(F.col("user_id").alias("__uid"), F.date_format("signup_date", "yyyy-MM").alias("__smonth"))
    rev = (r.join(su, r["user_id"] == su["__uid"], "left")
           .agg(F.count_if(F.col("__uid").isNull()).alias("ri_revenue_user_missing"),
                F.count_if(F.col("__uid").isNotNull() & (F.col("revenue_month") < F.col("__smonth")))
                .alias("revenue_before_signup")))

    out = None
    for wide in (rev, missing_content, users, content_orphans, content, tagged, campaigns):
        part = _long(wide)
        out = part if out is None else out.unionByName(part)
    return out


def dq_report(spark: SparkSession, raw: RawTables, date_range: tuple[str, str] = schemas.DATE_RANGE,
              max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """(category, severity, record_count, pct_of_users, description); the
    share is always over the number of signups, also for content/campaign checks."""
    meta = spark.createDataFrame([(c, s, d, i) for i, (c, s, d) in enumerate(CHECKS)], REPORT_SCHEMA)
    total_users = raw.user_signups.agg(F.count(F.lit(1))).scalar()
    counts = check_counts(raw, date_range, max_broadcast_rows)
    return (counts.join(F.broadcast(meta), "category")
            .select("category", "severity", "record_count",
                    round_dp(F.coalesce(safe_div("record_count", total_users) * 100.0, F.lit(0.0)), 1)
                    .alias("pct_of_users"),
                    "description", "check_order")
            .orderBy("check_order").drop("check_order"))


def anchors(raw: RawTables) -> DataFrame:
    """Total users and total revenue (2 dp), one row."""
    users = raw.user_signups.agg(F.count(F.lit(1))).scalar()
    return exact.ready(raw.portfolio_revenue, "revenue_amount").agg(
        round_dp(exact.sum_of("revenue_amount"), 2).alias("total_revenue")
    ).select(users.cast("bigint").alias("total_users"), "total_revenue")


def amount_precision(raw: RawTables) -> DataFrame:
    """One row: revenue rows, amounts beyond the decimal's range, and amounts
    with more decimals than it holds (their sums are exact to 8 decimals only)."""
    amount = F.col("revenue_amount").cast("double")
    held = amount.try_cast(MONEY)
    return raw.portfolio_revenue.agg(
        F.count(F.lit(1)).alias("revenue_rows"),
        F.count_if(amount.isNotNull() & held.isNull()).alias("beyond_range"),
        F.count_if(held.cast("double") != amount).alias("beyond_scale"))


def gate_failures(report: DataFrame) -> DataFrame:
    """Rows of the report that fail the run: error severity with a count > 0."""
    return report.where((F.col("severity") == "error") & (F.col("record_count") > 0))


def enforce_gate(report: DataFrame) -> None:
    """Raise :class:`DataQualityError` if any error-severity check failed.
    Collects at most the 21 report rows."""
    bad = gate_failures(report).select("category", "record_count").collect()
    if bad:
        detail = ", ".join(f"{r['category']}={r['record_count']}" for r in bad)
        raise DataQualityError(f"{len(bad)} hard data-integrity error(s): {detail}")


def source_profile(raw: RawTables) -> DataFrame:
    """One-row profile of the sources: missing shares (%), first/last touch
    conflict share (%), recurring revenue rows and total revenue.  One aggregate
    per table; the content and revenue figures are struct-valued scalar
    subqueries of the users aggregate."""
    def pct(cond) -> F.Column:
        return round_dp(safe_div(F.count_if(cond) * 100.0, F.count(F.lit(1))), 1)

    def blank(c):
        return F.col(c).isNull() | (F.col(c) == "")

    u, c, r = raw.user_signups, raw.content_performance, raw.portfolio_revenue
    content = c.agg(F.struct(F.count(F.lit(1)).alias("rows"), pct(blank("utm_source")).alias("missing"))).scalar()
    revenue = exact.ready(r, "revenue_amount").agg(F.struct(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("revenue_type") == "recurring").alias("recurring"),
        exact.sum_of("revenue_amount").alias("total"))).scalar()
    users = u.agg(
        F.count(F.lit(1)).alias("users"),
        pct(blank("utm_source")).alias("user_missing_utm_source_pct"),
        pct(blank("utm_campaign")).alias("user_missing_utm_campaign_pct"),
        pct(F.col("first_touch_channel") != F.col("last_touch_channel")).alias("touch_conflict_pct"),
    )
    return users.select(
        content.getField("rows").cast("bigint").alias("content_rows"),
        content.getField("missing").alias("content_missing_utm_source_pct"),
        "users", "user_missing_utm_source_pct", "user_missing_utm_campaign_pct", "touch_conflict_pct",
        revenue.getField("rows").cast("bigint").alias("revenue_rows"),
        revenue.getField("recurring").cast("bigint").alias("recurring_rows"),
        round_dp(revenue.getField("total"), 2).alias("total_revenue"),
    )
