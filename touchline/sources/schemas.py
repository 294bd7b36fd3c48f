"""Explicit schemas of the four marketing sources and the fixed domain values.

Nothing is inferred at read time: ``revenue_month`` must stay a ``YYYY-MM``
string and dates must be dates whatever the reader would guess.
"""
from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for identical results)
# ---------------------------------------------------------------------------
# Portfolio companies: id, name, industry, average revenue per user benchmark.
COMPANIES = [
    ("CTC-001", "GreenLeaf Landscaping", "Home Services", 120),
    ("CTC-002", "BrightPath Education", "Education", 85),
    ("CTC-003", "QuickFix Auto Repair", "Automotive", 210),
    ("CTC-004", "Summit Dental Group", "Healthcare", 165),
]
COMPANY_IDS = [c[0] for c in COMPANIES]

# Paid/owned content channels, then the two signup-only channels.
CONTENT_CHANNELS = ["youtube", "twitter", "instagram", "newsletter", "podcast", "blog"]
SIGNUP_CHANNELS = CONTENT_CHANNELS + ["organic", "referral"]

# Channel dimension: channel, display name, type, paid-content flag.
CHANNELS = [
    ("youtube", "YouTube", "content", True),
    ("twitter", "Twitter/X", "content", True),
    ("instagram", "Instagram", "content", True),
    ("newsletter", "Newsletter", "content", True),
    ("podcast", "Podcast", "content", True),
    ("blog", "Blog", "content", True),
    ("organic", "Organic", "earned", False),
    ("referral", "Referral", "earned", False),
]

# Attribution-quality labels in priority order (first matching flag wins).
QUALITY_LABELS = [
    ("is_touch_conflict", "touch_conflict"),
    ("is_utm_tracking_loss", "utm_tracking_loss"),
    ("has_referral_mismatch", "referral_mismatch"),
    ("is_organic", "organic_no_utm"),
]
QUALITY_DEFAULT = "clean"
QUALITY_VALUES = ["clean", "touch_conflict", "utm_tracking_loss", "referral_mismatch", "organic_no_utm"]

REVENUE_TYPES = ["one_time", "recurring"]

# Tolerance of the reconciliation tests, in currency units.
RECONCILIATION_TOLERANCE = 0.01

# Sane date window of the raw-layer date checks.
DATE_RANGE = ("2024-01-01", "2025-06-30")

# ---------------------------------------------------------------------------
# Source schemas.  Every field is nullable: the raw layer is a faithful copy
# of dirty sources and the checks count the NULLs (file readers make fields
# nullable anyway); the not-null expectations are tests, not reader rules.
# ---------------------------------------------------------------------------
CAMPAIGN_METADATA = T.StructType([
    T.StructField("campaign_id", T.StringType(), True),
    T.StructField("campaign_name", T.StringType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("target_company", T.StringType(), True),
    T.StructField("budget", T.IntegerType(), True),
    T.StructField("start_date", T.DateType(), True),
    T.StructField("end_date", T.DateType(), True),
    T.StructField("utm_campaign", T.StringType(), True),
])

CONTENT_PERFORMANCE = T.StructType([
    T.StructField("content_id", T.StringType(), True),
    T.StructField("title", T.StringType(), True),
    T.StructField("channel", T.StringType(), True),
    T.StructField("publish_date", T.DateType(), True),
    T.StructField("views", T.LongType(), True),
    T.StructField("clicks", T.LongType(), True),
    T.StructField("utm_source", T.StringType(), True),
    T.StructField("utm_medium", T.StringType(), True),
    T.StructField("utm_campaign", T.StringType(), True),
])

USER_SIGNUPS = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("signup_date", T.DateType(), True),
    T.StructField("company_id", T.StringType(), True),
    T.StructField("first_touch_channel", T.StringType(), True),
    T.StructField("last_touch_channel", T.StringType(), True),
    T.StructField("first_touch_content_id", T.StringType(), True),
    T.StructField("last_touch_content_id", T.StringType(), True),
    T.StructField("utm_source", T.StringType(), True),
    T.StructField("utm_medium", T.StringType(), True),
    T.StructField("utm_campaign", T.StringType(), True),
    T.StructField("referral_source", T.StringType(), True),
])

PORTFOLIO_REVENUE = T.StructType([
    T.StructField("user_id", T.StringType(), True),
    T.StructField("company_id", T.StringType(), True),
    T.StructField("revenue_month", T.StringType(), True),
    T.StructField("revenue_amount", T.DoubleType(), True),
    T.StructField("revenue_type", T.StringType(), True),
])

# Registry: logical raw table -> (canonical file name, schema).
SOURCES = {
    "raw_campaign_metadata": ("campaign_metadata.csv", CAMPAIGN_METADATA),
    "raw_content_performance": ("content_performance.csv", CONTENT_PERFORMANCE),
    "raw_portfolio_revenue": ("portfolio_revenue.csv", PORTFOLIO_REVENUE),
    "raw_user_signups": ("user_signups.json", USER_SIGNUPS),
}
