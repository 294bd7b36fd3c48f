"""Stand-in raw sources built from the driver's TPC-H-style tables.

Three of the four reference sources are not published, so the raw layer for
tests and benchmarks is derived from ``part``, ``customer`` and ``orders`` by
fixed arithmetic rules (documented in FIXTURES.md and repeated as CTEs by the
DuckDB oracle).  This module only produces rows in the source schemas; every
model, check and query downstream treats them as opaque input.

Scale notes: orders are pre-aggregated to (customer, month) with a partial
(map-side) aggregate before any shuffle, so a customer holding a large share
of orders never lands as raw rows in one task.  One campaign and one content
piece are derived per part, so every raw table grows with the data.
"""
from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from touchline.functions.exprs import money, month_start, month_str, pick
from touchline.sources import schemas
from touchline.sources.files import conform
from touchline.sources.tables import RawTables

# Fixed values of the adapter rules (FIXTURES.md section 2).
BUDGETS = [2500, 5000, 7500, 10000, 15000, 20000, 30000]
EPOCH = "1995-01-01"


def _days_after(epoch: str, days) -> F.Column:
    return F.date_add(F.lit(epoch).cast("date"), days.cast("int"))


def _user_id(k) -> F.Column:
    """``USR-`` and nine digits, by string functions where nine digits hold the number."""
    short = F.concat(F.lit("USR-"), F.lpad(k.cast("string"), 9, "0"))
    return F.when((k >= 0) & (k < 1_000_000_000), short).otherwise(F.format_string("USR-%09d", k))


def campaigns_from_parts(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    channel = pick(schemas.CONTENT_CHANNELS, p % 6)
    tag = F.format_string("cmp_%03d", p + 1)
    df = part.select(
        F.format_string("CMP-%03d", p + 1).alias("campaign_id"),
        F.concat(channel, F.lit("_"), tag).alias("campaign_name"),
        channel.alias("channel"),
        F.concat(F.lit("CTC-00"), ((F.floor(p / 6) % 4) + 1).cast("string")).alias("target_company"),
        F.element_at(F.array(*[F.lit(b) for b in BUDGETS]), (p % 7 + 1).cast("int")).alias("budget"),
        _days_after(EPOCH, (p * 37) % 730 - 45).alias("start_date"),
        _days_after(EPOCH, (p * 37) % 730 - 45 + 2 + p % 6 + F.when(p % 40 == 0, 60).otherwise(0)).alias("end_date"),
        tag.alias("utm_campaign"),
    )
    return conform(df, schemas.CAMPAIGN_METADATA)


def content_from_parts(part: DataFrame) -> DataFrame:
    p = F.col("p_partkey")
    channel = pick(schemas.CONTENT_CHANNELS, p % 6)
    views = F.when(p % 97 == 0, F.lit(0)).otherwise(F.lit(50) + (p * 7919) % 45000).cast("bigint")
    df = part.select(
        F.format_string("CNT-%08d", p).alias("content_id"),
        F.col("p_name").alias("title"),
        channel.alias("channel"),
        _days_after(EPOCH, p % 540).alias("publish_date"),
        views.alias("views"),
        F.floor(views * (F.lit(8) + p % 52) / 1000).cast("bigint").alias("clicks"),
        F.when(p % 12 == 0, F.lit(None).cast("string")).otherwise(channel).alias("utm_source"),
        F.lit("content").alias("utm_medium"),
        F.when(p % 20 < 9, F.lit(None).cast("string"))
         .otherwise(F.format_string("cmp_%03d", p % 30 + 1)).alias("utm_campaign"),
    )
    return conform(df, schemas.CONTENT_PERFORMANCE)


def _customer_months(orders: DataFrame) -> DataFrame:
    """(customer, order month) grain with the month's order total."""
    return (orders
            .select(F.col("o_custkey").alias("k"),
                    month_start(F.col("o_orderdate")).alias("month"),
                    F.col("o_orderdate").cast("date").alias("day"),
                    money("o_totalprice").alias("price"))
            .groupBy("k", "month")
            .agg(F.sum("price").cast("double").alias("amount"), F.min("day").alias("first_order")))


def signups_from_customers(customer: DataFrame, firsts: DataFrame) -> DataFrame:
    k = F.col("c_custkey")
    f = (k * 7 + F.col("c_nationkey")) % 8
    l_idx = F.when(k % 10 < 3, (f + 1 + k % 7) % 8).otherwise(f)

    def content_id(i):
        return F.when(i <= 5, F.format_string("CNT-%08d", i + (k % 33) * 6))

    # a customer without orders signed up as well, and has no revenue
    first = F.coalesce("first_order_date", _days_after(EPOCH, k % 700))
    df = (customer.join(firsts, customer["c_custkey"] == firsts["k"], "left")
          .select(
              _user_id(k).alias("user_id"),
              F.date_sub(first, (k % 45).cast("int")).alias("signup_date"),
              F.concat(F.lit("CTC-00"), (F.col("c_nationkey") % 4 + 1).cast("string")).alias("company_id"),
              pick(schemas.SIGNUP_CHANNELS, f).alias("first_touch_channel"),
              pick(schemas.SIGNUP_CHANNELS, l_idx).alias("last_touch_channel"),
              content_id(f).alias("first_touch_content_id"),
              content_id(l_idx).alias("last_touch_content_id"),
              F.when((l_idx == 6) | (k % 40 == 7), F.lit(None).cast("string"))
               .otherwise(pick(schemas.SIGNUP_CHANNELS, l_idx)).alias("utm_source"),
              F.when(l_idx == 6, F.lit("organic")).when(l_idx == 7, F.lit("referral"))
               .otherwise(F.lit("content")).alias("utm_medium"),
              F.when(k % 20 < 3, F.lit(None).cast("string"))
               .otherwise(F.format_string("cmp_%03d", k % 30 + 1)).alias("utm_campaign"),
              F.when((f == 7) | (l_idx == 7), F.lit("partner_site"))
               .when(k % 17 == 5, F.lit("reddit")).alias("referral_source"),
          ))
    return conform(df, schemas.USER_SIGNUPS)


def revenue_from_orders(months: DataFrame, customer: DataFrame) -> DataFrame:
    k = F.col("k")
    # a customer has one row a month, so they fit one task
    months = months.withColumn("n_months", F.count(F.lit(1)).over(Window.partitionBy("k")))
    one_time = F.col("n_months") == 1
    cust = customer.select(F.col("c_custkey").alias("k"), "c_nationkey")
    df = (months.join(cust, "k")
          .select(
              _user_id(k).alias("user_id"),
              F.concat(F.lit("CTC-00"), (F.col("c_nationkey") % 4 + 1).cast("string")).alias("company_id"),
              month_str(F.col("month")).alias("revenue_month"),
              F.col("amount").alias("revenue_amount"),
              F.when(one_time, F.lit("one_time")).otherwise(F.lit("recurring")).alias("revenue_type"),
          ))
    return conform(df, schemas.PORTFOLIO_REVENUE)


def from_tpch(spark: SparkSession, sf_dir: str) -> RawTables:
    """Build the raw layer from ``part``, ``customer`` and ``orders`` parquet."""
    part = spark.read.parquet(os.path.join(sf_dir, "part.parquet")).select("p_partkey", "p_name")
    customer = spark.read.parquet(os.path.join(sf_dir, "customer.parquet")).select("c_custkey", "c_nationkey")
    orders = spark.read.parquet(os.path.join(sf_dir, "orders.parquet")).select(
        "o_custkey", "o_orderdate", "o_totalprice")
    months = _customer_months(orders)
    # First order per customer, from the months.
    firsts = months.groupBy("k").agg(F.min("first_order").alias("first_order_date"))
    return RawTables(
        campaign_metadata=campaigns_from_parts(part),
        content_performance=content_from_parts(part),
        user_signups=signups_from_customers(customer, firsts),
        portfolio_revenue=revenue_from_orders(months, customer),
        provenance={
            "raw_campaign_metadata": "part.parquet",
            "raw_content_performance": "part.parquet",
            "raw_portfolio_revenue": "orders.parquet+customer.parquet",
            "raw_user_signups": "customer.parquet+orders.parquet",
        },
    )


def _number(c: str) -> F.Column:
    """The number in an id of the stand-in sources (``USR-000000012`` -> 12)."""
    return F.substring(F.col(c), 5, 12).cast("long")


def dirtied(raw: RawTables) -> RawTables:
    """The same sources with faults of every kind that the checks and tests look
    for (FIXTURES.md section 3); rows in the source schemas, nothing else."""
    k = _number("user_id")

    def swap(name: str, cond, value):
        kind = {f.name: f.dataType for s in schemas.SOURCES.values() for f in s[1].fields}[name]
        return F.when(cond, F.lit(value).cast(kind) if not isinstance(value, F.Column) else value).otherwise(F.col(name))

    users = raw.user_signups.withColumns({
        "company_id": swap("company_id", k % 97 == 3, "CTC-009"),
        "utm_source": swap("utm_source", k % 89 == 5, "tv"),
        "utm_campaign": swap("utm_campaign", k % 83 == 7, "cmp_unknown"),
        "first_touch_content_id": swap("first_touch_content_id", k % 79 == 1, "CNT-none"),
        "last_touch_content_id": swap("last_touch_content_id", k % 73 == 2, "CNT-none"),
        "first_touch_channel": swap("first_touch_channel", k % 61 == 6, None),
        "last_touch_channel": swap("last_touch_channel", k % 59 == 8, "radio"),
    })
    users = users.unionAll(users.where(k % 71 == 0))
    revenue = raw.portfolio_revenue.withColumns({
        "revenue_amount": swap("revenue_amount", F.col("revenue_month").isin("1996-03", "2001-07"), None),
        "revenue_month": swap("revenue_month", k % 47 == 1, "1994-01"),
        "user_id": swap("user_id", k % 53 == 9, F.concat(F.lit("GONE"), F.col("user_id"))),
    })
    c = _number("campaign_id")
    campaigns = raw.campaign_metadata.withColumns({
        "end_date": swap("end_date", c % 11 == 3, F.date_sub("start_date", 5)),
        "utm_campaign": swap("utm_campaign", c % 50 == 10, "cmp_001"),
    })
    p = _number("content_id")
    content = raw.content_performance.withColumns({
        "utm_source": swap("utm_source", p % 19 == 3, "fax"),
        "utm_campaign": swap("utm_campaign", p % 23 == 4, "cmp_none"),
    })
    return RawTables(campaign_metadata=campaigns, content_performance=content, user_signups=users,
                     portfolio_revenue=revenue, provenance=dict(raw.provenance))


#: Date bounds inside the data, for the dirtied sources' range checks.
DIRTY_RANGE = ("1995-06-01", "1995-12-31")
