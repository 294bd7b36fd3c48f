"""Intermediate models: user grain (M5-M7) and user x campaign grain (M8)."""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from touchline.functions import exact
from touchline.functions.exact import TIMES
from touchline.functions.exprs import is_in, round_dp
from touchline.operators.counted import carried, in_steps, n_rows, repeated, written
from touchline.operators.joins import DEFAULT_BROADCAST_ROWS, interval_join, lookup_join
from touchline.operators.sweep import EVENTS_PER_SLAB, sweep_join
from touchline.sources import schemas


def quality_label() -> F.Column:
    """One mutually exclusive label per user; first TRUE flag in priority order
    wins, a NULL flag falls through like a FALSE one."""
    expr = None
    for flag, label in schemas.QUALITY_LABELS:
        expr = F.when(F.col(flag), F.lit(label)) if expr is None else expr.when(F.col(flag), F.lit(label))
    return expr.otherwise(F.lit(schemas.QUALITY_DEFAULT))


def int_user_attribution(signups: DataFrame, campaigns: DataFrame,
                         max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """M5: users LEFT JOIN campaigns on the (exact-case) utm_campaign tag.

    The campaign side is broadcast when provably small, else reduced to the
    tags that occur among the users and broadcast if that is small, else joined
    by a shuffle on the tag salted by user (see :func:`lookup_join`): a tag
    held by a third of the users, or the NULL tag, never lands in one task.
    """
    return repeated(int_user_attribution_counted(signups, campaigns, max_broadcast_rows))


def int_user_attribution_counted(signups: DataFrame, campaigns: DataFrame,
                                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """M5 with its equal rows counted (:mod:`touchline.operators.counted`): of the
    campaigns that hold a tag, the model takes channel and company only."""
    tags = campaigns.groupBy(
        F.col("utm_campaign").alias("__tag"),
        F.col("channel").alias("campaign_channel"),
        F.col("company_id").alias("campaign_company"),
    ).agg(F.count(F.lit(1)).alias(TIMES))
    j = lookup_join(signups, tags, "utm_campaign", "__tag", "left", max_broadcast_rows, salt_on="user_id")
    trust = (F.col("utm_campaign").isNotNull()
             & is_in("campaign_channel", "first_touch_channel", "last_touch_channel")
             & (F.col("campaign_company") == F.col("company_id")))
    return j.select(
        "user_id", "company_id", "signup_date", "signup_month",
        "first_touch_channel", "last_touch_channel",
        "first_touch_content_id", "last_touch_content_id",
        quality_label().alias("attribution_quality"),
        "is_touch_conflict", "is_organic", "is_utm_tracking_loss",
        "has_referral_mismatch", "has_utm_campaign",
        "utm_campaign", "campaign_channel", "campaign_company",
        trust.alias("is_campaign_tag_trustworthy"),
        F.coalesce(TIMES, F.lit(1).cast("long")).alias(TIMES),
    )


def int_user_revenue(revenue: DataFrame) -> DataFrame:
    """M6: per (user, company) revenue summary.  Partial aggregation runs
    map-side, so a heavy user is combined before the shuffle."""
    return (exact.ready(revenue, "revenue_amount").groupBy("user_id", "company_id")
            .agg(F.min("revenue_type").alias("revenue_type"),
                 F.count(F.lit(1)).alias("active_months"),
                 F.min("revenue_month").alias("first_revenue_month"),
                 F.max("revenue_month").alias("last_revenue_month"),
                 round_dp(exact.sum_of("revenue_amount"), 2).alias("total_revenue"),
                 round_dp(exact.mean_of("revenue_amount"), 2).alias("avg_monthly_revenue")))


def int_user_journey(attribution: DataFrame, user_revenue: DataFrame) -> DataFrame:
    """M7: attribution LEFT JOIN revenue summary on user_id, zero-filled (counted, if
    ``attribution`` is)."""
    r = user_revenue.select(
        F.col("user_id").alias("__ruser"), "revenue_type", "active_months",
        "first_revenue_month", "last_revenue_month", "total_revenue", "avg_monthly_revenue")
    j = attribution.join(r, attribution["user_id"] == r["__ruser"], "left")
    return j.select(
        "user_id", "company_id", "signup_date", "signup_month",
        "first_touch_channel", "last_touch_channel", "attribution_quality",
        "is_touch_conflict", "is_campaign_tag_trustworthy", "utm_campaign",
        "revenue_type",
        F.coalesce("active_months", F.lit(0).cast("bigint")).alias("active_months"),
        "first_revenue_month", "last_revenue_month",
        F.coalesce("total_revenue", F.lit(0.0)).alias("total_revenue"),
        F.coalesce("avg_monthly_revenue", F.lit(0.0)).alias("avg_monthly_revenue"),
        F.col("__ruser").isNotNull().alias("has_revenue"), *carried(attribution),
    )


def _places(journey: DataFrame) -> DataFrame:
    """What the campaign credit takes of a user row."""
    return journey.select(
        "user_id",
        F.col("company_id").alias("__ucompany"),
        F.col("last_touch_channel").alias("__uchannel"),
        "signup_date", "total_revenue", *carried(journey))


def _credited(users: DataFrame, windows: DataFrame) -> DataFrame:
    """The user rows (:func:`_places`) that match campaigns, with the number of
    matches of their user and the share that each match gets.

    Matches are counted, not made: how many windows cover a day of a (channel,
    company) is a running sum of their starts and ends, with one row for each key and
    day, so a user's number is known before any match is written."""
    keys = ["__c", "__o"]
    valid = windows.filter(F.col("start_date") <= F.col("end_date")).select(
        F.col("channel").alias("__c"), F.col("company_id").alias("__o"),
        F.explode(F.array(F.struct(F.col("start_date").alias("__d"), F.lit(1).cast("long").alias("__n")),
                          F.struct(F.date_add("end_date", 1).alias("__d"), F.lit(-1).cast("long").alias("__n")))).alias("__e"))
    ends = valid.groupBy(*keys, F.col("__e.__d").alias("__d")).agg(F.sum("__e.__n").alias("__n"), F.lit(False).alias("__at"))
    days = users.groupBy(F.col("__uchannel").alias("__c"), F.col("__ucompany").alias("__o"), F.col("signup_date").alias("__d")).agg(
        F.lit(0).cast("long").alias("__n"), F.lit(True).alias("__at"))
    line = ends.unionByName(days).dropna().groupBy(*keys, "__d").agg(F.sum("__n").alias("__n"), F.max("__at").alias("__at"))
    # one row for each day of the calendar at most, so a key's days fit one task
    cover = line.withColumn("__cover", F.sum("__n").over(Window.partitionBy(*keys).orderBy("__d").rowsBetween(
        Window.unboundedPreceding, Window.currentRow))).filter("__at AND __cover > 0").drop("__n", "__at")
    met = users.join(cover, [users["__uchannel"] == cover["__c"], users["__ucompany"] == cover["__o"], users["signup_date"] == cover["__d"]])
    own = F.col("__cover") * F.col(TIMES) if TIMES in users.columns else F.col("__cover")
    return (met.withColumn("n_campaign_matches", F.sum(own).over(Window.partitionBy("user_id"))).drop(*keys, "__d", "__cover")
            .withColumn("attributed_revenue", round_dp(F.col("total_revenue") / F.col("n_campaign_matches"), 4)))


def int_campaign_attribution(journey: DataFrame, campaigns: DataFrame, *, bucketed: bool | None = None,
                             max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                             salt_buckets: int | None = None, slab: int = EVENTS_PER_SLAB) -> DataFrame:
    """M8: credit a campaign iff its channel = the user's last touch, its company
    = the user's company and the signup date lies in the closed campaign window;
    the user's lifetime revenue is split 1/N over the N matches (4 dp).

    The number of matches is counted first (:func:`_credited`), so the matches, as
    many as users times campaigns of a day, are the output of the last join and are
    neither shuffled nor sorted.  Users meet campaigns slab by slab of the sorted signup dates (:func:`sweep_join`).
    ``bucketed=False`` joins on (channel, company) with the range as a residual
    predicate; ``bucketed=True`` adds the signup month as an equality key against
    the month buckets of each window.  All give identical rows.
    """
    windows = campaigns.select("campaign_id", "campaign_name", "channel", "company_id",
                               "start_date", "end_date")
    # a match only repeats its row, counts are cut where rows are users
    users = in_steps(_credited(_places(journey), windows))
    sides = dict(point_keys=["__uchannel", "__ucompany"], window_keys=["channel", "company_id"],
                 point="signup_date", lo="start_date", hi="end_date")
    if bucketed is None:
        matches = sweep_join(users, windows, part_on="user_id", slab=slab, **sides)
    else:
        matches = interval_join(users, windows, bucketed=bucketed, max_broadcast_rows=max_broadcast_rows,
                                salt_buckets=salt_buckets, salt_on="user_id", **sides)
    return written(matches.select("user_id", "campaign_id", "campaign_name", "channel", "company_id",
                                   "n_campaign_matches", "total_revenue", "attributed_revenue", *carried(matches)))


def int_campaign_credit(journey: DataFrame, campaigns: DataFrame, slab: int = EVENTS_PER_SLAB) -> DataFrame:
    """M8 per campaign_id, without its rows: ``attributed_users`` (distinct), the exact
    sum of ``attributed_revenue``, the ``matches`` and those without an amount.

    All matches of a user have the same share, so users are added up per (channel,
    company, signup date), and each different window adds the days it covers: a row
    for each window and day at most, however many users and campaigns meet there. A
    user whose rows lie on several days or keys, or who meets several campaign rows of
    one id, may be counted more than once; only for those are matches written out, and
    what was counted too often is taken off."""
    windows = campaigns.select("campaign_id", "channel", "company_id", "start_date", "end_date")
    users = _credited(_places(journey), windows)
    place = ["__uchannel", "__ucompany", "signup_date"]
    daily = (exact.ready(users, "attributed_revenue").groupBy(*place)
             .agg(exact.total_of(users, "attributed_revenue").alias("amt"), n_rows(users).alias("rows"),
                  n_rows(users, F.col("attributed_revenue").isNull()).alias("bare"), F.count_distinct("user_id").alias("users")))
    key = [F.col("channel") == F.col("__uchannel"), F.col("company_id") == F.col("__ucompany")]
    reach = daily.groupBy("__uchannel", "__ucompany").agg(F.min("signup_date").alias("first"), F.max("signup_date").alias("last"))
    span = ["channel", "company_id", "start_date", "end_date"]
    spans = windows.select(*span).filter("start_date <= end_date").distinct().join(reach, key).filter("start_date <= last AND end_date >= first")
    held = spans.select(*span, F.explode(F.sequence(F.greatest("start_date", "first"), F.least("end_date", "last"))).alias("day")).join(
        daily, [*key, F.col("day") == F.col("signup_date")])
    sums = [exact.add("amt").alias("amt"), *[F.sum(c).alias(c) for c in ("rows", "bare", "users")]]
    credit = windows.join(held.groupBy(*span).agg(*sums), span).groupBy("campaign_id").agg(*sums)

    spots = users.select("user_id", *place).dropna().distinct().withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("user_id")))
    named = windows.filter("campaign_id IS NOT NULL").withColumn("m", F.count(F.lit(1)).over(Window.partitionBy("campaign_id")))
    sides = dict(point_keys=["__uchannel", "__ucompany"], window_keys=["channel", "company_id"], point="signup_date",
                 lo="start_date", hi="end_date", part_on="user_id", slab=slab)
    several = (sweep_join(spots.filter("n > 1"), named, **sides)
               .unionByName(sweep_join(spots.filter("n = 1"), named.filter("m > 1"), **sides)))
    again = (several.groupBy("campaign_id", "user_id").agg((F.count(F.lit(1)) - 1).alias("again"))
             .groupBy(F.col("campaign_id").alias("__id")).agg(F.sum("again").alias("again")))
    return credit.join(again, F.col("campaign_id") == F.col("__id"), "left").select(
        "campaign_id", (F.col("users") - F.coalesce("again", F.lit(0).cast("long"))).alias("attributed_users"),
        F.col("amt").alias("attributed_revenue"), F.col("rows").alias("matches"), F.col("bare").alias("without_amount"))


def credit_rows(credit: DataFrame) -> DataFrame:
    """The rows of M8 as :func:`int_campaign_credit` knows them, counted: a campaign's
    rows with the sum of their amounts, and those without an amount."""
    with_amount = F.struct(F.col("attributed_revenue"), (F.col("matches") - F.col("without_amount")).alias(TIMES))
    bare = F.struct(F.lit(None).alias("attributed_revenue"), F.col("without_amount").alias(TIMES))
    return (credit.select("campaign_id", F.explode(F.array(with_amount, bare)).alias("r"))
            .select("campaign_id", "r.attributed_revenue", f"r.{TIMES}").filter(F.col(TIMES) > 0))
