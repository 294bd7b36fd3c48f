"""Equal rows counted and campaign credit added up give what the written-out rows give."""
import random

from pyspark.sql import functions as F

from touchline.functions import exact
from touchline.operators.counted import dealt, repeated
from touchline.operators import expectations as ex
from touchline.plans import analytics, intermediate, marts, model_tests
from touchline.plans.warehouse import Warehouse
from touchline.registry import QUERIES
from util import SF_CHECK, campaign, raw_tables, revenue, user

CHANNELS, COMPANIES = ["youtube", "blog"], ["CTC-001", "CTC-002"]


def shared_tags(spark) -> Warehouse:
    """Tags held by many campaigns, users with several rows, campaign ids that repeat."""
    r = random.Random(7)

    def day(month):
        return f"2024-{month:02d}-{r.randint(1, 28):02d}"

    camps = [campaign(f"C{i % 50}", r.choice(CHANNELS), r.choice(COMPANIES), 100 * (i % 3), day(r.randint(1, 3)), day(r.randint(2, 5)),
                      f"cmp_{i % 2}", name=f"n{i}") for i in range(60)]
    camps += [campaign("C99", "blog", "CTC-001", 5, "2024-03-01", "2024-02-01", "cmp_9"), campaign("C98", "blog", "CTC-001", 5, "0001-01-01", "9999-12-31", "cmp_8")]
    users = [user(f"U{i % 30}", day(r.randint(1, 4)), r.choice(COMPANIES), last=r.choice(CHANNELS), tag=f"cmp_{i % 3}") for i in range(40)]
    users += users[:5]
    revs = [revenue(f"U{i % 25}", f"2024-{1 + i % 6:02d}", 10.01 * i, r.choice(COMPANIES)) for i in range(90)]
    return Warehouse(spark, raw_tables(spark, campaigns=camps, users=users, revenues=revs))


def written_out(w: Warehouse) -> Warehouse:
    """The same models with every row on its own, in the models' plain joins."""
    tags = w.stg_campaign_metadata.select("utm_campaign", F.col("channel").alias("campaign_channel"), F.col("company_id").alias("campaign_company"))
    plain = w.stg_user_signups.join(tags, "utm_campaign", "left").withColumn(
        "is_campaign_tag_trustworthy", F.expr("utm_campaign IS NOT NULL AND campaign_channel IN (first_touch_channel, last_touch_channel) "
                                              "AND campaign_company = company_id")).withColumn(
        "attribution_quality", intermediate.quality_label()).select(*w.int_user_attribution.columns)
    w = Warehouse(w.spark, w.raw, overrides={"int_user_attribution": plain})
    j = w.int_user_journey.alias("j")
    c = w.stg_campaign_metadata.alias("c")
    pairs = j.join(c, F.expr("c.channel = j.last_touch_channel AND c.company_id = j.company_id AND j.signup_date BETWEEN c.start_date AND c.end_date"))
    n = F.count(F.lit(1)).over(intermediate.Window.partitionBy("j.user_id"))
    rows = pairs.withColumn("n_campaign_matches", n).select(
        "user_id", "campaign_id", "campaign_name", "c.channel", "c.company_id", "n_campaign_matches", "total_revenue",
        intermediate.round_dp(F.col("total_revenue") / F.col("n_campaign_matches"), 4).alias("attributed_revenue"))
    return Warehouse(w.spark, w.raw, overrides={**w._overrides, "int_campaign_attribution": rows})


def bag(df):
    return sorted(map(str, df.collect()))


def test_models_and_tests_equal_the_written_out_ones(spark):
    w = shared_tags(spark)
    plain = written_out(w)
    for m in ("int_user_attribution", "int_user_journey", "int_campaign_attribution", "fct_attributed_revenue", "fct_campaign_roi"):
        assert bag(w.model(m)) == bag(plain.model(m)), m
    bucketed = Warehouse(spark, w.raw, bucketed=True)
    assert bag(bucketed.int_campaign_attribution) == bag(plain.int_campaign_attribution)
    assert bag(model_tests.every_test(w)) == bag(model_tests.every_test(plain))
    for q in (analytics.revenue_trend_by_channel, analytics.forecast_by_company):
        assert bag(q(w.counted("fct_attributed_revenue"))) == bag(q(plain.fct_attributed_revenue))
    assert (ex.reconcile_campaign_not_exceeds_total(w.counted("int_campaign_attribution"), w.stg_portfolio_revenue).collect()
            == ex.reconcile_campaign_not_exceeds_total(plain.int_campaign_attribution, plain.stg_portfolio_revenue).collect())


def test_rows_do_not_grow_with_the_campaigns_of_a_tag(spark):
    camps = [campaign(f"C{i}", "youtube", "CTC-001", 100, "2024-01-01", "2024-12-31", "cmp_1") for i in range(300)]
    users = [user(f"U{i}", "2024-01-05", tag="cmp_1") for i in range(20)]
    w = Warehouse(spark, raw_tables(spark, campaigns=camps, users=users, revenues=[revenue("U1", "2024-01", 5.0)]))
    assert w.counted("int_user_journey").count() == 20 and w.int_user_journey.count() == 6000
    assert w.counted("int_campaign_attribution").count() == 300
    # no match is shuffled or sorted again: nothing but projections above the join that makes it
    text = w.int_campaign_attribution._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in text[:text.index("Join Inner")]


def test_repeated_beyond_one_step(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("c", 200_001)], "k string, __times long")
    assert {r.k: r["count"] for r in repeated(df).groupBy("k").count().collect()} == {"a": 1, "b": 3, "c": 200_001}
    total = exact.ready(df.withColumn("x", F.lit(0.1)), "x").agg(exact.value(exact.total("x", times="__times")).alias("t"))
    assert total.first().t == 20000.5


def test_rows_of_a_shared_tag_are_written_by_many_tasks(spark):
    """Few users stand for most rows of the dirtied journey; the tasks that read them used to write them all."""
    df = QUERIES["dirty_int_user_journey"](spark, SF_CHECK)
    tasks = [r["count"] for r in df.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    assert len(tasks) >= 8 and max(tasks) < sum(tasks) / 4
    # one row's copies as well
    one = dealt(spark.createDataFrame([("a", 1), ("b", 3), ("c", 200_001)], "k string, __times long"))
    assert {r.k: r["count"] for r in one.groupBy("k").count().collect()} == {"a": 1, "b": 3, "c": 200_001}
    assert max(r["count"] for r in one.groupBy(F.spark_partition_id().alias("p")).count().collect()) < 200_001 / 3


def test_credit_of_no_rows(spark):
    w = Warehouse(spark, raw_tables(spark, campaigns=[campaign("C1", "blog", "CTC-001", 5, "2024-01-01", "2024-02-01", "t")]))
    assert [r.attributed_users for r in w.fct_campaign_roi.collect()] == [0]
    assert marts.fct_campaign_roi(w.stg_campaign_metadata, w.int_campaign_attribution).collect() == w.fct_campaign_roi.collect()
