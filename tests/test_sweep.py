"""The slab join against brute force, its slabs, and what a crowded key costs."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from touchline.operators.sweep import line, sweep_join
from touchline.registry import warehouse
from util import SF_CHECK

BASE = dt.date(2023, 11, 20)
day = st.one_of(st.none(), st.integers(min_value=0, max_value=300).map(lambda d: BASE + dt.timedelta(days=d)))
keys = st.sampled_from(["a", "b", None])
SIDES = dict(point_keys=["pkey"], window_keys=["wkey"], point="d", lo="lo", hi="hi")


def frames(spark, ws, ps):
    return (spark.createDataFrame([(f"p{i}", k, d) for i, (k, d) in enumerate(ps)], "pid string, pkey string, d date"),
            spark.createDataFrame([(f"w{i}", k, lo, hi) for i, (k, lo, hi) in enumerate(ws)], "wid string, wkey string, lo date, hi date"))


def plain(ws, ps):
    return sorted((f"p{i}", f"w{j}") for i, (pk, d) in enumerate(ps) for j, (wk, lo, hi) in enumerate(ws)
                  if None not in (pk, d, lo, hi) and pk == wk and lo <= d <= hi)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(keys, day, day), max_size=12), st.lists(st.tuples(keys, day), max_size=15), st.sampled_from([1, 3, 1000]))
def test_sweep_matches_brute_force(spark, ws, ps, slab):
    out = sweep_join(*frames(spark, ws, ps), part_on="pid", slab=slab, **SIDES)
    assert sorted((r.pid, r.wid) for r in out.collect()) == plain(ws, ps)
    assert set(out.columns) == {"pid", "pkey", "d", "wid", "wkey", "lo", "hi"}


def test_one_day_with_most_points_and_long_windows(spark):
    one = BASE + dt.timedelta(days=40)
    ps = [("a", one)] * 300 + [("a", BASE + dt.timedelta(days=i)) for i in range(0, 300, 3)]
    ws = [("a", BASE, BASE + dt.timedelta(days=3650))] * 3 + [("a", one, one), ("a", one + dt.timedelta(days=1), one)]
    pdf, wdf = frames(spark, ws, ps)
    out = sweep_join(pdf, wdf, part_on="pid", slab=25, **SIDES)
    assert sorted((r.pid, r.wid) for r in out.collect()) == plain(ws, ps)
    slabs = line(pdf, wdf, slab=25, **SIDES).groupBy("__k0", "slab").agg(F.sum("points").alias("n"), F.count(F.lit(1)).alias("days")).collect()
    # only the crowded day exceeds a slab, by itself or with what came before it
    assert sum(r.n > 50 for r in slabs) == 1 and max(r.n for r in slabs if r.n < 300) <= 50
    # a ten-year window is one row a slab, not one a month
    assert len(slabs) < 20


def test_slab_join_equals_the_other_forms(spark):
    from touchline.plans import intermediate
    w = warehouse(spark, SF_CHECK)
    want = sorted(warehouse(spark, SF_CHECK, bucketed=False).int_campaign_attribution.collect())
    assert sorted(w.int_campaign_attribution.collect()) == want
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        fine = intermediate.int_campaign_attribution(w.int_user_journey, w.stg_campaign_metadata, slab=20)
        assert sorted(fine.collect()) == want
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_planning_runs_no_job(spark):
    w = warehouse(spark, SF_CHECK)
    journey, campaigns = w.int_user_journey, w.stg_campaign_metadata
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("sweep-plan", "planning")
    try:
        from touchline.plans import intermediate
        intermediate.int_campaign_attribution(journey, campaigns)
        assert not tracker.getJobIdsForGroup("sweep-plan")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
