"""Property tests of the custom join operators against brute force."""
import datetime as dt

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline.operators.joins import interval_join, null_aware_anti_count

BASE = dt.date(2023, 11, 20)
day = st.integers(min_value=0, max_value=500).map(lambda d: BASE + dt.timedelta(days=d))
keys = st.sampled_from(["a", "b"])
windows = st.lists(st.tuples(keys, day, day), min_size=0, max_size=12)
points = st.lists(st.tuples(keys, day), min_size=0, max_size=15)

SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


@SETTINGS
@given(windows, points)
def test_interval_join_matches_brute_force(spark, ws, ps):
    wdf = spark.createDataFrame([(f"w{i}", k, lo, hi) for i, (k, lo, hi) in enumerate(ws)],
                                "wid string, wkey string, lo date, hi date")
    pdf = spark.createDataFrame([(f"p{i}", k, d) for i, (k, d) in enumerate(ps)],
                                "pid string, pkey string, d date")
    expected = sorted((f"p{i}", f"w{j}") for i, (pk, d) in enumerate(ps)
                      for j, (wk, lo, hi) in enumerate(ws) if pk == wk and lo <= d <= hi)
    for bucketed, max_rows in ((False, 1000), (True, 1000), (True, 0)):
        out = interval_join(pdf, wdf, point_keys=["pkey"], window_keys=["wkey"], point="d", lo="lo", hi="hi",
                            bucketed=bucketed, max_broadcast_rows=max_rows, salt_buckets=3, salt_on="pid")
        got = sorted((r["pid"], r["wid"]) for r in out.select("pid", "wid").collect())
        assert got == expected, (bucketed, max_rows)


values = st.lists(st.one_of(st.none(), st.sampled_from(["x", "y", "z", "w"])), max_size=10)


@SETTINGS
@given(values, values)
def test_null_aware_anti_count_matches_not_in(spark, probe, build):
    p = spark.createDataFrame([(v,) for v in probe], "k string")
    b = spark.createDataFrame([(v,) for v in build], "k string")
    got = null_aware_anti_count(p, b, "k", "k").first()["n"]
    con = duckdb.connect()
    con.execute("CREATE TABLE p (k VARCHAR)")
    con.execute("CREATE TABLE b (k VARCHAR)")
    if probe:
        con.executemany("INSERT INTO p VALUES (?)", [(v,) for v in probe])
    if build:
        con.executemany("INSERT INTO b VALUES (?)", [(v,) for v in build])
    want = con.execute("SELECT count(*) FROM p WHERE k IS NOT NULL AND k NOT IN (SELECT k FROM b)").fetchone()[0]
    assert got == want


def test_salting_spreads_a_hot_key(spark):
    """A third of the points share one (key, month): on the non-broadcast path
    the salt spreads them over several join tasks instead of one."""
    from pyspark.sql import functions as F
    hot = [(f"h{i}", "a", BASE + dt.timedelta(days=i % 20)) for i in range(3000)]
    cold = [(f"c{i}", "b" if i % 2 else "a", BASE + dt.timedelta(days=40 + i % 300)) for i in range(6000)]
    pdf = spark.createDataFrame(hot + cold, "pid string, pkey string, d date")
    wdf = spark.createDataFrame([("w0", "a", BASE, BASE + dt.timedelta(days=30)),
                                 ("w1", "b", BASE, BASE + dt.timedelta(days=400))],
                                "wid string, wkey string, lo date, hi date")
    # simulate a window side too large for any broadcast (ours or Spark's own)
    confs = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    prev = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        out = interval_join(pdf, wdf, point_keys=["pkey"], window_keys=["wkey"], point="d", lo="lo", hi="hi",
                            bucketed=True, max_broadcast_rows=0, salt_buckets=8, salt_on="pid")
        parts = (out.where(F.col("wid") == "w0").select(F.spark_partition_id().alias("p"))
                 .groupBy("p").count().collect())
        assert sum(r["count"] for r in parts) == 3000
        assert len(parts) >= 4 and max(r["count"] for r in parts) < 3000 / 2
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_hot_tag_lookup_is_salted_on_the_fallback(spark):
    """A third of the users carry one campaign tag and a sixth carry none.  With
    no broadcast possible the tag lookup is a salted shuffle join: neither the
    hot tag nor the NULL tag lands in a single task, and the rows are right."""
    from pyspark.sql import functions as F

    from touchline.plans.intermediate import int_user_attribution
    from touchline.plans.staging import stg_campaign_metadata, stg_user_signups
    from util import campaign, raw_tables, user
    camps = [campaign(f"C{i}", "blog", "CTC-001", 10, "2024-01-01", "2024-12-31", f"cmp_{i}") for i in range(40)]
    users = [user(f"U{i}", "2024-02-01", first="blog", last="blog", src="blog",
                  tag="cmp_0" if i % 3 == 0 else (None if i % 6 == 1 else f"cmp_{i % 40}")) for i in range(6000)]
    raw = raw_tables(spark, campaigns=camps, users=users)
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    prev = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        attr = int_user_attribution(stg_user_signups(raw.user_signups), stg_campaign_metadata(raw.campaign_metadata),
                                    max_broadcast_rows=0)
        rows = attr.collect()
        assert len(rows) == 6000
        assert all((r["campaign_channel"] == "blog") == (r["utm_campaign"] is not None) for r in rows)
        for cond in (F.col("utm_campaign") == "cmp_0", F.col("utm_campaign").isNull()):
            parts = attr.where(cond).select(F.spark_partition_id().alias("p")).groupBy("p").count().collect()
            assert len(parts) >= 4 and max(r["count"] for r in parts) < sum(r["count"] for r in parts) / 2
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_aqe_splits_a_hot_user_in_the_revenue_users_join(spark):
    """A third of the revenue rows belong to one user: AQE's skew-join handling
    splits that partition of the revenue -> users sort-merge join (D1 + D19)."""
    import random

    from touchline.operators import quality
    from util import raw_tables, revenue, user
    rnd = random.Random(1)
    users = [user(f"U{i}", "2024-01-05") for i in range(3000)]
    revs = [revenue("U0" if i % 3 == 0 else f"U{i % 3000}", f"{rnd.randint(1990, 2030)}-{rnd.randint(1, 12):02d}",
                    1.0) for i in range(30000)]
    expected_before = sum(1 for r in revs if r[2] < "2024-01")
    raw = raw_tables(spark, users=users, revenues=revs)
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
             "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k"}
    prev = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = quality.check_counts(raw, max_broadcast_rows=0)
        rows = {r["category"]: r["record_count"] for r in df.collect()}
        assert rows["ri_revenue_user_missing"] == 0 and rows["revenue_before_signup"] == expected_before
        assert "skew=true" in df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in prev.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


dates = st.dates(min_value=dt.date(1990, 1, 1), max_value=dt.date(2035, 12, 31))


@SETTINGS
@given(st.lists(st.tuples(dates, dates), min_size=1, max_size=40))
def test_month_index_matches_duckdb_date_diff(spark, pairs):
    from touchline.functions.exprs import month_index
    got = [r[0] for r in spark.createDataFrame(pairs, "a date, b date").select(month_index("a", "b")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT date_diff('month', ?::DATE, ?::DATE)", [a, b]).fetchone()[0] for a, b in pairs]
    assert got == want


@SETTINGS
@given(windows, points, st.sampled_from([1, 2, 1000]))
def test_interval_join_in_parts_matches_brute_force(spark, ws, ps, rows):
    """Without ``salt_buckets`` crowded buckets are dealt over parts of both sides; equal
    windows and equal points stay as many as they are."""
    ws, ps = ws + ws[:3], ps + ps[:3]
    wdf = spark.createDataFrame([(f"w{i % 9}", k, lo, hi) for i, (k, lo, hi) in enumerate(ws)],
                                "wid string, wkey string, lo date, hi date")
    pdf = spark.createDataFrame([(f"p{i % 9}", k, d) for i, (k, d) in enumerate(ps)],
                                "pid string, pkey string, d date")
    expected = sorted((f"p{i % 9}", f"w{j % 9}") for i, (pk, d) in enumerate(ps)
                      for j, (wk, lo, hi) in enumerate(ws) if pk == wk and lo <= d <= hi)
    for bucketed in (False, True):
        out = interval_join(pdf, wdf, point_keys=["pkey"], window_keys=["wkey"], point="d", lo="lo", hi="hi",
                            bucketed=bucketed, max_broadcast_rows=0, salt_on="pid", rows_per_part=rows)
        assert sorted((r["pid"], r["wid"]) for r in out.select("pid", "wid").collect()) == expected, bucketed


def _shuffled_rows(df) -> list[int]:
    """Rows written by each exchange of an executed plan."""
    found, todo = [], [df._jdf.queryExecution().executedPlan()]
    while todo:
        node = todo.pop()
        kind = node.getClass().getSimpleName()
        if kind == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif kind.endswith("QueryStageExec"):
            todo.append(node.plan())
        else:
            if kind == "ShuffleExchangeExec":
                found.append(node.metrics().apply("shuffleRecordsWritten").value())
            todo += [node.children().apply(i) for i in range(node.children().size())]
    return found


def test_windows_that_fit_a_part_are_not_copied(spark):
    """Beyond the broadcast bound, no exchange carries more rows than there are windows (each
    in one month here): the salted join sent 16 copies of each."""
    wdf = spark.createDataFrame([(f"w{i}", "a", BASE + dt.timedelta(days=11 + i % 20), BASE + dt.timedelta(days=11 + i % 20))
                                 for i in range(400)], "wid string, wkey string, lo date, hi date")
    pdf = spark.createDataFrame([(f"p{i}", "a", BASE + dt.timedelta(days=11 + i % 20)) for i in range(100)],
                                "pid string, pkey string, d date")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = interval_join(pdf, wdf, point_keys=["pkey"], window_keys=["wkey"], point="d", lo="lo", hi="hi",
                            max_broadcast_rows=0, salt_on="pid")
        assert len(out.collect()) == 100 * 20
        assert max(_shuffled_rows(out)) == 400
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
