"""File sources and sinks: explicit schemas, presence check, manifest, ingest."""
import json
import os
import tempfile

import pytest

from touchline.sources import files, schemas
from touchline.sources.tables import RawTables

CAMPAIGN_CSV = """campaign_id,campaign_name,channel,target_company,budget,start_date,end_date,utm_campaign
CMP-001,blog_a,blog,CTC-001,7500,2024-01-13,2024-05-07,cmp_001
CMP-002,tw_b, Twitter ,CTC-002,2500,2024-03-12,2024-07-05,cmp_002
"""
CONTENT_CSV = """content_id,title,channel,publish_date,views,clicks,utm_source,utm_medium,utm_campaign
CNT-1,t1,blog,2024-01-02,100,3,blog,content,cmp_001
CNT-2,t2,blog,2024-01-03,0,0,,content,
"""
REVENUE_CSV = """user_id,company_id,revenue_month,revenue_amount,revenue_type
USR-1,CTC-001,2024-01,10.50,recurring
USR-1,CTC-001,2024-02,11.25,recurring
"""
USERS = [{"user_id": "USR-1", "signup_date": "2024-01-05", "company_id": "CTC-001",
          "first_touch_channel": "blog", "last_touch_channel": "blog", "first_touch_content_id": "CNT-1",
          "last_touch_content_id": None, "utm_source": "blog", "utm_medium": "content",
          "utm_campaign": "cmp_001", "referral_source": None}]


@pytest.fixture()
def source_dir():
    d = tempfile.mkdtemp(prefix="touchline-src-")
    for name, text in (("campaign_metadata.csv", CAMPAIGN_CSV), ("content_performance.csv", CONTENT_CSV),
                       ("portfolio_revenue.csv", REVENUE_CSV)):
        with open(os.path.join(d, name), "w") as f:
            f.write(text)
    with open(os.path.join(d, "user_signups.json"), "w") as f:
        json.dump(USERS, f, indent=2)
    return d


def test_load_sources_with_explicit_schemas(spark, source_dir):
    raw = files.load_sources(spark, source_dir)
    assert raw.portfolio_revenue.schema == schemas.PORTFOLIO_REVENUE  # revenue_month stays text
    assert [r["revenue_month"] for r in raw.portfolio_revenue.orderBy("revenue_month").collect()] == [
        "2024-01", "2024-02"]
    c = {r["content_id"]: r for r in raw.content_performance.collect()}
    assert c["CNT-2"]["utm_source"] is None and c["CNT-2"]["utm_campaign"] is None  # empty field -> NULL
    u = raw.user_signups.first()
    assert str(u["signup_date"]) == "2024-01-05" and u["last_touch_content_id"] is None
    m = {r["table_name"]: r["row_count"] for r in files.manifest(raw).collect()}
    assert m == {"raw_campaign_metadata": 2, "raw_content_performance": 2, "raw_portfolio_revenue": 2,
                 "raw_user_signups": 1}


def test_missing_sources_are_all_named(spark):
    d = tempfile.mkdtemp(prefix="touchline-empty-")
    with pytest.raises(FileNotFoundError) as e:
        files.load_sources(spark, d)
    assert all(n in str(e.value) for n in ("campaign_metadata.csv", "user_signups.json", "portfolio_revenue.csv"))


def test_jsonl_and_parquet_readers(spark, source_dir):
    d = tempfile.mkdtemp(prefix="touchline-jsonl-")
    path = os.path.join(d, "users.jsonl")
    with open(path, "w") as f:
        f.write("\n".join(json.dumps(u) for u in USERS))
    df = files.read_source(spark, path, schemas.USER_SIGNUPS)
    assert df.count() == 1 and df.schema == schemas.USER_SIGNUPS
    pq = os.path.join(d, "rev_parquet")
    files.read_source(spark, os.path.join(source_dir, "portfolio_revenue.csv"), schemas.PORTFOLIO_REVENUE) \
        .write.parquet(pq)
    assert files.read_source(spark, pq, schemas.PORTFOLIO_REVENUE).count() == 2


def test_ingest_lands_parquet_and_results_sink(spark, source_dir):
    raw = files.load_sources(spark, source_dir)
    out = tempfile.mkdtemp(prefix="touchline-ingest-")
    landed, man = files.ingest(spark, raw, out)
    assert isinstance(landed, RawTables)
    assert sorted(os.listdir(out)) == sorted(n for n, _ in raw.items())
    assert {r["row_count"] for r in man.collect()} == {1, 2}
    assert sorted(man.collect()) == sorted(files.manifest(landed).collect())  # observed == scanned
    csv_dir = os.path.join(out, "result_csv")
    files.write_result_csv(landed.portfolio_revenue, csv_dir)
    parts = [p for p in os.listdir(csv_dir) if p.endswith(".csv")]
    assert len(parts) == 1
    with open(os.path.join(csv_dir, parts[0])) as f:
        assert f.readline().startswith("user_id,company_id,revenue_month")


def test_end_to_end_run_from_files(spark, source_dir):
    from touchline.run import run
    out = tempfile.mkdtemp(prefix="touchline-run-")
    w = run(spark, source_dir, out)
    assert w.fct_attributed_revenue.count() == 2
    assert sorted(os.listdir(os.path.join(out, "results"))) == sorted([
        "cac_by_channel_company", "campaign_roi", "campaign_roi_coverage", "channel_revenue_ranking",
        "cohort_retention_by_channel", "forecast_3mo_by_company", "revenue_trend_by_channel"])
    rep = spark.read.parquet(os.path.join(out, "raw", "data_quality_report"))
    assert rep.count() == 21


def test_run_takes_uris_and_splittable_signups(spark, source_dir):
    from touchline.run import run
    with open(os.path.join(source_dir, "users.jsonl"), "w") as f:
        f.writelines(json.dumps(u) + "\n" for u in USERS)
    os.remove(os.path.join(source_dir, "user_signups.json"))
    w = run(spark, f"file://{source_dir}", tempfile.mkdtemp(prefix="touchline-run-"),
            file_names={"raw_user_signups": "users.jsonl"})
    assert w.fct_attributed_revenue.count() == 2


def test_run_stops_at_a_failing_model_test(spark, source_dir):
    from touchline.plans.model_tests import ModelTestError
    from touchline.run import run
    with open(os.path.join(source_dir, "campaign_metadata.csv"), "a") as f:
        f.write("CMP-003,blog_c,blog,CTC-001,100,2024-01-01,2024-05-01,cmp_001\n")
    out = tempfile.mkdtemp(prefix="touchline-run-")
    with pytest.raises(ModelTestError, match="unique.stg_campaign_metadata.utm_campaign"):
        run(spark, source_dir, out)
    assert not os.path.exists(os.path.join(out, "results"))


def test_bucketed_writer_makes_one_file_per_bucket(spark):
    d = os.path.join(tempfile.mkdtemp(prefix="tl-files-"), "t")
    spark.sql("CREATE DATABASE IF NOT EXISTS t_files")
    df = spark.range(4000).selectExpr("concat('u', id % 97) AS user_id", "id").repartition(8)
    back = files.write_bucketed(spark, df, d, "t_files.one", "user_id", 4)
    assert back.count() == 4000 and len([p for p in os.listdir(d) if p.endswith(".parquet")]) == 4
