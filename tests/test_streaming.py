"""Incremental ingest: each landed file is appended exactly once."""
import json
import os
import tempfile

from touchline.streaming.ingest import ingest_new_files


def _write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_incremental_ingest_exactly_once(spark):
    root = tempfile.mkdtemp(prefix="touchline-stream-")
    rev_dir, usr_dir = os.path.join(root, "rev"), os.path.join(root, "usr")
    os.makedirs(rev_dir)
    os.makedirs(usr_dir)
    head = "user_id,company_id,revenue_month,revenue_amount,revenue_type\n"
    _write(os.path.join(rev_dir, "r1.csv"),
           head + "U1,CTC-001,2024-01,10.00,recurring\nU2,CTC-002,2024-01,5.5,one_time\n")
    _write(os.path.join(usr_dir, "u1.json"), json.dumps([{"user_id": "U1", "signup_date": "2024-01-02",
                                                          "company_id": "CTC-001", "first_touch_channel": "blog",
                                                          "last_touch_channel": "blog", "utm_medium": "content"}]))
    out, ckpt = os.path.join(root, "raw"), os.path.join(root, "ckpt")
    landing = {"raw_portfolio_revenue": rev_dir, "raw_user_signups": usr_dir}
    ingest_new_files(spark, landing, out, ckpt)
    assert spark.read.parquet(os.path.join(out, "raw_portfolio_revenue")).count() == 2

    _write(os.path.join(rev_dir, "r2.csv"), head + "U1,CTC-001,2024-02,12.25,recurring\n")
    ingest_new_files(spark, landing, out, ckpt)
    ingest_new_files(spark, landing, out, ckpt)  # nothing new: nothing appended
    rev = spark.read.parquet(os.path.join(out, "raw_portfolio_revenue"))
    assert sorted(r["revenue_month"] for r in rev.collect()) == ["2024-01", "2024-01", "2024-02"]
    users = spark.read.parquet(os.path.join(out, "raw_user_signups")).collect()
    assert [u["user_id"] for u in users] == ["U1"] and str(users[0]["signup_date"]) == "2024-01-02"
