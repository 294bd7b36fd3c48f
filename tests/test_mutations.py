"""Each deliberate corruption trips the check that guards against it."""
from touchline.operators import expectations as ex
from touchline.operators import quality
from touchline.plans import model_tests
from touchline.plans.warehouse import Warehouse
from util import campaign, raw_tables, revenue, user

CAMPS = [campaign("C1", "youtube", "CTC-001", 100, "2024-01-01", "2024-12-31", "cmp_1")]
USERS = [user("U1", "2024-01-05", tag="cmp_1"), user("U2", "2024-02-05")]
REVS = [revenue("U1", "2024-01", 10.0), revenue("U2", "2024-02", 5.0)]


def report(spark, **kw):
    raw = raw_tables(spark, **{"campaigns": CAMPS, "users": USERS, "revenues": REVS, **kw})
    rows = quality.dq_report(spark, raw).collect()
    return raw, {r["category"]: r["record_count"] for r in rows}


def failing(df):
    return {(r["model"], r["column_name"]): r["failing_rows"] for r in df.collect()}


def test_clean_fixture_passes_everything(spark):
    raw, rep = report(spark)
    assert len(rep) == 21 and all(rep[c] == 0 for c, sev, _ in quality.CHECKS
                                  if sev == "error")
    quality.enforce_gate(quality.dq_report(spark, raw))
    w = Warehouse(spark, raw)
    for f in (model_tests.not_null, model_tests.unique, model_tests.accepted_values, model_tests.relationships):
        assert all(v == 0 for v in failing(f(w)).values()), f.__name__


def test_orphan_revenue_user(spark):
    raw, rep = report(spark, revenues=REVS + [revenue("GHOST", "2024-03", 7.0)])
    assert rep["ri_revenue_user_missing"] == 1
    w = Warehouse(spark, raw)
    assert failing(model_tests.relationships(w))[("stg_portfolio_revenue", "user_id")] == 1
    assert ex.reconcile_row_count(w.fct_attributed_revenue, w.stg_portfolio_revenue).first()["failing_rows"] == 1
    assert ex.reconcile_revenue_to_source(w.fct_attributed_revenue, w.stg_portfolio_revenue).first()[
        "failing_rows"] == 1
    try:
        quality.enforce_gate(quality.dq_report(spark, raw))
        raise AssertionError("gate should fail")
    except quality.DataQualityError as e:
        assert "ri_revenue_user_missing" in str(e)


def test_duplicate_user_and_tag(spark):
    raw = raw_tables(spark, campaigns=CAMPS + [campaign("C2", "blog", "CTC-001", 5, "2024-01-01", "2024-02-01",
                                                        "cmp_1")],
                     users=USERS + [user("U1", "2024-01-07")], revenues=REVS)
    w = Warehouse(spark, raw)
    f = failing(model_tests.unique(w))
    assert f[("stg_user_signups", "user_id")] == 1 and f[("stg_campaign_metadata", "utm_campaign")] == 1
    assert ex.reconcile_row_count(w.fct_attributed_revenue, w.stg_portfolio_revenue).first()["failing_rows"] == 1


def test_inverted_window_revenue_before_signup_bad_company(spark):
    _, rep = report(spark, campaigns=CAMPS + [campaign("C9", "blog", "CTC-001", 5, "2024-05-01", "2024-04-01",
                                                        "cmp_9")],
                    users=USERS + [user("U3", "2024-06-20", company="CTC-999")],
                    revenues=REVS + [revenue("U3", "2024-05", 1.0)])
    assert rep["campaign_bad_window"] == 1
    assert rep["revenue_before_signup"] == 1
    assert rep["ri_bad_company_id"] == 1


def test_null_company_passes_d4_fails_not_null(spark):
    raw, rep = report(spark, users=USERS + [user("U3", "2024-01-05", company=None)])
    assert rep["ri_bad_company_id"] == 0
    assert failing(model_tests.not_null(Warehouse(spark, raw)))[("stg_user_signups", "company_id")] == 1


def test_source_contradicting_channel(spark):
    _, rep = report(spark, users=USERS + [user("U3", "2024-01-05", last="blog", first="blog", src="twitter")])
    assert rep["utm_source_channel_mismatch"] == 1


def test_not_in_with_null_build_side_counts_nothing(spark):
    # NOT IN over a subquery holding a NULL is never TRUE (SQL three-valued logic).
    raw = raw_tables(spark, campaigns=CAMPS + [campaign("C2", "blog", "CTC-001", 5, "2024-01-01", "2024-02-01",
                                                        None)],
                     users=USERS + [user("U3", "2024-01-05", tag="cmp_404")], revenues=REVS)
    rep = {r["category"]: r["record_count"] for r in quality.dq_report(spark, raw).collect()}
    assert rep["ri_user_campaign_fk_orphan"] == 0
    raw2 = raw_tables(spark, campaigns=CAMPS, users=USERS + [user("U3", "2024-01-05", tag="cmp_404")], revenues=REVS)
    rep2 = {r["category"]: r["record_count"] for r in quality.dq_report(spark, raw2).collect()}
    assert rep2["ri_user_campaign_fk_orphan"] == 1
