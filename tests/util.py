"""Hand-written raw tables and the tables' folders for tests."""
from __future__ import annotations

import datetime as dt

from touchline.sources import schemas
from touchline.sources.tables import RawTables

D = dt.date.fromisoformat

#: Tables of the tests; not in conftest, whose module name each test folder has for itself.
SF_SMALL = "/root/testdata/sf0.001"
SF_CHECK = "/root/testdata/sf0.01"


def campaign(cid, channel, company, budget, start, end, tag, name=None):
    return (cid, name or f"{channel}_{tag}", channel, company, budget, D(start), D(end), tag)


def content(cid, channel, publish="2024-01-10", views=100, clicks=5, src="x", medium="content", tag=None):
    return (cid, f"title {cid}", channel, D(publish), views, clicks, src, medium, tag)


def user(uid, signup, company="CTC-001", first="youtube", last="youtube", fcid=None, lcid=None,
         src="youtube", medium="content", tag=None, ref=None):
    return (uid, D(signup), company, first, last, fcid, lcid, src, medium, tag, ref)


def revenue(uid, month, amount, company="CTC-001", rtype="recurring"):
    return (uid, company, month, float(amount), rtype)


def raw_tables(spark, campaigns=(), contents=(), users=(), revenues=()) -> RawTables:
    def mk(rows, schema):
        return spark.createDataFrame(list(rows), schema)
    return RawTables(
        campaign_metadata=mk(campaigns, schemas.CAMPAIGN_METADATA),
        content_performance=mk(contents, schemas.CONTENT_PERFORMANCE),
        user_signups=mk(users, schemas.USER_SIGNUPS),
        portfolio_revenue=mk(revenues, schemas.PORTFOLIO_REVENUE),
        provenance={},
    )
