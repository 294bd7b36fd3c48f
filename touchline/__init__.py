"""Spark-native marketing attribution and revenue analytics.

Typical use::

    from touchline import build_session, load_sources, Warehouse, analytics, quality
    spark = build_session()
    raw = load_sources(spark, "/data/landing")
    quality.enforce_gate(quality.dq_report(spark, raw))
    w = Warehouse(spark, raw).materialize()
    analytics.channel_revenue_ranking(w.fct_attributed_revenue).show()
"""
from touchline.operators import expectations, quality
from touchline.plans import analytics, report
from touchline.plans.warehouse import Warehouse
from touchline.session import build_session
from touchline.sources.files import ingest, load_sources

__all__ = ["Warehouse", "analytics", "build_session", "expectations", "ingest", "load_sources", "quality",
           "report"]
