"""The model graph over one raw layer.

``Warehouse`` wires the staging -> intermediate -> mart functions together
once and hands out the same DataFrame object for a model every time, so a
query that needs a model twice builds one sub-plan (Spark then reuses its
exchanges).  :meth:`Warehouse.materialize` writes the marts and the reused
user-grain models as Parquet under the cluster's shared checkpoint folder and
returns a warehouse that reads them back, which cuts lineage for later jobs.
"""
from __future__ import annotations

import os
import uuid
from collections.abc import Callable
from functools import cached_property

from pyspark.sql import Column, DataFrame, Observation, SparkSession

from touchline.operators.counted import repeated
from touchline.operators.joins import DEFAULT_BROADCAST_ROWS
from touchline.plans import intermediate, marts, staging
from touchline.session import checkpoint_dir
from touchline.sources.files import write_bucketed
from touchline.sources.tables import RawTables

MATERIALIZED = (
    "stg_campaign_metadata", "stg_content_performance",
    "int_user_attribution", "int_user_revenue", "int_user_journey", "int_campaign_attribution",
    "fct_attributed_revenue", "fct_campaign_roi", "fct_content_performance",
    "dim_time", "dim_user_cohort",
)

MODEL_NAMES = (
    "stg_campaign_metadata", "stg_content_performance", "stg_portfolio_revenue", "stg_user_signups",
    "int_user_attribution", "int_user_revenue", "int_user_journey", "int_campaign_attribution",
    "fct_attributed_revenue", "fct_campaign_roi", "fct_content_performance",
    "dim_channel", "dim_company", "dim_time", "dim_user_cohort",
)

# Models keyed by user_id (stored bucketed by user_id on request).
USER_KEYED = (
    "stg_portfolio_revenue", "int_user_attribution", "int_user_revenue", "int_user_journey",
    "int_campaign_attribution", "fct_attributed_revenue", "dim_user_cohort",
)


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder (see :func:`touchline.session.checkpoint_dir`)."""
    path = checkpoint_dir(spark)
    if not path:
        raise RuntimeError("spark.checkpoint.dir is not set; configure a shared folder")
    return path


class Warehouse:
    """Lazily built models of the attribution pipeline for one raw layer."""

    def __init__(self, spark: SparkSession, raw: RawTables, *, bucketed: bool | None = None,
                 max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
                 overrides: dict[str, DataFrame] | None = None,
                 observed: dict[str, dict] | None = None):
        self.spark = spark
        self.raw = raw
        self.bucketed = bucketed
        self.max_broadcast_rows = max_broadcast_rows
        self._overrides = dict(overrides or {})
        #: Metrics of the models that :meth:`materialize` watched while it wrote them.
        self.observed = dict(observed or {})

    def _get(self, name: str, build) -> DataFrame:
        return self._overrides[name] if name in self._overrides else build()

    # -- equal rows counted ----------------------------------------------
    @cached_property
    def _counted(self) -> dict[str, DataFrame]:
        return {}

    def counted(self, name: str) -> DataFrame:
        """The model for aggregates: where a shared campaign tag repeats rows, the
        equal ones are one row and its count (:mod:`touchline.operators.counted`), and
        campaign matches are a row or two for each campaign. A stored model is read as it is."""
        builds = {
            "int_user_attribution": lambda: intermediate.int_user_attribution_counted(
                self.stg_user_signups, self.stg_campaign_metadata, self.max_broadcast_rows),
            "int_user_journey": lambda: intermediate.int_user_journey(self.counted("int_user_attribution"), self.int_user_revenue),
            "fct_attributed_revenue": lambda: marts.fct_attributed_revenue(
                self.stg_portfolio_revenue, self.counted("int_user_attribution")),
            "dim_user_cohort": lambda: marts.dim_user_cohort(self.counted("int_user_journey")),
            "int_campaign_attribution": lambda: intermediate.credit_rows(self.int_campaign_credit),
        }
        if name in self._overrides or name not in builds:
            return self.model(name)
        if name not in self._counted:
            self._counted[name] = builds[name]()
        return self._counted[name]

    @cached_property
    def int_campaign_credit(self) -> DataFrame:
        return intermediate.int_campaign_credit(self.counted("int_user_journey"), self.stg_campaign_metadata)

    # -- staging ---------------------------------------------------------
    @cached_property
    def stg_campaign_metadata(self) -> DataFrame:
        return self._get("stg_campaign_metadata",
                         lambda: staging.stg_campaign_metadata(self.raw.campaign_metadata))

    @cached_property
    def stg_content_performance(self) -> DataFrame:
        return self._get("stg_content_performance",
                         lambda: staging.stg_content_performance(self.raw.content_performance))

    @cached_property
    def stg_portfolio_revenue(self) -> DataFrame:
        return self._get("stg_portfolio_revenue",
                         lambda: staging.stg_portfolio_revenue(self.raw.portfolio_revenue))

    @cached_property
    def stg_user_signups(self) -> DataFrame:
        return self._get("stg_user_signups", lambda: staging.stg_user_signups(self.raw.user_signups))

    # -- intermediate ------------------------------------------------------
    @cached_property
    def int_user_attribution(self) -> DataFrame:
        return self._get("int_user_attribution", lambda: repeated(self.counted("int_user_attribution")))

    @cached_property
    def int_user_revenue(self) -> DataFrame:
        return self._get("int_user_revenue", lambda: intermediate.int_user_revenue(self.stg_portfolio_revenue))

    @cached_property
    def int_user_journey(self) -> DataFrame:
        return self._get("int_user_journey", lambda: repeated(self.counted("int_user_journey")))

    @cached_property
    def int_campaign_attribution(self) -> DataFrame:
        return self._get("int_campaign_attribution", lambda: intermediate.int_campaign_attribution(
            self.counted("int_user_journey"), self.stg_campaign_metadata, bucketed=self.bucketed,
            max_broadcast_rows=self.max_broadcast_rows))

    # -- marts -------------------------------------------------------------
    @cached_property
    def fct_attributed_revenue(self) -> DataFrame:
        return self._get("fct_attributed_revenue", lambda: repeated(self.counted("fct_attributed_revenue")))

    @cached_property
    def fct_campaign_roi(self) -> DataFrame:
        def build() -> DataFrame:
            if "int_campaign_attribution" in self._overrides:
                return marts.fct_campaign_roi(self.stg_campaign_metadata, self.int_campaign_attribution)
            return marts.campaign_roi_of(self.stg_campaign_metadata, self.int_campaign_credit)
        return self._get("fct_campaign_roi", build)

    @cached_property
    def fct_content_performance(self) -> DataFrame:
        return self._get("fct_content_performance",
                         lambda: marts.fct_content_performance(self.stg_content_performance))

    @cached_property
    def dim_channel(self) -> DataFrame:
        return self._get("dim_channel", lambda: marts.dim_channel(self.spark))

    @cached_property
    def dim_company(self) -> DataFrame:
        return self._get("dim_company", lambda: marts.dim_company(self.spark))

    @cached_property
    def dim_time(self) -> DataFrame:
        return self._get("dim_time", lambda: marts.dim_time(self.stg_portfolio_revenue))

    @cached_property
    def dim_user_cohort(self) -> DataFrame:
        return self._get("dim_user_cohort", lambda: repeated(self.counted("dim_user_cohort")))

    def model(self, name: str) -> DataFrame:
        return getattr(self, name)

    def register_views(self, names=MODEL_NAMES, prefix: str = "") -> list[str]:
        """Expose the models as session temp views (``prefix + name``) so ad-hoc
        Spark SQL can query them, e.g. ``spark.sql("SELECT last_touch_channel,
        round(sum(revenue_amount)) FROM fct_attributed_revenue GROUP BY 1")``.
        Views are lazy: nothing is computed until a query runs."""
        for name in names:
            self.model(name).createOrReplaceTempView(prefix + name)
        return [prefix + n for n in names]

    # -- materialisation ---------------------------------------------------
    def materialize(self, root: str | None = None, names=MATERIALIZED,
                    partition_fact_by_month: bool = False, bucket_users: int | None = None,
                    database: str = "touchline_marts",
                    metrics: Callable[[str], list[Column]] | None = None) -> Warehouse:
        """Write ``names`` (in dependency order) as Parquet tables and return a
        warehouse reading them.

        Each written table replaces its model before the next one is planned,
        so a dependent model is computed from the stored table instead of
        re-running its upstream lineage.  ``root`` defaults to a fresh folder
        under ``spark.checkpoint.dir`` (shared storage on a cluster, so a lost
        executor never loses a finished table).

        With ``bucket_users=N`` the user-keyed models are stored bucketed (and
        sorted) by user_id into N buckets, registered in ``database``; joins on
        user_id between them then read co-located buckets without a shuffle.

        ``metrics`` names aggregates of a model (by its name) that are observed
        while it is written, in the task that writes, so that they cost no scan and
        a lost task is not counted twice; they are in ``observed`` of the result.
        """
        root = root or os.path.join(shared_dir(self.spark), "touchline", uuid.uuid4().hex)
        if bucket_users:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} "
                           f"LOCATION '{os.path.join(root, '_' + database + '.db')}'")
        w: Warehouse = self
        for name in names:
            path = os.path.join(root, name)
            df = w.model(name)
            wanted = metrics(name) if metrics else []
            seen = Observation(name)

            def watch(rows: DataFrame, wanted: list[Column] = wanted, seen: Observation = seen) -> DataFrame:
                return rows.observe(seen, *wanted) if wanted else rows

            if bucket_users and name in USER_KEYED:
                stored = write_bucketed(self.spark, df, path, f"{database}.{name}", "user_id", bucket_users, watch)
            else:
                writer = watch(df).write.mode("overwrite")
                if partition_fact_by_month and name == "fct_attributed_revenue":
                    # rows of a month meet before they are written; AQE splits a large month
                    writer = (watch(df.hint("rebalance", "revenue_month_str")).write.mode("overwrite")
                              .partitionBy("revenue_month_str"))
                writer.parquet(path)
                # read back with the model's schema: no type inference of
                # partition directory names, same column order as the model
                stored = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
            w = Warehouse(self.spark, self.raw, bucketed=self.bucketed,
                          max_broadcast_rows=self.max_broadcast_rows,
                          overrides={**w._overrides, name: stored},
                          observed={**w.observed, name: seen.get} if wanted else w.observed)
        return w
