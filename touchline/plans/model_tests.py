"""The model test inventory (which column of which model is tested how)."""
from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from touchline.operators import expectations as ex
from touchline.plans.warehouse import Warehouse
from touchline.sources import schemas

NOT_NULL = {
    "stg_user_signups": ["user_id", "company_id", "first_touch_channel", "last_touch_channel"],
    "stg_portfolio_revenue": ["revenue_id", "user_id", "revenue_amount"],
    "stg_content_performance": ["content_id"],
    "stg_campaign_metadata": ["campaign_id", "utm_campaign", "budget"],
    "int_user_attribution": ["user_id", "first_touch_channel", "last_touch_channel", "attribution_quality"],
    "int_user_revenue": ["user_id", "total_revenue"],
    "int_user_journey": ["user_id"],
    "int_campaign_attribution": ["campaign_id", "attributed_revenue"],
    "fct_attributed_revenue": ["revenue_id", "revenue_amount", "last_touch_channel", "first_touch_channel"],
    "fct_content_performance": ["channel", "total_views"],
    "fct_campaign_roi": ["campaign_id", "attributed_revenue"],
    "dim_company": ["company_id"],
    "dim_channel": ["channel"],
    "dim_time": ["month_date"],
    "dim_user_cohort": ["user_id", "cohort_month"],
}

UNIQUE = [
    ("stg_user_signups", "user_id"), ("stg_portfolio_revenue", "revenue_id"),
    ("stg_content_performance", "content_id"), ("stg_campaign_metadata", "campaign_id"),
    ("stg_campaign_metadata", "utm_campaign"), ("int_user_attribution", "user_id"),
    ("int_user_revenue", "user_id"), ("int_user_journey", "user_id"),
    ("fct_attributed_revenue", "revenue_id"), ("fct_campaign_roi", "campaign_id"),
    ("dim_company", "company_id"), ("dim_channel", "channel"), ("dim_time", "month_date"),
    ("dim_user_cohort", "user_id"),
]

ACCEPTED = [
    ("stg_user_signups", "company_id", schemas.COMPANY_IDS),
    ("stg_user_signups", "first_touch_channel", schemas.SIGNUP_CHANNELS),
    ("stg_user_signups", "last_touch_channel", schemas.SIGNUP_CHANNELS),
    ("stg_portfolio_revenue", "revenue_type", schemas.REVENUE_TYPES),
    ("stg_content_performance", "channel", schemas.CONTENT_CHANNELS),
    ("stg_campaign_metadata", "channel", schemas.CONTENT_CHANNELS),
    ("int_user_attribution", "attribution_quality", schemas.QUALITY_VALUES),
    ("fct_attributed_revenue", "last_touch_channel", schemas.SIGNUP_CHANNELS),
    ("fct_attributed_revenue", "first_touch_channel", schemas.SIGNUP_CHANNELS),
]

RELATIONSHIPS = [
    ("stg_portfolio_revenue", "user_id", "stg_user_signups", "user_id"),
    ("fct_attributed_revenue", "company_id", "dim_company", "company_id"),
    ("fct_campaign_roi", "company_id", "dim_company", "company_id"),
]


def not_null(w: Warehouse) -> DataFrame:
    return ex.not_null_summary([(m, w.counted(m), cols) for m, cols in NOT_NULL.items()])


def unique(w: Warehouse) -> DataFrame:
    return ex.unique_summary([(m, w.counted(m), c) for m, c in UNIQUE])


def accepted_values(w: Warehouse) -> DataFrame:
    """One scan for each model, whatever the number of its columns."""
    parts = [ex.accepted_columns_summary(model, w.counted(model), [(c, v) for m, c, v in ACCEPTED if m == model])
             for model in dict.fromkeys(m for m, _, _ in ACCEPTED)]
    return reduce(DataFrame.unionByName, parts)


def relationships(w: Warehouse) -> DataFrame:
    return ex.relationships_summary([(m, w.counted(m), c, w.counted(p), pc) for m, c, p, pc in RELATIONSHIPS])


class ModelTestError(RuntimeError):
    """Raised by :func:`enforce` when a model test fails."""


def metrics(model: str) -> list[Column]:
    """What the tests want to know of a model while it is written: rows, NULLs of
    each column that must have none, rows outside each column's accepted values."""
    return [F.count(F.lit(1)).alias("rows"),
            *[F.count_if(F.col(c).isNull()).alias(f"null {c}") for c in NOT_NULL.get(model, [])],
            *[F.count_if(~F.col(c).isin(list(v))).alias(f"bad {c}") for m, c, v in ACCEPTED if m == model]]


def observed_tests(w: Warehouse) -> DataFrame | None:
    """The not-null and accepted-values tests of the models that were watched while
    they were written (see :meth:`Warehouse.materialize`): no table is read, unless
    a column has values outside its list, whose different ones are then counted."""
    rows, counted = [], []
    for model, seen in w.observed.items():
        rows += [("not_null", model, c, seen[f"null {c}"]) for c in NOT_NULL.get(model, [])]
        for m, c, v in ACCEPTED:
            if m == model and seen[f"bad {c}"]:
                counted.append((m, w.model(m), c, v))
            elif m == model:
                rows.append(("accepted_values", model, c, 0))
    if not rows and not counted:
        return None
    out = w.spark.createDataFrame(rows, "test_name string, model string, column_name string, failing_rows long")
    return out.unionByName(ex.accepted_values_summary(counted)) if counted else out


def column_tests(w: Warehouse) -> DataFrame:
    """G1-G4. Of a model that was not watched, NULLs and values take one scan."""
    parts = [unique(w), relationships(w)]
    seen = observed_tests(w)
    if seen is not None:
        parts.append(seen)
    unseen = [m for m in NOT_NULL if m not in w.observed]
    if unseen:
        parts.append(ex.not_null_summary([(m, w.counted(m), NOT_NULL[m]) for m in unseen]))
    for model in dict.fromkeys(m for m, _, _ in ACCEPTED if m not in w.observed):
        parts.append(ex.accepted_columns_summary(model, w.counted(model), [(c, v) for m, c, v in ACCEPTED if m == model]))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def failing_rows(w: Warehouse, test: str, model: str, column: str | None) -> DataFrame:
    """The rows that fail a test (for unique: the values and how often they occur;
    for a reconciliation: the totals it compared)."""
    df = w.model(model)
    if test == "not_null":
        return ex.expect_not_null(df, column)
    if test == "unique":
        return ex.expect_unique(df, column)
    if test == "accepted_values":
        return ex.expect_accepted_values(df, column, next(v for m, c, v in ACCEPTED if (m, c) == (model, column)))
    if test == "relationships":
        parent, key = next((p, pc) for m, c, p, pc in RELATIONSHIPS if (m, c) == (model, column))
        return ex.expect_relationships(df, column, w.model(parent), key)
    return reconciliations(w)[test, model]


def reconciliations(w: Warehouse) -> dict[tuple[str, str], DataFrame]:
    """R1-R4 by test name and the model they test."""
    fact, source = w.counted("fct_attributed_revenue"), w.stg_portfolio_revenue
    return {
        ("revenue_reconciles_to_source", "fct_attributed_revenue"): ex.reconcile_revenue_to_source(fact, source),
        ("row_count_matches_source", "fct_attributed_revenue"): ex.reconcile_row_count(fact, source),
        ("attributed_not_exceeds_total", "fct_attributed_revenue"): ex.reconcile_attributed_not_exceeds_total(fact, source),
        ("campaign_attribution_not_exceeds_total", "int_campaign_attribution"):
            ex.reconcile_campaign_not_exceeds_total(w.counted("int_campaign_attribution"), source),
    }


def every_test(w: Warehouse) -> DataFrame:
    """All column tests (G1-G4) and reconciliations (R1-R4): test_name, model,
    column_name, failing_rows."""
    out = column_tests(w)
    for (_, model), t in reconciliations(w).items():
        out = out.unionByName(t.groupBy("test_name").agg(F.sum("failing_rows").alias("failing_rows")).select(
            "test_name", F.lit(model).alias("model"), F.lit(None).cast("string").alias("column_name"), "failing_rows"))
    return out


def failing_tests(w: Warehouse) -> DataFrame:
    return every_test(w).where(F.col("failing_rows") > 0)


def enforce(tests: DataFrame, keep: Callable[[str, str, str | None], None] | None = None) -> None:
    """Raise :class:`ModelTestError` naming the tests of ``tests`` (see
    :func:`every_test`) that fail; at most one row per test is collected.
    ``keep`` is called with each failing test before (to write its rows)."""
    bad = tests.where(F.col("failing_rows") > 0).collect()
    if bad:
        for r in bad if keep else []:
            keep(r["test_name"], r["model"], r["column_name"])
        raise ModelTestError(f"{len(bad)} model test(s) failed: " + ", ".join(
            f"{r['test_name']}({r['model']}{'.' + r['column_name'] if r['column_name'] else ''})={r['failing_rows']}"
            for r in bad))
