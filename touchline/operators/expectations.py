"""Declarative column tests (G1-G4) and reconciliation tests.

Convention: ``expect_*`` returns the *violating rows* (empty = pass).  The
``*_summary`` builders run many tests at once and return one row per test,
``(test_name, model, column_name, failing_rows)``, so a passing test still
shows up; all not-null tests of one model share a single scan.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from touchline.functions import exact
from touchline.functions.exprs import round_dp
from touchline.operators.counted import n_rows
from touchline.operators.joins import DEFAULT_BROADCAST_ROWS, bounded_broadcast
from touchline.sources.schemas import RECONCILIATION_TOLERANCE

# ---------------------------------------------------------------------------
# single tests (violating rows)
# ---------------------------------------------------------------------------


def expect_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column).isNull())


def expect_unique(df: DataFrame, column: str) -> DataFrame:
    """Non-NULL values occurring more than once, with their counts."""
    return (df.where(F.col(column).isNotNull()).groupBy(column)
            .agg(n_rows(df).alias("n_records")).where(F.col("n_records") > 1))


def expect_accepted_values(df: DataFrame, column: str, values: Sequence) -> DataFrame:
    """Distinct values outside ``values``; NULL is not a violation."""
    return (df.groupBy(column).agg(n_rows(df).alias("n_records"))
            .where(~F.col(column).isin(list(values))))


def expect_relationships(df: DataFrame, column: str, parent: DataFrame, parent_column: str,
                         max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """Child rows whose non-NULL key has no parent row.

    The parent keys are broadcast when provably small (e.g. the 4-row company
    dimension, whose few keys would each be a hot partition of a shuffle join
    against the fact); otherwise a shuffle anti join, which AQE can split."""
    p, _ = bounded_broadcast(parent.select(F.col(parent_column).alias("__pk")), max_broadcast_rows)
    return df.where(F.col(column).isNotNull()).join(p, F.col(column) == p["__pk"], "left_anti")


# ---------------------------------------------------------------------------
# summaries
# ---------------------------------------------------------------------------


def _row(test: str, model: str, column: str, failing: F.Column) -> list[F.Column]:
    return [F.lit(test).alias("test_name"), F.lit(model).alias("model"),
            F.lit(column).alias("column_name"), failing.cast("bigint").alias("failing_rows")]


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def not_null_summary(specs: Sequence[tuple[str, DataFrame, Sequence[str]]]) -> DataFrame:
    """``specs``: (model name, frame, columns).  One aggregate per model."""
    parts = []
    for model, df, cols in specs:
        wide = df.agg(*[n_rows(df, F.col(c).isNull()).alias(c) for c in cols])
        parts.append(wide.unpivot([], list(cols), "column_name", "failing_rows")
                     .select(F.lit("not_null").alias("test_name"), F.lit(model).alias("model"),
                             "column_name", F.col("failing_rows").cast("bigint").alias("failing_rows")))
    return _union(parts)


def accepted_columns_summary(model: str, df: DataFrame, accepted: Sequence[tuple[str, Sequence]]) -> DataFrame:
    """The accepted-values tests of several columns of one model in one scan: only
    values outside their column's list come out of it, and are combined map-side."""
    def outside(c: str, values: Sequence) -> F.Column:
        return F.when(~F.col(c).isin(list(values)), F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")))

    bad = df.select(F.explode(F.filter(F.array(*[outside(c, v) for c, v in accepted]), lambda x: x.isNotNull())).alias("bad")).select("bad.*")
    counts = bad.distinct().groupBy("column_name").agg(F.count(F.lit(1)).alias("failing_rows"))
    names = df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c, _ in accepted])).alias("column_name"))
    return names.join(counts, "column_name", "left").select(
        F.lit("accepted_values").alias("test_name"), F.lit(model).alias("model"), "column_name",
        F.coalesce("failing_rows", F.lit(0).cast("bigint")).alias("failing_rows"))


def unique_summary(specs: Sequence[tuple[str, DataFrame, str]]) -> DataFrame:
    """``specs``: (model name, frame, column); failing rows = duplicated values."""
    return _union([expect_unique(df, col).agg(*_row("unique", model, col, F.count(F.lit(1))))
                   for model, df, col in specs])


def accepted_values_summary(specs: Sequence[tuple[str, DataFrame, str, Sequence]]) -> DataFrame:
    """``specs``: (model name, frame, column, values); failing rows = distinct bad values."""
    return _union([
        df.agg(*_row("accepted_values", model, col,
                     F.count_distinct(F.when(~F.col(col).isin(list(values)), F.col(col)))))
        for model, df, col, values in specs])


def relationships_summary(specs: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """``specs``: (model name, child frame, column, parent frame, parent column)."""
    return _union([expect_relationships(df, col, parent, pcol).agg(*_row("relationships", model, col, n_rows(df)))
                   for model, df, col, parent, pcol in specs])


# ---------------------------------------------------------------------------
# reconciliation (R1-R4): one summary row per compared quantity
# ---------------------------------------------------------------------------


def _total(df: DataFrame, col: str) -> F.Column:
    """Exact total of an amount column (see :mod:`touchline.functions.exact`), DOUBLE, as a scalar subquery."""
    return exact.ready(df, col).agg(exact.value(exact.total_of(df, col))).scalar()


def reconcile_revenue_to_source(fact: DataFrame, revenue: DataFrame,
                                tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """Fact total equals the source total within ``tolerance``."""
    totals = fact.sparkSession.range(1).select(exact.ready(fact, "revenue_amount").agg(exact.total_of(fact, "revenue_amount").alias("t")).scalar().alias("f"),
                                               exact.ready(revenue, "revenue_amount").agg(exact.total("revenue_amount").alias("t")).scalar().alias("s"))
    return totals.select(exact.value("f").alias("fct"), exact.value("s").alias("src"),
                         exact.value(exact.minus("f", "s")).alias("difference")).select(
        F.lit("revenue_reconciles_to_source").alias("test_name"),
        round_dp("fct", 2).alias("fct_total"),
        round_dp("src", 2).alias("src_total"),
        round_dp("difference", 2).alias("difference"),
        F.when(F.abs("difference") > tolerance, 1).otherwise(0).cast("bigint").alias("failing_rows"))


def reconcile_attributed_not_exceeds_total(fact: DataFrame, revenue: DataFrame,
                                           tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """R2: attributed revenue under each model does not exceed the source total.
    Both model totals come from one pass over the fact."""
    total = _total(revenue, "revenue_amount")
    # Every fact row carries both channels, so each model's attributed total is
    # the fact total; one aggregate yields both rows.
    per_model = exact.ready(fact, "revenue_amount").agg(exact.value(exact.total_of(fact, "revenue_amount")).alias("t")).select(
        F.col("t").alias("last_touch"), F.col("t").alias("first_touch"),
    ).unpivot([], ["last_touch", "first_touch"], "model", "attributed")
    return per_model.select(
        F.lit("attributed_not_exceeds_total").alias("test_name"), "model",
        round_dp("attributed", 2).alias("attributed_rev"),
        round_dp(total, 2).alias("total_rev"),
        F.when(F.coalesce("attributed", F.lit(0.0)) > total + tolerance, 1)
        .otherwise(0).cast("bigint").alias("failing_rows"))


def reconcile_row_count(fact: DataFrame, revenue: DataFrame) -> DataFrame:
    """Exactly one fact row per source revenue row."""
    f = fact.agg(n_rows(fact)).scalar()
    s = revenue.agg(F.count(F.lit(1))).scalar()
    return fact.sparkSession.range(1).select(
        F.lit("row_count_matches_source").alias("test_name"),
        f.cast("bigint").alias("fct_rows"), s.cast("bigint").alias("src_rows"),
        F.when(f != s, 1).otherwise(0).cast("bigint").alias("failing_rows"))


def reconcile_campaign_not_exceeds_total(campaign_attribution: DataFrame, revenue: DataFrame,
                                         tolerance: float = RECONCILIATION_TOLERANCE) -> DataFrame:
    """Revenue split over campaigns does not exceed the source total."""
    attr = _total(campaign_attribution, "attributed_revenue")
    total = _total(revenue, "revenue_amount")
    return campaign_attribution.sparkSession.range(1).select(
        F.lit("campaign_attribution_not_exceeds_total").alias("test_name"),
        round_dp(attr, 4).alias("attributed_rev"),
        round_dp(total, 2).alias("total_rev"),
        F.when(F.coalesce(attr, F.lit(0.0)) > total + tolerance, 1).otherwise(0).cast("bigint")
        .alias("failing_rows"))
