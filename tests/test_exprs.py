"""Parity helpers: rounding, month index, exact sums, safe division."""
import datetime as dt
import random

import duckdb
from pyspark.sql import functions as F

from touchline.functions.exprs import money_mean, money_sum, month_index, round_dp, safe_div


def test_round_dp_matches_duckdb_binary_rounding(spark):
    rnd = random.Random(7)
    vals = [rnd.uniform(-1e6, 1e6) for _ in range(3000)]
    vals += [k / 2000 for k in range(-2000, 2000)]  # many exact half-way cases
    vals += [0.125, 2.675, 1.005, -0.5, 0.5, 1.5, 2.5, -2.5, 0.0, -0.0, -0.04, -0.0004, 0.04, -1e-9]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    con = duckdb.connect()
    for n in (0, 1, 2, 3, 4):
        got = [r[0] for r in df.select(round_dp("x", n)).collect()]
        exp = [r[0] for r in con.execute(f"SELECT round(x, {n}) FROM (SELECT unnest($1) AS x)", [vals]).fetchall()]
        assert got == exp, f"n={n}"
        # same bits, including the sign of zero (-0.04 -> -0.0)
        assert [repr(v) for v in got] == [repr(v) for v in exp], f"n={n}"


def test_month_index_counts_boundaries(spark):
    rows = [(dt.date(2024, 1, 31), dt.date(2024, 2, 1), 1), (dt.date(2024, 1, 1), dt.date(2024, 1, 31), 0),
            (dt.date(2023, 12, 15), dt.date(2025, 1, 1), 13), (dt.date(2024, 5, 1), dt.date(2024, 3, 1), -2)]
    df = spark.createDataFrame(rows, "a date, b date, e int")
    assert all(r[0] == r[1] for r in df.select(month_index("a", "b"), "e").collect())


def test_money_sum_is_exact_and_order_free(spark):
    vals = [0.1] * 10 + [0.2] * 10 + [1e9 + 0.01, -1e9]
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(7)
    s, m = df.agg(money_sum("x"), money_mean("x")).first()
    assert s == 3.01
    assert m == 3.01 / len(vals)


def test_safe_div_null_on_zero(spark):
    df = spark.createDataFrame([(1, 0), (3, 2), (None, 1)], "a int, b int")
    assert [r[0] for r in df.select(safe_div("a", "b")).collect()] == [None, 1.5, None]
