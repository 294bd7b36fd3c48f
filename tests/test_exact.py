"""Exact sums of amounts against exact arithmetic in Python."""
import math
import random
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from touchline.functions import exact


def sums(spark, groups, parts=1, seed=0):
    rows = [(k, x) for k, v in groups.items() for x in v]
    random.Random(seed).shuffle(rows)
    df = spark.createDataFrame(rows, "k string, x double").repartition(parts)
    return {r.k: r.v for r in exact.ready(df, "x").groupBy("k").agg(exact.total("x").alias("t")).select("k", exact.value("t").alias("v")).collect()}


def is_decimal(x):
    return any(abs(round(x * 10.0 ** p)) <= 10 ** 15 and round(x * 10.0 ** p) / 10.0 ** p == x for p in (2, 8))


def plain(values):
    """Decimals as they are written, other doubles as the numbers they are."""
    near = float(sum((Decimal(repr(x)) for x in values if is_decimal(x)), Decimal(0)))
    others = math.fsum(x for x in values if not is_decimal(x))
    short = float(f"{others:.14e}")
    return near + (short if abs(short - others) <= abs(others) * 2.0 ** -52 else others)


@pytest.fixture(scope="module")
def groups():
    rng = random.Random(7)
    out = {f"any{g}": [rng.choice([1, -1]) * rng.random() * 10.0 ** rng.randint(-14, 25) for _ in range(rng.randint(1, 30))] for g in range(120)}
    for places in (0, 2, 4, 8):
        out |= {f"places{places}_{g}": [rng.choice([1, -1]) * round(rng.random() * 10 ** rng.randint(0, 7), places)
                                        for _ in range(rng.randint(1, 300))] for g in range(30)}
    out |= {"zero": [0.0, -0.0], "negative": [-0.1] * 7, "cancel": [1e23, 1.0, -1e23, 0.1], "edge": [exact.SMALLEST, -exact.SMALLEST, 2.0 ** 86],
            "tie": [2.0 ** 60 + 2.0 ** 8, 2.0 ** -40], "mixed": [0.1 + 0.2, 0.1, 1e9 + 0.01, -1e9, 1 / 3], "cents": [9999999999999.99, -0.01] * 3, "beyond": [90071992547409.91, -0.01] * 3,
            "half": [0.1225, 0.1225], "small": [4e-9] * 1000, "eight": [1234567.12345678] * 9, "sixteen": [12345678.12345678] * 9, "one": [1 / 3]}
    return out


def test_sums_are_exact_in_any_order(spark, groups):
    want = {k: plain(v) for k, v in groups.items()}
    assert sums(spark, groups) == want
    assert sums(spark, groups, parts=7, seed=1) == want
    assert want["small"] == 4e-6 and want["half"] == 0.245 and want["one"] == 1 / 3


def test_sums_of_decimals_are_those_of_decimal_arithmetic(spark, groups):
    own = {k: v for k, v in groups.items() if k.startswith("places") or k in ("cents", "half", "eight")}
    assert sums(spark, own) == {k: float(sum(Decimal(repr(x)) for x in v)) for k, v in own.items()}


def test_sums_come_near_the_true_sum(spark, groups):
    got = sums(spark, groups)
    for k, v in groups.items():
        near = sum(Fraction(repr(x)) if is_decimal(x) else Fraction(x) for x in v)
        assert abs(Fraction(got[k]) - near) <= sum(abs(Fraction(x)) for x in v) * Fraction(1, 2 ** 50)


def test_large_and_odd_amounts_do_not_raise(spark):
    got = sums(spark, {"large": [1e23] * 10, "huge": [1e300, 1e300], "inf": [math.inf, 1.0], "tiny": [1e-300, 1.0], "nan": [math.nan]})
    assert got["large"] == 1e24 and got["huge"] == 2e300 and got["inf"] == math.inf and got["tiny"] == 1.0 and math.isnan(got["nan"])
    flags = spark.createDataFrame([(x,) for x in (0.0, 1e23, 4e-9, 1e300, 1e-300, math.nan, None)], "x double").select(exact.held("x")).collect()
    assert [r[0] for r in flags] == [True, True, True, False, False, False, None]


def test_sums_of_sums_differences_and_nulls(spark, groups):
    rows = [(i, k, x) for i, (k, v) in enumerate(groups.items()) for x in v] + [(0, "none", None)]
    df = spark.createDataFrame(rows, "i long, k string, x double")
    per = exact.ready(df, "x").groupBy("k", (F.col("i") % 2).alias("odd")).agg(exact.total("x").alias("t"))
    whole = per.agg(exact.value(exact.add("t")).alias("v"), exact.add("t", when="odd = 1").alias("o"), exact.add("t").alias("t"))
    r = whole.select("v", exact.value(exact.minus("t", "o")).alias("even"), exact.value("o").alias("odd")).first()
    assert r.v == plain([x for _, _, x in rows if x is not None])
    assert r.odd == plain([x for i, _, x in rows if i % 2 and x is not None])
    assert r.even == plain([x for i, _, x in rows if i % 2 == 0 and x is not None])
    none = per.filter("k = 'none'").withColumn("one", F.expr(exact.minus("t", "t"))).select(exact.value("t").alias("v"), exact.value("one").alias("d")).first()
    assert none.v is None and none.d is None


def test_sums_and_means(spark):
    df = exact.ready(spark.createDataFrame([(4e-9,)] * 1000 + [(None,)], "x double"), "x")
    assert tuple(df.agg(exact.sum_of("x"), exact.mean_of("x")).first()) == (4e-6, 4e-6 / 1000)
    assert tuple(df.filter("x IS NULL").agg(exact.sum_of("x"), exact.mean_of("x")).first()) == (None, None)
