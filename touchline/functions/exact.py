"""Exact sums of amounts in built-in functions, the same in any order.

Amounts are decimals that doubles only come near, so an amount is taken as the
decimal it stands for: with two decimals (up to 1e13) or else eight (up to 1e7), 15
digits either way, which doubles tell apart, if that is the decimal whose double it
is. A division of such whole numbers is rounded once, so comparing it with the amount
is the proof. It is added as whole cents and whole 1e-8 beyond them. Any other double is taken as what it is,
an integer mantissa times a power of two, split over ``DIGITS`` bins of ``BITS`` bits:
each holds the whole multiple of ``2 ** (LOWEST + BITS k)`` nearest to what the
higher bins left. All of these are small whole numbers, nothing is rounded away, and
they are added up as BIGINT: exact, without regard to partitioning or order,
combined map-side, in a buffer of fixed size.

:func:`ready` writes those parts beside an amount column, below an aggregate in which
:func:`total` then gives the sum as a value (a struct of bins). That can be added up
again (:func:`add`), subtracted (:func:`minus`) and, once, at the edge, turned into
a double (:func:`value`); a rollup that stores it loses nothing. The decimals'
part becomes the double nearest to it. The other doubles' part (nearest, ties to even)
is written with the 15 digits that any double keeps, if that lies within a unit in
the last place or two of it; so a thousand times 4e-9 is 4e-6.

Range: besides those decimals, amounts from 2^-52 (2e-16) to 2^87 (1.5e26) in size,
and 2^39 of them in a group (beyond that BIGINT raises, under ANSI). Any other double,
infinities and NaN included, is added in ``rest`` as a plain double: it never
raises, but rounds like a plain sum.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS, DIGITS, LOWEST = 24, 8, -104
SMALLEST, LARGEST = 2.0 ** (LOWEST + 52), 2.0 ** (LOWEST + BITS * DIGITS - 1)
#: Cents in three parts, then the 1e-8 beyond them, then the binary bins.
_CENT_BITS, _CENTS, _BEYOND = 18, 3, 1_000_000
SLOTS = _CENTS + 1 + DIGITS
#: Column with the number of equal rows that a row stands for (:mod:`touchline.operators.counted`).
TIMES = "__times"


class Sum(str):
    """SQL text of an exact sum (one text is planned much faster than its many columns)."""

    def alias(self, name: str) -> Column:
        return F.expr(self).alias(name)


def _d(x: float) -> str:
    return f"{x!r}D"


def _whole(x: str, places: int) -> str:
    """The whole number k with the double of ``k / 10 ** places`` equal to x, or NULL."""
    k, scale = f"rint({x} * {_d(10.0 ** places)})", _d(10.0 ** places)
    return f"CASE WHEN abs({k}) <= 1E15D AND {k} / {scale} = {x} THEN {k} END"


def _within(x: str) -> str:
    return f"(abs({x}) >= {_d(SMALLEST)} AND abs({x}) < {_d(LARGEST)})"


def held(name: str) -> Column:
    """Whether the bins hold the amount exactly (NULL for NULL)."""
    x = f"CAST({name} AS DOUBLE)"
    return F.expr(f"CASE WHEN {x} IS NOT NULL THEN ({_whole(x, 2)}) IS NOT NULL OR {_within(x)} END")


def ready(df: DataFrame, *names: str) -> DataFrame:
    """``df`` with the parts of each amount column beside it: whole cents and 1e-8
    beyond them, else another double within range, else the rest. Columns that hold
    sums already stay as they are."""
    for name in names:
        if isinstance(df.schema[name].dataType, T.StructType):
            continue
        x, own = f"CAST({name} AS DOUBLE)", f"__{name}"
        df = df.selectExpr("*", f"{_whole(x, 2)} AS {own}_cents", f"{_whole(x, 8)} AS {own}_fine").selectExpr(
            "*", f"coalesce({own}_cents, rint({own}_fine / {_BEYOND}D)) AS {own}_high").selectExpr(
            f"* EXCEPT ({own}_cents, {own}_fine)",
            f"IF({own}_cents IS NOT NULL, 0D, {own}_fine - {own}_high * {_BEYOND}D) AS {own}_low",
            f"CASE WHEN {own}_high IS NULL AND {_within(x)} THEN {x} END AS {own}_other",
            f"CASE WHEN {own}_high IS NULL AND NOT {_within(x)} THEN {x} END AS {own}_rest")
    return df


def _digits(x: str, lowest: int, bits: int, count: int) -> list[str]:
    """``count`` whole numbers d with x = sum of ``d[k] * 2 ** (lowest + bits * k)``.
    Scaling by a power of two is exact, rint rounds to a whole number."""
    units = [f"rint({x} * {_d(2.0 ** -(lowest + bits * k))})" for k in range(count)]
    return [f"CAST({units[k]}{f' - {units[k + 1]} * {_d(2.0 ** bits)}' if k + 1 < count else ''} AS BIGINT)" for k in range(count)]


def _acc(bins: list[str], rest: str) -> Sum:
    return Sum(f"named_struct('bins', array({', '.join(bins)}), 'rest', {rest})")


def total(name: str, when: str | None = None, times: str | None = None) -> Sum:
    """Aggregate: the exact sum of an amount column that is :func:`ready` (of the
    rows for which the condition ``when`` holds; each ``times`` times)."""
    def part(p: str) -> str:
        return f"__{name}_{p}" if when is None else f"IF({when}, __{name}_{p}, NULL)"

    by = "" if times is None else f" * {times}"

    slots = [*_digits(part("high"), 0, _CENT_BITS, _CENTS), f"CAST({part('low')} AS BIGINT)", *_digits(part("other"), LOWEST, BITS, DIGITS)]
    return _acc([f"sum({d}{by})" for d in slots], f"sum({part('rest')}{by})")


def add(name: str, when: str | None = None) -> Sum:
    """Aggregate: the exact sum of a column of exact sums."""
    x = name if when is None else f"IF({when}, {name}, NULL)"
    return _acc([f"sum({x}.bins[{k}])" for k in range(SLOTS)], f"sum({x}.rest)")


def add_over(name: str, window: WindowSpec) -> Column:
    """Window sum of a column of exact sums."""
    a = F.col(name)
    return F.struct(F.array(*[F.sum(a["bins"][k]).over(window) for k in range(SLOTS)]).alias("bins"),
                    F.sum(a["rest"]).over(window).alias("rest"))


def total_of(df: DataFrame, name: str, when: str | None = None) -> Sum:
    """Exact sum of ``df[name]``, ready amounts or sums of them. The amount of a row
    that counts for several (``TIMES``) is added as often; sums hold theirs."""
    if isinstance(df.schema[name].dataType, T.StructType):
        return add(name, when)
    return total(name, when, TIMES if TIMES in df.columns else None)


def _none(a: str) -> str:
    return f"({a} IS NULL OR ({a}.bins[0] IS NULL AND {a}.bins[{_CENTS + 1}] IS NULL AND {a}.rest IS NULL))"


def minus(a: str, b: str) -> Sum:
    """The exact difference of two columns of sums; NULL if either is."""
    bins = [f"coalesce({a}.bins[{k}], 0L) - coalesce({b}.bins[{k}], 0L)" for k in range(SLOTS)]
    rest = f"IF({a}.rest IS NULL AND {b}.rest IS NULL, NULL, coalesce({a}.rest, 0D) - coalesce({b}.rest, 0D))"
    return Sum(f"IF({_none(a)} OR {_none(b)}, NULL, {_acc(bins, rest)})")


def _decimal(a: str) -> str:
    """The double nearest to the cents and the 1e-8 beyond them."""
    cents = "CAST(0 AS DECIMAL(38,0))"
    for k in reversed(range(_CENTS)):
        cents = f"CAST({cents} * CAST({1 << _CENT_BITS} AS DECIMAL(7,0)) + CAST({a}.bins[{k}] AS DECIMAL(20,0)) AS DECIMAL(38,0))"
    units = f"CAST({cents} * CAST({_BEYOND} AS DECIMAL(7,0)) + CAST({a}.bins[{_CENTS}] AS DECIMAL(20,0)) AS DECIMAL(38,0))"
    return f"CAST(concat(CAST({units} AS STRING), 'E-8') AS DOUBLE)"


def _rounded(bins: str) -> str:
    """The double nearest to binary bins of any sign. Carries make digits of the
    size; from the highest on, two go into a, two into b, and whether more follow into
    the last bit of b: a has more bits than a digit, so that bit only decides ties when
    the sum is rounded, once. The powers of two are exact."""
    up, mask = f"shiftright(c + s, {BITS})", f"{(1 << BITS) - 1}L"
    scales = ", ".join(_d(2.0 ** (LOWEST + BITS * (j - 3))) for j in range(DIGITS + 2))
    magnitude = (f"aggregate(transform(o, s -> IF(neg, -s, s)), named_struct('c', 0L, 'd', array(0L, 0L, 0L)), "
                 f"(st, s) -> named_struct('c', shiftright(st.c + s, {BITS}), 'd', concat(st.d, array((st.c + s) & {mask}))), "
                 f"st -> concat(st.d, array(st.c & {mask}, shiftright(st.c, {BITS}))))")
    read = (f"(st, d) -> IF(st.n = 0 AND d = 0, st, named_struct('n', st.n + 1L, 'a', IF(st.n < 2, shiftleft(st.a, {BITS}) + d, st.a), "
            f"'b', IF(st.n >= 2 AND st.n < 4, shiftleft(st.b, {BITS}) + d, st.b), 'more', IF(st.n >= 4 AND d <> 0, 1L, st.more)))")
    finish = (f"st -> IF(st.n = 0, 0D, (CAST(st.a AS DOUBLE) * {_d(2.0 ** (2 * BITS))} + CAST(st.b | st.more AS DOUBLE)) "
              f"* get(array({scales}), CAST(st.n - 4 AS INT)))")
    return (f"transform(array({bins}), o -> transform(array(aggregate(o, 0L, (c, s) -> {up}) < 0), neg -> IF(neg, -1D, 1D) * "
            f"aggregate(reverse({magnitude}), named_struct('n', 0L, 'a', 0L, 'b', 0L, 'more', 0L), {read}, {finish}))[0])[0]")


def value(acc: str) -> Column:
    """The sum (a column of sums, or a :class:`Sum`) as DOUBLE; NULL if no amount was added."""
    other = _rounded(f"slice(a.bins, {_CENTS + 2}, {DIGITS})")
    snapped = (f"transform(array({other}), x -> IF(abs(CAST(format_string('%.14e', x) AS DOUBLE) - x) <= abs(x) * {_d(2.0 ** -52)}, "
               "CAST(format_string('%.14e', x) AS DOUBLE), x))[0]")
    return F.expr(
        f"transform(array({acc}), a -> IF({_none('a')}, NULL, IF(a.bins[0] IS NULL, 0D, {_decimal('a')}) + "
        f"IF(a.bins[{_CENTS + 1}] IS NULL, 0D, {snapped}) + coalesce(a.rest, 0D)))[0]")


def sum_of(name: str) -> Column:
    """Exact sum of an amount column that is :func:`ready`, as DOUBLE."""
    return value(total(name))


def mean_of(name: str) -> Column:
    """Exact sum of such a column over the count of its amounts, as DOUBLE; NULL without one."""
    return value(total(name)) / F.nullif(F.count(F.col(name)), F.lit(0))
