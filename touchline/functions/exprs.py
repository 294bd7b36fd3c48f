"""Column expressions shared by every model.

All helpers return ``Column`` objects built from ``pyspark.sql.functions`` only,
so they stay inside whole-stage codegen (no Python UDF anywhere).

Numeric conventions (they decide cross-engine parity, see README "Numerics"):

* Amounts are summed exactly, whatever their decimals, partitioning and order
  (:mod:`touchline.functions.exact`), and rounded to ``DOUBLE`` once, at the edge.
* Rounding is ``round(x * 10^n) / 10^n`` on doubles (:func:`round_dp`), which is
  bit-for-bit what a binary-rounding engine does (including the sign of a
  result that rounds to zero), instead of Spark's decimal-string HALF_UP
  rounding of ``round(x, n)``.
* Means are ``exact sum / count`` so the result does not depend on the
  order rows reach an aggregation buffer.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_dp(c: ColumnOrName, n: int) -> Column:
    """Round a double to ``n`` decimals as ``round(x * 10^n) / 10^n``, half away
    from zero, keeping the sign of a result that rounds to zero (-0.04 -> -0.0
    at one decimal), bit-identical to binary-rounding engines.  Spark's own
    ``round`` drops that sign, so the magnitude is rounded and the sign applied."""
    scale = float(10**n)
    x = _c(c).cast("double")
    return F.signum(x) * (F.round(F.abs(x) * F.lit(scale)) / F.lit(scale))


MONEY = "decimal(30,8)"


def money(c: ColumnOrName) -> Column:
    """Decimal view of an amount, eight decimals."""
    return _c(c).cast(MONEY)


def money_sum(c: ColumnOrName) -> Column:
    """Order-independent sum of amounts of eight decimals at most, as DOUBLE (the
    models sum any amount, see :mod:`touchline.functions.exact`)."""
    return F.sum(money(c)).cast("double")


def money_mean(c: ColumnOrName) -> Column:
    """Order-independent mean of such amounts, as DOUBLE.

    NULL inputs are ignored like ``avg``; an all-NULL group gives NULL.
    """
    return F.sum(money(c)).cast("double") / F.nullif(F.count(_c(c)), F.lit(0))


def safe_div(num: ColumnOrName, den: ColumnOrName) -> Column:
    """Real division that yields NULL for a zero denominator (ANSI-safe)."""
    return _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double")


def norm(c: ColumnOrName) -> Column:
    """Channel / category normalisation: ``lower(trim(x))``."""
    return F.lower(F.trim(_c(c)))


def month_start(c: ColumnOrName) -> Column:
    """First day of the month as DATE (not TIMESTAMP)."""
    return F.trunc(_c(c).cast("date"), "month")


def month_str(c: ColumnOrName) -> Column:
    """``YYYY-MM`` text of a date."""
    return F.date_format(_c(c), "yyyy-MM")


def month_from_str(c: ColumnOrName) -> Column:
    """``YYYY-MM`` text to the first day of that month (DATE)."""
    return F.to_date(F.concat(_c(c), F.lit("-01")), "yyyy-MM-dd")


def month_index(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Number of month boundaries crossed from ``start`` to ``end``.

    31 Jan -> 1 Feb is 1, unlike ``months_between``/``timestampdiff`` which
    count whole elapsed months.
    """
    s, e = _c(start), _c(end)
    return ((F.year(e) - F.year(s)) * 12 + (F.month(e) - F.month(s))).cast("bigint")


def pick(values: Sequence[str], index: ColumnOrName) -> Column:
    """``values[index]`` for a 0-based integer column over a fixed literal list."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), _c(index).cast("int") + 1)


def is_in(c: ColumnOrName, *others: ColumnOrName) -> Column:
    """SQL ``c IN (a, b, ...)`` over columns, three-valued like SQL."""
    return _c(c).isin(*[_c(o) for o in others])
