"""Column expressions with the null rules the operators share.

ANSI mode is on, so every division that can meet a zero goes through ``ratio``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import sql

INFINITY = float("inf")


def col(c: Column | str) -> Column:
    return F.col(f"`{c}`") if isinstance(c, str) else c


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Quotient; NULL where the denominator is zero or either side is NULL."""
    if isinstance(numerator, str) and isinstance(denominator, str):
        return F.expr(sql.ratio(sql.q(numerator), sql.q(denominator)))
    return F.try_divide(col(numerator).cast("double"), col(denominator).cast("double"))


def pct_change(current: Column | str, base: Column | str) -> Column:
    """Change in percentage points; a zero or missing base gives NULL."""
    if isinstance(current, str) and isinstance(base, str):
        return F.expr(sql.pct_change(sql.q(current), sql.q(base)))
    return (ratio(current, base) - F.lit(1.0)) * F.lit(100.0)


def finite(c: Column | str) -> Column:
    """NaN and the infinities become NULL."""
    if isinstance(c, str):
        return F.expr(sql.finite(sql.q(c)))
    x = col(c).cast("double")
    return F.when(F.abs(x) < F.lit(INFINITY), x)  # NaN is above infinity in comparisons


def positive(c: Column | str) -> Column:
    """The value where it is above zero, else NULL (zeros are placeholders, not prices)."""
    if isinstance(c, str):
        return F.expr(sql.positive(sql.q(c)))
    x = col(c).cast("double")
    return F.when((x > 0) & (x < F.lit(INFINITY)), x)


def floor_zero(c: Column | str) -> Column:
    """Clip below at zero and keep NULL (``greatest`` would turn NULL into 0)."""
    x = col(c)
    return F.when(x < 0, F.lit(0.0)).otherwise(x)


def number(c: Column | str) -> Column:
    """Numeric coercion: text that is no number becomes NULL."""
    if isinstance(c, str):
        return F.expr(sql.number(sql.q(c)))
    return finite(col(c).try_cast("double"))


def close_to(a: Column | str, b: Column | str, rtol: float, atol: float) -> Column:
    """Tolerance test with ``b`` as the reference side."""
    return F.abs(col(a) - col(b)) <= F.lit(atol) + F.lit(rtol) * F.abs(col(b))


def growth_rate(current: Column | str, base: Column | str, years: float) -> Column:
    """Compound annual growth in percentage points; undefined roots and zero bases give NULL."""
    grown = F.pow(ratio(current, base), F.lit(1.0 / years))
    return finite((grown - F.lit(1.0)) * F.lit(100.0))


def anniversary(date: Column | str, years: int = 1) -> Column:
    """Same calendar date ``years`` earlier; February 29 maps to February 28."""
    return F.add_months(col(date), -12 * years)


def common_day_of_year(date: Column | str) -> Column:
    """Day of year on a 365-day calendar: after February, leap years shift back by one; February 29 is NULL."""
    d = col(date)
    leap = F.dayofyear(F.last_day(F.make_date(F.year(d), F.lit(12), F.lit(1)))) == 366
    plain = F.dayofyear(d)
    return (
        F.when((F.month(d) == 2) & (F.dayofmonth(d) == 29), F.lit(None).cast("int"))
        .when(leap & (F.month(d) > 2), plain - 1)
        .otherwise(plain)
    )
