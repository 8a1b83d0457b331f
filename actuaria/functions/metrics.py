"""Actuarial ratio functions returning Spark Columns.

All functions are built from ``pyspark.sql.functions`` so they stay inside
whole-stage code generation; none needs a Python UDF.

Numeric conventions (kept identical in the SQL oracle):

* A ratio of two amounts divides the two values as DOUBLE (decimal sums stay exact
  DECIMAL until then).
* Rounding is half away from zero, ``floor(|x| * 10^n + 0.5) / 10^n`` with the sign
  restored, written with double literals so that both engines compute the same bits.
* Every division is guarded: ANSI mode raises on ``x / 0``; the guard returns NULL.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col_(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def as_double(x: ColumnOrName) -> Column:
    return col_(x).cast("double")


def round_half_up(x: ColumnOrName, digits: int) -> Column:
    """Round a non-negative double to ``digits`` places (halves go up)."""
    scale = float(10**digits)
    return F.floor(as_double(x) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def round_half_away(x: ColumnOrName, digits: int) -> Column:
    """Round a double of any sign to ``digits`` places, halves away from zero."""
    scale = float(10**digits)
    v = as_double(x)
    return (
        F.when(v < 0, -F.floor(-v * F.lit(scale) + F.lit(0.5)) / F.lit(scale))
        .otherwise(F.floor(v * F.lit(scale) + F.lit(0.5)) / F.lit(scale))
    )


def ratio(
    num: ColumnOrName,
    den: ColumnOrName,
    digits: int | None = None,
    when: Column | None = None,
) -> Column:
    """``num / den`` as DOUBLE, rounded when ``digits`` is given, NULL unless ``when``.

    The default guard is ``den > 0`` (a premium or a count).
    """
    guard = (col_(den) > 0) if when is None else when
    value = F.try_divide(as_double(num), as_double(den))
    if digits is not None:
        value = round_half_up(value, digits)
    return F.when(guard, value)


def mean(total: ColumnOrName, count: ColumnOrName) -> Column:
    """Average as ``double(sum) / count`` (NULL for an empty group)."""
    return ratio(total, count)


def _as_dec18_6_double(x: ColumnOrName) -> Column:
    return col_(x).cast("decimal(18,6)").cast("double")


def loss_ratio(losses: ColumnOrName, premiums: ColumnOrName, decimals: int = 4) -> Column:
    """Incurred losses over earned premium; NULL when premium is NULL or not positive."""
    p = col_(premiums)
    value = F.try_divide(_as_dec18_6_double(losses), _as_dec18_6_double(p))
    return F.when(p.isNotNull() & (p > 0), round_half_away(value, decimals))


def burning_cost(losses: ColumnOrName, exposure: ColumnOrName, decimals: int = 2) -> Column:
    """Losses per unit of exposure (e.g. per policy-year), DECIMAL(18, decimals).

    NULL when the exposure is NULL or not positive.
    """
    e = col_(exposure)
    value = F.try_divide(_as_dec18_6_double(losses), _as_dec18_6_double(e))
    return F.when(
        e.isNotNull() & (e > 0),
        round_half_away(value, decimals).cast(f"decimal(18,{decimals})"),
    )


def combined_ratio(
    losses: ColumnOrName, expenses: ColumnOrName, premiums: ColumnOrName, decimals: int = 4
) -> Column:
    """(losses + expenses) / premiums; NULL when premium is NULL or not positive."""
    p = col_(premiums)
    total = col_(losses).cast("decimal(18,6)") + col_(expenses).cast("decimal(18,6)")
    value = F.try_divide(total.cast("double"), _as_dec18_6_double(p))
    return F.when(p.isNotNull() & (p > 0), round_half_away(value, decimals))


def safe_divide(num: ColumnOrName, den: ColumnOrName, precision: int = 4) -> Column:
    """num / den rounded; NULL only when den is NULL or zero (negative den divides)."""
    d = col_(den)
    value = F.try_divide(as_double(num), as_double(d))
    return F.when(d.isNotNull() & (d != 0), round_half_away(value, precision))


def cents_to_euros(cents: ColumnOrName) -> Column:
    """Integer cents to euros, rounded to 2 places, DECIMAL(38,2)."""
    c = col_(cents).cast("decimal(38,0)")
    return (c / F.lit(100)).cast("decimal(38,2)")


def share_squared(part: ColumnOrName, total: ColumnOrName) -> Column:
    """(part / total)^2 written as a product, NULL unless total > 0."""
    s = F.try_divide(as_double(part), as_double(total))
    return F.when(col_(total) > 0, s * s)
