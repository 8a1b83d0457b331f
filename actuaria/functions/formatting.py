"""Presentation formatting and key formatting (applied as the last projection only)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from actuaria.functions.metrics import ColumnOrName, as_double, col_, round_half_away


def padded_key(prefix: str, number: ColumnOrName, width: int) -> Column:
    """``prefix`` followed by ``number`` left-padded with zeros to ``width`` characters;
    a longer number is kept whole."""
    digits = col_(number).cast("string")
    return F.concat(F.lit(prefix), F.lpad(digits, F.greatest(F.length(digits), F.lit(width)), F.lit("0")))


def _fixed(x: ColumnOrName, digits: int) -> Column:
    """``x`` rounded half away from zero to ``digits`` places, as exact decimal text.

    Rounding is done before formatting, so the text does not depend on a formatter's
    own tie rule (Java's DecimalFormat rounds half-even, printf-style formatters on
    the binary value).
    """
    return round_half_away(x, digits).cast(f"decimal(38,{digits})").cast("string")


def percent(x: ColumnOrName, digits: int = 1) -> Column:
    """0.7134 -> '71.3%'."""
    return F.concat(_fixed(as_double(x) * F.lit(100.0), digits), F.lit("%"))


def millions_eur(x: ColumnOrName, digits: int = 1) -> Column:
    """12345678.9 -> '€12.3M'."""
    return F.concat(F.lit("€"), _fixed(as_double(x) / F.lit(1e6), digits), F.lit("M"))


def thousands_eur(x: ColumnOrName) -> Column:
    """1234567.8 -> '€1,234,568' (grouping applied to an already rounded integer)."""
    whole = round_half_away(x, 0).cast("decimal(38,0)")
    return F.concat(F.lit("€"), F.format_number(whole, 0))


def year_spine(first_year: ColumnOrName, last_year: ColumnOrName) -> Column:
    """One row per year between two bounds (use with ``select(year_spine(a, b))``)."""
    return F.explode(F.sequence(col_(first_year), col_(last_year))).alias("year_value")
