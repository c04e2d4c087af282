"""Strict casts and exact decimal arithmetic.

Staging casts must fail on garbage instead of turning it into NULL, whatever the
session's ANSI setting: a NULL input passes, an unparsable one raises.

Exact decimals: NUMERIC is stored as decimal(38,9).  Spark widens decimal
results and, when precision runs out, trims the scale down to as little as 6
digits.  The helpers below size the operands so that the result keeps the
digits that matter, then cast back to NUMERIC (ties round away from zero).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, DecimalType, LongType

NUMERIC = DecimalType(38, 9)
INT64 = LongType()


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_cast(c, dtype: DataType, what: str | None = None) -> Column:
    """Cast that raises on a non-NULL value it cannot convert (never try_cast)."""
    col = _col(c)
    tried = col.try_cast(dtype)
    label = what or dtype.simpleString()
    # coalesce evaluates the cast once; the error branch runs only when it failed
    failure = F.when(col.isNotNull(), F.raise_error(
        F.concat(F.lit(f"cannot cast to {label}: '"), col.cast("string"), F.lit("'"))))
    return F.coalesce(tried, failure.cast(dtype))


def to_numeric(c) -> Column:
    return strict_cast(c, NUMERIC, "NUMERIC")


def to_int64(c) -> Column:
    return strict_cast(c, INT64, "INT64")


# A whole ISO date, optionally with a time of day; no zone, no partial date, nothing after it.
_DAY = "[0-9]{4}-[0-9]{2}-[0-9]{2}"
_TIME = "[0-9]{2}:[0-9]{2}(:[0-9]{2}([.][0-9]{1,6})?)?"
WALL_CLOCK = f"^{_DAY}([ T]{_TIME})?$"


def strict_wall_clock(c, dtype: DataType, what: str) -> Column:
    """``strict_cast`` of a date or wall-clock text: a text with anything but that
    (a zone suffix, a missing day, trailing characters) raises."""
    col = _col(c)
    whole = F.when(col.cast("string").rlike(WALL_CLOCK), col.cast("string")).try_cast(dtype)
    failure = F.when(col.isNotNull(), F.raise_error(
        F.concat(F.lit(f"cannot cast to {what}: '"), col.cast("string"), F.lit("'"))))
    return F.coalesce(whole, failure.cast(dtype))


def to_date(c) -> Column:
    """Date of an ISO date or datetime string (the time part is dropped)."""
    return strict_wall_clock(c, DateType(), "DATE")


def _fit(c, dtype: DecimalType) -> Column:
    """Narrow a decimal for arithmetic; a value that does not fit raises
    (whatever the ANSI setting) instead of turning into NULL."""
    return strict_cast(c, dtype, f"{dtype.simpleString()} (operand too large)")


def exact_add(a, b) -> Column:
    """a + b for two NUMERIC values, kept at 9 places (NULL if either is NULL)."""
    return (_fit(a, DecimalType(37, 9)) + _fit(b, DecimalType(37, 9))).cast(NUMERIC)


def exact_ratio(num, den) -> Column:
    """num / den rounded half away from zero to 9 places.

    Operands go to decimal(18,9), so the quotient carries 20 places before the
    final rounding; a zero denominator raises instead of yielding NULL.
    """
    d = _col(den)
    q = _fit(num, DecimalType(18, 9)) / _fit(d, DecimalType(18, 9))
    return (F.when(d == 0, F.raise_error(F.lit("division by zero in exact_ratio")))
            .otherwise(q).cast(NUMERIC))


def exact_product(a, b) -> Column:
    """a * b at 17 places, as decimal(38,17): round it once, at the end."""
    return _fit(a, DecimalType(20, 9)) * _fit(b, DecimalType(18, 9))
