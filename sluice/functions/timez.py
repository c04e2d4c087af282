"""Time-zone helpers.

UTC instants are held as TIMESTAMP_NTZ values carrying the UTC wall clock, so no
result depends on the session time zone.  Local wall-clock strings are turned
into UTC with the zone's rules; a wall time inside a daylight-saving gap moves
forward by the gap, an ambiguous one takes the earlier offset.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampNTZType

from .casts import strict_wall_clock


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def local_to_utc(c, zone: str) -> Column:
    """Local wall-clock text (or NTZ value) in ``zone`` -> UTC instant (NTZ)."""
    ts = strict_wall_clock(c, TimestampNTZType(), "TIMESTAMP")
    return F.convert_timezone(F.lit(zone), F.lit("UTC"), ts)


def utc_to_local_date(c, zone: str) -> Column:
    """Calendar date in ``zone`` of a UTC instant."""
    return F.to_date(F.convert_timezone(F.lit("UTC"), F.lit(zone), _col(c)))


def utc_date(c) -> Column:
    """Calendar date in UTC of a UTC instant."""
    return F.to_date(_col(c))


def is_weekend(c) -> Column:
    return F.dayofweek(_col(c)).isin(1, 7)


def weekday_name(c) -> Column:
    """English weekday name ('Monday' ... 'Sunday')."""
    return F.date_format(_col(c), "EEEE")


def seconds_between(start, end) -> Column:
    """Fractional seconds from ``start`` to ``end`` (both instants)."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(1_000_000.0)
