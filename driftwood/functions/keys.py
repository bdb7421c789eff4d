"""Period keys kept as text (``YYYY``, ``YYYY_MM``, ``YYYY_MM_DD``)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

KEY_SEPARATOR = "_"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def key_part(c, index: int, sep: str = KEY_SEPARATOR) -> Column:
    """Part ``index`` of a separated key; null when out of range."""
    return F.get(F.split(_col(c), sep), index)


def year_of_key(c, sep: str = KEY_SEPARATOR) -> Column:
    return key_part(c, 0, sep)


def month_of_day(c, sep: str = KEY_SEPARATOR) -> Column:
    """``YYYY_MM`` of a ``YYYY_MM_DD`` key."""
    return F.concat(key_part(c, 0, sep), F.lit(sep), key_part(c, 1, sep))


def key_to_date(c, fmt: str = "yyyy_MM_dd") -> Column:
    """Parse a text key into a date; invalid keys become null."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def period_key(ts, fmt: str) -> Column:
    """Format a timestamp or date as a text period key."""
    return F.date_format(_col(ts), fmt)


def composite_key(cols, sep: str = KEY_SEPARATOR) -> Column:
    """``a || sep || b``; null when any part is null, like SQL ``||``."""
    parts = []
    for i, c in enumerate(cols):
        if i:
            parts.append(F.lit(sep))
        parts.append(_col(c).cast("string"))
    return F.concat(*parts)
