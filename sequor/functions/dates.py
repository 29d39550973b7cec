"""Date helpers for the ``mm-dd-yy`` directory dates.

A date directory is written as two-digit month, day and year. Validation
prefixes the year with the century "20" and then requires a real calendar
date with a 1-2 digit month and day; four-digit years are rejected.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..params import DATE_CENTURY_PREFIX, DATE_DIR_FORMAT

MDY_FORMAT = DATE_DIR_FORMAT
MDY_PATTERN = r"([0-9]{1,2})-([0-9]{1,2})-([0-9]{2})"
_MDY = "^" + MDY_PATTERN + "$"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def format_mdy(col: Column | str) -> Column:
    """a date / timestamp as ``mm-dd-yy`` text."""
    return F.date_format(_c(col), MDY_FORMAT)


def today_mdy() -> Column:
    """today's date as ``mm-dd-yy``."""
    return format_mdy(F.current_date())


def parse_mdy(col: Column | str) -> Column:
    """``mm-dd-yy`` text -> date in the 2000s; NULL when not a valid date."""
    c = _c(col)
    m = F.regexp_extract(c, _MDY, 1)
    d = F.regexp_extract(c, _MDY, 2)
    y = F.regexp_extract(c, _MDY, 3)
    text = F.concat(F.lit(DATE_CENTURY_PREFIX), y, F.lit("-"), F.lpad(m, 2, "0"), F.lit("-"), F.lpad(d, 2, "0"))
    return F.when(c.rlike(_MDY), F.try_to_date(text, "yyyy-MM-dd"))


def is_valid_mdy(col: Column | str) -> Column:
    """true for a valid ``mm-dd-yy`` date, false otherwise (never NULL)."""
    return F.coalesce(parse_mdy(col).isNotNull(), F.lit(False))


def parse_timestamp(col: Column | str, fmt: str) -> Column:
    """text -> timestamp with a fixed pattern; malformed text gives NULL."""
    return F.try_to_timestamp(_c(col), F.lit(fmt))
