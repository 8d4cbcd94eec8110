"""Reference-time helpers.  All timestamps are wall-clock TIMESTAMP_NTZ, so
no result depends on the session time zone."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from tillroll.config import AS_OF


def ts_lit(value: datetime | str | None = None) -> Column:
    """A TIMESTAMP_NTZ literal (constant-folded by Catalyst)."""
    value = AS_OF if value is None else value
    if isinstance(value, datetime):
        value = value.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.lit(value).cast("timestamp_ntz")


def date_lit(value: datetime | date | str | None = None) -> Column:
    value = AS_OF if value is None else value
    if isinstance(value, datetime):
        value = value.date()
    return F.lit(str(value)).cast("date")


def parse_ts(col: str | Column) -> Column:
    """String → TIMESTAMP_NTZ; malformed text gives NULL instead of an error."""
    c = F.col(col) if isinstance(col, str) else col
    return F.try_to_timestamp(c).cast("timestamp_ntz")


def days_since(col: str | Column, as_of: datetime | None = None) -> Column:
    """Whole calendar days between ``as_of``'s date and the column's date."""
    c = F.col(col) if isinstance(col, str) else col
    return F.datediff(date_lit(as_of), F.to_date(c))


def iso(col: str | Column) -> Column:
    """ISO-8601 text of a timestamp (``YYYY-MM-DDTHH:MM:SS``)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss")
