"""Date and time expressions with the conventions the jobs rely on."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tessera.functions.cleaning import ColumnOrName, _col

# Open end of a validity interval and the unknown-member key.
OPEN_END = "9999-12-31"
UNKNOWN_MEMBER_KEY = -1


def open_end() -> Column:
    return F.lit(OPEN_END).cast("date")


def date_key(c: ColumnOrName) -> Column:
    """yyyymmdd as INT."""
    return F.date_format(_col(c), "yyyyMMdd").cast("int")


def weekday_sunday0(c: ColumnOrName) -> Column:
    """Sunday = 0 ... Saturday = 6."""
    return F.dayofweek(_col(c)) - 1


def iso_weekday(c: ColumnOrName) -> Column:
    """Monday = 1 ... Sunday = 7."""
    return ((F.dayofweek(_col(c)) + 5) % 7) + 1


def wall_clock(c: ColumnOrName) -> Column:
    """The wall-clock reading of a timestamp (NTZ or session-zone) as a UTC instant.

    Differences of these values do not depend on the session time zone or
    its daylight-saving shifts.
    """
    return F.from_utc_timestamp(_col(c).cast("timestamp"), F.current_timezone())


def whole_minutes(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Truncated (toward zero) elapsed minutes between two wall-clock timestamps."""
    micros = F.unix_micros(wall_clock(end)) - F.unix_micros(wall_clock(start))
    return (micros / F.lit(60_000_000)).cast("long")


def whole_days(start: ColumnOrName, end: ColumnOrName) -> Column:
    return F.datediff(F.to_date(_col(end)), F.to_date(_col(start)))


def minutes_between(start: ColumnOrName, end: ColumnOrName, scale: int = 3) -> Column:
    """Fractional minutes rounded to ``scale`` decimals (silver duration)."""
    seconds = (F.unix_micros(wall_clock(end)) - F.unix_micros(wall_clock(start))) / 1e6
    return F.round(seconds / 60.0, scale)


def fiscal_parts(c: ColumnOrName, start_month: int = 11) -> dict[str, Column]:
    """Fiscal year/quarter/month for a year starting on ``start_month`` 1st.

    The fiscal year is named after the calendar year in which it ends.
    """
    shifted = F.add_months(F.to_date(_col(c)), 13 - start_month)
    return {
        "fiscal_year": F.year(shifted),
        "fiscal_quarter": F.quarter(shifted),
        "fiscal_month": F.month(shifted),
    }
