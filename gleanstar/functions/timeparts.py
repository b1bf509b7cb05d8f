"""Durations, periods and calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from gleanstar.functions.text import col


def elapsed(later: Column | str, earlier: Column | str, unit: str) -> Column:
    """Whole elapsed units between two instants, truncated toward zero."""
    return F.timestamp_diff(unit.upper(), col(earlier), col(later))


def calendar_days(later: Column | str, earlier: Column | str) -> Column:
    """Calendar days between the dates of two instants."""
    return F.date_diff(F.to_date(col(later)), F.to_date(col(earlier)))


def year_month(ts: Column | str) -> Column:
    return F.date_format(col(ts), "yyyy-MM")


def in_month(ts: Column | str, period: str) -> Column:
    """`ts` lies in month 'yyyy-MM', written as a range so that it prunes files."""
    start = F.to_timestamp(F.lit(f"{period}-01"))
    return (col(ts) >= start) & (col(ts) < F.add_months(F.to_date(F.lit(f"{period}-01")), 1).cast("timestamp"))


def calendar_columns(day: Column | str) -> dict[str, Column]:
    """The attributes of a calendar day (week by ISO, Sunday = 1)."""
    d = col(day)
    return {
        "date_key": F.date_format(d, "yyyyMMdd").cast("bigint"),
        "full_date": d,
        "year": F.year(d),
        "quarter": F.quarter(d),
        "month": F.month(d),
        "month_name": F.date_format(d, "MMMM"),
        "week_of_year": F.weekofyear(d),
        "day_of_month": F.dayofmonth(d),
        "day_of_week": F.dayofweek(d),
        "day_name": F.date_format(d, "EEEE"),
        "is_weekend": F.dayofweek(d).isin(1, 7),
    }
