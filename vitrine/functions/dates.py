"""Zone-free date arithmetic: nothing here depends on spark.sql.session.timeZone."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions.fixed_values import INCOMPLETE_YEARS

NTZ = "timestamp_ntz"


def month_start(ts: Column) -> Column:
    """First midnight of the month. Goes through DATE, as date_trunc would attach a zone."""
    return F.trunc(ts.cast("date"), "month").cast(NTZ)


def month_label(month: Column) -> Column:
    return F.substring(month.cast("string"), 1, 7)


def calendar_days(start: Column, end: Column) -> Column:
    """Midnights passed between two timestamps, of any sign."""
    return F.datediff(end, start).cast("long")


def day(value: dt.date) -> Column:
    return F.lit(value.isoformat()).cast("date").cast(NTZ)


def closed_months(
    month: Column,
    as_of: dt.date | None = None,
    exclude_years: Iterable[int] = INCOMPLETE_YEARS,
) -> Column:
    """Months before the one of `as_of` (default today), without the excluded years.

    Written as ranges over the month itself, not over its text, so that the filter prunes the
    month partitions of a stored mart.
    """
    today = F.current_date() if as_of is None else F.lit(as_of.isoformat()).cast("date")
    keep = month < F.trunc(today, "month").cast(NTZ)
    for year in sorted(exclude_years):
        inside = (month >= day(dt.date(year, 1, 1))) & (month < day(dt.date(year + 1, 1, 1)))
        keep = keep & ~inside
    return keep
