"""Sessions, years and UTC instants."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def session_ordinal(year: Column, week: Column) -> Column:
    """year*100 + week: a sortable number for a weekly session."""
    return year * F.lit(100) + week


def year_from_position(column_name: Column, base_year: Column | int, weeks_in_first_year: int = 52) -> Column:
    """Year of a week column from the number in its name (`column07` -> 7); dates are not trusted."""
    base = F.lit(base_year) if isinstance(base_year, int) else base_year
    position = F.substring(column_name, 7, 10).try_cast("int")
    return F.when(position <= weeks_in_first_year, base).otherwise(base + 1).cast("int")


def _iso(utc: Column) -> Column:
    """Text of a zone-less time. Formatting it would read it in the session's zone, where some times do not exist."""
    return F.concat(F.substring(F.replace(utc.cast("string"), F.lit(" "), F.lit("T")), 1, 19), F.lit(".000Z"))


def utc_iso(moment: Column) -> Column:
    """ISO-8601 text in UTC of an instant, whatever the session zone is."""
    since = F.make_dt_interval(secs=F.unix_seconds(moment.cast("timestamp")).cast("decimal(18,6)"))
    return _iso(F.lit("1970-01-01 00:00:00").cast("timestamp_ntz") + since)


def local_to_utc(civil: Column, zone: str) -> Column:
    """ISO-8601 UTC text of a civil (zone-less) time read in `zone`."""
    return _iso(F.convert_timezone(F.lit(zone), F.lit("UTC"), civil.cast("timestamp_ntz")))
