"""Date expressions on zone-less UTC timestamps."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from fieldloom.functions.zones import at_zone

# fixed values
REPORT_ZONES = {"utc": "UTC", "est": "US/Eastern", "cst": "US/Central", "pst": "US/Pacific"}


def date_formats(ts: Column) -> Column:
    """The four usual renderings of a timestamp and the timestamp itself.

    Cut from the timestamp's own text: ``date_format`` would take a zone-less
    value through the session zone and move it across daylight-saving gaps.
    """
    stamp = F.left(ts.cast("timestamp_ntz").cast("string"), F.lit(19))
    plain = F.translate(stamp, "-:", "")
    return F.struct(
        F.left(stamp, F.lit(10)).alias("yyyy_mm_dd"),
        stamp.alias("yyyy_mm_dd_hh_mm_ss"),
        F.left(plain, F.lit(8)).alias("yyyymmdd"),
        F.translate(plain, " ", "_").alias("yyyymmdd_hhmmss"),
        ts.alias("raw"),
    )


def datetime_in(ts: Column, name: str) -> Column:
    """``ts`` in one of the four report zones, by its short name."""
    return at_zone(ts, REPORT_ZONES[name])


def date_in(ts: Column, name: str) -> Column:
    return datetime_in(ts, name).cast("date")


def hhmm_between(ts: Column, start: int, end: int) -> Column:
    """Is the time of day, as HHMM less 400, within ``start`` and ``end``?

    A fixed four-hour shift without a daylight rule; before 04:00 UTC the value is
    negative and so outside every window. ``local_hhmm_between`` is the exact test.
    """
    return (F.hour(ts) * 100 + F.minute(ts) - 400).between(start, end)


def local_hhmm_between(ts: Column, start: int, end: int, zone: str = "US/Eastern") -> Column:
    local = at_zone(ts, zone)
    return (F.hour(local) * 100 + F.minute(local)).between(start, end)
