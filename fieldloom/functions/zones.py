"""Local time by state. One zone per state: the one most of the state keeps."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: abbreviation, name, time zone ---

STATES = [
    ("AL", "ALABAMA", "US/Central"),
    ("AK", "ALASKA", "US/Alaska"),
    ("AZ", "ARIZONA", "US/Mountain"),
    ("AR", "ARKANSAS", "US/Central"),
    ("CA", "CALIFORNIA", "US/Pacific"),
    ("CO", "COLORADO", "US/Mountain"),
    ("CT", "CONNECTICUT", "US/Eastern"),
    ("DE", "DELAWARE", "US/Eastern"),
    ("FL", "FLORIDA", "US/Eastern"),
    ("GA", "GEORGIA", "US/Eastern"),
    ("HI", "HAWAII", "US/Hawaii"),
    ("ID", "IDAHO", "US/Mountain"),
    ("IL", "ILLINOIS", "US/Central"),
    ("IN", "INDIANA", "US/Eastern"),
    ("IA", "IOWA", "US/Central"),
    ("KS", "KANSAS", "US/Central"),
    ("KY", "KENTUCKY", "US/Eastern"),
    ("LA", "LOUISIANA", "US/Central"),
    ("ME", "MAINE", "US/Eastern"),
    ("MD", "MARYLAND", "US/Eastern"),
    ("MA", "MASSACHUSETTS", "US/Eastern"),
    ("MI", "MICHIGAN", "US/Eastern"),
    ("MN", "MINNESOTA", "US/Central"),
    ("MS", "MISSISSIPPI", "US/Central"),
    ("MO", "MISSOURI", "US/Central"),
    ("MT", "MONTANA", "US/Mountain"),
    ("NE", "NEBRASKA", "US/Central"),
    ("NV", "NEVADA", "US/Pacific"),
    ("NH", "NEW HAMPSHIRE", "US/Eastern"),
    ("NJ", "NEW JERSEY", "US/Eastern"),
    ("NM", "NEW MEXICO", "US/Mountain"),
    ("NY", "NEW YORK", "US/Eastern"),
    ("NC", "NORTH CAROLINA", "US/Eastern"),
    ("ND", "NORTH DAKOTA", "US/Central"),
    ("OH", "OHIO", "US/Eastern"),
    ("OK", "OKLAHOMA", "US/Central"),
    ("OR", "OREGON", "US/Pacific"),
    ("PA", "PENNSYLVANIA", "US/Eastern"),
    ("RI", "RHODE ISLAND", "US/Eastern"),
    ("SC", "SOUTH CAROLINA", "US/Eastern"),
    ("SD", "SOUTH DAKOTA", "US/Central"),
    ("TN", "TENNESSEE", "US/Eastern"),
    ("TX", "TEXAS", "US/Central"),
    ("UT", "UTAH", "US/Mountain"),
    ("VT", "VERMONT", "US/Eastern"),
    ("VA", "VIRGINIA", "US/Eastern"),
    ("WA", "WASHINGTON", "US/Pacific"),
    ("DC", "WASHINGTON DC", "US/Eastern"),
    ("WV", "WEST VIRGINIA", "US/Eastern"),
    ("WI", "WISCONSIN", "US/Central"),
    ("WY", "WYOMING", "US/Mountain"),
]

OTHER_SPELLINGS = {"D.C.": "DC"}

# --- end of fixed values ---


def zone_of(state: Column) -> Column:
    """Zone name of a state given as abbreviation or name, any case; else NULL.

    Six set-membership tests (one per zone) instead of a lookup join: the whole
    expression stays in generated code and moves no data.
    """
    spellings = defaultdict(list)
    zone_by_code = {}
    for code, name, zone in STATES:
        spellings[zone] += [code, name]
        zone_by_code[code] = zone
    for spelling, code in OTHER_SPELLINGS.items():
        spellings[zone_by_code[code]].append(spelling)
    name = F.upper(state)
    zones = F
    for zone, names in spellings.items():
        zones = zones.when(name.isin(names), F.lit(zone))
    return zones


def at_zone(ts: Column, zone: Column | str) -> Column:
    """UTC wall clock ``ts`` as wall clock in ``zone``, whatever the session zone."""
    zone = F.lit(zone) if isinstance(zone, str) else zone
    return F.convert_timezone(F.lit("UTC"), zone, ts.cast("timestamp_ntz"))


def local_time(state: Column, ts: Column) -> Column:
    """UTC ``ts`` in the local time of ``state``; NULL for an unknown state."""
    return at_zone(ts, zone_of(state))
