"""Ports, protocols, hours and capture dates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from flowmarts.functions.lookups import first_match
from flowmarts.schema import (
    DEFAULT_DATE,
    LOGIN_PORTS,
    PROTOCOL_NAMES,
    UDP_PORTS,
    WEEKDAY_DATES,
)

def infer_protocol(port: Column) -> Column:
    """17 (UDP) for name, address-assignment and time service ports, else 6 (TCP)."""
    return F.when(port.isin(*UDP_PORTS), 17).otherwise(6)


def protocol_name(protocol: Column) -> Column:
    """Name of a protocol number; an unlisted number is kept as text."""
    names = ((protocol == number, name) for number, name in PROTOCOL_NAMES.items())
    return first_match(names, protocol.cast("string"))


def is_login_port(port: Column) -> Column:
    return port.isin(*LOGIN_PORTS)


def date_of_file(file_name: Column) -> Column:
    """Capture date from the first weekday (Monday first) found in a file name."""
    lowered = F.lower(file_name)
    days = ((lowered.contains(weekday), date) for weekday, date in WEEKDAY_DATES.items())
    return first_match(days, DEFAULT_DATE).cast("date")


def parse_timestamp(text: Column) -> Column:
    """Wall-clock timestamp from ISO or month/day/year text, 24-hour or AM/PM.

    Junk becomes null.  No step passes through a zoned timestamp, so the session's time
    zone does not matter.
    """
    upper = F.upper(F.trim(text))
    ordered = F.regexp_replace(upper, r"^(\d{1,2})/(\d{1,2})/(\d{4})\b", "$3-$1-$2")
    clock = F.regexp_replace(ordered, r" ?[AP]M$", "").try_cast("timestamp_ntz")
    hours = (
        F.when(upper.endswith("PM") & (F.hour(clock) < 12), 12)
        .when(upper.endswith("AM") & (F.hour(clock) == 12), -12)
        .otherwise(0)
    )
    return clock + F.make_dt_interval(hours=hours)
