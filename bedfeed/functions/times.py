"""HL7 times: text ``YYYYMMDDHHMMSS[.fraction][+-HHMM]`` to UTC instants with nanoseconds.

Times are carried as ``*_ns`` longs (Spark timestamps stop at microseconds) and turned into timestamps
at the end. Nothing here depends on the session time zone.

Differences from lenient C parsing: impossible dates are NULL; a fraction longer than nine digits is cut.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column
from pyspark.sql import functions as F

# The zone of texts without offset, and offsets known to come from skewed clocks.
DEFAULT_ZONE = "America/New_York"
SKEWED_TO_EDT = ("-0359", "-0401")
SKEWED_TO_EST = ("-0459", "-0501")

NS_MISSING = -(2**63)


def _head(text: Column) -> Column:
    return F.substring(text, F.lit(1), F.length(text) - 5)


def fix_time(text: Column) -> Column:
    """Repair the four skewed offsets at the end of a time text."""

    def ends(offsets: tuple[str, ...]) -> Column:
        return reduce(or_, [F.endswith(text, F.lit(offset)) for offset in offsets])

    return (
        F.when(ends(SKEWED_TO_EDT), F.concat(_head(text), F.lit("-0400")))
        .when(ends(SKEWED_TO_EST), F.concat(_head(text), F.lit("-0500")))
        .otherwise(text)
    )


def is_blank(text: Column) -> Column:
    return text.isNull() | (F.trim(text) == "")


def epoch_ns(text: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Nanoseconds since the epoch; NULL for blank or malformed text.

    Ambiguous local times take the earlier offset; times inside a spring gap move forward.
    """
    n = F.length(text)
    has_offset = (n >= 19) & F.substring(text, -5, 1).isin("+", "-")
    has_fraction = (n >= 15) & (F.substring(text, 15, 1) == ".")
    base = F.substring(text, 1, 14)
    instant = F.when(
        has_offset,
        F.try_to_timestamp(F.concat(base, F.right(text, F.lit(5))), F.lit("yyyyMMddHHmmssxx")),
    ).when(n >= 14, F.try_to_timestamp(F.concat(base, F.lit(zone)), F.lit("yyyyMMddHHmmssVV")))
    digits = F.substring(
        text, F.lit(16), F.least(F.when(has_offset, n - 20).otherwise(n - 15), F.lit(9))
    )
    fraction = F.when(has_fraction, F.rpad(digits, 9, "0").try_cast("bigint")).otherwise(
        F.lit(0).cast("bigint")
    )
    return F.try_add(F.try_multiply(F.unix_micros(instant), F.lit(1000)), fraction)


def parse_ns(text: Column, zone: str = DEFAULT_ZONE) -> Column:
    """``fix_time`` then ``epoch_ns``: the reading used for every time field."""
    return epoch_ns(fix_time(text), zone)


def ns_to_timestamp(ns: Column) -> Column:
    return F.timestamp_micros(F.call_function("div", ns - F.pmod(ns, F.lit(1000)), F.lit(1000)))


def parse_time(text: Column, zone: str = DEFAULT_ZONE) -> Column:
    return ns_to_timestamp(parse_ns(text, zone))


def time_repr(text: Column, mode: str = "timestamp", zone: str = DEFAULT_ZONE) -> Column:
    """A time field for output.

    ``timestamp``: NULL when blank. ``epoch``: nanoseconds, the smallest long when blank.
    ``text``: ISO-8601 in UTC, ``''`` when blank.
    """
    ns = F.when(is_blank(text), F.lit(None)).otherwise(parse_ns(text, zone))
    if mode == "timestamp":
        return ns_to_timestamp(ns)
    if mode == "epoch":
        return F.coalesce(ns, F.lit(NS_MISSING).cast("bigint"))
    if mode == "text":
        return F.coalesce(
            F.date_format(
                F.to_utc_timestamp(ns_to_timestamp(ns), F.current_timezone()),
                "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
            ),
            F.lit(""),
        )
    raise ValueError(f"unknown mode {mode!r}: use timestamp, epoch or text")


def duration_ns(first: Column, second: Column, zone: str = DEFAULT_ZONE) -> Column:
    """Nanoseconds from the first time text to the second."""
    return parse_ns(second, zone) - parse_ns(first, zone)


def compare_times(first: Column, second: Column, zone: str = DEFAULT_ZONE) -> Column:
    """1 when the first is earlier, 0 when equal, -1 when later."""
    return F.signum(duration_ns(first, second, zone)).cast("int")


def epoch_to_timestamp(value: Column, unit: str) -> Column:
    """Numeric epoch column to timestamp: ``s`` for float seconds, ``ns`` for integer nanoseconds."""
    if unit == "s":
        return F.timestamp_seconds(value)
    if unit == "ns":
        return ns_to_timestamp(value)
    raise ValueError(f"unknown unit {unit!r}: use s or ns")
