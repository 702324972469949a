"""Waveform maths: digital ranges of storage formats, gain and baseline, digitising."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bits per sample of each storage format.
FORMAT_BITS = {
    "80": 8,
    "508": 8,
    "310": 10,
    "311": 10,
    "212": 12,
    "16": 16,
    "61": 16,
    "160": 16,
    "516": 16,
    "24": 24,
    "524": 24,
    "32": 32,
    "8": 32,
}
# The format without a code for missing samples, and the ones tried for integers, in order.
NO_INVALID_FORMAT = "8"
INTEGER_FORMATS = ("80", "311", "212", "16", "24", "32")
DEFAULT_FORMAT = "16"
INT32_MAX = 2**31 - 1
INT32_MIN = -(2**31)


def digital_bounds(fmt: str) -> tuple[int, int]:
    """Smallest and largest digital value of a format."""
    half = 2 ** (FORMAT_BITS[fmt] - 1)
    return -half, half - 1


def invalid_sample(fmt: str) -> int | None:
    """The digital value that marks a missing sample: the lowest one."""
    return None if fmt == NO_INVALID_FORMAT else digital_bounds(fmt)[0]


def digital_range(fmt: Column) -> Column:
    """Format column to ``struct<digital_min, digital_max, invalid>``; NULL for unknown formats."""
    out = F.lit(None)
    for name in FORMAT_BITS:
        low, high = digital_bounds(name)
        row = F.struct(
            F.lit(low).cast("bigint").alias("digital_min"),
            F.lit(high).cast("bigint").alias("digital_max"),
            F.lit(invalid_sample(name)).cast("bigint").alias("invalid"),
        )
        out = F.when(fmt == name, row).otherwise(out)
    return out


def adc_gain_baseline(low: Column, high: Column, fmt: str = DEFAULT_FORMAT) -> Column:
    """Physical range of a channel to ``struct<adc_gain double, baseline bigint>``.

    digital = physical * gain + baseline. The lowest digital value is kept for missing samples. A flat
    channel uses one digital value. A baseline outside 32 bits is clamped and the gain recomputed.
    A channel without any number (NULL or NaN range) gets gain 1 and baseline 1.
    """
    dmin, dmax = digital_bounds(fmt)
    dmin += 1
    low, high = low.cast("double"), high.cast("double")
    one = F.lit(1.0)

    def pair(gain: Column, baseline: Column) -> Column:
        return F.struct(gain.alias("adc_gain"), baseline.cast("bigint").alias("baseline"))

    slope = F.try_divide(F.lit(float(dmax - dmin)), high - low)
    offset = F.lit(float(dmin)) - slope * low
    # Rounded away from the range so that the largest value cannot overshoot.
    rounded = F.when(low > 0, F.ceil(offset)).otherwise(F.floor(offset))
    refit = F.when(
        rounded != dmin, F.try_divide((F.lit(dmin) - rounded).cast("double"), low)
    ).otherwise(slope)
    varied = (
        F.when(
            rounded > INT32_MAX,
            pair(F.try_divide(F.lit(float(INT32_MAX - dmin)), F.abs(low)), F.lit(INT32_MAX)),
        )
        .when(
            rounded < INT32_MIN,
            pair(F.try_divide(F.lit(float(dmax - INT32_MIN)), high), F.lit(INT32_MIN)),
        )
        .otherwise(pair(refit, rounded))
    )
    empty = low.isNull() | high.isNull() | F.isnan(low) | F.isnan(high)
    return (
        F.when(empty | ((low == high) & (low == 0)), pair(one, F.lit(1)))
        .when(low == high, pair(F.abs(F.try_divide(one, low)), F.lit(0)))
        .otherwise(varied)
    )


def choose_format(low: Column, high: Column, integral: bool) -> Column:
    """Range of a channel to ``struct<fmt, storage>``.

    Whole numbers take the first format that holds them, with its lowest value left free; NULL when
    none does. Fractional numbers are stored through gain and baseline.
    """

    def pick(fmt: str, storage: str) -> Column:
        return F.struct(F.lit(fmt).alias("fmt"), F.lit(storage).alias("storage"))

    if not integral:
        return pick(DEFAULT_FORMAT, "physical")
    out = F.lit(None)
    for name in reversed(INTEGER_FORMATS):
        dmin, dmax = digital_bounds(name)
        out = F.when((low > dmin) & (high <= dmax), pick(name, "digital")).otherwise(out)
    return out


def digitize(values: Column, gain: Column, baseline: Column, fmt: str = DEFAULT_FORMAT) -> Column:
    """Physical samples to digital ones; missing samples take the format's invalid value."""
    missing = F.lit(invalid_sample(fmt)).cast("bigint")
    return F.transform(
        values,
        lambda v: F.when(v.isNull() | F.isnan(v), missing).otherwise(
            F.rint(v * gain + baseline).cast("bigint")
        ),
    )


def finite(values: Column) -> Column:
    """Samples that are numbers."""
    return F.filter(values, lambda v: v.isNotNull() & ~F.isnan(v))
