"""Waveform records: channel ranges, gain and baseline, and digitised record tables.

A record is one (key, start) of a bed. It is kept as two tables, a header row per record and channel and
the digital samples of each input row, so no task ever holds a whole record. Channels of several rates and rows with
holes between them are brought on one clock as frames, a block of frames at a time.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.functions import waveform

MILLIVOLT = "mV"


def channel_range(rows: DataFrame, keys: list[str], samples: str = "values_num") -> DataFrame:
    """Smallest and largest number, and the count of numbers, per key. Missing samples are ignored;
    a channel without any number has NULL bounds."""
    clean = waveform.finite(F.col(samples))
    return (
        rows.select(
            *keys,
            F.array_min(clean).cast("double").alias("_low"),
            F.array_max(clean).cast("double").alias("_high"),
            F.size(clean).cast("bigint").alias("_n"),
        )
        .groupBy(*keys)
        .agg(F.min("_low").alias("pmin"), F.max("_high").alias("pmax"), F.sum("_n").alias("n_samples"))
    )


def add_gain(ranges: DataFrame, fmt: str = waveform.DEFAULT_FORMAT) -> DataFrame:
    """Add ``adc_gain`` and ``baseline`` to a range table."""
    pair = waveform.adc_gain_baseline(F.col("pmin"), F.col("pmax"), fmt)
    return ranges.withColumn("_g", pair).select(
        *ranges.columns, F.col("_g.adc_gain").alias("adc_gain"), F.col("_g.baseline").alias("baseline")
    )


def add_format(ranges: DataFrame, integral: bool) -> DataFrame:
    """Add ``fmt`` and ``storage`` to a range table."""
    choice = waveform.choose_format(F.col("pmin"), F.col("pmax"), integral)
    return ranges.withColumn("_f", choice).select(
        *ranges.columns, F.col("_f.fmt").alias("fmt"), F.col("_f.storage").alias("storage")
    )


def record_name(prefix: Column, start_ns: Column) -> Column:
    """``prefix_epochseconds``."""
    seconds = F.call_function("div", start_ns, F.lit(10**9))
    return F.concat(prefix, F.lit("_"), seconds.cast("string"))


def record_headers(
    rows: DataFrame,
    record: list[str],
    channel: str = "channel",
    start: str = "start_t_ns",
    samples: str = "values_num",
    uom: str | None = "UoM",
    prefix: Column | None = None,
    fs: Column | float | None = None,
    samples_per_frame: int = 1,
    fmt: str = waveform.DEFAULT_FORMAT,
) -> DataFrame:
    """One row per record and channel: name, base time, rate, unit, format, gain and baseline.

    ``record`` lists the key columns of a record. Its base time is its earliest start. The rate comes
    from ``fs`` or from the sampling period ``pd_samp_ms``; a channel whose rows have several has no rate and
    says so in ``rate_error``. A channel without unit is in millivolt. The rows are read once.
    """
    clean = waveform.finite(F.col(samples))
    rate = fs if fs is not None else F.lit(1000.0) / F.nullif(F.col("pd_samp_ms"), F.lit(0.0))
    unit = F.nullif(F.col(uom), F.lit("")) if uom else F.lit(None).cast("string")
    channels = rows.select(
        *record, channel, F.col(start).alias("_start"),
        (rate if isinstance(rate, Column) else F.lit(rate)).alias("_fs"), unit.alias("_unit"),
        F.array_min(clean).cast("double").alias("_low"), F.array_max(clean).cast("double").alias("_high"),
        F.size(clean).cast("bigint").alias("_n"),
    ).groupBy(*record, channel).agg(
        F.min("_low").alias("pmin"), F.max("_high").alias("pmax"), F.sum("_n").alias("n_samples"),
        F.min("_start").alias("_start"), F.min("_fs").alias("_least"), F.max("_fs").alias("_most"), F.min("_unit").alias("_unit"),
    )
    mixed = F.col("_least") != F.col("_most")
    described = add_gain(channels, fmt).withColumns(
        {"fs": F.when(mixed, F.lit(None)).otherwise(F.col("_most")), "rate_error": F.when(mixed, F.lit("MIXED_RATE"))}
    )
    per_record = channels.groupBy(*record).agg(F.min("_start").alias("base_ns"), F.count(F.lit(1)).alias("n_sig"))
    both = described.join(per_record, record)
    head = prefix if prefix is not None else F.concat_ws("_", *record)
    return both.select(
        *record,
        channel,
        record_name(head, F.col("base_ns")).alias("record_name"),
        F.timestamp_micros(F.call_function("div", F.col("base_ns"), F.lit(1000))).alias("base_time"),
        "base_ns",
        "n_sig",
        "fs",
        "rate_error",
        F.coalesce("_unit", F.lit(MILLIVOLT)).alias("units"),
        F.lit(samples_per_frame).alias("samples_per_frame"),
        F.lit(fmt).alias("fmt"),
        "adc_gain",
        "baseline",
        "pmin",
        "pmax",
        "n_samples",
    )


def record_samples(
    rows: DataFrame,
    headers: DataFrame,
    record: list[str],
    channel: str = "channel",
    samples: str = "values_num",
    fmt: str = waveform.DEFAULT_FORMAT,
) -> DataFrame:
    """Digital samples of each row, with the gain and baseline of its record and channel.

    The headers are few next to the rows; Spark broadcasts them when they are small and otherwise splits
    busy channels of the join at run time.
    """
    scale = headers.select(*record, channel, "record_name", "adc_gain", "baseline")
    digital = waveform.digitize(F.col(samples), F.col("adc_gain"), F.col("baseline"), fmt)
    return (
        rows.join(scale, [*record, channel])
        .withColumn("digital", digital)
        .drop(samples, "adc_gain", "baseline")
    )


# Frames of a block: what one row of a frame table holds.
BLOCK_FRAMES = 1024


def _gcd(a: Column, b: Column) -> Column:
    """Greatest common divisor of two longs by Euclid's steps, of which numbers of 64 bits need at most 92."""
    start = F.struct(F.greatest(a, b).alias("a"), F.least(a, b).alias("b"))
    step = lambda s, _: F.when(s["b"] == 0, s).otherwise(F.struct(s["b"].alias("a"), F.try_mod(s["a"], s["b"]).alias("b")))
    return F.aggregate(F.sequence(F.lit(1), F.lit(92)), start, step)["a"]


def record_clocks(headers: DataFrame, record: list[str]) -> DataFrame:
    """The headers with ``frame_rate``, the largest rate of which all channels of the record have multiples, and their
    ``samples_per_frame`` at that rate. Rates count to a thousandth. A channel without a rate has NULL in both."""
    rate = F.round(F.col("fs") * 1000).cast("bigint")
    rated = headers.withColumn("_mhz", F.when(rate > 0, rate))
    zero = F.lit(0).cast("bigint")
    common = rated.groupBy(*record).agg(F.aggregate(F.collect_set("_mhz"), zero, _gcd).alias("_common"))
    both = rated.join(common.withColumn("_common", F.nullif("_common", zero)), record, "left")
    return both.withColumns({
        "samples_per_frame": F.call_function("div", F.col("_mhz"), F.col("_common")),
        "frame_rate": F.when(F.col("_mhz").isNotNull(), F.col("_common") / 1000),
    }).drop("_mhz", "_common")


def _laid_out(pieces: Column, length: Column, missing: Column) -> Column:
    """Pieces (at, _start, digital) put in their places; holes are filled, and of samples for one place the first stays."""

    def put(out: Column, p: Column) -> Column:
        filled = F.size(out)
        hole = F.array_repeat(missing, F.greatest(p["at"] - filled, F.lit(0)).cast("int"))
        more = F.slice(p["digital"], F.greatest(filled - p["at"], F.lit(0)).cast("int") + 1, F.size(p["digital"]))
        return F.when(p["at"] + F.size(p["digital"]) > filled, F.concat(out, hole, more)).otherwise(out)

    put_all = F.aggregate(F.array_sort(pieces), F.array().cast("array<bigint>"), put)
    return F.transform(F.array(put_all), lambda out: F.concat(out, F.array_repeat(missing, (length - F.size(out)).cast("int"))))[0]


def record_frames(
    rows: DataFrame,
    headers: DataFrame,
    record: list[str],
    channel: str = "channel",
    start: str = "start_t_ns",
    samples: str = "values_num",
    fmt: str = waveform.DEFAULT_FORMAT,
    block_frames: int = BLOCK_FRAMES,
) -> DataFrame:
    """Blocks of frames on the record's clock: one row per record, block and channel, with the digital samples in order.

    A frame is a step of ``frame_rate`` and holds ``samples_per_frame`` samples of each channel, by its rate. The first
    sample of a row takes the place nearest to its start; holes have the invalid value of the format, and where rows
    overlap the one that started first counts. A block has ``block_frames`` frames; blocks in which no channel has a
    sample are left out, and in the others all channels with a rate have all samples. Rows without a start, a sample or a
    rate of their channel give none.

    The work goes by (record, channel, block), so a long record is spread over all tasks.
    """
    clocks = record_clocks(headers, record).where(F.col("samples_per_frame").isNotNull())
    length = F.col("samples_per_frame") * block_frames
    keys = [*record, channel]
    digital = waveform.digitize(F.col(samples), F.col("adc_gain"), F.col("baseline"), fmt)
    placed = rows.select(*keys, F.col(start).alias("_start"), samples).where(F.col("_start").isNotNull() & (F.size(samples) > 0))
    placed = placed.join(clocks.select(*keys, "adc_gain", "baseline", "base_ns", "samples_per_frame", "frame_rate"), keys)
    clock = (F.col("_start") - F.col("base_ns")).cast("double") * F.col("samples_per_frame") * F.col("frame_rate") / 1e9
    placed = placed.select(*keys, "_start", length.alias("_length"), F.rint(clock).cast("bigint").alias("_at"), digital.alias("_digital"))
    last = F.col("_at") + F.size("_digital") - 1
    div = lambda a: F.call_function("div", a, F.col("_length"))
    cut = placed.withColumn("block", F.explode(F.sequence(div(F.col("_at")), div(last))))
    begin = F.col("block") * F.col("_length")
    skipped = F.greatest(begin - F.col("_at"), F.lit(0))
    piece = F.slice("_digital", (skipped + 1).cast("int"), F.least(F.col("_length"), F.size("_digital").cast("bigint")).cast("int"))
    at = F.greatest(F.col("_at") - begin, F.lit(0))
    piece = F.slice(piece, F.lit(1), (F.col("_length") - at).cast("int"))
    # Copies of a row fall together before anything is gathered.
    cut = cut.select(*keys, "block", at.alias("at"), "_start", piece.alias("digital")).distinct()
    pieces = cut.groupBy(*keys, "block").agg(F.collect_list(F.struct("at", "_start", "digital")).alias("_pieces"))
    blocks = pieces.select(*record, "block").distinct()
    every = blocks.join(clocks.select(*keys, "record_name", "frame_rate", "samples_per_frame"), record)
    missing = F.lit(waveform.invalid_sample(fmt)).cast("bigint")
    none = F.array().cast("array<struct<at:bigint,_start:bigint,digital:array<bigint>>>")
    out = every.join(pieces, [*keys, "block"], "left")
    return out.select(
        *keys, "record_name", "block", (F.col("block") * block_frames).alias("first_frame"), "frame_rate", "samples_per_frame",
        _laid_out(F.coalesce("_pieces", none), length, missing).alias("digital"),
    )
