"""One JSON array per message, without patient identity."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.functions import values
from bedfeed.functions.times import NS_MISSING
from bedfeed.operators.messages import valid
from bedfeed.operators.observations import (
    CHANNEL_TYPES,
    OTHER_TYPE,
    OTHER_WAVEFORM_TYPE,
    rows_in_message,
)


def _epoch(ns: Column) -> Column:
    return F.coalesce(ns, F.lit(NS_MISSING).cast("bigint"))


def _common() -> list[Column]:
    names = ("profile", "control_id", "deployment", "hospital", "bed_unit", "bed_id")
    kind = F.array_compact(
        F.array(F.col("hl7_type"), F.when(F.col("hl7_event") != "", F.col("hl7_event")))
    )
    return [
        _epoch(F.col("msh_time_ns")).alias("msh_time"),
        kind.alias("hl7_type"),
        *[F.col(c) for c in names],
    ]


def to_json_rows(messages: DataFrame, types: Mapping[str, str] = CHANNEL_TYPES) -> DataFrame:
    """Add ``json`` to valid located messages: the rows a message gives, as one JSON array.

    Patient id, visit and names are left out. Times are epoch nanoseconds, the smallest long when
    missing; a missing sampling period is null. A message without rows has ``''``.
    """
    good = valid(messages)
    type_of = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])
    waveform = F.col("msg_kind") == "Waveform"
    other = F.when(waveform, F.lit(OTHER_WAVEFORM_TYPE)).otherwise(F.lit(OTHER_TYPE))

    def rows_of(signal: Column) -> Column:
        def row(r: Column) -> Column:
            texts = values.values_text(r["value"])
            return F.struct(
                *_common(),
                signal["src"].alias("src"),
                signal["type"].alias("msg_type"),
                _epoch(signal["start_ns"]).alias("start_t"),
                _epoch(signal["end_ns"]).alias("end_t"),
                r["channel"].alias("channel"),
                r["channel_id"].alias("channel_id"),
                F.coalesce(F.try_element_at(type_of, r["channel"]), other).alias("channel_type"),
                _epoch(r["obx_start_t_ns"]).alias("obx_start_t"),
                texts.alias("values"),
                r["value_type"].alias("value_type"),
                r["UoM"].alias("UoM"),
                r["ref_range"].alias("ref_range"),
                r["pd_samp_ms"].alias("pd_samp_ms"),
                F.when(r["sampled"], F.size(texts)).otherwise(F.lit(1)).alias("nsamp"),
            )

        return F.transform(rows_in_message(signal, waveform), row)

    known = F.filter("signals", lambda s: s["known"])
    channel_rows = F.flatten(F.transform(known, rows_of))
    header = F.array(F.struct(*_common()))
    options = {"ignoreNullFields": "false"}
    text = F.when(F.col("msg_kind") == "ADT", F.to_json(header, options)).otherwise(
        F.when(F.size(channel_rows) > 0, F.to_json(channel_rows, options)).otherwise(F.lit(""))
    )
    keep = [c for c in ("dir", "file", "seg_id", "msg_idx") if c in good.columns]
    return good.select(*keep, "control_id", "msg_kind", text.alias("json"))
