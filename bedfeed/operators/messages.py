"""Messages: HL7 text rows to typed message rows.

One row stays one message. Segments, OBR groups and OBX attributes are nested arrays handled by
higher-order functions, so nothing here moves rows between executors.

A message that cannot be used gets ``error_code`` and ``error_msg`` and is split off by ``quarantine``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.functions import hl7, times, values
from bedfeed.session import compute_once, explode_rows, with_value

# Segments every message needs, and OBR.4 codes and names of the known message kinds.
REQUIRED_SEGMENTS = ("MSH", "PID", "PV1")
MESSAGE_KINDS = {"182777000": "Vitals", "196616": "Alarm", "69121": "Waveform"}
WAVEFORM_SIGNAL = "MDC_OBS_WAVE_CTS"
EVENT_SIGNALS = ("monitoring of patient", "MDC_EVT_ALARM")
PERSON = ("pid", "visit_id", "first_name", "last_name", "middle_initial")
HEADER = (
    "msh_time_text", "msh_time_ns", "send_app", "control_id", "deployment", "hl7_type", "hl7_event",
    "profile", "patient_class", "location_text", "msg_kind",
)
SIGNAL_NAMES = (WAVEFORM_SIGNAL, *EVENT_SIGNALS)


def _is_blank_line(line: Column) -> Column:
    """Whitespace only. Lines that start with neither a space nor a control character are settled by that; the pattern is
    tried only on those that start with a control character behind spaces."""
    rest = F.ltrim(line)
    return (F.ascii(line) <= 32) & ((rest == "") | ((F.ascii(rest) < 32) & ~rest.rlike("\\S")))


def segment_texts(message: Column) -> Column:
    """Segments of a message in order; blank lines are dropped."""
    lines = F.split(F.replace(message, F.lit("\r"), F.lit("\n")), "\n", -1)
    return F.filter(lines, lambda s: ~_is_blank_line(s))


def segment_labels(segments: Column) -> Column:
    return F.transform(segments, hl7.label)


def segment_names(labels: Column) -> Column:
    return F.array_distinct(F.transform(labels, F.upper))


def _last(segments: Column, labels: Column, name: str) -> Column:
    """Fields of the last segment with a name; NULL when there is none."""
    from_end = F.array_position(F.reverse(labels), name)
    place = F.when(from_end > 0, F.size(labels) - from_end)
    return hl7.fields(F.get(segments, place.cast("int")))


def segment_table(messages: DataFrame, message: str = "message", honor_msh_separators: bool = False) -> DataFrame:
    """One row per segment: ``seg_idx``, ``name`` and ``fields`` besides the message columns.

    With ``honor_msh_separators`` each message is split by the separators that its own MSH segment names.
    """
    keep = [c for c in messages.columns if c != message]
    text = F.col(message)
    if honor_msh_separators:
        text = hl7.with_default_separators(F.ltrim(text))
    rows = explode_rows(messages, keep, segment_texts(text), "segment", "seg_idx")
    return rows.select(
        *[c for c in rows.columns if c != "segment"],
        hl7.label(F.col("segment")).alias("name"),
        hl7.fields(F.col("segment")).alias("fields"),
    )


def value_table(segments: DataFrame, level: int = 5, honor_msh_separators: bool = False) -> DataFrame:
    """Long table of leaf values: one row per field, repetition, component and subcomponent.

    ``level`` stops the splitting: 2 fields, 3 repetitions, 4 components, 5 subcomponents. ``honor_msh_separators`` is as
    it was for the segments.
    """
    keep = [c for c in segments.columns if c != "fields"]
    out = explode_rows(segments, keep, F.col("fields"), "value", "field")
    steps = ((3, "rep", "~"), (4, "comp", "\\^"), (5, "sub", "&"))
    for depth, name, separator in steps:
        if level < depth:
            break
        parts = F.when(F.col("value") == hl7.ENCODING_CHARS, F.array("value")).otherwise(
            F.split("value", separator, -1)
        )
        out = explode_rows(out, [c for c in out.columns if c != "value"], parts, "value", name)
    return out.withColumn("value", hl7.held_values(F.col("value"))) if honor_msh_separators else out


def message_level(segments: DataFrame, keys: list[str]) -> DataFrame:
    """Segment name counts per message, from the segment table."""
    return segments.groupBy(*keys, "name").agg(F.count(F.lit(1)).alias("n"))


def _obr_places(labels: Column) -> Column:
    return F.array_compact(F.transform(labels, lambda s, i: F.when(s == "OBR", i)))


def _obr_groups(segments: Column, starts: Column) -> Column:
    """``array<struct<obr: fields, obx: array<fields>>>``: each OBX belongs to the OBR before it."""

    def group(start: Column, k: Column) -> Column:
        end = F.coalesce(F.get(starts, k + 1), F.size(segments))
        body = F.slice(segments, start + 2, end - start - 1)
        obx = F.filter(body, lambda s: hl7.is_named(s, "OBX"))
        return F.struct(
            hl7.fields(F.get(segments, start)).alias("obr"),
            F.transform(obx, hl7.fields).alias("obx"),
        )

    return F.transform(starts, group)


def _orphan_obx(labels: Column) -> Column:
    """True when an OBX comes before any OBR."""
    first_obx, first_obr = F.array_position(labels, "OBX"), F.array_position(labels, "OBR")
    return (first_obx > 0) & ((first_obr == 0) | (first_obx < first_obr))


def _bound(array: Column, *steps) -> Column:
    """Apply steps to each element in turn, so that a later step reads earlier results by name."""
    for step in steps:
        array = F.transform(array, step)
    return array


def _kept(row: Column, *names: str) -> list[Column]:
    return [row[n].alias(n) for n in names]


def _attributes(obx: Column, start_raw: Column, start_text: Column, start_ns: Column, for_rows: bool) -> Column:
    """OBX field arrays to attributes. A name or unit with a bad form is NULL. What only rows show is left out unless
    it is ``for_rows``. Most times are those of the OBR, of which the repaired and the parsed form are known."""
    shown = ("channel_id", "ref_range") if for_rows else ()

    def texts(fields: Column) -> Column:
        of_rows = [hl7.field(fields, n).alias(f"t{n}") for n in ((4, 7, 21) if for_rows else ())]
        return F.struct(
            hl7.field(fields, 2).alias("t2"),
            hl7.field(fields, 3).alias("t3"),
            F.get(fields, F.lit(5)).alias("value"),
            hl7.field(fields, 6).alias("t6"),
            hl7.field(fields, 14).alias("t14"),
            *of_rows,
        )

    def lists(r: Column) -> Column:
        of_rows = [
            hl7.flat_text(r["t7"]).alias("ref_range"),
            values.channel_id(r["t4"], r["t21"]).alias("channel_id"),
        ]
        return F.struct(
            *_kept(r, "value"),
            F.when(r["t14"] == start_raw, start_text).otherwise(times.fix_time(r["t14"])).alias("obx_time"),
            F.when(hl7.is_list(r["t3"]), hl7.top_level_list(r["t3"])).alias("name_parts"),
            F.when(r["t6"] == "", F.array(F.lit(""))).otherwise(hl7.top_level_list(r["t6"])).alias("uom_parts"),
            hl7.flat_text(r["t2"]).alias("value_type"),
            *(of_rows if for_rows else []),
        )

    def named(r: Column) -> Column:
        return F.struct(
            values.signal_name(r["name_parts"]).alias("name"),
            *([values.signal_code(r["name_parts"]).alias("code")] if for_rows else []),
            *_kept(r, *shown[:1], "value_type", "obx_time"),
            F.when(r["obx_time"] == start_text, start_ns)
            .otherwise(times.epoch_ns(r["obx_time"]))
            .alias("obx_ns"),
            values.uom_of(r["uom_parts"]).alias("uom"),
            *_kept(r, "value", *shown[1:]),
        )

    return _bound(obx, texts, lists, named)


def keep_last_by_name(attributes: Column) -> Column:
    """Attributes keyed by name: the last duplicate wins, in the place of the first."""
    names = F.transform(attributes, lambda a: a["name"])
    distinct = F.array_distinct(names)
    merged = F.transform(
        distinct,
        lambda n: F.try_element_at(F.filter(attributes, lambda a: a["name"].eqNullSafe(n)), F.lit(-1)),
    )
    return F.when(F.size(distinct) == F.size(attributes), attributes).otherwise(merged)


def _signals(obrs: Column, for_rows: bool) -> Column:
    """OBR groups to signals. OBRs of unknown type keep ``known = false`` and no attributes."""

    def texts(group: Column) -> Column:
        obr = group["obr"]
        return F.struct(
            hl7.components(hl7.field(obr, 4)).alias("types"),
            hl7.field(obr, 7).alias("start_raw"),
            with_value(hl7.field(obr, 7), times.fix_time).alias("start_text"),
            with_value(hl7.field(obr, 8), times.fix_time).alias("end_text"),
            hl7.field(obr, 10).alias("bed"),
            hl7.field(obr, 13).alias("t13"),
            hl7.field(obr, 21).alias("t21"),
            group["obx"].alias("obx"),
        )

    def head(r: Column) -> Column:
        kind = F.coalesce(F.get(r["types"], F.lit(1)), F.lit(""))
        known = kind.isin(*SIGNAL_NAMES)
        return F.struct(
            kind.alias("type"),
            *_kept(r, "start_raw", "start_text", "end_text"),
            times.epoch_ns(r["start_text"]).alias("start_ns"),
            times.epoch_ns(r["end_text"]).alias("end_ns"),
            r["bed"].alias("bed"),
            hl7.flat_text(r["t13"]).alias("env"),
            hl7.flat_text(r["t21"]).alias("src"),
            known.alias("known"),
            F.when(known, r["obx"]).otherwise(F.slice(r["obx"], 1, 0)).alias("obx"),
        )

    kept = ("type", "start_text", "end_text", "start_ns", "end_ns", "bed", "env", "src", "known")

    def attach(r: Column) -> Column:
        attributes = _attributes(r["obx"], r["start_raw"], r["start_text"], r["start_ns"], for_rows)
        return F.struct(*_kept(r, *kept), attributes.alias("attributes"))

    def check(r: Column) -> Column:
        bad_attribute_time = F.exists(
            r["attributes"], lambda a: _bad_time(a["obx_time"], a["obx_ns"])
        )
        return F.struct(
            *_kept(r, *kept),
            F.exists(r["attributes"], lambda a: a["name"].isNull()).alias("bad_names"),
            F.exists(r["attributes"], lambda a: a["uom"].isNull()).alias("bad_units"),
            (
                _bad_time(r["start_text"], r["start_ns"])
                | _bad_time(r["end_text"], r["end_ns"])
                | bad_attribute_time
            ).alias("bad_times"),
            keep_last_by_name(r["attributes"]).alias("attributes"),
        )

    return _bound(obrs, texts, head, attach, check)


def _message_kind(kinds: Column, has_parts: Column, obr_codes: Column) -> Column:
    kind = F.get(kinds, F.lit(0))
    # A code without a name cannot be matched to a signal type.
    code = F.when(F.size(obr_codes) > 1, F.get(obr_codes, F.lit(0)))
    out = F.when(has_parts & (kind == "ADT"), F.lit("ADT"))
    for known, name in MESSAGE_KINDS.items():
        out = out.when(has_parts & (kind == "ORU") & (code == known), F.lit(name))
    return out


def _patient(mrn: Column, mrn_text: Column, name: Column, name_text: Column, visit: Column,
             other_visit: Column) -> Column:
    """Identity from PID and PV1 texts and components, with the sizes each field may have."""
    first = F.lit(0)
    bad_mrn = hl7.is_list(mrn_text) & ~F.size(mrn).isin(1, 5)
    bad_name = hl7.is_list(name_text) & ~F.size(name).isin(1, 2, 7)
    pid_visit = F.when(F.size(visit).isin(1, 5), F.get(visit, first)).otherwise(F.lit(""))
    return F.struct(
        F.when(mrn_text == "I", F.lit("")).otherwise(F.get(mrn, first)).alias("pid"),
        F.when(pid_visit != "", pid_visit).otherwise(hl7.flat_text(other_visit)).alias("visit_id"),
        F.when(F.size(name) >= 2, F.get(name, F.lit(1))).otherwise(F.lit("")).alias("first_name"),
        F.get(name, first).alias("last_name"),
        F.lit("").alias("middle_initial"),
        bad_mrn.alias("bad_mrn"),
        bad_name.alias("bad_name"),
    )


_ERRORS = {
    "NOT_MSH_FIRST": "first segment is not MSH",
    "MISSING_SEGMENT": "a required segment is missing",
    "OBX_WITHOUT_OBR": "an OBX comes before any OBR",
    "NO_OBR": "an observation message has no OBR",
    "UNKNOWN_MESSAGE_TYPE": "MSH.9 is neither ORU nor ADT",
    "UNKNOWN_OBR_TYPE": "OBR.4 of the first OBR is not a known code",
    "BAD_PATIENT_ID": "PID.3 should be text or have 1 or 5 components",
    "BAD_PATIENT_NAME": "PID.5 should be text or have 1, 2 or 7 components",
    "BAD_SIGNAL_NAME": "OBX.3 should have 2 or 3 components",
    "BAD_UNIT": "OBX.6 should be blank, text or have 3 components",
    "BAD_TIME": "a time field is malformed",
}


DEPTHS = ("fields", "header", "checks", "signals")


def parse_messages(df: DataFrame, message: str = "message", depth: str = "signals") -> DataFrame:
    """Typed message rows: header, patient identity, raw PV1.3, signals, and the first error found.

    Columns besides those of ``df`` (without the text): ``segments, seg_names, missing_segments, msh,
    pid_fields, pv1_fields, obrs, msg_kind, signals`` and the header and patient columns.

    ``depth`` says how far messages are read, and so which errors can be found: ``fields`` stops at segments
    and groups (no header and no signal columns), ``header`` leaves out the signals. ``checks`` finds all errors, but
    attributes have no ``code``, ``channel_id`` and ``ref_range``, which quality rules, delays and sightings do not read.
    """
    if depth not in DEPTHS:
        raise ValueError(f"unknown depth {depth!r}: use one of {DEPTHS}")
    text = F.ltrim(F.col(message), F.lit("\r\n"))
    keep = [c for c in df.columns if c != message]
    split = df.select(
        *keep,
        F.startswith(text, F.lit("MSH")).alias("starts_msh"),
        segment_texts(text).alias("segments"),
    )
    segments, labels = F.col("segments"), F.col("_labels")
    labelled = split.withColumn("_labels", segment_labels(segments))
    placed = labelled.withColumn("_starts", _obr_places(labels))
    parts = placed.select(
        *split.columns,
        segment_names(labels).alias("seg_names"),
        _last(segments, labels, "MSH").alias("msh"),
        _last(segments, labels, "PID").alias("pid_fields"),
        _last(segments, labels, "PV1").alias("pv1_fields"),
        _obr_groups(segments, F.col("_starts")).alias("obrs"),
        _orphan_obx(labels).alias("orphan_obx"),
    )
    msh, pid, pv1 = F.col("msh"), F.col("pid_fields"), F.col("pv1_fields")
    required = F.array(*[F.lit(s) for s in REQUIRED_SEGMENTS])
    parts = parts.select("*", F.array_except(required, F.col("seg_names")).alias("missing_segments"))
    structure = {
        "NOT_MSH_FIRST": ~F.col("starts_msh"),
        "MISSING_SEGMENT": F.size("missing_segments") > 0,
        "OBX_WITHOUT_OBR": F.col("orphan_obx"),
    }
    if depth == "fields":
        kept = [c for c in parts.columns if c not in ("starts_msh", "orphan_obx")]
        coded = parts.select(*kept, _first_error(structure).alias("error_code"))
        return _with_message(compute_once(coded, {"obrs": F.col("obrs"), "error_code": F.col("error_code")}))
    deep = depth in ("checks", "signals")
    signals = [_signals(F.col("obrs"), depth == "signals").alias("signals")] if deep else []
    texts = parts.select(
        "*",
        hl7.field(msh, 2).alias("_msh3"),
        times.fix_time(hl7.field(msh, 6)).alias("msh_time_text"),
        hl7.field(msh, 8).alias("_msh9"),
        hl7.field(msh, 9).alias("_msh10"),
        hl7.field(msh, 10).alias("_msh11"),
        hl7.components(hl7.field(msh, 20)).alias("_msh21"),
        hl7.field(pid, 3).alias("_pid3"),
        hl7.field(pid, 5).alias("_pid5"),
        hl7.components(hl7.field(pid, 18)).alias("_pid18"),
        hl7.field(pv1, 2).alias("_pv12"),
        hl7.field(pv1, 3).alias("location_text"),
        hl7.field(pv1, 19).alias("_pv119"),
        hl7.components(hl7.field(F.get("obrs", F.lit(0))["obr"], 4)).alias("_obr4"),
        *signals,
    )
    listed = texts.select(
        "*",
        hl7.components(F.col("_msh9")).alias("_kinds"),
        hl7.is_list(F.col("_msh9")).alias("_has_kind"),
        hl7.components(F.col("_pid3")).alias("_mrn"),
        hl7.components(F.col("_pid5")).alias("_name"),
        times.epoch_ns(F.col("msh_time_text")).alias("msh_time_ns"),
    )
    typed = listed.select(
        *[c for c in listed.columns if not c.startswith("_")],
        hl7.flat_text(F.col("_msh3")).alias("send_app"),
        hl7.flat_text(F.col("_msh10")).alias("control_id"),
        hl7.flat_text(F.col("_msh11")).alias("deployment"),
        F.get("_kinds", F.lit(0)).alias("hl7_type"),
        F.coalesce(F.get("_kinds", F.lit(1)), F.lit("")).alias("hl7_event"),
        F.get("_msh21", F.lit(0)).alias("profile"),
        hl7.flat_text(F.col("_pv12")).alias("patient_class"),
        (F.col("_has_kind") & (F.get("_kinds", F.lit(0)) == "ORU")).alias("_oru"),
        _message_kind(F.col("_kinds"), F.col("_has_kind"), F.col("_obr4")).alias("msg_kind"),
        _patient(*[F.col(c) for c in ("_mrn", "_pid3", "_name", "_pid5", "_pid18", "_pv119")]).alias("patient"),
    )
    oru = F.col("_oru")
    checks = structure | {
        "NO_OBR": oru & (F.size("obrs") == 0),
        "UNKNOWN_OBR_TYPE": oru & F.col("msg_kind").isNull(),
        "UNKNOWN_MESSAGE_TYPE": F.col("msg_kind").isNull(),
        "BAD_PATIENT_ID": F.col("patient.bad_mrn"),
        "BAD_PATIENT_NAME": F.col("patient.bad_name"),
    }
    bad_time = _bad_time(F.col("msh_time_text"), F.col("msh_time_ns"))
    if deep:
        checks["BAD_SIGNAL_NAME"] = F.exists("signals", lambda s: s["bad_names"])
        checks["BAD_UNIT"] = F.exists("signals", lambda s: s["bad_units"])
        bad_time = bad_time | F.exists("signals", lambda s: s["bad_times"])
    checks["BAD_TIME"] = bad_time
    drop = ("patient", "starts_msh", "orphan_obx", "_oru")
    once = (*HEADER, *PERSON, *(["signals"] if signals else []), "error_code")
    return _with_message(
        compute_once(
            typed.select(
                *[c for c in typed.columns if c not in drop],
                *[F.col(f"patient.{c}").alias(c) for c in PERSON],
                _first_error(checks).alias("error_code"),
            ),
            {c: F.col(c) for c in once},
        )
    )


def _first_error(checks: dict[str, Column]) -> Column:
    code = F.lit(None).cast("string")
    for name, condition in reversed(checks.items()):
        code = F.when(condition, F.lit(name)).otherwise(code)
    return code


def _with_message(coded: DataFrame) -> DataFrame:
    text_of = F.create_map(*[F.lit(x) for kv in _ERRORS.items() for x in kv])
    return coded.withColumn(
        "error_msg",
        F.when(
            F.col("error_code") == "MISSING_SEGMENT",
            F.concat(F.lit("missing "), F.array_join("missing_segments", ",")),
        ).otherwise(F.try_element_at(text_of, F.col("error_code"))),
    )


def _bad_time(text: Column, ns: Column) -> Column:
    return ns.isNull() & ~times.is_blank(text)


def valid(messages: DataFrame) -> DataFrame:
    """Messages without an error."""
    return messages.where(F.col("error_code").isNull())


def quarantine(messages: DataFrame) -> DataFrame:
    """Messages that were set aside, with the reason."""
    return messages.where(F.col("error_code").isNotNull())


def header(messages: DataFrame) -> DataFrame:
    """One row of header columns per message."""
    keep = [c for c in ("dir", "file", "seg_id", "msg_idx") if c in messages.columns]
    return messages.select(*keep, *HEADER)
