"""Field queries: pick ``SEG`` or ``SEG.n`` from messages.

Every line a message gives is built inside its row and exploded once, so a query over many segments
still reads and splits the text a single time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bedfeed.functions import hl7
from bedfeed.session import explode_rows, with_value

# Segments that occur once per message and whose columns are already parsed.
_SINGLE = {"MSH": "msh", "PID": "pid_fields", "PV1": "pv1_fields"}


def wanted_fields(names: list[str]) -> dict[str, list[int | None]]:
    """``["PID.3", "OBX"]`` to ``{"PID": [3], "OBX": [None]}``; None is the whole segment."""
    wanted: dict[str, list[int | None]] = {}
    for name in names:
        segment, _, number = name.partition(".")
        wanted.setdefault(segment.upper(), []).append(int(number) if number else None)
    return wanted


def _field_text(segment: str, fields: Column, number: int | None) -> Column:
    if number is None:
        return F.array_join(F.transform(fields, hl7.flat_text), "|")
    if segment == "MSH" and number == 1:
        return F.lit("|")
    return hl7.flat_text(hl7.field(fields, number - 1 if segment == "MSH" else number))


def _line(kind: str, entries: dict[str, Column]) -> Column:
    """One output line: its kind, its values in the order of their keys, and its text with the keys in order."""
    keys = sorted(entries)
    return with_value(F.array(*[entries[k] for k in keys]), lambda texts: F.struct(
        F.lit(kind).alias("kind"),
        texts.alias("texts"),
        F.concat_ws("\t", *[F.concat(F.lit(f"{k}:"), F.get(texts, F.lit(i))) for i, k in enumerate(keys)]).alias("line"),
    ))


def _values(wanted: dict[str, list[int | None]]) -> Column:
    """The values of a line by key. The keys are those of its kind."""
    out = F.lit(None).cast("map<string,string>")
    for segment, numbers in wanted.items():
        keys = [_key(segment, n) for n in numbers]
        if segment == "OBX":
            keys += [_key("OBR", n) for n in wanted.get("OBR", [])]
        entries = [x for i, k in enumerate(sorted(set(keys))) for x in (F.lit(k), F.get("l.texts", F.lit(i)))]
        out = F.when(F.col("l.kind") == segment, F.create_map(*entries)).otherwise(out)
    return out


def _key(segment: str, number: int | None) -> str:
    return f"{'_' if segment in ('OBR', 'OBX') else ''}{segment}.{number}"


def _group_lines(wanted: dict[str, list[int | None]]) -> Column | None:
    """Lines of the OBR groups: OBR, OBX, or each OBR followed by its OBX rows."""
    obr_wanted, obx_wanted = wanted.get("OBR"), wanted.get("OBX")
    if obr_wanted is None and obx_wanted is None:
        return None

    def entries(segment: str, fields: Column, numbers: list[int | None]) -> dict[str, Column]:
        return {_key(segment, n): _field_text(segment, fields, n) for n in numbers}

    def lines(group: Column) -> Column:
        if obr_wanted is None:
            return group_lines(group, {})
        # The OBR is read once for all lines of its group.
        read = entries("OBR", group["obr"], obr_wanted)
        return with_value(F.array(*read.values()), lambda texts: group_lines(
            group, {key: F.get(texts, F.lit(i)) for i, key in enumerate(read)}
        ))

    def group_lines(group: Column, of_obr: dict[str, Column]) -> Column:
        parts = []
        if obr_wanted is not None:
            parts.append(F.array(_line("OBR", of_obr)))
        if obx_wanted is not None:
            parts.append(
                F.transform(
                    group["obx"],
                    lambda f: _line("OBX", {**of_obr, **entries("OBX", f, obx_wanted)}),
                )
            )
        return F.concat(*parts)

    return F.flatten(F.transform("obrs", lines))


def _segment_line(segment: str, numbers: list[int | None]) -> Callable[[Column], Column]:
    return lambda fields: _line(
        segment, {_key(segment, n): _field_text(segment, fields, n) for n in numbers}
    )


def _segments_named(name: str) -> Column:
    return F.transform(F.filter("segments", lambda s: hl7.label(s) == name), hl7.fields)


def extract_fields(messages: DataFrame, names: list[str], only_usable: bool = False) -> DataFrame:
    """Lines with the wanted fields, in message order.

    Columns: the file columns, ``line_idx``, ``kind``, ``values`` (map) and ``line``, the tab-joined
    ``key:value`` text. Messages must have the required segments; ``only_usable`` also leaves out
    messages of unknown kind. A segment that occurs several times gives one line each.
    """
    wanted = wanted_fields(names)
    structure = ("NOT_MSH_FIRST", "MISSING_SEGMENT", "OBX_WITHOUT_OBR")
    usable = (
        F.col("error_code").isNull()
        if only_usable
        else F.col("error_code").isNull() | ~F.col("error_code").isin(*structure)
    )
    arrays = [g for g in [_group_lines(wanted)] if g is not None]
    for segment, numbers in wanted.items():
        if segment in ("OBR", "OBX"):
            continue

        if segment in _SINGLE:
            arrays.append(F.array(_segment_line(segment, numbers)(F.col(_SINGLE[segment]))))
        else:
            arrays.append(
                F.transform(_segments_named(segment), _segment_line(segment, numbers))
            )
    keep = [c for c in ("dir", "file", "seg_id", "msg_idx") if c in messages.columns]
    return (
        explode_rows(messages.where(usable), keep, F.concat(*arrays), "l", "line_idx")
        .select(*keep, "line_idx", "l.kind", _values(wanted).alias("values"), "l.line")
    )


def extract_wide(messages: DataFrame, names: list[str], only_usable: bool = False) -> DataFrame:
    """The same lines with one column per field; fields a line does not have are NULL."""
    wanted = wanted_fields(names)
    keys = sorted(_key(s, n) for s, numbers in wanted.items() for n in numbers)
    lines = extract_fields(messages, names, only_usable)
    return lines.select(
        *[c for c in lines.columns if c not in ("values", "line")],
        *[F.try_element_at("values", F.lit(k)).alias(k) for k in dict.fromkeys(keys)],
    )
