"""OBX value, name, unit and identifier expressions, and the HL7 type table."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from bedfeed.functions import hl7, times

# HL7 value type -> logical type. Every other value type is STR; a blank type means ST.
VALUE_TYPES = {
    "ST": "STR",
    "NM": "NUMERIC",
    "NA": "LIST_OF_NUMERIC",
    "NR": "LIST_OF_NUMERIC",
    "CWE": "STR_OR_LIST",
}

# Logical type of each readable field, by HL7 field number.
FIELD_TYPES = {
    "MSH.3": "STR",
    "MSH.7": "DATETIME",
    "MSH.9": "STR_OR_LIST",
    "MSH.10": "STR",
    "MSH.11": "STR",
    "MSH.21": "STR_OR_LIST",
    "PID.3": "STR_OR_LIST",
    "PID.5": "STR_OR_LIST",
    "PID.18": "STR_OR_LIST",
    "PV1.2": "STR",
    "PV1.3": "STR_OR_LIST",
    "PV1.19": "STR",
    "OBR.3": "LIST_OF_STR",
    "OBR.4": "STR_OR_LIST",
    "OBR.7": "DATETIME",
    "OBR.8": "DATETIME",
    "OBR.10": "STR_OR_LIST",
    "OBR.13": "STR",
    "OBR.21": "STR",
    "OBX.2": "STR",
    "OBX.3": "STR_OR_LIST",
    "OBX.4": "STR",
    "OBX.5": "ANY",
    "OBX.6": "LIST_OF_STR",
    "OBX.7": "STR",
    "OBX.14": "DATETIME",
    "OBX.21": "STR",
}

_SCALARS = {"INT": "bigint", "FLOAT": "double", "NUMERIC": "double"}
_LISTS = {"LIST_OF_INT": "bigint", "LIST_OF_FLOAT": "double", "LIST_OF_NUMERIC": "double"}
_LOGICAL = {
    *_SCALARS, *_LISTS, "LIST_OF_STR", "STR", "STR_OR_LIST", "ANY", "DATETIME",
}


def _check(logical: str) -> None:
    if logical not in _LOGICAL:
        raise ValueError(f"unknown logical type {logical!r}")


def field_or_default(segment_fields: Column, path: str, as_string: bool = True) -> Column:
    """Typed field of a segment by its HL7 number, such as ``OBR.7``; unknown paths are an error."""
    if path not in FIELD_TYPES:
        raise ValueError(f"no type known for field {path}")
    segment, number = path.split(".")
    index = int(number) - 1 if segment == "MSH" else int(number)
    return convert_field(hl7.field(segment_fields, index), FIELD_TYPES[path], as_string)


def convert_field(text: Column, logical: str, as_string: bool = True) -> Column:
    """Read raw field text as a logical type.

    ``as_string`` keeps texts: lists become arrays, times are repaired but not parsed.
    Otherwise numbers and times are cast; text that cannot be cast is NULL (see ``conversion_error``).
    Blank text is NULL for numbers and times, an empty array for lists and ``''`` for texts.
    """
    _check(logical)
    blank = text == ""
    if logical in ("STR", "STR_OR_LIST", "ANY"):
        return hl7.flat_text(text) if logical == "STR" else text
    if logical == "DATETIME":
        return times.fix_time(text) if as_string else times.parse_time(text)
    if logical in _SCALARS:
        return text if as_string else F.when(hl7.is_list(text), None).otherwise(
            text.try_cast(_SCALARS[logical])
        )
    empty = F.array().cast("array<string>")
    items = F.when(blank, empty).otherwise(hl7.top_level_list(text))
    if logical == "LIST_OF_STR" or as_string:
        return items
    return items.try_cast(f"array<{_LISTS[logical]}>")


def conversion_error(text: Column, logical: str) -> Column:
    """True where a non-blank text has no value of the logical type."""
    _check(logical)
    if logical in _SCALARS or logical == "DATETIME":
        return (text != "") & convert_field(text, logical, as_string=False).isNull()
    if logical in _LISTS:
        return F.exists(convert_field(text, logical, as_string=False), lambda v: v.isNull())
    return F.lit(False)


def convert_column(column: Column, logical: str) -> Column:
    """Cast a whole column of texts or numbers; lists and texts pass through."""
    _check(logical)
    if logical == "DATETIME":
        return times.parse_time(column)
    if logical in _SCALARS:
        return column.try_cast(_SCALARS[logical])
    return column


def is_integral(text: Column) -> Column:
    """True when a numeric text or list has no decimal point, so it reads as whole numbers."""
    return ~text.contains(".")


def values_text(value: Column) -> Column:
    """OBX.5 as a list of texts; a scalar is a list of one, a missing value an empty list."""
    return F.when(value.isNull(), F.array().cast("array<string>")).otherwise(
        hl7.top_level_list(value)
    )


def values_numeric(value: Column, value_type: Column) -> Column:
    """OBX.5 as doubles for the numeric value types, NULL otherwise.

    ``NM`` must be a single number. Elements that are not numbers are NULL.
    """
    listed = value_type.isin(*[k for k, v in VALUE_TYPES.items() if v == "LIST_OF_NUMERIC"])
    numbers = F.split(value, "\\^", -1).try_cast("array<double>")
    single = value_type.isin(*[k for k, v in VALUE_TYPES.items() if v == "NUMERIC"])
    return F.when(listed | (single & ~value.contains("^")), numbers)


def coerce_error(value: Column, value_type: Column) -> Column:
    """Message for a value that does not fit its type; NULL when it does or when it is blank."""
    numeric = value_type.isin(*[k for k, v in VALUE_TYPES.items() if "NUMERIC" in v])
    numbers = values_numeric(value, value_type)
    bad = numbers.isNull() | F.exists(numbers, lambda v: v.isNull())
    return F.when(
        numeric & (value != "") & bad,
        F.concat(F.lit("cannot read "), value, F.lit(" as "), value_type),
    )


def signal_name(parts: Column) -> Column:
    """Name of OBX.3 elements; NULL for other sizes than one to three.

    One element names itself. Two are code and name without a scheme. Three are code, name and
    scheme; a blank name is replaced by ``scheme:code``.
    """
    p1 = F.get(parts, F.lit(1))
    return (
        F.when(F.size(parts) == 3, F.when(p1 == "", _scheme_code(parts)).otherwise(p1))
        .when(F.size(parts) == 2, p1)
        .when(F.size(parts) == 1, F.get(parts, F.lit(0)))
    )


def signal_code(parts: Column) -> Column:
    """Code of OBX.3 elements with its scheme; NULL for other sizes than one to three."""
    return F.when(F.size(parts) == 3, _scheme_code(parts)).when(
        F.size(parts).isin(1, 2), F.concat(F.lit("NO_SCHEME:"), F.get(parts, F.lit(0)))
    )


def _scheme_code(parts: Column) -> Column:
    return F.concat(F.get(parts, F.lit(2)), F.lit(":"), F.get(parts, F.lit(0)))


def signal_identity(parts: Column) -> Column:
    """OBX.3 elements to ``struct<name, code>``; NULL for other sizes."""
    return F.when(
        F.size(parts).isin(1, 2, 3), F.struct(signal_name(parts).alias("name"), signal_code(parts).alias("code"))
    )


def uom_of(parts: Column) -> Column:
    """OBX.6 elements to a unit: the only element or the second of three; NULL for other sizes."""
    return F.when(F.size(parts) == 1, F.get(parts, F.lit(0))).when(
        F.size(parts) == 3, F.get(parts, F.lit(1))
    )


def signal_uom(text: Column) -> Column:
    """Unit of an OBX.6 text; blank text is a blank unit."""
    return F.when(text == "", F.lit("")).otherwise(uom_of(hl7.top_level_list(text)))


def channel_id(sub_id: Column, source: Column) -> Column:
    """``OBX.4:OBX.21``, blank parts kept."""
    return F.concat(hl7.flat_text(sub_id), F.lit(":"), hl7.flat_text(source))
