"""Bed location rules: PV1.3 text to a hospital, unit and bed candidate, and the bed wildcard form.

The candidate still needs the site tables (see ``operators.location``). Each rule gives a struct:
``hospital, unit, bed``; ``lookup_bed``, set when the unit must first be looked up from the bed, with
``unit`` as the fallback; ``prefix_bed``, true when the bed takes its hospital's recovery-room prefix;
and ``error``, set when the text fits no known shape.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Markers inside location texts and the units they stand for.
DEPARTMENT_MARK = "DEPID"
DEPARTMENT_PREFIX = "100"
HOSPITAL_SUFFIX = "Hospital"
CART_MARK = "CART"
TOWER_MARK = "4TN"
TEST_BED = "WH-TEST"
RECOVERY_UNIT = "PACU"
EMERGENCY_UNIT = "ED"
SHARED_DEPARTMENT = "10007004"
SHARED_PODS_PREFIX = "cv"
SHARED_PODS_UNIT = "CVPODS"
SHARED_ICU_UNIT = "CVICU"
PICU_PREFIX = "PICU L"
PICU_UNIT = "PICU"
PICU_BED = "MHPICUL"
ICU41_PREFIXES = ("4107", "4108")
ICU41_UNIT = "41ICU"
NURSERY_UNIT = ("NLIC", "NLICU", "NL")
HOLDING_UNIT = ("POHA", "EHPOHA", "EHPOHA")
NL_RECOVERY_UNIT = ("NLPACU", "NLPACU", "NLPACU")
VIRTUAL_PREFIX = "V "

_TEXT = "string"


def _result(hospital=None, unit=None, bed=None, lookup_bed=None, prefix_bed=None, error=None) -> Column:
    def text(value):
        if value is None:
            return F.lit("")
        return F.lit(value) if isinstance(value, str) else value

    return F.struct(
        F.coalesce(text(hospital), F.lit("")).alias("hospital"),
        F.coalesce(text(unit), F.lit("")).alias("unit"),
        F.coalesce(text(bed), F.lit("")).alias("bed"),
        (F.lit(None).cast(_TEXT) if lookup_bed is None else lookup_bed).alias("lookup_bed"),
        F.coalesce(F.lit(False) if prefix_bed is None else prefix_bed, F.lit(False)).alias("prefix_bed"),
        F.lit(error).cast(_TEXT).alias("error"),
    )


def letter_bed(bed: Column) -> Column:
    """A letter and three digits is a room with one bed: add ``-01``."""
    return F.when(bed.rlike("^[A-Z]\\d{3}$"), F.concat(bed, F.lit("-01"))).otherwise(bed)


def icu_bed(bed: Column) -> Column:
    """``CV``/``ICU`` beds without a blank or a bed number: trailing three digits, plus ``-01``."""
    wanted = (
        (F.startswith(bed, F.lit("CV")) | F.startswith(bed, F.lit("ICU")))
        & (F.substring(bed, 4, 1) != " ")
        & (F.substring(bed, -3, 1) != "-")
    )
    room = F.regexp_extract(bed, "[A-Z]+(\\d{3})$", 1)
    return F.when(
        wanted, F.concat(F.when(room != "", room).otherwise(bed), F.lit("-01"))
    ).otherwise(bed)


def bed_wildcard(bed: Column) -> Column:
    """Bed id with its number replaced by ``?`` marks; NULL where a special prefix has a bad form.

    The rules are tried in order.
    """
    emergency = "^([A-Za-z]+)\\d{2}(-?)01$"
    tower = "^([A-Za-z]\\d)\\d{2}(-01)?$"
    nursery = F.startswith(bed, F.lit("NICU"))
    return (
        F.when(
            F.substring(bed, 1, 2).isin("ER", "PA"),
            F.when(bed.rlike(emergency), F.regexp_replace(bed, emergency, "$1??$201")),
        )
        .when(
            (F.length(bed) >= 4) & bed.rlike("^\\p{L}\\p{Nd}"),
            F.when(bed.rlike(tower), F.regexp_replace(bed, tower, "$1??$2")),
        )
        .when(F.startswith(bed, F.lit("EMS")), F.lit("EMS?"))
        .when(nursery & bed.rlike("[AB]$"), F.regexp_replace(bed, "\\d[A-Za-z]$", "??"))
        .when(nursery & bed.rlike("-0[12]$"), F.regexp_replace(bed, "\\d{2}$", "??"))
        .otherwise(F.regexp_replace(bed, "\\d{1,2}$", "??"))
    )


def _dash_text(text: Column) -> Column:
    """One text: the test bed, ``hospital-unit-bed``, ``hospital-room-bed`` or a cart name."""
    tokens = F.split(text, "-", -1)
    t0, t1, t2 = (F.get(tokens, F.lit(i)) for i in range(3))
    room_bed = F.concat(t1, F.lit("-"), t2)
    return (
        F.when(text == TEST_BED, _result("", text, text))
        .when(
            F.size(tokens) == 3,
            F.when(t1.rlike("^\\d\\d"), _result(t0, "", room_bed, lookup_bed=room_bed)).otherwise(
                _result(t0, t1, letter_bed(t2))
            ),
        )
        .when(t2 == CART_MARK, _result(t0, F.array_join(F.slice(tokens, 1, 3), "-"), text))
        .otherwise(_result(error="LOCATION_TEXT"))
    )


def _facility(c: Column) -> Column:
    """Four or five components: named hospital, department number, or unit and bed."""
    c0, c1, c2, c3 = (F.get(c, F.lit(i)) for i in range(4))
    by_name = (
        F.when(
            c0 == EMERGENCY_UNIT,
            _result(c3, F.concat(c3, F.lit("_" + EMERGENCY_UNIT)), icu_bed(c2), lookup_bed=c2),
        )
        .when(c0 == RECOVERY_UNIT, _result(c3, c0, c2, prefix_bed=F.lit(True)))
        .otherwise(_result(c3, c0, icu_bed(c2)))
    )
    pods = F.startswith(F.lower(c2), F.lit(SHARED_PODS_PREFIX))
    department = (
        F.when((c0 == SHARED_DEPARTMENT) & pods, F.lit(SHARED_PODS_UNIT))
        .when(c0 == SHARED_DEPARTMENT, F.lit(SHARED_ICU_UNIT))
        .otherwise(c0)
    )
    return (
        F.when(F.endswith(c3, F.lit(HOSPITAL_SUFFIX)), by_name)
        .when(F.startswith(c0, F.lit(DEPARTMENT_PREFIX)), _result(c3, department, c2))
        .otherwise(_result("", c0, c1))
    )


def _pair(c: Column, first_is_hospital: Column) -> Column:
    """Two components: hospital and bed when the first is a canonical hospital, else unit and bed."""
    c0, c1 = F.get(c, F.lit(0)), F.get(c, F.lit(1))
    picu_room = F.substring(c1, F.lit(len(PICU_PREFIX) + 1), F.length(c1))
    picu_bed = F.concat(
        F.lit(PICU_BED), F.when(F.length(picu_room) == 2, F.lit("1")).otherwise(F.lit("")), picu_room
    )
    icu41 = F.startswith(c1, F.lit(ICU41_PREFIXES[0])) | F.startswith(c1, F.lit(ICU41_PREFIXES[1]))
    unit_from_bed = F.when(c1.contains("-"), F.substring_index(c1, "-", 1)).otherwise(
        F.substring_index(c1, " ", 1)
    )
    at_hospital = (
        F.when(F.startswith(c1, F.lit(PICU_PREFIX)), _result(c0, PICU_UNIT, picu_bed))
        .when(icu41, _result(c0, ICU41_UNIT, c1))
        .otherwise(_result(c0, unit_from_bed, c1, lookup_bed=c1))
    )
    at_unit = _result("", c0, letter_bed(c1))
    for name, unit, prefix in (NURSERY_UNIT, HOLDING_UNIT, NL_RECOVERY_UNIT):
        bed = letter_bed(F.concat(F.lit(prefix), c1))
        at_unit = F.when(c0 == name, _result("", unit, bed)).otherwise(at_unit)
    return F.when(first_is_hospital, at_hospital).otherwise(at_unit)


def location_candidate(c: Column, first_is_hospital: Column) -> Column:
    """Location candidate from the components of PV1.3."""
    c0, n = F.get(c, F.lit(0)), F.size(c)
    department = F.when(
        F.get(c, F.lit(10)) == DEPARTMENT_MARK,
        _result(F.get(c, F.lit(3)), F.get(c, F.lit(8)), F.get(c, F.lit(2))),
    ).otherwise(_result(error="LOCATION_NO_DEPARTMENT_MARK"))
    monitored = (
        F.when(F.startswith(c0, F.lit(DEPARTMENT_PREFIX)), _facility(c))
        .when(c0.contains(CART_MARK) | c0.contains(TOWER_MARK), _dash_text(c0))
        .otherwise(_result(error="LOCATION_MONITOR_FORM"))
    )
    return (
        F.when(c.isNull() | ((n == 1) & (c0 == "")), _result(error="LOCATION_BLANK"))
        .when(n == 11, department)
        .when(n == 9, monitored)
        .when(n.isin(4, 5), _facility(c))
        .when(n == 2, _pair(c, first_is_hospital))
        .when(n == 1, _dash_text(c0))
        .otherwise(_result(error="LOCATION_SHAPE"))
    )
