"""Location resolution against the site's own bed, unit and hospital tables.

The text rules are column expressions; the lookups are joins with three small tables, so messages are
never shuffled. A table larger than the broadcast limit falls back to an ordinary join.
"""

from __future__ import annotations

import json
from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedfeed.functions import hl7
from bedfeed.functions.location import (
    CART_MARK,
    RECOVERY_UNIT,
    VIRTUAL_PREFIX,
    bed_wildcard,
    icu_bed,
    location_candidate,
)
from bedfeed.session import broadcast_if_small, compute_once, with_value


@dataclass(frozen=True)
class SiteTables:
    """The site's location tables.

    beds: ``bed_wildcard, unit``. units: ``unit, hospital, canonical_unit``.
    hospitals: ``hospital_raw, hospital``; canonical names map to themselves without being listed.
    """

    beds: DataFrame
    units: DataFrame
    hospitals: DataFrame

    @staticmethod
    def from_maps(
        spark: SparkSession,
        beds: Mapping[str, str],
        units: Mapping[str, Iterable[str]],
        hospitals: Mapping[str, str],
    ) -> SiteTables:
        return SiteTables(
            spark.createDataFrame(list(beds.items()), "bed_wildcard string, unit string"),
            spark.createDataFrame(
                [(u, *h) for u, h in units.items()],
                "unit string, hospital string, canonical_unit string",
            ),
            spark.createDataFrame(list(hospitals.items()), "hospital_raw string, hospital string"),
        )

    @staticmethod
    def from_json(spark: SparkSession, path: str) -> SiteTables:
        """Read one JSON file with the maps ``bed_wildcard_to_unit``, ``unit_to_canonical`` and
        ``hospital_to_canonical``."""
        site = json.loads(spark.read.text(path, wholetext=True).first()[0])
        return SiteTables.from_maps(
            spark,
            site["bed_wildcard_to_unit"],
            site["unit_to_canonical"],
            site["hospital_to_canonical"],
        )

    @cached_property
    def lookups(self) -> dict[str, DataFrame]:
        """The tables as the resolver joins them, sized once per site."""
        tables = {
            "beds": self.beds.select("bed_wildcard", "unit"),
            "units": self.units.select("unit", "hospital", "canonical_unit"),
            "bed_units": self.bed_units(),
            "hospitals": self.canonical_hospitals(),
            "hospital_names": self.hospital_names(),
            "recovery_prefixes": self.recovery_prefixes(),
        }
        return {name: broadcast_if_small(table) for name, table in tables.items()}

    def canonical_units(self) -> DataFrame:
        return self.units.select("canonical_unit").distinct()

    def canonical_hospitals(self) -> DataFrame:
        return self.units.select("hospital").distinct()

    def hospital_names(self) -> DataFrame:
        """Raw hospital names, plus an identity row for each canonical name."""
        names = self.hospitals.select("hospital_raw", "hospital", F.lit(1).alias("p"))
        same = self.canonical_hospitals().select(
            F.col("hospital").alias("hospital_raw"), "hospital", F.lit(0).alias("p")
        )
        return (
            names.unionByName(same)
            .groupBy("hospital_raw")
            .agg(F.min_by("hospital", "p").alias("hospital"))
        )

    def bed_units(self) -> DataFrame:
        """Bed wildcards with the canonical hospital and unit of their unit."""
        return self.beds.join(self.units, "unit", "left").select(
            "bed_wildcard", "unit", "hospital", "canonical_unit"
        )

    def recovery_prefixes(self) -> DataFrame:
        """Bed prefix of each hospital's recovery room, read off the bed wildcards.

        A wildcard ``<prefix>PACU??`` gives the prefix of the hospital its unit belongs to.
        """
        pattern = f"^(.+){RECOVERY_UNIT}\\?\\?$"
        found = self.bed_units().where(F.col("bed_wildcard").rlike(pattern)).groupBy("hospital").agg(
            F.min(F.regexp_extract("bed_wildcard", pattern, 1)).alias("bed_prefix")
        )
        return self.hospital_names().join(found, "hospital").select("hospital_raw", "bed_prefix")


_SCRATCH = "_loc"


def lookup_unit_by_bed(df: DataFrame, site: SiteTables, bed: str = "bed_id", default: str = "") -> DataFrame:
    """Add ``unit_from_bed``: the unit of the bed's wildcard, or the default."""
    dim = site.lookups["beds"].withColumnRenamed("unit", "unit_from_bed")
    return (
        df.withColumn("bed_wildcard", bed_wildcard(F.col(bed)))
        .join(dim, "bed_wildcard", "left")
        .withColumn("unit_from_bed", F.coalesce("unit_from_bed", F.lit(default)))
    )


def lookup_canonical_unit(df: DataFrame, site: SiteTables, unit: str = "bed_unit") -> DataFrame:
    """Add ``unit_hospital`` and ``canonical_unit`` of a unit, blank when unknown."""
    dim = site.lookups["units"].select(
        F.col("unit").alias(unit), F.col("hospital").alias("unit_hospital"), "canonical_unit"
    )
    return df.join(dim, unit, "left").fillna("", ["unit_hospital", "canonical_unit"])


def lookup_hospital(df: DataFrame, site: SiteTables, hospital: str = "hospital") -> DataFrame:
    """Add ``canonical_hospital``, blank when unknown."""
    dim = site.lookups["hospital_names"].select(
        F.col("hospital_raw").alias(hospital), F.col("hospital").alias("canonical_hospital")
    )
    return df.join(dim, hospital, "left").fillna("", ["canonical_hospital"])


def _lookup(df: DataFrame, dim: DataFrame, key: Column, dim_key: str, **columns: str) -> DataFrame:
    """Left join on an expression, bringing in columns under scratch names."""
    keyed = dim.select(
        F.col(dim_key).alias(f"{_SCRATCH}_key"),
        *[F.col(src).alias(f"{_SCRATCH}_{dst}") for dst, src in columns.items()],
    )
    joined = df.withColumn(f"{_SCRATCH}_key", key).join(keyed, f"{_SCRATCH}_key", "left")
    return joined.drop(f"{_SCRATCH}_key")


def _s(name: str) -> Column:
    return F.col(f"{_SCRATCH}_{name}")


def resolve_locations(df: DataFrame, site: SiteTables, text: str = "location_text") -> DataFrame:
    """Add ``hospital, bed_unit, bed_id``, ``location_error`` and ``hospital_mismatch``.

    Unknown units and hospitals are blank. ``hospital_mismatch`` marks a message that names another
    hospital than the one its unit belongs to; the unit decides.
    """
    c = f"{_SCRATCH}_c"
    out = df.withColumn(c, hl7.components(F.col(text)))
    lookups = site.lookups
    out = _lookup(out, lookups["hospitals"], F.get(c, F.lit(0)), "hospital", is_hospital="hospital")
    out = out.withColumn(
        f"{_SCRATCH}_cand",
        with_value(
            F.struct(F.col(c).alias("c"), _s("is_hospital").isNotNull().alias("hospital")),
            lambda r: location_candidate(r["c"], r["hospital"]),
        ),
    )
    cand = F.col(f"{_SCRATCH}_cand")
    out = out.withColumn(f"{_SCRATCH}_lookup_wild", with_value(cand["lookup_bed"], bed_wildcard))
    out = _lookup(out, lookups["recovery_prefixes"], cand["hospital"], "hospital_raw", prefix="bed_prefix")
    out = _lookup(out, lookups["beds"], _s("lookup_wild"), "bed_wildcard", found="unit")
    prefixed = with_value(F.concat(F.coalesce(_s("prefix"), F.lit("")), cand["bed"]), icu_bed)
    out = out.withColumns(
        {
            f"{_SCRATCH}_unit": F.when(
                cand["lookup_bed"].isNotNull(), F.coalesce(_s("found"), cand["unit"])
            ).otherwise(cand["unit"]),
            f"{_SCRATCH}_bed": F.when(cand["prefix_bed"], prefixed).otherwise(cand["bed"]),
        }
    )
    unit, bed = _s("unit"), _s("bed")
    out = _lookup(out, lookups["hospitals"], F.substring_index(unit, " ", 1), "hospital", first_word="hospital")
    out = _lookup(out, lookups["units"], unit, "unit", u_hospital="hospital", u_unit="canonical_unit")
    wild = F.when(bed == cand["lookup_bed"], _s("lookup_wild")).otherwise(with_value(bed, bed_wildcard))
    out = out.withColumn(f"{_SCRATCH}_wild", wild)
    out = _lookup(
        out, lookups["bed_units"], _s("wild"), "bed_wildcard",
        b_raw="unit", b_hospital="hospital", b_unit="canonical_unit",
    )
    out = _lookup(
        out, lookups["hospital_names"], cand["hospital"], "hospital_raw", named="hospital"
    )
    virtual = _s("first_word").isNotNull() | F.startswith(unit, F.lit(VIRTUAL_PREFIX))
    by_unit = _s("u_unit").isNotNull()
    ok = cand["error"].isNull()
    needs_bed = ok & ~virtual & ~by_unit
    bad_bed = (cand["lookup_bed"].isNotNull() & _s("lookup_wild").isNull()) | (
        needs_bed & _s("wild").isNull()
    )
    blank = F.lit("")
    hospital = (
        F.when(virtual, F.coalesce(_s("named"), blank))
        .when(by_unit, _s("u_hospital"))
        .otherwise(F.coalesce(_s("b_hospital"), blank))
    )
    canonical = (
        F.when(virtual, unit)
        .when(by_unit, _s("u_unit"))
        .otherwise(F.coalesce(_s("b_unit"), blank))
    )
    error = F.coalesce(cand["error"], F.when(bad_bed, F.lit("LOCATION_BED_FORM")))
    mismatch = (cand["hospital"] != "") & (F.coalesce(_s("named"), blank) != hospital)
    resolved = compute_once(
        out.withColumn(f"{_SCRATCH}_error", error),
        {
            name: F.when(_s("error").isNull(), value)
            for name, value in {
                "hospital": hospital,
                "bed_unit": canonical,
                "bed_id": bed,
                "hospital_mismatch": mismatch,
            }.items()
        }
        | {"location_error": _s("error")},
    )
    return resolved.select(
        *df.columns, "hospital", "bed_unit", "bed_id", "location_error", "hospital_mismatch"
    )


def locate_messages(messages: DataFrame, site: SiteTables) -> DataFrame:
    """Resolve the location of parsed messages; a location error becomes the message's error."""
    out = resolve_locations(messages, site)
    code = F.coalesce("error_code", "location_error")
    message = F.coalesce(
        "error_msg",
        F.when(
            F.col("location_error").isNotNull(),
            F.concat(F.lit("PV1.3 has no known form: "), "location_text"),
        ),
    )
    return out.withColumns({"error_code": code, "error_msg": message}).drop("location_error")


def is_cart(unit: Column) -> Column:
    return F.upper(unit).contains(CART_MARK)


def bed_inventory(beds: DataFrame) -> DataFrame:
    """Distinct beds of each hospital and unit, with the cart flag."""
    return beds.groupBy("hospital", "bed_unit").agg(
        F.countDistinct("bed_id").alias("beds"), F.first(is_cart(F.col("bed_unit"))).alias("is_cart")
    )


def bed_totals(beds: DataFrame) -> DataFrame:
    """Distinct hospitals, and distinct beds that are and are not on carts."""
    keys = beds.select("hospital", "bed_unit", "bed_id").distinct()
    return keys.agg(
        F.countDistinct("hospital").alias("hospitals"),
        F.countDistinct(F.when(~is_cart(F.col("bed_unit")), F.col("bed_id"))).alias("beds"),
        F.countDistinct(F.when(is_cart(F.col("bed_unit")), F.col("bed_id"))).alias("carts"),
    )


def bed_mapping(beds: DataFrame) -> DataFrame:
    """Distinct location texts with their resolved bed, in hospital, unit, bed order."""
    return (
        beds.select("hospital", "bed_unit", "bed_id", "location_text")
        .distinct()
        .orderBy("hospital", "bed_unit", "bed_id", "location_text")
    )


def discover_beds(observed: DataFrame, known: DataFrame, text: str = "location_text") -> DataFrame:
    """Union of known and observed location texts; ``is_new`` marks texts not known before."""
    seen = observed.select(text, F.lit(True).alias("is_new"))
    old = known.select(text, F.lit(False).alias("is_new"))
    return seen.unionByName(old).groupBy(text).agg(F.min("is_new").alias("is_new"))


def unmapped_locations(located: DataFrame, site: SiteTables) -> DataFrame:
    """Observed units and beds that the site tables do not know."""
    return (
        located.where(F.col("location_error").isNull())
        .where((F.col("hospital") == "") | (F.col("bed_unit") == ""))
        .groupBy("location_text", "hospital", "bed_unit", "bed_id")
        .agg(F.count(F.lit(1)).alias("n"))
    )
