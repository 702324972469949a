"""Queries that run operators on columns of the given tables directly."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bedfeed.functions import location as rules
from bedfeed.functions import text, times, waveform as wave
from bedfeed.operators import location, observations, patients, profile, waveform
from bedfeed.plans import synth
from bedfeed.plans.base import query
from bedfeed.plans.synth import table
from bedfeed.session import TASK_ROWS, compute_once, scratch_dir, spread
from bedfeed.sinks import records, tables as table_sink
from bedfeed.sources import tables as table_source

# ---------------------------------------------------------------- times


@query(
    """SELECT l_returnflag, CAST(sign(epoch_us(l_shipdate) - epoch_us(o_orderdate)) AS BIGINT) AS order_first,
      count(*) AS n, CAST(sum((epoch_us(l_shipdate) - epoch_us(o_orderdate)) // 1000000) AS BIGINT) AS seconds
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey GROUP BY ALL"""
)
def compared_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order and distance of two time texts."""
    joined = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey")
    )
    both = joined.select(
        "l_returnflag", synth.hl7_time(F.col("o_orderdate")).alias("a"), synth.hl7_time(F.col("l_shipdate")).alias("b")
    ).select(
        "l_returnflag", times.duration_ns(F.col("a"), F.col("b")).alias("d"),
        times.compare_times(F.col("a"), F.col("b")).cast("bigint").alias("order_first"),
    )
    seconds = F.call_function("div", F.col("d"), F.lit(10**9))
    return both.groupBy("l_returnflag", "order_first").agg(
        F.count(F.lit(1)).alias("n"), F.sum(seconds).alias("seconds")
    )


# ---------------------------------------------------------------- locations

_SHAPES = 22
_FIXED_UNITS = {
    "MAIN-ANES-CART": "MAIN-ANES-CART", "41ICU": "41ICU", "PICU": "PICU", "NLICU": "NLICU",
    "EHPOHA": "EHPOHA", "NLPACU": "NLPACU", "CVPODS": "CVPODS", "CVICU": "CVICU", "TEST": "TEST",
    "EDU": "EMERGENCY",
}


def shaped_site(spark: SparkSession, sf_dir: str) -> location.SiteTables:
    """The derived site plus the units that the special location forms name."""
    site = synth.site_tables(spark, sf_dir)
    region = table(spark, sf_dir, "region")
    fixed = spark.createDataFrame(
        [(u, "MAIN", c) for u, c in _FIXED_UNITS.items()], "unit string, hospital string, canonical_unit string"
    )
    recovery = F.concat(F.lit("PACU"), "r_regionkey")
    prefix = F.concat(F.char(F.lit(65) + F.col("r_regionkey")), F.lit("X"))
    return location.SiteTables(
        beds=site.beds.unionByName(
            region.select(F.concat(prefix, F.lit("PACU??")).alias("bed_wildcard"), recovery.alias("unit"))
        ).unionByName(
            spark.createDataFrame([("EDH??", "EDU"), ("WH-TEST", "TEST")], "bed_wildcard string, unit string")
        ),
        units=site.units.unionByName(fixed).unionByName(
            region.select(
                recovery.alias("unit"), F.col("r_name").alias("hospital"),
                F.concat(F.lit("PACU_"), "r_regionkey").alias("canonical_unit"),
            )
        ),
        hospitals=site.hospitals.unionByName(
            region.select(F.concat("r_name", F.lit(" Hospital")).alias("hospital_raw"), F.col("r_name").alias("hospital"))
        ),
    )


def shaped_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Location texts of every shape, from customer, nation and region keys."""
    customer, nation = table(spark, sf_dir, "customer"), table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    rows = customer.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).join(
        region, F.col("n_regionkey") == F.col("r_regionkey")
    ).select(
        "c_custkey",
        F.lpad((F.col("c_custkey") % 20).cast("string"), 2, "0").alias("b"),
        F.concat((F.lit(4100) + F.col("n_nationkey")).cast("string"), F.lit("-")).alias("room"),
        F.concat(F.lit("H"), "r_regionkey").alias("h"),
        F.concat(F.lit("U"), "n_nationkey").alias("u"),
        F.col("n_nationkey").cast("string").alias("n"),
        "n_name", "r_name",
    )
    h, u, b, n, name, region_name = (F.col(c) for c in ("h", "u", "b", "n", "n_name", "r_name"))
    bed = F.concat("room", "b")

    def text_of(*parts: str | Column) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    pods = F.when(F.col("c_custkey") % 4 == 1, F.lit("CV")).otherwise(F.lit("28"))
    shapes = [
        text_of("100^ROOM^", bed, "^", h, "^R^^^^", name, "^^DEPID"),
        text_of("100^ROOM^", bed, "^", h, "^R^^^^", name, "^^OTHER"),
        text_of("100", n, "^R^", bed, "^", h, "^^^^^MON"),
        text_of("MAIN-ANES-CART-A", n, "^^^^^^^^ANES"),
        text_of("ZZ", n, "^^^^^^^^MON"),
        text_of(u, "^^ICU 7^", region_name, " Hospital"),
        text_of(u, "^^ICU231^", region_name, " Hospital"),
        text_of("PACU^^PACU", b, "^", region_name, " Hospital"),
        text_of("ED^^EDH", b, "^", region_name, " Hospital"),
        text_of("10007004^R^", pods, b, "^", h),
        text_of(u, "^", bed, "^x^y"),
        text_of(region_name, "^", bed),
        text_of(region_name, "^PICU L", b),
        text_of("NLIC^20", b),
        text_of(u, "^G5", b),
        text_of(h, "-", bed),
        text_of("WH-TEST"),
        text_of("A^", n, "^C"),
        text_of(""),
        text_of(u, "X^ER123"),
        text_of("100^ROOM^", bed, "^", h, "^R^^^^V ", name, "^^DEPID"),
        text_of("100^ROOM^", bed, "^", h, "^R^^^^", region_name, " WARD^^DEPID"),
    ]
    out = shapes[-1]
    for k, shape in enumerate(shapes[:-1]):
        out = F.when(F.col("c_custkey") % _SHAPES == k, shape).otherwise(out)
    return rows.select("c_custkey", out.alias("location_text"))


_LOCATION_SQL = f"""WITH c AS (
    SELECT c_custkey, c_custkey % {_SHAPES} AS k, lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') AS b,
      (4100 + n_nationkey) || '-' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') AS bed,
      n_nationkey AS n, r_regionkey AS r, n_name, r_name
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
  loc AS (
    SELECT c_custkey, k, n, CASE
        WHEN k IN (1, 4, 17, 18, 19) THEN NULL
        WHEN k = 11 AND n IN (7, 8) THEN 'MAIN'
        WHEN k IN (3, 8, 9, 12, 13) THEN 'MAIN'
        WHEN k = 16 THEN 'MAIN' ELSE r_name END AS hospital,
      CASE WHEN k IN (1, 4, 17, 18, 19) THEN NULL
        WHEN k = 3 THEN 'MAIN-ANES-CART'
        WHEN k = 7 THEN 'PACU_' || r WHEN k = 8 THEN 'EMERGENCY'
        WHEN k = 9 THEN CASE WHEN c_custkey % 4 = 1 THEN 'CVPODS' ELSE 'CVICU' END
        WHEN k = 11 AND n IN (7, 8) THEN '41ICU'
        WHEN k = 12 THEN 'PICU' WHEN k = 13 THEN 'NLICU' WHEN k = 16 THEN 'TEST'
        WHEN k = 20 THEN 'V ' || n_name
        WHEN k = 21 AND r_name <> 'MIDDLE EAST' THEN r_name || ' WARD' ELSE n_name END AS bed_unit,
      CASE WHEN k IN (1, 4, 17, 18, 19) THEN NULL
        WHEN k = 3 THEN 'MAIN-ANES-CART-A' || n WHEN k = 5 THEN 'ICU 7' WHEN k = 6 THEN '231-01'
        WHEN k = 7 THEN chr(65 + r) || 'XPACU' || b WHEN k = 8 THEN 'EDH' || b
        WHEN k = 9 THEN CASE WHEN c_custkey % 4 = 1 THEN 'CV' ELSE '28' END || b
        WHEN k = 12 THEN 'MHPICUL1' || b WHEN k = 13 THEN 'NL20' || b WHEN k = 14 THEN 'G5' || b || '-01'
        WHEN k = 16 THEN 'WH-TEST' ELSE bed END AS bed_id,
      CASE k WHEN 1 THEN 'LOCATION_NO_DEPARTMENT_MARK' WHEN 4 THEN 'LOCATION_MONITOR_FORM'
        WHEN 17 THEN 'LOCATION_SHAPE' WHEN 18 THEN 'LOCATION_BLANK' WHEN 19 THEN 'LOCATION_BED_FORM'
        END AS location_error,
      CASE WHEN k IN (1, 4, 17, 18, 19) THEN NULL
        WHEN k IN (8, 9, 12) OR (k = 11 AND n IN (7, 8)) THEN TRUE ELSE FALSE END AS hospital_mismatch
    FROM c)"""


def resolved_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return location.resolve_locations(shaped_locations(spark, sf_dir), shaped_site(spark, sf_dir))


@query(
    f"""{_LOCATION_SQL}
    SELECT c_custkey, hospital, bed_unit, bed_id, location_error, hospital_mismatch FROM loc"""
)
def bed_locations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hospital, unit and bed of location texts of every shape."""
    return resolved_locations(spark, sf_dir).drop("location_text")


@query(
    f"""{_LOCATION_SQL}
    SELECT count(DISTINCT hospital) AS hospitals,
      count(DISTINCT CASE WHEN bed_unit NOT LIKE '%CART%' THEN bed_id END) AS beds,
      count(DISTINCT CASE WHEN bed_unit LIKE '%CART%' THEN bed_id END) AS carts
    FROM loc WHERE location_error IS NULL"""
)
def bed_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    resolved = resolved_locations(spark, sf_dir)
    return location.bed_totals(resolved.where(F.col("location_error").isNull()))


_WILD_SQL = """
  SELECT c_custkey, CASE c_custkey % 9
    WHEN 0 THEN 'ER' || b || '01' WHEN 1 THEN 'PA' || b || '-01' WHEN 2 THEN 'T4' || b WHEN 3 THEN 'T4' || b || '-01'
    WHEN 4 THEN 'EMS' || b WHEN 5 THEN 'NICU' || b || 'A' WHEN 6 THEN 'NICU7-01'
    WHEN 7 THEN 'ICU ' || (c_custkey % 20) ELSE 'T4' || b || 'x' END AS bed_id
  FROM (SELECT c_custkey, lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') AS b FROM customer)"""


@query(
    f"""SELECT bed_id, CASE
      WHEN bed_id LIKE 'ER%' THEN 'ER??01' WHEN bed_id LIKE 'PA%' THEN 'PA??-01'
      WHEN bed_id LIKE 'T4%x' THEN NULL WHEN bed_id LIKE 'T4%-01' THEN 'T4??-01' WHEN bed_id LIKE 'T4%' THEN 'T4??'
      WHEN bed_id LIKE 'EMS%' THEN 'EMS?' WHEN bed_id LIKE 'NICU%A' THEN regexp_replace(bed_id, '[0-9]A$', '??')
      WHEN bed_id LIKE 'NICU%' THEN 'NICU7-??' ELSE 'ICU ??' END AS bed_wildcard, count(*) AS n
    FROM ({_WILD_SQL}) GROUP BY ALL"""
)
def bed_wildcards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wildcard form of bed ids."""
    k, b = F.col("c_custkey") % 9, F.lpad((F.col("c_custkey") % 20).cast("string"), 2, "0")
    forms = [
        F.concat(F.lit("ER"), b, F.lit("01")), F.concat(F.lit("PA"), b, F.lit("-01")), F.concat(F.lit("T4"), b),
        F.concat(F.lit("T4"), b, F.lit("-01")), F.concat(F.lit("EMS"), b), F.concat(F.lit("NICU"), b, F.lit("A")),
        F.lit("NICU7-01"), F.concat(F.lit("ICU "), (F.col("c_custkey") % 20).cast("string")),
    ]
    bed = F.concat(F.lit("T4"), b, F.lit("x"))
    for n, form in enumerate(forms):
        bed = F.when(k == n, form).otherwise(bed)
    rows = table(spark, sf_dir, "customer").select(bed.alias("bed_id"))
    return rows.groupBy("bed_id", rules.bed_wildcard(F.col("bed_id")).alias("bed_wildcard")).agg(
        F.count(F.lit(1)).alias("n")
    )


@query(
    """SELECT location_text, min(is_new) AS is_new FROM (
      SELECT 'ROOM-' || c_nationkey || '-' || c_mktsegment AS location_text, TRUE AS is_new FROM customer
      UNION ALL SELECT 'ROOM-' || s_nationkey || '-BUILDING', FALSE FROM supplier) GROUP BY 1"""
)
def discovered_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observed location texts merged into the known list."""
    seen = table(spark, sf_dir, "customer").select(
        F.concat_ws("-", F.lit("ROOM"), "c_nationkey", "c_mktsegment").alias("location_text")
    )
    known = table(spark, sf_dir, "supplier").select(
        F.concat_ws("-", F.lit("ROOM"), "s_nationkey", F.lit("BUILDING")).alias("location_text")
    )
    return location.discover_beds(seen, known)


@query(
    """SELECT 'Q' || c_nationkey || '^G5' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') AS location_text,
      '' AS hospital, '' AS bed_unit, 'G5' || lpad(CAST(c_custkey % 20 AS VARCHAR), 2, '0') || '-01' AS bed_id,
      count(*) AS n
    FROM customer WHERE c_custkey % 2 = 0 GROUP BY ALL"""
)
def unmapped_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Locations the site tables do not know: half of the texts name units that are not listed."""
    unit = F.when(F.col("c_custkey") % 2 == 0, F.lit("Q")).otherwise(F.lit("U"))
    bed = F.lpad((F.col("c_custkey") % 20).cast("string"), 2, "0")
    rows = table(spark, sf_dir, "customer").select(
        F.concat(unit, "c_nationkey", F.lit("^G5"), bed).alias("location_text")
    )
    located = location.resolve_locations(rows, shaped_site(spark, sf_dir))
    return location.unmapped_locations(located, shaped_site(spark, sf_dir))


# ---------------------------------------------------------------- patients

_SEEN_SQL = """s AS (SELECT event_id, 'B' || (user_id % 10) AS bed_id, 'P' || user_id AS pid, epoch_ns(ts) AS ns,
    event_type FROM events)"""


def event_sightings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sightings_of(table(spark, sf_dir, "events"))


def sightings_of(events: DataFrame) -> DataFrame:
    """One sighting per event: ten beds, one patient per user."""
    text = F.concat(F.date_format("ts", "yyyyMMddHHmmss.SSSSSS"), F.lit("+0000"))
    return compute_once(events, {"start_ns": times.parse_ns(text)}).select(
        "event_id", "event_type",
        F.lit("H").alias("hospital"), F.lit("U").alias("bed_unit"),
        F.concat(F.lit("B"), F.col("user_id") % 10).alias("bed_id"),
        *[F.concat(F.lit(p), "user_id").alias(c) for p, c in zip("PVFL", patients.FILL, strict=True)],
        F.lit("").alias("middle_initial"),
        "start_ns",
        F.col("event_id").alias("msg_idx"),
    )


@query(
    f"""WITH {_SEEN_SQL}, f AS (SELECT bed_id, pid, min(ns) AS start_ns FROM s GROUP BY ALL)
    SELECT bed_id, pid, start_ns, lead(start_ns) OVER (PARTITION BY bed_id ORDER BY start_ns) AS end_ns FROM f"""
)
def patient_intervals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Validity intervals of patients per bed."""
    return patients.patient_intervals(event_sightings(spark, sf_dir)).select("bed_id", "pid", "start_ns", "end_ns")


@query(
    f"""WITH {_SEEN_SQL}, f AS (SELECT bed_id, pid, min(ns) AS start_ns FROM s GROUP BY ALL)
    SELECT bed_id, arg_max(pid, start_ns) AS pid, max(start_ns) AS start_ns FROM f GROUP BY bed_id"""
)
def current_patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    intervals = patients.patient_intervals(event_sightings(spark, sf_dir))
    return patients.current_patient(intervals).select("bed_id", "pid", "start_ns")


@query(f"WITH {_SEEN_SQL} SELECT bed_id, count(DISTINCT pid) AS patients FROM s GROUP BY bed_id")
def patients_per_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return patients.unique_patients(event_sightings(spark, sf_dir)).select("bed_id", "patients")


@query(
    f"""WITH {_SEEN_SQL},
    f1 AS (SELECT bed_id, pid, min(ns) AS start_ns FROM s WHERE event_id % 2 = 0 GROUP BY ALL),
    i1 AS (SELECT *, lead(start_ns) OVER (PARTITION BY bed_id ORDER BY start_ns) AS end_ns FROM f1),
    cur AS (SELECT bed_id, arg_max(pid, start_ns) AS pid, max(start_ns) AS ns FROM i1 GROUP BY bed_id),
    f2 AS (SELECT bed_id, pid, min(ns) AS start_ns FROM (
      SELECT bed_id, pid, ns FROM s WHERE event_id % 2 = 1 UNION ALL SELECT bed_id, pid, ns FROM cur) GROUP BY ALL),
    i2 AS (SELECT *, lead(start_ns) OVER (PARTITION BY bed_id ORDER BY start_ns) AS end_ns FROM f2)
    SELECT bed_id, pid, start_ns, end_ns FROM i2
    UNION ALL SELECT i1.* FROM i1 ANTI JOIN i2 USING (bed_id, pid, start_ns)"""
)
def patient_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """History after two batches, the second carried on from the first one's current patients."""
    seen = event_sightings(spark, sf_dir)
    first = patients.patient_intervals(seen.where(F.col("event_id") % 2 == 0))
    second = patients.patient_intervals(
        seen.where(F.col("event_id") % 2 == 1), patients.current_patient(first)
    )
    history = patients.patient_history(patients.patient_history(None, first), second)
    return history.select("bed_id", "pid", "start_ns", "end_ns")


@query(
    f"""WITH {_SEEN_SQL}, f AS (SELECT bed_id, pid, min(ns) AS start_ns FROM s GROUP BY ALL),
    i AS (SELECT *, lead(start_ns) OVER (PARTITION BY bed_id ORDER BY start_ns) AS end_ns FROM f)
    SELECT bed_id, pid, bucket FROM (
      SELECT bed_id, pid, unnest(CASE WHEN end_ns IS NULL THEN [NULL]
        ELSE range(start_ns // 86400000000000, (end_ns - 1) // 86400000000000 + 1) END) AS bucket FROM i)"""
)
def bed_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Patients per bed and day."""
    intervals = patients.patient_intervals(event_sightings(spark, sf_dir))
    return patients.bed_patient_lookup(intervals).select("bed_id", "pid", "bucket")


_ATTRIBUTED_SQL = f"""WITH {_SEEN_SQL}, f AS (SELECT bed_id, pid, min(ns) AS start_ns FROM s GROUP BY ALL),
    i AS (SELECT *, lead(start_ns) OVER (PARTITION BY bed_id ORDER BY start_ns) AS end_ns FROM f)
    SELECT event_id, s.bed_id, CASE WHEN event_type = 'view' THEN s.pid ELSE i.pid END AS pid,
      'V' || i.pid[2:] AS visit_id
    FROM s LEFT JOIN i ON s.bed_id = i.bed_id AND i.start_ns <= ns AND (i.end_ns IS NULL OR ns < i.end_ns)"""


def _attributed(spark: SparkSession, sf_dir: str, method: str) -> DataFrame:
    seen = event_sightings(spark, sf_dir)
    rows = seen.select(
        "event_id", "hospital", "bed_unit", "bed_id", F.col("start_ns").alias("start_t_ns"),
        F.when(F.col("event_type") == "view", F.col("pid")).otherwise(F.lit("")).alias("pid"),
        *[F.lit("").alias(c) for c in ("visit_id", "first_name", "last_name")],
    )
    path = scratch_dir(spark)
    patients.patient_intervals(seen).write.parquet(path)
    found = patients.attribute_patient(rows, spark.read.parquet(path), method=method)
    return found.select("event_id", "bed_id", "pid", "visit_id")


@query(_ATTRIBUTED_SQL)
def attributed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blank patients of rows filled from the intervals of their bed; the way is chosen by size."""
    return _attributed(spark, sf_dir, "auto")


@query(_ATTRIBUTED_SQL)
def attributed_rows_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same by merging rows and intervals in time order, the way for large interval tables."""
    return _attributed(spark, sf_dir, "sorted")


@query(
    f"""WITH {_SEEN_SQL},
    i AS (SELECT CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'H' END AS h, CASE WHEN event_id % 4 = 0 THEN NULL ELSE bed_id END AS bed,
      CASE WHEN event_id % 6 = 0 THEN '' ELSE pid END AS pid, 'V' || pid[2:] AS visit,
      CASE WHEN event_id % 35 = 0 THEN NULL ELSE ns END AS a,
      CASE WHEN event_id % 20 = 0 THEN NULL ELSE ns + (event_id % 7) * 36000000000000 END AS b FROM s WHERE event_id % 5 = 0),
    both_i AS (SELECT DISTINCT * FROM i),
    r AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN NULL ELSE 'H' END AS h,
      CASE WHEN event_id % 4 = 1 THEN NULL ELSE bed_id END AS bed, CASE WHEN event_id % 11 = 0 THEN NULL ELSE ns END AS t FROM s),
    m AS (SELECT r.event_id,
        first(pid ORDER BY a NULLS FIRST, b NULLS LAST, pid, visit) FILTER (pid <> '') AS pid,
        first(visit ORDER BY a NULLS FIRST, b NULLS LAST, pid, visit) AS visit
      FROM r JOIN both_i ON r.h IS NOT DISTINCT FROM both_i.h AND r.bed IS NOT DISTINCT FROM both_i.bed
        AND (a IS NULL OR a <= t) AND (b IS NULL OR t < b) WHERE t IS NOT NULL GROUP BY 1)
    SELECT r.event_id, way, coalesce(pid, '') AS pid, coalesce(visit, '') AS visit_id
    FROM r CROSS JOIN (VALUES ('auto'), ('lists'), ('sorted')) w(way) LEFT JOIN m USING (event_id)"""
)
def attributed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All ways to the patients of rows: keys and starts that are NULL, overlapping, empty, open and equal intervals."""
    seen = event_sightings(spark, sf_dir)
    n = F.col("event_id")
    intervals = seen.where(n % 5 == 0).select(
        F.when(n % 3 != 0, F.col("hospital")).alias("hospital"), "bed_unit", F.when(n % 4 != 0, F.col("bed_id")).alias("bed_id"),
        F.when(n % 6 == 0, F.lit("")).otherwise(F.col("pid")).alias("pid"), "visit_id",
        *[F.lit("").alias(c) for c in ("first_name", "last_name", "middle_initial")],
        F.when(n % 35 != 0, F.col("start_ns")).alias("start_ns"),
        F.when(n % 20 != 0, F.col("start_ns") + (n % 7) * (36 * 10**12)).alias("end_ns"),
    )
    intervals = intervals.unionByName(intervals.where(F.col("start_ns").isNull()))
    rows = seen.select(
        "event_id", F.when(n % 2 != 0, F.col("hospital")).alias("hospital"), "bed_unit",
        F.when(n % 4 != 1, F.col("bed_id")).alias("bed_id"), F.when(n % 11 != 0, F.col("start_ns")).alias("start_t_ns"),
        *[F.lit("").alias(c) for c in patients.FILL],
    )
    out = [
        patients.attribute_patient(rows, intervals, method=way).select("event_id", F.lit(way).alias("way"), "pid", "visit_id")
        for way in ("auto", "lists", "sorted")
    ]
    return out[0].unionByName(out[1]).unionByName(out[2])


@query(
    f"""WITH {_SEEN_SQL}, lone AS (SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'B0' ELSE bed_id END AS bed,
      CASE WHEN event_id % 2 = 0 THEN 1704067200000000000 + (event_id % 1000) * 3600000000 ELSE ns END AS t, event_id % 3 AS own FROM s),
    i AS (SELECT DISTINCT 'B0' AS bed, 'Q' || (event_id % 50) AS pid, 1704067200000000000 + (event_id % 50) * 72000000000 AS a,
      1704067200000000000 + (event_id % 50) * 72000000000 + 60000000000 AS b FROM s)
    SELECT event_id, lone.bed AS bed_id, t, CASE WHEN own = 0 THEN 'own' ELSE coalesce(i.pid, '') END AS pid
    FROM lone LEFT JOIN i ON lone.bed = i.bed AND a <= t AND t < b"""
)
def attributed_hot_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of which half lie in one hour of one bed, attributed by the prefix scan; rows that know their patient keep it."""
    n, begin = F.col("event_id"), 1_704_067_200_000_000_000
    hot, start = n % 2 == 0, begin + (n % 50) * 72_000_000_000
    seen = event_sightings(spark, sf_dir)
    rows = seen.select(
        "event_id", "hospital", "bed_unit", F.when(hot, F.lit("B0")).otherwise(F.col("bed_id")).alias("bed_id"),
        F.when(hot, begin + (n % 1000) * 3_600_000_000).otherwise(F.col("start_ns")).alias("start_t_ns"),
        F.when(n % 3 == 0, F.lit("own")).otherwise(F.lit("")).alias("pid"),
    )
    intervals = seen.select(
        "hospital", "bed_unit", F.lit("B0").alias("bed_id"), F.concat(F.lit("Q"), n % 50).alias("pid"),
        *[F.lit("").alias(c) for c in ("visit_id", "first_name", "last_name", "middle_initial")],
        start.alias("start_ns"), (start + 60_000_000_000).alias("end_ns"),
    ).distinct()
    out = patients.attribute_patient(rows, intervals, fill=("pid",), method="sorted")
    return out.select("event_id", "bed_id", F.col("start_t_ns").alias("t"), "pid")


# ---------------------------------------------------------------- observation tables


@query(
    """SELECT event_type AS channel, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1"""
)
def deduplicated_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows sent twice with other values the second time: the first ones stay."""
    events = table(spark, sf_dir, "events")
    sent = events.select(
        F.col("event_id").cast("string").alias("control_id"), F.col("event_type").alias("channel"),
        F.array("value").alias("values_num"), F.lit(0).alias("sent"),
    )
    again = sent.withColumns(
        {"values_num": F.transform("values_num", lambda v: v - 1), "sent": F.lit(1)}
    )
    kept = observations.dedup_observations(sent.unionByName(again), order=["sent"])
    return kept.groupBy("channel").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.get("values_num", F.lit(0))), 4).alias("total")
    )


def order_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as observation rows: a bed per status and priority, the price as value."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").cast("string").alias("control_id"),
        F.lit("H").alias("hospital"), F.lit("").alias("bed_unit"),
        F.concat_ws("_", "o_orderstatus", F.substring("o_orderpriority", 1, 1)).alias("bed_id"),
        times.parse_ns(synth.hl7_time(F.col("o_orderdate"))).alias("start_t_ns"),
        F.array("o_totalprice").alias("values_num"),
        (F.col("o_orderkey") % 4).alias("_batch"),
    )


@query(
    """SELECT o_orderstatus || '_' || o_orderpriority[1:1] AS bed_id, count(*) AS n,
      round(sum(CASE WHEN o_orderkey % 4 = 0 THEN o_totalprice - 1 ELSE o_totalprice END), 2) AS total
    FROM orders WHERE o_orderkey % 4 IN (0, 1, 2) GROUP BY 1"""
)
def loaded_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four numbered batches, each with the rows of the one before at smaller prices, one written twice; two of them
    read back: of the rows that both have, those of the first stay."""
    path = scratch_dir(spark)
    rows = order_rows(spark, sf_dir)
    cheaper = rows.withColumns({"values_num": F.transform("values_num", lambda v: v - 1), "_batch": F.col("_batch") + 1})
    rows = rows.unionByName(cheaper).withColumn("msg_idx", F.lit(0).cast("bigint"))
    for batch in (0, 1, 2, 3, 1):
        table_sink.write_batch(rows.where(F.col("_batch") == batch), path, batch)
    loaded = table_source.load_batches(spark, path, 1, 2)
    return loaded.groupBy("bed_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.get("values_num", F.lit(0))), 2).alias("total")
    )


@query(
    """SELECT o_orderstatus || '_' || o_orderpriority[1:1] AS bed_id, count(*) AS n, round(sum(o_totalprice), 2) AS total
    FROM orders GROUP BY 1"""
)
def appended_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows appended twice to one table, whose files have no numbers, and read back; within a file the first row of
    those that differ in their values only stays."""
    path = scratch_dir(spark)
    rows = order_rows(spark, sf_dir).withColumn("row_idx", F.lit(0).cast("bigint"))
    cheaper = rows.withColumns({"values_num": F.transform("values_num", lambda v: v - 1), "row_idx": F.lit(1).cast("bigint")})
    both = rows.unionByName(cheaper)
    both = both.repartition(max(4, -(-table(spark, sf_dir, "orders").count() // TASK_ROWS)), "control_id")
    table_sink.write_observations(both.where("_batch < 2"), path)
    table_sink.write_observations(both.where("_batch >= 2"), path)
    return table_source.load_batches(spark, path).groupBy("bed_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.get("values_num", F.lit(0))), 2).alias("total")
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS control_id, 'F_1' AS bed_id, '' AS bed_unit, o_totalprice AS price
    FROM orders WHERE o_orderstatus = 'F' AND o_orderpriority[1:1] = '1'"""
)
def loaded_bed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One bed read from a table written per bed, and its folder read as a file of a single bed."""
    path = scratch_dir(spark)
    table_sink.write_by_bed(order_rows(spark, sf_dir), path)
    bed = table_source.load_bed(spark, path, "H", "", "F_1")
    single = scratch_dir(spark)
    bed.write.parquet(single)
    key, rows = table_source.load_bed_file(spark, single)
    rows = rows.where(F.lit(key == ("H", "", "F_1")))
    return rows.select("control_id", "bed_id", "bed_unit", F.get("values_num", F.lit(0)).alias("price"))


@query(
    """WITH o AS (SELECT *, o_orderstatus || '_' || o_orderpriority[1:1] AS bed_id FROM orders),
    k AS (SELECT bed_id FROM o GROUP BY 1 ORDER BY 1 LIMIT 3 OFFSET 2)
    SELECT hospital, bed_unit, bed_id, n, total FROM (
      SELECT 'H' AS hospital, '' AS bed_unit, bed_id, count(*) AS n, round(sum(o_totalprice), 2) AS total
      FROM o JOIN k USING (bed_id) GROUP BY ALL)"""
)
def loaded_beds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One folder per bed written, a run of beds read back."""
    path = scratch_dir(spark)
    table_sink.write_by_bed(order_rows(spark, sf_dir), path)
    loaded = table_source.load_beds(spark, path, 2, 3)
    return loaded.groupBy("hospital", "bed_unit", "bed_id").agg(
        F.count(F.lit(1)).alias("n"), F.round(F.sum(F.get("values_num", F.lit(0))), 2).alias("total")
    )


# ---------------------------------------------------------------- texts

_TRANSLATED = (
    "replace(replace(replace(replace(translate(text, '‘’‚′“”„″�–—‹›˜ˆ', "
    "repeat(chr(39), 4) || repeat(chr(34), 4) || '?--<>~^'), "
    "'®', '(R)'), '©', '(C)'), '™', '(TM)'), '…', '...')"
)


@query(f"SELECT doc_id, regexp_replace({_TRANSLATED}, '[^\\x00-\\x7F]', '?', 'g') AS clean FROM documents")
def sanitized_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents in ASCII."""
    return table(spark, sf_dir, "documents").select("doc_id", text.sanitize_ascii(F.col("text")).alias("clean"))


@query(
    """SELECT char, count(*) AS texts FROM (
      SELECT unnest(list_distinct(regexp_extract_all(text, '[^\\x00-\\x7F]'))) AS char FROM documents) GROUP BY 1"""
)
def non_ascii_chars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents per non-ASCII character."""
    return profile.non_ascii_profile(table(spark, sf_dir, "documents"), "text")


@query("SELECT doc_id, md5(text) AS text_hash, CAST(strlen(text) AS BIGINT) AS text_bytes FROM documents")
def archived_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents archived and restored."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    archived = profile.archive_table(documents, "text")
    restored = archived.select(
        "doc_id", "text_bytes", text.restore_payload(F.col("payload")).alias("text")
    )
    return restored.select("doc_id", F.md5("text").alias("text_hash"), "text_bytes")


# ---------------------------------------------------------------- waveforms

_SAMPLES_SQL = """v AS (SELECT vec_id, label, CAST(unnest(embedding) AS DOUBLE) AS x FROM embeddings),
  ranges AS (SELECT CAST(label AS BIGINT) AS label, min(x) AS pmin, max(x) AS pmax, count(*) AS n_samples
    FROM v GROUP BY ALL),
  b AS (SELECT *, 65534.0::DOUBLE / (pmax - pmin) AS slope FROM ranges),
  r AS (SELECT *, CASE WHEN pmin > 0 THEN ceil(-32767 - slope * pmin) ELSE floor(-32767 - slope * pmin) END AS base FROM b),
  gains AS (SELECT *, CASE WHEN base <> -32767 THEN (-32767 - base) / pmin ELSE slope END AS gain FROM r)"""


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embeddings as waveform rows: one channel per label."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("label").cast("bigint").alias("label"),
        F.concat(F.lit("CH"), "label").alias("channel"),
        F.lit("H").alias("hospital"),
        (F.col("vec_id") * 10**9).alias("start_t_ns"),
        F.col("embedding").cast("array<double>").alias("values_num"),
        F.lit("").alias("UoM"),
        F.lit(4.0).alias("pd_samp_ms"),
        "vec_id",
    )


@query(f"WITH {_SAMPLES_SQL} SELECT label, pmin, pmax, n_samples FROM ranges")
def channel_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return waveform.channel_range(vectors(spark, sf_dir), ["label"])


@query(
    f"""WITH {_SAMPLES_SQL}
    SELECT label, round(gain, 6) AS adc_gain, CAST(base AS BIGINT) AS baseline FROM gains"""
)
def channel_gains(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gain and baseline that map each channel onto 16 bits."""
    gains = waveform.add_gain(waveform.channel_range(vectors(spark, sf_dir), ["label"]))
    return gains.select("label", F.round("adc_gain", 6).alias("adc_gain"), "baseline")


@query(
    """SELECT channel, pmin, pmax, CASE WHEN pmin > -128 AND pmax <= 127 THEN '80' WHEN pmin > -512 AND pmax <= 511 THEN '311'
      WHEN pmin > -2048 AND pmax <= 2047 THEN '212' WHEN pmin > -32768 AND pmax <= 32767 THEN '16'
      WHEN pmin > -8388608 AND pmax <= 8388607 THEN '24' ELSE '32' END AS fmt
    FROM (SELECT 'part' AS channel, CAST(min(l_partkey) AS DOUBLE) AS pmin, CAST(max(l_partkey) AS DOUBLE) AS pmax FROM lineitem
      UNION ALL SELECT 'line', min(l_linenumber), max(l_linenumber) FROM lineitem
      UNION ALL SELECT 'order', min(l_orderkey), max(l_orderkey) FROM lineitem
      UNION ALL SELECT 'balance', min(-l_orderkey), max(-l_orderkey) FROM lineitem)"""
)
def channel_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smallest storage format of whole-number channels."""
    rows = table(spark, sf_dir, "lineitem").select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(name).alias("channel"), F.array(c.cast("double")).alias("values_num"))
                    for name, c in {
                        "part": F.col("l_partkey"), "line": F.col("l_linenumber"),
                        "order": F.col("l_orderkey"), "balance": -F.col("l_orderkey"),
                    }.items()
                ]
            )
        )
    )
    ranges = waveform.channel_range(rows, ["channel"])
    return waveform.add_format(ranges, integral=True).select("channel", "pmin", "pmax", "fmt")


@query(
    f"""WITH {_SAMPLES_SQL}, base AS (SELECT CAST(label AS BIGINT) AS label, min(vec_id) AS first FROM embeddings GROUP BY ALL)
    SELECT label, 'CH' || label AS channel, 'R_' || first AS record_name, CAST(1 AS BIGINT) AS n_sig,
      250.0::DOUBLE AS fs, 'mV' AS units, '16' AS fmt, round(gain, 6) AS adc_gain, CAST(base AS BIGINT) AS baseline,
      n_samples FROM gains JOIN base USING (label)"""
)
def record_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header rows of waveform records, one record per label."""
    headers = waveform.record_headers(vectors(spark, sf_dir), ["label"], prefix=F.lit("R"))
    return headers.select(
        "label", "channel", "record_name", "n_sig", "fs", "units", "fmt",
        F.round("adc_gain", 6).alias("adc_gain"), "baseline", "n_samples",
    )


@query(
    f"""WITH {_SAMPLES_SQL}
    SELECT vec_id, CAST(v.label AS BIGINT) AS label,
      CAST(sum(CAST(round_even(x * gain + base, 0) AS BIGINT)) AS BIGINT) AS digital_sum,
      CAST(min(round_even(x * gain + base, 0)) AS BIGINT) AS digital_min, count(*) AS n
    FROM v JOIN gains ON v.label = gains.label GROUP BY ALL"""
)
def record_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digital samples of waveform records."""
    rows = vectors(spark, sf_dir)
    headers = waveform.record_headers(rows, ["label"], prefix=F.lit("R"))
    digital = waveform.record_samples(rows, headers, ["label"])
    zero = F.lit(0).cast("bigint")
    return digital.select(
        "vec_id", "label", F.aggregate("digital", zero, lambda a, v: a + v).alias("digital_sum"),
        F.array_min("digital").alias("digital_min"), F.size("digital").cast("bigint").alias("n"),
    )


@query(
    f"""WITH {_SAMPLES_SQL}
    SELECT CAST(label AS BIGINT) AS label, n_samples, n_samples AS written, '16' AS fmt FROM gains"""
)
def exported_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header and sample tables of records written and read back: samples per record in both."""
    path = scratch_dir(spark)
    rows = vectors(spark, sf_dir).withColumns({"bed_unit": F.lit("U"), "bed_id": F.concat(F.lit("B"), F.col("label") % 3)})
    records.export_records(rows, path, ["label"], prefix=F.lit("R"))
    headers = spark.read.parquet(f"{path}/headers").select("label", "n_samples", "fmt")
    samples = spark.read.parquet(f"{path}/samples").groupBy("label").agg(F.sum(F.size("digital")).alias("written"))
    return headers.join(samples, "label")


@query(
    """SELECT lang, fmt, count(*) AS n, CAST(lo AS BIGINT) AS low, CAST(hi AS BIGINT) AS high, CAST(bad AS BIGINT) AS invalid
    FROM documents JOIN (VALUES (0, '80', -128, 127, -128), (1, '212', -2048, 2047, -2048), (2, '16', -32768, 32767, -32768),
      (3, '24', -8388608, 8388607, -8388608), (4, '32', -2147483648, 2147483647, -2147483648),
      (5, '8', -2147483648, 2147483647, NULL)) f(k, fmt, lo, hi, bad) ON strlen(text) % 6 = k GROUP BY ALL"""
)
def digital_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digital ranges of formats, the format picked by the bytes of each text; `8` has no value for missing samples."""
    kind = F.octet_length("text") % 6
    fmt = F.lit("8")
    for n, name in enumerate(("80", "212", "16", "24", "32")):
        fmt = F.when(kind == n, F.lit(name)).otherwise(fmt)
    rows = table(spark, sf_dir, "documents").select("lang", fmt.alias("fmt"), wave.digital_range(fmt).alias("r"))
    return rows.groupBy("lang", "fmt").agg(
        F.count(F.lit(1)).alias("n"), F.max("r.digital_min").alias("low"), F.max("r.digital_max").alias("high"),
        F.max("r.invalid").cast("bigint").alias("invalid"),
    )


@query(
    """WITH r AS (SELECT user_id % 3 AS rec, 'A' AS ch, event_id * 4 + event_id % 3 AS s, 2 AS rate, 6 AS n, event_id % 100 AS v FROM events
      UNION ALL SELECT user_id % 3, 'B', event_id * 4 + event_id % 3, 1, 3, event_id % 50 + 100 FROM events WHERE event_id % 5 <> 0),
    base AS (SELECT rec, min(s) AS b FROM r GROUP BY rec),
    x AS (SELECT rec, ch, rate, s, (s - b) * rate + unnest(range(n)) AS pos, v + unnest(range(n)) AS val FROM r JOIN base USING (rec)),
    w AS (SELECT rec, ch, rate, pos, arg_min(val, s) AS val FROM x GROUP BY rec, ch, rate, pos),
    blocks AS (SELECT DISTINCT rec, pos // (8 * rate) AS block FROM w),
    cells AS (SELECT rec, ch, rate, block, unnest(range(8 * rate)) AS k FROM blocks JOIN (SELECT DISTINCT rec, ch, rate FROM r) USING (rec))
    SELECT CAST(c.rec AS BIGINT) AS record, c.ch AS channel, CAST(block AS BIGINT) AS block, CAST(8 * block AS BIGINT) AS first_frame,
      1.0::DOUBLE AS frame_rate, CAST(c.rate AS BIGINT) AS samples_per_frame, string_agg(CAST(coalesce(val, -32768) AS VARCHAR), ',' ORDER BY k) AS samples
    FROM cells c LEFT JOIN w ON w.rec = c.rec AND w.ch = c.ch AND w.pos = block * 8 * c.rate + k GROUP BY c.rec, c.ch, block, c.rate"""
)
def record_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames of records with channels of two rates, holes between rows and rows that overlap."""
    n = F.col("event_id")

    def rows_of(channel: str, period: float, size: int, first: Column) -> DataFrame:
        return spread(table(spark, sf_dir, "events"), "event_id", rows=4 * TASK_ROWS).select(
            (F.col("user_id") % 3).cast("bigint").alias("record"), F.lit(channel).alias("channel"), F.lit("mV").alias("UoM"),
            ((n * 4 + n % 3) * 10**9).alias("start_t_ns"), F.lit(period).alias("pd_samp_ms"), "event_id",
            F.transform(F.sequence(F.lit(0), F.lit(size - 1)), lambda j: (first + j).cast("double")).alias("values_num"),
        )

    rows = rows_of("A", 500.0, 6, n % 100).unionByName(rows_of("B", 1000.0, 3, n % 50 + 100).where(n % 5 != 0))
    headers = waveform.record_headers(rows, ["record"]).withColumns({"adc_gain": F.lit(1.0), "baseline": F.lit(0).cast("bigint")})
    frames = waveform.record_frames(rows, headers, ["record"], block_frames=8)
    return frames.select("record", "channel", "block", "first_frame", "frame_rate", "samples_per_frame", F.array_join("digital", ",").alias("samples"))
