"""Streams that keep state by key and event time: patient intervals with corrections, and windows that close once.

Both are processors on Spark's state store (RocksDB), so a micro-batch reads and writes only the keys it has rows for.
Rows are reduced within their partitions before the shuffle, so a bed or a window with a third of all rows sends few.
"""

from __future__ import annotations

import json
from bisect import bisect_left, insort
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from bedfeed.operators.patients import BED, DAY_NS, ORDER, PERSON
from bedfeed.operators.quality import quality_codes, verify_messages

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"

INTERVAL = (
    "hospital string, bed_unit string, bed_id string, pid string, visit_id string, first_name string, "
    "last_name string, middle_initial string, start_ns bigint, end_ns bigint"
)
SIGHTING = (
    "hospital string, bed_unit string, bed_id string, pid string, visit_id string, first_name string, "
    "last_name string, middle_initial string, start_ns bigint, seg_id string, msg_idx bigint, sighting_idx bigint"
)
# Stands for a missing number, which pandas would make the others floats for; it comes first in order, as NULL does.
MISSING = -(1 << 63)
# First sightings that a task holds before it passes them on.
MAX_FIRSTS = 50_000


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """Streams started inside keep their state in RocksDB, which these processors need; the setting is put back."""
    before = spark.conf.get(_PROVIDER, None)
    spark.conf.set(_PROVIDER, ROCKSDB)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_PROVIDER)
        else:
            spark.conf.set(_PROVIDER, before)


def _plain(value):
    """A pandas cell as a plain Python value, None for all that is missing."""
    if value is None or value is pd.NA or value != value:
        return None
    return value.item() if hasattr(value, "item") else value


def _place(start: int, seg_id: str | None, msg_idx: int, sighting_idx: int, last) -> list:
    """A sighting's place in the order of a bed, as in a batch."""
    return [start, seg_id is not None, seg_id or "", msg_idx, sighting_idx, last]


def _rank(found: tuple) -> list:
    """The order of sightings of one patient: by place, then by what else is known."""
    return _place(*found[:4], [(v is not None, v or "") for v in found[4:]])


def _earliest(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The first sighting of every patient and bed in a task's rows; if these are too many patients, in runs of blocks."""
    order = ["start_ns", *ORDER, "visit_id", "first_name", "last_name", "middle_initial"]
    firsts: pd.DataFrame | None = None
    for block in rows:
        both = block if firsts is None else pd.concat([firsts, block])
        firsts = both.sort_values(order, na_position="first", kind="stable").drop_duplicates([*BED, "pid"])
        if len(firsts) > MAX_FIRSTS:
            yield firsts
            firsts = None
    if firsts is not None:
        yield firsts


class BedIntervals(StatefulProcessor):
    """Patients of a bed by first sighting.

    State: the first sighting of each patient, the places of a day's first sightings in order, and the days that have
    any. A new or earlier sighting touches its day, the day it leaves, and the neighbours across their edges.
    """

    def init(self, handle) -> None:
        person = "start_ns bigint, seg_id string, msg_idx bigint, sighting_idx bigint, visit_id string, first_name string, last_name string, middle_initial string"
        self.firsts = handle.getMapState("firsts", "pid string", person)
        self.by_day = handle.getMapState("by_day", "day bigint", "places string")
        self.days = handle.getValueState("days", "days string")

    def _first(self, pid: str) -> tuple | None:
        return tuple(self.firsts.getValue((pid,))) if self.firsts.containsKey((pid,)) else None

    def _day(self, day: int) -> list:
        if day not in self.open:
            self.open[day] = json.loads(self.by_day.getValue((day,))[0]) if self.by_day.containsKey((day,)) else []
        return self.open[day]

    @staticmethod
    def _day_of(start: int) -> int:
        return start // DAY_NS

    def _neighbour(self, day: int, at: int, step: int) -> list | None:
        """The place before or after position ``at`` of a day, in other days if need be."""
        places = self._day(day)
        if 0 <= at + step < len(places):
            return places[at + step]
        k = bisect_left(self.known, day)
        k = k + step if k < len(self.known) and self.known[k] == day else k - (step < 0)
        while 0 <= k < len(self.known):
            if places := self._day(self.known[k]):
                return places[0 if step > 0 else -1]
            k += step
        return None

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        self.open: dict[int, list] = {}
        stored = self.days.get() if self.days.exists() else None
        self.known = json.loads(stored[0]) if stored else []
        changed: set[str] = set()
        seen: dict[str, tuple] = {}
        rest = ("visit_id", "first_name", "last_name", "middle_initial")
        for block in rows:
            for row in block.itertuples(index=False):
                found = tuple(_plain(getattr(row, c)) for c in ("start_ns", *ORDER, *rest))
                if row.pid not in seen or _rank(found) < _rank(seen[row.pid]):
                    seen[row.pid] = found
        for pid, found in seen.items():
            known = self._first(pid)
            place = _place(*found[:4], pid)
            if known is not None:
                if _rank(known) <= _rank(found):
                    continue
                old = _place(*known[:4], pid)
                day = self._day_of(known[0])
                at = bisect_left(self._day(day), old)
                before = self._neighbour(day, at, -1)
                if before is not None:
                    changed.add(before[-1])
                self._day(day).pop(at)
            day = self._day_of(found[0])
            insort(self._day(day), place)
            if (k := bisect_left(self.known, day)) == len(self.known) or self.known[k] != day:
                self.known.insert(k, day)
            before = self._neighbour(day, bisect_left(self._day(day), place), -1)
            if before is not None:
                changed.add(before[-1])
            changed.add(pid)
            self.firsts.updateValue((pid,), found)
        for day, places in self.open.items():
            if places:
                self.by_day.updateValue((day,), (json.dumps(places),))
            elif self.by_day.containsKey((day,)):
                self.by_day.removeKey((day,))
        self.known = [d for d in self.known if d not in self.open or self.open[d]]
        self.days.update((json.dumps(self.known),))
        out = []
        for pid in sorted(changed):
            first = self._first(pid)
            day = self._day_of(first[0])
            after = self._neighbour(day, bisect_left(self._day(day), _place(*first[:4], pid)), 1)
            end = MISSING if after is None else after[0]
            out.append((*key, pid, *first[4:], *[None if t == MISSING else t for t in (first[0], end)]))
        frame = pd.DataFrame(out, columns=[*BED, *PERSON, "start_ns", "end_ns"], dtype=object)
        yield frame.astype({"start_ns": "Int64", "end_ns": "Int64"})

    def close(self) -> None:
        pass


def stream_bed_intervals(sightings: DataFrame) -> DataFrame:
    """Patient intervals that a stream of sightings opens, closes or corrects; update mode, one row per change.

    The newest row of a bed and patient counts. A first sighting closes the interval before it; one that comes late
    also moves its own start and the ends around it, so the newest rows are always what ``patient_intervals`` gives for
    all sightings so far. Only beds with sightings in the micro-batch are looked at, and of these only the days that
    change. State grows by one entry per bed and patient. Blank and NULL ids count as one; sightings without a time come
    first. Start the query inside ``rocksdb``.
    """
    rows = sightings
    for c, kind in zip(ORDER, ("string", "bigint", "bigint"), strict=True):
        rows = rows.withColumn(c, F.col(c).cast(kind) if c in sightings.columns else F.lit(None).cast(kind))
    filled = {c: F.coalesce(c, F.lit(MISSING)) for c in ("start_ns", "msg_idx", "sighting_idx")}
    rows = rows.withColumns({**filled, "pid": F.coalesce("pid", F.lit(""))}).select(*BED, *PERSON, "start_ns", *ORDER)
    return rows.mapInPandas(_earliest, SIGHTING).groupBy(*BED).transformWithStateInPandas(
        BedIntervals(), outputStructType=INTERVAL, outputMode="Update", timeMode="None"
    )


def write_bed_intervals(changes: DataFrame, path: str, checkpoint: str, available_now: bool = False) -> StreamingQuery:
    """Keep the changes of every micro-batch under its number; a batch that is repeated replaces its own."""

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path.rstrip('/')}/v={number}")

    writer = changes.writeStream.foreachBatch(keep).outputMode("update").option("checkpointLocation", checkpoint)
    with rocksdb(changes.sparkSession):
        return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_bed_intervals(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The newest interval of each bed and patient, of all micro-batches or those up to one."""
    rows = spark.read.schema(f"{INTERVAL}, v bigint").parquet(path)
    if upto is not None:
        rows = rows.where(F.col("v") <= upto)
    rest = [c for c in (*PERSON, "start_ns", "end_ns") if c != "pid"]
    newest = F.max(F.struct("v", *rest)).alias("n")
    return rows.groupBy(*BED, "pid").agg(newest).select(*BED, "pid", *[F.col(f"n.{c}").alias(c) for c in rest])


COUNT = "window_ms bigint, code string, messages bigint"
WINDOW_COUNT = "window_ms bigint, code string, status string, messages bigint"


def _counted(rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for block in rows:
        yield block.groupby(["window_ms", "code"], dropna=False, as_index=False)["messages"].sum()


def closed_windows(rows: DataFrame, width_ms: int) -> DataFrame:
    """(window_ms, code, status, messages) of a stream (window_ms, code, messages) that has a watermark but no longer its
    time: Spark would drop late rows before they can be counted."""
    rows = rows.withColumn("window_ms", F.coalesce("window_ms", F.lit(MISSING)))
    return rows.mapInPandas(_counted, COUNT).groupBy("window_ms", "code").transformWithStateInPandas(
        ClosingWindows(width_ms), outputStructType=WINDOW_COUNT, outputMode="Append", timeMode="EventTime"
    )


class ClosingWindows(StatefulProcessor):
    """Counts per window and code: held until the watermark passes the window's end, then given out and forgotten."""

    def __init__(self, width_ms: int) -> None:
        self.width = width_ms

    def init(self, handle) -> None:
        self.handle = handle
        self.count = handle.getValueState("messages", "messages bigint")

    def _row(self, key, status: str, messages: int) -> pd.DataFrame:
        window = None if key[0] == MISSING else key[0]
        frame = pd.DataFrame({"window_ms": [window], "code": [key[1]], "status": [status], "messages": [messages]})
        return frame.astype({"window_ms": "Int64"})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        found = sum(int(block["messages"].sum()) for block in rows)
        window = int(key[0])
        if window == MISSING:
            yield self._row(key, "untimed", found)
        elif window + self.width <= timerValues.getCurrentWatermarkInMs():
            yield self._row(key, "late", found)
        else:
            if self.count.exists():
                found += self.count.get()[0]
            else:
                self.handle.registerTimer(window + self.width)
            self.count.update((found,))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        if self.count.exists():
            found = self.count.get()[0]
            self.count.clear()
            yield self._row(key, "closed", found)

    def close(self) -> None:
        pass


def stream_closed_quality(
    messages: DataFrame, window_ms: int = 60_000, delay: str = "10 minutes", check_start_times: bool = False
) -> DataFrame:
    """(window_ms, code, status, messages): windows by event time, each given out once, and what belongs to none.

    A window is ``closed`` when the largest message time minus the delay has passed its end; its state is then gone.
    Messages for a window that has been passed are counted as ``late``, those without a time as ``untimed`` (no window),
    per micro-batch. So every message is counted once, but for those of windows still open. Append mode; start the query
    inside ``rocksdb``.
    """
    codes = quality_codes(verify_messages(messages, check_start_times)).withColumn(
        "msh_time", F.timestamp_micros(F.call_function("div", F.col("msh_time_ns"), F.lit(1000)))
    )
    at = F.unix_millis("msh_time")
    rows = codes.withWatermark("msh_time", delay).select(
        (at - F.pmod(at, F.lit(window_ms))).alias("window_ms"), "code", F.lit(1).cast("bigint").alias("messages")
    )
    return closed_windows(rows, window_ms)
