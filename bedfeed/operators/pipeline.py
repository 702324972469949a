"""File to observation rows, the whole way."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from bedfeed.operators.location import SiteTables, locate_messages
from bedfeed.operators.messages import parse_messages, quarantine, valid
from bedfeed.operators.observations import observations
from bedfeed.operators.patients import attribute_patient, patient_sightings
from bedfeed.operators.quality import verify_messages
from bedfeed.session import passing_scratch, scratch_dir, spread, write_scratch
from bedfeed.sources.feed import message_rows, scan_feed, split_messages
from bedfeed.sources.lines import line_messages
from bedfeed.sources.state import update_state


def located_messages(messages: DataFrame, site: SiteTables, depth: str = "signals") -> DataFrame:
    """Message texts to parsed messages with their location."""
    return locate_messages(parse_messages(messages, depth=depth), site)


def read_messages(
    spark: SparkSession, root: str, site: SiteTables, extension: str = ".hl7", separator: str | None = None,
    by_lines: bool = False,
) -> DataFrame:
    """A feed folder to parsed messages with their location. With a separator, or by lines, files are read by many tasks;
    by lines, they may have any mix of line ends, and the messages are parsed in tasks of a bounded number.

    Files read whole are one row each, so they should be small next to the memory of a task."""
    if by_lines:
        return located_messages(spread(line_messages(spark, root, extension), "path", "msg_idx"), site)
    files = scan_feed(spark, root, extension, separator)
    return located_messages(split_messages(files) if separator is None else message_rows(files), site)


def read_observations(
    spark: SparkSession, root: str, site: SiteTables, state_path: str | None = None,
    version: int | None = None, extension: str = ".hl7", separator: str | None = None, by_lines: bool = False,
) -> dict[str, DataFrame]:
    """A feed folder to its tables: ``observations``, ``sightings``, ``quarantine`` and ``quality``.

    Messages are parsed once: the parsed table is written to the scratch folder, and all results come from
    it. With ``state_path`` the patient state is advanced first, and blank patient columns of the
    observations are filled from it. Admission messages give sightings but no observations.
    """
    path = scratch_dir(spark)
    with passing_scratch(spark):  # runs of lines
        messages = write_scratch(read_messages(spark, root, site, extension, separator, by_lines), path, "zstd")
    sightings = patient_sightings(messages)
    rows = observations(messages)
    if state_path is not None:
        state = update_state(spark, state_path, sightings, version)
        rows = attribute_patient(rows, state.intervals)
    return {
        "observations": rows,
        "sightings": sightings,
        "quarantine": quarantine(messages),
        "quality": verify_messages(valid(messages)),
    }
