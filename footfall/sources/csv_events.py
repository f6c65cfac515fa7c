"""CSV exports of click events -> typed raw events."""

from __future__ import annotations

import logging
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from footfall.functions import null_words, remove_text
from footfall.schema import RAW_EVENTS

log = logging.getLogger(__name__)

# CSV header -> raw column. Edit when a feed names its columns otherwise.
COLUMN_MAP = {name: name for name in RAW_EVENTS}

ZONE_SUFFIX = " UTC"

# Holds a line whose number of fields is not that of the header, while it is read.
ODD_LINE = "_odd_line"
END_MARK = "\x01end"


def map_columns(header: Iterable[str], column_map: dict[str, str] = COLUMN_MAP) -> dict[str, str]:
    """The part of the map the header offers. Other header columns are dropped, absent ones
    are reported, and a header without any known column is an error."""
    header = list(header)
    present = {src: dst for src, dst in column_map.items() if src in header}
    if not present:
        raise ValueError(f"no known column in the CSV header {header}")
    missing = sorted(set(column_map) - set(header))
    if missing:
        log.warning("columns missing from the CSV, loaded as NULL: %s", missing)
    extra = sorted(set(header) - set(column_map))
    if extra:
        log.info("columns in the CSV that are not loaded: %s", extra)
    return present


def to_raw_events(text: DataFrame, column_map: dict[str, str] = COLUMN_MAP) -> DataFrame:
    """All-string columns -> the raw contract, matched by name.

    Ids go from text straight to BIGINT, so long ones keep every digit. A field that does not
    parse fails the job, as long as ANSI mode is on.
    """
    source_of = {dst: src for src, dst in map_columns(text.columns, column_map).items()}

    def typed(name: str, kind: str) -> Column:
        if name not in source_of:
            return F.lit(None).cast(kind).alias(name)
        field = null_words(F.col(f"`{source_of[name]}`"))
        if name == "event_time":
            field = remove_text(field, ZONE_SUFFIX)
        return field.cast(kind).alias(name)

    return text.select(*[typed(name, kind) for name, kind in RAW_EVENTS.items()])


def read_events_csv(
    spark: SparkSession,
    path: str,
    column_map: dict[str, str] = COLUMN_MAP,
    multi_line: bool = False,
) -> DataFrame:
    """Read a CSV file, or a folder of CSV files with one header layout, as raw events.

    Files are split, so one large file is read by many tasks. Quoted line breaks need
    ``multi_line``, which reads each file in one piece. ``enforceSchema`` off makes a file whose
    header differs from the others an error instead of shifting its columns. Lines with fewer
    fields than the header get NULLs, lines with more fail the job.
    """
    options = {"header": True, "quote": '"', "escape": '"', "enforceSchema": False, "multiLine": multi_line}
    header = spark.read.options(**options).csv(path).columns
    schema = StructType([StructField(name, StringType()) for name in [*header, ODD_LINE]])
    # All columns are parsed: with some left out the reader would not count a line's fields.
    options |= {"columnNameOfCorruptRecord": ODD_LINE, "columnPruning": False}
    text = spark.read.schema(schema).options(**options).csv(path)
    return to_raw_events(_no_surplus(text, header).drop(ODD_LINE), column_map)


def _no_surplus(text: DataFrame, header: list[str]) -> DataFrame:
    """The same rows; a line with more fields than the header fails the job.

    The reader sets aside lines with more fields and lines with fewer, which may stay: their
    missing fields are NULL. Such a line is parsed again with a mark behind its end, which is
    among the first fields, one more than the header has, unless there are surplus ones.
    """
    names = [f"f{i}" for i in range(len(header) + 1)]
    kinds = ", ".join(f"{name} string" for name in names)
    again = F.from_csv(
        F.concat(F.regexp_replace(ODD_LINE, r"[\r\n]+$", ""), F.lit("," + END_MARK)), kinds,
        {"quote": '"', "escape": '"', "multiLine": "true"},
    )
    marked = F.exists(F.array(*[again.getField(name) for name in names]), lambda field: field == END_MARK)
    # A query of the set-aside column alone is not allowed, so another one takes part.
    first = F.coalesce(F.substring(F.col(f"`{header[0]}`"), 1, 0), F.lit(""))
    complaint = F.concat(F.lit("CSV line with more fields than the header: "), ODD_LINE, first)
    surplus = F.col(ODD_LINE).isNotNull() & ~F.coalesce(marked, F.lit(False))
    return text.where(F.when(surplus, F.raise_error(complaint).cast("boolean")).otherwise(F.length(first) == 0))
