"""Wall-clock time to and from text, the same in every session time zone.

A timestamp with zone cannot hold the hour that daylight saving skips, so nothing here goes
through one.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkwell.functions.patterns import CALL_MOMENT_SHAPE, LOG_MONTHS

# First character and length of each part of an ISO timestamp text.
ISO_PARTS = {"yyyy": (1, 4), "MM": (6, 2), "dd": (9, 2), "HH": (12, 2), "mm": (15, 2), "ss": (18, 2)}


def part(moment: Column, letters: str) -> Column:
    """One part of a timestamp without zone, as text."""
    return F.substring(moment.cast("string"), *ISO_PARTS[letters])


def compact_text(moment: Column) -> Column:
    """``MMddHHmm``."""
    start = ISO_PARTS["MM"][0]
    return F.translate(F.substring(moment.cast("string"), start, len("MM-dd HH:mm")), "- :", "")


def log_text(moment: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss``."""
    month = F.element_at(F.array(*[F.lit(m) for m in LOG_MONTHS]), F.month(moment))
    day = F.concat_ws("/", F.lpad(F.day(moment).cast("string"), 2, "0"), month, F.year(moment).cast("string"))
    return F.concat_ws(":", day, F.substring(moment.cast("string"), ISO_PARTS["HH"][0], len("HH:mm:ss")))


def call_text(moment: Column) -> Column:
    """``MM/dd/yyyy hh:mm:ss a``."""
    hour = F.lpad(((F.hour(moment) + 11) % 12 + 1).cast("string"), 2, "0")
    time = F.concat_ws(":", hour, F.substring(moment.cast("string"), ISO_PARTS["mm"][0], len("mm:ss")))
    half = F.when(F.hour(moment) < 12, "AM").otherwise("PM")
    return F.concat_ws(" ", day_text(moment), time, half)


def day_text(moment: Column) -> Column:
    """``MM/dd/yyyy``."""
    return F.concat_ws("/", part(moment, "MM"), part(moment, "dd"), part(moment, "yyyy"))


def parse_day(text: Column, pattern: str) -> Column:
    """The start of the day; null where the text does not fit the pattern."""
    return F.try_to_date(text, pattern).cast("timestamp_ntz")


def parse_call_moment(text: Column) -> Column:
    """``MM/dd/yyyy hh:mm:ss a`` to a timestamp without zone; null where the text has another shape or no such time exists.

    The text is put into ISO order and cast once.
    """
    half_day = F.when(F.upper(F.substring(text, 21, 1)) == "P", 12).otherwise(0)
    hour = F.lpad((F.substring(text, 12, 2).try_cast("int") % 12 + half_day).cast("string"), 2, "0")
    day = F.concat_ws("-", F.substring(text, 7, 4), F.substring(text, 1, 2), F.substring(text, 4, 2))
    moment = F.concat(day, F.lit(" "), hour, F.substring(text, 14, 6))
    return F.when(text.rlike(CALL_MOMENT_SHAPE), moment.try_cast("timestamp_ntz"))


def parse_default(text: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` to a timestamp without zone, month and day with one digit or two; null for anything else."""
    return F.when(text.rlike(r"^\d{4}-\d{1,2}-\d{1,2}( \d{1,2}:\d{1,2}:\d{1,2}(\.\d+)?)?$"), text.try_cast("timestamp_ntz"))


def parse_log_stamp(text: Column) -> Column:
    """``dd/MMM/yyyy:HH:mm:ss`` to a timestamp without zone; null for a date that does not exist.

    The text is put into ISO order and cast, which costs far less than a pattern for each row.
    """
    month = F.array_position(F.array(*[F.lit(m) for m in LOG_MONTHS]), F.substring(text, 4, 3))
    day = F.concat_ws("-", F.substring(text, 8, 4), F.lpad(month.cast("string"), 2, "0"), F.substring(text, 1, 2))
    return F.concat_ws(" ", day, F.substring(text, 13, 8)).try_cast("timestamp_ntz")
