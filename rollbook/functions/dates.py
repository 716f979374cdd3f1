"""Dates, time buckets and calendar parts."""

from pyspark.sql import functions as F

from ..fixed_values import BUCKET_UNITS


def ch_date(c):
    """``dd/MM/yyyy`` text to DATE; blank or malformed text gives NULL."""
    return F.try_to_date(F.trim(c), "dd/MM/yyyy")


def instant(c):
    """A point in time written either as epoch milliseconds or as an ISO text."""
    text = F.trim(c.cast("string"))
    epoch = F.when(text.rlike(r"^\d+$"), F.timestamp_millis(text.try_cast("bigint")))
    return F.coalesce(epoch, text.try_cast("timestamp"))


def bucket(c, unit):
    """Start of the minute, hour, day or month, without a time zone."""
    if unit not in BUCKET_UNITS:
        raise ValueError(f"Invalid time interval: {unit}")
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def dow0(c):
    """Day of the week with 0 for Sunday."""
    return (F.dayofweek(c) - 1).cast("bigint")


def hour_of(c):
    return F.hour(c).cast("bigint")


def day_name(c):
    """English day name, blank-padded to nine characters."""
    return F.rpad(F.date_format(c, "EEEE"), 9, " ")


def hour24(c):
    return F.date_format(c, "HH")


def repair_century(c):
    """``0006...`` was typed for ``2006...``; a date that starts with a blank is empty."""
    repaired = F.when(c.startswith("00"), F.concat(F.lit("2"), F.substring(c, 2, 99))).otherwise(c)
    return F.when(c.startswith(" ") | (c == ""), F.lit("")).otherwise(repaired)


def birth_date(full, partial):
    """(date text, is accurate): the full date if present, else the first of the known month."""
    is_full = ~(full.startswith(" ") | (full == ""))
    month = F.substring(partial, 1, 6)
    first = F.when(partial.startswith(" ") | (partial == ""), F.lit("")).otherwise(
        F.concat(month, F.lit("01"))
    )
    return F.when(is_full, repair_century(full)).otherwise(first), is_full
