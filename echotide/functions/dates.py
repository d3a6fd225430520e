"""Dates: the formats the feeds use, read and written in UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (shape of the leading part that counts, pattern it is read with).
_ISO = (r"^\d{4}-\d{2}-\d{2}", "yyyy-MM-dd")
_MONTH_NAME = (r"^[A-Za-z]{3} \d{1,2}, \d{4}", "MMM d, yyyy")
_DMY = (r"^\d{2}/\d{2}/\d{4}", "dd/MM/yyyy")
DATE_SHAPES = (_ISO, _MONTH_NAME, _DMY)

_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$"
# Seconds of the years 1 to 9999, the range in which a timestamp can be written.
_FIRST_SECOND, _LAST_SECOND = -62135596800, 253402300799


def parse_epoch_or_iso(c: Column) -> Column:
    """Seconds since the epoch (fraction cut off) or an ISO text holding a ``T``.

    The result is a timestamp on whole seconds; null where the text is neither.
    """
    text = c.cast("string")
    iso = F.timestamp_seconds(F.unix_seconds(F.try_to_timestamp(text).cast("timestamp")))
    seconds = F.when(text.rlike(_NUMBER), text).try_cast("double").try_cast("bigint")
    epoch = F.when(
        seconds.between(_FIRST_SECOND, _LAST_SECOND), F.timestamp_seconds(seconds)
    )
    return F.when(F.contains(text, F.lit("T")), iso).otherwise(epoch)


def _read(text: Column, pattern: str, when: Column) -> Column:
    """Read a date where ``when`` holds: a text of another shape would cost an exception."""
    return F.try_to_date(F.when(when, text), pattern)


def parse_date_any(c: Column, shapes=DATE_SHAPES) -> Column:
    """The date a text starts with, by the first shape that reads as a date."""

    def read(shape: str, pattern: str) -> Column:
        head = F.regexp_extract(c, shape, 0)
        return _read(F.initcap(head), pattern, head != "")

    return F.coalesce(*[read(*shape) for shape in shapes])


def parse_dmy(c: Column) -> Column:
    """DD/MM/YYYY, or the YYYY-MM-DD that collectors fall back to; both strict."""
    return F.coalesce(
        *[_read(c, pattern, c.rlike(f"{shape}$")) for shape, pattern in (_DMY, _ISO)]
    )


def format_dmy(c: Column) -> Column:
    """Timestamp or date as DD/MM/YYYY; null and anything up to the epoch give ``""``."""
    ts = c.cast("timestamp")
    return F.when(F.unix_seconds(ts) > 0, F.date_format(ts, "dd/MM/yyyy")).otherwise("")


def format_iso_utc(c: Column) -> Column:
    """Timestamp as ``yyyy-MM-ddTHH:mm:ssZ``; null and anything up to the epoch give ``""``."""
    ts = c.cast("timestamp")
    return F.when(
        F.unix_seconds(ts) > 0, F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    ).otherwise("")


def iso_wall_date(c: Column) -> Column:
    """The calendar date an ISO text shows, in its own offset and never shifted to UTC."""
    shape, pattern = _ISO
    return _read(F.substring(c, 1, 10), pattern, c.rlike(shape))


def wall_dmy(c: Column) -> Column:
    """``iso_wall_date`` as DD/MM/YYYY; other texts give their first ten characters."""
    return F.coalesce(
        F.date_format(iso_wall_date(c), "dd/MM/yyyy"), F.substring(c, 1, 10), F.lit("")
    )


def month(c: Column) -> Column:
    """First day of the calendar month."""
    return F.trunc(c, "MM")
