"""Text to typed values. Nothing here throws: what does not read becomes NULL,
and the quality checks report the rows."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBER = "decimal(18,4)"

_CLOCK = r"^([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d)?$"


def to_number(c: Column, type_name: str = NUMBER) -> Column:
    return F.trim(c).try_cast(type_name)


def exact_number(c: Column, type_name: str = NUMBER) -> Column:
    """The number, unless the type would drop digits of it."""
    number = to_number(c, type_name)
    return F.when(number == F.trim(c).try_cast("decimal(38,18)"), number)


def to_day(c: Column) -> Column:
    """``yyyy-MM-dd`` text. The cast alone would take more forms; it is much
    faster than a formatter, so the form is tested beside it."""
    text = F.trim(c)
    form = (
        (F.length(text) == 10)
        & (F.substring(text, 5, 1) == "-")
        & (F.substring(text, 8, 1) == "-")
    )
    return F.when(form, text.try_cast("date"))


def to_clock(c: Column) -> Column:
    """``HH:mm:ss`` text, seconds optional on input."""
    text = F.trim(c)
    full = F.when(F.length(text) <= 5, F.concat(text, F.lit(":00"))).otherwise(text)
    return F.when(text.rlike(_CLOCK), F.lpad(full, 8, "0"))


def stamp_day(c: Column) -> Column:
    """Characters 1 to 10 of a timestamp text, as a date."""
    return to_day(F.substring(c, 1, 10))


def stamp_clock(c: Column) -> Column:
    """Characters 12 to 19 of a timestamp text, as ``HH:mm:ss``."""
    return to_clock(F.substring(c, 12, 8))


def compact_day(c: Column) -> Column:
    """First eight characters of ``yyyyMMddHHmmss``, as a date."""
    return to_day(
        F.concat_ws("-", F.substring(c, 1, 4), F.substring(c, 5, 2), F.substring(c, 7, 2))
    )


def compact_clock(c: Column) -> Column:
    """Time part of ``yyyyMMddHHmmss``; midnight when the text stops at the day."""
    part = F.rpad(F.substring(c, 9, 6), 6, "0")
    return to_clock(
        F.concat_ws(":", F.substring(part, 1, 2), F.substring(part, 3, 2), F.substring(part, 5, 2))
    )


def to_stamp(c: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text as the plant's own time, in no zone."""
    text = F.trim(c)
    form = (
        (F.length(text) == 19)
        & to_day(F.substring(text, 1, 10)).isNotNull()
        & (F.substring(text, 11, 1) == " ")
        & (F.substring(text, 14, 1) == ":")
        & (F.substring(text, 17, 1) == ":")
    )
    return F.when(form, text.try_cast("timestamp_ntz"))


def as_typed(c: Column, kind: str) -> Column:
    """Text to the core type ``kind`` (string, date, timestamp_ntz or a decimal)."""
    if kind == "date":
        return to_day(c)
    if kind == "timestamp_ntz":
        return to_stamp(c)
    if kind.startswith("decimal"):
        return to_number(c, kind)
    return c


def load_stamp(load_ts) -> Column:
    """The load time, one constant per job and whole seconds."""
    return F.date_trunc("second", F.lit(load_ts).cast("timestamp"))
