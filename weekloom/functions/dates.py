"""Calendar columns: parsing, week starts and week labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Position of the weekday a week may start on, Monday first.
ANCHORS = {"MON": 0, "TUE": 1, "WED": 2, "THU": 3, "FRI": 4, "SAT": 5, "SUN": 6}

# One-letter fields accept both padded and unpadded numbers.
ISO_DAY = "yyyy-M-d"
US_DAY = "M/d/yyyy"


def parse_day(col: Column | str, fmt: str = ISO_DAY, strict: bool = True) -> Column:
    """Text to DATE.  ``strict`` fails the job on a bad value, otherwise it becomes NULL."""
    col = _column(col)
    parsed = F.to_date(col, fmt) if strict else F.try_to_date(col, fmt)
    if fmt != ISO_DAY:
        return parsed
    # A cast reads a plain day several times faster than a format does.
    quick = col.cast("date") if strict else col.try_cast("date")
    return F.when(col.rlike(r"\A\d{4}-\d\d-\d\d\z"), quick).otherwise(parsed)


def parse_moment(col: Column | str) -> Column:
    """Text of any ISO day or timestamp to TIMESTAMP_NTZ, NULL where it cannot be read."""
    return _column(col).try_cast("timestamp_ntz")


def week_start(col: Column | str, anchor: str = "MON", keep_time: bool = False) -> Column:
    """First day of the week holding ``col``, weeks starting on ``anchor``.

    Returns a DATE.  With ``keep_time`` the time of day survives, so that two moments of one
    week fall into different groups unless their times agree.
    """
    if anchor not in ANCHORS:
        raise ValueError(f"anchor must be one of {sorted(ANCHORS)}, got {anchor!r}")
    col, shift = _column(col), ANCHORS[anchor]
    if keep_time:
        days_in = F.pmod(F.weekday(col) - F.lit(shift), F.lit(7))
        return col.cast("timestamp_ntz") - F.make_dt_interval(days=days_in)
    if shift == 0:
        return F.trunc(col, "week")
    return F.date_add(F.trunc(F.date_sub(col, shift), "week"), shift)


def week_label(week: Column | str) -> Column:
    """``first/last`` day of the week starting at ``week``; the text ``NaT`` where it is NULL."""
    week = _column(week)
    label = F.concat(week.cast("string"), F.lit("/"), F.date_add(week, 6).cast("string"))
    return F.coalesce(label, F.lit("NaT"))


def read_week(col: Column | str) -> Column:
    """A stored week, given as a day, a timestamp or a ``first/last`` label, as TIMESTAMP_NTZ."""
    text = _column(col).cast("string")
    return F.coalesce(
        text.try_cast("timestamp_ntz"),
        F.split_part(text, F.lit("/"), F.lit(1)).try_cast("timestamp_ntz"),
    )


def _column(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col
