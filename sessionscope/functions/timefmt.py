"""Time parsing, formatting and keys.

Inside the library times are ``timestamp_ntz`` (wall-clock time without a
zone, like the action-time text they come from), so no result depends on
the session time zone except where text is parsed. Text forms are cut from
the zone-free ``CAST(ts AS STRING)``: ``date_format`` would pass an NTZ
value through the session zone, and in a daylight-saving zone a wall-clock
time inside the spring-forward gap (02:30) would print as 03:30.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats of the action log and of the derived keys.
ACTION_TIME_FORMAT = "yyyy-M-d H:m:s"   # every field but the year may be one digit
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"
DATE_HOUR_FORMAT = "yyyy-MM-dd_HH"
DATE_KEY_FORMAT = "yyyyMMdd"
MINUTE_KEY_FORMAT = "yyyyMMddHHmm"


def parse_action_time(text: Column) -> Column:
    """Action-time text to ``timestamp_ntz``; NULL when it does not parse.

    Accepts one- or two-digit fields and ignores a fraction of a second;
    out-of-range fields (minute 61) give NULL instead of rolling over. ``try_to_timestamp`` only screens the text
    (it would resolve the wall clock in the session zone); the value comes
    from the zone-free ``to_timestamp_ntz``, evaluated only for valid text.
    """
    text = F.substring_index(text, ".", 1)
    fmt = F.lit(ACTION_TIME_FORMAT)
    return F.when(F.try_to_timestamp(text, fmt).isNotNull(), F.to_timestamp_ntz(text, fmt))


def _wall_clock(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` of a timestamp_ntz, without any zone."""
    return F.substring(ts.cast("timestamp_ntz").cast("string"), 1, 19)


def format_time(ts: Column) -> Column:
    """``yyyy-MM-dd HH:mm:ss`` text of a time."""
    return _wall_clock(ts)


def format_action_time(ts: Column) -> Column:
    """``yyyy-MM-dd H:mm:ss`` text (one-digit hours), the action log's form."""
    text = _wall_clock(ts)
    return F.concat(F.substring(text, 1, 11), F.hour(ts).cast("string"), F.substring(text, 14, 6))


def format_date(d: Column) -> Column:
    """``yyyy-MM-dd`` text of a date (or of a time's date)."""
    return d.cast("date").cast("string")


def date_hour(ts: Column) -> Column:
    """``yyyy-MM-dd_HH`` bucket key of a time (hour zero-padded)."""
    text = _wall_clock(ts)
    return F.concat(F.substring(text, 1, 10), F.lit("_"), F.substring(text, 12, 2))


def date_key(ts: Column) -> Column:
    """``yyyyMMdd`` day key."""
    return F.replace(F.substring(_wall_clock(ts), 1, 10), F.lit("-"), F.lit(""))


def parse_date_key(key: Column) -> Column:
    """``yyyyMMdd`` key back to a date; NULL when malformed."""
    return F.try_to_timestamp(key, F.lit(DATE_KEY_FORMAT)).cast("timestamp_ntz").cast("date")


def minute_key(ts: Column) -> Column:
    """``yyyyMMddHHmm`` minute key."""
    text = _wall_clock(ts)
    return F.concat(date_key(ts), F.substring(text, 12, 2), F.substring(text, 15, 2))


def seconds_between(earlier: Column, later: Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``, truncated toward zero
    (NULL if either is NULL). ``timestamp_ntz`` subtraction is zone-free;
    ``timestampdiff`` would route both values through the session zone."""
    iv = later.cast("timestamp_ntz") - earlier.cast("timestamp_ntz")
    total = (F.extract(F.lit("DAY"), iv) * 86400 + F.extract(F.lit("HOUR"), iv) * 3600
             + F.extract(F.lit("MINUTE"), iv) * 60 + F.extract(F.lit("SECOND"), iv))
    return total.cast("long")


def time_before(t1: Column, t2: Column) -> Column:
    """``t1`` strictly before ``t2``; false when either is unknown."""
    return F.coalesce(t1 < t2, F.lit(False))


def time_after(t1: Column, t2: Column) -> Column:
    """``t1`` strictly after ``t2``; false when either is unknown."""
    return F.coalesce(t1 > t2, F.lit(False))


def today() -> Column:
    """Today as ``yyyy-MM-dd`` text (session time zone)."""
    return format_date(F.current_date())


def yesterday() -> Column:
    """Yesterday as ``yyyy-MM-dd`` text (session time zone)."""
    return format_date(F.date_sub(F.current_date(), 1))
