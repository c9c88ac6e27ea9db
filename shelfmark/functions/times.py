"""Time expressions. All results are zone-free ``TIMESTAMP_NTZ`` in UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfmark.config import CORRECTED, check_mode


def ntz(value: dt.datetime | str | Column) -> Column:
    """A UTC instant as a ``TIMESTAMP_NTZ`` literal that reaches file filters; columns pass through."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = dt.datetime.fromisoformat(value.replace("Z", "+00:00"))
    if value.tzinfo is not None:
        value = value.astimezone(dt.timezone.utc).replace(tzinfo=None)
    return F.expr(f"TIMESTAMP_NTZ '{value.isoformat(sep=' ')}'")


def epoch_seconds(col: Column) -> Column:
    """Seconds since 1970 with microseconds, independent of the session time zone."""
    return (col - ntz("1970-01-01")).cast("interval second").cast("decimal(20,6)")


def time_slice(col: Column, width_s: int) -> Column:
    return F.floor(epoch_seconds(col) / F.lit(width_s)).cast("bigint")


def plus_seconds(col: Column, seconds: Column | int | float) -> Column:
    seconds = seconds if isinstance(seconds, Column) else F.lit(seconds)
    return col + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), seconds.cast("decimal(18,6)"))


def ready_at(arrival: Column, delay_s: Column) -> Column:
    return plus_seconds(arrival, delay_s)


def iso_utc(col: Column) -> Column:
    """ISO 8601 text to UTC; null when it cannot be read."""
    local = F.try_to_timestamp(col).cast("timestamp_ntz")
    return F.convert_timezone(F.current_timezone(), F.lit("UTC"), local)


def token_valid(token: Column, expiration: Column, now: Column) -> Column:
    """A token counts while it is non-empty and its expiration, if any, lies strictly after ``now``."""
    return F.coalesce((token != "") & (expiration.isNull() | (expiration > now)), F.lit(False))


def from_text(ts: Column, mode: str) -> Column:
    """Lower bound of an incremental harvest as sent to the source; ``reference`` uses a 12-hour clock without zone."""
    pattern = "yyyy-MM-dd'T'HH:mm:ss'Z'" if check_mode(mode) == CORRECTED else "yyyy-MM-dd'T'hh:mm:ss"
    return F.date_format(ts, pattern)


def from_bound(ts: Column, mode: str) -> Column:
    """The instant which ``from_text`` denotes when it is read on a 24-hour clock in UTC."""
    text = F.regexp_replace(F.rtrim(from_text(ts, mode), F.lit("Z")), "T", " ")
    return text.cast("timestamp_ntz")
