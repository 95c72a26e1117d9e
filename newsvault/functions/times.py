"""Compact timestamps, weeks and days; zone-free throughout."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from newsvault.constants import TICK_MINUTES

_COMPACT = r"^(\d{4})(\d{2})(\d{2})(\d{2})(\d{2})(\d{2})$"


def ts_lit(value: datetime | str) -> Column:
    """A TIMESTAMP_NTZ literal."""
    text = value if isinstance(value, str) else value.isoformat(sep=" ")
    return F.lit(text).cast("timestamp_ntz")


def date_lit(value: date | str) -> Column:
    return F.lit(str(value)).cast("date")


def parse_compact_ts(c: Column) -> Column:
    """yyyyMMddHHmmss text to TIMESTAMP_NTZ; anything else becomes NULL."""
    dashed = F.regexp_replace(c, _COMPACT, "$1-$2-$3 $4:$5:$6")
    return F.when(c.rlike(_COMPACT), dashed.try_cast("timestamp_ntz"))


def compact_ts(ts: Column) -> Column:
    """TIMESTAMP_NTZ to the long yyyyMMddHHmmss."""
    return F.date_format(ts, "yyyyMMddHHmmss").cast("long")


def next_tick(file_ts: Column) -> Column:
    """The feed tick after a long yyyyMMddHHmmss."""
    step = F.expr(f"INTERVAL {TICK_MINUTES} MINUTES")
    return compact_ts(parse_compact_ts(file_ts.cast("string")) + step)


def week_start(ts: Column) -> Column:
    """Monday 00:00 of the week; built from dates so no zone conversion is involved."""
    day = ts.cast("date")
    return F.date_sub(day, F.weekday(day)).cast("timestamp_ntz")


def utc_instant(ts: Column) -> Column:
    """The instant at which a UTC clock shows this zone-free time."""
    return F.concat(ts.cast("string"), F.lit("Z")).cast("timestamp")


def utc_day(instant: Column) -> Column:
    """The UTC day of an instant, whatever the session zone."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(instant) / 86_400).cast("int"))


def days_behind(last_day: Column, today: Column) -> Column:
    return F.date_diff(today, last_day)
