"""Event-time helpers: parsing, truncation, window bounds, age."""

from __future__ import annotations

import datetime as dt
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from streammart.schemas import TIME_FORMAT

YEAR_MS = 1000 * 60 * 60 * 24 * 365


def from_millis(ts: Column | str) -> Column:
    return F.timestamp_millis(_col(ts))


def whole_seconds(ts: Column | str) -> Column:
    """Epoch milliseconds to a timestamp cut to the second."""
    return F.timestamp_seconds(F.call_function("div", _col(ts), F.lit(1000)))


def parse_time(text: Column | str) -> Column:
    return F.to_timestamp(_col(text), TIME_FORMAT)


def time_text(ts: Column | str) -> Column:
    return F.date_format(_col(ts), TIME_FORMAT)


def day_number(ts: Column | str) -> Column:
    """The day as an integer such as 20240131."""
    return F.date_format(_col(ts), "yyyyMMdd").cast("int")


def today_number() -> int:
    """Today as such an integer, in the zone of the running session."""
    session = SparkSession.getActiveSession()
    zone = session.conf.get("spark.sql.session.timeZone") if session else None
    return int(dt.datetime.now(ZoneInfo(zone) if zone else None).strftime("%Y%m%d"))


def age_years(birthday: Column | str, as_of: Column) -> Column:
    """Whole 365-day years between a ``yyyy-MM-dd`` birthday and ``as_of``."""
    born = F.unix_millis(F.try_to_timestamp(_col(birthday), F.lit("yyyy-MM-dd")))
    return F.call_function("div", F.unix_millis(as_of) - born, F.lit(YEAR_MS)).cast("int")


def with_create_parts(df: DataFrame, create_time: str = "create_time") -> DataFrame:
    """Add the date part, the time part and the event time of a creation time.

    ``create_hour`` holds the whole time of day, as downstream users expect;
    ``create_hh`` holds the hour alone.
    """
    parts = F.split(F.col(create_time), " ")
    return df.withColumns(
        {
            "create_date": parts[0],
            "create_hour": parts[1],
            "create_hh": F.substring(parts[1], 1, 2),
            "event_time": parse_time(create_time),
        }
    )


def as_stream_time(df: DataFrame, event_time: str) -> DataFrame:
    """Watermarks need a timestamp with zone; a plain one is cast on streams only."""
    if df.isStreaming and dict(df.dtypes)[event_time] == "timestamp_ntz":
        return df.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return df


def interval(text: str) -> Column:
    """A duration such as ``"-5 seconds"`` as an interval column."""
    count, unit = _split_duration(text)
    return F.expr(f"INTERVAL '{count}' {unit}")


_UNIT_SECONDS = {"SECOND": 1, "MINUTE": 60, "HOUR": 3600, "DAY": 86400}


def seconds(text: str) -> int:
    """A duration such as ``"10 seconds"`` in seconds."""
    count, unit = _split_duration(text)
    return count * _UNIT_SECONDS[unit]


def _split_duration(text: str) -> tuple[int, str]:
    count, unit = text.split()
    unit = unit.rstrip("s").upper()
    if unit not in _UNIT_SECONDS:
        raise ValueError(f"unknown duration unit in {text!r}")
    return int(count), unit


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
