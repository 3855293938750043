"""Time conversions. All assume the session time zone is UTC (see ``session.pin``)."""

from datetime import date, datetime, timezone

from pyspark.sql import Column, functions as F


def time_from_seconds(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def time_from_millis(millis: Column) -> Column:
    return F.timestamp_millis(millis)


def millis_to_seconds(millis: Column) -> Column:
    """Whole seconds, truncated toward zero also before 1970."""
    return F.call_function("div", millis, F.lit(1000).cast("bigint"))


def seconds_of_date(day: str) -> int:
    """Epoch seconds of midnight UTC of a ``YYYY-MM-DD`` date."""
    parsed = date.fromisoformat(day)
    return int(datetime(parsed.year, parsed.month, parsed.day, tzinfo=timezone.utc).timestamp())


def day_floor(time: Column) -> Column:
    return F.date_trunc("day", time)


def _text(time: Column, zone: str) -> Column:
    whole = F.unix_micros(time) % 1_000_000 == 0
    return F.concat(
        F.when(whole, F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss"))
        .otherwise(F.date_format(time, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")),
        F.lit(zone),
    )


def iso_text(time: Column) -> Column:
    """ISO-8601 with ``+00:00``; microseconds only when there are any."""
    return _text(time, "+00:00")


def odata_text(time: Column) -> Column:
    """The same instant as a query literal ending in ``Z``."""
    return _text(time, "Z")


def from_iso(text: Column) -> Column:
    """ISO-8601 text to an instant; unreadable text gives null."""
    return text.try_cast("timestamp")
