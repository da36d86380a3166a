"""Time keys: epoch minutes as columns, hour and day arithmetic for job arguments."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column
from pyspark.sql import functions as F

HOUR_FORMAT = "%Y-%m-%d-%H"
DAY_FORMAT = "%Y-%m-%d"


def epoch_minute(col: Column, fmt: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """Text time -> minutes since the epoch, the text read as UTC; NULL when it does not parse.

    The text is cut to the length of the format, so fractions and other trailing
    text do no harm. It is read once, as a time of UTC.
    """
    plain = F.substring(col, 1, len(fmt))
    # With its offset in the text the parser names the instant, whatever the session zone.
    at = F.try_to_timestamp(F.concat(plain, F.lit("+00:00")), F.lit(fmt + "xxx"))
    return F.floor(F.unix_seconds(at) / 60)


def _day_start(day: Column) -> Column:
    return F.unix_date(F.to_date(day)).cast("bigint") * (24 * 60)


def slot_minute(slot: str) -> int:
    """Epoch minute at which an hour slot ``yyyy-MM-dd-HH`` (UTC) starts."""
    at = datetime.strptime(slot, HOUR_FORMAT).replace(tzinfo=timezone.utc)
    return int(at.timestamp() // 60)


def day_minute(day: str) -> int:
    """Epoch minute at which a day ``yyyy-MM-dd`` (UTC) starts."""
    at = datetime.strptime(day, DAY_FORMAT).replace(tzinfo=timezone.utc)
    return int(at.timestamp() // 60)


def hour_list(start: str, span: int) -> list[str]:
    """``span`` hour slots from ``start`` on."""
    first = datetime.strptime(start, HOUR_FORMAT)
    return [(first + timedelta(hours=i)).strftime(HOUR_FORMAT) for i in range(span)]


def hours_before(slot: str, hours: int) -> str:
    return (datetime.strptime(slot, HOUR_FORMAT) - timedelta(hours=hours)).strftime(HOUR_FORMAT)


def previous_hour(slot: str) -> str:
    return hours_before(slot, 1)


def previous_day(day: str) -> str:
    return (datetime.strptime(day, DAY_FORMAT) - timedelta(days=1)).strftime(DAY_FORMAT)


def history_floor(day: str, keep_days: int) -> int:
    """Oldest epoch minute still kept on ``day``."""
    return day_minute(day) - 24 * 60 * keep_days


def hour_key(ts: Column) -> Column:
    """Timestamp -> hour slot text."""
    return F.date_format(ts, "yyyy-MM-dd-HH")


def previous_hour_key(ts: Column) -> Column:
    return hour_key(ts - F.expr("INTERVAL 1 HOUR"))


def previous_day_key(ts: Column) -> Column:
    return F.date_format(F.date_sub(F.to_date(ts), 1), "yyyy-MM-dd")


def history_floor_minute(ts: Column, keep_days: int) -> Column:
    """Column form of :func:`history_floor`."""
    return _day_start(F.date_sub(F.to_date(ts), keep_days))
