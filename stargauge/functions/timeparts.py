"""Time parts of an epoch-second column, in UTC whatever the session time zone is.

Date parts go through integer day numbers and ``date_from_unix_date``, so no expression here reads
``spark.sql.session.timeZone``; all of them stay inside generated code.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86400


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def to_timestamp(epoch: Column | str) -> Column:
    """Epoch seconds as a timestamp."""
    return F.timestamp_seconds(_col(epoch))


def epoch_seconds_ntz(ts: Column | str) -> Column:
    """Whole epoch seconds of a zone-less timestamp read as UTC."""
    ts = _col(ts)
    days = F.datediff(F.to_date(ts), F.lit("1970-01-01").cast("date")).cast("long")
    clock = F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)
    return days * SECONDS_PER_DAY + clock


def day_number(epoch: Column | str) -> Column:
    """Days since 1970-01-01, also right before 1970."""
    epoch = _col(epoch)
    return ((epoch - F.pmod(epoch, F.lit(SECONDS_PER_DAY))) / SECONDS_PER_DAY).cast("int")


def utc_date(epoch: Column | str) -> Column:
    return F.date_from_unix_date(day_number(epoch))


def hour(epoch: Column | str) -> Column:
    second_of_day = F.pmod(_col(epoch), F.lit(SECONDS_PER_DAY))
    return F.floor(second_of_day / 3600).cast("int")


def weekday(epoch: Column | str) -> Column:
    """Monday = 0 .. Sunday = 6."""
    return F.weekday(utc_date(epoch))


def month(epoch: Column | str) -> Column:
    return F.month(utc_date(epoch))


def day(epoch: Column | str) -> Column:
    return F.dayofmonth(utc_date(epoch))


def quarter(epoch: Column | str) -> Column:
    return F.quarter(utc_date(epoch))


def year(epoch: Column | str) -> Column:
    return F.year(utc_date(epoch))
