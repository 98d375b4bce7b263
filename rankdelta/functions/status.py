"""Movement status text, trend class and time labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rankdelta.schema import LOCAL_TZ, STATUS_DOWN, STATUS_NEW, STATUS_SAME, STATUS_UP


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def movement_status(delta) -> Column:
    """NULL -> new, >0 -> up n, <0 -> down n, 0 -> unchanged."""
    d = _col(delta)
    return (F.when(d.isNull(), F.lit(STATUS_NEW))
            .when(d > 0, F.concat(F.lit(STATUS_UP), d.cast("string")))
            .when(d < 0, F.concat(F.lit(STATUS_DOWN), F.abs(d).cast("string")))
            .otherwise(F.lit(STATUS_SAME)))


def trend_class(status) -> Column:
    """'up' / 'down' by the status' leading arrow, else ''."""
    s = F.coalesce(_col(status), F.lit(""))
    return (F.when(s.startswith(STATUS_UP), F.lit("up"))
            .when(s.startswith(STATUS_DOWN), F.lit("down"))
            .otherwise(F.lit("")))


def snapshot_label(ts) -> Column:
    """Text of a capture time as pandas prints a Timestamp.

    ``yyyy-MM-dd HH:mm:ss`` plus ``.ffffff`` when the microseconds are not 0.
    """
    t = _col(ts)
    micros = F.date_format(t, "SSSSSS")
    return F.when(t.isNull(), F.lit(None).cast("string")).otherwise(
        F.concat(F.date_format(t, "yyyy-MM-dd HH:mm:ss"),
                 F.when(micros == "000000", F.lit("")).otherwise(F.concat(F.lit("."), micros))))


def minute_label(ts) -> Column:
    """``yyyy-MM-dd HH:mm`` label of a baseline pick."""
    return F.date_format(_col(ts), "yyyy-MM-dd HH:mm")


def file_date_stamp(ts) -> Column:
    """``yyMMdd`` stamp used in report file names."""
    return F.date_format(_col(ts), "yyMMdd")


def local_wall_time(utc_ts) -> Column:
    """A UTC instant (timestamp_ntz) as Seoul wall time, still zone-less."""
    return F.convert_timezone(F.lit("UTC"), F.lit(LOCAL_TZ), _col(utc_ts))


def day_start(ts) -> Column:
    """Midnight of the wall-clock day, zone-independent (timestamp_ntz)."""
    return _col(ts).cast("date").cast("timestamp_ntz")


def plus_hours(ts, hours) -> Column:
    h = hours if isinstance(hours, Column) else F.lit(hours)
    return _col(ts) + F.make_dt_interval(F.lit(0), h.cast("int"), F.lit(0), F.lit(0))


def minus_days(ts, days: int) -> Column:
    return _col(ts) - F.make_dt_interval(F.lit(days), F.lit(0), F.lit(0), F.lit(0))


def plus_days(ts, days) -> Column:
    d = days if isinstance(days, Column) else F.lit(days)
    return _col(ts) + F.make_dt_interval(d.cast("int"), F.lit(0), F.lit(0), F.lit(0))
