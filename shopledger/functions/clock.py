"""Time-clock expressions (``Column -> Column``), all on TIMESTAMP_NTZ."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _col(c: ColumnLike) -> Column:
    return F.col(c) if isinstance(c, str) else c


def naive(ts: dt.datetime) -> Column:
    """A timestamp literal without zone, whatever the zone of the driver's clock."""
    return F.lit(ts.isoformat(sep=" ")).cast("timestamp_ntz")


def minutes(n: int) -> Column:
    return F.make_dt_interval(mins=F.lit(n))


def on_the_hour(ts: ColumnLike) -> Column:
    """The timestamp with its minute set to zero (seconds are kept)."""
    ts = _col(ts)
    return ts - F.make_dt_interval(mins=F.minute(ts))


def round_start(ts: ColumnLike) -> Column:
    """Clock-in rounding: up to :05 -> :00, :06 to :35 -> :30, later -> next hour."""
    ts = _col(ts)
    m, hour = F.minute(ts), on_the_hour(ts)
    return F.when(m <= 5, hour).when(m <= 35, hour + minutes(30)).when(m > 35, hour + minutes(60))


def round_end(ts: ColumnLike) -> Column:
    """Clock-out rounding: up to :24 -> :00, :25 to :54 -> :30, later -> next hour."""
    ts = _col(ts)
    m, hour = F.minute(ts), on_the_hour(ts)
    return F.when(m <= 24, hour).when(m <= 54, hour + minutes(30)).when(m > 54, hour + minutes(60))


def hours_between(start: ColumnLike, end: ColumnLike) -> Column:
    """Length of a span in fractional hours."""
    return F.timestamp_diff("MICROSECOND", _col(start), _col(end)) / F.lit(3.6e9)


def at_midnight(ts: ColumnLike) -> Column:
    ts = _col(ts)
    return (F.hour(ts) == 0) & (F.minute(ts) == 0)


def at_time(ts: ColumnLike, hour: int, minute: int) -> Column:
    """Same day, given hour and minute."""
    midnight = F.to_date(_col(ts)).cast("timestamp_ntz")
    return midnight + F.make_dt_interval(hours=F.lit(hour), mins=F.lit(minute))


def parse_date(text: ColumnLike, day_first: bool = True) -> Column:
    """Date text in either the slash or the ISO form; anything else is null.

    ``day_first`` only decides between the two readings of the slash form.  A
    time behind the date is left out.
    """
    text = F.regexp_replace(F.trim(_col(text)), r"[ T]\d{1,2}:\d{2}(:\d{2}(\.\d+)?)?$", "")
    slashed = ["d/M/yyyy"] if day_first else ["M/d/yyyy"]
    forms = [*slashed, "yyyy-M-d"]
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)).cast("date") for f in forms])


def parse_datetime(date: ColumnLike, time: ColumnLike, day_first: bool = True) -> Column:
    """Date text + ``HH:mm`` text -> timestamp, null where either does not parse."""
    day = F.date_format(parse_date(date, day_first), "yyyy-MM-dd")
    text = F.concat(day, F.lit(" "), F.trim(_col(time)))
    return F.try_to_timestamp(text, F.lit("yyyy-MM-dd H:mm")).cast("timestamp_ntz")


def date_parts(date: ColumnLike) -> dict[str, Column]:
    """Calendar features of a date; weekday counts from Monday = 0."""
    date = _col(date)
    return {
        "year": F.year(date),
        "month": F.month(date),
        "day": F.dayofmonth(date),
        "weekday": F.weekday(date),
    }


def weekday_name(weekday: ColumnLike) -> Column:
    """Monday = 0 ... Sunday = 6 -> English day name."""
    names = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]
    return F.get(F.array(*[F.lit(n) for n in names]), _col(weekday))
