"""Public holidays of a year as column expressions (Ontario calendar)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _day(year: Column, month: int, day: int) -> Column:
    return F.make_date(year, F.lit(month), F.lit(day))


def _nth_monday(year: Column, month: int, n: int) -> Column:
    # The first Monday on or after the 1st is the one following the last day of the month before.
    first = F.next_day(F.date_sub(_day(year, month, 1), 1), "Mon")
    return F.date_add(first, 7 * (n - 1))


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter: the Sunday after the paschal full moon."""

    golden = year % 19
    century = F.floor(year / 100).cast("int")
    leaps = F.floor(century / 4).cast("int")
    drift = F.floor((8 * century + 13) / 25).cast("int")
    moon = (century - leaps - drift + 19 * golden + 15) % 30
    # The two latest full moons are moved one day forward.
    moon = moon - F.when((moon == 29) | ((moon == 28) & (golden > 10)), 1).otherwise(0)
    full_moon = F.date_add(_day(year, 3, 21), moon)
    return F.next_day(full_moon, "Sun")


def substitute_days(holidays: Column) -> Column:
    """The days off that stand for holidays on a Saturday or Sunday, in the order of these.

    Each moves on to the next weekday that is neither a holiday nor a substitute already.
    """
    is_weekend = lambda d: F.dayofweek(d).isin(1, 7)

    def moved(taken: Column, holiday: Column) -> Column:
        after = F.transform(F.sequence(F.lit(1), F.lit(9)), lambda n: F.date_add(holiday["holiday_date"], n))
        used = lambda d: F.exists(F.concat(holidays, taken), lambda t: t["holiday_date"] == d)
        free = F.filter(after, lambda d: ~is_weekend(d) & ~used(d))[0]
        name = F.concat(holiday["description"], F.lit(" (observed)"))
        return F.concat(taken, F.array(F.struct(free.alias("holiday_date"), name.alias("description"))))

    late = F.array_sort(F.filter(holidays, lambda h: is_weekend(h["holiday_date"])))
    return F.aggregate(late, F.slice(holidays, 1, 0), moved)


def ontario_holidays(year: Column, substitutes: bool = False) -> Column:
    """``array<struct<holiday_date: date, description: string>>`` of a year.

    ``substitutes`` adds the days observed for holidays on a weekend.
    """
    # The ten holidays that count for pay.
    rules = [
        ("New Year's Day", _day(year, 1, 1)),
        ("Family Day", _nth_monday(year, 2, 3)),
        ("Good Friday", F.date_sub(easter_sunday(year), 2)),
        ("Victoria Day", F.date_sub(F.next_day(_day(year, 5, 24), "Mon"), 7)),
        ("Canada Day", _day(year, 7, 1)),
        ("Civic Holiday", _nth_monday(year, 8, 1)),
        ("Labour Day", _nth_monday(year, 9, 1)),
        ("Thanksgiving", _nth_monday(year, 10, 2)),
        ("Christmas Day", _day(year, 12, 25)),
        ("Boxing Day", _day(year, 12, 26)),
    ]
    days = F.array(
        *[F.struct(d.alias("holiday_date"), F.lit(name).alias("description")) for name, d in rules]
    )
    return F.concat(days, substitute_days(days)) if substitutes else days
