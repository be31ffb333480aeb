import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopledger.functions import clock, holidays, text

DAY = dt.datetime(2024, 3, 5, 10, 0)


def at(minute, hour=10):
    return DAY.replace(hour=hour, minute=minute)


def test_rounding_at_the_borders(spark):
    minutes = [0, 5, 6, 24, 25, 35, 36, 54, 55, 59]
    rows = spark.createDataFrame([(at(m),) for m in minutes], "ts timestamp_ntz")
    got = rows.select("ts", clock.round_start("ts").alias("s"), clock.round_end("ts").alias("e")).collect()
    start = {r.ts.minute: r.s for r in got}
    end = {r.ts.minute: r.e for r in got}
    assert [start[m] for m in (0, 5, 6, 35, 36, 59)] == [at(0), at(0), at(30), at(30), at(0, 11), at(0, 11)]
    assert [end[m] for m in (0, 24, 25, 54, 55, 59)] == [at(0), at(0), at(30), at(30), at(0, 11), at(0, 11)]


def test_rounding_into_the_next_day_and_null(spark):
    late = dt.datetime(2024, 2, 29, 23, 59, 40)
    rows = spark.createDataFrame([(late,), (None,)], "ts timestamp_ntz")
    got = {r.ts: (r.s, r.e) for r in rows.select("ts", clock.round_start("ts").alias("s"), clock.round_end("ts").alias("e")).collect()}
    nxt = dt.datetime(2024, 3, 1, 0, 0, 40)  # seconds stay
    assert got[late] == (nxt, nxt)
    assert got[None] == (None, None)


def test_parse_is_day_first_and_never_fails(spark):
    rows = spark.createDataFrame(
        [("05/03/2024", "9:05"), ("2024-03-05", "09:05"), ("31/02/2024", "09:05"), ("05/03/2024", "abc"), (None, "1:00")],
        "d string, t string",
    )
    got = [r[0] for r in rows.select(clock.parse_datetime("d", "t")).collect()]
    assert got == [dt.datetime(2024, 3, 5, 9, 5)] * 2 + [None] * 3


def test_hours_weekday_and_names(spark):
    one = spark.range(1).select(
        clock.hours_between(F.lit(at(0)).cast("timestamp_ntz"), F.lit(at(30, 34 % 24)).cast("timestamp_ntz")).alias("h"),
        F.weekday(F.lit(dt.date(2024, 3, 4))).alias("monday"),
        clock.weekday_name(F.lit(6)).alias("name"),
        text.full_name(F.lit("A"), F.lit(None).cast("string")).alias("half"),
        text.full_name(F.lit("A"), F.lit("B C")).alias("full"),
        text.first_code(F.lit("12|x|y")).alias("code"),
    ).first()
    assert (one.h, one.monday, one.name, one.half, one.full, one.code) == (0.5, 0, "Sunday", None, "A B C", "12")


def test_users_split_in_two(spark):
    rows = spark.createDataFrame([(" Ann  Lee Wu ",), ("Bo",), (None,)], "u string")
    first, last = text.name_parts(F.col("u"))
    assert [tuple(r) for r in rows.select(first, last).collect()] == [("Ann", "Lee Wu"), ("Bo", None), (None, None)]


@pytest.mark.parametrize(
    "year, easter",
    [(1954, "1954-04-18"), (1981, "1981-04-19"), (2000, "2000-04-23"), (2008, "2008-03-23"), (2024, "2024-03-31"), (2038, "2038-04-25")],
)
def test_easter(spark, year, easter):
    assert str(spark.range(1).select(holidays.easter_sunday(F.lit(year))).first()[0]) == easter


def test_holidays_of_2024(spark):
    got = spark.range(1).select(F.inline(holidays.ontario_holidays(F.lit(2024)))).collect()
    assert {r.description: str(r.holiday_date)[5:] for r in got} == {
        "New Year's Day": "01-01", "Family Day": "02-19", "Good Friday": "03-29", "Victoria Day": "05-20",
        "Canada Day": "07-01", "Civic Holiday": "08-05", "Labour Day": "09-02", "Thanksgiving": "10-14",
        "Christmas Day": "12-25", "Boxing Day": "12-26",
    }


def test_dates_with_a_time_part(spark):
    texts = ["2024-01-02 00:00:00", "2/1/2024 08:30", "2024-01-02T07:05:09.5", "2024-01-02", "x 08:30", None]
    rows = spark.createDataFrame([(t,) for t in texts], "d string")
    assert [str(r[0]) for r in rows.select(clock.parse_date("d")).collect()] == ["2024-01-02"] * 4 + ["None"] * 2


@pytest.mark.parametrize("year, observed", [
    (2021, {"Christmas Day": "12-27", "Boxing Day": "12-28"}),  # Saturday and Sunday
    (2022, {"New Year's Day": "01-03", "Christmas Day": "12-27"}),  # Monday is Boxing Day already
    (2020, {"Boxing Day": "12-28"}), (2018, {"Canada Day": "07-02"}), (2017, {"New Year's Day": "01-02", "Canada Day": "07-03"}),
    (2024, {}),
])
def test_holidays_on_a_weekend_move_on(spark, year, observed):
    days = spark.range(1).select(F.inline(holidays.ontario_holidays(F.lit(year), substitutes=True))).collect()
    got = {r.description.removesuffix(" (observed)"): str(r.holiday_date)[5:] for r in days if "observed" in r.description}
    assert got == observed and len(days) == 10 + len(observed)
