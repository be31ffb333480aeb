import datetime as dt

from pyspark.sql import functions as F

from shopledger.operators import timeclock as tc

SCHEMA = (
    "employee_number string, first_name string, last_name string, department string, job string, "
    "start_ts timestamp_ntz, end_ts timestamp_ntz"
)


def t(day, hour=0, minute=0):
    return dt.datetime(2024, 1, day, hour, minute)


def sheet(spark, rows):
    """rows: (employee, start, end[, job[, department]])"""
    full = [(r[0], f"F{r[0]}", "L", r[4] if len(r) > 4 else "Production", r[3] if len(r) > 3 else "Shift", r[1], r[2]) for r in rows]
    return spark.createDataFrame(full, SCHEMA).repartition(3)


def spans(df):
    return sorted((r.employee_number, r.start_ts, r.end_ts, r.working_hours) for r in df.collect())


def test_midnight_merge(spark):
    rows = [
        ("a", t(1, 20), t(2)), ("a", t(2), t(2, 4)),                        # pair
        ("b", t(1, 20), t(2)), ("b", t(2), t(3)), ("b", t(3), t(3, 4)),     # chain of three
        ("c", t(1, 20), t(2)), ("d", t(2), t(2, 4)),                        # neighbours of different people
        ("e", t(1, 8), t(1, 16)), ("e", t(5, 20), t(6)), ("e", t(6), t(6, 2)),  # last pair
        ("f", t(1, 8), t(1, 16)), ("f", t(2), t(2, 3)),                     # start at 00:00 alone
        (None, t(1, 20), t(2)), (None, t(2), t(2, 4)),                      # unknown people never merge
    ]
    hours = tc.working_hours(sheet(spark, rows))
    want = [
        ("a", t(1, 20), t(2, 4), 8.0), ("b", t(1, 20), t(3, 4), 32.0), ("c", t(1, 20), t(2), 4.0),
        ("d", t(2), t(2, 4), 4.0), ("e", t(1, 8), t(1, 16), 8.0), ("e", t(5, 20), t(6, 2), 6.0),
        ("f", t(1, 8), t(1, 16), 8.0), ("f", t(2), t(2, 3), 3.0),
    ]
    for merge in (tc.merge_midnight, tc.merge_midnight_exact):
        merged = merge(hours)
        assert spans(merged.filter(F.col("employee_number").isNotNull())) == want
        assert merged.filter(F.col("employee_number").isNull()).count() == 2
        assert merged.agg(F.sum("working_hours")).first()[0] == hours.agg(F.sum("working_hours")).first()[0]


def test_exact_merge_needs_exact_midnight(spark):
    rows = [("a", t(1, 20), t(1, 23, 58)), ("a", t(2), t(2, 4))]
    hours = tc.working_hours(sheet(spark, rows))
    assert tc.merge_midnight_exact(hours).count() == 2
    assert tc.merge_midnight(hours).count() == 1  # rounds to midnight of the next day


def test_vacations(spark):
    v = tc.VACATION_JOB
    rows = [
        ("a", t(1, 9), t(1, 17), v),                                               # single day
        ("a", t(2, 9), t(2, 17)),
        ("a", t(3, 9), t(3, 17), v), ("a", t(8, 9), t(8, 17), v), ("a", t(9, 9), t(9, 17), v),  # run of 3
        ("a", t(10, 9), t(10, 17)), ("a", t(11, 9), t(11, 17), v), ("a", t(12, 9), t(12, 17), v),  # another run
        ("b", t(12, 9), t(12, 17), v),                                             # own run of another person
    ]
    df = sheet(spark, rows)
    runs = sorted((r.employee_number, r.vacation_days) for r in tc.vacation_runs(df).collect())
    assert runs == [("a", 1), ("a", 2), ("a", 3), ("b", 1)]
    kept = sorted((r.employee_number, r.start_ts.day) for r in tc.drop_long_vacations(df).collect())
    assert kept == [("a", 1), ("a", 2), ("a", 10), ("b", 12)]
    dropped = sum(n for _, n in runs if n > 1)
    assert len(rows) == len(kept) + dropped


def test_business_hours_and_changes(spark):
    rows = [
        ("EE001", t(1, 8, 50), t(1, 17), "Shift", "Business"), ("EE002", t(1, 9), t(1, 19, 30), "Shift", "Business"),
        ("EE109", t(1, 8), t(1, 16), "Shift", "Business"), ("EE003", t(1, 8), t(1, 16)),
    ]
    hours = tc.working_hours(sheet(spark, rows))
    got = {r.employee_number: r.working_hours for r in tc.business_hours(hours).collect()}
    assert got == {"EE001": 10.5, "EE002": 10.5, "EE109": 8.0, "EE003": 8.0}
    assert [r.employee_number for r in tc.business_changes(hours).collect()] == ["EE001"]


def test_schedule_and_lunch(spark):
    rows = [("a", t(1, 8, 50), t(1, 17)), ("b", t(1, 8), t(1, 17)), ("c", t(1, 8), t(1, 17)), ("d", t(1, 8), t(1, 15))]
    hours = tc.working_hours(sheet(spark, rows))
    schedule = spark.createDataFrame(
        [(dt.date(2024, 1, 1), t(1, 9), "Fa L", None), (dt.date(2024, 1, 1), t(1, 10), "Fb L", None),
         (dt.date(2024, 1, 1), t(1, 8), "Fc L", "Unavailable"), (dt.date(2024, 1, 1), t(1, 9), "Fd L", "Available")],
        "sched_date date, sched_start timestamp_ntz, users string, availability_status string",
    )
    matched = tc.match_schedule(hours, tc.available_schedule(schedule))
    assert sorted(r.employee_number for r in tc.schedule_changes(matched).collect()) == ["a", "d"]
    assert [r.employee_number for r in tc.schedule_alerts(matched).collect()] == ["b"]
    updated = tc.apply_schedule(matched)
    assert {r.employee_number: r.working_hours for r in updated.collect()} == {"a": 8.0, "b": 9.0, "c": 9.0, "d": 6.0}
    final = {r.employee_number: r.working_hours for r in tc.lunch(updated).collect()}
    assert final == {"a": 7.5, "b": 8.5, "c": 8.5, "d": 6.0}
    log = tc.change_log(tc.schedule_changes(matched), tc.lunch_changes(updated))
    assert log.columns == list(tc.CHANGE_COLUMNS) and log.count() == 5
