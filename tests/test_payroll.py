import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopledger.functions.pay import salary, with_pay_defaults
from shopledger.operators import payroll as pr

START = dt.date(2024, 1, 1)
RATES = (
    "reg_rate double, ot_rate double, pay_basis string, skip_calc string, follow_clock string, "
    "ot_trigger_holiday int, ot_trigger_regular int"
)
SHEET = (
    "employee_number string, first_name string, last_name string, department string, job string, "
    "start_ts timestamp_ntz, end_ts timestamp_ntz, adj_start timestamp_ntz, adj_end timestamp_ntz, working_hours double"
)


def test_every_salary_branch(spark):
    base = dict(reg_rate=20.0, ot_rate=30.0, pay_basis="Hourly", skip_calc=None, follow_clock="No",
                ot_trigger_holiday=70, ot_trigger_regular=80)
    cases = [
        # changes, department, hours, days, holiday, (regular, overtime)
        (dict(reg_rate=None), "Production", 90.0, 9, False, (0, 0)),
        ({}, "Temp", 90.0, 9, False, (0, 0)),
        (dict(pay_basis=None), "Production", 90.0, 9, False, (0, 0)),
        (dict(pay_basis="weekly"), "Production", 90.0, 9, False, (0, 0)),
        (dict(skip_calc="Yes"), "Production", 90.0, 9, False, (0, 0)),
        (dict(pay_basis="Daily"), "Production", 90.0, 9, False, (180, 0)),
        (dict(pay_basis="ANNUAL"), "Production", 90.0, 9, False, (20, 0)),
        (dict(follow_clock="Yes", pay_basis=" Hourly "), "Production", 90.0, 9, False, (1800, 0)),
        ({}, "Production", 90.0, 9, False, (1600, 300)),
        ({}, "Production", 90.0, 9, True, (1400, 600)),
        (dict(ot_rate=None), "Production", 90.0, 9, True, (1400, 400)),
        (dict(ot_trigger_holiday=None), "Production", 90.0, 9, True, (1600, 300)),
        (dict(ot_trigger_regular=None), "Production", 90.0, 9, False, (1600, 300)),
        ({}, "Production", 10.0, 2, False, (1600, 0)),  # below the trigger: the whole trigger is paid
        ({}, None, 80.0, 9, False, (1600, 0)),
    ]
    rows = []
    for n, (change, department, hours, days, holiday, want) in enumerate(cases):
        r = base | change
        rows.append((n, *[r[k] for k in base], department, hours, days, holiday, float(want[0]), float(want[1])))
    df = spark.createDataFrame(
        rows, f"n int, {RATES}, department string, total_hours double, working_days int, hol boolean, reg double, ot double"
    )
    pay = with_pay_defaults(df).withColumn("p", salary(F.col("hol")))
    bad = pay.filter((F.col("p.regular_pay") != F.col("reg")) | (F.col("p.overtime_pay") != F.col("ot"))
                     | (F.col("p.salary") != F.col("reg") + F.col("ot")) | F.col("p.salary").isNull())
    assert [r.n for r in bad.collect()] == []
    capped = with_pay_defaults(df.filter("n = 13")).select(salary(F.col("hol"), cap_regular=True).alias("p")).first()
    assert capped.p.regular_pay == 200


def shift(employee, day, hours, department="Production"):
    start = dt.datetime(2024, 1, 1, 8) + dt.timedelta(days=day)
    end = start + dt.timedelta(hours=hours)
    return (employee, "A", "B", department, "Shift", start, end, start, end, float(hours))


@pytest.fixture(scope="module")
def parts(spark):
    # a: periods 0, 1, 3 (absent in 2); b: temp; c: no rate
    rows = [shift("a", 0, 10), shift("a", 0, 2), shift("a", 5, 8), shift("a", 16, 8), shift("a", 17, 8), shift("a", 44, 6)]
    rows += [shift("b", 17, 8, "Temp"), shift("c", 3, 8), shift("a", -1, 9), shift("a", 60, 9)]
    sheet = spark.createDataFrame(rows, SHEET).repartition(3)
    rates = spark.createDataFrame([("a", 20.0, 30.0, "Hourly", None, "No", 7, 10), ("b", 20.0, 30.0, "Hourly", None, "No", 7, 10)],
                                  f"employee_id string, {RATES}")
    holidays = spark.createDataFrame([(dt.date(2024, 1, 18), "H")], "holiday_date date, description string")
    bonus = spark.createDataFrame([(dt.date(2024, 1, 2), "a", 5.0), (dt.date(2024, 1, 3), "a", 2.5), (dt.date(2024, 1, 17), "b", 7.0)],
                                  "bonus_date date, employee_id string, bonus double")
    return sheet, rates, holidays, bonus


def test_totals_and_carry_over(parts):
    sheet, *_ = parts
    totals = pr.employee_totals(sheet, START, 4)
    got = {(r.employee_number, r.period): (r.total_hours, r.working_days) for r in totals.collect()}
    assert got == {("a", 0): (20.0, 2), ("a", 1): (16.0, 2), ("a", 3): (6.0, 1), ("b", 1): (8.0, 1), ("c", 0): (8.0, 1)}
    rolling = {(r.employee_number, r.period): r.rolling_hours for r in pr.with_rolling_hours(totals).collect()}
    assert rolling[("a", 3)] == 42.0 and rolling[("a", 1)] == 36.0  # present periods, not calendar ones
    two = {(r.employee_number, r.period): r.rolling_hours for r in pr.with_rolling_hours(totals, 1).collect()}
    assert two[("a", 3)] == 22.0


def test_payroll(parts):
    sheet, rates, holidays, bonus = parts
    paid = {(r.employee_number, r.period): r for r in pr.payroll(sheet, rates, holidays, bonus, START, 4).collect()}
    first, second = paid["a", 0], paid["a", 1]
    assert (first.salary, first.bonus, first.total_compensation, first.holiday_pay) == (500.0, 7.5, 507.5, 0.0)
    # holiday 18 January: 8 h at 30, plus min(36, 7 + 10) / 10 * 20; the total leaves it out
    assert second.holiday_pay == 8 * 30 + 17 / 10 * 20
    assert second.salary == 7 * 20 + 9 * 30 and second.total_compensation == second.salary
    assert (paid["b", 1].salary, paid["b", 1].holiday_pay, paid["b", 1].total_compensation) == (0.0, 0.0, 7.0)
    assert paid["c", 0].salary == 0.0
    assert str(second.period_start) == "2024-01-15" and str(second.period_end) == "2024-01-28"
    missing = pr.unmatched_employees(pr.join_rates(pr.employee_totals(sheet, START, 4), rates))
    assert [r.employee_number for r in missing.collect()] == ["c"]


def test_summary_splits_overtime_at_the_holiday_trigger(parts):
    sheet, rates, holidays, bonus = parts
    rows = pr.pay_summary(pr.payroll(sheet, rates, holidays, bonus, START, 1)).collect()
    row = next(r for r in rows if r.employee_number == "a")
    assert (row.overtime_pay, row.regular_pay) == (30.0 * 13, 500.0 - 390.0)
    assert row.employee_name == "A B"


def test_rate_list_without_a_key(spark):
    with pytest.raises(ValueError):
        pr.rate_key(spark.createDataFrame([(1,)], "x int"))
