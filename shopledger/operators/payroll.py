"""Bi-weekly payroll: totals, salary, holiday pay, bonus and the pay summary.

The periods are 14 days from a start date and a column of the tables, so any
number of periods is one pass.  The carry-over of hours between periods is a
window over one row per employee and period.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shopledger.functions.clock import naive
from shopledger.functions.pay import salary, with_pay_defaults
from shopledger.functions.text import full_name

PERIOD_DAYS = 14
KEYS = ["employee_number", "period"]


def period_of(date: Column, start: dt.date) -> Column:
    return F.floor(F.date_diff(date, F.lit(start)) / PERIOD_DAYS).cast("int")


def period_dates(start: dt.date) -> dict[str, Column]:
    first = F.date_add(F.lit(start), F.col("period") * PERIOD_DAYS)
    return {"period_start": first, "period_end": F.date_add(first, PERIOD_DAYS - 1)}


def in_periods(df: DataFrame, date: str, start: dt.date, num_periods: int | None = 1) -> DataFrame:
    """Rows of the first ``num_periods`` pay periods (None: all from the start), with their period number."""
    df = df.filter(F.col(date) >= F.lit(start))
    if num_periods is not None:
        df = df.filter(F.col(date) < F.lit(start + dt.timedelta(days=PERIOD_DAYS * num_periods)))
    return df.withColumn("period", period_of(F.col(date), start))


def dated(timesheet: DataFrame) -> DataFrame:
    return timesheet.withColumn("start_date", F.to_date("start_ts"))


def sheet_in_periods(timesheet: DataFrame, start: dt.date, num_periods: int | None = 1) -> DataFrame:
    """Time-sheet rows of the pay periods, with date and period.

    The bounds are on the stored timestamp itself, so they reach the table's scan.
    """
    first = dt.datetime.combine(start, dt.time())
    timesheet = timesheet.filter(F.col("start_ts") >= naive(first))
    if num_periods is not None:
        end = first + dt.timedelta(days=PERIOD_DAYS * num_periods)
        timesheet = timesheet.filter(F.col("start_ts") < naive(end))
    return dated(timesheet).withColumn("period", period_of(F.col("start_date"), start))


def employee_totals(timesheet: DataFrame, start: dt.date, num_periods: int | None = 1) -> DataFrame:
    """Hours, days and names per employee and period; names come from the earliest row.

    Rows are summed per day first: the distinct days of a period are then a plain
    count, and an employee's rows meet in one task only as daily rows.
    """
    rows = sheet_in_periods(timesheet, start, num_periods)
    at = F.struct("start_ts", "end_ts", "job", "adj_start", "adj_end")
    days = (
        rows.filter(F.col("employee_number").isNotNull())
        .groupBy(*KEYS, "start_date")
        .agg(
            F.sum("working_hours").alias("hours"),
            F.min(at).alias("at"),
            *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), at)).alias(c)
              for c in ("department", "first_name", "last_name")],
        )
    )
    return days.groupBy(*KEYS).agg(
        F.coalesce(F.sum("hours"), F.lit(0.0)).alias("total_hours"),
        F.count(F.lit(1)).alias("working_days"),
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("at"))).alias(c)
          for c in ("department", "first_name", "last_name")],
    )


def rate_key(rates: DataFrame) -> str:
    """The rate list's employee column: employee_number, else employee_id."""
    for name in ("employee_number", "employee_id"):
        if name in rates.columns:
            return name
    raise ValueError("the rate list has neither employee_number nor employee_id")


def join_rates(totals: DataFrame, rates: DataFrame) -> DataFrame:
    """Left join: employees without a rate stay."""
    return totals.join(rates.withColumnRenamed(rate_key(rates), "employee_number"), "employee_number", "left")


def unmatched_employees(rated: DataFrame) -> DataFrame:
    return rated.filter(F.col("reg_rate").isNull())


def holiday_periods(holidays: DataFrame, start: dt.date) -> DataFrame:
    """The periods with a holiday, as numbers relative to the start (also before it)."""
    return holidays.select(period_of(F.col("holiday_date"), start).alias("period")).distinct()


def with_holiday_flags(rated: DataFrame, holidays: DataFrame, start: dt.date) -> DataFrame:
    """Does the period, and does the one before it, have a holiday?"""
    periods = holiday_periods(holidays, start)
    now = periods.withColumn("has_holiday", F.lit(True))
    before = periods.select((F.col("period") + 1).alias("period"), F.lit(True).alias("had_holiday"))
    return rated.join(now, "period", "left").join(before, "period", "left").fillna(
        False, ["has_holiday", "had_holiday"]
    )


def with_rolling_hours(rated: DataFrame, lookback: int = 4) -> DataFrame:
    """Hours of the period and of the employee's ``lookback`` periods before it that have rows."""
    span = Window.partitionBy("employee_number").orderBy("period").rowsBetween(-lookback, 0)
    return rated.withColumn("rolling_hours", F.sum("total_hours").over(span))


def with_salary(flagged: DataFrame, cap_regular: bool = False) -> DataFrame:
    filled = with_pay_defaults(flagged)
    pay = salary(F.col("has_holiday"), cap_regular)
    return filled.withColumn("__pay", pay).select(*filled.columns, "__pay.*")


def pay_base(
    timesheet: DataFrame, rates: DataFrame, holidays: DataFrame, start: dt.date,
    num_periods: int | None = 1, cap_regular: bool = False,
) -> DataFrame:
    """One row per employee and period with everything the pay rules need, and the salary."""
    rated = join_rates(employee_totals(timesheet, start, num_periods), rates)
    flagged = with_holiday_flags(with_rolling_hours(rated), holidays, start)
    return with_salary(flagged, cap_regular)


def holiday_pay(
    base: DataFrame, timesheet: DataFrame, holidays: DataFrame, start: dt.date, num_periods: int | None = 1
) -> DataFrame:
    """Pay per employee and holiday of the period.

    Hours worked on the day at the overtime rate, plus a tenth of the rolling
    hours - capped by the triggers of this and the previous period - at the
    regular rate.  Temporary staff get 0.
    """
    days = in_periods(holidays, "holiday_date", start, num_periods)
    worked = sheet_in_periods(timesheet, start, num_periods).join(days.select("holiday_date").distinct(),
                                   F.col("start_date") == F.col("holiday_date"), "left_semi")
    worked = worked.groupBy("employee_number", F.col("start_date").alias("holiday_date")).agg(
        F.sum("working_hours").alias("holiday_hours")
    )
    rows = base.join(days.select("period", "holiday_date"), "period").join(
        worked, ["employee_number", "holiday_date"], "left"
    )

    def trigger(flag_name: str) -> Column:
        return F.when(F.col(flag_name), F.col("ot_trigger_holiday")).otherwise(F.col("ot_trigger_regular"))

    cap = (trigger("has_holiday") + trigger("had_holiday")).cast("double")
    day_pay = F.coalesce("holiday_hours", F.lit(0.0)) * F.col("ot_rate")
    rest_pay = F.least(F.col("rolling_hours"), cap) / 10 * F.col("reg_rate")
    pay = F.when(F.col("department").eqNullSafe("Temp"), 0.0).otherwise(day_pay + rest_pay)
    return rows.select(*KEYS, "holiday_date", pay.alias("holiday_pay"))


def bonus_totals(bonus: DataFrame, start: dt.date, num_periods: int | None = 1) -> DataFrame:
    rows = in_periods(bonus, "bonus_date", start, num_periods).filter(F.col("employee_id").isNotNull())
    return rows.groupBy(F.col("employee_id").alias("employee_number"), "period").agg(
        F.coalesce(F.sum("bonus"), F.lit(0.0)).alias("bonus")
    )


def join_bonus(base: DataFrame, totals: DataFrame) -> DataFrame:
    """Add the bonus, zero where there is none."""
    return base.join(totals, KEYS, "left").fillna(0.0, ["bonus"])


def payroll(
    timesheet: DataFrame, rates: DataFrame, holidays: DataFrame, bonus: DataFrame, start: dt.date,
    num_periods: int | None = 1, cap_regular: bool = False, base: DataFrame | None = None,
) -> DataFrame:
    """Salary, bonus, total compensation and holiday pay per employee and period.

    The total is salary plus bonus; the holiday pay is reported beside it.
    ``base`` may be a stored ``pay_base``, which is read twice.
    """
    if base is None:
        base = pay_base(timesheet, rates, holidays, start, num_periods, cap_regular)
    extra = holiday_pay(base, timesheet, holidays, start, num_periods)
    extra = extra.groupBy(*KEYS).agg(F.sum("holiday_pay").alias("holiday_pay"))
    paid = join_bonus(base, bonus_totals(bonus, start, num_periods)).join(extra, KEYS, "left")
    return paid.fillna(0.0, ["holiday_pay"]).withColumns(
        {"total_compensation": F.col("salary") + F.col("bonus"), **period_dates(start)}
    )


def pay_summary(paid: DataFrame) -> DataFrame:
    """The nine report columns per period; overtime always counts above the with-holiday trigger."""
    over = F.greatest(F.lit(0.0), F.col("total_hours") - F.col("ot_trigger_holiday"))
    overtime = F.col("ot_rate") * over
    return paid.select(
        "period_start", "period_end", "employee_number",
        full_name(F.col("first_name"), F.col("last_name")).alias("employee_name"),
        "department", "total_hours",
        (F.col("salary") - overtime).alias("regular_pay"), overtime.alias("overtime_pay"),
        "holiday_pay", "bonus", "total_compensation",
    )


def pay_detail(paid: DataFrame, timesheet: DataFrame, start: dt.date, num_periods: int | None = 1) -> DataFrame:
    """Every time-sheet row of the periods beside its employee's pay figures."""
    figures = paid.select(
        *KEYS, "period_start", "period_end", "total_hours", "reg_rate", "ot_rate", "pay_basis", "follow_clock",
        "ot_trigger_holiday", "ot_trigger_regular", "holiday_pay", "bonus", "total_compensation",
    )
    rows = sheet_in_periods(timesheet, start, num_periods).select(
        *KEYS, "first_name", "last_name", "job", "department", "start_ts", "end_ts", "adj_start", "adj_end",
        "working_hours",
    )
    return rows.join(figures, KEYS, "left").drop("period")
