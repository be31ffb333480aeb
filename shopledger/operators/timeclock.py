"""Time-sheet adjustments.

A time sheet has employee_number, first_name, last_name, department, job,
start_ts and end_ts; the operators add adj_start, adj_end and working_hours.
The payroll order is: vacations, midnight merge, business hours, schedule, lunch.
Change and alert rows are filters of the same projected frame, not a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.clock import (
    at_midnight, at_time, hours_between, round_end, round_start,
)
from shopledger.functions.text import flag, full_name, name_parts
from shopledger.operators.ordered import mark_runs, neighbours

# Fixed values.
VACATION_JOB = "Vacation - paid"
BUSINESS_DEPARTMENT = "Business"
BUSINESS_EXEMPT = ("EE109", "EE037", "EE034", "EE059")
LUNCH_ABOVE_HOURS, LUNCH_HOURS = 7, 0.5

ORDER = ["start_ts", "end_ts", "job"]
PERSON = ["employee_number", "first_name", "last_name"]
CHANGE_COLUMNS = {
    "employee_number": "string", "full_name": "string",
    "original_start": "timestamp_ntz", "new_start": "timestamp_ntz",
    "original_end": "timestamp_ntz", "new_end": "timestamp_ntz",
    "time_difference_hours": "double", "original_hours": "double", "new_hours": "double",
    "reason": "string",
}


def _name() -> Column:
    return full_name(F.col("first_name"), F.col("last_name")).alias("full_name")


def round_times(timesheet: DataFrame) -> DataFrame:
    """Add the rounded clock times."""
    return timesheet.withColumns({"adj_start": round_start("start_ts"), "adj_end": round_end("end_ts")})


def working_hours(timesheet: DataFrame) -> DataFrame:
    """Rounded times and hours of every row whose times are known."""
    known = timesheet.filter(F.col("start_ts").isNotNull() & F.col("end_ts").isNotNull())
    return round_times(known).withColumn("working_hours", hours_between("adj_start", "adj_end"))


def nonzero_hours(timesheet: DataFrame) -> DataFrame:
    return timesheet.filter(F.col("working_hours").isNotNull() & (F.col("working_hours") != 0))


# -- vacations ---------------------------------------------------------------


def _with_vacation_flag(timesheet: DataFrame) -> DataFrame:
    dated = timesheet.filter(F.col("start_ts").isNotNull())
    return dated.withColumn("is_vacation", flag(F.col("job") == VACATION_JOB))


def vacation_runs(timesheet: DataFrame) -> DataFrame:
    """Runs of consecutive vacation rows of an employee, with the first row's name."""
    flagged = _with_vacation_flag(timesheet).filter(F.col("employee_number").isNotNull())
    runs = mark_runs(
        flagged, ["employee_number"], ORDER, F.to_date("start_ts"), ["is_vacation"],
        lambda prev, cur: prev("is_vacation") != cur("is_vacation"),
    )
    head = F.struct("first_name", "last_name", "department")
    return (
        runs.filter("is_vacation")
        .groupBy("employee_number", "run_no")
        .agg(F.min_by(head, F.struct(*ORDER)).alias("head"), F.count(F.lit(1)).alias("vacation_days"))
        .select("employee_number", "head.first_name", "head.last_name", "head.department", "vacation_days")
    )


def vacation_report(runs: DataFrame) -> DataFrame:
    return runs.select("employee_number", _name().alias("employee_name"), "department", "vacation_days")


def drop_long_vacations(timesheet: DataFrame) -> DataFrame:
    """Remove vacation rows that have a vacation row next to them."""
    flagged = neighbours(
        _with_vacation_flag(timesheet), ["employee_number"], ORDER, F.to_date("start_ts"),
        lag={"before": "is_vacation"}, lead={"after": "is_vacation"},
    )
    beside = flag(F.col("before")) | flag(F.col("after"))
    long = F.col("is_vacation") & beside & F.col("employee_number").isNotNull()
    return flagged.filter(~long).select(*timesheet.columns)


# -- shifts over midnight ----------------------------------------------------


def _merge_runs(hours: DataFrame, keys: Sequence[str], continues) -> DataFrame:
    """Fold each chain of continuing rows into its first row.

    Hours are added up and the end is that of the last row, so no hour of a
    chain of any length is lost.
    """
    keyless = F.lit(False)
    for k in keys:
        keyless = keyless | F.col(k).isNull()
    # Rows without a full key stand alone; they never meet in a window.
    runs = mark_runs(
        hours.filter(~keyless), keys, ORDER, F.to_date("start_ts"), ["start_ts", "end_ts", "adj_start", "adj_end"],
        lambda prev, cur: ~flag(continues(prev, cur)),
    )
    at = F.struct(*ORDER)
    kept = [c for c in hours.columns if c not in (*keys, "end_ts", "adj_end", "working_hours")]
    merged = runs.groupBy(*keys, "run_no").agg(
        F.min_by(F.struct(*kept), at).alias("head"),
        F.max_by(F.struct("end_ts", "adj_end"), at).alias("tail"),
        F.sum("working_hours").alias("working_hours"),
    )
    merged = merged.select(*keys, "head.*", "tail.*", "working_hours").select(*hours.columns)
    return merged.unionByName(hours.filter(keyless))


def merge_midnight_exact(hours: DataFrame) -> DataFrame:
    """Merge rows where one ends at 00:00 sharp and the employee's next starts at 00:00 (raw times)."""
    return _merge_runs(
        hours, ["employee_number"],
        lambda prev, cur: at_midnight(prev("end_ts")) & at_midnight(cur("start_ts")),
    )


def merge_midnight(hours: DataFrame) -> DataFrame:
    """Merge rows where the rounded end is a later day and the next rounded start is 00:00."""
    return _merge_runs(
        hours, PERSON,
        lambda prev, cur: (F.to_date(prev("adj_end")) > F.to_date(prev("adj_start")))
        & at_midnight(cur("adj_start")),
    )


def timesheet_hours(timesheet: DataFrame) -> DataFrame:
    """The bonus side's time sheet: merged, rounded, non-zero hours per date."""
    merged = nonzero_hours(merge_midnight_exact(working_hours(timesheet)))
    return merged.select(
        *PERSON, "department", "job", F.to_date("start_ts").alias("start_date"), "working_hours"
    )


# -- business hours ----------------------------------------------------------


def _business_mask() -> Column:
    exempt = flag(F.col("employee_number").isin(*BUSINESS_EXEMPT))
    return flag(F.col("department") == BUSINESS_DEPARTMENT) & ~exempt


def business_hours(hours: DataFrame) -> DataFrame:
    """Business staff work 09:00 to 19:30 of the day they clock in."""
    mask = _business_mask()
    new_start, new_end = at_time("adj_start", 9, 0), at_time("adj_start", 19, 30)
    return hours.withColumns(
        {
            "adj_start": F.when(mask, new_start).otherwise(F.col("adj_start")),
            "adj_end": F.when(mask, new_end).otherwise(F.col("adj_end")),
            "working_hours": F.when(mask, hours_between(new_start, new_end)).otherwise(F.col("working_hours")),
        }
    )


def business_changes(hours: DataFrame) -> DataFrame:
    """Change rows of ``business_hours``, given its input."""
    new_start, new_end = at_time("adj_start", 9, 0), at_time("adj_start", 19, 30)
    differs = (F.col("adj_start") != new_start) | (F.col("adj_end") != new_end)
    return hours.filter(_business_mask() & differs).select(
        "employee_number", _name(),
        F.col("adj_start").alias("original_start"), new_start.alias("new_start"),
        F.col("adj_end").alias("original_end"), new_end.alias("new_end"),
        F.lit("Adjusted business hours").alias("reason"),
    )


# -- schedule ----------------------------------------------------------------


def available_schedule(schedule: DataFrame) -> DataFrame:
    """Schedule rows that can move a clock-in; a null status counts as available."""
    return schedule.filter(~F.col("availability_status").eqNullSafe("Unavailable"))


def match_schedule(hours: DataFrame, schedule: DataFrame) -> DataFrame:
    """Left join on (date, full name); several schedule rows of a day all stay."""
    first, last = name_parts(F.col("users"))
    planned = schedule.select(
        F.col("sched_date").alias("__date"), full_name(first, last).alias("__name"), "sched_start"
    )
    rows = hours.withColumns({"__date": F.to_date("start_ts"), "__name": _name()})
    matched = rows.join(planned, ["__date", "__name"], "left").drop("__date", "__name")
    return matched.withColumn("time_difference_hours", hours_between("start_ts", "sched_start"))


def apply_schedule(matched: DataFrame) -> DataFrame:
    """Take the schedule's start where it is within an hour; recompute all hours."""
    near = flag(F.col("time_difference_hours").between(-1, 1))
    start = F.when(near, F.col("sched_start")).otherwise(F.col("adj_start"))
    return matched.withColumns(
        {"adj_start": start, "working_hours": hours_between(start, "adj_end")}
    ).drop("sched_start", "time_difference_hours")


def schedule_changes(matched: DataFrame) -> DataFrame:
    return matched.filter(F.col("time_difference_hours").between(-1, 1)).select(
        "employee_number", _name(),
        F.col("start_ts").alias("original_start"), F.col("sched_start").alias("new_start"),
        "time_difference_hours", F.lit("Schedule start time adjustment").alias("reason"),
    )


def schedule_alerts(matched: DataFrame) -> DataFrame:
    return matched.filter(F.abs("time_difference_hours") > 1).select(
        "employee_number", _name(),
        F.col("start_ts").alias("timesheet_start"), F.col("sched_start").alias("schedule_start"),
        "time_difference_hours",
        F.lit("Large time difference between timesheet and schedule").alias("reason"),
    )


# -- lunch and the change log ------------------------------------------------


def lunch(hours: DataFrame) -> DataFrame:
    """Half an hour off every row of more than seven hours."""
    h = F.col("working_hours")
    return hours.withColumn("working_hours", F.when(h > LUNCH_ABOVE_HOURS, h - LUNCH_HOURS).otherwise(h))


def lunch_changes(hours: DataFrame) -> DataFrame:
    h = F.col("working_hours")
    return hours.filter(h > LUNCH_ABOVE_HOURS).select(
        "employee_number", _name(), h.alias("original_hours"), (h - LUNCH_HOURS).alias("new_hours"),
        F.lit("Subtracted 0.5 hours for lunch").alias("reason"),
    )


def change_log(*changes: DataFrame) -> DataFrame:
    """Union of change rows with one schema; absent columns are null."""

    def aligned(df: DataFrame) -> DataFrame:
        return df.select(
            *[
                (F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c)
                for c, t in CHANGE_COLUMNS.items()
            ]
        )

    first, *rest = [aligned(c) for c in changes]
    for df in rest:
        first = first.unionByName(df)
    return first
