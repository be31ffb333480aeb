"""Registered queries of the time-sheet adjustments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.text import full_name
from shopledger.operators import timeclock as tc
from shopledger.plans.adapters import Inputs, ctes


def rounded(df: DataFrame, *cols: str, digits: int = 4) -> DataFrame:
    return df.withColumns({c: F.round(c, digits) for c in cols})


def merged(i: Inputs) -> DataFrame:
    # The merge reads its input twice, so that is a stored table.
    hours = i.stored("hours", lambda: tc.working_hours(tc.drop_long_vacations(i.timesheet)))
    return tc.merge_midnight(hours)


def business(i: Inputs) -> DataFrame:
    return tc.business_hours(merged(i))


def matched(i: Inputs) -> DataFrame:
    return tc.match_schedule(business(i), tc.available_schedule(i.schedule))


def scheduled(i: Inputs) -> DataFrame:
    return tc.apply_schedule(matched(i))


def final_timesheet(i: Inputs) -> DataFrame:
    return tc.lunch(scheduled(i))


def all_changes(i: Inputs) -> DataFrame:
    rows = i.stored("merged", lambda: merged(i))
    pairs = i.stored(
        "matched", lambda: tc.match_schedule(tc.business_hours(rows), tc.available_schedule(i.schedule))
    )
    return tc.change_log(
        tc.business_changes(rows), tc.schedule_changes(pairs), tc.lunch_changes(tc.apply_schedule(pairs))
    )


QUERIES = {
    "round_times": lambda i: tc.round_times(i.timesheet),
    "working_hours": lambda i: tc.working_hours(i.timesheet),
    "nonzero_hours": lambda i: tc.nonzero_hours(tc.working_hours(i.timesheet)),
    "full_name": lambda i: i.timesheet.select(
        "employee_number", full_name(F.col("first_name"), F.col("last_name")).alias("full_name")
    ).distinct(),
    "vacation_runs": lambda i: tc.vacation_runs(i.timesheet),
    "vacation_report": lambda i: tc.vacation_report(tc.vacation_runs(i.timesheet)),
    "vacation_filtered": lambda i: tc.drop_long_vacations(i.timesheet),
    "midnight_merge_exact": lambda i: tc.merge_midnight_exact(tc.working_hours(i.timesheet)),
    "midnight_merge": lambda i: tc.merge_midnight(tc.working_hours(i.timesheet)),
    "timesheet_hours": lambda i: tc.timesheet_hours(i.timesheet),
    "business_hours": business,
    "business_changes": lambda i: tc.business_changes(merged(i)),
    "schedule_update": lambda i: rounded(scheduled(i), "working_hours"),
    "schedule_changes": lambda i: rounded(tc.schedule_changes(matched(i)), "time_difference_hours"),
    "schedule_alerts": lambda i: rounded(tc.schedule_alerts(matched(i)), "time_difference_hours"),
    "alert_log": lambda i: rounded(tc.schedule_alerts(matched(i)), "time_difference_hours").orderBy(
        "timesheet_start", "employee_number", "schedule_start"
    ),
    "lunch_adjust": lambda i: rounded(final_timesheet(i), "working_hours"),
    "lunch_changes": lambda i: rounded(tc.lunch_changes(scheduled(i)), "original_hours", "new_hours"),
    "change_log": lambda i: rounded(all_changes(i), "time_difference_hours", "original_hours", "new_hours"),
}


def _round(x: str, first: int, second: int) -> str:
    hour = f"{x} - to_minutes(minute({x}))"
    return (
        f"CASE WHEN minute({x})<={first} THEN {hour} WHEN minute({x})<={second} THEN {hour} + INTERVAL 30 MINUTE "
        f"ELSE {hour} + INTERVAL 60 MINUTE END"
    )


def _hours(a: str, b: str) -> str:
    return f"date_diff('microsecond', {a}, {b})/3.6e9"


_ORDER = "ORDER BY start_ts, end_ts, job"
_MASK = "department='Business' AND employee_number NOT IN ('EE109','EE037','EE034','EE059')"
_NINE, _HALF_SEVEN = "date_trunc('day', adj_start) + INTERVAL 9 HOUR", "date_trunc('day', adj_start) + INTERVAL 1170 MINUTE"


def merge_cte(name: str, source: str, keys: str, continues: str) -> str:
    """Islands over plain windows, then one row per island."""
    return f"""{name}_lag AS (SELECT *, lag(start_ts) OVER w AS p_start, lag(end_ts) OVER w AS p_end,
   lag(adj_start) OVER w AS p_adj_start, lag(adj_end) OVER w AS p_adj_end
   FROM {source} WINDOW w AS (PARTITION BY {keys} {_ORDER})),
{name}_run AS (SELECT *, sum(CASE WHEN {continues} THEN 0 ELSE 1 END)
   OVER (PARTITION BY {keys} {_ORDER} ROWS UNBOUNDED PRECEDING) AS run FROM {name}_lag),
{name} AS (SELECT employee_number, first(first_name {_ORDER}) AS first_name, first(last_name {_ORDER}) AS last_name,
   first(department {_ORDER}) AS department, first(job {_ORDER}) AS job, min(start_ts) AS start_ts,
   last(end_ts {_ORDER}) AS end_ts, first(adj_start {_ORDER}) AS adj_start, last(adj_end {_ORDER}) AS adj_end,
   sum(working_hours) AS working_hours FROM {name}_run GROUP BY {keys}, run)"""


STEPS = {
    "vac": """vac AS (SELECT *, job='Vacation - paid' AS v, lag(job='Vacation - paid') OVER w AS pv,
   lead(job='Vacation - paid') OVER w AS nv FROM timesheet
   WINDOW w AS (PARTITION BY employee_number ORDER BY start_ts, end_ts, job))""",
    "kept": """kept AS (SELECT employee_number, first_name, last_name, department, job, start_ts, end_ts FROM vac
   WHERE NOT (v AND (coalesce(pv, false) OR coalesce(nv, false))))""",
    "hours": f"""hours AS (SELECT *, {_hours('adj_start', 'adj_end')} AS working_hours FROM (
   SELECT *, {_round('start_ts', 5, 35)} AS adj_start, {_round('end_ts', 24, 54)} AS adj_end FROM kept))""",
    "merged": merge_cte(
        "merged", "hours", "employee_number, first_name, last_name",
        "CAST(p_adj_end AS DATE) > CAST(p_adj_start AS DATE) AND hour(adj_start)=0 AND minute(adj_start)=0",
    ),
    "business": f"""business AS (SELECT * REPLACE (
   CASE WHEN {_MASK} THEN {_NINE} ELSE adj_start END AS adj_start,
   CASE WHEN {_MASK} THEN {_HALF_SEVEN} ELSE adj_end END AS adj_end,
   CASE WHEN {_MASK} THEN 10.5 ELSE working_hours END AS working_hours) FROM merged)""",
    "matched": f"""matched AS (SELECT b.*, s.sched_start, {_hours('b.start_ts', 's.sched_start')} AS diff
   FROM business b LEFT JOIN schedule s ON s.sched_date=CAST(b.start_ts AS DATE)
     AND s.users=b.first_name||' '||b.last_name AND s.availability_status IS DISTINCT FROM 'Unavailable')""",
    "scheduled": f"""scheduled AS (SELECT employee_number, first_name, last_name, department, job, start_ts, end_ts,
   new_start AS adj_start, adj_end, {_hours('new_start', 'adj_end')} AS working_hours FROM (
   SELECT *, CASE WHEN diff BETWEEN -1 AND 1 THEN sched_start ELSE adj_start END AS new_start FROM matched))""",
    "final": """final AS (SELECT * REPLACE (
   CASE WHEN working_hours>7 THEN working_hours-0.5 ELSE working_hours END AS working_hours) FROM scheduled)""",
}


def steps(upto: str, *more: str) -> str:
    """The payroll chain as CTEs up to a step, preceded by the inputs it needs."""
    names = list(STEPS)
    used = names[: names.index(upto) + 1]
    return f"WITH {ctes('timesheet', 'schedule', *more)},\n" + ",\n".join(STEPS[n] for n in used)


_RAW_HOURS = STEPS["hours"].replace("FROM kept", "FROM timesheet")
_RAW = f"WITH {ctes('timesheet')},\n{_RAW_HOURS}"
_EXACT = merge_cte(
    "exact", "hours", "employee_number",
    "hour(p_end)=0 AND minute(p_end)=0 AND hour(start_ts)=0 AND minute(start_ts)=0",
)
_NAME = "first_name||' '||last_name AS full_name"
_ROUNDED = "SELECT * REPLACE (round(working_hours, 4) AS working_hours) FROM {}"
_RUNS = f"""WITH {ctes('timesheet')}, flagged AS (SELECT *, job='Vacation - paid' AS v FROM timesheet),
lagged AS (SELECT *, lag(v) OVER (PARTITION BY employee_number {_ORDER}) AS pv FROM flagged),
runs AS (SELECT *, sum(CASE WHEN v IS DISTINCT FROM pv THEN 1 ELSE 0 END) OVER (PARTITION BY employee_number {_ORDER}
  ROWS UNBOUNDED PRECEDING) AS run FROM lagged),
vacations AS (SELECT employee_number, first(first_name {_ORDER}) AS first_name, first(last_name {_ORDER}) AS last_name,
  first(department {_ORDER}) AS department, count(*) AS vacation_days FROM runs WHERE v GROUP BY employee_number, run)"""
_BUSINESS_CHANGES = f"""SELECT employee_number, {_NAME}, adj_start AS original_start, {_NINE} AS new_start,
  adj_end AS original_end, {_HALF_SEVEN} AS new_end, 'Adjusted business hours' AS reason FROM merged
  WHERE {_MASK} AND (adj_start<>{_NINE} OR adj_end<>{_HALF_SEVEN})"""
_SCHEDULE_CHANGES = f"""SELECT employee_number, {_NAME}, start_ts AS original_start, sched_start AS new_start,
  round(diff, 4) AS time_difference_hours, 'Schedule start time adjustment' AS reason FROM matched
  WHERE diff BETWEEN -1 AND 1"""
_SCHEDULE_ALERTS = f"""SELECT employee_number, {_NAME}, start_ts AS timesheet_start, sched_start AS schedule_start,
  round(diff, 4) AS time_difference_hours, 'Large time difference between timesheet and schedule' AS reason
  FROM matched WHERE abs(diff)>1"""
_LUNCH_CHANGES = f"""SELECT employee_number, {_NAME}, round(working_hours, 4) AS original_hours,
  round(working_hours-0.5, 4) AS new_hours, 'Subtracted 0.5 hours for lunch' AS reason FROM scheduled
  WHERE working_hours>7"""

ORACLES = {
    "round_times": f"{_RAW} SELECT * EXCLUDE (working_hours) FROM hours",
    "working_hours": f"{_RAW} SELECT * FROM hours",
    "nonzero_hours": f"{_RAW} SELECT * FROM hours WHERE working_hours<>0",
    "full_name": f"WITH {ctes('timesheet')} SELECT DISTINCT employee_number, {_NAME} FROM timesheet",
    "vacation_runs": f"{_RUNS} SELECT * FROM vacations",
    "vacation_report": f"""{_RUNS} SELECT employee_number, first_name||' '||last_name AS employee_name, department,
  vacation_days FROM vacations""",
    "vacation_filtered": f"{steps('kept')} SELECT * FROM kept",
    "midnight_merge_exact": f"{_RAW},\n{_EXACT} SELECT * FROM exact",
    "midnight_merge": f"{_RAW},\n{STEPS['merged']} SELECT * FROM merged",
    "timesheet_hours": f"""{_RAW},\n{_EXACT} SELECT employee_number, first_name, last_name, department, job,
  CAST(start_ts AS DATE) AS start_date, working_hours FROM exact WHERE working_hours<>0""",
    "business_hours": f"{steps('business')} SELECT * FROM business",
    "business_changes": f"{steps('merged')} {_BUSINESS_CHANGES}",
    "schedule_update": f"{steps('scheduled')} {_ROUNDED.format('scheduled')}",
    "schedule_changes": f"{steps('matched')} {_SCHEDULE_CHANGES}",
    "schedule_alerts": f"{steps('matched')} {_SCHEDULE_ALERTS}",
    "alert_log": f"{steps('matched')} {_SCHEDULE_ALERTS}",
    "lunch_adjust": f"{steps('final')} {_ROUNDED.format('final')}",
    "lunch_changes": f"{steps('scheduled')} {_LUNCH_CHANGES}",
    "change_log": f"""{steps('scheduled')}
SELECT * FROM ({_BUSINESS_CHANGES}) UNION ALL BY NAME SELECT * FROM ({_SCHEDULE_CHANGES})
UNION ALL BY NAME SELECT * FROM ({_LUNCH_CHANGES})""",
}
