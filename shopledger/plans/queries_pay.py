"""Registered queries of the payroll."""

from __future__ import annotations


from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions.holidays import ontario_holidays
from shopledger.functions.pay import pay_basis
from shopledger.operators import bonus as bo
from shopledger.operators import payroll as pr
from shopledger.plans import queries_bonus as qb
from shopledger.plans.adapters import PAY_START, Inputs, ctes
from shopledger.plans.queries_clock import STEPS, final_timesheet, rounded

PERIODS = 3


def sheet(i: Inputs) -> DataFrame:
    """The adjusted time sheet, written once: every pay query reads it more than once."""
    return i.stored("timesheet", lambda: final_timesheet(i))


def totals(i: Inputs) -> DataFrame:
    return pr.employee_totals(sheet(i), PAY_START, PERIODS)


def base(i: Inputs) -> DataFrame:
    return i.stored("base", lambda: pr.pay_base(sheet(i), i.payrate, i.holidays, PAY_START, PERIODS))


def production(i: Inputs) -> DataFrame:
    return bo.production_bonus(qb.other(i))


def paid(i: Inputs) -> DataFrame:
    return pr.payroll(sheet(i), i.payrate, i.holidays, production(i), PAY_START, PERIODS, base=base(i))


def holiday_pay(i: Inputs) -> DataFrame:
    return rounded(pr.holiday_pay(base(i), sheet(i), i.holidays, PAY_START, PERIODS), "holiday_pay")


def _years(i: Inputs) -> DataFrame:
    return i.table("events").select(F.year("ts").alias("year")).union(
        i.table("orders").select(F.year("o_orderdate").alias("year"))
    ).distinct()


def holiday_dim(i: Inputs) -> DataFrame:
    return _years(i).select("year", F.inline(ontario_holidays(F.col("year"))))


def calendar(i: Inputs) -> DataFrame:
    """The holidays, observed days included, of the years of the time sheets and of the year before."""
    years = sheet(i).select(F.explode(F.array(F.year("start_ts"), F.year("start_ts") - 1)).alias("year")).distinct()
    return years.select(F.inline(ontario_holidays(F.col("year"), substitutes=True)))


def calendar_pay(i: Inputs) -> DataFrame:
    """Holiday pay by the computed calendar."""
    days = i.stored("calendar", lambda: calendar(i))
    paid_base = pr.pay_base(sheet(i), i.payrate, days, PAY_START, PERIODS)
    return rounded(pr.holiday_pay(paid_base, sheet(i), days, PAY_START, PERIODS), "holiday_pay")


QUERIES = {
    "holiday_observed": lambda i: _years(i).select("year", F.inline(ontario_holidays(F.col("year"), substitutes=True))).filter(
        F.col("description").endswith("(observed)")),
    "holiday_pay_calendar": calendar_pay,
    "employee_totals": lambda i: rounded(totals(i), "total_hours"),
    "period_filter": lambda i: pr.sheet_in_periods(i.timesheet, PAY_START, 1),
    "payrate_join": lambda i: rounded(pr.join_rates(totals(i), i.payrate), "total_hours"),
    "unmatched_employees": lambda i: pr.unmatched_employees(pr.join_rates(totals(i), i.payrate)).select(
        "employee_number", "period", "first_name", "last_name"
    ),
    "holiday_dim": holiday_dim,
    "holiday_in_period": lambda i: pr.with_holiday_flags(totals(i), i.holidays, PAY_START).select(
        "employee_number", "period", "has_holiday", "had_holiday"
    ),
    "rolling_period_hours": lambda i: rounded(
        pr.with_rolling_hours(totals(i)).select("employee_number", "period", "rolling_hours"), "rolling_hours"
    ),
    "pay_basis": lambda i: i.payrate.select("employee_id", pay_basis(F.col("pay_basis")).alias("pay_basis")),
    "salary": lambda i: rounded(
        base(i).select("employee_number", "period", "salary", "regular_pay", "overtime_pay"),
        "salary", "regular_pay", "overtime_pay",
    ),
    "holiday_pay": holiday_pay,
    "bonus_join": lambda i: rounded(
        pr.join_bonus(totals(i), pr.bonus_totals(production(i), PAY_START, PERIODS)).select(
            "employee_number", "period", "bonus"
        ), "bonus",
    ),
    "total_compensation": lambda i: rounded(
        paid(i).select("employee_number", "period", "salary", "bonus", "total_compensation"),
        "salary", "bonus", "total_compensation",
    ),
    "payroll_periods": lambda i: rounded(
        paid(i).select("employee_number", "period_start", "period_end", "total_hours", "working_days", "salary",
                       "holiday_pay", "bonus", "total_compensation"),
        "total_hours", "salary", "holiday_pay", "bonus", "total_compensation",
    ),
    "payroll_summary": lambda i: rounded(
        pr.pay_summary(paid(i)), "total_hours", "regular_pay", "overtime_pay", "holiday_pay", "bonus",
        "total_compensation",
    ),
    "payroll_detail": lambda i: rounded(
        pr.pay_detail(paid(i), sheet(i), PAY_START, PERIODS), "working_hours", "total_hours", "holiday_pay",
        "bonus", "total_compensation",
    ),
}

_P = f"CAST(floor(date_diff('day', DATE '2024-01-01', {{0}})/14.0) AS INT)"
_IN = "{0} BETWEEN DATE '2024-01-01' AND DATE '2024-01-01' + 41"
_FIRST = "first({0} ORDER BY start_ts, end_ts, job, adj_start, adj_end)"
_CHAIN = ",\n".join(STEPS.values())
_INPUTS = f"WITH {ctes('timesheet', 'schedule', 'payrate', 'holidays')},\n{_CHAIN}"
_TOTALS = f""",
dated AS (SELECT *, CAST(start_ts AS DATE) AS start_date, {_P.format('CAST(start_ts AS DATE)')} AS period FROM final
  WHERE {_IN.format('CAST(start_ts AS DATE)')}),
totals AS (SELECT employee_number, period, sum(working_hours) AS total_hours,
  count(DISTINCT start_date) AS working_days, {_FIRST.format('department')} AS department,
  {_FIRST.format('first_name')} AS first_name, {_FIRST.format('last_name')} AS last_name
  FROM dated GROUP BY 1,2)"""
_BASE = f"""{_TOTALS},
hp AS (SELECT DISTINCT {_P.format('holiday_date')} AS period FROM holidays),
base0 AS (SELECT t.*, r.reg_rate, r.pay_basis, coalesce(r.skip_calc,'No') AS skip_calc,
    coalesce(r.follow_clock,'No') AS follow_clock, coalesce(r.ot_rate, r.reg_rate) AS ot_rate,
    coalesce(r.ot_trigger_holiday, 80) AS ot_trigger_holiday, coalesce(r.ot_trigger_regular, 80) AS ot_trigger_regular,
    t.period IN (SELECT period FROM hp) AS has_holiday, t.period-1 IN (SELECT period FROM hp) AS had_holiday,
    sum(t.total_hours) OVER (PARTITION BY t.employee_number ORDER BY t.period ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)
      AS rolling_hours
  FROM totals t LEFT JOIN payrate r ON r.employee_id=t.employee_number),
base1 AS (SELECT *, CASE WHEN has_holiday THEN ot_trigger_holiday ELSE ot_trigger_regular END AS trig,
    CASE WHEN had_holiday THEN ot_trigger_holiday ELSE ot_trigger_regular END AS trig_before,
    CASE WHEN reg_rate IS NULL OR department='Temp' OR pay_basis IS NULL
           OR NOT regexp_matches(lower(pay_basis), 'annual|hourly|daily') OR skip_calc='Yes' THEN 'none'
         WHEN lower(pay_basis) LIKE '%daily%' THEN 'daily' WHEN lower(pay_basis) LIKE '%annual%' THEN 'annual'
         WHEN follow_clock='Yes' THEN 'clock' ELSE 'trigger' END AS kind FROM base0),
base2 AS (SELECT *, CAST(CASE kind WHEN 'none' THEN 0 WHEN 'daily' THEN working_days*reg_rate WHEN 'annual' THEN reg_rate
      WHEN 'clock' THEN total_hours*reg_rate ELSE trig*reg_rate END AS DOUBLE) AS regular_pay,
    CAST(CASE kind WHEN 'trigger' THEN greatest(0, total_hours-trig)*ot_rate ELSE 0 END AS DOUBLE) AS overtime_pay FROM base1),
base AS (SELECT *, regular_pay+overtime_pay AS salary FROM base2)"""
_HOLIDAY = f""",
hpay AS (SELECT b.employee_number, b.period, h.holiday_date, CAST(CASE WHEN b.department='Temp' THEN 0 ELSE
    coalesce((SELECT sum(working_hours) FROM dated d WHERE d.employee_number=b.employee_number
              AND d.start_date=h.holiday_date), 0)*b.ot_rate
    + least(b.rolling_hours, b.trig+b.trig_before)/10*b.reg_rate END AS DOUBLE) AS holiday_pay
  FROM base b JOIN holidays h ON {_P.format('h.holiday_date')}=b.period)"""
_PAID = f"""{_BASE}{_HOLIDAY},
bonus_rows AS (SELECT employee_number, {_P.format('start_date')} AS period, sum(silver_bonus+gold_bonus) AS bonus
  FROM other_rows WHERE start_date IS NOT NULL AND {_IN.format('start_date')} GROUP BY 1,2),
paid AS (SELECT b.*, coalesce(x.bonus, 0) AS bonus, coalesce(h.holiday_pay, 0) AS holiday_pay,
    b.salary+coalesce(x.bonus, 0) AS total_compensation, DATE '2024-01-01'+14*b.period AS period_start,
    DATE '2024-01-01'+14*b.period+13 AS period_end
  FROM base b LEFT JOIN bonus_rows x USING (employee_number, period)
  LEFT JOIN (SELECT employee_number, period, sum(holiday_pay) AS holiday_pay FROM hpay GROUP BY 1,2) h
    USING (employee_number, period))"""
# The bonus side rebuilds the time sheet its own way; its steps get names of their own.
_OTHER = qb._HOURS.replace("hours AS (", "raw_hours AS (", 1).replace("FROM hours ", "FROM raw_hours ")
_W_PAID = (
    f"WITH {ctes('timesheet', 'schedule', 'payrate', 'holidays', 'bonus_rate', 'operator_output', 'die_price')},\n"
    f"{_CHAIN},\n{_OTHER},\n{qb._OTHER}{_PAID}\n"
)


def _r(*cols: str) -> str:
    return ", ".join(f"round({c}, 4) AS {c}" for c in cols)


_YEARS = """years AS (SELECT DISTINCT CAST(year(ts) AS INT) AS y FROM events
    UNION SELECT CAST(year(o_orderdate) AS INT) FROM orders)"""
_CALENDAR = """days AS (SELECT y, CAST(unnest(generate_series(make_date(y,1,1), make_date(y,12,31), INTERVAL 1 DAY)) AS DATE) AS d FROM years),
parts AS (SELECT *, month(d) AS m, day(d) AS dd, isodow(d) AS w FROM days),
e1 AS (SELECT y, y%19 AS a, y//100 AS b, y%100 AS c FROM years),
e2 AS (SELECT y, a, (19*a+b-b//4-(b-(b+8)//25+1)//3+15)%30 AS h, b, c FROM e1),
e3 AS (SELECT y, a, h, (32+2*(b%4)+2*(c//4)-h-c%4)%7 AS l FROM e2),
e4 AS (SELECT y, h+l-7*((a+11*h+22*l)//451)+114 AS n FROM e3),
easter AS (SELECT y, make_date(CAST(y AS BIGINT), CAST(n//31 AS BIGINT), CAST(n%31+1 AS BIGINT)) AS e FROM e4),
fixed AS (SELECT y AS year, d AS holiday_date, CASE WHEN m=1 THEN 'New Year''s Day' WHEN m=2 THEN 'Family Day'
  WHEN d=e-2 THEN 'Good Friday' WHEN m=5 THEN 'Victoria Day' WHEN m=7 THEN 'Canada Day' WHEN m=8 THEN 'Civic Holiday'
  WHEN m=9 THEN 'Labour Day' WHEN m=10 THEN 'Thanksgiving' WHEN dd=25 THEN 'Christmas Day' ELSE 'Boxing Day' END AS description
FROM parts JOIN easter USING (y) WHERE (m=1 AND dd=1) OR (m=2 AND w=1 AND dd BETWEEN 15 AND 21) OR d=e-2
  OR (m=5 AND w=1 AND dd BETWEEN 18 AND 24) OR (m=7 AND dd=1) OR (m IN (8,9) AND w=1 AND dd<=7)
  OR (m=10 AND w=1 AND dd BETWEEN 8 AND 14) OR (m=12 AND dd IN (25,26)))"""
# The four holidays of a fixed date, by the weekday they fall on.
_OBSERVED = """observed AS (SELECT y AS year, CASE name WHEN 'New Year''s Day' THEN make_date(y, 1, CASE isodow(make_date(y, 1, 1)) WHEN 6 THEN 3 ELSE 2 END)
    WHEN 'Canada Day' THEN make_date(y, 7, CASE isodow(make_date(y, 7, 1)) WHEN 6 THEN 3 ELSE 2 END)
    WHEN 'Christmas Day' THEN make_date(y, 12, 27) ELSE make_date(y, 12, 28) END AS holiday_date, name||' (observed)' AS description
  FROM (SELECT y, unnest(['New Year''s Day', 'Canada Day', 'Christmas Day', 'Boxing Day']) AS name FROM years)
  WHERE isodow(CASE name WHEN 'New Year''s Day' THEN make_date(y, 1, 1) WHEN 'Canada Day' THEN make_date(y, 7, 1)
    WHEN 'Christmas Day' THEN make_date(y, 12, 25) ELSE make_date(y, 12, 26) END) >= 6)"""

ORACLES = {
    "employee_totals": f"{_INPUTS}{_TOTALS} SELECT * REPLACE ({_r('total_hours')}) FROM totals",
    "period_filter": f"""WITH {ctes('timesheet')} SELECT *, CAST(start_ts AS DATE) AS start_date, CAST(0 AS INT) AS period
  FROM timesheet WHERE CAST(start_ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-14'""",
    "payrate_join": f"""{_INPUTS}{_TOTALS} SELECT t.* REPLACE ({_r('total_hours')}), r.* EXCLUDE (employee_id)
  FROM totals t LEFT JOIN payrate r ON r.employee_id=t.employee_number""",
    "unmatched_employees": f"""{_INPUTS}{_TOTALS} SELECT employee_number, period, first_name, last_name FROM totals
  WHERE employee_number NOT IN (SELECT employee_id FROM payrate WHERE reg_rate IS NOT NULL)""",
    "holiday_dim": f"WITH {_YEARS},\n{_CALENDAR} SELECT * FROM fixed",
    "holiday_observed": f"WITH {_YEARS},\n{_CALENDAR}, {_OBSERVED} SELECT * FROM observed",
    "holiday_pay_calendar": f"""WITH {ctes('timesheet', 'schedule', 'payrate')}, years AS (SELECT DISTINCT
    CAST(unnest([year(start_ts), year(start_ts)-1]) AS INT) AS y FROM timesheet), {_CALENDAR}, {_OBSERVED},
holidays AS (SELECT holiday_date, description FROM fixed UNION ALL SELECT holiday_date, description FROM observed),
{_CHAIN}{_BASE}{_HOLIDAY} SELECT employee_number, period, holiday_date, {_r('holiday_pay')} FROM hpay""",
    "holiday_in_period": f"{_INPUTS}{_BASE} SELECT employee_number, period, has_holiday, had_holiday FROM base",
    "rolling_period_hours": f"{_INPUTS}{_BASE} SELECT employee_number, period, {_r('rolling_hours')} FROM base",
    "pay_basis": f"""WITH {ctes('payrate')} SELECT employee_id, CASE WHEN lower(pay_basis) LIKE '%daily%' THEN 'daily'
  WHEN lower(pay_basis) LIKE '%annual%' THEN 'annual' WHEN lower(pay_basis) LIKE '%hourly%' THEN 'hourly' END AS pay_basis
  FROM payrate""",
    "salary": f"{_INPUTS}{_BASE} SELECT employee_number, period, {_r('salary', 'regular_pay', 'overtime_pay')} FROM base",
    "holiday_pay": f"""{_INPUTS}{_BASE}{_HOLIDAY} SELECT employee_number, period, holiday_date, {_r('holiday_pay')} FROM hpay""",
    "bonus_join": f"{_W_PAID} SELECT employee_number, period, {_r('bonus')} FROM paid",
    "total_compensation": f"""{_W_PAID} SELECT employee_number, period, {_r('salary', 'bonus', 'total_compensation')}
  FROM paid""",
    "payroll_periods": f"""{_W_PAID} SELECT employee_number, period_start, period_end, working_days,
  {_r('total_hours', 'salary', 'holiday_pay', 'bonus', 'total_compensation')} FROM paid""",
    "payroll_summary": f"""{_W_PAID} SELECT period_start, period_end, employee_number,
  first_name||' '||last_name AS employee_name, department, {_r('total_hours', 'holiday_pay', 'bonus', 'total_compensation')},
  round(salary-ot_rate*greatest(0, total_hours-ot_trigger_holiday), 4) AS regular_pay,
  round(ot_rate*greatest(0, total_hours-ot_trigger_holiday), 4) AS overtime_pay FROM paid""",
    "payroll_detail": f"""{_W_PAID} SELECT d.employee_number, d.first_name, d.last_name, d.job, d.department, d.start_ts,
  d.end_ts, d.adj_start, d.adj_end, round(d.working_hours, 4) AS working_hours, p.period_start, p.period_end,
  round(p.total_hours, 4) AS total_hours, p.reg_rate, p.ot_rate, p.pay_basis, p.follow_clock, p.ot_trigger_holiday,
  p.ot_trigger_regular, round(p.holiday_pay, 4) AS holiday_pay, round(p.bonus, 4) AS bonus,
  round(p.total_compensation, 4) AS total_compensation FROM dated d JOIN paid p USING (employee_number, period)""",
}
