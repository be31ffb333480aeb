"""Registered queries of the performance and bonus calculation."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.functions import rules
from shopledger.operators import bonus as bo
from shopledger.operators import timeclock as tc
from shopledger.plans.adapters import Inputs, ctes
from shopledger.plans.queries_clock import _EXACT, _RAW_HOURS, rounded

MONEY = ("working_hours", "output_qty", "revenue", "silver_bonus", "gold_bonus")


def hours(i: Inputs) -> DataFrame:
    return tc.timesheet_hours(i.timesheet)


def output(i: Inputs) -> DataFrame:
    return bo.clean_operator_output(i.operator_output)


def prices(i: Inputs) -> DataFrame:
    return bo.explode_prices(i.die_price)


def long_runs(rows: DataFrame) -> DataFrame:
    """A make-ready per job, and one more per code of which it made 30 or more."""
    codes = rows.groupBy(*bo.JOB, "main_product_code").agg(F.sum("output_qty").alias("qty"))
    return codes.groupBy(*bo.JOB).agg((1 + F.count_if(F.col("qty") >= 30)).alias("make_ready"))


def daily(i: Inputs) -> DataFrame:
    return bo.daily_output(output(i), prices(i))


def sheets(i: Inputs) -> DataFrame:
    return bo.sheeting_daily(bo.clean_sheeting(i.sheeting))


def sheeting(i: Inputs, worked: DataFrame | None = None) -> DataFrame:
    return bo.sheeting_bonus(hours(i) if worked is None else worked, sheets(i), bo.clean_bonus_rate(i.bonus_rate))


def other(i: Inputs, worked: DataFrame | None = None) -> DataFrame:
    return bo.other_process_bonus(hours(i) if worked is None else worked, daily(i), bo.clean_bonus_rate(i.bonus_rate))


def performance(i: Inputs) -> DataFrame:
    worked = i.stored("worked", lambda: hours(i))
    return bo.performance_union(sheeting(i, worked), other(i, worked))


def _rule(tier: str):
    def query(i: Inputs) -> DataFrame:
        rows = bo.join_output_hours(hours(i), daily(i))
        return rows.select(
            "process", "shift_date", "member_id", "working_hours", "make_ready", "output_qty", "revenue",
            "number_of_lines", rules.eligibility(tier).alias("eligible"),
        )

    return query


QUERIES = {
    "sheeting_clean": lambda i: bo.clean_sheeting(i.sheeting),
    "operator_output_clean": output,
    "bonus_rate_clean": lambda i: bo.clean_bonus_rate(i.bonus_rate),
    "project_rename": lambda i: i.bonus_rate.select(
        F.col("employee_number").alias("payroll_no"), "machine", "gold_rate"
    ),
    "split_codes": lambda i: output(i).select("main_product_code").distinct(),
    "die_price_explode": prices,
    "process_relabel": lambda i: bo.relabel_process(output(i)).select("member_id", "device_name", "process"),
    "revenue_lookup": lambda i: bo.join_prices(output(i), prices(i)).select(
        "erp_num", "main_product_code", "member_id", "shift_date", "output_qty", "price", "revenue"
    ),
    "sheeting_daily": sheets,
    "join_inner": lambda i: bo.join_daily_hours(hours(i), sheets(i)),
    "join_left_dim": lambda i: bo.join_machine_rate(hours(i), bo.clean_bonus_rate(i.bonus_rate)),
    "gold_sheeting": lambda i: sheeting(i).select(
        "employee_number", "start_date", "working_hours", "paper_sheets", "gold_rate", "gold", "gold_bonus"
    ),
    "sheeting_bonus": sheeting,
    "dedup_rows": lambda i: bo.join_machine_rate(
        bo.join_daily_hours(hours(i), sheets(i)), bo.clean_bonus_rate(i.bonus_rate)
    ).select("employee_number", "start_date", "paper_sheets", "gold_rate").dropDuplicates(),
    "make_ready": lambda i: daily(i).select(*bo.DAY, "make_ready"),
    "make_ready_group_rule": lambda i: bo.daily_output(output(i), prices(i), group_rule=long_runs).select(
        *bo.DAY, "make_ready"),
    "number_of_lines": lambda i: daily(i).select(*bo.DAY, "number_of_lines"),
    "output_rollup": daily,
    "join_right": lambda i: bo.join_output_hours(hours(i), daily(i)),
    "silver_rules": _rule("silver"),
    "gold_rules": _rule("gold"),
    "other_process_bonus": other,
    "performance_union": performance,
    "bonus_report": lambda i: bo.bonus_report(performance(i)),
    "not_reported_report": lambda i: bo.not_reported_report(performance(i)),
    "production_bonus": lambda i: rounded(bo.production_bonus(other(i)), "bonus"),
    "summary_process_location": lambda i: rounded(
        bo.summary_by(performance(i), ["process", "location"]), "working_hours", "output_qty", "revenue"
    ),
    "summary_employee_hours": lambda i: rounded(bo.employee_summary(performance(i), "working_hours"), "working_hours"),
    "summary_employee_makeready": lambda i: bo.employee_summary(performance(i), "make_ready"),
    "summary_employee_qty": lambda i: rounded(bo.employee_summary(performance(i), "output_qty"), "output_qty"),
    "summary_employee_revenue": lambda i: rounded(bo.employee_summary(performance(i), "revenue"), "revenue"),
    "report_range": lambda i: bo.report_range(performance(i)),
}

_HOURS = f"""{_RAW_HOURS},
{_EXACT},
worked AS (SELECT employee_number, first_name, last_name, department, job, CAST(start_ts AS DATE) AS start_date,
  working_hours FROM exact WHERE working_hours<>0)"""
_OUTPUT = """output AS (SELECT * REPLACE (split_part(main_product_code, '|', 1) AS main_product_code)
  FROM operator_output WHERE member_id IS NOT NULL),
labelled AS (SELECT * REPLACE (CASE WHEN process='Printing' AND device_name='SP1-HD102CX' THEN 'Printing_CX102'
  WHEN process='Printing' AND device_name='CP1-HD104CX' THEN 'Printing_CX104' ELSE process END AS process) FROM output),
prices AS (SELECT trim(unnest(string_split(erp_num, ','))) AS erp_num, product_id, price FROM die_price)"""
_DAILY = f"""{_OUTPUT},
priced AS (SELECT l.*, p.price, l.output_qty*p.price AS revenue FROM labelled l
  LEFT JOIN prices p ON l.erp_num=p.erp_num AND l.main_product_code=p.product_id),
jobs AS (SELECT process, shift_date, member_id, CASE process
    WHEN 'Die Cutting' THEN count(DISTINCT die_number)
    WHEN 'Printing' THEN count(DISTINCT product)*count(DISTINCT main_product_code)
      *count(DISTINCT CASE WHEN makeup_style IS NOT NULL THEN main_product_code||'#'||makeup_style END)
    ELSE count(DISTINCT main_product_code) END AS make_ready
  FROM priced WHERE product IS NOT NULL AND device_name IS NOT NULL AND die_number IS NOT NULL
  GROUP BY process, shift_date, member_id, product, device_name, die_number),
ready AS (SELECT process, shift_date, member_id, sum(make_ready) AS make_ready FROM jobs GROUP BY 1,2,3),
summed AS (SELECT process, shift_date, member_id, sum(output_qty) AS output_qty,
    count(DISTINCT device_name) AS number_of_lines, coalesce(sum(revenue), 0) AS revenue FROM priced GROUP BY 1,2,3),
daily AS (SELECT process, shift_date, member_id, output_qty, CAST(coalesce(make_ready, 0) AS BIGINT) AS make_ready,
    number_of_lines, revenue FROM summed LEFT JOIN ready USING (process, shift_date, member_id))"""
_SHEETS = """sheets AS (SELECT employee_number, CAST(start_time AS DATE) AS start_date,
  CAST(sum(paper_sheets) AS DOUBLE) AS paper_sheets FROM sheeting GROUP BY 1,2)"""
_SHEETING = f"""{_SHEETS},
sheet_rows AS (SELECT w.*, s.paper_sheets, r.name, r.location, r.machine, r.silver_rate, r.gold_rate,
    coalesce((working_hours>7 AND working_hours<=8 AND paper_sheets>=80000)
      OR (working_hours>8 AND working_hours<=10 AND paper_sheets>=100000)
      OR (working_hours>10 AND working_hours<=12 AND paper_sheets>=120000)
      OR (working_hours>=12 AND paper_sheets>=120000+floor(working_hours-12)*10000), false) AS gold
  FROM worked w JOIN sheets s USING (employee_number, start_date)
  LEFT JOIN bonus_rate r ON r.employee_number=w.employee_number AND r.machine='Sheeter'),
sheet_bonus AS (SELECT DISTINCT *, CASE WHEN gold THEN working_hours*gold_rate ELSE 0.0::DOUBLE END AS gold_bonus,
  CASE WHEN paper_sheets>0 AND working_hours IS NULL THEN 'yes' ELSE 'no' END AS flag_not_report_working_hour
  FROM sheet_rows)"""
_RULES = """printing(tier, process, step, rate, free, cap, n) AS (VALUES
  ('silver','Printing_CX102',1.00,8000,2,8,9), ('silver','Printing_CX102',1.00,8000,2,10,11),
  ('silver','Printing_CX102',1.00,8000,2,12,13), ('silver','Printing_CX104',1.00,8500,2,8,9),
  ('silver','Printing_CX104',1.00,8500,2,10,11), ('silver','Printing_CX104',1.00,8500,2,12,13),
  ('gold','Printing_CX102',0.85,9000,1,8,9), ('gold','Printing_CX102',0.85,9000,1,10,12),
  ('gold','Printing_CX102',0.85,9000,1,12,14), ('gold','Printing_CX104',0.85,9500,1,8,9),
  ('gold','Printing_CX104',0.85,9500,1,10,12), ('gold','Printing_CX104',0.85,9500,1,12,14)),
print_rules AS (SELECT tier, process, cap, m, CAST(cap-step*(m-1) AS DOUBLE) AS min_h,
    CAST(CASE WHEN m>n-free THEN 0 ELSE rate*(cap-step*(m-1)) END AS DOUBLE) AS min_q
  FROM (SELECT *, unnest(generate_series(1, n)) AS m FROM printing)),
cutting(tier, step, rate) AS (VALUES ('silver',2.0,4300), ('gold',1.5,5300)),
cut_rules AS (SELECT tier, cap, m, CAST(cap-step*(m-1) AS DOUBLE) AS min_h,
    CAST(CASE WHEN tier='silver' AND cap=8 AND m=1 THEN 34000 ELSE rate*(cap-step*(m-1)) END AS DOUBLE) AS min_q
  FROM cutting, (SELECT unnest([8,10,12]) AS cap), (SELECT unnest([1,2,3,4]) AS m))"""
_BAND = "CASE WHEN working_hours>12 THEN 12 WHEN working_hours>10 THEN 10 WHEN working_hours>8 THEN 8 END"


def _eligible(tier: str) -> str:
    rate = {"silver": 3500, "gold": 4000}[tier]
    return f"""coalesce(CASE WHEN process='Die Cutting' THEN working_hours>8 AND ((make_ready>=5 AND output_qty>=0)
    OR EXISTS (SELECT 1 FROM cut_rules r WHERE r.tier='{tier}' AND r.cap={_BAND} AND r.m=make_ready
       AND working_hours>=r.min_h AND output_qty>=r.min_q))
  WHEN process IN ('Gluing','WindowPatching') THEN revenue >= {rate}*{_BAND}
    * (CASE WHEN number_of_lines=1 THEN 1 ELSE 0.75*number_of_lines END)
  ELSE EXISTS (SELECT 1 FROM print_rules r WHERE r.tier='{tier}' AND r.process=o.process AND working_hours<=r.cap
    AND r.m=make_ready AND working_hours>=r.min_h AND output_qty>=r.min_q) END, false)"""


_JOINED = """joined AS (SELECT d.*, w.employee_number, w.first_name, w.last_name, w.start_date, w.working_hours
  FROM worked w RIGHT JOIN daily d ON w.employee_number=d.member_id AND w.start_date=d.shift_date)"""
_OTHER = f"""{_DAILY},
{_JOINED},
{_RULES},
rated AS (SELECT o.*, r.name, r.location, r.machine, r.silver_rate, r.gold_rate,
    {_eligible('gold')} AS gold, {_eligible('silver')} AS silver_only
  FROM joined o LEFT JOIN bonus_rate r ON o.employee_number=r.employee_number),
other_rows AS (SELECT * EXCLUDE (silver_only) REPLACE (coalesce(employee_number, member_id) AS employee_number),
    silver_only AND NOT gold AS silver,
    CASE WHEN (output_qty>0 OR make_ready>0) AND working_hours IS NULL THEN 'yes' ELSE 'no' END
      AS flag_not_report_working_hour,
    coalesce(CASE WHEN silver_only AND NOT gold THEN working_hours*silver_rate END, 0) AS silver_bonus,
    coalesce(CASE WHEN gold THEN working_hours*gold_rate END, 0) AS gold_bonus FROM rated)"""
_COLUMNS = ", ".join(bo.COMMON_COLUMNS)
_PERFORMANCE = f"""{_HOURS},
{_SHEETING},
{_OTHER},
performance AS (SELECT {_COLUMNS} FROM (SELECT *, 'Sheeting' AS process, paper_sheets AS output_qty,
    1::BIGINT AS make_ready, 1::BIGINT AS number_of_lines, 0.0::DOUBLE AS revenue, false AS silver,
    0.0::DOUBLE AS silver_bonus FROM sheet_bonus)
  UNION ALL SELECT {_COLUMNS} FROM other_rows)"""
_W_OUT = f"WITH {ctes('operator_output', 'die_price')},\n"
_W_HOURS = f"WITH {ctes('timesheet', 'sheeting', 'bonus_rate')},\n{_HOURS},\n"
_W_ALL = f"WITH {ctes('timesheet', 'sheeting', 'bonus_rate', 'operator_output', 'die_price')},\n"
_W_PERF = f"{_W_ALL}{_PERFORMANCE}\n"
_SHEET_JOIN = "worked w JOIN sheets s USING (employee_number, start_date)"
_RATE_JOIN = "LEFT JOIN bonus_rate r ON r.employee_number=w.employee_number AND r.machine='Sheeter'"


def _rule_sql(tier: str) -> str:
    return f"""{_W_ALL}{_HOURS},\n{_DAILY},\n{_JOINED},\n{_RULES}
SELECT process, shift_date, member_id, working_hours, make_ready, output_qty, revenue, number_of_lines,
  {_eligible(tier)} AS eligible FROM joined o"""


def _having(measure: str, limit: str, cast: str) -> str:
    return f"""{_W_PERF}SELECT employee_number, process, {cast.format(f'sum({measure})')} AS {measure} FROM performance
WHERE employee_number IS NOT NULL AND process IS NOT NULL GROUP BY 1,2 HAVING coalesce(sum({measure}), 0){limit}"""


ORACLES = {
    "sheeting_clean": f"""WITH {ctes('sheeting')} SELECT employee_number, start_time,
  CAST(paper_sheets AS DOUBLE) AS paper_sheets FROM sheeting WHERE paper_sheets IS NOT NULL""",
    "operator_output_clean": f"{_W_OUT}{_OUTPUT} SELECT * FROM output",
    "bonus_rate_clean": f"WITH {ctes('bonus_rate')} SELECT * FROM bonus_rate",
    "project_rename": f"WITH {ctes('bonus_rate')} SELECT employee_number AS payroll_no, machine, gold_rate FROM bonus_rate",
    "split_codes": f"{_W_OUT}{_OUTPUT} SELECT DISTINCT main_product_code FROM output",
    "die_price_explode": f"{_W_OUT}{_OUTPUT} SELECT * FROM prices",
    "process_relabel": f"{_W_OUT}{_OUTPUT} SELECT member_id, device_name, process FROM labelled",
    "revenue_lookup": f"""{_W_OUT}{_OUTPUT} SELECT o.erp_num, o.main_product_code, o.member_id, o.shift_date,
  o.output_qty, p.price, o.output_qty*p.price AS revenue FROM output o
  LEFT JOIN prices p ON o.erp_num=p.erp_num AND o.main_product_code=p.product_id""",
    "sheeting_daily": f"WITH {ctes('sheeting')}, {_SHEETS} SELECT * FROM sheets",
    "join_inner": f"{_W_HOURS}{_SHEETS} SELECT w.*, s.paper_sheets FROM {_SHEET_JOIN}",
    "join_left_dim": f"{_W_HOURS}{_SHEETS} SELECT w.*, r.* EXCLUDE (employee_number) FROM worked w {_RATE_JOIN}",
    "gold_sheeting": f"""{_W_HOURS}{_SHEETING} SELECT employee_number, start_date, working_hours, paper_sheets,
  gold_rate, gold, gold_bonus FROM sheet_bonus""",
    "sheeting_bonus": f"{_W_HOURS}{_SHEETING} SELECT * FROM sheet_bonus",
    "dedup_rows": f"""{_W_HOURS}{_SHEETS} SELECT DISTINCT w.employee_number, w.start_date, s.paper_sheets, r.gold_rate
  FROM {_SHEET_JOIN} {_RATE_JOIN}""",
    "make_ready_group_rule": f"""{_W_OUT}{_OUTPUT}, codes AS (SELECT process, shift_date, member_id, product, device_name, die_number,
    main_product_code, sum(output_qty) AS qty FROM labelled GROUP BY ALL),
jobs AS (SELECT process, shift_date, member_id, device_name, CASE WHEN product IS NOT NULL AND device_name IS NOT NULL AND die_number IS NOT NULL
    THEN 1+count(*) FILTER (qty >= 30) END AS make_ready FROM codes WHERE process IS NOT NULL AND shift_date IS NOT NULL AND member_id IS NOT NULL
  GROUP BY process, shift_date, member_id, product, device_name, die_number)
SELECT process, shift_date, member_id, CAST(coalesce(sum(make_ready), 0) AS BIGINT) AS make_ready FROM jobs GROUP BY 1, 2, 3""",
    "make_ready": f"{_W_OUT}{_DAILY} SELECT process, shift_date, member_id, make_ready FROM daily",
    "number_of_lines": f"{_W_OUT}{_DAILY} SELECT process, shift_date, member_id, number_of_lines FROM daily",
    "output_rollup": f"{_W_OUT}{_DAILY} SELECT * FROM daily",
    "join_right": f"{_W_ALL}{_HOURS},\n{_DAILY},\n{_JOINED} SELECT * FROM joined",
    "silver_rules": _rule_sql("silver"),
    "gold_rules": _rule_sql("gold"),
    "other_process_bonus": f"{_W_ALL}{_HOURS},\n{_OTHER} SELECT * FROM other_rows",
    "performance_union": f"{_W_PERF} SELECT * FROM performance",
    "bonus_report": f"{_W_PERF} SELECT * FROM performance WHERE silver OR gold",
    "not_reported_report": f"""{_W_PERF} SELECT employee_number, min(process) AS process,
  CAST(sum(make_ready) AS BIGINT) AS make_ready, sum(output_qty) AS output_qty, sum(revenue) AS revenue
  FROM performance WHERE flag_not_report_working_hour='yes' GROUP BY 1""",
    "production_bonus": f"""{_W_ALL}{_HOURS},\n{_OTHER} SELECT start_date AS bonus_date, employee_number AS employee_id,
  round(sum(silver_bonus+gold_bonus), 4) AS bonus FROM other_rows WHERE start_date IS NOT NULL GROUP BY 1,2""",
    "summary_process_location": f"""{_W_PERF} SELECT process, location, round(sum(working_hours), 4) AS working_hours,
  CAST(sum(make_ready) AS BIGINT) AS make_ready, round(sum(output_qty), 4) AS output_qty,
  round(sum(revenue), 4) AS revenue FROM performance WHERE process IS NOT NULL AND location IS NOT NULL GROUP BY 1,2""",
    "summary_employee_hours": _having("working_hours", ">=8", "round({}, 4)"),
    "summary_employee_makeready": _having("make_ready", ">0", "CAST({} AS BIGINT)"),
    "summary_employee_qty": _having("output_qty", ">100", "round({}, 4)"),
    "summary_employee_revenue": _having("revenue", ">100", "round({}, 4)"),
    "report_range": f"""{_W_PERF} SELECT min(start_date) AS first_date, max(start_date) AS last_date,
  'Production Report from '||strftime(min(start_date), '%Y-%m-%d')||' to '||strftime(max(start_date), '%Y-%m-%d')
  AS report_name FROM performance""",
}
