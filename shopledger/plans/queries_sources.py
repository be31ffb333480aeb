"""Registered queries of the sources, sinks and generic cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger import schemas
from shopledger.functions.clock import parse_datetime
from shopledger.functions.text import to_number
from shopledger.operators import bonus as bo
from shopledger.operators import cleaning as cl
from shopledger.operators import sales as sa
from shopledger.operators import timeclock as tc
from shopledger.plans import queries_bonus as qb
from shopledger.plans.adapters import Inputs, ctes
from shopledger.plans.queries_clock import rounded
from shopledger.session import new_folder, store
from shopledger.sources import files as fs

DEPARTMENTS = ["Business", "Temp", "Production", "Warehouse"]
ROW_ORDER = ["employee_number", "start_ts", "end_ts", "job"]


def _uid(name: str = "employee_number"):
    return F.substring(F.col(name), 3, 20).cast("int")


def timesheet_text(i: Inputs) -> DataFrame:
    """The time sheet as text, with a date that does not exist for some employees."""
    bad = (_uid() % 7 == 0) & (F.dayofmonth("start_ts") % 2 == 0)
    return i.timesheet.select(
        F.when(bad, "31/02/2024").otherwise(F.date_format("start_ts", "dd/MM/yyyy")).alias("start_date"),
        F.date_format("start_ts", "HH:mm").alias("start_time"),
        F.date_format("end_ts", "dd/MM/yyyy").alias("end_date"),
        F.when(_uid() % 7 == 1, "abc").otherwise(F.date_format("end_ts", "HH:mm")).alias("end_time"),
        "employee_number", "first_name", "last_name", "department", "job",
    )


def payrate_text(i: Inputs) -> DataFrame:
    """The pay rates as text, with blanks and words among the numbers."""
    uid = _uid("employee_id")
    reg = F.when(uid % 7 == 0, "abc").when(uid % 7 == 1, "  ").otherwise(F.col("reg_rate").cast("string"))
    basis = F.when(uid % 7 == 2, "").otherwise(F.col("pay_basis"))
    return i.payrate.select(
        "employee_id", reg.alias("reg_rate"), F.col("ot_rate").cast("string").alias("ot_rate"),
        basis.alias("pay_basis"), "skip_calc", "follow_clock",
        F.col("ot_trigger_holiday").cast("string").alias("ot_trigger_holiday"),
        F.col("ot_trigger_regular").cast("string").alias("ot_trigger_regular"),
    )


def schedule_text(i: Inputs) -> DataFrame:
    day = F.dayofmonth("sched_date")
    start = F.date_format("sched_start", "HH:mm")
    end = F.date_format(F.col("sched_start") + F.make_dt_interval(hours=F.lit(8)), "HH:mm")
    return i.schedule.select(
        F.date_format("sched_date", "yyyy-MM-dd").alias("sched_date"),
        F.when(day % 6 == 0, "All Day").otherwise(start).alias("sched_start"),
        F.when(day % 8 != 0, end).alias("sched_end"), "users", "availability_status",
    )


def _with_first_row(i: Inputs) -> DataFrame:
    """Time-sheet rows, flagged where they are the first of their employee in a department."""
    at = F.struct("start_ts", "end_ts", "job")
    first = i.timesheet.groupBy("employee_number", "department").agg(F.min(at).alias("first_at"))
    return i.timesheet.join(first, ["employee_number", "department"]).withColumn(
        "is_first", at == F.col("first_at")
    ).drop("first_at")


def drop_timesheets(i: Inputs) -> str:
    """Write one time-sheet file per department, names only on the first row of each employee."""
    folder = new_folder(i.spark, "drop")
    rows = store(_with_first_row(i), "rows")
    blanked = {c: F.when(F.col("is_first"), F.col(c)) for c in ("employee_number", "first_name", "last_name")}
    for department in DEPARTMENTS:
        part = rows.filter(F.col("department") == department).orderBy(*ROW_ORDER).select(
            F.date_format("start_ts", "dd/MM/yyyy").alias("start_date"),
            F.date_format("start_ts", "HH:mm").alias("start_time"),
            F.date_format("end_ts", "dd/MM/yyyy").alias("end_date"),
            F.date_format("end_ts", "HH:mm").alias("end_time"),
            *[e.alias(c) for c, e in blanked.items()], "job", F.lit(None).cast("string").alias("employee_notes"),
        )
        if department == "Temp":  # another order of the columns, and one more
            part = part.withColumn("Badge", F.lit("b")).select("first_name", "last_name", "employee_number", "Badge", *part.drop(*blanked).columns)
        layout = schemas.TIMESHEET_TEMP if department == "Temp" else schemas.TIMESHEET
        fs.write_csv(part, f"{folder}/{department} Timesheet.csv", layout)
    return folder


def drop_schedules(i: Inputs) -> str:
    folder = new_folder(i.spark, "drop")
    rows = schedule_text(i)
    export = F.coalesce(F.length("users") % 2 == 0, F.lit(True))
    fs.write_csv(rows.filter(export), f"{folder}/Production Schedule-Export.csv", schemas.SCHEDULE)
    fs.write_csv(rows.filter(~export), f"{folder}/Business Shift.csv", schemas.SCHEDULE)
    return folder


def load_timesheets(i: Inputs) -> DataFrame:
    return fs.load_timesheets(i.spark, drop_timesheets(i)).drop("employee_notes")


def load_union(i: Inputs) -> DataFrame:
    folder = new_folder(i.spark, "drop")
    output = i.operator_output
    shifts = F.col("process") == "Printing"
    fs.write_csv(output.filter(shifts), f"{folder}/Other printing.csv", schemas.OPERATOR_OUTPUT)
    fs.write_csv(output.filter(~shifts), f"{folder}/Other lines.csv", schemas.OPERATOR_OUTPUT)
    paths = [f"{folder}/Other printing.csv", f"{folder}/Other lines.csv"]
    return fs.load_union(i.spark, paths, schemas.OPERATOR_OUTPUT, bo.clean_operator_output)


def safe_read(i: Inputs) -> DataFrame:
    folder = new_folder(i.spark, "drop")
    fs.write_csv(i.bonus_rate, f"{folder}/Bonus rate.csv", schemas.BONUS_RATE)
    paths = [f"{folder}/Bonus rate.csv", f"{folder}/absent.csv"]
    return fs.safe_read(i.spark, paths, schemas.BONUS_RATE, ["employee_number", "machine", "silver_rate"]).drop(*fs.PLACE)


def rejected_records(i: Inputs) -> DataFrame:
    """Reports with an unclosed quote, a cell too many, bytes that are no text, no rate column, no line, or no file."""
    folder = new_folder(i.spark, "drop")
    kind = F.pmod(_uid(), F.lit(5))
    cells = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in schemas.BONUS_RATE.values()]
    line = F.concat_ws(",", *cells)
    line = F.when(kind == 0, F.concat(F.lit('"'), line)).when(kind == 1, F.concat(line, F.lit(",9"))).when(kind == 2, F.concat(line, F.lit(","))).otherwise(line)
    header = ",".join(schemas.BONUS_RATE)
    for name, labels in {"Bonus rate.csv": header, "Bonus of old.csv": header.replace("Silver Rate", "Rate")}.items():
        # one file with its header on top, as a report is: a few rows per employee
        top = i.spark.range(1).select(F.lit(0).alias("at"), F.lit(labels).alias("value"))
        both = top.unionByName(i.bonus_rate.select(F.lit(1).alias("at"), line.alias("value")))
        both.coalesce(1).sortWithinPartitions("at").select("value").write.text(f"{folder}/{name}")
    i.spark.range(1).select(F.lit("").alias("value")).write.text(f"{folder}/Bonus blank.csv")
    paths = [*(f"{folder}/{n}" for n in ("Bonus rate.csv", "Bonus of old.csv", "Bonus blank.csv")), f"{folder}/absent.csv"]
    read = fs.read_records(i.spark, paths, schemas.BONUS_RATE, ["employee_number", "machine", "silver_rate"])
    named = lambda df, reason: df.groupBy(fs.drop_name(F.col("file_path")).alias("file_name"), reason.alias("reason"))
    return named(read.rejected, F.col("reason")).agg(F.count("*").alias("n")).unionByName(
        named(read.rows, F.lit("read")).agg(F.count("*").alias("n")))


def landed_files(i: Inputs) -> DataFrame:
    """Two drops, the second with a report of the first under another name; every row of a report is there once."""
    landing = new_folder(i.spark, "landing")
    rates = i.bonus_rate.coalesce(1).sortWithinPartitions(*i.bonus_rate.columns)
    for names in (["Bonus rate.csv"], ["Bonus copy.csv", "Bonus east.csv"]):
        folder = new_folder(i.spark, "drop")
        for name in names:
            fs.write_csv(rates.filter("location = 'East'") if "east" in name else rates, f"{folder}/{name}", schemas.BONUS_RATE)
        fs.land(i.spark, folder, landing)
    rows = fs.read_landed(i.spark, landing, schemas.BONUS_RATE, ["employee_number", "location"]).rows
    files = fs.landed(i.spark, landing).select("drop", "file_name", F.col("path").alias("file_path"))
    return rows.join(files, "file_path").groupBy("drop", "file_name").agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("employee_number").alias("n_employees"))


def route_files(i: Inputs) -> DataFrame:
    folder = new_folder(i.spark, "drop")
    fs.write_csv(i.bonus_rate, f"{folder}/a/Operator Bonus Rate.csv", schemas.BONUS_RATE)
    fs.write_csv(i.sheeting, f"{folder}/b/SHEETING report.csv")
    fs.write_csv(i.die_price, f"{folder}/Die Price.csv", schemas.DIE_PRICE)
    fs.write_csv(i.holidays, f"{folder}/notes.csv")
    files = fs.route_files(i.spark, folder)
    # The rows of each routed file, read back: its lines without the header of each part.
    lines = i.spark.read.option("recursiveFileLookup", True).text(folder).groupBy(F.col("_metadata.file_path").alias("path"))
    # Stored, one row per file: else Spark carries the test of the names over to the paths of all lines.
    counts = store(lines.agg((F.count(F.lit(1)) - 1).alias("n")), "counts")
    counted = files.join(counts, "path")
    return counted.groupBy("role", "file_name").agg(F.sum("n").alias("n_rows"))


def production_report(i: Inputs) -> DataFrame:
    """Bonus rows written as a production report and loaded back."""
    folder = new_folder(i.spark, "drop")
    rows = qb.other(i).filter(F.col("start_date").isNotNull()).select(
        F.date_format("start_date", "dd/MM/yyyy").alias("bonus_date"),
        F.col("employee_number").alias("employee_id"),
        F.when(F.col("silver_bonus") > 0, F.col("silver_bonus")).alias("silver_bonus"),
        F.when(F.col("gold_bonus") > 0, F.col("gold_bonus")).alias("gold_bonus"),
    )
    fs.write_csv(rows, f"{folder}/January Production Report.csv", schemas.PRODUCTION_BONUS)
    return rounded(fs.load_production_bonus(i.spark, folder), "bonus")


def payrate_clean(i: Inputs) -> DataFrame:
    folder = new_folder(i.spark, "drop")
    labels = dict(schemas.PAYRATE)
    labels = {("Staff number" if k == "Employee ID" else k): v for k, v in labels.items()}
    fs.write_csv(payrate_text(i), f"{folder}/payrate.csv", labels)
    return fs.load_payrates(i.spark, f"{folder}/payrate.csv").withColumnRenamed("Employee ID", "employee_id")


def csv_source(i: Inputs) -> DataFrame:
    path = fs.write_csv(i.sales_daily, f"{new_folder(i.spark, 'drop')}/Sales_Summary.csv", schemas.SALES)
    return fs.read_sales(i.spark, path)


def csv_sink(i: Inputs) -> DataFrame:
    """Write the history tables as text and count what can be read back."""
    folder = new_folder(i.spark, "sink")
    tables = {
        "total_sales": rounded(sa.daily_total(i.sales_daily), "total_sales", digits=2),
        "history_by_category": rounded(sa.dense_by_category(i.sales_daily), "total_sales", digits=2),
    }
    counts = None
    for name, df in tables.items():
        path = fs.write_csv(df, f"{folder}/{name}.csv")
        n = i.spark.read.schema(df.schema).option("header", True).csv(path).agg(
            F.lit(name).alias("sink"), F.count(F.lit(1)).alias("n_rows"),
            F.round(F.sum("total_sales"), 0).alias("total_sales"),
        )
        counts = n if counts is None else counts.unionByName(n)
    return counts


def clean_columns(i: Inputs) -> DataFrame:
    raw = i.bonus_rate.select(
        F.col("employee_number").alias(" payroll NO. "), F.col("silver_rate").alias("silver-rate  value"),
        F.col("gold_rate").alias("GOLD_rate"),
    )
    return cl.clean_columns(raw)


QUERIES = {
    "route_files": route_files,
    "load_union": load_union,
    "safe_read": safe_read,
    "rejected_records": rejected_records,
    "landed_files": landed_files,
    "load_timesheets": load_timesheets,
    "load_schedules": lambda i: fs.load_schedules(i.spark, drop_schedules(i)),
    "file_department": lambda i: load_timesheets(i).groupBy("department").agg(F.count(F.lit(1)).alias("n_rows")),
    "production_report": production_report,
    "payrate_clean": payrate_clean,
    "csv_source": csv_source,
    "csv_sink": csv_sink,
    "clean_columns": clean_columns,
    "drop_null_keys": lambda i: cl.drop_null_keys(i.demand, ["p_num", "delivery_date"]).select("dgn_bil_id", "p_num"),
    "drop_all_null": lambda i: cl.drop_all_null(i.payrate, ["reg_rate", "ot_rate"]),
    "schedule_filter": lambda i: fs.schedule_filter(schedule_text(i)),
    "blank_to_null": lambda i: cl.blanks_to_null(payrate_text(i)).select("employee_id", "reg_rate", "pay_basis"),
    "coerce_numbers": lambda i: payrate_text(i).select("employee_id", to_number(F.col("reg_rate")).alias("reg_rate")),
    "parse_times": lambda i: timesheet_text(i).select(
        "employee_number", "start_date", "start_time",
        parse_datetime("start_date", "start_time").alias("start_ts"),
        parse_datetime("end_date", "end_time").alias("end_ts"),
    ),
    "fill_null": lambda i: i.payrate.select(
        "employee_id", F.coalesce("ot_rate", "reg_rate").alias("ot_rate"),
        F.coalesce("skip_calc", F.lit("No")).alias("skip_calc"),
        F.coalesce("ot_trigger_holiday", F.lit(80)).alias("ot_trigger_holiday"),
    ),
    "isin_filter": lambda i: i.timesheet.filter(
        ~F.col("employee_number").isin(*tc.BUSINESS_EXEMPT) & F.col("department").isin("Business", "Temp")
    ),
    "null_profile": lambda i: cl.null_profile(i.demand),
    "distinct_values": lambda i: i.sales_daily.select("sales").distinct(),
    "schema_profile": lambda i: cl.schema_profile(i.demand),
    "forward_fill": lambda i: cl.forward_fill(
        _with_first_row(i).withColumns(
            {"sort_key": F.col("employee_number"),
             "employee_number": F.when(F.col("is_first"), F.col("employee_number"))}
        ).drop("is_first"),
        ["department"], ["sort_key", "start_ts", "end_ts", "job"],
        # a department's employees come in ranges, each employee's rows in months
        [F.substring("sort_key", 1, 4), F.col("sort_key"), F.date_trunc("month", "start_ts")], ["employee_number"], deep=True,
    ),
    "industry_mismatch": lambda i: cl.industry_mismatch(
        i.table("customer").select(F.col("c_name").alias("company_name"), F.col("c_mktsegment").alias("industry")),
        i.table("customer").select(
            F.col("c_name").alias("company_name"),
            F.when(F.col("c_custkey") % 10 == 0, "MACHINERY").otherwise(F.col("c_mktsegment")).alias("industry"),
        ),
    ),
    "sorted_sales": lambda i: i.sales_daily.orderBy(
        F.asc_nulls_last("out_date"), F.asc_nulls_last("sales"), F.asc_nulls_last("customer"), "product_id"
    ),
    "preview_topn": lambda i: cl.preview(
        i.sales_daily.select("out_date", "sales", "customer", "product_id", "total_sales"),
        ["out_date", "sales", "customer", "product_id", "total_sales"], 5,
    ),
}

_UID = "CAST(substr({}, 3) AS INT)"
_T_UID, _P_UID = _UID.format("employee_number"), _UID.format("employee_id")
_TEXT = f"""text AS (SELECT *, CASE WHEN {_T_UID}%7=0 AND day(start_ts)%2=0 THEN '31/02/2024'
  ELSE strftime(start_ts, '%d/%m/%Y') END AS start_date, strftime(start_ts, '%H:%M') AS start_time,
  {_T_UID}%7=1 AS bad_end FROM timesheet)"""
_SCHED = """text AS (SELECT strftime(sched_date, '%Y-%m-%d') AS sched_date,
  CASE WHEN day(sched_date)%6=0 THEN 'All Day' ELSE strftime(sched_start, '%H:%M') END AS sched_start,
  CASE WHEN day(sched_date)%8<>0 THEN strftime(sched_start + INTERVAL 8 HOUR, '%H:%M') END AS sched_end,
  users, availability_status FROM schedule)"""
_SCHED_KEEP = """sched_start IS DISTINCT FROM 'All Day' AND availability_status IS DISTINCT FROM 'Unavailable'
  AND sched_end IS NOT NULL"""
_RATE_TEXT = f"""text AS (SELECT * REPLACE (CASE WHEN {_P_UID}%7=0 THEN 'abc' WHEN {_P_UID}%7=1 THEN '  '
    ELSE CAST(reg_rate AS VARCHAR) END AS reg_rate,
  CASE WHEN {_P_UID}%7=2 THEN '' ELSE pay_basis END AS pay_basis) FROM payrate)"""
_MISMATCH = """SELECT c_name AS company_name, c_mktsegment AS expected_industry, 'MACHINERY' AS found_industry
  FROM customer WHERE c_custkey%10=0 AND c_mktsegment<>'MACHINERY'"""
_LOADED = """SELECT employee_number, first_name, last_name, department, department='Temp' AS is_temp, job, start_ts,
  end_ts FROM timesheet"""

ORACLES = {
    "route_files": f"""WITH {ctes('bonus_rate', 'sheeting', 'die_price')}
SELECT 'bonus_rate' AS role, 'Operator Bonus Rate.csv' AS file_name, count(*) AS n_rows FROM bonus_rate
UNION ALL SELECT 'sheeting', 'SHEETING report.csv', count(*) FROM sheeting
UNION ALL SELECT 'die_price', 'Die Price.csv', count(*) FROM die_price""",
    "load_union": qb.ORACLES["operator_output_clean"],
    "safe_read": f"""WITH {ctes('bonus_rate')} SELECT employee_number, machine, CAST(silver_rate AS VARCHAR) AS silver_rate
  FROM bonus_rate""",
    "landed_files": f"""WITH {ctes('bonus_rate')}
SELECT CAST(1 AS INT) AS drop, 'Bonus rate.csv' AS file_name, count(*) AS n_rows, count(DISTINCT employee_number) AS n_employees FROM bonus_rate
UNION ALL SELECT CAST(2 AS INT), 'Bonus east.csv', count(*), count(DISTINCT employee_number) FROM bonus_rate WHERE location='East' HAVING count(*) > 0""",
    "rejected_records": f"""WITH {ctes('bonus_rate')}, kinds AS (
  SELECT CAST(substr(employee_number, 3) AS INT) % 5 AS kind FROM bonus_rate)
SELECT 'Bonus rate.csv' AS file_name, CASE kind WHEN 0 THEN 'broken quotes' WHEN 1 THEN 'more cells than the header' ELSE 'read' END AS reason,
  count(*) AS n FROM kinds GROUP BY ALL
UNION ALL VALUES ('Bonus of old.csv', 'no column Silver Rate', 1), ('Bonus blank.csv', 'no line', 1), ('absent.csv', 'missing', 1)""",
    "load_timesheets": f"WITH {ctes('timesheet')} {_LOADED}",
    "load_schedules": f"""WITH {ctes('schedule')}, {_SCHED} SELECT CAST(sched_date AS DATE) AS sched_date,
  CAST(sched_date||' '||sched_start||':00' AS TIMESTAMP) AS sched_start, users, availability_status,
  CASE WHEN length(users)%2=0 THEN 'Production' ELSE 'Business' END AS department,
  CASE WHEN length(users)%2=0 THEN 'Schedule-Export' ELSE 'Shift' END AS source FROM text WHERE {_SCHED_KEEP}""",
    "file_department": f"WITH {ctes('timesheet')} SELECT department, count(*) AS n_rows FROM timesheet GROUP BY 1",
    "production_report": qb.ORACLES["production_bonus"],
    "payrate_clean": f"""WITH {ctes('payrate')}, {_RATE_TEXT} SELECT employee_id, try_cast(reg_rate AS DOUBLE) AS reg_rate,
  CAST(ot_rate AS DOUBLE) AS ot_rate, nullif(trim(pay_basis), '') AS pay_basis, skip_calc, follow_clock,
  CAST(ot_trigger_holiday AS DOUBLE) AS ot_trigger_holiday, CAST(ot_trigger_regular AS DOUBLE) AS ot_trigger_regular
  FROM text""",
    "csv_source": f"WITH {ctes('sales_daily')} SELECT * FROM sales_daily",
    "csv_sink": f"""WITH {ctes('sales_daily')}
SELECT 'total_sales' AS sink, count(DISTINCT CAST(out_date AS DATE)) AS n_rows, round(sum(total_sales), 0) AS total_sales
  FROM sales_daily
UNION ALL SELECT 'history_by_category', count(DISTINCT CAST(out_date AS DATE))*count(DISTINCT sales),
  round(sum(total_sales), 0) FROM sales_daily""",
    "clean_columns": f"""WITH {ctes('bonus_rate')} SELECT employee_number AS "Payroll No.", silver_rate AS "Silverrate Value",
  gold_rate AS "Goldrate" FROM bonus_rate""",
    "drop_null_keys": f"WITH {ctes('demand')} SELECT dgn_bil_id, p_num FROM demand WHERE p_num IS NOT NULL AND delivery_date IS NOT NULL",
    "drop_all_null": f"""WITH {ctes('payrate')} SELECT * FROM payrate
  WHERE reg_rate IS NOT NULL OR ot_rate IS NOT NULL""",
    "schedule_filter": f"WITH {ctes('schedule')}, {_SCHED} SELECT * FROM text WHERE {_SCHED_KEEP}",
    "blank_to_null": f"""WITH {ctes('payrate')}, {_RATE_TEXT} SELECT employee_id,
  CASE WHEN trim(reg_rate)<>'' THEN reg_rate END AS reg_rate, CASE WHEN trim(pay_basis)<>'' THEN pay_basis END AS pay_basis
  FROM text""",
    "coerce_numbers": f"WITH {ctes('payrate')}, {_RATE_TEXT} SELECT employee_id, try_cast(reg_rate AS DOUBLE) AS reg_rate FROM text",
    "parse_times": f"""WITH {ctes('timesheet')}, {_TEXT} SELECT employee_number, start_date, start_time,
  CASE WHEN start_date<>'31/02/2024' THEN start_ts END AS start_ts, CASE WHEN NOT bad_end THEN end_ts END AS end_ts FROM text""",
    "fill_null": f"""WITH {ctes('payrate')} SELECT employee_id, coalesce(ot_rate, reg_rate) AS ot_rate,
  coalesce(skip_calc, 'No') AS skip_calc, coalesce(ot_trigger_holiday, 80) AS ot_trigger_holiday FROM payrate""",
    "isin_filter": f"""WITH {ctes('timesheet')} SELECT * FROM timesheet
  WHERE employee_number NOT IN ('EE109','EE037','EE034','EE059') AND department IN ('Business','Temp')""",
    "null_profile": f"""WITH {ctes('demand')} SELECT count(*) FILTER (dgn_bil_id IS NULL) AS dgn_bil_id,
  count(*) FILTER (p_num IS NULL) AS p_num, count(*) FILTER (delivery_date IS NULL) AS delivery_date,
  count(*) FILTER (customer IS NULL) AS customer, count(*) FILTER (product_id IS NULL) AS product_id,
  count(*) FILTER (product IS NULL) AS product, count(*) FILTER (order_count IS NULL) AS order_count FROM demand""",
    "distinct_values": f"WITH {ctes('sales_daily')} SELECT DISTINCT sales FROM sales_daily",
    "schema_profile": f"""WITH {ctes('demand')}, types(column_name, data_type) AS (VALUES ('dgn_bil_id','bigint'),
  ('p_num','string'), ('delivery_date','timestamp_ntz'), ('customer','string'), ('product_id','bigint'),
  ('product','string'), ('order_count','int')) SELECT (SELECT count(*) FROM demand) AS n_rows, * FROM types""",
    "forward_fill": f"""WITH {ctes('timesheet')}, marked AS (SELECT *, employee_number AS sort_key,
  CASE WHEN rank() OVER (PARTITION BY department, employee_number ORDER BY start_ts, end_ts, job)=1
    THEN employee_number END AS blanked FROM timesheet)
SELECT first_name, last_name, department, job, start_ts, end_ts, sort_key, last_value(blanked IGNORE NULLS)
  OVER (PARTITION BY department ORDER BY sort_key, start_ts, end_ts, job
        ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS employee_number FROM marked""",
    "industry_mismatch": _MISMATCH,
    "sorted_sales": f"WITH {ctes('sales_daily')} SELECT * FROM sales_daily",
    "preview_topn": f"""WITH {ctes('sales_daily')} SELECT out_date, sales, customer, product_id, total_sales FROM sales_daily
  ORDER BY out_date, sales, customer, product_id, total_sales LIMIT 5""",
}
