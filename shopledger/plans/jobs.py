"""The end-to-end jobs: read a drop folder, compute, write report datasets.

Every job stores the tables it reads more than once in the shared folder, so no
branch repeats the work of another and a lost executor only repeats its own part.
These tables are removed when the reports are written; what a job returns is read
from the reports.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger import schemas
from shopledger.functions.clock import parse_date, parse_datetime
from shopledger.functions.holidays import ontario_holidays
from shopledger.functions.text import to_number
from shopledger.operators import bonus as bo
from shopledger.operators import erp, forecast, payroll, sales
from shopledger.operators import timeclock as tc
from shopledger.session import configure, scratch, store
from shopledger.sources import files as fs


def paths_by_role(spark: SparkSession, folder: str) -> dict[str, list[str]]:
    """Paths of the dropped files of each role.

    Only names are listed, and the part files of one dropped folder count once.
    """
    dropped = F.regexp_replace(F.url_decode(F.replace("path", F.lit("+"), F.lit("%2B"))), "/part-[^/]*$", "")
    routed = fs.route_files(spark, folder).select("role", dropped.alias("path")).distinct()
    paths: dict[str, list[str]] = {}
    for role, path in routed.sort("path").toLocalIterator():
        paths.setdefault(role, []).append(path)
    return paths


def holiday_table(spark: SparkSession, years: Sequence[int]) -> DataFrame:
    """The holidays of the given years, with the days observed for those on a weekend."""
    rows = spark.range(min(years), max(years) + 1).select(F.col("id").cast("int").alias("year"))
    return rows.select(F.inline(ontario_holidays(F.col("year"), substitutes=True)))


def _typed_prices(raw: DataFrame) -> DataFrame:
    return bo.explode_prices(raw.withColumn("price", to_number(F.col("price"))))


def _typed_output(raw: DataFrame) -> DataFrame:
    return bo.clean_operator_output(raw.withColumn("shift_date", parse_date("shift_date", day_first=False)))


def _typed_rates(raw: DataFrame) -> DataFrame:
    rates = {c: to_number(F.col(c)) for c in ("silver_rate", "gold_rate")}
    return bo.clean_bonus_rate(raw.withColumns(rates))


def _typed_sheeting(raw: DataFrame) -> DataFrame:
    start = F.coalesce(
        F.col("start_time").try_cast("timestamp_ntz"), parse_datetime("filling_date", "start_time", day_first=False)
    )
    return bo.clean_sheeting(raw.withColumn("start_time", start))


def run_performance(spark: SparkSession, folder: str, out: str) -> dict[str, DataFrame]:
    """Operator performance: bonus report, missing hours, and the summaries."""
    configure(spark)
    with scratch(spark):
        return fs.write_reports(_performance(spark, folder), out)


def _performance(spark: SparkSession, folder: str) -> dict[str, DataFrame]:
    paths = paths_by_role(spark, folder)

    def load(role: str, layout: dict[str, str], fn, skip_rows: int = 0) -> DataFrame:
        return fs.load_union(spark, paths.get(role, []), layout, fn, skip_rows)

    sheets = fs.load_timesheets(spark, paths.get("time_sheet", []))
    hours = store(tc.timesheet_hours(store(sheets, "sheets")), "hours")
    rates = load("bonus_rate", schemas.BONUS_RATE, _typed_rates, skip_rows=2)
    sheeting = load("sheeting", schemas.SHEETING, _typed_sheeting)
    output = load("other_output", schemas.OPERATOR_OUTPUT, _typed_output)
    prices = load("die_price", schemas.DIE_PRICE, _typed_prices)
    other = bo.other_process_bonus(hours, bo.daily_output(output, prices), rates)
    performance = store(
        bo.performance_union(bo.sheeting_bonus(hours, bo.sheeting_daily(sheeting), rates), other), "performance"
    )
    return {
        "bonus": bo.bonus_report(performance),
        "not_reported": bo.not_reported_report(performance),
        "production_bonus": bo.production_bonus(performance),
        "range": bo.report_range(performance),
        "by_process_location": bo.summary_by(performance, ["process", "location"]),
        **{f"by_employee_{m}": bo.employee_summary(performance, m) for m in bo.MEASURES},
    }


def adjust_timesheet(timesheet: DataFrame, schedule: DataFrame | None) -> dict[str, DataFrame]:
    """The payroll's time-sheet steps in order, with their change rows and alerts."""
    timesheet = store(timesheet, "sheets")
    hours = store(tc.working_hours(tc.drop_long_vacations(timesheet)), "hours")
    merged = store(tc.merge_midnight(hours), "merged")
    changes = [tc.business_changes(merged)]
    rows, alerts = tc.business_hours(merged), None
    if schedule is not None:
        matched = store(tc.match_schedule(rows, schedule), "matched")
        changes.append(tc.schedule_changes(matched))
        alerts = tc.schedule_alerts(matched)
        rows = tc.apply_schedule(matched)
    changes.append(tc.lunch_changes(rows))
    out = {
        "timesheet": store(tc.lunch(rows), "timesheet"),
        "vacations": tc.vacation_report(tc.vacation_runs(timesheet)),
        "changes": tc.change_log(*changes),
    }
    return out if alerts is None else out | {"alerts": alerts}


def run_payroll(
    spark: SparkSession, timesheets: Sequence[str], schedules: Sequence[str], payrates: str, out: str,
    start: dt.date, num_periods: int = 1, bonus_folder: str | None = None, holidays: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """Bi-weekly payroll: summary, per-employee detail, vacations, changes and alerts."""
    configure(spark)
    with scratch(spark):
        reports = _payroll(spark, timesheets, schedules, payrates, start, num_periods, bonus_folder, holidays)
        return fs.write_reports(reports, out, {"detail": ["period_start", "employee_number"]})


def _payroll(
    spark: SparkSession, timesheets: Sequence[str], schedules: Sequence[str], payrates: str, start: dt.date, num_periods: int,
    bonus_folder: str | None, holidays: DataFrame | None,
) -> dict[str, DataFrame]:
    schedule = fs.load_schedules(spark, schedules) if schedules else None
    steps = adjust_timesheet(fs.load_timesheets(spark, timesheets), schedule)
    last_year = (start + dt.timedelta(days=payroll.PERIOD_DAYS * num_periods)).year
    if holidays is None:
        holidays = holiday_table(spark, [start.year - 1, last_year])
    if bonus_folder:
        bonus = fs.load_production_bonus(spark, bonus_folder)
    else:
        bonus = spark.createDataFrame([], "bonus_date date, employee_id string, bonus double")
    rates = fs.load_payrates(spark, payrates).withColumnRenamed("Employee ID", "employee_id")
    sheet = steps["timesheet"]
    base = store(payroll.pay_base(sheet, rates, holidays, start, num_periods), "base")
    paid = store(payroll.payroll(sheet, rates, holidays, bonus, start, num_periods, base=base), "paid")
    return {
        "summary": payroll.pay_summary(paid),
        "detail": payroll.pay_detail(paid, steps["timesheet"], start, num_periods),
        "unmatched": payroll.unmatched_employees(paid).select("employee_number", "period_start"),
        **{k: v for k, v in steps.items() if k != "timesheet"},
    }


def register_erp_views(
    spark: SparkSession, demand: DataFrame, shipments: DataFrame, plan: DataFrame, as_of: dt.datetime,
    policy: str = "null",
) -> None:
    """The schedule-analysis views under their names in the session."""
    configure(spark)
    views = {
        "basic_data_overview": erp.basic_overview(demand),
        "delivery_analysis": erp.delivery_analysis(shipments, as_of),
        "shipped_past_30_days": erp.shipped_past_30_days(shipments, as_of),
        "pending_deliveries": erp.pending_deliveries(demand, shipments, as_of),
        "unscheduled_deliveries": erp.unscheduled_deliveries(demand, shipments, as_of),
        "customer_analysis": erp.customer_analysis(demand, shipments, as_of),
        "work_order_status": erp.work_order_status(plan, shipments, policy),
        "late_orders_impact": erp.late_orders_impact(demand, shipments, as_of, policy),
        "machine_utilization": erp.machine_utilization(plan, demand, as_of, policy),
        "priority_urgency": erp.priority_urgency(plan, shipments, as_of, policy),
        "delivery_shipping_status": erp.delivery_shipping_status(shipments, plan, as_of, policy),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


def run_forecast(
    spark: SparkSession, sales_path: str, out: str, split: dt.date, horizon: int, months: int = 13
) -> dict[str, DataFrame]:
    """Daily histories, linear and seasonal forecasts, in total and by category, with errors."""
    configure(spark)
    with scratch(spark):
        return fs.write_reports(_forecast(spark, sales_path, split, horizon, months), out)


def _forecast(spark: SparkSession, sales_path: str, split: dt.date, horizon: int, months: int) -> dict[str, DataFrame]:
    day = forecast.DATE
    by_category = store(sales.dense_by_category(fs.read_sales(spark, sales_path), sales.MEASURES), "daily")
    totals = by_category.groupBy(day).agg(F.sum("total_sales").alias("total_sales"))
    total = store(totals.withColumn("sales", F.lit("total")), "total")
    before, after = F.col(day) < F.lit(split), F.col(day) >= F.lit(split)
    tables: dict[str, DataFrame] = {"total_sales": total, "history_by_category": by_category}
    for name, series in (("total", total), ("category", by_category)):
        model = forecast.fit_ols(series.filter(before), ["sales"])
        ahead = forecast.future_dates(series, months, keys=series.select("sales").distinct())
        scored = forecast.score_ols(series.filter(after).select("sales", day), model, ["sales"])
        tables[f"{name}_forecast"] = forecast.score_ols(ahead.select("sales", day), model, ["sales"])
        tables[f"{name}_errors"] = forecast.error_metrics(forecast.align(series, scored, ["sales"]), ["sales"], scored)
        days = series.filter(after).agg(F.datediff(F.max(day), F.lit(split))).first()[0]
        measures = ["total_sales"] if name == "total" else sales.MEASURES
        for m in measures:
            # as far as the test part goes, to be compared with it
            seasonal = store(forecast.sarima_forecast(series.filter(before), ["sales"], max(horizon, (days or 0) + 1), m), m)
            tables[f"{name}_seasonal_{m}"] = seasonal
            fitted = seasonal.filter("reason is null")
            tables[f"{name}_seasonal_{m}_errors"] = forecast.error_metrics(
                forecast.align(series.filter(after), fitted, ["sales"], m), ["sales"], fitted
            )
            tables[f"{name}_stationarity_{m}"] = forecast.adf_statistic(series.filter(before), ["sales"], m)
    return tables
