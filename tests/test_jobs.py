import datetime as dt
import os
import shutil

import pytest

from shopledger import schemas
from shopledger.plans import jobs
from shopledger.plans.adapters import AS_OF, Inputs
from shopledger.plans.queries_sources import drop_schedules, drop_timesheets, payrate_text
from shopledger.session import new_folder, scratch, shared_root, store
from shopledger.sources import files as fs


def stored_folders(spark):
    folder = f"{shared_root(spark)}/shopledger".removeprefix("file:")
    return set(os.listdir(folder))


def test_scratch_folders_go_after_an_error_too(spark):
    before = stored_folders(spark)
    with pytest.raises(ValueError), scratch(spark):
        assert store(spark.range(3), "some").count() == 3
        with scratch(spark):
            store(spark.range(3), "inner")
        raise ValueError
    assert stored_folders(spark) == before


def test_performance_then_payroll(spark, tiny):
    i = Inputs(spark, tiny)
    folder = drop_timesheets(i)
    fs.write_csv(i.die_price, f"{folder}/Die price.csv", schemas.DIE_PRICE)
    fs.write_csv(i.operator_output, f"{folder}/Other output.csv", schemas.OPERATOR_OUTPUT)
    sheeting = i.sheeting.selectExpr("paper_sheets", "date(start_time) filling_date", "start_time", "start_time end_time", "employee_number")
    fs.write_csv(sheeting, f"{folder}/Sheeting.csv", schemas.SHEETING)
    # a bonus-rate report has two lines of titles above its header
    head = ["title", "subtitle", ",".join(schemas.BONUS_RATE)]
    rates = [",".join("" if v is None else str(v) for v in r) for r in i.bonus_rate.select(*schemas.BONUS_RATE.values()).collect()]
    path = new_folder(spark, "rates").removeprefix("file:")
    os.makedirs(path)
    with open(f"{path}/Operator Bonus Rate.csv", "w") as file:
        file.write("\n".join([*head, *rates]) + "\n")
    shutil.copy(f"{path}/Operator Bonus Rate.csv", folder)
    out, before = new_folder(spark, "reports"), stored_folders(spark)
    reports = jobs.run_performance(spark, folder, out)
    assert stored_folders(spark) - before == {os.path.basename(out)}  # nothing else is left
    bonus = spark.read.parquet(f"{out}/report=bonus")
    assert bonus.count() > 0 and bonus.filter("process <> 'Sheeting' and silver_bonus + gold_bonus > 0").count() > 0
    by_place = spark.read.parquet(f"{out}/report=by_process_location")
    assert {r.location for r in by_place.select("location").distinct().collect()} == {"East", "West"}
    assert reports["range"].first().report_name.startswith("Production Report from 2024-01")

    rates = fs.write_csv(payrate_text(i), f"{new_folder(spark, 'rates')}/payrate.csv", schemas.PAYRATE)
    sheets = [f"{folder}/{d} Timesheet.csv" for d in ("Business", "Temp", "Production", "Warehouse")]
    schedule = drop_schedules(i)
    pay = jobs.run_payroll(spark, sheets, [schedule], rates, new_folder(spark, "pay"), dt.date(2024, 1, 1), 2)
    summary = pay["summary"].collect()
    assert len({r.employee_number for r in summary}) == i.timesheet.select("employee_number").distinct().count()
    assert all(r.total_compensation >= 0 for r in summary)
    assert pay["detail"].count() > 0 and pay["changes"].count() > 0 and pay["alerts"].count() > 0
    assert pay["vacations"].count() > 0


def test_views_and_forecast(spark, tiny):
    i = Inputs(spark, tiny)
    jobs.register_erp_views(spark, i.demand, i.shipments, i.plan, AS_OF)
    assert spark.sql("SELECT count(*) n FROM priority_urgency WHERE priority_score = 100").first().n > 0
    assert spark.sql("SELECT total_records n FROM basic_data_overview").first().n == i.demand.count()
    path = fs.write_csv(i.sales_daily, f"{new_folder(spark, 'sales')}/Sales_Summary.csv", schemas.SALES)
    tables = jobs.run_forecast(spark, path, new_folder(spark, "forecast"), dt.date(2000, 1, 1), 7)
    assert tables["total_forecast"].count() == 13 and tables["category_forecast"].count() == 13 * 5
    seasonal = tables["category_seasonal_out_count_total"]  # as long as the test part
    assert seasonal.groupBy("sales").count().filter("count >= 7").count() == 5 and seasonal.filter("reason is not null").count() == 0
    assert tables["category_seasonal_out_count_total_errors"].filter("mae > 0 and n_rows > 0").count() == 5
    assert tables["total_errors"].first().n_rows > 0
