import datetime as dt

import pytest
from pyspark.sql import functions as F

from shopledger import schemas
from shopledger.operators import bonus as bo
from shopledger.operators import cleaning as cl
from shopledger.plans import queries_sources as qs
from shopledger.plans.adapters import Inputs
from shopledger.sources import files as fs


@pytest.fixture()
def folder(tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    head = "Start Date,Start time,End Date,End time,Employee Number,First name,Last name,Job,Employee notes\n"
    (tmp_path / "Business Timesheet 1.csv").write_text(
        head + "01/02/2024,08:00,01/02/2024,16:00,EE1,Ann,Lee,Shift,\n"
        "02/02/2024,08:00,02/02/2024,16:00,,,,Shift,late\n"
        ",,,,,,,,\n"
        "03/02/2024,08:00,03/02/2024,xx,EE2,Bo,Ray,Shift,\n04/02/2024,08:00,04/02/2024,09:00,,,,Shift,\n"
    )
    (tmp_path / "deep" / "Temp TIMESHEET.csv").write_text(
        head.replace("Employee Number", "Team") + "01/02/2024,08:00,01/02/2024,16:00,T1,Cy,Dee,Shift,\n"
    )
    (tmp_path / "deep" / "er" / "Die prices.csv").write_text('ERPNum,ProductID,Price\n"E1, E2",7,1.5\n')
    (tmp_path / "Production Report bonus.csv").write_text("Date,Employee ID,Silver Bonus,Gold Bonus\n2024-02-01,EE1,,2.5\n2024-02-01,EE1,1,\n")
    (tmp_path / "Operator Bonus.csv").write_text("title\nsubtitle\nPayroll NO.,Name,Location,Machine,Silver Rate,Gold Rate\nEE1,Ann,East,Sheeter,1,2\n")
    (tmp_path / "readme.txt").write_text("nothing")
    return tmp_path


def test_routing(spark, folder):
    got = {r.file_name: r.role for r in fs.route_files(spark, str(folder)).collect()}
    assert got == {
        "Business Timesheet 1.csv": "time_sheet", "Temp TIMESHEET.csv": "time_sheet", "Die prices.csv": "die_price",
        "Production Report bonus.csv": "production", "Operator Bonus.csv": "bonus_rate",
    }


def test_timesheets_are_filled_down_per_file(spark, folder):
    paths = [str(folder / "Business Timesheet 1.csv"), str(folder / "deep" / "Temp TIMESHEET.csv"), str(folder / "gone.csv")]
    rows = sorted((r.department, r.employee_number, r.first_name, r.is_temp, r.start_ts.day, r.end_ts is None)
                  for r in fs.load_timesheets(spark, paths).collect())
    assert rows == [
        ("Business", "EE1", "Ann", False, 1, False), ("Business", "EE1", "Ann", False, 2, False),
        ("Business", "EE2", "Bo", False, 3, True), ("Business", "EE2", "Bo", False, 4, False),
        ("Temp", "T1", "Cy", True, 1, False),
    ]


def test_fill_crosses_the_splits_of_a_file(spark, tmp_path):
    lines = ["Start Date,Start time,End Date,End time,Employee Number,First name,Last name,Job,Employee notes"]
    for k in range(300):
        who = f"EE{k // 50},N{k // 50},L" if k % 50 == 0 else ",,"
        lines.append(f"01/02/2024,08:00,01/02/2024,16:00,{who},Shift,{k}")
    path = tmp_path / "Business Timesheet.csv"
    path.write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    try:
        df = fs.load_timesheets(spark, str(path))
        raw = fs.safe_read(spark, str(path), schemas.TIMESHEET)
        assert raw.select("file_block").distinct().count() > 3
        assert all(r.employee_number == f"EE{int(r.employee_notes) // 50}" for r in df.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_missing_file_and_skipped_rows(spark, folder):
    empty = fs.safe_read(spark, str(folder / "gone.csv"), schemas.BONUS_RATE, ["employee_number"])
    assert empty.count() == 0 and empty.columns == ["employee_number", *fs.PLACE]
    rate = fs.load_union(spark, [str(folder / "Operator Bonus.csv")], schemas.BONUS_RATE, bo.clean_bonus_rate, skip_rows=2)
    assert [tuple(r) for r in rate.collect()] == [("EE1", "Ann", "East", "Sheeter", "1", "2")]
    price = fs.load_union(spark, [str(folder / "deep" / "er")], schemas.DIE_PRICE, bo.explode_prices).filter("price is not null and product_id = '7'")
    assert sorted(r.erp_num for r in price.collect()) == ["E1", "E2"]


def test_production_report(spark, folder):
    rows = fs.load_production_bonus(spark, str(folder)).collect()
    assert [tuple(r) for r in rows] == [(dt.date(2024, 2, 1), "EE1", 3.5)]


def test_schedule_filter_keeps_unknown_values(spark):
    rows = [("All Day", "17:00", None), ("08:00", None, None), ("08:00", "17:00", "Unavailable"), ("08:00", "17:00", None), (None, "17:00", "x")]
    df = spark.createDataFrame(rows, "sched_start string, sched_end string, availability_status string")
    assert fs.schedule_filter(df).count() == 2


def test_reports_are_sorted_files_in_ranges(spark, tmp_path):
    """The number of files doesn't grow with the employees, and one of them is found in a file or two."""
    folder = str(tmp_path / "out")
    count = {}
    for n in (20, 2000):
        df = spark.range(4000).select((F.col("id") % n).alias("employee_number"), F.lit(1).alias("period"), "id")
        fs.write_reports({"detail": df, "log": df}, folder, {"detail": ["period", "employee_number"]})
        detail = spark.read.parquet(f"{folder}/report=detail")
        count[n] = len(detail.inputFiles())
        one = detail.filter("employee_number = 7")
        assert one.count() == 4000 // n and detail.count() == 4000
        assert one.select(F.col("_metadata.file_path")).distinct().count() <= 2
        where = F.col("_metadata.file_path")
        ranges = detail.groupBy(where).agg(F.min("employee_number").alias("a"), F.max("employee_number").alias("b")).orderBy("a").collect()
        assert all(x.b <= y.a for x, y in zip(ranges, ranges[1:]))
    assert count[2000] <= count[20] + 4
    assert spark.read.parquet(f"{folder}/report=log").count() == 4000


def test_a_landed_file_is_loaded_once(spark, tmp_path):
    landing, head = str(tmp_path / "landing"), "Price,ProductID,ERPNum\n"
    one, two = tmp_path / "one", tmp_path / "two"
    one.mkdir()
    two.mkdir()
    (one / "a.csv").write_text(head + "1,p,e\n2,q,e\n")
    (one / "same.csv").write_text(head + "1,p,e\n2,q,e\n")
    (two / "again.csv").write_text(head + "1,p,e\n2,q,e\n")
    (two / "b.csv").write_bytes(b"\xef\xbb\xbfERPNum,Price,ProductID\r\ne,3,r\r\n\xff,4,s\r\n")
    assert fs.landed(spark, landing).count() == 0
    assert [r.file_name for r in fs.land(spark, str(one), landing).collect()] == ["a.csv"]
    assert [r.file_name for r in fs.land(spark, str(two), landing).collect()] == ["b.csv"]
    assert fs.land(spark, [str(one), str(two)], landing).count() == 0
    files = {r.file_name: r for r in fs.landed(spark, landing).collect()}
    assert {n: (r.drop, r.length) for n, r in files.items()} == {"a.csv": (1, 35), "b.csv": (2, 41)} and len(files["a.csv"].sha256) == 64
    read = fs.read_landed(spark, landing, schemas.DIE_PRICE)
    assert {(r.price, r.product_id, r.erp_num) for r in read.rows.collect()} == {("1", "p", "e"), ("2", "q", "e"), ("3", "r", "e")}
    assert [r.reason for r in read.rejected.collect()] == ["not UTF-8"]


def test_cleaning(spark):
    assert [cl.clean_name(c) for c in (" payroll NO. ", "silver-rate  x", "a_b")] == ["Payroll No.", "Silverrate X", "Ab"]
    df = spark.createDataFrame([("", "7"), (" \t ", "x"), ("a", None)], "s string, `Staff number` string")
    assert [r.s for r in cl.blanks_to_null(df).collect()] == [None, None, "a"]
    assert cl.with_employee_id(df).columns == ["s", "Employee ID"]
    assert cl.null_profile(df).first().asDict() == {"s": 0, "Staff number": 1}
    stored = spark.createDataFrame([("a", "X"), ("b", None), ("c", "Y"), ("d", "Z")], "company_name string, industry string")
    found = spark.createDataFrame([("a", "X"), ("b", "Q"), ("c", "W"), ("d", None)], "company_name string, industry string")
    assert sorted(r.company_name for r in cl.industry_mismatch(stored, found).collect()) == ["b", "c"]


def test_columns_are_found_by_their_header(spark, tmp_path):
    (tmp_path / "a").mkdir()
    (tmp_path / "b").mkdir()
    (tmp_path / "a" / "Temp Timesheet.csv").write_text(
        "First name,Last name,Team,Start Date,Start time,Extra,End Date,End time,Job,Employee notes\n"
        "Ann,Lee,T7,01/02/2024,08:00,x,01/02/2024,16:00,Shift,n\n"
    )
    head = "Start Date,Start time,End Date,End time,Employee Number,First name,Last name,Job,Employee notes\n"
    (tmp_path / "a" / "Production Timesheet.csv").write_text(head + "01/02/2024,08:00,01/02/2024,16:00,EE1,Bo,Ray,Shift,\n")
    (tmp_path / "b" / "Production Timesheet.csv").write_text(head + "02/02/2024,08:00,02/02/2024,16:00,,,,Shift,\n")
    paths = [str(p) for p in (tmp_path / "a" / "Temp Timesheet.csv", tmp_path / "a" / "Production Timesheet.csv", tmp_path / "b" / "Production Timesheet.csv")]
    rows = fs.load_timesheets(spark, [*paths, str(tmp_path / "absent.csv")]).collect()
    # the nameless first row of b isn't filled from the file of the same name in a
    assert {(r.employee_number, r.first_name, r.last_name, r.job) for r in rows} == {
        ("T7", "Ann", "Lee", "Shift"), ("EE1", "Bo", "Ray", "Shift"), (None, None, None, "Shift")
    }
    (tmp_path / "sales.csv").write_text(
        "Customer,Sales,OutDate,Product,ProductID,TotalSales,OutCountTotal,TotalSales_LocalPrice\nCUST,S,2020-01-02T00:00:00.000,P,7,2.5,3,x\n"
    )
    assert fs.read_sales(spark, str(tmp_path / "sales.csv")).collect() == [(dt.datetime(2020, 1, 2), "S", "CUST", "P", 7, 3.0, 2.5, None)]
    with pytest.raises(Exception, match="no column 'Price'"):
        fs.safe_read(spark, str(tmp_path / "sales.csv"), {"Price": "price"}).collect()


def test_many_files_are_one_scan(spark, tmp_path):
    for k in range(300):
        (tmp_path / f"{k}.csv").write_text(f"Price,ProductID,ERPNum\n{k},p,e\n")
    df = fs.safe_read(spark, [str(tmp_path / f"{k}.csv") for k in range(300)], schemas.DIE_PRICE)
    assert sorted(int(r.price) for r in df.collect()) == list(range(300))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in plan and plan.count("Relation [") <= 3


def test_rejected_lines_and_files_have_a_reason(spark, tmp_path):
    good = 'Price,ProductID,ERPNum\n1,p,"a, ""b"" \\"c\\""\n2,"",\n3\n'
    (tmp_path / "one.csv").write_bytes(
        good.encode() + b'4,"open,e\n5,p,e,more\n6,p,e,,\n7,p\xff,e\n8,"p"x,e\n9,"C:\\",e\n'
    )
    (tmp_path / "two.csv").write_text("Price,Product\n1,p\n")
    (tmp_path / "none.csv").write_text("\n\n")
    paths = [str(tmp_path / n) for n in ("one.csv", "two.csv", "none.csv", "gone.csv")]
    read = fs.read_records(spark, paths, schemas.DIE_PRICE)
    rows = {(r.price, r.product_id, r.erp_num) for r in read.rows.collect()}
    assert rows == {("1", "p", 'a, "b" "c"'), ("2", "", None), ("3", None, None), ("6", "p", "e"), ("9", "C:\\", "e")}
    rejected = sorted((r.file_path.rsplit("/", 1)[1], r.reason, None if r.line is None else r.line[0]) for r in read.rejected.collect())
    assert rejected == [
        ("gone.csv", "missing", None), ("none.csv", "no line", None), ("one.csv", "broken quotes", "4"),
        ("one.csv", "broken quotes", "8"), ("one.csv", "more cells than the header", "5"), ("one.csv", "not UTF-8", "7"),
        ("two.csv", "no column ERPNum, ProductID", None),
    ]


def test_a_wide_file_is_read_whole(spark, tmp_path):
    (tmp_path / "wide.csv").write_text(",".join([*(f"x{k}" for k in range(200)), "Price", "ProductID", "ERPNum"]) + "\n" + "," * 200 + "1,p,e\n")
    assert [tuple(r)[:3] for r in fs.safe_read(spark, str(tmp_path / "wide.csv"), schemas.DIE_PRICE, ["price", "product_id", "erp_num"]).collect()] == [("1", "p", "e")]


def test_a_read_scans_its_files_once(spark, tmp_path, monkeypatch):
    (tmp_path / "one.csv").write_text("Price,ProductID,ERPNum\n1,p,e\n")
    written = []
    store = fs.store
    monkeypatch.setattr(fs, "store", lambda df, label: written.append(df) or store(df, label))
    read = fs.read_records(spark, str(tmp_path), schemas.DIE_PRICE)
    plans = [df._jdf.queryExecution().executedPlan().toString() for df in (read.rows, read.rejected)]
    (scan,) = [df._jdf.queryExecution().executedPlan().toString() for df in written]
    assert scan.count("Scan text") == 1 and not any("Scan text" in p or "Scan csv" in p for p in plans)
    assert read.rows.count() == 1 and read.rejected.count() == 0


def test_lines_meet_their_header_where_they_are(spark, tmp_path):
    """No line is shuffled by its path, however large Spark takes the headers to be."""
    for k in range(3):
        (tmp_path / f"{k}.csv").write_text("Price,ProductID,ERPNum\n" + f"{k},p,e\n" * 5)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = fs.safe_read(spark, str(tmp_path), schemas.DIE_PRICE)
        plan = rows._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert rows.groupBy("price").count().orderBy("price").collect() == [("0", 5), ("1", 5), ("2", 5)]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_content_of_a_landed_file_parts_from_its_lines(spark, tmp_path, monkeypatch):
    """What is below the split has the content, what is above it only lines."""
    (tmp_path / "drop").mkdir()
    (tmp_path / "drop" / "a.csv").write_text("Price,ProductID,ERPNum\n1,p,e\n")
    fs.land(spark, str(tmp_path / "drop"), str(tmp_path / "landing"))
    written = []
    store = fs.store
    monkeypatch.setattr(fs, "store", lambda df, label: written.append(df) or store(df, label))
    assert fs.read_landed(spark, str(tmp_path / "landing"), schemas.DIE_PRICE).rows.count() == 1
    plan = written[0]._jdf.queryExecution().optimizedPlan().toString()
    above = plan[: plan.index("Generate ")]
    assert "content#" not in above and "split#" not in above


def test_names_of_files_are_not_tested_line_by_line(spark, tiny):
    """Routed files are joined with counts that are there, so no test of a name reaches the scan of the lines."""
    plan = qs.QUERIES["route_files"](Inputs(spark, tiny))._jdf.queryExecution().executedPlan().toString()
    assert "Scan text" not in plan
