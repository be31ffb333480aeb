import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shopledger.operators import bonus as bo

DAY = dt.date(2024, 1, 1)
OUTPUT = (
    "erp_num string, product string, main_product_code string, makeup_style string, process string, "
    "device_name string, die_number string, shift_date date, member_id string, output_qty double"
)


def out(spark, rows):
    return spark.createDataFrame(rows, OUTPUT).repartition(3)


def row(process, member, code="c1", style="s1", die="d1", product="p1", device="v1", qty=10.0, erp="e1"):
    return (erp, product, code, style, process, device, die, DAY, member, qty)


def prices(spark, rows):
    return bo.explode_prices(spark.createDataFrame(rows, "erp_num string, product_id string, price double"))


def test_make_ready_lines_and_revenue(spark):
    rows = [
        row("Die Cutting", "m1"), row("Die Cutting", "m1", code="c2"), row("Die Cutting", "m1", die="d2", device="v2"),
        row("Printing", "m2"), row("Printing", "m2", style="s2"), row("Printing", "m2", code="c2"),
        row("Gluing", "m3"), row("Gluing", "m3", code="c2"), row("Gluing", "m3", code="c2", style="s9"),
        row("Gluing", "m3", code=None), row("Gluing", "m4", die=None), row("Gluing", None),
        row("Printing", "m5", device="SP1-HD102CX"), row("Printing", "m5", device="SP1-HD102CX", style="s2"),
    ]
    # c1 is priced twice for e1: quantity and revenue count twice.
    price = prices(spark, [("e0, e1", "c1", 0.5), ("e1", "c1", 1.0), ("e1", "c2", 2.0)])
    daily = {r.member_id: r for r in bo.daily_output(out(spark, rows), price).collect()}
    assert daily["m1"].make_ready == 2 and daily["m1"].number_of_lines == 2
    assert daily["m2"].make_ready == 2 * 3 and daily["m2"].process == "Printing"  # 2 codes x (2 + 1) styles
    assert daily["m3"].make_ready == 2 and daily["m4"].make_ready == 0
    assert daily["m5"].make_ready == 1 and daily["m5"].process == "Printing_CX102"
    assert daily["m1"].output_qty == 20 + 10 + 20 and daily["m1"].revenue == 15 + 20 + 15
    assert daily["m3"].output_qty == 20 + 10 + 10 + 10 and daily["m3"].revenue == 15 + 20 + 20
    assert set(daily) == {"m1", "m2", "m3", "m4", "m5"}
    joined = bo.join_prices(bo.relabel_process(out(spark, rows)), price)
    by_member = {r.member_id: r for r in joined.groupBy("member_id").sum("output_qty", "revenue").collect()}
    assert all(by_member[m]["sum(output_qty)"] == daily[m].output_qty for m in daily)


def test_gold_wins_and_missing_hours_are_flagged(spark):
    hours = spark.createDataFrame(
        [("m1", "A", "B", DAY, 9.0), ("m1", "A", "B", DAY, 4.0), ("m3", "A", "B", DAY, 9.0)],
        "employee_number string, first_name string, last_name string, start_date date, working_hours double",
    )
    daily = spark.createDataFrame(
        [("Die Cutting", DAY, "m1", 42400.0, 1, 1, 0.0), ("Die Cutting", DAY, "m2", 5.0, 1, 1, 0.0),
         ("Die Cutting", DAY, "m3", 34000.0, 1, 1, 0.0)],
        "process string, shift_date date, member_id string, output_qty double, make_ready bigint, number_of_lines bigint, revenue double",
    )
    rate = spark.createDataFrame(
        [("m1", "N", "East", "Sheeter", 1.0, 2.0), ("m1", "N", "East", "Gluer", 3.0, None), ("m3", "N", "East", "Gluer", 3.0, 4.0)],
        "employee_number string, name string, location string, machine string, silver_rate double, gold_rate double",
    )
    got = bo.other_process_bonus(hours, daily, rate).collect()
    assert len(got) == 6 and not any(r.silver and r.gold for r in got)
    gold = sorted(r.gold_bonus for r in got if r.member_id == "m1" and r.gold)
    assert gold == [0.0, 18.0]  # the rate row without a gold rate pays nothing
    assert [(r.silver, r.silver_bonus) for r in got if r.member_id == "m3"] == [(True, 27.0)]
    lone = [r for r in got if r.member_id == "m2"][0]
    assert (lone.flag_not_report_working_hour, lone.employee_number, lone.location) == ("yes", "m2", None)


def test_sheeting(spark):
    hours = spark.createDataFrame([("a", DAY, 8.0), ("b", DAY, 8.0), ("c", DAY, 8.0)], "employee_number string, start_date date, working_hours double")
    daily = spark.createDataFrame([("a", DAY, 80000.0), ("b", DAY, 80000.0)], "employee_number string, start_date date, paper_sheets double")
    rate = spark.createDataFrame(
        [("a", "N", "East", "Sheeter", 1.0, 2.0), ("b", "N", "East", "Gluer", 1.0, 2.0)],
        "employee_number string, name string, location string, machine string, silver_rate double, gold_rate double",
    )
    got = {r.employee_number: (r.gold, r.gold_bonus) for r in bo.sheeting_bonus(hours, daily, rate).collect()}
    assert got == {"a": (True, 16.0), "b": (True, None)}


def test_a_group_rule_sees_all_columns_and_covers_every_job(spark):
    rows = [row("Die Cutting", "m1", qty=5.0), row("Die Cutting", "m1", code="c2", qty=50.0), row("Gluing", "m2", die=None), row("Printing", "m3", erp="e9")]
    price = prices(spark, [("e1", "c1", 0.5), ("e1", "c1", 1.0)])
    large = lambda r: r.groupBy(*bo.JOB).agg(F.count_if((F.col("output_qty") > 20) | (F.col("erp_num") == "e9")).alias("make_ready"))
    daily = {r.member_id: r for r in bo.daily_output(out(spark, rows), price, group_rule=large).collect()}
    assert {m: r.make_ready for m, r in daily.items()} == {"m1": 1, "m2": 0, "m3": 1}
    assert {m: r.output_qty for m, r in daily.items()} == {"m1": 60.0, "m2": 20.0, "m3": 10.0}
    for fault, message in (
        (lambda r: large(r).filter("member_id <> 'm1'"), "gives no make-ready for"),
        (lambda r: large(r).unionByName(large(r)), "gives more than one make-ready"),
        (lambda r: large(r).withColumn("product", F.lit("other")), "make-ready for"),
    ):
        with pytest.raises(PySparkException, match=message):
            bo.daily_output(out(spark, rows), price, group_rule=fault).collect()


def test_a_day_of_output_is_dealt_twice(spark):
    """Once by member, day and device for styles, codes, jobs and devices, and once, summed, by member and day."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = bo.daily_output(out(spark, [row("Gluing", "m1")]), prices(spark, [("e1", "c1", 0.5)]))
        plan = daily._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # two more deal the rows and the prices by order and code
    assert plan.count("Exchange hashpartitioning") == 4


def test_a_day_of_output_lies_where_its_hours_are_dealt(spark):
    """The join with the hours deals only these, and a shuffle starts with more parts than the session's default."""
    hours = spark.createDataFrame(
        [("m1", "A", "B", DAY, 9.0)],
        "employee_number string, first_name string, last_name string, start_date date, working_hours double",
    )
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [row("Gluing", "m1"), row("Gluing", "m1", device=None), row("Gluing", "m1", device="v2"), row("Die Cutting", "m2")]
        daily = bo.daily_output(out(spark, rows), prices(spark, [("e1", "c1", 0.5)]))
        joined = bo.join_output_hours(hours, daily)
        plan = joined._jdf.queryExecution().executedPlan().toString()
        got = {r.member_id: (r.number_of_lines, r.output_qty, r.revenue, r.working_hours) for r in joined.collect()}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert len(dealt) == 5 and all(", 200), " in line for line in dealt)
    assert got == {"m1": (2, 30.0, 15.0, 9.0), "m2": (1, 10.0, 5.0, None)}


def test_packed_columns_are_told_apart_and_come_back(spark):
    values = ["", "a", "\x1f", "\x1b", "\x1b2", "\x1b1", "\x1f\x1b0", "a\x1fb", None]
    rows = [row(a, "m1", device=c) for a in values[:-1] for c in values]
    df = spark.createDataFrame(rows, OUTPUT)
    kinds = dict(df.dtypes)
    packed = df.select(F.struct(*bo.LINE).alias("was"), bo.pack_line(kinds), bo.pack(["device_name", "process"], kinds).alias("other"))
    got = packed.select("*", bo.unpack("line", bo.LINE, kinds).alias("now"), bo.on_known_device().alias("known")).collect()
    assert len({bytes(r.line) for r in got}) == len(rows)
    assert all(r.was == r.now and r.known == (r.was.device_name is not None) == (r.other is not None) for r in got)


def test_odd_and_unknown_names_are_jobs_of_their_own(spark):
    rows = [
        row("Printing", "m1", code="a\x1fb", style=None), row("Printing", "m1", code="a", style="b\x1f"), row("Printing", "m1", code=None),
        row("Printing", "m1", product="p1\x1f", die="1"), row("Printing", "m1", product="p1", die="\x1f1"),
        row("Gluing", "m\x1f1", device=None), row("Gluing", "m\x1f1", device="\x1b2"), row("Gluing", "m\x1f1", product=""),
        row("Gluing", "m\x1f1", product=None), row("Gluing", "m\x1f1", die=None),
    ]
    price = prices(spark, [("e1", "a", 2.0), ("e1", "c1", 1.0)])
    daily = {r.member_id: r for r in bo.daily_output(out(spark, rows), price).collect()}
    one, two = daily["m1"], daily["m\x1f1"]
    # two codes of which one has one style, and two jobs of one code and style
    assert (one.make_ready, one.number_of_lines, one.output_qty, one.revenue) == (2 * 1 + 1 + 1, 1, 50.0, 40.0)
    assert (two.process, two.shift_date, two.make_ready, two.number_of_lines, two.output_qty) == ("Gluing", DAY, 2, 2, 50.0)
    codes = lambda r: r.groupBy(*bo.JOB).agg(F.countDistinct("main_product_code").alias("make_ready"))
    ruled = {r.member_id: r.make_ready for r in bo.daily_output(out(spark, rows), price, group_rule=codes).collect()}
    assert ruled == {"m1": 2 + 1 + 1, "m\x1f1": 2}


def test_rows_of_output_are_dealt_in_few_columns(spark):
    """What a line and an item are travels packed."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        daily = bo.daily_output(out(spark, [row("Gluing", "m1")]), prices(spark, [("e1", "c1", 0.5)]))
        plan = daily._jdf.queryExecution().executedPlan().initialPlan()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dealt = []

    def walk(node):
        if node.nodeName() == "Exchange":
            dealt.append({node.output().apply(k).name() for k in range(node.output().size())})
        for k in range(node.children().size()):
            walk(node.children().apply(k))

    walk(plan)
    rows = {*bo.MEMBER_DAY, "line", "item", "main_product_code", "makeup_style", "output_qty"}
    assert rows | {"erp_num"} in dealt and rows | {"revenue"} in dealt
