"""Operator output, performance flags and bonuses."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions import rules
from shopledger.functions.text import first_code, flag, to_number

# The printing devices that are rated on their own.
DEVICE_PROCESS = {"SP1-HD102CX": "Printing_CX102", "CP1-HD104CX": "Printing_CX104"}
SHEETER = "Sheeter"
COMMON_COLUMNS = [
    "first_name", "last_name", "start_date", "employee_number", "working_hours", "process", "make_ready",
    "number_of_lines", "output_qty", "revenue", "location", "machine", "silver_rate", "gold_rate",
    "flag_not_report_working_hour", "silver", "gold", "silver_bonus", "gold_bonus",
]
DAY = ["process", "shift_date", "member_id"]
MEMBER_DAY = ["member_id", "shift_date"]
JOB = [*DAY, "product", "device_name", "die_number"]
# A job is an item on a line, on a member's day.
LINE, ITEM = ["process", "device_name"], ["product", "die_number"]


def _zero_sum(c: str | Column) -> Column:
    return F.coalesce(F.sum(c), F.lit(0))


def _all_present(cols: Sequence[str]) -> Column:
    cond = F.lit(True)
    for c in cols:
        cond = cond & F.col(c).isNotNull()
    return cond


# -- packed columns ----------------------------------------------------------

FIELD, ESCAPE = "\x1f", "\x1b"
UNKNOWN = ESCAPE + "2"


def pack(cols: Sequence[str], kinds: Mapping[str, str]) -> Column:
    """The columns as the fields of one text, which tells apart whatever they hold; null if one of them is."""
    parts: list[Column] = []
    for c in cols:
        text = F.col(c).cast("string")
        if kinds[c] == "string":
            text = F.replace(F.replace(c, F.lit(ESCAPE), F.lit(ESCAPE + "0")), F.lit(FIELD), F.lit(ESCAPE + "1"))
        parts += [F.lit(FIELD), text]
    return F.concat(*parts[1:])


def pack_line(kinds: Mapping[str, str]) -> Column:
    """A line as text, its device may be null; as bytes, as sums by many texts first go through a small map for texts, in vain."""
    device = F.coalesce(pack(["device_name"], kinds), F.lit(UNKNOWN))
    return F.concat(pack(["process"], kinds), F.lit(FIELD), device).cast("binary").alias("line")


def unpack(packed: str, cols: Sequence[str], kinds: Mapping[str, str]) -> Column:
    """A struct of the first fields, named and of the kinds they had before they were packed."""

    def value(k: int, kind: str) -> Column:
        first = F.substring_index(F.col(packed).cast("string"), FIELD, k + 1)
        text = F.nullif(F.substring_index(first, FIELD, -1), F.lit(UNKNOWN))
        if kind != "string":
            return text.cast(kind)
        return F.replace(F.replace(text, F.lit(ESCAPE + "1"), F.lit(FIELD)), F.lit(ESCAPE + "0"), F.lit(ESCAPE))

    return F.struct(*[value(k, kinds[c]).alias(c) for k, c in enumerate(cols)])


def on_known_device() -> Column:
    return ~F.col("line").cast("string").endswith(FIELD + UNKNOWN)


# -- cleaning ----------------------------------------------------------------


def clean_sheeting(raw: DataFrame) -> DataFrame:
    """Rows with a sheet count, typed."""
    return raw.dropna(subset=["paper_sheets"]).withColumns(
        {
            "employee_number": F.col("employee_number").cast("string"),
            "start_time": F.col("start_time").cast("timestamp_ntz"),
            "paper_sheets": to_number(F.col("paper_sheets")),
        }
    )


def clean_operator_output(raw: DataFrame) -> DataFrame:
    """Rows with a member, typed, with the first product code of the code list."""
    return raw.dropna(subset=["member_id"]).withColumns(
        {
            "shift_date": F.col("shift_date").cast("date"),
            "output_qty": to_number(F.col("output_qty")),
            "main_product_code": first_code(F.col("main_product_code")),
        }
    )


def clean_bonus_rate(raw: DataFrame) -> DataFrame:
    return raw.select("employee_number", "name", "location", "machine", "silver_rate", "gold_rate")


def explode_prices(die_price: DataFrame) -> DataFrame:
    """One row per order number of the comma list."""
    return die_price.withColumn("erp_num", F.explode(F.split("erp_num", ","))).withColumn(
        "erp_num", F.trim("erp_num")
    )


def relabel_process(output: DataFrame) -> DataFrame:
    """Printing on the two rated devices becomes a process of its own."""
    device, process = F.col("device_name"), F.col("process")
    label = F.when(flag(process != "Printing"), process)
    for name, new in DEVICE_PROCESS.items():
        label = label.when(device == name, new)
    return output.withColumn("process", label.otherwise(process))


# -- sheeting ----------------------------------------------------------------


def sheeting_daily(sheeting: DataFrame) -> DataFrame:
    """Sheets per employee and day."""
    dated = sheeting.withColumn("start_date", F.to_date("start_time"))
    return (
        dated.filter(_all_present(["employee_number", "start_date"]))
        .groupBy("employee_number", "start_date")
        .agg(_zero_sum("paper_sheets").alias("paper_sheets"))
    )


def join_daily_hours(hours: DataFrame, daily: DataFrame) -> DataFrame:
    return hours.join(daily, ["employee_number", "start_date"], "inner")


def join_machine_rate(rows: DataFrame, bonus_rate: DataFrame, machine: str = SHEETER) -> DataFrame:
    rate = bonus_rate.filter(F.col("machine") == machine)
    return rows.join(rate, "employee_number", "left")


def sheeting_bonus(
    hours: DataFrame,
    daily: DataFrame,
    bonus_rate: DataFrame,
    gold: Callable[[], Column] = rules.sheeting_gold,
) -> DataFrame:
    """Gold flag and bonus per time-sheet row of a sheeting day.

    A gold row without a rate keeps a null bonus.
    """
    rows = join_machine_rate(join_daily_hours(hours, daily), bonus_rate)
    rows = rows.withColumn("gold", gold())
    bonus = F.when(F.col("gold"), F.col("working_hours") * F.col("gold_rate")).otherwise(F.lit(0.0))
    unreported = (F.col("paper_sheets") > 0) & F.col("working_hours").isNull()
    return (
        rows.withColumn("gold_bonus", bonus)
        .dropDuplicates()
        .withColumn("flag_not_report_working_hour", F.when(unreported, "yes").otherwise("no"))
    )


# -- other processes ---------------------------------------------------------


def join_prices(output: DataFrame, prices: DataFrame) -> DataFrame:
    """Revenue per output row and matching price row; several prices all stay."""
    price = prices.select("erp_num", F.col("product_id").alias("main_product_code"), "price")
    return output.join(price, ["erp_num", "main_product_code"], "left").withColumn(
        "revenue", F.col("output_qty") * F.col("price")
    )


def make_ready_rule(process: Column, n_codes: Column, n_styles: Column) -> Column:
    """Make-ready count of one product, device and die on a member's day.

    ``n_codes`` distinct product codes, ``n_styles`` distinct styles summed over
    the codes.  The product and the die are fixed within the group.
    """
    return (
        F.when(process == "Die Cutting", F.lit(1))
        .when(process == "Printing", n_codes * n_styles)
        .otherwise(n_codes)
    )


def by_group_rule(jobs: DataFrame, rows: DataFrame, rule: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """The jobs with the ``make_ready`` that a rule gives for each of them.

    The rule gets the rows of all jobs whose keys are known, with all their columns, and returns one row per job with
    the job's columns and ``make_ready``. A job that it leaves out, gives twice or invents is an error.
    """
    known = _all_present(JOB)
    ruled = rule(rows.filter(known)).groupBy(*JOB).agg(F.count(F.lit(1)).alias("n_ruled"), F.max("make_ready").alias("ruled"))
    both = jobs.withColumn("n_job", F.lit(1)).join(ruled, JOB, "full")
    fault = (
        F.when(known & F.col("n_ruled").isNull(), "gives no make-ready for")
        .when(F.col("n_job").isNull(), "gives a make-ready for the unknown")
        .when(F.col("n_ruled") > 1, "gives more than one make-ready for")
    )
    error = F.raise_error(F.concat_ws(" ", F.lit("the group rule"), fault, F.lit("job"), F.to_json(F.struct(*JOB)))).cast("bigint")
    made = F.when(fault.isNotNull(), error).otherwise(F.col("ruled").cast("bigint"))
    return both.select(*jobs.columns, made.alias("make_ready"))


def daily_output(
    output: DataFrame,
    prices: DataFrame,
    make_ready: Callable[[Column, Column, Column], Column] = make_ready_rule,
    group_rule: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Quantity, make-ready, lines and revenue per process, day and member.

    ``make_ready`` counts a job from its distinct codes and styles; ``group_rule``, if given, from all of its rows (see
    ``by_group_rule``).

    The prices of an (order, product) are summed before they meet the output: a
    price list with duplicates multiplies quantity and revenue as the row join
    would, without its rows.  One exchange, by member, day, process and device,
    serves the levels of styles, codes, jobs and devices; what a member makes on
    a device in a day bounds the rows that meet in a task, and they are summed as
    they come.  A day of many devices is summed from its devices, which are dealt
    by member and day: the join with the member's hours of the day deals them no more.
    """
    # Few prices share an order and a product: summed before the exchange, they would fill the memory of its tasks.
    listed = prices.select("erp_num", F.col("product_id").alias("main_product_code"), "price")
    price = listed.repartition("erp_num", "main_product_code").groupBy("erp_num", "main_product_code").agg(
        F.count(F.lit(1)).alias("n_prices"), F.sum("price").alias("price")
    )
    rows = relabel_process(output).filter(_all_present(DAY))
    kinds = dict(rows.dtypes)
    # Jobs of an unknown product or die count no make-ready: they need not be told apart.
    item = pack(ITEM, kinds).alias("item")
    made = rows.select("erp_num", *MEMBER_DAY, pack_line(kinds), item, "main_product_code", "makeup_style", "output_qty")
    priced = made.join(price, ["erp_num", "main_product_code"], "left").select(
        *MEMBER_DAY, "line", "item", "main_product_code", "makeup_style",
        (F.col("output_qty") * F.coalesce("n_prices", F.lit(1))).alias("output_qty"),
        (F.col("output_qty") * F.col("price")).alias("revenue"),
    )
    line, job = [*MEMBER_DAY, "line"], [*MEMBER_DAY, "line", "item"]
    measures = [F.sum("output_qty").alias("output_qty"), F.sum("revenue").alias("revenue")]
    styles = priced.repartition(*line).groupBy(*job, "main_product_code", "makeup_style").agg(*measures)
    codes = styles.groupBy(*job, "main_product_code").agg(F.count("makeup_style").alias("n_styles"), *measures)
    jobs = codes.groupBy(*job).agg(
        F.count("main_product_code").alias("n_codes"),
        _zero_sum(F.when(F.col("main_product_code").isNotNull(), F.col("n_styles"))).alias("n_styles"), *measures,
    )
    # Nor does a job on an unknown device.
    if group_rule is None:
        known = F.col("item").isNotNull() & on_known_device()
        process = unpack("line", LINE, kinds)["process"]
        jobs = jobs.withColumn("make_ready", F.when(known, make_ready(process, F.col("n_codes"), F.col("n_styles"))))
    else:
        keys = jobs.withColumns({"line": unpack("line", LINE, kinds), "item": unpack("item", ITEM, kinds)})
        ruled = by_group_rule(keys.select(*MEMBER_DAY, "line.*", "item.*", "output_qty", "revenue"), rows, group_rule)
        jobs = ruled.select(*MEMBER_DAY, pack_line(kinds), "make_ready", "output_qty", "revenue")
    devices = jobs.groupBy(*line).agg(F.sum("make_ready").alias("make_ready"), *measures)
    days = devices.withColumns({"named": F.when(on_known_device(), 1), "line": unpack("line", LINE, kinds)})
    dealt = days.select("line.process", *MEMBER_DAY, "named", "make_ready", "output_qty", "revenue").repartition(*MEMBER_DAY)
    return dealt.groupBy(*DAY).agg(
        _zero_sum("output_qty").alias("output_qty"),
        _zero_sum("make_ready").alias("make_ready"),
        F.count("named").alias("number_of_lines"),
        _zero_sum("revenue").alias("revenue"),
    )


def join_output_hours(hours: DataFrame, daily: DataFrame) -> DataFrame:
    """Every output day with the member's time-sheet rows of that day, if any."""
    named = hours.select("employee_number", "first_name", "last_name", "start_date", "working_hours")
    cond = (named["employee_number"] == daily["member_id"]) & (named["start_date"] == daily["shift_date"])
    return daily.join(named, cond, "left")


def with_eligibility(
    rows: DataFrame,
    silver: Callable[[], Column] = rules.silver_rule,
    gold: Callable[[], Column] = rules.gold_rule,
) -> DataFrame:
    """Silver and gold flags; gold wins over silver."""
    return rows.withColumn("gold", gold()).withColumn("silver", silver() & ~F.col("gold"))


def other_process_bonus(
    hours: DataFrame,
    daily: DataFrame,
    bonus_rate: DataFrame,
    silver: Callable[[], Column] = rules.silver_rule,
    gold: Callable[[], Column] = rules.gold_rule,
) -> DataFrame:
    """Flags and bonuses per output day; members with several rates keep one row per rate."""
    rows = join_output_hours(hours, daily).join(bonus_rate, "employee_number", "left")
    worked = (F.col("output_qty") > 0) | (F.col("make_ready") > 0)
    unreported = worked & F.col("working_hours").isNull()
    rows = with_eligibility(rows, silver, gold)

    def bonus(tier: str) -> Column:
        pay = F.when(F.col(tier), F.col("working_hours") * F.col(f"{tier}_rate"))
        return F.coalesce(pay, F.lit(0.0))

    return rows.withColumns(
        {
            "flag_not_report_working_hour": F.when(unreported, "yes").otherwise("no"),
            "employee_number": F.coalesce("employee_number", "member_id"),
            "silver_bonus": bonus("silver"),
            "gold_bonus": bonus("gold"),
        }
    )


# -- reports -----------------------------------------------------------------


def performance_union(sheeting: DataFrame, other: DataFrame) -> DataFrame:
    """Both result tables on their common columns."""
    sheets = sheeting.withColumns(
        {
            "process": F.lit("Sheeting"),
            "output_qty": F.col("paper_sheets").cast("double"),
            "make_ready": F.lit(1).cast("long"),
            "number_of_lines": F.lit(1).cast("long"),
            "revenue": F.lit(0.0),
            "silver": F.lit(False),
            "silver_bonus": F.lit(0.0),
        }
    )
    return sheets.select(*COMMON_COLUMNS).unionByName(other.select(*COMMON_COLUMNS))


def bonus_report(performance: DataFrame) -> DataFrame:
    return performance.filter(F.col("silver") | F.col("gold"))


def not_reported_report(performance: DataFrame) -> DataFrame:
    """Output without reported hours, per employee; the process is the first by name."""
    rows = performance.filter(F.col("flag_not_report_working_hour") == "yes")
    return rows.filter(F.col("employee_number").isNotNull()).groupBy("employee_number").agg(
        F.min("process").alias("process"),
        *[_zero_sum(c).alias(c) for c in ("make_ready", "output_qty", "revenue")],
    )


def production_bonus(performance: DataFrame) -> DataFrame:
    """Bonus per date and employee, the payroll's input."""
    total = F.coalesce("silver_bonus", F.lit(0.0)) + F.coalesce("gold_bonus", F.lit(0.0))
    rows = performance.select(
        F.col("start_date").alias("bonus_date"), F.col("employee_number").alias("employee_id"), total.alias("bonus")
    )
    return rows.filter(_all_present(["bonus_date", "employee_id"])).groupBy("bonus_date", "employee_id").agg(
        F.sum("bonus").alias("bonus")
    )


MEASURES = ["working_hours", "make_ready", "output_qty", "revenue"]
# What each employee chart leaves out.
EMPLOYEE_LIMITS = {
    "working_hours": lambda c: c >= 8,
    "make_ready": lambda c: c > 0,
    "output_qty": lambda c: c > 100,
    "revenue": lambda c: c > 100,
}


def summary_by(performance: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The four measures summed by the keys, in one pass."""
    return performance.filter(_all_present(keys)).groupBy(*keys).agg(*[_zero_sum(c).alias(c) for c in MEASURES])


def employee_summary(performance: DataFrame, measure: str) -> DataFrame:
    """One measure by employee and process, small totals left out."""
    totals = performance.filter(_all_present(["employee_number", "process"]))
    totals = totals.groupBy("employee_number", "process").agg(_zero_sum(measure).alias(measure))
    return totals.filter(EMPLOYEE_LIMITS[measure](F.col(measure)))


def report_range(performance: DataFrame) -> DataFrame:
    """First and last date of the report and the name built from them."""
    fmt = "yyyy-MM-dd"
    return performance.agg(
        F.min("start_date").alias("first_date"), F.max("start_date").alias("last_date")
    ).withColumn(
        "report_name",
        F.concat(
            F.lit("Production Report from "), F.date_format("first_date", fmt), F.lit(" to "),
            F.date_format("last_date", fmt),
        ),
    )
