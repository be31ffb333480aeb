"""The library's input tables, derived from the given parquet tables.

``Inputs`` builds them with Spark; ``ctes`` gives the same definitions as SQL
``WITH`` items for the oracle.  Definitions follow FIXTURES.md.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopledger.operators.ordered import neighbours
from shopledger.session import configure, store

AS_OF = dt.datetime(2000, 1, 1, 12, 0, 0)
PAY_START = dt.date(2024, 1, 1)
SPLIT_DATE = dt.date(2000, 1, 1)

_EMPLOYEE = (
    "concat('EE', CASE WHEN user_id<1000 THEN lpad(CAST(user_id AS STRING),3,'0') "
    "ELSE CAST(user_id AS STRING) END)"
)
_P_NUM = (
    "CASE WHEN l_linenumber=6 THEN NULL WHEN l_linenumber=7 AND l_partkey%97=0 THEN '  ' "
    "ELSE concat('P', CAST(l_orderkey AS STRING)) END"
)
# An operator books a hundred orders in a row.
_OPERATOR = (
    "concat('EE', CASE WHEN floor(l_orderkey/100)<1000 THEN lpad(CAST(CAST(floor(l_orderkey/100) AS BIGINT) AS STRING),3,'0') "
    "ELSE CAST(CAST(floor(l_orderkey/100) AS BIGINT) AS STRING) END)"
)
_FULL = (
    "FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {customer} ON o_custkey=c_custkey "
    "JOIN {part} ON l_partkey=p_partkey"
)
# The same rows for Spark: the customer's columns join the orders before these meet their lines, so the lines, which are
# more, are shuffled once less.
_FULL_BY_ORDER = (
    "FROM {lineitem} JOIN ({orders} JOIN {customer} ON o_custkey=c_custkey) ON l_orderkey=o_orderkey "
    "JOIN {part} ON l_partkey=p_partkey"
)

# name -> (tables or tables of this dict it reads, SQL)
SQL: dict[str, tuple[list[str], str]] = {
    "demand": (
        ["lineitem", "orders", "customer", "part"],
        f"""SELECT l_orderkey*10+l_linenumber AS dgn_bil_id, {_P_NUM} AS p_num,
            o_orderdate + INTERVAL '45' DAY AS delivery_date, c_name AS customer, l_partkey AS product_id,
            p_name AS product, CAST(l_quantity AS INT) AS order_count {_FULL}""",
    ),
    "shipments": (
        ["lineitem", "orders", "customer", "part"],
        f"""SELECT l_orderkey*10+l_linenumber AS dgn_bil_num, {_P_NUM} AS p_num, l_shipdate AS out_date,
            o_orderdate + INTERVAL '45' DAY AS delivery_date, c_name AS customer, l_partkey AS product_id,
            p_name AS product, p_brand AS parts_name,
            CASE WHEN l_returnflag='R' THEN 0 ELSE CAST(l_quantity AS INT) END AS out_count,
            CAST(l_quantity AS INT)+l_linenumber AS p_count
            {_FULL} WHERE l_linestatus='F'""",
    ),
    "plan": (
        ["lineitem", "orders", "customer", "part"],
        f"""SELECT {_P_NUM} AS p_num, p_type AS js_name, p_brand AS dev_name, CAST(l_quantity AS INT)*7 AS f_time,
            CAST(l_quantity AS INT) AS p_count,
            CASE WHEN o_orderstatus='F' THEN CASE WHEN l_linenumber%2=0 THEN 'Completed' ELSE '已完成' END
                 WHEN o_orderstatus='O' THEN 'Producing'
                 WHEN l_linenumber%2=0 THEN 'Pause' ELSE 'Waitting' END AS status_des,
            CASE WHEN l_linenumber%5>0 THEN o_orderstatus END AS state,
            c_name AS customer, l_partkey AS product_id, p_name AS product_name,
            o_orderdate + INTERVAL '45' DAY AS p_end_time {_FULL}""",
    ),
    "sessions": (
        ["events"],
        """SELECT user_id, s_ts, e_ts FROM (
            SELECT user_id, ts AS s_ts, lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS e_ts,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM {events}) x
            WHERE rn%2=1 AND e_ts IS NOT NULL AND e_ts <= s_ts + INTERVAL '16' HOUR""",
    ),
    "timesheet": (
        ["sessions"],
        f"""SELECT {_EMPLOYEE} AS employee_number, concat('First', CAST(user_id AS STRING)) AS first_name,
            concat('Last', CAST(user_id%7 AS STRING)) AS last_name,
            CASE user_id%4 WHEN 0 THEN 'Production' WHEN 1 THEN 'Business' WHEN 2 THEN 'Warehouse'
                 ELSE 'Temp' END AS department,
            CASE WHEN (user_id + day(st)) % 9 IN (0,1) THEN 'Vacation - paid' ELSE 'Shift' END AS job,
            CAST(st AS {{naive}}) AS start_ts, CAST(en AS {{naive}}) AS end_ts FROM (
            SELECT user_id, date_trunc('minute', s_ts) AS st,
                CASE WHEN CAST(s_ts AS DATE)=CAST(e_ts AS DATE) THEN date_trunc('minute', e_ts)
                     ELSE date_trunc('day', e_ts) END AS en FROM {{sessions}}
            UNION ALL
            SELECT user_id, date_trunc('day', e_ts), date_trunc('minute', e_ts) FROM {{sessions}}
                WHERE CAST(s_ts AS DATE)<>CAST(e_ts AS DATE)) y""",
    ),
    "schedule": (
        ["timesheet"],
        """SELECT CAST(start_ts AS DATE) AS sched_date, CAST(date_trunc('hour', start_ts) AS {naive}) AS sched_start,
            concat(first_name,' ',last_name) AS users,
            CASE WHEN day(start_ts)%10=0 THEN 'Unavailable' ELSE NULL END AS availability_status
            FROM (SELECT *, row_number() OVER (PARTITION BY employee_number, CAST(start_ts AS DATE)
                  ORDER BY start_ts DESC) AS rk FROM {timesheet}) z WHERE rk=1""",
    ),
    "payrate": (
        ["events"],
        f"""SELECT DISTINCT {_EMPLOYEE} AS employee_id,
            CASE WHEN user_id%11=0 THEN NULL ELSE 15+user_id%20 END AS reg_rate,
            CASE WHEN user_id%6=0 THEN NULL ELSE 22+user_id%20 END AS ot_rate,
            CASE user_id%5 WHEN 0 THEN 'Annual' WHEN 1 THEN 'Daily' WHEN 2 THEN NULL ELSE ' Hourly ' END AS pay_basis,
            CASE WHEN user_id%13=0 THEN 'Yes' ELSE NULL END AS skip_calc,
            CASE WHEN user_id%3=0 THEN 'Yes' ELSE 'No' END AS follow_clock,
            CASE WHEN user_id%8=0 THEN NULL ELSE 8 END AS ot_trigger_holiday, 10 AS ot_trigger_regular
            FROM {{events}}""",
    ),
    "holidays": (
        [],
        """SELECT DATE '2024-01-01' AS holiday_date, 'New Years Day' AS description
            UNION ALL SELECT DATE '2024-01-18', 'Synthetic Holiday'""",
    ),
    "sales_daily": (
        ["lineitem", "orders", "customer", "part"],
        f"""SELECT o_orderdate AS out_date, c_mktsegment AS sales, c_name AS customer, p_name AS product,
            l_partkey AS product_id, l_quantity AS out_count_total, l_extendedprice AS total_sales,
            l_extendedprice*(1-l_discount) AS total_sales_local_price {_FULL}""",
    ),
    "operator_output": (
        ["lineitem", "part"],
        f"""SELECT concat('ERP', CAST(l_orderkey AS STRING)) AS erp_num, p_name AS product,
            concat(CAST(p_partkey AS STRING), '|x') AS main_product_code, p_type AS makeup_style,
            CASE l_suppkey%5 WHEN 0 THEN 'Die Cutting' WHEN 1 THEN 'Gluing' WHEN 2 THEN 'WindowPatching'
                 ELSE 'Printing' END AS process,
            CASE WHEN l_suppkey%5=3 THEN 'SP1-HD102CX' WHEN l_suppkey%10=4 THEN 'CP1-HD104CX'
                 ELSE p_brand END AS device_name,
            CASE WHEN p_size%10=0 THEN NULL ELSE concat('D', CAST(p_size AS STRING)) END AS die_number,
            DATE '2024-01-01' + CAST(l_orderkey%30 AS INT) AS shift_date,
            {_OPERATOR} AS member_id, l_quantity*1000 AS output_qty
            FROM {{lineitem}} JOIN {{part}} ON l_partkey=p_partkey""",
    ),
    "die_price": (
        ["lineitem"],
        """SELECT DISTINCT concat('ERP', CAST(l_orderkey AS STRING), ',ERP', CAST(l_orderkey+1 AS STRING)) AS erp_num,
            CAST(l_partkey AS STRING) AS product_id, CAST(0.5 + l_partkey%4 AS DOUBLE) AS price FROM {lineitem}""",
    ),
    "bonus_rate": (
        ["events"],
        f"""SELECT DISTINCT {_EMPLOYEE} AS employee_number, concat('Name', CAST(user_id AS STRING)) AS name,
            CASE WHEN user_id%3=0 THEN 'East' ELSE 'West' END AS location,
            CASE WHEN user_id%2=0 THEN 'Sheeter' ELSE 'Gluer' END AS machine,
            CAST(1+user_id%3 AS DOUBLE) AS silver_rate,
            CASE WHEN user_id%17=0 THEN NULL ELSE CAST(2+user_id%3 AS DOUBLE) END AS gold_rate FROM {{events}}""",
    ),
    "sheeting": (
        ["lineitem"],
        f"""SELECT {_OPERATOR} AS employee_number,
            CAST(DATE '2024-01-01' + CAST(l_orderkey%30 AS INT) AS {{naive}}) + INTERVAL '8' HOUR AS start_time,
            CAST(l_quantity*2000 AS INT) AS paper_sheets FROM {{lineitem}}""",
    ),
}
BASE_TABLES = ["lineitem", "orders", "customer", "part", "supplier", "events"]


def ctes(*names: str) -> str:
    """``name AS (...)`` items for the named inputs and what they need, in order."""
    wanted: set[str] = set()

    def need(name: str) -> None:
        if name in SQL and name not in wanted:
            wanted.add(name)
            for other in SQL[name][0]:
                need(other)

    for name in names:
        need(name)
    plain = {t: t for t in BASE_TABLES} | {n: n for n in SQL} | {"naive": "TIMESTAMP"}
    return ",\n".join(f"{n} AS ({SQL[n][1].format(**plain)})" for n in SQL if n in wanted)


class Inputs:
    """The input tables over one folder of parquet files."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self._stored: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    def _sql(self, name: str) -> DataFrame:
        needs, text = SQL[name]
        frames = {n: getattr(self, n) if n in SQL else self.table(n) for n in needs}
        return self.spark.sql(text.replace(_FULL, _FULL_BY_ORDER).replace("{naive}", "TIMESTAMP_NTZ"), **frames)

    demand = cached_property(lambda self: self._sql("demand"))
    shipments = cached_property(lambda self: self._sql("shipments"))
    plan = cached_property(lambda self: self._sql("plan"))
    payrate = cached_property(lambda self: self._sql("payrate"))
    holidays = cached_property(lambda self: self._sql("holidays"))
    sales_daily = cached_property(lambda self: self._sql("sales_daily"))
    operator_output = cached_property(lambda self: self._sql("operator_output"))
    bonus_rate = cached_property(lambda self: self._sql("bonus_rate"))
    sheeting = cached_property(lambda self: self._sql("sheeting"))

    @cached_property
    def die_price(self) -> DataFrame:
        """Distinct by the two keys, each of which gives one text: they are shorter than the texts to shuffle."""
        keys = self.table("lineitem").select("l_orderkey", "l_partkey").distinct()
        return self.spark.sql(SQL["die_price"][1].replace("SELECT DISTINCT", "SELECT", 1), lineitem=keys)

    @cached_property
    def sessions(self) -> DataFrame:
        """Every second event of a user starts a session that the next event ends."""
        events = self.table("events").select("user_id", "ts", "event_id")
        paired = neighbours(
            events, ["user_id"], ["ts", "event_id"], F.to_date("ts"),
            lead={"e_ts": "ts"}, running={"rn": F.lit(1)},
        )
        short = F.col("e_ts") <= F.col("ts") + F.make_dt_interval(hours=F.lit(16))
        return paired.filter((F.col("rn") % 2 == 1) & short).select(
            "user_id", F.col("ts").alias("s_ts"), "e_ts"
        )

    @cached_property
    def timesheet(self) -> DataFrame:
        """One row per session, or two where it crosses midnight; stored, as ordered operators read it twice."""
        return self.stored("timesheet", self._timesheet)

    def _timesheet(self) -> DataFrame:
        def half(start, end):
            return F.struct(start.cast("timestamp_ntz").alias("start_ts"), end.cast("timestamp_ntz").alias("end_ts"))

        first, last = F.date_trunc("minute", "s_ts"), F.date_trunc("minute", "e_ts")
        midnight = F.date_trunc("day", "e_ts")
        whole = F.array(half(first, last))
        halves = F.array(half(first, midnight), half(midnight, last))
        same_day = F.to_date("s_ts") == F.to_date("e_ts")
        rows = self.sessions.select("user_id", F.inline(F.when(same_day, whole).otherwise(halves)))
        uid = F.col("user_id")
        number = F.when(uid < 1000, F.lpad(uid.cast("string"), 3, "0")).otherwise(uid.cast("string"))
        vacation = ((uid + F.dayofmonth("start_ts")) % 9).isin(0, 1)
        departments = F.array(*[F.lit(d) for d in ("Production", "Business", "Warehouse", "Temp")])
        return rows.select(
            F.concat(F.lit("EE"), number).alias("employee_number"),
            F.concat(F.lit("First"), uid.cast("string")).alias("first_name"),
            F.concat(F.lit("Last"), (uid % 7).cast("string")).alias("last_name"),
            F.get(departments, (uid % 4).cast("int")).alias("department"),
            F.when(vacation, "Vacation - paid").otherwise("Shift").alias("job"),
            "start_ts", "end_ts",
        )

    def stored(self, name: str, make) -> DataFrame:
        """A table several parts of a query read: written once to the shared folder."""
        if name not in self._stored:
            self._stored[name] = store(make(), name)
        return self._stored[name]

    @cached_property
    def schedule(self) -> DataFrame:
        """One schedule row per employee and day, at the hour of the last clock-in."""
        day = F.to_date("start_ts").alias("sched_date")
        last = self.timesheet.groupBy("employee_number", day).agg(
            F.max("start_ts").alias("start_ts"),
            F.max_by(F.concat("first_name", F.lit(" "), "last_name"), "start_ts").alias("users"),
        )
        return last.select(
            "sched_date",
            F.date_trunc("hour", "start_ts").cast("timestamp_ntz").alias("sched_start"),
            "users",
            F.when(F.dayofmonth("sched_date") % 10 == 0, "Unavailable").alias("availability_status"),
        )
