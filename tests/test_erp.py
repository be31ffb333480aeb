import datetime as dt
import random

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

from shopledger.operators import erp

NOW = dt.datetime(2000, 1, 1, 12)
DEMAND = "dgn_bil_id bigint, p_num string, delivery_date timestamp_ntz, customer string, product_id bigint, product string, order_count int"
SHIP = (
    "dgn_bil_num bigint, p_num string, out_date timestamp_ntz, delivery_date timestamp_ntz, customer string, "
    "product_id bigint, product string, parts_name string, out_count int, p_count int"
)
PLAN = (
    "p_num string, js_name string, dev_name string, f_time int, p_count int, status_des string, state string, customer string, "
    "product_id bigint, product_name string, p_end_time timestamp_ntz"
)


def rows(seed=3, n=60):
    rnd = random.Random(seed)

    def number():
        # A third of the rows share one order; some are unnumbered.
        return rnd.choice(["HOT"] * 4 + ["P1", "P2", "P3", "P4", "", " ", None, "Unassigned"])

    def day(spread=60):
        return rnd.choice([None, NOW, NOW + dt.timedelta(days=7), NOW + dt.timedelta(days=30)] + [
            NOW + dt.timedelta(days=rnd.randint(-spread, spread)) for _ in range(8)])

    def some(*xs):
        return rnd.choice(xs)

    demand = [(rnd.randint(1, 20), number(), day(), some("c1", "c2", " ", None), some(1, 2, None), some("x", "y"), some(1, 5, None)) for _ in range(n)]
    ship = [(rnd.randint(1, 20), number(), day(), day(), some("c1", "c2"), some(1, 2, None), some("x", "y"), some("p", None), some(0, 3, None), some(2, None)) for _ in range(n)]
    plan = [(number(), some("j1", "j2"), some("d1", "d2"), some(7, 8, None), some(1, 2, None),
             some("Producing", "Pause", "Waitting", "Completed", "已完成", None), some("F", "O", None), some("c1", "c2"), some(1, 2, None), some("x", "y"), day()) for _ in range(n)]
    return demand, ship, plan


@pytest.fixture(scope="module")
def tables(spark):
    demand, ship, plan = rows()
    frames = {"demand": (demand, DEMAND), "shipments": (ship, SHIP), "plan": (plan, PLAN)}
    con = duckdb.connect()
    for name, (data, schema) in frames.items():
        cols = [c.strip().split(" ") for c in schema.split(",")]
        pdf = pd.DataFrame(data, columns=[c for c, _ in cols]).astype(object)
        con.register(f"{name}_raw", pdf.where(pdf.notna(), None).astype("string"))
        kinds = {"string": "VARCHAR", "timestamp_ntz": "TIMESTAMP"}
        con.execute(f"CREATE TABLE {name} AS SELECT " + ", ".join(f"CAST({c} AS {kinds.get(k, k)}) AS {c}" for c, k in cols) + f" FROM {name}_raw")
    return {n: spark.createDataFrame(d, s).repartition(3) for n, (d, s) in frames.items()}, con


def same(df, con, sql):
    names = sorted(df.columns)
    got = sorted(str([r[c] for c in names]) for r in df.collect())
    res = con.execute(sql)
    order = [[d[0] for d in res.description].index(c) for c in names]
    want = sorted(str([r[i] for i in order]) for r in res.fetchall())
    assert got == want and got


KEY = {"null": "CASE WHEN trim(p_num)<>'' THEN p_num END", "match": "rtrim(p_num)"}
T = "TIMESTAMP '2000-01-01 12:00:00'"
YEAR = f"BETWEEN {T} - INTERVAL 1 YEAR AND {T}"


@pytest.mark.parametrize("policy", ["null", "match"])
def test_counted_joins_equal_row_joins(tables, policy):
    f, con = tables
    k = KEY[policy]
    keyed = {n: f"(SELECT *, {k} AS k FROM {n})" for n in ("demand", "shipments", "plan")}
    late = f"d.delivery_date < {T} AND (s.out_date IS NULL OR s.out_date > d.delivery_date)"
    same(erp.work_order_status(f["plan"], f["shipments"], policy), con, f"""
        SELECT p.status_des AS work_order_status, count(*) AS work_order_count, count(s.out_date) AS shipped_count,
          count(*)-count(s.out_date) AS not_shipped_count
        FROM {keyed['plan']} p LEFT JOIN {keyed['shipments']} s ON p.k=s.k GROUP BY 1""")
    same(erp.late_orders_impact(f["demand"], f["shipments"], NOW, policy), con, f"""
        SELECT d.customer, d.product, year(d.delivery_date) AS delivery_year, month(d.delivery_date) AS delivery_month,
          count(*) AS total_orders, count(*) FILTER ({late}) AS late_orders, sum(d.order_count)::BIGINT AS total_order_qty,
          sum(CASE WHEN {late} THEN coalesce(d.order_count, 0) ELSE 0 END)::BIGINT AS late_order_qty
        FROM {keyed['demand']} d LEFT JOIN {keyed['shipments']} s ON d.k=s.k
        WHERE d.delivery_date {YEAR} GROUP BY 1,2,3,4""")
    same(erp.machine_utilization(f["plan"], f["demand"], NOW, policy), con, f"""
        SELECT p.js_name AS process, p.dev_name AS device_name, count(*) AS usage_count,
          (sum(p.f_time)//count(p.f_time))::BIGINT AS avg_time_spent,
          count(*) FILTER (p.status_des='Producing' AND d.delivery_date < {T}) AS delayed_count,
          count(*) FILTER (p.status_des IN ('Completed','已完成')) AS completed_count,
          count(*) FILTER (p.status_des='Pause') AS paused_count, count(*) FILTER (p.status_des='Waitting') AS waiting_count
        FROM {keyed['plan']} p JOIN {keyed['demand']} d ON p.k=d.k WHERE d.delivery_date {YEAR} GROUP BY 1,2""")
    same(erp.priority_urgency(f["plan"], f["shipments"], NOW, policy), con, f"""
        WITH o AS (SELECT coalesce(p.k,p.p_num,'Unassigned') AS p_num, p.customer, p.product_id, p.product_name AS product,
            p.p_end_time AS delivery_date, count(DISTINCT p.product_id) AS product_count,
            sum(p.p_count)::BIGINT AS total_order_qty, max(p.status_des) AS work_order_status, max(s.out_date) AS shipped_date
          FROM {keyed['plan']} p LEFT JOIN {keyed['shipments']} s ON p.k=s.k WHERE p.p_end_time {YEAR} GROUP BY 1,2,3,4,5)
        SELECT p_num, customer, product, delivery_date, product_count, total_order_qty, work_order_status, shipped_date,
          CASE WHEN delivery_date < {T} AND (shipped_date IS NULL OR shipped_date > delivery_date) THEN 100
            WHEN delivery_date BETWEEN {T} AND {T} + INTERVAL 7 DAY AND (shipped_date IS NULL OR shipped_date > delivery_date) THEN 80
            WHEN work_order_status='Producing' THEN 60 WHEN work_order_status IN ('Waitting','Pause') THEN 40 ELSE 20 END AS priority_score
        FROM o WHERE work_order_status NOT IN ('Completed','已完成')""")
    pairs = f"""(SELECT d.p_num, d.customer, d.product, d.delivery_date, a.state, a.status_des, a.k AS planned, d.p_count, d.out_count,
          s.out_date, s.out_count AS sent
        FROM {keyed['shipments']} d LEFT JOIN {keyed['shipments']} s ON d.k=s.k LEFT JOIN {keyed['plan']} a ON a.k=s.k)"""
    status = f"""CASE WHEN delivery_date < {T} AND {{0}} THEN 'Missed & Not Shipped'
            WHEN delivery_date BETWEEN {T} AND {T} + INTERVAL 7 DAY AND {{0}} THEN 'Urgent & Not Shipped'
            WHEN NOT {{0}} THEN 'Shipped' ELSE 'Upcoming & Not Shipped' END AS delivery_status"""
    same(erp.delivery_shipping_status(f["shipments"], f["plan"], NOW, policy), con, f"""
        SELECT p_num, customer, product, delivery_date, state, status_des, {status.format('(out_date IS NULL)')}, sum(p_count)::BIGINT AS total_order_qty,
          sum(out_count)::BIGINT AS out_count, out_date AS shipped_date, sum(sent)::BIGINT AS shipped_quantity
        FROM {pairs} GROUP BY 1,2,3,4,5,6,7,10""")
    same(erp.delivery_status(f["shipments"], f["plan"], NOW, policy).lines(), con, f"""
        SELECT p_num, customer, product, delivery_date, {status.format('(count(out_date)=0)')}, count(*) AS n_pairs, sum(p_count)::BIGINT AS total_order_qty,
          sum(out_count)::BIGINT AS out_count, sum(sent)::BIGINT AS shipped_quantity, count(DISTINCT out_date) AS n_ship_dates,
          min(out_date) AS first_shipped, max(out_date) AS last_shipped,
          string_agg(DISTINCT coalesce(state, '-')||'/'||coalesce(status_des, '-'), ',' ORDER BY coalesce(state, '-')||'/'||coalesce(status_des, '-'))
            FILTER (planned IS NOT NULL) AS states
        FROM {pairs} GROUP BY 1,2,3,4""")


def test_a_hot_order_stays_linear(spark):
    """One order of 20,000 lines on as many dates would have 400 million pairs; its lines are 20,000 rows."""
    n = 20_000
    at = F.timestamp_add("MINUTE", F.col("id"), F.lit(NOW).cast("timestamp_ntz"))
    ship = spark.range(n).select(
        F.lit("HOT").alias("p_num"), at.alias("out_date"), at.alias("delivery_date"), F.lit("c").alias("customer"),
        F.col("id").cast("string").alias("product"), F.lit(1).alias("out_count"), F.lit(2).alias("p_count"))
    plan = spark.range(n).select(F.lit("HOT").alias("p_num"), F.lit("F").alias("state"), F.lit("Pause").alias("status_des"))
    row = erp.delivery_status(ship, plan, NOW).lines().agg(F.count("*"), F.min("n_pairs"), F.min("shipped_quantity"), F.max("states")).first()
    assert tuple(row) == (n, n * n, n * n, "F/Pause")


def test_open_deliveries(tables):
    f, con = tables
    window = f"d.delivery_date BETWEEN {T} AND {T} + INTERVAL 30 DAY"
    same(erp.pending_deliveries(f["demand"], f["shipments"], NOW), con, f"""
        SELECT d.p_num, d.delivery_date, d.customer, d.product_id, d.product, s.parts_name,
          count(DISTINCT d.product_id) AS product_count, sum(d.order_count)::BIGINT AS total_order_qty
        FROM demand d LEFT JOIN shipments s ON d.p_num=s.p_num
        WHERE {window} AND trim(d.p_num)<>'' AND (s.out_count IS NULL OR s.out_count=0) GROUP BY 1,2,3,4,5,6""")
    for keys, fn in (("d.dgn_bil_id, ", erp.unscheduled_deliveries), ("", erp.customer_analysis)):
        same(fn(f["demand"], f["shipments"], NOW), con, f"""
            SELECT {keys}d.delivery_date, d.customer, d.product_id, d.product, count(DISTINCT d.product_id) AS product_count,
              sum(d.order_count)::BIGINT AS total_order_qty
            FROM demand d LEFT JOIN shipments s ON d.dgn_bil_id=s.dgn_bil_num
            WHERE {window} AND (s.p_num IS NULL OR trim(s.p_num)='') GROUP BY ALL""")


def test_overview_counts_blanks(tables):
    f, con = tables
    same(erp.basic_overview(f["demand"]), con, """
        SELECT count(*) AS total_records, count(*) FILTER (p_num IS NULL OR trim(p_num)='') AS missing_erp_num,
          count(*) FILTER (delivery_date IS NULL) AS missing_delivery_date,
          count(*) FILTER (customer IS NULL OR trim(customer)='') AS missing_customer FROM demand""")


def test_unknown_policy(spark):
    with pytest.raises(ValueError):
        erp.order_key("p", "other")
