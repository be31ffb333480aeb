"""Registered queries of the order and delivery analysis."""

from __future__ import annotations

from shopledger.operators import erp
from shopledger.plans.adapters import AS_OF, Inputs, ctes

NOW = "TIMESTAMP '2000-01-01 12:00:00'"
_BLANK = "({0} IS NULL OR trim({0})='')"
_OPEN_30 = f"d.delivery_date BETWEEN {NOW} AND {NOW} + INTERVAL '30' DAY"
_YEAR = f"BETWEEN {NOW} - INTERVAL '1' YEAR AND {NOW}"
_SHIP_KEY = "(SELECT *, CASE WHEN trim(p_num)<>'' THEN p_num END AS k FROM {0})"


def _basic(i: Inputs):
    return erp.basic_overview(i.demand)


QUERIES = {
    "basic_overview": _basic,
    "delivery_analysis": lambda i: erp.delivery_analysis(i.shipments, AS_OF),
    "shipped_past_30": lambda i: erp.shipped_past_30_days(i.shipments, AS_OF),
    "pending_deliveries": lambda i: erp.pending_deliveries(i.demand, i.shipments, AS_OF),
    "unscheduled_deliveries": lambda i: erp.unscheduled_deliveries(i.demand, i.shipments, AS_OF),
    "customer_analysis": lambda i: erp.customer_analysis(i.demand, i.shipments, AS_OF),
    "work_order_status": lambda i: erp.work_order_status(i.plan, i.shipments),
    "late_orders_impact": lambda i: erp.late_orders_impact(i.demand, i.shipments, AS_OF),
    "machine_utilization": lambda i: erp.machine_utilization(i.plan, i.demand, AS_OF),
    "priority_urgency": lambda i: erp.priority_urgency(i.plan, i.shipments, AS_OF),
    "top_priority": lambda i: erp.top_priority(erp.priority_urgency(i.plan, i.shipments, AS_OF), 100),
    "delivery_shipping_status": lambda i: erp.delivery_shipping_status(i.shipments, i.plan, AS_OF),
    "delivery_status_lines": lambda i: erp.delivery_status(i.shipments, i.plan, AS_OF).lines(),
}

_PRIORITY = f"""
orders_open AS (
  SELECT coalesce(p.k,p.p_num,'Unassigned') AS p_num, p.customer, p.product_id, p.product_name AS product,
    p.p_end_time AS delivery_date, count(DISTINCT p.product_id) AS product_count,
    CAST(sum(p.p_count) AS BIGINT) AS total_order_qty, max(p.status_des) AS work_order_status,
    max(s.out_date) AS shipped_date
  FROM {_SHIP_KEY.format('plan')} p LEFT JOIN {_SHIP_KEY.format('shipments')} s ON p.k=s.k
  WHERE p.p_end_time {_YEAR} GROUP BY 1,2,3,4,5),
scored AS (
  SELECT p_num, customer, product, delivery_date, product_count, total_order_qty, work_order_status, shipped_date,
    CAST(CASE WHEN delivery_date < {NOW} AND (shipped_date IS NULL OR shipped_date > delivery_date) THEN 100
         WHEN delivery_date BETWEEN {NOW} AND {NOW} + INTERVAL '7' DAY
              AND (shipped_date IS NULL OR shipped_date > delivery_date) THEN 80
         WHEN work_order_status='Producing' THEN 60 WHEN work_order_status IN ('Waitting','Pause') THEN 40
         ELSE 20 END AS INT) AS priority_score
  FROM orders_open WHERE work_order_status NOT IN ('Completed','已完成'))"""
_LATE = f"d.delivery_date < {NOW} AND (s.out_date IS NULL OR s.out_date > d.delivery_date)"
_UNSCHEDULED = f"""FROM demand d LEFT JOIN shipments s ON d.dgn_bil_id=s.dgn_bil_num
  WHERE {_OPEN_30} AND {_BLANK.format('s.p_num')}"""

ORACLES = {
    "basic_overview": f"""WITH {ctes('demand')}
SELECT count(*) AS total_records, count(*) FILTER ({_BLANK.format('p_num')}) AS missing_erp_num,
  count(*) FILTER (delivery_date IS NULL OR delivery_date=TIMESTAMP '1900-01-01 00:00:00') AS missing_delivery_date,
  count(*) FILTER ({_BLANK.format('customer')}) AS missing_customer FROM demand""",
    "delivery_analysis": f"""WITH {ctes('shipments')}
SELECT p_num, customer, product, delivery_date,
  CASE WHEN delivery_date < {NOW} THEN 'Missed'
       WHEN delivery_date BETWEEN {NOW} AND {NOW} + INTERVAL '7' DAY THEN 'Urgent' ELSE 'Upcoming' END AS delivery_status,
  CAST(sum(out_count) AS BIGINT) AS out_count FROM shipments GROUP BY 1,2,3,4,5""",
    "shipped_past_30": f"""WITH {ctes('shipments')}
SELECT p_num, out_date AS shipped_date, delivery_date, customer, product_id, product, parts_name,
  count(DISTINCT product_id) AS product_count, CAST(sum(out_count) AS BIGINT) AS total_shipped_qty
FROM shipments WHERE out_date BETWEEN {NOW} - INTERVAL '30' DAY AND {NOW} AND trim(p_num)<>''
GROUP BY 1,2,3,4,5,6,7""",
    "pending_deliveries": f"""WITH {ctes('demand', 'shipments')}
SELECT d.p_num, d.delivery_date, d.customer, d.product_id, d.product, s.parts_name,
  count(DISTINCT d.product_id) AS product_count, CAST(sum(d.order_count) AS BIGINT) AS total_order_qty
FROM demand d LEFT JOIN shipments s ON d.p_num=s.p_num
WHERE {_OPEN_30} AND trim(d.p_num)<>'' AND (s.out_count IS NULL OR s.out_count=0) GROUP BY 1,2,3,4,5,6""",
    "unscheduled_deliveries": f"""WITH {ctes('demand', 'shipments')}
SELECT d.dgn_bil_id, d.delivery_date, d.customer, d.product_id, d.product,
  count(DISTINCT d.product_id) AS product_count, CAST(sum(d.order_count) AS BIGINT) AS total_order_qty
{_UNSCHEDULED} GROUP BY 1,2,3,4,5""",
    "customer_analysis": f"""WITH {ctes('demand', 'shipments')}
SELECT d.delivery_date, d.customer, d.product_id, d.product,
  count(DISTINCT d.product_id) AS product_count, CAST(sum(d.order_count) AS BIGINT) AS total_order_qty
{_UNSCHEDULED} GROUP BY 1,2,3,4""",
    "work_order_status": f"""WITH {ctes('plan', 'shipments')}
SELECT p.status_des AS work_order_status, count(*) AS work_order_count,
  count(*) FILTER (s.out_date IS NOT NULL) AS shipped_count, count(*) FILTER (s.out_date IS NULL) AS not_shipped_count
FROM {_SHIP_KEY.format('plan')} p LEFT JOIN {_SHIP_KEY.format('shipments')} s ON p.k=s.k GROUP BY 1""",
    "late_orders_impact": f"""WITH {ctes('demand', 'shipments')}
SELECT d.customer, d.product, CAST(year(d.delivery_date) AS INT) AS delivery_year,
  CAST(month(d.delivery_date) AS INT) AS delivery_month, count(*) AS total_orders,
  count(*) FILTER ({_LATE}) AS late_orders, CAST(sum(d.order_count) AS BIGINT) AS total_order_qty,
  CAST(sum(CASE WHEN {_LATE} THEN d.order_count ELSE 0 END) AS BIGINT) AS late_order_qty
FROM {_SHIP_KEY.format('demand')} d LEFT JOIN {_SHIP_KEY.format('shipments')} s ON d.k=s.k
WHERE d.delivery_date {_YEAR} GROUP BY 1,2,3,4""",
    "machine_utilization": f"""WITH {ctes('plan', 'demand')}
SELECT p.js_name AS process, p.dev_name AS device_name, count(*) AS usage_count,
  CAST(sum(p.f_time) // count(p.f_time) AS BIGINT) AS avg_time_spent,
  count(*) FILTER (p.status_des='Producing' AND d.delivery_date < {NOW}) AS delayed_count,
  count(*) FILTER (p.status_des IN ('Completed','已完成')) AS completed_count,
  count(*) FILTER (p.status_des='Pause') AS paused_count, count(*) FILTER (p.status_des='Waitting') AS waiting_count
FROM {_SHIP_KEY.format('plan')} p LEFT JOIN {_SHIP_KEY.format('demand')} d ON p.k=d.k
WHERE d.delivery_date {_YEAR} GROUP BY 1,2""",
    "priority_urgency": f"WITH {ctes('plan', 'shipments')},{_PRIORITY}\nSELECT * FROM scored",
    "top_priority": f"""WITH {ctes('plan', 'shipments')},{_PRIORITY}
SELECT * FROM scored ORDER BY priority_score DESC, delivery_date ASC NULLS FIRST, p_num ASC NULLS FIRST,
  customer ASC NULLS FIRST, product ASC NULLS FIRST, total_order_qty DESC NULLS LAST,
  work_order_status ASC NULLS FIRST, shipped_date ASC NULLS FIRST, product_count ASC NULLS FIRST LIMIT 100""",
    "delivery_shipping_status": f"""WITH {ctes('plan', 'shipments')}, keyed AS {_SHIP_KEY.format('shipments')}
SELECT d.p_num, d.customer, d.product, d.delivery_date, a.state, a.status_des,
  CASE WHEN d.delivery_date < {NOW} AND s.out_date IS NULL THEN 'Missed & Not Shipped'
       WHEN d.delivery_date BETWEEN {NOW} AND {NOW} + INTERVAL '7' DAY AND s.out_date IS NULL THEN 'Urgent & Not Shipped'
       WHEN s.out_date IS NOT NULL THEN 'Shipped' ELSE 'Upcoming & Not Shipped' END AS delivery_status,
  CAST(sum(d.p_count) AS BIGINT) AS total_order_qty, s.out_date AS shipped_date, CAST(sum(d.out_count) AS BIGINT) AS out_count,
  CAST(sum(s.out_count) AS BIGINT) AS shipped_quantity
FROM keyed d LEFT JOIN keyed s ON d.k=s.k LEFT JOIN {_SHIP_KEY.format('plan')} a ON a.k=s.k
GROUP BY 1,2,3,4,5,6,7,9""",
    "delivery_status_lines": f"""WITH {ctes('plan', 'shipments')}, keyed AS {_SHIP_KEY.format('shipments')},
pairs AS (SELECT d.p_num, d.customer, d.product, d.delivery_date, d.p_count, d.out_count, s.out_date, s.out_count AS sent, a.k IS NOT NULL AS planned,
    coalesce(a.state, '-')||'/'||coalesce(a.status_des, '-') AS state
  FROM keyed d LEFT JOIN keyed s ON d.k=s.k LEFT JOIN {_SHIP_KEY.format('plan')} a ON a.k=s.k)
SELECT p_num, customer, product, delivery_date, CASE WHEN delivery_date < {NOW} AND count(out_date)=0 THEN 'Missed & Not Shipped'
    WHEN delivery_date BETWEEN {NOW} AND {NOW} + INTERVAL '7' DAY AND count(out_date)=0 THEN 'Urgent & Not Shipped'
    WHEN count(out_date)>0 THEN 'Shipped' ELSE 'Upcoming & Not Shipped' END AS delivery_status,
  count(*) AS n_pairs, CAST(sum(p_count) AS BIGINT) AS total_order_qty, CAST(sum(out_count) AS BIGINT) AS out_count,
  CAST(sum(sent) AS BIGINT) AS shipped_quantity, count(DISTINCT out_date) AS n_ship_dates, min(out_date) AS first_shipped,
  max(out_date) AS last_shipped, string_agg(DISTINCT state, ',' ORDER BY state) FILTER (planned) AS states
FROM pairs GROUP BY 1,2,3,4""",
}
