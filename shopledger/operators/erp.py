"""Order, delivery, plan and shipment analysis over the ERP tables.

Every view of this module that joins two tables on the work-order number is a
many-to-many join followed by sums.  The sums only need *how many* partner rows
an order has (and how many of them satisfy a condition), so both sides are
aggregated per order first and the counts are multiplied.  The pairs of an order
are never produced: a work order holding a third of all rows costs one partial
aggregate per task instead of a quadratic join.

``as_of`` stands for the current time of the analysis.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.clock import naive
from shopledger.functions.text import is_blank
from shopledger.operators.ordered import neighbours
from shopledger.session import store

# The status words of the plan table.
STATUS = {
    "producing": ["Producing"],
    "completed": ["Completed", "已完成"],
    "paused": ["Pause"],
    "waiting": ["Waitting"],
}
MISSING_DATE = dt.datetime(1900, 1, 1)


def _days(n: int) -> Column:
    return F.make_dt_interval(days=F.lit(n))


def _next_days(date: Column, as_of: dt.datetime, n: int) -> Column:
    return date.between(naive(as_of), naive(as_of) + _days(n))


def _past_year(date: Column, as_of: dt.datetime) -> Column:
    return date.between(naive(as_of) - F.make_ym_interval(years=F.lit(1)), naive(as_of))


def _one_if(cond: Column) -> Column:
    return F.when(cond, 1).otherwise(0)


def _count_if(cond: Column) -> Column:
    return F.sum(_one_if(cond)).cast("long")


def order_key(p_num: Column, policy: str = "null") -> Column:
    """Join key of a work-order number.

    ``null``: blank numbers match nothing.  ``match``: blank numbers match each
    other, trailing blanks being ignored as in a blank-padded comparison.
    """
    if policy == "null":
        return F.when(~is_blank(p_num), p_num)
    if policy == "match":
        return F.rtrim(p_num)
    raise ValueError(f"unknown blank-key policy: {policy}")


def basic_overview(demand: DataFrame) -> DataFrame:
    """Row count and missing order number, delivery date and customer."""
    no_date = F.col("delivery_date").isNull() | (F.col("delivery_date") == naive(MISSING_DATE))
    return demand.agg(
        F.count(F.lit(1)).alias("total_records"),
        _count_if(is_blank(F.col("p_num"))).alias("missing_erp_num"),
        _count_if(no_date).alias("missing_delivery_date"),
        _count_if(is_blank(F.col("customer"))).alias("missing_customer"),
    )


def delivery_analysis(shipments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Shipped quantity per order, product and due date, with the due status."""
    keys = ["p_num", "customer", "product", "delivery_date"]
    due = F.col("delivery_date")
    status = F.when(due < naive(as_of), "Missed").when(_next_days(due, as_of, 7), "Urgent")
    # The status follows from the due date, so it need not be a grouping key.
    return (
        shipments.groupBy(*keys)
        .agg(F.sum("out_count").alias("out_count"))
        .withColumn("delivery_status", status.otherwise("Upcoming"))
    )


def shipped_past_30_days(shipments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """What left in the last 30 days, by order, dates, customer, product and part."""
    recent = F.col("out_date").between(naive(as_of) - _days(30), naive(as_of))
    return (
        shipments.filter(recent & ~is_blank(F.col("p_num")))
        .groupBy("p_num", F.col("out_date").alias("shipped_date"), "delivery_date", "customer",
                 "product_id", "product", "parts_name")
        .agg(F.sum("out_count").alias("total_shipped_qty"))
        # The product is a grouping key: its distinct count is 1, or 0 when it is null.
        .withColumn("product_count", _one_if(F.col("product_id").isNotNull()).cast("long"))
    )


def pending_deliveries(demand: DataFrame, shipments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Due in the next 30 days with an order number, nothing shipped (or zero shipped)."""
    keys = ["p_num", "delivery_date", "customer", "product_id", "product"]
    due = demand.filter(_next_days(F.col("delivery_date"), as_of, 30) & ~is_blank(F.col("p_num")))
    due = due.groupBy(*keys).agg(F.sum("order_count").alias("qty"))
    nothing = F.col("out_count").isNull() | (F.col("out_count") == 0)
    sent = shipments.filter(~is_blank(F.col("p_num"))).groupBy("p_num", "parts_name")
    sent = sent.agg(_count_if(nothing).alias("n_open"))
    return (
        due.join(sent, "p_num", "left")
        .filter(F.col("n_open").isNull() | (F.col("n_open") > 0))
        .select(
            *keys, "parts_name",
            _one_if(F.col("product_id").isNotNull()).cast("long").alias("product_count"),
            (F.col("qty") * F.coalesce("n_open", F.lit(1))).alias("total_order_qty"),
        )
    )


def _unscheduled(demand: DataFrame, shipments: DataFrame, as_of: dt.datetime, keys: list[str]) -> DataFrame:
    due = demand.filter(_next_days(F.col("delivery_date"), as_of, 30))
    due = due.groupBy("dgn_bil_id", *[k for k in keys if k != "dgn_bil_id"])
    due = due.agg(F.sum("order_count").alias("qty"))
    bills = shipments.groupBy(F.col("dgn_bil_num").alias("dgn_bil_id"))
    bills = bills.agg(_count_if(is_blank(F.col("p_num"))).alias("n_blank"))
    return (
        due.join(bills, "dgn_bil_id", "left")
        .filter(F.col("n_blank").isNull() | (F.col("n_blank") > 0))
        .withColumn("qty", F.col("qty") * F.coalesce("n_blank", F.lit(1)))
    )


def unscheduled_deliveries(demand: DataFrame, shipments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """Due in the next 30 days, the bill not shipped under any order number."""
    keys = ["dgn_bil_id", "delivery_date", "customer", "product_id", "product"]
    return _unscheduled(demand, shipments, as_of, keys).select(
        *keys,
        _one_if(F.col("product_id").isNotNull()).cast("long").alias("product_count"),
        F.col("qty").alias("total_order_qty"),
    )


def customer_analysis(demand: DataFrame, shipments: DataFrame, as_of: dt.datetime) -> DataFrame:
    """The unscheduled deliveries per customer, product and due date."""
    keys = ["delivery_date", "customer", "product_id", "product"]
    open_bills = _unscheduled(demand, shipments, as_of, ["dgn_bil_id", *keys])
    return (
        open_bills.groupBy(*keys)
        .agg(F.sum("qty").alias("total_order_qty"))
        .withColumn("product_count", _one_if(F.col("product_id").isNotNull()).cast("long"))
    )


def _shipment_counts(shipments: DataFrame, policy: str) -> DataFrame:
    keyed = shipments.withColumn("order_key", order_key(F.col("p_num"), policy))
    return keyed.filter(F.col("order_key").isNotNull()).groupBy("order_key")


def work_order_status(plan: DataFrame, shipments: DataFrame, policy: str = "null") -> DataFrame:
    """Plan rows joined to shipments, counted by status and by shipped or not."""
    rows = plan.groupBy(order_key(F.col("p_num"), policy).alias("order_key"), "status_des")
    rows = rows.agg(F.count(F.lit(1)).alias("n"))
    sent = _shipment_counts(shipments, policy).agg(
        F.count(F.lit(1)).alias("n_all"), F.count("out_date").alias("n_out")
    )
    n_all, n_out = F.coalesce("n_all", F.lit(0)), F.coalesce("n_out", F.lit(0))
    return (
        rows.join(sent, "order_key", "left")
        .groupBy(F.col("status_des").alias("work_order_status"))
        .agg(
            F.sum(F.col("n") * F.greatest(n_all, F.lit(1))).alias("work_order_count"),
            F.sum(F.col("n") * n_out).alias("shipped_count"),
            F.sum(F.col("n") * (F.greatest(n_all, F.lit(1)) - n_out)).alias("not_shipped_count"),
        )
    )


def late_orders_impact(
    demand: DataFrame, shipments: DataFrame, as_of: dt.datetime, policy: str = "null"
) -> DataFrame:
    """Orders and late orders of the past year by customer, product and month.

    A demand row is late once per partner shipment that left after the due date or
    has no date, and once if there is no shipment.  How many shipments of an
    order left after a given due date is read off a running count over the
    order's distinct dates, which are written to the shared folder as they are
    read more than once.
    """
    keyed = demand.filter(_past_year(F.col("delivery_date"), as_of)).withColumn(
        "order_key", order_key(F.col("p_num"), policy)
    )
    lines = keyed.groupBy("order_key", "customer", "product", "delivery_date").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("order_count").cast("long")).alias("qty")
    )
    left = shipments.select(
        order_key(F.col("p_num"), policy).alias("order_key"), F.col("out_date").alias("at"),
        F.lit(1).alias("sent"), F.lit(0).alias("asked"),
    )
    asked = lines.select(
        "order_key", F.col("delivery_date").alias("at"), F.lit(0).alias("sent"), F.lit(1).alias("asked")
    )
    # One row per distinct (order, date) of either table: the windows see dates, not shipments.
    dates = (
        left.unionByName(asked)
        .filter(F.col("order_key").isNotNull())
        .groupBy("order_key", "at")
        .agg(F.sum("sent").alias("sent"), F.max("asked").alias("asked"))
    )
    dates = store(dates, "order-dates")
    # An order with times instead of dates has many rows here: they are counted by day.
    on_time = neighbours(
        dates.filter(F.col("at").isNotNull()), ["order_key"], ["at"], F.to_date("at"), running={"n_on_time": F.col("sent")}
    )
    sent = dates.groupBy("order_key").agg(F.sum("sent").alias("n_all"))
    counts = on_time.filter(F.col("asked") == 1).join(sent, "order_key").select(
        "order_key", F.col("at").alias("delivery_date"), "n_all", "n_on_time"
    )
    n_all = F.coalesce("n_all", F.lit(0))
    late = F.when(F.col("delivery_date") < naive(as_of),
                  F.when(n_all == 0, 1).otherwise(n_all - F.coalesce("n_on_time", F.lit(0)))).otherwise(0)
    pairs = F.greatest(n_all, F.lit(1))
    return (
        lines.join(counts, ["order_key", "delivery_date"], "left")
        .groupBy("customer", "product", F.year("delivery_date").alias("delivery_year"),
                 F.month("delivery_date").alias("delivery_month"))
        .agg(
            F.sum(F.col("n") * pairs).alias("total_orders"),
            F.sum(F.col("n") * late).alias("late_orders"),
            F.sum(F.col("qty") * pairs).alias("total_order_qty"),
            F.sum(F.coalesce("qty", F.lit(0)) * late).alias("late_order_qty"),
        )
    )


def machine_utilization(
    plan: DataFrame, demand: DataFrame, as_of: dt.datetime, policy: str = "null",
    status_map: Mapping[str, list[str]] = STATUS,
) -> DataFrame:
    """Use, mean time and order states by process and device, orders due in the past year."""
    status = F.col("status_des")

    def count_status(name: str) -> Column:
        return _count_if(status.isin(*status_map[name]))

    jobs = (
        plan.withColumn("order_key", order_key(F.col("p_num"), policy))
        .filter(F.col("order_key").isNotNull())
        .groupBy("order_key", F.col("js_name").alias("process"), F.col("dev_name").alias("device_name"))
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.col("f_time").cast("long")).alias("time_sum"),
            F.count("f_time").alias("time_n"),
            *[count_status(s).alias(s) for s in ("producing", "completed", "paused", "waiting")],
        )
    )
    due = (
        demand.filter(_past_year(F.col("delivery_date"), as_of))
        .groupBy(order_key(F.col("p_num"), policy).alias("order_key"))
        .agg(F.count(F.lit(1)).alias("n_due"), _count_if(F.col("delivery_date") < naive(as_of)).alias("n_over"))
    )
    n_due = F.col("n_due")
    sums = jobs.join(due, "order_key").groupBy("process", "device_name").agg(
        F.sum(F.col("n") * n_due).alias("usage_count"),
        F.sum(F.col("time_sum") * n_due).alias("time_sum"),
        F.sum(F.col("time_n") * n_due).alias("time_n"),
        F.sum(F.col("producing") * F.col("n_over")).alias("delayed_count"),
        *[F.sum(F.col(s) * n_due).alias(f"{s}_count") for s in ("completed", "paused", "waiting")],
    )
    # The mean of whole numbers is a whole number here.
    mean = F.when(F.col("time_n") > 0, F.expr("time_sum div nullif(time_n, 0)"))
    return sums.withColumn("avg_time_spent", mean).drop("time_sum", "time_n")


def priority_urgency(
    plan: DataFrame, shipments: DataFrame, as_of: dt.datetime, policy: str = "null",
    status_map: Mapping[str, list[str]] = STATUS,
) -> DataFrame:
    """Open orders planned to end in the past year, with a priority score."""
    key = order_key(F.col("p_num"), policy)
    # 'Unassigned' rows and rows of an order that is really called so share a label
    # but only the latter have partners, hence two sums in one pass.
    orders = (
        plan.filter(_past_year(F.col("p_end_time"), as_of))
        .groupBy(
            # only a missing number is relabelled; a blank one keeps its label, but matches nothing
            F.coalesce(key, "p_num", F.lit("Unassigned")).alias("p_num"), "customer", "product_id",
            F.col("product_name").alias("product"), F.col("p_end_time").alias("delivery_date"),
        )
        .agg(
            F.sum(F.when(key.isNotNull(), F.col("p_count").cast("long"))).alias("qty_keyed"),
            F.sum(F.when(key.isNull(), F.col("p_count").cast("long"))).alias("qty_free"),
            F.max(key.isNotNull()).alias("keyed"),
            F.max("status_des").alias("work_order_status"),
        )
        .filter(~F.col("work_order_status").isin(*status_map["completed"]))
    )
    sent = _shipment_counts(shipments, policy).agg(
        F.count(F.lit(1)).alias("n_all"), F.max("out_date").alias("last_out")
    )
    shipped = F.when(F.col("keyed"), F.col("last_out"))
    qty = F.when(
        F.col("qty_keyed").isNotNull() | F.col("qty_free").isNotNull(),
        F.coalesce(F.col("qty_keyed") * F.coalesce("n_all", F.lit(1)), F.lit(0)) + F.coalesce("qty_free", F.lit(0)),
    )
    due, now = F.col("delivery_date"), naive(as_of)
    not_in_time = F.col("shipped_date").isNull() | (F.col("shipped_date") > due)
    score = (
        F.when((due < now) & not_in_time, 100)
        .when(_next_days(due, as_of, 7) & not_in_time, 80)
        .when(F.col("work_order_status").isin(*status_map["producing"]), 60)
        .when(F.col("work_order_status").isin(*status_map["waiting"], *status_map["paused"]), 40)
        .otherwise(20)
    )
    return (
        orders.join(sent.withColumnRenamed("order_key", "p_num"), "p_num", "left")
        .select(
            "p_num", "customer", "product", "delivery_date",
            _one_if(F.col("product_id").isNotNull()).cast("long").alias("product_count"),
            qty.alias("total_order_qty"), "work_order_status", shipped.alias("shipped_date"),
        )
        .withColumn("priority_score", score)
    )


def top_priority(scored: DataFrame, n: int) -> DataFrame:
    """The n most urgent open orders, in order."""
    return scored.orderBy(
        F.desc("priority_score"), F.asc("delivery_date"), "p_num", "customer", "product",
        F.desc("total_order_qty"), "work_order_status", "shipped_date", "product_count",
    ).limit(n)


@dataclass(frozen=True)
class DeliveryStatus:
    """Due lines, and per order what was shipped and planned, before they are paired.

    An order with many lines, ship dates and plan states has as many pairs as their product; these tables have their
    sum. ``lines`` answers what is asked per line, ``pairs`` gives the view's rows.
    """

    due: DataFrame
    sent: DataFrame
    states: DataFrame
    as_of: dt.datetime

    def _status(self, due: Column, shipped: Column) -> Column:
        return (
            F.when((due < naive(self.as_of)) & ~shipped, "Missed & Not Shipped")
            .when(_next_days(due, self.as_of, 7) & ~shipped, "Urgent & Not Shipped")
            .when(shipped, "Shipped")
            .otherwise("Upcoming & Not Shipped")
        )

    def pairs(self) -> DataFrame:
        """One row per due line, plan state and ship date of its order, with the quantities the row join sums up."""
        n_due, n_sent, n_plan = F.col("n_due"), F.coalesce("n_sent", F.lit(1)), F.coalesce("n_plan", F.lit(1))
        shipped = F.col("shipped_date")
        return (
            self.due.join(self.sent, "order_key", "left").join(self.states, "order_key", "left").select(
                "p_num", "customer", "product", "delivery_date", "state", "status_des",
                self._status(F.col("delivery_date"), shipped.isNotNull()).alias("delivery_status"),
                (F.col("due_count") * n_sent * n_plan).alias("total_order_qty"),
                (F.col("due_qty") * n_sent * n_plan).alias("out_count"), "shipped_date",
                (F.col("sent_qty") * n_due * n_plan).alias("shipped_quantity"),
            )
        )

    def lines(self) -> DataFrame:
        """One row per due line with the totals over all its pairs: orders are summed before they meet the lines.

        ``delivery_status`` is that of the line's order as a whole, ``states`` the distinct words of its plan.
        """
        sent = self.sent.groupBy("order_key").agg(
            F.sum("n_sent").alias("n_sent"), F.sum("sent_qty").alias("sent_qty"), F.count("shipped_date").alias("n_ship_dates"),
            F.min("shipped_date").alias("first_shipped"), F.max("shipped_date").alias("last_shipped"),
        )
        word = F.concat_ws("/", F.coalesce("state", F.lit("-")), F.coalesce("status_des", F.lit("-")))
        planned = self.states.groupBy("order_key").agg(
            F.sum("n_plan").alias("n_plan"), F.array_join(F.array_sort(F.collect_set(word)), ",").alias("states")
        )
        n_sent, n_plan = F.coalesce("n_sent", F.lit(1)), F.coalesce("n_plan", F.lit(1))
        return self.due.join(sent, "order_key", "left").join(planned, "order_key", "left").select(
            "p_num", "customer", "product", "delivery_date",
            self._status(F.col("delivery_date"), F.coalesce(F.col("n_ship_dates") > 0, F.lit(False))).alias("delivery_status"),
            (F.col("n_due") * n_sent * n_plan).alias("n_pairs"), (F.col("due_count") * n_sent * n_plan).alias("total_order_qty"),
            (F.col("due_qty") * n_sent * n_plan).alias("out_count"), (F.col("sent_qty") * F.col("n_due") * n_plan).alias("shipped_quantity"),
            F.coalesce("n_ship_dates", F.lit(0).cast("long")).alias("n_ship_dates"), "first_shipped", "last_shipped", "states",
        )


def delivery_status(shipments: DataFrame, plan: DataFrame, as_of: dt.datetime, policy: str = "null") -> DeliveryStatus:
    """Due and shipping status of the orders; each side is reduced to its own result keys."""
    key = order_key(F.col("p_num"), policy).alias("order_key")
    due = shipments.groupBy(key, "p_num", "customer", "product", "delivery_date").agg(
        F.count(F.lit(1)).alias("n_due"), F.sum("out_count").alias("due_qty"), F.sum("p_count").alias("due_count")
    )
    sent = (
        shipments.groupBy(key, F.col("out_date").alias("shipped_date"))
        .agg(F.count(F.lit(1)).alias("n_sent"), F.sum("out_count").alias("sent_qty"))
        .filter(F.col("order_key").isNotNull())
    )
    states = (
        plan.groupBy(order_key(F.col("p_num"), policy).alias("order_key"), "state", "status_des")
        .agg(F.count(F.lit(1)).alias("n_plan"))
        .filter(F.col("order_key").isNotNull())
    )
    return DeliveryStatus(due, sent, states, as_of)


def delivery_shipping_status(
    shipments: DataFrame, plan: DataFrame, as_of: dt.datetime, policy: str = "null"
) -> DataFrame:
    """Due and shipping status per order, product, ship date, plan state and plan status."""
    return delivery_status(shipments, plan, as_of, policy).pairs()
