"""Inventory after shipping, and its reconciliation with the orders."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.operators.ordered import neighbours

BILL_RANGE = 1_000_000

def inventory_balance(opening: DataFrame, shipments: DataFrame) -> DataFrame:
    """Stock of a product after each of its shipments, in order of date and bill.

    The running sum is cut at hours and, for shipments on the hour (dates have
    no time), at ranges of bill numbers, so a product with very many shipments,
    even of one date, is summed by many tasks.
    """
    hour = F.date_trunc("hour", "out_date").cast("timestamp_ntz")
    later = F.col("out_date").cast("timestamp_ntz") > hour
    moves = shipments.filter(F.col("product_id").isNotNull() & F.col("out_date").isNotNull()).select(
        "product_id", "out_date", "dgn_bil_num", "out_count"
    )
    shipped = neighbours(
        moves, ["product_id"], ["out_date", "dgn_bil_num"],
        [hour, later, F.when(later, 0).otherwise(F.floor(F.col("dgn_bil_num") / BILL_RANGE))],
        running={"shipped": F.coalesce("out_count", F.lit(0))},
    )
    stock = opening.select("product_id", "opening_qty")
    return shipped.join(stock, "product_id").withColumn(
        "balance", F.col("opening_qty") - F.col("shipped")
    ).drop("shipped", "opening_qty")


def inventory_reconcile(demand: DataFrame, shipments: DataFrame) -> DataFrame:
    """Ordered against shipped quantity per product, where they differ or one is missing."""
    ordered = demand.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("order_count").alias("ordered_qty")
    )
    shipped = shipments.filter(F.col("product_id").isNotNull()).groupBy("product_id").agg(
        F.sum("out_count").alias("shipped_qty")
    )
    both = ordered.join(shipped, "product_id", "full")
    gap = F.coalesce("ordered_qty", F.lit(0)) - F.coalesce("shipped_qty", F.lit(0))
    return both.withColumn("difference", gap).filter(F.col("difference") != 0)
