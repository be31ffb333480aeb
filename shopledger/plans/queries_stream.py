"""Registered queries of the stream jobs and the inventory."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopledger.operators import inventory as inv
from shopledger.plans.adapters import Inputs, ctes
from shopledger.plans.queries_clock import rounded
from shopledger.session import new_folder
from shopledger.streaming import jobs

EVENTS = "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"


def events(i: Inputs) -> DataFrame:
    stream = jobs.read_files(i.spark, i.sf_dir, EVENTS, "events.parquet")
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def stream_intake(i: Inputs) -> DataFrame:
    out, progress = new_folder(i.spark, "intake"), new_folder(i.spark, "progress")
    jobs.intake(events(i), "event_id", "ts", "1 hour", out, progress)
    return i.spark.read.parquet(out).withColumn("ts", F.col("ts").cast("timestamp_ntz"))


def stream_monitor(i: Inputs) -> DataFrame:
    out, progress = new_folder(i.spark, "monitor"), new_folder(i.spark, "progress")
    windows = jobs.window_stats(events(i), "ts", "10 minutes", "1 hour", "event_type", "value")
    jobs.write_updates(windows, out, progress, ["window_start", "window_end", "event_type"])
    stats = jobs.latest(i.spark, out, windows.schema)
    naive = {c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")}
    return rounded(stats.withColumns(naive), "mean_value")


def opening(i: Inputs) -> DataFrame:
    return i.table("part").select(
        F.col("p_partkey").alias("product_id"), (F.col("p_size").cast("bigint") * 1000).alias("opening_qty")
    )


def movements(i: Inputs) -> DataFrame:
    """Daily movements of the products, kept by a stream over the shipments as they are dropped.

    The shipments of one date come in several files of several batches, later dates before earlier ones.
    """
    folder, out, progress = (new_folder(i.spark, name) for name in ("shipped", "moved", "progress"))
    part = F.pmod(F.xxhash64("dgn_bil_num"), F.lit(4))
    late = i.shipments.select("product_id", "out_date", "out_count", part.alias("part"))
    late.repartition("part").write.partitionBy("part").parquet(folder)
    stream = jobs.read_files(i.spark, f"{folder}/*", late.drop("part").schema, files_per_batch=2)
    days = jobs.daily_movements(stream, "product_id", "out_date", "out_count")
    jobs.write_updates(days, out, progress, ["product_id", "day"])
    return jobs.latest(i.spark, out, days.schema)


QUERIES = {
    "stream_balance": lambda i: jobs.closing_balance(movements(i), opening(i), "product_id"),
    "stream_current_balance": lambda i: jobs.current_balance(movements(i), opening(i), "product_id"),
    "stream_intake": stream_intake,
    "stream_monitor": stream_monitor,
    "stream_alerts": lambda i: jobs.alerts(stream_monitor(i), 100.0),
    "inventory_balance": lambda i: inv.inventory_balance(opening(i), i.shipments),
    "inventory_reconcile": lambda i: inv.inventory_reconcile(i.demand, i.shipments),
}

_MONITOR = """stats AS (SELECT time_bucket(INTERVAL 10 MINUTE, ts) AS window_start,
  time_bucket(INTERVAL 10 MINUTE, ts) + INTERVAL 10 MINUTE AS window_end, event_type, count(*) AS n,
  round(avg(value), 4) AS mean_value FROM events GROUP BY 1,2,3)"""

ORACLES = {
    "stream_balance": f"""WITH {ctes('shipments')}, days AS (SELECT product_id, CAST(out_date AS DATE) AS day, sum(out_count) AS moved,
  count(*) AS n_moves FROM shipments WHERE product_id IS NOT NULL AND out_date IS NOT NULL GROUP BY 1, 2)
SELECT product_id, day, n_moves, CAST(p_size*1000-sum(moved) OVER (PARTITION BY product_id ORDER BY day) AS BIGINT) AS balance
FROM days JOIN part ON p_partkey=product_id""",
    "stream_current_balance": f"""WITH {ctes('shipments')}, moved AS (SELECT product_id, max(CAST(out_date AS DATE)) AS last_day,
  sum(out_count) AS moved FROM shipments WHERE out_date IS NOT NULL GROUP BY 1)
SELECT p_partkey AS product_id, last_day, CAST(p_size*1000-coalesce(moved, 0) AS BIGINT) AS balance
FROM part LEFT JOIN moved ON p_partkey=product_id""",
    "stream_intake": "SELECT DISTINCT event_id, ts, user_id, event_type, value, props FROM events",
    "stream_monitor": f"WITH {_MONITOR} SELECT * FROM stats",
    "stream_alerts": f"WITH {_MONITOR} SELECT * FROM stats WHERE mean_value>100",
    "inventory_balance": f"""WITH {ctes('shipments')} SELECT s.product_id, s.out_date, s.dgn_bil_num, s.out_count,
  CAST(p_size*1000-sum(s.out_count) OVER (PARTITION BY s.product_id ORDER BY s.out_date, s.dgn_bil_num
    ROWS UNBOUNDED PRECEDING) AS BIGINT) AS balance FROM shipments s JOIN part ON p_partkey=s.product_id""",
    "inventory_reconcile": f"""WITH {ctes('demand', 'shipments')},
o AS (SELECT product_id, CAST(sum(order_count) AS BIGINT) AS ordered_qty FROM demand GROUP BY 1),
s AS (SELECT product_id, CAST(sum(out_count) AS BIGINT) AS shipped_qty FROM shipments GROUP BY 1)
SELECT product_id, ordered_qty, shipped_qty, coalesce(ordered_qty, 0)-coalesce(shipped_qty, 0) AS difference
FROM o FULL JOIN s USING (product_id) WHERE coalesce(ordered_qty, 0)<>coalesce(shipped_qty, 0)""",
}
