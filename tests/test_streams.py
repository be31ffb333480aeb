import datetime as dt

from pyspark.sql import functions as F

from shopledger.operators.inventory import inventory_balance
from shopledger.session import new_folder
from shopledger.streaming import jobs

SCHEMA = "event_id bigint, ts timestamp, kind string, value double"
T0 = dt.datetime(2024, 1, 1, 0, 0)


def drop(spark, folder, name, rows):
    data = [(i, T0 + dt.timedelta(minutes=m), k, float(v)) for i, m, k, v in rows]
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")


def test_intake_across_runs(spark, tmp_path):
    folder, out, state = str(tmp_path / "in"), new_folder(spark, "t"), new_folder(spark, "t")

    def run():
        stream = jobs.read_files(spark, f"{folder}/*", SCHEMA)
        jobs.intake(stream, "event_id", "ts", "1 hour", out, state)
        return sorted(r.event_id for r in spark.read.parquet(out).collect())

    drop(spark, folder, "one", [(1, 0, "a", 1), (1, 5, "a", 1), (2, 30, "a", 1)])
    assert run() == [1, 2]
    drop(spark, folder, "two", [(2, 31, "a", 1), (3, 300, "a", 1)])
    assert run() == [1, 2, 3]
    drop(spark, folder, "three", [(4, 10, "a", 1), (5, 290, "a", 1)])  # the first is hours late
    assert run() == [1, 2, 3, 5]


def test_monitor_equals_the_batch_result(spark, tmp_path):
    folder, out, state = str(tmp_path / "in"), new_folder(spark, "t"), new_folder(spark, "t")
    rows = [(i, i * 3, "ab"[i % 2], i % 7) for i in range(60)]
    drop(spark, folder, "one", rows[:40])
    drop(spark, folder, "two", rows[40:])
    stream = jobs.read_files(spark, f"{folder}/*", SCHEMA, files_per_batch=1)
    windows = jobs.window_stats(stream, "ts", "10 minutes", "10 hours", "kind", "value")
    jobs.write_updates(windows, out, state, ["window_start", "window_end", "kind"])
    got = jobs.latest(spark, out, windows.schema)
    batch = spark.read.schema(SCHEMA).parquet(f"{folder}/*").groupBy(F.window("ts", "10 minutes"), "kind").agg(
        F.count(F.lit(1)).alias("n"), F.avg("value").alias("mean_value")
    ).select("window.start", "window.end", "kind", "n", "mean_value")
    assert sorted(map(tuple, got.select("window_start", "window_end", "kind", "n", "mean_value").collect())) == sorted(map(tuple, batch.collect()))
    assert jobs.alerts(got, 4.0).count() == batch.filter("mean_value > 4").count()


DAYS = "product_id bigint, day date, moved bigint, n_moves bigint"
MOVES = "product_id bigint, out_date timestamp, out_count int"


def test_a_stream_of_late_movements_ends_at_the_batch_balance(spark, tmp_path):
    folder, out, state = str(tmp_path / "in"), new_folder(spark, "t"), new_folder(spark, "t")
    opening = spark.createDataFrame([(1, 100), (2, 50), (3, 7)], "product_id bigint, opening_qty bigint")
    drops = [[(1, 5, 10), (2, 1, 5)], [(1, 1, 3), (1, 5, 1), (None, 1, 9)], [(2, 3, None), (9, 1, 1), (1, 400, 6)]]

    def run():
        stream = jobs.read_files(spark, f"{folder}/*", MOVES, files_per_batch=1)
        days = jobs.daily_movements(stream, "product_id", "out_date", "out_count")
        jobs.write_updates(days, out, state, ["product_id", "day"], buckets=3)
        return jobs.latest(spark, out, DAYS)

    seen = []
    for k, rows in enumerate(drops):
        data = [(p, T0 + dt.timedelta(days=d), n) for p, d, n in rows]
        spark.createDataFrame(data, MOVES).coalesce(1).write.parquet(f"{folder}/{k}")
        seen += data
        days = run()
        got = sorted((r.product_id, r.day, r.n_moves, r.balance) for r in jobs.closing_balance(days, opening, "product_id").collect())
        start = {1: 100, 2: 50, 3: 7}
        want = []
        for p, day in sorted({(p, t.date()) for p, t, _ in seen if p in start}):
            want.append((p, day, sum(q == p and t.date() == day for q, t, _ in seen),
                         start[p] - sum(n or 0 for q, t, n in seen if q == p and t.date() <= day)))
        assert got == want
        now = {r.product_id: r.balance for r in jobs.current_balance(days, opening, "product_id").collect()}
        assert now == {p: start[p] - sum(n or 0 for q, _, n in seen if q == p) for p in start}


def test_a_state_table_keeps_its_size_over_fifty_batches(spark, tmp_path):
    out = str(tmp_path / "state")
    want = {}
    for batch_id in range(50):
        rows = [(None if k == 0 else k, batch_id * 100 + k) for k in (batch_id % 7, batch_id % 11, 20 + batch_id % 3)]
        want |= dict(rows)
        batch = spark.createDataFrame(list(dict(rows).items()), "k int, v int").coalesce(1)
        jobs.merge_batch(batch, batch_id, out, ["k"], buckets=4)
        if batch_id == 30:  # a batch is repeated after a failure
            jobs.merge_batch(batch, batch_id, out, ["k"], buckets=4)
    now = jobs.latest(spark, out, "k int, v int")
    assert dict(map(tuple, now.collect())) == want and now.count() == len(want)
    files = len(now.inputFiles())
    assert files <= 8 and len(jobs._listed(spark, f"{out}/manifest")) == 2
    # what lies there is the current buckets and those of the commit before
    assert len(jobs._listed(spark, out)) <= 2 * 4


def test_a_broken_off_batch_is_not_seen(spark, tmp_path):
    out = str(tmp_path / "state")
    one = spark.createDataFrame([(1, 1), (2, 1)], "k int, v int")
    jobs.merge_batch(one, 0, out, ["k"], buckets=2)
    spark.createDataFrame([(1, 9)], "k int, v int").withColumn(jobs.BUCKET, F.lit(0)).write.partitionBy(jobs.BUCKET).parquet(f"{out}/batch_id=1")
    assert dict(map(tuple, jobs.latest(spark, out, "k int, v int").collect())) == {1: 1, 2: 1}
    jobs.merge_batch(spark.createDataFrame([(2, 5)], "k int, v int"), 1, out, ["k"], buckets=2)
    assert dict(map(tuple, jobs.latest(spark, out, "k int, v int").collect())) == {1: 1, 2: 5}


def test_inventory_balance(spark):
    opening = spark.createDataFrame([(1, 100), (2, 5)], "product_id bigint, opening_qty bigint")
    moves = [(1, T0, 2, 30), (1, T0, 1, 10), (1, T0 + dt.timedelta(days=2), 3, 5), (2, T0, 4, None), (3, T0, 5, 1)]
    ship = spark.createDataFrame(moves, "product_id bigint, out_date timestamp_ntz, dgn_bil_num bigint, out_count int")
    got = sorted((r.product_id, r.dgn_bil_num, r.balance) for r in inventory_balance(opening, ship).collect())
    assert got == [(1, 1, 90), (1, 2, 60), (1, 3, 55), (2, 4, 5)]
