"""Stream jobs over dropped files.

Each job runs to the end of what has arrived (``availableNow``), keeps its
progress in a checkpoint folder and writes files, so it can be run again and
again as files keep arriving, and a lost executor or driver costs nothing but
the open batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.operators.ordered import neighbours
from shopledger.session import store

BATCH, BUCKET, MANIFEST = "batch_id", "key_bucket", "manifest"
#: Buckets of a state table: a batch rewrites those it has keys of.
BUCKETS = 16


def read_files(
    spark: SparkSession, folder: str, schema: T.StructType | str, pattern: str = "*.parquet",
    files_per_batch: int | None = None,
) -> DataFrame:
    """Stream of the parquet files below a folder whose names fit the pattern."""
    reader = spark.readStream.format("parquet").schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(folder)


def intake(stream: DataFrame, key: str, ts: str, delay: str, out: str, checkpoint: str) -> None:
    """Append each row once: repeats of a key within the delay are dropped, later rows too."""
    unique = stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark([key])
    query = (
        unique.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint)
        .outputMode("append").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def window_stats(stream: DataFrame, ts: str, length: str, delay: str, key: str, value: str) -> DataFrame:
    """Count and mean of a value per tumbling window and key."""
    windows = stream.withWatermark(ts, delay).groupBy(F.window(ts, length), key)
    return windows.agg(F.count(F.lit(1)).alias("n"), F.avg(value).alias("mean_value")).select(
        F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), key, "n", "mean_value"
    )


def write_updates(result: DataFrame, out: str, checkpoint: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Keep the last state of every key of a streaming result below ``out``, see ``merge_batch``."""
    query = (
        result.writeStream.foreachBatch(lambda batch, batch_id: merge_batch(batch, batch_id, out, keys, buckets))
        .option("checkpointLocation", checkpoint).outputMode("update").trigger(availableNow=True).start()
    )
    query.awaitTermination()


def merge_batch(batch: DataFrame, batch_id: int, out: str, keys: list[str], buckets: int = BUCKETS) -> None:
    """Merge changed rows into a table with one row per key.

    The table lies in buckets of the key. A batch rewrites the buckets it has rows for, into a folder of its own, and
    then commits: a manifest names the folder of every bucket. Readers go by the last manifest, so they see a batch
    whole or not at all, and a batch that is repeated after a failure replaces its own folder. Folders that neither the
    last nor the manifest before names are removed: what is kept is the table and its last change, not every batch.
    """
    spark = batch.sparkSession
    before = _manifest(spark, out, batch_id)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    folder = f"{out}/{BATCH}={batch_id}"
    # the batch's own rows, written once: it says which buckets it touches and is merged from there
    changed = store(batch.withColumn(BUCKET, bucket), "changed")
    touched = [r[0] for r in changed.select(BUCKET).distinct().collect()]
    old = [f"{before[b]}/{BUCKET}={b}" for b in touched if b in before]
    merged = changed
    if old:
        rest = spark.read.schema(batch.schema).parquet(*old).withColumn(BUCKET, bucket)
        same = F.lit(True)
        for k in keys:  # a null is a key like others
            same = same & rest[k].eqNullSafe(changed[k])
        merged = rest.join(changed, same, "left_anti").unionByName(changed)
    # a bucket is a few files, however many tasks the batch has
    merged.repartition(F.col(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(folder)
    now = before | {b: folder for b in touched}
    rows = spark.createDataFrame(sorted(now.items()), f"{BUCKET} int, folder string")
    rows.coalesce(1).write.mode("overwrite").json(f"{out}/{MANIFEST}/{BATCH}={batch_id}")
    _remove_unnamed(spark, out, batch_id, set(now.values()) | set(before.values()))


def _listed(spark: SparkSession, folder: str) -> list[str]:
    """Paths of the committed folders below a folder, one per batch."""
    there = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    fs = there.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(there):
        return []
    return [f.getPath().toString() for f in fs.listStatus(there) if f.isDirectory() and f"{BATCH}=" in f.getPath().getName()]


def _number(path: str) -> int:
    return int(path.rsplit("=", 1)[1])


def _manifest(spark: SparkSession, out: str, below: int | None = None) -> dict[int, str]:
    """Folder of every bucket, by the last commit (before a batch)."""
    commits = [p for p in _listed(spark, f"{out}/{MANIFEST}") if below is None or _number(p) < below]
    for path in sorted(commits, key=_number, reverse=True):
        done = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
        if done.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(done):
            return {r[0]: r[1] for r in spark.read.schema(f"{BUCKET} int, folder string").json(path).collect()}
    return {}


def _remove_unnamed(spark: SparkSession, out: str, batch_id: int, named: set[str]) -> None:
    path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    numbers = {_number(p) for p in named}
    stale = [p for p in _listed(spark, out) if _number(p) < batch_id and _number(p) not in numbers]
    commits = sorted((p for p in _listed(spark, f"{out}/{MANIFEST}") if _number(p) < batch_id), key=_number)
    for path in [*stale, *commits[:-1]]:
        path_of(path).getFileSystem(conf).delete(path_of(path), True)


def latest(spark: SparkSession, out: str, schema: T.StructType | str) -> DataFrame:
    """The current table of ``write_updates``: one row per key, read from the folders the last commit names."""
    folders = [f"{folder}/{BUCKET}={b}" for b, folder in sorted(_manifest(spark, out).items())]
    return spark.read.schema(schema).parquet(*folders) if folders else spark.createDataFrame([], schema)


def alerts(stats: DataFrame, above: float) -> DataFrame:
    """Windows whose mean value is above a threshold."""
    return stats.filter(F.col("mean_value") > above)


def daily_movements(stream: DataFrame, key: str, ts: str, quantity: str) -> DataFrame:
    """Sum and count of a stream of quantities per key and day, for ``write_updates``.

    A movement may come as late as it likes: it changes the sum of its own day. The state is one row per key and day,
    summed before it is shuffled, so a key with very many movements is no heavier than its days.
    """
    moves = stream.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return moves.groupBy(key, F.to_date(ts).alias("day")).agg(
        F.sum(F.coalesce(F.col(quantity).cast("bigint"), F.lit(0))).alias("moved"), F.count(F.lit(1)).alias("n_moves")
    )


def closing_balance(days: DataFrame, opening: DataFrame, key: str) -> DataFrame:
    """Balance per key at the end of each day with movements: the opening quantity less what has moved out until then."""
    moved = neighbours(days, [key], ["day"], [F.trunc("day", "year")], running={"until": F.col("moved")})
    return moved.join(opening, key).select(key, "day", "n_moves", (F.col("opening_qty") - F.col("until")).alias("balance"))


def current_balance(days: DataFrame, opening: DataFrame, key: str) -> DataFrame:
    """Balance per key after all movements seen, for keys without any, too."""
    moved = days.groupBy(key).agg(F.sum("moved").alias("moved"), F.max("day").alias("last_day"))
    return opening.join(moved, key, "left").select(
        key, "last_day", (F.col("opening_qty") - F.coalesce("moved", F.lit(0))).alias("balance")
    )
