"""Session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

ARCHIVE = "shopledger-package.zip"
#: Folders named within the open ``scratch`` blocks, the innermost last.
_SCRATCH: list[list[str]] = []

# Runtime SQL settings; none of them depends on the size of the cluster.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Shuffles start fine and are put together at run time: a task's share then does not grow with the input and spills no more.
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "200",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Splitting a hot join key is worth another exchange behind the join.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A join whose shuffled partitions turn out small is hashed instead of sorted; larger ones still sort.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # Generated methods above 8000 bytes are never compiled by the JVM; such stages run faster without them.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the settings every operator is written for."""
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship(spark)
    return spark


def ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per application.

    Functions that run in tasks refer to modules of the package, which a worker
    can import only if it has them, wherever the driver was started.
    """
    context = spark.sparkContext
    if any(f.endswith(f"{ARCHIVE}") for f in context._python_includes):
        return
    package = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="shopledger-ship-"), ARCHIVE)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as archive:
        for folder, _, names in os.walk(package):
            for name in names:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    archive.write(full, os.path.relpath(full, os.path.dirname(package)))
    context.addPyFile(path)


def local_session(cpus: int | str = 8, app: str = "shopledger", **conf: str) -> SparkSession:
    """A single-JVM session for tests and the benchmark."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.extraJavaOptions", "-XX:+UseParallelGC")
        .config("spark.sql.shuffle.partitions", str(cpus))
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir`` of the session.

    Only a session without that setting (a bare local test run) gets a
    temporary folder of its own, and that choice is written back to the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        root = tempfile.mkdtemp(prefix="shopledger-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def new_folder(spark: SparkSession, label: str) -> str:
    """A fresh folder name below the shared root (created by the first write)."""
    path = f"{shared_root(spark)}/shopledger/{label}-{uuid.uuid4().hex}"
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Folders named by ``new_folder`` (and so by ``store``) within are removed at the end, also after an error.

    What is to outlive them has to be written elsewhere and read from there.
    """
    _SCRATCH.append([])
    try:
        yield
    finally:
        path_of = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        for path in _SCRATCH.pop():
            path_of(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path_of(path), True)


def store(df, label: str):
    """Write ``df`` to the shared folder and read it back: cuts the lineage.

    The written files survive the loss of any executor, and later branches
    read them instead of running the whole plan again.
    """
    spark = df.sparkSession
    path = new_folder(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
