"""Helpers the training-data operators share."""

from __future__ import annotations

import gc
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

from shopledger.session import ship, store

#: Rows and bytes of one Arrow batch: documents differ by orders of magnitude, so both are bounded.
BATCH = {
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": str(8 << 20),
}
#: Remainder of the held-out rows.
HELD_OUT = 2


def prepare(spark: SparkSession) -> None:
    """Bound the Arrow batches and send the package to the workers."""
    for key, value in BATCH.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    ship(spark)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: Column) -> Column:
    """True if crc32 of the id's text leaves remainder 2 by 4; null ids are not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 4 == HELD_OUT, F.lit(False))


def unsigned_hex(column: Column) -> Column:
    """A long's 64 bits as 16 lower-case hexadecimal digits."""
    return F.lower(F.lpad(F.hex(column), 16, "0"))


def by_batch(
    df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str | StructType, most_bytes: int = 4 << 20
) -> DataFrame:
    """Apply ``fn`` to slices of the rows of at most about ``most_bytes`` each (one row at least)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, most_bytes):
                out = fn(part)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def with_columns(df: DataFrame, text_col: str, fn: Callable[[list[str | None]], list[pa.Array]], added: dict[str, str]) -> DataFrame:
    """All rows and columns of ``df`` and, from the texts of each batch, the columns of ``added`` (name -> type)."""
    names = df.columns
    where = names.index(text_col)
    schema = StructType([*df.schema.fields, *(StructField(n, _parse_datatype_string(t)) for n, t in added.items())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([*batch.columns, *fn(batch.column(where).to_pylist())], [*names, *added])

    return by_batch(df, run, schema, 2 << 20)


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, changed where ``df`` has such a column."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def placed(df: DataFrame, file: str, row: str) -> DataFrame:
    """``df`` with its rows' places: a hash of the file and the number in it. Rows that don't come from files are written first."""
    place = [F.xxhash64("_metadata.file_path").alias(file), F.col("_metadata.row_index").alias(row)]
    try:
        return df.select("*", *place)
    except AnalysisException:
        return store(df, "placed").select("*", *place)


def stored(df: DataFrame, label: str) -> DataFrame:
    """``store``, after which the shuffle files of the written plan may go: Spark drops them when the driver's garbage,
    Python's handles first, is collected."""
    out = store(df, label)
    for _ in range(2):  # the first finds the plans, the second what only they held
        gc.collect()
        df.sparkSession.sparkContext._jvm.System.gc()
        time.sleep(0.2)
    return out


def slices(batch: pa.RecordBatch, most_bytes: int) -> Iterator[pa.RecordBatch]:
    n = batch.num_rows
    step = max(1, n * most_bytes // max(1, batch.nbytes))
    for start in range(0, n, step):
        yield batch.slice(start, step)

