"""File sources and sinks.

Inputs arrive in a drop folder as text files (or as folders of part files, as
Spark writes them).  The name of the dropped file decides its role, its
department and its kind; it is taken from the scan's own file metadata, so one
read covers any number of files.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger import schemas
from shopledger.functions.clock import parse_date, parse_datetime
from shopledger.functions.text import to_number
from shopledger.operators.cleaning import (
    blanks_to_null, drop_all_null, forward_fill, with_employee_id,
)
from shopledger.session import store

# Word in the file name -> role; the first hit decides.
ROLES = {
    "timesheet": "time_sheet", "sheeting": "sheeting", "die": "die_price", "other": "other_output",
    "production": "production", "bonus": "bonus_rate",
}


def drop_name(path: Column) -> Column:
    """Name of the dropped file; for a part file, that of the folder it was written as."""
    decoded = F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))
    folder = F.regexp_extract(decoded, r"([^/]+\.[A-Za-z]+)/part-[^/]*$", 1)
    return F.when(folder != "", folder).otherwise(F.regexp_extract(decoded, r"([^/]+)$", 1))


def role_of(name: Column) -> Column:
    """Role of a file by its name; null when no word fits."""
    role = None
    for word, value in ROLES.items():
        hit = F.lower(name).contains(word)
        role = F.when(hit, value) if role is None else role.when(hit, value)
    return role


def department_of(name: Column) -> Column:
    """First word of the file name."""
    return F.get(F.split(F.trim(name), r"\s+"), F.lit(0))


def route_files(spark: SparkSession, folder: str) -> DataFrame:
    """Every file below the folder with its role; only the listing is read, not the content."""
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    listing = listing.select(F.col("_metadata.file_path").alias("path"), "length")
    named = listing.withColumn("file_name", drop_name(F.col("path")))
    return named.withColumn("role", role_of(F.col("file_name"))).filter(F.col("role").isNotNull())


def existing(spark: SparkSession, paths: Iterable[str]) -> list[str]:
    """Those of the paths and patterns that name something."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def there(path: str) -> bool:
        where = hadoop.Path(path)
        return bool(where.getFileSystem(conf).globStatus(where))

    return [p for p in paths if there(p)]


#: A cell with the comma before it: quoted (a quote inside is doubled or escaped) or plain.
QUOTED = r'"(?:[^"\\]|\\.|""|\\)*"'
CELL = f",(?:{QUOTED}(?=,|$)|[^,]*)"
PLACE = ["file_path", "file_block", "row_id"]
LANDED = "path string, file_name string, length bigint, sha256 string, content binary"
REJECTED = "file_path string, reason string, line string"


@dataclass(frozen=True)
class Records:
    """What a tolerant read gives: the rows, and the lines and files that gave none, with the reason."""

    rows: DataFrame
    rejected: DataFrame


def _cells(value: Column) -> tuple[Column, Column]:
    """The cells of a line, and what is wrong with it (null if nothing is). Blank cells are null, quoted blanks empty."""
    found = F.regexp_extract_all(F.concat(F.lit(","), value), F.lit(CELL), F.lit(0))
    is_quoted = lambda c: c.rlike(f"^,{QUOTED}$")
    plain = lambda c: F.when(c != "", c)
    unquoted = F.transform(found, lambda c: F.when(is_quoted(c), F.regexp_replace(F.substring(c, F.lit(3), F.length(c) - 3), r'\\"|""', '"')).otherwise(plain(F.substring(c, F.lit(2), F.length(c)))))
    cells = F.when(value.contains('"'), unquoted).otherwise(F.transform(F.split(value, ",", -1), plain))
    open_ = F.exists(found, lambda c: c.startswith(',"') & ~is_quoted(c)) | (F.length(F.array_join(found, "")) != F.length(value) + 1)
    broken = F.when(~F.is_valid_utf8(value), "not UTF-8").when(value.contains('"') & open_, "broken quotes")
    return cells, broken


def parsed_lines(text: DataFrame, spoiled: Column | None = None) -> DataFrame:
    """Lines (file_path, file_block, row_id, value) in cells, written once: whatever is asked of them later reads that.

    ``spoiled`` says which lines have lost bytes that were no UTF-8.
    """
    cells, broken = _cells(F.col("value"))
    if spoiled is not None:
        broken = F.when(spoiled, "not UTF-8").otherwise(broken)
    parsed = text.filter(F.trim("value") != "").select(*PLACE, cells.alias("cells"), "value", broken.alias("broken"))
    return store(parsed.select(*PLACE, "cells", F.when(F.col("broken").isNotNull(), F.col("value")).alias("raw"), "broken"), "lines")


def scan_lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    """All lines of the files."""
    text = spark.read.option("ignoreCorruptFiles", True).option("ignoreMissingFiles", True).option("recursiveFileLookup", True).text(paths)
    return parsed_lines(text.select(
        "value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("file_block"),
        F.monotonically_increasing_id().alias("row_id"),
    ))


def read_records(
    spark: SparkSession, paths: str | Iterable[str], layout: dict[str, str], columns: Iterable[str] | None = None,
    skip_rows: int = 0, strict: bool = False,
) -> Records:
    """Rows of text files of a layout, and what was rejected; any number of paths is one scan.

    Columns are found by each file's own header, wherever they stand and however many there are; other columns are
    left out. ``skip_rows`` lines at the top of each file come before the header. Rows have file_path, file_block and
    row_id too, which give the order within a file.

    Rejected are paths that name nothing, files without a line or without a wanted column (an error if ``strict``), and
    lines that are no UTF-8, whose quotes don't close or that hold more than the header names. A line with fewer cells
    has nulls. Of a file that breaks off, the lines before are read.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = existing(spark, paths)
    columns = list(columns) if columns is not None else list(layout.values())
    missing = spark.createDataFrame([(p, "missing", None) for p in paths if p not in found], REJECTED)
    if not found:
        fields = [T.StructField(c, T.StringType()) for c in columns]
        fields += [T.StructField(c, T.StringType() if c == "file_path" else T.LongType()) for c in PLACE]
        return Records(spark.createDataFrame([], T.StructType(fields)), missing)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(found).select(F.col("_metadata.file_path").alias("file_path"))
    read = _records(scan_lines(spark, found), listed, layout, columns, skip_rows, strict)
    return Records(read.rows, missing.unionByName(read.rejected))


def _records(
    lines: DataFrame, listed: DataFrame, layout: dict[str, str], columns: list[str], skip_rows: int, strict: bool
) -> Records:
    """Rows and rejects of parsed lines; ``listed`` names all files, with lines or without."""
    # The header is the first line of a file behind the skipped ones: one short row per file, as the driver's own listing
    # has. It is sent to the lines; a join by path would deal all lines of a file to one task.
    top = F.slice(F.sort_array(F.collect_list(F.struct("row_id", "cells"))), skip_rows + 1, 1)
    first = lines.filter("file_block = 0").groupBy("file_path").agg(F.min("row_id").alias("top_row"))
    head = (
        lines.join(F.broadcast(first), "file_path").filter((F.col("file_block") == 0) & (F.col("row_id") <= F.col("top_row") + skip_rows))
        .groupBy("file_path").agg(top.alias("top")).select("file_path", F.inline("top").alias("header_row", "labels"))
        .select("file_path", "header_row", F.transform("labels", lambda c: F.trim(F.ltrim(c, F.lit("\ufeff")))).alias("labels"))
    )
    label_of = {name: label for label, name in layout.items()}
    at = F.array(*[_position(label_of[name]) for name in columns])
    lacking = F.filter(F.array(*[F.when(_position(label_of[name]) == 0, F.lit(label_of[name])) for name in columns]), lambda c: c.isNotNull())
    if strict:
        error = F.raise_error(F.concat(F.lit("no column '"), lacking[0], F.lit("' in "), F.col("file_path"))).cast("array<int>")
        at = F.when(F.size(lacking) > 0, error).otherwise(at)
    head = head.select("*", at.alias("at"), F.concat(F.lit("no column "), F.array_join(lacking, ", ")).alias("lacks"), (F.size(lacking) == 0).alias("whole"))
    body = lines.join(F.broadcast(head), "file_path").filter((F.col("file_block") > 0) | (F.col("row_id") > F.col("header_row")))
    beyond = F.exists(F.slice("cells", F.size("labels") + 1, F.greatest(F.size("cells"), F.lit(1))), lambda c: c.isNotNull())
    reason = F.coalesce("broken", F.when(beyond, "more cells than the header"))
    judged = body.withColumn("reason", reason)
    cells = [F.get("cells", F.get("at", F.lit(k)) - 1).alias(name) for k, name in enumerate(columns)]
    rows = judged.filter(F.col("reason").isNull() & (F.lit(True) if strict else F.col("whole"))).select(*cells, *PLACE)
    of_lines = judged.filter(F.col("reason").isNotNull() & F.col("whole")).select(
        "file_path", "reason", F.coalesce("raw", F.array_join("cells", ",", "")).alias("line")
    )
    of_files = head.filter(~F.col("whole")).select("file_path", F.col("lacks").alias("reason"), F.lit(None).cast("string").alias("line"))
    blank = listed.join(head.select("file_path"), "file_path", "left_anti").select("file_path", F.lit("no line").alias("reason"), F.lit(None).cast("string").alias("line"))
    return Records(rows, of_lines.unionByName(of_files).unionByName(blank))


def safe_read(
    spark: SparkSession, paths: str | Iterable[str], layout: dict[str, str], columns: Iterable[str] | None = None,
    skip_rows: int = 0,
) -> DataFrame:
    """The rows of ``read_records``; a file without a wanted column is an error."""
    return read_records(spark, paths, layout, columns, skip_rows, strict=True).rows


def _position(label: str) -> Column:
    """Place of a label, or of its other name, in a file's header, from 1; 0 if it has none."""
    names = [label, *[other for other, known in schemas.OTHER_LABELS.items() if known == label]]
    return F.coalesce(F.greatest(*[F.array_position("labels", n) for n in names], F.lit(0)), F.lit(0)).cast("int")


def load_union(
    spark: SparkSession, paths: Iterable[str], layout: dict[str, str], fn: Callable[[DataFrame], DataFrame],
    skip_rows: int = 0,
) -> DataFrame:
    """All files of a layout, cleaned by ``fn``, as one table."""
    return safe_read(spark, paths, layout, skip_rows=skip_rows).drop(*PLACE).transform(fn)


def load_timesheets(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Time sheets of all departments; names are filled down from the first row of a block.

    Files of temporary staff carry the team where the others carry the employee
    number, so both kinds are one scan.
    """
    raw = safe_read(spark, paths, schemas.TIMESHEET).withColumn("file_name", drop_name(F.col("file_path")))
    # Files of one name in two folders are two files; the part files of one are one.
    raw = raw.withColumn("dropped", F.regexp_replace("file_path", "/part-[^/]*$", ""))
    filled = forward_fill(
        raw, ["dropped"], PLACE, [F.col("file_path"), F.col("file_block")],
        ["employee_number", "first_name", "last_name"],
    )
    kept = drop_all_null(filled, ["start_date", "start_time", "end_date", "end_time"])
    is_temp = F.col("file_name").contains("Temp")
    return kept.withColumns(
        {
            "department": department_of(F.col("file_name")),
            "is_temp": is_temp,
            "start_ts": parse_datetime("start_date", "start_time"),
            "end_ts": parse_datetime("end_date", "end_time"),
        }
    ).drop(*PLACE, "file_name", "dropped", "start_date", "start_time", "end_date", "end_time")


def schedule_filter(schedule: DataFrame) -> DataFrame:
    """Timed shifts of available people; a null start or status does not exclude a row."""
    timed = ~F.col("sched_start").eqNullSafe("All Day")
    available = ~F.col("availability_status").eqNullSafe("Unavailable")
    return schedule.filter(timed & available & F.col("sched_end").isNotNull())


def load_schedules(spark: SparkSession, paths: str | Iterable[str]) -> DataFrame:
    """Schedule rows with their department and the kind of file they came from."""
    raw = safe_read(spark, paths, schemas.SCHEDULE).withColumn("file_name", drop_name(F.col("file_path")))
    return schedule_filter(raw).select(
        parse_date("sched_date", day_first=False).alias("sched_date"),
        parse_datetime("sched_date", "sched_start", day_first=False).alias("sched_start"),
        "users", "availability_status",
        department_of(F.col("file_name")).alias("department"),
        F.when(F.col("file_name").contains("Schedule-Export"), "Schedule-Export").otherwise("Shift").alias("source"),
    )


def load_production_bonus(spark: SparkSession, folder: str) -> DataFrame:
    """Bonus per date and employee from the folder's production reports."""
    raw = safe_read(spark, f"{folder}/*Production Report*", schemas.PRODUCTION_BONUS)
    silver = F.coalesce(to_number(F.col("silver_bonus")), F.lit(0.0))
    gold = F.coalesce(to_number(F.col("gold_bonus")), F.lit(0.0))
    rows = raw.select(parse_date("bonus_date").alias("bonus_date"), "employee_id", (silver + gold).alias("bonus"))
    rows = rows.dropna(subset=["bonus_date", "employee_id"])
    return rows.groupBy("bonus_date", "employee_id").agg(F.sum("bonus").alias("bonus"))


def load_payrates(spark: SparkSession, path: str) -> DataFrame:
    """Pay rates by header name: blanks to null, id column found by name, numbers typed."""
    raw = with_employee_id(blanks_to_null(spark.read.option("header", True).csv(path)))
    named = raw.select(*[F.col(f"`{c}`").alias(schemas.PAYRATE.get(c, c)) for c in raw.columns])
    numbers = ["reg_rate", "ot_rate", "ot_trigger_holiday", "ot_trigger_regular"]
    return named.withColumns({c: to_number(F.col(c)) for c in numbers if c in named.columns})


def read_sales(spark: SparkSession, path: str) -> DataFrame:
    """The sales summary, by header name and typed."""
    raw = safe_read(spark, path, schemas.SALES).drop(*PLACE)
    types = {"out_date": "timestamp_ntz", "product_id": "bigint"} | dict.fromkeys(
        ("out_count_total", "total_sales", "total_sales_local_price"), "double"
    )
    return raw.select(*[F.col(c).try_cast(types[c]).alias(c) if c in types else F.col(c) for c in raw.columns])


def land(spark: SparkSession, paths: str | Iterable[str], landing: str) -> DataFrame:
    """Save dropped files below the landing folder, each content once; returns what was new.

    A drop is a dataset of the files' bytes with path, name, length and SHA-256. A file whose content has landed before,
    under whatever name, is left out, as is a second one in the same drop. A drop that broke off has not landed: the next
    one takes its place. Files are reports of up to 2 GB.
    """
    drops = _drops(spark, landing)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load([paths] if isinstance(paths, str) else list(paths))
    files = files.select(F.col("_metadata.file_path").alias("path"), "length", "content")
    hashed = files.select("path", F.sha2("content", 256).alias("sha256"))
    new = hashed.groupBy("sha256").agg(F.min("path").alias("path")).join(landed(spark, landing).select("sha256"), "sha256", "left_anti")
    into = f"{landing}/drop={max(drops, default=0) + 1}"
    named = files.join(new, "path").select("path", drop_name(F.col("path")).alias("file_name"), "length", "sha256", "content")
    named.write.mode("overwrite").parquet(into)
    return spark.read.schema(LANDED).parquet(into).drop("content")


def _drops(spark: SparkSession, landing: str) -> list[int]:
    """Numbers of the drops that have landed whole."""
    paths = existing(spark, [f"{landing}/drop=*/_SUCCESS"])
    if not paths:
        return []
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(paths[0])
    done = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(where)
    return sorted(int(f.getPath().getParent().getName().split("=")[1]) for f in done)


def _landed(spark: SparkSession, landing: str) -> DataFrame:
    parts = [f"{landing}/drop={n}" for n in _drops(spark, landing)]
    if not parts:
        return spark.createDataFrame([], f"{LANDED}, drop int")
    return spark.read.schema(f"{LANDED}, drop int").option("basePath", landing).parquet(*parts)


def landed(spark: SparkSession, landing: str) -> DataFrame:
    """The manifest: path, file_name, length, sha256 and drop of every file that has landed."""
    return _landed(spark, landing).drop("content")


def read_landed(
    spark: SparkSession, landing: str, layout: dict[str, str], columns: Iterable[str] | None = None, skip_rows: int = 0
) -> Records:
    """``read_records`` over the files that have landed."""
    files = _landed(spark, landing)
    text = F.col("content").cast("string")
    # Judged and split once a file, before its lines part: the content must not go along with each of them.
    split = files.select(F.col("path").alias("file_path"), F.is_valid_utf8(text).alias("valid"), F.split(text, "\r?\n|\r").alias("split"))
    lines = split.select(
        "file_path", F.lit(0).cast("bigint").alias("file_block"), "valid", F.posexplode("split").alias("row_id", "value"),
    ).withColumn("row_id", F.col("row_id").cast("bigint"))
    columns = list(columns) if columns is not None else list(layout.values())
    # splitting replaces bytes that are no UTF-8 by a sign of their own
    spoiled = ~F.col("valid") & F.col("value").contains("\ufffd")
    return _records(parsed_lines(lines, spoiled), files.select(F.col("path").alias("file_path")), layout, columns, skip_rows, False)


def write_csv(df: DataFrame, path: str, layout: dict[str, str] | None = None, mode: str = "errorifexists") -> str:
    """Write a table as text under the layout's header labels."""
    if layout:
        labels = {name: label for label, name in layout.items()}
        df = df.withColumnsRenamed({c: labels[c] for c in df.columns if c in labels})
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_reports(
    tables: dict[str, DataFrame], folder: str, sort_by: dict[str, list[str]] | None = None
) -> dict[str, DataFrame]:
    """Write each table as a dataset ``report=<name>`` below the folder, in place of one a run before has left there.

    Returns the tables as they are read from there.

    A table with sort columns is written in ranges of them, each file sorted: a reader of one value finds its rows by
    the files' minima and maxima. The number of files depends on the size of the table, not on its values, and the rows
    of a frequent value may lie in several files.
    """
    written = {}
    for name, df in tables.items():
        keys = (sort_by or {}).get(name, [])
        if keys:
            row = F.xxhash64(*df.columns)
            df = df.repartitionByRange(*[F.col(k) for k in keys], row).sortWithinPartitions(*keys)
        path = f"{folder}/report={name}"
        df.write.mode("overwrite").parquet(path)
        written[name] = df.sparkSession.read.schema(df.schema).parquet(path)
    return written
