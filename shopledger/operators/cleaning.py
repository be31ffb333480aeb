"""Generic table cleaning and profiling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopledger.functions.text import blank_to_null
from shopledger.operators.ordered import neighbours


def clean_name(name: str) -> str:
    """Capitalised words without ``_`` and ``-``, single blanks between them."""
    words = (word[:1].upper() + word[1:].lower() for word in name.split())
    return " ".join(words).translate({ord("_"): None, ord("-"): None})


def clean_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[clean_name(c) for c in df.columns])


def blanks_to_null(df: DataFrame) -> DataFrame:
    """Blank text becomes null in every text column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: blank_to_null(F.col(f"`{c}`")) for c in text})


def with_employee_id(df: DataFrame, name: str = "Employee ID") -> DataFrame:
    """Without an ``Employee ID`` column, the first one named like an id or number takes its place."""
    if name in df.columns:
        return df
    for c in df.columns:
        if "id" in c.lower() or "number" in c.lower():
            return df.withColumnRenamed(c, name)
    return df


def drop_null_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.dropna(how="any", subset=list(keys))


def drop_all_null(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    return df.dropna(how="all", subset=list(cols))


def forward_fill(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], bucket: Column | Sequence[Column], cols: Sequence[str],
    deep: bool = False,
) -> DataFrame:
    """Each null takes the last non-null value above it, in file order (``deep``: see ``neighbours``)."""
    filled = neighbours(df, keys, order, bucket, fill={f"__filled_{c}": c for c in cols}, deep=deep)
    return filled.select(*[F.col(f"__filled_{c}").alias(c) if c in cols else F.col(c) for c in df.columns])


def null_profile(df: DataFrame) -> DataFrame:
    """Number of nulls per column, in one pass."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])


def schema_profile(df: DataFrame) -> DataFrame:
    """Column names and types, with the row count of the table."""
    cells = [F.struct(F.lit(n).alias("column_name"), F.lit(t).alias("data_type")) for n, t in df.dtypes]
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select("n_rows", F.inline(F.array(*cells)))


def preview(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """The first rows in a total order."""
    return df.orderBy(*order).limit(n)


def industry_mismatch(companies: DataFrame, reference: DataFrame) -> DataFrame:
    """Companies whose stored industry differs from the reference table's."""
    known = reference.filter(F.col("industry").isNotNull()).select(
        "company_name", F.col("industry").alias("found_industry")
    )
    return (
        companies.join(known, "company_name")
        .filter(~F.col("industry").eqNullSafe(F.col("found_industry")))
        .select("company_name", F.col("industry").alias("expected_industry"), "found_industry")
    )
