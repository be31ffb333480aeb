"""Sales roll-ups.

Dates are days.  Every roll-up starts from sums with map-side aggregation; the
dense ones fill the missing (day, category) pairs with zero.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shopledger.functions.clock import date_parts, weekday_name
from shopledger.session import store

MEASURES = ["out_count_total", "total_sales", "total_sales_local_price"]


def _sum(c: str) -> Column:
    return F.coalesce(F.sum(c), F.lit(0.0)).alias(c)


def with_time_features(df: DataFrame, date: str = "out_date") -> DataFrame:
    """Add year, month, day and weekday (Monday = 0)."""
    return df.withColumns(date_parts(date))


def time_split(df: DataFrame, split: dt.date, date: str = "out_date") -> DataFrame:
    """Label rows before the date ``train`` and the others ``test``."""
    known = df.filter(F.col(date).isNotNull())
    return known.withColumn("part", F.when(F.col(date) < F.lit(split), "train").otherwise("test"))


def year_split(df: DataFrame, last_train_year: int, date: str = "out_date") -> DataFrame:
    """Train up to a year, test on the next one; later years are left out."""
    year = F.year(date)
    part = F.when(year <= last_train_year, "train").when(year == last_train_year + 1, "test")
    return df.withColumn("part", part).filter(F.col("part").isNotNull())


def _daily(sales: DataFrame, measures: Sequence[str], category: str | None = "sales") -> DataFrame:
    """Sums per day and category (rows without one together); rows without a date are left out."""
    day = F.to_date("out_date").alias("out_date")
    keys = [day, F.col(category)] if category else [day]
    return sales.filter(F.col("out_date").isNotNull()).groupBy(*keys).agg(*[_sum(m) for m in measures])


def daily_total(sales: DataFrame) -> DataFrame:
    return _daily(sales, ["total_sales"], category=None)


def dense_by_category(
    sales: DataFrame, measures: Sequence[str] = ("total_sales",), category: str = "sales"
) -> DataFrame:
    """Sums per day and category, every category on every day of the table.

    The sales are grouped once; the sums, a row per day and category, are written to the shared folder, and the days and
    categories come from there. The days are one array - a calendar, so a few thousand values however large the table -
    and each category explodes it.
    """
    every = store(_daily(sales, measures, category), "daily-sums")
    sums = every.filter(F.col(category).isNotNull())
    days = every.agg(F.collect_set("out_date")).scalar()
    grid = sums.select(category).distinct().withColumn("out_date", F.explode(days))
    return grid.join(sums, [category, "out_date"], "left").fillna(0.0, list(measures))


def by_year_weekday(sales: DataFrame) -> DataFrame:
    rows = daily_total(sales).groupBy(F.year("out_date").alias("year"), F.weekday("out_date").alias("weekday"))
    return rows.agg(_sum("total_sales")).withColumn("weekday_name", weekday_name("weekday"))


def by_year_month(sales: DataFrame) -> DataFrame:
    return daily_total(sales).groupBy(
        F.year("out_date").alias("year"), F.month("out_date").alias("month")
    ).agg(_sum("total_sales"))


def by_category_month(sales: DataFrame) -> DataFrame:
    month = F.trunc("out_date", "MM").alias("month_start")
    return _daily(sales, ["total_sales"]).groupBy("sales", month).agg(_sum("total_sales"))


def by_dimension(sales: DataFrame) -> DataFrame:
    """Total in millions for each value of year, month, day, weekday and category.

    The grouping sets multiply the daily sums, not the sales rows.
    """
    names = ["year", "month", "day", "weekday", "sales"]
    base = with_time_features(_daily(sales.withColumn("sales", F.coalesce("sales", F.lit(""))), ["total_sales"]))
    sets = base.groupingSets([[F.col(n)] for n in names], *names).agg(
        F.grouping_id().alias("set_id"), F.sum("total_sales").alias("total_sales")
    )
    # One of the five columns is grouped in each row: the one whose bit is not set.
    dimension = F.lit(names[-1])
    value = F.col(names[-1])
    for place, name in enumerate(reversed(names[:-1]), start=1):
        grouped = F.col("set_id").bitwiseAND(F.lit(1 << place)) == 0
        dimension = F.when(grouped, name).otherwise(dimension)
        value = F.when(grouped, F.col(name).cast("string")).otherwise(value)
    return sets.select(
        dimension.alias("dimension"), value.alias("value"), (F.col("total_sales") / 1e6).alias("total_millions")
    ).filter(F.col("value") != "")
