"""Pay expressions of the bi-weekly payroll."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: trigger hours of a rate row that names none.
DEFAULT_TRIGGER = 80


def with_pay_defaults(rates_joined: DataFrame) -> DataFrame:
    """Fill the optional rate columns; every later pay rule reads the filled ones."""
    return rates_joined.withColumns(
        {
            "skip_calc": F.coalesce("skip_calc", F.lit("No")),
            "follow_clock": F.coalesce("follow_clock", F.lit("No")),
            "ot_rate": F.coalesce("ot_rate", "reg_rate"),
            "ot_trigger_holiday": F.coalesce("ot_trigger_holiday", F.lit(DEFAULT_TRIGGER)),
            "ot_trigger_regular": F.coalesce("ot_trigger_regular", F.lit(DEFAULT_TRIGGER)),
        }
    )


def pay_basis(raw: Column) -> Column:
    """daily / annual / hourly, or null when the text names none of them."""
    text = F.lower(F.trim(raw))
    basis = F.when(text.contains("daily"), "daily").when(text.contains("annual"), "annual")
    return basis.when(text.contains("hourly"), "hourly")


def trigger_hours(has_holiday: Column) -> Column:
    return F.when(has_holiday, F.col("ot_trigger_holiday")).otherwise(F.col("ot_trigger_regular"))


def salary(has_holiday: Column, cap_regular: bool = False) -> Column:
    """``struct<salary, regular_pay, overtime_pay>`` of an employee and period.

    Expects the columns of ``with_pay_defaults`` plus department, total_hours and
    working_days.  Hourly staff not paid by the clock get the whole trigger as
    regular hours even when they worked less; ``cap_regular`` limits it to the
    hours worked.
    """
    hours = F.col("total_hours")
    reg, ot = F.col("reg_rate").cast("double"), F.col("ot_rate").cast("double")
    basis = pay_basis(F.col("pay_basis"))
    trigger = trigger_hours(has_holiday).cast("double")

    unpaid = F.col("reg_rate").isNull() | F.col("department").eqNullSafe("Temp")
    unpaid = unpaid | basis.isNull() | (F.col("skip_calc") == "Yes")
    fixed = F.when(basis == "daily", F.col("working_days") * reg).when(basis == "annual", reg)
    fixed = fixed.when(F.col("follow_clock") == "Yes", hours * reg)
    regular_hours = F.least(trigger, hours) if cap_regular else trigger

    regular = F.when(unpaid, 0.0).when(fixed.isNotNull(), fixed).otherwise(regular_hours * reg)
    overtime = F.when(unpaid | fixed.isNotNull(), 0.0).otherwise(F.greatest(F.lit(0.0), hours - trigger) * ot)
    return F.struct(
        (regular + overtime).alias("salary"), regular.alias("regular_pay"), overtime.alias("overtime_pay")
    )
