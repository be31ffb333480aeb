"""Text and coercion expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def is_blank(c: Column) -> Column:
    """Null or nothing but blanks."""
    return c.isNull() | (F.trim(c) == "")


def blank_to_null(c: Column) -> Column:
    return F.when(~c.rlike(r"^\s*$"), c)


def to_number(c: Column) -> Column:
    """Number or null; never an error, also under ANSI mode."""
    return c.try_cast("double")


def first_code(c: Column) -> Column:
    """The part before the first ``|``."""
    return F.substring_index(c, "|", 1)


def name_parts(users: Column) -> tuple[Column, Column]:
    """First word and the rest (null when there is no second word)."""
    parts = F.split(F.trim(users), r"\s+", 2)
    return F.get(parts, F.lit(0)), F.get(parts, F.lit(1))


def full_name(first: Column, last: Column) -> Column:
    """``first last``; null if either part is null."""
    return F.concat(first, F.lit(" "), last)


def flag(cond: Column) -> Column:
    """A condition with null meaning false."""
    return F.coalesce(cond, F.lit(False))
