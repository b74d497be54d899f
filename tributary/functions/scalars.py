"""Column functions. All are built-in expressions, so they stay in codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def lenient_double(name: str) -> Column:
    """Number, or NULL when the text is not one."""
    return F.col(name).try_cast("double")


def lenient_int(name: str) -> Column:
    """Integer, or NULL when the text is not one."""
    return F.col(name).try_cast("int")


def text_flag(name: str) -> Column:
    """True for the text `True`; anything else, also NULL, is false."""
    return F.col(name).cast("string").eqNullSafe(F.lit("True"))


def numeric_text(name: str) -> Column:
    """Number found by pattern; words become NULL."""
    digits = F.regexp_extract(F.col(name).cast("string"), r"^\s*([+-]?[0-9]+(?:\.[0-9]+)?)\s*$", 1)
    return F.nullif(digits, F.lit("")).try_cast("double")


def places(value: Column, digits: int) -> Column:
    """Round half up on the decimal text, returned as double."""
    return F.round(value.try_cast("decimal(28,10)"), digits).cast("double")


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, NULL when whole is 0 or NULL."""
    return F.try_divide(part.cast("double"), whole.cast("double"))


def percent(part: Column, whole: Column, digits: int = 2) -> Column:
    """100 * part / whole rounded to `digits`."""
    return places(ratio(part, whole) * 100, digits)


def zero(value: Column) -> Column:
    """NULL counts as 0."""
    return F.coalesce(value, F.lit(0))


def day(name: str) -> Column:
    """Calendar day of a time."""
    return F.to_date(F.col(name))


def count_when(condition: Column) -> Column:
    """Rows on which the condition holds; 0 on an empty group."""
    return F.count(F.when(condition, F.lit(1)))
