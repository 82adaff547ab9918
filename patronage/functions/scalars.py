"""Column helpers with the null and rounding rules the operators rely on."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, functions as F

from patronage.functions import labels


def day(value: date | str | Column) -> Column:
    """A date literal; a column stays as it is."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def safe_divide(a: Column, b: Column) -> Column:
    """a / b, null when b is 0 or either side is null."""
    return F.try_divide(a, b)


def safe_int(c: Column) -> Column:
    return c.try_cast("bigint")


def safe_double(c: Column) -> Column:
    """Text to number, null when it is not one."""
    return c.try_cast("double")


def floor_at_zero(c: Column) -> Column:
    """Negative values become 0; null stays null."""
    return F.when(c < 0, F.lit(0)).otherwise(c)


def greatest_or_null(*cols: Column) -> Column:
    """GREATEST that is null as soon as one argument is (Spark's skips nulls)."""
    known = cols[0].isNotNull()
    for c in cols[1:]:
        known = known & c.isNotNull()
    return F.when(known, F.greatest(*cols))


def round_half_up(c: Column, places: int) -> Column:
    """Round rates and shares half away from zero.

    The value is first snapped to nine decimals, so 0.125 stored as 0.12499999999999999
    rounds as 0.125 does.  Meant for values below 1e9.
    """
    return F.round(c.cast("decimal(18,9)"), places).cast("double")


def round_to_long(c: Column) -> Column:
    """Number to integer by rounding half away from zero, not by truncating."""
    return F.round(c.cast("decimal(24,6)")).cast("bigint")


def age_group(birth_year: Column, as_of: Column) -> Column:
    """Decade of age as text ('30'); null when the birth year is not a number."""
    years = F.year(as_of) - safe_int(birth_year)
    return (F.floor(years / 10) * 10).cast("string")


def join_group(join_dt: Column) -> Column:
    """Join month as yy-mm."""
    return F.date_format(join_dt, "yy-MM")


def clean_label(c: Column) -> Column:
    """Slashes become dashes, so that labels can be nested as a(b)."""
    return F.replace(c, F.lit("/"), F.lit("-"))


def has_label(c: Column, empty: str = labels.NO_CATEGORY_TEXT) -> Column:
    return c.isNotNull() & (F.trim(c) != "") & (F.trim(c) != empty)


def nested_label(outer: Column, inner: Column, missing: str = labels.NO_SUBCATEGORY) -> Column:
    """outer(inner), with a stand-in for a null or blank inner part."""
    blank = inner.isNull() | (F.trim(inner) == "")
    return F.concat(outer, F.lit("("), F.when(blank, F.lit(missing)).otherwise(inner), F.lit(")"))


def first_of(array: Column, field: str) -> Column:
    """Field of the first array element, null when the array is empty."""
    return F.get(array, F.lit(0))[field]


def ladder(value: Column, steps, last) -> Column:
    """Label of the first step whose upper bound is not exceeded; null falls to the last."""
    out = None
    for bound, label in steps:
        out = F.when(value <= bound, label) if out is None else out.when(value <= bound, label)
    return out.otherwise(last)


def grade_ladder(score: Column, cuts, lowest: str = labels.GRADE_LOWEST) -> Column:
    """Best grade whose cut the score exceeds; cuts run from best to worst."""
    out = None
    for cut, grade in cuts:
        out = F.when(score > cut, grade) if out is None else out.when(score > cut, grade)
    return out.otherwise(lowest)
