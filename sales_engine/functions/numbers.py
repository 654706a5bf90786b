"""Safe typing of dirty text and sums that do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: From here on a double has no hundredths.
LARGE = 1e15
#: Up to so many hundredths a value is added as an integer: 10^10 of them stay below 2^63.
HUNDREDTHS = 9e8
PLAIN_DECIMAL = r"^\s*[+-]?(\d+(\.\d*)?|\.\d+)\s*$"


def to_number(col: Column) -> Column:
    """Double value of a text or numeric column; malformed, NaN and infinite become NULL."""
    number = col.try_cast("double")
    return F.when(F.abs(number) < F.lit(float("inf")), number)


def to_int(col: Column) -> Column:
    """Whole part as int ('60.5' -> 60); malformed or out of range becomes NULL.

    Text must be a plain decimal: '12d' or '1e3', which a double cast takes, are malformed.
    """
    plain = (F.typeof(col) != "string") | col.cast("string").rlike(PLAIN_DECIMAL)
    return F.when(plain, to_number(col)).try_cast("int")


def exact_sum(col: Column, scale: int = 6) -> Column:
    """Sum of a double column with ``scale`` decimals, the same in any order of addition.

    Adding doubles gives another last digit for every order of the tasks, which
    makes ``total = max(total)`` a matter of luck after a retry. Values of whole hundredths
    up to nine million are added as integers, which needs no decimal a row. Other values
    are rounded to the scale and added as decimals. There is room for 10^10 rows of the largest.
    Those from ``LARGE`` on are added on their own with 38 digits, and leave the sum
    NULL, not wrong, if these do not suffice.
    """
    kind, part = f"decimal(38,{scale})", f"decimal(37,{scale})"
    hundredths = F.rint(col * 100)
    # such a double is the one nearest to its hundredths, so they are its decimal form
    plain = (F.abs(hundredths) <= HUNDREDTHS) & (hundredths / 100 == col)
    rest = F.when(~plain, col)
    large = F.when(F.abs(rest) >= LARGE, rest)
    digits = large.try_cast("decimal(38,0)")
    quick = (F.sum(F.when(plain, hundredths.try_cast("bigint"))).cast("decimal(19,0)") * F.lit("0.01").cast("decimal(3,2)")).cast(kind)
    slow = F.sum(below_large(rest).cast(f"decimal({16 + scale},{scale})")).cast(kind)
    small = F.when(quick.isNull(), slow).when(slow.isNull(), quick).otherwise(
        F.try_add(quick.try_cast(part), slow.try_cast(part)).cast(kind)
    )
    both = F.try_add(F.coalesce(small, F.lit(0).cast(kind)), F.try_sum(digits).try_cast(kind))
    fits = F.count(large) == F.count(digits)
    return F.when(F.count(large) == 0, small).when(fits, both.try_cast(kind))


def large_sum(col: Column) -> Column:
    """Sum of the values from ``LARGE`` on as a double; 0 where there are none."""
    return F.coalesce(F.sum(F.when(F.abs(col) >= LARGE, col)), F.lit(0.0))


def below_large(col: Column) -> Column:
    """The value, NULL from ``LARGE`` on."""
    return F.when(F.abs(col) < LARGE, col)
