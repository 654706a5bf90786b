"""Calendar derivations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sales_engine.functions.numbers import to_number

# Season label and its months; every other month, and an unknown date, is winter.
SEASONS = {"Primavera": (3, 4, 5), "Verano": (6, 7, 8), "Otoño": (9, 10, 11)}
DEFAULT_SEASON = "Invierno"


def to_ts(col: Column) -> Column:
    """ISO text -> timestamp; malformed becomes NULL."""
    return col.try_cast("timestamp")


def epoch_ms_to_ts(col: Column) -> Column:
    """Epoch milliseconds (text or number) -> timestamp; malformed becomes NULL."""
    return F.timestamp_micros(F.rint(to_number(col) * 1000).try_cast("bigint"))


def season(col: Column) -> Column:
    """Season label of a date or timestamp."""
    month = F.month(col)
    label = F.lit(DEFAULT_SEASON)
    for name, months in SEASONS.items():
        label = F.when(month.isin(*months), F.lit(name)).otherwise(label)
    return label
