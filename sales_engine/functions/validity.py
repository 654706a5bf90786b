"""What counts as a missing value."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column


def is_invalid(col: Column, sentinels: Sequence[str]) -> Column:
    """TRUE for NULL or a sentinel, FALSE otherwise, never NULL.

    The comparison is made on text, so numeric columns need no special case.
    """
    return col.isNull() | col.cast("string").isin(list(sentinels))
