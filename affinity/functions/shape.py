"""Output shaping: nested values leave a query as plain comparable strings."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def joined(arr: str | Column, sep: str = ",") -> Column:
    """Sorted array as one string (order-insensitive comparison)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.array_join(F.sort_array(a).cast("array<string>"), sep)


def joined_in_order(arr: str | Column, sep: str = ",") -> Column:
    """Array as one string, keeping its order (ranked lists)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.array_join(a.cast("array<string>"), sep)
