"""What the vector operators share."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def usable(vector: Column) -> Column:
    """Not null, not zero, all components there and finite."""
    odd = lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))
    return F.coalesce(vector.isNotNull() & ~F.exists(vector, odd) & F.exists(vector, lambda x: x != 0), F.lit(False))
