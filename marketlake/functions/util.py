"""Small helpers shared by the expression modules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col_of(x) -> Column:
    """Accept a column name or a Column."""
    return x if isinstance(x, Column) else F.col(x)
