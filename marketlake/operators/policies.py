"""Per-batch error policies (SNK-12, SNK-13).

``abort_rest``: rows are written in a fixed order (bars, then quotes, then
trades, each in arrival order); the first row that cannot be written stops the
batch: rows before it stay, it and every later row of that batch are lost
(there is no transaction). ``skip_row``: bad rows are reported, the others are
written.

The cut of each batch is a ``groupBy(batch).agg(min(rank))`` over the bad rows
only (one small row per batch that has an error, partially aggregated), joined
back to the rows; no window over whole batches, so a batch that holds a large
share of the rows is never gathered into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def abort_rest(rows: DataFrame, batch: Sequence[str], rank: Sequence[str], error: str = "_error") -> DataFrame:
    """SNK-12: the rows of each batch written before its first bad row (by ``rank``)."""
    batch, rank = list(batch), list(rank)
    cuts = (rows.filter(F.col(error).isNotNull()).groupBy(*batch)
            .agg(F.min(F.struct(*rank)).alias("_cut")))
    return (rows.join(cuts, on=batch, how="left")
            .filter(F.col("_cut").isNull() | (F.struct(*rank) < F.col("_cut")))
            .drop("_cut", error))


def skip_row(rows: DataFrame, error: str = "_error") -> DataFrame:
    """SNK-13: bad rows are left out (see ``rejected``), the others are written."""
    return rows.filter(F.col(error).isNull()).drop(error)


def rejected(rows: DataFrame, error: str = "_error") -> DataFrame:
    return rows.filter(F.col(error).isNotNull())
