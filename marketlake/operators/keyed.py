"""Keyed-table resolution: insert-ignore (first arrival wins) and upsert (last wins).

Both are a top-1 per key over an explicit arrival sequence, so the result does
not depend on partitioning, on the order rows are processed in, or on replays.
The filter ``row_number() = 1`` is planned as ``WindowGroupLimit``, which runs
a partial top-1 *before* the shuffle: a key that holds a third of all rows is
cut down to one row per input partition on the map side, so no task receives
the hot group whole.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _cols(xs) -> list[Column]:
    if isinstance(xs, (str, Column)):
        xs = [xs]
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def any_null(key: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in _cols(key):
        out = out | c.isNull()
    return out


def top_per_key(rows: DataFrame, key: Sequence[str], order, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``. ``order`` must be unique per key.
    Rows with a NULL in their key are equal to no other row (a unique index keeps
    them all): for them the order columns are part of the key."""
    o = [c.desc() if last else c.asc() for c in _cols(order)]
    alone = F.when(any_null(key), F.struct(*_cols(order)))
    w = Window.partitionBy(*_cols(key), alone).orderBy(*o)
    return rows.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") == 1).drop("_rn")


def insert_ignore(rows: DataFrame, key: Sequence[str], order, target: DataFrame | None = None) -> DataFrame:
    """SNK-2: rows that an ``INSERT ... ON CONFLICT (key) DO NOTHING`` would keep.

    In-batch: the first arrival per key. Across batches: keys already present in
    ``target`` are dropped (anti join on the key only; a shuffle of the key
    columns, or a broadcast when AQE measures the batch side as small).
    """
    firsts = top_per_key(rows, key, order, last=False)
    if target is None:
        return firsts
    return firsts.join(target.select(*key).distinct(), on=list(key), how="left_anti")


def upsert(rows: DataFrame, key: Sequence[str], order, target: DataFrame | None = None) -> DataFrame:
    """SNK-3: the table after ``INSERT ... ON CONFLICT (key) DO UPDATE SET <all non-key>``.

    The last arrival per key replaces every non-key column (NULLs included).
    Target rows whose key is not in the batch are kept as they are.
    """
    lasts = top_per_key(rows, key, order, last=True)
    if target is None:
        return lasts
    kept = target.join(lasts.select(*key), on=list(key), how="left_anti")
    return kept.unionByName(lasts, allowMissingColumns=True)
