"""What a stream must remember from batch to batch: one row per key, its least value.

Each micro-batch of a run writes the rows it adds to a folder of its own (a replay
replaces it). Every ``FOLD_EVERY`` batches all that came before is folded into one row a
key, so that a batch reads one fold and at most ``FOLD_EVERY`` additions, whose places
follow from its number: nothing is listed, and the cost does not grow with the stream's age.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.session import path_exists

FOLD_EVERY = 16


class FoldedState:
    def __init__(self, path: str, key: Sequence[str], value: str):
        self.path, self.key, self.value = path.rstrip("/"), list(key), value

    def _place(self, kind: str, run: str, batch_id: int) -> str:
        return f"{self.path}/{kind}/run={run}/batch={int(batch_id)}"

    def write(self, rows: DataFrame, run: str, batch_id: int) -> None:
        """Add a batch's rows (key columns and the value)."""
        rows.select(*self.key, self.value).write.mode("overwrite").parquet(self._place("added", run, batch_id))

    def before(self, spark: SparkSession, schema, run: str, batch_id: int) -> DataFrame | None:
        """What the batches of ``run`` before ``batch_id`` left: one row a key; None where
        there is nothing. The first batch behind a fold's end writes the fold."""
        fold = batch_id - batch_id % FOLD_EVERY
        if fold and fold == batch_id:
            held = self._read(spark, schema, run, fold - FOLD_EVERY, fold)
            if held is not None:
                held.write.mode("overwrite").parquet(self._place("folded", run, fold))
        return self._read(spark, schema, run, fold, batch_id)

    def upto(self, spark: SparkSession, schema, run: str, batch_id: int) -> DataFrame | None:
        """``before`` with what ``batch_id`` itself has written by now."""
        fold = batch_id - batch_id % FOLD_EVERY
        if fold == batch_id:
            self.before(spark, schema, run, batch_id)
        return self._read(spark, schema, run, fold, batch_id + 1)

    def _read(self, spark: SparkSession, schema, run: str, fold: int, till: int) -> DataFrame | None:
        start = None
        while fold > 0 and start is None:  # a fold is missing only if its batch failed and was passed over
            start = self._there(spark, schema, [self._place("folded", run, fold)])
            fold -= 0 if start is not None else FOLD_EVERY
        rows = self._there(spark, schema, [self._place("added", run, b) for b in range(fold, till)])
        both = [x for x in (start, rows) if x is not None]
        if not both:
            return None
        every = both[0] if len(both) == 1 else both[0].unionByName(both[1])
        return every.groupBy(*self.key).agg(F.min(self.value).alias(self.value))

    def _there(self, spark: SparkSession, schema, places: list[str]) -> DataFrame | None:
        """The rows of those places that exist (a batch that failed has none)."""
        found = [x for x in places if path_exists(spark, x)]
        return spark.read.schema(schema).parquet(*found) if found else None
