"""Keyed tables on plain Parquet (SNK-1..3, SNK-9, SNK-10).

Built-in Parquet tables have no ``MERGE``; a table here is an append-only log
partitioned by ``_run`` (the stable id of the streaming query that wrote it) and
``_batch_id``. Each micro-batch is written with dynamic partition overwrite, so a
replayed batch (after a restart from the checkpoint, or a lost executor) replaces
itself and nothing else: another run, or another pipeline on the same root, adds
to the table. Reading resolves the log per key:

* ``append``: every row;
* ``insert_ignore``: the first arrival per key (``ON CONFLICT DO NOTHING``);
* ``upsert``: the last arrival per key, surrogate ``id`` of the first
  (``ON CONFLICT DO UPDATE``, ``received_at`` refreshed).

Surrogate ids are unique. Runs are numbered (``_runs``, a claim that is read back before
it counts), and a run has ``RUN_IDS`` ids for each table. A batch takes ids from the
greatest one of its run's earlier batches on; inside it a row's id follows from its place
in arrival order within one of ``ID_GROUPS`` groups, so a replay gives the same ids. Like a
serial's, the ids have gaps.

Arrival order is ``(_at, _run, _batch_id, _seq)``, where ``_at`` is the time the batch
was handed to the table; it is data, so the result does not depend on
partitioning or on task order. The writer reduces each batch to one row per key
before writing, so the log grows with distinct keys per batch, not with
duplicates; ``compact()`` folds the log into a versioned snapshot and notes, for
each run, the last batch it holds, after which reads resolve only the others.
"""

from __future__ import annotations

import random
import threading
import time
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from marketlake.operators import keyed
from marketlake.schemas import TABLE_COLUMNS, TABLE_KEYS
from marketlake.session import path_exists

#: The run id of writes that no streaming query makes.
DIRECT = "direct"
#: Ids that a run has for each table, and groups in which a batch's rows are numbered.
RUN_IDS = 1 << 40
ID_GROUPS = 64

_numbers: dict[tuple[str, str], int] = {}  # of runs, by root
_next: dict[tuple[str, str], tuple[int, int]] = {}  # by table and run: the last batch written, the next id
_lock = threading.Lock()


def read_if_any(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``; None where there is no folder or no data file yet.
    Any other failure (an unreadable file, lost storage) is raised, never taken for
    an empty table."""
    if not path_exists(spark, path):
        return None
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def run_number(spark: SparkSession, root: str, run: str) -> int:
    """The number of a run among all that write to ``root``. A run claims the next free
    one and reads the claims again: whoever then sees another run with the same number
    gives it up for a greater one, so no two keep the same."""
    with _lock:
        if (root, run) in _numbers:
            return _numbers[root, run]
        path = f"{root}/_runs"
        while True:
            rows = read_if_any(spark, path)
            claims: dict[str, int] = {}
            for r in [] if rows is None else rows.groupBy("run").agg(F.max("number").alias("number")).collect():  # a row a run
                claims[r["run"]] = r["number"]
            mine = claims.pop(run, None)
            if mine is not None and mine not in claims.values():
                _numbers[root, run] = mine
                return mine
            if mine is not None:
                time.sleep(random.random())
            new = max([-1, *claims.values(), *([mine] if mine is not None else [])]) + 1
            spark.createDataFrame([(run, new)], "run string, number bigint").coalesce(1).write.mode("append").parquet(path)


class KeyedTable:
    """One table folder ``<root>/<name>`` (a shared path on a cluster)."""

    def __init__(self, spark: SparkSession, root: str, name: str,
                 key: Sequence[str] | None = None, mode: str | None = None):
        default_key, default_mode = TABLE_KEYS.get(name, ((), "append"))
        self.spark, self.name = spark, name
        self.key = list(key if key is not None else default_key)
        self.mode = mode or default_mode
        self.root = root.rstrip("/")
        self.path = f"{self.root}/{name}"

    # ---------------------------------------------------------------- write
    def write_batch(self, rows: DataFrame, batch_id: int, seq: Sequence[str], run: str = DIRECT) -> None:
        """Write one batch of ``run``; ``seq`` names the arrival-order columns of ``rows``."""
        df = rows.withColumn("_seq", F.struct(*seq))
        if self.mode == "insert_ignore":
            df = keyed.top_per_key(df, self.key, ["_seq"], last=False)
        elif self.mode == "upsert":
            df = keyed.top_per_key(df, self.key, ["_seq"], last=True)
        first = self._first_id(run, int(batch_id))
        group = F.pmod(F.xxhash64("_seq"), F.lit(ID_GROUPS))
        df = df.withColumn("_g", group).withColumn("_n", F.row_number().over(Window.partitionBy("_g").orderBy("_seq")))
        ident = F.lit(first) + (F.col("_n") - 1) * F.lit(ID_GROUPS).cast("bigint") + F.col("_g")
        cols = [c for c in TABLE_COLUMNS[self.name].fieldNames()] if self.name in TABLE_COLUMNS else \
            [c for c in rows.columns if c not in seq]
        out = df.select(ident.alias("id"), *cols, F.current_timestamp().cast("timestamp_ntz").alias("received_at"),
                        "_seq", F.lit(time.time_ns() // 1000).alias("_at"), F.lit(run).alias("_run"),
                        F.lit(int(batch_id)).cast("bigint").alias("_batch_id"))
        seen = Observation(f"ids-{self.name}-{int(batch_id)}")
        (out.observe(seen, F.max("id").alias("last")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_run", "_batch_id").parquet(self.path))
        last = seen.get["last"]
        with _lock:
            _next[self.path, run] = (int(batch_id), first if last is None else last + 1)

    def _first_id(self, run: str, batch_id: int) -> int:
        """The id from which a batch's rows are numbered: behind all of its run's earlier
        batches. Known from the batch before, or read (of the ids alone) after a restart."""
        with _lock:
            batch, first = _next.get((self.path, run), (batch_id, 0))
        start = run_number(self.spark, self.root, run) * RUN_IDS
        if batch >= batch_id:  # a new process, or a replay
            last = None
            if batch_id > 0:
                mine = self.log().filter((F.col("_run") == F.lit(run)) & (F.col("_batch_id") < F.lit(batch_id)))
                last = mine.agg(F.max("id")).first()[0]
            first = start + 1 if last is None else last + 1
        if first >= start + RUN_IDS:
            raise RuntimeError(f"run {run} has used up its ids in {self.name}")
        return first

    # ---------------------------------------------------------------- read
    def exists(self) -> bool:
        """Whether any batch was written."""
        return read_if_any(self.spark, self.path) is not None

    def _empty(self) -> DataFrame:
        schema = TABLE_COLUMNS[self.name]
        return self.spark.createDataFrame([], schema).select(
            F.lit(None).cast("bigint").alias("id"), *schema.fieldNames(),
            F.lit(None).cast("timestamp_ntz").alias("received_at"), F.lit(None).alias("_seq"),
            F.lit(None).cast("bigint").alias("_at"), F.lit(None).cast("string").alias("_run"),
            F.lit(None).cast("bigint").alias("_batch_id"))

    def log(self) -> DataFrame:
        """Every written row (all runs and batches), or an empty frame of the table's schema."""
        rows = read_if_any(self.spark, self.path)
        return self._empty() if rows is None else rows.withColumn("_run", F.col("_run").cast("string"))

    # ---------------------------------------------------------------- snapshots
    @property
    def snapshot_root(self) -> str:
        return self.path + "__snapshots"

    @property
    def manifest(self) -> str:
        return self.snapshot_root + "/_manifest"

    def _folded(self) -> tuple[int | None, dict[str, int]]:
        """The last complete snapshot and, for each run, the last batch in it (one row
        for each run). A version is listed only after its snapshot was written, so
        a compaction that died half-way is never read."""
        rows = read_if_any(self.spark, self.manifest)
        if rows is None:
            return None, {}
        version = rows.agg(F.max("version")).first()[0]
        return version, {r["run"]: r["till"] for r in rows.filter(F.col("version") == version).collect()}

    def latest_snapshot(self) -> int | None:
        return self._folded()[0]

    def _resolve(self, rows: DataFrame) -> DataFrame:
        order = ["_at", "_run", "_batch_id", "_seq"]
        if self.mode == "append":
            return rows
        if self.mode == "insert_ignore":
            return keyed.top_per_key(rows, self.key, order, last=False)
        # The last arrival's columns, the first one's id (partially aggregated, so a hot key is one row a task).
        place, alone = F.struct(*order), F.when(keyed.any_null(self.key), F.struct(*order))
        last = rows.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.key)], alone.alias("_alone")).agg(
            F.max_by(F.struct(*rows.columns), place).alias("_row"), F.min_by("id", place).alias("_id"))
        return last.select(*[F.col("_id").alias("id") if c == "id" else F.col(f"_row.`{c}`").alias(c) for c in rows.columns])

    def _newer(self, folded: dict[str, int]) -> DataFrame:
        """Log rows of batches that no snapshot holds (a filter on partition columns)."""
        rows = self.log()
        for run, till in folded.items():
            rows = rows.filter((F.col("_run") != F.lit(run)) | (F.col("_batch_id") > F.lit(till)))
        return rows

    def read(self) -> DataFrame:
        """The table as the reference's database would hold it.

        Without a snapshot the whole log is resolved (one shuffle on the key).
        With one, only log batches that it does not hold are resolved (the filter
        prunes partitions) and merged with the snapshot through an anti join on
        the key columns, so the snapshot's rows are not re-sorted.
        """
        version, folded = self._folded()
        if version is None:
            return self._resolve(self.log())
        snap = self.spark.read.parquet(f"{self.snapshot_root}/v={version}")
        newer = self._resolve(self._newer(folded))
        if self.mode == "append":
            return snap.unionByName(newer)
        if self.mode == "insert_ignore":
            fresh = newer.join(snap.select(*self.key), on=self.key, how="left_anti")
            return snap.unionByName(fresh)
        # A key that the snapshot holds keeps its id.
        ids = snap.select(*self.key, F.col("id").alias("_held"))
        newer = newer.join(ids, on=self.key, how="left").withColumn("id", F.coalesce("_held", "id")).select(*newer.columns)
        kept = snap.join(newer.select(*self.key), on=self.key, how="left_anti")
        return kept.unionByName(newer)

    def compact(self) -> int | None:
        """Fold every written batch into a new snapshot (the log is kept; a read then
        resolves only batches written later). Without such batches nothing is done."""
        version, folded = self._folded()
        last = {r["_run"]: r["till"] for r in self.log().groupBy("_run").agg(F.max("_batch_id").alias("till")).collect()}
        if all(folded.get(run, -1) >= till for run, till in last.items()):
            return version
        new = (version or 0) + 1
        held = F.lit(False)
        for run, till in last.items():  # batches that land meanwhile stay in the log
            held = held | ((F.col("_run") == F.lit(run)) & (F.col("_batch_id") <= F.lit(till)))
        self.read().filter(held).write.mode("overwrite").parquet(f"{self.snapshot_root}/v={new}")
        (self.spark.createDataFrame([(new, run, till) for run, till in last.items()], "version bigint, run string, till bigint")
         .coalesce(1).write.mode("append").parquet(self.manifest))
        return new


def init_schema(spark: SparkSession, root: str, names: Sequence[str] | None = None) -> list[str]:
    """SNK-9: create each table folder with its fixed schema if it does not exist
    (idempotent, like ``CREATE TABLE IF NOT EXISTS``)."""
    made = []
    for name in names or TABLE_COLUMNS:
        t = KeyedTable(spark, root, name)
        if t.exists():
            continue
        # An empty log partitioned like the batches (the folder, no data file): an
        # append, which never removes anything. ``log()`` gives the fixed schema
        # until the first batch lands.
        (t._empty().drop("_seq").write.mode("append").partitionBy("_run", "_batch_id").parquet(t.path))
        made.append(name)
    return made
