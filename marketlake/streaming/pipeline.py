"""Streaming pipelines: source -> sink (STR-1..7, SNK-11, SNK-14).

A pipeline is a Structured Streaming query: ``readStream`` (the source, with
its admission limit) -> ``foreachBatch`` (the sink). Micro-batches reach the
sink one at a time and in order (``batch_id`` is monotone), from one
consumer. The checkpoint makes a restarted query replay the unfinished batch,
and the table writes are idempotent per ``batch_id``, so each batch lands
exactly once even when executors are lost.
"""

from __future__ import annotations

import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Protocol

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from marketlake.operators import frames as FR
from marketlake.operators import rows as R
from marketlake.session import require_utc
from marketlake.streaming.state import FoldedState
from marketlake.streaming.tables import DIRECT, KeyedTable, read_if_any


def run_concurrently(*writes: Callable[[], None]) -> None:
    """Submit independent writes of one micro-batch as concurrent Spark jobs.

    They read the same cached batch, so overlapping them fills the executors
    instead of running small jobs one after the other. The first failure is
    raised after all have finished (each write is idempotent per batch id). The
    threads inherit the streaming query's job properties, so its stop cancels them.
    """
    if len(writes) == 1:
        writes[0]()
        return
    with ThreadPoolExecutor(max_workers=len(writes)) as pool:
        inherit = inheritable_thread_target(SparkSession.active())
        futures = [pool.submit(inherit(w)) for w in writes]
        errors = [f.exception() for f in futures]
    for e in errors:
        if e is not None:
            raise e


# A source builds the streaming DataFrame given the admission limit (files or
# units per micro-batch; None = unlimited).
Source = Callable[[SparkSession, "int | None"], DataFrame]


class Sink(Protocol):
    """SNK-14: user sinks implement a name and a per-batch handler."""

    name: str

    def handle_batch(self, df: DataFrame, batch_id: int) -> None: ...


def _write_log(df: DataFrame, path: str, run: str, batch_id: int) -> None:
    """Append one batch of a run to a partitioned log, replacing it on replay."""
    (df.withColumn("_run", F.lit(run)).withColumn("_batch_id", F.lit(int(batch_id)).cast("bigint"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_run", "_batch_id").parquet(path))


class _Compacting:
    """Optional periodic compaction: after every ``compact_every`` batches the
    sink folds its tables' logs into snapshots, so reads stay incremental."""

    tables: tuple = ()
    compact_every: int | None = None
    #: Set by the pipeline to its query's id: writes of different runs never meet.
    run_id: str = DIRECT

    def _maybe_compact(self, spark: SparkSession, batch_id: int) -> None:
        n = self.compact_every
        if n and (int(batch_id) + 1) % n == 0:
            run_concurrently(*[lambda t=KeyedTable(spark, self.root, name): t.compact() for name in self.tables])


class AlpacaTableSink(_Compacting):
    """SNK-11: one micro-batch of frames -> ``bars``, ``quotes``, ``trades`` (and
    ``frame_rejects``) in one pass: the batch is persisted once, each table is a
    filtered write of it, then it is released.

    ``policy`` = ``abort_rest`` (SNK-12, the reference's behaviour: in each frame,
    rows after the first unwritable one are lost) or ``skip_row`` (SNK-13).
    """

    name = "alpaca-tables"
    tables = ("bars", "quotes", "trades")

    def __init__(self, root: str, policy: str = "abort_rest", compact_every: int | None = None, subscriptions=None):
        """``subscriptions`` (``{channel: [symbols]}`` or a DataFrame of pairs) keeps only
        the subscribed messages (SRC-3)."""
        self.root, self.policy, self.compact_every = root, policy, compact_every
        self.subscriptions = subscriptions

    def _capture(self, spark: SparkSession, df: DataFrame, batch_id: int) -> DataFrame:
        """SRC-2 in the stream: a close or error frame ends its connection, in this
        micro-batch and in every later one. Ends are kept in ``conn_ends`` (one row for
        each ended connection, folded as it grows). This batch's are written first and read
        back with the earlier ones: Spark then knows their size when it plans, and joins
        the frames where they are, without a shuffle by connection."""
        from marketlake.sources import frames as SF

        state = FoldedState(f"{self.root}/conn_ends", ["conn"], "_end")
        ends = (df.filter(F.col("kind").isin(*SF.END_KINDS)).groupBy("conn")
                .agg(F.min("frame_no").alias("_end")))
        state.write(ends, self.run_id, batch_id)
        return SF.text_until(df, state.upto(spark, ends.schema, self.run_id, int(batch_id)), "conn")

    def handle_batch(self, df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        require_utc(spark)
        # The landed batch is read once: the connection cut reads it twice.
        held = [raw := df.persist()]
        try:
            df = self._capture(spark, raw, batch_id) if "kind" in df.columns and "conn" in df.columns else raw
            if "conn" not in df.columns:
                df = df.withColumn("conn", F.lit(None).cast("string"))
            # Parse once per micro-batch: the checked frames (validity + elements) are
            # cached, and of each table its typed rows, which the cut, the table and the rejects read.
            held.append(checked := FR.check_frames(df).persist())
            cuts = None
            keep = [c for c in df.columns if c != "body"]
            rejects = checked.filter(F.col("_reason").isNotNull()).select("conn", "frame_no", "body",
                                                                          F.col("_reason").alias("reason"))
            writes = [lambda: _write_log(rejects, f"{self.root}/frame_rejects", self.run_id, batch_id)]
            msgs = (checked.filter(F.col("_reason").isNull())
                    .select(*keep, F.posexplode("_elements").alias("pos", "msg"))
                    .withColumn("pos", F.col("pos").cast("bigint"))
                    .withColumn("kind", F.try_variant_get("msg", "$.T", "string"))
                    .filter(F.col("kind").isin(*FR.DATA_TAGS)))
            if self.subscriptions is not None:
                from marketlake.sources import frames as SF
                msgs = SF.subscription_filter(msgs, self.subscriptions)
            parts = {"bars": (R.bars_rows(FR.bars(msgs)), 0), "quotes": (R.quotes_rows(FR.quotes(msgs)), 1),
                     "trades": (R.trades_rows(FR.trades(msgs)), 2)}
            parts = {name: (rows.persist(), order) for name, (rows, order) in parts.items()}
            held += [rows for rows, _ in parts.values()]
            bad = None
            for name, (rows, order) in parts.items():
                b = rows.filter(F.col("_error").isNotNull()).select(
                    "conn", "frame_no", "pos", F.lit(name).alias("table"), F.lit(order).alias("t"),
                    F.col("_error").alias("reason"))
                bad = b if bad is None else bad.unionByName(b)
            # A frame is one connection's: frame numbers of different connections overlap.
            frame = ["conn", "frame_no"]
            lost = bad.drop("t")
            if self.policy == "abort_rest":
                # One small row per frame that has an unwritable row; cached for the writes.
                cuts = bad.groupBy(*frame).agg(F.min(F.struct("t", F.col("pos").alias("p"))).alias("_cut")).persist()
                held.append(cuts)
                lost = None
            for name, (rows, order) in parts.items():
                if cuts is not None:
                    rank = F.struct(F.lit(order).alias("t"), F.col("pos").alias("p"))
                    c = cuts.select(F.col("conn").alias("_c"), F.col("frame_no").alias("_f"), "_cut")
                    marked = (rows.join(c, F.col("conn").eqNullSafe(F.col("_c")) & (F.col("frame_no") == F.col("_f")), "left")
                              .drop("_c", "_f"))
                    stays = F.col("_cut").isNull() | (rank < F.col("_cut"))
                    kept = marked.filter(stays & F.col("_error").isNull()).drop("_cut")
                    gone = marked.filter(~stays).select(
                        "conn", "frame_no", "pos", F.lit(name).alias("table"),
                        F.coalesce("_error", F.lit("after an unwritable row")).alias("reason"))
                    lost = gone if lost is None else lost.unionByName(gone)
                else:
                    kept = rows.filter(F.col("_error").isNull())
                writes.append(lambda t=KeyedTable(spark, self.root, name), d=kept.drop("_error"):
                              t.write_batch(d, batch_id, ["frame_no", "conn", "pos"], self.run_id))
            # Every row that no table takes is recorded with its reason.
            writes.append(lambda: _write_log(lost, f"{self.root}/row_rejects", self.run_id, batch_id))
            run_concurrently(*writes)
            self._maybe_compact(spark, batch_id)
        finally:
            for df in reversed(held):
                df.unpersist()


FAILURE = "batch_id bigint, sink string, error string"


class PipelineHandle:
    """STR-6: the running feed. ``wait()`` returns when a finite source is drained;
    a source or sink failure is kept on the handle (STR-5), not lost."""

    def __init__(self, query: StreamingQuery, failure_log: str):
        self.query = query
        self.failure_log = failure_log
        self.error: Exception | None = None

    def failed_batches(self) -> DataFrame:
        """STR-4: ``(batch_id, sink, error)`` of the batches this run passed over, from its log."""
        spark = SparkSession.active()
        rows = read_if_any(spark, self.failure_log)
        if rows is None:
            return spark.createDataFrame([], FAILURE)
        return rows.filter(F.col("_run").cast("string") == F.lit(str(self.query.id))).select("batch_id", "sink", "error")

    def wait(self, timeout: float | None = None) -> PipelineHandle:
        try:
            self.query.awaitTermination(timeout)
        except Exception as e:  # noqa: BLE001 — StreamingQueryException and friends
            self.error = e
        return self

    def drain(self) -> PipelineHandle:
        """For a continuously triggered query: process all that is available, then stop."""
        try:
            self.query.processAllAvailable()
        except Exception as e:  # noqa: BLE001
            self.error = e
        finally:
            self.query.stop()
        return self

    def stop(self) -> None:
        self.query.stop()

    def progress(self) -> list[dict]:
        return [p for p in self.query.recentProgress]


class PipelineBuilder:
    """STR-1: fluent builder over ``readStream -> foreachBatch -> start()``."""

    def __init__(self, spark: SparkSession, source: Source, sink: Sink):
        self.spark, self.source, self.sink = spark, source, sink
        self._capacity: int | None = 1000
        self._on_error = "fail"
        self._trigger: dict = {"availableNow": True}
        self._checkpoint: str | None = None
        self._name: str | None = None
        self._failure_log: str | None = None

    def channel_capacity(self, n: int | None) -> PipelineBuilder:
        """STR-2: at most ``n`` admission units (files) per micro-batch; Spark pulls,
        so the producer can never run ahead of the sink."""
        self._capacity = n
        return self

    def on_sink_error(self, mode: str) -> PipelineBuilder:
        """STR-4: ``fail`` (default: the query stops; a restart replays the batch from
        the checkpoint) or ``continue`` (warn, record the batch, go on, no retry)."""
        if mode not in ("fail", "continue"):
            raise ValueError(mode)
        self._on_error = mode
        return self

    def trigger(self, **kw) -> PipelineBuilder:
        """STR-6/7: ``availableNow=True`` drains a finite source and ends;
        ``processingTime='5 seconds'`` polls at a fixed pace."""
        self._trigger = kw
        return self

    def failure_log(self, path: str) -> PipelineBuilder:
        """With ``on_sink_error("continue")``: where each failed batch is a row
        ``(batch_id, sink, error)`` (else beside the checkpoint)."""
        self._failure_log = path
        return self

    def checkpoint(self, path: str) -> PipelineBuilder:
        """Where the stream keeps its progress (a shared folder; required)."""
        self._checkpoint = path
        return self

    def name(self, name: str) -> PipelineBuilder:
        self._name = name
        return self

    def start(self) -> PipelineHandle:
        if not self._checkpoint:
            raise ValueError("a pipeline needs checkpoint(path): it is what makes a restart go on instead of starting over")
        stream = self.source(self.spark, self._capacity)
        sink, on_error = self.sink, self._on_error
        log_path = self._failure_log or self._checkpoint.rstrip("/") + "-failed"

        def run(df: DataFrame, batch_id: int) -> None:
            try:
                sink.handle_batch(df, batch_id)
            except Exception as e:  # noqa: BLE001
                if on_error == "fail":
                    raise
                record = df.sparkSession.createDataFrame([(int(batch_id), sink.name, str(e))], FAILURE)
                _write_log(record.coalesce(1), log_path, str(query[0].id), batch_id)

        started = threading.Event()
        query: list[StreamingQuery] = []

        def named(df: DataFrame, batch_id: int) -> None:
            started.wait()
            if hasattr(sink, "run_id"):
                sink.run_id = str(query[0].id)  # the same after a restart from the checkpoint
            run(df, batch_id)

        w = stream.writeStream.foreachBatch(named).option("checkpointLocation", self._checkpoint).trigger(**self._trigger)
        if self._name:
            w = w.queryName(self._name)
        query.append(w.start())
        started.set()
        return PipelineHandle(query[0], log_path)


def pipeline(spark: SparkSession, source: Source, sink: Sink) -> PipelineBuilder:
    return PipelineBuilder(spark, source, sink)


class StatementTableSink(_Compacting):
    """Fetch units ``(seq, kind, status, body)`` -> the three statement tables and
    ``calendar_dates`` (insert-ignore), with the skip-row policy of the reference
    (bad rows are reported in ``statement_rejects``), and failed fetches in
    ``fetch_errors``. One cached pass per micro-batch.

    ``fetch_policy`` (SRC-9): ``skip`` (a failed unit is recorded, the rest go on)
    or ``fail`` (the first failed unit in ``seq`` order ends the source: it and
    every later unit, in this micro-batch and all later ones, are not loaded; the
    cut is kept in a small ``fetch_cut`` table)."""

    name = "statement-tables"
    tables = ("quarterly_income_statements", "quarterly_balance_sheets", "quarterly_cashflow_statements",
              "calendar_dates")

    def __init__(self, root: str, compact_every: int | None = None, symbols: DataFrame | None = None,
                 fetch_policy: str = "skip"):
        """``symbols`` (a ``load_symbols`` result) keeps only the listed symbols (SRC-8)."""
        if fetch_policy not in ("skip", "fail"):
            raise ValueError(fetch_policy)
        self.root, self.compact_every, self.symbols = root, compact_every, symbols
        self.fetch_policy = fetch_policy

    def _cut(self, spark: SparkSession, units: DataFrame, batch_id: int) -> DataFrame:
        """``fail``: drop units at or after the first failed one (earlier batches included)."""
        from marketlake.sources import statements as ST

        state = FoldedState(f"{self.root}/fetch_cut", [], "_cut")
        first = units.filter(F.col("status") != "ok").agg(F.min("seq").alias("_cut"))
        state.write(first, self.run_id, batch_id)
        earlier = state.before(spark, first.schema, self.run_id, int(batch_id))
        if earlier is not None:
            cut = earlier.scalar()
            units = units.filter(cut.isNull() | (F.col("seq") < cut))
        return ST.cut_at_first_failure(units, ["seq"])

    def handle_batch(self, df: DataFrame, batch_id: int) -> None:
        from marketlake.sources import statements as ST

        spark = df.sparkSession
        require_utc(spark)
        if self.symbols is not None:
            df = ST.symbol_scan(df, self.symbols)
        base = ST.check_units(df).persist()  # read once; the fail cut reads it again
        units = self._cut(spark, base, batch_id) if self.fetch_policy == "fail" else base
        try:
            # Failures are taken before the cut, which removes the failed unit itself.
            writes = [lambda: _write_log(ST.fetch_errors(base), f"{self.root}/fetch_errors", self.run_id, batch_id)]
            ok = ST.fetch_ok(units)
            rejects = None
            for kind in ST.STATEMENT_KINDS:
                rows = R.statement_rows(ST.scan_statements(ok, kind), kind)
                table = KeyedTable(spark, self.root, R.STATEMENT_TABLES[kind][0])
                writes.append(lambda t=table, d=R.valid(rows): t.write_batch(d, batch_id, ["seq", "pos"], self.run_id))
                bad = R.invalid(rows).select("seq", "pos", F.lit(kind).alias("kind"), F.col("_error").alias("reason"))
                rejects = bad if rejects is None else rejects.unionByName(bad)
            cal = ST.calendar_unpivot(ST.scan_calendar(ok).drop("kind", "status"))
            cal = R.apply_constraints("calendar_dates", cal)
            rejects = rejects.unionByName(R.invalid(cal).select("seq", F.col("ord").alias("pos"), F.lit("calendar").alias("kind"),
                                                                F.col("_error").alias("reason")))
            writes.append(lambda: _write_log(rejects, f"{self.root}/statement_rejects", self.run_id, batch_id))
            table = KeyedTable(spark, self.root, "calendar_dates")
            writes.append(lambda: table.write_batch(R.valid(cal), batch_id, ["seq", "ord"], self.run_id))
            run_concurrently(*writes)
            self._maybe_compact(spark, batch_id)
        finally:
            base.unpersist()


class MarketTableSink(_Compacting):
    """Landed pages ``(walk_id, page_no, body)`` -> ``polymarket_markets`` (upsert,
    last arrival wins) and ``market_rejects``.

    A walk ends at its first page without a usable cursor. The stop page of each
    walk is kept in ``walk_stops`` (one row per walk, folded as it grows); later pages
    of a stopped walk are dropped in every later micro-batch. Pages walked and raw markets
    seen (AGG-1) are rows of the log ``ingest_counters``, one for each micro-batch."""

    name = "market-tables"
    tables = ("polymarket_markets",)

    def __init__(self, root: str, compact_every: int | None = None):
        self.root, self.compact_every = root, compact_every

    def counters(self, spark: SparkSession) -> DataFrame | None:
        """AGG-1: ``(pages, raw_markets, _run, _batch_id)`` of the batches written so far."""
        return read_if_any(spark, f"{self.root}/ingest_counters")

    def handle_batch(self, df: DataFrame, batch_id: int) -> None:
        from marketlake.sources import pages as P

        spark = df.sparkSession
        require_utc(spark)
        state = FoldedState(f"{self.root}/walk_stops", ["walk_id"], "_last")
        pages = df
        earlier = state.before(spark, "walk_id bigint, _last bigint", self.run_id, int(batch_id))
        if earlier is not None:
            pages = (pages.join(earlier.withColumnRenamed("_last", "_prev"), on="walk_id", how="left")
                     .filter(F.col("_prev").isNull() | (F.col("page_no") <= F.col("_prev"))).drop("_prev"))
        pages = P.parse_pages(pages).persist()  # the parsed pages: every write reads them from the cache
        try:
            # AGG-1 in the stream: counted while the batch is written (no extra job).
            obs = Observation(f"ingest-{int(batch_id)}")
            walked = P.walked_pages(pages).observe(
                obs, F.count(F.lit(1)).alias("pages"),
                F.coalesce(F.sum("raw_markets"), F.lit(0)).cast("bigint").alias("raw_markets"))
            stops = P.walk_stops(pages).filter(F.col("_last").isNotNull())
            raw = P.raw_markets(walked)
            markets = R.market_rows(P.typed_markets(raw))
            table = KeyedTable(spark, self.root, "polymarket_markets")
            # Pages and elements that do not parse, and markets that the table's constraints refuse.
            refused = R.invalid(markets).select("walk_id", "page_no", "pos", F.to_json(F.struct("condition_id")).alias("body"),
                                                F.col("_error").alias("reason"))
            rejects = (P.market_rejects(raw).select(*refused.columns).unionByName(refused)
                       .unionByName(P.page_rejects(pages)))
            run_concurrently(
                lambda: table.write_batch(R.valid(markets), batch_id, ["walk_id", "page_no", "pos"], self.run_id),
                lambda: _write_log(rejects, f"{self.root}/market_rejects", self.run_id, batch_id),
                lambda: state.write(stops, self.run_id, batch_id))
            seen = spark.createDataFrame([(obs.get["pages"], obs.get["raw_markets"])], "pages bigint, raw_markets bigint")
            _write_log(seen.coalesce(1), f"{self.root}/ingest_counters", self.run_id, batch_id)
            self._maybe_compact(spark, batch_id)
        finally:
            pages.unpersist()
