"""Streaming plans: the same operators as the batch plans, run as micro-batches.

Each query lands fx_frames as files in a fresh folder under the shared
checkpoint directory, runs a pipeline over them to completion and returns the
resulting table. The batch and streaming results must be equal (their oracles
are the batch ones).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.operators import frames as FR
from marketlake.plans import fixtures as fx
from marketlake.session import require_utc, scratch_dir
from marketlake.sources import custom
from marketlake.sources import frames as SF
from marketlake.sources.pages import PAGE_SCHEMA
from marketlake.sources.statements import UNIT_SCHEMA
from marketlake.streaming.pipeline import AlpacaTableSink, pipeline
from marketlake.streaming.tables import KeyedTable, init_schema

BAR_COLS = ["symbol", "open", "high", "low", "close", "volume", "timestamp", "trade_count", "vwap"]


#: Rows of one landed file, once there are more than a file an arrival.
ROWS_PER_FILE = 20_000
#: Arrivals into which a landed input is cut: the feed's clock. Files in an arrival follow the input.
ARRIVALS = 8


def land(rows: DataFrame, path: str, order: list[str], n_rows: int) -> str:
    """Write ``rows`` as a collector would: JSON lines in folders ``arrival=<number>`` (a
    column of ``rows``) of ``path``, as many files in each as its rows ask for."""
    (rows.repartitionByRange(max(ARRIVALS, -(-n_rows // ROWS_PER_FILE)), "arrival", *order).sortWithinPartitions("arrival", *order)
     .write.mode("append").partitionBy("arrival").json(path))
    return path


def land_frames(spark, sf_dir, broken: int | None = None, misnamed: int | None = None) -> str:
    """Write fx_frames as landed frames ``(conn, frame_no, kind, body)``. Which frames
    arrive together is known exactly: arrival = frame_no * ARRIVALS // frames. The frames
    of arrival ``broken`` land with a text where their number should be; those of arrival
    ``misnamed`` with the name of a connection that has no table."""
    f = fx.fx_frames(spark, sf_dir)
    path = scratch_dir(spark, "landed")
    n = f.agg(F.max("frame_no") + 1).first()[0]
    arrival = F.floor(F.col("frame_no") * ARRIVALS / F.lit(n)).cast("int")
    rows = f.select(F.when(arrival == F.lit(misnamed), "elsewhere").otherwise("c0").alias("conn"), "frame_no",
                    F.lit(SF.TEXT_KIND).alias("kind"), "body", arrival.alias("arrival"))
    if broken is not None:
        land(rows.filter(F.col("arrival") == broken).withColumn("frame_no", F.lit("broken")), path, ["body"], n)
        rows = rows.filter(F.col("arrival") != broken)
    return land(rows, path, ["frame_no"], n)


def file_source(path: str):
    return lambda spark, capacity: SF.read_frames_stream(spark, path, max_files_per_trigger=capacity)


def bars_table(spark, root: str) -> DataFrame:
    t = KeyedTable(spark, root, "bars").read()
    return t.select(F.col("_seq.frame_no").alias("frame_no"), F.col("_seq.pos").alias("pos"), *BAR_COLS)


def run_alpaca(spark, sf_dir, capacity=2, sink=None, on_error="fail", root=None, landed=None, trigger=None):
    """Run the Alpaca pipeline over landed fx_frames. With a ``capacity`` that many arrivals
    are admitted in a micro-batch, in order of arrival; without one, Spark's own file
    source takes all that landed."""
    require_utc(spark)
    root = root or scratch_dir(spark, "tables")
    init_schema(spark, root, ["bars", "quotes", "trades"])
    landed, checkpoint = landed or land_frames(spark, sf_dir), scratch_dir(spark, "checkpoint")
    source = file_source(landed) if capacity is None else custom.arrival_source(landed, checkpoint)
    b = pipeline(spark, source, sink or AlpacaTableSink(root)).checkpoint(checkpoint).on_sink_error(on_error)
    b = b.channel_capacity(capacity)
    if capacity is None:
        return root, b.start().wait()
    return root, b.trigger(**(trigger or {"processingTime": "0 seconds"})).start().drain()


def q_pipeline_run(spark, sf_dir):
    """STR-1/3/6 + SNK-4: landed frames -> micro-batches -> bars table (first arrival
    wins)."""
    root, handle = run_alpaca(spark, sf_dir, capacity=None)
    if handle.error:
        raise handle.error
    return bars_table(spark, root)


def q_fan_out(spark, sf_dir):
    """SNK-11: one pass per micro-batch writes the three tables."""
    root, handle = run_alpaca(spark, sf_dir, capacity=None)
    if handle.error:
        raise handle.error
    counts = [KeyedTable(spark, root, n).read().agg(F.count(F.lit(1)).alias("n_rows"))
              .select(F.lit(n).alias("table_name"), "n_rows") for n in ("bars", "quotes", "trades")]
    return counts[0].unionByName(counts[1]).unionByName(counts[2])


def q_write_metadata(spark, sf_dir):
    """SNK-10: surrogate id and write time on every row: rows, different ids, rows
    with a write time, per table."""
    root, handle = run_alpaca(spark, sf_dir, capacity=None)
    if handle.error:
        raise handle.error
    out = None
    for name in ("bars", "quotes", "trades"):
        one = KeyedTable(spark, root, name).read().agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
            F.count("received_at").alias("n_received"))
        out = one if out is None else out.unionByName(one)
    return out


def q_init_schema(spark, sf_dir):
    """SNK-9: bootstrap is idempotent and keeps what is there. The event rows as market
    ids land between two bootstraps of the same root; every table answers."""
    root = scratch_dir(spark, "tables")
    first = init_schema(spark, root)
    _, handle = run_alpaca(spark, sf_dir, capacity=None, root=root)
    if handle.error:
        raise handle.error
    again = init_schema(spark, root)
    out = None
    for name in first:
        t = KeyedTable(spark, root, name)
        one = t.read().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("table_name"), F.lit(name in again and t.exists()).alias("made_again"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


def q_two_runs(spark, sf_dir):
    """SNK-1/2, STR-1: two runs with their own checkpoints add to the same root, with a
    compaction between them; the second brings another connection with the same
    frame numbers. Rows of the quotes and bars tables."""
    root = scratch_dir(spark, "tables")
    landed = land_frames(spark, sf_dir)
    for conn in ("c0", "c1"):
        src = lambda s, cap, c=conn: SF.read_frames_stream(s, landed, max_files_per_trigger=cap).withColumn("conn", F.lit(c))
        h = pipeline(spark, src, AlpacaTableSink(root)).checkpoint(scratch_dir(spark, "checkpoint")).start().wait()
        if h.error:
            raise h.error
        for name in ("bars", "quotes"):
            KeyedTable(spark, root, name).compact()
    quotes, bars = KeyedTable(spark, root, "quotes").read(), KeyedTable(spark, root, "bars").read()
    return quotes.agg(F.lit("quotes").alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
                      F.count_distinct("_seq.conn").alias("n_conns")).unionByName(
        bars.agg(F.lit("bars").alias("table_name"), F.count(F.lit(1)).alias("n_rows"), F.count_distinct("id").alias("n_ids"),
                 F.count_distinct("_seq.conn").alias("n_conns")))


class RowCounter:
    """A user sink: input rows of each micro-batch into its own table."""

    name = "row-counter"

    def __init__(self, path: str):
        self.path = path

    def handle_batch(self, df, batch_id):
        (df.agg(F.count(F.lit(1)).alias("input_rows")).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path))


def q_bounded_admission(spark, sf_dir):
    """STR-2: at most ``capacity`` arrivals per micro-batch (eight arrivals, capacity 2), in
    the order of their numbers: the rows of each batch as its sink saw them."""
    path = scratch_dir(spark, "admitted")
    _, handle = run_alpaca(spark, sf_dir, capacity=2, sink=RowCounter(path))
    if handle.error:
        raise handle.error
    return spark.read.parquet(path).select(F.col("batch_id").cast("bigint").alias("batch_id"), "input_rows")


def q_paced_polling(spark, sf_dir):
    """STR-7: the same feed polled at a fixed pace (a trigger every second, two arrivals
    each) until it is drained."""
    root, h = run_alpaca(spark, sf_dir, capacity=2, trigger={"processingTime": "1 second"})
    if h.error:
        raise h.error
    return bars_table(spark, root)


def q_subscribed_run(spark, sf_dir):
    """SRC-3 in the pipeline: only subscribed bars reach the table."""
    from marketlake.plans.sources import subscriptions

    root = scratch_dir(spark, "tables")
    _, handle = run_alpaca(spark, sf_dir, capacity=None, root=root,
                           sink=AlpacaTableSink(root, subscriptions=subscriptions(spark, sf_dir)))
    if handle.error:
        raise handle.error
    return bars_table(spark, root)


class NamedConnectionSink:
    """A user sink for connections that are known by name: a batch with a frame of any
    other cannot be written, and nothing of it is."""

    name = "named-connections"

    def __init__(self, inner, names: list[str]):
        self.inner, self.names = inner, names

    def handle_batch(self, df, batch_id):
        unknown = F.concat(F.lit("no table for connection "), "conn")
        df.agg(F.max(F.when(~F.col("conn").isin(self.names), F.raise_error(unknown)))).collect()
        self.inner.handle_batch(df, batch_id)


def q_sink_failure_continue(spark, sf_dir):
    """STR-4: a batch whose frames name a connection that the sink has no table for is
    recorded and passed over (no retry); the others land."""
    root = scratch_dir(spark, "tables")
    _, handle = run_alpaca(spark, sf_dir, sink=NamedConnectionSink(AlpacaTableSink(root), ["c0"]), on_error="continue", root=root,
                           landed=land_frames(spark, sf_dir, misnamed=3))
    if handle.error:
        raise handle.error
    failed = handle.failed_batches()
    return bars_table(spark, root).select("*", failed.agg(F.count(F.lit(1))).scalar().alias("n_failed"),
                                          failed.agg(F.max("batch_id")).scalar().alias("failed_batch"))


def q_custom_source(spark, sf_dir):
    """SRC-10: a user-written streaming source (Python Data Source API) feeding the
    same sink, two arrivals per micro-batch."""
    root, handle = run_alpaca(spark, sf_dir, capacity=2)
    if handle.error:
        raise handle.error
    return bars_table(spark, root)


def q_source_failure_drain(spark, sf_dir):
    """STR-5: the source fails reading its 4th arrival, which is not what it should be
    (one arrival per micro-batch); the batches already handed over stay written and
    the failure is kept on the handle instead of being lost."""
    root, handle = run_alpaca(spark, sf_dir, capacity=1, landed=land_frames(spark, sf_dir, broken=3))
    return bars_table(spark, root).withColumn("source_failed", F.lit(handle.error is not None))


class KindCounter:
    """SNK-14: a user sink: messages per tag per micro-batch into its own table."""

    name = "kind-counter"

    def __init__(self, path: str):
        self.path = path

    def handle_batch(self, df, batch_id):
        (FR.parse_frames(df.drop("conn", "kind")).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))
         .withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id")
         .parquet(self.path))


def q_custom_sink(spark, sf_dir):
    """SNK-14: per-kind message counts written by a user sink, summed over batches."""
    path = scratch_dir(spark, "kind-counts")
    _, handle = run_alpaca(spark, sf_dir, capacity=4, sink=KindCounter(path))
    if handle.error:
        raise handle.error
    return spark.read.parquet(path).groupBy("kind").agg(F.sum("n").alias("n"))


# ---------------------------------------------------------------- the other two pipelines


def _land(df, spark, name: str, order: list[str]) -> str:
    """Land ``df`` in as many arrivals, in order of ``order``."""
    df = df.persist()
    try:
        n = df.count()
        first, last = df.agg(F.min(order[0]), F.max(order[0])).first()
        width = max(1, -(-((last or 0) - (first or 0) + 1) // ARRIVALS))
        return land(df.withColumn("arrival", F.floor((F.col(order[0]) - F.lit(first)) / width).cast("int")), scratch_dir(spark, name), order, n)
    finally:
        df.unpersist()


def run_statements(spark, sf_dir, capacity=2):
    from marketlake.plans import statements as PS
    from marketlake.streaming.pipeline import StatementTableSink
    require_utc(spark)
    cal = PS.calendar_units(spark, sf_dir).select(
        (F.col("seq") + F.lit(1 << 40)).alias("seq"), "kind", F.get_json_object("body", "$.symbol").alias("symbol"),
        "status", "body")
    units = PS.statement_units(spark, sf_dir).select("seq", "kind", "symbol", "status", "body").unionByName(cal)
    landed = _land(units, spark, "landed-units", ["seq"])
    root, checkpoint = scratch_dir(spark, "tables"), scratch_dir(spark, "checkpoint")
    b = pipeline(spark, custom.arrival_source(landed, checkpoint, UNIT_SCHEMA), StatementTableSink(root)).channel_capacity(capacity)
    return root, b.checkpoint(checkpoint).trigger(processingTime="0 seconds").start().drain()


def q_pipeline_statements(spark, sf_dir):
    """Statements pipeline as a stream: fetch units -> income table (insert-ignore, skip-row)."""
    root, h = run_statements(spark, sf_dir)
    if h.error:
        raise h.error
    t = KeyedTable(spark, root, "quarterly_income_statements").read()
    return t.select(F.col("_seq.seq").alias("seq"), F.col("_seq.pos").alias("pos"), "symbol", "period_date",
                    "total_revenue", "gross_profit", "operating_income", "net_income")


def q_pipeline_calendar(spark, sf_dir):
    """Calendar dates written by the statements pipeline stream (insert-ignore)."""
    root, h = run_statements(spark, sf_dir)
    if h.error:
        raise h.error
    t = KeyedTable(spark, root, "calendar_dates").read()
    return t.select((F.col("_seq.seq") - F.lit(1 << 40)).alias("seq"), F.col("_seq.ord").alias("ord"),
                    "symbol", "date_type", "date_utc")


def q_pipeline_markets(spark, sf_dir):
    """Market pages as a stream: walk cut kept across micro-batches -> upsert table."""
    from marketlake.plans.markets import _comparable
    from marketlake.streaming.pipeline import MarketTableSink
    require_utc(spark)
    landed = _land(fx.fx_pages(spark, sf_dir), spark, "landed-pages", ["walk_id", "page_no"])
    root = scratch_dir(spark, "tables")
    checkpoint = scratch_dir(spark, "checkpoint")
    h = (pipeline(spark, custom.arrival_source(landed, checkpoint, PAGE_SCHEMA), MarketTableSink(root)).channel_capacity(2)
         .checkpoint(checkpoint).trigger(processingTime="0 seconds").start().drain())
    if h.error:
        raise h.error
    t = KeyedTable(spark, root, "polymarket_markets").read()
    cols = [c for c in t.columns if c not in ("id", "received_at", "_at", "_run", "_batch_id", "_seq")]
    return _comparable(t.select(F.col("_seq.walk_id").alias("walk_id"), F.col("_seq.page_no").alias("page_no"),
                                F.col("_seq.pos").alias("pos"), *cols))


def q_stream_counters(spark, sf_dir):
    """AGG-1 in the stream: pages walked and raw markets seen, from the log that the
    sink writes a row to for each micro-batch."""
    from marketlake.streaming.pipeline import MarketTableSink
    require_utc(spark)
    landed = _land(fx.fx_pages(spark, sf_dir), spark, "landed-pages", ["walk_id", "page_no"])
    sink, checkpoint = MarketTableSink(scratch_dir(spark, "tables")), scratch_dir(spark, "checkpoint")
    h = (pipeline(spark, custom.arrival_source(landed, checkpoint, PAGE_SCHEMA), sink).channel_capacity(4)
         .checkpoint(checkpoint).trigger(processingTime="0 seconds").start().drain())
    if h.error:
        raise h.error
    return sink.counters(spark).agg(F.sum("pages").cast("bigint").alias("pages_walked"),
                                    F.sum("raw_markets").cast("bigint").alias("raw_markets"))
