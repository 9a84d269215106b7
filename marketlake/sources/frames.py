"""Landed websocket frames (SRC-1..3).

Landed form: ``(conn, frame_no, kind, body)`` — one row per received frame,
``kind`` in text, binary, ping, pong, frame, close, error — written by a
collector as JSON lines or Parquet. ``frame_no`` is the arrival number the
collector stamped; it is the arrival order (never the file order).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketlake.functions import jsontypes as J
from marketlake.operators import frames as FR
from marketlake.sources.lines import numbered_lines

FRAME_SCHEMA = T.StructType([
    T.StructField("conn", T.StringType()), T.StructField("frame_no", T.LongType()),
    T.StructField("kind", T.StringType()), T.StructField("body", T.StringType()),
])

# Frame kinds that end a capture, and the one that carries data.
END_KINDS = ("close", "error")
TEXT_KIND = "text"


def read_frames(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """SRC-1 (batch): landed frames with a declared schema (no inference)."""
    if fmt == "parquet":
        return spark.read.schema(FRAME_SCHEMA).parquet(path)
    return spark.read.schema(FRAME_SCHEMA).json(path)


def read_frames_stream(spark: SparkSession, path: str, fmt: str = "json",
                       max_files_per_trigger: int | None = None) -> DataFrame:
    """SRC-1 (stream): the same, as a streaming DataFrame; one landed file is one
    admission unit (STR-2 bounds the files per micro-batch)."""
    r = spark.readStream.schema(FRAME_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.format(fmt).load(path)


def read_frame_lines(spark: SparkSession, path: str) -> DataFrame:
    """SRC-1 for raw text captures (one frame per line, no stamp): ``conn`` is the file,
    ``frame_no`` falls back to (file time, file, line number); batch reads only."""
    lines = numbered_lines(spark, path)
    own = [c for c in lines.columns if c not in ("file", "file_time", "line_no", "line")]
    number = F.struct(F.col("file_time").alias("_mtime"), F.col("file").alias("_file"), F.col("line_no").alias("_line"))
    return lines.select(F.col("file").alias("conn"), number.alias("frame_no"), F.lit(TEXT_KIND).alias("kind"),
                        F.col("line").alias("body"), *own)


def capture_until_close(raw: DataFrame, conn: str = "conn", seq: str = "frame_no", kind: str = "kind") -> DataFrame:
    """SRC-2: text frames of each connection that arrived before its first close or
    error frame; binary, ping, pong and raw frames are skipped.

    The end of each connection is a ``groupBy(conn).agg(min)`` (partially aggregated
    before the shuffle) joined back. It has a row for every connection, ended or not: AQE
    broadcasts it when small and splits a connection that carries a large share of the
    frames (skew join) otherwise, but a join with no rows on one side it takes away, and
    then leaves all frames of a connection, shuffled for it, to one task.
    """
    end = F.when(F.col(conn).isNotNull() & F.col(kind).isin(*END_KINDS), F.col(seq))
    ends = raw.groupBy(F.col(conn).alias("_conn")).agg(F.min(end).alias("_end"))
    return text_until(raw, ends, F.col(conn).eqNullSafe(F.col("_conn")), seq, kind).drop("_conn")


def text_until(raw: DataFrame, ends: DataFrame, on, seq: str = "frame_no", kind: str = "kind") -> DataFrame:
    """The text frames that arrived before the ``_end`` of their connection, if it has one."""
    return (raw.filter(F.col(kind) == TEXT_KIND).join(ends, on=on, how="left")
            .filter(F.col("_end").isNull() | (F.col(seq) < F.col("_end"))).drop("_end"))


# Message tag -> subscription channel.
CHANNEL_OF_TAG = ((FR.TAG_BAR, "bars"), (FR.TAG_QUOTE, "quotes"), (FR.TAG_TRADE, "trades"))


#: Subscribed pairs (a few dozen bytes each) up to which a given list is broadcast.
BROADCAST_PAIRS = 100_000


def subscription_filter(messages: DataFrame, subs) -> DataFrame:
    """SRC-3: keep data messages whose (channel, symbol) was subscribed; an empty
    channel list means none of that channel; control messages pass through.

    ``subs`` is a DataFrame ``(channel, symbol)`` or a dict ``channel -> [symbols]``.
    A dict of at most ``BROADCAST_PAIRS`` pairs is broadcast; anything else is left
    to AQE, which broadcasts it once it has measured it small.
    One left join, not a union of two branches, so frames are parsed once;
    control messages get a key that matches nothing and still spreads over the
    partitions (not one NULL key in one task).
    """
    small = False
    if isinstance(subs, dict):
        data = [(ch, s) for ch, syms in subs.items() for s in syms]
        small = len(data) <= BROADCAST_PAIRS
        subs = messages.sparkSession.createDataFrame(data, "channel string, symbol string")
    keys = (subs.select(F.col("channel").alias("_ch"), F.col("symbol").alias("_sym"))
            .distinct().withColumn("_hit", F.lit(True)))
    if small:  # the hint sits directly under the join, where Spark applies it
        keys = F.broadcast(keys)
    chan = None
    for tag, ch in CHANNEL_OF_TAG:
        chan = (F.when(F.col("kind") == tag, F.lit(ch)) if chan is None
                else chan.when(F.col("kind") == tag, F.lit(ch)))
    is_data = F.col("kind").isin(*FR.DATA_TAGS)
    keyed = messages.withColumns({
        "_ch": F.when(is_data, chan).otherwise(F.concat(F.lit("~"), F.col("kind"))),
        "_sym": F.when(is_data, J.get(F.col("msg"), "S", "string")).otherwise(F.xxhash64(*[c for c in messages.columns if c != "msg"]).cast("string")),
    })
    return (keyed.join(keys, on=["_ch", "_sym"], how="left")
            .filter(~is_data | F.col("_hit").isNotNull())
            .drop("_ch", "_sym", "_hit"))
