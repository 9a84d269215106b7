"""Plans over landed Alpaca-style frames: parse, dispatch, typed rows, tables.

Each ``q_*`` takes ``(spark, sf_dir)`` and returns a DataFrame. Arrival order
is ``(frame_no, pos)``; outputs keep it as columns so results are comparable
without relying on physical row order.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import scalars as S
from marketlake.operators import frames as FR
from marketlake.operators import keyed, rows
from marketlake.operators.counters import arrival_order, batch_split_counts
from marketlake.plans import fixtures as fx
from marketlake.session import require_utc

SEQ = ["frame_no", "pos"]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    require_utc(spark)
    return FR.parse_frames(fx.fx_frames(spark, sf_dir))


def _list_text(c: str):
    """ARRAY<STRING> rendered as text for comparison (NULL stays NULL)."""
    return F.when(F.col(c).isNotNull(), F.concat(F.lit("["), F.array_join(c, ","), F.lit("]"))).alias(c)


def q_parse_frames(spark, sf_dir):
    """PRJ-1: one row per message of the accepted frames."""
    return messages(spark, sf_dir).select(*SEQ, "kind")


def q_dispatch_kinds(spark, sf_dir):
    """PRJ-2: messages per tag."""
    return messages(spark, sf_dir).groupBy("kind").agg(F.count(F.lit(1)).alias("n"))


def q_frame_rejects(spark, sf_dir):
    """FLT-2: frames dropped whole."""
    return FR.frame_rejects(fx.fx_frames(spark, sf_dir)).select("frame_no", "reason")


def q_data_messages(spark, sf_dir):
    """FLT-1: bars, quotes and trades only."""
    return FR.data_messages(messages(spark, sf_dir)).select(*SEQ, "kind")


def q_msg_success(spark, sf_dir):
    return FR.successes(messages(spark, sf_dir))


def q_msg_error(spark, sf_dir):
    return FR.errors(messages(spark, sf_dir))


def q_msg_subscription(spark, sf_dir):
    s = FR.subscriptions(messages(spark, sf_dir))
    return s.select(*SEQ, *[_list_text(name) for _, name in FR.SUBSCRIPTION_LISTS])


def q_bars_typed(spark, sf_dir):
    b = FR.bars(messages(spark, sf_dir))
    return b.withColumn("trade_count", F.col("trade_count").cast("bigint"))


def q_quotes_typed(spark, sf_dir):
    q = FR.quotes(messages(spark, sf_dir))
    return q.select(*[(_list_text(c) if c == "conditions" else F.col(c)) for c in q.columns])


def q_trades_typed(spark, sf_dir):
    t = FR.trades(messages(spark, sf_dir))
    return t.select(*[(_list_text(c) if c == "conditions" else F.col(c)) for c in t.columns]).withColumn(
        "trade_id", F.col("trade_id").cast("bigint"))


def bars_rows(spark, sf_dir):
    return rows.bars_rows(FR.bars(messages(spark, sf_dir)))


def quotes_rows(spark, sf_dir):
    return rows.quotes_rows(FR.quotes(messages(spark, sf_dir)))


def trades_rows(spark, sf_dir):
    return rows.trades_rows(FR.trades(messages(spark, sf_dir)))


def q_bars_rows(spark, sf_dir):
    return bars_rows(spark, sf_dir)


def q_quotes_rows(spark, sf_dir):
    return quotes_rows(spark, sf_dir)


def q_trades_rows(spark, sf_dir):
    return trades_rows(spark, sf_dir)


def q_bar_metrics(spark, sf_dir):
    """SCL-1/2 on typed bars."""
    b = FR.bars(messages(spark, sf_dir))
    return rows.bar_metrics(b).select(*SEQ, "price_change", "price_change_percent")


def q_quote_metrics(spark, sf_dir):
    """SCL-3/4 on typed quotes."""
    q = FR.quotes(messages(spark, sf_dir))
    return rows.quote_metrics(q).select(*SEQ, "spread", "spread_bps")


def sink_bars(spark, sf_dir):
    """SNK-4: insert-ignore on (symbol, timestamp), first arrival wins."""
    r = rows.valid(bars_rows(spark, sf_dir))
    return keyed.insert_ignore(r, ["symbol", "timestamp"], SEQ)


def q_sink_bars(spark, sf_dir):
    return sink_bars(spark, sf_dir)


def q_sink_trades(spark, sf_dir):
    """SNK-5: insert-ignore on (trade_id, symbol)."""
    r = rows.valid(trades_rows(spark, sf_dir))
    return keyed.insert_ignore(r, ["trade_id", "symbol"], SEQ)


def q_sink_quotes(spark, sf_dir):
    """SNK-1: append, every valid quote row."""
    return rows.valid(quotes_rows(spark, sf_dir))


def q_insert_ignore(spark, sf_dir):
    """SNK-2 general operator, on bars keyed by (symbol, timestamp)."""
    return q_sink_bars(spark, sf_dir).select("symbol", "timestamp", *SEQ)


def q_flagship(spark, sf_dir):
    """First-arrival bar per (symbol, minute stamp) with its price move (SCL-1/2)."""
    return rows.bar_metrics(sink_bars(spark, sf_dir))


def q_batch_split_counts(spark, sf_dir):
    """AGG-2: per frame (= batch), messages of each data variant."""
    return batch_split_counts(fx.fx_frames(spark, sf_dir))


def q_arrival_order(spark, sf_dir):
    """ORD-1: write rank inside each batch: bars, then quotes, then trades, each in frame order."""
    return arrival_order(fx.fx_frames(spark, sf_dir))


def q_ts_strict(spark, sf_dir):
    """SCL-5: strict RFC 3339; rows that fail are rejects (ok = false, value NULL)."""
    require_utc(spark)
    t = fx.fx_times(spark, sf_dir)
    return t.select("seq", S.ts_strict("value").alias("ts"), S.ts_strict_ok("value").alias("ok"))


def q_ts_lenient(spark, sf_dir):
    """SCL-6: lenient parse, failure -> NULL."""
    require_utc(spark)
    return fx.fx_times(spark, sf_dir).select("seq", S.ts_lenient("value").alias("ts"))
