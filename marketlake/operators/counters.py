"""Ingest counters (AGG-1, AGG-2).

Counts that belong to one frame or one page are computed inside its array, so
they need no shuffle; counts over a walk are a ``groupBy`` with map-side
partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import jsontypes as J
from marketlake.operators import frames as FR


def batch_split_counts(frames: DataFrame, body: str = "body") -> DataFrame:
    """AGG-2: per accepted frame (one frame is one batch), the bars, quotes and
    trades it splits into. Computed in the frame's array: no shuffle."""
    checked = FR.check_frames(frames, body).filter(F.col("_reason").isNull())
    keep = [c for c in frames.columns if c != body]

    def n(tag):
        return F.size(F.filter("_elements", lambda x: J.get(x, "T", "string") == tag)).cast("bigint")
    return checked.select(*keep, n(FR.TAG_BAR).alias("n_bars"), n(FR.TAG_QUOTE).alias("n_quotes"),
                          n(FR.TAG_TRADE).alias("n_trades"))


def arrival_order(frames: DataFrame, body: str = "body") -> DataFrame:
    """ORD-1: write rank of each data message inside its batch: bars first, then
    quotes, then trades, each in frame order. Sorted inside the array: no shuffle."""
    checked = FR.check_frames(frames, body).filter(F.col("_reason").isNull())
    keep = [c for c in frames.columns if c != body]
    type_order = {FR.TAG_BAR: 0, FR.TAG_QUOTE: 1, FR.TAG_TRADE: 2}

    def tagged(x, i):
        tag = J.get(x, "T", "string")
        rank = F.when(tag == FR.TAG_BAR, type_order[FR.TAG_BAR]).when(
            tag == FR.TAG_QUOTE, type_order[FR.TAG_QUOTE]).when(tag == FR.TAG_TRADE, type_order[FR.TAG_TRADE])
        return F.struct(rank.alias("type_order"), i.cast("bigint").alias("pos"), tag.alias("kind"))
    data = F.filter(F.transform("_elements", tagged), lambda s: s["type_order"].isNotNull())
    return (checked.select(*keep, F.posexplode(F.array_sort(data)).alias("i", "m"))
            .select(*keep, "m.pos", "m.kind", (F.col("i") + 1).cast("bigint").alias("write_rank")))


def ingest_counters(pages: DataFrame) -> DataFrame:
    """AGG-1: per walk, the pages walked and the raw markets seen (valid or not).

    ``pages`` are the walked pages (after the cursor cut) with ``raw_markets``.
    """
    return (pages.groupBy("walk_id")
            .agg(F.count(F.lit(1)).alias("pages_walked"),
                 F.sum(F.coalesce("raw_markets", F.lit(0))).cast("bigint").alias("raw_markets")))


def page_counters(raw: DataFrame) -> DataFrame:
    """AGG-1 per page: raw and valid markets of each walked page that has a data
    array (one partial-aggregated groupBy on (walk, page))."""
    return (raw.groupBy("walk_id", "page_no")
            .agg(F.count(F.lit(1)).alias("raw_markets"),
                 F.count_if(F.col("valid")).alias("valid_markets")))
