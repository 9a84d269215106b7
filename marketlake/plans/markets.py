"""Plans over landed market-listing pages: walk, unnest, type, upsert."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.operators import keyed, rows
from marketlake.operators.counters import ingest_counters, page_counters
from marketlake.plans import fixtures as fx
from marketlake.session import require_utc
from marketlake.sources import pages as P

SEQ = ["walk_id", "page_no", "pos"]


def walked(spark, sf_dir):
    return P.walked_pages(fx.fx_pages(spark, sf_dir))


def raw(spark, sf_dir):
    return P.raw_markets(walked(spark, sf_dir))


def _comparable(df):
    """VARIANT columns as single scalar paths (JSON text differs by engine)."""
    return (df.withColumn("token0_price", F.try_variant_get("tokens", "$[0].price", "double"))
            .withColumn("tokens_null", F.is_variant_null("tokens"))
            .withColumn("rewards_null", F.is_variant_null("rewards"))
            .withColumn("tags_null", F.is_variant_null("tags"))
            .drop("tokens", "rewards", "tags"))


def q_paged_markets(spark, sf_dir):
    """SRC-4: raw market elements of the pages the cursor walk reads."""
    return raw(spark, sf_dir).select(*SEQ, F.try_variant_get("m", "$.condition_id", "string").alias("condition_id"))


def q_ingest_counters(spark, sf_dir):
    """AGG-1: pages walked and raw markets per walk."""
    return ingest_counters(walked(spark, sf_dir))


def q_page_counters(spark, sf_dir):
    """AGG-1: raw and valid markets per walked page."""
    return page_counters(raw(spark, sf_dir))


def q_markets_typed(spark, sf_dir):
    """PRJ-9: typed markets with defaults."""
    return _comparable(P.typed_markets(raw(spark, sf_dir)))


def q_market_rejects(spark, sf_dir):
    """FLT-3: markets skipped, the rest of the page kept."""
    return P.market_rejects(raw(spark, sf_dir)).select(*SEQ, "reason")


def market_rows(spark, sf_dir):
    require_utc(spark)
    return rows.market_rows(P.typed_markets(raw(spark, sf_dir)))


def q_market_rows(spark, sf_dir):
    """PRJ-13 / SCL-6: table columns with three lenient time stamps."""
    return _comparable(market_rows(spark, sf_dir))


def q_sink_markets(spark, sf_dir):
    """SNK-6: upsert on condition_id, the last arrival replaces every column."""
    return _comparable(keyed.upsert(rows.valid(market_rows(spark, sf_dir)), ["condition_id"], SEQ))


def q_upsert(spark, sf_dir):
    """SNK-3 general operator: which arrival each key ends with."""
    return keyed.upsert(rows.valid(market_rows(spark, sf_dir)), ["condition_id"], SEQ).select("condition_id", *SEQ)
