"""Landed market-listing pages -> polymarket_markets (upsert), as a stream.

    python examples/ingest_markets.py <landed_pages_dir> <tables_root>

Pages are JSON lines ``{"walk_id", "page_no", "body"}``; a walk stops after its
first page without a usable cursor, across micro-batches too.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import get_session  # noqa: E402
from marketlake.sources.pages import read_pages_stream  # noqa: E402
from marketlake.streaming.pipeline import MarketTableSink, pipeline  # noqa: E402
from marketlake.streaming.tables import KeyedTable  # noqa: E402


def main(landed: str, root: str) -> None:
    spark = get_session()
    handle = pipeline(spark, lambda s, cap: read_pages_stream(s, landed, max_files_per_trigger=cap),
                      MarketTableSink(root)).checkpoint(f"{root}/_checkpoint").start().wait()
    if handle.error:
        raise SystemExit(f"pipeline failed: {handle.error}")
    print("polymarket_markets", KeyedTable(spark, root, "polymarket_markets").read().count())


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2])
