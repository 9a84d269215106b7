"""Landed websocket frames -> bars / quotes / trades tables, as a stream.

    python examples/ingest_frames.py <landed_frames_dir> <tables_root> [files_per_batch]

The landed folder holds JSON lines ``{"conn", "frame_no", "kind", "body"}``
written by a collector; the tables are keyed Parquet logs under tables_root.
"""

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from marketlake.session import get_session  # noqa: E402
from marketlake.sources.frames import read_frames_stream  # noqa: E402
from marketlake.streaming.pipeline import AlpacaTableSink, pipeline  # noqa: E402
from marketlake.streaming.tables import KeyedTable, init_schema  # noqa: E402


def main(landed: str, root: str, capacity: int = 1000) -> None:
    spark = get_session()
    init_schema(spark, root, ["bars", "quotes", "trades"])
    src = lambda s, cap: read_frames_stream(s, landed, max_files_per_trigger=cap)
    handle = pipeline(spark, src, AlpacaTableSink(root)).channel_capacity(capacity).checkpoint(f"{root}/_checkpoint").start().wait()
    if handle.error:
        raise SystemExit(f"pipeline failed: {handle.error}")
    for name in ("bars", "quotes", "trades"):
        t = KeyedTable(spark, root, name)
        t.compact()
        print(name, t.read().count())


if __name__ == "__main__":
    main(sys.argv[1], sys.argv[2], int(sys.argv[3]) if len(sys.argv) > 3 else 1000)
