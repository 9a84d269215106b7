"""

    python tools/measure.py [sf_dir] [cpus] [reps]

The payloads (fx_frames, fx_pages) are landed once as Parquet under the
shared checkpoint folder, so the timings cover the ingest work only, not the
fixture derivation. Prints one JSON line:
frames/s parsed and validated (PRJ-1 + FLT-2), bar rows/s through insert-ignore
(SNK-2/4), market rows/s through upsert (SNK-3/6), and the median micro-batch
duration of the frame pipeline. Scaling: run it with cpus 1, 2, 4, 8.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from marketlake.operators import frames as FR  # noqa: E402
from marketlake.operators import keyed, rows  # noqa: E402
from marketlake.plans import fixtures as fx  # noqa: E402
from marketlake.plans import streams  # noqa: E402
from marketlake.session import get_session, scratch_dir  # noqa: E402
from marketlake.sources import pages as P  # noqa: E402
from marketlake.streaming.pipeline import AlpacaTableSink, pipeline  # noqa: E402


def timed(df, reps):
    out = []
    for _ in range(reps):
        t0 = time.perf_counter()
        df.write.format("noop").mode("overwrite").save()
        out.append(time.perf_counter() - t0)
    return statistics.median(out)


def main(argv):
    sf_dir = argv[1] if len(argv) > 1 else "/root/testdata/sf0.1"
    cpus = int(argv[2]) if len(argv) > 2 else 8
    reps = int(argv[3]) if len(argv) > 3 else 3
    spark = get_session(f"local[{cpus}]", app="marketlake-measure", shuffle_partitions=max(4, 2 * cpus))
    land = scratch_dir(spark, "measure")
    fx.fx_frames(spark, sf_dir).write.parquet(f"{land}/frames")
    fx.fx_pages(spark, sf_dir).write.parquet(f"{land}/pages")
    frames = spark.read.parquet(f"{land}/frames")
    pages = spark.read.parquet(f"{land}/pages")
    n_frames = frames.count()

    checked = FR.check_frames(frames).select("frame_no", "_reason", F.size("_elements").alias("n"))
    t_parse = timed(checked, reps)

    bar_rows = rows.valid(rows.bars_rows(FR.bars(FR.parse_frames(frames))))
    n_bars = bar_rows.count()
    t_ii = timed(keyed.insert_ignore(bar_rows, ["symbol", "timestamp"], ["frame_no", "pos"]), reps)

    markets = rows.valid(rows.market_rows(P.typed_markets(P.raw_markets(P.walked_pages(pages)))))
    n_markets = markets.count()
    t_up = timed(keyed.upsert(markets, ["condition_id"], ["walk_id", "page_no", "pos"]), reps)

    landed = streams.land_frames(spark, sf_dir)
    h = (pipeline(spark, streams.file_source(landed), AlpacaTableSink(scratch_dir(spark, "tables")))
         .channel_capacity(2).checkpoint(scratch_dir(spark, "checkpoint")).start().wait())
    durations = [p["durationMs"]["triggerExecution"] for p in h.progress() if p["numInputRows"]]

    print(json.dumps({
        "sf_dir": sf_dir, "cpus": cpus, "reps": reps, "spark": spark.version,
        "frames": n_frames, "frames_per_sec_parse_validate": round(n_frames / t_parse),
        "bar_rows": n_bars, "bar_rows_per_sec_insert_ignore": round(n_bars / t_ii),
        "market_rows": n_markets, "market_rows_per_sec_upsert": round(n_markets / t_up),
        "micro_batches": len(durations),
        "micro_batch_ms_median": statistics.median(durations) if durations else None,
        "pipeline_error": str(h.error) if h.error else None,
    }))


if __name__ == "__main__":
    main(sys.argv)
