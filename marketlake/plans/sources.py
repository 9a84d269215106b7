"""Plans for the frame capture, subscription, landed scan and error policies."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketlake.functions import scalars as SC
from marketlake.operators import policies
from marketlake.plans import alpaca
from marketlake.plans import fixtures as fx
from marketlake.session import require_utc
from marketlake.sources import frames as SF


def q_capture_until_close(spark, sf_dir):
    """SRC-2: text frames of each connection before its first close/error frame."""
    return SF.capture_until_close(fx.fx_capture(spark, sf_dir)).select("conn", "frame_no", "body")


def subscriptions(spark, sf_dir):
    """Subscribed (channel, symbol) pairs, from the customer table."""
    c = fx.table(spark, sf_dir, "customer")
    sym = F.concat(F.lit("U"), F.col("c_custkey"))
    return (c.filter(F.col("c_custkey") % 3 == 0).select(F.lit("bars").alias("channel"), sym.alias("symbol"))
            .unionByName(c.filter(F.col("c_custkey") % 3 == 1).select(F.lit("quotes").alias("channel"),
                                                                      sym.alias("symbol")))
            .unionByName(c.filter(F.col("c_custkey") % 2 == 0).select(F.lit("trades").alias("channel"),
                                                                      sym.alias("symbol"))))


def q_subscription_filter(spark, sf_dir):
    """SRC-3: data messages of subscribed (channel, symbol) pairs, control messages kept."""
    return SF.subscription_filter(alpaca.messages(spark, sf_dir), subscriptions(spark, sf_dir)).select(
        "frame_no", "pos", "kind")


def q_scan_frames(spark, sf_dir):
    """SRC-1: landed frames read back with a declared schema: one row per frame."""
    from marketlake.plans.streams import land_frames
    f = SF.read_frames(spark, land_frames(spark, sf_dir))
    return f.select("frame_no", "kind", F.json_array_length("body").cast("bigint").alias("n_elements"))


def policy_rows(spark, sf_dir):
    require_utc(spark)
    p = fx.fx_policy(spark, sf_dir).filter(F.col("kind").isin("purchase", "view", "click"))  # FLT-1
    return p.select("batch", "type_order", "seq", "symbol", "value", SC.ts_strict("timestamp").alias("timestamp"),
                    F.when(~SC.ts_strict_ok("timestamp"), F.lit("bad timestamp")).alias("_error"))


def q_policy_abort_rest(spark, sf_dir):
    """SNK-12: rows before the first bad row of each batch."""
    return policies.abort_rest(policy_rows(spark, sf_dir), ["batch"], ["type_order", "seq"])


def q_policy_skip_row(spark, sf_dir):
    """SNK-13: every writable row."""
    return policies.skip_row(policy_rows(spark, sf_dir))


def land_lines(lines, folder: str, line_sep: str = "\n") -> str:
    """Write texts ``(folder, place, line)`` as a collector would: one file a folder, its
    lines in order; as many files as the input has folders."""
    from marketlake.session import scratch_dir

    path = scratch_dir(lines.sparkSession, "landed-lines")
    (lines.repartition(folder).sortWithinPartitions(folder, "place").select(folder, "line")
     .write.mode("overwrite").partitionBy(folder).option("lineSep", line_sep).text(path))
    return path


def q_scan_frame_lines(spark, sf_dir):
    """SRC-1 for raw text captures: frames landed one per line (no stamp), read back with
    their line numbers and parsed."""
    from marketlake.operators import frames as FR

    lines = SF.read_frame_lines(spark, land_lines(fx.fx_raw_lines(spark, sf_dir), "capture"))
    bodies = lines.select(F.col("capture").cast("bigint").alias("capture"), F.col("frame_no._line").alias("line_no"),
                          F.col("body").alias("text"), "body")
    msgs = FR.errors(FR.parse_frames(bodies))
    return msgs.select("capture", "line_no", F.col("text").alias("body"), "msg")
