"""Text files read as numbered lines, however they are split.

Spark cuts a large text file into blocks and reads each in a task; within a block the
lines come in order. A line's number in its file is the number of lines in the blocks
before its own plus its place in the block. The blocks' line counts are one row a block
(partially aggregated in the tasks that read them), their running sums a window over the
blocks of a file: no sort over lines, and no task has to read a whole file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(file, file_time, line_no, line)`` of the text files at ``path``: lines end at a
    line feed (a carriage return before it is dropped) and count from 0 in each file.
    Columns that folder names spell (``name=value``) follow. Batch reads only."""
    text = spark.read.option("lineSep", "\n").text(path)
    folders = [c for c in text.columns if c != "value"]
    lines = text.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_modification_time").alias("file_time"),
        F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_id"),
        F.regexp_replace("value", "\r$", "").alias("line"), *folders)
    # Ids rise with the lines of a block, and are the same in both scans of the same splits.
    blocks = lines.groupBy("file", "_block").agg(F.min("_id").alias("_first"), F.count(F.lit(1)).alias("_n"))
    before = F.sum("_n").over(Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1))
    starts = blocks.select("file", "_block", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"))
    return lines.join(starts, ["file", "_block"]).select(
        "file", "file_time", (F.col("_id") + F.col("_shift")).cast("bigint").alias("line_no"), "line", *folders)
