"""The stream's sink on feeds of one connection: no task holds them whole, each row is made once."""

import json

from pyspark.sql import functions as F

from marketlake.operators import frames as FR
from marketlake.operators import rows as R
from marketlake.session import scratch_dir
from marketlake.sources import frames as SF
from marketlake.streaming import pipeline as P
from marketlake.streaming.tables import KeyedTable

BAR = {"T": "b", "S": "A", "o": 1.0, "h": 2.0, "l": 0.5, "c": 1.5, "v": 10.0, "t": "2024-01-01T00:00:00Z"}


def feed(spark, n, ends=()):
    """``n`` frames of a bar each; of connection c0, but every tenth of none at all."""
    body = F.concat(F.lit("["), F.replace(F.lit(json.dumps(BAR)), F.lit('"A"'), F.concat(F.lit('"A'), F.col("id"), F.lit('"'))), F.lit("]"))
    kind = F.when(F.col("id").isin(list(ends)), "close").otherwise("text") if ends else F.lit("text")
    return spark.range(0, n, 1, 4).select(F.when(F.col("id") % 10 > 0, "c0").alias("conn"), F.col("id").alias("frame_no"),
                                          kind.alias("kind"), body.alias("body"))


def in_partitions(df):
    return sorted(r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect())


def test_frames_of_one_connection_without_an_end_are_not_one_tasks(spark):
    out = SF.capture_until_close(feed(spark, 4000))
    parts = in_partitions(out)
    assert sum(parts) == 4000 and len(parts) > 1 and parts[-1] < 2000
    nobody = SF.capture_until_close(feed(spark, 4000).withColumn("conn", F.lit(None).cast("string")))
    parts = in_partitions(nobody)
    assert sum(parts) == 4000 and parts[-1] < 2000
    cut = SF.capture_until_close(feed(spark, 4000, ends=[1001, 2010]))
    want = {k for k in range(4000) if k % 10 == 0 and k != 2010 or k < 1001}
    assert {r.frame_no for r in cut.collect()} == want


def test_stream_cut_leaves_frames_where_they_are(spark, monkeypatch):
    seen = []
    check = FR.check_frames
    monkeypatch.setattr(P.FR, "check_frames", lambda df: seen.append(in_partitions(df)) or check(df))
    root = scratch_dir(spark, "tables")
    sink = P.AlpacaTableSink(root)
    sink.handle_batch(feed(spark, 4000), 0)
    assert seen == [[1000] * 4]
    sink.handle_batch(feed(spark, 4000, ends=[1001]).withColumn("frame_no", F.col("frame_no") + 4000), 1)
    sink.handle_batch(feed(spark, 4000).withColumn("frame_no", F.col("frame_no") + 8000), 2)
    assert [sum(x) for x in seen] == [4000, 1001 + 299, 400]
    sink.handle_batch(feed(spark, 4000, ends=[1001]).withColumn("frame_no", F.col("frame_no") + 4000), 1)  # a replay
    assert sum(seen[-1]) == 1300


def test_each_table_row_is_made_once_a_batch(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(error):
        made.add(1)
        return error

    rows = R.bars_rows
    monkeypatch.setattr(P.R, "bars_rows", lambda df: rows(df).withColumn("_error", counted("_error")))
    root = scratch_dir(spark, "tables")
    P.AlpacaTableSink(root).handle_batch(feed(spark, 200), 0)
    assert KeyedTable(spark, root, "bars").read().count() == 200
    assert made.value == 200
