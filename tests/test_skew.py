"""Hot keys: one key (or one batch / connection) holding a third of all rows.

Results must equal a brute-force computation, and the plans must cut the hot
group down before the shuffle (partial top-1 / partial aggregation)."""

from pyspark.sql import functions as F

from marketlake.operators import keyed, policies
from marketlake.plans import fixtures as fx
from marketlake.sources import frames as SF

from conftest import SF_SMALL

SF_MID = "/root/testdata/sf0.01"


def _events(spark):
    ev = fx.table(spark, SF_MID, "events")
    # a third of all rows share one key
    return ev.withColumn("k", F.when(F.col("event_id") % 3 == 0, F.lit("HOT"))
                         .otherwise(F.concat(F.lit("U"), F.col("user_id").cast("string"))))


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_insert_ignore_with_hot_key(spark):
    ev = _events(spark)
    out = keyed.insert_ignore(ev, ["k"], ["event_id"])
    assert "WindowGroupLimit" in _plan(out) and "Partial" in _plan(out)
    got = {r.k: r.event_id for r in out.select("k", "event_id").collect()}
    brute = {r.k: r.m for r in ev.groupBy("k").agg(F.min("event_id").alias("m")).collect()}
    assert got == brute and got["HOT"] == 0


def test_upsert_with_hot_key(spark):
    ev = _events(spark)
    out = keyed.upsert(ev, ["k"], ["event_id"])
    got = {r.k: r.event_id for r in out.select("k", "event_id").collect()}
    brute = {r.k: r.m for r in ev.groupBy("k").agg(F.max("event_id").alias("m")).collect()}
    assert got == brute


def test_abort_rest_with_hot_batch(spark):
    ev = _events(spark).withColumn("batch", F.when(F.col("k") == "HOT", F.lit(-1)).otherwise((F.col("event_id") / 20).cast("bigint")))
    rows = ev.select("batch", "event_id", F.when(F.col("event_id") % 37 == 0, F.lit("bad")).alias("_error"))
    out = policies.abort_rest(rows, ["batch"], ["event_id"])
    assert "partial_min" in _plan(out)
    got = sorted(r.event_id for r in out.collect())
    cut = {r.batch: r.c for r in rows.filter("_error IS NOT NULL").groupBy("batch")
           .agg(F.min("event_id").alias("c")).collect()}
    brute = sorted(r.event_id for r in rows.collect() if r.batch not in cut or r.event_id < cut[r.batch])
    assert got == brute


def test_capture_with_hot_connection(spark):
    raw = fx.fx_capture(spark, SF_SMALL).withColumn(
        "conn", F.when(F.col("frame_no") % 3 == 0, F.lit(-1)).otherwise(F.col("conn")))
    out = SF.capture_until_close(raw)
    assert "partial_min" in _plan(out)
    rows = raw.collect()
    ends = {}
    for r in rows:
        if r.kind in ("close", "error"):
            ends[r.conn] = min(ends.get(r.conn, r.frame_no), r.frame_no)
    brute = sorted(r.frame_no for r in rows if r.kind == "text" and (r.conn not in ends or r.frame_no < ends[r.conn]))
    assert sorted(r.frame_no for r in out.collect()) == brute
