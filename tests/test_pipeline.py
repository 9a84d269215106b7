"""The reference's pipeline tests on Structured Streaming, and batch == stream."""

import json
import os

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from marketlake.plans import alpaca, streams
from marketlake.session import scratch_dir
from marketlake.sources import custom
from marketlake.sources import frames as SF
from marketlake.sources.pages import read_pages_stream
from marketlake.sources.statements import read_units_stream
from marketlake.streaming.pipeline import pipeline

from conftest import SF_SMALL


def _land(spark, batches):
    """One JSON-lines file per batch, file times in batch order."""
    path = scratch_dir(spark, "landed")
    local = path[len("file:"):] if path.startswith("file:") else path
    n = 0
    for i, bodies in enumerate(batches):
        f = os.path.join(local, f"part-{i:05d}.json")
        with open(f, "w") as fh:
            for b in bodies:
                fh.write(json.dumps({"conn": "c", "frame_no": n, "kind": "text", "body": b}) + "\n")
                n += 1
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    return path


class Recorder:
    name = "recorder"

    def __init__(self, fail_first=False):
        self.seen, self.calls, self.fail_first = [], 0, fail_first

    def handle_batch(self, df, batch_id):
        self.calls += 1
        if self.fail_first and self.calls == 1:
            raise RuntimeError("sink down")
        self.seen.append((batch_id, [r.body for r in df.orderBy("frame_no").collect()]))


def test_order_and_completeness(spark):
    path = _land(spark, [["alpha", "beta"], ["gamma"]])
    rec = Recorder()
    h = pipeline(spark, streams.file_source(path), rec).channel_capacity(1).checkpoint(scratch_dir(spark, "ckpt")).start().wait()
    assert h.error is None
    assert rec.seen == [(0, ["alpha", "beta"]), (1, ["gamma"])]


def test_continue_after_sink_error(spark):
    path = _land(spark, [["first"], ["second"]])
    rec = Recorder(fail_first=True)
    h = (pipeline(spark, streams.file_source(path), rec).channel_capacity(1).on_sink_error("continue")
         .checkpoint(scratch_dir(spark, "ckpt")).start().wait())
    assert h.error is None and rec.calls == 2
    assert rec.seen == [(1, ["second"])]
    assert [(r.batch_id, r.sink) for r in h.failed_batches().collect()] == [(0, "recorder")]


def test_failed_batches_are_logged(spark):
    path = _land(spark, [["first"], ["second"]])
    log = scratch_dir(spark, "failed")
    h = (pipeline(spark, streams.file_source(path), Recorder(fail_first=True)).channel_capacity(1)
         .on_sink_error("continue").failure_log(log).checkpoint(scratch_dir(spark, "ckpt")).start().wait())
    assert h.error is None
    rows = spark.read.parquet(log).collect()
    assert [(r.batch_id, r.sink, r.error) for r in rows] == [(0, "recorder", "sink down")]


def _arrive(path, number, *files):
    """Land files of frames (or one of broken text) as an arrival."""
    local = path[len("file:"):] if path.startswith("file:") else path
    folder = os.path.join(local, f"arrival={number}")
    os.makedirs(folder, exist_ok=True)
    for k, bodies in enumerate(files):
        with open(os.path.join(folder, f"part-{k:05d}.json"), "w") as fh:
            fh.write(bodies if isinstance(bodies, str) else "".join(json.dumps(
                {"conn": "c", "frame_no": 10 * number + i, "kind": "text", "body": b}) + "\n" for i, b in enumerate(bodies)))


def _feed(path, ckpt, rec, capacity):
    return (pipeline(SparkSession.active(), custom.arrival_source(path, ckpt), rec).channel_capacity(capacity)
            .trigger(processingTime="0 seconds").checkpoint(ckpt).start().drain())


def test_source_failure_keeps_earlier_batches(spark):
    path, rec = scratch_dir(spark, "landed"), Recorder()
    _arrive(path, 0, ["only"])
    _arrive(path, 1, '{"conn": "c", "frame_no": "not a number"}\n')
    h = _feed(path, scratch_dir(spark, "ckpt"), rec, 1)
    assert h.error is not None
    assert rec.seen == [(0, ["only"])]


def test_arrivals_are_admitted_in_order_and_a_restart_goes_on(spark):
    """Order is the arrival's number, not a file's time or name; the bound holds after a
    restart; nothing is read twice and the source keeps no file of its own."""
    path, ckpt, rec = scratch_dir(spark, "landed"), scratch_dir(spark, "ckpt"), Recorder()
    assert custom.planned(ckpt) is None
    for n, files in ((10, [["e"]]), (2, [["b", "c"], ["d"]]), (0, [["a"], []])):
        _arrive(path, n, *files)
    assert _feed(path, ckpt, rec, 2).error is None
    assert [b for _, b in rec.seen] == [["a", "b", "c", "d"], ["e"]] or [sorted(b) for _, b in rec.seen] == [list("abcd"), ["e"]]
    assert custom.planned(ckpt) == 10
    for n in (11, 12, 13, 14, 15):
        _arrive(path, n, [f"n{n}"])
    assert _feed(path, ckpt, rec, 2).error is None
    assert [sorted(b) for _, b in rec.seen[2:]] == [["n11", "n12"], ["n13", "n14"], ["n15"]]
    assert _feed(path, ckpt, rec, 2).error is None and len(rec.seen) == 5
    # Without a bound all that landed is one batch; a batch read takes it all.
    free = Recorder()
    assert _feed(f"file://{path.removeprefix('file:')}", scratch_dir(spark, "ckpt"), free, None).error is None
    assert [len(b) for _, b in free.seen] == [10]
    assert spark.read.format(custom.register(spark)).option("path", path).load().count() == 10
    with pytest.raises(Exception):
        spark.readStream.format(custom.register(spark)).option("path", path).option("maxArrivalsPerTrigger", 1).load() \
            .writeStream.format("noop").start().processAllAvailable()


def test_stream_equals_batch(spark):
    stream = streams.q_pipeline_run(spark, SF_SMALL)
    batch = alpaca.q_sink_bars(spark, SF_SMALL).select(*stream.columns)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_landed_frames_roundtrip(spark):
    path = streams.land_frames(spark, SF_SMALL)
    assert SF.read_frames(spark, path).count() == alpaca.fx.fx_frames(spark, SF_SMALL).count()


def test_market_walk_stop_kept_across_batches(spark):
    """Pages after a walk's stop page are dropped even when they arrive in a later micro-batch."""
    from marketlake.streaming.pipeline import MarketTableSink
    from marketlake.streaming.tables import KeyedTable

    path = scratch_dir(spark, "pages")
    local = path[len("file:"):] if path.startswith("file:") else path
    pages = [
        (0, '{"data":[{"condition_id":"a","question":"q0"}],"next_cursor":"c1"}'),
        (1, '{"data":[{"condition_id":"a","question":"q1"}],"next_cursor":""}'),
        (2, '{"data":[{"condition_id":"a","question":"q2"},{"condition_id":"b"}],"next_cursor":"c3"}'),
    ]
    for i, (page_no, body) in enumerate(pages):
        f = os.path.join(local, f"part-{i:05d}.json")
        with open(f, "w") as fh:
            fh.write(json.dumps({"walk_id": 1, "page_no": page_no, "body": body}) + "\n")
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    root = scratch_dir(spark, "tables")
    h = (pipeline(spark, lambda s, n: read_pages_stream(s, path, max_files_per_trigger=n), MarketTableSink(root))
         .channel_capacity(1).checkpoint(scratch_dir(spark, "ckpt")).start().wait())
    assert h.error is None
    got = {r.condition_id: r.question for r in KeyedTable(spark, root, "polymarket_markets").read().collect()}
    assert got == {"a": "q1"}


def test_statement_stream_equals_batch(spark):
    from marketlake.plans import statements

    stream = streams.q_pipeline_statements(spark, SF_SMALL)
    batch = statements.q_sink_income(spark, SF_SMALL).select(*stream.columns)
    assert sorted(map(tuple, stream.collect())) == sorted(map(tuple, batch.collect()))


def test_raw_text_capture_keeps_line_order(spark):
    path = scratch_dir(spark, "raw")
    local = path[len("file:"):] if path.startswith("file:") else path
    with open(os.path.join(local, "capture.txt"), "w") as fh:
        fh.write('[{"T":"success","msg":"a"}]\n[{"T":"success","msg":"b"}]\n[{"T":"success","msg":"c"}]\n')
    df = SF.read_frame_lines(spark, path)
    assert [r.body for r in df.orderBy("frame_no").collect()] == [
        '[{"T":"success","msg":"a"}]', '[{"T":"success","msg":"b"}]', '[{"T":"success","msg":"c"}]']


def test_compaction_during_stream_keeps_result(spark):
    from marketlake.streaming.pipeline import AlpacaTableSink
    from marketlake.streaming.tables import KeyedTable, init_schema

    root = scratch_dir(spark, "tables")
    init_schema(spark, root, ["bars", "quotes", "trades"])
    landed = streams.land_frames(spark, SF_SMALL)
    h = (pipeline(spark, streams.file_source(landed), AlpacaTableSink(root, compact_every=2))
         .channel_capacity(2).checkpoint(scratch_dir(spark, "ckpt")).start().wait())
    assert h.error is None
    t = KeyedTable(spark, root, "bars")
    assert t.latest_snapshot() is not None
    got = streams.bars_table(spark, root)
    batch = alpaca.q_sink_bars(spark, SF_SMALL).select(*got.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_market_stream_counts_pages_with_observe(spark):
    from marketlake.operators.counters import ingest_counters
    from marketlake.plans import markets
    from marketlake.streaming.pipeline import MarketTableSink

    pages = markets.fx.fx_pages(spark, SF_SMALL).withColumn("arrival", F.col("page_no"))
    landed = streams.land(pages, scratch_dir(spark, "landed-pages"), ["walk_id"], 1)
    sink = MarketTableSink(scratch_dir(spark, "tables"))
    ckpt = scratch_dir(spark, "ckpt")
    h = (pipeline(spark, custom.arrival_source(landed, ckpt, streams.PAGE_SCHEMA), sink).channel_capacity(2)
         .trigger(processingTime="0 seconds").checkpoint(ckpt).start().drain())
    seen = sink.counters(spark)
    assert h.error is None and seen.select("_batch_id").distinct().count() == seen.count() >= 2
    batch = ingest_counters(markets.walked(spark, SF_SMALL)).agg(F.sum("pages_walked").alias("p"),
                                                                  F.sum("raw_markets").alias("r"))
    pages, raw = batch.collect()[0]
    assert tuple(seen.agg(F.sum("pages"), F.sum("raw_markets")).first()) == (pages, raw)


def _bar(sym):
    return '[{"T":"b","S":"%s","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z"}]' % sym


def test_connection_end_kept_across_batches(spark):
    from marketlake.streaming.pipeline import AlpacaTableSink
    from marketlake.streaming.tables import KeyedTable, init_schema

    path = scratch_dir(spark, "landed")
    local = path[len("file:"):] if path.startswith("file:") else path
    files = [[("A", 0, "text", _bar("A0")), ("A", 1, "close", ""), ("B", 2, "ping", "")],
             [("A", 3, "text", _bar("A3")), ("B", 4, "text", _bar("B4"))]]
    for i, frames in enumerate(files):
        f = os.path.join(local, f"part-{i:05d}.json")
        with open(f, "w") as fh:
            for conn, n, kind, body in frames:
                fh.write(json.dumps({"conn": conn, "frame_no": n, "kind": kind, "body": body}) + "\n")
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    root = scratch_dir(spark, "tables")
    init_schema(spark, root, ["bars", "quotes", "trades"])
    h = pipeline(spark, streams.file_source(path), AlpacaTableSink(root)).channel_capacity(1).checkpoint(scratch_dir(spark, "ckpt")).start().wait()
    assert h.error is None
    assert sorted(r.symbol for r in KeyedTable(spark, root, "bars").read().collect()) == ["A0", "B4"]


def test_malformed_payload_counts_as_failed_fetch(spark):
    from marketlake.sources import statements as ST

    units = spark.createDataFrame(
        [(1, "income", "AAA", "ok", '{"symbol":"AAA","rows":[]}'), (2, "income", "BBB", "ok", '{"symbol": BROKEN'),
         (3, "income", "CCC", "error: timeout", None)],
        "seq bigint, kind string, symbol string, status string, body string")
    checked = ST.check_units(units)
    assert [r.symbol for r in ST.fetch_ok(checked).collect()] == ["AAA"]
    errs = {r.symbol: r.error for r in ST.fetch_errors(checked).collect()}
    assert errs == {"BBB": "error: malformed payload", "CCC": "error: timeout"}


def test_statement_stream_fail_policy_cuts_across_batches(spark):
    from marketlake.streaming.pipeline import StatementTableSink
    from marketlake.streaming.tables import KeyedTable

    def unit(seq, sym, status="ok"):
        body = None if status != "ok" else json.dumps(
            {"symbol": sym, "rows": [{"period": {"kind": "date", "date": "2024-03-31"},
                                      "total_revenue": {"amount": 1.5, "currency": "USD"}}]})
        return {"seq": seq, "kind": "income", "symbol": sym, "status": status, "body": body}
    files = [[unit(1, "A"), unit(2, "B")], [unit(3, "C"), unit(4, "D", "error: timeout"), unit(5, "E")],
             [unit(6, "F")]]
    path = scratch_dir(spark, "units")
    local = path[len("file:"):] if path.startswith("file:") else path
    for i, units in enumerate(files):
        f = os.path.join(local, f"part-{i:05d}.json")
        with open(f, "w") as fh:
            fh.writelines(json.dumps(u) + "\n" for u in units)
        os.utime(f, (1_700_000_000 + i, 1_700_000_000 + i))
    for policy, expect in (("fail", ["A", "B", "C"]), ("skip", ["A", "B", "C", "E", "F"])):
        root = scratch_dir(spark, "tables")
        h = (pipeline(spark, lambda s, n: read_units_stream(s, path, max_files_per_trigger=n),
                      StatementTableSink(root, fetch_policy=policy)).channel_capacity(1).checkpoint(scratch_dir(spark, "ckpt")).start().wait())
        assert h.error is None
        got = sorted(r.symbol for r in KeyedTable(spark, root, "quarterly_income_statements").read().collect())
        assert got == expect, policy


def test_runs_and_connections_add_to_one_table(spark):
    """Two runs into one root with a compaction between; a bad row of one connection
    costs no other connection a row; every refused row is recorded."""
    from marketlake.streaming.pipeline import AlpacaTableSink
    from marketlake.streaming.tables import KeyedTable

    root = scratch_dir(spark, "tables")
    bad = _bar("X").replace("2024-01-01T00:00:00Z", "soon")
    runs = [[("c1", 1, bad), ("c2", 1, _bar("C"))], [("c1", 1, _bar("D")), ("c2", 1, _bar("E"))]]
    for rows in runs:
        path = scratch_dir(spark, "landed")
        local = path[len("file:"):] if path.startswith("file:") else path
        with open(os.path.join(local, "part-0.json"), "w") as fh:
            fh.writelines(json.dumps({"conn": c, "frame_no": n, "kind": "text", "body": b}) + "\n" for c, n, b in rows)
        h = (pipeline(spark, streams.file_source(path), AlpacaTableSink(root)).checkpoint(scratch_dir(spark, "ckpt"))
             .start().wait())
        assert h.error is None
        KeyedTable(spark, root, "bars").compact()
    assert sorted(r.symbol for r in KeyedTable(spark, root, "bars").read().collect()) == ["C", "D", "E"]
    refused = spark.read.parquet(f"{root}/row_rejects").collect()
    assert [(r.conn, r.frame_no, r.pos, r.table, r.reason) for r in refused] == [("c1", 1, 0, "bars", "bad timestamp")]


def test_an_unreadable_table_is_not_an_empty_one(spark):
    import pytest

    from marketlake.streaming.tables import KeyedTable, init_schema

    root = scratch_dir(spark, "tables")
    local = root[len("file:"):] if root.startswith("file:") else root
    KeyedTable(spark, root, "bars").write_batch(
        spark.createDataFrame([("A", 1.0, 1.0, 1.0, 1.0, 1, None, None, None, 0, 0)],
                              "symbol string, open double, high double, low double, close double, volume bigint, "
                              "timestamp timestamp_ntz, trade_count bigint, vwap double, frame_no bigint, pos bigint"), 0,
        ["frame_no", "pos"])
    part = next(os.path.join(d, f) for d, _, fs in os.walk(os.path.join(local, "bars")) for f in fs if f.endswith(".parquet"))
    with open(part, "wb") as fh:
        fh.write(b"not parquet")
    with pytest.raises(Exception):  # noqa: B017
        init_schema(spark, root, ["bars"])
    assert os.path.exists(part)


def test_a_pipeline_needs_a_checkpoint(spark):
    import pytest

    with pytest.raises(ValueError):
        pipeline(spark, streams.file_source("/nowhere"), Recorder()).start()


def test_refused_pages_and_markets_are_recorded(spark):
    from marketlake.streaming.pipeline import MarketTableSink
    from marketlake.streaming.tables import KeyedTable

    bodies = ['{"data":[{"condition_id":"a"},{"condition_id":5},{"condition_id":"%s"}],"next_cursor":"c1"}' % ("x" * 70), "no json"]
    pages = spark.createDataFrame([(1, i, b) for i, b in enumerate(bodies)], "walk_id bigint, page_no bigint, body string")
    root = scratch_dir(spark, "tables")
    MarketTableSink(root).handle_batch(pages, 0)
    assert [r.condition_id for r in KeyedTable(spark, root, "polymarket_markets").read().collect()] == ["a"]
    got = sorted((r.page_no, r.pos, r.reason) for r in spark.read.parquet(f"{root}/market_rejects").fillna({"pos": -1}).collect())
    assert got == [(0, 1, "invalid market"), (0, 2, "condition_id too long"), (1, -1, "malformed page")]


def test_float_and_negative_zero_are_no_unsigned_integers(spark):
    from pyspark.sql import functions as F

    from marketlake.functions import jsontypes as J
    cases = {"12": True, "0": True, "-1": False, "12.0": False, "1234567890123456789.0": False, "9223372036854775807": True,
             "9223372036854775808": True, "18446744073709551615": True, "18446744073709551616": False, "null": False, '"5"': False}
    df = spark.createDataFrame([(k,) for k in cases], "x string").withColumn("v", F.parse_json(F.concat(F.lit('{"i":'), "x", F.lit("}"))))
    got = {r.x: r.ok for r in df.select("x", J.is_u64(F.col("v"), "i").alias("ok")).collect()}
    assert got == cases


def test_page_with_a_repeated_key_keeps_the_walk_going(spark):
    from marketlake.sources import pages as P
    good = '{"data": [{"condition_id": "a"}], "next_cursor": "n"}'
    odd = ['{"data": [], "next_cursor": "", "next_cursor": "n"}', '{"data": [{"x": 1, "x": 2}], "next_cursor": "n"}',
           '{"next_cursor": "n", "next_cursor": ""}', '{"next_cursor": "n", "next_cursor": 5}', '{"x": 1, "x": 2}',
           '{"next_cursor": "n", "x": 1, "x": 2', '{"next_cursor": "n", "x": 1, "x": 2} tail', '{"next_cursor": "n"}, "v": {}', "{no json"]
    rows = [(k, n, odd[k] if n == 1 else good) for k in range(len(odd)) for n in range(4)]
    pages = spark.createDataFrame(rows, P.PAGE_SCHEMA)
    last = {r.walk_id: r._last for r in P.walk_stops(pages).collect()}
    assert last == {0: None, 1: None, 2: 1, 3: 1, 4: 1, 5: 0, 6: 0, 7: 0, 8: 0}
    walked = P.walked_pages(pages)
    assert {r.page_no for r in walked.filter("walk_id < 2 AND page IS NOT NULL").collect()} == {0, 1, 2, 3}
    assert P.raw_markets(walked.filter("walk_id = 0")).count() == 3
    assert {(r.walk_id, r.page_no) for r in P.page_rejects(pages).collect()} == {(k, 1) for k in (5, 6, 7, 8)}


def test_last_of_repeated_keys_counts_at_page_market_and_column(spark):
    """Against Python's reader, which keeps the last of repeated keys too."""
    import json

    from marketlake.sources import pages as P
    page = lambda *markets, more="": '{"data": [' + ", ".join(markets) + '], "next_cursor": "n"' + more + "}"
    bodies = [
        page('{"condition_id": "a"}'), page('{"condition_id": "b", "icon": "old", "icon": "new"}', '{"condition_id": "b2"}'),
        page('{"condition_id": "x", "condition_id": "c", "active": true, "active": false, "seconds_delay": 7}', '"text"', "5", "null", "[]"),
        '{"data": [{"condition_id": "no"}], "data": [{"condition_id": "d"}], "next_cursor": "n"}',
        page('{"condition_id": "e", "tokens": [{"p": 1, "p": 2}, {"p": 3}], "rewards": {"r": [1], "r": [2, {"z": "q"}]}, "tags": ["t", "u"]}'),
        page('{"condition_id": "f", "tags": null, "tags": ["1a", "b"], "unknown": {"k": 1, "k": {"k": 2}}, "minimum_tick_size": 0.25}'),
        page('{"condition_id": "g", "icon": null, "icon": "\\u00e9\\"{", "question": "old", "question": null}', more=', "x": [], "x": {}'),
        page('{"condition_id": "h", "active": null, "icon": "1", "icon": "2"}', '{"condition_id": 5, "icon": "1", "icon": "2"}'),
        '{"data": {"condition_id": "no"}, "x": 1, "x": 2, "next_cursor": "n"}', '{"data": [{"condition_id": "i"}], "data": null, "next_cursor": "n"}']
    pages = spark.createDataFrame([(0, n, b) for n, b in enumerate(bodies)], P.PAGE_SCHEMA)
    raw = P.raw_markets(P.walked_pages(pages)).cache()
    want, valid = {}, {}
    for n, b in enumerate(bodies):
        data = json.loads(b).get("data")
        for pos, m in enumerate(data if isinstance(data, list) else []):
            want[n, pos] = m
            valid[n, pos] = isinstance(m, dict) and isinstance(m.get("condition_id"), str) and m.get("active", False) is not None
    rows = raw.selectExpr("page_no", "pos", "valid", "to_json(m) AS m").collect()
    assert {(r.page_no, r.pos): r.valid for r in rows} == valid
    typed = {(r.page_no, r.pos): r for r in P.typed_markets(raw).selectExpr(
        "page_no", "pos", "condition_id", "icon", "question", "active", "seconds_delay", "minimum_tick_size",
        "to_json(tokens) AS tokens", "to_json(rewards) AS rewards", "to_json(tags) AS tags").collect()}
    for at, ok in valid.items():
        if ok:
            m, r = want[at], typed[at]
            assert (r.condition_id, r.icon, r.question, r.active) == (m["condition_id"], m.get("icon"), m.get("question"), m.get("active", False))
            assert (r.seconds_delay, r.minimum_tick_size) == (m.get("seconds_delay", 0), m.get("minimum_tick_size", 0.0))
            assert [json.loads(r[c]) for c in ("tokens", "rewards", "tags")] == [m.get(c) for c in ("tokens", "rewards", "tags")]
    assert typed.keys() == {at for at, ok in valid.items() if ok}
    # A key that is repeated two levels inside a column costs that market alone.
    deep = spark.createDataFrame([(0, 0, page('{"condition_id": "j", "tokens": [{"p": {"q": 1, "q": 2}}]}', '{"condition_id": "k"}'))], P.PAGE_SCHEMA)
    left = P.raw_markets(P.walked_pages(deep))
    assert [r.condition_id for r in P.typed_markets(left).collect()] == ["k"] and P.market_rejects(left).count() == 1


def test_what_is_no_json_ends_a_walk(spark):
    from marketlake.sources import pages as P
    bad = ["{'next_cursor': 'n', 'x': 1, 'x': 2}", '{"next_cursor": "n", "x": NaN, "x": 2}', '{"next_cursor": "n", "x": 1, "x": 2},', ""]
    rows = [(k, n, bad[k] if n else '{"data": [], "next_cursor": "n"}') for k in range(len(bad)) for n in range(2)]
    pages = spark.createDataFrame([*rows, (9, 0, None)], P.PAGE_SCHEMA)
    assert {r.walk_id: r._last for r in P.walk_stops(pages).collect()} == {0: 0, 1: 0, 2: 0, 3: 0, 9: -1}
