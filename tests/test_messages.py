"""The reference's message tests (wrapped in a frame) plus strict-typing edge cases."""

import math

import pytest

from marketlake.operators import frames as FR
from marketlake.operators import rows as R

# The wire examples of each message kind.
BAR = '{"T":"b","S":"AAPL","o":150.0,"h":152.5,"l":149.5,"c":151.0,"v":1000000,"t":"2024-01-01T10:00:00Z","n":1500,"vw":150.75}'
QUOTE = ('{"T":"q","S":"TSLA","bx":"NASDAQ","bp":250.10,"bs":100,"ax":"NASDAQ","ap":250.15,"as":200,"c":[],'
         '"z":"C","t":"2024-01-01T10:00:01Z"}')
TRADE = '{"T":"t","S":"MSFT","i":12345,"x":"NASDAQ","p":380.50,"s":50,"c":[],"z":"C","t":"2024-01-01T10:00:02Z"}'


def accepted(frames_df):
    return [r.frame_no for r in FR.check_frames(frames_df).filter("_reason IS NULL").select("frame_no").collect()]


def test_success(frames):
    m = FR.successes(FR.parse_frames(frames('[{"T":"success","msg":"authenticated"}]'))).collect()
    assert [r.msg for r in m] == ["authenticated"]


def test_error(frames):
    m = FR.errors(FR.parse_frames(frames('[{"T":"error","code":401,"msg":"invalid credentials"}]'))).collect()
    assert (m[0].code, m[0].msg) == (401, "invalid credentials")


def test_subscription_snake_case_is_ignored(frames):
    body = ('[{"T":"subscription","trades":["AAPL","TSLA"],"quotes":[],"bars":["AAPL"],"updated_bars":[],'
            '"daily_bars":[],"statuses":[],"lulds":[],"corrections":[],"cancel_errors":[]}]')
    s = FR.subscriptions(FR.parse_frames(frames(body))).collect()[0]
    assert s.trades == ["AAPL", "TSLA"] and s.quotes == [] and s.bars == ["AAPL"]
    assert s.updated_bars == [] and s.cancel_errors == []


def test_subscription_camel_case(frames):
    s = FR.subscriptions(FR.parse_frames(frames('[{"T":"subscription","updatedBars":["X"]}]'))).collect()[0]
    assert s.updated_bars == ["X"]


def test_bar_and_metrics(frames):
    b = R.bar_metrics(FR.bars(FR.parse_frames(frames(f"[{BAR}]")))).collect()[0]
    assert b.symbol == "AAPL" and b.volume == 1000000.0 and b.trade_count == 1500 and b.vwap == 150.75
    assert b.price_change == 1.0
    assert abs(b.price_change_percent - 0.6666) < 1e-3


def test_quote_and_metrics(frames):
    q = R.quote_metrics(FR.quotes(FR.parse_frames(frames(f"[{QUOTE}]")))).collect()[0]
    assert q.conditions == [] and q.tape == "C" and q.bid_exchange == "NASDAQ"
    assert abs(q.spread - 0.05) < 1e-5
    assert abs(q.spread_bps - 1.9992) < 1e-4


def test_trade(frames):
    t = FR.trades(FR.parse_frames(frames(f"[{TRADE}]"))).collect()[0]
    assert int(t.trade_id) == 12345 and t.size == 50.0 and t.timestamp == "2024-01-01T10:00:02Z"


def test_subscription_defaults(frames):
    s = FR.subscriptions(FR.parse_frames(frames('[{"T":"subscription"}]'))).collect()[0]
    assert all(s[name] == [] for _, name in FR.SUBSCRIPTION_LISTS)


@pytest.mark.parametrize("body,reason", [
    ('[{"T":"invalid","unknown":"field"}]', "invalid element"),
    ('[{"T":"b","S":"AAPL" MISSING BRACE', "malformed json"),
    ('[{"T":"success","msg":"a"}] x', "malformed json"),
    ('[1],[2]', "malformed json"),
    ('{"T":"success","msg":"a"}', "not an array"),
    (f'[{BAR.replace(chr(34) + "o" + chr(34) + ":150.0", chr(34) + "o" + chr(34) + ":" + chr(34) + "150" + chr(34))}]',
     "invalid element"),
    ('[{"T":"b","S":5,"o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z"}]', "invalid element"),
    ('[{"T":"b","S":"A","o":null,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z"}]', "invalid element"),
    ('[{"T":"b","S":"A","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z","n":1500.0}]', "invalid element"),
    ('[{"T":"b","S":"A","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z","n":-1}]', "invalid element"),
    ('[{"T":"b","S":"A","o":1e400,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z"}]', "invalid element"),
    ('[{"T":"success","msg":"a","msg":"b"}]', "malformed json"),
    ('[{"T":"error","code":70000,"msg":"x"}]', "invalid element"),
    ('[{"T":"subscription","bars":["A",null]}]', "invalid element"),
    ('[{"T":"subscription","bars":null}]', "invalid element"),
    ('[{"T":"success","msg":"ok"},{"T":"q","S":"A"}]', "invalid element"),
])
def test_rejected(frames, body, reason):
    r = FR.frame_rejects(frames(body)).collect()
    assert [x.reason for x in r] == [reason]


@pytest.mark.parametrize("body", [
    "[]",
    '[{"T":"b","S":"A","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z","vw":null,"n":null}]',
    '[{"T":"b","S":"A","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z","n":18446744073709551615}]',
    '[{"T":"t","S":"A","i":1,"p":1,"s":1,"t":"x","extra":{"a":[1,2]}}]',
    ' [ {"T":"success","msg":"spaces"} ] ',
])
def test_accepted(frames, body):
    assert accepted(frames(body)) == [0]


def test_empty_frame_has_no_rows(frames):
    assert FR.parse_frames(frames("[]")).count() == 0


def test_u64_wraps_in_table(frames):
    body = '[{"T":"b","S":"A","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z","n":18446744073709551615}]'
    r = R.bars_rows(FR.bars(FR.parse_frames(frames(body)))).collect()[0]
    assert r.trade_count == -1


@pytest.mark.parametrize("text,expected", [
    ("2024-01-01T10:00:00Z", "2024-01-01 10:00:00"),
    ("2024-01-01T10:00:00+05:30", "2024-01-01 04:30:00"),
    ("2024-01-01T10:00:00-04:00", "2024-01-01 14:00:00"),
    ("2024-01-01t10:00:00z", "2024-01-01 10:00:00"),
    ("2024-01-01T10:00:00.123456789Z", "2024-01-01 10:00:00.123456"),
    ("2024-01-01", None),
    ("2024-01-01T10:00:00", None),
    ("2024-13-01T10:00:00Z", None),
    ("2024-01-01T10:00:00 UTC", None),
    ("2024-01-01T10:00:00Zjunk", None),
    ("2016-12-31T23:59:60Z", "2017-01-01 00:00:00"),
    ("2024-01-01 10:00:00Z", "2024-01-01 10:00:00"),
    ("2024-02-30T10:00:00Z", None),
])
def test_timestamps(spark, text, expected):
    from marketlake.functions import scalars as S
    r = spark.createDataFrame([(text,)], "v string").select(S.ts_lenient("v").cast("string").alias("t")).collect()
    got = r[0].t
    if expected is None:
        assert got is None
    else:
        assert got.startswith(expected)


def test_ieee_division(spark):
    from pyspark.sql import functions as F

    from marketlake.functions import scalars as S
    df = spark.createDataFrame([(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (1.0, -0.0), (3.0, 2.0)], "a double, b double")
    got = [r.q for r in df.select(S.ieee_div(F.col("a"), F.col("b")).alias("q")).collect()]
    assert got[0] == math.inf and got[1] == -math.inf and math.isnan(got[2]) and got[3] == -math.inf
    assert got[4] == 1.5


def test_size_truncation_and_saturation(spark):
    from marketlake.functions import scalars as S
    df = spark.createDataFrame([(0.37,), (-2.9,), (1e300,), (-1e300,), (float("nan"),)], "x double")
    assert [r.y for r in df.select(S.sat_bigint("x").alias("y")).collect()] == [
        0, -2, 9223372036854775807, -9223372036854775808, 0]


def test_varchar_limits(spark):
    from pyspark.sql import functions as F
    df = spark.createDataFrame([(1, "ABCDEFGHIJ"), (2, "ABCDEFGHIJK"), (3, "ABCDEFGHIJ   "), (4, None)],
                               "seq int, symbol string")
    out = R.apply_constraints("bars", df.withColumn("open", F.lit(1.0))).orderBy("seq").collect()
    assert [r._error for r in out] == [None, "symbol too long", None, "null symbol"]
    assert out[2].symbol == "ABCDEFGHIJ"


def test_load_symbols_rules(spark):
    from marketlake.sources.statements import load_symbols
    text = ("SYMBOL,Name\r\n AAPL , Apple\r\n\r\n,empty first cell\r\n MSFT ,x\r\n"
            "symbol,not a header after line 0\r\n\"BRK,A\",quoted\r\nAAPL,dup\n")
    got = [(r.line_no, r.symbol) for r in
           load_symbols(spark.createDataFrame([(text,)], "value string")).orderBy("line_no").collect()]
    assert got == [(1, "AAPL"), (4, "MSFT"), (5, "symbol"), (6, '"BRK'), (7, "AAPL")]


def test_load_symbols_without_header(spark):
    from marketlake.sources.statements import load_symbols
    got = [r.symbol for r in load_symbols(spark.createDataFrame([("IBM\nORCL",)], "value string"))
           .orderBy("line_no").collect()]
    assert got == ["IBM", "ORCL"]


def test_subscription_filter_from_dict(frames):
    from marketlake.sources.frames import subscription_filter
    body = ('[{"T":"success","msg":"a"},'
            '{"T":"b","S":"AAPL","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z"},'
            '{"T":"b","S":"MSFT","o":1,"h":1,"l":1,"c":1,"v":1,"t":"2024-01-01T00:00:00Z"},'
            '{"T":"q","S":"AAPL","bp":1,"bs":1,"ap":1,"as":1,"t":"2024-01-01T00:00:00Z"},'
            '{"T":"t","S":"AAPL","i":1,"p":1,"s":1,"t":"2024-01-01T00:00:00Z"}]')
    msgs = FR.parse_frames(frames(body))
    out = subscription_filter(msgs, {"bars": ["AAPL"], "quotes": [], "trades": ["AAPL"]})
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.pos, r.kind) for r in out.collect()) == [(0, "success"), (1, "b"), (4, "t")]


def test_schema_look_up_agrees_with_the_field_checks(spark):
    """Elements of every tag with values of every wire type, extra and missing keys."""
    import json
    import random

    from pyspark.sql import functions as F

    rng = random.Random(5)
    values = ["1", "-1", "0.5", "1e400", "1e3", "18446744073709551615", "18446744073709551616", "12345678901234567890123456789012345678901.5",
              '"x"', "null", "true", "[]", '["a"]', '["a",null]', "[1]", "[null]", "{}", '{"S":"x"}']
    usual = {"str": ['"x"'], "f64": ["1.5", "2"], "u64": ["7"], "list": ["[]", '["a"]']}
    texts = []
    for tag, fields in (("b", FR.BAR_FIELDS), ("q", FR.QUOTE_FIELDS), ("t", FR.TRADE_FIELDS)) * 150:
        parts = {"T": f'"{tag}"'}
        for key, _, kind, required in fields:
            if required or rng.random() < 0.5:
                parts[key] = rng.choice(usual[kind])
        for _ in range(rng.choice([0, 0, 1, 1, 2])):
            key = rng.choice([*parts, "extra", "A", "a b", "z,S: STRING", "`q", "zz", fields[-1][0]])
            parts[key] = rng.choice(values)
        if rng.random() < 0.2:
            parts.pop(rng.choice(list(parts)))
        keys = list(parts)
        rng.shuffle(keys)
        texts.append("{" + ",".join(json.dumps(k) + ":" + parts[k] for k in keys) + "}")
    texts += ["5", "null", "[]", '"b"', '{"T":"success","msg":"m"}', '{"T":"b"}', '{"T":5}']
    df = spark.createDataFrame([(t,) for t in texts], "x string").withColumn("v", F.parse_json("x"))
    rows = df.select("x", FR.element_valid(F.col("v")).alias("long"), FR.elements_valid(F.array("v")).alias("short")).collect()
    assert [r.x for r in rows if r.long != r.short] == []
    assert 100 < sum(r.long for r in rows) < len(rows) - 100
