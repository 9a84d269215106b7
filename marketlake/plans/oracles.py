"""DuckDB oracle texts: the expected rows of each query, computed straight from the
driver's tables (not by parsing the derived payloads), so they check the parse
independently. Conventions: ``//`` for integer division, ``trunc`` before a
BIGINT cast, the same IEEE ``CASE`` chain for division by zero.
"""

from __future__ import annotations

# Accepted frames of fx_frames: a frame is dropped whole when one of its five
# events became a bad bar (an event of another type with event_id % 10 = 0).
_FRAMES = """
WITH ev AS (
  SELECT *, event_id // 5 AS frame_no, event_id % 5 AS pos,
         (event_type IS NULL OR event_type NOT IN ('purchase', 'view', 'click', 'signup'))
           AND event_id % 10 = 0 AS bad,
         CASE WHEN event_type = 'purchase' THEN 'b' WHEN event_type = 'view' THEN 'q'
              WHEN event_type = 'click' THEN 't'
              WHEN event_type = 'signup' THEN CASE WHEN event_id % 2 = 0 THEN 'success' ELSE 'subscription' END
              ELSE 'error' END AS kind
  FROM events),
ok AS (SELECT * FROM ev WHERE frame_no NOT IN (SELECT frame_no FROM ev WHERE bad))
"""


def _ieee(num: str, den: str) -> str:
    return (f"(CASE WHEN ({den}) <> 0 THEN ({num}) / ({den}) WHEN isnan({num}) OR ({num}) = 0 THEN 'nan'::DOUBLE "
            f"WHEN ({num}) > 0 THEN 'inf'::DOUBLE ELSE '-inf'::DOUBLE END)")


_BARS = _FRAMES + """,
bars AS (
  SELECT frame_no, pos, 'U' || user_id AS symbol,
         CASE WHEN event_id % 97 = 0 THEN 0.0::DOUBLE ELSE value END AS open,
         value * 2 AS high, value / 2 AS low, value + 1 AS close, value * 10 AS volume,
         strftime(ts, '%Y-%m-%d') || 'T00:00:00Z' AS ts_text, date_trunc('day', ts)::TIMESTAMP AS ts_utc,
         CASE WHEN event_id % 2 = 0 THEN event_id END AS trade_count,
         CASE WHEN event_id % 3 = 0 THEN value END AS vwap
  FROM ok WHERE kind = 'b'),
bar_rows AS (
  SELECT frame_no, pos, symbol, open, high, low, close, CAST(trunc(volume) AS BIGINT) AS volume,
         ts_utc AS timestamp, trade_count, vwap FROM bars)
"""

_QUOTES = _FRAMES + """,
quotes AS (
  SELECT frame_no, pos, 'U' || user_id AS symbol, NULL::VARCHAR AS bid_exchange, value AS bid_price,
         value * 10 AS bid_size, NULL::VARCHAR AS ask_exchange, value + 0.05::DOUBLE AS ask_price,
         value * 7 AS ask_size, '[]' AS conditions, 'C' AS tape,
         strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+05:30' AS ts_text,
         (ts - INTERVAL '5 hours 30 minutes')::TIMESTAMP AS ts_utc
  FROM ok WHERE kind = 'q')
"""

_TRADES = _FRAMES + """,
trades AS (
  SELECT frame_no, pos, 'U' || user_id AS symbol, CAST(event_id % 20 AS BIGINT) AS trade_id, 'N' AS exchange,
         value AS price, value * 3 AS size, NULL::VARCHAR AS conditions, NULL::VARCHAR AS tape,
         NULL::VARCHAR AS tks, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || 'Z' AS ts_text, ts AS ts_utc
  FROM ok WHERE kind = 't'),
trade_rows AS (
  SELECT frame_no, pos, trade_id, symbol, exchange, price, CAST(trunc(size) AS BIGINT) AS size,
         ts_utc AS timestamp, tape, tks FROM trades)
"""

_TIMES = """
WITH t AS (
  SELECT event_id AS seq, CASE event_id % 14
     WHEN 0 THEN ts WHEN 1 THEN ts - INTERVAL '5 hours 30 minutes' WHEN 2 THEN ts + INTERVAL '4 hours'
     WHEN 3 THEN ts WHEN 7 THEN ts WHEN 8 THEN ts - INTERVAL '19 hours' WHEN 9 THEN ts + INTERVAL '23 hours 59 minutes'
     WHEN 11 THEN ts - (date_trunc('second', ts) - date_trunc('minute', ts)) + INTERVAL '1 minute'
     WHEN 12 THEN date_trunc('minute', ts) + INTERVAL '1 minute' + INTERVAL '19 hours' ELSE NULL END::TIMESTAMP AS ts
  FROM events)
"""

ORACLES: dict[str, str] = {
    "parse_frames": _FRAMES + "SELECT frame_no, pos, kind FROM ok",
    "dispatch_kinds": _FRAMES + "SELECT kind, count(*) AS n FROM ok GROUP BY kind",
    "frame_rejects": _FRAMES + "SELECT DISTINCT frame_no, 'invalid element' AS reason FROM ev WHERE bad",
    "data_messages": _FRAMES + "SELECT frame_no, pos, kind FROM ok WHERE kind IN ('b', 'q', 't')",
    "msg_success": _FRAMES + "SELECT frame_no, pos, 'connected' AS msg FROM ok WHERE kind = 'success'",
    "msg_error": _FRAMES + "SELECT frame_no, pos, 400 AS code, 'e' || event_id AS msg FROM ok WHERE kind = 'error'",
    "msg_subscription": _FRAMES + """
SELECT frame_no, pos, '[]' AS trades, '[]' AS quotes, '[U' || user_id || ']' AS bars, '[]' AS orderbooks,
       '[X]' AS updated_bars, '[]' AS daily_bars, '[]' AS statuses, '[]' AS lulds, '[]' AS corrections,
       '[]' AS cancel_errors
FROM ok WHERE kind = 'subscription'""",
    "bars_typed": _BARS + """
SELECT frame_no, pos, symbol, open, high, low, close, volume, ts_text AS timestamp, trade_count, vwap FROM bars""",
    "quotes_typed": _QUOTES + """
SELECT frame_no, pos, symbol, bid_exchange, bid_price, bid_size, ask_exchange, ask_price, ask_size, conditions,
       tape, ts_text AS timestamp FROM quotes""",
    "trades_typed": _TRADES + """
SELECT frame_no, pos, symbol, trade_id, exchange, price, size, conditions, tape, tks, ts_text AS timestamp
FROM trades""",
    "bars_rows": _BARS + "SELECT *, NULL::VARCHAR AS _error FROM bar_rows",
    "quotes_rows": _QUOTES + """
SELECT frame_no, pos, symbol, bid_exchange, bid_price, CAST(trunc(bid_size) AS BIGINT) AS bid_size, ask_exchange,
       ask_price, CAST(trunc(ask_size) AS BIGINT) AS ask_size, ts_utc AS timestamp, tape, NULL::VARCHAR AS _error
FROM quotes""",
    "trades_rows": _TRADES + "SELECT *, NULL::VARCHAR AS _error FROM trade_rows",
    "bar_metrics": _BARS + f"""
SELECT frame_no, pos, close - open AS price_change, {_ieee('close - open', 'open')} * 100 AS price_change_percent
FROM bars""",
    "quote_metrics": _QUOTES + f"""
SELECT frame_no, pos, ask_price - bid_price AS spread,
       {_ieee('ask_price - bid_price', 'bid_price')} * 10000 AS spread_bps FROM quotes""",
    "sink_bars": _BARS + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY frame_no, pos) AS rn FROM bar_rows)
WHERE rn = 1""",
    "insert_ignore": _BARS + """
SELECT symbol, timestamp, frame_no, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY frame_no, pos) AS rn FROM bar_rows)
WHERE rn = 1""",
    "flagship": _BARS + f"""
SELECT * EXCLUDE (rn), close - open AS price_change,
       {_ieee('close - open', 'open')} * 100 AS price_change_percent FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY frame_no, pos) AS rn FROM bar_rows)
WHERE rn = 1""",
    "sink_trades": _TRADES + """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY trade_id, symbol ORDER BY frame_no, pos) AS rn FROM trade_rows)
WHERE rn = 1""",
    "sink_quotes": _QUOTES + """
SELECT frame_no, pos, symbol, bid_exchange, bid_price, CAST(trunc(bid_size) AS BIGINT) AS bid_size, ask_exchange,
       ask_price, CAST(trunc(ask_size) AS BIGINT) AS ask_size, ts_utc AS timestamp, tape FROM quotes""",
    "batch_split_counts": _FRAMES + """
SELECT frame_no, count(*) FILTER (WHERE kind = 'b') AS n_bars, count(*) FILTER (WHERE kind = 'q') AS n_quotes,
       count(*) FILTER (WHERE kind = 't') AS n_trades FROM ok GROUP BY frame_no""",
    "arrival_order": _FRAMES + """
SELECT frame_no, pos, kind, row_number() OVER (PARTITION BY frame_no ORDER BY
         CASE kind WHEN 'b' THEN 0 WHEN 'q' THEN 1 ELSE 2 END, pos) AS write_rank
FROM ok WHERE kind IN ('b', 'q', 't')""",
    "ts_strict": _TIMES + "SELECT seq, ts, ts IS NOT NULL AS ok FROM t",
    "ts_lenient": _TIMES + "SELECT seq, ts FROM t",
}

# Market pages: walk = k // 500, page = (k % 500) // 50; the cursor is empty on page 7,
# page 5 has no data, a null minimum_order_size (k % 31 = 0) makes a market invalid.
_MARKETS = """
WITH p AS (
  SELECT p_partkey AS k, p_partkey // 500 AS walk_id, (p_partkey % 500) // 50 AS page_no, * FROM part),
walked AS (SELECT DISTINCT walk_id, page_no FROM p WHERE page_no <= 7),
raw AS (
  SELECT *, row_number() OVER (PARTITION BY walk_id, page_no ORDER BY k) - 1 AS pos, k % 31 <> 0 AS valid
  FROM p WHERE page_no <= 7 AND page_no <> 5),
typed AS (
  SELECT walk_id, page_no, pos, '0x' || (k % 300) AS condition_id, NULL::VARCHAR AS question_id,
         NULL::VARCHAR AS market_slug, p_name AS question, NULL::VARCHAR AS description, p_size % 2 = 0 AS active,
         false AS closed, false AS archived, false AS accepting_orders, false AS enable_order_book,
         false AS neg_risk,
         CASE k % 3 WHEN 0 THEN '2024-06-30T00:00:00Z' WHEN 1 THEN '2024-06-30T00:00:00-04:00' ELSE 'soon' END
           AS end_date_text,
         CASE k % 3 WHEN 0 THEN TIMESTAMP '2024-06-30 00:00:00' WHEN 1 THEN TIMESTAMP '2024-06-30 04:00:00'
           ELSE NULL END AS end_date_ts,
         NULL::VARCHAR AS game_start_time, NULL::VARCHAR AS accepting_order_timestamp,
         0.0::DOUBLE AS minimum_order_size, p_retailprice AS minimum_tick_size, 0.0::DOUBLE AS maker_base_fee,
         0.0::DOUBLE AS taker_base_fee, p_size AS seconds_delay,
         CASE WHEN page_no = 3 AND k % 50 = 7 THEN 'i' || k END AS icon, NULL::VARCHAR AS image,
         NULL::VARCHAR AS fpmm, NULL::VARCHAR AS neg_risk_market_id, NULL::VARCHAR AS neg_risk_request_id,
         false AS notifications_enabled, false AS is_50_50_outcome,
         CASE WHEN k % 2 = 0 THEN p_retailprice END AS token0_price, k % 2 <> 0 AS tokens_null,
         true AS rewards_null, true AS tags_null
  FROM raw WHERE valid)
"""

ORACLES.update({
    "paged_markets": _MARKETS + "SELECT walk_id, page_no, pos, '0x' || (k % 300) AS condition_id FROM raw",
    "ingest_counters": _MARKETS + """
SELECT w.walk_id, count(*) AS pages_walked,
       CAST(sum((SELECT count(*) FROM raw r WHERE r.walk_id = w.walk_id AND r.page_no = w.page_no)) AS BIGINT)
         AS raw_markets
FROM walked w GROUP BY w.walk_id""",
    "markets_typed": _MARKETS + """
SELECT * EXCLUDE (end_date_text, end_date_ts), end_date_text AS end_date_iso FROM typed""",
    "market_rejects": _MARKETS + "SELECT walk_id, page_no, pos, 'invalid market' AS reason FROM raw WHERE NOT valid",
    "market_rows": _MARKETS + """
SELECT * EXCLUDE (end_date_text, end_date_ts, game_start_time, accepting_order_timestamp),
       end_date_ts AS end_date_iso, NULL::TIMESTAMP AS game_start_time,
       NULL::TIMESTAMP AS accepting_order_timestamp, NULL::VARCHAR AS _error FROM typed""",
    "sink_markets": _MARKETS + """
SELECT * EXCLUDE (end_date_text, end_date_ts, game_start_time, accepting_order_timestamp, rn),
       end_date_ts AS end_date_iso, NULL::TIMESTAMP AS game_start_time,
       NULL::TIMESTAMP AS accepting_order_timestamp FROM (
  SELECT *, row_number() OVER (PARTITION BY condition_id ORDER BY walk_id DESC, page_no DESC, pos DESC) AS rn
  FROM typed) WHERE rn = 1""",
    "upsert": _MARKETS + """
SELECT condition_id, walk_id, page_no, pos FROM (
  SELECT *, row_number() OVER (PARTITION BY condition_id ORDER BY walk_id DESC, page_no DESC, pos DESC) AS rn
  FROM typed) WHERE rn = 1""",
})

# Statements: kind = o_orderkey % 3; the period is not a date when o_orderkey % 17 = 0; the
# required amount is missing when o_orderkey % 13 = 0; fetches of symbol (custkey % 200) fail
# when that number % 11 = 10. round(x / 2, 2) is HALF_UP on the decimal text of x / 2.
_STATEMENTS = """
WITH s0 AS (
  SELECT o_orderkey AS seq, o_orderkey % 3 AS kind_no, o_custkey % 200 AS symbol_no,
         'C' || (o_custkey % 200) AS symbol,
         CASE o_orderkey % 3 WHEN 0 THEN 'income' WHEN 1 THEN 'balance' ELSE 'cashflow' END AS kind,
         (o_custkey % 200) % 11 = 10 AS failed,
         CASE WHEN o_orderkey % 17 = 0 THEN 'quarter' ELSE 'date' END AS period_kind,
         CASE WHEN o_orderkey % 17 = 0 THEN NULL
              ELSE last_day(date_trunc('quarter', o_orderdate) + INTERVAL 2 MONTH) END AS period_date,
         CASE WHEN o_orderkey % 17 = 0 THEN year(o_orderdate) || 'Q' || quarter(o_orderdate) END AS period_label,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE o_totalprice END AS amount,
         ((CAST(round(o_totalprice * 100) AS BIGINT) + 1) // 2) / 100.0 AS amount2,
         CASE WHEN o_orderkey % 29 = 0 THEN -1 ELSE o_orderkey * 1000 END AS shares_outstanding
  FROM orders),
s AS (SELECT *, CASE WHEN period_date IS NULL THEN 'invalid period'
                     WHEN amount IS NULL THEN 'missing ' || CASE kind WHEN 'income' THEN 'total_revenue'
                          WHEN 'balance' THEN 'total_assets' ELSE 'operating_cashflow' END END AS err
      FROM s0 WHERE NOT failed),
inc AS (SELECT seq, 0::BIGINT AS pos, symbol, period_date, amount AS total_revenue, amount2 AS gross_profit,
               NULL::DOUBLE AS operating_income, NULL::DOUBLE AS net_income, err FROM s WHERE kind = 'income'),
bal AS (SELECT seq, 0::BIGINT AS pos, symbol, period_date, amount AS total_assets, amount2 AS total_liabilities,
               NULL::DOUBLE AS total_equity, NULL::DOUBLE AS cash, NULL::DOUBLE AS long_term_debt,
               shares_outstanding, err FROM s WHERE kind = 'balance'),
cf AS (SELECT seq, 0::BIGINT AS pos, symbol, period_date, amount AS operating_cashflow, amount2 AS capital_expenditures,
              NULL::DOUBLE AS free_cash_flow, NULL::DOUBLE AS net_income, err FROM s WHERE kind = 'cashflow')
"""


def _first(src: str, key: str, order: str) -> str:
    return (f"SELECT * EXCLUDE (rn, err) FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) "
            f"AS rn FROM {src} WHERE err IS NULL) WHERE rn = 1")


_CALENDAR = """
WITH c AS (
  SELECT o_custkey AS seq, 'C' || (o_custkey % 200) AS symbol, o_orderstatus AS st,
         date_trunc('month', o_orderdate)::TIMESTAMP AS d FROM orders),
earn AS (SELECT seq, symbol, row_number() OVER (PARTITION BY seq ORDER BY d) - 1 AS ord, 'earnings' AS date_type,
                d AS date_utc FROM c WHERE st = 'O'),
ne AS (SELECT seq, count(*) AS n FROM c WHERE st = 'O' GROUP BY seq),
dv AS (SELECT seq, any_value(symbol) AS symbol, max(d) AS date_utc FROM c WHERE st = 'F' GROUP BY seq),
ex AS (SELECT seq, any_value(symbol) AS symbol, min(d) AS date_utc FROM c WHERE st = 'P' GROUP BY seq),
cal AS (
  SELECT seq, symbol, ord, date_type, date_utc FROM earn
  UNION ALL
  SELECT dv.seq, dv.symbol, coalesce(ne.n, 0), 'dividend_payment', dv.date_utc FROM dv LEFT JOIN ne USING (seq)
  UNION ALL
  SELECT ex.seq, ex.symbol, coalesce(ne.n, 0) + CASE WHEN dv.seq IS NULL THEN 0 ELSE 1 END, 'ex_dividend',
         ex.date_utc FROM ex LEFT JOIN ne USING (seq) LEFT JOIN dv USING (seq))
"""

ORACLES.update({
    "scan_statements": _STATEMENTS + """
SELECT seq, kind, symbol, period_kind, period_date AS period_raw_date, amount, amount2 FROM s""",
    "statement_flatten": _STATEMENTS + """
SELECT seq, 0::BIGINT AS pos, symbol, period_kind, period_date AS period_raw_date, period_label, amount AS total_revenue,
       amount2 AS gross_profit, NULL::DOUBLE AS operating_income, NULL::DOUBLE AS net_income
FROM s WHERE kind = 'income'""",
    "income_rows": _STATEMENTS + "SELECT * EXCLUDE (err), err AS _error FROM inc",
    "balance_rows": _STATEMENTS + "SELECT * EXCLUDE (err), err AS _error FROM bal",
    "cashflow_rows": _STATEMENTS + "SELECT * EXCLUDE (err), err AS _error FROM cf",
    "statement_rejects": _STATEMENTS + "SELECT seq, kind, err AS reason FROM s WHERE err IS NOT NULL",
    "sink_income": _STATEMENTS + _first("inc", "symbol, period_date", "seq, pos"),
    "sink_balance": _STATEMENTS + _first("bal", "symbol, period_date", "seq, pos"),
    "sink_cashflow": _STATEMENTS + _first("cf", "symbol, period_date", "seq, pos"),
    "extract_amount": _STATEMENTS + "SELECT seq, amount FROM s0",
    "period_date": _STATEMENTS + "SELECT seq, period_date FROM s0",
    "wrap_bigint": _STATEMENTS + "SELECT seq, shares_outstanding AS shares FROM s0",
    "sat_bigint": """
WITH x AS (SELECT event_id AS seq, CASE event_id % 4 WHEN 0 THEN value WHEN 1 THEN -value
             WHEN 2 THEN value * 1e18 ELSE 'NaN'::DOUBLE END AS x FROM events)
SELECT seq, CASE WHEN isnan(x) THEN 0 WHEN x >= 9223372036854775808.0 THEN 9223372036854775807
                 WHEN x < -9223372036854775808.0 THEN -9223372036854775808
                 ELSE CAST(trunc(x) AS BIGINT) END AS as_bigint FROM x""",
    "load_symbols": """
SELECT list, line_no, 'C' || c_custkey AS symbol FROM (
  SELECT c_custkey, c_custkey // 20000 AS list, row_number() OVER (PARTITION BY c_custkey // 20000 ORDER BY c_custkey) AS line_no FROM customer)
WHERE c_custkey % 7 NOT IN (3, 5)""",
    "symbol_scan": _STATEMENTS + """
SELECT seq, kind, symbol FROM s0 WHERE symbol IN (SELECT 'C' || c_custkey FROM customer
                                                  WHERE c_custkey % 7 NOT IN (3, 5))""",
    "fetch_policy_skip": _STATEMENTS + "SELECT seq, kind, symbol FROM s0 WHERE NOT failed",
    "fetch_errors": _STATEMENTS + """
SELECT seq, symbol, kind, 'error: fetch failed' AS error FROM s0 WHERE failed""",
    "fetch_policy_fail": _STATEMENTS + """
SELECT seq, kind, symbol FROM s0
WHERE symbol_no * 10 + kind_no < coalesce((SELECT min(symbol_no * 10 + kind_no) FROM s0 WHERE failed), 1e18)""",
    "calendar_unpivot": _CALENDAR + "SELECT * FROM cal",
    "sink_calendar": _CALENDAR + """
SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY symbol, date_type, date_utc
                                                         ORDER BY seq, ord) AS rn FROM cal) WHERE rn = 1""",
    "date_type_code": """
SELECT o_orderkey AS seq, CASE o_orderkey % 4 WHEN 0 THEN 'earnings' WHEN 1 THEN 'ex_dividend'
                               WHEN 2 THEN 'dividend_payment' END AS date_type FROM orders""",
    "constraint_check": """
WITH f AS (
  SELECT p_partkey AS seq, CASE WHEN p_partkey % 41 = 0 THEN NULL
                                ELSE p_name || CASE WHEN p_partkey % 5 = 0 THEN '   ' ELSE '' END END AS symbol,
         CASE p_partkey % 4 WHEN 0 THEN 'earnings' WHEN 1 THEN 'ex_dividend' WHEN 2 THEN 'dividend_payment'
                            ELSE 'split' END AS date_type FROM part)
SELECT seq, CASE WHEN length(symbol) > 10 THEN left(symbol, 10) ELSE symbol END AS symbol, date_type,
       CASE WHEN symbol IS NULL THEN 'null symbol'
            WHEN length(rtrim(symbol, ' ')) > 10 THEN 'symbol too long'
            WHEN date_type NOT IN ('earnings', 'ex_dividend', 'dividend_payment') THEN 'date_type check' END AS _error
FROM f""",
})

_POLICY = """
WITH r AS (
  SELECT event_id // 20 AS batch, CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS type_order,
         event_id AS seq, 'U' || user_id AS symbol, value,
         CASE WHEN event_id % 37 = 0 THEN NULL ELSE ts END::TIMESTAMP AS timestamp
  FROM events WHERE event_type IN ('purchase', 'view', 'click')),
cut AS (SELECT batch, min(type_order * 1000000000000 + seq) AS c FROM r WHERE timestamp IS NULL GROUP BY batch)
"""

ORACLES.update({
    "capture_until_close": """
WITH f AS (
  SELECT user_id % 4 AS conn, event_id AS frame_no,
         CASE WHEN event_type = 'signup' THEN 'ping'
              WHEN event_type = 'error' AND event_id % 25 = 0 THEN 'close' ELSE 'text' END AS kind,
         event_type AS body FROM events),
e AS (SELECT conn, min(frame_no) AS e FROM f WHERE kind IN ('close', 'error') GROUP BY conn)
SELECT f.conn, f.frame_no, f.body FROM f LEFT JOIN e USING (conn)
WHERE f.kind = 'text' AND (e.e IS NULL OR f.frame_no < e.e)""",
    "subscription_filter": _FRAMES + """
SELECT frame_no, pos, kind FROM ok
WHERE kind NOT IN ('b', 'q', 't')
   OR (kind = 'b' AND user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0))
   OR (kind = 'q' AND user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 3 = 1))
   OR (kind = 't' AND user_id IN (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0))""",
    "scan_frames": "SELECT event_id // 5 AS frame_no, 'text' AS kind, count(*) AS n_elements FROM events GROUP BY 1",
    "policy_abort_rest": _POLICY + """
SELECT r.batch, r.type_order, r.seq, r.symbol, r.value, r.timestamp FROM r LEFT JOIN cut USING (batch)
WHERE cut.c IS NULL OR r.type_order * 1000000000000 + r.seq < cut.c""",
    "policy_skip_row": _POLICY + "SELECT * FROM r WHERE timestamp IS NOT NULL",
})

# Streaming runs must equal the batch results.
ORACLES.update({
    "pipeline_run": ORACLES["sink_bars"],
    "paced_polling": ORACLES["sink_bars"],
    "subscribed_run": f"""
SELECT * FROM ({ORACLES["sink_bars"]})
WHERE symbol IN (SELECT 'U' || c_custkey FROM customer WHERE c_custkey % 3 = 0)""",
    "custom_source": ORACLES["sink_bars"],
    "custom_sink": ORACLES["dispatch_kinds"],
    "fan_out": _BARS.replace("bars AS (", "bars AS (", 1) + """,
trades AS (SELECT frame_no, pos, 'U' || user_id AS symbol, event_id % 20 AS trade_id FROM ok WHERE kind = 't'),
tr AS (SELECT DISTINCT trade_id, symbol FROM trades)
SELECT 'bars' AS table_name, (SELECT count(*) FROM (SELECT DISTINCT symbol, timestamp FROM bar_rows)) AS n_rows
UNION ALL SELECT 'quotes', (SELECT count(*) FROM ok WHERE kind = 'q')
UNION ALL SELECT 'trades', (SELECT count(*) FROM tr)""",
})

_COUNTS = ORACLES["fan_out"]
ORACLES.update({
    "write_metadata": f"SELECT table_name, n_rows, n_rows AS n_ids, n_rows AS n_received FROM ({_COUNTS})",
    "init_schema": f"""
SELECT t.table_name, false AS made_again, CAST(coalesce(n_rows, 0) AS BIGINT) AS n_rows FROM (VALUES ('bars'), ('quotes'), ('trades'),
  ('quarterly_income_statements'), ('quarterly_balance_sheets'), ('quarterly_cashflow_statements'), ('calendar_dates'),
  ('polymarket_markets')) AS t(table_name) LEFT JOIN ({_COUNTS}) c ON c.table_name = t.table_name""",
    "two_runs": f"""
SELECT table_name, k * n_rows AS n_rows, k * n_rows AS n_ids, CAST(k AS BIGINT) AS n_conns
FROM ({_COUNTS}) JOIN (VALUES ('quotes', 2), ('bars', 1)) AS v(name, k) ON name = table_name""",
})

ORACLES.update({
    "pipeline_statements": ORACLES["sink_income"],
    "pipeline_calendar": ORACLES["sink_calendar"],
    "pipeline_markets": ORACLES["sink_markets"],
})

ORACLES.update({
    "page_counters": _MARKETS + """
SELECT walk_id, page_no, count(*) AS raw_markets, count(*) FILTER (WHERE valid) AS valid_markets
FROM raw GROUP BY walk_id, page_no""",
})

# Landed frames of the streaming queries: arrival = frame_no * 8 // frames, taken in order.
_ARRIVALS = """, ar AS (SELECT *, CAST(floor(frame_no * 8 / (SELECT max(frame_no) + 1 FROM ev)) AS INTEGER) AS arrival
            FROM bar_rows)"""


def _bars_of_arrivals(where: str, extra: str = "") -> str:
    return (_BARS + _ARRIVALS + f"""
SELECT * EXCLUDE (rn, arrival){extra} FROM (
  SELECT *, row_number() OVER (PARTITION BY symbol, timestamp ORDER BY frame_no, pos) AS rn FROM ar WHERE {where})
WHERE rn = 1""")


ORACLES.update({
    # arrival 3 names a connection without a table: its micro-batch (arrivals 2 and 3) is passed over
    "sink_failure_continue": _bars_of_arrivals("arrival NOT IN (2, 3)", ", CAST(1 AS BIGINT) AS n_failed, CAST(1 AS BIGINT) AS failed_batch"),
    # the source failed reading the 4th arrival: arrivals 0..2 were handed over
    "source_failure_drain": _bars_of_arrivals("arrival < 3", ", true AS source_failed"),
    "bounded_admission": """
WITH f AS (SELECT DISTINCT event_id // 5 AS frame_no FROM events)
SELECT CAST(arrival // 2 AS BIGINT) AS batch_id, count(*) AS input_rows FROM (
  SELECT CAST(floor(frame_no * 8 / (SELECT max(frame_no) + 1 FROM f)) AS INTEGER) AS arrival FROM f)
GROUP BY 1""",
})

ORACLES.update({
    "scan_frame_lines": """
SELECT capture, row_number() OVER (PARTITION BY capture ORDER BY event_id) - 1 AS line_no,
       '[{"T":"error","code":400,"msg":"' || event_type || ' ' || event_id || '"}]' AS body, event_type || ' ' || event_id AS msg
FROM (SELECT *, event_id // 5000 AS capture FROM events)""",
})

ORACLES.update({
    "stream_counters": _MARKETS + "SELECT (SELECT count(*) FROM walked) AS pages_walked, (SELECT count(*) FROM raw) AS raw_markets",
})
