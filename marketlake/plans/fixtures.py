"""Landed-payload inputs derived from the driver's tables (the ``fx_*`` rules).

Each function reads the parquet tables of one scale-factor folder and returns
the payloads a collector would have landed, so that every query's work grows
with the tables. The texts follow the derivation rules of the blueprint; the
oracles compute the expected rows straight from the same tables.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession


def _sql(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """Run ``text`` with ``{name}`` replaced by a fresh view over ``tables[name]``.

    (The texts hold JSON braces, so the built-in ``spark.sql`` formatter is not used.)
    The plan is analyzed at once, so the view names are private to this call.
    """
    for name, df in tables.items():
        view = f"_ml_{name}_{uuid.uuid4().hex[:10]}"
        df.createOrReplaceTempView(view)
        text = text.replace("{" + name + "}", view)
    return spark.sql(text)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fx_frames(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Alpaca-style frames ``(frame_no, body)``: one JSON array per 5 events."""
    return _sql(spark, """
SELECT event_id div 5 AS frame_no,
       concat('[', array_join(transform(array_sort(collect_list(struct(pos, body))), x -> x.body), ','), ']') AS body
FROM (SELECT event_id, event_id % 5 AS pos, CASE
    WHEN event_type = 'purchase' THEN concat('{"T":"b","S":"U', user_id, '","o":', if(event_id % 97 = 0, 0D, value),
         ',"h":', value * 2, ',"l":', value / 2, ',"c":', value + 1, ',"v":', value * 10,
         ',"t":"', date_format(ts, 'yyyy-MM-dd'), 'T00:00:00Z"',
         if(event_id % 2 = 0, concat(',"n":', event_id), ''), if(event_id % 3 = 0, concat(',"vw":', value), ''), '}')
    WHEN event_type = 'view' THEN concat('{"T":"q","S":"U', user_id, '","bp":', value, ',"bs":', value * 10,
         ',"ap":', value + 0.05D, ',"as":', value * 7, ',"c":[],"z":"C","t":"',
         date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), '+05:30"}')
    WHEN event_type = 'click' THEN concat('{"T":"t","S":"U', user_id, '","i":', event_id % 20, ',"p":', value,
         ',"s":', value * 3, ',"x":"N","t":"', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), 'Z"}')
    WHEN event_type = 'signup' THEN if(event_id % 2 = 0, '{"T":"success","msg":"connected"}',
         concat('{"T":"subscription","bars":["U', user_id, '"],"updatedBars":["X"]}'))
    WHEN event_id % 10 = 0 THEN concat('{"T":"b","S":"U', user_id, '","o":"bad"}')
    ELSE concat('{"T":"error","code":400,"msg":"e', event_id, '"}') END AS body
  FROM {events})
GROUP BY 1""", events=table(spark, sf_dir, "events"))


def fx_capture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw websocket frames ``(conn, frame_no, kind, body)`` with pings and closes."""
    return _sql(spark, """
SELECT user_id % 4 AS conn, event_id AS frame_no,
       CASE WHEN event_type = 'signup' THEN 'ping'
            WHEN event_type = 'error' AND event_id % 25 = 0 THEN 'close' ELSE 'text' END AS kind,
       event_type AS body
FROM {events}""", events=table(spark, sf_dir, "events"))


def fx_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Market listing pages ``(walk_id, page_no, body)``: 10 pages of 50 markets per walk.
    Page 2 repeats its cursor, page 4 its data, markets of page 3 their icon, markets of
    page 6 a key inside their tokens: the last value counts."""
    return _sql(spark, """
SELECT walk_id, page_no,
       concat('{', if(page_no = 2, '"next_cursor":"",', ''), if(page_no = 4, '"data":[{"condition_id":"no"}],', ''), if(page_no = 5, '', concat('"data":[', array_join(transform(array_sort(collect_list(struct(k, body))), x -> x.body), ','), '],')),
              '"next_cursor":"', if(page_no = 7, '', concat('c', page_no + 1)), '"}') AS body
FROM (SELECT p_partkey div 500 AS walk_id, (p_partkey % 500) div 50 AS page_no, p_partkey AS k,
        concat('{"condition_id":"0x', p_partkey % 300, '","question":"', p_name, '","active":', p_size % 2 = 0,
               ',"seconds_delay":', p_size, ',"minimum_tick_size":', p_retailprice,
               if(p_partkey % 31 = 0, ',"minimum_order_size":null', ''),
               if(p_partkey % 2 = 0, concat(',"tokens":[{', if((p_partkey % 500) div 50 = 6, '"price":0,', ''), '"price":', p_retailprice, '}]'), ''),
               if((p_partkey % 500) div 50 = 3 AND p_partkey % 50 = 7, concat(',"icon":"old","icon":"i', p_partkey, '"'), ''),
               ',"end_date_iso":"', CASE p_partkey % 3 WHEN 0 THEN '2024-06-30T00:00:00Z' WHEN 1 THEN '2024-06-30T00:00:00-04:00' ELSE 'soon' END, '"}') AS body
      FROM {part})
GROUP BY 1, 2""", part=table(spark, sf_dir, "part"))


def fx_statements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statement rows: kind 0 income, 1 balance, 2 cashflow; ``amount`` is the required
    amount of the kind, ``amount2`` the next one."""
    return _sql(spark, """
SELECT o_orderkey AS seq, o_orderkey % 3 AS kind, concat('C', o_custkey % 200) AS symbol,
       named_struct('kind', if(o_orderkey % 17 = 0, 'quarter', 'date'),
                    'date', if(o_orderkey % 17 = 0, NULL, last_day(add_months(trunc(o_orderdate, 'QUARTER'), 2))),
                    'label', if(o_orderkey % 17 = 0, concat(year(o_orderdate), 'Q', quarter(o_orderdate)), NULL)) AS period,
       if(o_orderkey % 13 = 0, NULL, named_struct('amount', cast(o_totalprice AS DECIMAL(38,10)), 'currency', 'USD')) AS amount,
       named_struct('amount', cast(round(o_totalprice / 2, 2) AS DECIMAL(38,10)), 'currency', 'USD') AS amount2,
       if(o_orderkey % 29 = 0, cast('18446744073709551615' AS DECIMAL(20,0)), cast(o_orderkey * 1000 AS DECIMAL(20,0))) AS shares_outstanding
FROM {orders}""", orders=table(spark, sf_dir, "orders"))


def fx_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calendar payloads per customer: earnings list, dividend payment and ex-dividend dates."""
    return _sql(spark, """
SELECT o_custkey AS seq, concat('C', o_custkey % 200) AS symbol,
       array_sort(collect_list(if(o_orderstatus = 'O', date_trunc('MONTH', o_orderdate), NULL))) AS earnings_dates,
       max(if(o_orderstatus = 'F', date_trunc('MONTH', o_orderdate), NULL)) AS dividend_payment_date,
       min(if(o_orderstatus = 'P', date_trunc('MONTH', o_orderdate), NULL)) AS ex_dividend_date
FROM {orders} GROUP BY o_custkey""", orders=table(spark, sf_dir, "orders"))


def fx_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of symbol lists ``(list, place, line)``, 20,000 customers each: a header,
    blank lines and lines with an empty first cell among them."""
    return _sql(spark, """
SELECT c_custkey div 20000 AS list, c_custkey AS place,
       CASE WHEN c_custkey % 7 = 3 THEN '' WHEN c_custkey % 7 = 5 THEN ',no symbol'
            ELSE concat(' C', c_custkey, ' , ', c_name) END AS line
FROM {customer} UNION ALL SELECT DISTINCT c_custkey div 20000, -1, 'Symbol,Name' FROM {customer}""",
                customer=table(spark, sf_dir, "customer"))


def fx_raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw captures ``(capture, place, line)``, one frame a line, 5,000 events a file."""
    return _sql(spark, """
SELECT event_id div 5000 AS capture, event_id AS place,
       concat('[{"T":"error","code":400,"msg":"', event_type, ' ', event_id, '"}]') AS line
FROM {events}""", events=table(spark, sf_dir, "events"))


def fx_constraints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows for the column constraints: NULL, long and padded symbols, an unknown date type."""
    return _sql(spark, """
SELECT p_partkey AS seq, if(p_partkey % 41 = 0, NULL, concat(p_name, if(p_partkey % 5 = 0, '   ', ''))) AS symbol,
       CASE p_partkey % 4 WHEN 0 THEN 'earnings' WHEN 1 THEN 'ex_dividend' WHEN 2 THEN 'dividend_payment' ELSE 'split' END AS date_type
FROM {part}""", part=table(spark, sf_dir, "part"))


def fx_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that parse but may not be writable (bad time stamp), in batches of 20 events;
    control messages (other kinds) among them."""
    return _sql(spark, """
SELECT event_id div 20 AS batch, CASE event_type WHEN 'purchase' THEN 0 WHEN 'view' THEN 1 ELSE 2 END AS type_order,
       event_id AS seq, event_type AS kind, concat('U', user_id) AS symbol, value,
       if(event_id % 37 = 0, 'not a time', date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")) AS timestamp
FROM {events}""", events=table(spark, sf_dir, "events"))


def fx_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time stamp texts: Z, +05:30, -04:00, z, no offset, ' UTC', trailing junk, nanoseconds,
    offsets up to a day and beyond, leap seconds, second 61."""
    return _sql(spark, """
SELECT event_id AS seq, concat(date_format(ts, CASE event_id % 14 WHEN 11 THEN "yyyy-MM-dd'T'HH:mm:'60'.SSSSSS"
         WHEN 12 THEN "yyyy-MM-dd'T'HH:mm:'60'" WHEN 13 THEN "yyyy-MM-dd'T'HH:mm:'61'" ELSE "yyyy-MM-dd'T'HH:mm:ss.SSSSSS" END), CASE event_id % 14
         WHEN 0 THEN 'Z' WHEN 1 THEN '+05:30' WHEN 2 THEN '-04:00' WHEN 3 THEN 'z' WHEN 4 THEN '' WHEN 5 THEN ' UTC'
         WHEN 6 THEN 'Zjunk' WHEN 7 THEN '999Z' WHEN 8 THEN '+19:00' WHEN 9 THEN '-23:59' WHEN 10 THEN '+24:00'
         WHEN 12 THEN '-19:00' ELSE 'Z' END) AS value
FROM {events}""", events=table(spark, sf_dir, "events"))
