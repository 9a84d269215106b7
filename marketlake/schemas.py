"""Fixed table layouts and landed-payload schemas.

Tables carry the reference's columns plus the engine's own bookkeeping:
``id`` (stable surrogate), ``received_at`` (write time), ``_batch_id`` and
``_seq`` (arrival sequence used to resolve keys).
"""

from __future__ import annotations

from pyspark.sql import types as T

# The calendar CHECK constraint.
CALENDAR_DATE_TYPES = ("earnings", "ex_dividend", "dividend_payment")

# VARCHAR(n) limits per table.
LENGTH_LIMITS = {
    "bars": {"symbol": 10},
    "quotes": {"symbol": 10, "bid_exchange": 10, "ask_exchange": 10, "tape": 5},
    "trades": {"symbol": 10, "exchange": 10, "tape": 5, "tks": 5},
    "quarterly_income_statements": {"symbol": 10},
    "quarterly_balance_sheets": {"symbol": 10},
    "quarterly_cashflow_statements": {"symbol": 10},
    "calendar_dates": {"symbol": 10, "date_type": 24},
    "polymarket_markets": {"condition_id": 66, "question_id": 66, "market_slug": 255, "fpmm": 66,
                           "neg_risk_market_id": 66, "neg_risk_request_id": 66},
}

# NOT NULL columns per table.
NOT_NULL = {
    "bars": ("symbol", "open", "high", "low", "close", "volume", "timestamp"),
    "quotes": ("symbol", "bid_price", "bid_size", "ask_price", "ask_size", "timestamp"),
    "trades": ("trade_id", "symbol", "price", "size", "timestamp"),
    "quarterly_income_statements": ("symbol",),
    "quarterly_balance_sheets": ("symbol",),
    "quarterly_cashflow_statements": ("symbol",),
    "calendar_dates": ("symbol", "date_type", "date_utc"),
    "polymarket_markets": ("condition_id",),
}

S, D, L, I, B, TS, DT, V = (T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType(),
                            T.BooleanType(), T.TimestampNTZType(), T.DateType(), T.VariantType())


def _struct(*cols) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


# Table columns (without bookkeeping), in DDL order.
TABLE_COLUMNS = {
    "bars": _struct(("symbol", S), ("open", D), ("high", D), ("low", D), ("close", D), ("volume", L),
                    ("timestamp", TS), ("trade_count", L), ("vwap", D)),
    "quotes": _struct(("symbol", S), ("bid_exchange", S), ("bid_price", D), ("bid_size", L),
                      ("ask_exchange", S), ("ask_price", D), ("ask_size", L), ("timestamp", TS), ("tape", S)),
    "trades": _struct(("trade_id", L), ("symbol", S), ("exchange", S), ("price", D), ("size", L),
                      ("timestamp", TS), ("tape", S), ("tks", S)),
    "quarterly_income_statements": _struct(("symbol", S), ("period_date", DT), ("total_revenue", D),
                                           ("gross_profit", D), ("operating_income", D), ("net_income", D)),
    "quarterly_balance_sheets": _struct(("symbol", S), ("period_date", DT), ("total_assets", D),
                                        ("total_liabilities", D), ("total_equity", D), ("cash", D),
                                        ("long_term_debt", D), ("shares_outstanding", L)),
    "quarterly_cashflow_statements": _struct(("symbol", S), ("period_date", DT), ("operating_cashflow", D),
                                             ("capital_expenditures", D), ("free_cash_flow", D), ("net_income", D)),
    "calendar_dates": _struct(("symbol", S), ("date_type", S), ("date_utc", TS)),
    "polymarket_markets": _struct(
        ("condition_id", S), ("question_id", S), ("market_slug", S), ("question", S), ("description", S),
        ("active", B), ("closed", B), ("archived", B), ("accepting_orders", B), ("enable_order_book", B),
        ("neg_risk", B), ("end_date_iso", TS), ("game_start_time", TS), ("accepting_order_timestamp", TS),
        ("minimum_order_size", D), ("minimum_tick_size", D), ("maker_base_fee", D), ("taker_base_fee", D),
        ("seconds_delay", I), ("tokens", V), ("rewards", V), ("tags", V), ("icon", S), ("image", S),
        ("fpmm", S), ("neg_risk_market_id", S), ("neg_risk_request_id", S), ("notifications_enabled", B),
        ("is_50_50_outcome", B)),
}

# Unique keys and write modes (append = no key).
TABLE_KEYS = {
    "bars": (("symbol", "timestamp"), "insert_ignore"),
    "quotes": ((), "append"),
    "trades": (("trade_id", "symbol"), "insert_ignore"),
    "quarterly_income_statements": (("symbol", "period_date"), "insert_ignore"),
    "quarterly_balance_sheets": (("symbol", "period_date"), "insert_ignore"),
    "quarterly_cashflow_statements": (("symbol", "period_date"), "insert_ignore"),
    "calendar_dates": (("symbol", "date_type", "date_utc"), "insert_ignore"),
    "polymarket_markets": (("condition_id",), "upsert"),
}

# Landed statement payload: {symbol, rows: [{period, <money>...}]}.
MONEY = _struct(("amount", T.DecimalType(38, 10)), ("currency", S))
PERIOD = _struct(("kind", S), ("date", DT), ("label", S))

STATEMENT_ROW = {
    "income": _struct(("period", PERIOD), ("total_revenue", MONEY), ("gross_profit", MONEY),
                      ("operating_income", MONEY), ("net_income", MONEY)),
    "balance": _struct(("period", PERIOD), ("total_assets", MONEY), ("total_liabilities", MONEY),
                       ("total_equity", MONEY), ("cash", MONEY), ("long_term_debt", MONEY),
                       ("shares_outstanding", T.DecimalType(20, 0))),
    "cashflow": _struct(("period", PERIOD), ("operating_cashflow", MONEY), ("capital_expenditures", MONEY),
                        ("free_cash_flow", MONEY), ("net_income", MONEY)),
}


def statement_payload(kind: str) -> T.StructType:
    return _struct(("symbol", S), ("rows", T.ArrayType(STATEMENT_ROW[kind])))


# Calendar dates are instants (UTC); the table stores them as UTC wall clock.
CALENDAR_PAYLOAD = _struct(("symbol", S), ("earnings_dates", T.ArrayType(T.TimestampType())),
                           ("dividend_payment_date", T.TimestampType()), ("ex_dividend_date", T.TimestampType()))
