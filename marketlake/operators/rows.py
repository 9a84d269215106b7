"""Typed messages -> table rows (PRJ-10..13) and column constraints (FLT-5..9).

Every mapping adds ``_error``: NULL when the row can be written, else the
reason it cannot (a bad time stamp, a NOT NULL or length constraint, a CHECK).
The error policies (``policies.py``) decide what an error does to the batch.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import scalars as S
from marketlake.schemas import CALENDAR_DATE_TYPES, LENGTH_LIMITS, NOT_NULL


def _first_error(checks: list[tuple[Column, str]]) -> Column:
    """The reason of the first failing check, in order; NULL when all pass."""
    expr = None
    for bad, reason in reversed(checks):
        expr = F.when(F.coalesce(bad, F.lit(False)), F.lit(reason)).otherwise(expr if expr is not None else F.lit(None))
    return expr.cast("string")


def fit_varchar(x, n: int) -> Column:
    """A value for VARCHAR(n): trailing spaces beyond n are cut (longer text is an error)."""
    c = x if isinstance(x, Column) else F.col(x)
    return F.when(F.char_length(c) > n, F.left(c, F.lit(n))).otherwise(c)


def too_long(x, n: int) -> Column:
    """FLT-8: longer than n characters once trailing spaces are ignored."""
    c = x if isinstance(x, Column) else F.col(x)
    return F.char_length(F.regexp_replace(c, " +$", "")) > n


def constraint_checks(table: str, df_cols: list[str]) -> list[tuple[Column, str]]:
    """FLT-7/8/9 checks of ``table`` for the columns present."""
    checks = []
    for c in NOT_NULL.get(table, ()):
        if c in df_cols:
            checks.append((F.col(c).isNull(), f"null {c}"))
    for c, n in LENGTH_LIMITS.get(table, {}).items():
        if c in df_cols:
            checks.append((too_long(c, n), f"{c} too long"))
    if table == "calendar_dates" and "date_type" in df_cols:
        checks.append((~F.col("date_type").isin(*CALENDAR_DATE_TYPES), "date_type check"))
    return checks


def apply_constraints(table: str, df: DataFrame, extra: list[tuple[Column, str]] | None = None) -> DataFrame:
    """Add ``_error`` (extra checks first, then the table's constraints) and fit VARCHARs."""
    checks = (extra or []) + constraint_checks(table, df.columns)
    out = df.withColumn("_error", _first_error(checks)) if checks else df.withColumn("_error", F.lit(None).cast("string"))
    for c, n in LENGTH_LIMITS.get(table, {}).items():
        if c in df.columns:
            out = out.withColumn(c, fit_varchar(c, n))
    return out


def _keep(df: DataFrame, drop: set[str]) -> list[str]:
    return [c for c in df.columns if c not in drop]


# ---------------------------------------------------------------- Alpaca (PRJ-11)

_BAR_IN = {"symbol", "open", "high", "low", "close", "volume", "timestamp", "trade_count", "vwap"}
_QUOTE_IN = {"symbol", "bid_exchange", "bid_price", "bid_size", "ask_exchange", "ask_price",
             "ask_size", "conditions", "tape", "timestamp"}
_TRADE_IN = {"symbol", "trade_id", "exchange", "price", "size", "conditions", "tape", "tks", "timestamp"}


def bars_rows(bars: DataFrame) -> DataFrame:
    """Typed bars -> ``bars`` columns: volume f64->i64 (truncating), trade_count u64->i64 (wrapping)."""
    ok_ts = S.ts_strict_ok("timestamp")
    out = bars.select(*_keep(bars, _BAR_IN), "symbol", "open", "high", "low", "close",
                      S.sat_bigint("volume").alias("volume"), S.ts_strict("timestamp").alias("timestamp"),
                      S.wrap_bigint("trade_count").alias("trade_count"), "vwap",
                      ok_ts.alias("_ts_ok"))
    return apply_constraints("bars", out, [(~F.col("_ts_ok"), "bad timestamp")]).drop("_ts_ok")


def quotes_rows(quotes: DataFrame) -> DataFrame:
    """Typed quotes -> ``quotes`` columns (sizes truncated to i64; conditions not stored)."""
    out = quotes.select(*_keep(quotes, _QUOTE_IN), "symbol", "bid_exchange", "bid_price",
                        S.sat_bigint("bid_size").alias("bid_size"), "ask_exchange", "ask_price",
                        S.sat_bigint("ask_size").alias("ask_size"), S.ts_strict("timestamp").alias("timestamp"),
                        "tape", S.ts_strict_ok("timestamp").alias("_ts_ok"))
    return apply_constraints("quotes", out, [(~F.col("_ts_ok"), "bad timestamp")]).drop("_ts_ok")


def trades_rows(trades: DataFrame) -> DataFrame:
    """Typed trades -> ``trades`` columns (id u64->i64 wrapping, size truncated; conditions not stored)."""
    out = trades.select(*_keep(trades, _TRADE_IN), S.wrap_bigint("trade_id").alias("trade_id"), "symbol",
                        "exchange", "price", S.sat_bigint("size").alias("size"),
                        S.ts_strict("timestamp").alias("timestamp"), "tape", "tks",
                        S.ts_strict_ok("timestamp").alias("_ts_ok"))
    return apply_constraints("trades", out, [(~F.col("_ts_ok"), "bad timestamp")]).drop("_ts_ok")


def bar_metrics(bars: DataFrame) -> DataFrame:
    """SCL-1/2 on bars."""
    return bars.withColumns({"price_change": S.price_change("close", "open"),
                             "price_change_percent": S.price_change_percent("close", "open")})


def quote_metrics(quotes: DataFrame) -> DataFrame:
    """SCL-3/4 on quotes."""
    return quotes.withColumns({"spread": S.spread("ask_price", "bid_price"),
                               "spread_bps": S.spread_bps("ask_price", "bid_price")})


# ---------------------------------------------------------------- statements (PRJ-10/12, FLT-5/6)

# Per statement kind, the table, its amount columns in order, and the
# amount that must be present.
STATEMENT_TABLES = {
    "income": ("quarterly_income_statements",
               ("total_revenue", "gross_profit", "operating_income", "net_income"), "total_revenue"),
    "balance": ("quarterly_balance_sheets",
                ("total_assets", "total_liabilities", "total_equity", "cash", "long_term_debt"), "total_assets"),
    "cashflow": ("quarterly_cashflow_statements",
                 ("operating_cashflow", "capital_expenditures", "free_cash_flow", "net_income"), "operating_cashflow"),
}


def statement_rows(statements: DataFrame, kind: str) -> DataFrame:
    """One statement kind -> its table columns, with ``_error`` for skipped rows.

    Input: ``symbol``, ``period`` struct and the kind's money structs (and
    ``shares_outstanding`` DECIMAL(20,0) for balance sheets). The period test
    comes before the required-amount test, as in the reference.
    """
    table, amounts, required = STATEMENT_TABLES[kind]
    drop = {"period", "shares_outstanding", *amounts}
    cols = [*_keep(statements, drop), S.period_date("period").alias("period_date")]
    cols += [S.extract_amount(a).alias(a) for a in amounts]
    if kind == "balance":
        cols.append(S.wrap_bigint("shares_outstanding").alias("shares_outstanding"))
    out = statements.select(*cols)
    extra = [(F.col("period_date").isNull(), "invalid period"), (F.col(required).isNull(), f"missing {required}")]
    return apply_constraints(table, out, extra)


# ---------------------------------------------------------------- markets (PRJ-13)

def market_rows(markets: DataFrame) -> DataFrame:
    """Typed markets -> ``polymarket_markets`` columns: three lenient time stamps."""
    ts_cols = ("end_date_iso", "game_start_time", "accepting_order_timestamp")
    out = markets.withColumns({c: S.ts_lenient(c) for c in ts_cols})
    return apply_constraints("polymarket_markets", out)


def valid(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_error").isNull()).drop("_error")


def invalid(df: DataFrame) -> DataFrame:
    return df.filter(F.col("_error").isNotNull())
