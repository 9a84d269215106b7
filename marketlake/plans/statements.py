"""Plans over landed statement / calendar / symbol payloads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketlake.functions import scalars as SC
from marketlake.operators import keyed, rows
from marketlake.plans import fixtures as fx
from marketlake.session import require_utc
from marketlake.sources import statements as ST

# The fixture's fetch units fail for these symbols: (customer % 200) % 11 = 10.
_FAILED = "(cast(substr(symbol, 2) as int) % 11 = 10)"


def statement_units(spark, sf_dir) -> DataFrame:
    """Landed fetch units ``(seq, kind, status, body)`` built from fx_statements.

    One payload per statement row (a collector may land each period separately);
    a failed fetch has a status text and no body.
    """
    s = fx.fx_statements(spark, sf_dir)
    kinds = F.element_at(F.array(*[F.lit(k) for k in ST.STATEMENT_KINDS]), (F.col("kind") + 1).cast("int"))

    def payload(row):
        return F.to_json(F.struct("symbol", F.array(row).alias("rows")))
    body = (F.when(F.col("kind") == 0, payload(F.struct("period", F.col("amount").alias("total_revenue"),
                                                        F.col("amount2").alias("gross_profit"))))
            .when(F.col("kind") == 1, payload(F.struct("period", F.col("amount").alias("total_assets"),
                                                       F.col("amount2").alias("total_liabilities"),
                                                       "shares_outstanding")))
            .otherwise(payload(F.struct("period", F.col("amount").alias("operating_cashflow"),
                                        F.col("amount2").alias("capital_expenditures")))))
    failed = F.expr(_FAILED)
    return ST.check_units(s.select("seq", kinds.alias("kind"), "symbol",
                                   F.when(failed, F.lit("error: fetch failed")).otherwise(F.lit("ok")).alias("status"),
                                   F.when(~failed, body).alias("body")))


def _units(spark, sf_dir):
    return statement_units(spark, sf_dir).drop("symbol")


def scanned(spark, sf_dir, kind):
    return ST.scan_statements(_units(spark, sf_dir), kind)


_REQUIRED = {"income": ("total_revenue", "gross_profit"), "balance": ("total_assets", "total_liabilities"),
             "cashflow": ("operating_cashflow", "capital_expenditures")}


def q_scan_statements(spark, sf_dir):
    """SRC-5: one typed row per period, tagged with the symbol, all three kinds."""
    out = None
    for kind in ST.STATEMENT_KINDS:
        a, b = _REQUIRED[kind]
        part = scanned(spark, sf_dir, kind).select(
            "seq", "kind", "symbol", F.col("period.kind").alias("period_kind"),
            F.col("period.date").alias("period_raw_date"), SC.extract_amount(a).alias("amount"),
            SC.extract_amount(b).alias("amount2"))
        out = part if out is None else out.unionByName(part)
    return out


def q_statement_flatten(spark, sf_dir):
    """PRJ-10: income statement rows with the symbol beside the flattened row."""
    s = scanned(spark, sf_dir, "income")
    return s.select("seq", "pos", "symbol", F.col("period.kind").alias("period_kind"),
                    F.col("period.date").alias("period_raw_date"), F.col("period.label").alias("period_label"),
                    *[SC.extract_amount(c).alias(c) for c in
                      ("total_revenue", "gross_profit", "operating_income", "net_income")])


def statement_rows(spark, sf_dir, kind):
    return rows.statement_rows(scanned(spark, sf_dir, kind), kind).drop("kind", "status")


def q_income_rows(spark, sf_dir):
    """PRJ-12 income: period date, amounts as doubles, ``_error`` for skipped rows."""
    return statement_rows(spark, sf_dir, "income")


def q_balance_rows(spark, sf_dir):
    """PRJ-12 balance: ``shares_outstanding`` u64 wrapped to BIGINT."""
    return statement_rows(spark, sf_dir, "balance")


def q_cashflow_rows(spark, sf_dir):
    return statement_rows(spark, sf_dir, "cashflow")


def q_statement_rejects(spark, sf_dir):
    """FLT-5/6: statements skipped, with the reason (period first, then the amount)."""
    out = None
    for kind in ST.STATEMENT_KINDS:
        part = rows.invalid(statement_rows(spark, sf_dir, kind)).select(
            "seq", F.lit(kind).alias("kind"), F.col("_error").alias("reason"))
        out = part if out is None else out.unionByName(part)
    return out


def _sink(spark, sf_dir, kind):
    return keyed.insert_ignore(rows.valid(statement_rows(spark, sf_dir, kind)), ["symbol", "period_date"],
                               ["seq", "pos"])


def q_sink_income(spark, sf_dir):
    """SNK-7: insert-ignore on (symbol, period_date)."""
    return _sink(spark, sf_dir, "income")


def q_sink_balance(spark, sf_dir):
    return _sink(spark, sf_dir, "balance")


def q_sink_cashflow(spark, sf_dir):
    return _sink(spark, sf_dir, "cashflow")


def q_extract_amount(spark, sf_dir):
    """SCL-9: money -> double, NULL-safe."""
    return fx.fx_statements(spark, sf_dir).select("seq", SC.extract_amount("amount").alias("amount"))


def q_period_date(spark, sf_dir):
    """SCL-10: the period's date when its kind is 'date'."""
    return fx.fx_statements(spark, sf_dir).select("seq", SC.period_date("period").alias("period_date"))


def q_wrap_bigint(spark, sf_dir):
    """SCL-8: u64 -> i64 two's-complement wrap."""
    return fx.fx_statements(spark, sf_dir).select("seq", SC.wrap_bigint("shares_outstanding").alias("shares"))


def q_sat_bigint(spark, sf_dir):
    """SCL-7: f64 -> i64 truncating and saturating, NaN -> 0."""
    ev = fx.table(spark, sf_dir, "events")
    x = (F.when(F.col("event_id") % 4 == 0, F.col("value")).when(F.col("event_id") % 4 == 1, -F.col("value"))
         .when(F.col("event_id") % 4 == 2, F.col("value") * F.lit(1e18)).otherwise(F.lit(float("nan"))))
    return ev.select(F.col("event_id").alias("seq"), SC.sat_bigint(x).alias("as_bigint"))


def symbols(spark, sf_dir):
    from marketlake.plans.sources import land_lines

    lists = ST.read_symbols(spark, land_lines(fx.fx_symbols(spark, sf_dir), "list", "\r\n"))
    return lists.select(F.col("list").cast("bigint").alias("list"), "line_no", "symbol")


def q_load_symbols(spark, sf_dir):
    """SRC-7: symbols from CSV files, with line numbers."""
    return symbols(spark, sf_dir)


def q_symbol_scan(spark, sf_dir):
    """SRC-8: only the payloads of the listed symbols."""
    return ST.symbol_scan(statement_units(spark, sf_dir), symbols(spark, sf_dir)).select("seq", "kind", "symbol")


def q_fetch_policy_skip(spark, sf_dir):
    """SRC-9 skip: failed units are recorded, the rest go on."""
    return ST.fetch_ok(statement_units(spark, sf_dir)).select("seq", "kind", "symbol")


def q_fetch_errors(spark, sf_dir):
    """SRC-9: one row per failed (symbol, statement type)."""
    return ST.fetch_errors(statement_units(spark, sf_dir))


def q_fetch_policy_fail(spark, sf_dir):
    """SRC-9 fail: the first failed unit in fetch order ends the source."""
    u = statement_units(spark, sf_dir)
    kind_order = F.array_position(F.array(*[F.lit(k) for k in ST.FETCH_ORDER]), F.col("kind"))
    u = u.withColumns({"symbol_no": F.substring("symbol", 2, 12).cast("int"), "kind_no": kind_order})
    return ST.cut_at_first_failure(u, ["symbol_no", "kind_no"]).select("seq", "kind", "symbol")


def calendar_units(spark, sf_dir) -> DataFrame:
    c = fx.fx_calendar(spark, sf_dir)
    body = F.to_json(F.struct("symbol", "earnings_dates", "dividend_payment_date", "ex_dividend_date"))
    return c.select("seq", F.lit("calendar").alias("kind"), F.lit("ok").alias("status"), body.alias("body"))


def calendar_rows(spark, sf_dir):
    require_utc(spark)
    return ST.calendar_unpivot(ST.scan_calendar(calendar_units(spark, sf_dir)).drop("kind", "status"))


def q_calendar_unpivot(spark, sf_dir):
    """SRC-6 / SET-1 / SCL-11: earnings dates, then dividend payment, then ex-dividend."""
    return calendar_rows(spark, sf_dir)


def q_sink_calendar(spark, sf_dir):
    """SNK-8: insert-ignore on (symbol, date_type, date_utc)."""
    r = rows.valid(rows.apply_constraints("calendar_dates", calendar_rows(spark, sf_dir)))
    return keyed.insert_ignore(r, ["symbol", "date_type", "date_utc"], ["seq", "ord"])


def q_date_type_code(spark, sf_dir):
    """SCL-12: enum ordinal -> date type text."""
    o = fx.table(spark, sf_dir, "orders")
    return o.select(F.col("o_orderkey").alias("seq"), SC.date_type_code(F.col("o_orderkey") % 4).alias("date_type"))


def q_constraint_check(spark, sf_dir):
    """FLT-7/8/9: NOT NULL, VARCHAR length (trailing spaces cut) and CHECK on calendar rows."""
    return rows.apply_constraints("calendar_dates", fx.fx_constraints(spark, sf_dir))
