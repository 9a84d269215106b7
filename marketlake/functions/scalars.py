"""Scalar functions (SCL-1..12) as native Column expressions.

All of them are safe under ANSI mode: divisions and narrowing casts are
guarded with ``when`` chains so they never raise, and they stay inside
whole-stage codegen (no Python on the data path).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketlake.functions.util import col_of

_I64_MAX = 9223372036854775807
_I64_MIN = -9223372036854775808
_TWO_63 = 9223372036854775808  # 2^63, exactly representable as a double
_TWO_64 = 18446744073709551616

# Fixed value: strict RFC 3339 date-time with a mandatory offset (below a day either way).
# Upper- and lower-case T/Z and a space separator are accepted, and second 60, as the
# reference's timestamp parser does.
RFC3339_PATTERN = (r"^\d{4}-\d{2}-\d{2}[Tt ]\d{2}:\d{2}:([0-5]\d|60)([.]\d+)?"
                   r"([Zz]|[+-]([01]\d|2[0-3]):[0-5]\d)$")

# The calendar date types, in their enum order.
DATE_TYPES = ("earnings", "ex_dividend", "dividend_payment")


def _neg_zero(x: Column) -> Column:
    """True for -0.0 (only the text form keeps the sign of a zero)."""
    return (x == 0) & x.cast("string").startswith("-")


def ieee_div(num, den) -> Column:
    """IEEE-754 division: x/0 gives +-Infinity or NaN instead of an ANSI error."""
    n, d = col_of(num).cast("double"), col_of(den).cast("double")
    inf = F.lit(float("inf"))
    pos = ~_neg_zero(d)
    return (F.when(d != 0, n / F.when(d != 0, d))
            .when(n.isNull() | d.isNull(), F.lit(None).cast("double"))
            .when(F.isnan(n) | (n == 0), F.lit(float("nan")))
            .when((n > 0) == pos, inf)
            .otherwise(-inf))


def price_change(close="close", open_="open") -> Column:
    """SCL-1: close - open."""
    return col_of(close) - col_of(open_)


def price_change_percent(close="close", open_="open") -> Column:
    """SCL-2: (close - open) / open * 100, IEEE when open = 0."""
    return ieee_div(price_change(close, open_), open_) * F.lit(100.0)


def spread(ask="ask_price", bid="bid_price") -> Column:
    """SCL-3: ask - bid."""
    return col_of(ask) - col_of(bid)


def spread_bps(ask="ask_price", bid="bid_price") -> Column:
    """SCL-4: spread / bid * 10000 (relative to the bid, not the mid)."""
    return ieee_div(spread(ask, bid), bid) * F.lit(10000.0)


def ts_lenient(text) -> Column:
    """SCL-6: RFC 3339 text -> UTC wall clock (TIMESTAMP_NTZ); bad or missing -> NULL.

    The wall clock and its offset are read apart and subtracted, so every offset below a
    day counts; a leap second (second 60) is carried into the next minute. Digits past
    microseconds are cut. Independent of the session's time zone.
    """
    t = col_of(text)
    ok = t.rlike(RFC3339_PATTERN)
    leap = F.substring(t, 18, 2) == "60"
    clock = F.concat(F.substring(t, 1, 10), F.lit(" "), F.substring(t, 12, 6), F.when(leap, "59").otherwise(F.substring(t, 18, 2)),
                     F.substring(F.regexp_extract(t, r"^.{19}([.]\d+)", 1), 1, 7))
    sign = F.when(F.substring(t, -6, 1) == "-", -1).otherwise(1)
    zone = F.when(F.upper(F.right(t, F.lit(1))) == "Z", 0).otherwise(
        sign * (F.substring(t, -5, 2).try_cast("int") * 3600 + F.right(t, F.lit(2)).try_cast("int") * 60))
    shift = F.when(leap, 1).otherwise(0) - zone
    return F.when(ok, clock.try_cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), shift.cast("decimal(18,6)")))


def ts_strict_ok(text) -> Column:
    """SCL-5 validity: True when the text parses; a False row is an error (reject)."""
    return ts_lenient(text).isNotNull()


ts_strict = ts_lenient  # SCL-5 value; callers route rows with ``ts_strict_ok`` = False to rejects


def sat_bigint(x) -> Column:
    """SCL-7: ``f64 as i64`` — truncate toward zero, saturate at the bounds, NaN -> 0."""
    c = col_of(x).cast("double")
    return (F.when(c.isNull(), F.lit(None).cast("bigint"))
            .when(F.isnan(c), F.lit(0).cast("bigint"))
            .when(c >= F.lit(float(_TWO_63)), F.lit(_I64_MAX).cast("bigint"))
            .when(c < F.lit(-float(_TWO_63)), F.lit(_I64_MIN).cast("bigint"))
            .otherwise(c.cast("bigint")))


def wrap_bigint(x) -> Column:
    """SCL-8: ``u64 as i64`` — two's-complement wrap of a DECIMAL(20,0) in 0..2^64-1."""
    d = col_of(x).cast("decimal(20,0)")
    return (F.when((d < 0) | (d >= F.lit(str(_TWO_64)).cast("decimal(21,0)")), F.lit(None))
            .when(d >= F.lit(str(_TWO_63)).cast("decimal(20,0)"),
                   (d - F.lit(str(_TWO_64)).cast("decimal(21,0)")))
            .otherwise(d)).cast("bigint")


def extract_amount(money) -> Column:
    """SCL-9: money struct (amount DECIMAL(38,10), currency) -> DOUBLE, NULL-safe."""
    return col_of(money).getField("amount").cast("double")


def period_date(period) -> Column:
    """SCL-10: the period's date when its kind is 'date', else NULL."""
    p = col_of(period)
    return F.when(p.getField("kind") == "date", p.getField("date").cast("date"))


def utc_wall_clock(ts) -> Column:
    """SCL-11: instant -> UTC wall clock. TIMESTAMP_NTZ input is taken as UTC already."""
    return col_of(ts).cast("timestamp_ntz")


def date_type_code(code) -> Column:
    """SCL-12: enum ordinal (0, 1, 2) -> date type text; anything else -> NULL."""
    m = F.create_map(*[x for i, name in enumerate(DATE_TYPES) for x in (F.lit(i), F.lit(name))])
    return F.try_element_at(m, col_of(code).cast("int"))
