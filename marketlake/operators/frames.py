"""Frame parsing and tagged-union dispatch (PRJ-1..8, FLT-1, FLT-2).

A frame is one text message holding a JSON array of tagged objects. It is
accepted only when the whole text is one JSON array and every element is a
valid variant; otherwise the whole frame goes to the rejects (all-or-nothing).
Validity is computed inside the array with ``forall``, so accepting a frame
needs no shuffle: parsing is a narrow, per-row stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketlake.functions import jsontypes as J

# The message tags, in the order of the union's variants.
TAG_SUCCESS, TAG_ERROR, TAG_SUBSCRIPTION, TAG_BAR, TAG_QUOTE, TAG_TRADE = (
    "success", "error", "subscription", "b", "q", "t")
DATA_TAGS = (TAG_BAR, TAG_QUOTE, TAG_TRADE)

# Subscription lists, wire key (camelCase) -> column name.
SUBSCRIPTION_LISTS = (
    ("trades", "trades"), ("quotes", "quotes"), ("bars", "bars"), ("orderbooks", "orderbooks"),
    ("updatedBars", "updated_bars"), ("dailyBars", "daily_bars"), ("statuses", "statuses"),
    ("lulds", "lulds"), ("corrections", "corrections"), ("cancelErrors", "cancel_errors"),
)

# Wire key, column name, wire type, required? — per data message.
BAR_FIELDS = (
    ("S", "symbol", "str", True), ("o", "open", "f64", True), ("h", "high", "f64", True),
    ("l", "low", "f64", True), ("c", "close", "f64", True), ("v", "volume", "f64", True),
    ("t", "timestamp", "str", True), ("n", "trade_count", "u64", False), ("vw", "vwap", "f64", False),
)
QUOTE_FIELDS = (
    ("S", "symbol", "str", True), ("bx", "bid_exchange", "str", False), ("bp", "bid_price", "f64", True),
    ("bs", "bid_size", "f64", True), ("ax", "ask_exchange", "str", False), ("ap", "ask_price", "f64", True),
    ("as", "ask_size", "f64", True), ("c", "conditions", "list", False), ("z", "tape", "str", False),
    ("t", "timestamp", "str", True),
)
TRADE_FIELDS = (
    ("S", "symbol", "str", True), ("i", "trade_id", "u64", True), ("x", "exchange", "str", False),
    ("p", "price", "f64", True), ("s", "size", "f64", True), ("c", "conditions", "list", False),
    ("z", "tape", "str", False), ("tks", "tks", "str", False), ("t", "timestamp", "str", True),
)

_CHECKS = {"str": J.is_string, "f64": J.is_f64, "u64": J.is_u64, "list": J.is_string_list}
_TYPES = {"str": "string", "f64": "double", "u64": "decimal(20,0)", "list": "array<string>"}


def _all(cs) -> Column:
    return reduce(lambda a, b: a & b, cs)


def _fields_valid(x: Column, fields) -> Column:
    return _all([(_CHECKS[t](x, k) if req else J.optional(x, k, _CHECKS[t])) for k, _, t, req in fields])


def element_valid(x: Column) -> Column:
    """True when ``x`` deserializes as one of the six variants (unknown keys ignored)."""
    tag = J.get(x, "T", "string")
    sub_ok = _all([J.defaulted(x, k, J.is_string_list) for k, _ in SUBSCRIPTION_LISTS])
    by_tag = (F.when(tag == TAG_BAR, _fields_valid(x, BAR_FIELDS))
              .when(tag == TAG_QUOTE, _fields_valid(x, QUOTE_FIELDS))
              .when(tag == TAG_TRADE, _fields_valid(x, TRADE_FIELDS))
              .when(tag == TAG_SUCCESS, J.is_string(x, "msg"))
              .when(tag == TAG_ERROR, J.is_int_in(x, "code", 0, 65535) & J.is_string(x, "msg"))
              .when(tag == TAG_SUBSCRIPTION, sub_ok)
              .otherwise(F.lit(False)))
    return F.coalesce(J.is_string(x, "T") & by_tag, F.lit(False))


# Wire types as schema_of_variant spells them, where the type alone says that the value is
# valid. A DOUBLE may be infinite, a DECIMAL no integer: those take the long way.
_PLAIN = {"str": "STRING", "f64": r"(?:BIGINT|DECIMAL\(\d+,\d+\))", "u64": "BIGINT", "list": "ARRAY<(?:STRING|VOID)>"}


def _shape(fields) -> str:
    """A pattern of the schema of an object of these fields, whose keys come in order:
    required ones are there, optional ones too or null or missing, others are flat."""
    known = sorted([*fields, ("T", "T", "str", True)])
    other = rf"(?:(?!(?:{'|'.join(k for k, *_ in known)}): )\w+: \w+(?:\(\d+,\d+\))?(?:, |>$))*+"
    out = "^OBJECT<" + other
    for key, _, kind, required in known:
        one = rf"{key}: {_PLAIN[kind] if required else f'(?:{_PLAIN[kind]}|VOID)'}(?:, |>$)"
        out += (one if required else f"(?:{one})?+") + other
    return out + "$"


def _plainly_valid(x: Column, schema: Column, fields) -> Column:
    """Whether the element's schema settles that it is valid, with a look at the values
    of unsigned numbers and lists alone."""
    out = schema.rlike(_shape(fields))
    for key, _, kind, _ in fields:
        if kind == "u64":
            out = out & F.coalesce(J.get(x, key, "bigint") >= 0, F.lit(True))
        elif kind == "list":
            texts = J.get(x, key, "array<string>")
            out = out & F.coalesce(~F.exists(texts, lambda t: t.isNull()), F.lit(True))
    return out


def elements_valid(elements: Column) -> Column:
    """Whether every element is valid. One look at an element's schema settles bars, quotes
    and trades of the usual wire types; anything else is checked field by field."""
    seen = F.transform(elements, lambda x: F.struct(x.alias("x"), F.schema_of_variant(x).alias("s"), J.get(x, "T", "string").alias("t")))

    def valid(e: Column) -> Column:
        plain = F.lit(False)
        for tag, fields in ((TAG_BAR, BAR_FIELDS), (TAG_QUOTE, QUOTE_FIELDS), (TAG_TRADE, TRADE_FIELDS)):
            plain = F.when(e["t"] == tag, _plainly_valid(e["x"], e["s"], fields)).otherwise(plain)
        return F.when(F.coalesce(plain, F.lit(False)), F.lit(True)).otherwise(element_valid(e["x"]))

    return F.forall(seen, valid)


def _once(df: DataFrame, keep: list[str], **cols: Column) -> DataFrame:
    """Evaluate ``cols`` exactly once per row.

    The columns are produced by a generator (``inline`` of a one-element
    array): the optimizer neither pushes later filters below a generator nor
    inlines its output into later projections, so the expensive parse and
    validation are not repeated for each place that uses their result.
    """
    return df.select(*keep, F.inline(F.array(F.struct(*[c.alias(n) for n, c in cols.items()]))))


def check_frames(frames: DataFrame, body: str = "body") -> DataFrame:
    """Add ``_elements`` (array<variant>, NULL unless accepted) and ``_reason``.

    ``try_parse_json`` accepts trailing text (``[1] x``), so the text is parsed
    twice, wrapped as ``[<text>]`` and as ``{"w":<text>}``: each wrapper fails on
    what the other lets through, and together they accept exactly one JSON value.
    Each frame is parsed and validated once, on the map side (no shuffle).
    """
    b = F.col(body)
    cols = frames.columns
    step = _once(frames, cols,
                 _wrapped=F.try_parse_json(F.concat(F.lit("["), b, F.lit("]"))),
                 _closed=F.try_parse_json(F.concat(F.lit('{"w":'), b, F.lit("}"))).isNotNull())
    w = F.col("_wrapped")
    one_value = F.coalesce(F.col("_closed") & (F.size(F.try_variant_get(w, "$", "array<variant>")) == 1),
                           F.lit(False))
    arr = F.when(one_value, F.try_variant_get(w, "$[0]", "array<variant>"))
    step = _once(step, cols, _one=one_value, _arr=arr)
    step = _once(step, [*cols, "_one", "_arr"], _all=F.coalesce(elements_valid(F.col("_arr")), F.lit(False)))
    reason = (F.when(~F.col("_one"), F.lit("malformed json"))
              .when(F.col("_arr").isNull(), F.lit("not an array"))
              .when(~F.col("_all"), F.lit("invalid element")))
    return step.select(*cols, reason.alias("_reason"),
                       F.when(reason.isNull(), F.col("_arr")).alias("_elements"))


def parse_frames(frames: DataFrame, body: str = "body") -> DataFrame:
    """PRJ-1/2: accepted frames -> one row per message.

    Output: the frame's other columns, ``pos`` (element index), ``kind`` (the tag)
    and ``msg`` (the element as VARIANT). Narrow: no shuffle.
    """
    checked = check_frames(frames, body)
    keep = [c for c in frames.columns if c != body]
    return (checked.filter(F.col("_reason").isNull())
            .select(*keep, F.posexplode("_elements").alias("pos", "msg"))
            .withColumn("pos", F.col("pos").cast("bigint"))
            .withColumn("kind", J.get(F.col("msg"), "T", "string")))


def frame_rejects(frames: DataFrame, body: str = "body") -> DataFrame:
    """FLT-2: frames dropped whole, with the reason."""
    checked = check_frames(frames, body)
    keep = [c for c in frames.columns]
    return checked.filter(F.col("_reason").isNotNull()).select(*keep, F.col("_reason").alias("reason"))


def data_messages(messages: DataFrame) -> DataFrame:
    """FLT-1: drop control messages (success, error, subscription)."""
    return messages.filter(F.col("kind").isin(*DATA_TAGS))


def _typed(messages: DataFrame, tag: str, fields) -> DataFrame:
    keep = [c for c in messages.columns if c not in ("msg", "kind")]
    m = F.col("msg")
    cols = [J.get(m, k, _TYPES[t]).alias(name) for k, name, t, _ in fields]
    return messages.filter(F.col("kind") == tag).select(*keep, *cols)


def bars(messages: DataFrame) -> DataFrame:
    """PRJ-6: typed bars (trade_count as exact u64, DECIMAL(20,0))."""
    return _typed(messages, TAG_BAR, BAR_FIELDS)


def quotes(messages: DataFrame) -> DataFrame:
    """PRJ-7: typed quotes, ``conditions`` kept as ARRAY<STRING> (NULL when absent)."""
    return _typed(messages, TAG_QUOTE, QUOTE_FIELDS)


def trades(messages: DataFrame) -> DataFrame:
    """PRJ-8: typed trades (the union tag ``T`` is not a field; ``t`` is the time stamp)."""
    return _typed(messages, TAG_TRADE, TRADE_FIELDS)


def successes(messages: DataFrame) -> DataFrame:
    """PRJ-3."""
    keep = [c for c in messages.columns if c not in ("msg", "kind")]
    return (messages.filter(F.col("kind") == TAG_SUCCESS)
            .select(*keep, J.get(F.col("msg"), "msg", "string").alias("msg")))


def errors(messages: DataFrame) -> DataFrame:
    """PRJ-4: code is a u16."""
    keep = [c for c in messages.columns if c not in ("msg", "kind")]
    m = F.col("msg")
    return (messages.filter(F.col("kind") == TAG_ERROR)
            .select(*keep, J.get(m, "code", "int").alias("code"), J.get(m, "msg", "string").alias("msg")))


def subscriptions(messages: DataFrame) -> DataFrame:
    """PRJ-5: ten string lists, a missing list is ``[]``."""
    keep = [c for c in messages.columns if c not in ("msg", "kind")]
    m = F.col("msg")
    return (messages.filter(F.col("kind") == TAG_SUBSCRIPTION)
            .select(*keep, *[J.string_list(m, k, True).alias(name) for k, name in SUBSCRIPTION_LISTS]))
