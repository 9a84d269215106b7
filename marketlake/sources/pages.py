"""Paged market listings (SRC-4, PRJ-9, FLT-3/4).

Landed form: ``(walk_id, page_no, body)``, one row per fetched page, where the
body is ``{"data": [market...], "next_cursor": "..."}``. A walk reads pages in
``page_no`` order and stops after the first page whose cursor is missing, not
a string or empty; a page that is no JSON ends the walk before it (see
``page_rejects``). Of a key that a page, a market or a JSON column of it repeats, the
last value counts, as with any reader of generic JSON. A page without a ``data`` array
contributes nothing, but the walk goes on.

The stop page of each walk is one ``groupBy(walk_id).agg(min)`` (partial
aggregation on the map side, one row per walk) joined back to the pages; AQE
broadcasts that side when it measures it small, and splits a walk that holds
a large share of the pages (skew join) otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import jsontypes as J
from marketlake.operators.frames import _all, _once

# Market fields by wire type. Optional strings (missing or null -> NULL).
MARKET_OPT_STRINGS = ("question_id", "market_slug", "question", "description", "end_date_iso",
                      "game_start_time", "accepting_order_timestamp", "icon", "image", "fpmm",
                      "neg_risk_market_id", "neg_risk_request_id")
# Booleans defaulting to false when missing (null is an error).
MARKET_BOOLS = ("active", "closed", "archived", "accepting_orders", "enable_order_book", "neg_risk",
                "notifications_enabled", "is_50_50_outcome")
# Doubles defaulting to 0 when missing (null is an error).
MARKET_F64 = ("minimum_order_size", "minimum_tick_size", "maker_base_fee", "taker_base_fee")
# 32-bit integer defaulting to 0.
MARKET_I32 = ("seconds_delay",)
# Any JSON value, JSON null when missing.
MARKET_JSON = ("tokens", "rewards", "tags")

# Table column order (the DDL's).
MARKET_COLUMNS = ("condition_id", "question_id", "market_slug", "question", "description", "active", "closed",
                  "archived", "accepting_orders", "enable_order_book", "neg_risk", "end_date_iso",
                  "game_start_time", "accepting_order_timestamp", "minimum_order_size", "minimum_tick_size",
                  "maker_base_fee", "taker_base_fee", "seconds_delay", "tokens", "rewards", "tags", "icon",
                  "image", "fpmm", "neg_risk_market_id", "neg_risk_request_id", "notifications_enabled",
                  "is_50_50_outcome")


# Landed page (JSON lines or Parquet).
PAGE_SCHEMA = "walk_id bigint, page_no bigint, body string"


def read_pages(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed pages (batch), declared schema."""
    return spark.read.schema(PAGE_SCHEMA).format(fmt).load(path)


def read_pages_stream(spark: SparkSession, path: str, fmt: str = "json",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed pages as a stream; one file is one admission unit."""
    r = spark.readStream.schema(PAGE_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r.format(fmt).load(path)


#: from_json reads what JSON allows, no more.
_STRICT = {"allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "columnNameOfCorruptRecord": "_bad"}


def _object(text: Column) -> Column:
    """A JSON object as VARIANT, the last of repeated keys (not inside its values); NULL
    for anything else. VARIANT's own reader refuses a repeated key, a map keeps all pairs."""
    pairs = F.map_entries(F.from_json(text, "map<string,variant>", _STRICT))
    last = F.filter(pairs, lambda e, i: ~F.exists(F.slice(pairs, i + 2, F.size(pairs)), lambda x: x["key"] == e["key"]))
    return F.when(text.startswith("{"), F.to_variant_object(F.map_from_entries(last)))


def _value(text: Column) -> Column:
    """Any JSON text (as from_json hands on a value: a string without its quotes) as
    VARIANT; repeated keys of an object, or of the objects of a list, are resolved."""
    items = F.from_json(text, "array<string>", _STRICT)
    plain = lambda e: F.when(~e.rlike(r"^[\[{]"), e.cast("variant"))
    listed = F.transform(items, lambda e: F.coalesce(F.try_parse_json(e), _object(e), plain(e)))
    whole = F.when(text.startswith("[") & ~F.exists(listed, lambda e: e.isNull()), F.to_variant_object(listed))
    return F.coalesce(F.try_parse_json(text), _object(text), whole, plain(text))


def _market(text: Column) -> Column:
    """A list element of a page that repeats keys: an object's own keys first; where a JSON
    column of it repeats some inside, field by field. An element that repeats keys deeper
    stays a text, and so no market."""
    known = [k for k in MARKET_COLUMNS if k not in MARKET_JSON]
    fields = F.from_json(text, ", ".join([f"`{k}` variant" for k in known] + [f"`{k}` string" for k in MARKET_JSON]), _STRICT)
    values = [fields[k] for k in known] + [_value(fields[k]) for k in MARKET_JSON]
    lost = F.lit(False)
    for k in MARKET_JSON:
        lost = lost | (fields[k].isNotNull() & _value(fields[k]).isNull())
    present = F.filter(F.array(*[F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in
                                 zip(known + list(MARKET_JSON), values)]), lambda e: e["value"].isNotNull())
    by_field = F.when(text.startswith("{") & fields.isNotNull() & ~lost, F.to_variant_object(F.map_from_entries(present)))
    return F.coalesce(F.try_parse_json(text), _object(text), by_field, text.cast("variant"))


def _repeated(body: Column) -> Column:
    """A text that VARIANT refuses, if it is one JSON value all the same, as the page that
    a reader which keeps the last of repeated keys gives. The same two parses as in
    ``parse_pages`` tell whether it is one."""
    closed = F.from_json(F.concat(F.lit('{"w":'), body, F.lit("}")), "w string, _bad string", _STRICT)
    values = F.from_json(F.concat(F.lit("["), body, F.lit("]")), "array<string>", _STRICT)
    one = closed["_bad"].isNull() & closed["w"].isNotNull() & (F.size(values) == 1)
    data = F.from_json(body, "data array<string>", _STRICT)["data"]
    cursor = F.from_json(body, "next_cursor variant", _STRICT)["next_cursor"]
    return F.when(one, F.to_variant_object(F.struct(F.transform(data, _market).alias("data"), cursor.alias("next_cursor"))))


def parse_pages(pages: DataFrame, body: str = "body") -> DataFrame:
    """Adds ``_page`` (pages that have it are left as they are): the body as VARIANT when it is exactly one JSON value, else NULL.
    Each of the two parses (one would let text after the value pass) runs once; only what
    they refuse is read again, for repeated keys."""
    if "_page" in pages.columns:
        return pages
    text = F.col(body)
    both = _once(pages, pages.columns, _w=F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))),
                 _closed=F.try_parse_json(F.concat(F.lit('{"w":'), text, F.lit("}"))).isNotNull())
    values = F.try_variant_get("_w", "$", "array<variant>")
    one = F.coalesce(F.col("_closed") & (F.size(values) == 1), F.lit(False))
    page = F.when(one, F.try_variant_get("_w", "$[0]", "variant")).when(F.col("_w").isNull(), _repeated(text))
    return _once(both.select(*pages.columns, "_w", "_closed"), pages.columns, _page=page)


def _stops(parsed: DataFrame, walk: str, page: str) -> DataFrame:
    """Last page read per walk: a page that is no JSON stops the walk before itself, a
    page without a usable cursor stops it after itself. One row per walk."""
    p = F.col("_page")
    cursor_ok = J.is_string(p, "next_cursor") & (J.get(p, "next_cursor", "string") != "")
    return (parsed.select(walk, F.when(p.isNull(), F.col(page) - 1).when(~cursor_ok, F.col(page)).alias("_last"))
            .groupBy(walk).agg(F.min("_last").alias("_last")))


def walk_stops(pages: DataFrame, walk: str = "walk_id", page: str = "page_no", body: str = "body") -> DataFrame:
    """``(walk, _last)``: the last page each walk reads (NULL: not stopped yet)."""
    return _stops(parse_pages(pages, body), walk, page)


def walked_pages(pages: DataFrame, walk: str = "walk_id", page: str = "page_no", body: str = "body") -> DataFrame:
    """SRC-4: the pages a cursor walk reads, with ``page`` (VARIANT) and ``raw_markets``."""
    p = F.col("_page")
    parsed = parse_pages(pages, body)
    stops = _stops(parsed, walk, page)
    data = F.try_variant_get(p, "$.data", "array<variant>")
    return (parsed.join(stops, on=walk, how="left")
            .filter(F.col("_last").isNull() | (F.col(page) <= F.col("_last")))
            .select(*[c for c in pages.columns if c not in (body, "_page")], p.alias("page"),
                    F.size(data).alias("raw_markets"))
            .withColumn("raw_markets", F.when(F.col("raw_markets") >= 0, F.col("raw_markets"))))


def market_valid(m: Column) -> Column:
    """FLT-3: the element deserializes as a market (unknown keys ignored)."""
    checks = [J.is_string(m, "condition_id")]
    checks += [J.optional(m, k, J.is_string) for k in MARKET_OPT_STRINGS]
    checks += [J.defaulted(m, k, J.is_bool) for k in MARKET_BOOLS]
    checks += [J.defaulted(m, k, J.is_f64) for k in MARKET_F64]
    checks += [J.defaulted(m, k, lambda v, key, **kw: J.is_int_in(v, key, -2147483648, 2147483647, **kw))
               for k in MARKET_I32]
    return F.coalesce(_all(checks), F.lit(False))


def raw_markets(walked: DataFrame) -> DataFrame:
    """Unnest ``$.data`` of the walked pages: one row per raw element, with ``pos`` and ``valid``."""
    keep = [c for c in walked.columns if c not in ("page", "raw_markets")]
    data = F.try_variant_get(F.col("page"), "$.data", "array<variant>")
    elements = (walked.select(*keep, F.posexplode(data).alias("pos", "m"))
                .withColumn("pos", F.col("pos").cast("bigint")))
    return _once(elements, elements.columns, valid=market_valid(F.col("m")))


def typed_markets(raw: DataFrame) -> DataFrame:
    """PRJ-9: valid markets as typed columns, defaults applied."""
    keep = [c for c in raw.columns if c not in ("m", "valid")]
    m = F.col("m")
    cols = {"condition_id": J.get(m, "condition_id", "string")}
    cols.update({k: J.get(m, k, "string") for k in MARKET_OPT_STRINGS})
    cols.update({k: F.coalesce(J.get(m, k, "boolean"), F.lit(False)) for k in MARKET_BOOLS})
    cols.update({k: F.coalesce(J.get(m, k, "double"), F.lit(0.0)) for k in MARKET_F64})
    cols.update({k: F.coalesce(J.get(m, k, "int"), F.lit(0)) for k in MARKET_I32})
    cols.update({k: F.coalesce(J.get(m, k, "variant"), F.parse_json(F.lit("null"))) for k in MARKET_JSON})
    return raw.filter("valid").select(*keep, *[cols[c].alias(c) for c in MARKET_COLUMNS])


def page_rejects(pages: DataFrame, walk: str = "walk_id", page: str = "page_no", body: str = "body") -> DataFrame:
    """Pages that are no JSON, and so end their walk, with their text."""
    return (parse_pages(pages, body).filter(F.col("_page").isNull())
            .select(walk, page, F.lit(None).cast("bigint").alias("pos"), body, F.lit("malformed page").alias("reason")))


def market_rejects(raw: DataFrame) -> DataFrame:
    """FLT-3: elements skipped, kept for inspection with their JSON text."""
    keep = [c for c in raw.columns if c not in ("m", "valid")]
    return raw.filter(~F.col("valid")).select(*keep, F.to_json(F.col("m")).alias("body"),
                                               F.lit("invalid market").alias("reason"))
