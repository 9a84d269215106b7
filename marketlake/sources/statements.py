"""Quarterly statements, calendar dates and symbol lists (SRC-5..9).

Landed form of a fetch unit: ``(seq, kind, status, body)`` where ``kind`` is
``income``, ``balance``, ``cashflow`` or ``calendar``, ``status`` is ``ok`` or
the fetch error, and ``body`` is the JSON payload
``{"symbol": ..., "rows": [...]}`` (statements) or
``{"symbol": ..., "earnings_dates": [...], "dividend_payment_date": ...,
"ex_dividend_date": ...}`` (calendar). Files are read with
``spark.read[Stream].schema(...).json``/``text``; the functions here take the
DataFrame so that batch and streaming share them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlake.functions import scalars as SC
from marketlake.schemas import CALENDAR_PAYLOAD, statement_payload
from marketlake.sources.lines import numbered_lines

# Landed fetch unit (JSON lines or Parquet).
UNIT_SCHEMA = "seq bigint, kind string, symbol string, status string, body string"

STATEMENT_KINDS = ("income", "balance", "cashflow")
# Fetch order of the data kinds of one symbol.
FETCH_ORDER = ("income", "balance", "cashflow", "calendar")


def _reader(spark: SparkSession, schema: str, stream: bool, max_files_per_trigger: int | None):
    r = (spark.readStream if stream else spark.read).schema(schema)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return r


def read_units(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Landed fetch units (batch), declared schema."""
    return _reader(spark, UNIT_SCHEMA, False, None).format(fmt).load(path)


def read_units_stream(spark: SparkSession, path: str, fmt: str = "json",
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """Landed fetch units as a stream; one file is one admission unit."""
    return _reader(spark, UNIT_SCHEMA, True, max_files_per_trigger).format(fmt).load(path)


def scan_statements(units: DataFrame, kind: str, body: str = "body") -> DataFrame:
    """SRC-5 / PRJ-10: one row per statement period of ``kind``, tagged with the symbol.

    Output: the unit's other columns, ``pos`` (row index in the payload),
    ``symbol`` and the row's fields flattened (``period``, money structs...).
    """
    keep = [c for c in units.columns if c not in (body, "symbol")]  # the payload's symbol is used
    parsed = (units.filter(F.col("kind") == kind)
              .select(*keep, F.from_json(F.col(body), statement_payload(kind)).alias("_p")))
    return (parsed.select(*keep, F.col("_p.symbol").alias("symbol"),
                          F.posexplode("_p.rows").alias("pos", "_row"))
            .select(*keep, F.col("pos").cast("bigint").alias("pos"), "symbol", "_row.*"))


def scan_calendar(units: DataFrame, body: str = "body") -> DataFrame:
    """Calendar payloads as columns (``symbol``, ``earnings_dates``, two optional dates)."""
    keep = [c for c in units.columns if c not in (body, "symbol")]
    return (units.filter(F.col("kind") == "calendar")
            .select(*keep, F.from_json(F.col(body), CALENDAR_PAYLOAD).alias("_p"))
            .select(*keep, "_p.*"))


def calendar_unpivot(cal: DataFrame) -> DataFrame:
    """SRC-6 / SET-1 / SCL-11: calendar payload -> rows, in the order earnings dates
    (list order), dividend payment date, ex-dividend date. One ``inline`` over a
    concatenated array (a bag union, no dedupe), so no union of three scans."""
    keep = [c for c in cal.columns if c not in ("symbol", "earnings_dates", "dividend_payment_date",
                                                  "ex_dividend_date")]

    def entry(date_type: str, d: Column) -> Column:
        return F.when(d.isNotNull(), F.struct(F.lit(date_type).alias("date_type"),
                                               SC.utc_wall_clock(d).alias("date_utc")))
    earn = F.transform(F.coalesce("earnings_dates", F.array().cast("array<timestamp>")),
                       lambda d: entry("earnings", d))
    rows = F.array_compact(F.concat(earn, F.array(entry("dividend_payment", F.col("dividend_payment_date"))),
                                    F.array(entry("ex_dividend", F.col("ex_dividend_date")))))
    return (cal.select(*keep, "symbol", F.posexplode(rows).alias("ord", "_e"))
            .select(*keep, "symbol", F.col("ord").cast("bigint").alias("ord"), "_e.date_type", "_e.date_utc"))


def _symbols(lines: DataFrame, place: Sequence[str]) -> DataFrame:
    """The symbol of each line (``line_no``, ``line``) that has one."""
    def trim(c: Column) -> Column:
        return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")
    t = lines.select(*place, F.col("line_no").cast("bigint").alias("line_no"), trim(F.regexp_replace("line", "\r$", "")).alias("line"))
    header = (F.col("line_no") == 0) & F.lower(F.col("line")).startswith("symbol")
    cell = trim(F.split_part(F.col("line"), F.lit(","), F.lit(1)))
    return (t.filter((F.col("line") != "") & ~header).select(*place, "line_no", cell.alias("symbol"))
            .filter(F.col("symbol") != ""))


def read_symbols(spark: SparkSession, path: str) -> DataFrame:
    """SRC-7: the symbol lists at ``path`` (a CSV file, or a folder of them): first column,
    trimmed; blank lines skipped; line 0 of a file skipped when it starts with "symbol"
    (any case); empty cells dropped; no quote handling; duplicates and order kept.
    Output ``(file, line_no, symbol)`` and the folders' columns. A large file is read by
    many tasks (``sources/lines.py``)."""
    lines = numbered_lines(spark, path)
    return _symbols(lines, ["file", *[c for c in lines.columns if c not in ("file", "file_time", "line_no", "line")]])


def load_symbols(text: DataFrame, value: str = "value") -> DataFrame:
    """SRC-7 for lists that are texts already, one a row: ``(line_no, symbol)``, by the
    rules of ``read_symbols``."""
    return _symbols(text.select(F.posexplode(F.split(F.col(value), "\n")).alias("line_no", "line")), [])


def symbol_scan(units: DataFrame, symbols: DataFrame, symbol_col: str = "symbol") -> DataFrame:
    """SRC-8: keep the payloads of the listed symbols only (left semi join).

    The symbol list is small and bounded by the listing (one row per line of a
    CSV file); AQE turns the semi join into a broadcast when it measures it so.
    """
    return units.join(symbols.select(F.col("symbol").alias(symbol_col)).distinct(), on=symbol_col,
                      how="left_semi")


def check_units(units: DataFrame, body: str = "body") -> DataFrame:
    """A landed unit whose fetch reported success but whose payload is missing, is not
    valid JSON, or has not the payload's shape (an object with a text ``symbol``,
    and for statements an array ``rows``) counts as a failed fetch, so the fetch
    policies see it instead of it vanishing in a lenient parse. Parsed once."""
    v = F.try_parse_json(F.col(body))
    kind_of = lambda key: F.schema_of_variant(F.try_variant_get(F.col("_v"), key, "variant"))
    rows_ok = (F.col("kind") == "calendar") | F.coalesce(kind_of("$.rows").startswith("ARRAY<"), F.lit(False))
    shape_ok = F.coalesce(kind_of("$.symbol") == "STRING", F.lit(False)) & rows_ok
    reason = (F.when(F.col("_v").isNull(), "error: malformed payload").when(~shape_ok, "error: unexpected payload"))
    return (units.withColumn("_v", v)
            .withColumn("status", F.when(F.col("status") == "ok", F.coalesce(reason, F.lit("ok"))).otherwise(F.col("status")))
            .drop("_v"))


def fetch_ok(units: DataFrame) -> DataFrame:
    """SRC-9 ``skip``: units whose fetch succeeded; the others go on."""
    return units.filter(F.col("status") == "ok")


def fetch_errors(units: DataFrame, unit: Sequence[str] = ("seq", "symbol", "kind")) -> DataFrame:
    """SRC-9: one row per failed unit (place, symbol, statement type, error)."""
    return units.filter(F.col("status") != "ok").select(*unit, F.col("status").alias("error"))


def cut_at_first_failure(units: DataFrame, order: Sequence[str]) -> DataFrame:
    """SRC-9 ``fail``: the first failed unit (by ``order``) ends the source; units
    before it are kept. The cut is one scalar subquery (a global min over the
    failed units, partially aggregated), so no join and no cross product."""
    first_bad = (units.filter(F.col("status") != "ok")
                 .select(F.min(F.struct(*order)).alias("cut")))
    cut = first_bad.scalar()
    return units.filter(cut.isNull() | (F.struct(*order) < cut))
