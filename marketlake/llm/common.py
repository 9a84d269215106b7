"""Shared helpers: tables in the shared folder, rows carried as structs, Arrow passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from marketlake.session import scratch_dir

#: The six ASCII characters that separate words; every other character belongs to one.
WORD_BREAKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, for a written table."""
    return f"{scratch_dir(spark, name)}/table"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a table in the shared folder and read again: a cut of the
    lineage that later joins can deal out anew (and split where a key is hot)."""
    path = shared_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_of(col: str = "text") -> Column:
    """The text, NULL as the empty text."""
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def packed(docs: DataFrame, **extra: Column) -> DataFrame:
    """The whole row as the struct ``_row`` beside the columns an operator works on,
    so that no column of the input can clash with one of the operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row"),
                       *[c.alias(k) for k, c in extra.items()])


def unpacked(df: DataFrame, *extra: str) -> DataFrame:
    """The columns of ``_row``, then ``extra``, which replace input columns of the same name."""
    fields = [f for f in df.schema["_row"].dataType.names if f.lower() not in {x.lower() for x in extra}]
    return df.select(*[F.col(f"_row.`{f}`").alias(f) for f in fields], *extra)


def add_columns(docs: DataFrame, fn, schema: T.StructType, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """One narrow Arrow pass: ``fn(Arrow texts)`` yields, for consecutive runs of
    them, ``(count, {column: Arrow array})``; the input row is carried untouched
    (``carry``: only these columns of it; the text need not travel twice)."""
    rows = packed(docs, _text=text_of(text_col))
    if carry is not None:
        rows = rows.withColumn("_row", F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in carry]))
    out = T.StructType([rows.schema["_row"], *schema.fields])
    names = ["_row", *schema.names]

    def run(batches):
        import pyarrow as pa
        for batch in batches:
            row, at = batch.column(0), 0
            for n, cols in fn(batch.column(1)):
                yield pa.RecordBatch.from_arrays([row.slice(at, n), *[cols[c] for c in schema.names]], names=names)
                at += n

    return unpacked(rows.mapInArrow(run, out), *schema.names)


def slices(texts, most_bytes: int = 2_000_000):
    """Consecutive runs of texts of about ``most_bytes`` each (at least one text),
    as Python strings: what a task holds as objects stays small."""
    import pyarrow.compute as pc
    at, n = 0, len(texts)
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_pylist()
    while at < n:
        to, size = at + 1, sizes[at]
        while to < n and size + sizes[to] <= most_bytes:
            size += sizes[to]
            to += 1
        yield texts.slice(at, to - at).to_pylist()
        at = to
