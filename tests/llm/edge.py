"""A documents table with every awkward case, with columns that clash with the operators' own."""

from pyspark.sql import types as T

LONG = "lorem ipsum dolor sit amet " * 20_000
COPY = "\n".join(f"line {k} of a passage that stands in several documents and has many words" for k in range(12))
SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
    T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), T.StructField("set", T.StringType()),
    T.StructField("size", T.StringType()), T.StructField("_row", T.StringType()), T.StructField("ids", T.IntegerType()),
    T.StructField("row", T.LongType()), T.StructField("line", T.StringType()), T.StructField("doc", T.StringType())])


def rows():
    texts = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, LONG), (6, COPY), (7, COPY), (7, COPY), (8, COPY + "\nand a line more"),
             (9, "x" * 30_000), (10, "Grüße, İstanbul ΣΑΣ 日本語 😀 ½"), (None, COPY), (None, None), (11, "a b c d e f g\n\n\na b c d e f g"),
             (12, "token = \"abcdefghij0123456789\" mail me@example.org or +1 (555) 010-9999, 4111 1111 1111 1111, 10.0.0.1"),
             (13, "<|startoftext|>Hi there<|endoftext|>")]
    return [(d, t, None if k % 5 == 0 else "en", None if k % 4 == 0 else f"s{k % 3}", None, None, "big", "r", 3, None, "l", "d")
            for k, (d, t) in enumerate(texts)]


def edge_docs(spark):
    return spark.createDataFrame(rows(), SCHEMA)


def empty_docs(spark):
    return spark.createDataFrame([], SCHEMA)
