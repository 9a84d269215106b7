"""Training corpus pipeline: quality rules, line dedup, near duplicates, benchmark
decontamination, tokens. Each stage reads what its predecessor wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlake.llm import bpe, decontam, line_dedup, ngram_join, rules
from marketlake.llm.common import documents, shared_path
from marketlake.llm.queries import tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the current policy."""
    return rules.keep(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs are deleted; a document of which nothing
    is left goes. ``n_chars`` counts what is left."""
    out = line_dedup.without_copies(docs)
    left = out.filter(F.col("n_removed") < F.col("n_lines"))
    return left.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near duplicates stays."""
    return ngram_join.one_of_each(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontam.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of every remaining text, packed, and the text they decode to."""
    return bpe.encode_decode(docs, tokenizer_path(), carry=["doc_id", "lang", "source"])


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", dedup_lines),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", decontaminate),
    ("tokens", tokens),
]

#: Merges of a vocabulary file and edit distances of sampled windows cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        path = shared_path(spark, f"corpus-{name.replace(' ', '-')}")
        out.write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
