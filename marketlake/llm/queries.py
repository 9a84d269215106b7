"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlake.llm import (bpe, conversation_repair, decontam, hard_negatives, line_dedup, ngram_join, pii, quality_qda, rlz,
                            rules, secret_scan, sharding, toxicity)
from marketlake.llm.common import documents
from marketlake.llm.oracles import ORACLES as _ORACLES
from marketlake.llm.spans import joined


def tokenizer_path() -> str:
    """Where the public vocabulary file lies on every machine."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each document and benchmark item found in it; clean documents have none."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontam.contaminated(documents(spark, sf_dir), benchmark, carry=["doc_id"])


def op2_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.encode_decode(documents(spark, sf_dir), tokenizer_path(), carry=["doc_id"])
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = lambda c: F.crc32(F.encode(F.col(c).cast("string"), "UTF-8")) % 5
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = quality_qda.score(documents(spark, sf_dir), labels, fold("_id") != 0)
    return out.select(F.col("_id").alias("doc_id"), F.coalesce(fold("_id") == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.without_copies(documents(spark, sf_dir), carry=["doc_id"])
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = rules.ledger(documents(spark, sf_dir), carry=["doc_id"])
    base_ok = rules.passes("base")
    return led.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                      (~base_ok).alias("base_failed"), (base_ok & rules.passes("v1")).alias("kept"), "failed")


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = rlz.parse(documents(spark, sf_dir))
    return out.select(F.nullif("_d", F.lit(rlz.LEAST)).alias("doc_id"), "n_words", "n_removed", "kept_sha256")


def _per_document(docs: DataFrame, spans: DataFrame, kinds: list[str], n_base: int, extra=()) -> DataFrame:
    """One row for each document: counts of the base kinds and the digests of its
    spans. ``spans`` has ``_doc``, ``kind``, ``start``, ``end``."""
    one = F.struct("start", "kind", "end")
    grouped = spans.groupBy("_doc").agg(
        *[F.count_if(F.col("kind") == k).alias(f"n_{kinds[k]}") for k in range(n_base)], *extra,
        F.collect_list(F.when(F.col("kind") < n_base, one)).alias("base"), F.collect_set(one).alias("every"))
    out = docs.join(grouped, "_doc", "left")
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    count = [c for c in grouped.columns if c.startswith("n_")]
    return out.select(F.col("_id").alias("doc_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in count],
                      F.sha2(joined(F.coalesce("base", none), kinds), 256).alias("base_sha256"),
                      joined(F.coalesce("every", none), kinds).alias("spans"))


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    least = F.lit(ngram_join.LEAST)
    out = ngram_join.join(documents(spark, sf_dir))
    return out.select(F.nullif("_d", least).alias("doc_id"), F.nullif("class_id", least).alias("class_id"), "n_links", "n_linked_texts")


def op8_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("_repo_", F.concat_ws("/", "source", "lang"))
    rows, found = secret_scan.scan(docs, repo_col="_repo_")
    base = found.filter("kind < 3").select("_doc", "kind", "start", "end", "live")
    live = found.filter("live").select("_doc", F.lit(4).alias("kind"), F.col("from").alias("start"), "end", "live")
    spans = base.unionAll(live.distinct())
    return _per_document(rows, spans, secret_scan.KINDS, 3, [
        F.count_if((F.col("kind") < 3) & F.col("live")).alias("n_owner_specific"),
        F.count_if((F.col("kind") < 3) & ~F.col("live")).alias("n_copied")])


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = documents(spark, sf_dir).select("doc_id", "text")
    out = sharding.shard(docs.withColumn("text_crc32", F.crc32(F.encode(text, "UTF-8"))), 40)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    rows, entities = pii.find(docs)
    words = pii.disclosing(docs, entities, min_docs=1)
    spans = entities.select("_doc", "kind", "start", "end").unionAll(words.select("_doc", "kind", "start", "end"))
    return _per_document(rows, spans, pii.KINDS, 4, [
        F.count_if(F.col("kind") >= 4).alias("n_words_hidden")])


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    rows = hard_negatives.usable(vectors, moved, F.col("embedding"), F.col("vec_id"), F.col("vec_id") % 100 == 0)
    whole = F.transform("_v", lambda x: F.floor(256 * x).cast("double"))
    return hard_negatives.mine(rows.withColumn("_v", whole))


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns, conversations = conversation_repair.damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    found = conversation_repair.blocks(conversation_repair.faults(turns, conversations))
    return conversation_repair.summaries(found).withColumnRenamed("_c", "conv_id")


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    fold = lambda c: F.crc32(F.encode(F.col(c).cast("string"), "UTF-8")) % 5
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    out = toxicity.score(documents(spark, sf_dir), labels, fold("_id") != 0)
    return out.select(F.col("_id").alias("doc_id"), F.coalesce(fold("_id") == 0, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


QUERIES = {name: fn for name, fn in globals().items() if name[:2] == "op" and name[2].isdigit()}
ORACLES = {k: v for k, v in _ORACLES.items() if k in QUERIES}
