"""Histogram sort: balance, slots, groups, hot texts."""

import random
from collections import Counter

from pyspark.sql import functions as F

from marketlake.llm import sharding


def check(out, n_shards, n_rows, slack):
    rows = out.collect()
    assert len(rows) == n_rows
    size, slots = Counter(), {}
    for r in rows:
        size[r.shard] += r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert all(0 <= s < n_shards for s in size)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    mean = sum(size.values()) / n_shards
    assert all(abs(size[s] - mean) <= slack for s in range(n_shards)), size


def test_equal_bytes_with_a_hot_text(spark):
    rng = random.Random(2)
    rows = [(k, "".join(rng.choice("abc é") for _ in range(rng.randrange(200)))) for k in range(3000)]
    rows += [(10_000 + 7 * k, "the same text again and again") for k in range(1500)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = sharding.shard(df, 8).cache()
    check(out, 8, 4500, 1300)
    split = out.filter("length(text) > 0 AND text NOT LIKE 'the same%'").groupBy("text").agg(F.count_distinct("shard").alias("n")).filter("n > 1")
    assert split.count() == 0  # groups below the tolerance are never cut
    want = {d: len(t.encode()) + 16 for d, t in rows}
    assert all(r.size == want[r.doc_id] for r in out.collect())


def test_edges(spark, docs, none):
    out = sharding.shard(docs, 3)
    rows = out.collect()
    assert len(rows) == docs.count() and set(out.columns) == {*docs.columns, "shard", "slot"}
    assert sharding.shard(none, 3).count() == 0
    same = spark.createDataFrame([(1, "x")] * 50, "doc_id long, text string")
    check(sharding.shard(same, 4), 4, 50, 50 * 17)


def test_ids_over_the_whole_range(spark):
    ids = [-(2 ** 63), 2 ** 63 - 1, 0, -5, 2 ** 62] + [2 ** 63 - 1 - k for k in range(1, 400)]
    df = spark.createDataFrame([(d, "hot") for d in ids], "doc_id long, text string")
    check(sharding.shard(df, 5), 5, len(ids), 3 * 19)


def test_small_groups_at_splitters_stay_whole(spark):
    """Thousands of pairs of copies: none below 0.2 % of a shard is cut, and every splitter
    lies within that much of its goal in a plain sort."""
    rng = random.Random(5)
    texts = ["".join(rng.choice("abcdef ") for _ in range(rng.randrange(60, 160))) for _ in range(12_000)]
    df = spark.createDataFrame([(2 * k + c, t) for k, t in enumerate(texts) for c in (0, 1)], "doc_id long, text string")
    out = sharding.shard(df, 20, rows_per_part=300).cache()
    total = out.agg(F.sum("size")).first()[0]
    most = 0.002 * total / 20
    check(out, 20, 24_000, most + 2 * 176)
    largest = out.groupBy("text").agg(F.sum("size").alias("b"), F.count_distinct("shard").alias("n"))
    assert largest.filter((F.col("n") > 1) & (F.col("b") <= most)).count() == 0
    bounds, n = sharding.splitters(df.select(F.xxhash64("text").alias("_hash"), F.col("doc_id").alias("_id"),
                                             (F.octet_length("text").cast("long") + 16).alias("_size")), 20, 0.002)
    keys = sorted((r[0], r[1], r[2]) for r in df.select(F.xxhash64("text"), "doc_id", (F.octet_length("text") + 16)).collect())
    for k, b in enumerate(bounds, 1):
        left = sum(s for h, i, s in keys if (h, i) < b)
        assert n == total and abs(left - total * k / 20) <= most + 2 * 176


def test_driver_rows_do_not_grow_with_the_rows(spark, monkeypatch):
    seen = {}
    for n in (2_000, 20_000):
        got = []
        original = type(spark.range(1)).collect
        monkeypatch.setattr(type(spark.range(1)), "collect", lambda self, f=original: (lambda rows: (got.append(len(rows)), rows)[1])(f(self)))
        sharding.shard(spark.range(n).selectExpr("id AS doc_id", "repeat(CAST(id AS string), 9) AS text"), 4, rows_per_part=100)
        monkeypatch.undo()
        seen[n] = max(got)
    assert max(seen.values()) <= 3 * sharding.CELLS
