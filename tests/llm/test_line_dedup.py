"""Line dedup against brute force over windows of lines."""

import random
import re

import pytest

from marketlake.llm import line_dedup

WORD = re.compile(r"[^\x20\x09-\x0D]")


def brute(rows, min_lines, min_words):
    """{(id, text): (text left, lines, removed)} for (id, text) rows."""
    docs = sorted({(d if d is not None else line_dedup.LEAST, t or "") for d, t in rows}, key=lambda x: x[0])
    seqs = {k: [x for x in k[1].split("\n") if WORD.search(x)] for k in docs}
    first = {}
    for d, t in docs:
        s = seqs[d, t]
        for n in {1, min_lines}:
            for i in range(len(s) - n + 1):
                first.setdefault((n, tuple(s[i:i + n])), []).append((d, i, t))
    out = {}
    for d, t in docs:
        s, dead = seqs[d, t], set()
        for n in {1, min_lines}:
            for i in range(len(s) - n + 1):
                if n == 1 and min_lines > 1 and len(re.findall(r"[^\x20\x09-\x0D]+", s[i])) < min_words:
                    continue
                if min(x[:2] for x in first[n, tuple(s[i:i + n])]) < (d, i):
                    dead |= set(range(i, i + n))
        k, left = 0, []
        for x in t.split("\n"):
            if WORD.search(x):
                if k not in dead:
                    left.append(x)
                k += 1
            else:
                left.append(x)
        out[d, t] = ("\n".join(left), len(s), len(dead))
    return out


def check(df, rows, **kw):
    want = brute(rows, kw.get("min_lines", 2), kw.get("min_words", 10))
    got = line_dedup.without_copies(df, **kw)
    key = {r.key: (r.doc_id, r.body) for r in df.selectExpr("key", "doc_id", "text AS body").collect()}
    out = got.collect()
    assert len(out) == len(rows)
    for r in out:
        d, t = key[r.key]
        assert (r.text, r.n_lines, r.n_removed) == want[d if d is not None else line_dedup.LEAST, t or ""], (d, t)


@pytest.mark.parametrize("min_lines", [1, 2, 4])
def test_random_lines(spark, min_lines):
    rng = random.Random(min_lines)
    pool = ["a", "b", "c d e f g h i j k l m", "", "  ", "e f"]
    rows = [(d, "\n".join(rng.choice(pool) for _ in range(rng.randrange(14)))) for d in range(25)]
    df = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, key long")
    check(df, rows, min_lines=min_lines)


def test_edges(spark, docs, none):
    from pyspark.sql import functions as F
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    keyed = docs.withColumn("key", F.xxhash64("doc_id", "text"))
    check(keyed, rows)
    out = line_dedup.without_copies(docs)
    assert set(out.columns) == {*docs.columns, "n_lines", "n_removed"}
    assert line_dedup.without_copies(none).count() == 0


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "BROADCAST_RUNS", -1)
    rows = [(d, "\n".join(["one line that has more than ten words in it, so it counts", str(d)])) for d in range(6)]
    check(spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, key long"), rows)


def test_runs_are_maximal_and_name_their_source(spark):
    body = [f"line number {k}" for k in range(11)]
    df = spark.createDataFrame([(1, "\n".join(body)), (2, "\n".join(["own", *body[2:9], "end"]))], "doc_id long, text string")
    run = line_dedup.runs(line_dedup.copies(df)).collect()
    assert [(r._d, r.line, r.n_lines, r["first"]._d) for r in run] == [(2, 1, 7, 1)]
    with pytest.raises(ValueError):
        line_dedup.copies(df, min_lines=3)
