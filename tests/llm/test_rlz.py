"""Substring dedup against brute force over all windows."""

import random
import re

from marketlake.llm import rlz


def brute(rows):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    first = {}
    at = lambda k, p: (rows[k][0] if rows[k][0] is not None else rlz.LEAST, p)
    for k, w in enumerate(words):
        for p in range(len(w) - rlz.WINDOW + 1):
            x = tuple(w[p:p + rlz.WINDOW])
            first[x] = min(first.get(x, at(k, p)), at(k, p))
    out = []
    for k, w in enumerate(words):
        dead = set()
        for p in range(len(w) - rlz.WINDOW + 1):
            if first[tuple(w[p:p + rlz.WINDOW])] < at(k, p):
                dead |= set(range(p, p + rlz.WINDOW))
        out.append((at(k, 0)[0], len(w), len(dead), " ".join(x for i, x in enumerate(w) if i not in dead)))
    return sorted(out)


def check(df, rows):
    got = rlz.parse(df).collect()
    want = brute(rows)
    import hashlib
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    assert sorted((r._d, r.n_words, r.n_removed, r.kept_sha256) for r in got) == \
        sorted((d, n, m, digest(k)) for d, n, m, k in want)
    assert all(r.kept is None or digest(r.kept) == r.kept_sha256 for r in got)
    for r in got:
        covered = set()
        for f in r.factors:
            assert f.n_words >= rlz.WINDOW and f.reference <= r._d
            covered |= set(range(f.start, f.start + f.n_words))
        assert len(covered) == r.n_removed


def test_random_passages(spark):
    rng = random.Random(8)
    passages = [[f"p{i}w{k}" for k in range(rng.randrange(15, 60))] for i in range(6)]
    rows = []
    for d in range(60):
        w = []
        for _ in range(rng.randrange(5)):
            p = rng.choice(passages)
            a = rng.randrange(max(1, len(p) - 25))
            w += p[a:a + rng.randrange(18, 60)] + [f"u{rng.randrange(50)}" for _ in range(rng.randrange(4))]
        rows.append((d // 2 * 2 if d % 9 == 0 else d, " ".join(w)))
    rows += [(100, " ".join(["same"] * 70)), (101, " ".join(["same"] * 50)), (102, " ".join(["x", "y"] * 40))]
    rows += [(k, rows[4][1]) for k in range(200, 206)]
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)


def test_edges(docs, none):
    check(docs, [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()])
    assert rlz.parse(none).count() == 0
