"""N-gram join against all pairs, through small buckets and through chunked groups."""

import random
import re

import pytest

from marketlake.llm import ngram_join as N


def sets_of(rows):
    out = {}
    for k, (d, t) in enumerate(rows):
        w = re.findall(r"[^\W_]+", (t or "").lower())
        out[k] = frozenset([" ".join(w) + "\0"] if 0 < len(w) < 5 else (" ".join(w[i:i + 5]) for i in range(len(w) - 4)))
    return out


def brute(rows):
    """For each row (class id, links, linked texts)."""
    s = sets_of(rows)
    near = {k: [j for j in s if j != k and s[k] and s[j] and 5 * len(s[k] & s[j]) >= 4 * len(s[k] | s[j])] for k in s}
    out = {}
    for k in s:
        todo, seen = [k], {k}
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] if rows[j][0] is not None else N.LEAST for j in seen]
        out[k] = (min(ids), len(near[k]), len({s[j] for j in near[k]} - {s[k]}))
    return out


def check(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r._d, r.class_id, r.n_links, r.n_linked_texts) for r in N.join(df).collect())
    want = brute(rows)
    assert got == sorted((rows[k][0] if rows[k][0] is not None else N.LEAST, *want[k]) for k in want)


def near_copies(rng, base, n, edits):
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"e{rng.randrange(10 ** 6)}"
        yield " ".join(w)


def rows_with_groups():
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.randrange(4000)}" for _ in range(60)) for _ in range(25)]
    base = [f"b{rng.randrange(4000)}" for _ in range(80)]
    texts += list(near_copies(rng, base, 30, 1)) + list(near_copies(rng, texts[0].split(), 4, 1)) + [texts[1]] * 5
    texts += ["", None, "  ", "one two", "One, two!", "a b c d", LONG]
    rng.shuffle(texts)
    return list(enumerate(texts))


LONG = " ".join(f"long{k}" for k in range(60_000))


@pytest.mark.parametrize("small, chunk", [(16, 512), (1000, 512), (2, 7)])
def test_links_and_classes(spark, monkeypatch, small, chunk):
    monkeypatch.setattr(N, "SMALL", small)
    monkeypatch.setattr(N, "CHUNK", chunk)
    check(spark, rows_with_groups())


def test_without_broadcast(spark, monkeypatch):
    monkeypatch.setattr(N, "BROADCAST_ROWS", -1)
    check(spark, rows_with_groups()[:40])


def test_edges(spark, docs, none):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    check(spark, rows)
    kept = N.one_of_each(docs)
    assert kept.columns == docs.columns
    want = brute(rows)
    classes = {(want[k][0], want[k][1] > 0) for k in want if sets_of(rows)[k]}
    worded = [r for r in kept.collect() if re.search(r"[^\W_]", r.text or "")]
    assert len(worded) == len(classes)
    assert kept.count() - len(worded) == sum(not x for x in sets_of(rows).values())
    assert N.join(none).count() == 0 and N.one_of_each(none).count() == 0


def test_band_count_reaches_the_recall():
    assert 1 - (1 - N.THRESHOLD ** N.ROWS) ** N.bands() >= N.RECALL


def test_components_against_union_find(spark):
    rng = random.Random(8)
    cases = [[(k, k + 1) for k in range(60)], [(99, k) for k in range(40)], [(k, rng.randrange(300)) for k in range(300)],
             [(rng.randrange(500), rng.randrange(500)) for _ in range(350)], [(5, 5)], []]
    for edges in cases:
        root = {x: x for e in edges if e[0] != e[1] for x in e}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x
        for a, b in edges:
            if a != b:
                a, b = find(a), find(b)
                root[max(a, b)] = min(a, b)
        got = {r.node: r.root for r in N.components(spark.createDataFrame(edges, "a long, b long"), "test").collect()}
        assert got == {x: find(x) for x in root}


def test_rows_grow_with_a_group_not_with_its_square(spark, monkeypatch):
    """Rows of every table that a join of 500 and of 1,000 near copies writes."""
    rng = random.Random(9)
    base = [f"b{k}" for k in range(150)]
    seen = {}
    for n in (500, 1000):
        count = {}
        original = N.written

        def counting(df, name):
            out = original(df, name)
            count[name] = max(count.get(name, 0), out.count())
            return out
        monkeypatch.setattr(N, "written", counting)
        rows = list(enumerate(near_copies(rng, base, n, 1)))
        out = N.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
        monkeypatch.setattr(N, "written", original)
        assert len({r.class_id for r in out}) == 1 and min(r.n_links for r in out) > 0.9 * n
        seen[n] = count
    # A count for each class and block it met (four numbers), a row for each pair of blocks.
    assert seen[500].pop("ngram-block-links") <= 500 and seen[1000].pop("ngram-block-links") <= 2 * 1000
    for name in seen[1000]:
        assert seen[1000][name] <= 3 * seen[500].get(name, 0) + 100, (name, seen[500].get(name), seen[1000][name])


def test_blocks_hold_their_sets():
    import numpy as np

    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 50, rng.integers(1, 40)).astype(np.uint64)) for _ in range(30)]
    base = sets[0]
    without = [np.flatnonzero(~np.isin(base, g)).astype(np.uint32).tobytes() for g in sets]
    more = [np.setdiff1d(g, base).tobytes() for g in sets]
    assert [sorted(g) for g in N.unpacked_sets(base.tobytes(), without, more)] == [g.tolist() for g in sets]
