"""Decontamination: recall and exactness against all windows."""

import random

from marketlake.llm import decontam as D


def plain(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j - 1] + (x != y), row[j] + 1, new[j - 1] + 1))
        row = new
    return row[-1]


def test_edit_distance():
    rng = random.Random(1)
    for _ in range(500):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, 14))] for _ in range(2))
        for most in (0, 2, 20):
            assert D.edits(a, b, most) == min(plain(a, b), most + 1) or abs(len(a) - len(b)) > most


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def test_recall_and_no_false_matches():
    rng = random.Random(7)
    items = [(i, " ".join(words(rng, n))) for i, n in enumerate([1, 2, 4, 5, 9, 10, 12, 16, 20, 25, 30, 40, 60] * 3)]
    block = D.Block(items)
    numbers = {i: seq.tolist() for i, seq in block.items}
    texts, want = [], []
    for i, t in items * 4:
        w = t.split()
        for _ in range(rng.randrange(len(w) // D.TOLERANCE + 1)):
            at = rng.randrange(len(w))
            w = [w[:at] + words(rng, 1) + w[at + 1:], w[:at] + w[at + 1:], w[:at] + words(rng, 1) + w[at:]][rng.randrange(3)]
        texts.append(" ".join(words(rng, rng.randrange(12)) + w + words(rng, rng.randrange(12))))
    for t in texts:
        seq, found = [block.number.get(x, 0) for x in t.split()], {}
        for i, item in numbers.items():
            n, most = len(item), len(item) // D.TOLERANCE
            ways = [(plain(seq[p:p + n], item), p) for p in range(max(0, len(seq) - n + most + 1))]
            if ways and min(ways)[0] <= most:
                found[i] = min(ways)
        want.append(found)
    hit = total = 0
    for got, found in zip(block.search(texts), want):
        for i, _, n, d in got:
            assert i in found and d >= found[i][0] and n == len(numbers[i])  # nothing that brute force does not find
        total += len(found)
        hit += sum(i in {g[0] for g in got} for i in found)
        for i, (d, p) in found.items():
            assert d > 0 or (i, p, len(numbers[i]), 0) in got  # word for word: always, at its first place
    assert hit >= 0.95 * total


def test_stretch():
    rng = random.Random(2)
    for _ in range(400):
        a, b = ([rng.randrange(4) for _ in range(rng.randrange(1, n))] for n in (14, 8))
        ways = [(plain(a[p:p + n], b), p, n) for p in range(len(a)) for n in range(1, len(a) - p + 1)]
        want = min(ways)
        for most in (0, 2, 20):
            got = D.stretch(a, b, most)
            if want[0] >= len(b):
                assert got[0] == min(len(b), most + 1) or want[0] > most
            else:
                assert got == (want if want[0] <= most else (most + 1, 0, 0))


def test_recall_of_added_and_dropped_words():
    rng = random.Random(11)
    items = [(n, " ".join(words(rng, n))) for n in (10, 20, 40, 60)]
    block = D.Block(items, D.WIDE_REPETITIONS, wide=True)
    for kind in ("add", "drop"):
        hit = total = 0
        for n, t in items:
            for k in range(1, n // D.TOLERANCE + 1):
                texts = []
                for _ in range(15):
                    w, at = t.split(), set(rng.sample(range(1, n - 1), k))
                    w = [y for j, x in enumerate(w) for y in ([] if j in at and kind == "drop" else [*(words(rng, 1) if j in at else []), x])]
                    texts.append(" ".join(words(rng, 30) + w + words(rng, 30)))
                for got in block.search(texts):
                    assert all(i == n and d <= k for i, _, _, d in got)
                    hit += len(got)
                    total += 1
        assert hit >= 0.95 * total, (kind, hit, total)


def test_query_finds_what_stands_word_for_word(spark):
    import re

    from marketlake.llm.queries import op1_decontamination
    sf = "/root/testdata/sf0.01"
    norm = lambda s: " " + " ".join(re.findall(r"[^\W_]+", s.lower())) + " "
    items = {r.item_id: norm(r.text) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()}
    docs = {r.doc_id: norm(r.text or "") for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = {(r.doc_id, r.item_id): r.distance for r in op1_decontamination(spark, sf).collect()}
    exact = {(d, i) for d, t in docs.items() for i, x in items.items() if x in t}
    assert exact and {k for k, v in got.items() if v == 0} == exact


def test_edges(spark, docs, none, monkeypatch):
    bench = spark.createDataFrame([(1, "line 3 of a passage that stands in several documents"), (2, None), (3, ""), (None, "one"), (4, "one")],
                                  "item_id long, text string")
    for block in (D.BLOCK_WORDS, 1):  # one block, then one for each item
        monkeypatch.setattr(D, "BLOCK_WORDS", block)
        out = D.contaminated(docs, bench)
        assert set(out.columns) == {*docs.columns, *D.MATCH.names}
        found = {(r.doc_id, r.item_id) for r in out.collect()}
        assert found == {(6, 1), (7, 1), (8, 1), (None, 1), (4, 4), (4, None)}
        kept = D.clean(docs, bench)
        assert kept.columns == docs.columns and kept.count() == docs.count() - 6
    nameless = bench.filter("item_id IS NULL")  # an item is found and cleaned away without an id too
    assert [(r.doc_id, r.item_id) for r in D.contaminated(docs, nameless).collect()] == [(4, None)]
    assert D.clean(docs, nameless).count() == docs.count() - 1
    assert D.contaminated(none, bench).count() == 0 and D.clean(docs, bench.limit(0)).count() == docs.count()
    assert D.contaminated(docs, bench.limit(0)).count() == 0


def test_block_size_counts_words_however_they_are_separated(spark, monkeypatch):
    monkeypatch.setattr(D, "BLOCK_WORDS", 10)
    bench = spark.createDataFrame([(k, "\n".join(["word"] * 6)) for k in range(6)], "item_id long, text string")
    assert [len(b) for b in D.blocks(bench, "item_id", "text")] == [2, 2, 2]


def test_clean_sends_each_text_once_and_gets_no_row_back(spark):
    rng = random.Random(3)
    rows = [(k, " ".join(words(rng, 400)), "x" * 3000) for k in range(200)]
    bench = spark.createDataFrame([(1, " ".join(rows[7][1].split()[50:90]))], "item_id long, text string")
    kept = D.clean(spark.createDataFrame(rows, "doc_id long, text string, other string"), bench)
    assert sorted(r.doc_id for r in kept.collect()) == [k for k in range(200) if k != 7]
    data, nodes = {"pythonDataSent": 0, "pythonDataReceived": 0}, [kept._jdf.queryExecution().executedPlan()]
    while nodes:
        node = nodes.pop()
        nodes += [node.children().apply(k) for k in range(node.children().size())]
        for name in data:
            data[name] += node.metrics().apply(name).value() if node.metrics().contains(name) else 0
    size = sum(len(r[1]) for r in rows)
    assert size <= data["pythonDataSent"] < 1.3 * size and 0 < data["pythonDataReceived"] < 0.1 * size, (data, size)
