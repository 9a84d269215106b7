"""Toxicity: held-out accuracy, planted words, gains against plain compression, edges."""

import random
import zlib

import numpy as np
import zstandard
from pyspark.sql import functions as F

from marketlake.llm import toxicity as X
from marketlake.llm.queries import op13_toxicity

SF = "/root/testdata/sf0.1"
SYLLABLES = [a + b for a in "bdfglmnprst" for b in ("a", "e", "i", "o", "u", "an", "er")]
BAD = ["quxzog", "vrackle", "zhwompy", "kyblixt"]


def prose(rng, n, bad=0.0):
    return " ".join(rng.choice(BAD) if rng.random() < bad else "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
                    for _ in range(n))


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op13_toxicity(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
    held = [(r.predicted, labels[r.doc_id], r.score) for r in rows if r.held_out and r.doc_id in labels]
    clean = [p for p, y, _ in held if y == 0]
    assert len(held) > 700 and np.mean([p == y for p, y, _ in held]) > 0.92
    assert np.mean(clean) < 0.01  # clean texts are left alone
    assert np.mean([p for p, y, _ in held if y == 1]) > 0.4
    assert np.median([s for _, y, s in held if y == 1]) > 5 * np.median([s for _, y, s in held if y == 0])


def test_planted_words_are_caught_wherever_they_stand(spark):
    rng = random.Random(3)
    docs = [(k, prose(rng, rng.randint(60, 400), 0.04 if k % 4 == 0 else 0.0)) for k in range(1600)]
    docs += [(5000, prose(rng, 40_000) + " " + prose(rng, 4_000, 0.05)), (5001, prose(rng, 44_000))]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(1600) if k % 3], "doc_id long, toxic int")
    got = {r["_id"]: r["score"] for r in X.score(frame, labels, F.lit(True)).collect()}
    unseen = [k for k in range(1600) if k % 3 == 0]
    hits = [got[k] >= 0.5 for k in unseen if k % 4 == 0]
    assert np.mean(hits) > 0.95
    assert np.mean([got[k] >= 0.5 for k in unseen if k % 4]) < 0.02
    assert got[5000] > got[5001]


def test_gains_are_differences_of_compressed_lengths():
    rng = random.Random(5)
    clean, bad = ([prose(rng, 200, b) for _ in range(300)] for b in (0.0, 0.05))
    model = X.fit({(0, 0): clean[:150], (1, 0): bad[:150], (0, 1): clean[150:], (1, 1): bad[150:]}, {0: 300, 1: 300})
    assert model.toxic.startswith(model.ordinary) and len(model.toxic) > len(model.ordinary)
    packed = lambda d, w: len(zstandard.ZstdCompressor(
        dict_data=zstandard.ZstdCompressionDict(d), level=X.LEVEL, write_content_size=False, write_checksum=False,
        write_dict_id=False).compress(w))
    # The dictionary is digested once for all windows, which may choose other settings than a single use.
    digested = model.measure()
    for t in (bad[0], clean[0], "", "QUXZOG quxzog", "x" * 1000):
        assert b"".join(X.windows(t)) == t.lower().encode()
        assert all(len(w) <= X.WINDOW for w in X.windows(t))
        gains = [packed(model.ordinary, w) - packed(model.toxic, w) for w in X.windows(t)]
        f = dict(zip(X.FEATURES, digested(t)))
        assert abs(f["greatest"] - max(max(gains), 0)) <= 6 and round(np.exp(f["windows"])) == len(gains)
    assert digested(bad[0])[0] > digested(clean[0])[0]


def test_calibration_has_no_slope_left():
    rng = np.random.default_rng(1)
    x = rng.normal(0, 1, (500, 3))
    y = (x @ [1.5, -1, 0] + rng.normal(0, 1, 500) > 0.8).astype(int)
    w, c = X._calibrated(x, y, ridge=1e-6)
    p = 1 / (1 + np.exp(-(x @ w + c)))
    weigh = np.where(y == 1, 0.5 / (y == 1).mean(), 0.5 / (y == 0).mean())
    assert np.abs(np.c_[x, np.ones(500)].T @ (weigh * (p - y))).max() < 1e-3


def test_edges(spark, docs, none):
    schema = "doc_id long, quality int, toxic int"
    labels = spark.createDataFrame([(1, 0, None), (2, 0, 1), (5, 1, 0), (6, 1, 0), (8, None, 1), (None, 1, 1), (7, 1, 0), (7, 1, 1)], schema)
    out = X.score(docs, labels, F.lit(True)).collect()
    assert len(out) == docs.count() and all(0 < r.score < 1 for r in out)
    # One class or no label: the smoothed share, for every text, the empty ones too.
    for some, share in ((labels.filter("toxic = 1"), 4.5 / 5), (labels.limit(0), 0.5)):
        got = {r.score for r in X.score(docs, some.filter("doc_id is not null or true"), F.lit(True)).collect()}
        assert len(got) == 1
        if share == 0.5:
            assert abs(got.pop() - share) < 1e-9
        else:
            assert got.pop() > 0.8
    assert X.score(none, labels, F.lit(True)).collect() == []
    assert X.with_scores(docs, X.fit({}, {})).columns == [*docs.columns, "score"]
    # Texts over the bound teach nothing and are scored all the same.
    few = X.score(docs, labels, F.lit(True), sample_bytes=10, sample_rows=2).collect()
    assert len(few) == docs.count()


def test_sample_is_bounded_and_deterministic(spark):
    rng = random.Random(9)
    docs = spark.createDataFrame([(k, prose(rng, 50, 0.1 * (k % 2))) for k in range(400)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(400)], "doc_id long, toxic int")
    a = X.train(docs, labels, F.lit(True), sample_rows=40)
    b = X.train(docs.repartition(7), labels.repartition(5), F.lit(True), sample_rows=40)
    assert a == b
