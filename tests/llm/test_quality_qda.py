"""Quality classifier: held-out accuracy, the fit against numpy, edges."""

import numpy as np
from pyspark.sql import functions as F

from marketlake.llm import quality_qda as Q
from marketlake.llm.queries import op3_quality_classifier

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    rows = op3_quality_classifier(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    held = [(r.predicted, labels[r.doc_id]) for r in rows if r.held_out and r.doc_id in labels]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.95


def test_scores_equal_log_densities(spark):
    rng = np.random.default_rng(0)
    d = len(Q.STATISTICS)
    x = np.r_[rng.normal(0, 1, (300, d)), rng.normal(0.5, 2, (200, d))]
    y = np.r_[np.zeros(300, int), np.ones(200, int)]
    df = spark.createDataFrame([(row.tolist(), int(k)) for row, k in zip(x, y)], "stats array<double>, y int")
    got = [r.s for r in df.select(Q.fit(df, "y").score(F.col("stats")).alias("s")).collect()]
    cov = [np.cov(x[y == k].T, bias=True) for k in (0, 1)]
    pooled, dens = (300 * cov[0] + 200 * cov[1]) / 500, []
    for k, n in ((0, 300), (1, 200)):
        c = 0.9 * cov[k] + 0.1 * pooled
        c = 0.9 * c + 0.1 * np.diag(np.diag(c)) + 1e-6 * np.eye(d)
        z = x - x[y == k].mean(0)
        dens.append(np.log(n / 500) - np.linalg.slogdet(c)[1] / 2 - (z @ np.linalg.inv(c) * z).sum(1) / 2)
    assert np.allclose(got, 1 / (1 + np.exp(-(dens[1] - dens[0]) / d)), atol=1e-8)


def test_edges(spark, docs, none):
    labels = spark.createDataFrame([(1, 0, None), (2, 0, 1), (5, 1, 0), (6, 1, 0), (8, None, 1), (None, 1, 1)], "doc_id long, quality int, toxic int")
    out = Q.score(docs, labels, F.lit(True)).collect()
    assert len(out) == docs.count() and all(r.score is not None and 0 <= r.score <= 1 for r in out)
    for some, share in ((labels.filter("quality = 1"), 2.5 / 3), (labels.limit(0), 0.5)):  # labelled rows: 5 and 6
        got = [r.score for r in Q.score(docs, some, F.lit(True)).collect()]
        assert len(got) == docs.count() and {round(x, 9) for x in got} == {round(share, 9)}
    assert Q.score(none, labels, F.lit(True)).collect() == []
