"""Quality classifier: regularised quadratic discriminant on document statistics.

A narrow pass turns every text into a few transformed statistics. The labelled rows
give, per class, a count, sums and cross products (one aggregation, all labelled
rows, no sample); the driver shrinks the class covariances towards the pooled one
and its diagonal and factors them once. The score of a text is the logistic of the
difference of the Mahalanobis log densities, solved with the cached Cholesky factors.

Defined results: a NULL or empty text has the statistics of no words and gets a
score like any other; a NULL label is no label; rows that share an id all take its
label; several labels of an id count as several rows; without labelled texts of both classes
there is nothing to tell them apart by, and every text scores the smoothed share of
label 1; an empty table of texts gives no rows. Only the text enters a score.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F, types as T

from marketlake.llm.common import add_columns, slices, written

# The groups of ASCII characters that are counted.
GROUPS = {
    "capitals": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ",
    "smalls": b"abcdefghijklmnopqrstuvwxyz",
    "digits": b"0123456789",
    "stops": b".,;:?",
    "shouts": b"!",
    "signs": b"#*$%&|<>@^~_=+/\\",
}
STATISTICS = ("words", "word_length", "line_words", "capitals", "digits", "stops", "shouts", "signs", "foreign",
              "distinct_words", "repeated_words", "repeated_lines")
_SCHEMA = T.StructType([T.StructField("stats", T.ArrayType(T.DoubleType()))])


def statistics(text: str) -> list[float]:
    """The transformed statistics of one text: logs of lengths, logits of smoothed shares."""
    import numpy as np

    raw = text.encode()
    words = raw.split()
    n, letters = len(words), len(text) - sum(map(text.count, " \t\n\r"))
    share = lambda part, whole: math.log((part + 0.5) / (whole - part + 0.5)) if whole >= part else 0.0
    count = {k: len(raw) - len(raw.translate(None, chars)) for k, chars in GROUPS.items()}
    lines = [x for x in text.split("\n") if x.strip()]
    number: dict[bytes, int] = {}
    codes = np.fromiter((number.setdefault(w, len(number)) for w in words), np.int64, n)
    again = 0
    if n > 3:
        pairs = codes[:-1] * len(number) + codes[1:]
        again = len(pairs) - len(np.unique(pairs))
    return [math.log1p(n), math.log((letters + 1) / (n + 1)), math.log((n + 1) / (len(lines) + 1)),
            share(count["capitals"], count["capitals"] + count["smalls"]), share(count["digits"], letters),
            share(count["stops"], letters), share(count["shouts"], letters), share(count["signs"], letters),
            share(len(raw) - len(text), len(raw)), share(n - len(number), n), share(again, max(n - 1, 0)),
            share(len(lines) - len(set(lines)), len(lines))]


def with_statistics(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``stats`` to every row (a narrow Arrow map)."""

    def run(texts):
        import pyarrow as pa

        for some in slices(texts):
            yield len(some), {"stats": pa.array([statistics(t or "") for t in some], pa.list_(pa.float64()))}

    return add_columns(docs, run, _SCHEMA, text_col, carry)


@dataclass(frozen=True)
class Qda:
    """Class means, inverse Cholesky factors (lower, by rows) and constants; without means
    the constant is every text's score."""
    means: tuple[tuple[float, ...], ...]
    whiten: tuple[tuple[tuple[float, ...], ...], ...]
    offsets: tuple[float, ...]  # log prior - half the log determinant

    def score(self, stats):
        """Column expression: the chance of label 1 for an array column of statistics."""
        if not self.means:
            return F.lit(self.offsets[0])
        def density(k: int):
            d = len(self.means[k])
            z = [F.get(stats, i) - self.means[k][i] for i in range(d)]
            parts = []
            for row in self.whiten[k]:
                dot = sum((F.lit(w) * z[j] for j, w in enumerate(row) if w), F.lit(0.0))
                parts.append(dot * dot)
            return F.lit(self.offsets[k]) - 0.5 * sum(parts, F.lit(0.0))
        # Log densities of many statistics are far too sure of themselves; dividing their
        # difference by the dimension keeps the order and spreads the scores.
        gap = (density(1) - density(0)) / len(self.means[0])
        return 1.0 / (1.0 + F.exp(-F.least(F.greatest(gap, F.lit(-300.0)), F.lit(300.0))))


def fit(labelled: DataFrame, label_col: str, shrink: float = 0.1, ridge: float = 0.1) -> Qda:
    """Fits on all rows with ``stats`` and a 0/1 label. ``shrink`` is the weight of the
    pooled covariance in each class's own, ``ridge`` that of its diagonal."""
    import numpy as np

    d = len(STATISTICS)
    rows = labelled.filter(F.col(label_col).isin(0, 1)).select(F.col(label_col).cast("int").alias("y"), *[
        F.get("stats", i).alias(f"s{i}") for i in range(d)])
    sums = rows.groupBy("y").agg(F.count("*").alias("n"), *[F.sum(f"s{i}").alias(f"m{i}") for i in range(d)], *[
        F.sum(F.col(f"s{i}") * F.col(f"s{j}")).alias(f"c{i}_{j}") for i in range(d) for j in range(i + 1)]).collect()
    by = {r["y"]: r for r in sums}  # two rows
    if set(by) != {0, 1}:
        count = {y: by[y]["n"] if y in by else 0 for y in (0, 1)}
        return Qda((), (), ((count[1] + 0.5) / (count[0] + count[1] + 1.0),))
    total = sum(r["n"] for r in sums)
    mean, own = {}, {}
    for y, r in by.items():
        mean[y] = np.array([r[f"m{i}"] for i in range(d)]) / r["n"]
        second = np.array([[r[f"c{max(i, j)}_{min(i, j)}"] for j in range(d)] for i in range(d)]) / r["n"]
        own[y] = second - np.outer(mean[y], mean[y])
    pooled = sum(by[y]["n"] * own[y] for y in by) / total
    means, whiten, offsets = [], [], []
    for y in (0, 1):
        cov = (1 - shrink) * own[y] + shrink * pooled
        diagonal = np.maximum(np.diag(cov), 1e-4)
        cov = (1 - ridge) * cov + ridge * np.diag(diagonal) + 1e-6 * np.eye(d)
        factor = np.linalg.cholesky(cov)
        means.append(tuple(map(float, mean[y])))
        whiten.append(tuple(tuple(map(float, row)) for row in np.linalg.inv(factor)))
        offsets.append(float(math.log(by[y]["n"] / total) - np.log(np.diag(factor)).sum()))
    return Qda(tuple(means), tuple(whiten), tuple(offsets))


def score(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality") -> DataFrame:
    """The id and ``score`` of every row of ``docs``. ``learn`` is a condition on
    ``_id``: only labels of those ids are learned from."""
    ids = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body"))
    rows = written(with_statistics(ids, "_body", ["_id"]), "quality-statistics")
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).alias("_label")).filter(learn)
    model = fit(rows.join(known, "_id"), "_label")
    return rows.select("_id", model.score(F.col("stats")).alias("score"))
