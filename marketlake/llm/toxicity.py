"""Toxicity by compression distance: zstandard dictionaries of toxic and ordinary text.

Two dictionaries are trained on a bounded sample of labelled texts. The ordinary one
comes from windows of ordinary texts. The toxic one is the same content followed by
what zstandard picks from the *contrast*: the stretches of toxic texts made of byte
5-grams that clearly more toxic than ordinary texts of the sample hold. What both hold
compresses alike, so the difference of a window's two compressed lengths, its gain, is
what toxic content alone explains. Every window of every whole text is compressed with
both; greatest gain, gains per window and their sums enter a logistic threshold that is
calibrated on labelled texts which no dictionary has seen, and shifted to the share of
toxic rows among *all* labelled ones.

Bounds of what is learned from (parameters of ``train``): ``sample_rows`` rows and
``sample_bytes`` bytes for each class and use (dictionary, calibration), chosen by a
hash of the id (the least ones). The model is two dictionaries (65 KB) and six numbers, sent with the task.

Defined results: a NULL text is the empty text; an empty text has one empty window of
gain 0 and gets the score of no evidence; a text longer than ``sample_bytes`` is not
learned from but is scored; a NULL label is no label; a row whose id has several labels
counts once for each; texts of one class only (or none) give no contrast, and every text
scores the smoothed share of label 1; an empty table gives no rows. Only the text enters
a score. Input columns are not looked at beyond id and text.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window, functions as F, types as T

from marketlake.llm.common import add_columns, slices, text_of

#: Bytes of a window; it ends after a space where its second half has one.
WINDOW = 192
LEVEL = 3
GRAM = 5
#: A 5-gram is contrast if so large a share of the toxic texts hold it and their number,
#: less two standard deviations, is so many times what the ordinary texts let expect.
LEAST_SHARE, TIMES = 0.01, 12.0
ORDINARY_BYTES, TOXIC_BYTES = 32_768, 1_024
FEATURES = ("greatest", "per_window", "per_root", "strong", "windows")
_SCHEMA = T.StructType([T.StructField("score", T.DoubleType())])


def windows(text: str) -> Iterator[bytes]:
    """Consecutive windows of the whole text, lower case, in UTF-8; at least one."""
    raw = text.lower().encode()
    at, n = 0, len(raw)
    while at < n:
        to = min(at + WINDOW, n)
        if to < n:
            space = raw.rfind(b" ", at + WINDOW // 2, to)
            to = space + 1 if space > 0 else to
        yield raw[at:to]
        at = to
    if not n:
        yield b""


def _compressor(dictionary: bytes):
    import zstandard

    plain = {"level": LEVEL, "write_content_size": False, "write_checksum": False, "write_dict_id": False}
    if not dictionary:
        return zstandard.ZstdCompressor(**plain)
    data = zstandard.ZstdCompressionDict(dictionary)
    data.precompute_compress(level=LEVEL)
    return zstandard.ZstdCompressor(dict_data=data, **plain)


@dataclass(frozen=True)
class Model:
    ordinary: bytes
    toxic: bytes
    weights: tuple[float, ...]  # of FEATURES, then the constant

    def measure(self):
        """A function of a text that gives its features."""
        if self.toxic == self.ordinary:  # no contrast: no window can gain
            return lambda text: [0.0] * len(FEATURES)
        base, other = _compressor(self.ordinary), _compressor(self.toxic)

        def features(text: str) -> list[float]:
            n = total = strong = greatest = 0
            for w in windows(text):
                gain = len(base.compress(w)) - len(other.compress(w))
                n += 1
                if gain > 0:
                    total += gain
                    strong += gain > 1
                    greatest = max(greatest, gain)
            return [float(greatest), total / n, total / math.sqrt(n), strong / math.sqrt(n), math.log(n)]

        return features

    def score(self, features: list[float]) -> float:
        z = sum(w * x for w, x in zip(self.weights, features)) + self.weights[-1]
        return 1.0 / (1.0 + math.exp(-max(-300.0, min(300.0, z))))


def _trained(samples: list[bytes], size: int, **how) -> bytes:
    """A dictionary of zstandard's trainer; of samples too few for it, their own last bytes."""
    import zstandard

    try:
        return zstandard.train_dictionary(size, samples, **how).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-size:]


def _grams(raw: bytes):
    """The 5-gram at each position of a text, as an integer."""
    import numpy as np

    x = np.frombuffer(raw, np.uint8).astype(np.uint64)
    n = max(len(x) - GRAM + 1, 0)
    codes = np.zeros(n, np.uint64)
    for i in range(GRAM):
        codes = codes * np.uint64(256) + x[i:n + i]
    return codes


def contrast(ordinary: list[bytes], toxic: list[bytes]) -> list[bytes]:
    """The stretches of the toxic texts that are covered by contrast 5-grams."""
    import numpy as np

    def holders(texts):
        return np.unique(np.concatenate([np.unique(_grams(t)) for t in texts]), return_counts=True)

    known, usual = holders(ordinary)
    grams, n = holders(toxic)
    there = np.zeros(len(grams))
    if len(known):
        at = np.minimum(np.searchsorted(known, grams), len(known) - 1)
        there = np.where(known[at] == grams, usual[at], 0)
    expected = (there + 1) * len(toxic) / len(ordinary)
    good = grams[(n >= max(3, LEAST_SHARE * len(toxic))) & (n - 2 * np.sqrt(n) >= TIMES * expected)]
    out = []
    for raw in toxic:
        hit = np.isin(_grams(raw), good)
        covered = np.zeros(len(raw) + 2, np.int8)
        for i in range(GRAM):
            covered[1 + i:1 + i + len(hit)] |= hit
        edge = np.flatnonzero(np.diff(covered))
        out += [raw[i:j] for i, j in zip(edge[::2], edge[1::2])]
    return out


def _calibrated(x, y, ridge: float = 1.0):
    """Ridge logistic regression by Newton's steps, on standardised features."""
    import numpy as np

    mean, scale = x.mean(0), np.maximum(x.std(0), 1e-9)
    z = np.hstack([(x - mean) / scale, np.ones((len(x), 1))])
    weigh = np.where(y == 1, 0.5 / max((y == 1).sum(), 1), 0.5 / max((y == 0).sum(), 1)) * len(y)
    keep = np.full(z.shape[1], ridge)
    keep[-1] = 1e-6
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = z.T @ (weigh * (p - y)) + keep * w
        curve = (z * (weigh * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ z + np.diag(keep)
        step = np.linalg.solve(curve, slope)
        w -= step
        if abs(step).max() < 1e-8:
            break
    own = w[:-1] / scale
    return own, w[-1] - own @ mean


def fit(samples: dict[tuple[int, int], list[str]], counts: dict[int, int]) -> Model:
    """``samples[label, use]`` are texts for the dictionaries (use 0) and for the
    calibration (use 1); ``counts[label]`` all labelled rows."""
    import numpy as np

    prior = math.log((counts.get(1, 0) + 0.5) / (counts.get(0, 0) + 0.5))
    none = (0.0,) * len(FEATURES)
    ordinary, toxic = ([t.lower().encode() for t in samples.get((y, 0), [])] for y in (0, 1))
    if not ordinary or not toxic:
        return Model(b"", b"", (*none, prior))
    usual = _trained([w for t in samples[0, 0] for w in windows(t)], ORDINARY_BYTES)
    found = contrast(ordinary, toxic)
    runs = [b"".join(found[i:i + 8]) for i in range(0, len(found), 8)]
    model = Model(usual, usual + _trained(runs, TOXIC_BYTES, k=32, d=6) if runs else usual, (*none, prior))
    held = [(t, y) for y in (0, 1) for t in samples.get((y, 1), [])]
    if model.toxic == usual or len({y for _, y in held}) < 2:
        return model
    measure = model.measure()
    weights, constant = _calibrated(np.array([measure(t) for t, _ in held]), np.array([y for _, y in held]))
    # Calibrated as if both classes were as frequent; the prior shifts it to their share.
    return Model(usual, model.toxic, (*map(float, weights), float(constant + prior)))


def train(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample_rows: int = 2_000, sample_bytes: int = 4_000_000) -> Model:
    """Learns from labelled rows that satisfy ``learn``, a condition on ``_id``."""
    known = labels.select(F.col(id_col).alias("_id"), F.col(label_col).cast("int").alias("_y")).filter(
        F.col("_y").isin(0, 1) & F.col("_id").isNotNull()).filter(learn)
    counts = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}  # two rows
    # About three times the rows wanted are taken by their hash, so that what is ranked stays as small.
    at = F.col("_hash") / float(2 ** 63)  # -1 to 1
    thin = [(F.col("_y") == y) & (at < 2.0 * min(1.0, 6 * sample_rows / max(n, 1)) - 1.0 + 1e-9) for y, n in counts.items()]
    some = known.withColumn("_hash", F.xxhash64("_id")).filter(reduce(or_, thin, F.lit(False)))
    order = Window.partitionBy("_y").orderBy("_hash", "_id")
    some = some.withColumn("_rank", F.row_number().over(order)).filter(F.col("_rank") <= 2 * sample_rows)
    some = some.withColumn("_use", (F.col("_rank") % 2).cast("int"))
    texts = docs.select(F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    # At most 8,000 ids and labels, whatever the table.
    rows = texts.join(F.broadcast(some), "_id").withColumn("_size", F.octet_length("_text")) \
        .filter(F.col("_size") <= sample_bytes)
    upto = F.sum("_size").over(Window.partitionBy("_y", "_use").orderBy("_rank", "_text").rowsBetween(
        Window.unboundedPreceding, 0))
    chosen = rows.withColumn("_sum", upto).filter(F.col("_sum") <= sample_bytes).select("_y", "_use", "_rank", "_text")
    samples: dict[tuple[int, int], list] = {}
    for r in sorted(chosen.collect(), key=lambda r: (r["_rank"], r["_text"])):  # four times sample_bytes at most
        samples.setdefault((r["_y"], r["_use"]), []).append(r["_text"])
    return fit(samples, counts)


def with_scores(docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``score``, the chance of label 1, to every row (a narrow Arrow map)."""

    def run(texts):
        import pyarrow as pa

        measure = model.measure()
        for some in slices(texts):
            yield len(some), {"score": pa.array([model.score(measure(t or "")) for t in some], pa.float64())}

    return add_columns(docs, run, _SCHEMA, text_col, carry)


def score(docs: DataFrame, labels: DataFrame, learn, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", **bounds) -> DataFrame:
    """The id and ``score`` of every row of ``docs``."""
    model = train(docs, labels, learn, id_col, text_col, label_col, **bounds)
    ids = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_body"))
    return with_scores(ids, model, "_body", ["_id"])
