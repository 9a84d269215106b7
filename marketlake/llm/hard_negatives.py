"""Hard negatives by segment summaries: bounds of inner products before exact scores.

A vector is cut into 1, 2, 4, 8 nested segments, and of each the mean and the deviation
(the root of the summed squares about the mean) are stored. In a segment of n components
the inner product of two vectors is n times the product of the means, plus or minus at
most the product of the deviations (Cauchy-Schwarz). Level by level these bounds drop rows
that cannot be among an anchor's results; what is left is scored exactly.

Two passes: an anchor's positives are its best other rows of the same label; a positive's
negatives are the best rows of other labels whose score is between ``low`` and ``high``
percent of the positive's. Higher scores come first, ties by the smaller id.

Scale: rows are packed in blocks of one label and of a narrow range of means, anchors in
smaller ones. Rows are dealt to R slots and anchors to A slots; every task takes one slot
of each, so a row is copied A times, an anchor R times, and R and A are chosen so that
both cost about as much. A block pair whose summaries' ranges cannot reach an anchor's
least score is not opened. A task holds two blocks; of each pair of blocks only the best
``k`` rows an anchor go on to the final ranking. No step needs all rows of a label, or all
anchors, in one place, and nothing is broadcast by hand.

Defined results: rows with a NULL label, a NULL vector or a NULL or non-finite component
take no part; an empty vector has score 0 with every other, shorter vectors are taken as
filled up with zeros; a NULL id is no anchor and loses ties; rows that share the anchor's
id are not *other* rows, other repeated rows are ranked each for itself; each occurrence
of an anchor's id is an anchor; an anchor without positives, or a positive without
negatives, has no rows; scores beyond 64 bits are cut to the nearest long; an empty table
gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from marketlake.llm.common import written

LEVELS = (1, 2, 4, 8)
BLOCK_ROWS, BLOCK_ANCHORS = 2_048, 256
#: Pairs of rows that one task may have to score.
TASK_PAIRS = 1_000_000_000
#: Partitions of packed blocks hold about so many blocks.
BLOCKS_A_PARTITION = 8

_DOUBLES = T.ArrayType(T.DoubleType())
_BLOCK = T.StructType([
    T.StructField("block", T.StringType()), T.StructField("label", T.StringType()), T.StructField("ids", T.ArrayType(T.LongType())),
    T.StructField("vectors", _DOUBLES), T.StructField("means", _DOUBLES), T.StructField("devs", _DOUBLES),
    T.StructField("least", _DOUBLES), T.StructField("most", _DOUBLES), T.StructField("widest", _DOUBLES)])


def edges(dim: int, segments: int) -> list[int]:
    """Where the segments of a level begin and end: halves of the level before."""
    cuts = [0, dim]
    while dim and len(cuts) <= segments:
        halves = sorted({*cuts, *[(a + b) // 2 for a, b in zip(cuts, cuts[1:])]})
        if halves == cuts:
            break
        cuts = halves
    return cuts


def summaries(x) -> list[tuple]:
    """For each level the means (times the root of the segment's length) and deviations
    of the rows of a matrix: the bounds of inner products are M @ M' +- D @ D'."""
    import numpy as np

    out = []
    for level in LEVELS:
        cuts = edges(x.shape[1], level)
        m, d = (np.zeros((len(x), len(cuts) - 1)) for _ in range(2))
        for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
            part = x[:, a:b]
            mean = part.mean(1) if b > a else np.zeros(len(x))
            m[:, k] = mean * math.sqrt(b - a)
            d[:, k] = np.sqrt(((part - mean[:, None]) ** 2).sum(1))
        out.append((m, d))
    return out


def usable(vectors: DataFrame, label: Column, vector: Column, row_id: Column, anchor: Column) -> DataFrame:
    """The rows that take part: ``_i`` id, ``_l`` label, ``_v`` vector, ``_a`` whether an anchor."""
    v = vector.cast(_DOUBLES)
    good = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vectors.filter(label.isNotNull() & v.isNotNull() & good).select(
        row_id.cast("long").alias("_i"), label.cast("string").alias("_l"), v.alias("_v"),
        F.coalesce(anchor, F.lit(False)).alias("_a"))


def packed(rows: DataFrame, dim: int, size: int, partitions: int) -> DataFrame:
    """Blocks of at most ``size`` rows of one label, near in the mean, with the summaries
    of every row and their ranges over the block; rows of a block are in order of ids."""
    mean = F.aggregate("_v", F.lit(0.0), lambda a, x: a + x)
    order = ["_l", "_mean", F.col("_i").asc_nulls_last()]
    dealt = rows.select("_i", "_l", "_v", mean.alias("_mean")).repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, part, number = to_arrow_schema(_BLOCK), TaskContext.get().partitionId(), 0
        held: list[tuple] = []

        def block():
            nonlocal held, number
            held.sort(key=lambda r: (r[0] is None, r[0] or 0))
            x = np.zeros((len(held), dim))
            for k, (_, _, v) in enumerate(held):
                x[k, :len(v)] = v
            levels = summaries(x)
            m, d = (np.hstack([lv[j] for lv in levels]) for j in (0, 1))
            row = {"block": f"{part}:{number}", "label": held[0][1], "ids": [r[0] for r in held], "vectors": x.ravel(),
                   "means": m.ravel(), "devs": d.ravel(), "least": levels[-1][0].min(0), "most": levels[-1][0].max(0),
                   "widest": levels[-1][1].max(0)}
            held, number = [], number + 1
            return pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                some = batch.slice(at, 256)
                for i, label, v in zip(*[some.column(k).to_pylist() for k in range(3)]):
                    if held and (held[0][1] != label or len(held) == size):
                        yield block()
                    held.append((i, label, v))
        if held:
            yield block()

    return dealt.mapInArrow(run, _BLOCK)


class _Block:
    """A packed block, taken from one row of an Arrow batch."""

    def __init__(self, row: dict, prefix: str):
        import numpy as np

        take = lambda c: row[prefix + c]
        self.ids, self.n = take("ids"), len(take("ids"))
        shape = (self.n, -1)
        empty = np.zeros((self.n, 0))
        matrix = lambda c: np.asarray(take(c), float).reshape(shape) if len(take(c)) else empty
        self.x, means, devs = matrix("vectors"), matrix("means"), matrix("devs")
        self.levels, at = [], 0
        for level in LEVELS:
            k = len(edges(self.x.shape[1], level)) - 1
            self.levels.append((means[:, at:at + k], devs[:, at:at + k]))
            at += k
        self.norm = np.sqrt((self.x ** 2).sum(1))
        self.ids_or_last = np.array([np.iinfo(np.int64).max if i is None else i for i in self.ids], np.int64)
        self.no_id = np.array([i is None for i in self.ids], bool)


def exact(a, b):
    """Inner products of integer-valued rows, without rounding; whole numbers as floats
    while they are small, else Python's integers."""
    import numpy as np

    most = (np.abs(a).max(initial=0.0) * np.abs(b).max(initial=0.0)) * max(a.shape[1], 1)
    if most < 2.0 ** 45:  # a hundred times a score is still whole
        return a @ b.T
    whole = lambda m: np.array([[int(x) for x in r] for r in m.tolist()], object).reshape(m.shape)
    return whole(a) @ whole(b).T


def survivors(a: _Block, b: _Block, least, most, certain_most, k: int, allowed):
    """The columns of ``b`` that can be among some anchor's ``k`` best, and which pairs.

    ``least``, ``most``: an anchor's score must be between them; ``certain_most``: a score
    up to it surely counts, so k rows whose lower bounds reach t (and whose upper bounds do
    not pass certain_most) rule out whatever stays below t. ``allowed``: pairs that may count."""
    import numpy as np

    columns, alive = np.arange(b.n), allowed
    for (ma, da), (mb, db) in zip(a.levels, b.levels):
        mid, reach = ma @ mb[columns].T, da @ db[columns].T
        reach = reach + (1e-9 * np.outer(a.norm, b.norm[columns]) + 1e-6)  # rounding of the bounds
        upper, lower = mid + reach, mid - reach
        alive = alive & (upper >= least[:, None]) & (lower <= most[:, None])
        if len(columns) > k:
            sure = np.where(alive & (upper <= certain_most[:, None]) & (lower >= least[:, None]), lower, -np.inf)
            bar = np.partition(sure, len(columns) - k, axis=1)[:, len(columns) - k]
            alive &= upper >= bar[:, None]
        some = alive.any(0)
        columns, alive = columns[some], alive[:, some]
        if not len(columns):
            break
    return columns, alive


def best(scores, good, k: int):
    """(row, column) of each row's ``k`` greatest good scores, ties by the smaller column
    (columns are in order of ids)."""
    import numpy as np

    rows, cols = [], []
    n = scores.shape[1]
    if scores.dtype == object or np.abs(scores).max(initial=0.0) * max(n, 1) > 2.0 ** 52:
        for i in range(len(scores)):
            c = np.flatnonzero(good[i])
            c = sorted(c.tolist(), key=lambda j: (-scores[i, j], j))[:k]
            rows += [i] * len(c)
            cols += c
        return np.array(rows, int), np.array(cols, int)
    key = np.where(good, scores * n + (n - 1 - np.arange(n)), -np.inf)
    if n > k:
        top = np.argpartition(key, n - k, axis=1)[:, n - k:]
    else:
        top = np.broadcast_to(np.arange(n), (len(key), n))
    r = np.repeat(np.arange(len(key)), top.shape[1])
    c = top.ravel()
    keep = np.isfinite(key[r, c])
    return r[keep], c[keep]


def _long(x) -> int:
    return max(-2 ** 63, min(2 ** 63 - 1, int(x)))


def grid(rows: int, anchors: int, parallel: int) -> tuple[int, int]:
    """Slots of rows and of anchors: enough tasks for the cluster and for a bounded task,
    with as much copied of the one side as of the other."""
    tasks = max(parallel, math.ceil(rows * anchors / TASK_PAIRS), 1)
    of_rows = max(1, min(math.ceil(math.sqrt(tasks * rows / max(anchors, 1))), math.ceil(rows / BLOCK_ROWS), tasks))
    of_anchors = max(1, min(math.ceil(tasks / of_rows), math.ceil(anchors / BLOCK_ANCHORS)))
    return of_rows, of_anchors


def _met(anchors: DataFrame, rows: DataFrame, slots: tuple[int, int], same: bool) -> DataFrame:
    """Each anchor block beside each row block of the same label, or of other labels."""
    of_rows, of_anchors = slots
    named = lambda df, p: df.select(*[F.col(c).alias(p + c) for c in df.columns])
    slot = lambda c, n: F.pmod(F.xxhash64(c), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    a = named(anchors, "a_").withColumn("as", slot("a_block", of_anchors)).withColumn("rs", every(of_rows))
    r = named(rows, "r_").withColumn("rs2", slot("r_block", of_rows)).withColumn("as2", every(of_anchors))
    label = F.col("a_label") == F.col("r_label")
    return a.join(r, (F.col("as") == F.col("as2")) & (F.col("rs") == F.col("rs2")) & (label if same else ~label)).drop(
        "as", "rs", "as2", "rs2", "a_label", "r_label")


def _pairs(batches):
    for batch in batches:
        for at in range(batch.num_rows):
            one = batch.slice(at, 1)
            row = {}
            for c in one.schema.names:
                v = one.column(c)
                # Long lists stay in Arrow's memory; everything else is small.
                row[c] = v.values.slice(v.offsets[0].as_py(), len(v[0])).to_numpy(zero_copy_only=False) \
                    if c[2:] in ("vectors", "means", "devs", "least", "most", "widest") else v[0].as_py()
            yield row


_FOUND = T.StructType([
    T.StructField("block", T.StringType()), T.StructField("at", T.IntegerType()), T.StructField("anchor_id", T.LongType()),
    T.StructField("other", T.LongType()), T.StructField("score", T.LongType())])


def _positives(pairs: DataFrame, k: int) -> DataFrame:
    """The best ``k`` other rows of each anchor in each pair of blocks."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(_FOUND)
        for row in _pairs(batches):
            a, b = _Block(row, "a_"), _Block(row, "r_")
            far = np.full(a.n, np.inf)
            other = (a.ids_or_last[:, None] != b.ids_or_last[None, :]) | b.no_id[None, :]
            columns, alive = survivors(a, b, -far, far, far, k, other)
            if not len(columns):
                continue
            scores = exact(a.x, b.x[columns])
            i, c = best(scores, alive, k)
            yield pa.RecordBatch.from_pydict({
                "block": [row["a_block"]] * len(i), "at": i.tolist(), "anchor_id": [a.ids[x] for x in i],
                "other": [b.ids[columns[x]] for x in c], "score": [_long(scores[x, y]) for x, y in zip(i, c)]}, schema=arrow)

    return pairs.mapInArrow(run, _FOUND)


_MINED = T.StructType([*_FOUND.fields, T.StructField("rank", T.IntegerType()), T.StructField("positive_id", T.LongType()),
                       T.StructField("positive_score", T.LongType())])


def _negatives(pairs: DataFrame, k: int, low: int, high: int) -> DataFrame:
    """The best ``k`` rows in range for each anchor and positive in each pair of blocks."""
    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(_MINED)
        for row in _pairs(batches):
            wanted: dict[int, list] = {}  # of an anchor: (rank, id, score) of its positives that have a range
            for p in row["a_positives"]:
                if low * p["score"] <= high * p["score"]:
                    wanted.setdefault(p["at"], []).append((p["rank"], p["other"], p["score"]))
            if not wanted:
                continue
            ends = {i: (min(low * s for *_, s in ps), max(high * s for *_, s in ps), min(high * s for *_, s in ps))
                    for i, ps in wanted.items()}
            a = _Block(row, "a_")
            limit = np.array([ends.get(i, (1e300, -1e300, -1e300)) for i in range(a.n)], float) / 100.0
            least, most, certain = (limit[:, j] for j in range(3))
            # The whole block first: the range of its summaries against each anchor.
            m, d = a.levels[-1]
            reach = np.maximum(m * row["r_least"], m * row["r_most"]).sum(1) + (d * row["r_widest"]).sum(1)
            if (reach * (1 + 1e-9) + 1e-6 + 1e-9 * np.abs(reach) < least).all():
                continue
            b = _Block(row, "r_")
            # Bounds are compared with a margin; the exact range is tested on exact scores.
            columns, alive = survivors(a, b, least - 1e-6 * (1 + np.abs(least)), most + 1e-6 * (1 + np.abs(most)),
                                       certain - 1e-6 * (1 + np.abs(certain)), k, np.ones((a.n, b.n), bool))
            if not len(columns):
                continue
            scores = exact(a.x, b.x[columns])
            out = {c: [] for c in _MINED.names}
            for nth in range(max(map(len, wanted.values()))):  # the first positive of every anchor, the second, ...
                some = [i for i in wanted if len(wanted[i]) > nth]
                goal = np.array([wanted[i][nth][2] for i in some], scores.dtype)[:, None]
                part = scores[some]
                good = alive[some] & (low * goal <= 100 * part).astype(bool) & (100 * part <= high * goal).astype(bool)
                for x, y in zip(*best(part, good, k)):
                    i = some[x]
                    rank, positive, score = wanted[i][nth]
                    for c, v in zip(_MINED.names, (row["a_block"], i, a.ids[i], b.ids[columns[y]], _long(part[x, y]), rank, positive, score)):
                        out[c].append(v)
            if out["at"]:
                yield pa.RecordBatch.from_pydict(out, schema=arrow)

    return pairs.mapInArrow(run, _MINED)


def mine(rows: DataFrame, positives: int = 5, negatives: int = 5, low: int = 80, high: int = 100) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the
    rows of ``usable`` (components must be whole numbers)."""
    spark = rows.sparkSession
    rows = written(rows, "mining-rows")
    facts = rows.agg(F.count("*").alias("n"), F.count_if("_a").alias("a"), F.max(F.size("_v")).alias("dim")).first()
    n, n_anchors, dim = facts["n"], facts["a"], facts["dim"] or 0
    parts = lambda count, size: max(1, math.ceil(count / (size * BLOCKS_A_PARTITION)))
    blocks = written(packed(rows, dim, BLOCK_ROWS, parts(n, BLOCK_ROWS)), "mining-blocks")
    anchors = written(packed(rows.filter("_a"), dim, BLOCK_ANCHORS, parts(n_anchors, BLOCK_ANCHORS)), "mining-anchors")
    slots = grid(n, n_anchors, 2 * spark.sparkContext.defaultParallelism)
    order = [F.col("score").desc(), F.col("other").asc_nulls_last()]

    found = _positives(_met(anchors, blocks, slots, same=True), positives)
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("block", "at").orderBy(*order)))
    first = ranked.filter(F.col("rank") <= positives)
    # At most ``positives`` entries for each of the anchors of a block.
    by_block = first.groupBy("block").agg(F.collect_list(F.struct("at", "rank", "other", "score")).alias("positives"))
    aimed = written(anchors.join(by_block, "block"), "mining-aimed").select(*anchors.columns, "positives")

    mined = _negatives(_met(aimed, blocks, slots, same=False), negatives, low, high).withColumnRenamed("rank", "nth")
    mined = mined.withColumn("rank", F.row_number().over(Window.partitionBy("block", "at", "nth").orderBy(*order)))
    return mined.filter(F.col("rank") <= negatives).select(
        "anchor_id", "positive_id", "rank", F.col("other").alias("negative_id"), "positive_score",
        F.col("score").alias("negative_score"))
