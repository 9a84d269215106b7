"""N-gram Jaccard join: which texts share most of their word n-grams.

Texts are sets of hashed ``WORDS``-word n-grams of their words (lower case, letters
and digits). Texts with equal sets form one class. The classes' MinHash signatures
are cut into bands; band and row counts follow from the target recall at the
threshold (``bands``). Classes meet where a band's hash is equal, and every pair that
meets is verified on the full sets.

Buckets of up to ``SMALL`` classes give their pairs as rows. Larger ones (a group of
thousands of near copies) never do: the classes that large buckets connect are packed
into blocks of ``CHUNK`` sets and ``BLOCK_BYTES`` at most, each set as its difference from
the block's first, and a pair of blocks is verified by matrix products, giving back a
count for each class and a spanning forest of the links. So no link is lost, and a set
travels once for each block of its group, as a few n-grams where texts are near copies.
The comparisons themselves grow with the square of a group of *different* texts, and with
them the counts, one for each class and block it meets; exact copies cost nothing.

The result has one row for each document: its class (the least id that links lead
to) and its number of links, copies included.

Defined results: a text of fewer words than ``WORDS`` is one n-gram, all its words;
a NULL text, or one without words, links to nothing and is a class of its own; rows
equal in id and text count as copies of each other; a NULL id is the least one; an
empty table gives no rows. Only the two named columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, functions as F, types as T

from marketlake.llm.common import slices, text_of, written

WORDS, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.999999, 4
SMALL, CHUNK = 16, 512
BLOCK_BYTES = 16_000_000
#: Sets of a group that one task packs, about (below CHUNK, so that chance seldom makes two blocks of them).
PACKED_ROWS = 448
#: Classes up to which the texts to verify are picked by a broadcast of their keys (16 bytes each).
BROADCAST_ROWS = 1_000_000
LEAST = -(2 ** 63)


def bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = ROWS) -> int:
    """Bands of ``rows`` hashes that a pair at the threshold shares one of with chance ``recall``."""
    return math.ceil(math.log(1 - recall) / math.log(1 - threshold ** rows))


class Shingler:
    """Sets and signatures of texts, the same on every machine."""

    def __init__(self, n_bands: int, rows: int = ROWS):
        import re

        import numpy as np
        import xxhash

        self.words, self.hash = re.compile(r"[^\W_]+").findall, xxhash.xxh3_64_intdigest
        rng = np.random.default_rng(6)
        odd = lambda n: rng.integers(0, 2 ** 63, n, dtype=np.uint64) * 2 + 1
        self.place, self.odd, self.rows, self.n_bands = odd(WORDS), odd(n_bands * rows), rows, n_bands

    def set_of(self, text: str):
        """The sorted hashes of the text's n-grams; empty without words."""
        import numpy as np

        words = self.words(text.lower())
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < WORDS:
            return np.array([self.hash("\x00" + " ".join(words))], np.uint64)
        h = np.fromiter(map(self.hash, words), np.uint64, len(words))
        n = len(h) - WORDS + 1
        out = np.zeros(n, np.uint64)
        for k in range(WORDS):
            out = (out ^ (out >> np.uint64(32)) ^ h[k:k + n]) * self.place[k]
        return np.unique(out ^ (out >> np.uint64(29)))

    def bands_of(self, hashes) -> list[int]:
        """One number for each band of the signature."""
        import numpy as np

        least = np.empty(len(self.odd), np.uint64)
        for a in range(0, len(hashes), 4096):
            part = (hashes[a:a + 4096][None, :] * self.odd[:, None]).min(axis=1)
            least = part if a == 0 else np.minimum(least, part)
        raw = least.tobytes()
        width = 8 * self.rows
        return [_signed(self.hash(bytes([k % 256]) + raw[k * width:(k + 1) * width])) for k in range(self.n_bands)]


def _signed(x: int) -> int:
    return x - 2 ** 64 if x >= 2 ** 63 else x


_SETS = T.StructType([T.StructField("_d", T.LongType()), T.StructField("_h", T.LongType()), T.StructField("set", T.LongType()),
                      T.StructField("n", T.IntegerType()), T.StructField("bands", T.ArrayType(T.LongType()))])


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = text_of(text_col)
    return docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("_d"), F.xxhash64(text).alias("_h"), text.alias("_t"))


def signatures(keyed: DataFrame, n_bands: int) -> DataFrame:
    """For each row its set's identity (0: no words), its size and its bands."""

    def run(batches):
        import pyarrow as pa
        import xxhash

        shingler = Shingler(n_bands)
        for batch in batches:
            at = 0
            for some in slices(batch.column(2)):
                sets = [shingler.set_of(t) for t in some]
                ids = [(_signed(xxhash.xxh3_64_intdigest(s.tobytes())) or 1) if len(s) else 0 for s in sets]
                band = [shingler.bands_of(s) if len(s) else [] for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(some)), batch.column(1).slice(at, len(some)), pa.array(ids, pa.int64()),
                    pa.array([len(s) for s in sets], pa.int32()), pa.array(band, pa.list_(pa.int64()))], names=_SETS.names)
                at += len(some)

    return keyed.mapInArrow(run, _SETS)


def full_sets(keyed: DataFrame) -> DataFrame:
    """``set`` and its packed hashes, of rows with ``set`` and the text."""
    schema = T.StructType([T.StructField("set", T.LongType()), T.StructField("grams", T.BinaryType())])

    def run(batches):
        import pyarrow as pa

        shingler = Shingler(0)
        for batch in batches:
            at = 0
            for some in slices(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, len(some)), pa.array(
                    [shingler.set_of(t).tobytes() for t in some], pa.binary())], names=schema.names)
                at += len(some)

    return keyed.select("set", "_t").mapInArrow(run, schema)


def components(edges: DataFrame, name: str) -> DataFrame:
    """``node`` and ``root`` (the least node that edges ``a``, ``b`` lead to), by contraction:
    a node's parent is its least smaller neighbour, chains of parents are followed to their
    ends, edges go to the ends of their nodes, and what is left starts over. Edges that fall
    together or inside a node vanish, so later rounds have few."""
    left = written(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), f"{name}-edges")
    labels, step = None, 0
    while True:
        step += 1
        parents = written(left.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node"), f"{name}-{step}")
        while True:  # parents are smaller than their nodes: chains end
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            if parents.join(above, "root", "left_semi").isEmpty():
                break
            parents = written(parents.join(above, "root", "left").select("node", F.coalesce("next", "root").alias("root")), f"{name}-{step}-chain")
        ends = left.select(F.col("b").alias("node")).unionAll(left.select("a")).distinct() if labels is None else labels
        if labels is None:
            labels = ends.join(parents, "node", "left").select("node", F.coalesce("root", "node").alias("root"))
        else:
            up = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            labels = labels.join(up, "root", "left").select("node", F.coalesce("next", "root").alias("root"))
        labels = written(labels, f"{name}-{step}-labels")
        a, b = parents.select(F.col("node").alias("a"), F.col("root").alias("ra")), parents.select(F.col("node").alias("b"), F.col("root").alias("rb"))
        both = left.join(a, "a").select("ra", "b").distinct().join(b, "b", "left").select("ra", F.coalesce("rb", "b").alias("rb"))
        left = written(both.filter("ra <> rb").select(F.greatest("ra", "rb").alias("a"), F.least("ra", "rb").alias("b")).distinct(), f"{name}-{step}-left")
        if left.isEmpty():
            return labels


_LINKS = T.StructType([T.StructField("set", T.LongType()), T.StructField("root", T.LongType()),
                       T.StructField("texts", T.LongType()), T.StructField("docs", T.LongType())])


_BLOCK = T.StructType([T.StructField("group", T.LongType()), T.StructField("block", T.StringType()), T.StructField("sets", T.ArrayType(T.LongType())),
                       T.StructField("copies", T.ArrayType(T.LongType())), T.StructField("base", T.BinaryType()),
                       T.StructField("without", T.ArrayType(T.BinaryType())), T.StructField("more", T.ArrayType(T.BinaryType()))])


def packed(grams: DataFrame) -> DataFrame:
    """Sets (``group``, ``part``, ``set``, ``copies``, ``grams``) in blocks of one group: the
    first set of a block whole, of each the places in it that are missing and the n-grams
    that are new."""
    dealt = grams.select("group", "part", "set", "copies", "grams").repartition("group", "part").sortWithinPartitions("group", "part", "set")

    def run(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, part, number = to_arrow_schema(_BLOCK), TaskContext.get().partitionId(), 0
        held, key, size = [], None, 0

        def block():
            nonlocal held, number, size
            base = held[0][2]
            row = {"group": key[0], "block": f"{part}:{number}", "sets": [r[0] for r in held], "copies": [r[1] for r in held],
                   "base": base.tobytes(),
                   "without": [np.flatnonzero(~np.isin(base, g, assume_unique=True)).astype(np.uint32).tobytes() for *_, g in held],
                   "more": [np.setdiff1d(g, base, assume_unique=True).tobytes() for *_, g in held]}
            held, number, size = [], number + 1, 0
            return pa.RecordBatch.from_pydict({k: [v] for k, v in row.items()}, schema=arrow)

        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                for r in batch.slice(at, 16).to_pylist():
                    if held and (key != (r["group"], r["part"]) or len(held) == CHUNK or size + len(r["grams"]) > BLOCK_BYTES):
                        yield block()
                    key = (r["group"], r["part"])
                    held.append((r["set"], r["copies"], np.frombuffer(r["grams"], np.uint64)))
                    size += len(r["grams"])
        if held:
            yield block()

    return dealt.mapInArrow(run, _BLOCK)


def unpacked_sets(base: bytes, without: list[bytes], more: list[bytes]) -> list:
    """The sets of a block."""
    import numpy as np

    base = np.frombuffer(base, np.uint64)
    return [np.concatenate([np.delete(base, np.frombuffer(w, np.uint32)), np.frombuffer(m, np.uint64)]) for w, m in zip(without, more)]


def linked(ids, copies, grams, sides, threshold: float) -> dict:
    """The links among sets (``sides``: between those of two sides alone): for each class
    with a link the number of linked classes and of their documents, and its root."""
    import numpy as np

    ids, copies, sides = np.asarray(ids, np.int64), np.asarray(copies, np.float64), np.asarray(sides)
    size = np.array([len(g) for g in grams], np.float64)
    flat, doc = np.concatenate(grams), np.repeat(np.arange(len(grams)), size.astype(np.int64))
    order = np.argsort(flat, kind="stable")
    flat, doc = flat[order], doc[order]
    first = np.r_[True, flat[1:] != flat[:-1]]
    number, count = np.cumsum(first) - 1, np.diff(np.r_[np.flatnonzero(first), len(flat)])
    shared = count[number] > 1
    number, doc = number[shared], doc[shared]
    both = np.zeros((len(grams), len(grams)), np.float64)
    if len(number):
        number = np.unique(number, return_inverse=True)[1]
        for a in range(0, int(number[-1]) + 1, 4096):  # a few thousand n-grams at a time
            low, high = np.searchsorted(number, [a, a + 4096])
            grid = np.zeros((len(grams), 4096), np.float32)
            grid[doc[low:high], number[low:high] - a] = 1
            both += grid @ grid.T
    link = both >= threshold * (size[:, None] + size[None, :] - both) - 1e-9
    np.fill_diagonal(link, False)
    if sides.any():
        link &= sides[:, None] != sides[None, :]
    root = np.arange(len(ids))
    while True:  # least index that links lead to
        new = np.minimum(root, np.where(link, root[None, :], len(ids)).min(axis=1, initial=len(ids)))
        new = new[new]
        if (new == root).all():
            break
        root = new
    some = link.any(axis=1)
    return {"set": ids[some], "root": ids[root[some]], "texts": link.sum(axis=1)[some], "docs": (link @ copies).astype(np.int64)[some]}


def verified(pairs: DataFrame, threshold: float) -> DataFrame:
    """The links of each pair of blocks (``l_`` and ``r_`` columns), or within one."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(batch.num_rows):
                row, = batch.slice(at, 1).to_pylist()
                sides = ["l"] if row["l_block"] == row["r_block"] else ["l", "r"]
                sets = [unpacked_sets(row[f"{s}_base"], row[f"{s}_without"], row[f"{s}_more"]) for s in sides]
                take = lambda c: [x for s in sides for x in row[f"{s}_{c}"]]
                out = linked(take("sets"), take("copies"), [g for some in sets for g in some],
                             np.repeat(np.arange(len(sides)), [len(some) for some in sets]), threshold)
                yield pa.RecordBatch.from_arrays([pa.array(out[c], pa.int64()) for c in _LINKS.names], names=_LINKS.names)

    return pairs.mapInArrow(run, _LINKS)


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row for each row of ``docs``: ``_d`` (its id, LEAST for NULL), ``_h`` (hash of its
    text), ``class_id``, ``n_links`` (other documents, copies included),
    ``n_linked_texts`` (other sets) and ``has_words``."""
    keyed = _keyed(docs, id_col, text_col)
    rows = written(signatures(keyed, bands(threshold)), "ngram-signatures")
    some = rows.filter("set <> 0")
    classes = written(some.groupBy("set").agg(F.count("*").alias("copies"), F.min("_d").alias("_d"), F.min_by("_h", F.struct("_d", "_h")).alias("_h"),
                                              F.first("bands").alias("bands")), "ngram-classes")
    member = classes.select("set", F.posexplode("bands").alias("k", "v")).select(F.xxhash64("k", "v").alias("bucket"), "set")
    buckets = written(member.groupBy("bucket").agg(F.count("*").alias("size"), F.min("set").alias("least"))
                      .filter("size > 1"), "ngram-buckets")
    met = written(member.join(buckets, "bucket"), "ngram-members")

    # Classes that large buckets connect.
    large = met.filter((F.col("size") > SMALL) & (F.col("set") != F.col("least")))
    groups = components(large.select(F.col("set").alias("a"), F.col("least").alias("b")), "ngram-groups")
    sizes = groups.groupBy("root").agg(F.count("*").alias("members"))
    groups = written(groups.join(sizes, "root").select(F.col("node").alias("set"), F.col("root").alias("group"), F.ceil(F.col("members") / PACKED_ROWS).cast("int").alias("parts")),
                     "ngram-groups")

    # Pairs of small buckets, but for those that a group verifies.
    small = written(met.filter(F.col("size") <= SMALL).join(groups.select("set", "group"), "set", "left"), "ngram-small")
    a, b = small.select("bucket", F.col("set").alias("a"), F.col("group").alias("ga")), small.select("bucket", F.col("set").alias("b"), F.col("group").alias("gb"))
    pairs = written(a.join(b, "bucket").filter((F.col("a") < F.col("b")) & ~F.coalesce(F.col("ga") == F.col("gb"), F.lit(False)))
                    .select("a", "b").distinct(), "ngram-pairs")

    asked = pairs.select(F.col("a").alias("set")).unionAll(pairs.select("b")).unionAll(groups.select("set")).distinct()
    keys = written(classes.join(asked, "set").select("set", "copies", "_d", "_h"), "ngram-asked")
    n_keys = keys.count()
    picked = keys.select("_d", "_h", "set")
    text = keyed.join(F.broadcast(picked) if n_keys <= BROADCAST_ROWS else picked, ["_d", "_h"])
    grams = written(full_sets(text).dropDuplicates(["set"]).join(keys.select("set", "copies"), "set"), "ngram-sets")

    left = grams.select(F.col("set").alias("a"), F.col("grams").alias("ga"), F.col("copies").alias("ca"))
    right = grams.select(F.col("set").alias("b"), F.col("grams").alias("gb"), F.col("copies").alias("cb"))
    found = written(_similar(pairs.join(left, "a").join(right, "b"), threshold), "ngram-links")
    part = F.pmod(F.xxhash64("set"), F.col("parts")).cast("int")
    blocks = written(packed(grams.join(groups, "set").withColumn("part", part)), "ngram-blocks")
    side = lambda p: blocks.select(*[F.col(c).alias(p + c) for c in blocks.columns])
    meet = blocks.select("group", F.col("block").alias("l_block")).join(blocks.select("group", F.col("block").alias("r_block")), "group")
    meet = written(meet.filter("l_block <= r_block").drop("group"), "ngram-block-pairs").repartition("l_block", "r_block")
    dense = written(verified(meet.join(side("l_"), "l_block").join(side("r_"), "r_block"), threshold), "ngram-block-links")

    one = lambda s, c: found.select(F.col(s).alias("set"), F.lit(1).cast("long").alias("texts"), F.col(c).alias("docs"))
    counts = (one("a", "cb").unionAll(one("b", "ca")).unionAll(dense.select("set", "texts", "docs"))
              .groupBy("set").agg(F.sum("texts").alias("texts"), F.sum("docs").alias("docs")))
    edges = found.select("a", "b").unionAll(dense.filter("set <> root").select("set", "root"))
    roots = components(edges, "ngram-links").withColumnRenamed("node", "set")
    named = classes.select("set", "copies", "_d").join(roots, "set", "left").withColumn("root", F.coalesce("root", "set"))
    ids = written(named.groupBy("root").agg(F.min("_d").alias("class_id")), "ngram-ids")
    zero = F.lit(0).cast("long")
    table = written(named.join(ids, "root").join(counts, "set", "left").select(
        "set", "class_id", (F.col("copies") - 1 + F.coalesce("docs", zero)).alias("n_links"), F.coalesce("texts", zero).alias("n_linked_texts"), F.lit(True).alias("has_words")), "ngram-table")
    alone = rows.filter("set = 0").select("_d", "_h", F.col("_d").alias("class_id"), zero.alias("n_links"), zero.alias("n_linked_texts"), F.lit(False).alias("has_words"))
    return some.select("_d", "_h", "set").join(table, "set").select("_d", "_h", "class_id", "n_links", "n_linked_texts", "has_words").unionAll(alone)


def _similar(pairs: DataFrame, threshold: float) -> DataFrame:
    """The pairs whose full sets reach the threshold."""
    schema = T.StructType([f for f in pairs.schema if f.name in ("a", "b", "ca", "cb")])

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            keep = []
            for x, y in zip(batch.column(len(schema)), batch.column(len(schema) + 1)):
                x, y = np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both >= threshold * (len(x) + len(y) - both) - 1e-9)
            yield pa.RecordBatch.from_arrays([batch.column(i) for i in range(len(schema))], names=schema.names).filter(pa.array(keep, pa.bool_()))

    return pairs.select(*schema.names, "ga", "gb").mapInArrow(run, schema)


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` that stay: of each class the document with the least id
    (of equal rows one); texts without words all stay."""
    text = text_of(text_col)
    out = written(join(docs, id_col, text_col, threshold), "ngram-result")
    worded = out.filter("has_words")
    best = worded.groupBy("class_id").agg(F.min(F.struct("_d", "_h")).alias("k")).select("class_id", "k")
    gone = written(worded.join(best, "class_id").filter(F.struct("_d", "_h") != F.col("k")).select("_d", "_h").distinct(), "ngram-gone")
    twice = written(worded.groupBy("_d", "_h").count().filter("count > 1").select("_d", "_h"), "ngram-equal-rows")
    rows = docs.select(F.struct("*").alias("doc"), F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("_d"),
                       F.xxhash64(text).alias("_h"))
    small = lambda t: F.broadcast(t) if t.count() <= BROADCAST_ROWS else t
    kept = rows.join(small(gone), ["_d", "_h"], "left_anti")
    if not twice.isEmpty():
        equal = kept.join(small(twice), ["_d", "_h"], "left_semi").dropDuplicates(["_d", "_h"])
        kept = kept.join(small(twice), ["_d", "_h"], "left_anti").unionByName(equal)
    return kept.select("doc.*")
