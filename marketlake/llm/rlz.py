"""Substring dedup by relative Lempel-Ziv parsing against the indexed corpus.

Every document is parsed against all text that starts earlier (a smaller id, or the
same document further left). The reference is an index of windows of ``WINDOW``
words, dealt into blocks by window hash; an entry names the least document that
holds the window. A document's windows visit their blocks, and the greedy parse
reads the answers from the left: a factor begins at a window whose sequence starts
earlier and goes on while the following windows have the same reference; where
the reference changes or ends, the windows across the factor's boundary are the
next ones looked up, so a repeat that two factors share is not missed. Factors of
``WINDOW`` words or more are duplicate spans; every other word is a literal and stays.

Most windows never travel. Texts equal in all words are parsed once. Of the rest,
winnowing picks the least hash among the ``GRAM``-word grams of every window (about
one word in eight); equal windows pick equal grams, so only windows whose gram
occurs twice in the corpus are candidates, and only those are indexed.

Counts and least documents are partial aggregates, and the rows that visit the index
join it from written tables, where a hot gram or window can be split.

Defined results: a word is a stretch without the six ASCII breaks; NULL and empty
texts have none; documents of fewer than ``WINDOW`` words lose nothing; rows with
equal ids are the same document (neither starts earlier at an equal place); a NULL id
is the least one; an empty table gives no rows. Windows are compared by 64-bit
hashes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from marketlake.llm.common import slices, text_of, written

WINDOW, GRAM = 20, 6
LEAST = -(2 ** 63)


def _odd(n: int):
    import numpy as np
    return np.random.default_rng(7).integers(0, 2 ** 63, n, dtype=np.uint64) * 2 + 1


def _mixed(h, width: int):
    """One hash for each run of ``width`` word hashes."""
    import numpy as np

    n, odd = len(h) - width + 1, _odd(width)
    out = np.zeros(max(n, 0), np.uint64)
    for k in range(width if n > 0 else 0):
        out = (out ^ (out >> np.uint64(32)) ^ h[k:k + n]) * odd[k]
    return out ^ (out >> np.uint64(29))


def _slide(x, width: int, least: bool):
    """The least (or largest) of each run of ``width`` values, by doubling."""
    import numpy as np

    pick, size = np.minimum if least else np.maximum, 1
    while 2 * size <= width:
        x = pick(x[:-size], x[size:])
        size *= 2
    return pick(x[:len(x) - (width - size)], x[width - size:]) if width > size else x


def word_hashes(words: list[bytes]):
    import numpy as np
    import xxhash

    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def winnowed(h):
    """Of the word hashes of a text: the least gram of each window, and the grams that are the least of one."""
    import numpy as np

    grams = _mixed(h, GRAM)
    width = WINDOW - GRAM + 1
    least = _slide(grams, width, True)
    edge = np.zeros(width - 1, np.uint64)
    chosen = _slide(np.concatenate([edge, least, edge]), width, False) == grams
    return least, grams[chosen]


_SCAN = T.StructType([T.StructField("_d", T.LongType()), T.StructField("_h", T.LongType()), T.StructField("whole", T.BinaryType()),
                      T.StructField("n", T.LongType()), T.StructField("grams", T.ArrayType(T.LongType()))])


def scanned(keyed: DataFrame) -> DataFrame:
    """Of each row (``_d``, ``_h``, text): its number of words, the digest of its words
    joined by one space, and its winnowed grams."""

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            at = 0
            for some in slices(batch.column(2)):
                whole, n, grams = [], [], []
                for text in some:
                    words = text.encode().split()
                    n.append(len(words))
                    whole.append(hashlib.sha256(b" ".join(words)).digest())
                    grams.append(winnowed(word_hashes(words))[1].astype(np.int64) if len(words) >= WINDOW else np.zeros(0, np.int64))
                offsets = pa.array(np.r_[0, np.cumsum([len(g) for g in grams])], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(some)), batch.column(1).slice(at, len(some)), pa.array(whole, pa.binary()),
                    pa.array(n, pa.int64()), pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(grams), pa.int64()))],
                    names=_SCAN.names)
                at += len(some)

    return keyed.mapInArrow(run, _SCAN)


_WINDOWS = T.StructType([T.StructField("row", T.LongType()), T.StructField("_d", T.LongType()), T.StructField("text", T.StringType()),
                         T.StructField("hashes", T.ArrayType(T.LongType()))])


def candidates(rows: DataFrame) -> DataFrame:
    """Of the rows (``row``, ``_d``, text, its repeated ``grams``) that have a window whose gram
    is repeated: the different hashes of those windows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            i = 0
            for some in slices(batch.column(2), 4_000_000):
                hashes = []
                for k, text in enumerate(some, i):
                    h = word_hashes(text.encode().split())
                    repeated = np.array(batch.column(3)[k].as_py(), np.int64).astype(np.uint64)
                    hashes.append(np.unique(_mixed(h, WINDOW)[np.isin(winnowed(h)[0], repeated)]).astype(np.int64))
                n = len(some)
                found = pa.array([len(x) > 0 for x in hashes], pa.bool_())
                offsets = pa.array(np.r_[0, np.cumsum([len(x) for x in hashes])], pa.int32())
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(i, n) for c in range(3)),
                    pa.ListArray.from_arrays(offsets, pa.array(np.concatenate(hashes), pa.int64()))], names=_WINDOWS.names).filter(found)
                i += n

    return rows.select("row", "_d", "text", "grams").mapInArrow(run, _WINDOWS)


_PARSED = T.StructType([T.StructField("row", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept", T.StringType()),
                        T.StructField("kept_sha256", T.BinaryType()), T.StructField("factors", T.ArrayType(T.StructType([
                            T.StructField("start", T.IntegerType()), T.StructField("n_words", T.IntegerType()),
                            T.StructField("reference", T.LongType())])))])


def factors(starts, hashes, own: int, earlier: dict[int, int]) -> list[tuple[int, int, int]]:
    """The greedy parse of one text: (start, words, reference) of its factors, from the
    windows whose words start earlier, from the left. ``earlier``: for those that a smaller
    document holds, the least one; the others came up further left in the same text (``own``)."""
    out: list[tuple[int, int, int]] = []
    for s, h in zip(starts, hashes):
        ref = earlier.get(h, own)
        if out and out[-1][2] == ref and out[-1][0] + out[-1][1] == s + WINDOW - 1:
            out[-1] = (out[-1][0], out[-1][1] + 1, ref)
        else:
            out.append((s, WINDOW, ref))
    return out


def parsed(rows: DataFrame) -> DataFrame:
    """Parses rows (``row``, ``_d``, text, and the (hash, least document) pairs of the windows
    that other documents hold) and cuts the factors out; rows that lose nothing are left out."""

    def run(batches):
        import hashlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            for i in range(batch.num_rows):
                row, d, text, hits = (batch.column(c)[i].as_py() for c in range(4))
                words = text.encode().split()
                hashes = _mixed(word_hashes(words), WINDOW).astype(np.int64)
                earlier = {h["hash"]: h["least"] for h in hits or () if h["least"] < d}
                again = np.ones(len(hashes), bool)
                again[np.unique(hashes, return_index=True)[1]] = False
                starts = np.flatnonzero(again | np.isin(hashes, np.fromiter(earlier, np.int64, len(earlier))))
                if not len(starts):
                    continue
                found = factors(starts.tolist(), hashes[starts].tolist(), d, earlier)
                stays = np.ones(len(words), bool)
                for s, n, _ in found:
                    stays[s:s + n] = False
                kept = b" ".join([w for w, keep in zip(words, stays.tolist()) if keep])
                out.append((row, int((~stays).sum()), kept.decode(), hashlib.sha256(kept).digest(),
                            [{"start": s, "n_words": n, "reference": r} for s, n, r in found]))
            kinds = (pa.int64(), pa.int64(), pa.string(), pa.binary(),
                     pa.list_(pa.struct([("start", pa.int32()), ("n_words", pa.int32()), ("reference", pa.int64())])))
            yield pa.RecordBatch.from_arrays([pa.array([o[c] for o in out], t) for c, t in enumerate(kinds)], names=_PARSED.names)

    return rows.select("row", "_d", "text", "hits").mapInArrow(run, _PARSED)


def parse(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row for each row of ``docs``: ``_d`` (its id, LEAST for NULL), ``_h`` (hash of its
    text), ``n_words``, ``n_removed``, ``kept`` (the words that stay, joined by one
    space; NULL where all stay), ``kept_sha256`` (of the words that stay) and
    ``factors`` (a text that repeats a smaller document's whole text is one factor)."""
    text = text_of(text_col)
    keyed = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("_d"), F.xxhash64(text).alias("_h"), text.alias("text"))
    rows = written(scanned(keyed).withColumn("row", F.monotonically_increasing_id()), "rlz-rows")
    firsts = written(rows.groupBy("whole").agg(F.min(F.struct("_d", "row")).alias("f"))
                     .select("whole", F.col("f._d").alias("first_d"), F.col("f.row").alias("first_row")), "rlz-firsts")
    once = rows.select("row", "whole", "n", "grams").join(firsts.select("first_row"), F.col("row") == F.col("first_row"), "left_semi")
    each = once.filter(F.col("n") >= WINDOW).select("row", F.explode("grams").alias("gram"))
    twice = written(each.groupBy("gram").agg(F.count("*").alias("k")).filter("k > 1").select("gram"), "rlz-grams")
    lists = written(each.join(twice, "gram").groupBy("row").agg(F.collect_set("gram").alias("grams")), "rlz-lists")
    places = lists.join(rows.select("row", "_d", "_h"), "row")
    # Equal rows are one document; after the join they lie in one partition, so this shuffles nothing more.
    wanted = keyed.join(places, ["_d", "_h"]).dropDuplicates(["_d", "_h"]).select("row", "_d", "text", "grams")
    found = written(candidates(wanted), "rlz-windows")
    visit = found.select("row", "_d", F.explode("hashes").alias("hash"))
    index = written(visit.groupBy("hash").agg(F.min("_d").alias("least"), F.max("_d").alias("last"))
                    .filter("least < last").select("hash", "least"), "rlz-index")
    hits = written(visit.join(index, "hash").filter("least < _d").groupBy("row")
                   .agg(F.collect_list(F.struct("hash", "least")).alias("hits")), "rlz-hits")
    done = written(parsed(found.drop("hashes").join(hits, "row", "left")), "rlz-parsed")
    out = (rows.select("row", "_d", "_h", "whole", "n").join(firsts, "whole")
           .join(done.withColumnRenamed("row", "first_row"), "first_row", "left"))
    same, long = F.col("_d") == F.col("first_d"), F.col("n") >= WINDOW
    whole_factor = F.array(F.struct(F.lit(0).alias("start"), F.col("n").cast("int").alias("n_words"), F.col("first_d").alias("reference")))
    none = F.array().cast(_PARSED["factors"].dataType)
    removed = F.when(same, F.coalesce("n_removed", F.lit(0).cast("long"))).when(long, F.col("n")).otherwise(F.lit(0).cast("long"))
    all_gone = ~same & long
    digest = F.when(all_gone, F.sha2(F.lit(""), 256)).otherwise(F.lower(F.hex(F.when(same, F.coalesce("kept_sha256", "whole")).otherwise(F.col("whole")))))
    return out.select("_d", "_h", F.col("n").alias("n_words"), removed.alias("n_removed"),
                      F.when(all_gone, F.lit("")).when(same, F.col("kept")).alias("kept"), digest.alias("kept_sha256"),
                      F.when(same, F.coalesce("factors", none)).when(long, whole_factor).otherwise(none).alias("factors"))
