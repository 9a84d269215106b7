"""Equal-bytes sharding by histogram sort.

Rows are ordered by (64-bit hash of the text, id). The splitters of that order are
found without moving a row: each round counts the exact bytes in the cells between
probe keys, keeps only the cells that a splitter falls into, and probes those more
finely, until a cell is within tolerance (a share of a shard). A text whose copies
outweigh the tolerance is probed by id, so a hot group is cut too; smaller groups of
equal texts are never cut. Then one exchange brings the rows of each part of a shard
together and numbers them: a shard has as many parts, by a hash of the key, as its rows
ask for, and the parts' counts add up to where each begins.

The driver sees at most ``CELLS`` counts for each shard's splitter, whatever the number
of rows; neither a hot text nor a large shard meets in one task.

Defined results: a NULL text weighs the overhead alone and hashes as the empty
text; a NULL id sorts first; rows equal in text and id cannot be told apart and
stay in one part; an empty table gives no rows. Input columns are carried along,
those named like an output are replaced.
"""

from __future__ import annotations

import bisect
from decimal import Decimal
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.llm.common import packed, text_of, unpacked, written

#: Bits of the hash that one round of probes refines, and probes over a run of ids.
BITS, CELLS = 12, 4096
LEAST = -(2 ** 63)


def _cell(bits: int) -> Column:
    """The first ``bits`` bits of the hash, in signed order."""
    return F.shiftright("_hash", 64 - bits)


def _edge(prefix: int, bits: int) -> tuple[int, int] | None:
    """The smallest key of a hash cell; None beyond the last one."""
    return None if prefix >= 2 ** (bits - 1) else (prefix << (64 - bits), LEAST)


def _after(hash_: int, id_: int) -> tuple[int, int] | None:
    """The key (hash, id), or the next hash where the id is past the last one."""
    return (hash_, id_) if id_ < 2 ** 63 else _edge(hash_ + 1, 64)


def splitters(keys: DataFrame, n_ranges: int, tolerance: float) -> tuple[list[tuple[int, int] | None], int]:
    """``n_ranges - 1`` keys in order: rows from a key on lie right of it (None:
    none do). ``keys`` has ``_hash``, ``_id``, ``_size``. Also the total bytes."""
    spark = keys.sparkSession
    stats = [F.sum("_size").alias("b"), F.min("_hash").alias("h0"), F.max("_hash").alias("h1"),
             F.min("_id").alias("i0"), F.max("_id").alias("i1")]
    first = keys.groupBy(F.lit(0).alias("n"), _cell(BITS).alias("c")).agg(*stats).collect()  # at most CELLS rows
    total = sum(r["b"] for r in first)
    goals = [total * k // n_ranges for k in range(1, n_ranges)]
    most = max(1, tolerance * total / n_ranges)
    found: dict[int, tuple[int, int] | None] = {}
    opened = [(0, goals, lambda c: _edge(c, BITS), BITS)]  # bytes left of a cell, its goals, its finer cells' edges
    rows = first
    while opened and rows:
        inside: dict[int, list] = {}
        for r in rows:
            inside.setdefault(r["n"], []).append(r)
        by_hash, by_id = [], []
        for n, (below, mine, edge, bits) in enumerate(opened):
            cells = sorted(inside[n], key=lambda r: r["c"])
            ends = [below + x for x in accumulate(r["b"] for r in cells)]
            for g in mine:
                k = min(bisect.bisect_right(ends, g), len(cells) - 1)
                r, start = cells[k], ends[k] - cells[k]["b"]
                if r["b"] <= most or (r["h0"] == r["h1"] and r["i0"] == r["i1"]):
                    found[g] = edge(r["c"]) if g - start <= ends[k] - g else edge(r["c"] + 1)
                    continue
                todo = by_id if r["h0"] == r["h1"] else by_hash
                if not todo or todo[-1][0] != start:
                    todo.append((start, [], r["h0"], r["i0"], r["i1"], r["c"], bits))
                todo[-1][1].append(g)
        opened, parts = [], []
        if by_hash:
            bits, finer = by_hash[0][6], min(64, by_hash[0][6] + BITS)
            active = spark.createDataFrame([(n, x[5]) for n, x in enumerate(by_hash)], "n int, p long")
            parts.append(keys.join(F.broadcast(active), _cell(bits) == F.col("p"))  # one row for each splitter at most
                         .groupBy("n", _cell(finer).alias("c")).agg(*stats))
            opened += [(x[0], x[1], lambda c, b=finer: _edge(c, b), finer) for x in by_hash]
        if by_id:
            runs = [(len(opened) + n, x[2], x[3], x[4], -(-(x[4] - x[3] + 1) // CELLS)) for n, x in enumerate(by_id)]
            active = spark.createDataFrame([(*r[:4], Decimal(r[4])) for r in runs],
                                           "n int, p long, i0 long, i1 long, step decimal(20,0)")
            at = F.floor((F.col("_id").cast("decimal(20,0)") - F.col("_from")) / F.col("step")).cast("long")
            parts.append(keys.join(F.broadcast(active.withColumnsRenamed({"i0": "_from", "i1": "_till"})),
                                   (F.col("_hash") == F.col("p")) & F.col("_id").between(F.col("_from"), F.col("_till")))
                         .groupBy("n", at.alias("c")).agg(*stats))
            opened += [(x[0], x[1], lambda c, r=r: _after(r[1], min(r[2] + c * r[4], r[3] + 1)), 64)
                       for x, r in zip(by_id, runs)]
        rows = [r for p in parts for r in p.collect()]  # at most CELLS rows for each splitter
    return [found.get(g) for g in goals], total


def shard(docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = 16,
          tolerance: float = 0.002, rows_per_part: int = 200_000) -> DataFrame:
    """Adds ``size``, ``shard`` (0 to ``n_shards - 1``, near equal in bytes) and
    ``slot`` (gapless from 0 in each shard)."""
    text = text_of(text_col)
    rows = packed(docs, _hash=F.xxhash64(text), _id=F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)),
                  _size=F.octet_length(text).cast("long") + overhead)
    spark = docs.sparkSession
    keys = written(rows.select("_hash", "_id", "_size"), "shard-keys")
    parts = max(1, -(-keys.count() // (n_shards * rows_per_part)))
    bounds, _ = splitters(keys, n_shards, tolerance)
    # Of each first-round cell: the shard it starts in, and the splitters inside it.
    cut = [b for b in bounds if b is not None]
    shift = 64 - BITS
    table, at = [], 0
    for c in range(-(CELLS // 2), CELLS // 2):
        mine = []
        start = at
        while at < len(cut) and cut[at][0] >> shift == c:
            mine.append(cut[at])
            at += 1
        table.append((c, start, mine))
    lookup = spark.createDataFrame(table, "c int, start int, inside array<struct<h: long, i: long>>")
    part = F.pmod(F.xxhash64("_hash", "_id"), F.lit(parts)).cast("int")
    sizes = _ranged(keys, lookup).groupBy("shard", part.alias("_part")).agg(F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    bases = sizes.select("shard", "_part", F.coalesce(before, F.lit(0)).cast("long").alias("_base"))
    order = Window.partitionBy("shard", "_part").orderBy("_hash", "_id", "_size")
    out = (_ranged(rows, lookup).withColumn("_part", part).withColumn("_n", F.row_number().over(order)).join(bases, ["shard", "_part"])
           .withColumn("slot", F.col("_base") + F.col("_n") - 1).withColumn("size", F.col("_size")))
    return unpacked(out, "size", "shard", "slot")


def _ranged(rows: DataFrame, lookup: DataFrame) -> DataFrame:
    """Adds the shard of every row; the lookup has CELLS rows and one entry for each splitter."""
    key = F.struct(F.col("_hash").alias("h"), F.col("_id").alias("i"))
    return (rows.join(F.broadcast(lookup), _cell(BITS) == F.col("c"))
            .withColumn("shard", F.col("start") + F.size(F.filter("inside", lambda b: b <= key))))
