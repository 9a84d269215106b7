"""Line dedup: repeated runs of lines by prefix doubling.

Every document is the sequence of its lines that hold a word; a line's id is a hash
of its text. Prefix doubling names the suffixes of all sequences: at depth 1 the
name is the line id, at depth 2h it is the pair of the depth-h names h lines apart.
Suffixes with equal names at depth h are one interval of the suffix array whose
longest common prefix is h or more; the doubling goes on with intervals of two and
more members only, so unique lines drop out at once and a suffix at its last
repeated depth. In each interval the first member (smallest document, then line)
is the copy that stays; the h lines at every later member are a copy. Overlapping
copies in a document join to its maximal repeated runs, and those are deleted where
they qualify: ``min_lines`` lines or more (a power of two), or a single line of
``min_words`` words or more.

Names are grouped with a partial aggregation (count and first member), so a line
that a third of all documents hold is a row for each task; the members then join
the few repeated names from a written table, where a hot name can be split. Lines
shift within their own document only.

Defined results: NULL and empty texts have no lines and stay as they are; lines
without a word are never part of a run and always stay; rows equal in id and text
are one document and all of them lose the same lines; NULL ids come first; an empty
table gives no rows; input columns are carried along.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from marketlake.llm.common import WORD, WORD_BREAKS, text_of, unpacked, written

LEAST = -(2 ** 63)
#: Runs (24 bytes each) up to which the documents that lose some are matched by a broadcast,
#: so that no text is shuffled; beyond it texts and runs meet by a shuffle.
BROADCAST_RUNS = 500_000


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows with the identity of their document, the id and a hash of the text;
    the text travels once, beside the other columns."""
    text = text_of(text_col)
    rest = docs.drop(text_col)
    key = docs.select(*[F.col(f"`{c}`") for c in docs.columns], F.coalesce(F.col(id_col).cast("long"), F.lit(LEAST)).alias("_d"),
                      F.xxhash64(text).alias("_h"), text.alias("_text"))
    return key.select(F.struct(*[F.col(f"`{c}`") for c in rest.columns]).alias("_row"), "_d", "_h", "_text")


def _words(line: Column) -> Column:
    return F.size(F.regexp_extract_all(line, F.lit(WORD), F.lit(0)))


def suffixes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 10) -> DataFrame:
    """One row for each line with a word: the document (``_d``, ``_h``), ``line`` (its
    place among those), ``name`` (its id) and ``wide`` (``min_words`` words or more)."""
    rows = _keyed(docs, id_col, text_col).select("_d", "_h", "_text").filter(F.col("_text").rlike(WORD))
    lines = F.filter(F.split("_text", "\n", -1), lambda x: x.rlike(WORD))
    each = F.transform(lines, lambda x: F.struct(F.xxhash64(x).alias("name"), (_words(x) >= min_words).alias("wide")))
    return rows.select("_d", "_h", F.posexplode(each).alias("line", "l")).select("_d", "_h", "line", "l.*")


def repeated(named: DataFrame, depth: int) -> DataFrame:
    """The members of intervals with two members or more, with their interval's first
    member and whether they are it."""
    member = F.struct("_d", "line", "_h")
    groups = written(named.groupBy("name").agg(F.min(member).alias("first"), F.max(member).alias("last"))
                     .filter(F.col("first") != F.col("last")).select("name", "first"), f"line-intervals-{depth}")
    return written(named.join(groups, "name").withColumn("copy", F.col("first") != member), f"line-members-{depth}")


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2,
           min_words: int = 10) -> DataFrame:
    """The copied stretches of lines: document, ``line``, ``depth`` (lines) and the
    ``first`` member whose lines they repeat; each at its last repeated depth and at
    the least qualifying one."""
    if min_lines & (min_lines - 1) or min_lines < 1:
        raise ValueError("min_lines is a power of two")
    members = repeated(suffixes(docs, id_col, text_col, min_words), 1)
    found = [members.filter("copy" if min_lines == 1 else "copy AND wide").select("_d", "_h", "line", F.lit(1).alias("depth"), "first")]
    depth = 1
    while not members.isEmpty():
        ahead = Window.partitionBy("_d", "_h").orderBy("line").rangeBetween(depth, depth)
        pair = members.select("_d", "_h", "line", "name", F.first("name").over(ahead).alias("next")).filter("next IS NOT NULL")
        depth *= 2
        members = repeated(pair.select("_d", "_h", "line", F.xxhash64("name", "next", F.lit(depth)).alias("name")), depth)
        if depth >= min_lines:
            found.append(members.filter("copy").select("_d", "_h", "line", F.lit(depth).alias("depth"), "first"))
    out = found[0]
    for f in found[1:]:
        out = out.unionAll(f)
    return out


def runs(stretches: DataFrame) -> DataFrame:
    """The maximal copied runs of each document: ``line``, ``n_lines``, and the
    longest stretch's source (``first``)."""
    order = Window.partitionBy("_d", "_h").orderBy("line", F.desc("depth"))
    end = F.col("line") + F.col("depth")
    before = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = stretches.withColumn("begins", F.coalesce(F.col("line") > before, F.lit(True)).cast("int"))
    marked = marked.withColumn("run", F.sum("begins").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return (marked.groupBy("_d", "_h", "run")
            .agg(F.min("line").alias("line"), F.max(end).alias("till"), F.max_by("first", "depth").alias("first"))
            .select("_d", "_h", "line", (F.col("till") - F.col("line")).alias("n_lines"), "first"))


def without_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2,
                   min_words: int = 10, carry: list[str] | None = None) -> DataFrame:
    """The rows (or their columns ``carry``) with later copies deleted from the text;
    adds ``n_lines`` (lines with a word, before) and ``n_removed``. A NULL text
    becomes the empty text."""
    found = runs(copies(docs, id_col, text_col, min_lines, min_words))
    cuts = written(found.groupBy("_d", "_h").agg(F.collect_list(F.struct("line", "n_lines")).alias("_cut")), "line-runs")
    rows = _keyed(docs, id_col, text_col)
    if carry is not None:
        rows = rows.withColumn("_row", F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in carry]))
    few = (cuts.agg(F.sum(F.size("_cut"))).first()[0] or 0) <= BROADCAST_RUNS
    rows = rows.join(F.broadcast(cuts) if few else cuts, ["_d", "_h"], "left").select("_row", "_text", "_cut")
    out = T.StructType([rows.schema["_row"], T.StructField(text_col, T.StringType()),
                        T.StructField("n_lines", T.LongType()), T.StructField("n_removed", T.LongType())])

    def run(batches):
        import pyarrow as pa

        breaks = set(WORD_BREAKS)
        for batch in batches:
            texts, total, gone = [], [], []
            for text, cut in zip(batch.column(1), batch.column(2)):
                lines = text.as_py().split("\n")
                places = [k for k, x in enumerate(lines) if not breaks.issuperset(x)]
                dead = {places[k] for c in cut.as_py() or () for k in range(c["line"], c["line"] + c["n_lines"])}
                texts.append("\n".join([x for k, x in enumerate(lines) if k not in dead]) if dead else text.as_py())
                total.append(len(places))
                gone.append(len(dead))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string()), pa.array(total, pa.int64()),
                                              pa.array(gone, pa.int64())], names=out.names)

    return unpacked(rows.mapInArrow(run, out), text_col, "n_lines", "n_removed")
