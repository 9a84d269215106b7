"""Personal data, and the words around it that give it away.

Patterns find the protected entities (addresses, numbers). Corpus co-occurrence
then estimates how strongly a word discloses an entity: with N documents, n(e) and
n(t) that hold the entity and the word, and n(t, e) that hold both (the word anywhere
outside the entities, not only beside one; n(t) counts it inside them too), the word discloses

    log2(n(t, e) * N / (n(t) * n(e)))   bits, and names it with chance n(t, e) / n(t).

The bits count as a share of the entity's own information, log2(N / n(e)), so that rare
and hot entities and small and large corpora are rated alike. ``op10_pii`` hides the words
of all pairs over both thresholds. The operator may ask for more: by default an entity of
several documents needs the word in two of them, and an entity of one document is disclosed
by the words that no other document holds. An entity that all documents hold has no
information, so none discloses it.

A word over both thresholds is removed wherever it stands in a document that holds
that entity if it names it almost surely, and generalised otherwise. Only built-in functions run on the
executors. All counts are over all documents; they are aggregated before they are
shuffled, and an entity that a third of all documents hold is joined from written
tables, where its rows can be split.

Entities that the same documents hold have the same numbers, so they are rated as one
group: a document of many addresses that stand nowhere else is one pair with a word, not
one for each. Entities of one document need no pairs at all, and a word that too many
documents hold for an entity's chance to reach the threshold is left out before pairs
are counted. Words are rated once a document; only flagged words are looked for in place.

Defined results: a NULL text has no spans; repeated rows are scanned alike and each
counts as a document; an empty table gives no rows; no input column but the two
named ones is read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketlake.llm.common import text_of, written
from marketlake.llm.spans import pieces, positions

# The patterns. Possessive repeats and the start conditions match the same
# spans as the plain forms, without restarting inside a run or recursing for each repeat.
PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
ANY = r"[A-Za-z0-9._%+-]@[A-Za-z0-9-]++\.[A-Za-z0-9-]|[0-9]\.[0-9]++\.[0-9]++\.[0-9]|[0-9](?:[\x20-]?[0-9]){13}|\+[0-9][\x20().0-9-]+[0-9]"
KINDS = [*PATTERNS, "generalise", "remove"]
TERM = r"\p{L}{3,}+"
#: Thresholds are met up to rounding: bits are sums of logarithms.
ROUNDING = 1e-12


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the check digit of the text holds."""
    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when(i % 2 == 1, twice).otherwise(d)
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add) % 10 == 0


def _valid(kind: Column, value: Column) -> Column:
    parts = F.transform(F.split(value, r"\."), lambda p: F.ltrim(p, F.lit("0")))
    ip = F.forall(parts, lambda p: (F.length(p) < 3) | ((F.length(p) == 3) & (p <= "255")))
    digits = _digits(value)
    n = F.length(digits)
    return (F.when(kind == 0, True).when(kind == 1, ip).when(kind == 2, F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
            .otherwise(n.between(10, 15)))


def _terms(text: Column) -> Column:
    """The distinct words of a text, lower case."""
    return F.array_distinct(F.transform(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)), F.lower))


def _outside(text: Column) -> Column:
    """The text without its addresses, the only entities that have letters at all, and
    without the letters that touch one: they are parts of a word that overlaps it."""
    gaps = F.split(text, PATTERNS["email"], -1)
    head = lambda g, i: F.when(i > 0, F.regexp_replace(g, r"^\p{L}++", "")).otherwise(g)
    tail = lambda g, i: F.when(i < F.size(gaps) - 1, F.regexp_replace(g, r"(?<!\p{L})\p{L}++$", "")).otherwise(g)
    return F.array_join(F.transform(F.transform(gaps, head), tail), " ")


def _places(texts: DataFrame, flagged: DataFrame, entities: DataFrame) -> DataFrame:
    """Where the flagged words (``_doc``, ``term``, ...) stand outside the entities."""
    some = texts.join(flagged.select("_doc").distinct(), "_doc", "left_semi").repartition("_doc")
    words = positions(some.select("_doc", pieces(F.col("_text"), TERM).alias("_words")), "_doc", {"word": "_words"}, ["_doc"])
    kept = words.select("_doc", "start", "end", F.lower("value").alias("term")).join(flagged, ["_doc", "term"])
    more = [c for c in flagged.columns if c not in ("_doc", "term")]
    spans = entities.select("_doc", "start", "end", F.lit(None).cast("string").alias("term"),
                            *[F.lit(None).cast(flagged.schema[c].dataType).alias(c) for c in more])
    both = kept.select("_doc", "start", "end", "term", *more).unionByName(spans)
    entity = lambda c: F.when(F.col("term").isNull(), F.col(c))
    order = Window.partitionBy("_doc").orderBy("start", F.col("term").isNotNull())
    till = F.max(entity("end")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    # Looked up backwards: a frame that grows by a row at a time costs no more than the rows.
    back = Window.partitionBy("_doc").orderBy(F.col("start").desc(), F.col("term").isNotNull().desc())
    next_ = F.last(entity("start"), ignorenulls=True).over(back.rowsBetween(Window.unboundedPreceding, -1))
    return (both.withColumn("_till", till).withColumn("_next", next_)
            .filter(F.col("term").isNotNull() & (F.coalesce("_till", F.lit(0)) <= F.col("start"))
                    & (F.col("_next").isNull() | (F.col("_next") >= F.col("end")))).drop("_till", "_next"))


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """``documents`` (``_doc``, a number for each row, and ``_id``) and ``entities``:
    ``_doc``, ``kind``, ``start``, ``end``, ``entity`` (hash of kind and value) and
    ``_text``, the document's text, in one row of each document."""
    rows = docs.select(F.monotonically_increasing_id().alias("_doc"), F.col(id_col).alias("_id"), text_of(text_col).alias("_text"))
    hit = F.col("_text").rlike(ANY)
    seen = written(rows.select("_doc", "_id", F.when(hit, F.col("_text")).alias("_text"),
                               *[F.when(hit, pieces(F.col("_text"), p)).alias(f"_{k}")
                                                for k, p in PATTERNS.items()]), "pii-candidates")
    spans = positions(seen, "_doc", {k: f"_{k}" for k in PATTERNS}, ["_doc"]).filter(_valid(F.col("kind"), F.col("value")))
    first = F.row_number().over(Window.partitionBy("_doc").orderBy("kind", "start")) == 1
    entities = spans.select("_doc", "kind", "start", "end", F.xxhash64("kind", "value").alias("entity")).withColumn(
        "_first", F.when(first, F.col("_doc")))
    texts = seen.filter(F.col("_text").isNotNull()).select(F.col("_doc").alias("_first"), "_text")
    alone, others = entities.filter("_first IS NOT NULL"), entities.filter("_first IS NULL")
    return seen.select("_doc", "_id"), written(alone.join(texts, "_first").drop("_first").unionByName(
        others.drop("_first").withColumn("_text", F.lit(None).cast("string"))), "pii-entities")


def disclosing(docs: DataFrame, entities: DataFrame, text_col: str = "text", min_share: float = 0.5,
               min_chance: float = 0.5, sure: float = 0.9, min_docs: int = 2) -> DataFrame:
    """The spans of disclosing words: ``_doc``, ``start``, ``end``, ``kind`` (number
    in ``KINDS``), ``bits``, ``chance``. A word counts from ``min_share`` of the entity's information on.
    ``min_docs``: how many documents must hold both; with 1 the thresholds alone decide."""
    texts = entities.filter(F.col("_text").isNotNull()).select("_doc", "_text")
    words = written(texts.select("_doc", F.explode(_terms(_outside(F.col("_text")))).alias("term")), "pii-words")
    each = written(entities.select("_doc", "entity").distinct(), "pii-held")
    # Entities by the documents that hold them: their number and two digests of the set.
    sets = each.groupBy("entity").agg(F.count("*").alias("n_entity"), F.bit_xor(F.xxhash64("_doc")).alias("_x"),
                                      F.bit_xor(F.xxhash64("_doc", F.lit(1))).alias("_y"))
    groups = written(each.join(sets, "entity").select("_doc", "n_entity", "_x", "_y").distinct(), "pii-groups")
    asked = words.select("term").distinct()
    n_term = (docs.select(F.explode(_terms(text_of(text_col))).alias("term")).select(F.xxhash64("term").alias("h"))
              .groupBy("h").agg(F.count("*").alias("n_term")))
    n_term = asked.withColumn("h", F.xxhash64("term")).join(n_term, "h").drop("h")
    counted = written(words.join(n_term, "term"), "pii-counted")
    total = float(docs.count())
    own = F.log2(F.lit(total) / F.col("n_entity"))
    # An entity of one document: the words that few enough others hold, or none.
    few = F.col("n_term") * F.lit(min_chance) <= 1 if min_docs <= 1 else F.col("n_term") == 1
    named = 1 / F.col("n_term")
    alone = counted.filter(few).join(groups.filter("n_entity = 1").select("_doc", "n_entity").distinct(), "_doc").select(
        "_doc", "term", named.alias("chance"), (own + F.log2(named)).alias("bits"), own.alias("own"))
    # An entity of several: the words that enough of them hold, in few enough others.
    pairs = written(counted.filter(F.col("n_term") >= min_docs).join(groups.filter("n_entity > 1"), "_doc")
                    .filter(F.col("n_term") * F.lit(min_chance) <= F.col("n_entity"))
                    .withColumn("pair", F.xxhash64("term", "n_entity", "_x", "_y")), "pii-pairs")
    both = pairs.groupBy("pair").agg(F.count("*").alias("n_both"), F.first("n_term").alias("n_term"), F.first("n_entity").alias("n_entity"))
    chance = F.col("n_both") / F.col("n_term")
    rated = both.filter(F.col("n_both") >= min_docs).select("pair", chance.alias("chance"), (own + F.log2(chance)).alias("bits"), own.alias("own"))
    good = (F.col("own") > 0) & (F.col("bits") >= min_share * F.col("own") - ROUNDING) & (F.col("chance") >= min_chance)
    several = pairs.select("_doc", "term", "pair").join(written(rated.filter(good), "pii-rated"), "pair")
    flagged = written(alone.filter(good).unionByName(several.drop("pair")).groupBy("_doc", "term").agg(
        F.max("chance").alias("chance"), F.max("bits").alias("bits")), "pii-flagged")
    best = _places(texts, flagged, entities)
    kind = F.when(F.col("chance") >= sure, F.lit(KINDS.index("remove"))).otherwise(F.lit(KINDS.index("generalise")))
    return best.select("_doc", kind.alias("kind"), F.col("start").cast("long"), F.col("end").cast("long"), "bits", "chance")


def sanitised(text: Column, spans: Column) -> Column:
    """The text with its spans replaced: ``[kind]`` for entities, ``[word]`` for
    generalised words, nothing for removed ones. ``spans``: array of (start, kind,
    end); of overlapping spans the one that starts first counts, then the longest."""
    names = F.array(*[F.lit(f"[{k}]") for k in PATTERNS], F.lit("[word]"), F.lit(""))
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["start"].alias("s"), (-s["end"]).alias("e"), s["kind"].alias("k"))))
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("long").alias("at"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.substr(text, (acc["at"] + 1).cast("int"), (s["s"] - acc["at"]).cast("int"))
        return F.when(s["s"] >= acc["at"], F.struct(F.concat(acc["out"], gap, F.get(names, s["k"])).alias("out"), (-s["e"]).alias("at"))).otherwise(acc)

    done = F.aggregate(ordered, start, step)
    return F.concat(done["out"], F.substr(text, (done["at"] + 1).cast("int"), F.char_length(text)))
