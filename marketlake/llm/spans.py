"""Spans of pattern matches in code points, by DataFrame functions only.

``split`` and ``regexp_extract_all`` with one pattern cut a text into alternating
gaps and matches; running sums of their lengths are the positions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def pieces(text: Column, pattern: str) -> Column:
    """For one text the array of its matches, leftmost and non-overlapping, each with the
    length of the gap before it. The text is cut once, however many matches there are."""
    gaps, hits = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    both = F.zip_with(gaps, hits, lambda g, h: F.struct(F.char_length(g).alias("gap"), h.alias("value")))
    return F.filter(both, lambda m: m["value"].isNotNull())  # the gap behind the last match


def positions(df: DataFrame, key: str, kinds: dict[str, str], carry: list[str]) -> DataFrame:
    """One row for each match: ``carry``, ``kind`` (its number), ``start``, ``end``
    and the match's fields. ``kinds`` maps a kind to the column of its ``pieces``."""
    def numbered(k: int, c: str) -> Column:
        some = F.coalesce(F.col(c), F.array().cast(df.schema[c].dataType))
        return F.transform(some, lambda m, i: F.struct(F.lit(k).alias("kind"), i.alias("at"), m.alias("m")))

    each = F.explode(F.concat(*[numbered(k, c) for k, c in enumerate(kinds.values())])).alias("e")
    rows = df.select(key, *[c for c in carry if c != key], each)
    till = F.sum(F.col("e.m.gap") + F.char_length("e.m.value")).over(
        Window.partitionBy(key, "e.kind").orderBy("e.at").rowsBetween(Window.unboundedPreceding, 0))
    return (rows.withColumn("end", till.cast("long"))
            .withColumn("start", F.col("end") - F.char_length("e.m.value"))
            .select(key, *[c for c in carry if c != key], F.col("e.kind").alias("kind"), "start", "end", "e.m.*")
            .drop("gap"))


def joined(spans: Column, names: list[str]) -> Column:
    """``kind:start:end`` of an array of (start, kind, end), in order, by commas."""
    name = F.array(*[F.lit(n) for n in names])
    one = lambda s: F.concat_ws(":", F.get(name, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    return F.array_join(F.transform(F.array_sort(spans), one), ",")
