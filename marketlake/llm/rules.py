"""Quality rules as a bitmask ledger.

One pass measures every text; each rule is then evaluated once, as a column
expression over the measurements, and its failure sets one bit of ``failed``.
Policies are versioned sets of rules: applying one is a bitwise AND against the
ledger, and an ablation (what a policy would keep without one of its rules) is an
aggregate over the few different masks. Neither reads a text again.

Defined results: a NULL or empty text has no words and all measurements 0, so it
fails ``few_words``; repeated rows get equal ledgers; an empty table gives an empty
ledger; an input column named like a ledger column is replaced.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from marketlake.llm.common import WORD_BREAKS, add_columns, slices

MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_letters",
            "n_capitals", "n_shouts")
_SCHEMA = T.StructType([T.StructField(m, T.LongType()) for m in MEASURES])

# The character classes that are counted.
SYMBOLS = b"#*$%&|<>"
CAPITALS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LETTERS = CAPITALS + CAPITALS.lower()
_BREAKS = set(WORD_BREAKS)


def measure_text(text: str) -> tuple[int, ...]:
    """The measurements of one text, in the order of ``MEASURES``."""
    import numpy as np

    raw = text.encode()
    words = raw.split()  # on the six ASCII breaks
    seen, lines, again = set(), 0, 0
    for line in text.split("\n"):
        if line and not _BREAKS.issuperset(line):
            lines += 1
            again += line in seen
            seen.add(line)
    repeated = 0
    if len(words) >= 4:  # fewer words hold no two windows
        number: dict[bytes, int] = {}
        w = np.fromiter((number.setdefault(x, len(number)) for x in words), np.int64, len(words))
        pair = w[:-1] * len(number) + w[1:]
        if len(number) > 2_000_000:  # keeps the next product within 64 bits
            pair = np.unique(pair, return_inverse=True)[1]
        window = pair[:-1] * len(number) + w[2:]
        order = np.argsort(window, kind="stable")
        same = window[order[1:]] == window[order[:-1]]
        twice = np.zeros(len(window), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        inside = np.zeros(len(words), bool)
        for k in range(3):
            inside[k:k + len(twice)] |= twice
        repeated = int(inside.sum())
    less = lambda chars: len(raw) - len(raw.translate(None, chars))
    return (len(words), len(text) - sum(map(text.count, WORD_BREAKS)), less(SYMBOLS), again, repeated, lines,
            less(LETTERS), less(CAPITALS), less(b"!"))


def measure(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds the measurements to every row (a narrow Arrow map)."""

    def run(texts):
        import pyarrow as pa

        for some in slices(texts):
            rows = [measure_text(t or "") for t in some]
            yield len(some), {m: pa.array([r[i] for r in rows], pa.int64()) for i, m in enumerate(MEASURES)}

    return add_columns(docs, run, _SCHEMA, text_col, carry)


@dataclass(frozen=True)
class Rule:
    """A rule has one bit for good; ``fails`` builds its condition from measurements."""
    bit: int
    name: str
    fails: Callable[[], Column]


_c = F.col
RULES = (
    Rule(0, "few_words", lambda: _c("n_words") < 50),
    Rule(1, "repeated_words", lambda: 100 * _c("n_repeat_words") > 50 * _c("n_words")),
    Rule(2, "symbols", lambda: 10 * _c("n_symbols") > _c("n_words")),
    Rule(3, "repeated_lines", lambda: 100 * _c("n_dup_lines") > 50 * _c("n_lines")),
    Rule(4, "short_words", lambda: _c("word_chars") < 2 * _c("n_words")),
    Rule(5, "long_words", lambda: _c("word_chars") > 15 * _c("n_words")),
    Rule(6, "capitals", lambda: 100 * _c("n_capitals") > 40 * _c("n_letters")),
    Rule(7, "shouting", lambda: 4 * _c("n_shouts") > _c("n_words")),
)

#: Versioned policies: the rules whose failure rejects a document.
POLICIES = {
    "base": ("few_words", "repeated_words"),
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "short_words", "long_words", "capitals",
           "shouting"),
}


def mask(policy: str) -> int:
    bits = {r.name: r.bit for r in RULES}
    return sum(1 << bits[name] for name in POLICIES[policy])


def ledger(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (or their columns ``carry``) with their measurements and the failure bits of all rules."""
    bits = [F.when(r.fails(), F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")) for r in RULES]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs, text_col, carry).withColumn("failed", failed)


def passes(policy: str) -> Column:
    """Whether a ledger row passes ``policy``."""
    return F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")) == 0


def ablations(led: DataFrame, policy: str) -> DataFrame:
    """For each rule of ``policy``: documents that fail it, that fail it alone, and
    what the policy keeps with and without it. The ledger shrinks to one row for
    each different mask before anything is compared."""
    masks = led.groupBy(F.col("failed").bitwiseAND(F.lit(mask(policy)).cast("long")).alias("m")).agg(F.count("*").alias("n"))
    rules = [r for r in RULES if mask(policy) >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("bit"))
                               for r in rules])).alias("r")
    total = lambda cond: F.coalesce(F.sum(F.when(cond, F.col("n"))), F.lit(0).cast("long"))
    bit, m = F.col("r.bit"), F.col("m")
    return (masks.select("m", "n", each).groupBy("r.rule")
            .agg(total(m.bitwiseAND(bit) != 0).alias("n_failed"), total(m == bit).alias("n_failed_alone"),
                 total(m == 0).alias("n_kept"), total(m.bitwiseAND(F.bitwise_not(bit)) == 0).alias("n_kept_without"))
            .select("rule", "n_failed", "n_failed_alone", "n_kept", "n_kept_without"))


def keep(docs: DataFrame, policy: str = "v1", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that pass ``policy``, with their own columns only."""
    rows = docs.select(F.struct("*").alias("doc"), F.col(text_col).alias("body"))
    return ledger(rows, "body", ["doc"]).filter(passes(policy)).select("doc.*")
