"""BPE encoding and decoding of whole texts with a public word-level vocabulary.

The merges run in batched numpy rounds: the symbols of many words lie in one
flat array; each round looks up the rank of every adjacent pair by binary search
over the sorted pair keys, takes the lowest rank of each word and merges its
occurrences from the left. Only words a task has not met before are merged; a
text is then a gather over the words' ids.

Defined results: a NULL or empty text has no ids and decodes to the empty text;
repeated rows, extra columns and empty tables pass through (a column of the input
named like an output is replaced). A text is tokenized whole, however long.
"""

from __future__ import annotations

import json
import unicodedata

from pyspark.sql import DataFrame, functions as F, types as T

from marketlake.llm.common import add_columns, slices

#: Words one Python worker remembers; beyond it the memory starts anew.
MEMORY_WORDS = 60_000

ENCODED = T.StructType([T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
                        T.StructField("decoded", T.StringType())])


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: Latin-1 letters and signs
    stand for themselves, the other bytes get the characters from U+0100 on."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = iter(range(0x100, 0x200))
    return [chr(b) if b in own else chr(next(rest)) for b in range(256)]


class WordBpe:
    """A vocabulary file of the tokenizers library with word ends (``</w>``)."""

    def __init__(self, path: str):
        import numpy as np
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, vocab = spec["model"], spec["model"]["vocab"]
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(split["pattern"]["Regex"]).findall
        self.added = regex.compile("(" + "|".join(map(regex.escape, added)) + ")") if added else None
        self.tokens: dict[int, str] = {i: t for t, i in [*vocab.items(), *added.items()]}
        self.token = [self.tokens.get(i, "") for i in range(max(self.tokens) + 1)]
        end = model["end_of_word_suffix"] or ""
        symbols = byte_symbols()
        self.inner = np.array([vocab[s] for s in symbols], np.int64)
        self.last = np.array([vocab[s + end] for s in symbols], np.int64)
        self.base = len(self.token)
        left, right, whole = zip(*((vocab[a], vocab[b], vocab[a + b]) for a, b in
                                   (m if isinstance(m, list) else m.split(" ") for m in model["merges"])))
        keys = np.array(left, np.int64) * self.base + np.array(right, np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks, self.whole = keys[order], order, np.array(whole, np.int64)
        self.special = added
        self.forget()

    def forget(self) -> None:
        import numpy as np

        self.codes = _Codes()
        self.flat, self.start, self.length = (np.zeros(0, np.int64) for _ in range(3))
        for word in self.special:  # never the result of splitting, so safe as words of their own
            self.codes[word]
        self.codes.new.clear()
        ids = np.array(list(self.special.values()), np.int64)
        self.flat, self.start, self.length = ids, np.arange(len(ids)), np.ones(len(ids), np.int64)

    def split(self, text: str) -> list[str]:
        """The words of a text: added tokens are cut out of the raw text first,
        the rest is composed (NFC), lower-cased letter by letter and split."""
        if self.added is not None and "<|" in text:
            out: list[str] = []
            for k, piece in enumerate(self.added.split(text)):
                out += [piece] if k % 2 else self.words(lowered(piece))
            return out
        return self.words(lowered(text))

    def merge(self, words: list[str]):
        """Ids of many words at once: flat ids and the number of ids of each word."""
        import numpy as np

        raw = [w.encode() for w in words]
        sizes = np.array([len(r) for r in raw], np.int64)
        data = np.frombuffer(b"".join(raw), np.uint8)
        sym, word = self.inner[data], np.repeat(np.arange(len(words)), sizes)
        ends = np.cumsum(sizes) - 1
        sym[ends] = self.last[data[ends]]
        none = len(self.ranks)
        done_sym, done_word = [], []
        while len(sym):
            first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
            key = sym[:-1] * self.base + sym[1:]
            at = np.minimum(np.searchsorted(self.keys, key), none - 1)
            rank = np.full(len(sym), none)
            hit = (self.keys[at] == key) & (word[1:] == word[:-1])
            rank[:-1][hit] = self.ranks[at[hit]]
            least = np.repeat(np.minimum.reduceat(rank, first), np.diff(np.r_[first, len(sym)]))
            over = least == none
            if over.any():  # no pair of these words can be merged any more
                done_sym.append(sym[over])
                done_word.append(word[over])
                sym, word, rank, least = (x[~over] for x in (sym, word, rank, least))
                if not len(sym):
                    break
            at = np.flatnonzero(rank == least)
            run = np.r_[True, np.diff(at) > 1] | np.r_[True, word[at[1:]] != word[at[:-1]]]
            place = np.arange(len(at))
            place -= np.maximum.accumulate(np.where(run, place, 0))
            at = at[place % 2 == 0]  # in a run of overlapping pairs every second one, from the left
            sym[at] = self.whole[rank[at]]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            sym, word = sym[keep], word[keep]
        sym, word = np.concatenate(done_sym), np.concatenate(done_word)
        return sym[np.argsort(word, kind="stable")], np.bincount(word, minlength=len(words))

    def encode(self, texts: list[str]):
        """Flat ids of many texts (int64) and the number of ids of each text."""
        import numpy as np

        if len(self.codes) > MEMORY_WORDS:
            self.forget()
        counts, parts = [], []
        for text in texts:
            words = self.split(text)
            counts.append(len(words))
            parts.append(np.fromiter(map(self.codes.__getitem__, words), np.int64, len(words)))
        codes = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        if self.codes.new:
            ids, sizes = self.merge(self.codes.new)
            self.start = np.r_[self.start, len(self.flat) + np.cumsum(sizes) - sizes]
            self.length, self.flat = np.r_[self.length, sizes], np.r_[self.flat, ids]
            self.codes.new.clear()
        size = self.length[codes]
        till = np.cumsum(size)
        total = int(till[-1]) if len(till) else 0
        ids = self.flat[np.repeat(self.start[codes] - (till - size), size) + np.arange(total)]
        bounds = np.r_[0, till][np.r_[0, np.cumsum(counts)].astype(np.int64)]
        return ids, np.diff(bounds)

    def decode(self, ids: list[int]) -> str:
        """The vocabulary file names no decoder: the tokens joined by one space."""
        return " ".join(map(self.token.__getitem__, ids))


class _Codes(dict):
    """Numbers words in the order they are met; ``new`` holds those not merged yet."""

    def __init__(self):
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def lowered(text: str) -> str:
    """NFC, then lower case of each letter alone (no final sigma)."""
    if not text.isascii():
        text = unicodedata.normalize("NFC", text)
        if "Σ" in text:
            text = text.replace("Σ", "σ")
    return text.lower()


_LOADED: dict[str, WordBpe] = {}


def load(path: str) -> WordBpe:
    """One vocabulary per Python worker and path."""
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_decode(docs: DataFrame, tokenizer: str, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Adds ``n_tokens``, ``ids`` (little-endian unsigned 32-bit integers) and
    ``decoded`` (the text of those ids) to every row. A narrow map: no shuffle.
    ``tokenizer`` is a path that every executor can open; ``carry`` names the input
    columns to return (all of them by default)."""

    def run(texts):
        import pyarrow as pa

        bpe = load(tokenizer)
        for some in slices(texts, 1_000_000):
            ids, counts = bpe.encode([t or "" for t in some])
            wire, at, raw, decoded = ids.astype("<u4").tobytes(), 0, [], []
            for n in counts.tolist():
                raw.append(wire[4 * at:4 * (at + n)])
                decoded.append(bpe.decode(ids[at:at + n].tolist()))
                at += n
            yield len(some), {"n_tokens": pa.array(counts, pa.int64()), "ids": pa.array(raw, pa.binary()),
                              "decoded": pa.array(decoded, pa.string())}

    return add_columns(docs, run, ENCODED, text_col, carry)


def decode_ids(df: DataFrame, tokenizer: str, ids_col: str = "ids") -> DataFrame:
    """``decoded`` from packed ids alone, such as those of a written table."""

    def run(batches):
        import numpy as np
        import pandas as pd

        bpe = load(tokenizer)
        for ids in batches:
            yield pd.Series([None if x is None else bpe.decode(np.frombuffer(x, "<u4").tolist()) for x in ids])

    from collections.abc import Iterator

    import pandas as pd
    run.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return df.withColumn("decoded", F.pandas_udf(run, "string")(F.col(ids_col)))


def ids_array(col: str = "ids"):
    """Packed ids as ``array<int>``, by DataFrame functions."""
    words = F.regexp_extract_all(F.hex(F.col(col)), F.lit("[0-9A-F]{8}"), F.lit(0))
    byte = lambda w, k: F.substring(w, 1 + 2 * k, 2)
    return F.transform(words, lambda w: F.conv(F.concat(*[byte(w, k) for k in (3, 2, 1, 0)]), 16, 10).cast("int"))
