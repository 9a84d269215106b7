"""Benchmark decontamination by edit distance.

Texts and items are sequences of words (lower case, letters and digits only). An
item of n words is found in a document where some stretch of consecutive words, of
whatever length, is within ``n // TOLERANCE`` word edits of it. Candidates come from the CGK embedding: a random
walk reads the window, and after each step the shared random bit of (step, word)
decides whether the walk moves on, so that sequences at a small edit distance
yield, with good chance, embeddings at a small Hamming distance. Each of
``REPETITIONS`` walks samples ``SAMPLED`` places of the embedding; windows that agree
with an item there are verified by the exact edit distance of the item to the best
stretch of the window widened by ``n // TOLERANCE`` words on both sides. The number of
repetitions follows from the recall, measured by brute force.

Windows are item-sized and start at every word. Most are left out beforehand by a
count that loses nothing: a changed or dropped word breaks at most two word pairs, an
added one breaks one and pushes at most one out of the window, so the window at a
stretch within d edits of an n-word item holds at least n - 1 - 2d of the item's pairs.

Every document is read by one task, whole; the benchmark is a stated query set that
goes to the tasks in blocks of ``BLOCK_WORDS`` words at most.

Defined results: NULL and empty texts, and items without words, match nothing; an item
with a NULL id is searched for like any other and its matches have a NULL ``item_id``;
repeated rows match alike; an empty table gives no rows; a tie between places goes
to the smaller distance, then the earlier place, then the shorter stretch.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.pandas.functions import ArrowUDFType

from marketlake.llm.common import packed, slices, text_of, unpacked

TOLERANCE = 5
REPETITIONS = 32
#: Walks where stretches of other lengths than the item's are looked for.
WIDE_REPETITIONS = 128
SAMPLED = 3
BLOCK_WORDS = 500_000
#: Bytes of text that a task searches at once.
SLICE_BYTES = 3_000_000
_WORDS = r"[^\W_]+"
MATCH = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("first_word", T.IntegerType()),
                      T.StructField("n_words", T.IntegerType()), T.StructField("distance", T.IntegerType())])


class Block:
    """Some items, ready to be searched for in many texts at once. Word 0 stands for
    every word that no item has, -1 for what lies outside a document. ``wide``: an item
    is compared with stretches of any length around a window, else with the window."""

    def __init__(self, items: list[tuple[int | None, str]], repetitions: int = REPETITIONS, sampled: int = SAMPLED, wide: bool = False):
        import re

        import numpy as np

        self.words, self.wide = re.compile(_WORDS).findall, wide
        self.number: dict[str, int] = {}
        numbered = [(i, np.array([self.number.setdefault(w, len(self.number) + 1) for w in self.words(t.lower())], np.int64))
                    for i, t in items]
        self.items = [(i, seq) for i, seq in numbered if len(seq)]
        self.base = len(self.number) + 1
        size = np.array([len(seq) for _, seq in self.items], np.int64)
        self.size, self.most = size, size // TOLERANCE
        #: Pairs (of an item of one word: the word itself, below ``base``) an item must share with a window.
        self.need = np.maximum(1, size - 1 - 2 * self.most)
        pairs = [np.unique(self._pairs(seq)) for _, seq in self.items]
        flat, owner = np.concatenate([*pairs, np.zeros(0, np.int64)]), np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
        order = np.argsort(flat, kind="stable")
        self.every, self.from_ = np.unique(flat[order], return_index=True)
        self.kinds = np.array([len(p) for p in pairs], np.int64)
        self.held = np.sort(owner * len(self.every) + np.searchsorted(self.every, flat))
        self.till, self.owner = np.r_[self.from_[1:], len(flat)], owner[order]
        # A table of 2^20 places keeps most pairs of a text off the exact look-up.
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[self._place(self.every)] = True
        self.single = bool((size == 1).any())
        rng = np.random.default_rng(20)
        self.walks = []
        for _ in range(repetitions):
            bits = rng.integers(0, 2, (64, self.base + 1), dtype=np.int8)
            draw, odd = rng.integers(0, 2 ** 31, sampled), rng.integers(0, 2 ** 62, sampled).astype(np.uint64) * 2 + 1
            keys = np.zeros(len(size), np.uint64)
            for n in np.unique(size):
                mine = np.flatnonzero(size == n)
                keys[mine] = self._walk(np.stack([self.items[k][1] for k in mine]), bits, self._places(draw, n), odd)
            self.walks.append((bits, draw, odd, keys))

    @staticmethod
    def _places(draw, n):
        import numpy as np
        return np.unique(draw % (2 * n))  # a walk moves on at every second step on average

    def _pairs(self, seq):
        return seq if len(seq) == 1 else seq[:-1] * self.base + seq[1:]

    @staticmethod
    def _place(pairs):
        import numpy as np
        return ((pairs.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(44)).astype(np.int64)

    @staticmethod
    def _walk(windows, bits, at, odd):
        """The embedding of many equally long windows, sampled at the places ``at`` and
        hashed to one key for each window."""
        import numpy as np

        n = windows.shape[1]
        padded = np.concatenate([windows, np.full((len(windows), 1), -1)], axis=1)
        row, pos = np.arange(len(windows)), np.zeros(len(windows), np.int64)
        key, taken = np.zeros(len(windows), np.uint64), 0
        for step in range(int(at[-1]) + 1):
            word = padded[row, pos]
            if step == at[taken]:
                key = (key ^ (word + 2).astype(np.uint64)) * odd[taken]
                key ^= key >> np.uint64(29)
                taken += 1
            pos = np.minimum(pos + bits[step % 64, word], n)
        return key

    def _pair_at(self, seq, at):
        return seq[at] * self.base + seq[at + 1]

    def search(self, texts: list[str]) -> list[list[tuple[int, int, int, int]]]:
        """For each text the items found: (item, first word, words, distance) of the best place."""
        import numpy as np

        parts = []
        for t in texts:
            words = self.words(t.lower())
            parts.append(np.fromiter(map(self.number.get, words, repeat(0)), np.int32, len(words)))
        ends = np.cumsum([len(p) for p in parts])
        out: list[list[tuple[int, int, int, int]]] = [[] for _ in texts]
        seq = np.concatenate(parts).astype(np.int64) if parts else np.zeros(0, np.int64)
        if not self.items or not len(seq):
            return out
        hits = np.flatnonzero((seq[:-1] > 0) & (seq[1:] > 0))
        pair = self._pair_at(seq, hits)
        if self.single:
            alone = np.flatnonzero(seq > 0)
            hits, pair = np.r_[hits, alone], np.r_[pair, seq[alone]]
        some = self.sieve[self._place(pair)]
        hits, pair = hits[some], pair[some]
        at = np.minimum(np.searchsorted(self.every, pair), len(self.every) - 1)
        doc = np.searchsorted(ends, hits, "right")
        some = (self.every[at] == pair) & ((pair < self.base) | (hits + 1 < ends[doc]))
        best = self._verified(seq, ends, *self._windows(ends, hits[some], at[some]))
        for (d, k), (far, place, n) in sorted(best.items()):
            out[d].append((self.items[k][0], place - int(ends[d] - len(parts[d])), n, far))
        return out

    def _windows(self, ends, hits, at):
        """(item, first word) of the windows that hold enough pairs of an item. ``hits``:
        places of known pairs, ``at``: their numbers."""
        import numpy as np

        item = self.owner[_ranges(self.from_[at], self.till[at])]
        place = np.repeat(hits, self.till[at] - self.from_[at])
        order = np.lexsort((place, item))
        item, place = item[order], place[order]
        last = np.arange(len(item)) + self.need[item] - 1  # the window's last pair that it needs
        a = np.flatnonzero(last < len(item))
        b = last[a]
        a, b = a[item[a] == item[b]], b[item[a] == item[b]]
        n, doc = self.size[item[a]], np.searchsorted(ends, place[a], "right")
        ok = (place[b] - place[a] <= np.maximum(n - 2, 0)) & (place[b] < ends[doc])
        a, b, n, doc = a[ok], b[ok], n[ok], doc[ok]
        low = np.maximum(place[b] - np.maximum(n - 2, 0), np.r_[0, ends][doc])
        count = place[a] - low + 1
        rows = np.unique(np.repeat(item[a], count) * (int(ends[-1]) + 1) + _ranges(low, place[a] + 1))
        return np.divmod(rows, int(ends[-1]) + 1)

    def _distinct(self, windows, k):
        """Whether each window holds enough different pairs of its item: an edit changes two at most."""
        import numpy as np

        pair = windows if windows.shape[1] == 1 else windows[:, :-1] * self.base + windows[:, 1:]
        at = np.minimum(np.searchsorted(self.every, pair), len(self.every) - 1)
        mark = k[:, None] * len(self.every) + at
        place = np.minimum(np.searchsorted(self.held, mark), len(self.held) - 1)
        mark = np.sort(np.where((self.every[at] == pair) & (self.held[place] == mark), mark, -1), axis=1)
        different = (mark[:, 1:] != mark[:, :-1]).sum(axis=1) + (mark[:, 0] >= 0)
        return different >= np.maximum(1, self.kinds[k] - 2 * self.most[k])

    def _verified(self, seq, ends, item, start) -> dict[tuple[int, int], tuple[int, int, int]]:
        """(document, item): (distance, place, words) of the best place that a walk proposes."""
        import numpy as np

        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for n in np.unique(self.size[item]).tolist():
            of = np.flatnonzero(self.size[item] == n)
            for part in range(0, len(of), 20_000):
                k, p = item[of[part:part + 20_000]], start[of[part:part + 20_000]]
                doc = np.searchsorted(ends, p, "right")
                grid = p[:, None] + np.arange(n)
                windows = np.where(grid < ends[doc][:, None], seq[np.minimum(grid, len(seq) - 1)], -1)
                keep = self._distinct(windows, k)
                k, p, doc, windows = k[keep], p[keep], doc[keep], windows[keep]
                new, most = np.ones(len(k), bool), n // TOLERANCE
                for bits, draw, odd, keys in self.walks if len(k) else ():
                    hit = np.flatnonzero(self._walk(windows, bits, self._places(draw, n), odd) == keys[k])
                    for w in hit.tolist():
                        at, place = (int(doc[w]), int(k[w])), int(p[w])
                        match = self._match(seq, ends, *at, place, most)
                        if match[0] <= most and match < best.get(at, (most + 1, 0, 0)):
                            best[at] = match
                    # What is verified, or found word for word in its document, needs no more walks.
                    new[:] = True
                    new[hit] = False
                    if len(hit):
                        new &= np.array([best.get(x, (1,))[0] > 0 for x in zip(doc.tolist(), k.tolist())], bool)
                        k, p, doc, windows, new = k[new], p[new], doc[new], windows[new], new[new]
                    if not len(k):
                        break
        return best

    def _match(self, seq, ends, doc: int, k: int, place: int, most: int) -> tuple[int, int, int]:
        """(distance, place, words) of an item at the window that starts at ``place``."""
        item = self.items[k][1].tolist()
        low, high = int(ends[doc - 1]) if doc else 0, int(ends[doc])
        if not self.wide:
            return edits(seq[place:min(place + len(item), high)].tolist(), item, most), place, len(item)
        low = max(low, place - most)
        far, first, words = stretch(seq[low:min(place + len(item) + most, high)].tolist(), item, most)
        return far, low + first, words


def _ranges(low, high):
    """The numbers from each low to its high (exclusive), end to end."""
    import numpy as np

    count = high - low
    return np.repeat(low - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def edits(a: list[int], b: list[int], most: int) -> int:
    """Edit distance of two word sequences, exact up to ``most`` (beyond: ``most + 1``):
    columns of the distance matrix as bits of two integers, one step for each word of ``a``."""
    if abs(len(a) - len(b)) > most:
        return most + 1
    distance = len(b)
    for distance in _distances(a, b, 1):
        pass
    return min(distance, most + 1)


def stretch(a: list[int], b: list[int], most: int) -> tuple[int, int, int]:
    """(distance, first word, words) of the stretch of ``a`` that is nearest to ``b``,
    the earliest and then shortest of these (beyond ``most``: ``most + 1``, no place)."""
    ends = list(_distances(a, b, 0))
    far = min(ends, default=most + 1)
    if far > most:
        return most + 1, 0, 0
    places = []
    for end, d in enumerate(ends):
        if d == far:  # from its end backwards: how long it is
            back = _distances(a[max(0, end + 1 - len(b) - far):end + 1][::-1], b[::-1], 1)
            places += [(end + 1 - n, n) for n, x in enumerate(back, 1) if x == far]
    return far, *min(places)


def _distances(a: list[int], b: list[int], start: int) -> Iterator[int]:
    """After each word of ``a`` the distance of ``b`` to the words so far (``start`` 1)
    or to the best stretch that ends there (``start`` 0)."""
    where: dict[int, int] = {}
    for j, word in enumerate(b):
        where[word] = where.get(word, 0) | 1 << j
    full, last = (1 << len(b)) - 1, 1 << len(b) >> 1
    up, down, distance = full, 0, len(b)
    for word in a:
        eq = where.get(word, 0)
        level = (((eq & up) + up) ^ up) | eq | down
        right, left = down | ~(level | up) & full, up & level
        distance += bool(right & last) - bool(left & last)
        right = right << 1 & full | start
        left = left << 1 & full
        up, down = left | ~(level | right) & full, right & level
        yield distance


def blocks(benchmark: DataFrame, item_col: str, text_col: str) -> Iterator[list[tuple[int | None, str]]]:
    """The items in blocks of bounded size, one block on the driver at a time."""
    import re

    some: list[tuple[int | None, str]] = []
    size, words = 0, re.compile(_WORDS)
    for r in benchmark.select(F.col(item_col).alias("i"), text_of(text_col).alias("t")).orderBy("i", "t").toLocalIterator():
        some.append((r["i"], r["t"]))
        size += 1 + sum(1 for _ in words.finditer(r["t"]))
        if size >= BLOCK_WORDS:
            yield some
            some, size = [], 0
    if some:
        yield some


def contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """One row for each document and benchmark item found in it: the document's
    columns (or ``carry``), ``item_id``, the place in words and the distance."""
    rows = packed(docs, _text=text_of(text_col))
    if carry is not None:
        rows = rows.withColumn("_row", F.struct(*[F.col(f"_row.`{c}`").alias(c) for c in carry]))
    schema = T.StructType([rows.schema["_row"], *MATCH.fields])

    def search(items):
        def run(batches):
            import pyarrow as pa

            block = Block(items, WIDE_REPETITIONS, wide=True)
            for batch in batches:
                at, found, n = [], [], 0
                for some in slices(batch.column(1), SLICE_BYTES):
                    for matches in block.search(some):
                        at += [n] * len(matches)
                        found += matches
                        n += 1
                cols = [pa.array([f[j] for f in found], t) for j, t in enumerate((pa.int64(), pa.int32(), pa.int32(), pa.int32()))]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), *cols], names=schema.names)

        return rows.mapInArrow(run, schema)

    out = None
    for items in blocks(benchmark, item_col, item_text_col):
        part = search(items)
        out = part if out is None else out.unionAll(part)
    return unpacked(out if out is not None else rows.sparkSession.createDataFrame([], schema), *MATCH.names)


def clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
          item_text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, with their own columns. Texts
    alone go to Python, and one bit for each comes back; the rows stay where they are."""
    def without(items):
        def run(batches):
            import pyarrow as pa

            block = Block(items, WIDE_REPETITIONS, wide=True)
            for batch in batches:
                yield pa.array([not found for some in slices(batch, SLICE_BYTES) for found in block.search(some)], pa.bool_())

        return F.arrow_udf(run, T.BooleanType(), ArrowUDFType.SCALAR_ITER)

    for items in blocks(benchmark, item_col, item_text_col):
        docs = docs.filter(without(items)(text_of(text_col)))
    return docs
