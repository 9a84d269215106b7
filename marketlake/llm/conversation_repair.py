"""Conversation structure repair: Knuth's lightest derivation over blocks of turns.

A repaired conversation's role initials are ``(s?(ua)+)?``. A repair is a derivation of
the goal from items ``(i, q)``: the first i turns are edited and the automaton of that
pattern stands in state q. Deductions append one edit: Keep (0), Rerole to the role that
may follow (2), Delete (3, the only one for blank and duplicate turns), Insert an empty
turn (2); an undeleted truncated turn adds 1. A weight is (cost, audit), audit being the
edits' initials; the agenda pops the least weight, ties by ASCII. Every deduction is
superior (it adds a cost or one letter to the audit) and monotone (equal costs with equal
turns are never prefixes of each other), so a popped item is final.

Scale: turns are dealt out by ranges of (conversation, turn, ...), so that a conversation
of any length is spread over many tasks. Each task runs the agenda on blocks of at most
``BLOCK_ROWS`` turns, from every state in which a block may begin; a block becomes one row
with its lightest derivations from state to state. A second agenda joins the blocks of a
conversation in order. What remains sequential is the digest of a repaired conversation:
blocks stream through one task, which holds one block, four audits and four digests.
Duplicates are found by pre-aggregated least turns, not by gathering equal texts.

Defined results: a NULL role or text is one space (so such a text is blank, and such a
role is neither user, assistant nor system); a NULL turn comes first and has no part in
gaps; turns that share a number are ordered by role and text, repeated rows stand next to
each other; a NULL conversation id is a conversation like any other; an empty role has no
initial; a conversation without turns has zeros, an empty audit and the digest of the
empty text; an empty table gives no rows. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

from pyspark.sql import DataFrame, functions as F, types as T

from marketlake.llm.common import written

BLOCK_ROWS = 256
BLOCK_BYTES = 1_000_000
#: Equal turns travel as one row with a number, of so many at most.
MOST_COPIES = 1_000

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
#: The automaton of (s?(ua)+)?: from a state by a role initial; and the states that accept.
START, SYSTEM, USER, ASSISTANT = 0, 1, 2, 3
MOVES = {START: {"s": SYSTEM, "u": USER}, SYSTEM: {"u": USER}, USER: {"a": ASSISTANT}, ASSISTANT: {"u": USER}}
ACCEPT = (START, ASSISTANT)
#: What Rerole and Insert give from a state: the only user or assistant that may follow.
NEXT = {q: next(r for r in moves if r != "s") for q, moves in MOVES.items()}
ROLE = {"u": "user", "a": "assistant"}
LEGAL_PAIRS = ("su", "ua", "au")

#: A turn as one letter: its initial (x: another), in upper case if it is truncated; d if
#: it must be deleted.
FORCED = "d"

Weight = tuple[int, str]


def lightest(axioms: dict, deductions: Callable[[tuple], Iterable], goals: Iterable | None = None) -> dict:
    """Knuth's generalisation of Dijkstra's algorithm. ``deductions(item)`` gives the
    hyperedges that have the item in their tail: (head, tail items, function of the tail's
    weights). The functions must be superior and monotone. Returns the final weights of
    what was popped until all goals (None: all there is) are final or nothing is left."""
    best, final, wanted = dict(axioms), {}, set(goals or ())
    agenda = [(w, item) for item, w in best.items()]
    heapq.heapify(agenda)
    while agenda and (goals is None or wanted):
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        wanted.discard(item)
        for head, tail, function in deductions(item):
            if head in final or any(t not in final for t in tail):
                continue
            new = function(*[final[t] for t in tail])
            if head not in best or new < best[head]:
                best[head] = new
                heapq.heappush(agenda, (new, head))
    return final


def _append(cost: int, audit: str) -> Callable[[Weight], Weight]:
    return lambda w: (w[0] + cost, w[1] + audit)


@lru_cache(maxsize=200_000)
def derivations(turns: str, begin: int) -> tuple[tuple[int, int, str], ...]:
    """The lightest derivations of a block, given as one letter a turn, from state
    ``begin``: (end state, cost, audit) for every end state that can be reached."""
    n = len(turns)

    def deductions(item):
        i, q = item
        yield (i, MOVES[q][NEXT[q]]), (item,), _append(COST[INSERT], INSERT)
        if i == n:
            return
        yield (i + 1, q), (item,), _append(COST[DELETE], DELETE)
        letter = turns[i]
        if letter == FORCED:
            return
        more = TRUNCATED_COST * letter.isupper()
        kept = MOVES[q].get(letter.lower())
        if kept is not None:
            yield (i + 1, kept), (item,), _append(COST[KEEP] + more, KEEP)
        yield (i + 1, MOVES[q][NEXT[q]]), (item,), _append(COST[REROLE] + more, REROLE)

    ends = [(n, q) for q in MOVES]
    final = lightest({(0, begin): (0, "")}, deductions, ends)
    return tuple((q, *final[n, q]) for q in MOVES if (n, q) in final)


def edited(turns: str, begin: int, audit: str) -> Iterator[tuple[str, int | None, str | None]]:
    """What an audit makes of a block: for each edit its initial, the turn it takes (None:
    inserted) and the new role (None: the turn's own; no row is left of a deleted turn)."""
    i, q = 0, begin
    for edit in audit:
        if edit == DELETE:
            yield edit, i, None
        elif edit == KEEP:
            yield edit, i, None
            q = MOVES[q][turns[i].lower()]
        else:
            yield edit, None if edit == INSERT else i, ROLE[NEXT[q]]
            q = MOVES[q][NEXT[q]]
        i += edit != INSERT


def joined(before: dict[int, Weight], steps: list[dict], last: bool) -> dict[int, tuple[Weight, int, str]]:
    """One block more: the lightest weight of each state behind it, the state in front of
    it and the block's own part of the audit. ``last``: of the goal alone."""
    def deductions(item):
        place, q = item
        if place == "before":
            for s in steps:
                if s["begin"] == q:
                    yield ("behind", s["end"]), (item,), _append(s["cost"], s["audit"])
        elif place == "behind" and last and q in ACCEPT:
            yield ("goal", q), (item,), lambda w: w

    goal = "goal" if last else "behind"
    final = lightest({("before", q): w for q, w in before.items()}, deductions)
    out = {}
    for s in steps:
        end = final.get((goal, s["end"]))
        front = before.get(s["begin"])
        if end and front and end == _append(s["cost"], s["audit"])(front):
            out[s["end"]] = (end, s["begin"], s["audit"])
    if last:
        least = min(out, key=lambda q: out[q][0])
        out = {least: out[least]}
    return out


def _taken(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str, *more) -> DataFrame:
    """The columns looked at, under the operator's own names; NULL roles and texts are one space."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(F.col(conv_col).alias("_c"), F.col(turn_col).cast("long").alias("_t"),
                        filled(role_col).alias("_r"), filled(text_col).alias("_x"), *more)


def faults(rows: DataFrame, conversations: DataFrame) -> DataFrame:
    """Turns (``_c`` conversation, ``_t`` turn, ``_r`` role, ``_x`` text) with the first
    fault of each, and one row more for each conversation, in front of its turns.

    Adds ``_k`` (0: the row in front), ``_m`` (so many equal turns), ``_n`` (which of the
    rows of equal turns), ``fault`` of the first of them ('', 'blank', 'duplicate',
    'truncated'; the others are blank or duplicates)."""
    # Equal rows are counted before anything is compared: a hot turn is one row a task.
    counted = rows.groupBy("_c", "_t", "_r", "_x").agg(F.count("*").alias("_copies"))
    counted = written(counted.withColumn("_h", F.sha2("_x", 256)), "conversation-turns")
    place = F.struct(F.col("_t").isNotNull().alias("there"), F.col("_t").alias("turn"))
    keys = ["_c", "_r", "_h"]
    first = counted.groupBy(*keys).agg(F.min(place).alias("_first"))
    first = first.select(*[F.col(k).alias(f"f{k}") for k in keys], "_first")
    same = [F.col(k).eqNullSafe(F.col(f"f{k}")) for k in keys]
    marked = counted.join(first, same[0] & same[1] & same[2])
    each = marked.select("_c", "_t", "_r", "_x", "_copies", F.col("_t").eqNullSafe(F.col("_first.turn")).alias("_is_first"),
                         F.explode(F.expr(f"sequence(0L, (_copies - 1) div {MOST_COPIES})")).alias("_n"))
    blank = ~F.col("_x").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("_x").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    fault = (F.when(blank, "blank").when(~F.col("_is_first") | (F.col("_n") > 0), "duplicate")
             .when(cut, "truncated").otherwise(""))
    copies = F.least(F.lit(MOST_COPIES).cast("long"), F.col("_copies") - F.col("_n") * MOST_COPIES)
    out = each.select("_c", F.lit(1).alias("_k"), "_t", "_r", "_x", "_n", copies.alias("_m"), fault.alias("fault"))
    front = conversations.distinct().select(
        "_c", F.lit(0).alias("_k"), F.lit(None).cast("long").alias("_t"), F.lit("").alias("_r"), F.lit("").alias("_x"),
        F.lit(0).cast("long").alias("_n"), F.lit(1).cast("long").alias("_m"), F.lit("").alias("fault"))
    return out.unionAll(front)


def _blocks_schema(conv: T.DataType) -> T.StructType:
    step = T.StructType([T.StructField("begin", T.IntegerType()), T.StructField("end", T.IntegerType()),
                         T.StructField("cost", T.LongType()), T.StructField("audit", T.StringType())])
    return T.StructType([
        T.StructField("_c", conv), T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
        T.StructField("turns", T.StringType()), T.StructField("roles", T.ArrayType(T.StringType())),
        T.StructField("texts", T.ArrayType(T.StringType())), T.StructField("numbers", T.ArrayType(T.LongType())),
        T.StructField("faults", T.ArrayType(T.StringType())), T.StructField("steps", T.ArrayType(step))])


def blocks(marked: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The turns of ``faults`` in order, as blocks of at most ``block_rows`` turns with
    their lightest derivations; (``part``, ``seq``) is the order of a conversation's blocks."""
    schema = _blocks_schema(marked.schema["_c"].dataType)
    order = ["_c", "_k", F.col("_t").asc_nulls_first(), "_r", "_x", "_n"]
    dealt = marked.repartitionByRange(*order).sortWithinPartitions(*order)

    def run(batches):
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        part, seq, arrow = TaskContext.get().partitionId(), 0, to_arrow_schema(schema)
        block, conv, size, starts = [], None, 0, tuple(MOVES)

        def flush():
            nonlocal block, size, seq
            letters = "".join(r[4] for r in block)
            steps = [{"begin": p, "end": q, "cost": c, "audit": a} for p in starts for q, c, a in derivations(letters, p)]
            row = {"_c": conv, "part": part, "seq": seq, "turns": letters, "roles": [r[0] for r in block],
                   "texts": [r[1] for r in block], "numbers": [r[2] for r in block], "faults": [r[3] for r in block],
                   "steps": steps}
            block, size, seq = [], 0, seq + 1
            return row

        def turns_of(batch):
            """The turns, copies apart; the text of a turn that must go is not kept."""
            for at in range(0, batch.num_rows, 64):
                for r in batch.slice(at, 64).to_pylist():
                    for k in range(r["_m"]):
                        fault = r["fault"] if k == 0 or r["fault"] == "blank" else "duplicate"
                        initial = r["_r"][:1]
                        if fault in ("blank", "duplicate"):
                            yield r, ("", fault, FORCED)
                        else:
                            letter = initial if initial in ("s", "u", "a") else "x"
                            yield r, (r["_x"], fault, letter.upper() if fault == "truncated" else letter)

        out, held, begun = [], 0, False
        for batch in batches:
            for r, (text, fault, letter) in turns_of(batch):
                front = r["_k"] == 0
                if begun and (front or len(block) >= block_rows or size > BLOCK_BYTES):
                    held += size
                    out.append(flush())
                    if len(out) == 1000 or held > BLOCK_BYTES:
                        yield pa.RecordBatch.from_pylist(out, schema=arrow)
                        out, held = [], 0
                    starts = tuple(MOVES)
                if front or not begun:  # a conversation without its front row began in an earlier partition
                    conv, begun = r["_c"], True
                if front:
                    starts = (START,)
                else:
                    block.append((r["_r"], text, r["_t"], fault, letter))
                    size += len(text)
        if begun:
            out.append(flush())
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return dealt.mapInArrow(run, schema)


def _conversations(batches) -> Iterator[Iterator[tuple[dict, bool]]]:
    """The blocks of each conversation, in order, each with whether it is the last."""
    def rows():
        for batch in batches:
            for at in range(0, batch.num_rows, 16):
                yield from batch.slice(at, 16).to_pylist()

    stream = rows()
    ahead = next(stream, None)

    def one():
        nonlocal ahead
        conv = ahead["_c"]
        while ahead is not None and ahead["_c"] == conv:
            row, ahead = ahead, next(stream, None)
            yield row, ahead is None or ahead["_c"] != conv

    while ahead is not None:
        blocks_of = one()
        yield blocks_of
        for _ in blocks_of:  # whatever the caller left
            pass


class _Report:
    """Counts over the turns of one conversation, block by block."""

    def __init__(self):
        self.blank = self.duplicate = self.truncated = self.illegal = self.distinct = 0
        self.least = self.most = self.initial = None

    def add(self, row: dict) -> None:
        self.blank += row["faults"].count("blank")
        self.duplicate += row["faults"].count("duplicate")
        self.truncated += row["faults"].count("truncated")
        for role in row["roles"]:
            self.illegal += self.initial is not None and self.initial + role[:1] not in LEGAL_PAIRS
            self.initial = role[:1]
        for t in row["numbers"]:
            if t is not None and t != self.most:  # in order: a new number is a greater one
                self.distinct += 1
                self.least, self.most = t if self.least is None else self.least, t

    @property
    def gaps(self) -> int:
        return 0 if self.least is None else self.most - self.least + 1 - self.distinct


def _in_order(found: DataFrame) -> DataFrame:
    return found.repartition("_c").sortWithinPartitions("_c", "part", "seq")


def summaries(found: DataFrame) -> DataFrame:
    """One row for each conversation of ``blocks``: ``_c``, the counts of its faults, the
    cost and audit of the lightest repair and the SHA-256 digest of what it leaves
    (``role:text``, joined by newlines)."""
    count = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    schema = T.StructType([found.schema["_c"], *[T.StructField(c, T.LongType()) for c in count],
                           T.StructField("audit", T.StringType()), T.StructField("repaired_sha256", T.StringType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow, out = to_arrow_schema(schema), []
        for conversation in _conversations(batches):
            report, states = _Report(), {START: ((0, ""), hashlib.sha256(), False)}
            for row, last in conversation:
                report.add(row)
                behind = joined({q: s[0] for q, s in states.items()}, row["steps"], last)
                after = {}
                for q, (weight, begin, audit) in behind.items():
                    digest, some = states[begin][1].copy(), states[begin][2]
                    for edit, i, role in edited(row["turns"], begin, audit):
                        if edit == DELETE:
                            continue
                        line = f"{role or row['roles'][i]}:{'' if i is None else row['texts'][i]}"
                        digest.update(("\n" if some else "").encode() + line.encode())
                        some = True
                    after[q] = (weight, digest, some)
                states = after
            ((cost, audit), digest, _), = states.values()
            out.append({"_c": row["_c"], "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest(),
                        **{c: int(getattr(report, c)) for c in count[:-1]}})
            if len(out) == 1000:
                yield pa.RecordBatch.from_pylist(out, schema=arrow)
                out = []
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return _in_order(found).mapInArrow(run, schema)


def _paths(found: DataFrame) -> DataFrame:
    """For each block the state in which the lightest repair enters it and its edits."""
    schema = T.StructType([found.schema["_c"], T.StructField("part", T.IntegerType()), T.StructField("seq", T.LongType()),
                           T.StructField("begin", T.IntegerType()), T.StructField("audit", T.StringType()),
                           T.StructField("position", T.LongType())])

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for conversation in _conversations(batches):
            states, trail = {START: (0, "")}, []
            for row, last in conversation:
                behind = joined(states, row["steps"], last)
                trail.append((row["part"], row["seq"], {q: b[1:] for q, b in behind.items()}))
                states = {q: b[0] for q, b in behind.items()}
            (q, (_, whole)), = states.items()
            out, left = [], sum(e != DELETE for e in whole)
            for part, seq, ways in reversed(trail):
                q, audit = ways[q]
                left -= sum(e != DELETE for e in audit)
                out.append({"_c": row["_c"], "part": part, "seq": seq, "begin": q, "audit": audit, "position": left})
            yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return _in_order(found.select("_c", "part", "seq", "steps")).mapInArrow(run, schema)


def repaired(found: DataFrame) -> DataFrame:
    """The turns that the repair leaves, inserted ones included: ``_c``, ``position``
    (from 0), ``role``, ``text``, ``edit`` (K, R or I) and ``turn``, the number the turn had."""
    schema = T.StructType([found.schema["_c"], T.StructField("position", T.LongType()), T.StructField("role", T.StringType()),
                           T.StructField("text", T.StringType()), T.StructField("edit", T.StringType()),
                           T.StructField("turn", T.LongType())])
    found = written(found, "conversation-blocks")
    paths = _paths(found)
    at = [F.col(f"b.{c}") == F.col(f"p.{c}") for c in ("part", "seq")]
    rows = found.alias("b").join(paths.alias("p"), at[0] & at[1] & F.col("b._c").eqNullSafe(F.col("p._c"))).select(
        "b._c", "b.turns", "b.roles", "b.texts", "b.numbers", "p.begin", "p.audit", "p.position")

    def run(batches):
        import pyarrow as pa
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        for batch in batches:
            for at in range(batch.num_rows):
                r, = batch.slice(at, 1).to_pylist()
                out = [{"_c": r["_c"], "role": role or r["roles"][i], "text": "" if i is None else r["texts"][i],
                        "edit": edit, "turn": None if i is None else r["numbers"][i]}
                       for edit, i, role in edited(r["turns"], r["begin"], r["audit"]) if edit != DELETE]
                for k, x in enumerate(out):
                    x["position"] = r["position"] + k
                if out:
                    yield pa.RecordBatch.from_pylist(out, schema=arrow)

    return rows.mapInArrow(run, schema)


def damaged(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """A test bed: turns spoilt by a hash of ``conversation:turn`` (of each twenty one is
    dropped, emptied, robbed of its stops, repeated, given to the user), as ``faults``
    takes them, and the ids of all conversations."""
    part = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    key = F.concat(part(conv_col), F.lit(":"), part(turn_col))
    rows = _taken(turns, conv_col, turn_col, role_col, text_col, (F.crc32(F.encode(key, "UTF-8")) % 20).alias("_d"))
    spoilt = rows.filter("_d <> 0").select(
        "_c", "_t", F.when(F.col("_d") == 4, "user").otherwise(F.col("_r")).alias("_r"),
        F.when(F.col("_d") == 1, "").when(F.col("_d") == 2, F.regexp_replace("_x", "[.!?]", "")).otherwise(F.col("_x")).alias("_x"),
        F.explode(F.array_repeat(F.lit(1), F.when(F.col("_d") == 3, 2).otherwise(1))).alias("_copy"))
    return spoilt.drop("_copy"), rows.select("_c")


def repair(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
           text_col: str = "text", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``blocks`` of a table of turns, for ``summaries`` and ``repaired``."""
    rows = _taken(turns, conv_col, turn_col, role_col, text_col)
    return blocks(faults(rows, rows.select("_c")), block_rows)
