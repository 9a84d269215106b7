"""Conversation repair: the agenda against all short edit scripts, blocks, hot conversations, edges."""

import hashlib
import itertools
import random
import re

from pyspark.sql import functions as F

from marketlake.llm import conversation_repair as C

SCHEMA = "conv_id long, turn long, role string, text string, _c string, cost string, Text2 string"
SPACE = "\x20\x09\x0a\x0b\x0c\x0d"
LEGAL = re.compile(r"(s?(ua)+)?\Z")


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", "x", None) for r in rows], SCHEMA)


def marked(rows):
    """A conversation's turns in order, with their first faults, written down plainly."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    seen, out = set(), []
    for t, r, x in rows:
        fault = ""
        if not x.strip(SPACE):
            fault = "blank"
        elif (r, x) in seen:
            fault = "duplicate"
        elif x.rstrip(SPACE)[-1] not in ".!?":
            fault = "truncated"
        seen.add((r, x))
        out.append((t, r, x, fault))
    return out


def brute(rows):
    """The report of one conversation, from every sequence of edits with up to three inserts."""
    turns = marked(rows)
    best = None
    options = ["D" if f in ("blank", "duplicate") else "DKR" for *_, f in turns]
    for edits in itertools.product(*options):
        for k in range(4):
            for gaps in itertools.combinations_with_replacement(range(len(turns) + 1), k):
                audit = "".join("I" * gaps.count(i) + (edits[i] if i < len(turns) else "") for i in range(len(turns) + 1))
                free = sum(e in "RI" for e in audit)
                for roles in itertools.product("ua", repeat=free):
                    roles, lines, initials, i, cost = list(roles), [], "", 0, 0
                    for e in audit:
                        cost += {"K": 0, "R": 2, "I": 2, "D": 3}[e]
                        if e in "RI":
                            role = {"u": "user", "a": "assistant"}[roles.pop(0)]
                        elif e == "K":
                            role = turns[i][1]
                        if e != "D":
                            initials += role[:1] or "-"
                            lines.append(f"{role}:{turns[i][2] if e != 'I' else ''}")
                        if e in "KR":
                            cost += turns[i][3] == "truncated"
                        i += e != "I"
                    if LEGAL.match(initials) and (best is None or (cost, audit) < best[:2]):
                        best = (cost, audit, "\n".join(lines))
    known = [t for t, *_ in turns if t is not None]
    first = [r[:1] for _, r, *_ in turns]
    pairs = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))
    count = [sum(f == name for *_, f in turns) for name in ("blank", "duplicate", "truncated")]
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (gaps, *count, pairs, best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest())


def result(found):
    return {r["_c"]: tuple(r)[1:] for r in C.summaries(found).collect()}


def conversations(rng, n):
    texts = ["Yes.", "No!", "What?", "cut", "", " \n", "More words. ", "Yes.", None]
    roles = ["user", "user", "assistant", "assistant", "system", "tool", "", None, "sage", "usher"]
    return {c: [(rng.choice([None, 0, 1, 1, 2, 3, 9]), rng.choice(roles), rng.choice(texts)) for _ in range(rng.randint(1, 4))]
            for c in range(n)}


def test_every_short_conversation_against_all_edit_scripts(spark):
    convs = conversations(random.Random(2), 120)
    rows = frame(spark, [(c, *r) for c, rs in convs.items() for r in rs])
    want = {c: brute(rs) for c, rs in convs.items()}
    for size in (1, 2, 256):  # however the turns are cut into blocks
        assert result(C.repair(rows.repartition(5), block_rows=size)) == want


def test_agenda_finds_the_least_of_all_paths():
    """Against Bellman's equations, which look at every deduction again and again."""
    rng = random.Random(4)
    for _ in range(150):
        turns = "".join(rng.choice("suaxdSUAXD".replace("D", "d")) for _ in range(rng.randint(0, 9)))
        for begin in C.MOVES:
            best, changed = {(0, begin): (0, "")}, True
            while changed:
                changed = False
                for (i, q), (cost, audit) in list(best.items()):
                    after = [((i, C.MOVES[q][C.NEXT[q]]), (cost + 2, audit + "I"))]
                    if i < len(turns):
                        x, late = turns[i].lower(), turns[i].isupper()
                        after.append(((i + 1, q), (cost + 3, audit + "D")))
                        if x != "d":
                            after.append(((i + 1, C.MOVES[q][C.NEXT[q]]), (cost + 2 + late, audit + "R")))
                            if x in C.MOVES[q]:
                                after.append(((i + 1, C.MOVES[q][x]), (cost + late, audit + "K")))
                    for item, weight in after:
                        if item not in best or weight < best[item]:
                            best[item], changed = weight, True
            assert {q: (c, a) for q, c, a in C.derivations(turns, begin)} == {
                q: w for (i, q), w in best.items() if i == len(turns)}


def test_lightest_takes_hyperedges_of_several_tails():
    """A small grammar: weights of a rule add up; the goal needs two parts."""
    rules = [("x", ("a", "b"), 1), ("x", ("a",), 9), ("y", ("x", "b"), 2), ("goal", ("x", "y"), 0)]
    uses = lambda item: [(h, t, lambda *w, c=c: (sum(x[0] for x in w) + c, "")) for h, t, c in rules if item in t]
    final = C.lightest({"a": (1, ""), "b": (3, "")}, uses, ["goal"])
    assert final["x"] == (5, "") and final["y"] == (10, "") and final["goal"] == (15, "")
    assert C.lightest({"a": (1, "")}, uses, ["y"]).get("x") == (10, "") and "y" not in C.lightest({"a": (1, "")}, uses, ["y"])


def test_repaired_turns_are_what_the_digest_is_of(spark):
    convs = conversations(random.Random(7), 60)
    found = C.repair(frame(spark, [(c, *r) for c, rs in convs.items() for r in rs]), block_rows=2).cache()
    want = {r["_c"]: r for r in C.summaries(found).collect()}
    left = {}
    for r in C.repaired(found).collect():
        left.setdefault(r["_c"], []).append((r["position"], r["role"], r["text"], r["edit"], r["turn"]))
    for c, r in want.items():
        rows = sorted(left.get(c, []))
        assert [x[0] for x in rows] == list(range(len(rows)))
        assert hashlib.sha256("\n".join(f"{x[1]}:{x[2]}" for x in rows).encode()).hexdigest() == r["repaired_sha256"]
        assert "".join(x[3] for x in rows) == r["audit"].replace("D", "")
        assert all(x[4] is None for x in rows if x[3] == "I")


def test_a_hot_conversation_is_spread_over_tasks(spark):
    """One conversation of 9,000 turns and one turn repeated 2,500 times."""
    rng = random.Random(1)
    hot = [(1, t, ("user", "assistant")[t % 2] if rng.random() < 0.95 else "user", f"Text {t}." if rng.random() < 0.95 else "")
           for t in range(9000)]
    rows = hot + [(2, 5, "user", "Same.")] * 2500 + [(2, 6, "assistant", "Ok.")] + [(3, 1, "user", "A."), (3, 2, "assistant", "B.")]
    found = C.repair(frame(spark, rows)).cache()
    per_task = [r["n"] for r in found.filter("_c = 1").groupBy("part").agg(F.sum(F.length("turns")).alias("n")).collect()]
    assert len(per_task) >= 3 and max(per_task) < 6000 and sum(per_task) == 9000
    got = result(found)
    assert got[3] == (0, 0, 0, 0, 0, 0, "KK", hashlib.sha256(b"user:A.\nassistant:B.").hexdigest())
    assert got[2][:6] == (0, 0, 2499, 0, 2499, 3 * 2499) and got[2][6] == "K" + "D" * 2499 + "K"
    # The same conversation as a single block: one agenda over all of it.
    codes = "".join("d" if not x else "u" if r == "user" else "a" for _, _, r, x in hot[:600])
    whole = min(w for q, *w in C.derivations(codes, C.START) if q in C.ACCEPT)
    part = result(C.repair(frame(spark, hot[:600]), block_rows=7))[1]
    assert [part[5], part[6]] == whole


def test_edges(spark):
    empty = frame(spark, [(1, 1, "user", "A.")]).limit(0)
    assert C.summaries(C.repair(empty)).collect() == [] and C.repaired(C.repair(empty)).collect() == []
    long = "word " * 300_000 + "end."
    rows = [(None, None, None, None), (None, 3, "user", long), (None, 3, "user", long), (4, None, "system", "S."), (4, None, "user", "U."),
            (5, 2, "", "No role."), (6, 7, "assistant", "x\x85"), (7, 1, "user", "\xa0")]
    got = result(C.repair(frame(spark, rows)))
    for c in {r[0] for r in rows}:
        assert got[c] == brute([r[1:] for r in rows if r[0] == c]), c
    # Conversations whose turns are all gone are still reported.
    spoilt, every = C.damaged(frame(spark, [(c, 0, "user", "Hi.") for c in range(300)]))
    out = result(C.blocks(C.faults(spoilt, every)))
    assert set(out) == set(range(300))
    gone = set(range(300)) - {r["_c"] for r in spoilt.collect()}
    assert gone and all(out[c] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in gone)
