"""Hard negatives: bounds, brute force, blocks and slots, skew, edges."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlake.llm import hard_negatives as H

SCHEMA = "id long, label string, v array<double>, score string, block long"


def frame(spark, rows):
    return spark.createDataFrame([(*r, "s", 1) for r in rows], SCHEMA)


def take(df, every=3):
    return H.usable(df, F.col("label"), F.col("v"), F.col("id"), F.col("id") % every == 0)


def brute(rows, every=3, k=5, low=80, high=100):
    """Every pair of every anchor, in Python's integers."""
    ok = [(i, c, [int(x) for x in v]) for i, c, v in rows if c is not None and v is not None
          and all(x is not None and np.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    last = lambda i: (i is None, i or 0)
    out = []
    for i, c, v in ok:
        if i is None or i % every:
            continue
        rated = sorted(((-dot(v, w), last(j), j, d) for j, d, w in ok if j is None or j != i), key=lambda t: t[:2])
        for s, _, j, _ in [r for r in rated if r[3] == c][:k]:
            hits = [r for r in rated if r[3] != c and low * -s <= 100 * -r[0] <= high * -s][:k]
            out += [(i, j, n + 1, r[2], -s, -r[0]) for n, r in enumerate(hits)]
    return sorted(out, key=str)


def got(df, **how):
    return sorted([tuple(r) for r in H.mine(df, **how).collect()], key=str)


def vectors(rng, n, dim=16, labels=4, near=0.6):
    centres = [[rng.gauss(0, 60) for _ in range(dim)] for _ in range(labels)]
    shared = [rng.gauss(0, 60) for _ in range(dim)]
    return [(i, f"l{c}", [float(round(near * s + (1 - near) * x + rng.gauss(0, 8))) for s, x in zip(shared, centres[c])])
            for i in range(n) for c in [rng.randrange(labels)]]


def test_bounds_hold_at_every_level_and_narrow():
    rng = np.random.default_rng(0)
    for dim in (1, 3, 8, 13, 64):
        a, b = rng.normal(3, 50, (20, dim)).round(), rng.normal(-1, 50, (30, dim)).round()
        exact, widths = a @ b.T, []
        for (ma, da), (mb, db) in zip(H.summaries(a), H.summaries(b)):
            mid, reach = ma @ mb.T, da @ db.T + 1e-6
            assert (mid - reach <= exact).all() and (exact <= mid + reach).all()
            widths.append(reach.mean())
        assert all(x >= y - 1e-9 for x, y in zip(widths, widths[1:]))
        assert H.edges(dim, 8)[-1] == dim and set(H.edges(dim, 4)) <= set(H.edges(dim, 8))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed):
    rows = vectors(random.Random(seed), 260)
    want = brute(rows)
    assert len(want) > 500
    assert got(take(frame(spark, rows).repartition(7))) == want


def test_small_blocks_and_many_slots_give_the_same(spark, monkeypatch):
    rows = vectors(random.Random(3), 300, dim=9)
    df = take(frame(spark, rows), 5)
    want = brute(rows, 5, 3, 70, 95)
    for block, anchors, slots in ((7, 3, (5, 4)), (64, 2, (1, 9)), (2048, 256, (3, 1))):
        monkeypatch.setattr(H, "BLOCK_ROWS", block)
        monkeypatch.setattr(H, "BLOCK_ANCHORS", anchors)
        monkeypatch.setattr(H, "grid", lambda *_, s=slots: s)
        assert got(df, positives=3, negatives=3, low=70, high=95) == want


def test_ties_repeats_and_a_hot_vector(spark):
    """A third of all rows are one vector; ids repeat; many scores are equal."""
    rng = random.Random(4)
    rows = [(i, "a" if i % 2 else "b", [2.0, 1.0, 0.0, 1.0]) for i in range(120)]
    rows += [(i, rng.choice("abc"), [float(rng.randint(-2, 2)) for _ in range(4)]) for i in range(120, 300)]
    rows += rows[125:135]
    assert got(take(frame(spark, rows), 15)) == brute(rows, 15)


def test_edges(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, "a", [1.0, 2.0]), (3, "a", [2.0, 2.0]), (1, "a", [1.0, 1.0, 5.0]), (2, "b", [1.0, 2.0]), (4, "b", [2.0, 1.0]),
            (None, "a", [3.0, 1.0]), (None, "b", [1.0, 2.0]), (5, None, [1.0, 2.0]), (6, "a", None), (7, "b", [1.0, None]),
            (8, "b", [nan, 1.0]), (9, "a", [inf, 1.0]), (12, "b", []), (13, "a", []), (15, "c", [0.0, 0.0]), (18, "a", [-1.0, -2.0])]
    assert got(take(frame(spark, rows))) == brute(rows)
    assert got(take(frame(spark, rows).limit(0))) == []
    assert got(take(frame(spark, rows).filter("id % 3 <> 0"))) == []
    assert got(take(frame(spark, [(0, "a", []), (1, "a", []), (2, "b", [])]))) == brute([(0, "a", []), (1, "a", []), (2, "b", [])])
    # One label only: no negatives. Whole numbers too great for a float's digits are multiplied exactly.
    assert got(take(frame(spark, [(i, "a", [1.0]) for i in range(5)]))) == []
    big = [(0, "a", [2.0 ** 30 + 1, 1.0]), (1, "a", [2.0 ** 31, 3.0]), (2, "b", [2.0 ** 31 - 1, 1.0]), (4, "b", [2.0 ** 31, 3.0]),
           (5, "b", [2.0 ** 31, 4.0])]
    assert got(take(frame(spark, big))) == brute(big) != []


def test_rows_are_pruned_before_exact_scores():
    """Near and far clusters: the bounds leave few rows to be scored."""
    rng = np.random.default_rng(5)
    x = np.vstack([rng.normal(m, 2, (200, 32)).round() for m in (-40, -20, 0, 20, 40)])

    def block(m):
        levels = H.summaries(m)
        row = {"ids": list(range(len(m))), "vectors": m.ravel(), "means": np.hstack([lv[0] for lv in levels]).ravel(),
               "devs": np.hstack([lv[1] for lv in levels]).ravel()}
        return H._Block({f"a_{k}": v for k, v in row.items()}, "a_")

    a, b = block(x[-10:]), block(x)
    far = np.full(a.n, np.inf)
    columns, alive = H.survivors(a, b, -far, far, far, 5, np.ones((a.n, b.n), bool))
    assert len(columns) < 250
    exact = a.x @ b.x.T
    for i in range(a.n):
        assert set(np.argsort(-exact[i], kind="stable")[:5]) <= set(columns[alive[i]])


def test_grid_bounds_the_work_of_a_task():
    for rows, anchors, parallel in ((0, 0, 8), (10, 1, 8), (50_000, 500, 16), (10 ** 9, 10 ** 7, 8000)):
        r, a = H.grid(rows, anchors, parallel)
        assert r >= 1 and a >= 1
        if rows > 10 ** 6:
            assert rows * anchors / (r * a) <= 1.01 * H.TASK_PAIRS
            assert 0.2 < (rows * a) / (anchors * r) < 5  # both sides are copied about as much
