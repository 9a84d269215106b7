"""op10: every pair of a word and an entity over both thresholds is kept."""

import math
import random
import re

from marketlake.llm import queries
from test_spans import personal


def brute(texts, min_share=0.5, min_chance=0.5, sure=0.9):
    texts = [t or "" for t in texts]
    spans = [[(a, e, (k, t[a:e])) for a, k, e in personal(t)] for t in texts]
    words = [[(m.start(), m.end(), m[0].lower()) for m in re.finditer(r"[^\W\d_]{3,}", t)] for t in texts]
    outside = [[w for w in ws if all(w[1] <= a or w[0] >= e for a, e, _ in ss)] for ws, ss in zip(words, spans)]
    n, entity, term = len(texts), {}, {}
    for d, ss in enumerate(spans):
        for *_, x in ss:
            entity.setdefault(x, set()).add(d)
    for d, ws in enumerate(words):
        for *_, w in ws:
            term.setdefault(w, set()).add(d)
    out = set()
    for d, ws in enumerate(outside):
        for a, e, w in ws:
            best = 0
            for x in {x for *_, x in spans[d]}:
                chance = sum(1 for k in entity[x] if any(v == w for *_, v in outside[k])) / len(term[w])
                own = math.log2(n / len(entity[x]))
                if own > 0 and own * (1 - min_share) + math.log2(chance) >= -1e-12 and chance >= min_chance:
                    best = max(best, chance)
            if best:
                out.add((d, a, e, "remove" if best >= sure else "generalise"))
    return out


def hidden(spark, texts, tmp_path):
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return {(r.doc_id, int(a), int(e), k) for r in queries.op10_pii(spark, str(tmp_path)).collect()
            for k, a, e in (x.split(":") for x in r.spans.split(",") if x) if k in ("generalise", "remove")}


def test_pairs_over_the_thresholds(spark, tmp_path):
    rng = random.Random(8)
    people = [f"p{k}@x{k % 3}.org" for k in range(8)] + ["+49 30 1234567", "4111 1111 1111 1111"]
    plain = "please write about the order whatever weather number may say soon".split()
    texts = [None, "", "please write zebulon", "zebulon at z.q@example.org, please",  # a word of two documents, an entity of one
             "Ünal.Özgür.smith@x.org about Kübra", "Jürgé@example.org or p1@x1.org", "p1@x1.orgétude plain@p.org", "é1@b.org 10.1.2.3 étage"]
    for k in range(60):
        parts = rng.sample(plain, 5) + [f"name{chr(97 + rng.randrange(12))}"] + rng.sample(people, rng.choice([0, 0, 1, 2]))
        rng.shuffle(parts)
        texts.append(" ".join(parts) + f" only{chr(97 + k % 26)}{chr(97 + k // 26)}")
    got, want = hidden(spark, texts, tmp_path), brute(texts)
    assert got == want and len(want) > 40
    words = {texts[d][a:e] for d, a, e, _ in got}
    assert {"zebulon", "Ünal", "Jürgé", "example", "Kübra"} <= words


def test_a_threshold_met_exactly(spark, tmp_path):
    """Chance 2/3 and log2(9/4) bits: exactly half of the entity's information."""
    at = "ask lantern at p1@x1.org"
    texts = [at] * 2 + ["ask about p1@x1.org"] * 2 + ["ask lantern"] + ["ask"] * 4
    got = hidden(spark, texts, tmp_path)
    assert got == brute(texts) and (0, 4, 11, "generalise") in got
