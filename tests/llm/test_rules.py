"""Quality rules: measurements by brute force, bit masks, policies, ablations."""

import random
import re

from marketlake.llm import rules


def brute(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(inside), len(lines),
            len(re.findall("[A-Za-z]", text)), len(re.findall("[A-Z]", text)), text.count("!"))


def test_measurements():
    rng = random.Random(3)
    for _ in range(300):
        text = "".join(rng.choice(["a", "b", "A!", "é", " ", " ", "\n", "\t", "#", "\x0b", " "]) for _ in range(rng.randrange(60)))
        assert rules.measure_text(text) == brute(text), repr(text)


def test_ledger_policies_and_ablations(spark, docs):
    led = rules.ledger(docs).cache()
    rows = led.collect()
    assert len(rows) == docs.count()
    for r in rows:
        if len(r.text or "") < 5000:
            m = brute(r.text or "")
            assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == m[:5]
        assert bool(r.failed & 1) == (r.n_words < 50)
    kept = {(r.doc_id, r.text) for r in rules.keep(docs).collect()}
    assert kept == {(r.doc_id, r.text) for r in rows if not r.failed & rules.mask("v1")}
    assert rules.keep(docs).columns == docs.columns
    for a in rules.ablations(led, "v1").collect():
        bit = 1 << next(x.bit for x in rules.RULES if x.name == a["rule"])
        assert a.n_failed == sum(bool(r.failed & bit) for r in rows)
        assert a.n_failed_alone == sum(r.failed & rules.mask("v1") == bit for r in rows)
        assert a.n_kept_without == sum(not r.failed & rules.mask("v1") & ~bit for r in rows)


def test_empty(none):
    assert rules.ledger(none).count() == 0 and rules.keep(none).columns == none.columns
