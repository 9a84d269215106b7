"""DuckDB SQL for the queries that SQL can express."""

_WORD = r"[^\x20\x09-\x0D]+"

OP5 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT rid, regexp_extract_all(t, '{_WORD}') AS ws FROM d),
pos AS (SELECT rid, unnest(ws) AS a, generate_subscripts(ws, 1) AS p FROM w),
win AS (SELECT rid, p, a, lead(a, 1) OVER q AS b, lead(a, 2) OVER q AS c FROM pos WINDOW q AS (PARTITION BY rid ORDER BY p)),
cnt AS (SELECT rid, p, count(*) OVER (PARTITION BY rid, a, b, c) AS k FROM win WHERE c IS NOT NULL),
hit AS (SELECT DISTINCT rid, p + o AS p FROM cnt, (VALUES (0), (1), (2)) AS x(o) WHERE k >= 2),
rep AS (SELECT rid, count(*) AS n FROM hit GROUP BY rid),
ln AS (SELECT rid, unnest(string_split(t, chr(10))) AS l FROM d),
lc AS (SELECT rid, l, count(*) AS k FROM ln WHERE regexp_matches(l, '{_WORD}') GROUP BY rid, l),
la AS (SELECT rid, sum(k) AS n_lines, sum(k - 1) AS dup FROM lc GROUP BY rid),
m AS (SELECT d.rid, doc_id, CAST(len(ws) AS BIGINT) AS n_words,
  CAST(length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g')) AS BIGINT) AS word_chars,
  CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
  CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
  CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines,
  length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS capitals,
  length(regexp_replace(t, '[^!]', '', 'g')) AS shouts
  FROM d JOIN w USING (rid) LEFT JOIN rep USING (rid) LEFT JOIN la USING (rid)),
b AS (SELECT *, CAST(
  (CASE WHEN n_words < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END)
  + (CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END) + (CASE WHEN 100 * n_dup_lines > 50 * n_lines THEN 8 ELSE 0 END)
  + (CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END) + (CASE WHEN word_chars > 15 * n_words THEN 32 ELSE 0 END)
  + (CASE WHEN 100 * capitals > 40 * letters THEN 64 ELSE 0 END) + (CASE WHEN 4 * shouts > n_words THEN 128 ELSE 0 END)
  AS BIGINT) AS failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed & 3) <> 0 AS base_failed,
  failed = 0 AS kept, failed FROM b
"""

OP4 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
s AS (SELECT rid, doc_id, string_split(t, chr(10)) AS ls FROM d),
raw AS (SELECT rid, doc_id, unnest(ls) AS l, generate_subscripts(ls, 1) AS i FROM s),
ln AS (SELECT *, row_number() OVER (PARTITION BY rid ORDER BY i) AS p FROM raw WHERE regexp_matches(l, '{_WORD}')),
w AS (SELECT *, lead(l) OVER (PARTITION BY rid ORDER BY p) AS l2 FROM ln),
f AS (SELECT *, row_number() OVER (PARTITION BY l ORDER BY doc_id, p) AS k1,
  row_number() OVER (PARTITION BY l, l2 ORDER BY doc_id, p) AS k2 FROM w),
g AS (SELECT rid, i, p, (k1 > 1 AND len(regexp_extract_all(l, '{_WORD}')) >= 10) OR (l2 IS NOT NULL AND k2 > 1) AS here,
  l2 IS NOT NULL AND k2 > 1 AS two FROM f),
x AS (SELECT rid, i, here OR coalesce(lag(two) OVER (PARTITION BY rid ORDER BY p), false) AS dead FROM g),
a AS (SELECT raw.rid, raw.doc_id, count(x.i) AS n_lines, coalesce(sum(CAST(x.dead AS INT)), 0) AS n_removed,
  coalesce(string_agg(CASE WHEN coalesce(x.dead, false) THEN NULL ELSE l END, chr(10) ORDER BY raw.i), '') AS kept
  FROM raw LEFT JOIN x USING (rid, i) GROUP BY raw.rid, raw.doc_id)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_removed AS BIGINT) AS n_removed, sha256(kept) AS kept_sha256 FROM a
"""

OP6 = r"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(lower(coalesce(text, '')), '[\p{L}\p{N}]+') AS ws FROM documents),
g AS (SELECT rid, doc_id, CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ') || chr(1)]
  ELSE list_distinct(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) END AS s FROM d),
sh AS (SELECT rid, len(s) AS n, unnest(s) AS x FROM g),
k AS (SELECT x FROM sh GROUP BY x HAVING count(*) > 1),
j AS (SELECT sh.* FROM sh JOIN k USING (x)),
p AS (SELECT a.rid AS a, b.rid AS b FROM j a JOIN j b ON a.x = b.x AND a.rid <> b.rid GROUP BY a.rid, b.rid, a.n, b.n
  HAVING 5 * count(*) >= 4 * (a.n + b.n - count(*))),
r(node, root) AS (SELECT rid, rid FROM d UNION SELECT p.b, r.root FROM r JOIN p ON p.a = r.node),
c AS (SELECT r.node, min(t.doc_id) AS class_id FROM r JOIN d t ON t.rid = r.root GROUP BY r.node),
l AS (SELECT a, count(*) AS n_links, count(DISTINCT list_sort(g.s)) AS texts FROM p JOIN g ON g.rid = p.b GROUP BY a),
o AS (SELECT p.a, count(*) AS same FROM p JOIN g x ON x.rid = p.a JOIN g y ON y.rid = p.b WHERE list_sort(x.s) = list_sort(y.s) GROUP BY p.a)
SELECT d.doc_id, c.class_id, coalesce(n_links, 0) AS n_links, coalesce(texts, 0) - CASE WHEN o.same > 0 THEN 1 ELSE 0 END AS n_linked_texts
FROM d JOIN c ON c.node = d.rid LEFT JOIN l ON l.a = d.rid LEFT JOIN o ON o.a = d.rid
"""

OP7 = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS ws FROM documents),
wd AS (SELECT rid, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
win AS (SELECT rid, doc_id, p, string_agg(w, ' ') OVER q AS x, count(*) OVER q AS n FROM wd
  WINDOW q AS (PARTITION BY rid ORDER BY p ROWS BETWEEN CURRENT ROW AND 19 FOLLOWING)),
f AS (SELECT rid, p, rank() OVER (PARTITION BY x ORDER BY doc_id, p) AS k FROM win WHERE n = 20),
c AS (SELECT DISTINCT rid, p + o AS p FROM f, (SELECT unnest(range(20)) AS o) WHERE k > 1),
a AS (SELECT wd.rid, count(c.p) AS gone, string_agg(CASE WHEN c.p IS NULL THEN w END, ' ' ORDER BY wd.p) AS kept
  FROM wd LEFT JOIN c USING (rid, p) GROUP BY wd.rid)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN a USING (rid)
"""

OP11 = r"""
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS s
  FROM e a JOIN e b ON a.vec_id % 100 = 0 AND b.vec_id <> a.vec_id),
p AS (SELECT a, b, s FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, b) <= 5),
n AS (SELECT p.a, p.b AS pos, p.s AS ps, s.b AS neg, s.s AS ns, row_number() OVER (PARTITION BY p.a, p.b ORDER BY s.s DESC, s.b) AS k
  FROM p JOIN s ON s.a = p.a AND NOT s.same AND 80 * p.s <= 100 * s.s AND 100 * s.s <= 100 * p.s)
SELECT a AS anchor_id, pos AS positive_id, CAST(k AS INTEGER) AS rank, neg AS negative_id, ps AS positive_score, ns AS negative_score
FROM n WHERE k <= 5
"""


def _op12() -> str:
    """A dynamic programme over the turns: for each state of the pattern (0 start, 1 after
    system, 2 after user, 3 after assistant) the least (cost, audit, lines)."""
    def add(s, cost, edit, line):
        lines = f"list_append({s}.x, {line})" if line else f"{s}.x"
        return f"CASE WHEN {s} IS NOT NULL THEN {{'c': {s}.c + {cost}, 'a': {s}.a || '{edit}', 'x': {lines}}} END"

    def either(when, *options):
        return [f"CASE WHEN {when} THEN {o} END" for o in options]

    kept, more = "f.r || ':' || f.x", "f.late"
    free = lambda s, to: add(s, f"2 + {more}", "R", f"'{to}:' || f.x")
    keep = lambda s: add(s, more, "K", kept)
    to = [
        [add("s0", 3, "D", "")],
        [add("s1", 3, "D", ""), *either("NOT f.gone AND f.i = 's'", keep("s0"))],
        [add("s2", 3, "D", ""), *either("NOT f.gone AND f.i = 'u'", *map(keep, ("s0", "s1", "s3"))),
         *either("NOT f.gone", *[free(s, "user") for s in ("s0", "s1", "s3")])],
        [add("s3", 3, "D", ""), *either("NOT f.gone AND f.i = 'a'", keep("s2")), *either("NOT f.gone", free("s2", "assistant"))]]
    least = lambda xs: f"least({', '.join(xs)})" if len(xs) > 1 else xs[0]
    # Inserts behind a turn: a user from every other state, then an assistant.
    user = least(["t2", *[add(s, 2, "I", "'user:'") for s in ("t0", "t1", "t3")]])
    return rf"""
WITH RECURSIVE bits AS (SELECT i, 0 AS k, i AS v FROM range(256) AS t(i) UNION ALL
  SELECT i, k + 1, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(v ORDER BY i) AS tb FROM bits WHERE k = 8),
src AS (SELECT conv_id, turn, coalesce(role, ' ') AS r, coalesce(text, ' ') AS x,
  coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key FROM conversations),
h AS (SELECT src.*, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(key, ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: xor(a >> 8, tb[(xor(a, b) & 255) + 1])), 4294967295) % 20 AS d FROM src, tab),
dam AS (SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE r END AS r,
  CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(x, '[.!?]', '', 'g') ELSE x END AS x
  FROM h, range(2) AS t(n) WHERE d <> 0 AND (d = 3 OR n = 0)),
q AS (SELECT *, left(r, 1) AS i, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, r, x) AS p FROM dam),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id, r, x ORDER BY p) AS k, NOT regexp_matches(x, '[^\x20\x09-\x0D]') AS blank FROM q),
f AS (SELECT *, blank OR k > 1 AS gone, NOT blank AND k > 1 AS dup,
  CASE WHEN NOT blank AND k = 1 AND NOT regexp_matches(x, '[.!?][\x20\x09-\x0D]*$') THEN 1 ELSE 0 END AS late,
  lag(i) OVER (PARTITION BY conv_id ORDER BY p) AS before FROM o),
c AS (SELECT DISTINCT conv_id FROM src),
dp AS (SELECT conv_id, CAST(0 AS BIGINT) AS p, {{'c': CAST(0 AS BIGINT), 'a': '', 'x': CAST([] AS VARCHAR[])}} AS s0,
    CAST(NULL AS STRUCT(c BIGINT, a VARCHAR, x VARCHAR[])) AS s1, {{'c': CAST(2 AS BIGINT), 'a': 'I', 'x': ['user:']}} AS s2,
    {{'c': CAST(4 AS BIGINT), 'a': 'II', 'x': ['user:', 'assistant:']}} AS s3 FROM c
  UNION ALL
  SELECT conv_id, p, t0 AS s0, t1 AS s1, s2, least(t3, {add("s2", 2, "I", "'assistant:'")}) AS s3 FROM (
    SELECT conv_id, p, t0, t1, t3, {user} AS s2 FROM (
      SELECT dp.conv_id, f.p, {least(to[0])} AS t0, {least(to[1])} AS t1, {least(to[2])} AS t2, {least(to[3])} AS t3
      FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.p = dp.p + 1))),
goal AS (SELECT conv_id, least(s0, s3) AS g FROM dp QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY p DESC) = 1),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
  count(*) FILTER (dup) AS duplicate, sum(late) AS truncated,
  count(*) FILTER (before IS NOT NULL AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id)
SELECT goal.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
  CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
  CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, g.c AS cost, g.a AS audit, sha256(array_to_string(g.x, chr(10))) AS repaired_sha256
FROM goal LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM goal.conv_id
"""


ORACLES = {"op7_substring_dedup": OP7, "op6_ngram_join": OP6, "op4_line_dedup": OP4, "op5_quality_rules": OP5,
           "op11_hard_negatives": OP11, "op12_conversation_repair": _op12()}
