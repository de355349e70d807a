"""DuckDB SQL for the rows of op9, op11, op12 and op13, written apart from the operators."""

from __future__ import annotations

from changemill.llm.common import LOWER, UPPER, WORD

M64 = "18446744073709551616::UHUGEINT"
# fixed values: the primes of XXH64
P1, P2, P3, P4, P5 = (f"{p}::UHUGEINT" for p in (
    "11400714785074694791", "14029467366897019727", "1609587929392839161", "9650029242287828579", "2870177450012600261"))


def _mul(a: str, b: str) -> str:
    return f"(({a}) * {b}) % {M64}"


def _add(*terms: str) -> str:
    return f"({' + '.join(f'({t})' for t in terms)}) % {M64}"


def _left(a: str, k: int) -> str:
    # a rotation is a product modulo 2^64 - 1
    return f"(({a}) * {1 << k}::UHUGEINT) % 18446744073709551615::UHUGEINT"


def _lane(v: str) -> str:
    return _mul(_left(_mul(v, P2), 31), P1)


def _number(at: str, size: int) -> str:
    """Little-endian number of ``size`` bytes from byte ``at`` of the hexadecimal text x."""
    return "('0x' || " + " || ".join(f"substr(x, 2 * ({at}) + {2 * k + 1}, 2)" for k in reversed(range(size))) + ")::UBIGINT::UHUGEINT"


def _simhash() -> str:
    stripes = [f"list_reduce([lanes[4 * k + {j + 1}] FOR k IN range(n // 32)], lambda v, l: {_mul(_left(_add('v', _mul('l', P2)), 31), P1)}, ({start}) % {M64})"
               for j, start in enumerate((f"42 + {P1} + {P2}", f"42 + {P2}", "42::UHUGEINT", f"42 + {M64} - {P1}"))]
    joined = _add(*[_left(f"acc[{j + 1}]", k) for j, k in enumerate((1, 7, 12, 18))])
    mixed = f"list_reduce(acc, lambda h, v: {_add(_mul(f'xor(h, {_lane("v")})', P1), P4)}, {joined})"
    eight = f"list_reduce(lanes[4 * (n // 32) + 1:], lambda h, l: {_add(_mul(_left(f'xor(h, {_lane("l")})', 27), P1), P4)}, h0)"
    four = f"CASE WHEN n % 8 >= 4 THEN {_add(_mul(_left(f'xor(h1, {_mul(_number("n // 8 * 8", 4), P1)})', 23), P2), P3)} ELSE h1 END"
    ones = f"list_reduce([{_number('n - n % 4 + k', 1)} FOR k IN range(n % 4)], lambda h, b: {_mul(_left(f'xor(h, {_mul("b", P5)})', 11), P1)}, h2)"
    bits = " + ".join(f"CASE WHEN 2 * sum((h >> {k}) & 1) > count(*) THEN {1 << k}::UHUGEINT ELSE 0 END" for k in range(64))
    return f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORD}') AS w FROM documents),
g AS (SELECT r, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
        ELSE [array_to_string(w[i:i + 2], ' ') FOR i IN range(1, len(w) - 1)] END) AS g FROM d),
x AS (SELECT g, hex(encode(g)) AS x, octet_length(encode(g)) AS n FROM (SELECT DISTINCT g FROM g)),
l AS (SELECT *, [{_number('8 * k', 8)} FOR k IN range(n // 8)] AS lanes FROM x),
a AS (SELECT *, CASE WHEN n >= 32 THEN [{', '.join(stripes)}] END AS acc FROM l),
h0 AS (SELECT g, x, n, lanes, {_add(f"CASE WHEN n < 32 THEN 42 + {P5} ELSE {mixed} END", "n::UHUGEINT")} AS h0 FROM a),
h1 AS (SELECT *, {eight} AS h1 FROM h0),
h2 AS (SELECT *, {four} AS h2 FROM h1),
h3 AS (SELECT g, {ones} AS h3 FROM h2),
h4 AS (SELECT g, {_mul('xor(h3, h3 // 8589934592::UHUGEINT)', P2)} AS h4 FROM h3),
h5 AS (SELECT g, {_mul('xor(h4, h4 // 536870912::UHUGEINT)', P3)} AS h5 FROM h4),
h6 AS (SELECT g, xor(h5, h5 // 4294967296::UHUGEINT)::UBIGINT AS h FROM h5),
b AS (SELECT r, {bits} AS f FROM g JOIN h6 USING (g) GROUP BY r),
f AS (SELECT d.doc_id, coalesce(f, 0)::UBIGINT AS f FROM d LEFT JOIN b USING (r)),
p AS (SELECT DISTINCT f FROM f),
e AS (SELECT x.f AS a, y.f AS b FROM p x JOIN p y ON x.f <> y.f AND bit_count(xor(x.f, y.f)) <= 2),
c(f, o) AS (SELECT f, f FROM p UNION SELECT c.f, e.b FROM c JOIN e ON c.o = e.a),
m AS (SELECT c.f, min(f.doc_id) AS component_id FROM c JOIN f ON c.o = f.f GROUP BY c.f),
k AS (SELECT a AS f, count(*) AS n FROM e GROUP BY a)
SELECT f.doc_id, format('{{:016x}}', f.f) AS fingerprint, m.component_id, coalesce(k.n, 0) AS n_links
FROM f JOIN m USING (f) LEFT JOIN k USING (f)"""


SIMHASH_SQL = _simhash()


def crc32(text: str) -> str:
    """crc32 of an expression of ASCII characters."""
    bits = f"flatten([[ascii(c), -1, -1, -1, -1, -1, -1, -1, -1] FOR c IN string_split({text}, '')])"
    step = "CASE WHEN x >= 0 THEN xor(c, x) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return f"xor(list_reduce([x::BIGINT FOR x IN {bits}], lambda c, x: {step}, 4294967295::BIGINT), 4294967295)"


def _field(e: str) -> str:
    return f"CASE WHEN {e} IS NULL THEN '-' ELSE octet_length(encode({e}::VARCHAR)) || ':' || {e} END"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(e) for e in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS r, doc_id, lang, {_leaf('text')} AS leaf,
  CASE WHEN {crc32("doc_id::VARCHAR")} % 3 = 0 THEN {_leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS other FROM documents),
o AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY lang) AS n FROM d),
low(tree, level, idx, n, h) AS (SELECT tree, 0, idx, n, leaf FROM o
  UNION ALL SELECT tree, level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM low WHERE n > 1 GROUP BY tree, level, idx // 8, n),
sub AS (SELECT tree, h FROM low WHERE n = 1),
top(level, idx, n, h) AS (SELECT 0, tree - 1, (SELECT count(*) FROM sub), h FROM sub
  UNION ALL SELECT level + 1, idx // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY level, idx // 8, n),
every AS (SELECT tree, level, idx, n, h FROM low WHERE n > 1 UNION ALL SELECT 0, level, idx, n, h FROM top WHERE n > 1),
runs AS (SELECT tree, level, idx // 8 AS run, list(h ORDER BY idx) AS hs FROM every GROUP BY ALL),
steps AS (SELECT sub.tree, coalesce(max(level) + 1, 0) AS steps FROM sub LEFT JOIN every USING (tree) GROUP BY sub.tree),
-- the runs on the way up: those of the leaf's tree, then those of the tree of subroots
way AS (SELECT o.r, s.level AS k, s.hs, (o.idx >> (3 * s.level)) % 8 + 1 AS at FROM o JOIN runs s ON s.tree = o.tree AND s.run = o.idx >> (3 * s.level + 3)
  UNION ALL SELECT o.r, t.steps + s.level, s.hs, ((o.tree - 1) >> (3 * s.level)) % 8 + 1 FROM o JOIN steps t USING (tree) JOIN runs s ON s.tree = 0 AND s.run = (o.tree - 1) >> (3 * s.level + 3)),
walk(r, k, proof, folded) AS (
  SELECT r, 0, '', coalesce(other, leaf) FROM o
  UNION ALL
  SELECT w.r, w.k + 1, w.proof || array_to_string([s.hs[k] FOR k IN range(1, len(s.hs) + 1) IF k <> s.at], ''),
         sha256(array_to_string([CASE WHEN k = s.at THEN w.folded ELSE s.hs[k] END FOR k IN range(1, len(s.hs) + 1)], ''))
  FROM walk w JOIN way s ON s.r = w.r AND s.k = w.k),
ends AS (SELECT r, arg_max(proof, k) AS proof, arg_max(folded, k) AS folded FROM walk GROUP BY r)
SELECT o.doc_id, o.leaf, sub.h AS subroot, root.h AS root, sha256(e.proof) AS proof_sha256, e.folded AS folded_root, e.folded = root.h AS verified
FROM o JOIN sub USING (tree) JOIN ends e USING (r) JOIN (SELECT h FROM top WHERE n = 1) root ON true"""

_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

REPAIR_SQL = f"""
WITH RECURSIVE raw AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  {crc32("(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))")} % 20 AS kind FROM conversations),
hurt AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
  CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text FROM raw, range(2) AS t(copy)
  WHERE kind <> 0 AND (copy = 0 OR kind = 3)),
ids AS (SELECT row_number() OVER () AS c, conv_id FROM (SELECT DISTINCT conv_id FROM conversations)),
put AS (SELECT ids.c, turn, role, text, row_number() OVER (PARTITION BY ids.c ORDER BY turn NULLS FIRST, role, sha256(text)) AS i
  FROM hurt JOIN ids ON hurt.conv_id IS NOT DISTINCT FROM ids.conv_id),
marked AS (SELECT *, left(role, 1) AS initial, CASE WHEN trim(text, {_WHITE}) = '' THEN 'b' WHEN row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 THEN 'd'
  WHEN right(trim(text, {_WHITE}), 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault FROM put),
pairs AS (SELECT c, lag(initial) OVER (PARTITION BY c ORDER BY i) || initial AS p FROM marked),
-- put out: (state before, role) to state after; states: - nothing, s, u, a
moves(q, r, q2) AS (VALUES ('-', 's', 's'), ('-', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
edits AS (SELECT 'D' AS e, q, NULL AS r, q AS q2, 2 AS price FROM (VALUES ('-'), ('s'), ('u'), ('a')) t(q)
  UNION ALL SELECT 'K', q, r, q2, 0 FROM moves UNION ALL SELECT 'R', q, r, q2, 1 FROM moves WHERE r <> 's'),
inserts AS (SELECT '' AS e, q, q AS q2, 0 AS price FROM (VALUES ('-'), ('s'), ('u'), ('a')) t(q)
  UNION ALL SELECT 'I', q, q2, 5 FROM moves WHERE r <> 's'
  UNION ALL SELECT 'II', x.q, y.q2, 10 FROM moves x JOIN moves y ON x.q2 = y.q WHERE x.r <> 's' AND y.r <> 's'),
best(c, i, q, cost, audit) AS (SELECT ids.c, 0::BIGINT, n.q2, n.price, n.e FROM ids, inserts n WHERE n.q = '-'
  UNION ALL
  SELECT c, i, q, (min({{'cost': cost, 'audit': audit}})).cost, (min({{'cost': cost, 'audit': audit}})).audit FROM (
    SELECT b.c, m.i, n.q2 AS q, b.cost + e.price + n.price + CASE WHEN e.e <> 'D' AND m.fault = 't' THEN 5 ELSE 0 END AS cost, b.audit || e.e || n.e AS audit
    FROM best b JOIN marked m ON m.c = b.c AND m.i = b.i + 1
    JOIN edits e ON e.q = b.q AND (e.e <> 'K' OR e.r = m.initial) AND (e.e = 'D' OR m.fault NOT IN ('b', 'd'))
    JOIN inserts n ON n.q = e.q2) GROUP BY c, i, q),
sizes AS (SELECT ids.c, count(i) AS n FROM ids LEFT JOIN marked USING (c) GROUP BY ids.c),
done AS (SELECT b.c, min({{'cost': cost, 'audit': audit}}) AS v FROM best b JOIN sizes s ON s.c = b.c AND s.n = b.i WHERE b.q IN ('-', 'a') GROUP BY b.c),
letters AS (SELECT c, unnest(string_split(v.audit, '')) AS e, generate_subscripts(string_split(v.audit, ''), 1) AS k FROM done WHERE v.audit <> ''),
rowed AS (SELECT *, sum(CASE WHEN e <> 'I' THEN 1 ELSE 0 END) OVER (PARTITION BY c ORDER BY k) AS i FROM letters),
shown AS (SELECT l.c, l.k, l.e, m.role, m.text, m.initial, row_number() OVER (PARTITION BY l.c ORDER BY l.k) AS o FROM rowed l
  LEFT JOIN marked m ON l.e <> 'I' AND m.c = l.c AND m.i = l.i WHERE l.e <> 'D'),
head AS (SELECT c, max(CASE WHEN o = 1 AND e = 'K' AND initial = 's' THEN 1 ELSE 0 END) AS s FROM shown GROUP BY c),
whole AS (SELECT c, string_agg(CASE WHEN e = 'K' THEN role WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN e = 'I' THEN '' ELSE text END, chr(10) ORDER BY o) AS t
  FROM shown JOIN head USING (c) GROUP BY c),
counts AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated FROM marked GROUP BY c),
bad AS (SELECT c, count(*) AS illegal FROM pairs WHERE p NOT IN ('su', 'ua', 'au') GROUP BY c)
SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  done.v.cost::BIGINT AS cost, done.v.audit AS audit, sha256(coalesce(whole.t, '')) AS repaired_sha256
FROM ids JOIN done USING (c) LEFT JOIN counts USING (c) LEFT JOIN bad USING (c) LEFT JOIN whole USING (c)"""


def repetition_sql(limits: tuple, line_limit: float) -> str:
    """op9: shares of characters in repeated n-grams (``limits``: n and the largest share kept)."""
    grams = " UNION ALL ".join(
        f"SELECT r, {n} AS n, i, array_to_string(w[i:i + {n - 1}], ' ') AS k FROM (SELECT r, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM d WHERE len(w) >= {n}) x" for n, _ in limits)
    share = lambda n: f"CASE WHEN word_chars > 0 THEN coalesce(c{n}, 0)::DOUBLE / word_chars ELSE 0.0 END"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS ({grams}),
twice AS (SELECT r, n, i FROM (SELECT r, n, i, count(*) OVER (PARTITION BY r, n, k) AS c FROM g) x WHERE c > 1),
inside AS (SELECT DISTINCT r, n, unnest(range(i, i + n)) AS j FROM twice),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
c AS (SELECT r, n, sum(length(word)) AS chars, count(*) AS words FROM inside JOIN words USING (r, j) GROUP BY r, n),
lines AS (SELECT r, line, row_number() OVER (PARTITION BY r, line) > 1 AS again FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM d) x WHERE regexp_matches(line, '{WORD}')),
l AS (SELECT r, count(*) FILTER (again) AS n_dup_lines, coalesce(sum(strlen(line)) FILTER (again), 0)::DOUBLE / sum(strlen(line)) AS line_share FROM lines GROUP BY r),
base AS (SELECT d.r, d.doc_id, len(w)::BIGINT AS n_words, coalesce(wc.chars, 0)::BIGINT AS word_chars,
  len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(l.line_share, 0.0) AS line_share
  FROM d LEFT JOIN l USING (r) LEFT JOIN (SELECT r, sum(length(word)) AS chars FROM words GROUP BY r) wc USING (r)),
p AS (SELECT r, max(words) FILTER (n = 5) AS w5, {', '.join(f'max(chars) FILTER (n = {n}) AS c{n}' for n, _ in limits)} FROM c GROUP BY r),
s AS (SELECT base.*, coalesce(w5, 0)::BIGINT AS n_repeat_words, {', '.join(f'{share(n)} AS share_{n}' for n, _ in limits)} FROM base LEFT JOIN p USING (r)),
f AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, line_share, {', '.join(f'share_{n}' for n, _ in limits)},
  NOT base_failed AND line_share <= {line_limit} AND {' AND '.join(f'share_{n} <= {most}' for n, most in limits)} AS kept FROM f"""
