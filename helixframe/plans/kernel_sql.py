"""DuckDB SQL for order-dependent kernels: each group's rows, in order, are folded by ``list_reduce``.

The accumulator of a fold has the type of the elements, so elements are lists of one row,
or structs that hold such lists.
"""

from __future__ import annotations

from helixframe.plans import relations as R

LIS = """WITH g AS (SELECT user_id, list([value] ORDER BY ts, event_id) AS v FROM events GROUP BY 1)
SELECT user_id, len(list_reduce(v, lambda acc, x: acc[:len(list_filter(acc, lambda t: t < x[1]))] || x || acc[len(list_filter(acc, lambda t: t < x[1])) + 2:], [])) AS n FROM g"""

THINNED = f"""WITH {R.MATCHES}, g AS (SELECT ref, list([{{'pos': rs, 'score': mlen}}] ORDER BY mlen DESC, rs) AS l FROM matches GROUP BY 1),
k AS (SELECT ref, unnest(list_reduce(l, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: abs(y.pos - x[1].pos) < 500)) = 0 THEN acc || x ELSE acc END, [])) AS x FROM g)
SELECT ref, x.pos AS pos, x.score AS score FROM k"""

PLACED = f"""WITH {R.MATCHES}, g AS (SELECT ref, list([{{'id': id, 'a': rs, 'b': re}}] ORDER BY re - rs DESC, rs, id) AS l FROM matches GROUP BY 1),
k AS (SELECT ref, unnest(list_reduce(l, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: y.a - 50 <= x[1].a AND x[1].b <= y.b + 50)) = 0 THEN acc || x ELSE acc END, [])) AS x FROM g)
SELECT ref AS key, x.id AS id, x.a AS a, x.b AS b FROM k"""

ADVANCING = f"""WITH {R.MATCHES}, g AS (SELECT ref, list([{{'id': id, 'rs': rs, 're': re}}] ORDER BY rs, re) AS l FROM matches GROUP BY 1),
k AS (SELECT ref, unnest(list_reduce(l, lambda acc, x: CASE WHEN len(acc) = 0 OR x[1].re > acc[-1].re - 100 THEN acc || x ELSE acc END, [])) AS x FROM g)
SELECT ref, x.id AS id, x.rs AS rs, x.re AS re FROM k"""

#: The best at each start; what was kept before ends at the furthest good end of earlier starts.
STREAMED = f"""WITH {R.MATCHES}, m AS (SELECT id, qry, least(qs, qe) AS lo, greatest(qs, qe) AS hi, mlen FROM matches WHERE mlen >= 0.05 * rlen),
g AS (SELECT *, max(mlen) OVER (PARTITION BY qry, lo) AS most FROM m),
s AS (SELECT qry, lo, max(hi) AS far FROM g WHERE mlen >= 0.95 * most GROUP BY 1, 2),
p AS (SELECT qry, lo, coalesce(max(far) OVER (PARTITION BY qry ORDER BY lo ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), -1) AS last FROM s)
SELECT g.id, g.qry FROM g JOIN p ON g.qry = p.qry AND g.lo = p.lo WHERE mlen >= 0.95 * most AND hi > last"""

_SPANS = f"""WITH {R.INTERVALS}, i AS (SELECT key, i.id, a::DOUBLE AS a, b::DOUBLE AS b, l_quantity AS score FROM intervals i
  JOIN (SELECT ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100 + l_quantity::BIGINT AS id, l_quantity FROM lineitem) l ON i.id = l.id)"""


def tiles(weight: str, k: int = 2, at_most: int = 1 << 30) -> str:
    """Greedy tiling by decreasing ``weight``: chosen spans, and the disjoint pieces that they cover."""
    piece = "len(list_filter(acc.cov, lambda c: least(x.cov[1].b, c.b) - greatest(x.cov[1].a, c.a) > 0 AND least(x.cov[1].b, c.b) - greatest(x.cov[1].a, c.a) >= greatest({0}, (x.cov[1].b - x.cov[1].a) * (1.3::DOUBLE - 0.9::DOUBLE))))".format(f"{k} * 1.3::DOUBLE")
    inside = "len(list_filter(acc.got, lambda c: c.a <= x.got[1].a AND x.got[1].b <= c.b))"
    meets = "NOT (c.b < x.cov[1].a OR c.a > x.cov[1].b)"
    union = f"""list_filter(acc.cov, lambda c: NOT ({meets})) || [{{'a': list_min(list_transform(list_filter(acc.cov, lambda c: {meets}), lambda c: c.a) || [x.cov[1].a]),
      'b': list_max(list_transform(list_filter(acc.cov, lambda c: {meets}), lambda c: c.b) || [x.cov[1].b])}}]"""
    return f"""{_SPANS}, o AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY a, b, id) AS i FROM i),
g AS (SELECT key, list({{'got': [{{'a': a, 'b': b, 'id': id}}], 'cov': [{{'a': a, 'b': b}}]}} ORDER BY {weight} DESC, i) AS l FROM o GROUP BY 1),
f AS (SELECT key, list_reduce(l, lambda acc, x: CASE WHEN len(acc.got) >= {at_most} OR {piece} > 0 OR {inside} > 0 THEN acc ELSE {{'got': acc.got || x.got, 'cov': {union}}} END,
  {{'got': []::STRUCT(a DOUBLE, b DOUBLE, id BIGINT)[], 'cov': []::STRUCT(a DOUBLE, b DOUBLE)[]}}) AS r FROM g)
SELECT key, unnest(r.got).id AS id FROM f"""


#: Each entry of the accumulator is a chain that is better than all that end before it.
MAXIMAL = f"""{_SPANS}, g AS (SELECT key, list([{{'e': b, 't': score, 'c': [{{'a': a, 'id': id, 't': score}}]}}] ORDER BY b, a, id) AS l FROM i GROUP BY 1),
f AS (SELECT key, list_reduce(l, lambda acc, x: list_transform([list_filter(list_filter(acc, lambda y: y.e <= least(x[1].c[1].a + 2 * 1.3::DOUBLE, x[1].e))[-1].c, lambda y: y.a < x[1].c[1].a)], lambda base:
    CASE WHEN len(acc) = 0 OR x[1].t + coalesce(base[-1].t, 0) > acc[-1].t
      THEN acc || [{{'e': x[1].e, 't': x[1].t + coalesce(base[-1].t, 0), 'c': coalesce(base, []) || [{{'a': x[1].c[1].a, 'id': x[1].c[1].id, 't': x[1].t + coalesce(base[-1].t, 0)}}]}}]
      ELSE acc END)[1], []::STRUCT(e DOUBLE, t DOUBLE, c STRUCT(a DOUBLE, id BIGINT, t DOUBLE)[])[]) AS r FROM g)
SELECT key, unnest(r[-1].c).id AS id FROM f"""

_ROW = "{'id': id, 'rs': rs, 're': re, 'qs': qs, 'qe': qe, 'mlen': mlen, 'idy': idy}"
_RUN = """list_reduce({0}, lambda acc, x: CASE WHEN len(acc) = 0 THEN x
    WHEN (x[1].qs < x[1].qe) <> (acc[1].qs < acc[1].qe) OR (x[1].qs + x[1].qe - acc[-1].qs - acc[-1].qe) * (CASE WHEN acc[1].qs < acc[1].qe THEN 1 ELSE -1 END) <= 0 THEN acc ELSE acc || x END, [])"""
_BROKEN = """len(list_filter(generate_series(2, len(run)), lambda i: abs(run[i].rs - run[i - 1].re - (run[i].qs - run[i - 1].qe) * (CASE WHEN run[1].qs < run[1].qe THEN 1 ELSE -1 END)) > {0}
    OR 2 * (run[i - 1].re - run[i - 1].rs + run[i].re - run[i].rs) < run[i].rs - run[i - 1].re)) > 0"""
_WHOLE = """{'rs': p[1].rs, 're': p[-1].re, 'qs': p[1].qs, 'qe': p[-1].qe, 'n': len(p)::INTEGER, 'mlen': list_sum(list_transform(p, lambda m: m.mlen))::BIGINT,
    'idy': list_sum(list_transform(p, lambda m: m.mlen * m.idy))::DOUBLE / list_sum(list_transform(p, lambda m: m.mlen))::DOUBLE}"""
_TWO = "(floor(({0}) * 10000 + 0.50001)::BIGINT // 100)::VARCHAR || '.' || lpad((floor(({0}) * 10000 + 0.50001)::BIGINT % 100)::VARCHAR, 2, '0')"


def _chains(apart: int, by: str) -> str:
    """CTE parts: a row for each merged match of the chains of each group."""
    return f"""g AS (SELECT ref, qry, {by} AS side, any_value(rlen) AS rlen, any_value(qlen) AS qlen, list([{_ROW}] ORDER BY rs, re, id) AS l FROM matches GROUP BY 1, 2, 3),
run AS (SELECT * EXCLUDE l, {_RUN.format('l')} AS run FROM g),
cut AS (SELECT ref, qry, side, rlen, qlen, CASE WHEN {_BROKEN.format(apart)} THEN list_transform(run, lambda m: [m]) ELSE [run] END AS ps FROM run),
parts AS (SELECT ref, qry, side, rlen, qlen, {_WHOLE} AS m FROM (SELECT ref, qry, side, rlen, qlen, unnest(ps) AS p FROM cut))"""


MERGED = f"""WITH {R.MATCHES}, {_chains(2000, '0')}
SELECT ref, qry, m.rs AS rs, m.re AS re, m.qs AS qs, m.qe AS qe, m.n AS n, {_TWO.format('m.idy / 100')} AS idy2, {_TWO.format('(m.re - m.rs + 1) / rlen')} AS cov_r, {_TWO.format('(abs(m.qe - m.qs) + 1) / qlen')} AS cov_q FROM parts"""

_OUT = "x.m.rs AS rs, x.m.re AS re, x.m.qs AS qs, x.m.qe AS qe, x.m.n AS n, x.m.mlen AS mlen, x.m.idy AS idy, x.rlen AS rlen, x.qlen AS qlen"

MERGED_AND_TILED = f"""WITH {R.MATCHES}, {_chains(2000, '(qs < qe)::INTEGER')},
total AS (SELECT ref, qry, side, row_number() OVER (PARTITION BY ref, qry ORDER BY sum(m.mlen) DESC, side DESC) AS r FROM parts GROUP BY 1, 2, 3),
best AS (SELECT parts.* FROM parts JOIN total USING (ref, qry, side) WHERE r = 1),
s AS (SELECT ref, list([{{'qry': qry, 'm': m, 'rlen': rlen, 'qlen': qlen, 'contained': FALSE}}] ORDER BY m.rs - m.re, m.rs, qry) AS l FROM best GROUP BY 1),
f AS (SELECT ref, unnest(list_reduce(l, lambda acc, x: acc || [{{'qry': x[1].qry, 'm': x[1].m, 'rlen': x[1].rlen, 'qlen': x[1].qlen,
  'contained': x[1].m.re - x[1].m.rs + 1 < 1000 OR len(list_filter(acc, lambda y: NOT y.contained AND y.m.rs - 100 <= x[1].m.rs AND x[1].m.re <= y.m.re + 100)) > 0}}], [])) AS x FROM s)
SELECT ref, x.qry AS qry, {_OUT}, x.contained AS contained FROM f"""

_STEP = """{'rs': acc[-1].rs, 're': x[1].re, 'qs': acc[-1].qs, 'qe': x[1].qe, 'n': acc[-1].n + 1, 'mlen': acc[-1].mlen + x[1].mlen, 'w': acc[-1].w + x[1].w}"""
_WAY = "(CASE WHEN acc[-1].qs < acc[-1].qe THEN 1 ELSE -1 END)"
INTERVAL_TILING = f"""WITH {R.MATCHES}, g AS (SELECT ref, qry, any_value(rlen) AS rlen, any_value(qlen) AS qlen,
  list([{{'rs': rs, 're': re, 'qs': qs, 'qe': qe, 'n': 1, 'mlen': mlen, 'w': mlen * idy}}] ORDER BY rs, re, id) AS l FROM matches GROUP BY 1, 2),
runs AS (SELECT ref, qry, rlen, qlen, unnest(list_reduce(l, lambda acc, x: CASE WHEN len(acc) > 0 AND (x[1].qs < x[1].qe) = (acc[-1].qs < acc[-1].qe)
    AND abs(x[1].rs - acc[-1].re - (x[1].qs - acc[-1].qe) * {_WAY}) < 5000
    AND (x[1].qs - acc[-1].qe) * {_WAY} <= 1.5 * greatest(x[1].rs - acc[-1].re, 1) AND x[1].rs - acc[-1].re > -5 AND (x[1].qs - acc[-1].qe) * {_WAY} > -5
    AND acc[-1].mlen + x[1].mlen >= (x[1].qs - acc[-1].qe) * {_WAY} AND x[1].rs > acc[-1].rs THEN acc[:-2] || [{_STEP}] ELSE acc || x END, [])) AS m FROM g),
s AS (SELECT ref, list([{{'qry': qry, 'm': m, 'rlen': rlen, 'qlen': qlen}}] ORDER BY (m.w::DOUBLE / m.mlen) * m.mlen DESC, m.rs, qry) AS l FROM runs GROUP BY 1),
f AS (SELECT ref, unnest(list_reduce(l, lambda acc, x: CASE WHEN len(list_filter(acc, lambda y: (y.m.rs <= x[1].m.rs AND x[1].m.re <= y.m.re) OR (x[1].m.rs <= y.m.rs AND y.m.re <= x[1].m.re)
    OR least(x[1].m.re, y.m.re) - greatest(x[1].m.rs, y.m.rs) > greatest(10.0::DOUBLE * least(x[1].m.re - x[1].m.rs, y.m.re - y.m.rs) / 100, 1.2::DOUBLE * 17))) > 0 THEN acc ELSE acc || x END, [])) AS x FROM s)
SELECT ref, x.qry AS qry, x.m.rs AS rs, x.m.re AS re, x.m.qs AS qs, x.m.qe AS qe, x.m.n AS n, x.m.mlen AS mlen, x.m.w::DOUBLE / x.m.mlen AS idy, x.rlen AS rlen, x.qlen AS qlen FROM f"""

_NEAR = "list_sort(list_filter(g, lambda v: abs(v - acc.mid) <= greatest(0.25 * abs(acc.mid), 200)))"
MEDIANS = f"""WITH r AS (SELECT l_partkey % 40 AS u1, l_suppkey % 10 AS u2, ((l_orderkey * 10 + l_linenumber) * 1000000 + l_partkey) * 100 + l_quantity::BIGINT AS id, (l_quantity * 40)::BIGINT AS gap, round(l_discount * 1000)::BIGINT AS over FROM lineitem),
s AS (SELECT u1, u2, list(gap ORDER BY over, id) AS g, min(over) AS best FROM r GROUP BY 1, 2),
f AS (SELECT u1, u2, g, best, list_reduce(list_transform(generate_series(1, 5), lambda i: {{'mid': 0::DOUBLE, 'dead': FALSE, 'done': FALSE}}),
  lambda acc, x: CASE WHEN acc.dead OR acc.done THEN acc WHEN len({_NEAR}) < 2 THEN {{'mid': acc.mid, 'dead': TRUE, 'done': FALSE}}
    ELSE list_transform([CASE WHEN len({_NEAR}) = 2 THEN ({_NEAR}[1] + {_NEAR}[2]) / 2 ELSE {_NEAR}[len({_NEAR}) // 2 + 1]::DOUBLE END], lambda new: {{'mid': new, 'dead': FALSE, 'done': new = acc.mid}})[1] END,
  {{'mid': g[1]::DOUBLE, 'dead': FALSE, 'done': FALSE}}) AS z FROM s)
SELECT u1, u2, id, (CASE WHEN len(g) = 1 THEN -1 WHEN len(g) = 2 THEN (abs(g[1] - g[2]) <= 200 OR abs(g[1] - g[2]) <= 0.25 * greatest(abs(g[1]), abs(g[2])))::INTEGER
  WHEN z.dead THEN 0 ELSE (abs(gap - z.mid) <= greatest(0.25 * abs(z.mid), 200) AND (over < 3 * best OR over < 250))::INTEGER END)::INTEGER AS verdict FROM r JOIN f USING (u1, u2)"""

GAP_PATHS = """WITH RECURSIVE e AS (SELECT p_partkey::VARCHAR AS src, ((p_partkey * 3 + p_size) % 200)::VARCHAR AS dst, p_size + 1 AS "add" FROM part),
gaps AS (SELECT s_suppkey AS id, s_suppkey::VARCHAR AS src, (s_nationkey * 7)::VARCHAR AS dst, 60 AS gap FROM supplier),
walk AS (
  SELECT id, src AS cur, dst, gap, 0 AS n, [src] AS path, 1 AS c, 0 AS depth FROM gaps
  UNION ALL
  SELECT w.id, e.dst, w.dst, gap, n + "add", list_append(path, e.dst), count(*) OVER (PARTITION BY w.id), depth + 1
  FROM walk w JOIN e ON e.src = w.cur WHERE c <= 10 AND (depth = 0 OR w.cur <> w.dst) AND n + "add" <= 2 * gap
)
SELECT id, any_value(array_to_string(path, '_')) AS path FROM walk WHERE depth > 0 AND cur = dst AND c <= 10 AND id NOT IN (SELECT id FROM walk WHERE c > 10) GROUP BY id HAVING count(*) = 1"""

#: Pieces of 700 bases every 900, named in pairs: only the second of a pair joins the next one, across 200 raw bases.
_PIECES = f"""WITH {R.READS}, p AS (SELECT name AS read, seq AS whole, i, substring(seq, 900 * i + 1, 700) AS piece FROM (SELECT name, seq, unnest(generate_series(0, (length(seq) - 1) // 900)) AS i FROM reads WHERE length(seq) > 0)),
ok AS (SELECT * FROM p WHERE i = 0 OR length(piece) >= 200)"""
JOINED = f"""{_PIECES}, k AS (SELECT * FROM ok WHERE read IN (SELECT read FROM ok GROUP BY 1 HAVING avg(length(piece)) >= 300)),
t AS (SELECT read, (i + 1) // 2 AS part, string_agg(CASE WHEN i % 2 = 0 AND i > 0 THEN lower(substring(whole, 900 * i - 199, 200)) ELSE '' END || piece, '' ORDER BY i) AS seq FROM k GROUP BY 1, 2)
SELECT read, (row_number() OVER (PARTITION BY read ORDER BY part) - 1)::INTEGER AS part, length(seq) AS n, md5(seq) AS digest FROM t WHERE length(seq) >= 400"""
CORRECTED = f"""{_PIECES}, t AS (SELECT read, string_agg(lower(piece) || substring(whole, 900 * i + 701, 200) || CASE WHEN last THEN substring(whole, 900 * i + 901) ELSE '' END, '' ORDER BY i) AS seq FROM (SELECT *, i = max(i) OVER (PARTITION BY read) AS last FROM ok) GROUP BY 1)
SELECT r.name, length(coalesce(t.seq, r.seq)) AS n, md5(coalesce(t.seq, r.seq)) AS digest FROM reads r LEFT JOIN t ON t.read = r.name"""

MATES = f"""WITH {R.READS}, p AS (SELECT name AS read, start, substring(seq, start, 900) AS piece FROM (SELECT name, seq, unnest(generate_series(1, length(seq), 2000)) AS start FROM reads WHERE length(seq) > 0)),
w AS (SELECT read, start, piece, lead(start) OVER o AS s2, lead(piece) OVER o AS p2 FROM p WINDOW o AS (PARTITION BY read ORDER BY start))
SELECT read, floor((s2 + length(p2) - start + 500) / 1000)::BIGINT AS library, (s2 + length(p2) - start)::INTEGER AS insert, md5(substring(piece, 1, 250)) AS left, md5(substring(p2, 1, 250)) AS right
FROM w WHERE s2 IS NOT NULL AND s2 + length(p2) - start >= 2500 AND substring(piece, 1, 250) <> substring(p2, 1, 250)"""

FRG = f"""WITH {R.READS}, p AS (SELECT name, i AS part, translate(substring(seq, 5000 * i + 1, 6000), 'Nn', 'Aa') AS s FROM (SELECT name, seq, unnest(generate_series(0, (greatest(1, length(seq) - 1000) - 1) // 5000)) AS i FROM reads WHERE length(seq) > 0))
SELECT '{{FRG' || chr(10) || 'act:A' || chr(10) || 'acc:' || name || '.' || part || chr(10) || 'rnd:1' || chr(10) || 'sta:G' || chr(10) || 'lib:LR' || chr(10) || 'pla:0' || chr(10) || 'loc:0' || chr(10) || 'src:' || chr(10) || '.' || chr(10) || 'seq:' || chr(10) || s
  || chr(10) || '.' || chr(10) || 'qlt:' || chr(10) || CASE WHEN length(s) > 1 THEN 'X' || repeat('D', length(s) - 2) || 'L' ELSE 'X' END || chr(10) || '.' || chr(10) || 'hps:' || chr(10) || '.' || chr(10) || 'clr:0,' || length(s) || chr(10) || '}}' AS value FROM p"""

_DRAW = "((name * 1000003 + pos) % 2147483647 * 48271 % 2147483647)"
_TURN = f"({_DRAW} * 16807 % 2147483647)"


def edits(source: str, rate: float) -> str:
    """CTE bases: each base of ``source`` (name, seq), with what it is changed to."""
    return f"""bases AS (SELECT name, pos, c, CASE WHEN upper(c) IN ('A', 'C', 'G', 'T') AND {_DRAW} % 1000000 < {int(rate * 1_000_000)}
      THEN substring('ACGTACGT', (instr('ACGT', upper(c)) + {_TURN} % 3 + 1)::INTEGER, 1) END AS alt
    FROM (SELECT name, pos, substring(seq, pos::INTEGER, 1) AS c FROM (SELECT name, seq, unnest(generate_series(1, length(seq))) AS pos FROM {source} WHERE length(seq) > 0)))"""


RANDOM_EDITS = f"WITH {R.FRAGMENTS}, {edits('fragments', 0.05)} SELECT name, pos::INTEGER AS pos, c AS ref, alt FROM bases WHERE alt IS NOT NULL"
APPLIED = f"""WITH docs AS (SELECT doc_id AS name, text AS seq FROM documents), {edits('docs', 0.01)}
SELECT docs.name, md5(coalesce(string_agg(coalesce(alt, c), '' ORDER BY pos), '')) AS digest, count(alt)::INTEGER AS applied, 0 AS skipped FROM docs LEFT JOIN bases ON bases.name = docs.name WHERE seq IS NOT NULL GROUP BY docs.name"""
