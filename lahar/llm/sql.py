"""DuckDB SQL that gives the same rows as the queries it is named after."""

MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || '|mix-1'), 1, 8))::BIGINT AS place
  FROM documents),
src AS (
  SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rank
  FROM sized GROUP BY source),
weighed AS (SELECT *, [5.0, 2.0, 1.0][((rank - 1) % 3 + 1)::INT]::DOUBLE AS weight, source_size * 2.0::DOUBLE AS most FROM src),
levels AS (
  SELECT *, most / weight AS full_at,
         (sum(source_size) OVER ()::DOUBLE * 1.5::DOUBLE
          - coalesce(sum(most) OVER (ORDER BY most / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / sum(weight) OVER (ORDER BY most / weight, rank ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM weighed),
plan AS (
  SELECT source, source_size, rank,
         least(most, coalesce((SELECT l2.level FROM levels l2 WHERE l2.full_at >= l2.level ORDER BY l2.full_at, l2.rank LIMIT 1) * weight, most)) AS target
  FROM levels),
runs AS (
  SELECT d.*, p.source_size, p.target,
         CASE WHEN p.source_size > 0 THEN floor(p.target / p.source_size)::BIGINT ELSE 0 END AS passes,
         sum(d.size) OVER (PARTITION BY p.rank ORDER BY d.place, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS upto
  FROM sized d JOIN plan p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target,
       (passes + CASE WHEN target - passes * source_size > 0
                       AND upto - size / 2.0::DOUBLE <= target - passes * source_size THEN 1 ELSE 0 END) * size AS taken
FROM runs
"""

LINES_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS rid, coalesce(doc_id, 9223372036854775807) AS ord, doc_id, coalesce(text, '') AS text FROM documents),
lines AS (
  SELECT rid, ord, doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM docs),
toks AS (
  SELECT *, list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS m,
         list_transform(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), lambda x: regexp_matches(x, '[0-9]')) AS d
  FROM lines),
leafy AS (SELECT *, len(m) || ' ' || array_to_string(m[1:3], ' ') AS leaf FROM toks WHERE len(m) >= 3),
hot AS (SELECT leaf, count(DISTINCT rid) AS docs FROM leafy GROUP BY leaf HAVING count(DISTINCT rid) >= 3),
level AS (SELECT leaf, unnest([3.0::DOUBLE, 0.1::DOUBLE * docs, 0.3::DOUBLE * docs, 0.5::DOUBLE * docs]) AS least, unnest(range(4)) AS share FROM hot),
tok AS (
  SELECT rid, ord, pos, leaf, unnest(m) AS x, unnest(d) AS digit, generate_subscripts(m, 1) AS j
  FROM leafy SEMI JOIN hot USING (leaf)),
const AS (SELECT leaf, j, x, count(DISTINCT rid) AS docs FROM tok WHERE NOT digit GROUP BY leaf, j, x HAVING count(DISTINCT rid) >= 3),
marked AS (
  SELECT t.rid, t.ord, t.pos, t.leaf, t.j, t.x, v.share, c.docs >= v.least AND NOT t.digit AS fix
  FROM tok t JOIN level v ON t.leaf = v.leaf LEFT JOIN const c ON t.leaf = c.leaf AND t.j = c.j AND t.x = c.x),
tmpl AS (
  SELECT rid, ord, pos, leaf, string_agg(CASE WHEN fix THEN x ELSE '<*>' END, ' ' ORDER BY j) AS template, count(*) FILTER (fix) AS fixed, count(*) AS n
  FROM marked GROUP BY rid, ord, pos, leaf, share),
rec AS (SELECT leaf, template, min(ord) AS least FROM tmpl WHERE fixed >= 0.6 * n GROUP BY leaf, template HAVING count(DISTINCT rid) >= 3),
gone AS (SELECT DISTINCT t.rid, t.pos FROM tmpl t JOIN rec r ON t.leaf = r.leaf AND t.template = r.template WHERE t.fixed >= 0.6 * t.n AND t.ord > r.least)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(g.rid)::BIGINT AS n_removed,
       sha256(coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (g.rid IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN gone g ON l.rid = g.rid AND l.pos = g.pos
GROUP BY l.rid, l.doc_id
"""

SUBSTRINGS_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
places AS (SELECT rid, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35),
windows AS (SELECT rid, i, array_to_string(w[i:i + 34], ' ') AS words FROM places JOIN docs USING (rid)),
repeated AS (SELECT words FROM windows GROUP BY words HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS j FROM windows SEMI JOIN repeated USING (words)),
words AS (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM docs),
kept AS (
  SELECT words.rid, count(gone.j)::BIGINT AS n_removed, coalesce(string_agg(word, ' ' ORDER BY words.j) FILTER (gone.j IS NULL), '') AS kept
  FROM words LEFT JOIN gone ON words.rid = gone.rid AND words.j = gone.j GROUP BY words.rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

NEAR_SQL = r"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT DISTINCT rid, doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                           WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle FROM docs),
sizes AS (SELECT rid, count(*) AS n FROM sets GROUP BY rid),
shared AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS common FROM sets a JOIN sets b ON a.shingle = b.shingle AND a.rid < b.rid
  WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY 1, 2),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y WHERE 100 * common >= 85 * (p.n + q.n - common)),
ways AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT rid, doc_id AS other FROM docs UNION SELECT ways.y, reach.other FROM reach JOIN ways ON ways.x = reach.rid),
least AS (SELECT rid, min(other) AS component_id FROM reach GROUP BY rid)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, coalesce(doc_id = component_id, true) AS kept
FROM docs LEFT JOIN sizes USING (rid) LEFT JOIN least USING (rid)
"""

NEAREST_SQL = """
WITH usable AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.v, c.v) AS score FROM usable q JOIN usable c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v)
  WHERE q.vec_id % 20 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INT AS rank, vec_id, score FROM pairs) WHERE rank <= 20
"""

#: crc32 of the decimal id: the bits of its bytes one after another, seven empty steps after each byte.
_CRC32 = """xor(list_reduce(flatten(list_transform(string_split({x}::VARCHAR, ''), lambda s: [ascii(s)::BIGINT, 0, 0, 0, 0, 0, 0, 0])),
  lambda r, e: xor(xor(r, e) >> 1, 3988292384 * (xor(r, e) & 1)), 4294967295::BIGINT), 4294967295)"""

RUNS_SQL = rf"""
WITH plain AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w, {_CRC32.format(x="doc_id")} AS h FROM documents),
sized AS (SELECT *, len(w) AS n, h // 10 AS g, coalesce(h % 10 = 0 AND len(w) > 0, false) AS loops FROM plain),
placed AS (SELECT *, CASE WHEN loops THEN g % n END AS a FROM sized),
periods AS (SELECT *, CASE WHEN loops THEN 1 + (n - a) // (3 + g % 8) END AS p FROM placed),
docs AS (
  SELECT rid, doc_id, n, CASE WHEN loops THEN list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % p END]) ELSE w END AS w
  FROM periods),
words AS (SELECT rid, n, unnest(w) AS x, generate_subscripts(w, 1) - 1 AS i FROM docs),
agree AS (SELECT l.rid, l.i, r.i - l.i AS q FROM words l JOIN words r ON l.rid = r.rid AND l.x = r.x AND r.i > l.i AND 4 * (r.i - l.i) <= l.n),
islands AS (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS island FROM agree),
stretches AS (SELECT rid, q, min(i) AS start, count(*) + q AS length FROM islands GROUP BY rid, q, island HAVING count(*) + q >= greatest(6, 4 * q)),
runs AS (SELECT rid, start, length, min(q) AS period FROM stretches GROUP BY rid, start, length),
best AS (
  SELECT rid, start, length, period FROM runs
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length::DOUBLE / period DESC, start, period) = 1),
listed AS (SELECT rid, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines FROM runs GROUP BY rid),
gone AS (SELECT DISTINCT rid, unnest(range(start + period, start + length)) AS i FROM runs),
left_over AS (SELECT rid, string_agg(x, ' ' ORDER BY i) AS kept FROM words ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period,
       (1000 * length // period)::BIGINT AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(kept, '')) AS collapsed_sha256
FROM docs LEFT JOIN listed USING (rid) LEFT JOIN best USING (rid) LEFT JOIN left_over USING (rid)
"""


def _clusters_sql(k: int, rounds: int, dim: int) -> str:
    near = """SELECT rid, vec_id, v, j, d FROM (
    SELECT rid, vec_id, v, j, list_sum(list_transform(range(1, {dim} + 1), lambda i: (v[i] - c[i]) * (v[i] - c[i])))::BIGINT AS d FROM kept CROSS JOIN c{t})
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY d, j) = 1"""
    steps = []
    for t in range(rounds):
        steps.append(f"""a{t} AS ({near.format(t=t, dim=dim)}),
sums{t} AS (SELECT j, i, sum(x)::BIGINT AS s, count(*) AS n FROM (SELECT j, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM a{t}) GROUP BY j, i),
means{t} AS (SELECT j, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM sums{t} GROUP BY j),
c{t + 1} AS (SELECT j, coalesce(means{t}.c, c{t}.c) AS c FROM c{t} LEFT JOIN means{t} USING (j)),
""")
    return f"""
WITH kept AS (
  SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding::DOUBLE[], lambda x: floor(256 * x)::BIGINT) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) = {dim} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (SELECT * FROM (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id) NULLS LAST, v) - 1 AS j, v AS c FROM kept) WHERE j < {k}),
{"".join(steps)}own AS ({near.format(t=rounds, dim=dim)})
SELECT vec_id, j::INT AS cluster, d AS distance, sum(d) OVER (PARTITION BY j)::BIGINT AS cluster_inertia, sum(d) OVER ()::BIGINT AS inertia,
       sha256(array_to_string(c, ',')) AS centroid_sha256
FROM own JOIN c{rounds} USING (j)
"""


CLUSTERS_SQL = _clusters_sql(40, 5, 64)
