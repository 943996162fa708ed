"""The operators in DuckDB SQL, where SQL can say them."""

from . import centroids, chat, licenses, mixing, quality_rules, sharding, syncmers

SPACE = r"[\x20\x09-\x0D]+"

OP3 = rf"""
WITH w AS (SELECT row_number() OVER () AS rid, doc_id, lang, source, coalesce(text, '') AS t FROM documents),
p AS (SELECT *, list_filter(string_split_regex(t, '{SPACE}'), lambda x: x <> '') AS ws,
      list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM w),
win AS (SELECT rid, i, array_to_string(ws[i:i + {quality_rules.WINDOW - 1}], ' ') AS g FROM p, unnest(range(1, len(ws) - {quality_rules.WINDOW - 2})) AS u(i)),
dup AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS n FROM win) WHERE n > 1),
cov AS (SELECT rid, count(DISTINCT j) AS n FROM dup, unnest(range(i, i + {quality_rules.WINDOW})) AS u(j) GROUP BY rid),
f AS (SELECT p.rid, doc_id, lang, source, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
      (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
      coalesce(cov.n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines, (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g')))::BIGINT AS n_capitals
      FROM p LEFT JOIN cov USING (rid)),
b AS (SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM f),
m AS (SELECT rid, lang, source, base_failed, 'symbols' AS measure, CASE WHEN word_chars > 0 THEN 1000 * n_symbols // word_chars END AS v FROM b
      UNION ALL SELECT rid, lang, source, base_failed, 'word_length', CASE WHEN n_words > 0 THEN 100 * word_chars // n_words END FROM b
      UNION ALL SELECT rid, lang, source, base_failed, 'dup_lines', CASE WHEN n_lines > 0 THEN 1000 * n_dup_lines // n_lines END FROM b
      UNION ALL SELECT rid, lang, source, base_failed, 'repeats', CASE WHEN n_words > 0 THEN 1000 * n_repeat_words // n_words END FROM b
      UNION ALL SELECT rid, lang, source, base_failed, 'capitals', CASE WHEN word_chars > 0 THEN 1000 * n_capitals // word_chars END FROM b),
s AS (SELECT lang, source, measure, v - v % (1::BIGINT << greatest(length(bin(v)) - 7, 0)::INT) AS bucket FROM m WHERE NOT base_failed AND v IS NOT NULL),
lv AS (SELECT 2 AS level, lang, source, measure, bucket FROM s UNION ALL SELECT 1, lang, NULL, measure, bucket FROM s UNION ALL SELECT 0, NULL, NULL, measure, bucket FROM s),
bn AS (SELECT level, lang, source, measure, bucket, count(*) AS n FROM lv GROUP BY ALL),
bc AS (SELECT *, sum(n) OVER (PARTITION BY level, lang, source, measure ORDER BY bucket) AS seen, sum(n) OVER (PARTITION BY level, lang, source, measure) AS al FROM bn),
q AS (SELECT level, lang, source, measure, {', '.join(f'min(bucket) FILTER (seen * 10 >= al * {k}) AS q{k}' for k in (1, 5, 9))}, any_value(al)::BIGINT AS n FROM bc GROUP BY ALL),
fl (measure, least, two) AS (VALUES {', '.join(f"('{m}', {least}, {m in quality_rules.TWO_SIDED})" for m, (_, least) in quality_rules.MEASURES.items())}),
fe AS (SELECT level, lang, source, q.measure, CASE WHEN two THEN q1 - {quality_rules.REACH} * greatest(q5 - q1, least) END AS low, q9 + {quality_rules.REACH} * greatest(q9 - q5, least) AS high, n FROM q JOIN fl USING (measure)),
f1 AS (SELECT a.lang, a.measure, floor((a.n * a.low + {quality_rules.PRIOR} * b.low) / (a.n + {quality_rules.PRIOR})) AS low, floor((a.n * a.high + {quality_rules.PRIOR} * b.high) / (a.n + {quality_rules.PRIOR})) AS high
      FROM fe a JOIN fe b ON a.level = 1 AND b.level = 0 AND a.measure = b.measure),
f2 AS (SELECT a.lang, a.source, a.measure, floor((a.n * a.low + {quality_rules.PRIOR} * b.low) / (a.n + {quality_rules.PRIOR})) AS low, floor((a.n * a.high + {quality_rules.PRIOR} * b.high) / (a.n + {quality_rules.PRIOR})) AS high
      FROM fe a JOIN f1 b ON a.level = 2 AND a.measure = b.measure AND a.lang IS NOT DISTINCT FROM b.lang),
bad AS (SELECT DISTINCT m.rid FROM m JOIN f2 ON f2.measure = m.measure AND f2.lang IS NOT DISTINCT FROM m.lang AND f2.source IS NOT DISTINCT FROM m.source WHERE m.v > f2.high OR m.v < f2.low)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND rid NOT IN (SELECT rid FROM bad) AS kept FROM b
"""


def number(text):
    """The whole number of the first eight hex digits of an MD5."""
    return f"('0x' || substr(md5({text}), 1, 8))::BIGINT"


OP5 = f"""
WITH RECURSIVE s AS (SELECT list({number("'offset:shard-' || k")} % {sharding.SLOTS} ORDER BY k) AS o, list({number("'step:shard-' || k")} % {sharding.SLOTS - 1} + 1 ORDER BY k) AS st FROM range({sharding.SHARDS}) AS r(k)),
turns AS (
  SELECT 0 AS t, list_transform(range({sharding.SLOTS}), lambda x: -1) AS taken FROM s
  UNION ALL
  SELECT t + 1, list_transform(taken, lambda was, i: CASE WHEN i - 1 = (off + k * step) % {sharding.SLOTS} THEN t % {sharding.SHARDS} ELSE was END)
  FROM (SELECT t, taken, off, step, list_filter(range({sharding.SLOTS}), lambda x: taken[(off + x * step) % {sharding.SLOTS} + 1] < 0)[1] AS k
        FROM (SELECT t, taken, o[t % {sharding.SHARDS} + 1] AS off, st[t % {sharding.SHARDS} + 1] AS step FROM turns, s WHERE t < {sharding.SLOTS}))),
slots AS (SELECT taken FROM turns WHERE t = {sharding.SLOTS})
SELECT doc_id, source, slot::INTEGER AS slot, (SELECT taken[slot + 1] FROM slots)::INTEGER AS shard
FROM (SELECT doc_id, source, {number("'key:' || coalesce(doc_id::VARCHAR, '')")} % {sharding.SLOTS} AS slot FROM documents)
"""

OP6 = rf"""
WITH RECURSIVE p AS (SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{SPACE}'), lambda x: x <> '') AS ws FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(ws[i:i + 4], ' ') AS g FROM p, unnest(range(1, greatest(len(ws) - 3, 2))) AS u(i) WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM g a JOIN g b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT a AS node, a AS root FROM e UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node),
k AS (SELECT node, min(root) AS root FROM r GROUP BY 1)
SELECT p.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(root, p.doc_id) AS component_id, coalesce(root, p.doc_id) = p.doc_id AS kept
FROM p LEFT JOIN n USING (doc_id) LEFT JOIN k ON k.node = p.doc_id
"""

OP8 = f"""
WITH t AS (SELECT DISTINCT conv_id, turn, role, text, md5(coalesce('+' || role, '-') || chr(10) || coalesce('+' || text, '-')) AS h FROM conversations),
k AS (SELECT *, coalesce('id:' || conv_id, 'turn:' || coalesce(turn::VARCHAR, '') || ':' || h) AS conv FROM t),
s AS (SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, h) AS place, count(*) OVER (PARTITION BY conv) AS turns FROM k),
p AS (SELECT *, string_agg(h, ',') OVER (PARTITION BY conv ORDER BY place) AS prefix FROM s),
w AS (SELECT prefix, min_by(conv, (conv_id, conv)) AS conv, count(*) AS copies FROM p WHERE place = turns GROUP BY 1),
x AS (SELECT conv, copies FROM w WHERE prefix NOT IN (SELECT prefix FROM p WHERE place < turns))
SELECT min(conv_id) AS conv_id, count(*) AS n_turns, min(copies) AS copies,
       string_agg('{chat.START}' || coalesce(role, '{chat.UNKNOWN}') || chr(10) || coalesce(text, '') || '{chat.END.strip()}' || chr(10), '' ORDER BY place) AS chat
FROM s JOIN x USING (conv) GROUP BY conv
"""

_M = mixing
_STEPS = "".join(f"""
f{k} AS (SELECT s, max(perm) AS hi, max(tot) AS took FROM (SELECT r.s, perm, {f'left{k - 1}' if k > 1 else 'left0'} AS room, sum(size) OVER (PARTITION BY r.s ORDER BY perm RANGE UNBOUNDED PRECEDING) AS tot
  FROM r JOIN st{k - 1} z ON z.s IS NOT DISTINCT FROM r.s WHERE perm > cut{k - 1} AND size <= left{k - 1}) WHERE tot <= room GROUP BY s),
st{k} AS (SELECT z.*, coalesce(hi, cut{k - 1}) AS cut{k}, left{k - 1} - coalesce(took, 0) AS left{k} FROM st{k - 1} z LEFT JOIN f{k} f ON f.s IS NOT DISTINCT FROM z.s),""" for k in range(1, _M.ROUNDS + 1))
_FITS = " OR ".join(f"(perm > cut{k - 1} AND perm <= cut{k} AND d.size <= left{k - 1})" for k in range(1, _M.ROUNDS + 1))

OP9 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
h AS (SELECT *, md5('{_M.SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS perm FROM d),
e AS (SELECT *, ('0x' || substr(perm, 1, 8))::BIGINT % {_M.BUCKETS} AS bucket FROM h),
sz AS (SELECT source, sum(size)::BIGINT AS ss, [{', '.join(map(str, _M.WEIGHTS))}][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % {len(_M.WEIGHTS)} + 1] AS w FROM e GROUP BY 1),
sh AS (SELECT *, {_M.LIMIT}::DOUBLE * ss / w AS ratio FROM sz),
lv AS (SELECT *, ({_M.GROWTH}::DOUBLE * sum(ss) OVER () - {_M.LIMIT} * coalesce(sum(ss) OVER o, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER o, 0)) AS share FROM sh WINDOW o AS (ORDER BY ratio, source NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
tg AS (SELECT source, ss, least({_M.LIMIT}::DOUBLE * ss, coalesce((SELECT share FROM lv WHERE share <= ratio ORDER BY ratio, source NULLS FIRST LIMIT 1), 0) * w) AS target,
       least({_M.BUCKETS}, greatest(1, ceil(ss / greatest((SELECT sum(ss) FROM sz) / {_M.BLOCKS}, {_M.LEAST_BLOCK}))))::INT AS blocks FROM lv),
g AS (SELECT e.*, ss, target, blocks, floor(bucket * blocks / {_M.BUCKETS})::INT AS block FROM e JOIN tg ON tg.source IS NOT DISTINCT FROM e.source),
b AS (SELECT source AS s, ss, target, block AS b, sum(size)::BIGINT AS words FROM g GROUP BY ALL),
o AS (SELECT *, CASE WHEN ss > 0 THEN floor(target / ss) ELSE 0 END::BIGINT AS passes, sum(words) OVER (PARTITION BY s ORDER BY md5('{_M.SEED}:' || coalesce(s, '') || ':' || b), b ROWS UNBOUNDED PRECEDING) AS seen FROM b),
p AS (SELECT *, greatest(0, least(words, floor(target)::BIGINT - passes * ss - (seen - words)))::BIGINT AS given FROM o),
st0 AS (SELECT s, b, given AS left0, '' AS cut0 FROM p WHERE given > 0 AND given < words),
r AS (SELECT z.s, perm, size FROM g JOIN st0 z ON z.s IS NOT DISTINCT FROM g.source AND z.b = g.block WHERE size > 0),{_STEPS}
t AS (SELECT d.*, passes, given, words, coalesce({_FITS}, false) AS fits FROM g d JOIN p ON p.s IS NOT DISTINCT FROM d.source AND p.b = d.block
      LEFT JOIN st{_M.ROUNDS} z ON z.s IS NOT DISTINCT FROM d.source AND z.b = d.block)
SELECT doc_id, size, ss AS source_size, target, (size * (passes + CASE WHEN given > 0 AND (given = words OR fits) THEN 1 ELSE 0 END))::BIGINT AS taken FROM t
"""


def op10(stated):
    texts = ", ".join("('" + name + f"/{k}', '{name}', '" + t.replace("'", "''") + "')" for name, ts in licenses.TEMPLATES.items() for k, t in enumerate(ts))
    words = lambda x: f"list_filter(list_transform(string_split_regex(lower({x}), '[^a-z0-9.]+'), lambda v: trim(v, '.')), lambda v: v <> '')"
    split = "string_split(regexp_replace(coalesce(text, ''), '([.!?])[ \\t]+', '\\1' || chr(10), 'g'), chr(10))"
    return rf"""
WITH RECURSIVE tp (id, licence, t) AS (VALUES {texts}),
tt AS (SELECT id, licence, term, count(*) AS n FROM (SELECT id, licence, unnest({words('t')}) AS term FROM tp) GROUP BY ALL),
idf AS (SELECT term, 1 + ln((1.0 + (SELECT count(*) FROM tp)) / (1 + count(*))) AS idf FROM tt GROUP BY 1),
tw AS (SELECT id, licence, term, n * idf / sqrt(sum((n * idf) ** 2) OVER (PARTITION BY id)) AS w FROM tt JOIN idf USING (term)),
f AS (SELECT doc_id, concat_ws('/', source, lang, CASE WHEN regexp_matches(coalesce(text, ''), '(?i)\A{stated}|\n{stated}\z') THEN 'LICENSE.' || coalesce(doc_id::VARCHAR, '') ELSE coalesce(doc_id::VARCHAR, '') || '.txt' END) AS path, text FROM documents),
st AS (SELECT path, s FROM (SELECT path, unnest({split}) AS s FROM f) WHERE regexp_matches(s, '{licenses.STATEMENT}')),
ds AS (SELECT DISTINCT s FROM st),
sw AS (SELECT s, term, count(*) AS n FROM (SELECT s, unnest({words('s')}) AS term FROM ds) GROUP BY ALL),
sx AS (SELECT s, term, n * coalesce(idf, 1 + ln(1.0 + (SELECT count(*) FROM tp))) AS w FROM sw LEFT JOIN idf USING (term)),
sl AS (SELECT s, sqrt(sum(w * w)) AS len FROM sx GROUP BY 1),
sc AS (SELECT s, id, licence, round(sum(sx.w * tw.w) / any_value(len), 9) AS score FROM sx JOIN tw USING (term) JOIN sl USING (s) GROUP BY ALL),
bs AS (SELECT s, min_by(licence, (-score, licence)) AS licence, max(score) AS score FROM sc WHERE score >= {licenses.LEAST} GROUP BY 1),
ow AS (SELECT path, min_by(licence, (-score, licence)) AS licence, max(score) AS score FROM st JOIN bs USING (s) GROUP BY 1),
dl AS (SELECT regexp_replace(path, '/?[^/]*$', '') AS dir, min_by(licence, (-score, licence)) AS licence FROM ow WHERE regexp_matches(path, '{licenses.LICENCE_FILE}') GROUP BY 1),
up AS (SELECT DISTINCT regexp_replace(path, '/?[^/]*$', '') AS dir, regexp_replace(path, '/?[^/]*$', '') AS up, 0 AS steps FROM f
       UNION ALL SELECT dir, regexp_replace(up, '/?[^/]*$', ''), steps + 1 FROM up WHERE up <> ''),
ih AS (SELECT up.dir, min_by(up, steps) AS from_dir, min_by(licence, steps) AS licence FROM up JOIN dl ON dl.dir = up.up GROUP BY 1)
SELECT doc_id, f.path, coalesce(ow.licence, ih.licence) AS licence, ow.score AS score, CASE WHEN ow.licence IS NOT NULL THEN 'own' WHEN ih.licence IS NOT NULL THEN 'inherited' END AS how,
       CASE WHEN ow.licence IS NULL THEN from_dir END AS from_dir
FROM f LEFT JOIN ow USING (path) LEFT JOIN ih ON ih.dir = regexp_replace(f.path, '/?[^/]*$', '')
"""

_K, _S, _HEX = syncmers.K, syncmers.S, syncmers.HEX
OP11 = rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER (ORDER BY doc_id DESC NULLS LAST) AS r FROM documents),
n AS (SELECT *, length(t) AS n, coalesce(lead(t) OVER (ORDER BY r), first_value(t) OVER (ORDER BY r)) AS nt FROM d),
e AS (SELECT *, left(t, n - n // 2) || left(nt, n // 2) AS et FROM n),
x AS (SELECT r, 'own' AS what, t FROM e UNION ALL SELECT r, 'new', et FROM e),
w AS (SELECT r, what, list_filter(string_split_regex(t, '{SPACE}'), lambda v: v <> '') AS ws FROM x),
h AS (SELECT *, list_transform(range(1, len(ws)), lambda i: md5(ws[i] || ' ' || ws[i + 1])) AS h FROM w),
p AS (SELECT *, list_filter(range(1, len(ws) - {_K - 2}), lambda i: least(h[i], h[i + {_K - _S}]) <= least({', '.join(f'h[i + {k}]' for k in range(1, _K - _S))})) AS p FROM h),
a AS (SELECT r, what, CASE WHEN len(ws) = 0 THEN [] WHEN len(p) = 0 THEN [substr(md5(array_to_string(ws, ' ')), 1, {_HEX}) || '0']
      ELSE list_transform(p, lambda i, n: substr(md5(array_to_string(ws[i:i + {_K - 1}], ' ')), 1, {_HEX}) || CASE WHEN n = 1 THEN 0 ELSE least(i - p[n - 1], 9) END) END AS a FROM p),
b AS (SELECT e.doc_id, e.r, n, et, o.a AS o, c.a AS c FROM e JOIN a o ON o.r = e.r AND o.what = 'own' JOIN a c ON c.r = e.r AND c.what = 'new'),
m AS (SELECT *, coalesce(lead(o) OVER (ORDER BY r), first_value(o) OVER (ORDER BY r)) AS z FROM b)
SELECT doc_id, n AS n_chars, sha256(et) AS edited_sha256, array_to_string(o, '') AS fingerprint, array_to_string(c, '') AS edited_fingerprint,
       CASE WHEN len(o) + len(c) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(o, c)) / (len(list_distinct(o)) + len(list_distinct(c))) END AS near_edited,
       CASE WHEN len(o) + len(z) = 0 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE * len(list_intersect(o, z)) / (len(list_distinct(o)) + len(list_distinct(z))) END AS near_next
FROM m
"""

_C = centroids
_ROUNDS = "".join(f"""
a{k} AS (SELECT rid, min_by(k, (d, k)) AS k, min(d) AS d FROM (SELECT rid, k, sum((x - c) * (x - c))::BIGINT AS d FROM e JOIN c{k} USING (j) GROUP BY ALL) GROUP BY 1),""" + (f"""
s{k} AS (SELECT k, j, sum(x)::BIGINT AS s, count(*) AS n FROM e JOIN a{k} USING (rid) GROUP BY ALL),
c{k + 1} AS (SELECT k, j, coalesce((s - (s % n + n) % n) // n, c)::BIGINT AS c FROM c{k} LEFT JOIN s{k} USING (k, j)),""" if k < _C.ROUNDS else "") for k in range(_C.ROUNDS + 1))

OP12 = f"""
WITH v AS (SELECT row_number() OVER () AS rid, vec_id, list_transform(embedding, lambda x: floor({_C.SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
      WHERE len(embedding) = {_C.SIZE} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {_C.SIZE}),
e AS (SELECT rid, unnest(range(1, {_C.SIZE + 1})) AS j, unnest(v) AS x FROM v),
f AS (SELECT v, row_number() OVER (ORDER BY sha256('{_C.SEED}:' || coalesce(vec_id::VARCHAR, '')), vec_id, v) - 1 AS k FROM v),
c0 AS (SELECT k, unnest(range(1, {_C.SIZE + 1})) AS j, unnest(v) AS c FROM f WHERE k < {_C.CENTROIDS}),{_ROUNDS}
l AS (SELECT k, sha256(string_agg(c::VARCHAR, ',' ORDER BY j)) AS sha FROM c{_C.ROUNDS} GROUP BY 1)
SELECT vec_id, k::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY k))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia, sha AS centroid_sha256
FROM v JOIN a{_C.ROUNDS} USING (rid) JOIN l USING (k)
"""
