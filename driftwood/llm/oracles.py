"""DuckDB SQL that gives the same rows as the registered corpus queries, where SQL can express them."""

SQL: dict[str, str] = {}

#: Classes of documents whose sets of five-word shingles are alike by a percentage or more.
_CLASSES = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' '))) END AS s
  FROM w),
n AS (SELECT doc_id, len(s)::BIGINT AS n FROM s),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id
      GROUP BY 1, 2),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
      WHERE 100 * i >= {0} * (na.n + nb.n - i)),
d AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, seen) AS (SELECT doc_id, doc_id FROM n UNION SELECT r.node, d.b FROM r JOIN d ON d.a = r.seen)
SELECT n.doc_id, n.n AS n_shingles, c.c AS component_id{1}
FROM n JOIN (SELECT node, min(seen) AS c FROM r GROUP BY 1) c ON c.node = n.doc_id
"""

SQL["op3_minhash"] = _CLASSES.format(75, ", n.doc_id = c.c AS kept")

SQL["op5_sharding"] = r"""
WITH t AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k:
             CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
           FROM (SELECT unnest(range(256))::BIGINT AS i)),
s AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
h AS (SELECT doc_id, octet_length(b) + 16 AS size, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(1, octet_length(b) + 1), lambda i: ('0x' || hex(b[i:i]))::BIGINT)),
             lambda a, x: xor(a >> 8, t.t[(xor(a, x) & 255) + 1]))) AS crc FROM s, t),
c AS (SELECT doc_id, size::BIGINT AS size, crc, sum(size) OVER (ORDER BY doc_id) - size AS before,
             sum(size) OVER () AS total, row_number() OVER (ORDER BY doc_id) - 1 AS pos FROM h),
p AS (SELECT *, least(39, floor((before + size / 2) / total * 40))::INTEGER AS shard FROM c)
SELECT doc_id, size, crc AS text_crc32, 'bytes' AS law, shard,
       pos - min(pos) OVER (PARTITION BY shard) AS slot, NULL::INTEGER AS grown_shard
FROM p
"""

SQL["op8_suffixes"] = r"""
WITH d AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
p AS (SELECT doc_id, b, unnest(range(1, octet_length(b) + 1)) AS i FROM d),
w AS (SELECT doc_id, i, b[i:i + 199] AS w FROM p WHERE i + 199 <= octet_length(b)),
r AS (SELECT doc_id, i, count(*) OVER (PARTITION BY w) > 1 AS hit FROM w),
m AS (SELECT p.doc_id, p.i, p.b[p.i:p.i] AS c,
        coalesce(max(CASE WHEN r.hit THEN 1 ELSE 0 END)
          OVER (PARTITION BY p.doc_id ORDER BY p.i ROWS BETWEEN 199 PRECEDING AND CURRENT ROW), 0) AS gone
      FROM p LEFT JOIN r ON r.doc_id = p.doc_id AND r.i = p.i),
g AS (SELECT *, gone > coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY i), 0) AS opens FROM m),
k AS (SELECT doc_id, count(*) AS n, sum(gone)::BIGINT AS n_removed, sum(opens::INTEGER)::BIGINT AS n_spans,
        sha256(unhex(coalesce(string_agg(hex(c), '' ORDER BY i) FILTER (gone = 0), ''))) AS kept_sha256
      FROM g GROUP BY doc_id)
SELECT d.doc_id, octet_length(d.b)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, coalesce(kept_sha256, sha256('')) AS kept_sha256
FROM d LEFT JOIN k ON k.doc_id = d.doc_id
"""

SQL["op7_decontamination"] = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
           FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w
      FROM benchmark),
m AS (SELECT * FROM (VALUES (0, [0, 1, 2, 4, 7]), (1, [0, 1, 3, 5, 6]), (2, [0, 2, 3, 4, 6]), (3, [0, 1, 2, 3, 4])) v(i, k)),
ds AS (SELECT doc_id, p, i, list_transform(k, lambda x: w[p + x]) AS s
       FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS p FROM d), m),
bs AS (SELECT item_id, p, i, list_transform(k, lambda x: w[p + x]) AS s
       FROM (SELECT item_id, w, unnest(range(1, len(w) - 6)) AS p FROM b), m),
h AS (SELECT DISTINCT doc_id, item_id, ds.p - bs.p AS shift FROM ds JOIN bs USING (i, s)),
o AS (SELECT h.doc_id, h.item_id, d.w AS dw, b.w AS bw, greatest(shift, 0) AS x, greatest(-shift, 0) AS y,
        least(len(d.w) - greatest(shift, 0), len(b.w) - greatest(-shift, 0)) AS n
      FROM h JOIN d USING (doc_id) JOIN b USING (item_id)),
e AS (SELECT doc_id, item_id, least(16, n) AS c,
        list_transform(range(1, n + 1), lambda i: CASE WHEN dw[x + i] = bw[y + i] THEN 1 ELSE 0 END) AS same FROM o),
g AS (SELECT doc_id, item_id, max(list_sum(same)) AS matched FROM e
      WHERE c >= 8 AND list_max(list_transform(range(1, len(same) - c + 2), lambda i: list_sum(same[i:i + c - 1]))) >= c * 0.6
      GROUP BY 1, 2),
f AS (SELECT doc_id, count(*) AS n, max(matched)::BIGINT AS m, string_agg(item_id::VARCHAR, ',' ORDER BY item_id) AS ids
      FROM g GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_items, coalesce(m, 0) AS matched_tokens, coalesce(ids, '') AS item_ids,
       n IS NOT NULL AS contaminated
FROM d LEFT JOIN f ON f.doc_id = d.doc_id
"""

SQL["op10_search"] = r"""
WITH w AS (SELECT doc_id, list_filter(string_split_regex(
             translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
n AS (SELECT count(*) AS n, sum(len(w)) / count(*) AS mean FROM w),
t AS (SELECT doc_id, term, len, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS term, len(w) AS len FROM w) GROUP BY 1, 2, 3),
f AS (SELECT term, ln(1 + (n.n - count(*) + 0.5) / (count(*) + 0.5)) AS idf FROM t, n GROUP BY term, n.n),
s AS (SELECT q.doc_id AS query_id, t.doc_id,
        round(sum(f.idf * t.tf * 2.2 / (t.tf + 1.2 * (0.25 + 0.75 * t.len / n.mean))), 6) AS score
      FROM t q JOIN t USING (term) JOIN f USING (term), n WHERE q.doc_id % 100 = 0 GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, doc_id, score FROM r WHERE rank <= 10
"""

#: crc32 of the decimal form of a number: a table of 256 remainders, then one step a byte.
_CRC = """t AS (SELECT list(list_reduce(list_prepend(i, range(8)), lambda a, k:
        CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
      FROM (SELECT unnest(range(256))::BIGINT AS i))"""
_CRC_OF = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
        list_transform(string_split({0}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
        lambda a, x: xor(a >> 8, t.t[(xor(a, x) & 255) + 1])))"""

SQL["op11_periods"] = r"""
WITH """ + _CRC + r""",
o AS (SELECT row_number() OVER () AS r, doc_id, """ + _CRC_OF.format("doc_id") + r""" AS h,
        list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents, t),
a AS (SELECT *, len(w) AS n, CASE WHEN h % 10 = 0 AND len(w) > 0 THEN (h // 10) % len(w) END AS a FROM o),
d AS (SELECT r, doc_id, n, CASE WHEN a IS NULL THEN w ELSE w[1:a] || list_transform(range(0, n - a),
        lambda i: w[a + 1 + i % (1 + (n - a) // (3 + (h // 10) % 8))]) END AS w FROM a),
w AS (SELECT r, n, unnest(w) AS w, unnest(range(n)) AS i FROM d),
m AS (SELECT x.r, x.i, y.i - x.i AS q FROM w x JOIN w y ON x.r = y.r AND x.w = y.w AND y.i > x.i AND 4 * (y.i - x.i) <= x.n),
g AS (SELECT r, q, min(i) AS s, count(*) + q AS l
      FROM (SELECT *, i - row_number() OVER (PARTITION BY r, q ORDER BY i) AS g FROM m) GROUP BY r, q, g),
u AS (SELECT r, s, l, min(q) AS q FROM g WHERE l >= greatest(6, 4 * q) GROUP BY r, s, l),
f AS (SELECT r, count(*) AS n_runs, sha256(string_agg(s || ',' || l || ',' || q || chr(10), '' ORDER BY s, q)) AS sha,
        list({'s': s, 'l': l, 'q': q} ORDER BY s, q) AS all_runs FROM u GROUP BY r),
b AS (SELECT r, s, l, q FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY l::DECIMAL(38, 18) / q DESC, s, q) AS k FROM u) WHERE k = 1),
k AS (SELECT w.r, string_agg(w.w, ' ' ORDER BY w.i) AS t FROM w LEFT JOIN f ON f.r = w.r
      WHERE f.r IS NULL OR len(list_filter(f.all_runs, lambda x: w.i >= x.s + x.q AND w.i < x.s + x.l)) = 0 GROUP BY w.r)
SELECT d.doc_id, coalesce(f.n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period,
       (1000 * b.l) // b.q AS exponent_milli, coalesce(f.sha, sha256('')) AS runs_sha256,
       sha256(coalesce(k.t, '')) AS collapsed_sha256
FROM d LEFT JOIN f ON f.r = d.r LEFT JOIN b ON b.r = d.r LEFT JOIN k ON k.r = d.r
"""

SQL["op12_trie"] = r"""
WITH """ + _CRC + r""",
c AS (SELECT conv_id, """ + _CRC_OF.format("conv_id") + r""" % 4 AS h
      FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), t),
o AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) - 1 AS p,
        {'r': coalesce(role, ''), 't': coalesce(text, '')} AS x FROM conversations WHERE conv_id IS NOT NULL),
s AS (SELECT conv_id, list(x ORDER BY p) AS s FROM o GROUP BY conv_id),
b AS (SELECT c.conv_id, coalesce(d.s[1:c.h], []) || s.s[c.h + 1:] AS s
      FROM c JOIN s USING (conv_id) LEFT JOIN s d ON d.conv_id = c.conv_id - c.conv_id % 20),
p AS (SELECT conv_id, d, s[1:d] AS k, len(s) = d AS ends,
        CASE WHEN d = 0 THEN 0 ELSE len(list_filter(string_split_regex(s[d].t, '[\x20\x09-\x0D]+'), lambda x: x <> '')) END AS words
      FROM (SELECT conv_id, s, unnest(range(len(s) + 1)) AS d FROM b)),
n AS (SELECT d, k, min(conv_id) AS conv_id, count(*) AS n, (count(*) - 1) * max(words) AS saves,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS sha FROM p GROUP BY d, k),
j AS (SELECT d - 1 AS d, k[1:d - 1] AS k, count(*) AS n FROM n WHERE d > 0 GROUP BY 1, 2),
v AS (SELECT n.*, coalesce(j.n, 0) AS children FROM n LEFT JOIN j ON j.d = n.d AND j.k = n.k),
u AS (SELECT d, k, sum(saves)::BIGINT AS saved, sum(leaf)::BIGINT AS leaves
      FROM (SELECT saves, (children = 0)::INTEGER AS leaf, i AS d, k[1:i] AS k FROM (SELECT *, unnest(range(d + 1)) AS i FROM v)) GROUP BY 1, 2)
SELECT v.conv_id, v.d AS depth, up.conv_id AS parent_conv_id, v.n AS n_convs, v.children AS n_children,
       u.leaves AS n_leaves, u.saved AS saved_tokens, v.sha AS ends_sha256
FROM v JOIN u ON u.d = v.d AND u.k = v.k LEFT JOIN n up ON up.d = v.d - 1 AND up.k = v.k[1:v.d - 1]
"""

SQL["op13_jaccard"] = _CLASSES.format(80, "")
