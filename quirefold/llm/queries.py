"""The queries of this subpackage and their SQL, as ``__spark_entry__`` adds them."""

from __future__ import annotations

import importlib

#: Query name: (module, function).
MODULES = {
    "op1_bpe": "bpe",
    "op2_ogg": "ogg",
    "op3_packing": "packing",
    "op4_toxicity": "toxicity",
    "op5_quality": "quality",
    "op6_simhash": "simhash",
    "op7_langid": "langid",
    "op8_warc": "warc",
    "op9_topk": "topk",
    "op10_pitman_yor": "pitman_yor",
    "op11_importance": "resampling",
    "op12_similar": "tokengroups",
    "op13_spelling": "spelling",
}


def queries() -> dict:
    return {name: getattr(importlib.import_module(f"{__package__}.{module}"), name) for name, module in MODULES.items()}


#: CRC-32 in SQL: its table by the polynomial's rule (t.steps), and the unsigned checksum of text ``x``.
_CRC_TABLE = "SELECT list_transform(range(256), lambda x: list_reduce([x] || range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS steps"
_CRC = "xor(list_reduce([4294967295] || list_transform(range(octet_length(encode({x}))), lambda i: CAST('0x' || substr(hex(encode({x})), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT)), lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: What SQL can express; the others are tested against brute force, libraries or held-out labels.
ORACLE = {
    "op8_warc": """WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
m AS (SELECT h, max(page_id) AS best FROM p WHERE octet_length(encode(h)) >= 1000 GROUP BY h)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
CASE WHEN best <> page_id THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN best <> page_id THEN best END AS refers_to FROM p LEFT JOIN m USING (h)""",
    "op9_topk": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0),
r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5""",
    "op12_similar": rf"""WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 3 THEN list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2]) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] END) AS sh FROM d),
c AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS o FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM o JOIN c p ON a = p.doc_id JOIN c q ON b = q.doc_id WHERE 100 * o >= 90 * (p.n + q.n - o)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id, doc_id AS near FROM d UNION SELECT r.doc_id, b FROM r JOIN e ON a = near)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id FROM (SELECT doc_id, min(near) AS component_id FROM r GROUP BY doc_id) LEFT JOIN c USING (doc_id)""",
    "op13_spelling": rf"""WITH RECURSIVE t AS ({_CRC_TABLE}),
r AS (SELECT doc_id, w, count(*) AS n FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents) GROUP BY ALL),
k AS (SELECT w, n, {_CRC.format(x="(doc_id || ':' || w)")} AS h FROM r, t),
c AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, CAST(h % length(w) AS BIGINT)) || substr(w, CAST(h % length(w) AS BIGINT) + 2) ELSE w END AS word, n FROM k),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM c WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
p AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
m AS (SELECT word, n, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM p),
e AS (SELECT x.word, x.n, y.word AS near, y.n AS near_n FROM m x JOIN m y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
UNION SELECT m.word, m.n, v.word, v.n FROM m JOIN v ON v.word = m.a || m.b UNION SELECT v.word, v.n, m.word, m.n FROM m JOIN v ON v.word = m.a || m.b),
g AS (SELECT word, count(*) AS n_near, max(near_n) AS top FROM e GROUP BY word),
f AS (SELECT word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN top >= 2 * v.n THEN top END AS form_n FROM v LEFT JOIN g USING (word)),
o AS (SELECT f.*, (SELECT min(near) FROM e WHERE e.word = f.word AND e.near_n = f.form_n) AS form FROM f),
s AS (SELECT word, word AS root, 0 AS d FROM o UNION ALL SELECT s.word, o.form, d + 1 FROM s JOIN o ON o.word = s.root WHERE o.form IS NOT NULL)
SELECT o.word, form, root, n, n_near, form_n FROM o JOIN (SELECT word, max_by(root, d) AS root FROM s GROUP BY word) USING (word)""",
    "op11_importance": rf"""WITH t AS ({_CRC_TABLE}),
d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
b AS (SELECT unnest(regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM benchmark),
f AS (SELECT doc_id, unnest(ws) AS w FROM d),
h AS (SELECT w, {_CRC.format(x="w")} % 10000 AS bucket FROM (SELECT w FROM f UNION SELECT w FROM b), t),
s AS (SELECT bucket, count(*) AS s FROM f JOIN h USING (w) GROUP BY bucket), c AS (SELECT bucket, count(*) AS t FROM b JOIN h USING (w) GROUP BY bucket),
g AS (SELECT bucket, CAST(floor(1000 * ln(CAST((coalesce(t, 0) + 1) * ((SELECT count(*) FROM f) + 10000) AS DOUBLE) / CAST((coalesce(s, 0) + 1) * ((SELECT count(*) FROM b) + 10000) AS DOUBLE))) AS BIGINT) AS gain FROM s FULL JOIN c USING (bucket)),
w AS (SELECT doc_id, CAST(sum(gain) AS BIGINT) AS weight FROM f JOIN h USING (w) JOIN g USING (bucket) GROUP BY doc_id),
v AS (SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight, CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS h FROM d LEFT JOIN w USING (doc_id)),
x AS (SELECT doc_id, n_features, weight, weight + CAST(floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS BIGINT) AS score FROM v),
r AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k FROM x WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CAST(k AS BIGINT) AS rank FROM x LEFT JOIN (SELECT doc_id, k FROM r WHERE k <= 10 * (SELECT count(*) FROM x WHERE n_features >= 20) // 100) USING (doc_id)""",
}


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
