"""DuckDB SQL of the queries of queries.py that SQL can express over whole tables."""

from __future__ import annotations

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'
), escaped AS (
  SELECT *, length(replace(replace(replace(role, '\', '\s'), '<|', '<\p'), chr(10), '\n')) AS role_chars,
    length(replace(replace(text, '\', '\s'), '<|', '<\p')) AS text_chars FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(24 + role_chars + text_chars) AS BIGINT) AS formatted_chars
FROM escaped GROUP BY conv_id
"""

_URL = r"""
WITH RECURSIVE rules(verdict, host, path) AS (
  VALUES ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'), ('block', 'net', '/es/'), ('block', 'net', '/fr/')
), rest AS (
  SELECT page_id, html, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r FROM pages
), raw_parts AS (
  SELECT page_id, html,
    translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path,
    regexp_extract(r, '^[^/?#]*([^#]*)', 1) AS tail, row_number() OVER () AS row
  FROM rest
), parts AS (
  SELECT *, host || CASE WHEN starts_with(tail, '/') THEN tail ELSE '/' || tail END AS node, CASE WHEN path = '' THEN '/' ELSE path END AS page FROM raw_parts
), named AS (
  SELECT host, path, node, page AS page_path, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(html, '<link\b[^>]*>', 0, 'is'), lambda x: regexp_matches(x, '\brel\s*=\s*["'']?canonical\b', 'is')),
      lambda x: regexp_extract(x, '\shref\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'is')),
    list_transform(list_filter(regexp_extract_all(html, '<meta\b[^>]*>', 0, 'is'), lambda x: regexp_matches(x, '\bhttp-equiv\s*=\s*["'']?refresh\b', 'is')),
      lambda x: regexp_extract(x, '\burl\s*=\s*["'']?\s*([^"''\s>]+)', 1, 'is')))) AS link
  FROM parts WHERE host <> ''
), links AS (
  SELECT node AS src, CASE WHEN link LIKE '%://%' THEN regexp_extract(link, '^[A-Za-z][A-Za-z0-9+.-]*://(.*)$', 1, 's') WHEN starts_with(link, '//') THEN substr(link, 3)
    WHEN starts_with(link, '/') THEN host || link WHEN starts_with(link, '?') THEN host || page_path || link WHEN starts_with(link, '#') THEN ''
    ELSE host || regexp_extract(page_path, '^(.*/)', 1, 's') || replace(link, '&amp;', '&') END AS target FROM named WHERE link <> ''
), cut AS (
  SELECT src, translate(regexp_extract(target, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h, regexp_extract(target, '^[^/?#]*([^#]*)', 1) AS t
  FROM links WHERE target <> ''
), ends AS (SELECT src, h || CASE WHEN starts_with(t, '/') THEN t ELSE '/' || t END AS dst FROM cut
), edges AS (SELECT src AS a, dst AS b FROM ends UNION SELECT dst, src FROM ends),
reach(a, b) AS (SELECT a, b FROM edges UNION SELECT reach.a, edges.b FROM reach JOIN edges ON reach.b = edges.a),
node_rules AS (
  SELECT node, (SELECT verdict FROM rules WHERE (h = rules.host OR suffix(h, '.' || rules.host)) AND starts_with(p, rules.path)
    ORDER BY length(rules.host || rules.path) DESC LIMIT 1) AS verdict
  FROM (SELECT DISTINCT a AS node, regexp_extract(a, '^[^/?]*') AS h, regexp_extract(a, '^[^/?]*([^?]*)', 1) AS p FROM edges)
), blocked AS (SELECT DISTINCT reach.a AS node FROM reach JOIN node_rules ON node_rules.node = reach.b WHERE verdict = 'block'),
ranked AS (
  SELECT parts.row, rules.host || rules.path AS rule, rules.verdict,
    row_number() OVER (PARTITION BY parts.row ORDER BY length(rules.host || rules.path) DESC) AS n
  FROM parts JOIN rules ON (parts.host = rules.host OR suffix(parts.host, '.' || rules.host)) AND starts_with(parts.path, rules.path)
)
SELECT page_id, host, path, rule,
  coalesce(verdict, CASE WHEN EXISTS (SELECT 1 FROM blocked WHERE blocked.node = parts.node) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts LEFT JOIN ranked ON ranked.row = parts.row AND n = 1
"""

_VECTORS = """
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
), sound AS (
  SELECT * FROM v WHERE label IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(e, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(v.vec_id) AS component_id FROM reach JOIN v ON v.r = reach.b GROUP BY 1),
counted AS (SELECT a AS r, count(*) AS n FROM links GROUP BY 1)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, component_id) AS component_id, vec_id = least(vec_id, component_id) AS kept
FROM v LEFT JOIN least USING (r) LEFT JOIN counted USING (r)
"""

_WORDS = r"""docs AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM documents
)"""

_SUBSTRINGS = f"""
WITH {_WORDS}, windows AS (
  SELECT r, i, md5(array_to_string(words[i:i + 34], ' ')) AS h FROM (SELECT r, words, unnest(generate_series(1, len(words) - 34)) AS i FROM docs)
), repeated AS (
  SELECT r, i FROM windows WHERE h IN (SELECT h FROM windows GROUP BY h HAVING count(*) > 1)
), spelled AS (
  SELECT r, unnest(words) AS word, unnest(generate_series(1, len(words))) AS i FROM docs
), marked AS (
  SELECT s.r, s.word, s.i, max(w.i) OVER (PARTITION BY s.r ORDER BY s.i ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) IS NOT NULL AS gone
  FROM spelled s LEFT JOIN repeated w ON w.r = s.r AND w.i = s.i
), kept AS (
  SELECT r, count(*) FILTER (gone) AS n_removed, string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS text FROM marked GROUP BY r
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (r)
"""

_NEAR = f"""
WITH RECURSIVE {_WORDS}, shingles AS (
  SELECT DISTINCT r, md5(array_to_string(words[i:i + 4], ' ')) AS h
  FROM (SELECT r, words, unnest(generate_series(1, greatest(1, len(words) - 4))) AS i FROM docs WHERE len(words) > 0)
), sizes AS (SELECT r, count(*) AS n FROM shingles GROUP BY r),
common AS (SELECT a.r AS a, b.r AS b, count(*) AS c FROM shingles a JOIN shingles b ON a.h = b.h AND a.r <> b.r GROUP BY 1, 2),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.r = a JOIN sizes y ON y.r = b WHERE c >= 0.8 * (x.n + y.n - c)
), reach(a, b) AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(docs.doc_id) AS class_id FROM reach JOIN docs ON docs.r = reach.b GROUP BY 1)
SELECT doc_id, least(doc_id, class_id) AS class_id, doc_id = least(doc_id, class_id) AS kept FROM docs LEFT JOIN least USING (r)
"""

_TOP_K = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(CAST(q.e AS DOUBLE[]), CAST(c.e AS DOUBLE[])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0
), ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS n FROM scored)
SELECT query_id, CAST(n AS INTEGER) AS rank, vec_id, score FROM ranked WHERE n <= 5
"""

_LEXICAL = r"""
WITH split AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS terms FROM documents
), asked AS (
  SELECT row_number() OVER () AS i, item_id, list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'), lambda x: x <> '') AS terms FROM benchmark
), totals AS (SELECT count(*) FILTER (len(terms) > 0) AS big_n, CAST(sum(len(terms)) AS BIGINT) AS big_l FROM split),
tfs AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM split) GROUP BY r, term),
weights AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tfs, totals GROUP BY term, big_n),
sizes AS (SELECT r, doc_id, 100 - 25 + ((25 * len(terms) * big_n) // big_l) AS m FROM split, totals WHERE len(terms) > 0),
wanted AS (SELECT i, item_id, term, count(*) AS repeats FROM (SELECT i, item_id, unnest(terms) AS term FROM asked) GROUP BY i, item_id, term),
scored AS (
  SELECT i, item_id, r, doc_id, CAST(sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
  FROM wanted JOIN tfs USING (term) JOIN weights USING (term) JOIN sizes USING (r) GROUP BY i, item_id, r, doc_id
), ranked AS (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS n FROM scored WHERE score > 0)
SELECT item_id, CAST(n AS INTEGER) AS rank, doc_id, score FROM ranked WHERE n <= 20
"""

_SPELLING = r"""
WITH RECURSIVE remainders AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, b: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) x(i))
), runs AS (
  SELECT run, hex(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run) AS x FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
), hashed AS (
  SELECT run, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
    list_transform(range(1, len(x), 2), lambda i: (strpos('0123456789ABCDEF', x[i]) - 1) * 16 + strpos('0123456789ABCDEF', x[i + 1]) - 1)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h FROM runs, remainders
), words AS (
  SELECT word, count(*) AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING count(*) >= 5
), spots AS (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words),
gaps AS (SELECT word, i, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM spots),
shorter AS (SELECT DISTINCT word, a || b AS other FROM gaps WHERE a || b IN (SELECT word FROM words)),
near AS (
  SELECT x.word, y.word AS other FROM gaps x JOIN gaps y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT word, other FROM shorter UNION SELECT other, word FROM shorter
), best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS most FROM near JOIN words o ON o.word = near.other GROUP BY near.word
), formed AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * w.n THEN most END AS form_n,
    (SELECT min(o.word) FROM near JOIN words o ON o.word = near.other WHERE near.word = w.word AND o.n = most AND most >= 5 * w.n) AS form
  FROM words w LEFT JOIN best USING (word)
), paths(word, place) AS (SELECT word, word FROM formed UNION SELECT paths.word, form FROM paths JOIN formed f ON f.word = paths.place WHERE form IS NOT NULL)
SELECT f.word, f.form, paths.place AS root, CAST(f.n AS BIGINT) AS n, CAST(f.n_near AS BIGINT) AS n_near, CAST(f.form_n AS BIGINT) AS form_n
FROM formed f JOIN paths USING (word) JOIN formed last ON last.word = paths.place WHERE last.form IS NULL
"""

ORACLES: dict[str, str] = {
    "op2_embedding_dedup": _VECTORS,
    "op3_chat_format": _CHAT,
    "op6_substring_dedup": _SUBSTRINGS,
    "op7_minhash_dedup": _NEAR,
    "op8_exact_topk": _TOP_K,
    "op10_url_filter": _URL,
    "op12_lexical_search": _LEXICAL,
    "op13_spelling_variants": _SPELLING,
}
