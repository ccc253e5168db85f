"""DuckDB SQL of the queries that SQL can express."""

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = f"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
  SELECT row_number() OVER () AS uid, page_id, {_LOWER.format("regexp_extract(rest, '^[^/?#]*')")} AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut
), rules(action, rhost, rpath) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fits AS (
  SELECT uid, rhost || rpath AS rule, action, row_number() OVER (PARTITION BY uid ORDER BY length(rhost || rpath) DESC) AS nth
  FROM parts JOIN rules ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT page_id, host, path, rule, coalesce(action, 'allow') AS verdict
FROM parts LEFT JOIN (SELECT * FROM fits WHERE nth = 1) USING (uid)
"""

#: Ids are unique in the table, so the place of a line is its document and number.
OP2 = rf"""
WITH l AS (SELECT doc_id, i, string_split(text, chr(10))[i] AS line FROM (SELECT doc_id, text, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS i FROM documents WHERE text IS NOT NULL)),
w AS (SELECT DISTINCT doc_id, i, unnest(regexp_extract_all({_LOWER.format('line')}, '[^\x20\x09-\x0D]+')) AS w FROM l),
s AS (SELECT doc_id, i, list(w ORDER BY w) AS ws, len(ws) AS n FROM w GROUP BY ALL),
k AS (SELECT ws, n, min((doc_id, i)) AS first, row_number() OVER () AS k FROM s GROUP BY ALL),
t AS (SELECT k, n, first, unnest(ws) AS w FROM k),
lost AS (SELECT DISTINCT k FROM (SELECT b.k FROM t a JOIN t b ON a.w = b.w AND a.first < b.first AND 5 * a.n >= 4 * b.n AND 5 * b.n >= 4 * a.n GROUP BY a.k, b.k, a.n, b.n HAVING 9 * count(*) >= 4 * (a.n + b.n))),
gone AS (SELECT s.doc_id, s.i FROM s JOIN k USING (ws) WHERE (s.doc_id, s.i) <> k.first OR k.k IN (SELECT k FROM lost))
SELECT d.doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(x.n, 0)::BIGINT AS n_removed, sha256(coalesce(x.body, d.text, '')) AS kept_sha256
FROM documents d LEFT JOIN (SELECT l.doc_id, count(g.i) AS n, coalesce(string_agg(l.line, chr(10) ORDER BY l.i) FILTER (g.i IS NULL), '') AS body FROM l LEFT JOIN gone g ON l.doc_id = g.doc_id AND l.i = g.i GROUP BY l.doc_id) x ON d.doc_id = x.doc_id
"""

OP3 = r"""
WITH rows AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '1' ELSE '0' || source END AS grp,
         md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || coalesce(text, '')) AS rkey,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
  FROM documents
), src AS (
  SELECT grp, sum(size)::BIGINT AS source_size, [3.0, 1.0, 2.0][((row_number() OVER (ORDER BY grp) - 1) % 3 + 1)::INT]::DOUBLE AS w FROM rows GROUP BY grp
), slope AS (
  SELECT *, source_size * 2.0::DOUBLE AS cap, 1.5::DOUBLE * sum(source_size) OVER () AS total,
         coalesce(sum(source_size * 2.0::DOUBLE) OVER (ORDER BY source_size / w, grp ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS before,
         sum(w) OVER (ORDER BY source_size / w, grp ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS after
  FROM src
), level AS (
  SELECT sum(cap) FILTER (cap < w * (total - before) / after) AS capped, sum(w) FILTER (NOT cap < w * (total - before) / after) AS open FROM slope
), goal AS (
  SELECT grp, source_size, CASE WHEN open IS NULL THEN cap ELSE least(cap, w * (total - coalesce(capped, 0.0)) / open) END AS target FROM slope, level
), plan AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM goal
), runs AS (
  SELECT doc_id, size, source_size, target, epochs, greatest(0, round(target)::BIGINT - epochs * source_size) AS rest,
         sum(size) OVER (PARTITION BY grp ORDER BY rkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS run
  FROM rows JOIN plan USING (grp)
)
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, rest - run + size)))::BIGINT AS taken
FROM runs
"""

OP4 = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT * FROM (VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]'))
), sized AS (
  SELECT *, length(role) + length(text) + length(role || text) - length(replace(role || text, '\', ''))
         + length(role) - length(replace(role, chr(10), ''))
         + len(regexp_extract_all(text, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>'))
         + len(regexp_extract_all(role, '<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>')) + 24 AS chars
  FROM rows
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

_PLAIN = r"regexp_extract_all({}, '[0-9a-z\x{{80}}-\x{{10FFFF}}]+')"
_DOC_WORDS = _PLAIN.format(_LOWER.format("coalesce(text, '')"))

OP5 = f"""
WITH docs AS (
  SELECT row_number() OVER () AS uid, doc_id, {_DOC_WORDS} AS words FROM documents
), bench AS (
  SELECT item_id::VARCHAR AS item, words, least(len(words), 8) AS n FROM (SELECT item_id, {_DOC_WORDS} AS words FROM benchmark WHERE item_id IS NOT NULL) WHERE len(words) > 0
), windows AS (
  SELECT DISTINCT item, n, array_to_string(words[i : i + n - 1], ' ') AS gram FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM bench)
), sizes AS (SELECT DISTINCT n FROM windows),
grams AS (
  SELECT uid, i, n, array_to_string(words[i : i + n - 1], ' ') AS gram FROM (SELECT uid, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM docs, sizes WHERE len(words) >= n)
), hits AS (
  SELECT uid, i, n, item FROM grams JOIN windows USING (n, gram)
), words_hit AS (
  SELECT uid, count(DISTINCT place) AS n_hit FROM (SELECT uid, unnest(range(i, i + n)) AS place FROM hits) GROUP BY uid
), items AS (
  SELECT uid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed FROM (SELECT DISTINCT uid, item FROM hits) GROUP BY uid
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_items, 0) >= 2 AS contaminated
FROM docs LEFT JOIN words_hit USING (uid) LEFT JOIN items USING (uid)
"""

_SPACED = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x20\x09-\x0D]+')"

OP6 = f"""
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS uid, doc_id, {_SPACED} AS words FROM documents
), shingles AS (
  SELECT DISTINCT uid, md5(array_to_string(words[i : i + n - 1], ' ')) AS s
  FROM (SELECT uid, words, least(len(words), 5) AS n, unnest(range(1, len(words) - least(len(words), 5) + 2)) AS i FROM docs WHERE len(words) > 0)
), sizes AS (
  SELECT uid, count(*) AS n FROM shingles GROUP BY uid
), shared AS (
  SELECT a.uid AS a, b.uid AS b, count(*) AS n FROM shingles a JOIN shingles b ON a.s = b.s AND a.uid < b.uid GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.uid = a JOIN sizes y ON y.uid = b WHERE 100 * shared.n >= 80 * (x.n + y.n - shared.n)
), both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach(a, b) AS (
  SELECT uid, uid FROM docs UNION SELECT reach.a, both_ways.b FROM reach JOIN both_ways ON reach.b = both_ways.a
)
SELECT docs.doc_id, coalesce(any_value(sizes.n), 0)::BIGINT AS n_shingles, min(other.doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (uid) JOIN reach ON reach.a = docs.uid JOIN docs other ON other.uid = reach.b GROUP BY docs.uid, docs.doc_id
"""

OP9 = f"""
SELECT doc_id, keep_id, group_size, nth = 1 AS kept, text_sha256 FROM (
  SELECT doc_id, text_sha256, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         row_number() OVER (PARTITION BY text_sha256 ORDER BY doc_id DESC NULLS LAST) AS nth
  FROM (SELECT doc_id, sha256({_LOWER.format("coalesce(text, '')")}) AS text_sha256 FROM documents)
)
"""

SQL = {
    "op1_url_filter": OP1,
    "op2_line_dedup": OP2,
    "op3_mix_sources": OP3,
    "op4_chat_format": OP4,
    "op5_decontaminate": OP5,
    "op6_ngram_jaccard": OP6,
    "op9_exact_dedup": OP9,
}
