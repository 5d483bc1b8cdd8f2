"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_OP1 = """
WITH valid AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         coalesce(list_sum(list_transform(list_zip(q.v, c.v), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
  FROM valid q JOIN valid c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM scored
)
SELECT query_id, rank, vec_id, score FROM placed WHERE rank <= 5
"""

_OP2 = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null')), 1, 15))::BIGINT AS hash
  FROM documents
), totals AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighted AS (
  SELECT source, source_size,
         ([5, 2, 1])[(row_number() OVER (ORDER BY source IS NULL, source) - 1) % 3 + 1]::BIGINT AS weight
  FROM totals
), filled AS (
  SELECT *,
         (SELECT sum(source_size) FROM weighted) - coalesce(3 * sum(source_size) OVER before, 0) AS rest,
         (SELECT sum(weight) FROM weighted) - coalesce(sum(weight) OVER before, 0) AS share
  FROM weighted
  WINDOW before AS (ORDER BY source_size::DOUBLE / weight, source IS NULL, source
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT rest, share FROM filled WHERE rest * weight <= 3 * source_size * share
  ORDER BY source_size::DOUBLE / weight, source IS NULL, source LIMIT 1
), targets AS (
  SELECT w.source, w.source_size,
         CASE WHEN l.rest * w.weight > 3 * w.source_size * l.share THEN (3 * w.source_size)::DOUBLE
              ELSE (w.weight * l.rest)::DOUBLE / l.share::DOUBLE END AS target
  FROM weighted w, level l
), plans AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS times FROM targets
), budgets AS (
  SELECT *, greatest(0, floor(target - times * source_size))::BIGINT AS budget FROM plans
), placed AS (
  SELECT s.*, b.source_size, b.target, b.times, b.budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.hash RANGE UNBOUNDED PRECEDING) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.hash) AS together
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source
)
SELECT doc_id, source, size, source_size, target,
       (size * (times + CASE WHEN budget > 0 AND upto - together <= budget
          AND (upto <= budget OR upto - budget < budget - (upto - together)) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM placed
"""

_OP3 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents WHERE text IS NOT NULL
), placed AS (
  SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_start FROM lines
), cut AS (
  SELECT *, string_split(regexp_replace(line, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS pieces FROM placed
), units AS (
  SELECT doc_id, line_no, line_start, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS piece_no FROM cut
), found AS (
  SELECT doc_id, piece,
         line_start + coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id, line_no ORDER BY piece_no
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS unit_start,
         trim(regexp_replace(lower(piece), '[ \t\r\x0b\x0c]+', ' ', 'g')) AS plain
  FROM units
), long_units AS (
  SELECT *, first_value(struct_pack(d := doc_id, s := unit_start)) OVER (PARTITION BY plain ORDER BY doc_id, unit_start) AS kept
  FROM found WHERE len(string_split(plain, ' ')) >= 8
)
SELECT doc_id, unit_start::INTEGER AS unit_start, (unit_start + length(piece))::INTEGER AS unit_end,
       kept.d AS kept_doc_id, kept.s::INTEGER AS kept_start
FROM long_units WHERE NOT (doc_id = kept.d AND unit_start = kept.s)
"""

_OP3_PASSAGES = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents WHERE text IS NOT NULL AND text <> ''
), placed AS (
  SELECT *, coalesce(sum(length(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS line_start,
         trim(regexp_replace(line, '[ \t\r\x0b\x0c]+', ' ', 'g')) <> '' AS full_line FROM lines
), cut AS (
  SELECT *, string_split(regexp_replace(line, '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS parts FROM placed WHERE full_line
), pieces AS (
  SELECT doc_id, line_no, line_start, unnest(parts) AS piece, generate_subscripts(parts, 1) AS n FROM cut
), counted AS (
  SELECT *, CASE WHEN plain = '' THEN 0 ELSE len(string_split(plain, ' ')) END AS words,
         line_start + coalesce(sum(length(piece) + 1) OVER (PARTITION BY doc_id, line_no ORDER BY n
           ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS a
  FROM (SELECT *, trim(regexp_replace(piece, '[ \t\r\x0b\x0c]+', ' ', 'g')) AS plain FROM pieces)
), summed AS (
  SELECT *, a + length(piece) AS b, sum(words) OVER (PARTITION BY doc_id, line_no ORDER BY n) AS upto,
         sum(words) OVER (PARTITION BY doc_id, line_no) AS total, max(n) OVER (PARTITION BY doc_id, line_no) AS last_n FROM counted
), reach AS (
  SELECT i.doc_id, i.line_no, i.n, min(j.n) FILTER (WHERE j.n >= i.n AND j.upto - i.upto + i.words >= 8) AS forth,
         max(j.n) FILTER (WHERE j.n <= i.n AND j.total - j.upto + j.words >= 8) AS back, any_value(i.last_n) AS last_n
  FROM summed i JOIN summed j ON i.doc_id = j.doc_id AND i.line_no = j.line_no GROUP BY ALL
), spans AS (
  SELECT r.doc_id, f.a, l.b FROM reach r
  JOIN summed f ON f.doc_id = r.doc_id AND f.line_no = r.line_no AND f.n = CASE WHEN r.forth IS NULL THEN r.back ELSE r.n END
  JOIN summed l ON l.doc_id = r.doc_id AND l.line_no = r.line_no AND l.n = coalesce(r.forth, r.last_n)
  UNION
  SELECT doc_id, line_start, line_start + length(line) FROM placed WHERE full_line
  UNION
  SELECT doc_id, min(line_start), max(line_start + length(line))
  FROM (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS island FROM placed WHERE full_line)
  GROUP BY doc_id, island
), units AS (
  SELECT s.doc_id, s.a, s.b, trim(regexp_replace(lower(substr(d.text, s.a::BIGINT + 1, (s.b - s.a)::BIGINT)), '[ \t\r\n\x0b\x0c]+', ' ', 'g')) AS plain
  FROM spans s JOIN documents d USING (doc_id)
), ranked AS (
  SELECT *, first_value(struct_pack(d := doc_id, s := a)) OVER (PARTITION BY plain ORDER BY doc_id, a) AS kept FROM units
)
SELECT doc_id, a::INTEGER AS unit_start, b::INTEGER AS unit_end, kept.d AS kept_doc_id, kept.s::INTEGER AS kept_start
FROM ranked WHERE NOT (doc_id = kept.d AND a = kept.s)
"""

_OP7 = r"""
WITH lines AS (
  SELECT doc_id, lower(trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13) || chr(11) || chr(12))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL
), seqs AS (
  SELECT doc_id, line, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) - 1 AS seq
  FROM lines WHERE line <> ''
), pairs AS (
  SELECT *, lead(line) OVER (PARTITION BY doc_id ORDER BY seq) AS next FROM seqs
), copies AS (
  SELECT doc_id, seq FROM (
    SELECT *, row_number() OVER (PARTITION BY line, next ORDER BY doc_id, seq) AS k FROM pairs WHERE next IS NOT NULL
  ) WHERE k > 1
), deleted AS (
  SELECT DISTINCT doc_id, seq FROM (SELECT doc_id, seq FROM copies UNION ALL SELECT doc_id, seq + 1 FROM copies)
), islands AS (
  SELECT doc_id, seq, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM deleted
)
SELECT doc_id, min(s.line_no)::INTEGER AS first_line, max(s.line_no)::INTEGER AS last_line, count(*)::INTEGER AS n_lines
FROM islands JOIN seqs s USING (doc_id, seq) GROUP BY doc_id, island
"""

_OP7_ALL = r"""
WITH lines AS (
  SELECT doc_id, lower(trim(unnest(string_split(text, chr(10))), ' ' || chr(9) || chr(13) || chr(11) || chr(12))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS line_no
  FROM documents WHERE text IS NOT NULL
), seqs AS (
  SELECT doc_id, line_no, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS seq,
         row_number() OVER (PARTITION BY line ORDER BY doc_id, line_no) AS k
  FROM lines WHERE line <> ''
), islands AS (
  SELECT doc_id, line_no, seq - row_number() OVER (PARTITION BY doc_id ORDER BY seq) AS island FROM seqs WHERE k > 1
)
SELECT doc_id, min(line_no)::INTEGER AS first_line, max(line_no)::INTEGER AS last_line, count(*)::INTEGER AS n_lines
FROM islands GROUP BY doc_id, island
"""

_OP8 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(list_transform(range(1, greatest(len(w) - 3, 1) + 1), lambda i: array_to_string(w[i:i+3], ' '))) AS s
  FROM words WHERE len(w) > 0
), sizes AS (
  SELECT d.doc_id, coalesce(len(s), 0)::BIGINT AS n FROM documents d LEFT JOIN sets USING (doc_id)
), items AS (
  SELECT doc_id, hash(unnest(s)) AS h FROM sets
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS common
  FROM items a JOIN items b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared o JOIN sizes a ON a.doc_id = x JOIN sizes b ON b.doc_id = y
  WHERE 100 * common >= 85 * (a.n + b.n - common)
), edges AS (
  SELECT x AS u, y AS v FROM links UNION ALL SELECT y, x FROM links
), reach AS (
  SELECT DISTINCT u AS doc_id, u AS r FROM edges
  UNION
  SELECT e.v, reach.r FROM reach JOIN edges e ON e.u = reach.doc_id WHERE e.v > reach.r
)
SELECT z.doc_id, z.n AS n_shingles, coalesce(m.c, z.doc_id) AS component_id
FROM sizes z LEFT JOIN (SELECT doc_id, min(r) AS c FROM reach GROUP BY doc_id) m USING (doc_id)
"""

_OP10 = r"""
WITH parsed AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), rules(h, p, verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'),
         ('net', '/es/', 'block'), ('net', '/fr/', 'block')
)
SELECT page_id, host, path,
       (SELECT h || p FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        ORDER BY length(h) + length(p) DESC LIMIT 1) AS rule,
       coalesce((SELECT verdict FROM rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
        ORDER BY length(h) + length(p) DESC LIMIT 1), 'allow') AS verdict
FROM parsed
"""

# CRC-32 of the id's decimal text, bit by bit.
_OP11 = r"""
WITH ids AS (
  SELECT DISTINCT conv_id AS c, conv_id - conv_id % 5 AS base,
         list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ord(substr(conv_id::VARCHAR, i, 1))::BIGINT) AS codes
  FROM conversations WHERE conv_id IS NOT NULL
), heads AS (
  SELECT c, base, xor(list_reduce(list_prepend(4294967295::BIGINT, codes), lambda crc, b: list_reduce(
           list_prepend(xor(crc, b), range(8)),
           lambda x, i: xor(x >> 1, CASE WHEN x % 2 = 1 THEN 3988292384 ELSE 0 END)::BIGINT)), 4294967295::BIGINT) % 9 AS h
  FROM ids
), turns AS (
  SELECT conv_id AS c, coalesce("role", '') AS who, coalesce("text", '') AS said,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
           md5(length(coalesce("role", '')) || ':' || coalesce("role", '') || coalesce("text", ''))) - 1 AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), rebuilt AS (
  SELECT h.c, 0 AS part, t.pos, t.who, t.said FROM heads h JOIN turns t ON t.c = h.base WHERE t.pos < h.h
  UNION ALL
  SELECT h.c, 1, t.pos, t.who, t.said FROM heads h JOIN turns t ON t.c = h.c WHERE t.pos >= h.h
), numbered AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY part, pos) AS depth, said, md5(length(who) || ':' || who || said) AS item FROM rebuilt
), paths AS (
  SELECT c, depth, strlen(said) AS bytes,
         string_agg(item, '') OVER (PARTITION BY c ORDER BY depth ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS path
  FROM numbered
  UNION ALL SELECT c, 0, 0, '' FROM heads
), ends AS (
  SELECT path, sha256(string_agg(c::VARCHAR, ',' ORDER BY c)) AS digest
  FROM (SELECT c, arg_max(path, depth) AS path FROM paths GROUP BY c) GROUP BY path
), nodes AS (
  SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
         left(path, 32 * (depth::INTEGER - 1)) AS up FROM paths GROUP BY path, depth
), kids AS (
  SELECT up, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY up
), sums AS (
  SELECT a.path, sum((k.n IS NULL)::BIGINT)::BIGINT AS leaves, sum(b.saved)::BIGINT AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS at FROM nodes) b
  JOIN nodes a ON a.path = left(b.path, 32 * b.at::INTEGER) LEFT JOIN kids k ON k.up = b.path GROUP BY a.path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(k.n, 0) AS n_children,
       s.leaves AS n_leaves, s.saved AS saved_tokens, coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes n JOIN sums s USING (path) LEFT JOIN kids k ON k.up = n.path
LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.up LEFT JOIN ends e ON e.path = n.path
"""

_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counted AS (
  SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM words, (SELECT unnest([1, 2, 3, 4]) AS size))
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(f)::BIGINT AS n FROM counted WHERE size = 1 GROUP BY lang
), candidates AS (
  SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM counted WHERE size > 1 AND f >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.a, c.k, l.f AS l, r.f AS r, ((2000000::HUGEINT * c.a) // (l.f + r.f))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, size)) AS k FROM candidates) c
  JOIN counted l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
  JOIN counted r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')
), best AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inside AS (
  SELECT DISTINCT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, a
  FROM (SELECT *, unnest(range(1, size - s + 2)) AS i FROM (SELECT *, unnest(range(2, size)) AS s FROM candidates))
), placed AS (
  SELECT b.*, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
  FROM best b
  WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = b.lang AND i.phrase = b.phrase AND 100 * i.a::HUGEINT >= 80 * b.a::HUGEINT)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM placed JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLES = {
    "op1_mtree_top_k": _OP1,
    "op2_hash_threshold_mix": _OP2,
    "op3_line_hashing": _OP3,
    "op3_passage_hashing": _OP3_PASSAGES,
    "op7_all_repeated_lines": _OP7_ALL,
    "op7_suffix_runs": _OP7,
    "op8_signature_trees": _OP8,
    "op10_url_rules": _OP10,
    "op11_prefix_trie": _OP11,
    "op12_phrases": _OP12,
}
