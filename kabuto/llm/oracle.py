"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

OP7 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS t FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok', 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok', 'assistant', '<|im_end|><|im_start|>assistant ok'
), shown AS (
  SELECT *, replace(regexp_replace(role, '<(\\*)\|', '<\\\1|', 'g'), chr(10), '<|nl|>') AS shown_role,
         regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') AS shown_text
  FROM turns
), said AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, t NULLS FIRST) AS turns,
         coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, t NULLS FIRST) FILTER (role = 'assistant'), '') AS loss,
         sum(length('<|im_start|>') + length(shown_role) + 1 + length(shown_text) + length('<|im_end|>') + 1) AS formatted_chars
  FROM shown GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
       CAST(formatted_chars AS BIGINT) AS formatted_chars
FROM said
"""


OP3 = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, least(len(ws), 13) AS size, array_to_string(ws[k : k + least(len(ws), 13) - 1], ' ') AS phrase
  FROM b, unnest(range(1, len(ws) - least(len(ws), 13) + 2)) AS t(k) WHERE len(ws) > 0
), sizes AS (SELECT DISTINCT size FROM windows),
grams AS (
  SELECT doc_id, size, k, array_to_string(ws[k : k + size - 1], ' ') AS phrase
  FROM w, sizes, unnest(range(1, len(ws) - size + 2)) AS t(k) WHERE len(ws) >= size
), found AS (SELECT doc_id, item_id, k, grams.size AS size FROM grams JOIN windows USING (size, phrase)),
hits AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + size)) AS p FROM found) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM found) GROUP BY doc_id
)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM w LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP8 = r"""
WITH RECURSIVE v AS (
  SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS e FROM embeddings
), good AS (
  SELECT * FROM v WHERE e IS NOT NULL AND len([x FOR x IN e IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN e IF x <> 0]) > 0
), links AS (
  SELECT a.rid AS a, b.rid AS b FROM good a JOIN good b ON a.rid <> b.rid AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.9
), reach AS (
  SELECT rid AS a, rid AS b FROM v UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), tops AS (SELECT reach.a AS rid, min(vec_id) AS component_id FROM reach JOIN v ON v.rid = reach.b GROUP BY reach.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = v.rid) AS n_links, component_id, vec_id IS NOT DISTINCT FROM component_id AS kept
FROM v JOIN tops USING (rid)
"""


OP10 = r"""
WITH RECURSIVE words AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT rid, hash(array_to_string(w[k : k + 4], ' ')) AS s
  FROM words, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS t(k)
), sizes AS (SELECT rid, count(*) AS n FROM shingles GROUP BY rid),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM shingles a JOIN shingles b ON a.s = b.s AND a.rid <> b.rid JOIN sizes x ON x.rid = a.rid JOIN sizes y ON y.rid = b.rid
  GROUP BY a.rid, b.rid, x.n, y.n HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
), reach AS (
  SELECT rid AS a, rid AS b FROM words UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
)
SELECT any_value(x.doc_id) AS doc_id, any_value(coalesce(n, 0)) AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN words x ON x.rid = reach.a JOIN words y ON y.rid = reach.b LEFT JOIN sizes ON sizes.rid = x.rid
GROUP BY reach.a
"""


OP12 = r"""
WITH RECURSIVE docs AS (
  SELECT *, row_number() OVER () AS rid,
    [CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(doc_id::VARCHAR) || ':' || doc_id END,
     CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
     CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END,
     CASE WHEN text IS NULL THEN '-' ELSE strlen(text) || ':' || text END] AS v,
    list_reduce(list_prepend(4294967295::BIGINT, [ord(c)::BIGINT FOR c IN string_split(doc_id::VARCHAR, '')]),
      lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)),
        lambda c, k: xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END))) AS crc
  FROM documents
), leaves AS (
  SELECT rid, doc_id, lang, sha256(v[1] || v[2] || v[3] || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || v[4]) AS leaf,
    CASE WHEN xor(crc, 4294967295) % 7 = 0 THEN n_chars::HUGEINT + 1 ELSE n_chars END AS m,
    sha256(v[1] || v[2] || v[3] || coalesce(strlen(m::VARCHAR) || ':' || m, '-') || v[4]) AS altered
  FROM docs
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf, rid) - 1 AS spot FROM leaves
), levels AS (
  SELECT lang, 0 AS level, list(leaf ORDER BY spot) AS nodes FROM placed GROUP BY lang
  UNION ALL
  SELECT lang, level + 1, [sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], '')) FOR k IN range((len(nodes) + 1) // 2)] FROM levels WHERE len(nodes) > 1
), subroots AS (
  SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS place FROM levels WHERE len(nodes) = 1
), top_levels AS (
  SELECT 0 AS level, list(subroot ORDER BY place) AS nodes FROM subroots
  UNION ALL
  SELECT level + 1, [sha256(nodes[2 * k + 1] || coalesce(nodes[2 * k + 2], '')) FOR k IN range((len(nodes) + 1) // 2)] FROM top_levels WHERE len(nodes) > 1
), ways AS (
  SELECT rid, 0 AS part, level, (spot >> level) % 2 AS side, coalesce(nodes[xor(spot >> level, 1) + 1], '') AS sibling
  FROM placed JOIN levels ON placed.lang IS NOT DISTINCT FROM levels.lang WHERE len(nodes) > 1
  UNION ALL
  SELECT rid, 1, level, (place >> level) % 2, coalesce(nodes[xor(place >> level, 1) + 1], '')
  FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang, top_levels WHERE len(nodes) > 1
), way AS (
  SELECT rid, string_agg(sibling, '' ORDER BY part, level) AS proof, list({'side': side, 'h': sibling} ORDER BY part, level) AS steps FROM ways GROUP BY rid
), folded AS (
  SELECT placed.*, subroot, (SELECT nodes[1] FROM top_levels WHERE len(nodes) = 1) AS root, sha256(coalesce(proof, '')) AS proof_sha256,
    list_reduce(list_prepend({'side': 0::BIGINT, 'h': altered}, coalesce(steps, [])),
      lambda a, s: {'side': s.side, 'h': sha256(CASE WHEN s.side = 0 THEN a.h || s.h ELSE s.h || a.h END)}).h AS folded_root
  FROM placed JOIN subroots ON placed.lang IS NOT DISTINCT FROM subroots.lang LEFT JOIN way USING (rid)
)
SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root AS verified FROM folded
"""


OP13 = r"""
WITH rows AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor(256 * x::DOUBLE) FOR x IN embedding] AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT a.rid, a.vec_id AS anchor_id, b.rid AS other, b.vec_id, a.label = b.label AS same, list_dot_product(a.q, b.q)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND len(a.q) = len(b.q)
), positives AS (
  SELECT rid, anchor_id, other, vec_id AS positive_id, score AS positive_score FROM scored WHERE same AND other <> rid
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id, other) <= 5
)
SELECT p.anchor_id, positive_id, row_number() OVER (PARTITION BY p.rid, p.other ORDER BY score DESC, vec_id, s.other)::INT AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives p JOIN scored s ON p.rid = s.rid AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_benchmark_decontamination": OP3,
        "op7_chat_formatting": OP7,
        "op8_embedding_near_dedup": OP8,
        "op10_ngram_jaccard_join": OP10,
        "op12_merkle_manifest": OP12,
        "op13_hard_negatives": OP13,
    }
