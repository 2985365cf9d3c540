"""DuckDB SQL of those training-data queries that SQL can express."""

from __future__ import annotations

from reelmart.llm.queries import CONTROL_TURNS

CHAT = f"""
WITH control(conv_id, turn, role, text) AS (VALUES {", ".join(f"({c}, {t}, '{r}', '{x}')" for c, t, r, x in CONTROL_TURNS)}),
spoken AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, role AS r, text AS x
    FROM (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT * FROM control)),
whole AS (
    SELECT conv_id, count(*) AS n_turns,
        string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, r NULLS FIRST, x NULLS FIRST) AS said,
        coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, x NULLS FIRST) FILTER (role = 'assistant'), '') AS learnt,
        sum(length(regexp_replace(text, '[~<\\[\\]]', 'xx', 'g')) + length(regexp_replace(role, '[~<\\[\\]]', 'xx', 'g')) + 10) AS chars
    FROM spoken GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(learnt) AS loss_chars, sha256(learnt) AS loss_sha256,
    CAST(chars AS BIGINT) AS formatted_chars
FROM whole
"""


EMBEDDINGS = """
WITH RECURSIVE fit AS (
    SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
links AS (
    SELECT a.r AS a, b.r AS b FROM fit a JOIN fit b ON a.label = b.label AND a.r <> b.r AND len(a.v) = len(b.v)
    WHERE list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
    SELECT r AS a, r AS b FROM fit UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
found AS (
    SELECT fit.r, fit.vec_id, (SELECT count(*) FROM links WHERE links.a = fit.r) AS n_links,
        (SELECT min(f.vec_id) FROM reach JOIN fit f ON f.r = reach.b WHERE reach.a = fit.r) AS component_id FROM fit),
rest AS (
    SELECT vec_id, 0 AS n_links, vec_id AS component_id FROM embeddings
    WHERE NOT coalesce(label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0, false))
SELECT vec_id, n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM (SELECT vec_id, n_links, component_id FROM found UNION ALL SELECT * FROM rest)
"""


# Shingles are lists of three words; a text of fewer words is one list of them all.
JACCARD = """
WITH RECURSIVE worded AS (
    SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
sets AS (
    SELECT r, doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 3 THEN [words]
        ELSE list_distinct(list_transform(range(1, len(words) - 1), lambda i: words[i : i + 2])) END AS shingles FROM worded),
sized AS (SELECT r, doc_id, len(shingles) AS n FROM sets),
single AS (SELECT r, unnest(shingles) AS shingle FROM sets),
together AS (
    SELECT x.r AS a, y.r AS b, count(*) AS shared FROM single x JOIN single y ON x.shingle = y.shingle AND x.r <> y.r GROUP BY ALL),
links AS (
    SELECT a, b FROM together JOIN sized p ON p.r = a JOIN sized q ON q.r = b WHERE 100 * shared >= 90 * (p.n + q.n - shared)),
reach AS (SELECT r AS a, r AS b FROM sized UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT reach.a AS r, min(sized.doc_id) AS component_id FROM reach JOIN sized ON sized.r = reach.b GROUP BY ALL)
SELECT doc_id, n AS n_shingles, coalesce(component_id, doc_id) AS component_id FROM sized JOIN least USING (r)
"""


# CRC-32 of a decimal id from its table of 256 values, made by rule; nodes are lists of turns.
TRIE = """
WITH RECURSIVE crc AS (
    SELECT list_transform(range(256), lambda i: list_reduce(range(8), lambda c, s: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)) AS t),
turns AS (
    SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos,
        {'r': coalesce(role, ''), 'x': coalesce(text, '')} AS said
    FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
    SELECT conv_id, own, conv_id - conv_id % 20 AS base,
        xor(4294967295, list_reduce(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda s: CAST(ascii(s) AS BIGINT)),
            lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295)) % 4 AS h
    FROM (SELECT conv_id, list(said ORDER BY pos) AS own FROM turns GROUP BY conv_id), crc),
rebuilt AS (
    SELECT c.conv_id, list_concat(coalesce(b.own[1 : c.h], []), c.own[c.h + 1 :]) AS path FROM convs c LEFT JOIN convs b ON b.conv_id = c.base),
places AS (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS depth FROM rebuilt),
nodes AS (
    SELECT path[1 : depth] AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(path) = depth), '')) AS ends_sha256
    FROM places GROUP BY 1, 2),
valued AS (
    SELECT *, node[1 : depth - 1] AS parent, (n_convs - 1) * CASE WHEN depth = 0 THEN 0
        ELSE len(regexp_extract_all(node[depth].x, '[^\\x20\\x09-\\x0D]+')) END AS tokens FROM nodes),
family AS (SELECT parent AS node, count(*) AS n FROM valued WHERE depth > 0 GROUP BY 1),
above AS (SELECT v.node[1 : d] AS node, (f.n IS NULL) AS leaf, tokens
    FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM valued) v LEFT JOIN family f ON f.node = v.node),
totals AS (SELECT node, count(*) FILTER (leaf) AS n_leaves, CAST(sum(tokens) AS BIGINT) AS saved_tokens FROM above GROUP BY 1)
SELECT v.conv_id, v.depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(f.n, 0) AS n_children, n_leaves, saved_tokens, v.ends_sha256
FROM valued v JOIN totals USING (node) LEFT JOIN family f ON f.node = v.node LEFT JOIN nodes p ON v.depth > 0 AND p.node = v.parent
"""


RANKED = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS terms FROM documents),
total AS (SELECT count(*) FILTER (len(terms) > 0) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS n_terms FROM docs),
held AS (SELECT r, unnest(terms) AS term FROM docs),
counted AS (SELECT r, term, count(*) AS tf FROM held GROUP BY ALL),
spread AS (SELECT term, count(*) AS df FROM counted GROUP BY ALL),
items AS (
    SELECT row_number() OVER () AS i, item_id, list_distinct(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS terms FROM benchmark),
asked AS (SELECT i, item_id, unnest(terms) AS term FROM items),
weighed AS (
    SELECT i, item_id, term, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
    FROM asked JOIN spread USING (term), total),
sized AS (SELECT r, doc_id, 10 + (90 * len(terms) * n_docs) // n_terms AS m FROM docs, total),
scores AS (
    SELECT i, item_id, r, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
    FROM weighed JOIN counted USING (term) JOIN sized USING (r) GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scores WHERE score > 0)
WHERE rank <= 10
"""


MATCHES = """
WITH fit AS (
    SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
scores AS (
    SELECT q.r AS r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
    FROM fit q JOIN fit c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scores)
WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": CHAT,
        "op2_pstable_embedding_dedup": EMBEDDINGS,
        "op3_ngram_jaccard_join": JACCARD,
        "op11_prefix_trie": TRIE,
        "op12_ranked_lexical_search": RANKED,
        "op13_exact_top_matches": MATCHES,
    }
