"""DuckDB SQL for the registered queries of this package that SQL can express."""

from __future__ import annotations

LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

EXACT = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(content) AS text_sha256
FROM (SELECT doc_id, {LOWER.format("coalesce(text, '')")} AS content FROM documents)
WINDOW same AS (PARTITION BY content)
"""

LINES = f"""
WITH lines AS (
    SELECT doc_id, generate_subscripts(parts, 1) AS pos, unnest(parts) AS line
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents)
), keyed AS (
    SELECT *, {LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key
    FROM lines
), shared AS (
    SELECT key, max(doc_id) AS keep_id FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), judged AS (
    SELECT keyed.*, keep_id IS NOT NULL AND keep_id <> doc_id AS gone FROM keyed LEFT JOIN shared USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


# CRC-32 takes two steps a byte, low half first; a table row is the polynomial shifted four times.
def _crc_step(x: int) -> int:
    for _ in range(4):
        x = (x >> 1) ^ (0xEDB88320 if x & 1 else 0)
    return x


CRC_TABLE = ", ".join(f"{_crc_step(x)}::BIGINT" for x in range(16))
CRC32 = f"""xor(4294967295::BIGINT, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(range(2 * strlen({{0}})),
        lambda i: (instr('0123456789ABCDEF', substr(hex(encode({{0}})), (xor(i, 1) + 1)::BIGINT, 1)) - 1)::BIGINT)),
    lambda crc, half: xor(crc >> 4, [{CRC_TABLE}][(xor(crc, half) & 15) + 1])))"""

SHARDS = f"""
WITH dealt AS (
    SELECT doc_id, source, coalesce(text, '') AS t,
           md5('7:' || coalesce(doc_id::VARCHAR, '')) AS key FROM documents
), ranked AS (
    SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id) - 0.5::DOUBLE)
              / count(*) OVER (PARTITION BY source) AS part FROM dealt
), placed AS (
    SELECT *, row_number() OVER (ORDER BY part, source, key, doc_id) - 1 AS place, count(*) OVER () AS n FROM ranked
), cut AS (SELECT *, place * 40 // n AS s FROM placed)
SELECT doc_id, strlen(t)::BIGINT + 16 AS size, {CRC32.format("t")}::BIGINT AS text_crc32, 'rows' AS law,
       s::INT AS shard, place - (s * n + 39) // 40 AS slot, NULL::INT AS grown_shard
FROM cut
"""


WORDS = "regexp_extract_all({}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

DECONTAMINATION = f"""
WITH items AS (
    SELECT item_id::VARCHAR AS item_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM benchmark
), grams AS (
    SELECT item_id, least(len(w), 10) AS size,
           unnest(list_transform(range(greatest(len(w) - 9, 1)), lambda i: list_slice(w, i + 1, i + 10))) AS gram
    FROM items WHERE len(w) > 0
), docs AS (
    SELECT doc_id, {WORDS.format(LOWER.format("coalesce(text, '')"))} AS w FROM documents
), windows AS (
    SELECT doc_id, size, unnest(range(len(w) - size + 1)) AS pos, w
    FROM docs, (SELECT DISTINCT size FROM grams) WHERE len(w) >= size
), hits AS (
    SELECT doc_id, pos, size, item_id
    FROM (SELECT doc_id, pos, size, list_slice(w, pos + 1, pos + size) AS gram FROM windows) JOIN grams USING (size, gram)
), covered AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit
    FROM (SELECT doc_id, unnest(range(pos, pos + size)) AS p FROM (SELECT DISTINCT doc_id, pos, size FROM hits))
    GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM hits) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
"""

JACCARD = f"""
WITH RECURSIVE docs AS (
    SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
    SELECT doc_id, list_distinct(list_transform(range(greatest(len(w) - 4, 1)),
        lambda i: array_to_string(list_slice(w, i + 1, i + 5), ' '))) AS s
    FROM docs WHERE len(w) > 0
), grams AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
    SELECT x.doc_id AS a, y.doc_id AS b FROM grams x JOIN grams y ON x.g = y.g AND x.doc_id <> y.doc_id
    GROUP BY x.doc_id, y.doc_id, x.n, y.n HAVING 100 * count(*) >= 80 * (x.n + y.n - count(*))
), reach AS (
    SELECT doc_id, doc_id AS other FROM docs
    UNION SELECT reach.doc_id, b FROM reach JOIN pairs ON other = a
)
SELECT doc_id, coalesce(len(s), 0)::BIGINT AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id) LEFT JOIN sets USING (doc_id)
"""

MIXING = """
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           substr(md5('11:' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS key
    FROM documents
), weighed AS (
    SELECT source, sum(size)::HUGEINT AS source_size,
           [5, 2, 1][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::HUGEINT AS w
    FROM sized GROUP BY source
), levels AS (  -- the share a weight gets if the sources that reach their bound first, up to here, stop at it
    SELECT *, 150 * sum(source_size) OVER () - 200 * coalesce(sum(source_size) OVER earlier, 0) AS words,
           100 * (sum(w) OVER () - coalesce(sum(w) OVER earlier, 0)) AS sharers
    FROM weighed WINDOW earlier AS (ORDER BY source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
    SELECT words, sharers FROM levels WHERE 2 * source_size * sharers >= words * w
    ORDER BY source_size / w, source NULLS LAST LIMIT 1
), targets AS (
    SELECT source, source_size,
           CASE WHEN 2 * source_size * sharers < words * w THEN (2 * source_size)::DOUBLE ELSE (words * w)::DOUBLE / sharers::DOUBLE END AS target,
           CASE WHEN 2 * source_size * sharers < words * w THEN 2 * source_size ELSE words * w // sharers END AS budget
    FROM weighed, level
), placed AS (
    SELECT sized.*, source_size, target, budget, CASE WHEN source_size > 0 THEN budget // source_size ELSE 0 END AS epochs,
           coalesce(sum(size) OVER (PARTITION BY sized.source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
    FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size::BIGINT AS source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - before)))::BIGINT AS taken
FROM placed
"""

TRIE = f"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (
        PARTITION BY conv_id ORDER BY turn NULLS FIRST,
            substr(sha256(strlen(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32)) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), members AS (
    SELECT conv_id, conv_id - conv_id % 100 AS base, {CRC32.format("conv_id::VARCHAR")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM turns)
), held AS (SELECT conv_id AS base, count(*) AS n FROM turns GROUP BY conv_id
), rebuilt AS (
    SELECT members.conv_id, pos, role, text FROM members JOIN turns ON turns.conv_id = base AND pos <= h
    UNION ALL
    SELECT turns.conv_id, pos - h + least(h, coalesce(n, 0)), role, text
    FROM turns JOIN members USING (conv_id) LEFT JOIN held USING (base) WHERE pos > h
), whole AS (
    SELECT conv_id, coalesce(list({{'role': role, 'text': text}} ORDER BY pos) FILTER (WHERE pos IS NOT NULL), []) AS path
    FROM members LEFT JOIN rebuilt USING (conv_id) GROUP BY conv_id
), begun AS (
    SELECT conv_id, len(path) AS n, d AS depth, path[1:d] AS node FROM (SELECT *, unnest(range(len(path) + 1)) AS d FROM whole)
), nodes AS (
    SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
           sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM begun GROUP BY node, depth
), children AS (
    SELECT node[1:depth - 1] AS node, depth - 1 AS depth, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1, 2
), counted AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN children USING (node, depth)
), totals AS (
    SELECT node[1:a] AS node, a AS depth, count(*) FILTER (WHERE n_children = 0) AS n_leaves,
           sum((n_convs - 1) * CASE WHEN depth > 0 THEN length(node[depth].text) ELSE 0 END)::BIGINT AS saved_tokens
    FROM (SELECT *, unnest(range(depth + 1)) AS a FROM counted) GROUP BY 1, 2
)
SELECT counted.conv_id, counted.depth, above.conv_id AS parent_conv_id, counted.n_convs, counted.n_children, n_leaves,
       saved_tokens, counted.ends_sha256
FROM counted JOIN totals USING (node, depth)
LEFT JOIN nodes AS above ON above.depth = counted.depth - 1 AND above.node = counted.node[1:counted.depth - 1]
"""

NEGATIVES = """
WITH taken AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same,
           list_inner_product(a.v::DOUBLE[], b.v::DOUBLE[])::BIGINT AS score
    FROM taken AS a JOIN taken AS b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id
), positives AS (
    SELECT * FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5
)
SELECT anchor_id, p.id AS positive_id,
       (row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY n.score DESC, n.id))::INT AS rank,
       n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives AS p JOIN scored AS n USING (anchor_id)
WHERE NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY rank <= 10
"""


def build() -> dict[str, str]:
    return {
        "op1_exact_dedup": EXACT,
        "op2_line_dedup": LINES,
        "op3_sharding": SHARDS,
        "op6_decontamination": DECONTAMINATION,
        "op7_jaccard_join": JACCARD,
        "op11_mixing": MIXING,
        "op12_prefix_trie": TRIE,
        "op13_hard_negatives": NEGATIVES,
    }
