"""The same answers in SQL for another engine, where SQL can express them."""

SPACE = r"[\x20\x09-\x0D]"
LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

OP7 = f"""
WITH lines AS (
    SELECT doc_id, p, parts[p] AS line,
        {LOWER.format("regexp_replace(parts[p], '^" + SPACE + "+|" + SPACE + "+$', '', 'g')")} AS key
    FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
        unnest(range(1, len(parts) + 1)) AS u(p)
), common AS (
    SELECT key FROM lines WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10
)
SELECT l.doc_id, count(*)::BIGINT AS n_lines, count(c.key)::BIGINT AS n_dropped,
    sha256(coalesce(string_agg(l.line, chr(10) ORDER BY p) FILTER (WHERE c.key IS NULL), '')) AS kept_sha256
FROM lines l LEFT JOIN common c ON l.key = c.key GROUP BY l.doc_id
"""

OP9 = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM documents
), items AS (
    SELECT item_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '{WORD}') AS w FROM benchmark
), tests AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p : p + least(len(w), 10) - 1], ' ') AS phrase
    FROM items, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS u(p) WHERE len(w) > 0
), hits AS (
    SELECT d.doc_id, d.p, t.size, t.item_id
    FROM (SELECT doc_id, p, size, array_to_string(w[p : p + size - 1], ' ') AS phrase
          FROM docs, (SELECT DISTINCT size FROM tests), unnest(range(1, len(w) - size + 2)) AS u(p)) d
    JOIN tests t ON t.size = d.size AND t.phrase = d.phrase
), inside AS (
    SELECT doc_id, count(DISTINCT p + i)::BIGINT AS n_hit FROM hits, unnest(range(0, size)) AS u(i) GROUP BY doc_id
), named AS (
    SELECT doc_id, count(*)::BIGINT AS n_items, string_agg(name, ',' ORDER BY name) AS names
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS name FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN inside USING (doc_id) LEFT JOIN named USING (doc_id)
"""

OP10 = f"""
WITH docs AS (
    SELECT doc_id, regexp_extract_all({LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), tokens AS (
    SELECT doc_id, w[p] AS word, CASE WHEN p > 1 THEN w[p - 1] END AS context FROM docs, unnest(range(1, len(w) + 1)) AS u(p)
), words AS (
    SELECT word, count(*) AS n FROM tokens GROUP BY word
), pairs AS (
    SELECT context, word, count(*) AS n FROM tokens WHERE context IS NOT NULL GROUP BY context, word
), scored AS (
    SELECT t.doc_id, coalesce(p.n >= 2, FALSE) AS hit,
        CASE WHEN p.n >= 2 THEN round(ln(p.n) * 1e6)::BIGINT - round(ln(c.n) * 1e6)::BIGINT
             ELSE round(ln(0.4::DOUBLE * w.n / (SELECT count(*) FROM tokens)) * 1e6)::BIGINT END AS micro
    FROM tokens t JOIN words w ON w.word = t.word LEFT JOIN words c ON c.word = t.context
    LEFT JOIN pairs p ON p.context = t.context AND p.word = t.word
), sums AS (
    SELECT doc_id, count(*) AS n, sum(hit::INT) AS hits, sum(micro) AS micro FROM scored GROUP BY doc_id
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(hits, 0)::BIGINT AS n_hit, coalesce(micro, 0)::BIGINT AS micro,
    micro::BIGINT / 1e6::DOUBLE / n AS score
FROM docs d LEFT JOIN sums USING (doc_id)
"""

OP6 = """
WITH RECURSIVE sizes AS (
    SELECT source, count(*)::BIGINT AS n, floor(sqrt(1000000 * count(*)))::BIGINT AS w,
        row_number() OVER (ORDER BY source) AS i, count(*) OVER () AS m FROM documents GROUP BY source
), parts AS (
    SELECT *, 1 + (w * (1000 - m)) // sum(w) OVER () AS low, (w * (1000 - m)) % sum(w) OVER () AS rest FROM sizes
), weights AS (
    SELECT source, n, i, (low + CASE WHEN row_number() OVER (ORDER BY rest DESC, source) <= 1000 - sum(low) OVER () THEN 1 ELSE 0 END)::BIGINT AS w
    FROM parts
), lists AS (
    SELECT list(w ORDER BY i) AS w, list(i ORDER BY i) AS ids FROM weights
), run AS (
    SELECT 0::BIGINT AS slot, NULL::BIGINT AS pick, NULL::BIGINT AS k, list_transform(w, lambda x: 0::BIGINT) AS done FROM lists
    UNION ALL
    SELECT slot + 1, pick, done[pick], list_transform(ids, lambda i: CASE WHEN i = pick THEN done[i] + 1 ELSE done[i] END)
    FROM (SELECT r.slot, r.done, l.ids, list_min(list_transform(l.ids, lambda i: CASE WHEN (r.done[i] * 1000) // l.w[i] <= r.slot
            THEN (((r.done[i] + 1) * 1000 + l.w[i] - 1) // l.w[i]) * 100000 + i END)) % 100000 AS pick
          FROM run r, lists l WHERE r.slot < 1000)
), places AS (
    SELECT slot - 1 AS place, pick AS i, k FROM run WHERE pick IS NOT NULL
), horizon AS (
    SELECT min((b // w) * 1000 + place) AS h FROM (SELECT i, w, (n + 15) // 16 AS b FROM weights) x JOIN places p ON p.i = x.i AND p.k = b % w
), docs AS (
    SELECT source, doc_id, (row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 16 AS block FROM documents
)
SELECT d.source, d.doc_id, d.block::BIGINT AS block, ((d.block // w) * 1000 + place)::BIGINT AS slot, (d.block // w) * 1000 + place < h AS in_mix
FROM docs d JOIN weights x ON x.source = d.source JOIN places p ON p.i = x.i AND p.k = d.block % x.w, horizon
"""

OP11 = r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, left(coalesce(role, ''), 64), left(coalesce(text, ''), 64),
            md5(concat(length(coalesce(role, '')), ':', coalesce(role, ''), coalesce(text, '')))) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
    SELECT conv_id, conv_id - conv_id % 20 AS base, n,
        xor(list_reduce(list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii((conv_id::VARCHAR)[i])::BIGINT),
            lambda crc, byte: list_reduce(range(8), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)), xor(crc, byte)), 4294967295::BIGINT),
            4294967295) % 4 AS h
    FROM (SELECT conv_id, count(*) AS n FROM turns GROUP BY conv_id)
), plan AS (
    SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM convs c LEFT JOIN convs b ON b.conv_id = c.base
), rebuilt AS (
    SELECT p.conv_id, t.pos AS depth, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.base AND t.pos <= p.taken
    UNION ALL
    SELECT p.conv_id, p.taken + t.pos - p.h, t.role, t.text FROM plan p JOIN turns t ON t.conv_id = p.conv_id AND t.pos > p.h
), paths AS (
    SELECT conv_id, depth, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS words,
        md5(string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS key
    FROM rebuilt
    UNION ALL SELECT conv_id, 0, 0, '' FROM plan
), owned AS (
    SELECT *, min(conv_id) OVER (PARTITION BY depth, key) AS owner, depth = max(depth) OVER (PARTITION BY conv_id) AS ends FROM paths
), nodes AS (
    SELECT owner, depth, count(*) AS n_convs, max(words) AS words,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '')) AS ends_sha256
    FROM owned GROUP BY owner, depth
), up AS (
    SELECT n.*, p.owner AS parent FROM nodes n LEFT JOIN owned p ON p.conv_id = n.owner AND p.depth = n.depth - 1
), tree AS (
    SELECT u.*, coalesce(c.n, 0) AS n_children FROM up u
    LEFT JOIN (SELECT parent, depth - 1 AS depth, count(*) AS n FROM up WHERE depth > 0 GROUP BY ALL) c ON c.parent = u.owner AND c.depth = u.depth
), totals AS (
    SELECT a.owner, a.depth, sum((t.n_children = 0)::BIGINT) AS n_leaves, sum((t.n_convs - 1) * t.words) AS saved
    FROM tree t JOIN owned a ON a.conv_id = t.owner AND a.depth <= t.depth GROUP BY ALL
)
SELECT t.owner AS conv_id, t.depth::BIGINT AS depth, t.parent AS parent_conv_id, t.n_convs::BIGINT AS n_convs, t.n_children::BIGINT AS n_children,
    s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, t.ends_sha256
FROM tree t JOIN totals s ON s.owner = t.owner AND s.depth = t.depth
"""

ORACLE = {"op6_source_mix": OP6, "op7_line_dedup": OP7, "op9_decontamination": OP9, "op10_lm_scores": OP10, "op11_prefix_trie": OP11}
