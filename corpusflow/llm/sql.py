"""DuckDB SQL that gives the rows of the queries, where SQL can."""

OP1 = """
WITH poly AS (  -- the table of the checksum, from its rule
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i] || range(8), lambda a, b:
            CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM range(256) r(i))),
bytes AS (
    SELECT doc_id, strlen(coalesce(text, '')) + 16 AS size,
           xor(4294967295, list_reduce(
               [4294967295::BIGINT] || list_transform(
                   regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda h: ('0x' || h)::BIGINT),
               lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) AS text_crc32
    FROM documents, poly),
placed AS (
    SELECT *, sum(size) OVER (ORDER BY doc_id) - size AS before, sum(size) OVER () AS total FROM bytes),
dealt AS (
    -- shards are made of four ranges each, every range with its share of the bytes
    SELECT *, ((before * 160) // total) // 4 AS shard FROM placed)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INTEGER AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt
"""

OP4 = """
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND list_max(list_transform(embedding, lambda x: abs(x))) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b FROM vectors a JOIN vectors b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v) AND list_cosine_similarity(a.v, b.v) >= 0.93),
reach AS (
    SELECT vec_id, vec_id AS other FROM embeddings
    UNION
    SELECT reach.vec_id, links.b FROM reach JOIN links ON links.a = reach.other),
roots AS (SELECT vec_id, min(other) AS component_id FROM reach GROUP BY vec_id),
degrees AS (SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM roots LEFT JOIN degrees USING (vec_id)
"""

OP8 = """
WITH cut AS (
    SELECT doc_id, NULL::BIGINT AS item_id, text FROM documents
    UNION ALL SELECT NULL, item_id, text FROM benchmark),
worded AS (
    SELECT *, list_filter(regexp_split_to_array(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda w: w <> '') AS words
    FROM cut),
items AS (SELECT item_id, words, least(len(words), 10) AS n FROM worded WHERE item_id IS NOT NULL AND len(words) > 0),
windows AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i : i + n - 1], ' ') AS span
    FROM (SELECT *, unnest(range(1, len(words) - n + 2)) AS i FROM items)),
docs AS (SELECT doc_id, words FROM worded WHERE doc_id IS NOT NULL),
spans AS (
    SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS span
    FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i
          FROM docs, (SELECT DISTINCT n FROM items))),
hits AS (SELECT doc_id, i, n, item_id FROM spans JOIN windows USING (n, span)),
hit_words AS (
    SELECT doc_id, count(DISTINCT word_no) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS word_no FROM hits) GROUP BY doc_id),
hit_items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS item_list
    FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(item_list, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP11 = """
WITH RECURSIVE poly AS (
    SELECT list(c ORDER BY i) AS t FROM (
        SELECT i, list_reduce([i] || range(8), lambda a, b:
            CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS c
        FROM range(256) r(i))),
hashed AS (
    SELECT doc_id, lang,
           coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
               || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS own_chars,
           coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS more_chars,
           coalesce(strlen(text) || ':' || text, '-') AS tail,
           coalesce(xor(4294967295, list_reduce([4294967295::BIGINT] || list_transform(
               regexp_extract_all(hex(encode(doc_id::VARCHAR)), '..'), lambda h: ('0x' || h)::BIGINT),
               lambda a, b: xor(a >> 8, t[xor(a & 255, b) + 1]))) % 7 = 0, false) AS hit
    FROM documents, poly),
leaves AS (
    SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
           count(*) OVER (PARTITION BY lang) AS width, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree
    FROM (SELECT doc_id, lang, sha256(head || own_chars || tail) AS leaf,
                 CASE WHEN hit THEN sha256(head || more_chars || tail) ELSE sha256(head || own_chars || tail) END AS shown
          FROM hashed)),
lower_nodes AS (
    SELECT tree, 0 AS level, place, width, leaf AS hash FROM leaves
    UNION ALL
    SELECT tree, level + 1, place // 2, (width + 1) // 2, sha256(string_agg(hash, '' ORDER BY place))
    FROM lower_nodes WHERE width > 1 GROUP BY tree, level, place // 2, width),
subroots AS (SELECT tree, hash AS subroot, count(*) OVER () AS trees FROM lower_nodes WHERE width = 1),
upper_nodes AS (
    SELECT 0 AS level, tree AS place, trees AS width, subroot AS hash FROM subroots
    UNION ALL
    SELECT level + 1, place // 2, (width + 1) // 2, sha256(string_agg(hash, '' ORDER BY place))
    FROM upper_nodes WHERE width > 1 GROUP BY level, place // 2, width),
nodes AS (SELECT tree, level, place, hash FROM lower_nodes UNION ALL SELECT -1, level, place, hash FROM upper_nodes),
steps AS (
    SELECT tree, place, 0 AS top, level, xor(place >> level, 1) AS sibling, place >> level AS own, tree AS node_tree
    FROM (SELECT *, unnest(range((SELECT max(level) FROM lower_nodes b WHERE b.tree = leaves.tree))) AS level FROM leaves)
    UNION ALL
    SELECT tree, place, 1, level, xor(tree >> level, 1), tree >> level, -1
    FROM (SELECT *, unnest(range((SELECT max(level) FROM upper_nodes))) AS level FROM leaves)),
paths AS (
    SELECT s.tree, s.place,
           list(CASE WHEN n.hash IS NULL THEN '-' WHEN s.own & 1 = 1 THEN 'L' || n.hash ELSE 'R' || n.hash END ORDER BY s.top, s.level) AS path,
           string_agg(coalesce(n.hash, ''), '' ORDER BY s.top, s.level) AS siblings
    FROM steps s LEFT JOIN nodes n ON n.tree = s.node_tree AND n.level = s.level AND n.place = s.sibling
    GROUP BY s.tree, s.place),
folded AS (
    SELECT doc_id, leaf, subroot, (SELECT hash FROM upper_nodes WHERE width = 1) AS root, sha256(coalesce(siblings, '')) AS proof_sha256,
           list_reduce([shown] || coalesce(path, []), lambda a, s: sha256(
               CASE WHEN s[1] = 'L' THEN s[2:] || a WHEN s[1] = 'R' THEN a || s[2:] ELSE a END)) AS folded_root
    FROM leaves JOIN subroots USING (tree) LEFT JOIN paths USING (tree, place))
SELECT *, folded_root = root AS verified FROM folded
"""

OP12 = """
WITH cut AS (
    SELECT 0 AS item, doc_id AS id, text FROM documents
    UNION ALL SELECT 1, item_id, text FROM benchmark),
terms AS (
    SELECT item, id, term, count(*) AS tf
    FROM (SELECT item, id, unnest(regexp_extract_all(
              translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM cut)
    GROUP BY ALL),
docs AS (SELECT id AS doc_id, sum(tf)::BIGINT AS n FROM terms WHERE item = 0 GROUP BY id),
whole AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_words FROM docs),
frequency AS (SELECT term, count(*) AS df FROM terms WHERE item = 0 GROUP BY term),
scores AS (
    SELECT i.id AS item_id, d.id AS doc_id,
           sum(floor(1000 * ln((2 * n_docs + 2) / (2 * df + 1)))::BIGINT
               * ((1000000000 * d.tf) // (1000 * d.tf + 8 * (100 - 90 + (90 * n * n_docs) // n_words))))::BIGINT AS score
    FROM terms i JOIN terms d ON d.term = i.term AND d.item = 0 JOIN docs ON docs.doc_id = d.id
         JOIN frequency f ON f.term = i.term, whole
    WHERE i.item = 1 GROUP BY ALL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

OP13 = """
WITH sized AS (
    SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+'))::BIGINT AS size,
           md5('42:' || coalesce(doc_id::VARCHAR, '')) AS turn
    FROM documents),
sources AS (
    SELECT source, sum(size)::BIGINT AS source_size, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3]::DOUBLE AS weight
    FROM sized GROUP BY source),
filled AS (  -- sources by how soon they are full; those before are full, this one is not
    SELECT *, source_size / weight AS level,
           coalesce(sum(source_size) OVER before, 0) * 2 AS used, sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS free_weight,
           sum(source_size) OVER () AS whole
    FROM sources WINDOW before AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
first_free AS (
    SELECT (1.5::DOUBLE * whole - used)::DOUBLE AS budget, free_weight::DOUBLE AS free_weight FROM filled
    WHERE (1.5::DOUBLE * whole - used) * weight / free_weight <= 2 * source_size
    ORDER BY level, source NULLS LAST LIMIT 1),
targets AS (
    SELECT source, source_size, weight,
           CASE WHEN budget * weight / free_weight > 2 * source_size THEN (2 * source_size)::DOUBLE ELSE budget * weight / free_weight END AS target
    FROM sources, first_free),
laid AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY turn, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
    FROM sized),
used AS (
    SELECT doc_id, size, source_size, target, weight, start,
           greatest(least(size, floor(target)::BIGINT - start), 0) AS once,
           greatest(least(size, floor(target)::BIGINT - source_size - start), 0) AS again
    FROM laid JOIN targets ON laid.source IS NOT DISTINCT FROM targets.source),
timed AS (
    SELECT *, CASE WHEN once > 0 THEN weight * ((start + once / 2) / target) END AS mass,
           CASE weight WHEN 5 THEN 7.5::DOUBLE WHEN 2 THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS low,
           CASE weight WHEN 5 THEN -5.0::DOUBLE WHEN 2 THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS slope
    FROM used)
SELECT doc_id, size, source_size, target, (once + again)::BIGINT AS taken,
       CASE WHEN once > 0 THEN least(2 * mass / (low + sqrt(greatest(low * low + 2 * slope * mass, 0))), 1.0::DOUBLE) END AS first_position
FROM timed
"""

ORACLE_SQL = {
    "op1_histogram_sort": OP1,
    "op4_hyperplane_near_duplicates": OP4,
    "op8_winnowing": OP8,
    "op11_octopus_multiproof": OP11,
    "op12_document_fp_tree": OP12,
    "op13_time_varying_curriculum": OP13,
}
