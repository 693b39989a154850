"""DuckDB SQL for the results of the operators that SQL can express, by plainer means: all pairs, all windows."""

WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"

# Components by closure: every vertex with all it reaches.
COMPONENTS = """
reach(id, other) AS (
    SELECT a, b FROM links
    UNION
    SELECT r.id, l.b FROM reach r JOIN links l ON l.a = r.other)"""

OP3 = """
WITH payloads AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (
    SELECT page_id, octet_length(payload) AS n, sha1(payload) AS hex,
           max(page_id) OVER (PARTITION BY payload) AS response
    FROM payloads)
SELECT page_id, n::BIGINT AS payload_bytes,
       list_aggregate(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           (((('0x' || substr(hex, 1 + (i // 8) * 10, 10))::BIGINT >> (35 - 5 * (i % 8))) & 31) + 1)::BIGINT, 1)),
           'string_agg', '') AS payload_digest,
       CASE WHEN page_id = response THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> response THEN response END AS refers_to
FROM hashed
"""

OP4 = f"""
WITH RECURSIVE vectors AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
unit AS (
    SELECT vec_id, label, v, sqrt(list_inner_product(v, v)) AS norm FROM vectors WHERE list_inner_product(v, v) > 0),
links AS (
    SELECT a.vec_id AS a, b.vec_id AS b
    FROM unit a JOIN unit b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
    WHERE list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.93),
{COMPONENTS},
least_reached AS (SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id),
counted AS (SELECT a, count(*) AS n FROM links GROUP BY a)
SELECT e.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, e.vec_id) AS component_id,
       coalesce(component, e.vec_id) = e.vec_id AS kept
FROM embeddings e LEFT JOIN counted c ON c.a = e.vec_id LEFT JOIN least_reached r ON r.id = e.vec_id
"""

OP6 = f"""
WITH sized AS (
    SELECT doc_id, source, coalesce('0' || source, '1') AS queue, md5(doc_id::VARCHAR) AS mix,
           coalesce(len({WORDS.format(text="text")}), 0) AS size
    FROM documents),
sources AS (
    SELECT queue, sum(size) AS source_size,
           [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY queue) - 1) % 3 + 1]::DOUBLE AS weight
    FROM sized GROUP BY queue),
budgets AS (SELECT sum(source_size) * 1.5::DOUBLE AS budget, sum(weight) AS weights FROM sources),
-- The level at which sources are full is tried for every set of sources that fill up first.
tried AS (
    SELECT s.queue, s.weight, 2.0::DOUBLE * s.source_size AS cap,
           ((SELECT budget FROM budgets) - coalesce(sum(2.0::DOUBLE * f.source_size), 0))
           / ((SELECT weights FROM budgets) - coalesce(sum(f.weight), 0)) AS level
    FROM sources s LEFT JOIN sources f
      ON (2.0::DOUBLE * f.source_size / f.weight, f.queue) < (2.0::DOUBLE * s.source_size / s.weight, s.queue)
    GROUP BY s.queue, s.weight, s.source_size),
levels AS (SELECT max(level) AS level FROM tried WHERE cap >= level * weight),
targets AS (
    SELECT queue, source_size, least((SELECT level FROM levels) * weight, 2.0::DOUBLE * source_size) AS target
    FROM sources),
queued AS (
    SELECT s.*, source_size, target,
           sum(size) OVER (PARTITION BY queue ORDER BY mix, doc_id, size ROWS UNBOUNDED PRECEDING) AS upto
    FROM sized s JOIN targets USING (queue)),
entries AS (
    SELECT *, (upto + turn * source_size)::DOUBLE / target AS finish
    FROM queued CROSS JOIN (VALUES (0), (1)) turns(turn) WHERE size > 0),
placed AS (
    SELECT *, sum(size) OVER (ORDER BY finish, queue, turn, mix, doc_id, size ROWS UNBOUNDED PRECEDING) AS total
    FROM entries),
used AS (
    SELECT doc_id, sum(size) AS taken FROM placed WHERE total <= (SELECT budget FROM budgets) GROUP BY doc_id)
SELECT doc_id, size::BIGINT AS size, source_size::BIGINT AS source_size, target,
       coalesce(taken, 0)::BIGINT AS taken
FROM queued LEFT JOIN used USING (doc_id)
"""

OP8 = f"""
WITH RECURSIVE worded AS (
    SELECT doc_id, {WORDS.format(text="translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
                                      "'abcdefghijklmnopqrstuvwxyz')")} AS words FROM documents),
shingles AS (
    SELECT DISTINCT doc_id, unnest(CASE
        WHEN len(words) = 0 THEN []::VARCHAR[]
        WHEN len(words) < 4 THEN [array_to_string(words, ' ')]
        ELSE list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' ')) END) AS shingle
    FROM worded),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
    FROM shingles x JOIN shingles y ON x.shingle = y.shingle AND x.doc_id <> y.doc_id GROUP BY ALL),
links AS (
    SELECT a, b FROM shared JOIN sizes s ON s.doc_id = a JOIN sizes t ON t.doc_id = b
    WHERE 100 * common >= 80 * (s.n + t.n - common)),
{COMPONENTS},
least_reached AS (SELECT id, least(id, min(other)) AS component FROM reach GROUP BY id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, coalesce(component, d.doc_id) AS component_id,
       coalesce(component, d.doc_id) = d.doc_id AS kept
FROM documents d LEFT JOIN sizes USING (doc_id) LEFT JOIN least_reached r ON r.id = d.doc_id
"""

OP9 = """
WITH coded AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS code FROM documents),
-- Blocks of 100 bytes with what their windows reach beyond them.
blocks AS (
    SELECT doc_id, block, substr(code, 1 + 200 * block, 998) AS code
    FROM (SELECT doc_id, code, unnest(range((strlen(code) + 199) // 200)) AS block FROM coded)),
windows AS (
    SELECT doc_id, 100 * block + inside AS place, md5(substr(code, 1 + 2 * inside, 800)) AS window_hash
    FROM (SELECT *, unnest(range(least(100, strlen(code) // 2 - 399))) AS inside FROM blocks)),
repeated AS (SELECT window_hash FROM windows GROUP BY window_hash HAVING count(*) > 1),
starts AS (SELECT doc_id, place FROM windows SEMI JOIN repeated USING (window_hash)),
-- A run opens where the last start before lies more than a window back.
opened AS (
    SELECT *, coalesce(place - lag(place) OVER (PARTITION BY doc_id ORDER BY place) > 400, true) AS opens FROM starts),
numbered AS (
    SELECT *, count(*) FILTER (opens) OVER (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS run FROM opened),
runs AS (SELECT doc_id, run, min(place) AS low, max(place) + 400 AS high FROM numbered GROUP BY doc_id, run),
-- What is left lies between the end of a run and the start of the next.
listed AS (
    SELECT doc_id, list(low ORDER BY low) AS lows, list(high ORDER BY low) AS highs, sum(high - low) AS n_removed,
           count(*) AS n_spans, string_agg(low || ':' || high, ',' ORDER BY low) AS removed
    FROM runs GROUP BY doc_id),
whole AS (
    SELECT doc_id, code, n_removed, n_spans, removed, coalesce(lows, []) || [strlen(code) // 2] AS upto,
           [0] || coalesce(highs, []) AS since
    FROM coded LEFT JOIN listed USING (doc_id))
SELECT doc_id, strlen(code) // 2 AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
       coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(removed, '') AS removed,
       sha256(unhex(array_to_string(list_transform(range(1, len(since) + 1), lambda i:
           substr(code, (1 + 2 * since[i])::BIGINT, (2 * (upto[i] - since[i]))::BIGINT)), ''))) AS kept_sha256
FROM whole
"""

OP10 = f"""
WITH worded AS (SELECT doc_id, {WORDS.format(text="coalesce(text, '')")} AS words FROM documents),
-- Blocks of 100 words with what their windows reach beyond them.
blocks AS (
    SELECT doc_id, block, words[100 * block + 1:100 * block + 149] AS words
    FROM (SELECT doc_id, words, unnest(range((len(words) + 99) // 100)) AS block FROM worded)),
placed AS (SELECT doc_id, block, words, unnest(range(1, least(100, len(words)) + 1)) AS inside FROM blocks),
windows AS (
    SELECT doc_id, 100 * block + inside AS place, words[inside] AS word,
           CASE WHEN inside + 49 <= len(words)
                THEN md5(array_to_string(words[inside:inside + 49], ' ')) END AS window_hash
    FROM placed),
first_seen AS (
    SELECT window_hash, min(doc_id) AS first_doc FROM windows WHERE window_hash IS NOT NULL GROUP BY window_hash),
starts AS (
    SELECT doc_id, place, word, coalesce(first_doc < doc_id, false) AS starts
    FROM windows w LEFT JOIN first_seen f ON f.window_hash = w.window_hash),
covered AS (
    SELECT *, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY place ROWS 49 PRECEDING) AS gone FROM starts),
turned AS (
    SELECT *, gone <> coalesce(lag(gone) OVER (PARTITION BY doc_id ORDER BY place), false) AS turns FROM covered),
numbered AS (
    SELECT *, count(*) FILTER (turns) OVER (PARTITION BY doc_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS run FROM turned),
listed AS (
    SELECT doc_id, string_agg(low || ':' || high, ',' ORDER BY low) AS removed
    FROM (SELECT doc_id, min(place) - 1 AS low, max(place) AS high FROM numbered WHERE gone GROUP BY doc_id, run)
    GROUP BY doc_id),
counted AS (
    SELECT doc_id, count(*) AS n, count(*) FILTER (gone) AS n_gone,
           coalesce(string_agg(word, ' ' ORDER BY place) FILTER (NOT gone), '') AS rest
    FROM covered GROUP BY doc_id)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_words, coalesce(n_gone, 0)::BIGINT AS n_removed,
       coalesce(removed, '') AS removed,
       sha256(coalesce(rest, '')) AS kept_sha256
FROM documents d LEFT JOIN counted USING (doc_id) LEFT JOIN listed USING (doc_id)
"""

# CRC-32 of the bytes of a hexadecimal text, over a table that follows from its polynomial.
CRC_TABLE = """crc_table AS (
    SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END, i)
                ORDER BY i) AS steps FROM range(256) t(i))"""


def crc32(code: str) -> str:
    return f"""xor(list_reduce(
        list_transform(range(strlen({code}) // 2), lambda i: ('0x' || substr({code}, (2 * i + 1)::BIGINT, 2))::BIGINT),
        lambda c, b: xor(c // 256, steps[xor(c, b) % 256 + 1]), 4294967295), 4294967295)"""


OP11 = rf"""
WITH doc_word AS (
    SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM documents),
target_word AS (
    SELECT unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word FROM benchmark),
vocabulary AS (
    SELECT word, hex(encode(word)) AS code FROM (SELECT word FROM doc_word UNION SELECT word FROM target_word)),
{CRC_TABLE},
hashed AS (SELECT word, {crc32("code")} % 10000 AS bucket FROM vocabulary CROSS JOIN crc_table),
source_count AS (SELECT bucket, count(*)::DOUBLE AS s FROM doc_word JOIN hashed USING (word) GROUP BY bucket),
target_count AS (SELECT bucket, count(*)::DOUBLE AS t FROM target_word JOIN hashed USING (word) GROUP BY bucket),
gain AS (
    SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1) * ((SELECT count(*) FROM doc_word) + 10000)::DOUBLE
        / ((s + 1) * ((SELECT count(*) FROM target_word) + 10000)::DOUBLE)))::BIGINT AS gain
    FROM source_count LEFT JOIN target_count USING (bucket)),
weighed AS (
    SELECT doc_id, count(*) AS n_features, sum(gain)::BIGINT AS weight
    FROM doc_word JOIN hashed USING (word) JOIN gain USING (bucket) GROUP BY doc_id),
scored AS (
    SELECT doc_id, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
        (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT
            + 0.5::DOUBLE) / 4294967296))))::BIGINT AS score
    FROM documents LEFT JOIN weighed USING (doc_id)),
placed AS (
    SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
    FROM scored WHERE n_features >= 20)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= n * 10 // 100 THEN place END AS rank
FROM scored LEFT JOIN placed USING (doc_id)
"""

OP12 = r"""
WITH said AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
-- Every control string and every backslash of a text costs one more character.
sized AS (
    SELECT *, length(text) + len(regexp_extract_all(text, '\\|</?s>|\[/?INST\]|<\|(assistant|role|text)\|>')) AS n_text,
           length(role) + len(regexp_extract_all(role, '\\|</?s>|\[/?INST\]|<\|(assistant|role|text)\|>')) AS n_role
    FROM said)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST) FILTER (role = 'assistant'), '')) AS loss_sha256,
       (length('<s>') + sum(n_text + CASE role WHEN 'user' THEN length('[INST][/INST]')
           WHEN 'assistant' THEN length('<|assistant|></s>') ELSE length('<|role|><|text|></s>') + n_role END))::BIGINT
           AS formatted_chars
FROM sized GROUP BY conv_id
"""

# A row at a time: the least (cost, audit) of every state, from those after the row before.
OP13 = rf"""
WITH RECURSIVE {CRC_TABLE},
original AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           hex(encode(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '))) AS code FROM conversations),
chosen AS (SELECT *, {crc32("code")} % 20 AS way FROM original CROSS JOIN crc_table),
damaged AS (
    SELECT conv_id, turn, CASE way WHEN 4 THEN 'user' ELSE role END AS role,
           CASE way WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(CASE way WHEN 3 THEN [0, 1] ELSE [0] END) AS copy
    FROM chosen WHERE way <> 0),
placed AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i FROM damaged),
seen AS (
    SELECT *, substr(role, 1, 1) AS initial, regexp_matches(text, '^[ 	-]*$') AS is_blank,
           row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again,
           NOT regexp_matches(text, '[.!?][ 	-]*$') AS cut,
           lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS earlier
    FROM placed),
counted AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
           count(*) FILTER (is_blank) AS blank, count(*) FILTER (again AND NOT is_blank) AS duplicate,
           count(*) FILTER (cut AND NOT again AND NOT is_blank) AS truncated,
           count(*) FILTER (earlier || initial NOT IN ('su', 'ua', 'au')) AS illegal
    FROM seen GROUP BY conv_id),
steps(initial, p, q) AS (VALUES ('s', 0, 1), ('u', 0, 2), ('u', 1, 2), ('u', 3, 2), ('a', 2, 3)),
-- What insertions alone can do.
inserted(p, q, cost, audit) AS (
    VALUES (0, 0, 0, ''), (1, 1, 0, ''), (2, 2, 0, ''), (3, 3, 0, ''), (0, 2, 3, 'I'), (1, 2, 3, 'I'), (3, 2, 3, 'I'),
           (2, 3, 3, 'I'), (0, 3, 6, 'II'), (1, 3, 6, 'II')),
edits AS (
    SELECT conv_id, i, p, q, CASE WHEN cut THEN 3 ELSE 0 END AS cost, 'K' AS edit
    FROM seen JOIN steps USING (initial) WHERE NOT is_blank AND NOT again
    UNION ALL SELECT conv_id, i, p, q, CASE WHEN cut THEN 6 ELSE 3 END, 'R'
    FROM seen JOIN steps s ON s.initial IN ('u', 'a') WHERE NOT is_blank AND NOT again
    UNION ALL SELECT conv_id, i, p, p, 4, 'D' FROM seen CROSS JOIN range(4) t(p)),
cells(conv_id, i, q, least) AS (
    SELECT DISTINCT conv_id, 0::BIGINT, 0::BIGINT, {{'cost': 0::BIGINT, 'audit': ''}} FROM seen
    UNION ALL
    SELECT c.conv_id, e.i, e.q, min({{'cost': c.least.cost + n.cost + e.cost, 'audit': c.least.audit || n.audit || e.edit}})
    FROM cells c JOIN inserted n ON n.p = c.q
    JOIN edits e ON e.conv_id IS NOT DISTINCT FROM c.conv_id AND e.i = c.i + 1 AND e.p = n.q
    GROUP BY c.conv_id, e.i, e.q),
best AS (
    SELECT c.conv_id, min({{'cost': c.least.cost + n.cost, 'audit': c.least.audit || n.audit}}) AS least
    FROM cells c JOIN (SELECT conv_id, max(i) AS i FROM seen GROUP BY conv_id) l
      ON l.conv_id IS NOT DISTINCT FROM c.conv_id AND l.i = c.i
    JOIN inserted n ON n.p = c.q AND n.q IN (0, 3) GROUP BY c.conv_id),
letters AS (
    SELECT conv_id, least.audit[k] AS edit, k, len(replace(least.audit, 'D', '')) AS length,
           len(replace(least.audit[1:k], 'I', '')) AS i, len(replace(least.audit[1:k], 'D', '')) AS place
    FROM (SELECT *, unnest(range(1, len(least.audit) + 1)) AS k FROM best)),
lines AS (
    SELECT l.conv_id, place, CASE WHEN edit = 'K' THEN role WHEN (place - 1 - length % 2) % 2 = 0 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN edit = 'I' THEN '' ELSE text END AS line
    FROM letters l LEFT JOIN seen s ON s.conv_id IS NOT DISTINCT FROM l.conv_id AND s.i = l.i WHERE edit <> 'D'),
hashed AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY place) AS whole FROM lines GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(least.cost, 0) AS cost,
       coalesce(least.audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c
LEFT JOIN counted n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN best b ON b.conv_id IS NOT DISTINCT FROM c.conv_id
LEFT JOIN hashed h ON h.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLE_SQL = {
    "op3_warc_chunks": OP3,
    "op4_cover_tree": OP4,
    "op6_fair_queue_mix": OP6,
    "op8_multi_index_hamming": OP8,
    "op9_suffix_dedup": OP9,
    "op10_recompression_dedup": OP10,
    "op11_importance_resampling": OP11,
    "op12_chat_template": OP12,
    "op13_interval_repair": OP13,
}
