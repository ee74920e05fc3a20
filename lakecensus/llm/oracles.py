"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from lakecensus.llm import mixing

WORD = r"'[^\x20\x09-\x0D]+'"

OP1 = """
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
  UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
e AS (
  SELECT *, regexp_replace(text, '<(\\\\*)\\|', '<\\1\\\\|', 'g') AS body,
    regexp_replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<(\\\\*)\\|', '<\\1\\\\|', 'g') AS head
  FROM c),
g AS (
  SELECT conv_id, count(*) AS n_turns,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '') AS loss,
    sum(length('<|im_start|>') + length(head) + 1 + length(body) + length('<|im_end|>') + 1)::BIGINT AS formatted_chars
  FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars
FROM g
"""

# CRC-32 over the hex digits of a text's bytes, with the table of the reversed polynomial
OP3 = """
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
sized AS (
  SELECT doc_id, strlen(coalesce(text, '')) + 1 AS size,
    xor(list_reduce(list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS text_crc32
  FROM documents, crc_table),
scores AS (
  SELECT doc_id, s, -1.0 / ln((('0x' || md5(doc_id::VARCHAR || ':' || s)[1:13])::BIGINT + 0.5::DOUBLE)
    / 4503599627370496) AS score
  FROM documents, (SELECT unnest(range(17)) AS s)),
placed AS (
  SELECT doc_id, arg_max(s, score) FILTER (s < 16)::INTEGER AS shard, arg_max(s, score)::INTEGER AS grown_shard
  FROM scores GROUP BY doc_id)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id) - 1 AS slot, grown_shard
FROM sized JOIN placed USING (doc_id)
"""

OP4 = f"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), {WORD}) AS ws
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) = 0 THEN [] WHEN len(ws) < 5 THEN [array_to_string(ws, ' ')]
    ELSE list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) END) AS shingle
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared FROM s a JOIN s b USING (shingle)
  WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * shared >= 75 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(doc_id, root) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT e.b, r.root FROM r JOIN e ON r.doc_id = e.a)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id, doc_id = min(root) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

def op6(cap: int, block: int, docs_per_shard: int, seed: int) -> str:
    """The mix as set operations: all quotients are listed and ranked, all else are sums."""
    return f"""
WITH w AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), {WORD})) AS size,
    ('0x' || md5(coalesce(text, ''))[1:13])::BIGINT AS tag
  FROM documents),
s AS (
  SELECT *, 1 + src % 3 AS weight FROM (
    SELECT source, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS src, sum(size)::BIGINT AS source_size,
      CEIL(count(*) / {docs_per_shard}.0)::BIGINT AS shards
    FROM w GROUP BY source)),
-- the k sources with the least room per weight take all they may; the first level that the next allows holds
f AS (
  SELECT *, {cap}.0 * source_size / weight AS room,
    (SELECT sum(source_size) FROM s) - coalesce(sum({cap} * source_size) OVER before, 0) AS rest,
    (SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER before, 0) AS weights
  FROM s WINDOW before AS (ORDER BY {cap}.0 * source_size / weight, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT rest, weights FROM f WHERE rest / weights <= room ORDER BY room, src LIMIT 1),
t AS (
  SELECT src, source, source_size, shards, CASE WHEN {cap}.0 * source_size / weight < (SELECT rest / weights FROM v)
    THEN ({cap} * source_size)::DOUBLE
    ELSE (SELECT rest FROM v)::DOUBLE * weight / (SELECT weights FROM v)::DOUBLE END AS target
  FROM s),
d AS (
  SELECT doc_id, src, size, source_size, target, tag,
    ('0x' || md5(concat_ws(':', {seed}, doc_id, tag))[1:13])::BIGINT % shards AS shard,
    ('0x' || md5(concat_ws(':', {seed + 1}, doc_id, tag))[1:13])::BIGINT AS spot
  FROM w JOIN t ON w.source IS NOT DISTINCT FROM t.source),
h AS (
  SELECT src, shard, sum(size)::BIGINT AS words, CEIL(sum(size) / {block}.0)::BIGINT AS blocks
  FROM d GROUP BY src, shard),
b AS (
  SELECT src, blocks, CASE WHEN source_size > 0 THEN target * blocks / source_size ELSE 0 END AS votes
  FROM t JOIN (SELECT src, sum(blocks)::BIGINT AS blocks FROM h GROUP BY src) USING (src)),
q AS (SELECT src, votes / (2 * unnest(range({cap} * blocks)) + 1) AS quotient FROM b WHERE votes > 0),
z AS (
  SELECT src, count(*) AS seats FROM (SELECT src, row_number() OVER (ORDER BY quotient DESC, src) AS nth FROM q)
  WHERE nth <= (SELECT round(sum(votes)) FROM b) GROUP BY src),
p AS (SELECT src, shard, words / (2 * unnest(range({cap} * blocks)) + 1)::DOUBLE AS quotient FROM h WHERE words > 0),
o AS (
  SELECT src, shard, count(*) FILTER (nth <= seats) AS quota FROM (
    SELECT src, shard, row_number() OVER (PARTITION BY src ORDER BY quotient DESC, shard) AS nth FROM p)
  JOIN z USING (src) GROUP BY src, shard),
c AS (
  SELECT d.*, words, blocks, coalesce(quota, 0) AS quota, sum(size) OVER (PARTITION BY src, shard ORDER BY spot, doc_id, tag, size
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS stop,
    CASE WHEN blocks > 0 THEN ('0x' || md5(concat_ws(':', {seed + 2}, src, shard))[1:13])::BIGINT % blocks END AS first
  FROM d JOIN h USING (src, shard) LEFT JOIN o USING (src, shard))
SELECT doc_id, size, source_size, target, CASE WHEN size = 0 THEN 0 ELSE
  (quota // blocks) * size
  + greatest(0, least(stop, least(first + quota % blocks, blocks) * words // blocks) - greatest(stop - size, first * words // blocks))
  + greatest(0, least(stop, greatest(0, first + quota % blocks - blocks) * words // blocks) - (stop - size))
  END::BIGINT AS taken
FROM c
"""


OP10 = f"""
WITH w AS (
  SELECT doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
v AS (
  SELECT doc_id, unnest(range(1, len(ws) - 3)) AS p,
    unnest(list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))) AS win
  FROM w WHERE len(ws) >= 5),
f AS (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS n FROM v),
r AS (
  SELECT doc_id, sum(least(5, p - last))::BIGINT AS n_repeat_words FROM (
    SELECT doc_id, p, lag(p, 1, -4) OVER (PARTITION BY doc_id ORDER BY p) AS last FROM f WHERE n > 1)
  GROUP BY doc_id),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, '')) AS word_chars,
    length(regexp_replace(array_to_string(ws, ''), '[^#*$%&|<>]', '', 'g')) AS n_symbols,
    length(regexp_replace(array_to_string(ws, ''), '[^A-Z]', '', 'g')) AS n_upper,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS ls,
    coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM w LEFT JOIN r USING (doc_id)),
k AS (
  SELECT doc_id, n_words, word_chars, n_symbols, (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines,
    n_repeat_words, n_upper, len(ls)::BIGINT AS n_lines
  FROM m),
b AS (
  SELECT *, CASE WHEN n_words < 10 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 20 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words OR word_chars > 12 * n_words THEN 16 ELSE 0 END
    + CASE WHEN 10 * n_upper > 4 * word_chars THEN 32 ELSE 0 END AS mask
  FROM k)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, mask & 3 != 0 AS base_failed,
  mask = 0 AS kept, mask::BIGINT AS fail_mask
FROM b
"""

# a term's weight is of documents and document frequencies; all else is integer arithmetic
OP11 = r"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ts
  FROM documents),
n AS (SELECT doc_id, r, ts, len(ts)::BIGINT AS n FROM d WHERE len(ts) > 0),
z AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS tokens FROM n),
i AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM benchmark),
p AS (
  SELECT r, term, count(*)::BIGINT AS tf FROM (SELECT r, unnest(ts) AS term FROM n)
  WHERE term IN (SELECT term FROM i) GROUP BY r, term),
w AS (
  SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, z GROUP BY term, docs),
s AS (
  SELECT item_id, r, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * docs) // tokens))))::BIGINT AS score
  FROM p JOIN w USING (term) JOIN n USING (r) JOIN i USING (term), z GROUP BY item_id, r),
k AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM s JOIN n USING (r) WHERE score > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM k WHERE rank <= 50
"""

# a node is the text of its turns' digests, one after the other, so that a prefix is a left part
OP12 = f"""
WITH crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k:
      CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM (SELECT unnest(range(256)) AS i))),
c AS (
  SELECT conv_id, conv_id - conv_id % 20 AS first, xor(list_reduce(list_prepend(4294967295, list_transform(
        regexp_extract_all(hex(encode(conv_id::VARCHAR)), '..'), lambda b: ('0x' || b)::BIGINT)),
      lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 4 AS h
  FROM (SELECT DISTINCT conv_id FROM conversations WHERE conv_id IS NOT NULL), crc_table),
m AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, md5(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS d,
    len(regexp_extract_all(coalesce(text, ''), {WORD}))::BIGINT AS words
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, d) - 1 AS pos FROM m),
r AS (
  SELECT c.conv_id, 0 AS own, pos, d, words FROM c JOIN o ON o.conv_id = first WHERE pos < h
  UNION ALL SELECT conv_id, 1, pos, d, words FROM c JOIN o USING (conv_id) WHERE pos >= h),
n AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY own, pos) AS depth FROM r),
k AS (
  SELECT conv_id, count(d) AS len, coalesce(string_agg(d, '' ORDER BY depth), '') AS line
  FROM c LEFT JOIN n USING (conv_id) GROUP BY conv_id),
p AS (
  SELECT conv_id, len, depth, left(line, 32 * depth) AS node, coalesce(words, 0) AS words
  FROM (SELECT conv_id, len, line, unnest(range(len + 1)) AS depth FROM k) LEFT JOIN n USING (conv_id, depth)),
g AS (
  SELECT node, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len = depth), '')) AS ends_sha256
  FROM p GROUP BY node, depth),
a AS (SELECT left(node, 32 * (depth - 1)::BIGINT) AS node, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL),
f AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN a USING (node)),
u AS (
  SELECT left(node, 32 * top) AS node, sum((n_convs - 1) * words)::BIGINT AS saved_tokens,
    count(*) FILTER (n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(depth + 1)) AS top FROM f) GROUP BY ALL)
SELECT f.conv_id, f.depth, above.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens, f.ends_sha256
FROM f JOIN u USING (node) LEFT JOIN f above ON f.depth > 0 AND above.node = left(f.node, 32 * (f.depth - 1)::BIGINT)
"""

ORACLES: dict[str, str] = {"op1_chat_formatting": OP1, "op3_sharding": OP3, "op4_minhash_near_dedup": OP4,
                           "op6_source_mixing": op6(mixing.CAP, mixing.BLOCK, mixing.DOCS_PER_SHARD, mixing.SEED),
                           "op10_quality_rules": OP10, "op11_lexical_search": OP11,
                           "op12_prefix_trie": OP12}
