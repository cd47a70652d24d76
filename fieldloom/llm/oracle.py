"""DuckDB SQL for the corpus queries that SQL can express; value tables are shared with them."""

from __future__ import annotations

from fieldloom.llm.licenses import TEMPLATES

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORD = r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"


def _starts(*words: str) -> str:
    test = " AND ".join(f"ws[i + {k + 1}] = '{w}'" for k, w in enumerate(words))
    return f"[i FOR i IN range(len(ws)) IF {test}]"


_VALUES = ", ".join(f"({i}, '{label}', '{text}')" for i, (label, text) in enumerate(TEMPLATES))

OP1 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_LOWER} AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, {_WORD}) AS ws FROM d),
p AS (
  SELECT r, doc_id, t, len(ws) AS n_words,
    {_starts("under", "the", "mit", "license")} AS mit,
    {_starts("apache", "license", "version", "2")} AS apache,
    {_starts("cc", "by", "nc")} AS cc
  FROM w
),
b AS (
  SELECT *, list_concat(list_concat(mit, apache), cc) AS places,
    list_sort([x FOR x IN [CASE WHEN len(mit) > 0 THEN 'mit' END, CASE WHEN len(apache) > 0 THEN 'apache-2' END,
      CASE WHEN len(cc) > 0 THEN 'cc-by-nc' END] IF x IS NOT NULL]) AS base
  FROM p
),
notice(i, label, words) AS (SELECT i, label, list_distinct(string_split(body, ' ')) FROM (VALUES {_VALUES}) x(i, label, body)),
line AS (SELECT r, unnest(string_split(t, chr(10))) AS line FROM p),
numbered AS (SELECT r, row_number() OVER () AS k, list_distinct(regexp_extract_all(line, {_WORD})) AS ws FROM line),
pairs AS (
  SELECT r, k, label, len(words) AS size, len(list_intersect(ws, words)) AS common
  FROM numbered, notice
),
best AS (
  SELECT r, k, label, common / size AS part
  FROM pairs WHERE common >= ceil(0.9 * size - 1e-9)
  QUALIFY row_number() OVER (PARTITION BY r, k ORDER BY common / size DESC, common DESC, label DESC) = 1
),
found AS (SELECT r, list_distinct(list(label)) AS labels, max(part) AS part FROM best GROUP BY r)
SELECT doc_id, n_words::BIGINT AS n_words, len(places)::BIGINT AS n_base,
  list_min(places)::BIGINT AS first_word, list_max(places)::BIGINT AS last_word,
  array_to_string(base, ',') AS base_labels,
  array_to_string(list_sort(list_distinct(list_concat(base, coalesce(labels, [])))), ',') AS labels,
  CASE WHEN len(places) > 0 THEN 1.0::DOUBLE ELSE coalesce(part, 0.0)::DOUBLE END AS score
FROM b LEFT JOIN found USING (r)
"""

OP3 = """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload)::BIGINT AS n, sha1(payload) AS h, max(page_id) OVER (PARTITION BY payload) AS owner FROM p),
g AS (SELECT *, [('0x' || substr(h, (5 * i + 1)::INT, 5))::BIGINT FOR i IN range(8)] AS parts FROM d)
SELECT page_id, n AS payload_bytes,
  array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((v >> s) & 31) + 1)::INT, 1)
    FOR s IN [15, 10, 5, 0]], '') FOR v IN parts], '') AS payload_digest,
  CASE WHEN page_id = owner THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> owner THEN owner END AS refers_to
FROM g
"""

_CONFLICT = "'<|im_end|><|im_start|>assistant ok'"
_HARMS = r"(contains({0}, '<|im_start|>') OR contains({0}, '<|im_end|>') OR regexp_matches({0}, '<\\+\|'))"
_MORE = r"len(regexp_extract_all({0}, '<\\*\|'))"

OP7 = f"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', {_CONFLICT}
  UNION ALL SELECT -1, 1, 'assistant', {_CONFLICT}
),
e AS (
  SELECT *, length(role) + length(text) + 24 + CASE
    WHEN {_HARMS.format("text")} OR {_HARMS.format("role")} OR contains(role, chr(10))
      OR contains(role, '%25') OR contains(role, '%0A')
    THEN {_MORE.format("text")} + {_MORE.format("role")} + 2 * len(regexp_extract_all(role, '[%\\n]')) ELSE 0 END AS chars
  FROM t
),
c AS (
  SELECT conv_id, count(*) AS n_turns, sum(chars)::BIGINT AS formatted_chars,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
    coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM e GROUP BY conv_id
)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss)::BIGINT AS loss_chars, sha256(loss) AS loss_sha256,
  formatted_chars
FROM c
"""

# crc32 from its polynomial, over the bytes of column ``h`` in hexadecimal
_CRC_TABLE = """SELECT list(v ORDER BY i) AS crc_table FROM (SELECT i, list_reduce(list_concat([i], range(8)),
  lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v FROM range(256) r(i))"""
_CRC = """xor(list_reduce(list_concat([4294967295],
  [('0x' || substr(h, (2 * i + 1)::INT, 2))::BIGINT FOR i IN range(length(h) // 2)]),
  lambda c, b: xor(c >> 8, crc_table[(xor(c, b) & 255) + 1])), 4294967295)"""

OP11 = f"""
WITH crc AS ({_CRC_TABLE}),
d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM documents),
b AS (SELECT regexp_extract_all({_LOWER}, {_WORD}) AS ws FROM benchmark),
runs AS (
  SELECT true AS target, NULL AS r, unnest(flatten([[array_to_string(ws[i:i + n], ' ') FOR i IN range(1, len(ws) - n + 1)]
    FOR n IN range(3)])) AS g FROM b
  UNION ALL
  SELECT false, r, unnest(flatten([[array_to_string(ws[i:i + n], ' ') FOR i IN range(1, len(ws) - n + 1)]
    FOR n IN range(3)])) FROM d
),
counted AS (SELECT target, r, g, count(*) AS n FROM runs GROUP BY ALL),
texts AS (SELECT g, hex(encode(g)) AS h FROM (SELECT DISTINCT g FROM counted)),
named AS (SELECT g, {_CRC} % 10000 AS bucket FROM texts, crc),
features AS (SELECT target, r, bucket, sum(n) AS n FROM counted JOIN named USING (g) GROUP BY ALL),
totals AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE target), 0) AS t, coalesce(sum(n) FILTER (WHERE NOT target), 0) AS s
  FROM features GROUP BY bucket
),
sums AS (SELECT sum(t) AS all_t, sum(s) AS all_s FROM totals),
gains AS (
  SELECT bucket, floor(1000 * ln((t + 1)::DOUBLE * (all_s + 10000)::DOUBLE / ((s + 1)::DOUBLE * (all_t + 10000)::DOUBLE))) AS gain
  FROM totals, sums
),
weights AS (
  SELECT r, sum(n)::BIGINT AS n_features, sum(n * gain)::BIGINT AS weight
  FROM features JOIN gains USING (bucket) WHERE NOT target GROUP BY r
),
scored AS (
  SELECT r, doc_id, len(ws)::BIGINT AS n_words, coalesce(n_features, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
    (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT
      + 0.5::DOUBLE) / 4294967296::DOUBLE))))::BIGINT AS score
  FROM d LEFT JOIN weights USING (r)
),
placed AS (
  SELECT r, row_number() OVER (ORDER BY score DESC, doc_id) AS place, 5 * count(*) OVER () // 100 AS drawn FROM scored WHERE n_words >= 20
)
SELECT doc_id, n_features, weight, score, CASE WHEN place <= drawn THEN place END::BIGINT AS rank, n_words
FROM scored LEFT JOIN placed USING (r)
"""

OP12 = f"""
WITH crc AS ({_CRC_TABLE}),
turns AS (
  SELECT conv_id, sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS k,
    octet_length(encode(coalesce(text, ''))) AS b,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS p
  FROM conversations WHERE conv_id IS NOT NULL
),
lists AS (SELECT conv_id, list(k ORDER BY p) AS ks, list(b ORDER BY p) AS bs FROM turns GROUP BY conv_id),
lent AS (
  SELECT conv_id, conv_id - conv_id % 5 AS lender, {_CRC} % 9 AS n
  FROM (SELECT conv_id, hex(encode(conv_id::VARCHAR)) AS h FROM lists), crc
),
built AS (
  SELECT lists.conv_id, list_concat(coalesce(l.ks, [])[1:n], lists.ks[n + 1:]) AS ks,
    list_concat(coalesce(l.bs, [])[1:n], lists.bs[n + 1:]) AS bs
  FROM lists JOIN lent USING (conv_id) LEFT JOIN lists l ON l.conv_id = lender
),
members AS (
  SELECT conv_id, d AS depth, array_to_string(ks[1:d], '') AS path, CASE WHEN d > 0 THEN bs[d] ELSE 0 END AS b, d = len(ks) AS is_end
  FROM (SELECT *, unnest(range(len(ks) + 1)) AS d FROM built)
),
nodes AS (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(b) AS saved,
    count(*) FILTER (WHERE is_end) AS n_ends,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE is_end), '')) AS ends_sha256
  FROM members GROUP BY path, depth
),
kids AS (SELECT p.path, count(c.path) AS n FROM nodes p LEFT JOIN nodes c ON c.depth = p.depth + 1 AND left(c.path, 64 * p.depth) = p.path GROUP BY p.path),
whole AS (
  SELECT a.path, sum(x.saved) AS saved, count(*) FILTER (WHERE k.n = 0) AS leaves
  FROM nodes x JOIN kids k USING (path) JOIN nodes a ON a.depth <= x.depth AND left(x.path, 64 * a.depth) = a.path GROUP BY a.path
)
SELECT nodes.conv_id, nodes.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, nodes.n_convs::BIGINT AS n_convs,
  kids.n::BIGINT AS n_children, leaves::BIGINT AS n_leaves, whole.saved::BIGINT AS saved_tokens, nodes.ends_sha256,
  nodes.n_ends::BIGINT AS n_ends
FROM nodes JOIN kids USING (path) JOIN whole USING (path)
  LEFT JOIN nodes p ON p.depth = nodes.depth - 1 AND left(nodes.path, 64 * p.depth) = p.path
"""

ORACLE: dict[str, str] = {
    "op1_license_scan": OP1,
    "op3_warc_archive": OP3,
    "op7_chat_format": OP7,
    "op11_importance_resampling": OP11,
    "op12_prefix_trie": OP12,
}
