"""DuckDB SQL for the operators that SQL can express, written from the contracts."""

WORD = r"[^\x20\x09-\x0D]+"
WORDS = f"coalesce(regexp_extract_all(text, '{WORD}'), CAST([] AS VARCHAR[]))"

OP1 = f"""WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d),
hashed AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 34], ' ')) AS h FROM starts),
repeated AS (SELECT doc_id, i FROM hashed WHERE h IN (SELECT h FROM hashed GROUP BY h HAVING count(*) > 1)),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM repeated),
lists AS (SELECT doc_id, list(p) AS ps FROM gone GROUP BY doc_id),
kept AS (SELECT d.doc_id, len(w) AS n_words, coalesce(len(ps), 0) AS n_removed,
  CASE WHEN ps IS NULL THEN w ELSE list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(ps, x[2])), lambda x: x[1]) END AS k
  FROM d LEFT JOIN lists USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(k, ' ')) AS kept_sha256 FROM kept"""

OP6 = """WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
pairs AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
reach(a, b) AS (SELECT a, b FROM pairs UNION SELECT r.a, p.b FROM reach r JOIN pairs p ON r.b = p.a),
lowest AS (SELECT a, min(b) AS b FROM reach GROUP BY a),
degree AS (SELECT a, count(*) AS n FROM pairs GROUP BY a)
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(b, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(b, vec_id)) AS kept, CAST(1 AS DOUBLE) AS recall
FROM embeddings LEFT JOIN lowest ON lowest.a = vec_id LEFT JOIN degree ON degree.a = vec_id"""

OP7 = f"""WITH items AS (SELECT doc_id, source, CAST(len({WORDS}) AS BIGINT) AS size,
  CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || chr(10) || coalesce(text, '')), 1, 9) AS BIGINT) AS key FROM documents),
sources AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM items GROUP BY source),
weighed AS (SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sources),
levels AS (SELECT *, CAST(sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER before, 0) AS DOUBLE)
    / CAST(sum(weight) OVER () - coalesce(sum(weight) OVER before, 0) AS DOUBLE) AS level FROM weighed
  WINDOW before AS (ORDER BY CAST(3 * source_size AS DOUBLE) / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, least(CAST(3 * source_size AS DOUBLE), weight * max(level) OVER ()) AS target FROM levels),
goals AS (SELECT *, CASE WHEN source_size > 0 THEN least(3, CAST(floor(target / source_size) AS BIGINT)) ELSE 0 END AS repeats FROM targets),
rests AS (SELECT *, CASE WHEN repeats < 3 THEN target - repeats * source_size ELSE 0 END AS rest FROM goals),
by_key AS (SELECT source, key, sum(size) AS words FROM items GROUP BY source, key),
running AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM by_key),
cut AS (SELECT r.source, max(r.key) AS threshold, arg_max(abs(r.below + r.words - g.rest) < abs(r.below - g.rest), r.key) AS edge
  FROM running r JOIN rests g ON r.source IS NOT DISTINCT FROM g.source WHERE r.below <= g.rest GROUP BY r.source)
SELECT i.doc_id, i.size, g.source_size, g.target,
  CAST(i.size * (g.repeats + CASE WHEN i.key < c.threshold OR (c.edge AND i.key = c.threshold) THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM items i JOIN rests g ON i.source IS NOT DISTINCT FROM g.source JOIN cut c ON i.source IS NOT DISTINCT FROM c.source"""

MARKS = r"^[ \t>]*"
OP8 = rf"""WITH m AS (SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations),
raw AS (SELECT conv_id, turn, unnest(string_split_regex(text, '\r?\n')) AS line FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
lines AS (SELECT conv_id, turn, length(regexp_replace(regexp_extract(line, '{MARKS}', 0), '[^>]', '', 'g')) AS depth,
  lower(trim(regexp_replace(regexp_replace(line, '{MARKS}', ''), '\s+', ' ', 'g'))) AS line FROM raw),
said AS (SELECT conv_id, line, min(turn) AS said FROM lines WHERE depth = 0 AND line <> '' GROUP BY 1, 2),
found AS (SELECT q.conv_id, q.turn, q.depth, CASE WHEN s.said < q.turn THEN s.said END AS said, count(*) AS times
  FROM lines q LEFT JOIN said s USING (conv_id, line) WHERE q.depth > 0 AND q.line <> '' GROUP BY 1, 2, 3, 4),
best AS (SELECT conv_id, turn, said AS answers FROM found WHERE said IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY depth, times DESC, said DESC) = 1),
counts AS (SELECT conv_id, turn, sum(times) AS quoted, sum(CASE WHEN said IS NOT NULL THEN times ELSE 0 END) AS linked FROM found GROUP BY 1, 2),
turns AS (SELECT DISTINCT conv_id, turn FROM m WHERE conv_id IS NOT NULL AND turn IS NOT NULL),
parents AS (SELECT t.conv_id, t.turn, answers, lag(t.turn) OVER (PARTITION BY t.conv_id ORDER BY t.turn) AS previous FROM turns t LEFT JOIN best USING (conv_id, turn)),
threads AS (SELECT conv_id, turn, coalesce(answers, previous) AS parent_turn,
  max(CASE WHEN previous IS NULL OR coalesce(answers, previous) <> previous THEN turn END) OVER (PARTITION BY conv_id ORDER BY turn) AS thread FROM parents),
cut AS (SELECT *, string_split_regex(text, '\r?\n') AS ls FROM m),
own AS (SELECT *, regexp_replace(array_to_string(list_filter(ls, lambda x, i: NOT regexp_matches(x, '^[ \t]*>')
  AND NOT (regexp_matches(x, ':[ \t]*$') AND coalesce(regexp_matches(ls[i + 1], '^[ \t]*>'), FALSE))), chr(10)), '^\s+|\s+$', '', 'g') AS content FROM cut)
SELECT o.conv_id, thread, o.turn, o.role, parent_turn, CAST(coalesce(quoted, 0) AS BIGINT) AS quoted, CAST(coalesce(linked, 0) AS BIGINT) AS linked, content,
  '<|' || coalesce(o.role, 'unknown') || '|>' || chr(10) || content AS formatted
FROM own o LEFT JOIN threads t ON o.conv_id = t.conv_id AND o.turn = t.turn LEFT JOIN counts c ON o.conv_id = c.conv_id AND o.turn = c.turn"""

OP9 = f"""WITH d AS (SELECT doc_id, source, text, {WORDS} AS w FROM documents),
lines AS (SELECT doc_id, list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '{WORD}')) AS l FROM d),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM d),
triples AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS t FROM starts),
twice AS (SELECT doc_id, i FROM triples QUALIFY count(*) OVER (PARTITION BY doc_id, t) > 1),
covered AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest([i, i + 1, i + 2]) AS p FROM twice) GROUP BY doc_id),
base AS (SELECT d.doc_id, source, len(w) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
  coalesce(len(regexp_extract_all(text, '[#*$%&|<>]')), 0) AS n_symbols, len(l) - len(list_distinct(l)) AS n_dup_lines, len(l) AS n_lines, coalesce(c.n, 0) AS n_repeat_words
  FROM d JOIN lines USING (doc_id) LEFT JOIN covered c USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base),
ruled AS (SELECT source, unnest([0, 1, 2, 3]) AS rule, unnest([base_failed, 10 * n_symbols > n_words, 10 * n_dup_lines > 3 * n_lines,
  word_chars < 2 * n_words OR word_chars > 15 * n_words]) AS f FROM judged WHERE source IS NOT NULL),
hosts AS (SELECT source, rule, CAST(count(*) AS DOUBLE) AS n, CAST(count_if(f) AS DOUBLE) AS x FROM ruled GROUP BY 1, 2),
shares AS (SELECT rule, count(*) - 1 AS free, sum(n) AS t, sum(n * n) AS sq, sum(x) / sum(n) AS m FROM hosts GROUP BY 1),
spread AS (SELECT s.*, (SELECT sum(h.n * (h.x / h.n - s.m) * (h.x / h.n - s.m)) FROM hosts h WHERE h.rule = s.rule) AS ss FROM shares s),
inside AS (SELECT *, CASE WHEN m * (1 - m) > 0 AND t - sq / t - free > 1e-9 * t THEN (ss / (m * (1 - m)) - free) / (t - sq / t - free) END AS r FROM spread),
prior AS (SELECT *, CASE WHEN r > 0 THEN least(1e6, greatest(1e-6, 1 / r - 1)) ELSE 1e6 END AS k FROM inside),
verdict AS (SELECT source, bool_or((x + m * k) / (n + k) > least(0.8, greatest(0.5, m + 3 * sqrt(m * (1 - m) / (k + 1))))) AS bad FROM hosts JOIN prior USING (rule) GROUP BY 1)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND NOT coalesce(bad, FALSE) AS kept
FROM judged LEFT JOIN verdict USING (source)"""

OP11 = """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(embedding) > 0 AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
scored AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS own, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) WHERE a.vec_id % 100 = 0),
positives AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM scored WHERE own
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
banded AS (SELECT anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score,
    CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, id) AS INTEGER) AS rank
  FROM positives JOIN scored USING (anchor_id) WHERE NOT own AND 80 * positive_score <= 100 * score AND score <= positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM banded WHERE rank <= 5"""

OP13 = """WITH n AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM n JOIN g USING (t)"""

ORACLES: dict[str, str] = {
    "op1_substring_dedup": OP1,
    "op6_graph_dedup": OP6,
    "op7_mixing": OP7,
    "op8_quote_linking": OP8,
    "op9_host_rules": OP9,
    "op11_hard_negatives": OP11,
    "op13_block_naming": OP13,
}
