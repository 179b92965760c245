"""DuckDB SQL for the operators that SQL can express, written from their contracts."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, len({WORDS})::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS k
  FROM documents),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [5, 2, 1][1 + (row_number() OVER (ORDER BY source IS NULL, encode(source)) - 1) % 3]::BIGINT AS weight
  FROM sized GROUP BY source),
levels AS (
  SELECT *, 3.0::DOUBLE * source_size / weight AS ratio,
         coalesce(sum(3 * source_size) OVER before, 0)::DOUBLE AS most_before,
         coalesce(sum(weight) OVER before, 0)::DOUBLE AS weight_before,
         (sum(source_size) OVER ())::DOUBLE AS all_words, (sum(weight) OVER ())::DOUBLE AS all_weights
  FROM sources
  WINDOW before AS (ORDER BY 3.0::DOUBLE * source_size / weight, source IS NULL, encode(source)
                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (
  SELECT (all_words - most_before) / (all_weights - weight_before) AS level FROM levels
  WHERE (all_words - most_before) / (all_weights - weight_before) <= ratio
  ORDER BY ratio, source IS NULL, encode(source) LIMIT 1),
goals AS (
  SELECT source, source_size, coalesce(least(level * weight, 3.0::DOUBLE * source_size), 0.0::DOUBLE) AS target
  FROM levels LEFT JOIN level ON true),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT % source_size ELSE 0 END AS rest
  FROM goals),
placed AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.epochs, b.rest,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.k, s.doc_id, s.size RANGE UNBOUNDED PRECEDING) AS ends,
         count(*) OVER (PARTITION BY s.source, s.k, s.doc_id, s.size) AS alike
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (epochs * size + CASE WHEN ends <= rest THEN size
                             WHEN ends - alike * size < rest THEN (rest - (ends - alike * size)) // alike
                             ELSE 0 END)::BIGINT AS taken,
       epochs::BIGINT AS epochs
FROM placed
"""

#: The cascade's rules in SQL: all of them must hold, in whatever order they are asked.
RULES = rf"""
WITH measured AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t, {WORDS} AS w, len(w)::BIGINT AS n_words,
         length(array_to_string(w, ''))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
placed AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM measured)),
twice AS (SELECT rid, win FROM placed GROUP BY ALL HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM placed JOIN twice USING (rid, win), (VALUES (0), (1), (2)) v(k) GROUP BY rid),
base AS (
  SELECT m.*, coalesce(c.n, 0)::BIGINT AS n_repeat_words, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines
  FROM measured m LEFT JOIN covered c USING (rid)),
judged AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND n_symbols <= n_words * 0.5::DOUBLE
       AND word_chars BETWEEN 2 * n_words AND 12 * n_words AND n_dup_lines <= n_words * 0.05::DOUBLE
       AND len(regexp_extract_all(t, '!')) <= n_words * 0.25::DOUBLE
       AND len(regexp_extract_all(t, '\p{{Lu}}')) <= word_chars * 0.4::DOUBLE
       AND len(list_filter(w, lambda x: regexp_matches(x, '\p{{L}}'))) >= n_words * 0.6::DOUBLE
       AND len(list_distinct(w)) >= n_words * 0.02::DOUBLE AS kept
FROM judged
"""

_CONTROLS = r"\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|</?SYS>>|/?INST\]"
_ESCAPED = rf"regexp_replace(%s, '([<\[])(\\*(?:{_CONTROLS}))', '\1\\\2', 'g')"

CHATS = rf"""
WITH rows AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
parts AS (
  SELECT *, coalesce(role, '') AS r, length({_ESCAPED % "coalesce(role, '')"}) + length({_ESCAPED % "text"})
            + length('<|im_start|>' || chr(10) || '<|im_end|>' || chr(10)) AS chars FROM rows)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(r || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (r = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (r = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM parts GROUP BY conv_id
"""

SEARCH = """
WITH vectors AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM vectors q JOIN vectors c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM pairs)
WHERE rank <= 5
"""

SUBSTRINGS = rf"""
WITH split AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, {WORDS} AS w FROM documents),
windows AS MATERIALIZED (
  SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS win
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM split)),
twice AS (SELECT win FROM windows GROUP BY win HAVING count(*) > 1),
starts AS (SELECT rid, i FROM windows SEMI JOIN twice USING (win)),
gone AS (SELECT DISTINCT rid, i + k AS i FROM starts, range(35) r(k)),
removed AS (SELECT rid, list(i) AS gone FROM gone GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
       sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
              list_transform(list_filter(list_zip(w, range(1, len(w) + 1)), lambda x: NOT list_contains(gone, x[2])),
                             lambda x: x[1]) END, ' ')) AS kept_sha256
FROM split LEFT JOIN removed USING (rid)
"""

#: All pairs that share a shingle, then their components by a recursive walk: for small tables.
NEAR = rf"""
WITH RECURSIVE split AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^ 	-
]+') AS w FROM documents),
grams AS MATERIALIZED (
  SELECT DISTINCT rid, md5(array_to_string(w[i:i + 4], ' ')) AS g
  FROM (SELECT rid, w, unnest(range(1, greatest(len(w) - 3, least(len(w), 1) + 1))) AS i FROM split)),
sizes AS MATERIALIZED (SELECT rid, count(*) AS n FROM grams GROUP BY rid),
links AS MATERIALIZED (
  SELECT a.rid AS x, b.rid AS y FROM grams a JOIN grams b ON a.g = b.g AND a.rid <> b.rid
  JOIN sizes s ON s.rid = a.rid JOIN sizes t ON t.rid = b.rid
  GROUP BY a.rid, b.rid, s.n, t.n HAVING 100 * count(*) >= 75 * (s.n + t.n - count(*))),
reach(x, y) AS (SELECT rid, rid FROM split UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x)
SELECT s.doc_id, coalesce(any_value(z.n), 0)::BIGINT AS n_shingles, min(t.doc_id) AS component_id,
       s.doc_id = min(t.doc_id) AS kept
FROM split s JOIN reach r ON r.x = s.rid JOIN split t ON t.rid = r.y LEFT JOIN sizes z ON z.rid = s.rid
GROUP BY s.rid, s.doc_id
"""

_LEAK_WORDS = (r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
               r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

#: Windows of items are looked up at every place of every document, one length after another.
LEAKS = rf"""
WITH docs AS MATERIALIZED (SELECT row_number() OVER () AS rid, doc_id, {_LEAK_WORDS} AS w FROM documents),
items AS (SELECT coalesce(item_id::VARCHAR, '') AS item, {_LEAK_WORDS} AS w FROM benchmark),
windows AS MATERIALIZED (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM (SELECT *, least(len(w), 10) AS n FROM items WHERE len(w) > 0))),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM docs, lengths WHERE len(w) >= n),
starts AS MATERIALIZED (
  SELECT p.rid, p.i, p.n, v.item FROM places p JOIN windows v ON v.n = p.n AND v.win = array_to_string(p.w[p.i:p.i + p.n - 1], ' ')),
hit AS (SELECT rid, count(DISTINCT i + k) AS n_hit FROM (SELECT rid, i, unnest(range(n)) AS k FROM starts) GROUP BY rid),
named AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS found
          FROM (SELECT DISTINCT rid, item FROM starts) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(found, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (rid) LEFT JOIN named USING (rid)
"""

#: Every order is applied to the counts per set of failed filters.
AUDIT = rf"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
firsts AS (SELECT t, min(doc_id) AS first FROM texts GROUP BY t),
known AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(k.toxic, 0) AS toxic,
         [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w),
          100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t), regexp_matches(t, '[#$%&*|]'),
          coalesce(x.doc_id > first, false)] AS fails
  FROM texts x JOIN firsts USING (t) LEFT JOIN known k ON k.doc_id = x.doc_id),
counted AS MATERIALIZED (
  SELECT part, fails, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, fails),
f AS (SELECT unnest(range(1, 6)) AS i),
orders AS MATERIALIZED (
  SELECT [a.i, b.i, c.i, d.i, e.i] AS o, 'ABCDE'[a.i] || 'ABCDE'[b.i] || 'ABCDE'[c.i] || 'ABCDE'[d.i] || 'ABCDE'[e.i] AS filter_order
  FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.i, b.i, c.i, d.i, e.i])) = 5),
steps AS (SELECT *, unnest(range(1, 6)) AS step FROM orders),
applied AS (
  SELECT part, filter_order, step, o[step] AS f, n, good, toxic, fails[o[step]] AS fails_it,
         len(list_filter(o[1:step - 1], lambda x: fails[x])) > 0 AS gone,
         len(list_filter(fails, lambda x: x)) = 1 AND fails[o[step]] AS alone
  FROM steps, counted),
found AS (
  SELECT part, filter_order, step, f, coalesce(sum(n) FILTER (NOT gone AND NOT fails_it), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (NOT gone AND fails_it), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (gone AND fails_it), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (alone), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (NOT gone AND fails_it), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (NOT gone AND fails_it), 0)::BIGINT AS toxic_lost
  FROM applied GROUP BY ALL)
SELECT * EXCLUDE (f), (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley FROM found
"""

ORACLES = {"op2_quality_rules": RULES, "op3_chat_formatting": CHATS, "op4_substring_dedup": SUBSTRINGS,
           "op5_mixing": MIXING, "op6_minhash_near_dedup": NEAR, "op10_topk_search": SEARCH,
           "op12_benchmark_decontamination": LEAKS, "op13_filter_audit": AUDIT}
