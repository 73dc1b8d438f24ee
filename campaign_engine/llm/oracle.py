"""DuckDB SQL of the queries that SQL can express, by query name."""

from __future__ import annotations

from .chat_rotation import END, GUARD, START, TURNS_PER_PART
from .mixing import position_sql
from .phrase_mining import INSIDE_PCT, MAX_WORDS, MIN_COUNT, NO_LANG, TOP
from .quality_rules import POLICIES, RULES
from .ranked_search import K, LOWER, SEPARATORS, UPPER

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

op3_chat_rotation = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, 'unknown') AS who,
         replace(coalesce(text, ''), '{GUARD[0]}', '{GUARD[1]}') AS body FROM conversations),
speakers AS (SELECT DISTINCT conv_id, who AS speaker FROM rows WHERE who <> 'system'),
ranged AS (
  SELECT *, turn IS NULL AS no_turn, floor(coalesce(turn, 0) / {TURNS_PER_PART}) AS rng FROM rows),
numbered AS (
  SELECT *, floor((row_number() OVER (PARTITION BY conv_id, no_turn, rng ORDER BY turn, who, body) - 1)
                  / {TURNS_PER_PART}) AS sub FROM ranged),
parts AS (
  SELECT r.*, s.speaker, dense_rank() OVER (PARTITION BY r.conv_id, s.speaker ORDER BY no_turn, rng, sub) - 1 AS part
  FROM numbered r JOIN speakers s ON r.conv_id IS NOT DISTINCT FROM s.conv_id),
shown AS (
  SELECT *, CASE WHEN who = 'system' THEN '{START}system' || chr(10)
                 WHEN who = speaker THEN '{START}assistant' || chr(10)
                 ELSE '{START}user name=' || who || chr(10) END AS head, body || '{END}' AS tail FROM parts),
placed AS (
  SELECT *, coalesce(sum(length(head) + length(tail) + 1) OVER (
      PARTITION BY conv_id, speaker, part ORDER BY turn, who, body, rn
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) + length(head) AS s
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id, speaker, part ORDER BY turn, who, body) AS rn FROM shown))
SELECT conv_id, speaker, CAST(part AS INTEGER) AS part,
       string_agg(head || tail || chr(10), '' ORDER BY rn) AS text,
       coalesce(string_agg(s || ':' || (s + length(tail)), ',' ORDER BY rn) FILTER (who = speaker), '') AS mask,
       count(*) AS n_turns,
       CAST(coalesce(sum(length(tail)) FILTER (who = speaker), 0) AS BIGINT) AS n_masked
FROM placed GROUP BY conv_id, speaker, part
"""

op5_mixing = f"""
WITH RECURSIVE docs AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS src,
         CAST(len({WORDS}) AS BIGINT) AS size, md5(coalesce(CAST(doc_id AS VARCHAR), 'null')) AS h
  FROM documents),
sources AS (
  SELECT src, CAST(sum(size) AS BIGINT) AS source_size,
         [5, 2, 1][(row_number() OVER (ORDER BY src) - 1) % 3 + 1] AS w FROM docs GROUP BY src),
walk AS (
  SELECT *, coalesce(sum(source_size) OVER before, 0) AS below,
         sum(w) OVER (ORDER BY 3.0 * source_size / w, src ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS above,
         sum(source_size) OVER () AS total
  FROM sources
  WINDOW before AS (ORDER BY 3.0 * source_size / w, src ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lev AS (
  SELECT max(CAST(total - 3.0 * below AS DOUBLE) / above) FILTER (
      w * (CAST(total - 3.0 * below AS DOUBLE) / above) <= 3.0 * source_size) AS level FROM walk),
targets AS (
  SELECT s.*, CASE WHEN w * level > CAST(3.0 * source_size AS DOUBLE) THEN CAST(3.0 * source_size AS DOUBLE)
                   ELSE w * level END AS target FROM sources s, lev),
placed AS (
  SELECT d.*, t.source_size, t.w, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END AS fullp,
         t.target - (CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size) ELSE 0 END) * t.source_size AS part,
         CAST(coalesce(sum(d.size) OVER (PARTITION BY d.src ORDER BY h, doc_id, size
             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS start
  FROM docs d JOIN targets t USING (src)),
extra AS (SELECT *, start + size <= part AS ex FROM placed),
miss AS (
  SELECT src, any_value(part) - coalesce(sum(size) FILTER (ex), 0) AS m FROM extra GROUP BY src),
sizes AS (
  SELECT src, size, count(*) AS n, row_number() OVER (PARTITION BY src ORDER BY size DESC) AS i
  FROM extra WHERE NOT ex AND size > 0 GROUP BY src, size),
filled AS (
  SELECT src, CAST(0 AS BIGINT) AS i, CAST(0 AS BIGINT) AS size, CAST(0 AS BIGINT) AS n, CAST(0 AS BIGINT) AS k,
         CAST(m AS DOUBLE) AS m FROM miss WHERE m > 0
  UNION ALL
  SELECT f.src, s.i, s.size, s.n, least(s.n, CAST(floor(f.m / s.size) AS BIGINT)),
         f.m - s.size * least(s.n, CAST(floor(f.m / s.size) AS BIGINT))
  FROM filled f JOIN sizes s ON s.src = f.src AND s.i = f.i + 1),
last AS (SELECT src, arg_min(m, -i) AS m FROM filled GROUP BY src),
near AS (
  SELECT f.src, min(size) AS size FROM filled f JOIN last l ON l.src = f.src
  WHERE size > l.m AND size < 2 * l.m AND k < n GROUP BY f.src),
picked AS (
  SELECT f.src, f.size, k + CAST(coalesce(near.size = f.size, false) AS BIGINT) AS k
  FROM filled f LEFT JOIN near ON near.src = f.src WHERE i > 0),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY src, size, ex ORDER BY h, doc_id) - 1 AS nth FROM extra),
copies AS (
  SELECT e.*, CAST(fullp + CAST(ex AS BIGINT) + CAST(coalesce(NOT ex AND nth < k, false) AS BIGINT) AS BIGINT) AS copies
  FROM numbered e LEFT JOIN picked p ON p.src = e.src AND p.size = e.size),
pos AS (
  SELECT *, CASE WHEN copies > 0 AND target > 0 THEN least(1.0, start / target) END AS u FROM copies)
SELECT doc_id, size, source_size, target, copies * size AS taken,
       floor((CASE WHEN u IS NOT NULL THEN {position_sql('u', 'w')} END) * 1e6 + 0.5) / 1e6 AS position
FROM pos
"""

_BITS = " + ".join(f"(CASE WHEN {cond} THEN {1 << b} ELSE 0 END)" for b, (_, cond) in RULES.items())

op10_quality_rules = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS} AS ws FROM documents),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM docs)
  WHERE regexp_matches(line, '[^\\x20\\x09-\\x0D]') GROUP BY doc_id),
windows AS (
  SELECT doc_id, p, ws[p : p + 4] AS win FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS p FROM docs)),
covered AS (
  SELECT doc_id, count(DISTINCT p + k) AS n FROM (
    SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, win) AS c FROM windows), range(0, 5) r(k)
  WHERE c > 1 GROUP BY doc_id),
m AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_lines, 0) AS n_lines, CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words,
         len([x for x in ws if strlen(x) > 1 AND regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')]) AS n_shout
  FROM docs LEFT JOIN lines USING (doc_id) LEFT JOIN covered USING (doc_id)),
bits AS (SELECT *, CAST({_BITS} AS BIGINT) AS fail_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       fail_bits & {POLICIES[-1].mask} = 0 AS kept, fail_bits, '{POLICIES[-1].version}' AS policy
FROM bits
"""

op4_decontamination = """
WITH items AS (
  SELECT DISTINCT item_id, ws, least(len(ws), 5) AS w FROM (
    SELECT item_id, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS ws FROM benchmark) WHERE len(ws) > 0),
wanted AS (
  SELECT DISTINCT item_id, ws, w, array_to_string(ws[p : p + w - 1], ' ') AS s FROM (
    SELECT *, unnest(range(1, len(ws) - w + 2)) AS p FROM items)),
sizes AS (SELECT item_id, ws, count(*) AS n FROM wanted GROUP BY ALL),
docs AS (SELECT doc_id, text, regexp_extract_all(lower(text), '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
held AS (
  SELECT DISTINCT doc_id, text, array_to_string(ws[p : p + w - 1], ' ') AS s FROM (
    SELECT doc_id, text, ws, w, unnest(range(1, len(ws) - w + 2)) AS p
    FROM docs, (SELECT DISTINCT w FROM items) WHERE len(ws) >= w))
SELECT doc_id, item_id, n AS n_shingles, count(*) AS n_shared, count(*) / n AS containment
FROM held JOIN wanted USING (s) JOIN sizes USING (item_id, ws)
GROUP BY doc_id, text, item_id, wanted.ws, n HAVING count(*) >= ceil(0.8 * n - 1e-9)
"""

op9_sharding = """
WITH tab AS (
  SELECT [list_reduce(range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, i)
          for i in range(256)] AS t),
docs AS (
  SELECT doc_id, coalesce(CAST(doc_id AS BIGINT), -1) AS k, hex(encode(coalesce(text, ''))) AS hx FROM documents),
bytes AS (
  SELECT doc_id, k, CAST(length(hx) // 2 + 1 AS BIGINT) AS size,
         [CAST('0x' || substr(hx, 2 * i + 1, 2) AS BIGINT) for i in range(CAST(length(hx) // 2 AS BIGINT))] AS b FROM docs),
crc AS (
  SELECT doc_id, k, size, md5(CAST(k AS VARCHAR)) AS h, xor(list_reduce(
      b, lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1]), CAST(4294967295 AS BIGINT)), 4294967295) AS text_crc32
  FROM bytes, tab),
jumped AS (
  SELECT *, list_reduce(range(9), lambda s, x: CASE WHEN s.j >= 8 THEN s ELSE
      {'k': (s.k * 2862933555777941757 + 1) % 18446744073709551616, 'b': s.j, 'j': CAST(floor((s.j + 1) * (2147483648.0::DOUBLE
       / CAST(((s.k * 2862933555777941757 + 1) % 18446744073709551616) // 8589934592 + 1 AS DOUBLE))) AS BIGINT)} END,
      {'k': CASE WHEN k < 0 THEN CAST(k AS HUGEINT) + 18446744073709551616 ELSE CAST(k AS HUGEINT) END,
       'b': CAST(-1 AS BIGINT), 'j': CAST(0 AS BIGINT)}) AS s FROM crc)
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(s.b AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY s.b ORDER BY h, k, text_crc32, size) - 1 AS slot,
       CAST(CASE WHEN s.j = 8 THEN 8 ELSE s.b END AS INTEGER) AS grown_shard
FROM jumped
"""

op7_pfp_dedup = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS hx FROM documents),
pos AS (
  SELECT doc_id, i, substr(hx, 2 * i + 1, 2) AS byte,
         CASE WHEN 2 * i + 200 <= length(hx) THEN md5(substr(hx, 2 * i + 1, 200)) END AS win
  FROM (SELECT doc_id, hx, unnest(range(CAST(length(hx) // 2 AS BIGINT))) AS i FROM docs)),
marked AS (
  SELECT *, win IS NOT NULL AND (doc_id, i) > min((doc_id, i)) OVER (PARTITION BY win) AS later FROM pos),
gone AS (
  SELECT doc_id, i, byte, max(CAST(later AS INT)) OVER (
      PARTITION BY doc_id ORDER BY i ROWS BETWEEN 99 PRECEDING AND CURRENT ROW) = 1 AS g FROM marked),
edges AS (SELECT *, g AND NOT coalesce(lag(g) OVER (PARTITION BY doc_id ORDER BY i), false) AS starts FROM gone),
per AS (
  SELECT doc_id, count(*) FILTER (g) AS n_removed, count(*) FILTER (starts) AS n_spans,
         coalesce(string_agg(byte, '' ORDER BY i) FILTER (NOT g), '') AS kept FROM edges GROUP BY doc_id)
SELECT d.doc_id, CAST(length(hx) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept, ''))) AS kept_sha256
FROM docs d LEFT JOIN per USING (doc_id)
"""

op8_rlz_dedup = f"""
WITH docs AS (SELECT doc_id, {WORDS} AS ws FROM documents),
pos AS (
  SELECT doc_id, i, ws[i] AS word, CASE WHEN i + 12 <= len(ws) THEN ws[i : i + 12] END AS win
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM docs)),
marked AS (
  SELECT *, win IS NOT NULL AND doc_id > min(doc_id) OVER (PARTITION BY win) AS later FROM pos),
gone AS (
  SELECT doc_id, i, word, max(CAST(later AS INT)) OVER (
      PARTITION BY doc_id ORDER BY i ROWS BETWEEN 12 PRECEDING AND CURRENT ROW) = 1 AS g FROM marked),
runs AS (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, g ORDER BY i) AS run FROM gone),
factors AS (
  SELECT doc_id, string_agg(s || ':' || e, ',' ORDER BY s) AS factors FROM (
    SELECT doc_id, min(i) - 1 AS s, max(i) AS e FROM runs WHERE g GROUP BY doc_id, run) GROUP BY doc_id),
per AS (
  SELECT doc_id, count(*) FILTER (g) AS n_removed,
         coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT g), '') AS kept FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256, coalesce(factors, '') AS factors
FROM docs d LEFT JOIN per USING (doc_id) LEFT JOIN factors USING (doc_id)
"""

_TERMS = (f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^{SEPARATORS}]+')")

op12_pair_maxscore = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {_TERMS} AS ts FROM documents),
words AS (SELECT d, doc_id, len(ts) AS n, unnest(ts) AS t FROM docs),
numbers AS (SELECT count(*) AS n_docs, CAST(sum(len(ts)) AS BIGINT) AS total FROM docs WHERE len(ts) > 0),
tfs AS (SELECT d, doc_id, t, CAST(n AS BIGINT) AS n, count(*) AS tf FROM words GROUP BY ALL),
weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * n_docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w
  FROM (SELECT t, count(*) AS df FROM tfs GROUP BY t), numbers),
items AS (
  SELECT i, item_id, unnest(list_distinct(ts)) AS t FROM (
    SELECT row_number() OVER () AS i, item_id, {_TERMS} AS ts FROM benchmark)),
scored AS (
  SELECT i, item_id, d, doc_id,
         CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * n_docs) // total)))) AS BIGINT) AS score
  FROM items JOIN tfs USING (t) JOIN weights USING (t), numbers GROUP BY ALL)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
WHERE rank <= {K}
"""

op13_fm_collocations = f"""
WITH pieces AS (
  SELECT lang, unnest(regexp_split_to_array(body, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM (
    SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS body FROM documents)),
rows AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM pieces),
totals AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM rows GROUP BY lang),
grams AS (
  SELECT lang, k AS words, array_to_string(ws[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM (
    SELECT lang, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM rows, range(1, {MAX_WORDS + 1}) t(k) WHERE len(ws) >= k)
  GROUP BY ALL HAVING count(*) >= {MIN_COUNT}),
cand AS (SELECT *, string_split(phrase, ' ') AS ws FROM grams WHERE words > 1),
longer AS (
  SELECT lang, array_to_string(ws[i : i + k - 1], ' ') AS phrase, max(f) AS most FROM (
    SELECT lang, ws, f, k, unnest(range(1, words - k + 2)) AS i FROM cand, range(2, {MAX_WORDS}) t(k) WHERE words > k)
  GROUP BY ALL),
cuts AS (
  SELECT c.lang, c.phrase, c.f AS a, k, array_to_string(c.ws[1 : k], ' ') AS one, array_to_string(c.ws[k + 1 :], ' ') AS two
  FROM cand c LEFT JOIN longer g ON c.lang = g.lang AND c.phrase = g.phrase, range(1, {MAX_WORDS}) t(k)
  WHERE k < c.words AND (most IS NULL OR 100 * most < {INSIDE_PCT} * c.f)),
scored AS (
  SELECT cuts.lang, cuts.phrase, a, k, l.f AS l, r.f AS r, CAST(
      CAST(1000000 AS HUGEINT) * a * a // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
  FROM cuts JOIN grams l ON l.lang = cuts.lang AND l.phrase = one JOIN grams r ON r.lang = cuts.lang AND r.phrase = two),
best AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS o FROM scored) WHERE o = 1)
SELECT lang, rank, phrase, a, l, r, n, score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
JOIN totals USING (lang) WHERE rank <= {TOP}
"""
