"""SQL twins of the longer queries, for one engine and small tables: all pairs meet, nothing is dealt out."""

from __future__ import annotations

from tidemark.llm.quality import LADDERS
from tidemark.llm.spellings import ALTERED, LEAST_COUNT, LEAST_LENGTH

_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

# the table of the checksum by its rule; a word holds it in ``crc_table``
_CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce(list_concat([n], repeat([0], 8)), lambda c, x:
  CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS crc_table"""


def _crc(data: str) -> str:
    """CRC-32 of a list of bytes."""
    return f"""xor(4294967295, list_reduce(list_concat([4294967295], {data}),
    lambda c, x: xor(c // 256, crc_table[xor(c, x) % 256 + 1])))"""


#: Shingle sets, links of pairs that share a shingle, and what links reach.
JACCARD = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda k: w[k] || ' ' || w[k + 1] || ' ' || w[k + 2]) END) AS s FROM words),
texts AS (SELECT min(doc_id) AS doc_id, list_sort(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS shingle FROM texts),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.shingle = b.shingle AND a.doc_id < b.doc_id
  AND 100 * least(a.n, b.n) >= 90 * greatest(a.n, b.n)
  GROUP BY ALL HAVING 100 * count(*) >= 90 * (any_value(a.n) + any_value(b.n) - count(*))),
arcs AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reached AS (SELECT doc_id, doc_id AS other FROM texts UNION SELECT r.doc_id, arcs.b FROM reached r JOIN arcs ON arcs.a = r.other),
roots AS (SELECT doc_id, min(other) AS root FROM reached GROUP BY doc_id)
SELECT sets.doc_id, CAST(len(sets.s) AS BIGINT) AS n_shingles, coalesce(root, sets.doc_id) AS component_id
FROM sets LEFT JOIN texts ON texts.s = list_sort(sets.s) LEFT JOIN roots ON roots.doc_id = texts.doc_id
"""

_LADDERS = ", ".join(f"({k}, '{rule}', {cutoffs})" for k, (rule, cutoffs) in enumerate(LADDERS.items()))

#: Counts, scores, exact binomial tails of every ladder step, and the verdicts.
QUALITY = rf"""WITH ladders(place, rule, cutoffs) AS (VALUES {_LADDERS}),
texts AS (
  SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS t,
         regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda line: regexp_matches(line, '[^\x20\x09-\x0D]')) AS lines FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 1)) AS k, w[k:k + 2] AS gram FROM texts),
again AS (SELECT doc_id, k, count(*) OVER (PARTITION BY doc_id, gram) AS n FROM windows),
repeated AS (
  SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([k, k + 1, k + 2]) AS place FROM again WHERE n > 1)
  GROUP BY doc_id),
counts AS (
  SELECT doc_id, stratum, len(w) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words,
         len(lines) AS n_lines, length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper,
         length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(t, '[^!?]', '', 'g')) AS n_marks,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed
  FROM texts LEFT JOIN repeated USING (doc_id)),
scores AS (
  SELECT doc_id, stratum, base_failed, place, rule, CAST(cutoffs AS DOUBLE[]) AS cutoffs, coalesce(CASE rule
    WHEN 'symbols_per_word' THEN n_symbols / greatest(n_words, 1) WHEN 'shouted_share' THEN n_upper / nullif(n_letters, 0)
    WHEN 'repeated_share' THEN n_repeat_words / greatest(n_words, 1) WHEN 'copied_line_share' THEN n_dup_lines / nullif(n_lines, 0)
    ELSE n_marks / greatest(n_words, 1) END, 0) AS score FROM counts, ladders),
known AS (SELECT doc_id, min(quality) > 0 AS good FROM labels WHERE quality IS NOT NULL GROUP BY doc_id),
held AS (SELECT * FROM scores JOIN known USING (doc_id) WHERE NOT base_failed),
steps AS (
  SELECT stratum, place, step, cutoff, count(*) FILTER (good AND score > cutoff) AS wrong,
         count(*) FILTER (NOT good AND score > cutoff) AS caught, count(*) FILTER (good) AS trials
  FROM (SELECT *, unnest(range(len(cutoffs))) AS step, cutoffs[step + 1] AS cutoff FROM held) GROUP BY ALL),
tails AS (
  SELECT *, 0.02 / {len(LADDERS)} AS rate, list_sum(list_transform(range(wrong + 1), lambda k: exp(
           lgamma(trials + 1) - lgamma(k + 1) - lgamma(trials - k + 1) + k * ln(rate) + (trials - k) * ln(1 - rate)))) AS tail,
         0.05 / ((SELECT count(DISTINCT stratum) FROM held) * {len(LADDERS)}) AS level FROM steps),
proven AS (
  SELECT *, caught - 10 * wrong AS gain, bool_and(trials > 0 AND (wrong < trials AND tail <= level)) OVER (
    PARTITION BY stratum, place ORDER BY step) AS sure FROM tails),
chosen AS (
  SELECT stratum, place, first(cutoff ORDER BY gain DESC, step) AS chosen FROM proven WHERE sure AND gain > 0 GROUP BY stratum, place),
failed AS (
  SELECT doc_id, first(rule ORDER BY place) AS failed_rule FROM scores JOIN chosen USING (stratum, place) WHERE score > chosen
  GROUP BY doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND failed_rule IS NULL AS kept, failed_rule
FROM counts LEFT JOIN failed USING (doc_id)
"""

#: Words with their planted alterations, near words by one masked or one missing letter, forms and roots.
SPELLINGS = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
found AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, unnest(regexp_extract_all(
    translate(text, {_LOWER}), '[a-zÀ-ÿ]+')) AS run FROM documents),
runs AS (SELECT id, run, count(*) AS n FROM found GROUP BY id, run),
summed AS MATERIALIZED (
  SELECT run, n, {_crc('''flatten(list_transform(string_split(id || ':' || run, ''),
    lambda l: CASE WHEN unicode(l) < 128 THEN [unicode(l)] ELSE [195, unicode(l) - 64] END))''')} AS h FROM runs, crc),
altered AS (
  SELECT CASE WHEN h % {ALTERED} = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM summed),
words AS MATERIALIZED (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM altered WHERE length(word) >= {LEAST_LENGTH} GROUP BY word HAVING sum(altered.n) >= {LEAST_COUNT}),
places AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words),
masked AS (SELECT word, n, k, word[:k - 1] || '*' || word[k + 1:] AS pattern, word[:k - 1] || word[k + 1:] AS shorter FROM places),
near AS (
  SELECT a.word, b.word AS near, b.n AS near_n FROM masked a JOIN masked b ON a.pattern = b.pattern AND a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM masked a JOIN words b ON a.shorter = b.word
  UNION SELECT b.word, a.word, a.n FROM masked a JOIN words b ON a.shorter = b.word),
best AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM near GROUP BY word),
forms AS MATERIALIZED (
  SELECT words.word, CASE WHEN near_n >= 2 * n THEN near END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM words LEFT JOIN best USING (word)),
ways AS (SELECT word, word AS root FROM forms UNION ALL SELECT ways.word, form FROM ways JOIN forms ON forms.word = root WHERE form IS NOT NULL)
SELECT forms.*, root FROM forms JOIN ways USING (word) JOIN forms ends ON ends.word = root WHERE ends.form IS NULL
"""

#: The damage, the faults, and the cheapest edits from the last row back to the first.
CONVERSATIONS = rf"""
WITH RECURSIVE crc AS ({_CRC_TABLE}),
placed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {_crc('''list_transform(string_split(
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda l: unicode(l))''')} % 20 AS h
  FROM conversations, crc),
damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE h WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM placed),
ranked AS MATERIALIZED (
  SELECT *, role[:1] AS initial, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k FROM damaged),
faults AS MATERIALIZED (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
                 WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault FROM ranked),
pairs AS (SELECT *, lag(initial) OVER (PARTITION BY conv_id ORDER BY k) || initial AS pair FROM faults),
tally AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(k) AS rows FROM pairs GROUP BY conv_id),
-- cheapest edits of the rows from k on; states: at the start, behind a system's, a user's, an assistant's message
solved AS (
  SELECT conv_id, rows AS k, [{{c: 0, a: '', r: ''}}, {{c: 10, a: 'II', r: chr(10) || 'user:' || chr(10) || 'assistant:'}},
                              {{c: 5, a: 'I', r: chr(10) || 'assistant:'}}, {{c: 0, a: '', r: ''}}] AS best FROM tally
  UNION ALL
  SELECT conv_id, k - 1, list_transform([1, 2, 3, 4], lambda s: list_min([
           own[s], {{c: 5 + own[after[s]].c, a: 'I' || own[after[s]].a, r: lines[s] || own[after[s]].r}},
           {{c: 10 + own[after[after[s]]].c, a: 'II' || own[after[after[s]]].a, r: lines[s] || lines[after[s]] || own[after[after[s]]].r}}]))
  FROM (
    SELECT conv_id, k, after, list_transform(names, lambda name: chr(10) || name || ':') AS lines, list_transform([1, 2, 3, 4], lambda s: list_min([
             {{c: 2 + best[s].c, a: 'D' || best[s].a, r: best[s].r}},
             {{c: must + cut + 1 + best[after[s]].c, a: 'R' || best[after[s]].a, r: chr(10) || names[s] || ':' || text || best[after[s]].r}},
             {{c: must + cut + coalesce(best[keep[s]].c, 1000000), a: 'K' || coalesce(best[keep[s]].a, ''),
               r: chr(10) || role || ':' || text || coalesce(best[keep[s]].r, '')}}])) AS own
    FROM (
      SELECT solved.conv_id, solved.k, best, role, text, [3, 3, 4, 3] AS after, ['user', 'user', 'assistant', 'user'] AS names,
             CASE initial WHEN 's' THEN [2, 0, 0, 0] WHEN 'u' THEN [3, 3, 0, 3] WHEN 'a' THEN [0, 0, 4, 0] ELSE [0, 0, 0, 0] END AS keep,
             CASE WHEN fault IN ('blank', 'duplicate') THEN 1000000 ELSE 0 END AS must, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS cut
      FROM solved JOIN faults ON faults.conv_id IS NOT DISTINCT FROM solved.conv_id AND faults.k = solved.k))),
done AS (SELECT conv_id, best[1] AS way FROM solved WHERE k = 0)
SELECT p.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(way.c, 0) AS BIGINT) AS cost,
       coalesce(way.a, '') AS audit, sha256(coalesce(way.r[2:], '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM placed) p LEFT JOIN tally ON tally.conv_id IS NOT DISTINCT FROM p.conv_id
LEFT JOIN done ON done.conv_id IS NOT DISTINCT FROM p.conv_id
"""
