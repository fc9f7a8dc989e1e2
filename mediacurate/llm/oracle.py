"""The queries that SQL can express on whole tables, in DuckDB SQL."""

from __future__ import annotations

from mediacurate.llm.mixing import BLOCK, FRAME

_WHITE = r"[\x20\x09-\x0D]"

OP3 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
    generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
keepers AS (
  SELECT key, min(doc_id) AS keeper FROM keyed WHERE length(key) >= 10 GROUP BY key HAVING count(DISTINCT doc_id) > 1),
judged AS (
  SELECT k.doc_id, k.line, k.pos, keeper IS NOT NULL AND keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN keepers USING (key))
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

OP4 = rf"""
WITH rows AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '{_WHITE}', '', 'g') AS content
  FROM documents),
ranked AS (
  SELECT doc_id, content, first_value(doc_id) OVER (PARTITION BY content ORDER BY chars DESC, doc_id) AS keep_id,
    count(*) OVER (PARTITION BY content) AS group_size FROM rows)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(content) AS text_sha256 FROM ranked
"""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

HITS = rf"""
item_words AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, array_to_string(w[i : i + least(len(w), 13) - 1], ' ') AS win, least(len(w), 13) AS n
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 13) + 2)) AS i FROM item_words WHERE len(w) > 0)),
doc_words AS (SELECT doc_id, {_WORDS} AS w, text FROM documents),
sizes AS (SELECT DISTINCT n FROM windows),
doc_windows AS (
  SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM doc_words, sizes WHERE len(w) >= n)),
met AS (SELECT doc_id, i, d.n, item_id FROM doc_windows d JOIN windows USING (win, n)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (
  SELECT doc_id, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT doc_id, i, n FROM met)) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS joined FROM (
  SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM met) GROUP BY doc_id),
judged AS (
  SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
    sha256(coalesce(joined, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM doc_words d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id))
"""

OP8 = f"WITH {HITS} SELECT * FROM judged"

OP9 = f"""
WITH RECURSIVE named AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS src, coalesce(md5(CAST(doc_id AS VARCHAR)), '') AS ord FROM documents),
sizes AS (SELECT src, count(*) AS n, sqrt(count(*)) AS weight FROM named GROUP BY src),
frames AS (SELECT *, CAST(ceil(count(*) OVER () / 100) AS BIGINT) * {FRAME} AS frame, count(*) OVER () AS many,
  sum(weight) OVER () AS total FROM sizes),
wanted AS (SELECT *, (frame - many) * weight / total AS want FROM frames),
spared AS (SELECT *, want - floor(want) AS rest,
  frame - many - sum(CAST(floor(want) AS BIGINT)) OVER () AS spare FROM wanted),
shares AS (SELECT src, frame, row_number() OVER (ORDER BY src) AS number,
  CAST(1 + floor(want) + CASE WHEN row_number() OVER (ORDER BY rest DESC, src) <= spare THEN 1 ELSE 0 END AS BIGINT) AS slots
  FROM spared),
whole AS (SELECT list(slots ORDER BY number) AS slots, max(frame) AS frame FROM shares),
turns AS (
  SELECT CAST(-1 AS BIGINT) AS slot, list_transform(slots, lambda s: CAST(0 AS BIGINT)) AS served, CAST(0 AS BIGINT) AS picked,
    slots, frame FROM whole WHERE frame IS NOT NULL
  UNION ALL
  SELECT slot, list_transform(served, lambda n, i: n + CASE WHEN i = picked THEN 1 ELSE 0 END), picked, slots, frame FROM (
    SELECT slot + 1 AS slot, served, slots, frame,
      CAST(list_sort(list_filter(list_transform(served, lambda n, i:
        CASE WHEN n * frame < (slot + 2) * slots[i]
          THEN [CAST(ceil((n + 1) * frame / slots[i]) AS BIGINT), i] END), lambda x: x IS NOT NULL))[1][2] AS BIGINT) AS picked
    FROM turns WHERE slot + 1 < frame)),
schedule AS (SELECT picked AS number, slot, row_number() OVER (PARTITION BY picked ORDER BY slot) - 1 AS turn
  FROM turns WHERE slot >= 0),
ranked AS (SELECT doc_id, source, src, row_number() OVER (PARTITION BY src ORDER BY ord) - 1 AS rank FROM named),
blocked AS (SELECT r.*, rank // {BLOCK} AS block, number, slots, frame FROM ranked r JOIN shares USING (src))
SELECT doc_id, source, block, block // slots * frame + slot AS slot, CAST(rank % {BLOCK} AS INT) AS place
FROM blocked b JOIN schedule s ON b.number = s.number AND block % slots = turn
"""

OP13 = rf"""
WITH signs AS (SELECT list(list_reduce([b] || range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)
  ORDER BY b) AS sign FROM range(256) r(b)),
doc_words AS (SELECT doc_id, {_WORDS} AS w FROM documents),
item_words AS (SELECT {_WORDS} AS w FROM benchmark),
spelled AS (SELECT word, hex(word) AS x FROM (
  SELECT unnest(w) AS word FROM doc_words UNION SELECT unnest(w) FROM item_words)),
buckets AS (SELECT word, xor(4294967295, list_reduce(
    [4294967295] || list_transform(range(0, len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT)),
    lambda c, b: xor(c >> 8, sign[(xor(c, b) & 255) + 1]))) % 10000 AS bucket FROM spelled, signs),
features AS (SELECT doc_id, bucket FROM (SELECT doc_id, unnest(w) AS word FROM doc_words) JOIN buckets USING (word)),
sources AS (SELECT bucket, count(*) AS s FROM features GROUP BY bucket),
targets AS (SELECT bucket, count(*) AS t FROM (SELECT unnest(w) AS word FROM item_words) JOIN buckets USING (word) GROUP BY bucket),
gains AS (SELECT bucket, floor(1000 * ln(CAST(coalesce(t, 0) + 1 AS DOUBLE) * ((SELECT count(*) FROM features) + 10000)
    / (CAST(s + 1 AS DOUBLE) * ((SELECT coalesce(sum(t), 0) FROM targets) + 10000)))) AS gain
  FROM sources LEFT JOIN targets USING (bucket)),
weights AS (SELECT doc_id, CAST(floor(sum(gain) / count(*)) AS BIGINT) AS weight
  FROM features JOIN gains USING (bucket) GROUP BY doc_id),
scores AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
    coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
    / 4294967296::DOUBLE))) AS BIGINT) AS score FROM doc_words LEFT JOIN weights USING (doc_id)),
drawn AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS many
  FROM scores WHERE n_features >= 20)
SELECT s.doc_id, n_features, weight, score, rank
FROM scores s LEFT JOIN drawn d ON s.doc_id = d.doc_id AND rank <= 10 * many // 100
"""

ORACLE = {
    "op3_line_dedup": OP3,
    "op4_exact_dedup": OP4,
    "op8_decontaminate": OP8,
    "op9_mix": OP9,
    "op13_importance": OP13,
}
