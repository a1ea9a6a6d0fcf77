"""The derived views once more, as plain SQL for the checking engine."""

NORM = r"array_to_string(regexp_extract_all(lower(translate({0},'İ','i')),'[\p{{L}}\p{{N}}_]+'),' ')"
TOKENS = r"regexp_extract_all(lower(translate({0},'İ','i')),'\p{{L}}+')"


def norm(column: str = "text") -> str:
    return NORM.format(column)


def tokens(column: str = "text") -> str:
    return TOKENS.format(column)


VIEWS = f"""
lines AS (
  SELECT doc_id AS track_id, unnest(string_split(text, chr(10))) AS text,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS pos
  FROM documents),
kept AS (
  SELECT *, length(text) AS n, row_number() OVER (PARTITION BY track_id ORDER BY pos) AS cue_id
  FROM lines WHERE text <> ''),
timed AS (
  SELECT *, least(500 + n * (40 + (track_id * 7 + pos * 13) % 80), 30000) AS dur,
         ((track_id * 31 + pos * 17) % 23) * 600
           - CASE WHEN (pos * 11 + track_id) % 29 = 0 AND cue_id > 1 THEN 400 ELSE 0 END AS lead_ms
  FROM kept),
ended AS (
  SELECT *, CAST(sum(lead_ms + dur) OVER (PARTITION BY track_id ORDER BY cue_id
                                          ROWS UNBOUNDED PRECEDING) AS BIGINT) AS end_ms
  FROM timed),
cues AS (SELECT track_id, cue_id, end_ms - dur AS start_ms, end_ms, text FROM ended),
media AS (
  SELECT track_id, max(end_ms) + (track_id % 4) * 5000 AS duration_ms FROM cues GROUP BY track_id),
labelled AS (
  SELECT track_id, cue_id, start_ms, end_ms,
         CASE WHEN length(text) < 24 THEN '[' || text || ']' ELSE text END AS text FROM cues),
speech AS (
  SELECT track_id, cue_id, start_ms + (cue_id % 4) * 300 AS start_ms,
         end_ms + (cue_id % 5) * 700 AS end_ms
  FROM cues WHERE length(text) >= 24),
ref AS (
  SELECT track_id, cue_id, start_ms + 4860 + (cue_id % 3) * 100 AS start_ms,
         end_ms + 4860 + (cue_id % 3) * 100 AS end_ms, text
  FROM cues WHERE NOT contains(text, 'z')),
target AS (
  SELECT track_id, cue_id, start_ms + (cue_id % 5) * 150 AS start_ms,
         greatest(end_ms - (cue_id % 3) * 100, start_ms + (cue_id % 5) * 150 + 100) AS end_ms,
         replace(text, 'en', 'an') AS text
  FROM cues WHERE NOT contains(text, 'k')),
target_long AS (
  SELECT track_id, (cue_id - 1) // 3 + 1 AS cue_id, min(start_ms) AS start_ms, max(end_ms) AS end_ms
  FROM cues GROUP BY ALL),
edited AS (
  SELECT track_id, cue_id, start_ms,
         end_ms + CASE WHEN contains(text, 'w') THEN 250 ELSE 0 END AS end_ms,
         CASE WHEN contains(text, 'q') THEN text || ' !' ELSE text END AS text
  FROM cues WHERE length(text) >= 16),
renumbered AS (
  SELECT track_id, row_number() OVER (PARTITION BY track_id ORDER BY cue_id) AS cue_id, start_ms, end_ms, text
  FROM edited),
word_lists AS (
  SELECT track_id, cue_id, start_ms AS s, end_ms AS e, {tokens()} AS w FROM cues),
word_rows AS (
  SELECT track_id, cue_id, s, e, len(w) AS n, unnest(w) AS text, generate_subscripts(w, 1) - 1 AS pos
  FROM word_lists),
words AS (
  SELECT track_id, cue_id, pos, text,
         CASE WHEN length(text) > 1 THEN s + pos * ((e - s) // n) END AS start_ms,
         CASE WHEN length(text) > 1 THEN s + (pos + 1) * ((e - s) // n) END AS end_ms
  FROM word_rows),
heard_cues AS (
  SELECT track_id, ((start_ms + end_ms) // 2) // 30000 AS w,
         string_agg(text, ' ' ORDER BY cue_id) AS text
  FROM cues WHERE NOT contains(text, 'x') GROUP BY ALL),
heard_grid AS (
  SELECT track_id, duration_ms, unnest(range(0, (duration_ms - 1) // 30000 + 1)) AS w FROM media),
heard AS (
  SELECT g.track_id, g.w * 30000 AS start_ms, least((g.w + 1) * 30000, duration_ms) AS end_ms,
         coalesce(text, '') AS text, length(coalesce(text, '')) % 300 AS generation_tokens
  FROM heard_grid g LEFT JOIN heard_cues h ON g.track_id = h.track_id AND g.w = h.w),
ledger AS (
  SELECT user_id AS auth_id, event_id,
         CASE event_type WHEN 'purchase' THEN 'call' ELSE 'upload' END AS kind,
         (event_id % 97) * 1000 AS duration_ms,
         length(props) * 100 + event_id % 500 AS prompt_bytes,
         CAST(floor(value * 100) / 100000 AS DECIMAL(18,8)) AS charge,
         CASE WHEN event_type = 'click' AND event_id % 3 = 0 THEN 'full-episode' END AS label,
         CASE WHEN event_type = 'purchase' AND event_id % 4 = 0 THEN 'full_episode_observation' END AS stage, ts AS at
  FROM events WHERE event_type IN ('purchase', 'click')),
turns AS (SELECT conv_id AS track_id, turn + 1 AS cue_id, role, text FROM conversations)
"""
