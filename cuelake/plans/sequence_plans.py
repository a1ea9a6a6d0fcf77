"""Order-based queries: repetition, validation, batches, samples, generated ranges, clips."""

from pyspark.sql import functions as F

from cuelake.functions import midpoint
from cuelake.functions.base import idiv
from cuelake.operators import intervals as iv
from cuelake.operators import sequences as sq
from cuelake.operators.ordered import id_chunk, scan
from cuelake.plans.registry import plan
from cuelake.plans.views import norm

RUNS = """
r_n AS (SELECT track_id, cue_id, start_ms, end_ms, {expr} AS norm FROM {src}),
r_f AS (SELECT *, CASE WHEN norm = lag(norm) OVER w THEN 0 ELSE 1 END AS fresh FROM r_n WINDOW w AS (PARTITION BY track_id ORDER BY cue_id)),
r_i AS (SELECT *, sum(fresh) OVER (PARTITION BY track_id ORDER BY cue_id ROWS UNBOUNDED PRECEDING) AS island FROM r_f),
all_runs AS (SELECT track_id, min(cue_id) AS first_id, max(cue_id) AS last_id, min(start_ms) AS start_ms,
  arg_max(end_ms, cue_id) AS end_ms, count(*) AS n_rows, min(norm) AS norm FROM r_i GROUP BY track_id, island)"""


@plan("repetition_runs_w3", f""",
{RUNS.format(expr=norm(), src='cues')}
SELECT * FROM all_runs WHERE n_rows >= 3 AND length(norm) >= 8""")
def repetition_runs_w3(t):
    return sq.runs(t.cues)


@plan("repeated_pairs_w3", f""",
{RUNS.format(expr=norm(), src='target')}
SELECT * FROM all_runs WHERE n_rows >= 2 AND length(norm) >= 8""")
def repeated_pairs_w3(t):
    return sq.runs(t.target, 2, 8)


@plan("longest_run_w7", f""",
{RUNS.format(expr='text', src='cues')}
SELECT track_id, max(n_rows) AS longest FROM all_runs GROUP BY 1""")
def longest_run_w7(t):
    return sq.longest_run(t.cues)


@plan("validate_w8", """
SELECT track_id, cue_id, 'ends_after_media' AS error FROM edited JOIN media USING (track_id) WHERE end_ms > duration_ms
UNION ALL
SELECT track_id, cue_id, 'out_of_order' FROM (SELECT *, lag(start_ms) OVER (PARTITION BY track_id ORDER BY cue_id) AS ps FROM edited) WHERE ps > start_ms
UNION ALL
SELECT track_id, cue_id, 'overlap' FROM (SELECT *, lag(end_ms) OVER (PARTITION BY track_id ORDER BY cue_id) AS pe FROM edited) WHERE pe > start_ms""")
def validate_w8(t):
    return sq.validate(t.edited, t.media)


@plan("layout_overlap_w9", """
SELECT track_id, l AS left_id, cue_id AS right_id FROM (
 SELECT *, lag(cue_id) OVER w AS l, lag(end_ms) OVER w AS pe FROM edited WINDOW w AS (PARTITION BY track_id ORDER BY start_ms, end_ms, cue_id))
WHERE start_ms < pe""")
def layout_overlap_w9(t):
    return sq.layout_check(t.edited)


WINDOWS_SQL = """
rw AS (SELECT track_id, start_ms, end_ms, text,
 CASE WHEN text='' THEN 'empty' WHEN generation_tokens>=290 THEN 'truncated' WHEN generation_tokens<20 THEN 'questionable' ELSE 'complete' END AS status,
 CASE WHEN text='' THEN 'empty_asr_output' WHEN generation_tokens>=10 AND generation_tokens<20 THEN 'repeated_asr_output' END AS issue
 FROM heard WHERE NOT contains(text, 'k'))"""


def recog_windows(t):
    n = F.col("generation_tokens")
    status = F.when(F.col("text") == "", "empty").when(n >= 290, "truncated").when(n < 20, "questionable").otherwise("complete")
    issue = F.when(F.col("text") == "", "empty_asr_output").when((n >= 10) & (n < 20), "repeated_asr_output")
    return t.heard.where(~F.contains("text", F.lit("k"))).select(
        "track_id", "start_ms", "end_ms", "text", status.alias("status"), issue.alias("issue"))


@plan("scan_contiguity_w10", f""", {WINDOWS_SQL},
o AS (SELECT rw.*, duration_ms, lag(end_ms) OVER w AS pe, lead(start_ms) OVER w AS ns FROM rw JOIN media USING (track_id)
 WINDOW w AS (PARTITION BY track_id ORDER BY start_ms)),
e AS (SELECT track_id, start_ms, CASE
  WHEN coalesce(pe,0) <> start_ms OR end_ms <= start_ms OR end_ms > duration_ms OR (ns IS NULL AND end_ms <> duration_ms) THEN 'missing_or_malformed_interval'
  WHEN status IN ('failed','truncated','unusable') THEN 'unusable_interval'
  WHEN (status='empty') <> (trim(text)='') OR (status='empty' AND coalesce(issue,'') <> 'empty_asr_output') OR (status='questionable' AND issue IS NULL) THEN 'inconsistent_window' END AS error FROM o)
SELECT * FROM e WHERE error IS NOT NULL
UNION ALL SELECT track_id, NULL, 'no_windows' FROM media WHERE track_id NOT IN (SELECT track_id FROM rw)""")
def scan_contiguity_w10(t):
    return sq.scan_gaps(recog_windows(t), t.media)


@plan("inner_gap_w12", """
SELECT track_id, translation_id, max(g) AS gap_ms FROM (
 SELECT c.track_id, (c.cue_id-1)//3+1 AS translation_id, c.start_ms - lag(c.end_ms) OVER (PARTITION BY c.track_id, (c.cue_id-1)//3 ORDER BY c.start_ms, c.end_ms) AS g FROM cues c)
GROUP BY ALL HAVING max(g) > 1000""")
def inner_gap_w12(t):
    links = t.cues.select("track_id", (idiv(F.col("cue_id") - 1, 3) + 1).alias("translation_id"),
                          F.col("cue_id").alias("unit_id"), "start_ms", "end_ms")
    return sq.inner_gap(links)


@plan("context_batches_w13", """
, n AS (SELECT track_id, cue_id, row_number() OVER (PARTITION BY track_id ORDER BY cue_id) - 1 AS i FROM turns),
b AS (SELECT DISTINCT track_id, i // 5 AS k FROM n)
SELECT n.track_id, b.k + 1 AS batch_no, n.cue_id,
 CASE WHEN i < b.k*5 THEN 'previous' WHEN i >= (b.k+1)*5 THEN 'next' ELSE 'target' END AS role
FROM n JOIN b ON n.track_id=b.track_id AND i >= b.k*5-3 AND i < (b.k+1)*5+3""")
def context_batches_w13(t):
    return sq.batches(t.turns, 5, 3)


def numbered(df, weight):
    ranked = scan(df.select("track_id", "cue_id", weight.alias("weight")), ["track_id"], ["cue_id"],
                  id_chunk("cue_id"), number="row_no")
    return ranked.select("track_id", "row_no", "weight")


GREEDY = """/*recursive*/, n AS (SELECT track_id, row_number() OVER (PARTITION BY track_id ORDER BY cue_id) AS row_no, {weight} AS w FROM cues),
p AS (SELECT *, sum(w) OVER (PARTITION BY track_id ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS upto, max(row_no) OVER (PARTITION BY track_id) AS n FROM n),
walk AS (
 SELECT track_id, row_no, n, w, CASE WHEN w > {budget} THEN {rows} ELSE 1 END AS k, w AS used, CASE WHEN w > {budget} THEN 0 ELSE 1 END::BIGINT AS batch_no FROM p WHERE row_no = 1
 UNION ALL
 SELECT p.track_id, p.row_no, p.n, p.w,
  CASE WHEN p.w > {budget} THEN {rows} WHEN k = {rows} OR used + p.w > {budget} THEN 1 ELSE k + 1 END,
  CASE WHEN k = {rows} OR used + p.w > {budget} THEN p.w ELSE used + p.w END,
  CASE WHEN p.w <= {budget} AND (k = {rows} OR used + p.w > {budget}) THEN batch_no + 1 ELSE batch_no END
 FROM walk JOIN p ON p.track_id = walk.track_id AND p.row_no = walk.row_no + 1)
SELECT p.track_id, p.row_no, CASE WHEN p.w <= {budget} THEN walk.batch_no END AS batch_no FROM p LEFT JOIN walk USING (track_id, row_no)"""


@plan("char_batches_w15", GREEDY.format(weight="length(text) * CASE WHEN cue_id % 97 = 0 THEN 1000 ELSE 1 END", budget=5000, rows=100))
def char_batches_w15(t):
    """Some cues are blown up beyond the budget: they get no batch and the walk goes on."""
    weight = (F.length("text") * F.when(F.col("cue_id") % 97 == 0, 1000).otherwise(1)).cast("bigint")
    return sq.greedy_batches(numbered(t.cues, weight), ["track_id"], 100, 5000)


@plan("byte_batches_w14", """/*recursive*/, n AS (SELECT track_id, row_number() OVER (PARTITION BY track_id ORDER BY cue_id) AS row_no, strlen(text) + 24 AS w FROM cues),
p AS MATERIALIZED (SELECT *, sum(w) OVER (PARTITION BY track_id ORDER BY row_no ROWS UNBOUNDED PRECEDING) AS upto, count(*) OVER (PARTITION BY track_id) AS n FROM n),
k AS MATERIALIZED (SELECT a.track_id, a.row_no, count(*) FILTER (c.upto - coalesce(b.upto, 0) <= 12000 - 600) AS k FROM p a JOIN p e ON e.track_id = a.track_id AND e.row_no BETWEEN a.row_no AND a.row_no + 19
 JOIN p c ON c.track_id = a.track_id AND c.row_no = least(a.n, e.row_no + 4) LEFT JOIN p b ON b.track_id = a.track_id AND b.row_no = a.row_no - 5 GROUP BY 1, 2),
walk AS (SELECT track_id, row_no, k, CASE WHEN k > 0 THEN 1 ELSE 0 END::BIGINT AS batch_no FROM k WHERE row_no = 1
 UNION ALL SELECT k.track_id, k.row_no, k.k, batch_no + CASE WHEN k.k > 0 THEN 1 ELSE 0 END FROM walk JOIN k ON k.track_id = walk.track_id AND k.row_no = walk.row_no + greatest(walk.k, 1))
SELECT track_id, row_no + CAST(g AS BIGINT) AS row_no, CASE WHEN k > 0 THEN batch_no END AS batch_no FROM walk, range(20) r(g) WHERE g < greatest(k, 1)""")
def byte_batches_w14(t):
    """Input bytes with four rows of context on each side."""
    weight = (F.octet_length("text") + 24).cast("bigint")
    return sq.greedy_batches(numbered(t.cues, weight), ["track_id"], 20, 12_000, fixed=600,
                             context=4, context_weight=True)


@plan("samples_w16", """
, n AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY cue_id) AS row_no, count(*) OVER (PARTITION BY track_id) AS c FROM cues)
SELECT track_id, cue_id, min(f)::DOUBLE AS fraction, min((start_ms+end_ms)//2) AS at_ms
FROM n, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) v(f) WHERE row_no = round_even((c-1)*f, 0)::BIGINT + 1 GROUP BY ALL""".replace("GROUP BY ALL", "GROUP BY track_id, cue_id"))
def samples_w16(t):
    return sq.samples(t.cues)


@plan("link_order_w17", """
, l AS (SELECT b.track_id, b.cue_id + (b.cue_id * 7) % 11 * 3 AS item_no, min(a.cue_id) AS first_idx, max(a.cue_id) AS last_idx
 FROM ref b JOIN cues a ON a.track_id=b.track_id AND a.start_ms<b.end_ms AND a.end_ms>b.start_ms GROUP BY ALL)
SELECT * FROM (SELECT *, max(last_idx) OVER (PARTITION BY track_id ORDER BY item_no ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reached FROM l)
WHERE first_idx < reached""")
def link_order_w17(t):
    pairs = iv.interval_join(
        t.ref.select("track_id", (F.col("cue_id") + (F.col("cue_id") * 7) % 11 * 3).alias("item_no"), "start_ms", "end_ms"),
        t.cues.select("track_id", "cue_id", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end")),
        ["track_id"])
    items = pairs.groupBy("track_id", "item_no").agg(
        F.min("cue_id").alias("first_idx"), F.max("cue_id").alias("last_idx"))
    return sq.link_order(items)


@plan("same_scene_w18", """
, g AS (SELECT *, (cue_id-1)//5 AS scene FROM cues),
o AS (SELECT *, lag(end_ms) OVER (PARTITION BY track_id, scene ORDER BY start_ms, end_ms) AS pe FROM g)
SELECT track_id, scene, bool_and(pe IS NULL OR start_ms <= pe + 2000) AS one_scene, count(*) AS n_flags FROM o GROUP BY ALL""")
def same_scene_w18(t):
    return sq.same_scene(t.cues.withColumn("scene", idiv(F.col("cue_id") - 1, 5)), ["track_id", "scene"])


@plan("retime_check_w20", """
SELECT track_id, cue_id, start_ms - 800 AS new_start, end_ms + 400 AS new_end,
 start_ms - 800 < end_ms + 400 AND (pe IS NULL OR pe <= start_ms - 800) AND (ns IS NULL OR end_ms + 400 <= ns) AS ok
FROM (SELECT *, lag(end_ms) OVER w AS pe, lead(start_ms) OVER w AS ns FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY cue_id))""")
def retime_check_w20(t):
    proposals = t.cues.select("track_id", "cue_id", (F.col("start_ms") - 800).alias("new_start"),
                              (F.col("end_ms") + 400).alias("new_end"))
    return sq.retime_ok(t.cues, proposals)


CLIPS = """clips AS (SELECT track_id, core_start_ms//{core} + 1 AS clip_no, greatest(0, core_start_ms-{ov}) AS offset_ms, core_start_ms,
 least(duration_ms, core_start_ms+{core}) AS core_end_ms, least(duration_ms, core_start_ms+{core}+{ov}) AS audio_end_ms
 FROM (SELECT track_id, duration_ms, unnest(range(0, duration_ms, {core})) AS core_start_ms FROM media))"""


@plan("clip_ranges_g1", f", {CLIPS.format(core=300000, ov=5000)} SELECT * FROM clips")
def clip_ranges_g1(t):
    return sq.clip_ranges(t.media)


@plan("review_windows_g2", """
/*recursive*/, b AS (SELECT track_id, cue_id AS issue_id, greatest(0, start_ms-60000) AS lo, least(duration_ms, end_ms+60000) AS hi FROM cues JOIN media USING (track_id)),
w AS (SELECT track_id, issue_id, lo AS start_ms, least(lo+50000, hi) AS end_ms, hi FROM b WHERE lo < hi
 UNION ALL SELECT track_id, issue_id, end_ms-2000, least(end_ms-2000+50000, hi), hi FROM w WHERE end_ms < hi)
SELECT track_id, issue_id, start_ms, end_ms FROM w""")
def review_windows_g2(t):
    issues = t.cues.select("track_id", F.col("cue_id").alias("issue_id"), "start_ms", "end_ms")
    return sq.review_windows(issues, t.media, 60_000)


@plan("scan_windows_g3", """
SELECT track_id, s AS start_ms, least(duration_ms, s+30000) AS end_ms FROM (SELECT *, unnest(range(0, duration_ms, 30000)) AS s FROM media)""")
def scan_windows_g3(t):
    return sq.scan_windows(t.media)


@plan("align_windows_g4", """
, k AS (SELECT track_id, duration_ms, ((start_ms+end_ms)//2)//60000 AS k, min(start_ms) AS lo, max(end_ms) AS hi, count(*) AS n_units
 FROM cues JOIN media USING (track_id) WHERE (start_ms+end_ms)//2 < duration_ms GROUP BY ALL)
SELECT track_id, k*60000 AS core_start_ms, least(k*60000+60000, duration_ms) AS core_end_ms,
 greatest(0, least(k*60000-2000, lo-500)) AS audio_start_ms,
 least(duration_ms, greatest(least(k*60000+60000, duration_ms)+2000, hi+500)) AS audio_end_ms, n_units FROM k""")
def align_windows_g4(t):
    return sq.align_windows(t.cues, t.media)


@plan("eval_windows_g5", """
SELECT track_id, p AS percent, s AS start_ms, least(s+180000, duration_ms) AS end_ms FROM (
 SELECT *, greatest(0, least(duration_ms*p//100 - 90000, duration_ms-180000)) AS s FROM (SELECT *, unnest([3,27,50,73,97]::BIGINT[]) AS p FROM media))""")
def eval_windows_g5(t):
    return sq.eval_windows(t.media)


@plan("boundary_points_g6", """
SELECT DISTINCT track_id, unnest([start_ms + least(100,(end_ms-start_ms)//4), end_ms - least(100,(end_ms-start_ms)//4)]) AS at_ms
FROM edited JOIN media USING (track_id) WHERE contains(text, 'ou') AND end_ms <= duration_ms""")
def boundary_points_g6(t):
    status = F.when(F.contains("text", F.lit("ou")), "resolved").otherwise("reviewed")
    return sq.boundary_points(t.edited.withColumn("status", status), t.media)


@plan("cue_points_g7", """
SELECT track_id, cue_id, label, at_ms FROM (
 SELECT track_id, cue_id, 'before' AS label, start_ms-250 AS at_ms FROM cues UNION ALL
 SELECT track_id, cue_id, 'during', (start_ms+end_ms)//2 FROM cues UNION ALL
 SELECT track_id, cue_id, 'after', end_ms+250 FROM cues) JOIN media USING (track_id) WHERE at_ms >= 0 AND at_ms < duration_ms""")
def cue_points_g7(t):
    return sq.cue_points(t.cues, t.media)


def short_clips(t):
    return sq.clip_ranges(t.media, 60_000, 5_000)


def clip_cues(t):
    """Cues as each overlapping clip would show them, on the clip's own clock."""
    clips = short_clips(t).select("track_id", "clip_no", "offset_ms", F.col("offset_ms").alias("r_start"),
                                  F.col("audio_end_ms").alias("r_end"))
    pairs = iv.interval_join(t.cues, clips, ["track_id"])
    return pairs.select("track_id", "clip_no", "cue_id", (F.col("start_ms") - F.col("offset_ms")).alias("start_ms"),
                        (F.col("end_ms") - F.col("offset_ms")).alias("end_ms"), "text")


CLIP_CUES = CLIPS.format(core=60000, ov=5000) + """,
clip_cues AS (SELECT c.track_id, k.clip_no, c.cue_id, c.start_ms, c.end_ms, c.text, k.core_start_ms, k.core_end_ms
 FROM cues c JOIN clips k ON c.track_id=k.track_id AND c.start_ms < k.audio_end_ms AND c.end_ms > k.offset_ms)"""


@plan("clip_clock_s17", f", {CLIP_CUES} SELECT track_id, clip_no, cue_id, start_ms, end_ms FROM clip_cues")
def clip_clock_s17(t):
    return sq.shift_cues(clip_cues(t), short_clips(t)).drop("text")


X5_SQL = """ SELECT track_id, clip_no, cue_id, start_ms, end_ms FROM clip_cues WHERE {rule}"""
OWNER = "(core_start_ms <= (start_ms+end_ms)//2 AND (start_ms+end_ms)//2 < core_end_ms)"


def assembled(t, mode):
    return sq.assemble(sq.shift_cues(clip_cues(t), short_clips(t)), short_clips(t), mode).drop("text")


@plan("clip_owner_x5", f", {CLIP_CUES}" + X5_SQL.format(rule=OWNER))
def clip_owner_x5(t):
    return assembled(t, "core")


@plan("clip_touch_x5", f", {CLIP_CUES}" + X5_SQL.format(rule="start_ms < core_end_ms AND end_ms > core_start_ms"))
def clip_touch_x5(t):
    return assembled(t, "touch")


@plan("clip_cross_x5", f", {CLIP_CUES}" + X5_SQL.format(
    rule=f"{OWNER} OR (start_ms < core_start_ms AND core_start_ms < end_ms) OR (start_ms < core_end_ms AND core_end_ms < end_ms)"))
def clip_cross_x5(t):
    return assembled(t, "cross")


@plan("seam_views_w19", f""", {CLIP_CUES},
s AS (SELECT a.track_id, a.core_end_ms AS boundary_ms, a.clip_no AS l, b.clip_no AS r FROM clips a JOIN clips b ON a.track_id=b.track_id AND b.clip_no=a.clip_no+1)
SELECT c.track_id, s.boundary_ms, CASE WHEN c.clip_no=s.l THEN 'left' ELSE 'right' END AS side, c.cue_id, c.start_ms, c.end_ms
FROM s JOIN clip_cues c ON c.track_id=s.track_id AND c.clip_no IN (s.l, s.r)
WHERE c.start_ms < s.boundary_ms+10000 AND c.end_ms > greatest(0, s.boundary_ms-10000)""")
def seam_views_w19(t):
    return sq.seam_views(sq.shift_cues(clip_cues(t), short_clips(t)), short_clips(t)).select(
        "track_id", "boundary_ms", "side", "cue_id", "start_ms", "end_ms")


@plan("seam_duplicates_w19", f""", {CLIP_CUES},
s AS (SELECT a.track_id, a.core_end_ms AS boundary_ms, a.clip_no AS l, b.clip_no AS r FROM clips a JOIN clips b ON a.track_id=b.track_id AND b.clip_no=a.clip_no+1),
v AS (SELECT c.*, s.boundary_ms, s.l, {norm('c.text')} AS norm
 FROM s JOIN clip_cues c ON c.track_id=s.track_id AND c.clip_no IN (s.l, s.r)
 WHERE c.start_ms < s.boundary_ms+10000 AND c.end_ms > greatest(0, s.boundary_ms-10000))
SELECT a.track_id, a.boundary_ms, a.cue_id AS left_id, b.cue_id AS right_id FROM v a JOIN v b
ON a.track_id=b.track_id AND a.boundary_ms=b.boundary_ms AND a.clip_no=a.l AND b.clip_no=b.l+1 AND a.norm=b.norm
AND a.start_ms < b.end_ms AND a.end_ms > b.start_ms""")
def seam_duplicates_w19(t):
    return sq.seam_duplicates(sq.shift_cues(clip_cues(t), short_clips(t)), short_clips(t))


def slow_chunks(t):
    """Chunks that hold a line repeated right after itself."""
    return sq.chunks_for_runs(sq.runs(t.cues, 2, 1), 2, 60_000)


SLOW = f"""{RUNS.format(expr=norm(), src='cues')},
slow AS (SELECT DISTINCT track_id, unnest(range(start_ms//60000, end_ms//60000+1)) AS chunk_no FROM all_runs WHERE n_rows >= 2 AND length(norm) >= 1)"""


@plan("chunks_for_runs_o5", f", {SLOW} SELECT * FROM slow")
def chunks_for_runs_o5(t):
    return slow_chunks(t)


@plan("loop_priority_o4", f""", {RUNS.format(expr=norm(), src='cues')}
SELECT track_id, CAST(sum(end_ms-start_ms) AS BIGINT) AS loop_ms FROM all_runs WHERE n_rows >= 3 AND length(norm) >= 1 GROUP BY 1""")
def loop_priority_o4(t):
    return sq.loop_priority(sq.runs(t.cues, 2, 1), 3)


@plan("replace_chunks_x6", f""", {SLOW},
n AS (SELECT *, ((start_ms+end_ms)//2)//60000 AS mid FROM cues)
SELECT track_id, start_ms, end_ms, 'kept' AS origin FROM n WHERE NOT EXISTS (SELECT 1 FROM slow s WHERE s.track_id=n.track_id AND s.chunk_no=n.mid)
UNION ALL
SELECT t.track_id, t.start_ms, t.end_ms, 'fresh' FROM target t JOIN slow s ON t.track_id=s.track_id AND t.start_ms//60000=s.chunk_no
WHERE ((t.start_ms+t.end_ms)//2)//60000=s.chunk_no OR (t.start_ms < s.chunk_no*60000 AND s.chunk_no*60000 < t.end_ms)
 OR (t.start_ms < (s.chunk_no+1)*60000 AND (s.chunk_no+1)*60000 < t.end_ms)""")
def replace_chunks_x6(t):
    fresh = t.target.withColumn("chunk_no", idiv(F.col("start_ms"), 60_000))
    return sq.replace_chunks(t.cues, fresh, slow_chunks(t), 60_000).drop("text")


@plan("midpoint_p11", "SELECT track_id, cue_id, (start_ms+end_ms)//2 AS mid_ms FROM cues")
def midpoint_p11(t):
    return t.cues.select("track_id", "cue_id", midpoint("start_ms", "end_ms").alias("mid_ms"))
