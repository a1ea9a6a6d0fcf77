"""Interval queries: overlap joins, merging, subtraction, gaps, cover, as-of lookup."""

from pyspark.sql import functions as F

from cuelake.functions import is_label, meaningful, overlap_ms
from cuelake.operators import intervals as iv
from cuelake.operators.ordered import id_chunk
from cuelake.plans.registry import plan

T = ["track_id"]

MEANINGFUL = ("least(a.end_ms,b.end_ms)-greatest(a.start_ms,b.start_ms) >= least(least(a.end_ms-a.start_ms,b.end_ms-b.start_ms),"
              " greatest(100, least(500, least(a.end_ms-a.start_ms,b.end_ms-b.start_ms)//4)))")
STRICT = "a.start_ms < b.end_ms AND a.end_ms > b.start_ms"

# Islands in plain SQL, reused by several checks below.
MERGE = """
{out}_f AS (SELECT *, CASE WHEN start_ms <= max(end_ms) OVER (PARTITION BY {by} ORDER BY start_ms, end_ms
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) THEN 0 ELSE 1 END AS fresh FROM ({src})),
{out}_i AS (SELECT *, sum(fresh) OVER (PARTITION BY {by} ORDER BY start_ms, end_ms ROWS UNBOUNDED PRECEDING) AS island FROM {out}_f),
{out} AS (SELECT {by}, min(start_ms) AS start_ms, max(end_ms) AS end_ms FROM {out}_i GROUP BY {by}, island)"""

# Pieces of spans outside a merged cover, walked per span in cover order.
SUBTRACT = """
{out}_p AS (SELECT a.*, b.start_ms AS cs, b.end_ms AS ce FROM {spans} a LEFT JOIN {cover} b
            ON a.track_id = b.track_id AND a.start_ms < b.end_ms AND a.end_ms > b.start_ms),
{out}_w AS (SELECT *, coalesce(lag(ce) OVER k, start_ms) AS from_ms, lead(cs) OVER k IS NULL AS final FROM {out}_p
            WINDOW k AS (PARTITION BY track_id, cue_id ORDER BY cs)),
{out} AS (SELECT track_id, cue_id, start_ms, end_ms, from_ms AS piece_start, least(coalesce(cs, end_ms), end_ms) AS piece_end FROM {out}_w
          UNION ALL
          SELECT track_id, cue_id, start_ms, end_ms, ce, end_ms FROM {out}_w WHERE final AND ce IS NOT NULL)"""


def pairs(t):
    return iv.interval_join(
        t.cues.select("track_id", "cue_id", "start_ms", "end_ms"),
        t.ref.select("track_id", F.col("cue_id").alias("ref_id"), F.col("start_ms").alias("r_start"),
                     F.col("end_ms").alias("r_end")), T)


@plan("interval_join_j1", f"""
SELECT a.track_id, a.cue_id, b.cue_id AS ref_id, least(a.end_ms,b.end_ms)-greatest(a.start_ms,b.start_ms) AS overlap_ms,
       {MEANINGFUL} AS meaningful
FROM cues a JOIN ref b ON a.track_id=b.track_id AND {STRICT}""")
def interval_join_j1(t):
    return pairs(t).select(
        "track_id", "cue_id", "ref_id",
        overlap_ms("start_ms", "end_ms", "r_start", "r_end").alias("overlap_ms"),
        meaningful("start_ms", "end_ms", "r_start", "r_end").alias("meaningful"))


@plan("overlap_length_p12", f"""
SELECT a.track_id, count(*) AS pairs, CAST(sum(least(a.end_ms,b.end_ms)-greatest(a.start_ms,b.start_ms)) AS BIGINT) AS overlap_ms
FROM cues a JOIN ref b ON a.track_id=b.track_id AND {STRICT} GROUP BY a.track_id""")
def overlap_length_p12(t):
    return pairs(t).groupBy("track_id").agg(
        F.count(F.lit(1)).alias("pairs"),
        F.sum(overlap_ms("start_ms", "end_ms", "r_start", "r_end")).alias("overlap_ms"))


@plan("meaningful_overlap_p13", f"""
SELECT a.track_id, a.cue_id, b.cue_id AS target_id FROM cues a JOIN target b
ON a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL}""")
def meaningful_overlap_p13(t):
    return iv.interval_join(
        t.cues.select("track_id", "cue_id", "start_ms", "end_ms"),
        t.target.select("track_id", F.col("cue_id").alias("target_id"),
                        F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end")),
        T, meaningful=True).select("track_id", "cue_id", "target_id")


@plan("uncovered_cues_j2", f"""
SELECT 'source_without_target' AS kind, track_id, cue_id, start_ms, end_ms FROM cues a
WHERE NOT EXISTS (SELECT 1 FROM target b WHERE a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL})
UNION ALL
SELECT 'target_without_source', track_id, cue_id, start_ms, end_ms FROM target a
WHERE NOT EXISTS (SELECT 1 FROM cues b WHERE a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL})""")
def uncovered_cues_j2(t):
    def one(kind, left, right):
        return iv.uncovered_cues(left.drop("text"), right.drop("text")).select(
            F.lit(kind).alias("kind"), "track_id", "cue_id", "start_ms", "end_ms")

    return one("source_without_target", t.cues, t.target).unionByName(
        one("target_without_source", t.target, t.cues))


@plan("many_to_one_j3", f"""
SELECT * FROM (SELECT b.track_id, b.cue_id AS target_id, a.cue_id AS source_id,
       count(*) OVER (PARTITION BY b.track_id, b.cue_id) AS n_sources
FROM target_long b JOIN cues a ON a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL}) WHERE n_sources >= 3""")
def many_to_one_j3(t):
    return iv.many_to_one(t.cues, t.target_long).select("track_id", "target_id", "source_id", "n_sources")


PACK = """SELECT track_id, CAST(w AS BIGINT) + 1 AS window_id, role, cue_id, start_ms, end_ms FROM (
 SELECT *, unnest(range(start_ms // 60000, (end_ms - 1) // 60000 + 1)) AS w FROM (
   SELECT 'source' AS role, track_id, cue_id, start_ms, end_ms FROM cues
   UNION ALL SELECT 'target', track_id, cue_id, start_ms, end_ms FROM target))"""


@plan("window_pack_j4", PACK)
def window_pack_j4(t):
    both = t.cues.withColumn("role", F.lit("source")).unionByName(t.target.withColumn("role", F.lit("target")))
    return iv.window_pack(both).drop("text")


@plan("active_cue_j11", f"""
SELECT p.track_id, p.at_ms, min(c.cue_id) AS active_id
FROM (SELECT DISTINCT track_id, (start_ms+end_ms)//2 + 3000 AS at_ms FROM cues) p
LEFT JOIN cues c ON p.track_id=c.track_id AND c.start_ms <= p.at_ms AND p.at_ms < c.end_ms GROUP BY ALL""")
def active_cue_j11(t):
    points = t.cues.select("track_id", (F.call_function("div", F.col("start_ms") + F.col("end_ms"), F.lit(2)) + 3000).alias("at_ms")).distinct()
    return iv.active_at(points, t.cues, T).select("track_id", "at_ms", "active_id")


@plan("merge_intervals_w4", f"""
, {MERGE.format(out='m', by='track_id', src='SELECT track_id, start_ms, end_ms FROM speech')}
SELECT * FROM m""".replace("\n, ", ", ", 1))
def merge_intervals_w4(t):
    return iv.merge_intervals(t.speech, T)


@plan("union_length_a27", f"""
, {MERGE.format(out='m', by='track_id', src='SELECT track_id, start_ms, end_ms FROM speech')}
SELECT track_id, CAST(sum(end_ms-start_ms) AS BIGINT) AS union_ms, count(*) AS spans FROM m GROUP BY 1""")
def union_length_a27(t):
    return iv.union_length(t.speech, T)


MERGED_SPEECH = MERGE.format(out="s", by="track_id", src="SELECT track_id, start_ms, end_ms FROM speech")
MERGED_CUES = MERGE.format(out="c", by="track_id", src="SELECT track_id, greatest(start_ms-150,0) AS start_ms, end_ms+150 AS end_ms FROM cues WHERE NOT contains(text,'z')")
UNCOVERED_SPEECH = f"""{MERGED_SPEECH}, {MERGED_CUES},
 sp AS (SELECT track_id, start_ms AS cue_id, start_ms, end_ms FROM s), {SUBTRACT.format(out='u', spans='sp', cover='c')}"""


def shown(t):
    """A draft that misses the lines with a z."""
    return t.cues.where(~F.contains(F.col("text"), F.lit("z")))


@plan("uncovered_speech_w5", f"""
, {UNCOVERED_SPEECH}
SELECT track_id, piece_start AS start_ms, piece_end AS end_ms FROM u WHERE piece_end - piece_start >= 700""")
def uncovered_speech_w5(t):
    return iv.uncovered_speech(iv.merge_intervals(t.speech, T), shown(t))


SILENT = f"""
{MERGE.format(out='sp', by='track_id', src='SELECT track_id, greatest(start_ms-250,0) AS start_ms, end_ms+250 AS end_ms FROM speech')},
 sc AS (SELECT track_id, cue_id, start_ms, end_ms FROM labelled WHERE NOT regexp_full_match(text, '\\s*(\\[[^\\]]+\\]\\s*)+')),
 {SUBTRACT.format(out='u', spans='sc', cover='sp')}"""


def late_speech(t):
    """Voice found in the second half of long lines only."""
    half = F.call_function("div", F.col("end_ms") - F.col("start_ms"), F.lit(2))
    return t.speech.withColumn("start_ms", F.col("start_ms") + half)


@plan("silent_cue_parts_w6", f"""
, late AS (SELECT track_id, start_ms + (end_ms-start_ms)//2 AS start_ms, end_ms FROM speech),
{SILENT.replace('FROM speech', 'FROM late')}
SELECT track_id, cue_id, piece_start AS start_ms, piece_end AS end_ms,
 CASE WHEN piece_start=start_ms AND piece_end=end_ms THEN 'entire' WHEN piece_end=end_ms THEN 'after'
      WHEN piece_start=start_ms THEN 'before' ELSE 'within' END AS position,
 round((piece_end-piece_start)/1000.0, 3) AS duration_seconds
FROM u WHERE piece_end - piece_start >= 3000""")
def silent_cue_parts_w6(t):
    return iv.silent_cue_parts(late_speech(t), t.labelled)


GAPS = """
g_s AS (SELECT c.track_id, cue_id, duration_ms, start_ms, least(duration_ms, greatest(start_ms,0)) AS s, least(duration_ms,end_ms) AS e
        FROM cues c JOIN media USING (track_id)),
g_m AS (SELECT *, max(e) OVER (PARTITION BY track_id ORDER BY start_ms, cue_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS reach,
        row_number() OVER (PARTITION BY track_id ORDER BY start_ms, cue_id) AS rn FROM g_s),
g_r AS (SELECT *, coalesce(reach,0) AS cover FROM g_m),
g_x AS (SELECT track_id, max(e) AS cover FROM g_s GROUP BY 1),
gaps AS (
 SELECT r.track_id, r.cover AS start_ms, r.s AS end_ms,
  (SELECT arg_min(p.cue_id, p.rn) FROM g_r p WHERE p.track_id=r.track_id AND p.rn<r.rn AND p.e=r.reach) AS previous_cue, r.cue_id AS next_cue
 FROM g_r r WHERE r.s - r.cover >= 10000
 UNION ALL
 SELECT m.track_id, coalesce(x.cover,0), m.duration_ms,
  (SELECT arg_min(p.cue_id, p.rn) FROM g_r p WHERE p.track_id=m.track_id AND p.e=x.cover), NULL
 FROM media m LEFT JOIN g_x x USING (track_id) WHERE m.duration_ms - coalesce(x.cover,0) >= 10000)"""


@plan("gaps_w1", f", {GAPS} SELECT * FROM gaps")
def gaps_w1(t):
    return iv.gaps(t.cues, t.media)


@plan("overlaps_w2", """
SELECT * FROM (SELECT track_id, lag(cue_id) OVER w AS left_id, cue_id AS right_id, start_ms, least(lag(end_ms) OVER w, end_ms) AS end_ms
 FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY cue_id)) q
WHERE EXISTS (SELECT 1 FROM cues c WHERE c.track_id=q.track_id AND c.cue_id=q.left_id AND c.end_ms > q.start_ms)""")
def overlaps_w2(t):
    return iv.overlaps(t.cues, id_chunk("cue_id"))


@plan("covers_w11", f"""
, {MERGE.format(out='s', by='track_id', src='SELECT track_id, start_ms, end_ms FROM speech')}
SELECT a.track_id, a.cue_id, bool_or(b.track_id IS NOT NULL) AS covered
FROM cues a LEFT JOIN s b ON a.track_id=b.track_id AND b.start_ms <= a.start_ms AND b.end_ms >= a.end_ms GROUP BY ALL""")
def covers_w11(t):
    return iv.covers(t.speech, t.cues.drop("text"), T, ["cue_id"]).select("track_id", "cue_id", "covered")


@plan("neighbours_j12", f"""
, {UNCOVERED_SPEECH},
 g AS (SELECT DISTINCT track_id, piece_start AS start_ms, piece_end AS end_ms FROM u WHERE piece_end - piece_start >= 700)
SELECT g.track_id, g.start_ms, g.end_ms,
 (SELECT arg_min(c.cue_id, (-c.end_ms, c.cue_id)) FROM cues c WHERE c.track_id=g.track_id AND c.end_ms <= g.start_ms+150 AND NOT contains(text,'z')) AS previous_cue,
 (SELECT arg_min(c.cue_id, (c.start_ms, c.cue_id)) FROM cues c WHERE c.track_id=g.track_id AND c.start_ms >= g.end_ms-150 AND NOT contains(text,'z')) AS next_cue
FROM g""")
def neighbours_j12(t):
    spans = iv.uncovered_speech(iv.merge_intervals(t.speech, T), shown(t))
    return iv.neighbours(spans, shown(t)).select("track_id", "start_ms", "end_ms", "previous_cue", "next_cue")


@plan("clip_to_rows_g8", """
SELECT track_id, cue_id, row_no, clip_start, clip_end FROM (
 SELECT track_id, cue_id, row_no, greatest(start_ms, row_no*60000) AS clip_start, least(end_ms, (row_no+1)*60000) AS clip_end
 FROM (SELECT *, unnest(range(start_ms//60000, (end_ms-1)//60000+1)) AS row_no FROM cues)) WHERE clip_end > clip_start""")
def clip_to_rows_g8(t):
    return iv.clip_to_rows(t.cues, 60_000, ["track_id", "cue_id"])


@plan("coverage_report_t17", f"""
, late AS (SELECT track_id, start_ms + (end_ms-start_ms)//2 AS start_ms, end_ms FROM speech), {UNCOVERED_SPEECH},
{SILENT.replace('FROM speech', 'FROM late').replace('sp_', 'zp_').replace(' sp ', ' zp ').replace('sp AS', 'zp AS').replace('u_', 'v_').replace('u AS', 'v AS').replace('JOIN sp', 'JOIN zp')}
SELECT m.track_id,
 (SELECT count(*) FROM cues c WHERE c.track_id=m.track_id AND NOT contains(text,'z')) AS cue_count,
 (SELECT count(*) FROM u WHERE u.track_id=m.track_id AND piece_end-piece_start>=700) AS gap_count,
 (SELECT CAST(coalesce(sum(piece_end-piece_start),0) AS BIGINT) FROM u WHERE u.track_id=m.track_id AND piece_end-piece_start>=700) AS gap_ms,
 (SELECT count(*) FROM v WHERE v.track_id=m.track_id AND piece_end-piece_start>=3000) AS silent_count,
 (SELECT CAST(coalesce(sum(piece_end-piece_start),0) AS BIGINT) FROM v WHERE v.track_id=m.track_id AND piece_end-piece_start>=3000) AS silent_ms
FROM media m""")
def coverage_report_t17(t):
    return coverage_report(t.media, iv.merge_intervals(t.speech, T), late_speech(t), shown(t), t.labelled)


def coverage_report(media, speech, late, cues, labelled):
    """Both directions of the speech check, counted per track."""
    found = iv.uncovered_speech(speech, cues).groupBy("track_id").agg(
        F.count(F.lit(1)).alias("gap_count"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("gap_ms"))
    silent = iv.silent_cue_parts(late, labelled).groupBy("track_id").agg(
        F.count(F.lit(1)).alias("silent_count"),
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("silent_ms"))
    total = cues.groupBy("track_id").agg(F.count(F.lit(1)).alias("cue_count"))
    joined = media.join(total, "track_id", "left").join(found, "track_id", "left").join(silent, "track_id", "left")
    names = ["cue_count", "gap_count", "gap_ms", "silent_count", "silent_ms"]
    return joined.select("track_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in names])


@plan("label_predicate_p9", r"""
SELECT track_id, cue_id, regexp_full_match(text, '\s*(\[[^\]]+\]\s*)+') AS label FROM labelled""")
def label_predicate_p9(t):
    return t.labelled.select("track_id", "cue_id", is_label("text").alias("label"))
