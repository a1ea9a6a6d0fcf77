"""Version queries: work plans, resume, merges with history, readiness, currency."""

from pyspark.sql import functions as F

from cuelake.functions import row_hash
from cuelake.functions.base import idiv
from cuelake.operators import linking as lk
from cuelake.operators import measures as ms
from cuelake.operators import rules as rl
from cuelake.operators import sequences as sq
from cuelake.operators import versions as vs
from cuelake.operators.ordered import id_chunk, scan
from cuelake.plans.link_plans import LINKS_SQL, translated, units
from cuelake.plans.measure_plans import ASSESSED, assessed, has
from cuelake.plans.registry import CHECKS, plan
from cuelake.plans.rule_plans import SMALL, dated_issues, decision_errors_t11, decisions_on, grouping_pending_t12, issues, pending_issues_j17, row_sha, still_unresolved, translation_audit_t7
from cuelake.plans.scalar_plans import set_hash_sql
from cuelake.plans.sequence_plans import layout_overlap_w9, scan_contiguity_w10
from cuelake.session import settled

T = ["track_id"]


def window_hash_sql(name, src, model, revision):
    full = f"{model}@{revision}" if revision else model
    return f"""{name}_k AS (SELECT track_id, duration_ms, ((start_ms+end_ms)//2)//60000 AS k, min(start_ms) AS lo, max(end_ms) AS hi,
 {set_hash_sql(row_sha('cue_id', 'text', 'start_ms', 'end_ms'))} AS w, {set_hash_sql(row_sha('text', 'start_ms', 'end_ms'))} AS o FROM {src} JOIN media USING (track_id) WHERE (start_ms+end_ms)//2 < duration_ms GROUP BY 1, 2, 3),
{name}_j AS (SELECT *, greatest(0, least(k*60000-2000, lo-500)) AS a, least(duration_ms, greatest(least(k*60000+60000, duration_ms)+2000, hi+500)) AS b FROM {name}_k),
{name} AS (SELECT track_id, k*60000 AS core_start_ms, a AS audio_start_ms, b AS audio_end_ms, {row_sha(f"'{full}'", 'a', 'b', 'w')} AS input_sha, {row_sha(f"'{model}'", 'a', 'b', 'w')} AS legacy_sha, {row_sha(f"'{full}'", 'a', 'b', 'o')} AS content_sha FROM {name}_j)"""


def saved_windows(t):
    """Results kept from the previous text version; short tracks predate recorded revisions."""
    dated = vs.window_hashes(t.cues, t.media, "aligner", "r1")
    plain = vs.window_hashes(t.cues, t.media, "aligner", None)
    long = t.media.where(F.col("duration_ms") >= 100_000).select("track_id")
    return dated.join(long, "track_id", "left_semi").unionByName(plain.join(long, "track_id", "left_anti"))


@plan("work_plan_v1", f""", {window_hash_sql('nw', 'renumbered', 'aligner', 'r1')}, {window_hash_sql('od', 'cues', 'aligner', 'r1')}, {window_hash_sql('op', 'cues', 'aligner', None)},
sv AS (SELECT od.*, 'r1' AS rev FROM od JOIN media USING (track_id) WHERE duration_ms >= 100000 UNION ALL SELECT op.*, NULL FROM op JOIN media USING (track_id) WHERE duration_ms < 100000)
SELECT nw.track_id, nw.core_start_ms, nw.audio_start_ms, nw.audio_end_ms, CASE WHEN sv.input_sha=nw.input_sha THEN 'cached' WHEN sv.track_id IS NOT NULL AND rev IS NULL AND sv.input_sha=nw.legacy_sha THEN 'legacy'
 WHEN sv.content_sha=nw.content_sha THEN 'remapped' ELSE 'missing' END AS work FROM nw LEFT JOIN sv ON sv.track_id=nw.track_id AND sv.core_start_ms=nw.core_start_ms""")
def work_plan_v1(t):
    return vs.plan_work(vs.window_hashes(t.renumbered, t.media, "aligner", "r1"), saved_windows(t))


@plan("missing_windows_v2", """
SELECT track_id, s AS start_ms, least(duration_ms, s+30000) AS end_ms, 'r2' AS revision FROM (SELECT *, unnest(range(0, duration_ms, 30000)) AS s FROM media) w
WHERE NOT EXISTS (SELECT 1 FROM heard h WHERE h.track_id=w.track_id AND h.start_ms=s AND h.end_ms=least(duration_ms, s+30000) AND NOT contains(h.text, 'z'))""")
def missing_windows_v2(t):
    cache = t.heard.withColumn("revision", F.when(has("text", "z"), "r1").otherwise("r2"))
    return vs.missing_windows(sq.scan_windows(t.media).withColumn("revision", F.lit("r2")), cache, ["revision"])


BATCHES = """
{name}_n AS (SELECT track_id, cue_id, text, row_number() OVER (PARTITION BY track_id ORDER BY cue_id) - 1 AS i FROM {src}),
{name}_b AS (SELECT DISTINCT track_id, i // 5 AS k FROM {name}_n),
{name}_r AS (SELECT n.track_id, b.k + 1 AS batch_no, n.cue_id, n.text, CASE WHEN i < b.k*5 THEN 'previous' WHEN i >= (b.k+1)*5 THEN 'next' ELSE 'target' END AS role
 FROM {name}_n n JOIN {name}_b b ON n.track_id=b.track_id AND i >= b.k*5-3 AND i < (b.k+1)*5+3),
{name} AS (SELECT track_id, batch_no, {sha} AS input_sha, count(*) FILTER (role='target') AS n_targets FROM {name}_r GROUP BY 1, 2)"""


def batch_sql(name, src):
    return BATCHES.format(name=name, src=src, sha=set_hash_sql(row_sha("cue_id", "text", "role")))


@plan("batch_inputs_v10", f", {batch_sql('bi', 'cues')} SELECT * FROM bi")
def batch_inputs_v10(t):
    return vs.batch_inputs(t.cues, 5, 3)


@plan("pending_batches_v3", f""", {batch_sql('bi', 'target')}, {batch_sql('bo', 'cues')}
SELECT bi.track_id, bi.batch_no, bi.input_sha, CASE WHEN bo.track_id IS NULL THEN 'pending' WHEN bo.input_sha <> bi.input_sha THEN 'changed' WHEN bo.n_targets < 5 THEN 'blocked' ELSE 'done' END AS state
FROM bi LEFT JOIN bo ON bo.track_id=bi.track_id AND bo.batch_no=bi.batch_no""")
def pending_batches_v3(t):
    done = vs.batch_inputs(t.cues, 5, 3).withColumn("answered", F.col("n_targets") >= 5)
    return vs.pending_batches(vs.batch_inputs(t.target, 5, 3), done)


@plan("stale_batches_v10", f""", {batch_sql('bi', 'cues')}, {batch_sql('bo', 'target')},
nm AS (SELECT track_id, cue_id, text, (row_number() OVER (PARTITION BY track_id ORDER BY cue_id) - 1)//5 + 1 AS batch_no FROM cues),
g AS (SELECT track_id, batch_no, cue_id, count(*) AS n FROM (SELECT track_id, batch_no, cue_id FROM nm WHERE NOT contains(text,'w') UNION ALL SELECT track_id, batch_no, cue_id FROM nm WHERE contains(text,'x')) GROUP BY 1, 2, 3),
q AS (SELECT nm.track_id, nm.batch_no, bool_and(coalesce(n, 0) = 1) AS once FROM nm LEFT JOIN g ON g.track_id=nm.track_id AND g.batch_no=nm.batch_no AND g.cue_id=nm.cue_id GROUP BY 1, 2)
SELECT bi.track_id, bi.batch_no FROM bi LEFT JOIN bo ON bo.track_id=bi.track_id AND bo.batch_no=bi.batch_no JOIN q ON q.track_id=bi.track_id AND q.batch_no=bi.batch_no WHERE NOT coalesce(bo.input_sha=bi.input_sha AND once, false)""")
def stale_batches_v10(t):
    numbered = scan(t.cues.select("track_id", "cue_id", "text"), T, ["cue_id"], id_chunk("cue_id"), number="row_no")
    placed = numbered.select("track_id", (idiv(F.col("row_no") - 1, 5) + 1).alias("batch_no"), F.col("cue_id").alias("source_id"), "text")
    assessed = placed.where(~has("text", "w")).unionByName(placed.where(has("text", "x"))).drop("text")
    return vs.stale_batches(vs.batch_inputs(t.target, 5, 3), vs.batch_inputs(t.cues, 5, 3), assessed, numbered, 5)


def merged(t):
    row = lambda df, note: df.select("track_id", "cue_id", F.lit(note).alias("note"), F.sha2("text", 256).alias("sha"))
    return vs.upsert_decisions(row(t.cues, "old"), row(t.edited.where(has("text", "q")), "new"), t.target, ["track_id", "cue_id"])


MERGED = """, nw AS (SELECT track_id, cue_id, sha256(text) AS sha FROM edited WHERE contains(text,'q')),
mk AS (SELECT c.track_id, c.cue_id, sha256(text) AS sha, CASE WHEN EXISTS (SELECT 1 FROM nw WHERE nw.track_id=c.track_id AND nw.cue_id=c.cue_id) THEN 'superseded' WHEN NOT EXISTS (SELECT 1 FROM target t WHERE t.track_id=c.track_id AND t.cue_id=c.cue_id) THEN 'question_disappeared' END AS r FROM cues c)"""


@plan("decision_merge_v4", f"{MERGED} SELECT track_id, cue_id, 'old' AS note, sha FROM mk WHERE r IS NULL UNION ALL SELECT track_id, cue_id, 'new', sha FROM nw")
def decision_merge_v4(t):
    return merged(t)[0]


@plan("decision_history_v4", f"{MERGED} SELECT track_id, cue_id, 'old' AS note, sha, r AS archive_reason FROM mk WHERE r IS NOT NULL")
def decision_history_v4(t):
    return merged(t)[1]


CHECKPOINT = "ck AS (SELECT track_id, cue_id, CASE WHEN NOT contains(text,'w') THEN text END AS text, CASE WHEN contains(text,'w') THEN 'disputed' END AS defer_reason FROM target)"


def checkpoint(t):
    return t.target.select("track_id", "cue_id", F.when(~has("text", "w"), F.col("text")).alias("text"), F.when(has("text", "w"), "disputed").alias("defer_reason"))


def authored(t):
    return t.edited.select("track_id", "cue_id", F.when(~has("text", "p"), F.col("text")).alias("text"), F.when(has("text", "p"), "unclear").when(has("text", "x"), "both").alias("defer_reason"))


APPLY = f""", {CHECKPOINT}, ar AS (SELECT track_id, cue_id, CASE WHEN NOT contains(text,'p') THEN trim(text) END AS t, CASE WHEN contains(text,'p') THEN 'unclear' END AS d FROM edited WHERE contains(text,'p') OR NOT contains(text,'x')),
jn AS (SELECT coalesce(ck.track_id, ar.track_id) AS track_id, coalesce(ck.cue_id, ar.cue_id) AS cue_id, ck.text, ck.defer_reason, t, d, ar.track_id IS NOT NULL AS given, ck.text IS NOT NULL AND ar.track_id IS NOT NULL AND t IS DISTINCT FROM ck.text AS conflict FROM ck FULL JOIN ar ON ck.track_id=ar.track_id AND ck.cue_id=ar.cue_id),
tk AS (SELECT *, given AND (NOT conflict OR ({{correction}} AND t IS NOT NULL)) AS take FROM jn)
SELECT track_id, cue_id, CASE WHEN take THEN t ELSE text END AS text, CASE WHEN take THEN d ELSE defer_reason END AS defer_reason, CASE WHEN take AND conflict THEN text END AS previous_text, conflict AND NOT take AS conflict FROM tk"""


@plan("apply_rows_v5", APPLY.format(correction="false"))
def apply_rows_v5(t):
    return vs.apply_rows(checkpoint(t), authored(t))


@plan("apply_correction_v5", APPLY.format(correction="true"))
def apply_correction_v5(t):
    return vs.apply_rows(checkpoint(t), authored(t), correction=True)


@plan("export_status_v6", f""", {CHECKPOINT}, e AS (SELECT c.track_id, count(*) AS cues, count(*) FILTER (ck.text IS NULL) AS missing, count(*) FILTER (ck.text IS NULL AND ck.defer_reason IS NOT NULL) AS deferred FROM cues c LEFT JOIN ck ON ck.track_id=c.track_id AND ck.cue_id=c.cue_id GROUP BY 1)
SELECT *, CASE WHEN missing=0 THEN 'complete_draft' WHEN missing=cues THEN 'empty' ELSE 'partial' END AS status FROM e""")
def export_status_v6(t):
    return vs.export_status(checkpoint(t), t.cues)


@plan("snapshot_v7", """SELECT c.track_id, c.cue_id, sha256(c.text) AS version_sha FROM cues c WHERE EXISTS (SELECT 1 FROM edited e WHERE sha256(e.text) = sha256(c.text))""")
def snapshot_v7(t):
    sha = F.sha2("text", 256).alias("version_sha")
    return vs.snapshot(t.cues.select("track_id", "cue_id", sha), t.edited.select(sha))


@plan("readiness_v8", f""", {SMALL}, op AS (SELECT track_id, count(*) AS n FROM issues WHERE end_ms-start_ms >= 20000 GROUP BY 1),
q AS (SELECT doc_id, min(quality) AS q, max(toxic) AS x FROM labels GROUP BY 1)
SELECT m.track_id, coalesce(n, 0) AS open_issues, coalesce(q=1, false) AND n IS NULL AND coalesce(x=0, false) AS ready FROM media m LEFT JOIN op ON op.track_id=m.track_id LEFT JOIN q ON q.doc_id=m.track_id""")
def readiness_v8(t):
    label = t.raw("labels").groupBy(F.col("doc_id").alias("track_id")).agg((F.min("quality") == 1).alias("good"), F.max("toxic").alias("toxic"))
    base = t.media.select("track_id").join(label, "track_id", "left")
    decisions = base.select("track_id", *[F.col("good").alias(name) for name in vs.READY], F.lit(0).alias("remaining"), F.lit("agent").alias("reviewer"), F.lit("reviewed").alias("reason"))
    evidence = base.select("track_id", F.lit("0").alias("sha"), F.coalesce("toxic", F.lit(0)).cast("string").alias("current_sha"))
    return vs.ready(decisions, issues(t).where(F.col("end_ms") - F.col("start_ms") >= 20_000), evidence)


@plan("input_drift_v9", """SELECT 'd' || c.doc_id AS path, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.quality=0 THEN 'changed' ELSE 'current' END AS state FROM documents c LEFT JOIN (SELECT doc_id, min(quality) AS quality FROM labels GROUP BY 1) l ON l.doc_id=c.doc_id""")
def input_drift_v9(t):
    docs = t.raw("documents").select("doc_id", F.concat(F.lit("d"), "doc_id").alias("path"), F.sha2("text", 256).alias("sha"))
    label = t.raw("labels").groupBy("doc_id").agg(F.min("quality").alias("quality"))
    present = docs.join(label, "doc_id").select("path", F.when(F.col("quality") == 0, F.reverse("sha")).otherwise(F.col("sha")).alias("sha"))
    return vs.drift(docs.drop("doc_id"), present)


@plan("import_track_v11", """
SELECT track_id, cue_id FROM target x WHERE NOT EXISTS (SELECT 1 FROM cues a FULL JOIN target b ON a.track_id=b.track_id AND a.cue_id=b.cue_id WHERE coalesce(a.track_id, b.track_id)=x.track_id AND (a.start_ms IS NULL OR b.start_ms IS NULL))
AND NOT EXISTS (SELECT 1 FROM edited e WHERE e.track_id=x.track_id AND contains(e.text,'q'))""")
def import_track_v11(t):
    external = t.cues.join(t.target.select("track_id", "cue_id"), ["track_id", "cue_id"], "left_semi")
    used = t.edited.where(has("text", "q")).select("track_id", "cue_id", "text", F.lit(None).cast("string").alias("defer_reason"))
    return vs.import_track(used, t.cues, external).drop("text")


@plan("report_check_v12", """
, a AS (SELECT track_id, start_ms//60000 AS m, end_ms-start_ms > 8000 AS long FROM cues), b AS (SELECT track_id, start_ms//60000 AS m, end_ms-start_ms > 8000 AS long FROM target)
SELECT *, 'only_saved' AS side FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b) UNION ALL SELECT *, 'only_recomputed' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def report_check_v12(t):
    row = lambda df: df.select("track_id", idiv(F.col("start_ms"), 60_000).alias("m"), (F.col("end_ms") - F.col("start_ms") > 8000).alias("long"))
    return vs.report_matches(row(t.cues), row(t.target))


@plan("timing_evidence_v13", """
, d AS (SELECT c.track_id, c.cue_id AS decision_id, CASE WHEN contains(c.text,'w') THEN 'possible_early_cue' ELSE 'missing_word_timing' END AS kind, e.text AS x FROM cues c LEFT JOIN edited e ON e.track_id=c.track_id AND e.cue_id=c.cue_id),
r AS (SELECT track_id, decision_id, CASE WHEN x IS NULL THEN 'no_evidence' WHEN contains(x,'k') THEN 'unknown_kind' WHEN contains(x,'z') THEN 'changed_evidence' WHEN kind='possible_early_cue' AND NOT contains(x,'q') THEN 'needs_audio' END AS error FROM d)
SELECT * FROM r WHERE error IS NOT NULL""")
def timing_evidence_v13(t):
    decisions = t.cues.select("track_id", F.col("cue_id").alias("decision_id"), F.when(has("text", "w"), "possible_early_cue").otherwise("missing_word_timing").alias("kind"))
    kind = F.when(has("text", "k"), "rumour").when(has("text", "q"), "original_audio").otherwise("scene_context")
    evidence = t.edited.select("track_id", F.col("cue_id").alias("decision_id"), kind.alias("kind"), F.lit("a").alias("sha"), F.when(has("text", "z"), "b").otherwise("a").alias("current_sha"))
    return vs.timing_evidence_errors(decisions, evidence)


@plan("current_units_j19", """SELECT c.track_id, c.cue_id FROM cues c JOIN edited e ON e.track_id=c.track_id AND e.cue_id=c.cue_id WHERE sha256(c.text) = sha256(e.text)""")
def current_units_j19(t):
    stamp = lambda df: df.select("track_id", "cue_id", F.sha2("text", 256).alias("sha"))
    return vs.current_rows(stamp(t.cues), stamp(t.edited), ["track_id", "cue_id"]).drop("sha")


@plan("track_versions_p15", f"SELECT track_id, {set_hash_sql(row_sha('cue_id', 'start_ms', 'end_ms', 'text'))} AS version_sha, count(*) AS cues FROM cues GROUP BY 1")
def track_versions_p15(t):
    from cuelake.functions import set_hash

    return t.cues.groupBy("track_id").agg(set_hash(row_hash("cue_id", "start_ms", "end_ms", "text")).alias("version_sha"), F.count(F.lit(1)).alias("cues"))


@plan("open_work_a25", f""", {SMALL}
SELECT kind, count(*) AS n, count(DISTINCT track_id) AS tracks FROM issues WHERE end_ms-start_ms >= 10000 GROUP BY 1""")
def open_work_a25(t):
    long = issues(t).where(F.col("end_ms") - F.col("start_ms") >= 10_000)
    # Tracks per kind by two grouped counts: the first one combines, so no wide distinct set.
    return rl.ordered(long.groupBy("kind", "track_id").agg(F.count(F.lit(1)).alias("_n")).groupBy("kind").agg(F.sum("_n").alias("n"), F.count(F.lit(1)).alias("tracks")), "kind")


def rows_sql(name, check):
    return f"SELECT track_id, '{check}' AS \"check\" FROM ({CHECKS[name]})"


LATE = """SELECT e.track_id, 'timing' AS "check" FROM {src} e JOIN media USING (track_id) WHERE e.end_ms > duration_ms
 UNION ALL SELECT track_id, 'timing' FROM (SELECT *, lag(end_ms) OVER (PARTITION BY track_id ORDER BY cue_id) AS pe FROM {src}) WHERE pe > start_ms
 UNION ALL SELECT track_id, 'timing' FROM (SELECT *, lag(start_ms) OVER (PARTITION BY track_id ORDER BY cue_id) AS ps FROM {src}) WHERE ps > start_ms"""


@plan("release_gate_a24", f""", {LINKS_SQL}, {ASSESSED},
p AS ({CHECKS["pending_issues_j17"]}),
b AS ({LATE.format(src="edited")} UNION ALL {LATE.format(src="target")}
 UNION ALL SELECT track_id, 'links' FROM cues c WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.track_id=c.track_id AND l.unit_id=c.cue_id)
 UNION ALL SELECT track_id, 'links' FROM target c WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.track_id=c.track_id AND l.translation_id=c.cue_id)
 UNION ALL SELECT track_id, 'meaning' FROM asd WHERE verdict <> 'correct' AND NOT settled
 UNION ALL SELECT DISTINCT coalesce(c.track_id, e.track_id), 'source' FROM cues c FULL JOIN edited e ON c.track_id=e.track_id AND c.cue_id=e.cue_id AND c.start_ms=e.start_ms AND c.end_ms=e.end_ms AND c.text=e.text WHERE c.track_id IS NULL OR e.track_id IS NULL
 UNION ALL {rows_sql("decision_errors_t11", "audio")} UNION ALL {rows_sql("scan_contiguity_w10", "scan")} UNION ALL {rows_sql("layout_overlap_w9", "layout")}
 UNION ALL {rows_sql("grouping_pending_t12", "grouping")} UNION ALL {rows_sql("unresolved_issues_j29", "unresolved")}
 UNION ALL SELECT track_id, 'pending' FROM p
 UNION ALL SELECT track_id, 'urgent' FROM p WHERE end_ms-start_ms >= CASE kind WHEN 'long_cue' THEN 20000 WHEN 'repetition' THEN 30000 WHEN 'subtitle_gap' THEN 30000 END
 UNION ALL SELECT track_id, 'coverage' FROM p WHERE kind IN ('subtitle_gap','possible_speech_gap'))
SELECT m.track_id, count(b.track_id) AS blockers, coalesce(string_agg(DISTINCT b.check, ',' ORDER BY b.check), '') AS checks, count(b.track_id)=0 AS passed FROM media m LEFT JOIN b ON b.track_id=m.track_id GROUP BY 1""")
def release_gate_a24(t):
    """Blockers are counted a few checks at a time, so that the shuffles of all checks are never on disk together."""
    named = lambda df, name: df.withColumn("check", F.lit(name))
    found = settled(dated_issues(t), "issues")
    steps = [
        [rl.queue_blockers(rl.pending(found, decisions_on(found)))],
        [named(still_unresolved(found, decisions_on(found)), "unresolved")],
        [named(sq.validate(t.edited, t.media), "timing"), named(sq.validate(t.target, t.media), "timing")],
        [named(lk.link_gaps(units(t), translated(t), lk.link_tracks(t.cues, t.target)), "links"),
         named(assessed(t).where((F.col("verdict") != "correct") & ~F.col("settled")), "meaning")],
        [named(vs.stale_tracks(t.cues, t.edited, ["cue_id", "start_ms", "end_ms", "text"]), "source")],
        [named(decision_errors_t11(t), "audio")],
        [named(scan_contiguity_w10(t), "scan"), named(layout_overlap_w9(t), "layout"), named(grouping_pending_t12(t), "grouping")]]
    return ms.gate_of_counts(t.media, [settled(ms.blocker_counts(step), "blockers") for step in steps])


@plan("episode_summary_a25", f"""
, parts AS (SELECT track_id, 'cues' AS p FROM cues UNION ALL SELECT track_id, kind FROM ({CHECKS["pending_issues_j17"]}) UNION ALL {rows_sql("decision_errors_t11", "audio_questions")} UNION ALL {rows_sql("translation_audit_t7", "translation_flags")}
 UNION ALL {rows_sql("layout_overlap_w9", "layout_overlaps")} UNION ALL {rows_sql("scan_contiguity_w10", "scan_errors")})
SELECT m.track_id, {", ".join(f"count(*) FILTER (p='{k}') AS {n}" for k, n in (("cues", "cues"), ("subtitle_gap", "gaps"), ("long_cue", "long_cues"), ("overlap", "overlaps"), ("repetition", "repetitions"), ("audio_questions", "audio_questions"), ("translation_flags", "translation_flags"), ("layout_overlaps", "layout_overlaps"), ("scan_errors", "scan_errors")))}
FROM media m LEFT JOIN parts ON parts.track_id=m.track_id GROUP BY 1""")
def episode_summary_a25(t):
    # Issues are counted by kind ahead of the union; every other report comes as rows.
    kinds = {"gaps": "subtitle_gap", "long_cues": "long_cue", "overlaps": "overlap", "repetitions": "repetition"}
    counted = pending_issues_j17(t).groupBy("track_id").agg(*[F.count_if(F.col("kind") == kind).alias(name) for name, kind in kinds.items()])
    rest = ms.episode_summary(t.media, {
        "cues": t.cues, "audio_questions": decision_errors_t11(t), "translation_flags": translation_audit_t7(t),
        "layout_overlaps": layout_overlap_w9(t), "scan_errors": scan_contiguity_w10(t)})
    return rest.join(counted, "track_id", "left").select(*rest.columns, *[F.coalesce(name, F.lit(0)).alias(name) for name in kinds])
