"""Rule queries: review queue, audits, decisions, evidence, ordering, key sets, text scoring."""

from pyspark.sql import functions as F

from cuelake.functions import row_hash
from cuelake.functions.base import idiv
from cuelake.operators import intervals as iv
from cuelake.operators import linking as lk
from cuelake.operators import measures as ms
from cuelake.operators import rules as rl
from cuelake.operators import scoring as sc
from cuelake.operators import sequences as sq
from cuelake.operators.ordered import id_chunk
from cuelake.plans.interval_plans import GAPS, MEANINGFUL, MERGE, SILENT, STRICT, UNCOVERED_SPEECH, late_speech
from cuelake.plans.link_plans import LINKS_SQL, SHIFTED, clock
from cuelake.plans.measure_plans import STATUS, has, unit_words
from cuelake.plans.registry import plan
from cuelake.plans.scalar_plans import loop_sql
from cuelake.plans.sequence_plans import CLIPS, RUNS
from cuelake.plans.views import norm, tokens

T = ["track_id"]

# --- the review queue -----------------------------------------------------------------------

MUTE = SILENT.replace("FROM speech", "FROM sp0").replace("FROM labelled", "FROM cues").replace("sp_", "zp_").replace("sp AS", "zp AS").replace(
    " sp ", " zp ").replace("JOIN sp", "JOIN zp").replace("u_", "v_").replace("u AS", "v AS")
QUEUE = f"""{GAPS}, {RUNS.format(expr=norm(), src='cues')}, {SHIFTED}, {CLIPS.format(core=300000, ov=5000)},
{UNCOVERED_SPEECH.replace("FROM cues WHERE NOT contains(text,'z')", "FROM cues")},
sp0 AS (SELECT track_id, start_ms, end_ms FROM s), {MUTE},
issues AS (
 SELECT track_id, 'long_cue:' || cue_id AS issue_id, 'long_cue' AS kind, start_ms, end_ms FROM cues WHERE end_ms-start_ms > 8000
 UNION ALL SELECT track_id, 'overlap:' || l || '-' || cue_id, 'overlap', start_ms, least(pe, end_ms) FROM (SELECT *, lag(cue_id) OVER w AS l, lag(end_ms) OVER w AS pe FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY cue_id)) WHERE pe > start_ms
 UNION ALL SELECT track_id, 'subtitle_gap:' || coalesce(previous_cue::VARCHAR, 'start') || '-' || coalesce(next_cue::VARCHAR, 'end'), 'subtitle_gap', start_ms, end_ms FROM gaps
 UNION ALL SELECT track_id, 'repetition:' || first_id || '-' || last_id, 'repetition', start_ms, end_ms FROM all_runs WHERE n_rows >= 3 AND length(norm) >= 8
 UNION ALL SELECT track_id, 'reference_only:' || ref_id, 'reference_only', greatest(start_ms, 0), end_ms FROM sh a WHERE NOT EXISTS (SELECT 1 FROM cues b WHERE b.track_id=a.track_id AND a.start_ms < b.end_ms+500 AND a.end_ms > b.start_ms-500)
 UNION ALL SELECT track_id, 'possible_speech_gap:' || piece_start, 'possible_speech_gap', piece_start, piece_end FROM u WHERE piece_end-piece_start >= 700
 UNION ALL SELECT track_id, 'possible_subtitle_without_speech:' || cue_id || '-' || piece_start, 'possible_subtitle_without_speech', piece_start, piece_end FROM v WHERE piece_end-piece_start >= 3000
 UNION ALL SELECT track_id, 'unresolved_seam:' || core_start_ms, 'unresolved_seam', greatest(0, core_start_ms-10000), core_start_ms+10000 FROM clips WHERE core_start_ms > 0)"""


def queue(t):
    return rl.review_queue(t.cues, t.media, lk.shifted_reference(t.ref, clock(t), t.media),
                           iv.merge_intervals(t.speech, T), sq.clip_ranges(t.media))


@plan("review_queue_t5", f", {QUEUE} SELECT * FROM issues")
def review_queue_t5(t):
    return queue(t)


@plan("issue_union_x1", f", {QUEUE} SELECT kind, count(*) AS n FROM issues GROUP BY 1")
def issue_union_x1(t):
    return ms.issue_counts(queue(t))


@plan("reference_disagreement_t1")
def reference_disagreement_t1(t):
    """Reference lines against the draft lines they overlap; DuckDB edits bytes, not characters, so no SQL twin."""
    other = t.ref.withColumn("text", F.when(has("text", "q"), F.reverse("text")).otherwise(F.col("text")))
    return sc.reference_disagreement(t.cues, lk.shifted_reference(other, clock(t), t.media))


SMALL = f"""{GAPS}, {RUNS.format(expr=norm(), src='cues')},
issues AS (
 SELECT track_id, 'long_cue:' || cue_id AS issue_id, 'long_cue' AS kind, start_ms, end_ms FROM cues WHERE end_ms-start_ms > 8000
 UNION ALL SELECT track_id, 'overlap:' || l || '-' || cue_id, 'overlap', start_ms, least(pe, end_ms) FROM (SELECT *, lag(cue_id) OVER w AS l, lag(end_ms) OVER w AS pe FROM cues WINDOW w AS (PARTITION BY track_id ORDER BY cue_id)) WHERE pe > start_ms
 UNION ALL SELECT track_id, 'subtitle_gap:' || coalesce(previous_cue::VARCHAR, 'start') || '-' || coalesce(next_cue::VARCHAR, 'end'), 'subtitle_gap', start_ms, end_ms FROM gaps
 UNION ALL SELECT track_id, 'repetition:' || first_id || '-' || last_id, 'repetition', start_ms, end_ms FROM all_runs WHERE n_rows >= 3 AND length(norm) >= 8)"""


def issues(t):
    return rl.review_queue(t.cues, t.media)


RANK = """CASE WHEN kind='repetition' AND end_ms-start_ms >= 30000 THEN 0 WHEN kind='subtitle_gap' AND end_ms-start_ms >= 30000 THEN 1 WHEN kind='overlap' THEN 2
 WHEN kind='subtitle_gap' THEN 5 WHEN kind='repetition' THEN 9 ELSE 10 END"""


@plan("next_issues_o1", f""", {SMALL}
SELECT * FROM (SELECT *, CAST({RANK} AS BIGINT) AS priority, row_number() OVER (PARTITION BY track_id ORDER BY {RANK}, start_ms, issue_id) AS rank FROM issues) WHERE rank <= 5""")
def next_issues_o1(t):
    return rl.next_issues(issues(t), 5).withColumn("rank", F.col("rank").cast("bigint"))


@plan("ordered_issues_o3", f", {SMALL} SELECT * FROM issues ORDER BY track_id, start_ms, end_ms, issue_id")
def ordered_issues_o3(t):
    return rl.ordered(issues(t))


@plan("urgent_issues_t10", f""", {SMALL}
SELECT * FROM issues WHERE end_ms-start_ms >= CASE kind WHEN 'long_cue' THEN 20000 WHEN 'repetition' THEN 30000 WHEN 'subtitle_gap' THEN 30000 END""")
def urgent_issues_t10(t):
    return rl.urgent(issues(t))


# --- two-track audit ------------------------------------------------------------------------

@plan("translation_audit_t7", f""", {RUNS.format(expr=norm(), src='target')},
tg AS (SELECT track_id, cue_id, start_ms, end_ms, text FROM target)
SELECT track_id, 'source_without_target' AS kind, 'source' AS language, cue_id FROM cues a WHERE NOT EXISTS (SELECT 1 FROM tg b WHERE a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL})
UNION ALL SELECT track_id, 'target_without_source', 'target', cue_id FROM tg a WHERE NOT EXISTS (SELECT 1 FROM cues b WHERE a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL})
UNION ALL SELECT b.track_id, 'many_source_cues_one_target', 'target', b.cue_id FROM tg b JOIN cues a ON a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL} GROUP BY b.track_id, b.cue_id HAVING count(*) >= 3
UNION ALL SELECT track_id, 'repeated_target', 'target', first_id FROM all_runs WHERE n_rows >= 3 AND length(norm) >= 8
UNION ALL SELECT track_id, 'fast_cue', 'source', cue_id FROM cues WHERE length(replace(text, chr(10), '')) * 1000.0 / (end_ms-start_ms) > 25
UNION ALL SELECT track_id, 'fast_cue', 'target', cue_id FROM tg WHERE length(replace(text, chr(10), '')) * 1000.0 / (end_ms-start_ms) > 25
UNION ALL SELECT track_id, 'long_target_cue', 'target', cue_id FROM tg WHERE end_ms-start_ms > 8000""")
def translation_audit_t7(t):
    return rl.translation_audit(t.cues, t.target)


# --- layout ---------------------------------------------------------------------------------

ALIGNED = STATUS.replace("FROM edited u", "FROM cues u")
LAYOUT = f"""{LINKS_SQL}, {ALIGNED},
lt AS (SELECT track_id, cue_id AS unit_id, min(start_ms) AS ws, max(end_ms) AS we FROM words WHERE start_ms IS NOT NULL AND end_ms IS NOT NULL GROUP BY 1, 2),
hw AS (SELECT DISTINCT track_id, cue_id AS unit_id FROM words),
fa AS (SELECT st.track_id, st.unit_id, contains(c.text, 'q') AS stale, NOT contains(c.text, 'q') AND hw.unit_id IS NOT NULL AND status IN ('partial','failed','suspicious') AS bad,
  CASE WHEN NOT contains(c.text, 'q') THEN ws END AS ws, CASE WHEN NOT contains(c.text, 'q') THEN we END AS we FROM st
  LEFT JOIN lt ON lt.track_id=st.track_id AND lt.unit_id=st.unit_id LEFT JOIN hw ON hw.track_id=st.track_id AND hw.unit_id=st.unit_id JOIN cues c ON c.track_id=st.track_id AND c.cue_id=st.unit_id),
it AS (SELECT track_id, 'source' AS language, cue_id AS item_id, start_ms + (cue_id % 4) * 500 - 900 AS start_ms, end_ms + (cue_id % 3) * 800 AS end_ms, text FROM cues UNION ALL SELECT track_id, 'english', cue_id, start_ms, end_ms, text FROM target),
br AS (SELECT track_id, 'source' AS language, cue_id AS item_id, cue_id AS unit_id FROM cues UNION ALL SELECT track_id, 'english', translation_id, unit_id FROM links),
rl AS (SELECT br.track_id, language, item_id, bool_or(stale) AS stale, bool_or(bad) AS bad, min(ws) AS ws, max(we) AS we FROM br JOIN fa ON fa.track_id=br.track_id AND fa.unit_id=br.unit_id GROUP BY 1, 2, 3),
j AS (SELECT it.*, stale, bad, ws, we, length(replace(text, chr(10), '')) * 1000.0::DOUBLE / (end_ms-start_ms) AS cps FROM it LEFT JOIN rl ON rl.track_id=it.track_id AND rl.language=it.language AND rl.item_id=it.item_id),
ig AS (SELECT track_id, translation_id, max(g) AS g FROM (SELECT l.track_id, l.translation_id, i.start_ms - lag(i.end_ms) OVER (PARTITION BY l.track_id, l.translation_id ORDER BY i.start_ms, i.end_ms) AS g FROM links l JOIN it i ON i.language='source' AND i.track_id=l.track_id AND i.item_id=l.unit_id) GROUP BY 1, 2),
flags AS (SELECT track_id, language, item_id, 'stale_alignment' AS kind, NULL::DOUBLE AS measure FROM j WHERE stale UNION ALL SELECT track_id, language, item_id, 'unreliable_alignment', NULL FROM j WHERE bad
 UNION ALL SELECT track_id, language, item_id, 'missing_word_timing', NULL FROM j WHERE ws IS NULL UNION ALL SELECT track_id, language, item_id, 'possible_early_cue', ws-start_ms FROM j WHERE ws-start_ms > 700
 UNION ALL SELECT track_id, language, item_id, 'possible_lingering_cue', end_ms-we FROM j WHERE end_ms-we > 700 UNION ALL SELECT track_id, language, item_id, 'fast_cue', round(cps, 2) FROM j WHERE cps > 25
 UNION ALL SELECT track_id, 'english', translation_id, 'translation_spans_dialogue_gap', g FROM ig WHERE g > 1000
 UNION ALL SELECT track_id, 'source', cue_id, 'missing_english_link', NULL FROM cues c WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.track_id=c.track_id AND l.unit_id=c.cue_id))"""


def layout_units(t):
    cue = F.col("cue_id")
    return t.cues.select("track_id", cue.alias("unit_id"), (F.col("start_ms") + (cue % 4) * 500 - 900).alias("start_ms"), (F.col("end_ms") + (cue % 3) * 800).alias("end_ms"), "text")


def outdated(t):
    return t.cues.where(has("text", "q")).select("track_id", F.col("cue_id").alias("unit_id"))


def layout_flags(t):
    links = lk.link_tracks(t.cues, t.target)
    moved = layout_units(t)
    # The unit's own bounds, not the moved display times, decide whether a word is suspicious.
    return rl.layout_audit(moved, t.target.withColumnRenamed("cue_id", "translation_id"), links, unit_words(t), outdated(t))


LAYOUT_MOVED = LAYOUT.replace(ALIGNED, STATUS.replace("FROM edited u", "FROM (SELECT track_id, cue_id, start_ms + (cue_id % 4) * 500 - 900 AS start_ms, end_ms + (cue_id % 3) * 800 AS end_ms FROM cues) u"))


@plan("layout_audit_t8", f", {LAYOUT_MOVED} SELECT * FROM flags")
def layout_audit_t8(t):
    return layout_flags(t)


@plan("material_flags_t9", f""", {LAYOUT_MOVED}
SELECT * FROM flags WHERE kind IN ('stale_alignment','unreliable_alignment','missing_word_timing','translation_spans_dialogue_gap','missing_english_link') OR (kind IN ('possible_early_cue','possible_lingering_cue') AND measure >= 2000)""")
def material_flags_t9(t):
    return rl.material(layout_flags(t))


def row_sha(*names):
    return "sha256(concat_ws(chr(31), " + ", ".join(f"coalesce({n}::VARCHAR, '\\N')" for n in names) + "))"


BOUND = f"""{LAYOUT_MOVED},
ish AS (SELECT track_id, language, item_id, {row_sha('start_ms', 'end_ms', 'text')} AS item_sha FROM it),
fsh AS (SELECT track_id, language, item_id, {row_sha('stale', 'bad', 'ws', 'we')} AS fact_sha FROM rl),
bd AS (SELECT f.*, {row_sha('f.language', 'f.item_id', 'kind', 'CAST(trunc(measure) AS BIGINT)', 'item_sha', 'fact_sha')} AS binding FROM flags f LEFT JOIN ish ON ish.track_id=f.track_id AND ish.language=f.language AND ish.item_id=f.item_id
 LEFT JOIN fsh ON fsh.track_id=f.track_id AND fsh.language=f.language AND fsh.item_id=f.item_id)"""


def bound(t):
    key = ["track_id", "language", "item_id"]
    shown = layout_units(t).select("track_id", F.lit("source").alias("language"), F.col("unit_id").alias("item_id"), row_hash("start_ms", "end_ms", "text").alias("item_sha")).unionByName(
        t.target.select("track_id", F.lit("english").alias("language"), F.col("cue_id").alias("item_id"), row_hash("start_ms", "end_ms", "text").alias("item_sha")))
    links = lk.link_tracks(t.cues, t.target)
    bridge = t.cues.select("track_id", F.lit("source").alias("language"), F.col("cue_id").alias("item_id"), F.col("cue_id").alias("unit_id")).unionByName(
        links.select("track_id", F.lit("english").alias("language"), F.col("translation_id").alias("item_id"), "unit_id"))
    facts = bridge.join(rl.unit_facts(layout_units(t), unit_words(t), outdated(t)), ["track_id", "unit_id"])
    facts = facts.groupBy(*key).agg(F.bool_or("stale").alias("stale"), F.bool_or("bad").alias("bad"), F.min("ws").alias("ws"), F.max("we").alias("we"))
    return rl.bind_flags(layout_flags(t), shown, facts.select(*key, row_hash("stale", "bad", "ws", "we").alias("fact_sha")))


@plan("flag_binding_t13", f", {BOUND} SELECT track_id, language, item_id, kind, binding FROM bd")
def flag_binding_t13(t):
    return bound(t).drop("measure")


@plan("open_flags_t13", f", {BOUND} SELECT track_id, language, item_id, kind FROM bd WHERE NOT (kind <> 'fast_cue' AND coalesce(measure, 0) < 1500 AND substr(binding, 1, 1) >= '4')")
def open_flags_t13(t):
    flags = bound(t)
    # Decisions exist for the smaller findings; a quarter of them were bound to older content.
    old = F.substring("binding", 1, 1) < "4"
    decided = flags.where((F.col("kind") != "fast_cue") & (F.coalesce("measure", F.lit(0)) < 1500)).select(
        "track_id", "language", "item_id", "kind", F.when(old, F.reverse("binding")).otherwise(F.col("binding")).alias("binding"),
        F.lit("false_positive").alias("disposition"), F.lit("agent").alias("reviewer"), F.lit("heard").alias("reason"))
    return rl.open_flags(flags, decided).drop("measure", "binding")


# --- decisions ------------------------------------------------------------------------------

# Decisions cover the issues of ten seconds or more; a later one repeats the longest of them.
DECISIONS = f"""{SMALL},
ii AS (SELECT i.*, {row_sha('i.start_ms', 'i.end_ms')} AS interval_sha FROM issues i),
dc AS (SELECT track_id, issue_id, kind, start_ms, end_ms, CASE (start_ms // 100) % 3 WHEN 0 THEN 'reviewed' WHEN 1 THEN 'resolved' ELSE 'unresolved' END AS status,
  CASE WHEN start_ms % 5 = 0 THEN 'old' ELSE interval_sha END AS interval_sha, start_ms AS seq FROM ii WHERE end_ms-start_ms >= 10000
 UNION ALL SELECT track_id, kind || ':earlier-' || start_ms, kind, start_ms, end_ms, CASE WHEN end_ms % 2 = 0 THEN 'reviewed' ELSE 'unresolved' END, interval_sha, start_ms + 1 FROM ii WHERE end_ms-start_ms >= 15000)"""


def dated_issues(t):
    return issues(t).withColumn("interval_sha", row_hash("start_ms", "end_ms"))


def decided(t):
    found = dated_issues(t)
    return found, decisions_on(found)


def decisions_on(found):
    length = F.col("end_ms") - F.col("start_ms")
    turn = idiv(F.col("start_ms"), 100) % 3
    first = F.struct(
        "issue_id", F.when(turn == 0, "reviewed").when(turn == 1, "resolved").otherwise("unresolved").alias("status"),
        F.when(F.col("start_ms") % 5 == 0, "old").otherwise(F.col("interval_sha")).alias("interval_sha"), F.col("start_ms").alias("seq"))
    again = F.struct(
        F.concat("kind", F.lit(":earlier-"), "start_ms").alias("issue_id"),
        F.when(F.col("end_ms") % 2 == 0, "reviewed").otherwise("unresolved").alias("status"), "interval_sha", (F.col("start_ms") + 1).alias("seq"))
    made = found.select("track_id", "kind", "start_ms", "end_ms", F.explode(F.array_compact(F.array(
        F.when(length >= 10_000, first), F.when(length >= 15_000, again)))).alias("_d"))
    return made.select("track_id", "_d.issue_id", "kind", "start_ms", "end_ms", "_d.status", "_d.interval_sha", "_d.seq")


LAST = """l_id AS (SELECT track_id, issue_id, arg_max({'kind': kind, 's': start_ms, 'e': end_ms, 'status': status, 'sha': interval_sha}, seq) AS d FROM dc GROUP BY 1, 2),
l_sp AS (SELECT track_id, kind, start_ms, end_ms, arg_max(status, seq) AS st FROM dc GROUP BY 1, 2, 3, 4),
jj AS (SELECT ii.*, d, st FROM ii LEFT JOIN l_id ON l_id.track_id=ii.track_id AND l_id.issue_id=ii.issue_id LEFT JOIN l_sp ON l_sp.track_id=ii.track_id AND l_sp.kind=ii.kind AND l_sp.start_ms=ii.start_ms AND l_sp.end_ms=ii.end_ms)"""


@plan("pending_issues_j17", f""", {DECISIONS}, {LAST}
SELECT track_id, issue_id, kind, start_ms, end_ms FROM jj WHERE NOT (coalesce(d.kind=kind AND d.s=start_ms AND d.e=end_ms AND d.status IN ('reviewed','resolved') AND d.sha=interval_sha, false)
 OR coalesce(kind IN ('subtitle_gap','possible_speech_gap') AND st='reviewed', false))""")
def pending_issues_j17(t):
    return rl.pending(*decided(t)).drop("interval_sha")


@plan("closing_decision_j18", f""", {DECISIONS}
SELECT i.track_id, i.issue_id, i.kind, i.start_ms, i.end_ms, arg_max(d.status, d.seq) AS status, max(d.seq) AS seq FROM ii i
LEFT JOIN dc d ON d.track_id=i.track_id AND (d.issue_id=i.issue_id OR (d.kind=i.kind AND d.start_ms=i.start_ms AND d.end_ms=i.end_ms)) GROUP BY 1, 2, 3, 4, 5""")
def closing_decision_j18(t):
    return rl.closing_decision(*decided(t)).drop("interval_sha")


@plan("stale_decisions_j19", f""", {DECISIONS} SELECT track_id, issue_id, seq FROM dc WHERE NOT EXISTS (SELECT 1 FROM ii WHERE ii.track_id=dc.track_id AND ii.issue_id=dc.issue_id AND ii.interval_sha=dc.interval_sha)""")
def stale_decisions_j19(t):
    found, decisions = decided(t)
    return rl.stale(decisions, found, ["track_id", "issue_id"], "interval_sha").select("track_id", "issue_id", "seq")


@plan("unresolved_issues_j29", f""", {DECISIONS},
li AS (SELECT track_id, issue_id, arg_max(status, seq) AS st FROM dc WHERE end_ms % 3 = 0 GROUP BY 1, 2),
ls AS (SELECT track_id, kind, start_ms, end_ms, arg_max(status, seq) AS st FROM dc WHERE end_ms % 3 <> 0 GROUP BY 1, 2, 3, 4)
SELECT ii.track_id, ii.issue_id, ii.kind, ii.start_ms, ii.end_ms FROM ii LEFT JOIN li ON li.track_id=ii.track_id AND li.issue_id=ii.issue_id
LEFT JOIN ls ON ls.track_id=ii.track_id AND ls.kind=ii.kind AND ls.start_ms=ii.start_ms AND ls.end_ms=ii.end_ms
WHERE coalesce(li.st='unresolved', false) OR coalesce(ls.st='unresolved', false)""")
def unresolved_issues_j29(t):
    return still_unresolved(*decided(t))


def still_unresolved(found, decisions):
    # A third of the decisions names no interval.
    whole = F.col("end_ms") % 3 != 0
    return rl.unresolved(found, decisions.withColumn("start_ms", F.when(whole, F.col("start_ms"))).withColumn("end_ms", F.when(whole, F.col("end_ms")))).drop("interval_sha")


@plan("missing_keys_x2", f", {DECISIONS} SELECT DISTINCT track_id, issue_id FROM ii WHERE NOT EXISTS (SELECT 1 FROM dc WHERE dc.track_id=ii.track_id AND dc.issue_id=ii.issue_id)")
def missing_keys_x2(t):
    return rl.missing_keys(*decided(t), ["track_id", "issue_id"])


@plan("bad_keys_x3", f""", {DECISIONS}, k AS (SELECT track_id, kind, start_ms, count(*) AS n FROM dc GROUP BY 1, 2, 3)
SELECT track_id, kind, start_ms, 'duplicate' AS problem FROM k WHERE n > 1 UNION ALL
SELECT track_id, kind, start_ms, 'obsolete' FROM k WHERE NOT EXISTS (SELECT 1 FROM ii WHERE ii.track_id=k.track_id AND ii.kind=k.kind AND ii.start_ms=k.start_ms AND length(ii.issue_id) < 16)""")
def bad_keys_x3(t):
    found, decisions = decided(t)
    return rl.bad_keys(decisions, found.where(F.length("issue_id") < 16), ["track_id", "kind", "start_ms"])


@plan("unknown_ids_x4", """SELECT track_id, cue_id AS translation_id, count(*) AS n_unknown FROM (SELECT *, unnest(range((cue_id-1)*3+1, cue_id*3+1)) AS u FROM target_long) t
WHERE NOT EXISTS (SELECT 1 FROM cues c WHERE c.track_id=t.track_id AND c.cue_id=t.u) GROUP BY 1, 2""")
def unknown_ids_x4(t):
    rows = t.target_long.select("track_id", F.col("cue_id").alias("translation_id"), F.sequence((F.col("cue_id") - 1) * 3 + 1, F.col("cue_id") * 3).alias("source_ids"))
    return rl.not_subset(rows, t.cues.select("track_id", "cue_id"), ["track_id", "translation_id"], "source_ids", "cue_id")


AUDIO = """ad AS (SELECT track_id, cue_id AS decision_id, start_ms, end_ms, CASE WHEN contains(text,'w') THEN 'noise' WHEN length(text) < 30 THEN 'silence' WHEN contains(text,'q') THEN NULL ELSE 'relevant_speech' END AS outcome,
 CASE WHEN length(text) < 60 THEN 'no_relevant_speech' ELSE 'source_supported' END AS disposition, CASE WHEN contains(text,'z') THEN ' ' ELSE 'ok' END AS reason, 'agent' AS reviewer, 1 AS n_evidence FROM edited)"""


@plan("decision_errors_t11", f""", {AUDIO}, r AS (SELECT ad.*, disposition='no_relevant_speech' AND EXISTS (SELECT 1 FROM labelled c WHERE c.track_id=ad.track_id AND c.start_ms < ad.end_ms AND c.end_ms > ad.start_ms AND NOT regexp_full_match(c.text, '\\s*(\\[[^\\]]+\\]\\s*)+')) AS clash FROM ad),
e AS (SELECT track_id, decision_id, CASE WHEN outcome='noise' THEN 'invalid_outcome' WHEN trim(reason)='' THEN 'incomplete' WHEN disposition='no_relevant_speech' AND coalesce(outcome,'') <> 'silence' THEN 'needs_non_speech_outcome' WHEN clash THEN 'overlaps_spoken_cue' END AS error FROM r)
SELECT * FROM e WHERE error IS NOT NULL""")
def decision_errors_t11(t):
    outcome = F.when(has("text", "w"), "noise").when(F.length("text") < 30, "silence").when(has("text", "q"), None).otherwise("relevant_speech")
    decisions = t.edited.select("track_id", F.col("cue_id").alias("decision_id"), "start_ms", "end_ms", outcome.alias("outcome"),
                                F.when(F.length("text") < 60, "no_relevant_speech").otherwise("source_supported").alias("disposition"),
                                F.when(has("text", "z"), " ").otherwise("ok").alias("reason"), F.lit("agent").alias("reviewer"), F.lit(1).alias("n_evidence"))
    return rl.decision_errors(decisions, t.labelled)


@plan("grouping_pending_t12", f"""
, fl AS (SELECT b.track_id, 'many_source_cues_one_target:' || b.cue_id AS flag_id, 'many_source_cues_one_target' AS kind, {row_sha('b.track_id', 'b.cue_id')} AS sha, count(*) AS n FROM target_long b JOIN cues a ON a.track_id=b.track_id AND {STRICT} AND {MEANINGFUL} GROUP BY b.track_id, b.cue_id HAVING count(*) >= 3)
SELECT track_id, flag_id, kind FROM fl WHERE substr(sha, 1, 1) < '8'""")
def grouping_pending_t12(t):
    found = iv.many_to_one(t.cues, t.target_long).select("track_id", "target_id").distinct()
    flags = found.select("track_id", F.concat(F.lit("many_source_cues_one_target:"), "target_id").alias("flag_id"), F.lit("many_source_cues_one_target").alias("kind"), row_hash("track_id", "target_id").alias("sha"))
    seen = flags.where(F.substring("sha", 1, 1) >= "8").select("track_id", "flag_id", "sha", F.lit("independent_display_grouping").alias("disposition"), F.lit("reads well").alias("reason"))
    return rl.grouping_pending(flags, seen).select("track_id", "flag_id", "kind")


# --- evidence -------------------------------------------------------------------------------

@plan("evidence_issues_t6", """
, e AS (SELECT c.track_id, CASE WHEN contains(text,'w') THEN 'shared' ELSE 'e' || cue_id END AS evidence_id, start_ms - 3000 AS start_ms, end_ms, CASE WHEN contains(text,'z') THEN ' ' ELSE 'differs' END AS summary, length(text) % 9 AS n_refs, duration_ms FROM cues c JOIN media USING (track_id))
SELECT track_id, evidence_id, start_ms, end_ms, summary FROM e WHERE start_ms >= 0 AND start_ms < end_ms AND end_ms <= duration_ms AND trim(summary) <> '' AND n_refs > 0
AND (SELECT count(*) FROM e x WHERE x.track_id=e.track_id AND x.evidence_id=e.evidence_id) = 1""")
def evidence_issues_t6(t):
    rows = t.cues.select("track_id", F.when(has("text", "w"), "shared").otherwise(F.concat(F.lit("e"), "cue_id")).alias("evidence_id"), (F.col("start_ms") - 3000).alias("start_ms"), "end_ms",
                         F.when(has("text", "z"), " ").otherwise("differs").alias("summary"), (F.length("text") % 9).alias("n_refs"))
    return rl.evidence_issues(rows, t.media)


@plan("valid_observations_s11", """
, o AS (SELECT track_id, cue_id AS obs_id, CASE WHEN contains(text,'w') THEN 'noise' WHEN contains(text,'q') THEN 'asr' ELSE 'audio_event' END AS kind, CASE WHEN contains(text,'z') THEN 'speech' ELSE 'clap' END AS label, text,
 CASE WHEN contains(text,'k') THEN NULL ELSE length(text) / 200.0::DOUBLE END AS confidence, start_ms, end_ms, start_ms // 60000 * 60000 AS r_start, start_ms // 60000 * 60000 + 60000 AS r_end FROM cues)
SELECT track_id, obs_id, kind FROM o WHERE kind IN ('audio_event','asr') AND r_start <= start_ms AND start_ms < end_ms AND end_ms <= r_end AND trim(text) <> '' AND (kind <> 'audio_event' OR (label='speech' AND (confidence IS NULL OR confidence BETWEEN 0 AND 1)))""")
def valid_observations_s11(t):
    r = idiv(F.col("start_ms"), 60_000) * 60_000
    rows = t.cues.select("track_id", F.col("cue_id").alias("obs_id"), F.when(has("text", "w"), "noise").when(has("text", "q"), "asr").otherwise("audio_event").alias("kind"),
                         F.when(has("text", "z"), "speech").otherwise("clap").alias("label"), "text", F.when(~has("text", "k"), F.length("text") / F.lit(200.0)).alias("confidence"),
                         "start_ms", "end_ms", r.alias("r_start"), (r + 60_000).alias("r_end"))
    return rl.valid_observations(rows).select("track_id", "obs_id", "kind")


@plan("evidence_errors_t18", f"""
, cl AS (SELECT track_id, cue_id, start_ms - 500 AS start_ms, start_ms + (end_ms-start_ms)//2 AS end_ms, NOT contains(text,'q') AS ok FROM cues UNION ALL SELECT track_id, cue_id, start_ms + (end_ms-start_ms)//2 + CASE WHEN contains(text,'w') THEN 50 ELSE 0 END, end_ms + 500, true FROM cues),
g AS (SELECT track_id, cue_id, start_ms, end_ms FROM cl WHERE start_ms >= 0 AND start_ms < end_ms), {MERGE.format(out='gm', by='track_id, cue_id', src='SELECT * FROM g')},
cv AS (SELECT c.track_id, c.cue_id, bool_or(gm.track_id IS NOT NULL) AS covered FROM cues c LEFT JOIN gm ON gm.track_id=c.track_id AND gm.cue_id=c.cue_id AND gm.start_ms <= c.start_ms AND gm.end_ms >= c.end_ms GROUP BY 1, 2),
bd AS (SELECT track_id, cue_id, bool_or(NOT ok OR start_ms < 0 OR start_ms >= end_ms) AS bad FROM cl GROUP BY 1, 2)
SELECT track_id, cue_id, CASE WHEN bad THEN 'malformed_clip' ELSE 'interval_not_covered' END AS error FROM cv JOIN bd USING (track_id, cue_id) WHERE bad OR NOT covered""")
def evidence_errors_t18(t):
    half = F.col("start_ms") + idiv(F.col("end_ms") - F.col("start_ms"), 2)
    one = t.cues.select("track_id", "cue_id", (F.col("start_ms") - 500).alias("start_ms"), half.alias("end_ms"), (~has("text", "q")).alias("media_ok"))
    two = t.cues.select("track_id", "cue_id", (half + F.when(has("text", "w"), 50).otherwise(0)).alias("start_ms"), (F.col("end_ms") + 500).alias("end_ms"), F.lit(True).alias("media_ok"))
    return rl.evidence_errors(one.unionByName(two), t.cues.drop("text"), ["cue_id"])


@plan("review_errors_t15", """
, q AS (SELECT c.*, CASE WHEN cue_id % 2 = 0 THEN end_ms ELSE duration_ms END AS dur, cue_id % 3 AS route, start_ms + (end_ms - start_ms) // 2 AS mid,
 cue_id % 19 = 0 OR cue_id % 23 = 0 OR cue_id % 29 = 0 AS stale, cue_id % 17 = 0 OR cue_id % 31 = 0 AS unjudged FROM cues c JOIN media USING (track_id)),
o AS (SELECT track_id, cue_id, 'a' AS model, 'a1' AS receipt, greatest(start_ms - 10, 0) AS start_ms, CASE WHEN route = 1 THEN mid ELSE end_ms + 10 END AS end_ms, false AS whole FROM q
 UNION ALL SELECT track_id, cue_id, 'a', 'a2', CASE WHEN route <> 1 THEN start_ms WHEN cue_id % 7 = 0 THEN mid + 5 ELSE mid END, end_ms, false FROM q
 UNION ALL SELECT track_id, cue_id, CASE WHEN cue_id % 13 = 0 THEN 'a' ELSE 'b' END, 'b1', CASE WHEN route = 1 AND cue_id % 5 > 2 THEN 0 ELSE start_ms END,
  CASE WHEN route <> 1 AND cue_id % 5 = 0 THEN end_ms - 60 WHEN route = 1 AND cue_id % 5 = 3 THEN end_ms - 30 WHEN route = 1 AND cue_id % 5 = 4 THEN end_ms - 70 ELSE end_ms + 5 END, route = 1 AND cue_id % 5 > 2 FROM q),
u AS (SELECT q.track_id, q.cue_id, bool_and(q.cue_id % 37 <> 0 AND q.cue_id % 41 <> 0 AND (q.route = 1 AND o.start_ms < o.end_ms OR q.route = 0 AND q.cue_id % 11 <> 0 AND o.start_ms <= q.start_ms AND o.end_ms >= q.end_ms)) AS usable,
 count(DISTINCT model) AS models FROM q JOIN o ON o.track_id=q.track_id AND o.cue_id=q.cue_id GROUP BY 1, 2), """ + MERGE.format(out="om", by="track_id, cue_id, model", src="SELECT track_id, cue_id, model, start_ms, end_ms FROM o") + """,
rr AS (SELECT q.track_id, q.cue_id, q.end_ms, q.dur, m.model, greatest(q.start_ms, coalesce(max(m.end_ms) FILTER (m.start_ms <= q.start_ms), 0)) AS reach FROM q JOIN om m ON m.track_id=q.track_id AND m.cue_id=q.cue_id GROUP BY q.track_id, q.cue_id, q.end_ms, q.dur, q.start_ms, m.model),
w AS (SELECT rr.track_id, rr.cue_id, bool_and(reach >= rr.end_ms OR coalesce(reach = au.e AND rr.end_ms = rr.dur AND rr.end_ms - reach <= 50, false)) AS ok FROM rr
 LEFT JOIN (SELECT track_id, cue_id, model, max(end_ms) AS e FROM o WHERE whole GROUP BY 1, 2, 3) au ON au.track_id=rr.track_id AND au.cue_id=rr.cue_id AND au.model=rr.model GROUP BY 1, 2),
v AS (SELECT q.track_id, q.cue_id AS issue_id, CASE WHEN stale THEN 'stale_or_uncertain' WHEN route < 2 AND unjudged THEN 'needs_agent_judgment' WHEN route < 2 AND NOT usable THEN 'observation_unusable'
 WHEN route < 2 AND models < 2 THEN 'needs_two_models_and_receipts' WHEN route = 1 AND NOT w.ok THEN 'interval_not_covered' WHEN route = 2 AND length(text) < 40 THEN 'needs_two_ordered_stages' END AS error
 FROM q JOIN u ON u.track_id=q.track_id AND u.cue_id=q.cue_id JOIN w ON w.track_id=q.track_id AND w.cue_id=q.cue_id)
SELECT * FROM v WHERE error IS NOT NULL""")
def review_errors_t15(t):
    n = F.col("issue_id")
    every = lambda k: n % k == 0
    base = t.cues.join(t.media, "track_id").select(
        "track_id", F.col("cue_id").alias("issue_id"), "start_ms", "end_ms", F.when(F.col("cue_id") % 2 == 0, F.col("end_ms")).otherwise(F.col("duration_ms")).alias("duration_ms"),
        F.lit("v").alias("media_sha"), F.sha2("text", 256).alias("interval_sha"), "text")
    route = F.when(every(3), "local_asr_agent").when(n % 3 == 1, "saved_asr_agent").otherwise("provider")
    results = base.select(
        "track_id", "issue_id", (F.col("start_ms") - 100).alias("start_ms"), (F.col("end_ms") + F.when(every(19), -10).otherwise(100)).alias("end_ms"),
        F.when(every(23), "uncertain").otherwise("supported").alias("status"), route.alias("route"), "media_sha",
        F.when(every(29), "x").otherwise(F.col("interval_sha")).alias("interval_sha"),
        F.when(every(17), " ").otherwise("agent").alias("reviewer"), F.lit("heard twice").alias("reason"), every(31).alias("heard_original"))
    saved, mid = n % 3 == 1, F.col("start_ms") + F.expr("(end_ms - start_ms) div 2")
    late = F.when(~saved & every(5), -60).when(saved & (n % 5 == 3), -30).when(saved & (n % 5 == 4), -70).otherwise(5)
    row = lambda model, receipt, first, last, whole: F.struct(
        model.alias("model"), F.lit(receipt).alias("receipt"), first.alias("start_ms"), last.alias("end_ms"), whole.alias("whole"))
    obs = base.select("track_id", "issue_id", "media_sha", F.explode(F.array(
        row(F.lit("a"), "a1", F.greatest(F.col("start_ms") - 10, F.lit(0)), F.when(saved, mid).otherwise(F.col("end_ms") + 10), F.lit(False)),
        row(F.lit("a"), "a2", F.when(~saved, F.col("start_ms")).when(every(7), mid + 5).otherwise(mid), F.col("end_ms"), F.lit(False)),
        row(F.when(every(13), "a").otherwise("b"), "b1", F.when(saved & (n % 5 > 2), 0).otherwise(F.col("start_ms")), F.col("end_ms") + late, saved & (n % 5 > 2)))).alias("_o"))
    obs = obs.select("track_id", "issue_id", "media_sha", "_o.*", F.when(every(37), "other").when(saved, "hosted_asr").otherwise("local_asr").alias("method"),
                     F.when(every(11), " ").otherwise("1").alias("model_version"), (~every(41)).alias("receipt_ok"))
    stages = base.select("track_id", "issue_id", F.posexplode(F.array(F.lit("independent"), F.when(F.length("text") < 40, "again").otherwise("comparison"))).alias("pos", "stage"), F.lit("m").alias("model"), F.lit("heard").alias("assessment"))
    return rl.review_errors(results, base.drop("text"), obs, stages)


@plan("open_findings_t16", """
SELECT track_id, cue_id AS source_id FROM edited WHERE (contains(text,'q') OR contains(text,'w')) AND NOT (length(text) >= 60 AND NOT contains(text,'z') AND (contains(text,'w') OR NOT contains(text,'k')))""")
def open_findings_t16(t):
    found = t.edited.where(has("text", "q") | has("text", "w")).withColumnRenamed("cue_id", "source_id")
    shas = [F.sha2(F.concat(F.lit(tag), "text"), 256).alias(f"{tag}_sha") for tag in ("input", "response", "finding")]
    assessments = found.select("track_id", "source_id", F.lit("uncertain").alias("verdict"), *shas)
    given = found.select("track_id", "source_id", *shas[:2], F.when(F.length("text") < 60, "old").otherwise(shas[2]).alias("finding_sha"), F.lit("supported_as_written").alias("disposition"),
                         F.when(has("text", "w"), "translation_semantics").otherwise("source_recognition").alias("question_type"), F.lit("agent").alias("reviewer"), F.lit("reads right").alias("reason"))
    evidence = found.select("track_id", "source_id", F.when(has("text", "k"), "source_text").otherwise("original_audio").alias("kind"), F.lit("a").alias("sha"), F.when(has("text", "z"), "b").otherwise("a").alias("current_sha"))
    return rl.open_findings(assessments, given, evidence).select("track_id", "source_id")


# --- text scoring ---------------------------------------------------------------------------

# Words of both sides with their occurrence; what has no partner forms runs.
WORD_RUNS = """, jt AS (SELECT h.track_id, h.start_ms, coalesce(string_agg(c.text, ' ' ORDER BY c.cue_id), '') AS cue_text FROM heard h
 LEFT JOIN target c ON c.track_id=h.track_id AND c.start_ms < h.end_ms AND c.end_ms > h.start_ms GROUP BY 1, 2),
sd AS (SELECT track_id, start_ms, 'h' AS side, {th} AS w FROM heard UNION ALL SELECT track_id, start_ms, 'w', {tw} FROM jt),
tk AS (SELECT track_id, start_ms, side, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM sd),
oc AS (SELECT *, row_number() OVER (PARTITION BY track_id, start_ms, side, word ORDER BY pos) AS nth FROM tk),
ln AS (SELECT *, pos - row_number() OVER (PARTITION BY track_id, start_ms, side ORDER BY pos) AS g FROM oc a
 WHERE NOT EXISTS (SELECT 1 FROM oc b WHERE b.track_id=a.track_id AND b.start_ms=a.start_ms AND b.side<>a.side AND b.word=a.word AND b.nth=a.nth)),
rn AS (SELECT track_id, start_ms, side, g, count(*) AS n, min(pos) AS f, bool_or(word IN ('evet','hayır','değil','yok','var','asla','hiç','no','not','never','yes')) AS turned FROM ln GROUP BY ALL),
tp AS (SELECT * FROM rn QUALIFY row_number() OVER (PARTITION BY track_id, start_ms, side ORDER BY n DESC, f) = 1)""".replace("GROUP BY ALL", "GROUP BY 1, 2, 3, 4").format(th=tokens("text"), tw=tokens("cue_text"))


@plan("token_diff_t2", WORD_RUNS + """
SELECT h.track_id, h.start_ms, coalesce(a.n, 0)::INTEGER AS unmatched, coalesce(b.n, 0)::INTEGER AS unsupported, coalesce(a.turned, false) OR coalesce(b.turned, false) AS polarity
FROM heard h LEFT JOIN tp a ON a.track_id=h.track_id AND a.start_ms=h.start_ms AND a.side='h' LEFT JOIN tp b ON b.track_id=h.track_id AND b.start_ms=h.start_ms AND b.side='w'""")
def token_diff_t2(t):
    d = F.col("_d")
    return sc.token_diff(ms.window_text(t.heard, t.target)).select("track_id", "start_ms", d["longest_unmatched"].alias("unmatched"), d["longest_unsupported"].alias("unsupported"), d["polarity"].alias("polarity"))


@plan("window_classes_t3", WORD_RUNS + f""",
un AS (SELECT track_id, start_ms, count(*) AS n FROM ln WHERE side='h' GROUP BY 1, 2),
dg AS (SELECT track_id, start_ms, coalesce(list_bool_or(list_transform(w, lambda x: length(x) > 40)), false) OR {loop_sql(4)} OR
 (len(w) >= 8 AND list_max(list_transform(list_distinct(w), lambda x: len(list_filter(w, lambda y: y = x)))) > 0.45 * len(w)) AS looped FROM sd WHERE side='h'),
st AS (SELECT h.track_id, h.start_ms, len(h.w) AS nh, len(x.w) AS nw, looped, CASE WHEN len(h.w) > 0 THEN round((len(h.w) - coalesce(un.n, 0)) * 1.0::DOUBLE / len(h.w), 3) END AS ag,
  coalesce(a.n, 0) AS mi, coalesce(b.n, 0) AS ex, coalesce(a.turned, false) OR coalesce(b.turned, false) AS turned
 FROM sd h JOIN sd x ON x.track_id=h.track_id AND x.start_ms=h.start_ms AND x.side='w' JOIN dg ON dg.track_id=h.track_id AND dg.start_ms=h.start_ms LEFT JOIN un ON un.track_id=h.track_id AND un.start_ms=h.start_ms
 LEFT JOIN tp a ON a.track_id=h.track_id AND a.start_ms=h.start_ms AND a.side='h' LEFT JOIN tp b ON b.track_id=h.track_id AND b.start_ms=h.start_ms AND b.side='w' WHERE h.side='h')
SELECT track_id, start_ms, nh AS heard_words, nw AS written_words, ag AS word_agreement, mi::INTEGER AS longest_unmatched, ex::INTEGER AS longest_unsupported,
 CASE WHEN looped THEN 'repeated_asr_output'
  WHEN nh > 0 AND ((greatest(nh, nw) <= 20 AND (mi >= 3 OR turned OR (nh >= 6 AND ag < 0.25))) OR (greatest(nh, nw) > 20 AND mi >= 6 AND ag < 0.65)) THEN 'possible_missing_or_wrong_subtitle'
  WHEN nh > 0 AND ((greatest(nh, nw) <= 20 AND ex >= 3) OR (greatest(nh, nw) > 20 AND ex >= 8 AND ag < 0.6)) THEN 'possible_unsupported_subtitle' END AS issue FROM st""")
def window_classes_t3(t):
    return sc.classify_window(ms.window_text(t.heard, t.target)).select("track_id", "start_ms", "heard_words", "written_words", "word_agreement", "longest_unmatched", "longest_unsupported", "issue")


@plan("window_status_t4", """
, w AS (SELECT *, CASE WHEN contains(text,'z') THEN 'length' END AS fr, CASE WHEN contains(text,'k') THEN 'repeated_asr_output' END AS iss, len(regexp_extract_all(lower(translate(text,'İ','i')),'\\p{L}+')) AS n FROM heard),
s AS (SELECT *, CASE WHEN fr='length' OR generation_tokens >= 200 THEN 'truncated' WHEN text='' THEN 'empty' WHEN n >= 192 THEN 'truncated' WHEN iss IS NOT NULL THEN 'questionable' ELSE 'complete' END AS status FROM w)
SELECT track_id, start_ms, status, CASE WHEN status IN ('empty','truncated') THEN status || '_asr_output' ELSE iss END AS issue FROM s""")
def window_status_t4(t):
    rows = t.heard.withColumn("finish_reason", F.when(has("text", "z"), "length")).withColumn("issue", F.when(has("text", "k"), "repeated_asr_output"))
    return sc.window_status(rows, 200).select("track_id", "start_ms", "status", "issue")


@plan("ctc_scores_t14", """/*recursive*/, ev AS (SELECT vec_id AS clip_id, label, list_transform(embedding, lambda v: exp(v::DOUBLE)) AS e FROM embeddings),
fr AS (SELECT clip_id, k AS frame_no, list_transform(list_slice(e, k * 8 + 1, k * 8 + 8), lambda v: v / list_sum(list_slice(e, k * 8 + 1, k * 8 + 8))) AS p FROM ev, range(64) g(k) WHERE k < len(e) // 8),
ca AS (SELECT clip_id, 0 AS candidate_id, [0, 1, 0, 2, 0] AS s FROM ev UNION ALL SELECT clip_id, 1, [0, 3, 0, 3, 0] FROM ev UNION ALL SELECT clip_id, 2, [0, label % 7 + 1, 0] FROM ev),
fw AS (SELECT clip_id, candidate_id, s, 0::BIGINT AS f, list_transform(range(0, len(s)), lambda j: CASE WHEN j = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) AS a FROM ca
 UNION ALL SELECT fw.clip_id, candidate_id, s, f + 1, list_transform(range(0, len(s)), lambda j: p[s[j + 1] + 1] * (a[j + 1] + CASE WHEN j > 0 THEN a[j] ELSE 0 END + CASE WHEN j > 1 AND s[j + 1] <> 0 AND s[j + 1] <> s[j - 1] THEN a[j - 1] ELSE 0 END))
 FROM fw JOIN fr ON fr.clip_id = fw.clip_id AND fr.frame_no = fw.f),
z AS (SELECT clip_id, candidate_id, s, f AS n, ln(a[-1] + a[-2]) AS score FROM fw QUALIFY f = max(f) OVER (PARTITION BY clip_id, candidate_id))
SELECT clip_id, candidate_id, round(score, 9) AS score, round(score / n, 9) AS per_frame, round(score / (len(s) // 2), 9) AS per_token FROM z""")
def ctc_scores_t14(t):
    """Embeddings cut into frames of eight token scores; exhaustive path sums in the tests."""
    dims = F.transform("embedding", lambda v: v.cast("double"))
    vec = t.raw("embeddings").select("vec_id", "label", dims.alias("e"))
    rows = vec.select(F.col("vec_id").alias("clip_id"), F.explode(F.sequence(F.lit(0).cast("bigint"), idiv(F.size("e").cast("bigint"), 8) - 1)).alias("frame_no"), "e").withColumn(
        "f", F.slice("e", (F.col("frame_no") * 8 + 1).cast("int"), F.lit(8)))
    total = F.log(F.aggregate("f", F.lit(0.0), lambda acc, v: acc + F.exp(v)))
    frames = rows.withColumn("_z", total).select("clip_id", "frame_no", F.transform("f", lambda v: v - F.col("_z")).alias("log_probs"))
    candidates = vec.select(F.col("vec_id").alias("clip_id"), F.posexplode(F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(3)), F.array((F.col("label") % 7 + 1).cast("int")))).alias("candidate_id", "tokens"))
    out = sc.ctc_scores(frames, candidates, chunk=3)
    return out.select("clip_id", "candidate_id", *[F.round(c, 9).alias(c) for c in ("score", "per_frame", "per_token")])


@plan("coverage_queue_w6", f""", late AS (SELECT track_id, start_ms + (end_ms-start_ms)//2 AS start_ms, end_ms FROM speech), {SILENT.replace('FROM speech', 'FROM late')}
SELECT track_id, count(*) AS parts, CAST(sum(piece_end-piece_start) AS BIGINT) AS silent_ms FROM u WHERE piece_end-piece_start >= 3000 GROUP BY 1""")
def coverage_queue_w6(t):
    return iv.silent_cue_parts(late_speech(t), t.labelled).groupBy("track_id").agg(F.count(F.lit(1)).alias("parts"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("silent_ms"))


@plan("overlap_counts_a1", "SELECT track_id, count(*) AS n FROM (SELECT *, lag(end_ms) OVER (PARTITION BY track_id ORDER BY cue_id) AS pe FROM cues) WHERE pe > start_ms GROUP BY 1")
def overlap_counts_a1(t):
    return ms.issue_counts(iv.overlaps(t.cues, id_chunk("cue_id")), ["track_id"])
