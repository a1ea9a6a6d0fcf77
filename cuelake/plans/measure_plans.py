"""Aggregate queries: statistics, agreement, usage, completeness, verdicts, gates."""

from pyspark.sql import functions as F

from cuelake.functions.base import idiv
from cuelake.operators import intervals as iv
from cuelake.operators import ledger as lg
from cuelake.operators import linking as lk
from cuelake.operators import measures as ms
from cuelake.operators import scoring as sc
from cuelake.operators import sequences as sq
from cuelake.operators.ordered import id_chunk
from cuelake.plans.interval_plans import GAPS, MERGE
from cuelake.plans.link_plans import LINKS_SQL, translated, units
from cuelake.plans.registry import plan
from cuelake.plans.sequence_plans import CLIPS, short_clips
from cuelake.plans.views import tokens

T = ["track_id"]


def has(text, letter):
    return F.contains(F.col(text), F.lit(letter))


STATS = """(SELECT track_id, count(*) AS cues, count(*) FILTER (end_ms-start_ms < 1000) AS under_1s,
 count(*) FILTER (end_ms > start_ms AND length(replace(text, chr(10), ' ')) * 1000.0 / (end_ms-start_ms) > 20) AS over_20_cps, count(*) FILTER (pe > start_ms) AS overlaps
 FROM (SELECT *, lag(end_ms) OVER (PARTITION BY track_id ORDER BY cue_id) AS pe FROM {src}) GROUP BY 1)"""


@plan("track_stats_a9", f"SELECT * FROM {STATS.format(src='target')}")
def track_stats_a9(t):
    return ms.track_stats(t.target)


COMPARED = f"""cmp AS (SELECT b.track_id, b.under_1s AS under_1s_before, b.over_20_cps AS over_20_cps_before, b.overlaps AS overlaps_before, a.under_1s AS under_1s_after, a.over_20_cps AS over_20_cps_after, a.overlaps AS overlaps_after,
 a.under_1s > b.under_1s OR a.over_20_cps > b.over_20_cps OR a.overlaps > b.overlaps AS regressed FROM {STATS.format(src='cues')} b JOIN {STATS.format(src='edited')} a USING (track_id))"""


@plan("compare_versions_a10", f", {COMPARED} SELECT * FROM cmp")
def compare_versions_a10(t):
    return ms.compare_versions(t.cues, t.edited)


@plan("version_totals_a10", f""", {COMPARED} SELECT count(*) AS tracks, CAST(sum(under_1s_before) AS BIGINT) AS under_1s_before, CAST(sum(over_20_cps_before) AS BIGINT) AS over_20_cps_before, CAST(sum(overlaps_before) AS BIGINT) AS overlaps_before,
 CAST(sum(under_1s_after) AS BIGINT) AS under_1s_after, CAST(sum(over_20_cps_after) AS BIGINT) AS over_20_cps_after, CAST(sum(overlaps_after) AS BIGINT) AS overlaps_after, count(*) FILTER (regressed) AS regressed FROM cmp""")
def version_totals_a10(t):
    return ms.version_totals(ms.compare_versions(t.cues, t.edited))


@plan("duration_audit_a11", """SELECT track_id, count(*) AS cues, count(*) FILTER (end_ms-start_ms > 8000) AS flagged, max(end_ms-start_ms) FILTER (end_ms-start_ms > 8000) AS worst_ms FROM cues GROUP BY 1""")
def duration_audit_a11(t):
    return ms.duration_audit(t.cues)


@plan("worst_cues_o2", """SELECT track_id, cue_id, start_ms, end_ms, end_ms-start_ms AS duration_ms FROM cues WHERE end_ms-start_ms > 8000 ORDER BY duration_ms DESC, track_id, cue_id LIMIT 50""")
def worst_cues_o2(t):
    return ms.worst(t.cues, 50)


@plan("reading_profile_a12", f"""SELECT track_id, count(*) AS cues, CAST(sum(len({tokens()})) AS BIGINT) AS words, median(end_ms-start_ms) AS median_ms, count(*) FILTER (end_ms-start_ms < 1000) AS under_1s,
 count(*) FILTER (length(replace(text, chr(10), '')) * 1000.0 / (end_ms-start_ms) > 25) AS over_25_cps,
 round(count(*) FILTER (length(replace(text, chr(10), '')) * 1000.0 / (end_ms-start_ms) > 25) * 100.0 / count(*), 1)::DOUBLE AS over_25_percent FROM target GROUP BY 1""")
def reading_profile_a12(t):
    return ms.reading_profile(t.target).withColumn("over_25_percent", F.col("over_25_percent").cast("double"))


PHRASE = """ph AS (SELECT track_id, text, count(*) AS n FROM cues GROUP BY ALL),
tp AS (SELECT track_id, arg_min(text, (-n, text)) AS phrase, max(n) AS n, CAST(sum(n) AS BIGINT) AS cues, count(*) AS distinct_texts FROM ph GROUP BY 1)"""


@plan("top_phrase_a13", f", {PHRASE} SELECT * FROM tp")
def top_phrase_a13(t):
    return ms.top_phrase(t.cues)


@plan("dominant_line_a14", f", {PHRASE} SELECT track_id, phrase, n, cues FROM tp WHERE n >= cues * 0.1")
def dominant_line_a14(t):
    return ms.dominant_line(t.cues, 0.1).drop("distinct_texts")


@plan("throughput_a15", """SELECT event_type AS setting, CAST(sum(event_id % 50) AS BIGINT) AS items, CAST(sum(1 + event_id % 7) AS BIGINT) AS seconds, count(*) FILTER (value < 5) AS failures,
 round(sum(event_id % 50)::DOUBLE / sum(1 + event_id % 7)::DOUBLE, 3) AS items_per_second FROM events GROUP BY 1""")
def throughput_a15(t):
    runs = t.raw("events").select(F.col("event_type").alias("setting"), (F.col("event_id") % 50).alias("items"),
                                  (1 + F.col("event_id") % 7).alias("seconds"), (F.col("value") < 5).alias("failed"))
    return ms.throughput(runs, ["setting"])


@plan("word_agreement_a4", f"""
, hw AS (SELECT track_id, start_ms, word, count(*) AS h FROM (SELECT track_id, start_ms, unnest({tokens()}) AS word FROM heard) GROUP BY ALL),
pw AS (SELECT h.track_id, h.start_ms, unnest({tokens('c.text')}) AS word FROM heard h JOIN target c ON c.track_id=h.track_id AND c.start_ms < h.end_ms AND c.end_ms > h.start_ms),
ww AS (SELECT track_id, start_ms, word, count(*) AS w FROM pw GROUP BY ALL)
SELECT hw.track_id, hw.start_ms, CAST(sum(h) AS BIGINT) AS heard_words, CAST(sum(least(h, coalesce(w, 0))) AS BIGINT) AS shared_words,
 round(sum(least(h, coalesce(w, 0)))::DOUBLE / sum(h)::DOUBLE, 3) AS agreement FROM hw LEFT JOIN ww ON hw.track_id=ww.track_id AND hw.start_ms=ww.start_ms AND hw.word=ww.word GROUP BY 1, 2""")
def word_agreement_a4(t):
    return sc.word_agreement(ms.window_text(t.heard, t.target)).select("track_id", "start_ms", "heard_words", "shared_words", "agreement")


@plan("window_text_j5", """
SELECT h.track_id, h.start_ms, coalesce(string_agg(c.text, ' ' ORDER BY c.cue_id), '') AS cue_text FROM heard h
LEFT JOIN target c ON c.track_id=h.track_id AND c.start_ms < h.end_ms AND c.end_ms > h.start_ms GROUP BY 1, 2""")
def window_text_j5(t):
    return ms.window_text(t.heard, t.target).select("track_id", "start_ms", "cue_text")


@plan("word_disagreement_a5")
def word_disagreement_a5(t):
    """Word edits of the translated wording against the source cue; brute force in the tests (lines run to
    20,000 words, too long for a table in SQL)."""
    pairs = t.cues.select("track_id", "cue_id", F.col("text").alias("reference")).join(
        t.target.select("track_id", "cue_id", F.col("text").alias("hypothesis")), ["track_id", "cue_id"])
    return ms.word_disagreement(pairs, T)


def unit_words(t):
    return t.words.withColumnRenamed("cue_id", "unit_id")


@plan("word_span_a6", f""", {LINKS_SQL}
SELECT l.track_id, l.translation_id AS item_id, min(w.start_ms) AS span_start, max(w.end_ms) AS span_end FROM links l JOIN words w ON w.track_id=l.track_id AND w.cue_id=l.unit_id
WHERE w.start_ms IS NOT NULL AND w.end_ms IS NOT NULL GROUP BY 1, 2""")
def word_span_a6(t):
    links = lk.link_tracks(t.cues, t.target).select("track_id", F.col("translation_id").alias("item_id"), "unit_id")
    return ms.word_span(unit_words(t), links)


STATUS = """st AS (SELECT u.track_id, u.cue_id AS unit_id, count(w.cue_id) AS n_words, count(*) FILTER (w.cue_id IS NOT NULL AND (w.start_ms IS NULL OR w.end_ms IS NULL)) AS unaligned,
 CASE WHEN count(w.cue_id)=0 THEN 'failed' WHEN count(*) FILTER (w.start_ms IS NULL OR w.end_ms IS NULL) > 0 THEN 'partial'
 WHEN bool_or(w.end_ms-w.start_ms > 2000 OR w.start_ms < u.start_ms-700 OR w.end_ms > u.end_ms+700) THEN 'suspicious' ELSE 'aligned' END AS status
 FROM edited u LEFT JOIN words w ON w.track_id=u.track_id AND w.cue_id=u.cue_id GROUP BY 1, 2)"""


@plan("align_status_a8", f", {STATUS} SELECT * FROM st")
def align_status_a8(t):
    return ms.align_status(unit_words(t), t.edited.withColumnRenamed("cue_id", "unit_id"))


@plan("display_rows_a30", f""", {LINKS_SQL},
s AS (SELECT l.track_id, translation_id, min(c.start_ms) AS s, max(c.end_ms) AS e, count(*) AS n FROM links l JOIN cues c ON c.track_id=l.track_id AND c.cue_id=l.unit_id GROUP BY 1, 2)
SELECT t.track_id, t.cue_id AS translation_id, CASE WHEN contains(text,'q') THEN s ELSE start_ms END AS start_ms, CASE WHEN contains(text,'q') THEN e ELSE end_ms END AS end_ms, coalesce(n, 0) AS n_units,
 CASE WHEN n IS NULL THEN 'missing_link' WHEN contains(text,'ou') THEN 'provisional' ELSE 'ready' END AS state FROM target t LEFT JOIN s ON s.track_id=t.track_id AND s.translation_id=t.cue_id""")
def display_rows_a30(t):
    trans = t.target.select("track_id", F.col("cue_id").alias("translation_id"), (~has("text", "ou")).alias("confirmed"),
                            F.when(~has("text", "q"), F.col("start_ms")).alias("start_ms"), F.when(~has("text", "q"), F.col("end_ms")).alias("end_ms"))
    return ms.display_rows(units(t), trans, lk.link_tracks(t.cues, t.target))


@plan("usage_cost_a16", """SELECT role, count(*) AS calls, CAST(sum(length(text)) AS BIGINT) AS prompt_tokens, CAST(sum(length(text)//2) AS BIGINT) AS completion_tokens,
 CAST(sum(length(text))*30 + sum(length(text)//2)*120 AS BIGINT) AS cost_e8, CAST(sum(strlen(text)+1000)*30 + sum(500)*120 AS BIGINT) AS upper_cost_e8 FROM conversations GROUP BY 1""")
def usage_cost_a16(t):
    n = F.length("text").cast("bigint")
    usage = t.raw("conversations").select("role", n.alias("prompt_tokens"), idiv(n, 2).alias("completion_tokens"),
                                          F.octet_length("text").cast("bigint").alias("prompt_bytes"), F.lit(500).cast("bigint").alias("max_tokens"))
    cost = ms.usage_cost(usage, ["role"])
    e8 = lambda name: (F.col(name) * F.lit(100_000_000)).cast("bigint").alias(f"{name}_e8")
    return cost.select("role", "calls", "prompt_tokens", "completion_tokens", e8("cost"), e8("upper_cost"))


LIMITS = {"uploads": 10, "calls": 12, "upload_ms": 600_000, "call_ms": 700_000, "prompt_bytes": 20_000}


def limits(t):
    caps = [F.lit(value).cast("bigint").alias(f"max_{name}") for name, value in LIMITS.items()]
    free = (F.col("auth_id") % 7 == 0).alias("unlimited")
    return t.ledger.select("auth_id").distinct().select("auth_id", *caps, F.lit("0.03").cast("decimal(18,8)").alias("max_charge"), free)


@plan("ledger_status_a17", """
, l AS (SELECT auth_id, count(*) FILTER (kind='upload') AS uploads, count(*) FILTER (kind='call') AS calls, CAST(coalesce(sum(duration_ms) FILTER (kind='upload'), 0) AS BIGINT) AS upload_ms,
 CAST(coalesce(sum(duration_ms) FILTER (kind='call'), 0) AS BIGINT) AS call_ms, CAST(coalesce(sum(prompt_bytes) FILTER (kind='call'), 0) AS BIGINT) AS prompt_bytes,
 CAST(coalesce(sum(charge) FILTER (kind='call'), 0) * 100000000 AS BIGINT) AS charge_e8,
 count(*) FILTER (label='full-episode') AS full_uploads, count(*) FILTER (stage='full_episode_observation') AS full_calls, auth_id % 7 = 0 AS free FROM ledger GROUP BY 1)
SELECT * EXCLUDE (free), array_to_string(list_filter([CASE WHEN NOT free AND uploads>10 THEN 'uploads' END, CASE WHEN NOT free AND calls>12 THEN 'calls' END, CASE WHEN NOT free AND upload_ms>600000 THEN 'upload_ms' END, CASE WHEN NOT free AND call_ms>700000 THEN 'call_ms' END,
 CASE WHEN NOT free AND prompt_bytes>20000 THEN 'prompt_bytes' END, CASE WHEN NOT free AND charge_e8>3000000 THEN 'charge' END, CASE WHEN full_uploads>1 THEN 'full_uploads' END, CASE WHEN full_calls>1 THEN 'full_calls' END], lambda x: x IS NOT NULL), ',') AS over FROM l""".replace(" AS over FROM", ' AS "over" FROM'))
def ledger_status_a17(t):
    return lg.ledger_status(t.ledger, limits(t)).withColumn("charge_e8", (F.col("charge") * 100_000_000).cast("bigint")).drop("charge")


KINDS = ["click", "error", "purchase", "restart", "signup", "view"]


@plan("event_counts_a18", """
SELECT r.run_id, k.kind, count(e.event_id) AS n FROM (SELECT DISTINCT user_id AS run_id FROM events) r CROSS JOIN (VALUES ('click'),('error'),('purchase'),('restart'),('signup'),('view')) k(kind)
LEFT JOIN events e ON e.user_id=r.run_id AND e.event_type=k.kind GROUP BY 1, 2""")
def event_counts_a18(t):
    return ms.event_counts(t.raw("events").select(F.col("user_id").alias("run_id"), F.col("event_type").alias("kind")), KINDS)


@plan("five_minute_rows_a19", """SELECT track_id, start_ms//300000+1 AS window_id, start_ms//300000*300000 AS window_start, (start_ms//300000+1)*300000 AS window_end, cue_id FROM cues""")
def five_minute_rows_a19(t):
    return ms.windows_of(t.cues)


@plan("plan_check_a28", f""", {CLIPS.format(core=60000, ov=5000)},
p AS (SELECT track_id, count(*) AS calls, CAST(sum(audio_end_ms-offset_ms) AS BIGINT) AS audio_ms, count(*) FILTER (offset_ms < 0 OR audio_end_ms > duration_ms OR offset_ms >= audio_end_ms) AS bad_intervals, count(*)-count(DISTINCT clip_no) AS duplicate_ids FROM clips JOIN media USING (track_id) GROUP BY 1)
SELECT *, bad_intervals=0 AND duplicate_ids=0 AND calls <= 6 AND audio_ms <= 400000 AS approved FROM p""")
def plan_check_a28(t):
    rows = short_clips(t).join(t.media, "track_id").select("track_id", F.col("clip_no").alias("clip_id"), F.col("offset_ms").alias("start_ms"), F.col("audio_end_ms").alias("end_ms"), "duration_ms")
    caps = t.media.select("track_id", F.lit(6).alias("max_calls"), F.lit(400_000).alias("max_audio_ms"))
    return ms.plan_check(rows, caps, T)


def answers(t):
    """Translated rows as a model might return them: some twice, some blank, some renumbered."""
    blank = t.target.select("track_id", "cue_id", F.when(F.length("text") < 20, " ").otherwise(F.col("text")).alias("text"))
    again = t.target.where(has("text", "q")).select("track_id", "cue_id", "text")
    odd = t.target.where(has("text", "w")).select("track_id", (F.col("cue_id") + 100_000).alias("cue_id"), "text")
    return blank.unionByName(again).unionByName(odd)


@plan("exactly_once_a21", """
, g AS (SELECT track_id, cue_id, CASE WHEN length(text) < 20 THEN ' ' ELSE text END AS text FROM target UNION ALL SELECT track_id, cue_id, text FROM target WHERE contains(text,'q')
 UNION ALL SELECT track_id, cue_id+100000, text FROM target WHERE contains(text,'w')),
s AS (SELECT track_id, cue_id, count(*) AS n, bool_or(trim(text)='') AS blank FROM g GROUP BY 1, 2)
SELECT coalesce(c.track_id, s.track_id) AS track_id, coalesce(c.cue_id, s.cue_id) AS cue_id,
 CASE WHEN n IS NULL THEN 'missing' WHEN c.cue_id IS NULL THEN 'extra' WHEN n > 1 THEN 'duplicate' ELSE 'blank' END AS problem
FROM cues c FULL JOIN s ON c.track_id=s.track_id AND c.cue_id=s.cue_id WHERE n IS NULL OR c.cue_id IS NULL OR n > 1 OR blank""")
def exactly_once_a21(t):
    return ms.exactly_once(t.cues, answers(t), ["track_id", "cue_id"])


@plan("fill_assessments_a22", """
, g AS (SELECT track_id, cue_id, CASE WHEN contains(text,'w') THEN 'bad' WHEN contains(text,'q') THEN 'uncertain' ELSE 'correct' END AS v,
 CASE WHEN NOT contains(text,'z') THEN 'heard so' END AS x, CASE WHEN NOT contains(text,'p') THEN true END AS a FROM edited),
j AS (SELECT c.track_id, c.cue_id AS source_id, c.text, g.cue_id IS NOT NULL AS got, v, x, a, CASE WHEN g.cue_id IS NULL OR v='bad' THEN 'uncertain' ELSE v END AS w FROM cues c LEFT JOIN g ON g.track_id=c.track_id AND g.cue_id=c.cue_id)
SELECT track_id, source_id, w AS verdict, CASE WHEN w<>'correct' THEN coalesce(x, text) ELSE x END AS source_expression, a AS audio_needed,
 CASE WHEN NOT got THEN 'Model omitted assessment' WHEN w<>'correct' AND a IS NULL THEN 'Model omitted audio need' WHEN v='bad' THEN 'Model omitted a valid verdict' END AS schema_uncertainty FROM j""")
def fill_assessments_a22(t):
    got = t.edited.select(
        "track_id", F.col("cue_id").alias("source_id"),
        F.when(has("text", "w"), "bad").when(has("text", "q"), "uncertain").otherwise("correct").alias("verdict"),
        F.when(~has("text", "z"), "heard so").alias("source_expression"), F.when(~has("text", "p"), F.lit(True)).alias("audio_needed"))
    return ms.fill_assessments(t.cues.select("track_id", F.col("cue_id").alias("source_id"), "text"), got)


ASSESSED = """asd AS (SELECT track_id, cue_id AS source_id, CASE WHEN contains(text,'q') THEN 'material_error' WHEN contains(text,'w') THEN 'uncertain' ELSE 'correct' END AS verdict, contains(text,'z') AS settled FROM edited)"""


def assessed(t):
    verdict = F.when(has("text", "q"), "material_error").when(has("text", "w"), "uncertain").otherwise("correct")
    return t.edited.select("track_id", F.col("cue_id").alias("source_id"), verdict.alias("verdict"), has("text", "z").alias("settled"))


@plan("verdict_tally_a20", f""", {ASSESSED}
SELECT c.track_id, count(*) AS units, count(*) FILTER (verdict IS NULL) AS pending, count(*) FILTER (verdict='material_error' AND NOT settled) AS material, count(*) FILTER (verdict='uncertain' AND NOT settled) AS uncertain
FROM cues c LEFT JOIN asd a ON a.track_id=c.track_id AND a.source_id=c.cue_id GROUP BY 1""")
def verdict_tally_a20(t):
    return ms.verdict_tally(units(t), assessed(t))


OBSERVED = """o AS (SELECT track_id, 'a' AS model, 'a' || cue_id AS receipt, start_ms-1000 AS start_ms, end_ms+1000 AS end_ms FROM edited UNION ALL SELECT track_id, 'b', 'b' || cue_id, start_ms-1500, end_ms+1500 FROM speech)"""


@plan("corroborated_a23", f""", {OBSERVED}, {MERGE.format(out="om", by="track_id, model", src="SELECT track_id, model, start_ms, end_ms FROM o")},
h AS (SELECT DISTINCT c.track_id, c.cue_id, m.model, c.start_ms, c.end_ms FROM cues c JOIN om m ON m.track_id=c.track_id AND m.start_ms <= c.start_ms AND m.end_ms >= c.end_ms),
n AS (SELECT h.track_id, h.cue_id, count(DISTINCT h.model) AS models, count(DISTINCT receipt) AS receipts FROM h JOIN o ON o.track_id=h.track_id AND o.model=h.model AND o.start_ms < h.end_ms AND o.end_ms > h.start_ms GROUP BY 1, 2)
SELECT c.track_id, c.cue_id, coalesce(models, 0) AS models, coalesce(receipts, 0) AS receipts, coalesce(models, 0) >= 2 AND coalesce(receipts, 0) >= 2 AS ok FROM cues c LEFT JOIN n ON n.track_id=c.track_id AND n.cue_id=c.cue_id""")
def corroborated_a23(t):
    one = t.edited.select("track_id", F.lit("a").alias("model"), F.concat(F.lit("a"), "cue_id").alias("receipt"), (F.col("start_ms") - 1000).alias("start_ms"), (F.col("end_ms") + 1000).alias("end_ms"))
    two = t.speech.select("track_id", F.lit("b").alias("model"), F.concat(F.lit("b"), "cue_id").alias("receipt"), (F.col("start_ms") - 1500).alias("start_ms"), (F.col("end_ms") + 1500).alias("end_ms"))
    return ms.corroborated(one.unionByName(two), t.cues, T, ["cue_id"])


MODEL_COVER = MERGE.format(out="mc", by="track_id, model", src="""SELECT track_id, 'whisper' AS model, start_ms, end_ms FROM heard WHERE trim(text) <> ''
 UNION ALL SELECT track_id, 'voice', start_ms, end_ms FROM speech""")


@plan("covering_j28", f""", {MODEL_COVER}
SELECT c.track_id, c.cue_id, mc.model, bool_or(mc.start_ms <= c.start_ms AND mc.end_ms >= c.end_ms) AS covered FROM cues c JOIN mc ON mc.track_id=c.track_id
 AND mc.start_ms < c.end_ms AND mc.end_ms > c.start_ms GROUP BY 1, 2, 3""")
def covering_j28(t):
    items = t.heard.select("track_id", F.lit("whisper").alias("model"), "start_ms", "end_ms", "text").unionByName(
        t.speech.select("track_id", F.lit("voice").alias("model"), "start_ms", "end_ms", F.lit("x").alias("text")))
    return ms.covering(items, t.cues, T, ["cue_id"])


REVIEWS = """rv AS (SELECT track_id, 'independent' AS stage, 'm' || cue_id % 2 AS model, start_ms, end_ms FROM speech UNION ALL SELECT track_id, 'comparison', 'c' || cue_id % 3, start_ms-500, end_ms+500 FROM edited)"""


@plan("combine_reviews_a29", f""", {REVIEWS}, {MERGE.format(out='rc', by='track_id, stage', src='SELECT track_id, stage, start_ms, end_ms FROM rv')},
ls AS (SELECT c.track_id, a.stage, c.cue_id, string_agg(DISTINCT a.model, ', ' ORDER BY a.model) AS models, count(*) AS reviews FROM cues c JOIN rv a ON a.track_id=c.track_id AND a.start_ms < c.end_ms AND a.end_ms > c.start_ms GROUP BY 1, 2, 3),
cv AS (SELECT c.track_id, rc.stage, c.cue_id, bool_or(rc.start_ms <= c.start_ms AND rc.end_ms >= c.end_ms) AS covered FROM cues c
 JOIN rc ON rc.track_id=c.track_id AND rc.start_ms < c.end_ms AND rc.end_ms > c.start_ms GROUP BY 1, 2, 3)
SELECT ls.track_id, ls.stage, ls.cue_id, models, reviews, covered FROM ls JOIN cv ON cv.track_id=ls.track_id AND cv.stage=ls.stage AND cv.cue_id=ls.cue_id""")
def combine_reviews_a29(t):
    rows = t.speech.select("track_id", F.lit("independent").alias("stage"), F.concat(F.lit("m"), F.col("cue_id") % 2).alias("model"), "start_ms", "end_ms").unionByName(
        t.edited.select("track_id", F.lit("comparison").alias("stage"), F.concat(F.lit("c"), F.col("cue_id") % 3).alias("model"), (F.col("start_ms") - 500).alias("start_ms"), (F.col("end_ms") + 500).alias("end_ms")))
    return ms.combine_reviews(rows, t.cues, T, ["cue_id"])


@plan("mapped_events_s15", """
, ev AS (SELECT vec_id AS clip_id, k AS event_id, CASE label % 2 WHEN 0 THEN 'speech' ELSE 'music' END AS label, 0.05+0.1*k AS first_s, 0.2+0.1*k AS last_s FROM embeddings, range(3) r(k)),
fr AS (SELECT vec_id AS clip_id, CASE label % 2 WHEN 0 THEN 'speech' ELSE 'music' END AS label, unnest(embedding) AS p, generate_subscripts(embedding, 1) - 1 AS frame_no FROM embeddings)
SELECT ev.clip_id // 10 AS track_id, ev.clip_id, event_id, ev.label, clip_id*1000 + CAST(round_even(first_s*1000, 0) AS BIGINT) AS start_ms, least(clip_id*1000+400, clip_id*1000 + CAST(round_even(last_s*1000, 0) AS BIGINT)) AS end_ms,
 round((SELECT avg(abs(p)::DOUBLE) FROM fr WHERE fr.clip_id=ev.clip_id AND fr.label=ev.label AND frame_no >= round_even(first_s*100, 0) AND frame_no < round_even(last_s*100, 0)), 5) AS confidence
FROM ev WHERE clip_id*1000 + CAST(round_even(first_s*1000, 0) AS BIGINT) < least(clip_id*1000+400, clip_id*1000 + CAST(round_even(last_s*1000, 0) AS BIGINT))""")
def mapped_events_s15(t):
    base = t.raw("embeddings").select(F.col("vec_id").alias("clip_id"), F.when(F.col("label") % 2 == 0, "speech").otherwise("music").alias("label"), "embedding")
    k = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(2).cast("bigint"))).alias("event_id")
    events = base.select("clip_id", "label", k).withColumn("first_s", 0.05 + 0.1 * F.col("event_id")).withColumn("last_s", 0.2 + 0.1 * F.col("event_id"))
    frames = base.select("clip_id", "label", F.posexplode("embedding").alias("frame_no", "_p")).select("clip_id", "label", F.col("frame_no").cast("bigint").alias("frame_no"), F.abs("_p").cast("double").alias("p"))
    clips = base.select("clip_id", idiv(F.col("clip_id"), 10).alias("track_id"), (F.col("clip_id") * 1000).alias("start_ms"), (F.col("clip_id") * 1000 + 400).alias("end_ms"))
    return ms.mapped_events(events, frames, clips).withColumn("confidence", F.round("confidence", 5))


@plan("issue_counts_a1", f""", {GAPS}, i AS (SELECT 'subtitle_gap' AS kind, 'source' AS lang FROM gaps UNION ALL SELECT 'long_cue', 'source' FROM cues WHERE end_ms-start_ms > 8000 UNION ALL SELECT 'long_cue', 'target' FROM target WHERE end_ms-start_ms > 8000)
SELECT kind, lang, count(*) AS n FROM i GROUP BY ROLLUP (kind, lang)""")
def issue_counts_a1(t):
    tag = lambda df, kind, lang: df.select(F.lit(kind).alias("kind"), F.lit(lang).alias("lang"))
    rows = tag(iv.gaps(t.cues, t.media), "subtitle_gap", "source").unionByName(
        tag(ms.long_cues(t.cues), "long_cue", "source")).unionByName(tag(ms.long_cues(t.target), "long_cue", "target"))
    return ms.issue_counts(rows, ["kind", "lang"], rollup=True)
