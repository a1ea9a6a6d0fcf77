"""Two-track queries: reference match, links, stable ids, rebase, clock offset, edits."""

from pyspark.sql import functions as F

from cuelake.functions import midpoint
from cuelake.operators import intervals as iv
from cuelake.operators import linking as lk
from cuelake.operators import sequences as sq
from cuelake.plans.interval_plans import GAPS, STRICT
from cuelake.plans.registry import plan
from cuelake.plans.views import norm

T = ["track_id"]


def clock(t):
    return t.media.select("track_id", F.lit(5000).cast("bigint").alias("offset_ms"))


SHIFTED = """sh AS (SELECT r.track_id, r.cue_id AS ref_id, r.start_ms-5000 AS start_ms, r.end_ms-5000 AS end_ms, r.text
 FROM ref r JOIN media m USING (track_id) WHERE r.end_ms-5000 > 0 AND r.start_ms-5000 < m.duration_ms
 AND NOT regexp_full_match(r.text, '\\s*(\\[[^\\]]+\\]\\s*)+'))"""
NEAR = "a.start_ms < b.end_ms + 500 AND a.end_ms > b.start_ms - 500"


def sparse(t):
    """A draft that lost its longer lines."""
    return t.cues.where(F.length("text") < 200)


@plan("reference_only_j6", f""", {SHIFTED}
SELECT track_id, ref_id, greatest(start_ms, 0) AS start_ms, end_ms FROM sh a
WHERE NOT EXISTS (SELECT 1 FROM cues b WHERE b.track_id=a.track_id AND length(b.text) < 200 AND {NEAR})""")
def reference_only_j6(t):
    return lk.reference_only(sparse(t), lk.shifted_reference(t.ref, clock(t), t.media))


@plan("reference_pairs_j6", f""", {SHIFTED}
SELECT a.track_id, a.ref_id, b.cue_id FROM sh a JOIN cues b ON b.track_id=a.track_id AND {NEAR}""")
def reference_pairs_j6(t):
    return lk.reference_pairs(t.cues, lk.shifted_reference(t.ref, clock(t), t.media)).select("track_id", "ref_id", "cue_id")


LINKS = f"""
l_o AS (SELECT a.track_id, a.cue_id AS translation_id, b.cue_id AS unit_id FROM target a JOIN cues b ON a.track_id=b.track_id AND {STRICT}
 AND least(a.end_ms,b.end_ms)-greatest(a.start_ms,b.start_ms) >= 100),
links AS (SELECT *, 'overlap' AS how FROM l_o UNION ALL
 SELECT a.track_id, a.cue_id, b.cue_id, 'same_cue' FROM target a JOIN cues b USING (track_id, cue_id, start_ms, end_ms)
 WHERE NOT EXISTS (SELECT 1 FROM l_o WHERE l_o.track_id=a.track_id AND l_o.translation_id=a.cue_id))"""


@plan("provisional_links_j7", f", {LINKS} SELECT * FROM links".replace("b.cue_id, 'same_cue' FROM target a JOIN cues b USING (track_id, cue_id, start_ms, end_ms)",
      "b.cue_id, 'same_cue' FROM target a JOIN cues b ON a.track_id=b.track_id AND a.cue_id=b.cue_id AND a.start_ms=b.start_ms AND a.end_ms=b.end_ms"))
def provisional_links_j7(t):
    return lk.link_tracks(t.cues, t.target)


@plan("carry_ids_j8", """
, s1 AS (SELECT a.track_id, a.cue_id AS new_id, b.cue_id AS old_id FROM renumbered a JOIN cues b ON a.track_id=b.track_id AND a.cue_id=b.cue_id AND a.text=b.text AND abs(a.start_ms-b.start_ms) <= 10000),
a2 AS (SELECT * FROM renumbered r WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.track_id=r.track_id AND s1.new_id=r.cue_id)),
b2 AS (SELECT * FROM cues r WHERE NOT EXISTS (SELECT 1 FROM s1 WHERE s1.track_id=r.track_id AND s1.old_id=r.cue_id)),
c2 AS (SELECT a.track_id, a.cue_id AS new_id, b.cue_id AS old_id, count(*) OVER (PARTITION BY a.track_id, a.cue_id) AS n, count(*) OVER (PARTITION BY a.track_id, b.cue_id) AS o
 FROM a2 a JOIN b2 b ON a.track_id=b.track_id AND a.text=b.text AND abs(a.start_ms-b.start_ms) <= 1000),
s2 AS (SELECT track_id, new_id, old_id FROM c2 WHERE n=1 AND o=1),
a3 AS (SELECT * FROM a2 r WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s2.track_id=r.track_id AND s2.new_id=r.cue_id)),
b3 AS (SELECT * FROM b2 r WHERE NOT EXISTS (SELECT 1 FROM s2 WHERE s2.track_id=r.track_id AND s2.old_id=r.cue_id)),
c3 AS (SELECT a.track_id, a.cue_id AS new_id, b.cue_id AS old_id, count(*) OVER (PARTITION BY a.track_id, a.cue_id) AS n, count(*) OVER (PARTITION BY a.track_id, b.cue_id) AS o
 FROM a3 a JOIN b3 b ON a.track_id=b.track_id AND abs(a.start_ms-b.start_ms) <= 200 AND abs(a.end_ms-b.end_ms) <= 200)
SELECT *, 'same_cue' AS stage FROM s1 UNION ALL SELECT *, 'exact_text' FROM s2 UNION ALL SELECT track_id, new_id, old_id, 'edges' FROM c3 WHERE n=1 AND o=1""")
def carry_ids_j8(t):
    return lk.carry_ids(t.cues, t.renumbered)


REBASE = """
x1 AS (SELECT track_id, start_ms, end_ms, text, min(cue_id) AS old_id FROM cues GROUP BY ALL HAVING count(*)=1),
x2 AS (SELECT track_id, start_ms, end_ms, text, min(cue_id) AS new_id FROM renumbered GROUP BY ALL),
ex AS (SELECT track_id, new_id, old_id FROM x2 JOIN x1 USING (track_id, start_ms, end_ms, text)),
t1 AS (SELECT track_id, text, min(cue_id) AS new_id, min(start_ms) AS s, min(end_ms) AS e FROM renumbered r WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.track_id=r.track_id AND ex.new_id=r.cue_id) GROUP BY ALL HAVING count(*)=1),
t2 AS (SELECT track_id, text, min(cue_id) AS old_id, min(start_ms) AS s, min(end_ms) AS e FROM cues r WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.track_id=r.track_id AND ex.old_id=r.cue_id) GROUP BY ALL HAVING count(*)=1),
mt AS (SELECT * FROM ex UNION ALL SELECT t1.track_id, new_id, old_id FROM t1 JOIN t2 ON t1.track_id=t2.track_id AND t1.text=t2.text AND abs(t1.s-t2.s)<=2000 AND abs(t1.e-t2.e)<=2000),
af AS (SELECT track_id, cue_id FROM renumbered r WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.track_id=r.track_id AND mt.new_id=r.cue_id)
 UNION ALL SELECT o.track_id, coalesce((SELECT min(n.cue_id) FROM renumbered n WHERE n.track_id=o.track_id AND n.start_ms >= o.start_ms), (SELECT max(n.cue_id) FROM renumbered n WHERE n.track_id=o.track_id))
 FROM cues o WHERE NOT EXISTS (SELECT 1 FROM mt WHERE mt.track_id=o.track_id AND mt.old_id=o.cue_id))"""


@plan("rebase_j10", f""", {REBASE}
SELECT * FROM mt WHERE NOT EXISTS (SELECT 1 FROM af WHERE af.track_id=mt.track_id AND abs(af.cue_id-mt.new_id) <= 2)""")
def rebase_j10(t):
    return lk.rebase(t.cues, t.renumbered).select("track_id", "new_id", "old_id")


ANCHORS = f"""
ua AS (SELECT track_id, norm, min(cue_id) AS cue_id, min(start_ms) AS start_ms FROM (SELECT *, {norm()} AS norm FROM cues) WHERE length(norm) >= 20 GROUP BY ALL HAVING count(*)=1),
ub AS (SELECT track_id, norm, min(cue_id) AS ref_id, min(start_ms) AS ref_start FROM (SELECT *, {norm()} AS norm FROM ref) WHERE length(norm) >= 20 GROUP BY ALL HAVING count(*)=1),
anchors AS (SELECT ua.track_id, cue_id, ref_id, start_ms, ref_start-start_ms AS delta_ms FROM ua JOIN ub ON ua.track_id=ub.track_id AND ua.norm=ub.norm WHERE abs(ref_start-start_ms) <= 60000),
tot AS (SELECT track_id, count(*) AS matched FROM anchors GROUP BY 1),
bk AS (SELECT track_id, CAST(round_even(delta_ms/1000.0, 0) AS BIGINT) AS b, count(*) AS n FROM anchors GROUP BY ALL),
best AS (SELECT track_id, b FROM (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY n DESC, abs(b), b) AS rn FROM bk) WHERE rn=1),
agree AS (SELECT a.* FROM anchors a JOIN best ON a.track_id=best.track_id JOIN tot ON a.track_id=tot.track_id WHERE matched >= 8 AND abs(delta_ms-b*1000) <= 1500),
off AS (SELECT t.track_id, CAST(round_even(median(delta_ms), 0) AS BIGINT) AS offset_ms, any_value(matched) AS matched, count(a.cue_id) AS agreeing FROM tot t LEFT JOIN agree a ON t.track_id=a.track_id GROUP BY ALL)"""


def anchors(t):
    return lk.text_anchors(t.cues, t.ref)


@plan("text_anchors_j9", f", {ANCHORS} SELECT * FROM anchors")
def text_anchors_j9(t):
    return anchors(t)


@plan("clock_offset_a2", f", {ANCHORS} SELECT * FROM off")
def clock_offset_a2(t):
    return lk.estimate_offset(anchors(t))


PARTS = f"""{ANCHORS}, parts AS (SELECT track_id, start_ms//60000 AS part, count(*) AS matches, CAST(round_even(median(delta_ms),0) AS BIGINT) AS median_offset_ms FROM agree GROUP BY ALL)"""


@plan("anchor_spread_a2", f", {PARTS} SELECT * FROM parts")
def anchor_spread_a2(t):
    return lk.anchor_spread(anchors(t), 60_000)


CHECKS = f"""{PARTS}, sp AS (SELECT track_id, count(DISTINCT least(2, part*60000*3//duration_ms)) AS thirds, max(median_offset_ms)-min(median_offset_ms) AS spread_ms FROM parts JOIN media USING (track_id) GROUP BY 1),
chk AS (SELECT off.*, coalesce(thirds,0) AS thirds, spread_ms, agreeing >= 20 AND coalesce(thirds,0)=3 AND coalesce(spread_ms <= 1000, false) AND offset_ms IS NOT NULL AS accepted FROM off LEFT JOIN sp USING (track_id))"""


@plan("offset_checks_a3", f", {CHECKS} SELECT * FROM chk")
def offset_checks_a3(t):
    return lk.offset_checks(anchors(t), t.media, 60_000)


@plan("propose_retime_a3", f""", {CHECKS}
SELECT r.track_id, r.cue_id, r.start_ms-offset_ms AS start_ms, r.end_ms-offset_ms AS end_ms FROM ref r JOIN chk USING (track_id) JOIN media USING (track_id)
WHERE accepted AND r.start_ms-offset_ms >= 0 AND r.end_ms-offset_ms <= duration_ms""")
def propose_retime_a3(t):
    return lk.propose_retime(t.ref, lk.offset_checks(anchors(t), t.media, 60_000), t.media).drop("text")


@plan("explode_links_j13", """
SELECT t.track_id, t.cue_id AS translation_id, u AS unit_id, c.start_ms, c.end_ms FROM (SELECT *, unnest(range((cue_id-1)*3+1, cue_id*3+1)) AS u FROM target_long) t
LEFT JOIN cues c ON c.track_id=t.track_id AND c.cue_id=t.u""")
def explode_links_j13(t):
    ids = F.sequence((F.col("cue_id") - 1) * 3 + 1, F.col("cue_id") * 3)
    trans = t.target_long.select("track_id", F.col("cue_id").alias("translation_id"), ids.alias("source_ids"))
    units = t.cues.select("track_id", F.col("cue_id").alias("unit_id"), "start_ms", "end_ms")
    return lk.explode_links(trans, units).select("track_id", "translation_id", "unit_id", "start_ms", "end_ms")


def translated(t):
    return t.target.select("track_id", F.col("cue_id").alias("translation_id"), "text",
                           (~F.contains("text", F.lit("ou"))).alias("confirmed"))


def units(t):
    return t.cues.select("track_id", F.col("cue_id").alias("unit_id"), "start_ms", "end_ms", "text")


LINKS_SQL = LINKS.replace("b.cue_id, 'same_cue' FROM target a JOIN cues b USING (track_id, cue_id, start_ms, end_ms)",
                          "b.cue_id, 'same_cue' FROM target a JOIN cues b ON a.track_id=b.track_id AND a.cue_id=b.cue_id AND a.start_ms=b.start_ms AND a.end_ms=b.end_ms")


@plan("second_view_j14", f""", {LINKS_SQL}
SELECT c.track_id, c.cue_id AS unit_id, coalesce(string_agg(t.text, ' / ' ORDER BY t.cue_id), '') AS translation, count(t.cue_id) AS n_translations,
 CASE WHEN bool_and(NOT contains(t.text, 'ou')) THEN 'confirmed' ELSE 'provisional' END AS link_status
FROM cues c LEFT JOIN links l ON l.track_id=c.track_id AND l.unit_id=c.cue_id LEFT JOIN target t ON t.track_id=l.track_id AND t.cue_id=l.translation_id GROUP BY c.track_id, c.cue_id""")
def second_view_j14(t):
    return lk.second_view(units(t), translated(t), lk.link_tracks(t.cues, t.target))


@plan("link_gaps_a7", f""", {LINKS_SQL}
SELECT track_id, 'missing_english_link' AS kind, cue_id AS id FROM cues c WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.track_id=c.track_id AND l.unit_id=c.cue_id)
UNION ALL SELECT track_id, 'unlinked_english', cue_id FROM target c WHERE NOT EXISTS (SELECT 1 FROM links l WHERE l.track_id=c.track_id AND l.translation_id=c.cue_id)""")
def link_gaps_a7(t):
    return lk.link_gaps(units(t), translated(t), lk.link_tracks(t.cues, t.target))


@plan("timeline_parity_j15", """
SELECT coalesce(a.track_id, b.track_id) AS track_id, coalesce(a.cue_id, b.cue_id) AS cue_id, a.start_ms AS a_start, a.end_ms AS a_end, b.start_ms AS b_start, b.end_ms AS b_end,
 CASE WHEN b.start_ms IS NULL THEN 'missing' WHEN a.start_ms IS NULL THEN 'extra' ELSE 'timing' END AS problem
FROM cues a FULL JOIN edited b ON a.track_id=b.track_id AND a.cue_id=b.cue_id
WHERE a.start_ms IS NULL OR b.start_ms IS NULL OR a.start_ms<>b.start_ms OR a.end_ms<>b.end_ms""")
def timeline_parity_j15(t):
    return lk.parity(t.cues, t.edited)


@plan("timeline_j16", f""", {GAPS},
s AS (SELECT 'ref' AS source, track_id, cue_id AS id, start_ms, end_ms, length(text) AS n FROM ref UNION ALL
 SELECT 'speech', track_id, cue_id, start_ms, end_ms, 0 FROM speech UNION ALL SELECT 'heard', track_id, start_ms, start_ms, end_ms, length(text) FROM heard)
SELECT g.track_id, g.start_ms AS span_id, s.source, s.id, s.start_ms, s.end_ms, s.n FROM gaps g JOIN s ON g.track_id=s.track_id AND g.start_ms < s.end_ms AND g.end_ms > s.start_ms""")
def timeline_j16(t):
    spans = iv.gaps(t.cues, t.media).select("track_id", F.col("start_ms").alias("span_id"), "start_ms", "end_ms")
    named = lambda df, ident: df.withColumn("id", F.col(ident))
    rows = lk.timeline(spans, {
        "ref": named(t.ref, "cue_id"), "speech": named(t.speech.withColumn("text", F.lit("")), "cue_id"),
        "heard": named(t.heard, "start_ms")})
    return rows.withColumn("n", F.length("text").cast("bigint")).drop("text")


@plan("speech_in_gaps_j20", """
SELECT track_id, cue_id*100000+pos AS obs_id, 'possible_speech_gap' AS kind, start_ms+3000 AS start_ms, end_ms+3000 AS end_ms FROM words w
WHERE start_ms IS NOT NULL AND NOT EXISTS (SELECT 1 FROM cues c WHERE c.track_id=w.track_id AND c.start_ms < w.end_ms+3000 AND c.end_ms > w.start_ms+3000)""")
def speech_in_gaps_j20(t):
    return lk.speech_in_gaps(gap_rows(t), t.cues)


def gap_rows(t):
    return t.words.where(F.col("start_ms").isNotNull()).select(
        "track_id", (F.col("cue_id") * 100_000 + F.col("pos")).alias("obs_id"), F.lit("asr").alias("kind"),
        (F.col("start_ms") + 3000).alias("start_ms"), (F.col("end_ms") + 3000).alias("end_ms"))


@plan("unsupported_edits_j21", """
, acc AS (SELECT track_id, cue_id, text, start_ms + CASE WHEN contains(text,'q') THEN 7 ELSE 0 END AS start_ms, end_ms FROM words WHERE start_ms IS NOT NULL AND length(text) > 6),
cur AS (SELECT track_id, cue_id, text, start_ms, end_ms FROM words)
SELECT track_id, cue_id, 'no_accepted_word' AS error FROM edited e WHERE NOT EXISTS (SELECT 1 FROM acc w WHERE w.track_id=e.track_id AND w.start_ms < e.end_ms AND w.end_ms > e.start_ms)
UNION ALL SELECT track_id, cue_id, 'word_not_current' FROM (SELECT DISTINCT * FROM acc) a WHERE NOT EXISTS (SELECT 1 FROM cur w WHERE w.track_id=a.track_id AND w.cue_id=a.cue_id AND w.text=a.text AND w.start_ms=a.start_ms AND w.end_ms=a.end_ms)""")
def unsupported_edits_j21(t):
    moved = F.when(F.contains("text", F.lit("q")), 7).otherwise(0)
    accepted = t.words.where(F.col("start_ms").isNotNull() & (F.length("text") > 6)).withColumn("start_ms", F.col("start_ms") + moved)
    return lk.unsupported_edits(t.edited, accepted, t.words)


@plan("pending_downloads_j22", """
, sv AS (SELECT d.doc_id, doc_id//2 AS episode, lang FROM documents d SEMI JOIN labels USING (doc_id))
SELECT doc_id AS file_id, doc_id//2 AS episode, lang, EXISTS (SELECT 1 FROM sv WHERE sv.episode=d.doc_id//2 AND sv.lang<>d.lang AND sv.lang IN ('en','fr')) AS completes_pair
FROM documents d WHERE lang IN ('en','fr') AND doc_id NOT IN (SELECT doc_id FROM sv)""")
def pending_downloads_j22(t):
    docs = t.raw("documents").select(F.col("doc_id").alias("file_id"), F.call_function("div", F.col("doc_id"), F.lit(2)).alias("episode"), "lang")
    saved = docs.join(t.raw("labels").select(F.col("doc_id").alias("file_id")), "file_id", "left_semi")
    return lk.pending_downloads(docs.withColumn("status", F.lit("not_downloaded")), saved.withColumn("status", F.lit("saved")), ["en", "fr"])


@plan("upsert_listings_x8", """
, r AS (SELECT doc_id, arg_max({'s': CASE WHEN k=0 AND quality=1 THEN 'saved' ELSE 'failed' END, 'e': 'status ' || k || toxic}, k) AS r, bool_or(k=0 AND quality=1) AS s FROM labels, range(2) n(k) GROUP BY 1)
SELECT d.doc_id AS file_id, CASE WHEN r.s THEN 'saved' ELSE 'not_downloaded' END AS status, CASE WHEN r.s THEN 'files/' || d.doc_id ELSE '' END AS path,
 CASE WHEN r.r.s='failed' THEN r.r.e ELSE '' END AS last_error FROM documents d LEFT JOIN r ON r.doc_id=d.doc_id""")
def upsert_listings_x8(t):
    listings = t.raw("documents").select(F.col("doc_id").alias("file_id"), F.lit("not_downloaded").alias("status"), F.lit("").alias("path"), F.lit("").alias("last_error"))
    # Two attempts a file; the second fails, also behind a save.
    tries = t.raw("labels").withColumn("seq", F.explode(F.array(F.lit(0), F.lit(1))))
    results = tries.select(
        F.col("doc_id").alias("file_id"), "seq", F.when((F.col("quality") == 1) & (F.col("seq") == 0), "saved").otherwise("failed").alias("status"),
        F.concat(F.lit("files/"), F.col("doc_id")).alias("path"), F.concat(F.lit("status "), F.col("seq"), F.col("toxic")).alias("error"))
    return lk.upsert_listings(listings, results)


@plan("restore_ends_j23", """
, k AS (SELECT track_id, start_ms, trim(text) AS x, max(end_ms) AS prior_end FROM cues GROUP BY ALL HAVING count(*)=1)
SELECT e.track_id, e.cue_id, e.start_ms, greatest(least(e.end_ms, e.start_ms+8000), coalesce(prior_end, 0)) AS end_ms,
 coalesce(prior_end > least(e.end_ms, e.start_ms+8000), false) AS extended
FROM edited e LEFT JOIN k ON k.track_id=e.track_id AND k.start_ms=e.start_ms AND k.x=trim(e.text)""")
def restore_ends_j23(t):
    capped = lambda df: df.withColumn("end_ms", F.least(F.col("end_ms"), F.col("start_ms") + 8000))
    return lk.restore_ends(capped(t.cues), t.cues, capped(t.edited)).drop("text")


def edits(t):
    cut = F.contains("text", F.lit("q"))
    add = F.contains("text", F.lit("w")) & ~cut
    rows = t.cues.where(cut | add).withColumn("_cut", cut)
    named = rows.select("track_id", F.col("cue_id").alias("edit_id"), F.when(F.col("_cut"), F.col("cue_id")).alias("first_id"),
                        F.when(F.col("_cut"), F.col("cue_id")).alias("last_id"), F.when(~F.col("_cut"), F.col("cue_id")).alias("insert_after"))
    mid = midpoint("start_ms", "end_ms")
    halves = F.array(F.struct(F.lit(0).alias("pos"), F.col("start_ms").alias("s"), mid.alias("e")),
                     F.struct(F.lit(1).alias("pos"), mid.alias("s"), F.col("end_ms").alias("e")))
    extra = F.array(F.struct(F.lit(0).alias("pos"), F.col("end_ms").alias("s"), (F.col("end_ms") + 200).alias("e")))
    fresh = rows.select("track_id", F.col("cue_id").alias("edit_id"), "text", F.explode(F.when(F.col("_cut"), halves).otherwise(extra)).alias("_r"))
    return named, fresh.select("track_id", "edit_id", "_r.pos", F.col("_r.s").alias("start_ms"), F.col("_r.e").alias("end_ms"), "text")


@plan("splice_j24", """
, e AS (SELECT *, contains(text,'q') AS cut, contains(text,'w') AND NOT contains(text,'q') AS added FROM cues),
r AS (SELECT track_id, cue_id, 0 AS p, start_ms, end_ms, text FROM e WHERE NOT cut UNION ALL
 SELECT track_id, cue_id, 0, start_ms, (start_ms+end_ms)//2, trim(text) FROM e WHERE cut UNION ALL
 SELECT track_id, cue_id, 1, (start_ms+end_ms)//2, end_ms, trim(text) FROM e WHERE cut UNION ALL
 SELECT track_id, cue_id, 2, end_ms, end_ms+200, trim(text) FROM e WHERE added)
SELECT track_id, row_number() OVER w AS cue_id, start_ms, end_ms, length(text) AS n, coalesce(lag(start_ms) OVER w > start_ms, false) AS out_of_order FROM r
WINDOW w AS (PARTITION BY track_id ORDER BY cue_id, p)""")
def splice_j24(t):
    named, fresh = edits(t)
    return lk.splice(t.cues, named, fresh).withColumn("n", F.length("text").cast("bigint")).drop("text")


@plan("insert_pairs_j25", f""", {GAPS},
g AS (SELECT *, start_ms AS s FROM gaps),
a AS (SELECT track_id, s, start_ms+500 AS a, start_ms+3000 AS b FROM g UNION ALL SELECT track_id, s, start_ms+3500, start_ms+6000+(track_id%3)*5000 FROM g)
SELECT g.track_id, g.s AS gap_id, min(a) >= g.start_ms AND max(b) <= g.end_ms AND bool_and(a < b) AS inside,
 min(a) <= g.start_ms+800+500 AND max(b) >= g.start_ms+6200-500 AS speech_covered,
 bool_or(EXISTS (SELECT 1 FROM cues c WHERE c.track_id=a.track_id AND c.start_ms < a.b AND c.end_ms > a.a)) AS overlaps
FROM g JOIN a ON a.track_id=g.track_id AND a.s=g.s GROUP BY g.track_id, g.s, g.start_ms, g.end_ms""")
def insert_pairs_j25(t):
    gaps = iv.gaps(t.cues, t.media).withColumn("gap_id", F.col("start_ms"))
    s = F.col("start_ms")
    added = gaps.select("track_id", "gap_id", F.explode(F.array(
        F.struct(F.lit(0).alias("pos"), (s + 500).alias("start_ms"), (s + 3000).alias("end_ms")),
        F.struct(F.lit(1).alias("pos"), (s + 3500).alias("start_ms"), (s + 6000 + (F.col("track_id") % 3) * 5000).alias("end_ms")))).alias("_a"))
    added = added.select("track_id", "gap_id", "_a.pos", "_a.start_ms", "_a.end_ms")
    named = gaps.withColumn("speech_start", s + 800).withColumn("speech_end", s + 6200)
    return lk.insert_pairs(t.cues, added, named)


def item_edges(t):
    return iv.interval_join(
        t.ref.select("track_id", F.col("cue_id").alias("item_id"), "start_ms", "end_ms"),
        t.cues.select("track_id", "cue_id", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end")), T).select("track_id", "item_id", "cue_id")


COMPONENTS = f"""
ed AS (SELECT a.track_id, a.cue_id AS item_id, b.cue_id FROM ref a JOIN cues b ON a.track_id=b.track_id AND {STRICT}),
hop AS (SELECT DISTINCT x.track_id, x.item_id AS a, y.item_id AS b FROM ed x JOIN ed y ON x.track_id=y.track_id AND x.cue_id=y.cue_id),
reach AS (SELECT track_id, a, b FROM hop UNION SELECT r.track_id, r.a, h.b FROM reach r JOIN hop h ON r.track_id=h.track_id AND r.b=h.a),
lab AS (SELECT track_id, a AS item_id, min(b) AS label FROM reach GROUP BY ALL)"""


@plan("components_j26", f"""/*recursive*/, {COMPONENTS} SELECT ed.track_id, ed.item_id, ed.cue_id, label FROM ed JOIN lab USING (track_id, item_id)""")
def components_j26(t):
    return lk.components(item_edges(t), "item_id", "cue_id")


@plan("component_text_j26", f"""/*recursive*/, {COMPONENTS},
ce AS (SELECT ed.track_id, ed.item_id, ed.cue_id, label FROM ed JOIN lab USING (track_id, item_id)),
tx AS (SELECT c.track_id, label, string_agg(text, ' ' ORDER BY item_id) AS x FROM (SELECT DISTINCT track_id, item_id, label FROM ce) c JOIN ref r ON r.track_id=c.track_id AND r.cue_id=c.item_id GROUP BY ALL),
ty AS (SELECT c.track_id, label, string_agg(text, ' ' ORDER BY c.cue_id) AS y FROM (SELECT DISTINCT track_id, cue_id, label FROM ce) c JOIN cues r ON r.track_id=c.track_id AND r.cue_id=c.cue_id GROUP BY ALL)
SELECT track_id, label FROM tx JOIN ty USING (track_id, label)
WHERE regexp_split_to_array(trim(x), '\\s+') <> regexp_split_to_array(trim(y), '\\s+')""")
def component_text_j26(t):
    items = t.ref.select("track_id", F.col("cue_id").alias("item_id"), "text")
    return lk.component_text_diff(item_edges(t), items, t.cues.select("track_id", "cue_id", "text")).select("track_id", "label")


@plan("edit_diff_text_j27", """
, b AS (SELECT coalesce(a.track_id, e.track_id) AS track_id, coalesce(a.start_ms=e.start_ms AND a.end_ms=e.end_ms, false) AS same, a.text IS DISTINCT FROM e.text AS differs FROM cues a FULL JOIN edited e ON a.track_id=e.track_id AND a.cue_id=e.cue_id)
SELECT track_id, CASE WHEN NOT bool_and(same) THEN 'times_changed' ELSE 'nothing_changed' END AS error FROM b GROUP BY 1 HAVING NOT bool_and(same) OR NOT bool_or(differs)""")
def edit_diff_text_j27(t):
    return lk.edit_diff(t.cues, t.edited, "text_only")


WORDS_DIFFER = """
, x AS (SELECT track_id, string_agg(text, ' ' ORDER BY cue_id) AS x FROM cues GROUP BY 1), y AS (SELECT track_id, string_agg(text, ' ' ORDER BY cue_id) AS y FROM {other} GROUP BY 1)
SELECT coalesce(x.track_id, y.track_id) AS track_id{extra} FROM x FULL JOIN y ON x.track_id=y.track_id
WHERE coalesce(regexp_split_to_array(trim(x), '\\s+') <> regexp_split_to_array(trim(y), '\\s+'), true)"""


@plan("edit_diff_layout_j27", WORDS_DIFFER.format(other="renumbered", extra=", 'words_changed' AS error"))
def edit_diff_layout_j27(t):
    return lk.edit_diff(t.cues, t.renumbered, "layout")


@plan("same_words_x7", WORDS_DIFFER.format(other="target", extra=""))
def same_words_x7(t):
    return lk.words_differ(t.cues, t.target, T, "cue_id")


@plan("reconcile_samples_j30", """
, n AS (SELECT *, row_number() OVER (PARTITION BY track_id ORDER BY cue_id) AS row_no, count(*) OVER (PARTITION BY track_id) AS c FROM cues),
rq AS (SELECT DISTINCT track_id, 's' || cue_id AS label, (start_ms+end_ms)//2 AS at_ms FROM n, (VALUES (0.1::DOUBLE), (0.5::DOUBLE), (0.9::DOUBLE)) v(f) WHERE row_no = round_even((c-1)*f, 0)::BIGINT + 1),
ac AS (SELECT r.track_id, r.label, r.at_ms, min(c.cue_id) AS cue_id FROM rq r LEFT JOIN cues c ON c.track_id=r.track_id AND c.start_ms <= at_ms AND at_ms < c.end_ms GROUP BY ALL),
rp AS (SELECT track_id, 's' || cue_id AS label, (start_ms+end_ms)//2 AS at_ms, cue_id, text FROM edited),
j AS (SELECT ac.track_id, ac.label, ac.at_ms, CASE WHEN rp.at_ms IS NULL THEN 'missing' WHEN rp.at_ms <> ac.at_ms THEN 'wrong_time' WHEN rp.cue_id IS DISTINCT FROM ac.cue_id THEN 'wrong_cue'
 WHEN rp.text IS DISTINCT FROM c.text THEN 'wrong_text' END AS error FROM ac LEFT JOIN rp ON rp.track_id=ac.track_id AND rp.label=ac.label LEFT JOIN cues c ON c.track_id=ac.track_id AND c.cue_id=ac.cue_id)
SELECT * FROM j WHERE error IS NOT NULL""")
def reconcile_samples_j30(t):
    label = F.concat(F.lit("s"), F.col("cue_id")).alias("label")
    required = sq.samples(t.cues).select("track_id", label, "at_ms")
    reported = t.edited.select("track_id", label, midpoint("start_ms", "end_ms").alias("at_ms"), "cue_id", "text", F.lit(True).alias("visible"))
    return lk.reconcile_samples(required, reported, t.cues)
