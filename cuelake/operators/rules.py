"""Rule engines: review queue, audits, decision and evidence validity, ordering."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cuelake.functions import cps, hash_slices, is_label, row_hash, slices_hash
from cuelake.operators import intervals as iv
from cuelake.operators import linking as lk
from cuelake.operators import measures as ms
from cuelake.operators import sequences as sq
from cuelake.operators.ordered import id_chunk, time_chunk
from cuelake.operators.scoring import first_per, reference_disagreement

TRACK = ["track_id"]
ISSUE = ["track_id", "issue_id", "kind", "start_ms", "end_ms"]


def _issue(df: DataFrame, kind: str, *key: Column | str) -> DataFrame:
    parts = [F.col(k).cast("string") if isinstance(k, str) else k for k in key]
    return df.select("track_id", F.concat(F.lit(kind + ":"), F.concat_ws("-", *parts)).alias("issue_id"),
                     F.lit(kind).alias("kind"), "start_ms", "end_ms")


def review_queue(
    cues: DataFrame,
    media: DataFrame,
    shifted: DataFrame | None = None,
    speech: DataFrame | None = None,
    clips: DataFrame | None = None,
    observations: DataFrame | None = None,
    evidence: DataFrame | None = None,
    with_similarity: bool = False,
    seam_pad_ms: int = 10_000,
) -> DataFrame:
    """All source questions of the corpus as one issue table.

    Optional inputs add their kinds: `shifted` reference cues, merged `speech`, `clips` for seams,
    recognised `observations`, checked `evidence` rows.
    """
    or_word = lambda name, word: F.coalesce(F.col(name).cast("string"), F.lit(word))
    parts = [
        _issue(ms.long_cues(cues), "long_cue", "cue_id"),
        _issue(iv.overlaps(cues, id_chunk("cue_id")), "overlap", "left_id", "right_id"),
        _issue(iv.gaps(cues, media), "subtitle_gap", or_word("previous_cue", "start"), or_word("next_cue", "end")),
        _issue(sq.runs(cues, with_text=False), "repetition", "first_id", "last_id"),
    ]
    if shifted is not None:
        parts.append(_issue(lk.reference_only(cues, shifted), "reference_only", "ref_id"))
        if with_similarity:
            parts.append(_issue(reference_disagreement(cues, shifted), "reference_disagreement", "ref_id"))
    if speech is not None:
        parts.append(_issue(iv.uncovered_speech(speech, cues), "possible_speech_gap", "start_ms"))
        parts.append(_issue(iv.silent_cue_parts(speech, cues), "possible_subtitle_without_speech", "cue_id", "start_ms"))
    if clips is not None:
        seams = clips.where(F.col("core_start_ms") > 0).select(
            "track_id", F.col("core_start_ms").alias("boundary_ms"),
            F.greatest(F.lit(0), F.col("core_start_ms") - seam_pad_ms).alias("start_ms"),
            (F.col("core_start_ms") + seam_pad_ms).alias("end_ms"))
        parts.append(_issue(seams, "unresolved_seam", "boundary_ms"))
    if observations is not None:
        parts.append(_issue(lk.speech_in_gaps(observations, cues), "possible_speech_gap", F.concat(F.lit("saved-"), "obs_id")))
    if evidence is not None:
        parts.append(_issue(evidence_issues(evidence, media), "evidence_disagreement", "evidence_id"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def ordered(df: DataFrame, *keys: str) -> DataFrame:
    """Total order of a report; a range-partitioned sort."""
    return df.orderBy(*(keys or ("track_id", "start_ms", "end_ms", "issue_id")))


# Fixed review order of issue kinds; large repetitions and gaps come before all of them.
KIND_RANK = {
    "overlap": 2, "possible_subtitle_without_speech": 3, "reference_only": 4, "subtitle_gap": 5,
    "possible_speech_gap": 6, "unresolved_seam": 7, "reference_disagreement": 8, "repetition": 9, "long_cue": 10,
}
# Fixed durations from which a defect keeps a track from release.
URGENT_MS = {"long_cue": 20_000, "repetition": 30_000, "subtitle_gap": 30_000, "possible_subtitle_without_speech": 10_000}


def _lookup(values: Mapping[str, int], column: Column) -> Column:
    return F.create_map(*[F.lit(x) for pair in values.items() for x in pair])[column]


def priority() -> Column:
    length = F.col("end_ms") - F.col("start_ms")
    return (F.when((F.col("kind") == "repetition") & (length >= 30_000), 0)
            .when((F.col("kind") == "subtitle_gap") & (length >= 30_000), 1)
            .otherwise(F.coalesce(_lookup(KIND_RANK, F.col("kind")), F.lit(10))))


def next_issues(issues: DataFrame, k: int = 5) -> DataFrame:
    """The k issues of each track to look at first."""
    ranked = issues.withColumn("priority", priority().cast("bigint"))
    return first_per(ranked, TRACK, [F.col("priority"), F.col("start_ms"), F.col("issue_id")], k)


def urgent(issues: DataFrame) -> DataFrame:
    return issues.where(F.col("end_ms") - F.col("start_ms") >= _lookup(URGENT_MS, F.col("kind")))


def translation_audit(source: DataFrame, target: DataFrame, max_cps: float = 25, long_ms: int = 8000) -> DataFrame:
    """Mechanical flags of a two-track comparison."""
    def flag(df, kind, language, ident):
        return df.select("track_id", F.lit(kind).alias("kind"), F.lit(language).alias("language"), F.col(ident).cast("bigint").alias("cue_id"))

    def fast(df, language):
        return flag(df.where(cps("text", "start_ms", "end_ms") > max_cps), "fast_cue", language, "cue_id")

    s, t = source.drop("text"), target.drop("text")
    grouped = lk_many(source, target)
    return (
        flag(iv.uncovered_cues(s, t), "source_without_target", "source", "cue_id")
        .unionByName(flag(iv.uncovered_cues(t, s), "target_without_source", "target", "cue_id"))
        .unionByName(flag(grouped, "many_source_cues_one_target", "target", "target_id"))
        .unionByName(flag(sq.runs(target, with_text=False), "repeated_target", "target", "first_id"))
        .unionByName(fast(source, "source")).unionByName(fast(target, "target"))
        .unionByName(flag(ms.long_cues(target, long_ms), "long_target_cue", "target", "cue_id")))


def lk_many(source: DataFrame, target: DataFrame) -> DataFrame:
    return iv.many_to_one(source, target).select("track_id", "target_id").distinct()


def unit_facts(units: DataFrame, words: DataFrame, stale: DataFrame) -> DataFrame:
    """(track_id, unit_id, stale, bad, ws, we): what the alignment says of each unit.

    A stale unit has no result that still counts, so neither status nor word times; a unit without
    any word row has no status.
    """
    key = ["track_id", "unit_id"]
    both = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull()
    timed = words.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min(F.when(both, F.col("start_ms"))).alias("_ws"), F.max(F.when(both, F.col("end_ms"))).alias("_we"))
    old = stale.select(*key).distinct().withColumn("_old", F.lit(True))
    joined = ms.align_status(words, units).select(*key, "status").join(timed, key, "left").join(old, key, "left")
    fresh = F.col("_old").isNull()
    bad = fresh & F.col("_n").isNotNull() & F.col("status").isin("partial", "failed", "suspicious")
    return joined.select(*key, (~fresh).alias("stale"), F.coalesce(bad, F.lit(False)).alias("bad"),
                         F.when(fresh, F.col("_ws")).alias("ws"), F.when(fresh, F.col("_we")).alias("we"))


def layout_audit(units: DataFrame, translations: DataFrame, links: DataFrame, words: DataFrame, stale: DataFrame,
                 threshold_ms: int = 700, max_cps: float = 25) -> DataFrame:
    """Timing, density and link flags of both languages, one row per flag with its measure.

    Units: track_id, unit_id, start_ms, end_ms, text. Translations: translation_id instead.
    Links: track_id, translation_id, unit_id. Words: track_id, unit_id, start_ms, end_ms.
    Stale: track_id, unit_id of units whose alignment no longer fits.
    """
    # 1. One fact row per unit.

    facts = unit_facts(units, words, stale)

    # 2. Items of both languages over their units.

    key = ["track_id", "language", "item_id"]
    items = units.select("track_id", F.lit("source").alias("language"), F.col("unit_id").alias("item_id"), "start_ms", "end_ms", "text").unionByName(
        translations.select("track_id", F.lit("english").alias("language"), F.col("translation_id").alias("item_id"), "start_ms", "end_ms", "text"))
    bridge = units.select("track_id", F.lit("source").alias("language"), F.col("unit_id").alias("item_id"), "unit_id").unionByName(
        links.select("track_id", F.lit("english").alias("language"), F.col("translation_id").alias("item_id"), "unit_id"))
    rolled = bridge.join(facts, ["track_id", "unit_id"]).groupBy(*key).agg(
        F.bool_or("stale").alias("_stale"), F.bool_or("bad").alias("_bad"), F.min("ws").alias("_ws"), F.max("we").alias("_we"))
    slim = items.select(*key, "start_ms", "end_ms", cps("text", "start_ms", "end_ms").alias("_cps"))
    joined = slim.join(rolled, key, "left")
    lead, tail = F.col("_ws") - F.col("start_ms"), F.col("end_ms") - F.col("_we")

    def when(test: Column, kind: str, measure: Column) -> Column:
        return F.when(test, F.struct(F.lit(kind).alias("kind"), measure.cast("double").alias("measure")))

    none = F.lit(None).cast("double")
    flags = joined.select(*key, F.explode(F.array_compact(F.array(
        when(F.coalesce("_stale", F.lit(False)), "stale_alignment", none),
        when(F.coalesce("_bad", F.lit(False)), "unreliable_alignment", none),
        when(F.col("_ws").isNull(), "missing_word_timing", none),
        when(lead > threshold_ms, "possible_early_cue", lead),
        when(tail > threshold_ms, "possible_lingering_cue", tail),
        when(F.col("_cps") > max_cps, "fast_cue", F.round("_cps", 2)),
    ))).alias("_f")).select(*key, "_f.kind", "_f.measure")

    # 3. Links themselves.

    spans = links.select("track_id", "translation_id", "unit_id").join(
        units.select("track_id", "unit_id", "start_ms", "end_ms"), ["track_id", "unit_id"])
    wide = sq.inner_gap(spans).select(
        "track_id", F.lit("english").alias("language"), F.col("translation_id").alias("item_id"),
        F.lit("translation_spans_dialogue_gap").alias("kind"), F.col("gap_ms").cast("double").alias("measure"))
    lonely = units.join(links, ["track_id", "unit_id"], "left_anti").select(
        "track_id", F.lit("source").alias("language"), F.col("unit_id").alias("item_id"),
        F.lit("missing_english_link").alias("kind"), none.alias("measure"))
    return flags.unionByName(wide).unionByName(lonely)


# Fixed kinds that always need a decision; early and lingering cues only from two seconds.
MATERIAL = ["stale_alignment", "unreliable_alignment", "missing_word_timing", "translation_spans_dialogue_gap", "missing_english_link"]


def material(flags: DataFrame, from_ms: int = 2000) -> DataFrame:
    return flags.where(F.col("kind").isin(*MATERIAL) | (
        F.col("kind").isin("possible_early_cue", "possible_lingering_cue") & (F.col("measure") >= from_ms)))


# --- content binding ------------------------------------------------------------------------

def interval_sha(cues: DataFrame, spans: DataFrame, key: Sequence[str]) -> DataFrame:
    """Content hash of the cues inside each span; spans without cues (or length) get the empty hash.

    What overlaps a span started before its end and had not ended by its start, so slice sums
    of the span are a difference of two running sums: no cue is paired with a span.
    """
    sums = ["n", "s0", "s1", "s2", "s3"]
    hashed = cues.select("track_id", "start_ms", "end_ms", row_hash("start_ms", "end_ms", "text").alias("_row"))
    rows = hashed.select("track_id", "start_ms", "end_ms", F.lit(1).cast("bigint").alias("n"), *[v.alias(f"s{i}") for i, v in enumerate(hash_slices("_row"))])

    def reached(at: str, ask: Column) -> DataFrame:
        return iv.sums_before(rows.select("track_id", F.col(at).alias("at"), *sums), spans.select("track_id", ask.alias("at")), TRACK, sums, time_chunk("at"))

    begun, over = reached("start_ms", F.col("end_ms")), reached("end_ms", F.col("start_ms") + 1)
    asked = spans.withColumn("_e", F.col("end_ms")).withColumn("_s", F.col("start_ms") + 1)
    asked = asked.join(begun.select("track_id", F.col("at").alias("_e"), *[F.col(v).alias(f"_b{v}") for v in sums]), ["track_id", "_e"], "left")
    asked = asked.join(over.select("track_id", F.col("at").alias("_s"), *[F.col(v).alias(f"_o{v}") for v in sums]), ["track_id", "_s"], "left")
    some = F.coalesce((F.col("start_ms") < F.col("end_ms")) & F.col("_bn").isNotNull(), F.lit(False))
    inside = {v: F.when(some, F.col(f"_b{v}") - F.col(f"_o{v}")).otherwise(0) for v in sums}
    sha = slices_hash(inside["n"], [inside[f"s{i}"] for i in range(4)])
    return asked.select(*[F.col(c) for c in spans.columns], sha.alias("interval_sha"))


def stale(rows: DataFrame, current: DataFrame, key: Sequence[str], sha: str = "sha", keep: bool = False) -> DataFrame:
    """Rows whose stored hash is no longer the current one (or, with `keep`, still is)."""
    return rows.join(current.select(*key, sha).distinct(), [*key, sha], "left_semi" if keep else "left_anti")


def bind_flags(flags: DataFrame, items: DataFrame, facts: DataFrame) -> DataFrame:
    """Hash of flag, item and alignment facts, so a decision expires when any of them changes.

    `items` and `facts` carry one hash per (track_id, language, item_id): item_sha, fact_sha. A measure
    without an integer (the infinite speed of a cue of no length) counts as none.
    """
    key = ["track_id", "language", "item_id"]
    joined = flags.join(items, key, "left").join(facts, key, "left")
    return joined.withColumn("binding", row_hash("language", "item_id", "kind", F.col("measure").try_cast("bigint"), "item_sha", "fact_sha")).drop("item_sha", "fact_sha")


def open_flags(bound: DataFrame, decisions: DataFrame) -> DataFrame:
    """Flags without a valid decision for exactly their current binding."""
    good = decisions.where(
        F.col("disposition").isin("false_positive", "accepted_exception", "alternate_timing_evidence")
        & (F.trim("reviewer") != "") & (F.trim("reason") != ""))
    return bound.join(good.select("track_id", "language", "item_id", "kind", "binding").distinct(),
                      ["track_id", "language", "item_id", "kind", "binding"], "left_anti")


# --- decisions ------------------------------------------------------------------------------

SPAN = ["track_id", "kind", "start_ms", "end_ms"]


def _latest(decisions: DataFrame, key: Sequence[str], alias: str) -> DataFrame:
    """Last decision per key by sequence number; combines on the map side."""
    return decisions.groupBy(*key).agg(
        F.max_by(F.struct("issue_id", "kind", "start_ms", "end_ms", "status", "interval_sha", "seq"), "seq").alias(alias))


def pending(issues: DataFrame, decisions: DataFrame) -> DataFrame:
    """Issues still open: no valid decision by id, nor a reviewed one for the same gap interval.

    `issues` carries interval_sha. A decision by id counts if it names the same interval, is
    reviewed or resolved, and saw the present content.
    """
    by_id = _latest(decisions, ["track_id", "issue_id"], "_d")
    by_span = _latest(decisions, SPAN, "_s")
    joined = issues.join(by_id, ["track_id", "issue_id"], "left").join(by_span, SPAN, "left")
    d = F.col("_d")
    valid = ((d["kind"] == F.col("kind")) & (d["start_ms"] == F.col("start_ms")) & (d["end_ms"] == F.col("end_ms"))
             & d["status"].isin("reviewed", "resolved") & (d["interval_sha"] == F.col("interval_sha")))
    gap = F.col("kind").isin("subtitle_gap", "possible_speech_gap") & (F.col("_s")["status"] == "reviewed")
    closed = F.coalesce(valid, F.lit(False)) | F.coalesce(gap, F.lit(False))
    return joined.where(~closed).drop("_d", "_s")


def closing_decision(issues: DataFrame, decisions: DataFrame) -> DataFrame:
    """Last decision that names the issue by id or by kind and interval; two equi joins, no OR."""
    payload = F.struct("seq", "status", "interval_sha")
    a = issues.select("track_id", "issue_id").join(decisions.select("track_id", "issue_id", payload.alias("_d")), ["track_id", "issue_id"])
    b = issues.select(*SPAN, "issue_id").join(decisions.select(*SPAN, payload.alias("_d")), SPAN).select("track_id", "issue_id", "_d")
    last = a.unionByName(b).groupBy("track_id", "issue_id").agg(F.max_by("_d", F.col("_d.seq")).alias("_d"))
    return issues.join(last, ["track_id", "issue_id"], "left").select(*issues.columns, F.col("_d.status").alias("status"), F.col("_d.seq").alias("seq"))


def unresolved(issues: DataFrame, decisions: DataFrame) -> DataFrame:
    """Issues whose last decision says unresolved. A decision with an interval speaks for issues of
    its kind at that interval, whatever its id; only one without speaks for its id."""
    timed = F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull()
    by_id = _latest(decisions.where(~timed), ["track_id", "issue_id"], "_d")
    by_span = _latest(decisions.where(timed), SPAN, "_s")
    joined = issues.join(by_id, ["track_id", "issue_id"], "left").join(by_span, SPAN, "left")
    is_open = F.coalesce(F.col("_d.status") == "unresolved", F.lit(False)) | F.coalesce(F.col("_s.status") == "unresolved", F.lit(False))
    return joined.where(is_open).select(*issues.columns)


def queue_blockers(pending: DataFrame) -> DataFrame:
    """What pending issues hold up, one row each: (track_id, check) with `pending` for every issue,
    `urgent` for a severe one, `coverage` for a question of speech coverage. One pass over the queue."""
    severe = F.coalesce(F.col("end_ms") - F.col("start_ms") >= _lookup(URGENT_MS, F.col("kind")), F.lit(False))
    checks = F.array(F.lit("pending"), F.when(severe, "urgent"), F.when(F.col("kind").isin("subtitle_gap", "possible_speech_gap"), "coverage"))
    return pending.select("track_id", F.explode(F.array_compact(checks)).alias("check"))


# Fixed outcome and disposition names of an audio decision.
OUTCOMES = ["relevant_speech", "unintelligible_speech", "music_without_relevant_words", "nonverbal_sound", "silence"]
DISPOSITIONS = ["source_supported", "model_artifact", "repaired", "no_relevant_speech"]
SILENT_OUTCOMES = ["music_without_relevant_words", "nonverbal_sound", "silence"]


def decision_errors(decisions: DataFrame, cues: DataFrame) -> DataFrame:
    """First broken rule of each audio decision.

    `decisions`: track_id, decision_id, start_ms, end_ms, outcome, disposition, reason, reviewer, n_evidence.
    """
    silent = decisions.where(F.col("disposition") == "no_relevant_speech")
    spoken = cues.where(~is_label("text"))
    clash = iv.with_partner(silent, spoken, TRACK, ["decision_id"]).select("track_id", "decision_id").withColumn("_clash", F.lit(True))
    joined = decisions.join(clash, ["track_id", "decision_id"], "left")
    blank = lambda name: F.coalesce(F.trim(name), F.lit("")) == ""
    quiet = F.col("disposition") == "no_relevant_speech"
    error = (
        F.when(F.col("outcome").isNotNull() & ~F.col("outcome").isin(*OUTCOMES), "invalid_outcome")
        .when(~F.coalesce(F.col("disposition").isin(*DISPOSITIONS), F.lit(False)) | blank("reason") | blank("reviewer") | (F.col("n_evidence") < 1), "incomplete")
        .when(quiet & ~F.coalesce(F.col("outcome").isin(*SILENT_OUTCOMES), F.lit(False)), "needs_non_speech_outcome")
        .when(quiet & F.col("_clash").isNotNull(), "overlaps_spoken_cue"))
    return joined.select("track_id", "decision_id", error.alias("error")).where(F.col("error").isNotNull())


def grouping_pending(flags: DataFrame, decisions: DataFrame) -> DataFrame:
    """Translation flags not settled by a current display-grouping decision.

    `flags`: track_id, flag_id, kind, sha. `decisions`: track_id, flag_id, sha, disposition, reason.
    """
    good = decisions.where((F.col("disposition") == "independent_display_grouping") & (F.trim("reason") != ""))
    settled = flags.where(F.col("kind") == "many_source_cues_one_target").join(
        good.select("track_id", "flag_id", "sha").distinct(), ["track_id", "flag_id", "sha"], "left_semi")
    return flags.join(settled.select("track_id", "flag_id", "kind"), ["track_id", "flag_id", "kind"], "left_anti")


def check_rules(df: DataFrame, key: Sequence[str], rules: Mapping[str, Column]) -> DataFrame:
    """One row per row and broken rule; `rules` maps a name to the condition that must hold."""
    broken = F.array_compact(F.array(*[F.when(~F.coalesce(test, F.lit(False)), F.lit(name)) for name, test in rules.items()]))
    return df.select(*key, F.explode(broken).alias("rule"))


def evidence_issues(evidence: DataFrame, media: DataFrame) -> DataFrame:
    """Evidence rows that pass validation, as issues."""
    joined = evidence.join(media, "track_id")
    once = joined.groupBy("track_id", "evidence_id").agg(F.count(F.lit(1)).alias("_n"))
    return joined.join(once.where("_n = 1"), ["track_id", "evidence_id"]).where(_evidence_ok()).select(
        "track_id", "evidence_id", "start_ms", "end_ms", "summary")


def _evidence_ok() -> Column:
    return ((F.col("start_ms") >= 0) & (F.col("start_ms") < F.col("end_ms")) & (F.col("end_ms") <= F.col("duration_ms"))
            & (F.trim("summary") != "") & (F.col("n_refs") > 0))


def valid_observations(rows: DataFrame) -> DataFrame:
    """Acoustic observation rows that may be used.

    `rows`: obs_id, kind, label, text, confidence, start_ms, end_ms, r_start, r_end (receipt bounds).
    """
    inside = (F.col("r_start") <= F.col("start_ms")) & (F.col("start_ms") < F.col("end_ms")) & (F.col("end_ms") <= F.col("r_end"))
    sure = F.col("confidence").isNull() | (~F.isnan("confidence") & F.col("confidence").between(0, 1))
    event = (F.col("kind") != "audio_event") | (F.coalesce(F.col("label").isin("speech", "singing", "music"), F.lit(False)) & sure)
    return rows.where(F.col("kind").isin("audio_event", "asr", "local_audio_observation") & inside & (F.trim("text") != "") & event)


def evidence_errors(clips: DataFrame, spans: DataFrame, key: Sequence[str]) -> DataFrame:
    """Spans whose evidence clips are malformed, of other media, or leave a hole.

    `clips`: track_id, key, start_ms, end_ms, media_ok. `spans`: track_id, key, start_ms, end_ms.
    """
    by = ["track_id", *key]
    bad = clips.where(~F.col("media_ok") | (F.col("start_ms") < 0) | (F.col("start_ms") >= F.col("end_ms"))).select(*by).distinct().withColumn("_bad", F.lit(True))
    good = clips.select(*by, "start_ms", "end_ms").where((F.col("start_ms") >= 0) & (F.col("start_ms") < F.col("end_ms")))
    judged = iv.covers(good, spans.withColumn("_one", F.lit(0)), by, ["_one"]).drop("_one").join(bad, by, "left")
    error = F.when(F.col("_bad").isNotNull(), "malformed_clip").when(~F.col("covered"), "interval_not_covered")
    return judged.select(*by, error.alias("error")).where(F.col("error").isNotNull())


def reach(observations: DataFrame, spans: DataFrame, key: Sequence[str]) -> DataFrame:
    """How far each model's observations of a span run on from its start without a hole.

    `observations`: key, model, start_ms, end_ms; `spans`: key, start_ms, end_ms. Returns key, model,
    reach_ms (the span's start where nothing begins there). A window holds one model's distinct
    intervals for one span.
    """
    begin = spans.select(*key, F.col("start_ms").alias("_s"))
    rows = observations.select(*key, "model", "start_ms", "end_ms").distinct().join(begin, list(key))
    order = Window.partitionBy(*key, "model").orderBy("start_ms", "end_ms")
    before = F.max("end_ms").over(order.rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_hole", F.col("start_ms") > F.greatest("_s", F.coalesce(before, "_s")))
    rows = rows.withColumn("_past", F.max("_hole").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*key, "model").agg(F.greatest(F.first("_s"), F.max(F.when(~F.col("_past"), F.col("end_ms")))).alias("reach_ms"))


def review_errors(results: DataFrame, issues: DataFrame, observations: DataFrame, stages: DataFrame, tail_ms: int = 50) -> DataFrame:
    """First reason a review result cannot close its issue, or nothing.

    `results`: track_id, issue_id, start_ms, end_ms, status, route, media_sha, interval_sha, and the
    agent's reviewer, reason, heard_original BOOLEAN.
    `issues`: track_id, issue_id, start_ms, end_ms, duration_ms, media_sha, interval_sha.
    `observations`: track_id, issue_id, method, model, model_version, receipt, receipt_ok BOOLEAN (its
    content is the recorded one), media_sha, start_ms, end_ms, whole BOOLEAN (of the whole audio).
    `stages`: track_id, issue_id, pos, stage, model, assessment.

    A local recogniser's observation must hold the issue whole. Saved receipts hold it together, model
    by model; only there may a whole-audio receipt end up to `tail_ms` before the media's end.
    """
    key = ["track_id", "issue_id"]
    want = issues.select(*key, F.col("start_ms").alias("_s"), F.col("end_ms").alias("_e"), "duration_ms",
                         F.col("media_sha").alias("_m"), F.col("interval_sha").alias("_h"))
    told = lambda *names: functools.reduce(lambda a, b: a & b, [F.coalesce(F.trim(n) != "", F.lit(False)) for n in names])

    seen = observations.join(want, key).join(results.select(*key, "route"), key)
    shared = told("model", "receipt") & F.col("receipt_ok") & (F.col("media_sha") == F.col("_m"))
    local = shared & (F.col("method") == "local_asr") & told("model_version") & (F.col("start_ms") <= F.col("_s")) & (F.col("end_ms") >= F.col("_e"))
    saved = shared & (F.col("method") == "hosted_asr") & (F.col("start_ms") >= 0) & (F.col("start_ms") < F.col("end_ms"))
    usable = F.when(F.col("route") == "local_asr_agent", local).otherwise(saved)
    facts = seen.groupBy(*key).agg(
        F.count(F.lit(1)).alias("_n"), F.bool_and(F.coalesce(usable, F.lit(False))).alias("_usable"),
        F.count_distinct("model").alias("_models"), F.count_distinct("receipt").alias("_receipts"))

    hosted = seen.where(F.col("route") == "saved_asr_agent")
    audio = hosted.where("whole").groupBy(*key, "model").agg(F.max("end_ms").alias("_audio"))
    far = reach(hosted, issues, key).join(want.select(*key, "_e", "duration_ms"), key).join(audio, [*key, "model"], "left")
    tail = (F.col("_audio") == F.col("reach_ms")) & (F.col("_e") == F.col("duration_ms")) & (F.col("_e") - F.col("reach_ms") <= tail_ms)
    whole = far.groupBy(*key).agg(F.bool_and((F.col("reach_ms") >= F.col("_e")) | F.coalesce(tail, F.lit(False))).alias("_whole"))

    right = ((F.col("pos") == 0) & (F.col("stage") == "independent")) | ((F.col("pos") == 1) & (F.col("stage") == "comparison"))
    steps = stages.groupBy(*key).agg(F.count(F.lit(1)).alias("_stages"), F.bool_and(F.coalesce(told("model", "assessment") & right, F.lit(False))).alias("_right"))

    joined = results.join(want, key).join(facts, key, "left").join(whole, key, "left").join(steps, key, "left")
    current = ((F.col("media_sha") == F.col("_m")) & (F.col("interval_sha") == F.col("_h")) & (F.col("start_ms") <= F.col("_s"))
               & (F.col("end_ms") >= F.col("_e")) & F.col("status").isin("supported", "corrected", "model_artifact"))
    agent = F.coalesce(F.col("route").isin("local_asr_agent", "saved_asr_agent"), F.lit(False))
    judged = told("reviewer", "reason") & F.coalesce(~F.col("heard_original"), F.lit(False)) & (F.coalesce("_n", F.lit(0)) >= 2)
    twice = (F.col("_models") >= 2) & (F.col("_receipts") >= 2)
    staged = (F.coalesce("_stages", F.lit(0)) == 2) & F.coalesce("_right", F.lit(False))
    error = (F.when(~F.coalesce(current, F.lit(False)), "stale_or_uncertain")
             .when(agent & ~judged, "needs_agent_judgment")
             .when(agent & ~F.coalesce("_usable", F.lit(False)), "observation_unusable")
             .when(agent & ~F.coalesce(twice, F.lit(False)), "needs_two_models_and_receipts")
             .when((F.col("route") == "saved_asr_agent") & ~F.coalesce("_whole", F.lit(False)), "interval_not_covered")
             .when(~agent & ~staged, "needs_two_ordered_stages"))
    return joined.select(*key, error.alias("error")).where(F.col("error").isNotNull())


def open_findings(assessments: DataFrame, adjudications: DataFrame, evidence: DataFrame) -> DataFrame:
    """Findings without a current adjudication.

    `assessments`: track_id, source_id, verdict, input_sha, response_sha, finding_sha.
    `adjudications`: the same hashes, disposition, question_type, reviewer, reason.
    `evidence`: track_id, source_id, kind, sha, current_sha.
    """
    key = ["track_id", "source_id"]
    facts = evidence.groupBy(*key).agg(
        F.bool_and(F.col("sha").eqNullSafe(F.col("current_sha")) & F.col("kind").isin("source_text", "scene_context", "original_audio", "model_receipt", "other")).alias("_fresh"),
        F.bool_or(F.col("kind") == "original_audio").alias("_audio"))
    good = adjudications.join(facts, key).where(
        (F.col("disposition") == "supported_as_written") & (F.trim("reviewer") != "") & (F.trim("reason") != "") & F.col("_fresh")
        & ((F.col("question_type") == "translation_semantics") | ((F.col("question_type") == "source_recognition") & F.col("_audio"))))
    shas = [*key, "input_sha", "response_sha", "finding_sha"]
    return assessments.where(F.col("verdict") != "correct").join(good.select(*shas).distinct(), shas, "left_anti")


# --- key sets -------------------------------------------------------------------------------

def missing_keys(expected: DataFrame, got: DataFrame, key: Sequence[str]) -> DataFrame:
    return expected.select(*key).distinct().join(got, list(key), "left_anti")


def bad_keys(entries: DataFrame, expected: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys recorded twice, and keys that name nothing any more."""
    counted = entries.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    twice = counted.where("_n > 1").select(*key, F.lit("duplicate").alias("problem"))
    gone = counted.join(expected, list(key), "left_anti").select(*key, F.lit("obsolete").alias("problem"))
    return twice.unionByName(gone)


def not_subset(rows: DataFrame, allowed: DataFrame, by: Sequence[str], ids: str, ident: str) -> DataFrame:
    """Rows whose id array names something outside the allowed ids; exploded, not collected."""
    outside = rows.select(*by, F.explode(ids).alias(ident)).join(allowed, ["track_id", ident], "left_anti")
    return outside.groupBy(*by).agg(F.count(F.lit(1)).alias("n_unknown"))
