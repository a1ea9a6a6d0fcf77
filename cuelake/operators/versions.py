"""Versioning: work plans by content hash, resume, merges with history, readiness, drift."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.functions import midpoint, row_hash, set_hash
from cuelake.functions.base import idiv
from cuelake.operators.linking import parity
from cuelake.operators.rules import stale
from cuelake.operators.sequences import align_windows, batches

TRACK = ["track_id"]


def window_hashes(units: DataFrame, media: DataFrame, model: str, revision: str | None, core_ms: int = 60_000) -> DataFrame:
    """Identity of every alignment window: with the model revision, without it, and without ids.

    Sums of row hashes replace a sorted list of units, so no window is collected.
    """
    jobs = align_windows(units, media, core_ms)
    slot = idiv(midpoint("start_ms", "end_ms"), core_ms) * core_ms
    rows = units.join(media, "track_id").where(midpoint("start_ms", "end_ms") < F.col("duration_ms")).select(
        "track_id", slot.alias("core_start_ms"),
        row_hash("cue_id", "text", "start_ms", "end_ms").alias("_with"), row_hash("text", "start_ms", "end_ms").alias("_without"))
    content = rows.groupBy("track_id", "core_start_ms").agg(set_hash("_with").alias("_w"), set_hash("_without").alias("_o"))
    joined = jobs.join(content, ["track_id", "core_start_ms"])
    full = model if revision is None else f"{model}@{revision}"
    tag = lambda name, body: row_hash(F.lit(name), "audio_start_ms", "audio_end_ms", body)
    return joined.select(
        "track_id", "core_start_ms", "audio_start_ms", "audio_end_ms", tag(full, "_w").alias("input_sha"),
        tag(model, "_w").alias("legacy_sha"), tag(full, "_o").alias("content_sha"), F.lit(revision).cast("string").alias("revision"))


def plan_work(inputs: DataFrame, cache: DataFrame) -> DataFrame:
    """What each window needs: cached, legacy (revision unrecorded), remapped (only ids changed), missing."""
    saved = cache.select("track_id", "core_start_ms", F.col("input_sha").alias("_i"), F.col("content_sha").alias("_c"), F.col("revision").alias("_r"))
    joined = inputs.join(saved, ["track_id", "core_start_ms"], "left")
    status = (F.when(F.col("_i") == F.col("input_sha"), "cached")
              .when(F.col("_r").isNull() & (F.col("_i") == F.col("legacy_sha")), "legacy")
              .when(F.col("_c") == F.col("content_sha"), "remapped").otherwise("missing"))
    return joined.select("track_id", "core_start_ms", "audio_start_ms", "audio_end_ms", status.alias("work"))


def missing_windows(windows: DataFrame, cache: DataFrame, settings: Sequence[str]) -> DataFrame:
    """Windows with no cached result of the same bounds and settings."""
    return windows.join(cache.select("track_id", "start_ms", "end_ms", *settings).distinct(),
                        ["track_id", "start_ms", "end_ms", *settings], "left_anti")


def pending_batches(jobs: DataFrame, done: DataFrame) -> DataFrame:
    """State of each batch: done, changed (identity differs), blocked (tried, no answer), pending."""
    saved = done.select("track_id", "batch_no", F.col("input_sha").alias("_sha"), F.col("answered").alias("_a"), F.lit(True).alias("_seen"))
    joined = jobs.join(saved, ["track_id", "batch_no"], "left")
    state = (F.when(F.col("_seen").isNull(), "pending").when(F.col("_sha") != F.col("input_sha"), "changed")
             .when(~F.col("_a"), "blocked").otherwise("done"))
    return joined.select("track_id", "batch_no", "input_sha", state.alias("state"))


def upsert_decisions(current: DataFrame, new: DataFrame, live: DataFrame, key: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Merge new decisions in: returns (current, history).

    A prior row with a new one for its key is superseded; one whose question is gone is archived.
    """
    key = list(key)
    marks = current.join(new.select(*key).distinct().withColumn("_new", F.lit(True)), key, "left").join(
        live.select(*key).distinct().withColumn("_live", F.lit(True)), key, "left")
    reason = F.when(F.col("_new").isNotNull(), "superseded").when(F.col("_live").isNull(), "question_disappeared")
    marked = marks.withColumn("archive_reason", reason).drop("_new", "_live")
    kept = marked.where(F.col("archive_reason").isNull()).drop("archive_reason").unionByName(new)
    return kept, marked.where(F.col("archive_reason").isNotNull())


def apply_rows(checkpoint: DataFrame, rows: DataFrame, correction: bool = False) -> DataFrame:
    """Apply authored rows to a translation checkpoint.

    Each row has a text or a defer reason, not both. An existing text may only change in a
    correction, which keeps the old text; otherwise the old one stays and the row is a conflict.
    """
    blank = lambda name: F.coalesce(F.trim(name), F.lit("")) == ""
    valid = rows.where(blank("text") != blank("defer_reason")).select(
        "track_id", "cue_id", F.when(~blank("text"), F.trim("text")).alias("_t"), F.when(~blank("defer_reason"), F.trim("defer_reason")).alias("_d"),
        F.lit(True).alias("_row"))
    joined = checkpoint.join(valid, ["track_id", "cue_id"], "full_outer")
    had, given = F.col("text").isNotNull(), F.col("_row").isNotNull()
    same = F.coalesce(F.col("_t") == F.col("text"), F.lit(False))
    conflict = had & given & ~same
    take = given & (~conflict | (F.lit(correction) & F.col("_t").isNotNull()))
    return joined.select(
        "track_id", "cue_id", F.when(take, F.col("_t")).otherwise(F.col("text")).alias("text"),
        F.when(take, F.col("_d")).otherwise(F.col("defer_reason")).alias("defer_reason"),
        F.when(take & conflict, F.col("text")).alias("previous_text"), (conflict & ~take).alias("conflict"))


def export_status(checkpoint: DataFrame, cues: DataFrame) -> DataFrame:
    """Per track: complete or partial, how many cues lack a text, how many are deferred."""
    joined = cues.select("track_id", "cue_id").join(checkpoint.select("track_id", "cue_id", F.col("text").alias("_t"), "defer_reason"), ["track_id", "cue_id"], "left")
    missing = F.col("_t").isNull()
    counted = joined.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("cues"), F.count_if(missing).alias("missing"), F.count_if(missing & F.col("defer_reason").isNotNull()).alias("deferred"))
    return counted.withColumn("status", F.when(F.col("missing") == 0, "complete_draft").when(F.col("missing") == F.col("cues"), "empty").otherwise("partial"))


def snapshot(versions: DataFrame, hashes: DataFrame) -> DataFrame:
    """Rows of the stored versions that the given hashes name."""
    return versions.join(hashes.select("version_sha").distinct(), "version_sha", "left_semi")


# Fixed names of the judgments a source needs before translation.
READY = ["coverage_assessed", "material_defects_repaired", "speech_timing_usable", "ordinary_dialogue_review_complete"]


def ready(decisions: DataFrame, pending: DataFrame, evidence: DataFrame) -> DataFrame:
    """Readiness per track: all judgments true, nothing left, no open question, evidence unchanged.

    `decisions`: track_id, READY booleans, remaining BIGINT, reviewer, reason. `evidence`: track_id, sha, current_sha.
    """
    held = evidence.groupBy("track_id").agg(F.bool_and(F.col("sha").eqNullSafe(F.col("current_sha"))).alias("_fresh"))
    open_rows = pending.groupBy("track_id").agg(F.count(F.lit(1)).alias("open_issues"))
    joined = decisions.join(held, "track_id", "left").join(open_rows, "track_id", "left")
    judged = F.lit(True)
    for name in READY:
        judged = judged & F.coalesce(name, F.lit(False))
    ok = (judged & (F.col("remaining") == 0) & (F.trim("reviewer") != "") & (F.trim("reason") != "")
          & F.coalesce("_fresh", F.lit(False)) & F.col("open_issues").isNull())
    return joined.select("track_id", F.coalesce("open_issues", F.lit(0)).alias("open_issues"), F.coalesce(ok, F.lit(False)).alias("ready"))


def drift(manifest: DataFrame, files: DataFrame) -> DataFrame:
    """Recorded against present hashes of files: current, changed or missing."""
    joined = manifest.join(files.select("path", F.col("sha").alias("_now")), "path", "left")
    state = F.when(F.col("_now").isNull(), "missing").when(F.col("_now") != F.col("sha"), "changed").otherwise("current")
    return joined.select("path", state.alias("state"))


def batch_inputs(units: DataFrame, size: int, context: int) -> DataFrame:
    """Hash of each review batch: ids, texts and roles of its rows, no timings."""
    rows = batches(units, size, context).join(units.select("track_id", "cue_id", "text"), ["track_id", "cue_id"])
    return rows.groupBy("track_id", "batch_no").agg(
        set_hash(row_hash("cue_id", "text", "role")).alias("input_sha"), F.count_if(F.col("role") == "target").alias("n_targets"))


def stale_batches(saved: DataFrame, current: DataFrame, assessed: DataFrame, units: DataFrame, size: int) -> DataFrame:
    """Batches to review again: input hash changed, or not every id assessed exactly once.

    `saved`: track_id, batch_no, input_sha. `assessed`: track_id, batch_no, source_id.
    """
    want = units.groupBy("track_id", (idiv(F.col("row_no") - 1, size) + 1).alias("batch_no")).agg(F.count(F.lit(1)).alias("_want"))
    per_id = assessed.groupBy("track_id", "batch_no", "source_id").agg(F.count(F.lit(1)).alias("_n"))
    got = per_id.groupBy("track_id", "batch_no").agg(F.count(F.lit(1)).alias("_got"), F.max("_n").alias("_most"))
    joined = current.join(saved.select("track_id", "batch_no", F.col("input_sha").alias("_sha")), ["track_id", "batch_no"], "left")
    joined = joined.join(want, ["track_id", "batch_no"], "left").join(got, ["track_id", "batch_no"], "left")
    fresh = (F.col("_sha") == F.col("input_sha")) & (F.col("_got") == F.col("_want")) & (F.col("_most") == 1)
    return joined.where(~F.coalesce(fresh, F.lit(False))).select("track_id", "batch_no")


def import_track(checkpoint: DataFrame, cues: DataFrame, external: DataFrame) -> DataFrame:
    """Accept an outside track only where timing is identical and nothing was translated yet."""
    off = parity(cues, external).select("track_id").distinct()
    used = checkpoint.where(F.col("text").isNotNull() | F.col("defer_reason").isNotNull()).select("track_id").distinct()
    return external.join(off, "track_id", "left_anti").join(used, "track_id", "left_anti").select("track_id", "cue_id", "text")


def report_matches(saved: DataFrame, recomputed: DataFrame) -> DataFrame:
    """Rows on one side only, with multiplicity; empty means the report still holds."""
    cols = saved.columns
    gone = saved.exceptAll(recomputed.select(*cols)).withColumn("side", F.lit("only_saved"))
    new = recomputed.select(*cols).exceptAll(saved).withColumn("side", F.lit("only_recomputed"))
    return gone.unionByName(new)


# Fixed kinds of evidence and of flags that must be judged by ear.
EVIDENCE = ["source_text", "scene_context", "original_audio", "model_receipt", "other"]
BY_EAR = ["possible_early_cue", "possible_lingering_cue", "translation_spans_dialogue_gap"]


def timing_evidence_errors(decisions: DataFrame, evidence: DataFrame) -> DataFrame:
    """Timing decisions whose evidence is missing, of unknown kind, changed, or lacks audio.

    `decisions`: track_id, decision_id, kind. `evidence`: track_id, decision_id, kind, sha, current_sha.
    """
    key = ["track_id", "decision_id"]
    facts = evidence.groupBy(*key).agg(
        F.bool_and(F.col("kind").isin(*EVIDENCE)).alias("_known"), F.bool_and(F.col("sha").eqNullSafe(F.col("current_sha"))).alias("_fresh"),
        F.bool_or(F.col("kind") == "original_audio").alias("_audio"))
    joined = decisions.join(facts, key, "left")
    error = (F.when(F.col("_known").isNull(), "no_evidence").when(~F.col("_known"), "unknown_kind").when(~F.col("_fresh"), "changed_evidence")
             .when(F.col("kind").isin(*BY_EAR) & ~F.col("_audio"), "needs_audio"))
    return joined.select(*key, error.alias("error")).where(F.col("error").isNotNull())


def current_rows(rows: DataFrame, current: DataFrame, key: Sequence[str], sha: str = "sha") -> DataFrame:
    return stale(rows, current, key, sha, keep=True)


def stale_tracks(reviewed: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Tracks whose rows differ, as a set, from the reviewed ones; a track in one table only differs too."""
    def version(df, name):
        return df.groupBy("track_id").agg(set_hash(row_hash(*columns)).alias(name))

    joined = version(reviewed, "_r").join(version(current, "_c"), "track_id", "full")
    return joined.where(~F.col("_r").eqNullSafe(F.col("_c"))).select("track_id")
