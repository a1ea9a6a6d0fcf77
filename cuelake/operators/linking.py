"""Two-track operators: reference match, links, stable ids, rebase, clock offset, edits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.functions import is_label, norm_text
from cuelake.functions.base import idiv
from cuelake.operators.intervals import WIDTH_MS, active_at, asof_last, interval_join, with_partner
from cuelake.operators.ordered import id_chunk, scan, time_chunk
from cuelake.session import cut_lineage

TRACK = ["track_id"]


# --- reference track on another clock -------------------------------------------------------

def shifted_reference(ref: DataFrame, offsets: DataFrame, media: DataFrame) -> DataFrame:
    """Spoken reference cues moved onto the media clock and lying at least partly inside it.

    `offsets`: track_id, offset_ms (NULL means no aligned reference, so the track drops out).
    """
    known = offsets.where(F.col("offset_ms").isNotNull()).select("track_id", "offset_ms")
    moved = ref.where(~is_label("text")).join(known, "track_id").join(media, "track_id")
    moved = moved.withColumn("start_ms", F.col("start_ms") - F.col("offset_ms")).withColumn(
        "end_ms", F.col("end_ms") - F.col("offset_ms"))
    return moved.where((F.col("end_ms") > 0) & (F.col("start_ms") < F.col("duration_ms"))).select(
        "track_id", F.col("cue_id").alias("ref_id"), "start_ms", "end_ms", "text")


def reference_only(cues: DataFrame, shifted: DataFrame, pad: int = 500) -> DataFrame:
    """Reference cues with no draft cue within the pad."""
    slim = shifted.select("track_id", "ref_id", "start_ms", "end_ms")
    alone = with_partner(slim, cues, TRACK, ["ref_id"], keep=False, pad=pad)
    return alone.select("track_id", "ref_id", F.greatest(F.col("start_ms"), F.lit(0)).alias("start_ms"), "end_ms")


def reference_pairs(cues: DataFrame, shifted: DataFrame, pad: int = 500) -> DataFrame:
    """Reference cue beside every draft cue within the pad, in long form."""
    near = cues.select("track_id", "cue_id", F.col("text").alias("cue_text"),
                       F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    return interval_join(shifted, near, TRACK, pad=pad)


def text_anchors(a: DataFrame, b: DataFrame, min_length: int = 20, within_ms: int = 60_000) -> DataFrame:
    """Cues whose normalised text is distinctive and occurs once on each side.

    Repeated texts collapse in the map-side part of the count, so a line with a billion copies
    is one row by the time it shuffles.
    """
    def single(df: DataFrame, start: str, cue: str) -> DataFrame:
        keyed = df.select("track_id", "cue_id", "start_ms", norm_text("text").alias("norm"))
        keyed = keyed.where(F.length("norm") >= min_length)
        return keyed.groupBy("track_id", "norm").agg(
            F.count(F.lit(1)).alias("_n"), F.min("start_ms").alias(start), F.min("cue_id").alias(cue)
        ).where(F.col("_n") == 1).drop("_n")

    pairs = single(a, "start_ms", "cue_id").join(single(b, "ref_start", "ref_id"), ["track_id", "norm"])
    delta = F.col("ref_start") - F.col("start_ms")
    return pairs.where(F.abs(delta) <= within_ms).select(
        "track_id", "cue_id", "ref_id", "start_ms", delta.alias("delta_ms"))


def agreeing_anchors(anchors: DataFrame, at_least: int = 8, near_ms: int = 1500) -> DataFrame:
    """Anchors near the densest one-second offset bucket of their track.

    Most frequent bucket first, then the smallest absolute bucket, then the bucket value.
    """
    second = F.bround(F.col("delta_ms") / F.lit(1000.0), 0).cast("bigint")
    counted = anchors.groupBy("track_id", second.alias("_b")).agg(F.count(F.lit(1)).alias("_n"))
    best = counted.groupBy("track_id").agg(
        F.sum("_n").alias("matched"),
        F.max(F.struct("_n", (-F.abs("_b")).alias("_near"), (-F.col("_b")).alias("_low"))).alias("_top"))
    best = best.where(F.col("matched") >= at_least).select(
        "track_id", "matched", (-F.col("_top._low") * 1000).alias("_centre"))
    return anchors.join(best, "track_id").where(
        F.abs(F.col("delta_ms") - F.col("_centre")) <= near_ms).drop("_centre")


def estimate_offset(anchors: DataFrame, at_least: int = 8) -> DataFrame:
    """Clock offset per track, NULL where too few anchors match."""
    agreed = agreeing_anchors(anchors, at_least).groupBy("track_id").agg(
        F.bround(F.median("delta_ms"), 0).cast("bigint").alias("offset_ms"),
        F.count(F.lit(1)).alias("agreeing"))
    total = anchors.groupBy("track_id").agg(F.count(F.lit(1)).alias("matched"))
    return total.join(agreed, "track_id", "left").select(
        "track_id", "offset_ms", "matched", F.coalesce("agreeing", F.lit(0)).alias("agreeing"))


def anchor_spread(anchors: DataFrame, part_ms: int = 1_200_000, at_least: int = 8) -> DataFrame:
    """Median offset per stretch of the video, twenty minutes each by default."""
    return agreeing_anchors(anchors, at_least).groupBy(
        "track_id", idiv(F.col("start_ms"), part_ms).alias("part")).agg(
        F.count(F.lit(1)).alias("matches"),
        F.bround(F.median("delta_ms"), 0).cast("bigint").alias("median_offset_ms"))


def offset_checks(anchors: DataFrame, media: DataFrame, part_ms: int = 1_200_000,
                  min_agreeing: int = 20, max_spread_ms: int = 1000) -> DataFrame:
    """Is the offset spread over all thirds of the media, and steady?"""
    parts = anchor_spread(anchors, part_ms).join(media, "track_id")
    third = F.least(F.lit(2), idiv(F.col("part") * part_ms * 3, F.col("duration_ms")))
    spread = parts.groupBy("track_id").agg(
        F.count_distinct(third).alias("thirds"),
        (F.max("median_offset_ms") - F.min("median_offset_ms")).alias("spread_ms"))
    joined = estimate_offset(anchors).join(spread, "track_id", "left")
    ok = ((F.col("agreeing") >= min_agreeing) & (F.coalesce("thirds", F.lit(0)) == 3)
          & F.coalesce(F.col("spread_ms") <= max_spread_ms, F.lit(False)) & F.col("offset_ms").isNotNull())
    return joined.select("track_id", "offset_ms", "matched", "agreeing",
                         F.coalesce("thirds", F.lit(0)).cast("bigint").alias("thirds"), "spread_ms", ok.alias("accepted"))


def propose_retime(ref: DataFrame, checks: DataFrame, media: DataFrame) -> DataFrame:
    """Shifted copies of accepted references; cues outside the media are dropped."""
    accepted = checks.where("accepted").select("track_id", "offset_ms")
    moved = ref.join(accepted, "track_id").join(media, "track_id").select(
        "track_id", "cue_id", (F.col("start_ms") - F.col("offset_ms")).alias("start_ms"),
        (F.col("end_ms") - F.col("offset_ms")).alias("end_ms"), "text", "duration_ms")
    return moved.where((F.col("start_ms") >= 0) & (F.col("end_ms") <= F.col("duration_ms"))).drop("duration_ms")


# --- links between source units and translations --------------------------------------------

def link_tracks(units: DataFrame, translations: DataFrame, min_overlap: int = 100) -> DataFrame:
    """Provisional links: overlap of 100 ms or more, else same id and same times."""
    a = translations.select("track_id", F.col("cue_id").alias("translation_id"), "start_ms", "end_ms")
    b = units.select("track_id", F.col("cue_id").alias("unit_id"),
                     F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    timed = interval_join(a, b, TRACK, min_overlap=min_overlap)
    alone = with_partner(a, units, TRACK, ["translation_id"], keep=False, min_overlap=min_overlap)
    same = alone.join(
        b, (alone.track_id == b.track_id) & (alone.translation_id == b.unit_id)
        & (alone.start_ms == b.r_start) & (alone.end_ms == b.r_end)
    ).select(alone.track_id, "translation_id", "unit_id")
    out = ["track_id", "translation_id", "unit_id"]
    return timed.select(*out, F.lit("overlap").alias("how")).unionByName(
        same.select(*out, F.lit("same_cue").alias("how")))


def explode_links(translations: DataFrame, units: DataFrame) -> DataFrame:
    """Translations with `source_ids` beside each linked unit; ids without a unit stay visible."""
    rows = translations.select("track_id", "translation_id", F.explode("source_ids").alias("unit_id"))
    return rows.join(units, ["track_id", "unit_id"], "left")


def second_view(units: DataFrame, translations: DataFrame, links: DataFrame) -> DataFrame:
    """Source units beside their joined translations; confirmed only if all links are."""
    linked = links.select("track_id", "translation_id", "unit_id").join(
        translations.select("track_id", "translation_id", "text", "confirmed"), ["track_id", "translation_id"])
    joined = linked.groupBy("track_id", "unit_id").agg(
        F.array_sort(F.collect_list(F.struct("translation_id", "text"))).alias("_t"),
        F.bool_and("confirmed").alias("_c"))
    return units.select("track_id", "unit_id").join(joined, ["track_id", "unit_id"], "left").select(
        "track_id", "unit_id", F.coalesce(F.array_join("_t.text", " / "), F.lit("")).alias("translation"),
        F.greatest(F.size("_t"), F.lit(0)).cast("bigint").alias("n_translations"),
        F.when(F.col("_c"), "confirmed").otherwise("provisional").alias("link_status"))


def link_gaps(units: DataFrame, translations: DataFrame, links: DataFrame) -> DataFrame:
    """Units without a translation and translations without a unit."""
    lonely = units.join(links, ["track_id", "unit_id"], "left_anti").select(
        "track_id", F.lit("missing_english_link").alias("kind"), F.col("unit_id").alias("id"))
    loose = translations.join(links, ["track_id", "translation_id"], "left_anti").select(
        "track_id", F.lit("unlinked_english").alias("kind"), F.col("translation_id").alias("id"))
    return lonely.unionByName(loose)


def parity(a: DataFrame, b: DataFrame) -> DataFrame:
    """Cue ids whose timing differs between two tracks or that one side lacks."""
    left = a.select("track_id", "cue_id", F.col("start_ms").alias("a_start"), F.col("end_ms").alias("a_end"))
    right = b.select("track_id", "cue_id", F.col("start_ms").alias("b_start"), F.col("end_ms").alias("b_end"))
    both = left.join(right, ["track_id", "cue_id"], "full_outer")
    problem = (
        F.when(F.col("b_start").isNull(), "missing").when(F.col("a_start").isNull(), "extra")
        .when((F.col("a_start") != F.col("b_start")) | (F.col("a_end") != F.col("b_end")), "timing"))
    return both.withColumn("problem", problem).where(F.col("problem").isNotNull())


# --- versions of one track ------------------------------------------------------------------

def _unique_near(new: DataFrame, old: DataFrame, by: Sequence[str], start_tol: int,
                 end_tol: int | None = None) -> DataFrame:
    """new_id/old_id pairs whose edges are near and which are the only candidates on both sides.

    Rows that share all compared values collapse to one with a count first, so copies never turn
    into pairs; a collapsed group still counts as several candidates.
    """
    by = list(by)
    edges = ["start_ms"] + (["end_ms"] if end_tol is not None else [])

    def grouped(df: DataFrame, ident: str, tag: str) -> DataFrame:
        return df.groupBy(*by, *edges).agg(
            F.count(F.lit(1)).alias(f"{tag}_n"), F.min(ident).alias(ident))

    n = grouped(new, "new_id", "n").withColumn("_lo", F.col("start_ms") - start_tol).withColumn(
        "_hi", F.col("start_ms") + start_tol + 1)
    if end_tol is not None:
        n = n.withColumnRenamed("end_ms", "_n_end")
    o = grouped(old, "old_id", "o").withColumn("r_start", F.col("start_ms")).withColumn(
        "r_end", F.col("start_ms") + 1)
    if end_tol is not None:
        o = o.withColumnRenamed("end_ms", "_o_end")
    pairs = interval_join(n.drop("start_ms"), o.drop("start_ms"), by, "_lo", "_hi", width=20_000)
    if end_tol is not None:
        pairs = pairs.where(F.abs(F.col("_n_end") - F.col("_o_end")) <= end_tol)
    pairs = pairs.select(*by, "new_id", "old_id", "n_n", "o_n")
    lone_new = pairs.groupBy(*by, "new_id").agg(F.sum("o_n").alias("_c")).where("_c = 1").drop("_c")
    lone_old = pairs.groupBy(*by, "old_id").agg(F.sum("n_n").alias("_c")).where("_c = 1").drop("_c")
    both = pairs.where("n_n = 1 AND o_n = 1").join(lone_new, [*by, "new_id"]).join(lone_old, [*by, "old_id"])
    return both.select("track_id", "new_id", "old_id")


def carry_ids(old: DataFrame, new: DataFrame) -> DataFrame:
    """Stable ids across versions in three stages, each unique on both sides.

    Same cue id and text within ten seconds, else equal text within one second, else both edges
    within 200 ms. A later stage only sees what earlier ones left. Both inputs: track_id, cue_id,
    start_ms, end_ms, text; cue ids are unique per track.
    """
    def keyed(df: DataFrame, ident: str) -> DataFrame:
        short = F.substring(F.unhex(F.sha2("text", 256)), 1, 16)  # 128 bits: a row moves half the bytes of the hex digest
        return df.select("track_id", F.col("cue_id").alias(ident), "start_ms", "end_ms", short.alias("norm"), F.lit(True).alias("here"))

    a, b = keyed(new, "new_id").alias("a"), keyed(old, "old_id").alias("b")
    paired = F.col("a.here") & F.col("b.here")
    alone = lambda name: F.when(~F.coalesce(paired, F.lit(False)), F.coalesce(f"a.{name}", f"b.{name}")).alias(name)
    # One pass splits both versions into matches and what is left of each; each cue moves once.
    met = cut_lineage(a.join(b, [
        F.col("a.track_id") == F.col("b.track_id"), F.col("a.new_id") == F.col("b.old_id"),
        F.col("a.norm") == F.col("b.norm"),
        F.abs(F.col("a.start_ms") - F.col("b.start_ms")) <= 10_000,
    ], "full_outer").select(
        F.coalesce("a.track_id", "b.track_id").alias("track_id"), "new_id", "old_id", alone("start_ms"), alone("end_ms"), alone("norm"),
        F.col("a.here").alias("in_new"), F.col("b.here").alias("in_old")))
    one = met.where("in_new AND in_old").select("track_id", "new_id", "old_id")
    rest_a = met.where("in_old IS NULL").select("track_id", "new_id", "start_ms", "end_ms", "norm")
    rest_b = met.where("in_new IS NULL").select("track_id", "old_id", "start_ms", "end_ms", "norm")
    two = cut_lineage(_unique_near(rest_a, rest_b, ["track_id", "norm"], 1000))
    rest_a = rest_a.join(two, ["track_id", "new_id"], "left_anti")
    rest_b = rest_b.join(two, ["track_id", "old_id"], "left_anti")
    three = _unique_near(rest_a, rest_b, TRACK, 200, 200)
    return (
        one.withColumn("stage", F.lit("same_cue"))
        .unionByName(two.withColumn("stage", F.lit("exact_text")))
        .unionByName(three.withColumn("stage", F.lit("edges"))))


def match_versions(old: DataFrame, new: DataFrame, near_ms: int = 2000) -> DataFrame:
    """Unambiguous new-to-old matches: exact rows first, then unique texts with near edges."""
    def keyed(df: DataFrame, ident: str) -> DataFrame:
        return df.select("track_id", F.col("cue_id").alias(ident), "start_ms", "end_ms",
                         F.sha2("text", 256).alias("norm"))

    a, b = keyed(new, "new_id"), keyed(old, "old_id")
    key = ["track_id", "start_ms", "end_ms", "norm"]
    lone = b.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"), F.min("old_id").alias("old_id")).where("_n = 1")
    first = a.groupBy(*key).agg(F.min("new_id").alias("new_id"))
    exact = cut_lineage(first.join(lone, key).select("track_id", "new_id", "old_id"))

    def single(df: DataFrame, ident: str, tag: str) -> DataFrame:
        left = df.join(exact, ["track_id", ident], "left_anti")
        return left.groupBy("track_id", "norm").agg(
            F.count(F.lit(1)).alias("_n"), F.min(ident).alias(ident),
            F.min("start_ms").alias(f"{tag}_s"), F.min("end_ms").alias(f"{tag}_e"),
        ).where("_n = 1").drop("_n")

    moved = single(a, "new_id", "a").join(single(b, "old_id", "b"), ["track_id", "norm"]).where(
        (F.abs(F.col("a_s") - F.col("b_s")) <= near_ms) & (F.abs(F.col("a_e") - F.col("b_e")) <= near_ms))
    return exact.unionByName(moved.select("track_id", "new_id", "old_id"))


def rebase(old: DataFrame, new: DataFrame, reach: int = 2) -> DataFrame:
    """new_id/old_id pairs whose translation survives a source edit.

    An unmatched new cue, and the cue that follows a removed old one, invalidate themselves and
    two neighbours on each side. New cue ids are dense and in start order.
    """
    matched = cut_lineage(match_versions(old, new))
    fresh = new.join(matched.withColumnRenamed("new_id", "cue_id"), ["track_id", "cue_id"], "left_anti")
    gone = old.join(matched.withColumnRenamed("old_id", "cue_id"), ["track_id", "cue_id"], "left_anti")
    probes = gone.select("track_id", (-F.col("start_ms")).alias("_at")).distinct()
    flipped = new.select("track_id", "cue_id", (-F.col("start_ms")).alias("_from"))
    following = asof_last(probes, flipped, TRACK, "_at", "_from", "cue_id", "hit")
    last = new.groupBy("track_id").agg(F.max("cue_id").alias("n_new"))
    hit = following.join(last, "track_id").select("track_id", F.coalesce("hit", "n_new").alias("cue_id"))
    affected = fresh.select("track_id", "cue_id").unionByName(hit)
    local = affected.select(
        "track_id", F.explode(F.sequence(F.col("cue_id") - reach, F.col("cue_id") + reach)).alias("new_id")).distinct()
    return matched.join(local, ["track_id", "new_id"], "left_anti")


def restore_ends(installed: DataFrame, baseline: DataFrame, draft: DataFrame) -> DataFrame:
    """Give draft cues back a later preserved end when start and words are unchanged.

    Installed and baseline pair by cue id; a (start, text) key must name one installed cue.
    """
    pairs = installed.select("track_id", "cue_id", "start_ms", F.trim("text").alias("_t")).join(
        baseline.select("track_id", "cue_id", F.col("end_ms").alias("prior_end")), ["track_id", "cue_id"])
    prior = pairs.groupBy("track_id", "start_ms", "_t").agg(
        F.count(F.lit(1)).alias("_n"), F.max("prior_end").alias("prior_end"))
    prior = prior.where("_n = 1").drop("_n")
    joined = draft.withColumn("_t", F.trim("text")).join(prior, ["track_id", "start_ms", "_t"], "left")
    end = F.greatest(F.col("end_ms"), F.coalesce("prior_end", "end_ms"))
    return joined.select("track_id", "cue_id", "start_ms", end.alias("end_ms"), "text",
                         (end > F.col("end_ms")).alias("extended"))


# --- edits ----------------------------------------------------------------------------------

def splice(cues: DataFrame, edits: DataFrame, replacements: DataFrame) -> DataFrame:
    """Apply span edits and renumber.

    `edits`: track_id, edit_id, first_id, last_id (replace) or insert_after with first_id NULL.
    Ranges of one track must not overlap. `replacements`: track_id, edit_id, pos, start_ms,
    end_ms, text. Rows out of start order after the edit are flagged, not dropped.
    """
    ranges = edits.where(F.col("first_id").isNotNull()).select(
        "track_id", F.explode(F.sequence("first_id", "last_id")).alias("cue_id"))
    kept = cues.join(ranges, ["track_id", "cue_id"], "left_anti").select(
        "track_id", (F.col("cue_id") * 2).alias("_slot"), F.lit(0).cast("bigint").alias("_pos"),
        "start_ms", "end_ms", "text")
    slot = F.coalesce(F.col("first_id") * 2, F.col("insert_after") * 2 + 1)
    fresh = replacements.join(edits, ["track_id", "edit_id"]).select(
        "track_id", slot.alias("_slot"), F.col("pos").cast("bigint").alias("_pos"), "start_ms", "end_ms",
        F.trim("text").alias("text"))
    both = kept.unionByName(fresh)
    ranked = scan(both, TRACK, ["_slot", "_pos"], id_chunk("_slot"), prev={"_ps": "start_ms"}, number="cue_id")
    return ranked.select("track_id", "cue_id", "start_ms", "end_ms", "text",
                         F.coalesce(F.col("_ps") > F.col("start_ms"), F.lit(False)).alias("out_of_order"))


def insert_pairs(cues: DataFrame, additions: DataFrame, gaps: DataFrame) -> DataFrame:
    """Check cues proposed for a gap: inside it, no overlap after the merge, speech covered.

    `additions`: track_id, gap_id, pos, start_ms, end_ms. `gaps`: track_id, gap_id, start_ms,
    end_ms, speech_start, speech_end. One row per gap.
    """
    key = ["track_id", "gap_id"]
    named = gaps.select(*key, F.col("start_ms").alias("g_start"), F.col("end_ms").alias("g_end"),
                        "speech_start", "speech_end")
    inner = scan(additions.select(*key, "pos", "start_ms", "end_ms"), key, ["start_ms", "pos"],
                 time_chunk("start_ms"), prev={"p_end": "end_ms"})
    shape = inner.groupBy(*key).agg(
        F.min("start_ms").alias("first"), F.max("end_ms").alias("last"),
        F.max(F.col("start_ms") - F.col("p_end")).alias("widest"),
        F.coalesce(F.bool_or(F.col("start_ms") < F.col("p_end")), F.lit(False)).alias("self_overlap"),
        F.bool_or(F.col("start_ms") >= F.col("end_ms")).alias("bad"))
    clash = with_partner(additions.select(*key, "pos", "start_ms", "end_ms"), cues, TRACK, ["gap_id", "pos"])
    clash = clash.select(*key).distinct().withColumn("_clash", F.lit(True))
    joined = named.join(shape, key).join(clash, key, "left")
    inside = ~F.col("bad") & (F.col("g_start") <= F.col("first")) & (F.col("last") <= F.col("g_end"))
    heard = ((F.col("first") <= F.col("speech_start") + 500) & (F.col("last") >= F.col("speech_end") - 500)
             & (F.coalesce("widest", F.lit(0)) <= 1000))
    return joined.select(*key, inside.alias("inside"), heard.alias("speech_covered"),
                         (F.col("_clash").isNotNull() | F.col("self_overlap")).alias("overlaps"))


def unsupported_edits(edits: DataFrame, accepted: DataFrame, words: DataFrame) -> DataFrame:
    """Replacement cues without an accepted word, and accepted words not in the current alignment.

    `edits`: track_id, cue_id, start_ms, end_ms. Words: track_id, cue_id, text, start_ms, end_ms.
    """
    bare = with_partner(edits.select("track_id", "cue_id", "start_ms", "end_ms"), accepted, TRACK,
                        ["cue_id"], keep=False)
    key = ["track_id", "cue_id", "text", "start_ms", "end_ms"]
    foreign = accepted.select(*key).distinct().join(words.select(*key), key, "left_anti")
    return bare.select("track_id", "cue_id", F.lit("no_accepted_word").alias("error")).unionByName(
        foreign.select("track_id", "cue_id", F.lit("word_not_current").alias("error")))


def text_positions(df: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Whitespace words of ordered rows with their position in the whole group.

    Offsets come from a two-level running sum of word counts, so no group is concatenated.
    """
    by = list(by)
    split = F.filter(F.split(F.trim("text"), r"\s+"), lambda word: word != "")
    rows = df.select(*by, order, split.alias("_w"))
    ranked = scan(rows.withColumn("_n", F.size("_w").cast("bigint")), by, [order], id_chunk(order),
                  sum_before={"_at": "_n"})
    return ranked.select(*by, "_at", F.posexplode("_w").alias("_p", "word")).select(
        *by, (F.col("_at") + F.col("_p")).alias("word_no"), "word")


def word_mismatches(a: DataFrame, b: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """Groups whose ordered words differ between two versions, whatever the row boundaries.

    Compared word by word on (group, position): exact, and as parallel as the words are many.
    """
    by = list(by)
    left = text_positions(a, by, order).withColumnRenamed("word", "a_word")
    right = text_positions(b, by, order).withColumnRenamed("word", "b_word")
    both = left.join(right, [*by, "word_no"], "full_outer")
    return both.where(~F.col("a_word").eqNullSafe(F.col("b_word"))).groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_words"), F.min("word_no").alias("first_word"))


def words_differ(a: DataFrame, b: DataFrame, by: Sequence[str], order: str) -> DataFrame:
    """The groups of `word_mismatches` alone. No word is shuffled: each side's texts move once, for
    the offsets, then a group is its number of words and 128 bits of sums of hashes of (word, position).
    """
    by = list(by)

    def digests(df: DataFrame, side: str) -> DataFrame:
        words = F.filter(F.split(F.trim("text"), r"\s+"), lambda word: word != "")
        rows = df.select(*by, order, words.alias("_w")).select(
            *by, order, F.size("_w").cast("bigint").alias("_n"), F.array_join("_w", " ").alias("_t")).where("_n > 0")
        ranked = scan(rows, by, [order], id_chunk(order), sum_before={"_at": "_n"})
        at = F.col("_at") + F.col("_p")
        hashed = ranked.select(*by, "_at", F.posexplode(F.split("_t", " ")).alias("_p", "_x")).select(
            *by, F.xxhash64("_x", at).alias("_h"), F.xxhash64(at, "_x", F.lit(1)).alias("_i"))
        # Halves of the hashes, so that no sum can overflow.
        halves = [half for name in ("_h", "_i") for half in (F.col(name).bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(name, 32))]
        return hashed.groupBy(*by).agg(F.struct(F.count(F.lit(1)), *[F.sum(half) for half in halves]).alias(side))

    both = digests(a, "_a").join(digests(b, "_b"), by, "full_outer")
    return both.where(~F.col("_a").eqNullSafe(F.col("_b"))).select(*by)


def edit_diff(old: DataFrame, new: DataFrame, mode: str, by: Sequence[str] = ("track_id",)) -> DataFrame:
    """Spans that break the promise of their edit.

    `text_only`: times must match row by row and some text must differ. `layout`: words must stay.
    """
    by = list(by)
    if mode == "layout":
        return words_differ(old, new, by, "cue_id").select(*by, F.lit("words_changed").alias("error"))
    a = old.select(*by, "cue_id", "start_ms", "end_ms", F.sha2("text", 256).alias("_a"))
    b = new.select(*by, "cue_id", F.col("start_ms").alias("_s"), F.col("end_ms").alias("_e"),
                   F.sha2("text", 256).alias("_b"))
    both = a.join(b, [*by, "cue_id"], "full_outer")
    same_time = F.coalesce((F.col("start_ms") == F.col("_s")) & (F.col("end_ms") == F.col("_e")), F.lit(False))
    judged = both.groupBy(*by).agg(
        F.bool_and(same_time).alias("_times"), F.bool_or(~F.col("_a").eqNullSafe(F.col("_b"))).alias("_text"))
    error = F.when(~F.col("_times"), "times_changed").when(~F.col("_text"), "nothing_changed")
    return judged.select(*by, error.alias("error")).where(F.col("error").isNotNull())


# --- item/cue graph -------------------------------------------------------------------------

def components(edges: DataFrame, left: str, right: str, by: Sequence[str] = ("track_id",)) -> DataFrame:
    """Connected components of a bipartite graph: the smallest left id reachable from each edge.

    Labels move by minimum over both sides and then jump to the label of their label, so long
    chains need few rounds. Minima combine before the shuffle, so a hub is no hot spot. Each round
    is checkpointed to the shared folder.
    """
    by = list(by)
    state = cut_lineage(edges.select(*by, left, right).distinct().withColumn("label", F.col(left)))
    while True:
        of_left = state.groupBy(*by, left).agg(F.min("label").alias("_l"))
        of_right = state.groupBy(*by, right).agg(F.min("label").alias("_r"))
        low = state.join(of_left, [*by, left]).join(of_right, [*by, right]).withColumn(
            "_m", F.least("_l", "_r"))
        # The label is itself a left node; take over the smallest label that node knows.
        known = of_left.select(*by, F.col(left).alias("_m"), F.col("_l").alias("_up"))
        moved = low.join(known, [*by, "_m"], "left").select(
            *by, left, right, F.least("_m", F.coalesce("_up", "_m")).alias("_new"),
            F.col("label").alias("_old"))
        moved = cut_lineage(moved)
        settled = moved.where(F.col("_new") != F.col("_old")).isEmpty()
        state = moved.select(*by, left, right, F.col("_new").alias("label"))
        if settled:
            break
    return state


def component_text_diff(links: DataFrame, items: DataFrame, cues: DataFrame) -> DataFrame:
    """Components of the item/cue graph whose words differ between items and cues.

    `links`: track_id, item_id, cue_id. Items: track_id, item_id, text. Cues: track_id, cue_id, text.
    """
    state = components(links, "item_id", "cue_id")
    left = state.select("track_id", "item_id", "label").distinct().join(items, ["track_id", "item_id"])
    right = state.select("track_id", "cue_id", "label").distinct().join(cues, ["track_id", "cue_id"])
    return words_differ(
        left.select("track_id", "label", F.col("item_id").alias("ord"), "text"),
        right.select("track_id", "label", F.col("cue_id").alias("ord"), "text"),
        ["track_id", "label"], "ord")


# --- timelines and samples ------------------------------------------------------------------

def timeline(spans: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """Everything that touches each span, from several sources, in long form.

    `spans`: track_id, span_id, start_ms, end_ms. Sources: track_id, id, start_ms, end_ms, text.
    """
    asked = spans.select("track_id", "span_id", "start_ms", "end_ms")
    out = None
    for name, source in sources.items():
        rows = source.select("track_id", F.col("id"), F.col("start_ms").alias("r_start"),
                             F.col("end_ms").alias("r_end"), "text")
        hits = interval_join(asked, rows, TRACK).select(
            "track_id", "span_id", F.lit(name).alias("source"), "id",
            F.col("r_start").alias("start_ms"), F.col("r_end").alias("end_ms"), "text")
        out = hits if out is None else out.unionByName(hits)
    return out


def reconcile_samples(required: DataFrame, reported: DataFrame, cues: DataFrame) -> DataFrame:
    """Required playback points against reported rows.

    `required`: track_id, label, at_ms. `reported`: track_id, label, at_ms, cue_id, text, visible.
    """
    expected = active_at(required, cues, TRACK).select(
        "track_id", "label", "at_ms", F.col("active_id"), F.col("active_text"))
    seen = reported.select("track_id", "label", F.col("at_ms").alias("got_at"), F.col("cue_id").alias("got_id"),
                           F.col("text").alias("got_text"), "visible")
    both = expected.join(seen, ["track_id", "label"], "left")
    error = (
        F.when(F.col("got_at").isNull(), "missing").when(F.col("got_at") != F.col("at_ms"), "wrong_time")
        .when(~F.col("got_id").eqNullSafe(F.col("active_id")), "wrong_cue")
        .when(~F.col("got_text").eqNullSafe(F.col("active_text")), "wrong_text")
        .when(~F.col("visible").eqNullSafe(F.col("active_id").isNotNull()), "wrong_visibility"))
    return both.select("track_id", "label", "at_ms", error.alias("error")).where(F.col("error").isNotNull())


def pending_downloads(listings: DataFrame, manifest: DataFrame, languages: Sequence[str]) -> DataFrame:
    """Listed, not yet saved, in a wanted language; files that complete a pair come first.

    Both inputs: file_id, episode, lang, status (listings: not_downloaded, manifest: saved).
    """
    saved = manifest.where(F.col("status") == "saved").select("file_id", "episode", "lang")
    open_rows = listings.where(
        (F.col("status") == "not_downloaded") & F.col("lang").isin(*languages)
    ).join(saved.select("file_id").distinct(), "file_id", "left_anti")
    # One row per saved (episode, language); a wanted file completes a pair if another one exists.
    langs = saved.where(F.col("lang").isin(*languages)).groupBy("episode").agg(
        F.min("lang").alias("_a"), F.max("lang").alias("_b"))
    flagged = open_rows.join(langs, "episode", "left")
    completes = F.coalesce((F.col("_a") != F.col("lang")) | (F.col("_b") != F.col("lang")), F.lit(False))
    return flagged.select("file_id", "episode", "lang", completes.alias("completes_pair")).orderBy(
        F.desc("completes_pair"), "episode", "lang", "file_id")


def upsert_listings(listings: DataFrame, results: DataFrame) -> DataFrame:
    """Apply download results by file id: a save stays, whatever follows; the error is the last row's."""
    done = F.col("status") == "saved"
    latest = results.groupBy("file_id").agg(
        F.max_by(F.struct("status", "error"), "seq").alias("_r"), F.bool_or(done).alias("_saved"),
        F.max(F.when(done, F.struct("seq", "path"))).alias("_p"))
    joined = listings.join(latest, "file_id", "left")
    saved = F.coalesce("_saved", F.lit(False))
    return joined.select(
        "file_id", F.when(saved, "saved").otherwise(F.col("status")).alias("status"),
        F.when(saved, F.col("_p.path")).otherwise(F.col("path")).alias("path"),
        F.when(F.col("_r.status") == "saved", "").when(F.col("_r").isNotNull(), F.col("_r.error")).otherwise(F.col("last_error")).alias("last_error"))


def speech_in_gaps(observations: DataFrame, cues: DataFrame) -> DataFrame:
    """Recognised speech that no cue overlaps becomes a question."""
    rows = observations.where(F.col("kind") == "asr").select("track_id", "obs_id", "start_ms", "end_ms")
    # Nearly all words lie inside one time bucket: those move once and one anti join settles them.
    bucket = lambda at: idiv(F.greatest(at, F.lit(0)), WIDTH_MS)
    inside = F.coalesce(bucket(F.col("start_ms")) == bucket(F.greatest(F.col("end_ms") - 1, F.col("start_ms"))), F.lit(False))
    spans = cues.select("track_id", F.col("start_ms").alias("_rs"), F.col("end_ms").alias("_re")).distinct()
    alone = interval_join(rows.where(inside), spans, TRACK, rs="_rs", re="_re", how="left_anti").unionByName(
        with_partner(rows.where(~inside), cues, TRACK, ["obs_id"], keep=False))
    return alone.select("track_id", "obs_id", F.lit("possible_speech_gap").alias("kind2"), "start_ms", "end_ms").withColumnRenamed("kind2", "kind")
