"""Aggregations: track statistics, agreement, usage, completeness, verdicts, gates."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuelake.functions import cps, letter_tokens, norm_text
from cuelake.functions.base import idiv
from cuelake.operators.intervals import covers, interval_join, sums_before
from cuelake.operators.ordered import id_chunk, scan
from cuelake.session import spread

TRACK = ["track_id"]


def issue_counts(issues: DataFrame, by: Sequence[str] = ("kind",), rollup: bool = False) -> DataFrame:
    grouped = issues.rollup(*by) if rollup else issues.groupBy(*by)
    return grouped.agg(F.count(F.lit(1)).alias("n"))


def track_stats(cues: DataFrame) -> DataFrame:
    """Cues under a second, cues over 20 characters a second, adjacent overlaps."""
    slim = cues.select("track_id", "cue_id", "start_ms", "end_ms",
                       F.coalesce(cps("text", "start_ms", "end_ms", " ") > 20, F.lit(False)).alias("fast"))
    paired = scan(slim, TRACK, ["cue_id"], id_chunk("cue_id"), prev={"p_end": "end_ms"})
    length = F.col("end_ms") - F.col("start_ms")
    return paired.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("cues"), F.count_if(length < 1000).alias("under_1s"),
        F.count_if((length > 0) & F.col("fast")).alias("over_20_cps"),
        F.count_if(F.col("p_end") > F.col("start_ms")).alias("overlaps"))


def compare_versions(before: DataFrame, after: DataFrame) -> DataFrame:
    """Track statistics before and after; `regressed` where any count went up."""
    names = ["under_1s", "over_20_cps", "overlaps"]
    left = track_stats(before).select("track_id", *[F.col(n).alias(f"{n}_before") for n in names])
    right = track_stats(after).select("track_id", *[F.col(n).alias(f"{n}_after") for n in names])
    worse = F.lit(False)
    for n in names:
        worse = worse | (F.col(f"{n}_after") > F.col(f"{n}_before"))
    return left.join(right, "track_id").withColumn("regressed", worse)


def version_totals(compared: DataFrame) -> DataFrame:
    names = [n for n in compared.columns if n.endswith(("_before", "_after"))]
    return compared.agg(F.count(F.lit(1)).alias("tracks"), *[F.sum(n).alias(n) for n in names],
                        F.count_if("regressed").alias("regressed"))


def duration_audit(cues: DataFrame, over_ms: int = 8000) -> DataFrame:
    length = F.col("end_ms") - F.col("start_ms")
    return cues.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("cues"), F.count_if(length > over_ms).alias("flagged"),
        F.max(F.when(length > over_ms, length)).alias("worst_ms"))


def long_cues(cues: DataFrame, over_ms: int = 8000) -> DataFrame:
    length = F.col("end_ms") - F.col("start_ms")
    return cues.where(length > over_ms).select("track_id", "cue_id", "start_ms", "end_ms", length.alias("duration_ms"))


def worst(cues: DataFrame, k: int, over_ms: int = 8000) -> DataFrame:
    """The k longest cues of the corpus; a top-k needs no full sort."""
    return long_cues(cues, over_ms).orderBy(F.desc("duration_ms"), "track_id", "cue_id").limit(k)


def reading_profile(cues: DataFrame) -> DataFrame:
    length = F.col("end_ms") - F.col("start_ms")
    fast = cps("text", "start_ms", "end_ms") > 25
    return cues.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("cues"), F.sum(F.size(letter_tokens("text"))).alias("words"),
        F.median(length).alias("median_ms"), F.count_if(length < 1000).alias("under_1s"),
        F.count_if(fast).alias("over_25_cps"),
        F.round(F.count_if(fast) * 100.0 / F.count(F.lit(1)), 1).alias("over_25_percent"))


def top_phrase(cues: DataFrame) -> DataFrame:
    """Most frequent text per track (ties: first in text order), its share, distinct texts.

    Counts combine before the shuffle, so a line repeated a billion times is one row by then.
    """
    counted = cues.groupBy("track_id", "text").agg(F.count(F.lit(1)).alias("_n"))
    best = counted.groupBy("track_id").agg(
        F.sum("_n").alias("cues"), F.count(F.lit(1)).alias("distinct_texts"), F.max("_n").alias("n"),
        F.min_by("text", F.struct(-F.col("_n"), F.col("text"))).alias("phrase"))
    return best.select("track_id", "phrase", "n", "cues", "distinct_texts")


def dominant_line(cues: DataFrame, share: float = 0.5) -> DataFrame:
    """Tracks in which one line makes up at least `share` of the cues."""
    return top_phrase(cues).where(F.col("n") >= F.col("cues") * F.lit(share))


def throughput(runs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Items, seconds, items per second and failures per setting (`items`, `seconds`, `failed`)."""
    return runs.groupBy(*by).agg(
        F.sum("items").alias("items"), F.sum("seconds").alias("seconds"),
        F.count_if("failed").alias("failures")
    ).withColumn("items_per_second", F.round(F.col("items") / F.nullif(F.col("seconds"), F.lit(0)), 3))


# --- text agreement -------------------------------------------------------------------------

def window_words(windows: DataFrame, cues: DataFrame) -> DataFrame:
    """Cue texts that show in each recogniser window, one row per pair."""
    slim = cues.select("track_id", "cue_id", "text", F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    return interval_join(windows.select("track_id", "start_ms", "end_ms"), slim, TRACK)


def window_text(windows: DataFrame, cues: DataFrame) -> DataFrame:
    """Recogniser windows beside the joined text of the cues they touch, in cue order."""
    joined = window_words(windows, cues).groupBy("track_id", F.col("start_ms")).agg(
        F.array_join(F.array_sort(F.collect_list(F.struct("cue_id", "text")))["text"], " ").alias("cue_text"))
    return windows.join(joined, ["track_id", "start_ms"], "left").withColumn(
        "cue_text", F.coalesce("cue_text", F.lit("")))


def _distance(heard: Sequence, written: Sequence) -> int:
    """Edits between two sequences of words or characters. Common ends are cut off; of the rest, one column of the edit
    table at a time is held as two bit sets (where it rises and where it falls), one bit an element."""
    m = min(len(heard), len(written))
    front = next((i for i in range(m) if heard[i] != written[i]), m)
    back = next((i for i in range(m - front) if heard[-1 - i] != written[-1 - i]), m - front)
    a, b = heard[front : len(heard) - back], written[front : len(written) - back]
    if not a or not b:
        return len(a) + len(b)
    places: dict[object, int] = {}
    for i, word in enumerate(a):
        places[word] = places.get(word, 0) | 1 << i
    whole, last = (1 << len(a)) - 1, 1 << (len(a) - 1)
    rise, fall, edits = whole, 0, len(a)
    for word in b:
        equal = places.get(word, 0)
        level = equal | fall
        carry = (((equal & rise) + rise) ^ rise) | equal
        up, down = fall | (whole & ~(carry | rise)), rise & carry
        edits += bool(up & last) - bool(down & last)
        up, down = (up << 1 | 1) & whole, down << 1 & whole
        rise, fall = down | (whole & ~(level | up)), up & level
    return edits


@F.pandas_udf(T.LongType())
def word_edits(heard: pd.Series, written: pd.Series) -> pd.Series:
    """Word edit distance of two token arrays, of any length; memory follows the longer one."""
    return pd.Series([_distance(list(a), list(b)) for a, b in zip(heard, written, strict=True)], dtype="int64")


def word_disagreement(pairs: DataFrame, by: Sequence[str]) -> DataFrame:
    """Word edits over reference words; `pairs` has hypothesis and reference texts per window."""
    hyp = F.filter(F.split(norm_text("hypothesis"), " "), lambda w: w != "")
    ref = F.filter(F.split(norm_text("reference"), " "), lambda w: w != "")
    scored = spread(pairs, *pairs.columns).withColumn("_h", hyp).withColumn("_r", ref).select(
        *by, word_edits("_h", "_r").alias("edits"),
        F.size("_r").cast("bigint").alias("words"))
    return scored.groupBy(*by).agg(F.sum("edits").alias("edits"), F.sum("words").alias("words")).withColumn(
        "disagreement", F.round(F.col("edits") / F.nullif(F.col("words"), F.lit(0)), 4))


# --- alignment ------------------------------------------------------------------------------

def word_span(words: DataFrame, links: DataFrame) -> DataFrame:
    """First start and last end over the timed words of each item's units."""
    timed = words.where(F.col("start_ms").isNotNull() & F.col("end_ms").isNotNull())
    # Reduce words to one row per unit before the bridge join.
    spans = timed.groupBy("track_id", "unit_id").agg(F.min("start_ms").alias("_s"), F.max("end_ms").alias("_e"))
    return links.join(spans, ["track_id", "unit_id"]).groupBy("track_id", "item_id").agg(
        F.min("_s").alias("span_start"), F.max("_e").alias("span_end"))


def align_status(words: DataFrame, units: DataFrame, longest_ms: int = 2000, slack_ms: int = 700) -> DataFrame:
    """failed (no words) > partial (untimed word) > suspicious > aligned, per unit."""
    bounds = units.select("track_id", "unit_id", F.col("start_ms").alias("_us"), F.col("end_ms").alias("_ue"))
    # Extremes decide, so words shrink to one row per unit before the join.
    facts = words.groupBy("track_id", "unit_id").agg(
        F.count(F.lit(1)).alias("n_words"),
        F.count_if(F.col("start_ms").isNull() | F.col("end_ms").isNull()).alias("unaligned"),
        F.max(F.col("end_ms") - F.col("start_ms")).alias("_long"),
        F.min("start_ms").alias("_first"), F.max("end_ms").alias("_last"))
    joined = bounds.join(facts, ["track_id", "unit_id"], "left")
    odd = ((F.col("_long") > longest_ms) | (F.col("_first") < F.col("_us") - slack_ms)
           | (F.col("_last") > F.col("_ue") + slack_ms))
    status = (F.when(F.col("n_words").isNull(), "failed").when(F.col("unaligned") > 0, "partial")
              .when(odd, "suspicious").otherwise("aligned"))
    return joined.select("track_id", "unit_id", F.coalesce("n_words", F.lit(0)).alias("n_words"),
                         F.coalesce("unaligned", F.lit(0)).alias("unaligned"), status.alias("status"))


def display_rows(units: DataFrame, translations: DataFrame, links: DataFrame) -> DataFrame:
    """Display interval of each translation: its own times, else those of its units.

    `translations` may carry NULL times. A translation without units is reported, not dropped.
    """
    spans = links.join(units.select("track_id", "unit_id", "start_ms", "end_ms"), ["track_id", "unit_id"]).groupBy(
        "track_id", "translation_id").agg(F.min("start_ms").alias("_s"), F.max("end_ms").alias("_e"),
                                          F.count(F.lit(1)).alias("n_units"))
    joined = translations.join(spans, ["track_id", "translation_id"], "left")
    return joined.select(
        "track_id", "translation_id", F.coalesce("start_ms", "_s").alias("start_ms"),
        F.coalesce("end_ms", "_e").alias("end_ms"), F.coalesce("n_units", F.lit(0)).alias("n_units"),
        F.when(F.col("n_units").isNull(), "missing_link").when(~F.col("confirmed"), "provisional")
        .otherwise("ready").alias("state"))


# --- usage ----------------------------------------------------------------------------------

def usage_cost(usage: DataFrame, by: Sequence[str], input_rate: str = "0.30", output_rate: str = "1.20",
               overhead: int = 1000) -> DataFrame:
    """Cost from tokens at dollars per million, and an upper bound from prompt bytes. Exact decimals.

    `usage`: by, prompt_tokens, completion_tokens, prompt_bytes, max_tokens.
    """
    rate = lambda value: F.lit(value).cast("decimal(10,2)")
    sums = usage.groupBy(*by).agg(
        F.count(F.lit(1)).alias("calls"), F.sum("prompt_tokens").alias("prompt_tokens"),
        F.sum("completion_tokens").alias("completion_tokens"),
        F.sum(F.col("prompt_bytes") + overhead).alias("_upper_in"), F.sum("max_tokens").alias("_upper_out"))
    dollars = lambda a, b: (
        (F.col(a).cast("decimal(20,0)") * rate(input_rate) + F.col(b).cast("decimal(20,0)") * rate(output_rate))
        / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(24,8)")
    return sums.select(*by, "calls", "prompt_tokens", "completion_tokens",
                       dollars("prompt_tokens", "completion_tokens").alias("cost"),
                       dollars("_upper_in", "_upper_out").alias("upper_cost"))


def reserve_estimate(prompt_bytes: Column, duration_ms: Column, output_tokens: Column,
                     input_rate: Column, output_rate: Column) -> Column:
    """Reservation before a call: one token per byte, 64 a second of audio, 1,000 of overhead."""
    tokens = prompt_bytes + 1000 + F.ceil(duration_ms * 64 / F.lit(1000))
    return ((tokens.cast("decimal(20,0)") * input_rate + output_tokens.cast("decimal(20,0)") * output_rate)
            / F.lit(1_000_000).cast("decimal(7,0)")).cast("decimal(24,8)")


def event_counts(events: DataFrame, kinds: Sequence[str], by: Sequence[str] = ("run_id",)) -> DataFrame:
    """Event counts with zeros for kinds that did not occur; one conditional count per kind."""
    counted = events.groupBy(*by).agg(*[F.count_if(F.col("kind") == kind).alias(f"k{at}") for at, kind in enumerate(kinds)])
    entries = F.explode(F.array(*[F.struct(F.lit(kind).alias("kind"), F.col(f"k{at}").alias("n")) for at, kind in enumerate(kinds)]))
    return counted.select(*by, entries.alias("_e")).select(*by, "_e.kind", "_e.n")


def windows_of(rows: DataFrame, window_ms: int = 300_000) -> DataFrame:
    """Rows numbered into fixed windows by start, in long form with the window bounds."""
    slot = idiv(F.col("start_ms"), window_ms)
    return rows.select("track_id", (slot + 1).alias("window_id"), (slot * window_ms).alias("window_start"),
                       ((slot + 1) * window_ms).alias("window_end"), "cue_id")


def plan_check(rows: DataFrame, caps: DataFrame, by: Sequence[str]) -> DataFrame:
    """Plans against approved limits: unique clip ids, valid intervals, audio time, call count.

    `rows`: by, clip_id, start_ms, end_ms, duration_ms. `caps`: by, max_calls, max_audio_ms.
    """
    bad = (F.col("start_ms") < 0) | (F.col("end_ms") > F.col("duration_ms")) | (F.col("start_ms") >= F.col("end_ms"))
    # Two levels: duplicates show in the first, so no distinct set is built per plan.
    ids = rows.groupBy(*by, "clip_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(F.col("end_ms") - F.col("start_ms")).alias("_ms"), F.count_if(bad).alias("_bad"))
    plans = ids.groupBy(*by).agg(
        F.sum("_n").alias("calls"), F.sum("_ms").alias("audio_ms"), F.sum("_bad").alias("bad_intervals"),
        F.sum(F.col("_n") - 1).alias("duplicate_ids"))
    joined = plans.join(caps, list(by))
    ok = ((F.col("bad_intervals") == 0) & (F.col("duplicate_ids") == 0)
          & (F.col("calls") <= F.col("max_calls")) & (F.col("audio_ms") <= F.col("max_audio_ms")))
    return joined.select(*by, "calls", "audio_ms", "bad_intervals", "duplicate_ids", ok.alias("approved"))


# --- review completeness --------------------------------------------------------------------

def exactly_once(expected: DataFrame, got: DataFrame, key: Sequence[str]) -> DataFrame:
    """Ids that are missing, extra, duplicated or blank; `got` has key and text."""
    key = list(key)
    seen = got.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"),
                                 F.bool_or(F.coalesce(F.trim("text"), F.lit("")) == "").alias("_blank"))
    both = expected.select(*key).distinct().withColumn("_want", F.lit(True)).join(seen, key, "full_outer")
    problem = (F.when(F.col("_n").isNull(), "missing").when(F.col("_want").isNull(), "extra")
               .when(F.col("_n") > 1, "duplicate").when(F.col("_blank"), "blank"))
    return both.select(*key, problem.alias("problem")).where(F.col("problem").isNotNull())


def fill_assessments(expected: DataFrame, got: DataFrame) -> DataFrame:
    """One assessment per source id: omitted or invalid verdicts become `uncertain`.

    `expected`: track_id, source_id, text. `got`: track_id, source_id, verdict,
    source_expression, audio_needed BOOLEAN.
    """
    joined = expected.join(got.withColumn("_got", F.lit(True)), ["track_id", "source_id"], "left")
    known = F.coalesce(F.col("verdict").isin("correct", "material_error", "uncertain"), F.lit(False))
    verdict = F.when(F.col("_got").isNull() | ~known, "uncertain").otherwise(F.col("verdict"))
    unsure = (verdict != "correct") & F.col("audio_needed").isNull()
    note = (F.when(F.col("_got").isNull(), "Model omitted assessment")
            .when(unsure, "Model omitted audio need").when(~known, "Model omitted a valid verdict"))
    return joined.select(
        "track_id", "source_id", F.when(unsure, "uncertain").otherwise(verdict).alias("verdict"),
        F.when(verdict != "correct", F.coalesce("source_expression", "text"))
        .otherwise(F.col("source_expression")).alias("source_expression"), "audio_needed",
        note.alias("schema_uncertainty"))


def verdict_tally(units: DataFrame, assessments: DataFrame) -> DataFrame:
    """Units still to review, and open errors and doubts, per track."""
    joined = units.select("track_id", "unit_id").join(
        assessments.select("track_id", F.col("source_id").alias("unit_id"), "verdict", "settled"), ["track_id", "unit_id"], "left")
    open_finding = ~F.coalesce("settled", F.lit(False))
    return joined.groupBy("track_id").agg(
        F.count(F.lit(1)).alias("units"), F.count_if(F.col("verdict").isNull()).alias("pending"),
        F.count_if((F.col("verdict") == "material_error") & open_finding).alias("material"),
        F.count_if((F.col("verdict") == "uncertain") & open_finding).alias("uncertain"))


def _touching(spans: DataFrame, rows: DataFrame, by: Sequence[str], key: Sequence[str], part: str, *more: str) -> DataFrame:
    """Pairs of a span and a row that overlap: by, key, start_ms, end_ms, `part`, `more`."""
    slim = rows.select(*by, part, *more, F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    return interval_join(spans.select(*by, *key, "start_ms", "end_ms"), slim, by)


def _held(pairs: DataFrame, rows: DataFrame, by: Sequence[str], key: Sequence[str], part: str) -> DataFrame:
    """Do the rows of one `part` together cover each span that they touch? Only touching parts are asked."""
    asked = pairs.select(*by, *key, "start_ms", "end_ms", part).distinct()
    return covers(rows.select(*by, part, "start_ms", "end_ms"), asked, [*by, part], list(key)).select(*by, *key, part, "covered")


def covering(items: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Per recogniser: do its non-blank windows cover each span without a hole?

    `items`: by, model, start_ms, end_ms, text. Returns span key, model, covered for the recognisers
    whose non-blank windows touch the span; any other does not cover it and has no row.
    """
    heard = items.where(F.trim("text") != "")
    return _held(_touching(spans, heard, by, key, "model"), heard, by, key, "model")


def corroborated(obs: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str], at_least: int = 2, one_row: bool = False) -> DataFrame:
    """Spans that two distinct models cover completely, by two distinct receipts or more.

    `obs`: by, model, receipt, start_ms, end_ms. A model's receipts cover a span together; with
    `one_row` (observations of a clip made for the span) each one has to hold it whole.
    """
    pairs = _touching(spans, obs, by, key, "model", "receipt")
    if one_row:
        held = pairs.where((F.col("r_start") <= F.col("start_ms")) & (F.col("r_end") >= F.col("end_ms")))
    else:
        held = pairs.join(_held(pairs, obs, by, key, "model").where("covered"), [*by, *key, "model"], "left_semi")
    found = held.groupBy(*by, *key).agg(F.count_distinct("model").alias("models"), F.count_distinct("receipt").alias("receipts"))
    joined = spans.select(*by, *key).join(found, [*by, *key], "left")
    count = lambda name: F.coalesce(name, F.lit(0)).cast("bigint")
    return joined.select(*by, *key, count("models").alias("models"), count("receipts").alias("receipts"),
                         ((count("models") >= at_least) & (count("receipts") >= at_least)).alias("ok"))


def combine_reviews(reviews: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Overlapping reviews of a span, per stage: model list, review count, cover.

    `reviews`: by, stage, model, start_ms, end_ms. Models per span are a small set. A stage without a
    review that touches the span has no row.
    """
    pairs = _touching(spans, reviews, by, key, "stage", "model")
    listed = pairs.groupBy(*by, "stage", *key).agg(
        F.array_join(F.array_sort(F.collect_set("model")), ", ").alias("models"), F.count(F.lit(1)).alias("reviews"))
    return listed.join(_held(pairs, reviews, by, key, "stage"), [*by, "stage", *key]).select(*by, "stage", *key, "models", "reviews", "covered")


def release_gate(tracks: DataFrame, blockers: Sequence[DataFrame]) -> DataFrame:
    """One row per track: how many blockers of each check, their names, and pass or not.

    Blockers (track_id, check) are counted before they meet; the list holds check names only.
    """
    return gate_of_counts(tracks, [blocker_counts(blockers)])


def blocker_counts(blockers: Sequence[DataFrame]) -> DataFrame:
    """(track_id, check, n): how many blockers of a check a track has."""
    every = reduce(DataFrame.unionByName, [part.select("track_id", "check") for part in blockers])
    return every.groupBy("track_id", "check").agg(F.count(F.lit(1)).alias("n"))


def gate_of_counts(tracks: DataFrame, counts: Sequence[DataFrame]) -> DataFrame:
    """The release gate, of blockers counted in several parts."""
    listed = reduce(DataFrame.unionByName, counts).groupBy("track_id").agg(
        F.sum("n").alias("blockers"), F.array_join(F.array_sort(F.collect_set("check")), ",").alias("checks"))
    return tracks.select("track_id").join(listed, "track_id", "left").select(
        "track_id", F.coalesce("blockers", F.lit(0)).alias("blockers"), F.coalesce("checks", F.lit("")).alias("checks"),
        F.col("blockers").isNull().alias("passed"))


def episode_summary(tracks: DataFrame, parts: dict[str, DataFrame]) -> DataFrame:
    """Row counts of every report per track. One union and one pivoting aggregate, no join chain."""
    every = None
    for name, part in parts.items():
        slim = part.select("track_id", F.lit(name).alias("_part"))
        every = slim if every is None else every.unionByName(slim)
    counted = every.groupBy("track_id").agg(*[F.count_if(F.col("_part") == name).alias(name) for name in parts])
    return tracks.select("track_id").join(counted, "track_id", "left").select(
        "track_id", *[F.coalesce(name, F.lit(0)).alias(name) for name in parts])


def mapped_events(events: DataFrame, frames: DataFrame, clips: DataFrame, per_second: int = 100) -> DataFrame:
    """Clip-relative events on the media clock, with the mean frame confidence inside each.

    `events`: clip_id, event_id, label, first_s, last_s. `frames`: clip_id, frame_no, label, p.
    `clips`: clip_id, track_id, start_ms, end_ms. Means come from running sums at both ends of an
    event, so no event is paired with its frames.
    """
    placed = events.join(clips, "clip_id").select(
        "clip_id", "track_id", "event_id", "label",
        (F.col("start_ms") + F.bround(F.col("first_s") * 1000, 0).cast("bigint")).alias("begin_ms"),
        F.least("end_ms", F.col("start_ms") + F.bround(F.col("last_s") * 1000, 0).cast("bigint")).alias("stop_ms"),
        F.bround(F.col("first_s") * per_second, 0).cast("bigint").alias("f0"),
        F.bround(F.col("last_s") * per_second, 0).cast("bigint").alias("f1"))
    by = ["clip_id", "label"]
    asked = placed.select(*by, "event_id", "f0", "f1").where(F.col("f0") < F.col("f1"))
    # Exact decimals, so that a difference of running sums is the sum in between.
    points = frames.select(*by, F.col("frame_no").alias("at"), F.col("p").cast("decimal(20,15)").alias("p"), F.lit(1).cast("bigint").alias("n")).where(F.col("p").isNotNull())
    ends = asked.select(*by, F.explode(F.array("f0", "f1")).alias("at"))
    sums = sums_before(points, ends, by, ["p", "n"], id_chunk("at"))
    edge = lambda at, name: sums.select(*by, F.col("at").alias(at), F.col("p").alias(f"{name}p"), F.col("n").alias(f"{name}n"))
    both = asked.join(edge("f0", "a"), [*by, "f0"]).join(edge("f1", "b"), [*by, "f1"])
    n = F.col("bn") - F.col("an")
    means = both.select("clip_id", "event_id", F.when(n > 0, (F.col("bp") - F.col("ap")).cast("double") / n).alias("confidence"))
    return placed.where(F.col("begin_ms") < F.col("stop_ms")).join(means, ["clip_id", "event_id"], "left").select(
        "track_id", "clip_id", "event_id", "label", F.col("begin_ms").alias("start_ms"),
        F.col("stop_ms").alias("end_ms"), "confidence")
