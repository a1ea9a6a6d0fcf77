"""Interval core: overlap joins, merging, subtraction, gaps, cover and as-of lookup."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelake.functions import intersects, is_label, round_seconds
from cuelake.functions.base import C, as_col, idiv
from cuelake.functions.times import meaningful as meaningful_cond
from cuelake.functions.times import overlap_ms
from cuelake.operators.ordered import scan, time_chunk

WIDTH_MS = 60_000


def _buckets(start: Column, end: Column, width: int) -> Column:
    first = F.greatest(start, F.lit(0))
    last = F.greatest(end - 1, start, F.lit(0))
    return F.explode(F.sequence(idiv(first, width), idiv(last, width)))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    ls: str = "start_ms",
    le: str = "end_ms",
    rs: str = "r_start",
    re: str = "r_end",
    *,
    pad: int = 0,
    width: int = WIDTH_MS,
    min_overlap: int | None = None,
    meaningful: bool = False,
    how: str = "inner",
) -> DataFrame:
    """Overlap join `l.start < r.end AND l.end > r.start` (right side widened by `pad`).

    Both sides are cut into fixed time buckets, so it is an equi join on (by, bucket). A pair that
    shares several buckets is kept only in the one that holds the later start, which makes every
    pair come out once without a distinct. `how` may be inner or left_semi; with left_semi a left
    row can come out once per bucket it matches in, see `with_partner`.
    """
    by = list(by)
    lo, hi = F.col(rs) - pad, F.col(re) + pad
    a = left.withColumn("_b", _buckets(F.col(ls), F.col(le), width))
    b = right.withColumn("_b", _buckets(lo, hi, width))
    for name in by:
        b = b.withColumnRenamed(name, f"_r_{name}")
    b = b.withColumnRenamed("_b", "_rb")
    cond = F.col("_b") == F.col("_rb")
    for name in by:
        cond = cond & (F.col(name) == F.col(f"_r_{name}"))
    cond = cond & intersects(ls, le, lo, hi)
    cond = cond & (F.col("_b") == idiv(F.greatest(F.col(ls), lo, F.lit(0)), width))
    if min_overlap is not None:
        cond = cond & (overlap_ms(ls, le, lo, hi) >= min_overlap)
    if meaningful:
        cond = cond & meaningful_cond(ls, le, lo, hi)
    joined = a.join(b, cond, how)
    return joined.drop("_b", "_rb", *[f"_r_{name}" for name in by])


def sums_before(rows: DataFrame, asks: DataFrame, by: Sequence[str], values: Sequence[str], chunk: Column) -> DataFrame:
    """For every asked point, the sums of `values` over the rows that lie before it (at < point).

    `rows`: by, at, values. `asks`: by, at. Returns by, at, values. The sum over a range is the
    difference of two points, so long ranges cost no more than short ones and no pair list is built.
    `chunk` bounds the scan, see `ordered`.
    """
    by, values = list(by), list(values)
    kinds = dict(rows.dtypes)
    points = asks.select(*by, "at", *[F.lit(0).cast(kinds[v]).alias(v) for v in values], F.lit(True).alias("_asked")).distinct()
    every = rows.select(*by, "at", *values, F.lit(False).alias("_asked")).unionByName(points)
    # One row per point, summed before the shuffle.
    level = every.groupBy(*by, "at").agg(*[F.sum(v).alias(v) for v in values], F.max("_asked").alias("_asked"))
    ranked = scan(level, by, ["at"], chunk, sum_before={f"_b_{v}": v for v in values})
    return ranked.where("_asked").select(*by, "at", *[F.col(f"_b_{v}").alias(v) for v in values])


def with_partner(
    left: DataFrame,
    right: DataFrame,
    by: Sequence[str],
    key: Sequence[str],
    *,
    keep: bool = True,
    ls: str = "start_ms",
    le: str = "end_ms",
    rs: str = "start_ms",
    re: str = "end_ms",
    **options,
) -> DataFrame:
    """Left rows that overlap some right interval (`keep`) or none at all (`keep=False`).

    Copies on the right collapse before the shuffle, and the semi join stops at the first
    partner, so no pair list is built. `key` names the left row within `by`.
    """
    by, key = list(by), list(key)
    spans = right.select(*by, F.col(rs).alias("_rs"), F.col(re).alias("_re")).distinct()
    slim = left.select(*by, *key, F.col(ls).alias("_ls"), F.col(le).alias("_le"))
    hits = interval_join(slim, spans, by, "_ls", "_le", "_rs", "_re", how="left_semi", **options)
    hits = hits.select(*by, *key).distinct()
    return left.join(hits, [*by, *key], "left_semi" if keep else "left_anti")


def uncovered_cues(left: DataFrame, right: DataFrame, by=("track_id",), key=("cue_id",)) -> DataFrame:
    """Left cues with no meaningful overlap on the right side."""
    return with_partner(left, right, by, key, keep=False, meaningful=True)


def many_to_one(source: DataFrame, target: DataFrame, at_least: int = 3,
                by: Sequence[str] = ("track_id",)) -> DataFrame:
    """Targets that meaningfully overlap `at_least` sources, one row per target and source."""
    by = list(by)
    pairs = interval_join(
        target.select(*by, F.col("cue_id").alias("target_id"), "start_ms", "end_ms"),
        source.select(*by, F.col("cue_id").alias("source_id"),
                      F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end")),
        by, meaningful=True,
    ).select(*by, "target_id", "start_ms", "end_ms", "source_id")
    enough = pairs.groupBy(*by, "target_id").agg(F.count(F.lit(1)).alias("n_sources"))
    return pairs.join(enough.where(F.col("n_sources") >= at_least), [*by, "target_id"])


def merge_intervals(df: DataFrame, by: Sequence[str], start: str = "start_ms",
                    end: str = "end_ms") -> DataFrame:
    """Union of overlapping or touching intervals.

    Equal starts collapse first (a map-side combine), so a time chunk holds at most one row per
    millisecond however many copies the input has.
    """
    by = list(by)
    reduced = df.groupBy(*by, F.col(start).alias("start_ms")).agg(F.max(end).alias("_end"))
    ranked = scan(reduced, by, ["start_ms"], time_chunk("start_ms"),
                  max_before={"_reach": "_end"}, max_all={"_most": "_end"})
    opening = ranked.where(F.col("_reach").isNull() | (F.col("start_ms") > F.col("_reach"))).select(
        *by, "start_ms", "_reach", "_most")
    closed = scan(opening, by, ["start_ms"], time_chunk("start_ms"), nxt={"_stop": "_reach"})
    return closed.select(*by, "start_ms", F.coalesce("_stop", "_most").alias("end_ms"))


def free_spans(cover: DataFrame, bounds: DataFrame, by: Sequence[str], pad: int = 0) -> DataFrame:
    """What the padded cover leaves free inside each group's [lo, hi] bound."""
    by = list(by)
    padded = cover.select(
        *by,
        F.greatest(F.col("start_ms") - pad, F.lit(0)).alias("start_ms"),
        (F.col("end_ms") + pad).alias("end_ms"),
    ).where(F.col("start_ms") < F.col("end_ms"))
    # Where the cover opens anew, what it reached before is the end of the stretch before; each
    # group's last free span begins at the largest end.
    reduced = padded.groupBy(*by, "start_ms").agg(F.max("end_ms").alias("_end"))
    ranked = scan(reduced, by, ["start_ms"], time_chunk("start_ms"), max_before={"_reach": "_end"})
    opening = ranked.where(F.col("_reach").isNull() | (F.col("start_ms") > F.col("_reach"))).select(
        *by, F.col("_reach").alias("_from"), F.col("start_ms").alias("_to"))
    ends = padded.select(*by, "end_ms").unionByName(bounds.select(*by, F.lit(None).cast("bigint").alias("end_ms")))
    tail = ends.groupBy(*by).agg(F.max("end_ms").alias("_from")).select(*by, "_from", F.lit(None).cast("bigint").alias("_to"))
    return opening.unionByName(tail).join(bounds, by).select(
        *by, F.coalesce("_from", "lo").alias("free_start"), F.coalesce("_to", "hi").alias("free_end")).where(
        F.col("free_start") < F.col("free_end"))


def subtract_intervals(spans: DataFrame, cover: DataFrame, by: Sequence[str], pad: int = 0,
                       minimum: int = 1) -> DataFrame:
    """Parts of each span that the padded cover leaves uncovered, at least `minimum` long.

    The cover is turned into its free spans once, then joined: no per-span window, so a single
    very long span is no special case.
    """
    by = list(by)
    bounds = spans.groupBy(*by).agg(F.min("start_ms").alias("lo"), F.max("end_ms").alias("hi"))
    free = free_spans(cover, bounds, by, pad)
    pairs = interval_join(spans, free, by, rs="free_start", re="free_end")
    return (
        pairs.withColumn("piece_start", F.greatest("start_ms", "free_start"))
        .withColumn("piece_end", F.least("end_ms", "free_end"))
        .drop("free_start", "free_end")
        .where(F.col("piece_end") - F.col("piece_start") >= minimum)
    )


def uncovered_speech(speech: DataFrame, cues: DataFrame, by=("track_id",), tolerance_ms: int = 150,
                     minimum_ms: int = 700) -> DataFrame:
    pieces = subtract_intervals(speech.select(*by, "start_ms", "end_ms"), cues, by,
                                tolerance_ms, minimum_ms)
    return pieces.select(*by, F.col("piece_start").alias("start_ms"), F.col("piece_end").alias("end_ms"))


def silent_cue_parts(speech: DataFrame, cues: DataFrame, by=("track_id",), tolerance_ms: int = 250,
                     minimum_ms: int = 3000) -> DataFrame:
    """Long parts of spoken cues without detected voice, and where in the cue they lie."""
    spoken = cues.where(~is_label("text")).select(*by, "cue_id", "start_ms", "end_ms")
    pieces = subtract_intervals(spoken, speech, by, tolerance_ms, minimum_ms)
    at_start = F.col("piece_start") == F.col("start_ms")
    at_end = F.col("piece_end") == F.col("end_ms")
    return pieces.select(
        *by, "cue_id", F.col("piece_start").alias("start_ms"), F.col("piece_end").alias("end_ms"),
        F.when(at_start & at_end, "entire").when(at_end, "after").when(at_start, "before")
        .otherwise("within").alias("position"),
        round_seconds(F.col("piece_end") - F.col("piece_start")).alias("duration_seconds"),
    )


def covers(clips: DataFrame, spans: DataFrame, by: Sequence[str], key: Sequence[str]) -> DataFrame:
    """Flag each span the union of clips covers without a hole."""
    by, key = list(by), list(key)
    holes = subtract_intervals(spans.select(*by, *key, "start_ms", "end_ms"), clips, by)
    holes = holes.select(*by, *key).distinct().withColumn("_hole", F.lit(True))
    return spans.join(holes, [*by, *key], "left").withColumn(
        "covered", F.col("_hole").isNull()).drop("_hole")


def union_length(df: DataFrame, by: Sequence[str]) -> DataFrame:
    return merge_intervals(df, by).groupBy(*by).agg(
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("union_ms"),
        F.count(F.lit(1)).alias("spans"))


def gaps(cues: DataFrame, media: DataFrame, minimum_ms: int = 10_000) -> DataFrame:
    """Cue-free stretches of the media, with the cue that last reached the cover and the next one.

    `media` has (track_id, duration_ms). Cues with one start collapse to the furthest end (first
    cue to reach it) and the lowest id before the scan.
    """
    clamped = cues.join(media, "track_id").select(
        "track_id", "duration_ms", "cue_id", "start_ms",
        F.least("duration_ms", F.greatest(F.col("start_ms"), F.lit(0))).alias("_s"),
        F.least("duration_ms", "end_ms").alias("_e"),
    )
    reach = F.when(F.col("_e") > 0, F.struct(
        F.col("_e").alias("e"), (-F.col("start_ms")).alias("s"), (-F.col("cue_id")).alias("id")))
    starts = clamped.groupBy("track_id", "start_ms").agg(
        F.max(reach).alias("_reach"), F.min("cue_id").alias("next_cue"), F.min("_s").alias("_s"))
    ranked = scan(starts, ["track_id"], ["start_ms"], time_chunk("start_ms"),
                  max_before={"_seen": "_reach"})
    cover = F.coalesce(F.col("_seen.e"), F.lit(0))
    inner = ranked.where(F.col("_s") - cover >= minimum_ms).select(
        "track_id", cover.alias("start_ms"), F.col("_s").alias("end_ms"),
        (-F.col("_seen.id")).alias("previous_cue"), "next_cue")
    final = clamped.groupBy("track_id").agg(F.max(reach).alias("_seen"))
    tail = media.join(final, "track_id", "left").where(
        F.col("duration_ms") - cover >= minimum_ms).select(
        "track_id", cover.alias("start_ms"), F.col("duration_ms").alias("end_ms"),
        (-F.col("_seen.id")).alias("previous_cue"), F.lit(None).cast("bigint").alias("next_cue"))
    return inner.unionByName(tail)


def overlaps(cues: DataFrame, chunk: Column) -> DataFrame:
    """Adjacent cues where the left one ends after the right one starts."""
    paired = scan(cues.select("track_id", "cue_id", "start_ms", "end_ms"), ["track_id"], ["cue_id"],
                  chunk, prev={"left_id": "cue_id", "left_end": "end_ms"})
    return paired.where(F.col("left_end") > F.col("start_ms")).select(
        "track_id", "left_id", F.col("cue_id").alias("right_id"), "start_ms",
        F.least("left_end", "end_ms").alias("end_ms"))


def asof_last(points: DataFrame, values: DataFrame, by: Sequence[str], at: str, value_at: str,
              value_id: str, found: str) -> DataFrame:
    """Add to each point the id of the value with the largest time not after it.

    Ties go to the lowest id. Both sides go through one ordered scan, no range join; values with
    one time collapse first. Points need distinct times per group, as gaps and pieces have.
    """
    by = list(by)
    extra = [name for name in points.columns if name not in by]
    kinds = dict(points.dtypes)
    probes = points.select(*by, F.col(at).alias("_t"), F.lit(1).alias("_side"),
                           F.lit(None).cast("bigint").alias("_id"), *extra)
    known = values.groupBy(*by, F.col(value_at).alias("_t")).agg(
        F.min(value_id).cast("bigint").alias("_id"))
    known = known.select(*by, "_t", F.lit(0).alias("_side"), "_id",
                         *[F.lit(None).cast(kinds[name]).alias(name) for name in extra])
    seen = F.when(F.col("_side") == 0, F.struct("_t", "_id"))
    ranked = scan(known.unionByName(probes), by, ["_t", "_side"], time_chunk("_t"),
                  max_before={"_seen": seen})
    return ranked.where(F.col("_side") == 1).select(*by, *extra, F.col("_seen._id").alias(found))


def neighbours(spans: DataFrame, cues: DataFrame, by=("track_id",), slack_ms: int = 150) -> DataFrame:
    """Last cue ending by the span start and first cue starting from its end, with slack."""
    by = list(by)
    extra = [name for name in spans.columns if name not in by]
    kinds = dict(spans.dtypes)
    # Cue ends and starts (one row per time) and two probes per span on one clock, one scan: the
    # probe for the next cue goes before cues of its own time, the other one behind them.
    none = F.lit(None).cast("bigint")
    ends = F.explode(F.array(F.struct(F.col("end_ms").alias("t"), F.lit(True).alias("ends")), F.struct(F.col("start_ms").alias("t"), F.lit(False).alias("ends"))))
    known = cues.select(*by, F.col("cue_id").cast("bigint").alias("_id"), ends.alias("_c")).groupBy(*by, F.col("_c.t").alias("_t")).agg(
        F.min(F.when(F.col("_c.ends"), F.col("_id"))).alias("_ends"), F.min(F.when(~F.col("_c.ends"), F.col("_id"))).alias("_starts"))
    known = known.select(*by, "_t", F.lit(1).alias("_side"), "_ends", "_starts", *[F.lit(None).cast(kinds[name]).alias(name) for name in extra])
    asked = F.explode(F.array(F.struct((F.col("end_ms") - slack_ms).alias("t"), F.lit(0).alias("side")), F.struct((F.col("start_ms") + slack_ms).alias("t"), F.lit(2).alias("side"))))
    probes = spans.select("*", asked.alias("_p")).select(*by, F.col("_p.t").alias("_t"), F.col("_p.side").alias("_side"), none.alias("_ends"), none.alias("_starts"), *extra)
    ranked = scan(known.unionByName(probes), by, ["_t", "_side"], time_chunk("_t"),
                  max_before={"_before": F.when(F.col("_ends").isNotNull(), F.struct("_t", "_ends"))},
                  min_after={"_after": F.when(F.col("_starts").isNotNull(), F.struct("_t", "_starts"))})
    return ranked.where(F.col("_side") != 1).groupBy(*by, *extra).agg(
        F.max(F.when(F.col("_side") == 2, F.col("_before._ends"))).alias("previous_cue"),
        F.max(F.when(F.col("_side") == 0, F.col("_after._starts"))).alias("next_cue"))


def active_at(points: DataFrame, cues: DataFrame, by: Sequence[str], at: str = "at_ms") -> DataFrame:
    """The first cue showing at each point (half-open), or NULL."""
    by = list(by)
    probes = points.select(*by, at).distinct()
    pairs = interval_join(
        probes.withColumn("_ps", F.col(at)).withColumn("_pe", F.col(at) + 1),
        cues.select(*by, F.col("cue_id").alias("active_id"), F.col("text").alias("active_text"),
                    F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end")),
        by, "_ps", "_pe")
    first = pairs.groupBy(*by, at).agg(
        F.min(F.struct("active_id", "active_text")).alias("_a")
    ).select(*by, at, "_a.active_id", "_a.active_text")
    return points.join(first, [*by, at], "left")


def clip_to_rows(df: DataFrame, row_ms: int, keep: Sequence[C]) -> DataFrame:
    """Cut intervals at fixed row borders."""
    rows = df.withColumn("row_no", _buckets(F.col("start_ms"), F.col("end_ms"), row_ms))
    lo = F.col("row_no") * row_ms
    return rows.select(
        *[as_col(name) for name in keep], "row_no",
        F.greatest(F.col("start_ms"), lo).alias("clip_start"),
        F.least(F.col("end_ms"), lo + row_ms).alias("clip_end"),
    ).where(F.col("clip_end") > F.col("clip_start"))


def window_pack(tracks: DataFrame, window_ms: int = 60_000) -> DataFrame:
    """Review windows in long form: one row per window, role and cue showing in it.

    Rows rather than packed arrays, so a crowded window never becomes one huge record.
    """
    return tracks.withColumn(
        "window_no", _buckets(F.col("start_ms"), F.col("end_ms"), window_ms)
    ).select(
        "track_id", (F.col("window_no") + 1).alias("window_id"), "role", "cue_id",
        "start_ms", "end_ms", "text")
