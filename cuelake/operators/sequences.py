"""Order-based operators: repetition, validation, batches, samples, ranges, clip assembly."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.functions import midpoint, norm_text
from cuelake.functions.base import idiv
from cuelake.operators.intervals import interval_join
from cuelake.operators.ordered import id_chunk, islands, scan, time_chunk
from cuelake.session import cut_lineage

TRACK = ["track_id"]


def runs(cues: DataFrame, at_least: int = 3, min_length: int = 8, with_text: bool = True) -> DataFrame:
    """Adjacent cues with one normalised text; a run is named by its first and last cue.

    Without the text (`norm`) only its hash and length travel through the scans.
    """
    norm = norm_text("text")
    kept = {"norm": norm} if with_text else {}
    slim = cues.select("track_id", "cue_id", "start_ms", "end_ms", F.unhex(F.sha2(norm, 256)).alias("_sha"), F.length(norm).alias("_length"),
                       *[value.alias(name) for name, value in kept.items()])
    # Neighbours compare by hash, so no text travels in the edge rows of the scan.
    found = islands(slim, TRACK, ["cue_id"], id_chunk("cue_id"), "_sha",
                    first={"first_id": "cue_id", "start_ms": "start_ms", "_length": "_length", **{name: name for name in kept}},
                    last={"last_id": "cue_id", "end_ms": "end_ms"})
    return found.where((F.col("n_rows") >= at_least) & (F.col("_length") >= min_length)).select(
        "track_id", "first_id", "last_id", "start_ms", "end_ms", "n_rows", *kept)


def longest_run(cues: DataFrame) -> DataFrame:
    """Longest stretch of equal raw texts per track."""
    slim = cues.select("track_id", "cue_id", "text")
    found = islands(slim, TRACK, ["cue_id"], id_chunk("cue_id"), "text",
                    first={"first_id": "cue_id"}, last={"last_id": "cue_id"})
    return found.groupBy("track_id").agg(F.max("n_rows").alias("longest"))


def validate(cues: DataFrame, media: DataFrame) -> DataFrame:
    """Cues past the media end, out of start order, or overlapping their predecessor."""
    late = cues.join(media, "track_id").where(F.col("end_ms") > F.col("duration_ms")).select(
        "track_id", "cue_id", F.lit("ends_after_media").alias("error"))
    paired = scan(cues.select("track_id", "cue_id", "start_ms", "end_ms"), TRACK, ["cue_id"],
                  id_chunk("cue_id"), prev={"p_start": "start_ms", "p_end": "end_ms"})
    errors = F.array(
        F.when(F.col("p_start") > F.col("start_ms"), F.lit("out_of_order")),
        F.when(F.col("p_end") > F.col("start_ms"), F.lit("overlap")))
    pairs = paired.select("track_id", "cue_id", F.explode(F.array_compact(errors)).alias("error"))
    return late.unionByName(pairs)


def layout_check(items: DataFrame) -> DataFrame:
    """Items sorted by time that start before the previous one ends.

    The order is by time, so chunks are cut on a rank-free key: equal times share a chunk, and
    ids break ties.
    """
    slim = items.select("track_id", "cue_id", "start_ms", "end_ms")
    ranked = scan(slim, TRACK, ["start_ms", "end_ms", "cue_id"], time_chunk("start_ms"),
                  prev={"p_id": "cue_id", "p_end": "end_ms"})
    return ranked.where(F.col("start_ms") < F.col("p_end")).select(
        "track_id", F.col("p_id").alias("left_id"), F.col("cue_id").alias("right_id"))


def scan_gaps(windows: DataFrame, media: DataFrame) -> DataFrame:
    """Breaks in the tiling of [0, duration) by recogniser windows, and rows at odds with themselves.

    `windows`: track_id, start_ms, end_ms, text, status, issue.
    """
    bounded = windows.join(media, "track_id")
    # A text is blank or not; only that reaches the shuffle.
    slim = bounded.select("track_id", "start_ms", "end_ms", "duration_ms", "status", "issue",
                          (F.trim("text") == "").alias("blank"))
    ranked = scan(slim, TRACK, ["start_ms", "end_ms"], time_chunk("start_ms"),
                  prev={"p_end": "end_ms"}, nxt={"n_start": "start_ms"})
    status = F.col("status")
    broken = (
        (F.coalesce("p_end", F.lit(0)) != F.col("start_ms")) | (F.col("end_ms") <= F.col("start_ms"))
        | (F.col("end_ms") > F.col("duration_ms"))
        | (F.col("n_start").isNull() & (F.col("end_ms") != F.col("duration_ms")))
    )
    odd = (
        ((status == "empty") != F.col("blank"))
        | ((status == "empty") & ~F.coalesce(F.col("issue") == "empty_asr_output", F.lit(False)))
        | ((status == "questionable") & F.col("issue").isNull())
    )
    error = (
        F.when(broken, "missing_or_malformed_interval")
        .when(~status.isin("complete", "questionable", "empty", "failed", "truncated", "unusable"), "unknown_status")
        .when(status.isin("failed", "truncated", "unusable"), "unusable_interval")
        .when(odd, "inconsistent_window")
    )
    errors = ranked.select("track_id", "start_ms", error.alias("error")).where(F.col("error").isNotNull())
    empty = media.join(windows.select("track_id").distinct(), "track_id", "left_anti").select(
        "track_id", F.lit(None).cast("bigint").alias("start_ms"), F.lit("no_windows").alias("error"))
    return errors.unionByName(empty)


def inner_gap(links: DataFrame, over_ms: int = 1000) -> DataFrame:
    """Largest silence between consecutive source units of one translation.

    `links`: track_id, translation_id, unit_id, start_ms, end_ms (times of the unit).
    """
    # Copies of one interval cannot widen a gap, so they collapse first.
    slim = links.select("track_id", "translation_id", "start_ms", "end_ms").distinct()
    ranked = scan(slim, ["track_id", "translation_id"], ["start_ms", "end_ms"],
                  time_chunk("start_ms"), prev={"p_end": "end_ms"})
    gap = ranked.groupBy("track_id", "translation_id").agg(
        F.max(F.col("start_ms") - F.col("p_end")).alias("gap_ms"))
    return gap.where(F.col("gap_ms") > over_ms)


def batches(units: DataFrame, size: int, context: int) -> DataFrame:
    """Fixed-size batches in long form: each row once as target, plus its copies as context."""
    numbered = scan(units.select("track_id", "cue_id"), TRACK, ["cue_id"], id_chunk("cue_id"),
                    number="row_no", total="n_rows")
    at = F.col("row_no") - 1
    first = F.greatest(F.lit(0), F.floor((at - context) / size)).cast("bigint")
    last = F.least(idiv(F.col("n_rows") - 1, size), idiv(at + context, size))
    spread = numbered.withColumn("_b", F.explode(F.sequence(first, last)))
    place = (
        F.when(at < F.col("_b") * size, "previous").when(at >= (F.col("_b") + 1) * size, "next")
        .otherwise("target")
    )
    return spread.select("track_id", (F.col("_b") + 1).alias("batch_no"), "cue_id", place.alias("role"))


def _groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]):
    """Split sorted Arrow batches into (key, columns) groups; a group may span batches."""
    held, held_key = [], None
    for pdf in batches:
        if pdf.empty:
            continue
        changed = (pdf[keys] != pdf[keys].shift()).any(axis=1).to_numpy()
        starts = np.flatnonzero(changed)
        columns = {name: pdf[name].to_numpy() for name in pdf.columns}
        for begin, stop in zip(starts, [*starts[1:], len(pdf)]):
            key = tuple(columns[name][begin] for name in keys)
            part = {name: values[begin:stop] for name, values in columns.items()}
            if held and key != held_key:
                yield held_key, _joined(held)
                held = []
            held.append(part)
            held_key = key
    if held:
        yield held_key, _joined(held)


def _joined(parts: list[dict]) -> dict:
    return parts[0] if len(parts) == 1 else {name: np.concatenate([p[name] for p in parts]) for name in parts[0]}


def _frames(rows: Iterator[dict], columns: Sequence[str], at_least: int = 10_000) -> Iterator[pd.DataFrame]:
    """Gather small column groups into frames worth sending."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[columns[0]])
        if size >= at_least:
            yield pd.DataFrame(_joined(held))[list(columns)]
            held, size = [], 0
    if held:
        yield pd.DataFrame(_joined(held))[list(columns)]


def _entered(table: DataFrame, by: Sequence[str], chunks: int) -> DataFrame:
    """Where a walk from the front of each group enters its chunks, and how many batches lie before.

    `table`: by, _chunk, _entry, _exit (entry row in the next chunk), _made. Each round joins the table
    with itself, so that a row jumps twice as many chunks, and adds as many chunks again to those
    whose entry is known: rounds follow the logarithm of the longest group, and no task sees a group.
    """
    by = list(by)
    known = table.where("_chunk = 0 AND _entry = 0").select(*by, "_chunk", F.col("_entry").alias("_start"), F.lit(0).cast("bigint").alias("_done"))
    jump, step = table, 1
    while step < chunks:
        jump, known = cut_lineage(jump), cut_lineage(known)
        ahead = known.join(jump.withColumnRenamed("_entry", "_start"), [*by, "_chunk", "_start"]).select(
            *by, (F.col("_chunk") + step).alias("_chunk"), F.col("_exit").alias("_start"), (F.col("_done") + F.col("_made")).alias("_done"))
        known = known.unionByName(ahead)
        second = jump.select(*by, (F.col("_chunk") - step).alias("_chunk"), F.col("_entry").alias("_exit"), F.col("_exit").alias("_far"), F.col("_made").alias("_more"))
        jump = jump.join(second, [*by, "_chunk", "_exit"]).select(*by, "_chunk", "_entry", F.col("_far").alias("_exit"), (F.col("_made") + F.col("_more")).alias("_made"))
        step *= 2
    return known


def greedy_batches(
    units: DataFrame,
    by: Sequence[str],
    max_rows: int,
    budget: int,
    *,
    fixed: int = 0,
    context: int = 0,
    context_weight: bool = False,
    chunk_rows: int = 200_000,
) -> DataFrame:
    """Greedy batches: from each start take as many rows as fit `max_rows` and `budget`.

    `units`: by, row_no (1..n dense), weight (bigint). The next start depends on the previous
    one, which looks sequential, but a jump is at most `max_rows` long. So every chunk works out,
    in parallel and for each of its possible entry rows, where a walk would leave it and how many
    batches it makes; the small entry tables are chained by doubling (`_entered`); then chunks number
    their rows in parallel. Chaining takes one small job to learn the number of chunks. With `context_weight` a batch also pays for `context` rows before and
    after it. A row that cannot start a batch gets batch_no NULL; the walk goes on behind it.
    """
    by = list(by)
    keys = [*by, "_chunk"]
    reach = max_rows + context
    size = max(chunk_rows, reach)
    at = F.col("row_no") - 1
    # Rows near a border are also sent to the neighbouring chunk as halo.
    low = F.greatest(F.lit(0), F.floor((at - reach) / size)).cast("bigint")
    high = F.floor((at + context) / size).cast("bigint")
    rows = units.select(*by, F.explode(F.sequence(low, high)).alias("_chunk"), "row_no", "weight")
    kinds = dict(units.dtypes)
    types = ", ".join(f"`{name}` {kinds[name]}" for name in by)

    def in_order(df: DataFrame, part: Sequence[str], *then: str) -> DataFrame:
        # Hashing an expression of the keys keeps this shuffle: one that repeats a join's own
        # partitioning is dropped as redundant, and a skew-split join would then cut groups apart.
        return df.repartition(F.xxhash64(*part)).sortWithinPartitions(*part, *then)

    def jumps(group: dict, chunk: int):
        total = np.concatenate([[0], np.cumsum(group["weight"].astype(np.int64))])
        base, n = int(group["row_no"][0]) - 1, len(group["row_no"])
        begin, stop = chunk * size - base, min((chunk + 1) * size - base, n)
        start = np.arange(begin, max(begin, stop))
        halo = context if context_weight else 0
        paid = total[np.maximum(start - halo, 0)]
        # Furthest row boundary the budget reaches; past the end nothing more is paid for.
        far = np.searchsorted(total, budget - fixed + paid, side="right") - 1
        count = np.where(far >= n, max_rows, far - start - halo)
        return base, begin, stop, np.clip(np.minimum(count, n - start), 0, max_rows).tolist()

    def exits(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def tables():
            for key, group in _groups(frames, keys):
                _, begin, stop, step = jumps(group, int(key[-1]))
                n = stop - begin
                leave, made = [0] * max(n, 0), [0] * max(n, 0)
                for i in range(n - 1, -1, -1):
                    after, new = i + (step[i] or 1), min(1, step[i])
                    if after >= n:
                        leave[i], made[i] = after - n, new
                    else:
                        leave[i], made[i] = leave[after], made[after] + new
                # A group is entered at its first row; later chunks at any of the first max_rows.
                m = max(0, min(1 if key[-1] == 0 else max_rows, n))
                yield {**{name: np.repeat(np.array([key[i]]), m) for i, name in enumerate(keys)},
                       "_entry": np.arange(m), "_exit": np.array(leave[:m], dtype=np.int64), "_made": np.array(made[:m], dtype=np.int64)}

        yield from _frames(tables(), [*keys, "_entry", "_exit", "_made"])

    def number(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def numbered():
            for key, group in _groups(frames, keys):
                base, begin, stop, step = jumps(group, int(key[-1]))
                entry, done = int(group["_start"][0]), int(group["_done"][0])
                n = max(0, stop - begin)
                label = np.zeros(n, dtype=np.int64)
                i = n if entry < 0 else min(entry, n)
                label[:i] = done if entry >= 0 else 0
                while i < n:
                    done += min(1, step[i])
                    label[i:i + step[i]] = done
                    i += step[i] or 1
                yield {**{name: np.repeat(np.array([key[k]]), n) for k, name in enumerate(by)},
                       "row_no": np.arange(base + begin + 1, base + begin + 1 + n), "batch_no": label}

        yield from _frames(numbered(), [*by, "row_no", "batch_no"])

    table = in_order(rows, keys, "row_no").mapInPandas(exits, f"{types}, _chunk bigint, _entry bigint, _exit bigint, _made bigint")
    chunks = (units.agg(F.max("row_no")).first()[0] or 0) // size + 1
    ready = rows.join(_entered(table, by, chunks), keys)
    out = in_order(ready, keys, "row_no").mapInPandas(number, f"{types}, row_no bigint, batch_no bigint")
    return out.withColumn("batch_no", F.nullif("batch_no", F.lit(0)))


def samples(cues: DataFrame, fractions: Sequence[float] = (0.1, 0.5, 0.9)) -> DataFrame:
    """Cues at fixed fractions of the track, half-even rounded, with the point in their middle."""
    numbered = scan(cues.select("track_id", "cue_id", "start_ms", "end_ms"), TRACK, ["cue_id"],
                    id_chunk("cue_id"), number="row_no", total="n_rows")
    picked = numbered.withColumn("fraction", F.explode(F.array(*[F.lit(f) for f in fractions])))
    place = F.bround((F.col("n_rows") - 1) * F.col("fraction"), 0).cast("bigint") + 1
    return picked.where(F.col("row_no") == place).groupBy("track_id", "cue_id").agg(
        F.min("fraction").alias("fraction"), F.min(midpoint("start_ms", "end_ms")).alias("at_ms"))


def link_order(items: DataFrame, by: Sequence[str] = ("track_id",)) -> DataFrame:
    """Items whose first linked cue lies before the last cue of some earlier item.

    `items`: by, item_no, first_idx, last_idx.
    """
    ranked = scan(items.select(*by, "item_no", "first_idx", "last_idx"), by, ["item_no"],
                  id_chunk("item_no"), max_before={"reached": "last_idx"})
    return ranked.where(F.col("first_idx") < F.col("reached"))


def same_scene(flags: DataFrame, by: Sequence[str], slack_ms: int = 2000) -> DataFrame:
    """Per group: do its intervals, sorted by time, follow one another within the slack?"""
    # Copies of one interval always follow each other, so they collapse to a count first.
    slim = flags.groupBy(*by, "start_ms", "end_ms").agg(F.count(F.lit(1)).alias("_n"))
    ranked = scan(slim, by, ["start_ms", "end_ms"], time_chunk("start_ms"), prev={"p_end": "end_ms"})
    near = F.col("p_end").isNull() | (F.col("start_ms") <= F.col("p_end") + slack_ms)
    return ranked.groupBy(*by).agg(F.bool_and(near).alias("one_scene"), F.sum("_n").alias("n_flags"))


def retime_ok(cues: DataFrame, proposals: DataFrame) -> DataFrame:
    """Check that a proposed interval does not run into the neighbouring cues."""
    around = scan(cues.select("track_id", "cue_id", "start_ms", "end_ms"), TRACK, ["cue_id"],
                  id_chunk("cue_id"), prev={"p_end": "end_ms"}, nxt={"n_start": "start_ms"})
    joined = proposals.join(around.select("track_id", "cue_id", "p_end", "n_start"), ["track_id", "cue_id"])
    clear = (
        (F.col("new_start") < F.col("new_end"))
        & (F.col("p_end").isNull() | (F.col("p_end") <= F.col("new_start")))
        & (F.col("n_start").isNull() | (F.col("new_end") <= F.col("n_start")))
    )
    return joined.withColumn("ok", clear).drop("p_end", "n_start")


def clip_ranges(media: DataFrame, core_ms: int = 300_000, overlap_ms: int = 5_000) -> DataFrame:
    """Cores that tile the media, each with audio reaching into its neighbours."""
    core = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("duration_ms") - 1, F.lit(core_ms).cast("bigint")))
    return media.where(F.col("duration_ms") > 0).select("track_id", "duration_ms", core.alias("core_start_ms")).select(
        "track_id", (idiv(F.col("core_start_ms"), core_ms) + 1).alias("clip_no"),
        F.greatest(F.lit(0), F.col("core_start_ms") - overlap_ms).alias("offset_ms"), "core_start_ms",
        F.least("duration_ms", F.col("core_start_ms") + core_ms).alias("core_end_ms"),
        F.least("duration_ms", F.col("core_start_ms") + core_ms + overlap_ms).alias("audio_end_ms"))


def review_windows(issues: DataFrame, media: DataFrame, context_ms: int, length_ms: int = 50_000,
                   overlap_ms: int = 2_000) -> DataFrame:
    """Overlapping review clips over each disputed interval plus context."""
    step = length_ms - overlap_ms
    bounded = issues.join(media, "track_id").select(
        "track_id", "issue_id",
        F.greatest(F.lit(0), F.col("start_ms") - context_ms).alias("_lo"),
        F.least("duration_ms", F.col("end_ms") + context_ms).alias("_hi"))
    # The last window is the first to reach the end.
    count = F.greatest(F.lit(0), F.call_function("div", F.col("_hi") - F.col("_lo") - overlap_ms - 1, F.lit(step)))
    spread = bounded.where(F.col("_lo") < F.col("_hi")).withColumn(
        "_k", F.explode(F.sequence(F.lit(0).cast("bigint"), count)))
    start = F.col("_lo") + F.col("_k") * step
    return spread.select("track_id", "issue_id", start.alias("start_ms"),
                         F.least(start + length_ms, F.col("_hi")).alias("end_ms"))


def scan_windows(media: DataFrame, window_ms: int = 30_000) -> DataFrame:
    start = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("duration_ms") - 1, F.lit(window_ms).cast("bigint")))
    return media.where(F.col("duration_ms") > 0).select("track_id", "duration_ms", start.alias("start_ms")).select(
        "track_id", "start_ms", F.least("duration_ms", F.col("start_ms") + window_ms).alias("end_ms"))


def align_windows(units: DataFrame, media: DataFrame, core_ms: int = 60_000) -> DataFrame:
    """Alignment jobs: units by midpoint core, audio widened to the core and the units."""
    slot = idiv(midpoint("start_ms", "end_ms"), core_ms)
    cores = units.join(media, "track_id").where(midpoint("start_ms", "end_ms") < F.col("duration_ms")).groupBy(
        "track_id", "duration_ms", slot.alias("_k")).agg(
        F.min("start_ms").alias("_lo"), F.max("end_ms").alias("_hi"), F.count(F.lit(1)).alias("n_units"))
    start = F.col("_k") * core_ms
    end = F.least(start + core_ms, F.col("duration_ms"))
    return cores.select(
        "track_id", start.alias("core_start_ms"), end.alias("core_end_ms"),
        F.greatest(F.lit(0), F.least(start - 2000, F.col("_lo") - 500)).alias("audio_start_ms"),
        F.least("duration_ms", F.greatest(end + 2000, F.col("_hi") + 500)).alias("audio_end_ms"), "n_units")


def eval_windows(media: DataFrame, percents: Sequence[int] = (3, 27, 50, 73, 97),
                 length_ms: int = 180_000) -> DataFrame:
    """Fixed-length evaluation windows centred at fixed shares of the media, moved inside it."""
    spread = media.withColumn("percent", F.explode(F.array(*[F.lit(p).cast("bigint") for p in percents])))
    centred = idiv(F.col("duration_ms") * F.col("percent"), 100) - length_ms // 2
    start = F.greatest(F.lit(0), F.least(centred, F.col("duration_ms") - length_ms))
    return spread.select("track_id", "percent", start.alias("start_ms"),
                         F.least(start + length_ms, F.col("duration_ms")).alias("end_ms"))


def boundary_points(decisions: DataFrame, media: DataFrame) -> DataFrame:
    """Distinct points just inside both ends of each resolved repair."""
    inside = decisions.join(media, "track_id").where(
        (F.col("status") == "resolved") & (F.col("start_ms") >= 0)
        & (F.col("start_ms") < F.col("end_ms")) & (F.col("end_ms") <= F.col("duration_ms")))
    offset = F.least(F.lit(100), idiv(F.col("end_ms") - F.col("start_ms"), 4))
    return inside.select("track_id", F.explode(F.array(
        F.col("start_ms") + offset, F.col("end_ms") - offset)).alias("at_ms")).distinct()


def cue_points(cues: DataFrame, media: DataFrame, reach_ms: int = 250) -> DataFrame:
    """Points before, during and after each cue that lie inside the media."""
    spots = F.explode(F.array(
        F.struct(F.lit("before").alias("label"), (F.col("start_ms") - reach_ms).alias("at_ms")),
        F.struct(F.lit("during").alias("label"), midpoint("start_ms", "end_ms").alias("at_ms")),
        F.struct(F.lit("after").alias("label"), (F.col("end_ms") + reach_ms).alias("at_ms"))))
    return cues.join(media, "track_id").select("track_id", "cue_id", "duration_ms", spots.alias("_p")).where(
        (F.col("_p.at_ms") >= 0) & (F.col("_p.at_ms") < F.col("duration_ms"))).select(
        "track_id", "cue_id", "_p.label", "_p.at_ms")


def shift_cues(cues: DataFrame, clips: DataFrame) -> DataFrame:
    """Clip-relative cues on the media clock; a clip without cues is silence."""
    return cues.join(clips.select("track_id", "clip_no", "offset_ms"), ["track_id", "clip_no"]).select(
        "track_id", "clip_no", "cue_id", (F.col("start_ms") + F.col("offset_ms")).alias("start_ms"),
        (F.col("end_ms") + F.col("offset_ms")).alias("end_ms"), "text")


def assemble(cues: DataFrame, clips: DataFrame, mode: str = "core") -> DataFrame:
    """One track from overlapping clips (cues already on the media clock).

    `core`: one owner per cue by midpoint. `touch`: every clip whose core the cue touches.
    `cross`: the owner, plus cues that cross an edge of the core.
    """
    own = cues.join(clips.select("track_id", "clip_no", "core_start_ms", "core_end_ms"), ["track_id", "clip_no"])
    mid = midpoint("start_ms", "end_ms")
    lo, hi = F.col("core_start_ms"), F.col("core_end_ms")
    owner = (lo <= mid) & (mid < hi)
    rule = {
        "core": owner,
        "touch": (F.col("start_ms") < hi) & (F.col("end_ms") > lo),
        "cross": owner | ((F.col("start_ms") < lo) & (lo < F.col("end_ms")))
        | ((F.col("start_ms") < hi) & (hi < F.col("end_ms"))),
    }[mode]
    return own.where(rule).select(*cues.columns)


def replace_chunks(original: DataFrame, fresh: DataFrame, chunks: DataFrame, core_ms: int = 300_000) -> DataFrame:
    """Swap the cues of selected chunks for freshly recognised ones; keep the rest."""
    slot = idiv(midpoint("start_ms", "end_ms"), core_ms)
    kept = original.withColumn("chunk_no", slot).join(chunks, ["track_id", "chunk_no"], "left_anti")
    lo, hi = F.col("chunk_no") * core_ms, (F.col("chunk_no") + 1) * core_ms
    new = fresh.join(chunks, ["track_id", "chunk_no"]).where(
        (slot == F.col("chunk_no")) | ((F.col("start_ms") < lo) & (lo < F.col("end_ms")))
        | ((F.col("start_ms") < hi) & (hi < F.col("end_ms"))))
    cols = ["track_id", "start_ms", "end_ms", "text"]
    return kept.select(*cols, F.lit("kept").alias("origin")).unionByName(
        new.select(*cols, F.lit("fresh").alias("origin")))


def seam_views(cues: DataFrame, clips: DataFrame, padding_ms: int = 10_000) -> DataFrame:
    """Cues of both clips around each seam, one row per seam, side and cue."""
    # A seam sits where a core ends and the next begins: an equi join on clip numbers.
    left = clips.select("track_id", "clip_no", F.col("core_end_ms").alias("boundary_ms"))
    right = clips.select("track_id", (F.col("clip_no") - 1).alias("clip_no"))
    seams = left.join(right, ["track_id", "clip_no"]).select(
        "track_id", "boundary_ms", F.explode(F.array(
            F.struct(F.lit("left").alias("side"), F.col("clip_no").alias("clip_no")),
            F.struct(F.lit("right").alias("side"), (F.col("clip_no") + 1).alias("clip_no")))).alias("_s"),
    ).select("track_id", "boundary_ms", "_s.side", "_s.clip_no",
             F.greatest(F.lit(0), F.col("boundary_ms") - padding_ms).alias("review_start_ms"),
             (F.col("boundary_ms") + padding_ms).alias("review_end_ms"))
    return cues.join(seams, ["track_id", "clip_no"]).where(
        (F.col("start_ms") < F.col("review_end_ms")) & (F.col("end_ms") > F.col("review_start_ms")))


def loop_priority(found: DataFrame, at_least: int = 100) -> DataFrame:
    """Tracks by total time of runs of `at_least` cues or more, worst first."""
    return found.where(F.col("n_rows") >= at_least).groupBy("track_id").agg(
        F.sum(F.col("end_ms") - F.col("start_ms")).alias("loop_ms")).orderBy(F.desc("loop_ms"), "track_id")


def chunks_for_runs(found: DataFrame, at_least: int = 100, core_ms: int = 300_000) -> DataFrame:
    """Chunks a long run touches."""
    return found.where(F.col("n_rows") >= at_least).select(
        "track_id", F.explode(F.sequence(idiv(F.col("start_ms"), core_ms), idiv(F.col("end_ms"), core_ms))).alias("chunk_no")
    ).distinct()


def seam_duplicates(cues: DataFrame, clips: DataFrame, padding_ms: int = 10_000) -> DataFrame:
    """Pairs of overlapping cues with one text on the two sides of a seam."""
    views = seam_views(cues, clips, padding_ms).withColumn("norm", norm_text("text"))
    left = views.where(F.col("side") == "left").select(
        "track_id", "boundary_ms", "norm", F.col("cue_id").alias("left_id"), "start_ms", "end_ms")
    right = views.where(F.col("side") == "right").select(
        "track_id", "boundary_ms", "norm", F.col("cue_id").alias("right_id"),
        F.col("start_ms").alias("r_start"), F.col("end_ms").alias("r_end"))
    return interval_join(left, right, ["track_id", "boundary_ms", "norm"]).select(
        "track_id", "boundary_ms", "left_id", "right_id")
