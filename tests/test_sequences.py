import json
import random

from cuelake.operators import sequences as sq

CUE = "track_id long, cue_id long, start_ms long, end_ms long, text string"


def test_longest_run(spark):
    df = spark.createDataFrame([(1, 1, 0, 1, "a"), (1, 2, 1, 2, "a"), (1, 3, 2, 3, "b")], CUE)
    assert sq.longest_run(df).collect()[0].longest == 2


def test_chunks_for_runs(spark):
    df = spark.createDataFrame([(1, 299_000, 601_000, 100)], "track_id long, start_ms long, end_ms long, n_rows long")
    assert sorted(r.chunk_no for r in sq.chunks_for_runs(df).collect()) == [0, 1, 2]


def test_clip_ranges(spark):
    media = spark.createDataFrame([(1, 71_000)], "track_id long, duration_ms long")
    rows = sq.clip_ranges(media, 30_000, 2000).orderBy("clip_no").collect()
    assert [r.offset_ms for r in rows] == [0, 28_000, 58_000]
    assert [r.audio_end_ms for r in rows] == [32_000, 62_000, 71_000]


def test_review_windows(spark):
    media = spark.createDataFrame([(1, 500_000)], "track_id long, duration_ms long")
    for end in (100_000, 50_000, 49_999, 50_001, 98_000, 98_001, 1):
        issues = spark.createDataFrame([(1, "x", 0, end)], "track_id long, issue_id string, start_ms long, end_ms long")
        got = [(r.start_ms, r.end_ms) for r in sq.review_windows(issues, media, 0).orderBy("start_ms").collect()]
        want, at = [], 0
        while True:
            want.append((at, min(at + 50_000, end)))
            if want[-1][1] == end:
                break
            at = want[-1][1] - 2000
        assert got == want


def test_align_window(spark):
    media = spark.createDataFrame([(1, 120_000)], "track_id long, duration_ms long")
    units = spark.createDataFrame([(1, 1, 59_500, 60_500, "x")], CUE)
    r = sq.align_windows(units, media).collect()
    assert [(x.core_start_ms, x.core_end_ms, x.audio_start_ms, x.audio_end_ms) for x in r] == [(60_000, 120_000, 58_000, 120_000)]


def test_seam_owner(spark):
    clips = spark.createDataFrame([(1, 1, 0, 0, 1000), (1, 2, 800, 1000, 2000)],
                                  "track_id long, clip_no long, offset_ms long, core_start_ms long, core_end_ms long")
    heard = spark.createDataFrame([
        (1, 1, 1, 100, 500, "First."), (1, 1, 2, 880, 1050, "Seam left."), (1, 2, 1, 90, 350, "Seam right."), (1, 2, 2, 500, 900, "Last."),
    ], "track_id long, clip_no long, cue_id long, start_ms long, end_ms long, text string")
    shifted = sq.shift_cues(heard, clips)
    owned = [r.text for r in sq.assemble(shifted, clips, "core").orderBy("start_ms").collect()]
    # 880-1050 has its midpoint in the first core, 890-1150 in the second.
    assert owned == ["First.", "Seam left.", "Seam right.", "Last."]
    sides = {(r.side, r.text) for r in sq.seam_views(shifted, clips, 200).collect()}
    assert sides == {("left", "Seam left."), ("right", "Seam right.")}


def test_boundary_cue_touches_both_cores(spark):
    clips = spark.createDataFrame([(1, 1, 0, 4_500_000, 4_800_000), (1, 2, 0, 4_800_000, 5_100_000)],
                                  "track_id long, clip_no long, offset_ms long, core_start_ms long, core_end_ms long")
    cue = spark.createDataFrame([(1, k, 1, 4_798_420, 4_801_220, "x") for k in (1, 2)],
                                "track_id long, clip_no long, cue_id long, start_ms long, end_ms long, text string")
    assert sq.assemble(cue, clips, "touch").count() == 2
    assert [r.clip_no for r in sq.assemble(cue, clips, "core").collect()] == [1]


def test_context_batches(spark):
    df = spark.createDataFrame([(1, i) for i in range(1, 13)], "track_id long, cue_id long")
    rows = sq.batches(df, 5, 3).collect()
    second = {r.cue_id: r.role for r in rows if r.batch_no == 2}
    assert second == {3: "previous", 4: "previous", 5: "previous", **{i: "target" for i in range(6, 11)}, 11: "next", 12: "next"}
    assert sorted(r.cue_id for r in rows if r.role == "target") == list(range(1, 13))


def walk(weights, max_rows, budget, fixed=0, context=0):
    out, start, number = [None] * len(weights), 0, 0
    while start < len(weights):
        count = min(max_rows, len(weights) - start)
        while count > 0:
            left, right = max(0, start - context), min(len(weights), start + count + context)
            if fixed + sum(weights[left:right]) <= budget:
                break
            count -= 1
        if count == 0:
            start += 1
            continue
        number += 1
        out[start:start + count] = [number] * count
        start += count
    return out


def test_greedy_batches_equal_the_walk(spark):
    rng = random.Random(6)
    rows, want = [], {}
    for track in range(6):
        weights = [rng.randrange(1, 400) for _ in range(rng.randrange(1, 300))]
        if track == 5:
            weights[len(weights) // 2] = 5000
        rows += [(track, i + 1, w) for i, w in enumerate(weights)]
        for name, kw in (("rows", {}), ("context", dict(fixed=50, context=4))):
            want[track, name] = walk(weights, 20, 2000, **kw)
    df = spark.createDataFrame(rows, "track_id long, row_no long, weight long")
    for name, kw in (("rows", {}), ("context", dict(fixed=50, context=4, context_weight=True))):
        # Up to nine chunks a track: four rounds of doubling.
        got = sq.greedy_batches(df, ["track_id"], 20, 2000, chunk_rows=37, **kw).collect()
        assert len(got) == len(rows)
        for track in range(6):
            mine = [r.batch_no for r in sorted(got, key=lambda r: r.row_no) if r.track_id == track]
            assert mine == want[track, name], (track, name)


def test_101_rows_make_100_and_1(spark):
    df = spark.createDataFrame([(1, i, 10) for i in range(1, 102)], "track_id long, row_no long, weight long")
    got = sq.greedy_batches(df, ["track_id"], 100, 5000).groupBy("batch_no").count().collect()
    assert sorted(r["count"] for r in got) == [1, 100]


def test_thirty_rows_within_bytes(spark):
    texts = [f"line {i} " + "x" * (i * 3) for i in range(30)]
    weights = [len(json.dumps({"id": i, "text": t}).encode()) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(1, i + 1, w) for i, w in enumerate(weights)], "track_id long, row_no long, weight long")
    got = sq.greedy_batches(df, ["track_id"], 20, 2000, context=4, context_weight=True).orderBy("row_no").collect()
    assert [r.row_no for r in got] == list(range(1, 31)) and all(r.batch_no for r in got)
    assert [r.batch_no for r in got] == walk(weights, 20, 2000, context=4)


def test_scan_gaps(spark):
    media = spark.createDataFrame([(1, 60_000), (2, 60_000), (3, 1000)], "track_id long, duration_ms long")
    rows = [(1, 0, 30_000, "a", "complete", None), (1, 30_000, 60_000, "", "empty", "empty_asr_output"),
            (2, 0, 30_000, "a", "complete", None), (2, 31_000, 60_000, "b", "questionable", None)]
    df = spark.createDataFrame(rows, "track_id long, start_ms long, end_ms long, text string, status string, issue string")
    got = {(r.track_id, r.start_ms): r.error for r in sq.scan_gaps(df, media).collect()}
    assert got == {(2, 31_000): "missing_or_malformed_interval", (3, None): "no_windows"}


def test_grouping_shuffles_are_kept(spark):
    df = spark.createDataFrame([(1, i, 10) for i in range(1, 102)], "track_id long, row_no long, weight long")
    text = sq.greedy_batches(df, ["track_id"], 100, 5000)._jdf.queryExecution().executedPlan().toString()
    assert text.count("hashpartitioning(xxhash64(") >= 2


def test_runs_without_text_move_none(spark):
    cues = spark.createDataFrame([(1, i, 1000 * i, 1000 * i + 900, "Same line again" if 3 <= i < 8 else f"line {i} alone") for i in range(1, 12)],
                                 "track_id long, cue_id long, start_ms long, end_ms long, text string")
    slim = sq.runs(cues, with_text=False)
    assert [tuple(r) for r in slim.collect()] == [tuple(r)[:-1] for r in sq.runs(cues).collect()] == [(1, 3, 7, 3000, 7900, 5)]
    assert "norm" not in slim._jdf.queryExecution().executedPlan().toString()
