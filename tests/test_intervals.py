"""Interval operators against literal cases and against plain nested loops."""

import random

from cuelake.operators import intervals as iv
from cuelake.operators import ordered as od

CUE = "track_id long, cue_id long, start_ms long, end_ms long, text string"
SPAN = "track_id long, start_ms long, end_ms long"


def cues(spark, *times, text="words here"):
    return spark.createDataFrame([(1, i + 1, s, e, text) for i, (s, e) in enumerate(times)], CUE)


def spans(spark, *times):
    return spark.createDataFrame([(1, s, e) for s, e in times], SPAN)


def pairs(df):
    return sorted((r.start_ms, r.end_ms) for r in df.collect())


def test_uncovered_speech(spark):
    got = iv.uncovered_speech(spans(spark, (0, 10_000)), cues(spark, (2000, 4000), (6000, 8000)), tolerance_ms=0)
    assert pairs(got) == [(0, 2000), (4000, 6000), (8000, 10_000)]
    assert pairs(iv.uncovered_speech(spans(spark, (0, 10_000)), cues(spark, (90_000, 91_000)))) == [(0, 10_000)]


def test_uncovered_speech_without_any_cue(spark):
    assert pairs(iv.uncovered_speech(spans(spark, (500, 9000)), cues(spark).limit(0) if False else spark.createDataFrame([], CUE))) == [(500, 9000)]


def test_silent_cue_parts(spark):
    got = iv.silent_cue_parts(spans(spark, (2000, 3000), (9000, 10_000)), cues(spark, (0, 10_000))).collect()
    assert [(r.position, r.duration_seconds) for r in got] == [("within", 5.5)]
    silent = iv.silent_cue_parts(spark.createDataFrame([], SPAN), cues(spark, (0, 10_000), text="[Singing]"))
    assert silent.count() == 0


def test_gaps(spark):
    media = spark.createDataFrame([(1, 40_000)], "track_id long, duration_ms long")
    got = iv.gaps(cues(spark, (0, 12_000), (9000, 18_000), (30_000, 32_000)), media).collect()
    assert [(r.previous_cue, r.next_cue, r.start_ms, r.end_ms) for r in got] == [(2, 3, 18_000, 30_000)]


def test_gap_of_media_without_cues(spark):
    media = spark.createDataFrame([(7, 40_000)], "track_id long, duration_ms long")
    got = iv.gaps(cues(spark, (0, 1000)), media).collect()
    assert [(r.track_id, r.previous_cue, r.next_cue, r.start_ms, r.end_ms) for r in got] == [(7, None, None, 0, 40_000)]


def random_spans(seed, n, longest):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randrange(-2000, 300_000)
        out.append((rng.randrange(3), i, start, start + rng.randrange(1, longest)))
    return out


def test_join_equals_nested_loop(spark):
    schema = "track_id long, id long, start_ms long, end_ms long"
    a, b = random_spans(1, 150, 90_000), random_spans(2, 150, 2000)
    left = spark.createDataFrame(a, schema)
    right = spark.createDataFrame(b, "track_id long, rid long, r_start long, r_end long")
    for pad in (0, 500):
        want = sorted((x[1], y[1]) for x in a for y in b if x[0] == y[0] and x[2] < y[3] + pad and x[3] > y[2] - pad)
        got = sorted((r.id, r.rid) for r in iv.interval_join(left, right, ["track_id"], pad=pad).collect())
        assert got == want
    touched = {x[1] for x in a for y in b if x[0] == y[0] and x[2] < y[3] and x[3] > y[2]}
    spans_only = right.selectExpr("track_id", "r_start AS start_ms", "r_end AS end_ms")
    kept = iv.with_partner(left, spans_only, ["track_id"], ["id"]).collect()
    lost = iv.with_partner(left, spans_only, ["track_id"], ["id"], keep=False).collect()
    assert sorted(r.id for r in kept) == sorted(touched)
    assert sorted(r.id for r in lost) == sorted({x[1] for x in a} - touched)


def merge_plain(times):
    out = []
    for start, end in sorted(times):
        if out and start <= out[-1][1]:
            out[-1][1] = max(out[-1][1], end)
        else:
            out.append([start, end])
    return [tuple(x) for x in out]


def test_merge_crosses_chunks(spark, monkeypatch):
    rows = [(s % 2, s, e) for _, _, s, e in random_spans(3, 300, 9000) if s >= 0] + [(0, 10_000, 250_000)]
    df = spark.createDataFrame(rows, SPAN)
    monkeypatch.setattr(od.time_chunk, "__defaults__", (4096,))
    got = sorted((r.track_id, r.start_ms, r.end_ms) for r in iv.merge_intervals(df, ["track_id"]).collect())
    want = sorted((t, s, e) for t in (0, 1) for s, e in merge_plain([(s, e) for k, s, e in rows if k == t]))
    assert got == want


def test_gaps_and_merged_cues_fill_the_media(spark, monkeypatch):
    monkeypatch.setattr(od.time_chunk, "__defaults__", (4096,))
    rows = [(1, i + 1, s, e, "x") for i, (_, _, s, e) in enumerate(sorted(random_spans(4, 60, 3000), key=lambda x: x[2])) if s >= 0]
    media = spark.createDataFrame([(1, 400_000)], "track_id long, duration_ms long")
    table = spark.createDataFrame(rows, CUE)
    free = iv.gaps(table, media, 1).selectExpr("sum(end_ms - start_ms)").collect()[0][0]
    held = iv.union_length(table, ["track_id"]).collect()[0].union_ms
    assert free + held == 400_000


def test_neighbours(spark):
    got = iv.neighbours(spans(spark, (5000, 8000)), cues(spark, (0, 2000), (1000, 5100), (7900, 9000), (9000, 9500))).collect()[0]
    assert (got.previous_cue, got.next_cue) == (2, 3)


def test_active(spark):
    points = spark.createDataFrame([(1, 999), (1, 1000), (1, 2000)], "track_id long, at_ms long")
    got = {r.at_ms: r.active_id for r in iv.active_at(points, cues(spark, (1000, 2000), (1500, 2500)), ["track_id"]).collect()}
    assert got == {999: None, 1000: 1, 2000: 2}


def test_scan_over_many_chunks_equals_python(spark):
    rng = random.Random(5)
    rows = [(k, i, rng.randrange(100)) for k in (1, 2) for i in range(200)]
    df = spark.createDataFrame(rows, "g long, i long, v long")
    got = od.scan(df, ["g"], ["i"], od.id_chunk("i", 7), prev={"p": "v"}, nxt={"n": "v"}, max_before={"m": "v"},
                  max_upto={"u": "v"}, sum_before={"s": "v"}, max_all={"a": "v"}, last={"l": "i"}, number="no", total="t").collect()
    by = {g: [v for k, _, v in rows if k == g] for g in (1, 2)}
    assert len(got) == 400
    for r in got:
        vs, i = by[r.g], r.i
        assert r.p == (vs[i - 1] if i else None) and r.n == (vs[i + 1] if i < 199 else None)
        assert r.m == (max(vs[:i]) if i else None) and r.u == max(vs[:i + 1]) and r.s == sum(vs[:i])
        assert (r.a, r.l, r.no, r.t) == (max(vs), 199, i + 1, 200)


def test_islands_over_many_chunks(spark):
    keys = "aabbbbcaaaaaad"
    df = spark.createDataFrame([(1, i, k) for i, k in enumerate(keys)], "g long, i long, k string")
    got = od.islands(df, ["g"], ["i"], od.id_chunk("i", 3), "k", first={"a": "i"}, last={"z": "i"}).collect()
    assert sorted((r.a, r.z, r.key, r.n_rows) for r in got) == [(0, 1, "a", 2), (2, 5, "b", 4), (6, 6, "c", 1), (7, 12, "a", 6), (13, 13, "d", 1)]
