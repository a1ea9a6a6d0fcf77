from cuelake.operators import linking as lk

CUE = "track_id long, cue_id long, start_ms long, end_ms long, text string"
MEDIA = "track_id long, duration_ms long"


def line(i):
    return f"line number {i} spoken by someone in scene {i * 7}"


def test_offset_of_thirty_anchors(spark):
    a = [(1, i + 1, i * 10_000, i * 10_000 + 2000, line(i)) for i in range(30)]
    b = [(1, i + 1, s + 5000, e + 5000, text) for _, i, s, e, text in a]
    cues, ref = spark.createDataFrame(a, CUE), spark.createDataFrame(b, CUE)
    media = spark.createDataFrame([(1, 310_000)], MEDIA)
    anchors = lk.text_anchors(cues, ref)
    got = lk.offset_checks(anchors, media, part_ms=60_000).collect()[0]
    assert (got.offset_ms, got.matched, got.agreeing, got.accepted) == (5000, 30, 30, True)
    moved = lk.propose_retime(ref, lk.offset_checks(anchors, media, part_ms=60_000), media)
    assert sorted(r.start_ms for r in moved.collect()) == [i * 10_000 for i in range(30)]


def test_drifting_reference_is_rejected(spark):
    a = [(1, i + 1, i * 10_000, i * 10_000 + 2000, line(i)) for i in range(30)]
    b = [(1, i, s + 5000 + (i - 1) // 10 * 2500, e + 5000, text) for _, i, s, e, text in a]
    media = spark.createDataFrame([(1, 310_000)], MEDIA)
    anchors = lk.text_anchors(spark.createDataFrame(a, CUE), spark.createDataFrame(b, CUE))
    assert lk.offset_checks(anchors, media, part_ms=60_000).collect()[0].accepted is False


def test_too_few_anchors(spark):
    rows = [(1, i + 1, i * 1000, i * 1000 + 500, line(i % 2)) for i in range(8)]
    df = spark.createDataFrame(rows, CUE)
    assert lk.estimate_offset(lk.text_anchors(df, df)).count() == 0
    few = spark.createDataFrame([(1, i, i * 1000, 0, line(i)) for i in range(5)], CUE)
    assert lk.estimate_offset(lk.text_anchors(few, few)).collect()[0].offset_ms is None


def version(spark, *rows):
    return spark.createDataFrame([(1, i + 1, s, e, t) for i, (s, e, t) in enumerate(rows)], CUE)


BASE = [(i * 1000, i * 1000 + 900, f"t{i}") for i in range(6)]


def test_rebase_after_editing_the_second_cue(spark):
    edited = list(BASE)
    edited[1] = (1000, 1900, "changed")
    got = lk.rebase(version(spark, *BASE), version(spark, *edited)).collect()
    assert sorted((r.new_id, r.old_id) for r in got) == [(5, 5), (6, 6)]


def test_rebase_after_insert_at_head(spark):
    shifted = [(0, 400, "new")] + [(s + 500, e + 500, t) for s, e, t in BASE]
    got = lk.rebase(version(spark, *BASE), version(spark, *shifted)).collect()
    assert sorted((r.new_id, r.old_id) for r in got) == [(4, 3), (5, 4), (6, 5), (7, 6)]


def test_short_identical_cues_link_by_id_and_time(spark):
    df = version(spark, (1000, 1080, "x"), (5000, 5080, "y"))
    got = sorted((r.translation_id, r.unit_id, r.how) for r in lk.link_tracks(df, df).collect())
    assert got == [(1, 1, "same_cue"), (2, 2, "same_cue")]


def test_carry_ids_reads_each_version_once(spark, tmp_path):
    """What the first stage leaves is kept, so no later stage reads and moves the versions again."""
    old = spark.createDataFrame([(1, 1, 0, 900, "a"), (1, 2, 1000, 1900, "b"), (1, 3, 2000, 2900, "c"), (1, 4, 3000, 3900, "d")], "track_id long, cue_id long, start_ms long, end_ms long, text string")
    new = spark.createDataFrame([(1, 1, 0, 900, "a"), (1, 2, 2000, 2900, "c"), (1, 3, 3000, 3900, "e"), (1, 4, 90000, 90900, "d")], old.schema)
    for name, df in (("old", old), ("new", new)):
        df.write.parquet(f"{tmp_path}/{name}")
    out = lk.carry_ids(spark.read.parquet(f"{tmp_path}/old"), spark.read.parquet(f"{tmp_path}/new"))
    assert sorted((r.new_id, r.old_id, r.stage) for r in out.collect()) == [(1, 1, "same_cue"), (2, 3, "exact_text"), (3, 4, "edges")]
    assert "parquet" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_carry_ids_needs_one_candidate_on_both_sides(spark):
    old = version(spark, (0, 900, "a"), (2000, 2900, "b"), (4000, 4900, "same"), (4300, 5000, "same"), (9000, 9900, "z"))
    new = spark.createDataFrame([(1, 1, 100, 900, "a"), (1, 7, 2400, 3300, "b"), (1, 8, 4050, 4950, "same"), (1, 9, 9100, 9950, "other")], CUE)
    got = {r.new_id: (r.old_id, r.stage) for r in lk.carry_ids(old, new).collect()}
    assert got == {1: (1, "same_cue"), 7: (2, "exact_text"), 8: (3, "edges"), 9: (5, "edges")}


def test_restore_ends(spark):
    installed = version(spark, (0, 8000, "a"), (20_000, 21_000, "b"))
    preserved = version(spark, (0, 16_000, "a"), (20_000, 21_000, "b"))
    draft = version(spark, (0, 8000, "a"), (17_000, 18_000, "new"), (20_000, 21_000, "b"))
    got = [(r.end_ms, r.extended) for r in lk.restore_ends(installed, preserved, draft).orderBy("cue_id").collect()]
    assert got == [(16_000, True), (18_000, False), (21_000, False)]


def test_splice(spark):
    cues = version(spark, (0, 10, "a"), (20, 30, "b"), (40, 50, "c"))
    edits = spark.createDataFrame([(1, 1, 2, 2, None), (1, 2, None, None, 3)], "track_id long, edit_id long, first_id long, last_id long, insert_after long")
    new = spark.createDataFrame([(1, 1, 0, 20, 24, "b1"), (1, 1, 1, 25, 30, " b2 "), (1, 2, 0, 5, 6, "late")],
                                "track_id long, edit_id long, pos int, start_ms long, end_ms long, text string")
    got = [(r.cue_id, r.text, r.out_of_order) for r in lk.splice(cues, edits, new).orderBy("cue_id").collect()]
    assert got == [(1, "a", False), (2, "b1", False), (3, "b2", False), (4, "c", False), (5, "late", True)]


def test_components_of_a_long_chain(spark):
    edges = [(1, i, i + 100) for i in range(1, 60)] + [(1, i + 1, i + 100) for i in range(1, 59)] + [(1, 500, 900), (2, 7, 7), (2, 9, 7)]
    got = lk.components(spark.createDataFrame(edges, "track_id long, item_id long, cue_id long"), "item_id", "cue_id").collect()
    labels = {(r.track_id, r.item_id): r.label for r in got}
    assert {labels[1, i] for i in range(1, 60)} == {1} and labels[1, 500] == 500 and labels[2, 9] == 7


def test_words_compare_across_row_boundaries(spark):
    a = version(spark, (0, 1, "one two"), (1, 2, "three"))
    b = version(spark, (0, 1, "one"), (1, 2, "two\nthree"))
    c = version(spark, (0, 1, "one"), (1, 2, "two four"))
    assert lk.word_mismatches(a, b, ["track_id"], "cue_id").count() == 0
    assert [(r.n_words, r.first_word) for r in lk.word_mismatches(a, c, ["track_id"], "cue_id").collect()] == [(1, 2)]


def test_speech_in_gap(spark):
    obs = spark.createDataFrame([(1, 1, "asr", 1800, 1900), (1, 2, "asr", 600, 700), (1, 3, "saved_review", 3000, 3100)],
                                "track_id long, obs_id long, kind string, start_ms long, end_ms long")
    got = lk.speech_in_gaps(obs, version(spark, (500, 1500, "x"))).collect()
    assert [(r.obs_id, r.kind) for r in got] == [(1, "possible_speech_gap")]


def test_words_differ_by_group(spark):
    a = version(spark, (0, 1, "one two"), (1, 2, " three  one"), (2, 3, " "))
    same = version(spark, (0, 1, "one"), (1, 2, "two\nthree"), (2, 4, "one"))
    for other, n in [(same, 0), (version(spark, (0, 1, "two one three one")), 1), (version(spark, (0, 1, "one two three")), 1), (version(spark, (0, 1, " ")), 1)]:
        assert lk.words_differ(a, other, ["track_id"], "cue_id").count() == n
        assert lk.word_mismatches(a, other, ["track_id"], "cue_id").count() == n
    nothing = version(spark, (0, 1, "\n"))
    assert lk.words_differ(nothing, version(spark, (0, 1, " ")), ["track_id"], "cue_id").count() == 0
    # Each text moves once: the plan shuffles no row per word.
    plan = lk.words_differ(a, same, ["track_id"], "cue_id")._jdf.queryExecution().optimizedPlan().toString()
    assert "word_no" not in plan and plan.count("RepartitionByExpression") == 4


def test_speech_in_gap_across_buckets(spark):
    # Words at, over and beside the border of a minute, of no length, and without a time.
    words = [(1, 59_000, 59_500), (2, 59_900, 60_000), (3, 59_900, 60_100), (4, 60_000, 60_000), (5, 61_000, 181_000), (6, 200_000, 201_000), (7, None, None), (8, -500, 20), (9, 119_990, 120_005)]
    obs = spark.createDataFrame([(1, i, "asr", s, e) for i, s, e in words], "track_id long, obs_id long, kind string, start_ms long, end_ms long")
    cues = [(59_950, 60_050), (120_000, 120_010), (10, 30), (199_000, 200_000)]
    alone = lk.speech_in_gaps(obs, version(spark, *[(s, e, "x") for s, e in cues]))
    free = {i for i, s, e in words if s is None or not any(a < e and b > s for a, b in cues)}
    assert sorted(r.obs_id for r in alone.collect()) == sorted(free) == [1, 6, 7]
    assert alone._jdf.queryExecution().optimizedPlan().toString().count("Join LeftAnti") == 2
