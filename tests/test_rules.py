import itertools
import math
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from cuelake.operators import ledger as lg
from cuelake.operators import measures as ms
from cuelake.operators import rules as rl
from cuelake.operators import scoring as sc
from cuelake.operators import versions as vs

CUE = "track_id long, cue_id long, start_ms long, end_ms long, text string"


def test_layout_flags(spark):
    units = spark.createDataFrame([(1, 1, 0, 3000, "a"), (1, 2, 6000, 9000, "b"), (1, 3, 10_000, 11_000, "c")], "track_id long, unit_id long, start_ms long, end_ms long, text string")
    trans = spark.createDataFrame([(1, 1, 0, 12_000, "ab")], "track_id long, translation_id long, start_ms long, end_ms long, text string")
    links = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "track_id long, translation_id long, unit_id long")
    words = spark.createDataFrame([(1, 1, 1000, 1500), (1, 2, 6500, 7000)], "track_id long, unit_id long, start_ms long, end_ms long")
    stale = spark.createDataFrame([], "track_id long, unit_id long")
    got = {(r.language, r.item_id, r.kind) for r in rl.layout_audit(units, trans, links, words, stale).collect()}
    assert {("english", 1, "possible_early_cue"), ("english", 1, "possible_lingering_cue"), ("english", 1, "translation_spans_dialogue_gap"),
            ("source", 3, "missing_english_link"), ("source", 3, "missing_word_timing")} <= got


def test_stale_and_wordless_units(spark):
    units = spark.createDataFrame([(1, 1, 0, 3000, "a"), (1, 2, 6000, 9000, "b")], "track_id long, unit_id long, start_ms long, end_ms long, text string")
    trans = spark.createDataFrame([], "track_id long, translation_id long, start_ms long, end_ms long, text string")
    links = spark.createDataFrame([], "track_id long, translation_id long, unit_id long")
    words = spark.createDataFrame([(1, 1, 2500, 9900)], "track_id long, unit_id long, start_ms long, end_ms long")
    stale = spark.createDataFrame([(1, 1)], "track_id long, unit_id long")
    got = {(r.item_id, r.kind) for r in rl.layout_audit(units, trans, links, words, stale).collect()}
    assert got == {(1, "stale_alignment"), (1, "missing_word_timing"), (1, "missing_english_link"), (2, "missing_word_timing"), (2, "missing_english_link")}


def test_a_decision_with_an_interval_does_not_speak_for_its_id(spark):
    issues = spark.createDataFrame([(1, "a", "overlap", 0, 10), (1, "b", "overlap", 20, 30), (1, "c", "overlap", 40, 50)], "track_id long, issue_id string, kind string, start_ms long, end_ms long")
    rows = [(1, "a", "overlap", 5, 15, "unresolved", "h", 1), (1, "b", "overlap", None, None, "unresolved", "h", 2), (1, "z", "overlap", 40, 50, "unresolved", "h", 3), (1, "z", "overlap", 40, 50, "reviewed", "h", 4)]
    decisions = spark.createDataFrame(rows, "track_id long, issue_id string, kind string, start_ms long, end_ms long, status string, interval_sha string, seq long")
    assert [r.issue_id for r in rl.unresolved(issues, decisions).collect()] == ["b"]


def test_align_status(spark):
    units = spark.createDataFrame([(1, i, 1000, 2000) for i in range(4)], "track_id long, unit_id long, start_ms long, end_ms long")
    words = spark.createDataFrame([(1, 1, 1000, 1500), (1, 1, None, None), (1, 2, 200, 900), (1, 3, 1000, 1900)], "track_id long, unit_id long, start_ms long, end_ms long")
    assert {r.unit_id: r.status for r in ms.align_status(words, units).collect()} == {0: "failed", 1: "partial", 2: "suspicious", 3: "aligned"}


def test_exactly_once(spark):
    want = spark.createDataFrame([(1,), (2,), (3,)], "cue_id long")
    got = spark.createDataFrame([(1, "a"), (1, "b"), (3, " "), (9, "x")], "cue_id long, text string")
    assert {r.cue_id: r.problem for r in ms.exactly_once(want, got, ["cue_id"]).collect()} == {1: "duplicate", 2: "missing", 3: "blank", 9: "extra"}


def test_display_rows(spark):
    units = spark.createDataFrame([(1, 1, 0, 1000), (1, 2, 2000, 3000)], "track_id long, unit_id long, start_ms long, end_ms long")
    trans = spark.createDataFrame([(1, 1, None, None, True)], "track_id long, translation_id long, start_ms long, end_ms long, confirmed boolean")
    links = spark.createDataFrame([(1, 1, 1), (1, 1, 2)], "track_id long, translation_id long, unit_id long")
    r = ms.display_rows(units, trans, links).collect()
    assert [(x.start_ms, x.end_ms, x.n_units, x.state) for x in r] == [(0, 3000, 2, "ready")]


def test_window_classes(spark):
    cases = [
        ("evet geldim", "geldim", "possible_missing_or_wrong_subtitle"), ("geldim", "geldim", None),
        ("bir iki üç dört", "", "possible_missing_or_wrong_subtitle"), ("bir", "bir iki üç dört beş", "possible_unsupported_subtitle"),
        ("git git git git", "git", "repeated_asr_output"), ("", "bir iki üç", None),
    ]
    df = spark.createDataFrame([(1, i, h, w) for i, (h, w, _) in enumerate(cases)], "track_id long, start_ms long, text string, cue_text string")
    got = {r.start_ms: r.issue for r in sc.classify_window(df).collect()}
    assert got == {i: issue for i, (_, _, issue) in enumerate(cases)}


def test_token_exhaustion(spark):
    df = spark.createDataFrame([(1, "hello", 256, None), (2, "", 3, None), (3, "x", 3, "repeated_asr_output"), (4, "x", 3, None)],
                               "k long, text string, generation_tokens long, issue string")
    assert {r.k: r.status for r in sc.window_status(df, 256).collect()} == {1: "truncated", 2: "empty", 3: "questionable", 4: "complete"}


def test_ctc_equals_all_paths(spark):
    probs = [[0.6, 0.3, 0.1], [0.2, 0.5, 0.3], [0.3, 0.3, 0.4]]
    frames = spark.createDataFrame([(1, i, [math.log(p) for p in row]) for i, row in enumerate(probs)], "clip_id long, frame_no long, log_probs array<double>")
    tokens = [[1], [2], [1, 2], [1, 1], [1, 1, 1]]
    cands = spark.createDataFrame([(1, i, t) for i, t in enumerate(tokens)], "clip_id long, candidate_id long, tokens array<int>")
    got = {r.candidate_id: r.score for r in sc.ctc_scores(frames, cands).collect()}
    for i, want in enumerate(tokens):
        total = 0.0
        for path in itertools.product(range(3), repeat=3):
            squeezed = [k for k, _ in itertools.groupby(path)]
            if [k for k in squeezed if k] == want:
                total += math.prod(probs[f][k] for f, k in enumerate(path))
        assert math.isclose(math.exp(got[i]), total, abs_tol=1e-12)
    assert got[4] == -math.inf


@pytest.mark.parametrize("chunk", [1, 2, 64])
def test_ctc_of_a_long_clip_in_chunks(spark, chunk):
    """A clip of many chunks against the forward table of one candidate; a token out of range has no path."""
    rng = random.Random(5)
    probs = [[rng.random() + 0.1 for _ in range(4)] for _ in range(70)]
    probs = [[p / sum(row) for p in row] for row in probs]
    frames = spark.createDataFrame([(k, i, [math.log(p) for p in row]) for i, row in enumerate(probs) for k in (1, 2) if k == 1 or i < 9], "clip_id long, frame_no long, log_probs array<double>")
    cands = spark.createDataFrame([(1, 0, [1, 2, 2, 3]), (2, 0, [1, 2, 2, 3]), (1, 1, [9]), (1, 2, [])], "clip_id long, candidate_id long, tokens array<int>")
    got = {(r.clip_id, r.candidate_id): (r.score, r.per_frame, r.per_token) for r in sc.ctc_scores(frames, cands, chunk=chunk).collect()}
    for clip, n in ((1, 70), (2, 9)):
        states = [0, 1, 0, 2, 0, 2, 0, 3, 0]
        alpha = [1.0] + [0.0] * 8
        for row in probs[:n]:
            alpha = [(alpha[j] + (alpha[j - 1] if j else 0) + (alpha[j - 2] if j > 1 and states[j] and states[j] != states[j - 2] else 0)) * row[states[j]] for j in range(9)]
        want = math.log(alpha[-1] + alpha[-2])
        assert all(math.isclose(x, y, rel_tol=1e-9) for x, y in zip(got[clip, 0], (want, want / n, want / 4)))
    assert got[1, 1][0] == -math.inf
    assert math.isclose(got[1, 2][0], sum(math.log(row[0]) for row in probs), rel_tol=1e-9) and got[1, 2][2] is None


def edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_word_disagreement(spark):
    rng = random.Random(8)
    pairs = [(1, [rng.choice("abcdefg") for _ in range(rng.randrange(1, 90))], [rng.choice("abcdefg") for _ in range(rng.randrange(1, 90))]) for _ in range(20)]
    df = spark.createDataFrame([(k, " ".join(a), " ".join(b)) for k, a, b in pairs], "k long, hypothesis string, reference string")
    got = ms.word_disagreement(df, ["k"]).collect()[0]
    assert got.edits == sum(edits(a, b) for _, a, b in pairs) and got.words == sum(len(b) for _, _, b in pairs)


def test_word_edits_of_any_length():
    """Short lists against the whole table; long ones, with more distinct words than there are code points, by construction."""
    rng = random.Random(6)
    for _ in range(400):
        words = rng.choice(["ab", "abcdefgh"])
        a, b = ([rng.choice(words) for _ in range(rng.randrange(0, 40))] for _ in range(2))
        assert ms._distance(a, b) == edits(a, b)
    a = [str(i) for i in range(1_200_000)]
    assert ms._distance(a, [*a[:1000], "x", *a[1000:]]) == 1
    assert ms._distance(a, a[:-1]) == 1 and ms._distance([], a) == len(a)
    long = a[:6000]
    assert ms._distance(long, [x + "!" if i % 3 == 0 else x for i, x in enumerate(long)]) == 2000


NAMES = ["Mecnun", "Pakize", "Karabasan", "Ak Sakallı Dede", "Leyla"]
# Fixed cases: old line, new line, accepted or not.
REPAIRS = [
    ("ben de taksideyim", "Ben de taksideyim.", True), ("Akize geldi", "Pakize geldi", True), ("doktor noktor", "doktor doktor", False),
    ("Denekman geldi", "Mecnun geldi", False), ("greve mi gitsek", "grev mi gitsek", False), ("ben de taksideyim", "Eben de taksideyim", False),
    ("Mecnuna dön.", "Mecnun'a dön.", True), ("Karabasandır oğlum o be.", "Karabasan'dır oğlum o be.", True),
    ("Aksakallı dedenin mucizesi.", "Ak Sakallı Dede'nin mucizesi.", True), ("çayrak altınımı takarım", "çeyrek altınımı takarım", False),
    ("Kököteni terk mi ettin?", "Yoksa seni terk mi ettin?", False),
]


def test_repair_gate(spark):
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(REPAIRS)], "edit_id long, old string, new string")
    names = spark.createDataFrame([(n,) for n in NAMES], "name string")
    got = {r.edit_id: r.accepted for r in sc.repair_gate(df, names).collect()}
    assert got == {i: ok for i, (_, _, ok) in enumerate(REPAIRS)}


def test_ledger_equals_the_sequential_rule(spark):
    rng = random.Random(9)
    caps = {"uploads": 6, "calls": 7, "upload_ms": 9000, "call_ms": 12_000, "prompt_bytes": 3000, "charge": "0.5"}
    rows = [(a, i, rng.choice(["call", "upload"]), rng.randrange(1, 4000), rng.randrange(1, 900), rng.randrange(1, 20)) for i in range(200) for a in [rng.choice([1, 1, 1, 2, 3])]]
    df = spark.createDataFrame(rows, "auth_id long, event_id long, kind string, duration_ms long, prompt_bytes long, c long").selectExpr("*", "cast(c / 100 as decimal(18,8)) AS charge")
    limits = spark.createDataFrame([(a, 6, 7, 9000, 12_000, 3000) for a in (1, 2, 3)], "auth_id long, max_uploads long, max_calls long, max_upload_ms long, max_call_ms long, max_prompt_bytes long").selectExpr("*", "cast('0.5' as decimal(18,8)) AS max_charge")
    want, state = {}, {a: [0] * 6 for a in (1, 2, 3)}
    top = [6, 7, 9000, 12_000, 3000, 50]
    for a, i, kind, length, size, c in rows:
        call = kind == "call"
        after = [x + y for x, y in zip(state[a], [not call, call, 0 if call else length, length if call else 0, size if call else 0, c if call else 0])]
        want[i] = all(x <= y for x, y in zip(after, top))
        if want[i]:
            state[a] = after
    got = {r.event_id: r.accepted for r in lg.decide_reservations(df, limits).collect()}
    assert got == want and caps


def test_next_issues_and_urgent(spark):
    rows = [(1, "a", "long_cue", 0, 25_000), (1, "b", "overlap", 50, 60), (1, "c", "repetition", 90, 40_000), (1, "d", "subtitle_gap", 5, 10_010)]
    df = spark.createDataFrame(rows, "track_id long, issue_id string, kind string, start_ms long, end_ms long")
    assert [r.issue_id for r in rl.next_issues(df, 3).orderBy("rank").collect()] == ["c", "b", "d"]
    assert sorted(r.issue_id for r in rl.urgent(df).collect()) == ["a", "c"]


def test_apply_rows(spark):
    ckpt = spark.createDataFrame([(1, 1, "one", None), (1, 2, None, "unclear")], "track_id long, cue_id long, text string, defer_reason string")
    rows = spark.createDataFrame([(1, 1, "uno", None), (1, 2, "two", None), (1, 3, None, "noise"), (1, 4, "both", "x")], "track_id long, cue_id long, text string, defer_reason string")
    got = {r.cue_id: (r.text, r.defer_reason, r.conflict) for r in vs.apply_rows(ckpt, rows).collect()}
    assert got == {1: ("one", None, True), 2: ("two", None, False), 3: (None, "noise", False)}
    fixed = {r.cue_id: (r.text, r.previous_text) for r in vs.apply_rows(ckpt, rows, correction=True).collect()}
    assert fixed[1] == ("uno", "one")


def test_one_edit_leaves_other_windows_cached(spark):
    media = spark.createDataFrame([(1, 600_000)], "track_id long, duration_ms long")
    rows = [(1, i + 1, i * 20_000, i * 20_000 + 1500, f"t{i}") for i in range(30)]
    changed = [(*r[:4], "edited") if r[1] == 5 else r for r in rows]
    moved = [(r[0], r[1] + 1, *r[2:]) for r in rows]
    frame = lambda data: vs.window_hashes(spark.createDataFrame(data, CUE), media, "m", "r")
    work = lambda data: sorted(r.work for r in vs.plan_work(frame(data), frame(rows)).collect())
    assert work(rows) == ["cached"] * 10
    assert work(changed) == ["cached"] * 9 + ["missing"]
    assert work(moved) == ["remapped"] * 10


def test_reference_disagreement(spark):
    cues = [(1, 1, 0, 2000, "where did you go last night"), (1, 2, 2000, 4000, "I was at home"), (1, 3, 9000, 9900, "nothing alike here at all")]
    ref = [(1, 7, 100, 2400, "where did you go last night"), (1, 8, 9100, 9800, "zzz qqq www vvv kkk jjj xxx"), (1, 9, 100, 900, "too short")]
    shifted = spark.createDataFrame(ref, "track_id long, ref_id long, start_ms long, end_ms long, text string")
    got = {r.ref_id: r.similarity for r in sc.reference_disagreement(spark.createDataFrame(cues, CUE), shifted, below=1.1).collect()}
    near = {7: "where did you go last night i was at home", 8: "nothing alike here at all"}
    assert got == {k: round(1 - edits((own := dict((r[1], r[4]) for r in ref)[k]), text) / max(len(own), len(text)), 3) for k, text in near.items()}
    low = sc.reference_disagreement(spark.createDataFrame(cues, CUE), shifted).collect()
    assert [r.ref_id for r in low] == [8]


def test_token_diff(spark):
    """Literal cases: runs on both sides, repeated words, words that move, empty sides."""
    rows = [
        (1, 0, "we will not go home today", "we go home today my friend"), (1, 1, "go go go", "go"), (1, 2, "", "all of this is extra"), (1, 3, "a b c", ""),
        (1, 4, "one two three", "three two one"), (1, 5, "a x y b z", "a b"), (1, 6, "", ""),
    ]
    df = spark.createDataFrame(rows, "track_id long, start_ms long, text string, cue_text string")
    got = {r.start_ms: tuple(r["_d"]) for r in sc.token_diff(df).collect()}
    assert got == {
        0: (2, "will not", 2, "my friend", True), 1: (2, "go go", 0, "", False), 2: (0, "", 5, "all of this is extra", False), 3: (3, "a b c", 0, "", False),
        4: (0, "", 0, "", False), 5: (2, "x y", 0, "", False), 6: (0, "", 0, "", False),
    }


def test_moved_words_are_no_repair(spark):
    names = spark.createDataFrame([("Mecnun",)], "name string")
    edits_ = spark.createDataFrame([(1, "Necnun geldi dün", "Mecnun geldi dün"), (2, "geldi dün Necnun", "dün geldi Mecnun"), (3, "geldi dün", "dün geldi")], "edit_id long, old string, new string")
    assert {r.edit_id: r.accepted for r in sc.repair_gate(edits_, names).collect()} == {1: True, 2: False, 3: False}


def test_release_blockers(spark):
    pending = spark.createDataFrame([(1, "subtitle_gap", 0, 30_000), (1, "subtitle_gap", 0, 29_999), (2, "possible_speech_gap", 0, 90_000), (2, "long_cue", 0, 20_000), (3, "overlap", 0, 5)],
                                    "track_id long, kind string, start_ms long, end_ms long")
    got = sorted(map(tuple, rl.queue_blockers(pending).collect()))
    assert got == sorted([(1, "pending")] * 2 + [(1, "urgent")] + [(1, "coverage")] * 2 + [(2, "pending")] * 2 + [(2, "coverage"), (2, "urgent"), (3, "pending")])
    assert rl.queue_blockers(pending.limit(0)).collect() == []

    cues = [(1, 1, 0, 9, "a"), (1, 2, 9, 12, None), (2, 1, 0, 9, "a"), (3, 1, 0, 9, "a"), (5, 1, 0, 9, "a"), (5, 1, 0, 9, "a")]
    now = [(1, 2, 9, 12, None), (1, 1, 0, 9, "a"), (2, 1, 0, 9, "b"), (4, 1, 0, 9, "a"), (5, 1, 0, 9, "a")]
    stale = vs.stale_tracks(spark.createDataFrame(cues, CUE), spark.createDataFrame(now, CUE), ["cue_id", "start_ms", "end_ms", "text"])
    assert {r.track_id for r in stale.collect()} >= {2, 3, 4} and 1 not in {r.track_id for r in stale.collect()}

    tracks = spark.createDataFrame([(1,), (3,), (9,)], "track_id long")
    gate = {r.track_id: (r.blockers, r.checks, r.passed) for r in ms.release_gate(tracks, [rl.queue_blockers(pending)]).collect()}
    assert gate == {1: (5, "coverage,pending,urgent", False), 3: (1, "pending", False), 9: (0, "", True)}


def lone_runs(heard, written):
    """Brute force: shared words, then the longest stretch without a partner on either side."""
    def longest(a, b):
        left, best, run = Counter(b), [], []
        for word in a:
            run = [] if left[word] else [*run, word]
            left[word] -= left[word] > 0
            best = run if len(run) > len(best) else best
        return len(best), " ".join(best)

    return sum((Counter(heard) & Counter(written)).values()), *longest(heard, written), *longest(written, heard)


def test_words_stay_in_their_window(spark):
    """Random windows against brute force; words are neither shuffled nor sorted by Spark (the joins by occurrence made
    58 times the input of shuffle and spill)."""
    rng = random.Random(5)
    texts = [(k % 3, k, " ".join(rng.choices("abcdeç", k=rng.randint(0, 30))), " ".join(rng.choices("abcdeç", k=rng.randint(0, 30)))) for k in range(300)]
    texts += [(9, 1, None, "a b"), (9, 2, "a b", None), (9, 3, "a " * 30_000, "b " * 30_000 + "a")]
    df = spark.createDataFrame(texts, "track_id long, start_ms long, text string, cue_text string").repartition(3)
    diff, agreement = sc.token_diff(df), sc.word_agreement(df)
    want = {(t, k): lone_runs((h or "").split(), (w or "").split()) for t, k, h, w in texts}
    got = {(r.track_id, r.start_ms): (r["_shared"], *tuple(r["_d"])[:4]) for r in diff.collect()}
    assert got == want
    shares = {(r.track_id, r.start_ms): (r.heard_words, r.shared_words) for r in agreement.collect()}
    assert shares == {(t, k): (len(h.split()), want[t, k][0]) for t, k, h, _ in texts if h}
    for frame in (diff, agreement, sc.classify_window(df)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert "hashpartitioning" not in plan and "Join" not in plan and "Sort " not in plan


def test_edits_of_long_texts(spark):
    """A text of 60,000 characters (half a minute in the whole edit table), one inside another, and random
    pairs around the length where the way of counting changes, against the built-in distance."""
    rng = random.Random(6)
    line = lambda n: "".join(rng.choices("abcdeğ ", k=n))
    pairs = [(line(n), line(m)) for n in (0, 1, 60, 141, 142, 300) for m in (0, 1, 141, 142, 400)]
    pairs += [(p[50:90], p) for p in (line(500),)] + [(p, p[2:200]) for p in (line(500),)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate([*pairs, (None, "a"), ("a", None)])], "i long, a string, b string")
    assert df.where(~sc.text_edits(F.col("a"), F.col("b")).eqNullSafe(F.levenshtein("a", "b"))).collect() == []
    long = line(60_000)
    begun = time.time()
    got = spark.createDataFrame([(long, long[::-1]), (long, long[:30_000] + "z" + long[30_001:])], "a string, b string").select(sc.text_edits(F.col("a"), F.col("b")).alias("n")).collect()
    assert got[1].n == 1 and 0 < got[0].n < 60_000 and time.time() - begun < 20
