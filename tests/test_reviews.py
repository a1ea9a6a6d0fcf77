"""Review results and covers: literal cases of what closes an issue and what does not."""

import pytest

from cuelake.operators import measures as ms
from cuelake.operators import rules as rl

RESULT = "track_id long, issue_id long, start_ms long, end_ms long, status string, route string, media_sha string, interval_sha string, reviewer string, reason string, heard_original boolean"
ISSUE = "track_id long, issue_id long, start_ms long, end_ms long, duration_ms long, media_sha string, interval_sha string"
OBS = "track_id long, issue_id long, method string, model string, model_version string, receipt string, receipt_ok boolean, media_sha string, start_ms long, end_ms long, whole boolean"
STEP = "track_id long, issue_id long, pos int, stage string, model string, assessment string"


def obs(model, receipt, start, end, method="hosted_asr", version="1", ok=True, media="v", whole=False):
    return (1, 1, method, model, version, receipt, ok, media, start, end, whole)


def local(model, receipt, start=1000, end=2000, **more):
    return obs(model, receipt, start, end, method=more.pop("method", "local_asr"), **more)


TWO = [obs("a", "r1", 0, 2000), obs("b", "r2", 900, 2100)]
CASES = [
    ("saved_asr_agent", {}, TWO, None),
    # receipts of one model hold the issue together; a hole between them does not
    ("saved_asr_agent", {}, [obs("a", "r1", 0, 1500), obs("a", "r3", 1500, 2000), TWO[1]], None),
    ("saved_asr_agent", {}, [obs("a", "r1", 0, 1500), obs("a", "r3", 1501, 2000), TWO[1]], "interval_not_covered"),
    ("saved_asr_agent", {}, [obs("a", "r1", 0, 1990), TWO[1]], "interval_not_covered"),
    # only the whole audio may end a little before the media does
    ("saved_asr_agent", {"duration": 2000}, [obs("a", "r1", 0, 1960, whole=True), TWO[1]], None),
    ("saved_asr_agent", {"duration": 2000}, [obs("a", "r1", 0, 1940, whole=True), TWO[1]], "interval_not_covered"),
    ("saved_asr_agent", {"duration": 2000}, [obs("a", "r1", 0, 1960), TWO[1]], "interval_not_covered"),
    ("saved_asr_agent", {"duration": 9000}, [obs("a", "r1", 0, 1960, whole=True), TWO[1]], "interval_not_covered"),
    ("saved_asr_agent", {}, [TWO[0], obs("a", "r2", 900, 2100)], "needs_two_models_and_receipts"),
    ("saved_asr_agent", {}, [TWO[0], obs("b", "r1", 900, 2100)], "needs_two_models_and_receipts"),
    ("saved_asr_agent", {}, [TWO[0], obs("b", "r2", 900, 2100, ok=False)], "observation_unusable"),
    ("saved_asr_agent", {}, [TWO[0], obs("b", "r2", 900, 2100, method="local_asr")], "observation_unusable"),
    ("saved_asr_agent", {}, TWO[:1], "needs_agent_judgment"),
    ("saved_asr_agent", {"reviewer": " "}, TWO, "needs_agent_judgment"),
    ("saved_asr_agent", {"heard": True}, TWO, "needs_agent_judgment"),
    ("saved_asr_agent", {"heard": None}, TWO, "needs_agent_judgment"),
    ("saved_asr_agent", {"interval": "old"}, TWO, "stale_or_uncertain"),
    ("local_asr_agent", {}, [local("a", "r1"), local("b", "r2")], None),
    # each local observation holds the issue alone, and has no tolerance at the media's end
    ("local_asr_agent", {}, [local("a", "r1", end=1500), local("a", "r3", start=1500), local("b", "r2")], "observation_unusable"),
    ("local_asr_agent", {"duration": 2000}, [local("a", "r1", end=1960, whole=True), local("b", "r2")], "observation_unusable"),
    ("local_asr_agent", {}, [local("a", "r1"), local("b", "r2", version=" ")], "observation_unusable"),
    ("local_asr_agent", {}, [local("a", "r1"), local("b", "r2", media="w")], "observation_unusable"),
    ("local_asr_agent", {}, [], "needs_agent_judgment"),
    ("provider", {}, [], None),
    ("provider", {"stages": ("comparison", "independent")}, [], "needs_two_ordered_stages"),
]


def test_review_errors(spark):
    results, issues, seen, steps, want = [], [], [], [], {}
    for n, (route, o, rows, error) in enumerate(CASES):
        results.append((1, n, 1000, 2000, "supported", route, "v", o.get("interval", "h"), o.get("reviewer", "agent"), "because", o.get("heard", False)))
        issues.append((1, n, 1000, 2000, o.get("duration", 60_000), "v", "h"))
        seen += [(1, n, *r[2:]) for r in rows]
        steps += [(1, n, pos, stage, "m", "heard") for pos, stage in enumerate(o.get("stages", ("independent", "comparison")))]
        want[n] = error
    out = rl.review_errors(*(spark.createDataFrame(rows, schema) for rows, schema in ((results, RESULT), (issues, ISSUE), (seen, OBS), (steps, STEP))))
    got = {r["issue_id"]: r["error"] for r in out.collect()}
    assert {n: got.get(n) for n in want} == want


@pytest.fixture(scope="module")
def spans(spark):
    return spark.createDataFrame([(1, 1, 1000, 2000), (1, 2, 5000, 6000), (2, 1, 0, 10)], "track_id long, cue_id long, start_ms long, end_ms long")


def test_corroborated(spark, spans):
    rows = [(1, "a", "r1", 0, 1500), (1, "a", "r2", 1500, 2500), (1, "b", "r3", 900, 2000), (1, "a", "r4", 5000, 6000), (1, "b", "r5", 5000, 5400), (1, "b", "r6", 5500, 6000)]
    seen = spark.createDataFrame(rows, "track_id long, model string, receipt string, start_ms long, end_ms long")
    got = sorted(map(tuple, ms.corroborated(seen, spans, ["track_id"], ["cue_id"]).collect()))
    assert got == [(1, 1, 2, 3, True), (1, 2, 1, 1, False), (2, 1, 0, 0, False)]
    got = sorted(map(tuple, ms.corroborated(seen, spans, ["track_id"], ["cue_id"], one_row=True).collect()))
    assert got == [(1, 1, 1, 1, False), (1, 2, 1, 1, False), (2, 1, 0, 0, False)]


def test_only_what_touches_a_span_is_asked(spark, spans):
    rows = [(1, "a", 0, 1500, "x"), (1, "a", 1500, 2500, "x"), (1, "b", 1200, 2000, "x"), (1, "c", 1000, 2000, " "), (1, "b", 5000, 6000, "x")]
    items = spark.createDataFrame(rows, "track_id long, model string, start_ms long, end_ms long, text string")
    got = sorted((r["cue_id"], r["model"], r["covered"]) for r in ms.covering(items, spans, ["track_id"], ["cue_id"]).collect())
    assert got == [(1, "a", True), (1, "b", False), (2, "b", True)]
    reviews = spark.createDataFrame([(1, "s", "m2", 0, 1500), (1, "s", "m1", 1400, 2000), (1, "t", "m1", 1500, 2000)], "track_id long, stage string, model string, start_ms long, end_ms long")
    got = sorted((r["cue_id"], r["stage"], r["models"], r["reviews"], r["covered"]) for r in ms.combine_reviews(reviews, spans, ["track_id"], ["cue_id"]).collect())
    assert got == [(1, "s", "m1, m2", 2, True), (1, "t", "m1", 1, False)]
