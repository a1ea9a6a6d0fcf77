import datetime
import json
import random
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from cuelake.operators.ledger import decide_reservations, ledger_status, settle_usage
from cuelake.operators.measures import event_counts
from cuelake.sources import records as rc
from cuelake.sources import srt as sr
from cuelake.streaming import flows

SRT = "﻿1\r\n00:00:01,000 --> 00:00:02,500\r\nFirst line\r\nsecond\r\n\r\n2\r\n00:00:03,000 --> 00:00:04,000\r\nLast.\r\n"


def test_srt_round_trip(spark, tmp_path):
    (tmp_path / "a.srt").write_text(SRT, encoding="utf-8")
    rows = sr.read_srt(spark, str(tmp_path / "*.srt")).orderBy("cue_id")
    assert [(r.cue_id, r.start_ms, r.end_ms, r.text, r.error) for r in rows.collect()] == [
        (1, 1000, 2500, "First line\nsecond", None), (2, 3000, 4000, "Last.", None)]
    out = tmp_path / "out"
    sr.write_srt(rows.withColumn("track_id", F.lit("a")), str(out))
    again = sr.read_srt(spark, str(out / "track_id=a" / "*.txt"), mode="failfast").orderBy("cue_id")
    assert [r.text for r in again.collect()] == ["First line\nsecond", "Last."]


def test_srt_errors(spark, tmp_path):
    bad = "1\n00:00:01,000 --> 00:00:00,500\nx\n\n5\n00:00:02,000 --> 00:00:03,000\ny\n\n3\n00:99:02,000 --> 00:00:03,000\nz"
    (tmp_path / "b.srt").write_text(bad)
    got = [r.error for r in sr.read_srt(spark, str(tmp_path / "b.srt")).orderBy("cue_id").collect()]
    assert got == ["no_duration", "bad_id", "bad_time"]
    tolerant = [r.error for r in sr.read_srt(spark, str(tmp_path / "b.srt"), renumber=True).orderBy("cue_id").collect()]
    assert tolerant == ["no_duration", None, "bad_time"]
    with pytest.raises(Exception, match="Broken subtitle block"):
        sr.read_srt(spark, str(tmp_path / "b.srt"), mode="failfast").count()


def test_turkish_code_page(spark):
    df = spark.createDataFrame([("p", bytearray("Işığı söndür, şimdi.".encode("cp1254")))], "path string, content binary")
    assert sr.decode_tracks(df, "cp1254").collect()[0].text == "Işığı söndür, şimdi."


def test_transcript_lines(spark):
    text = "00:01.5 --> 00:02.000 | Hello\nthere\n01:00,250 --> 01:02.000 | Bye"
    df = spark.createDataFrame([(1, 90_000, text), (2, 90_000, "junk " + text), (3, 90_000, "no stamps"), (4, 1000, text)], "k long, duration_ms long, content string")
    got = {}
    for r in sr.parse_transcripts(df).collect():
        got.setdefault(r.k, []).append((r.start_ms, r.end_ms, r.text, r.error))
    assert sorted(got[1]) == [(1500, 2000, "Hello there", None), (60_250, 62_000, "Bye", None)]
    assert {e for *_, e in got[3]} == {"no_timestamps"} and {e for *_, e in got[4]} == {"outside_clip"}


def test_salvage(spark):
    item = {"source_id": "u1", "verdict": "correct"}
    whole = json.dumps({"assessments": [item, item]})
    odd = json.dumps({"assessments": [{"source_id": 'a "}] {', "explanation": "{\"x\": 1}"}]})[:-2] + ', {"source_id": "see {\\"y\\": 2} and'
    rows = [(1, whole, "stop"), (2, whole[:-10], "length"), (3, whole[:-10], "stop"), (4, whole[:30], "length"), (5, '{"other": 1}', "stop"),
            (6, '{"assessments": []}', "stop"), (7, odd, "length"), (8, None, None), (9, '{"notes": [{"source_id": "n"}, ', "length")]
    df = spark.createDataFrame(rows, "response_id long, content string, done_reason string")
    got = sorted((r.response_id, r.pos, r.cut, r.source_id, r.error) for r in rc.salvage_assessments(df).collect())
    assert got == [(1, 0, False, "u1", None), (1, 1, False, "u1", None), (2, 0, True, "u1", None), (3, None, False, None, "not_json"), (4, None, True, None, "no_whole_item"),
                   (5, None, False, None, "no_assessments"), (7, 0, True, 'a "}] {', None), (8, None, False, None, "not_json"), (9, None, True, None, "no_whole_item")]


def test_fences(spark):
    mark = "`" * 3
    cases = {f"Here:\n{mark}json\n[1]\n{mark}\nDone.": ("[1]", None), f"{mark}[1]{mark}{mark}[2]{mark}": (None, "ambiguous_fences"), f"{mark}json\n{mark}": (None, "ambiguous_fences"),
             ' {"a": 1}\n': ('{"a": 1}', None), f"{mark}json\n[2]": ("[2]", None), f"[3]\n{mark}": ("[3]", None), f"so {mark} [3]": (None, "not_json"), "[]": (None, "empty_or_scalar"), "7": (None, "empty_or_scalar")}
    df = spark.createDataFrame([(c,) for c in cases], "content string")
    assert {r.content: (r.payload, r.error) for r in rc.fenced_json(df).collect()} == cases


def test_csv_and_json_logs(spark, tmp_path):
    listing = spark.createDataFrame([("1", 'A "quoted", name', "saved")], "id string, title string, status string")
    rc.write_index(listing, str(tmp_path / "csv"))
    assert rc.read_listings(spark, str(tmp_path / "csv"), "id string, title string, status string").collect()[0].title == 'A "quoted", name'
    log = tmp_path / "log"
    for kind in ("failure", "failure", "checkpoint"):
        rc.append_events(spark.createDataFrame([("r", kind, "x")], "run_id string, kind string, detail string").withColumn("at", F.current_timestamp()), str(log))
    assert {r.kind: r.n for r in event_counts(rc.read_events(spark, str(log)), ["checkpoint", "failure", "pause"]).collect()} == {"checkpoint": 1, "failure": 2, "pause": 0}


def test_decisions_come_in_revision_order(spark, tmp_path):
    for revision, status in (("001", "unresolved"), ("002", "resolved")):
        folder = tmp_path / revision
        folder.mkdir()
        (folder / "decision.json").write_text(json.dumps({"issue_id": "gap:1", "status": status}, indent=1))
    rows = rc.read_decisions(spark, str(tmp_path / "*" / "decision.json")).orderBy("revision").collect()
    assert [r.status for r in rows] == ["unresolved", "resolved"]


def drain(stream, mode):
    name = "t" + uuid.uuid4().hex
    query = stream.writeStream.outputMode(mode).format("memory").queryName(name).trigger(availableNow=True).start()
    query.awaitTermination()
    return name


def test_streamed_counts_equal_the_batch(spark, tmp_path):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").selectExpr("user_id AS run_id", "event_type AS kind")
    events.repartition(5).write.parquet(str(tmp_path / "in"))
    source = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 2).parquet(str(tmp_path / "in"))
    name = drain(flows.stream_event_counts(source), "complete")
    got = {(r.run_id, r.kind): r.n for r in spark.table(name).collect()}
    kinds = ["click", "error", "purchase", "signup", "view"]
    assert got == {(r.run_id, r.kind): r.n for r in event_counts(events, kinds).where("n > 0").collect()}


RESERVED = "auth_id long, event_id long, kind string, duration_ms long, prompt_bytes long, charge double, label string, stage string, at timestamp"


def reservations(spark, rows):
    return spark.createDataFrame(rows, RESERVED).withColumn("charge", F.col("charge").cast("decimal(18,8)"))


def run_ledger(spark, tmp_path, parts, limits, **settings):
    """One drain per part, all from one checkpoint."""
    for part in parts:
        part.write.mode("append").parquet(str(tmp_path / "in"))
        source = spark.readStream.schema(part.schema).parquet(str(tmp_path / "in"))
        flows.drain(flows.stream_ledger(source, limits, **settings), str(tmp_path / "cp"), str(tmp_path / "out"))
    out = spark.read.schema("auth_id long, event_id long, accepted boolean").parquet(str(tmp_path / "out"))
    return sorted((r.auth_id, r.event_id, r.accepted) for r in out.collect())


def test_streamed_ledger_goes_on_at_its_checkpoint(spark, tmp_path):
    """Rows of a part arrive in any order; totals, open slots and once-only reservations outlive a restart."""
    rng = random.Random(4)
    start = datetime.datetime(2024, 1, 1)
    rows = []
    for i in range(300):
        call = rng.random() < 0.5
        label, stage = (None, rng.choice([None, "full_episode_observation"])) if call else (rng.choice([None, "full-episode"]), None)
        rows.append((rng.choice([1, 1, 1, 2, 3]), i, "call" if call else "upload", rng.randrange(1, 4000), rng.randrange(1, 900), rng.randrange(20) / 100, label, stage, start + datetime.timedelta(seconds=7 * i)))
    caps = "max_uploads long, max_calls long, max_upload_ms long, max_call_ms long, max_prompt_bytes long, max_charge decimal(18,8), unlimited boolean"
    limits = spark.createDataFrame([(a, 30, 40, 90_000, 120_000, 20_000, Decimal(3), a == 3) for a in (1, 2, 3)], "auth_id long, " + caps)
    parts = [rows[:90], rows[90:91], rows[91:]]
    for part in parts:
        rng.shuffle(part)
    close = [(-1, -1, None, None, None, None, None, None, start + datetime.timedelta(days=9))]
    got = run_ledger(spark, tmp_path, [reservations(spark, part) for part in [*parts, close]], limits, slot_ms=60_000)
    want = sorted((r.auth_id, r.event_id, r.accepted) for r in decide_reservations(reservations(spark, rows), limits).collect())
    assert got == want and {ok for _, _, ok in got} == {True, False}
    once = [(a, i) for a, i, ok in got if ok and (rows_by := {r[1]: r for r in rows})[i][6] == "full-episode"]
    assert sorted(a for a, _ in once) == [1, 2, 3]


def test_once_only_reservations_bind_unlimited_use(spark):
    """Literal cases: caps, the unlimited switch, one full upload and one full observation each."""
    day = datetime.datetime(2024, 1, 1)
    one = lambda auth, i, kind, label=None, stage=None, cost=1.0: (auth, i, kind, 1000, 10, cost, label, stage, day)
    rows = [
        one(1, 1, "upload", "full-episode"), one(1, 2, "call", None, "full_episode_observation"), one(1, 3, "upload", "full-episode"), one(1, 4, "call", None, "full_episode_observation"),
        one(1, 5, "call"), one(1, 6, "call"), one(2, 7, "call", cost=50.0), one(2, 8, "upload"), one(2, 9, "call", cost=2.0), one(2, 10, "call", cost=1.5),
        one(9, 11, "call"),
    ]
    caps = "max_uploads long, max_calls long, max_upload_ms long, max_call_ms long, max_prompt_bytes long, max_charge decimal(18,8), unlimited boolean"
    limits = spark.createDataFrame([(1, 0, 0, 0, 0, 0, Decimal(0), True), (2, 1, 2, 9000, 9000, 900, Decimal("3.5"), False)], "auth_id long, " + caps)
    got = {r.event_id: r.accepted for r in decide_reservations(reservations(spark, rows), limits).collect()}
    assert got == {1: True, 2: True, 3: False, 4: False, 5: True, 6: True, 7: False, 8: True, 9: True, 10: True}
    over = {r.auth_id: r.over for r in ledger_status(reservations(spark, rows), limits).collect()}
    assert over == {1: "full_uploads,full_calls", 2: "calls,charge"}


def test_settled_usage_replaces_the_estimate(spark):
    day = datetime.datetime(2024, 1, 1)
    events = reservations(spark, [(1, 1, "upload", 10, 10, 0.0, None, None, day), (1, 2, "call", 10, 10, 0.5, None, None, day), (1, 3, "call", 10, 10, 0.25, None, None, day)])
    receipts = spark.createDataFrame([(1, 2, 10, 10, 10, 1), (1, 2, 1_000_000, 500_000, 500_000, 2), (1, 3, 5, None, 1, 1), (1, 9, 1, 1, 1, 1), (1, 1, 1, 1, 1, 1)],
                                     "auth_id long, event_id long, input_tokens long, output_tokens long, thought_tokens long, recorded_at long")
    got = {r.event_id: (r.charge and float(r.charge), r.error) for r in settle_usage(events, receipts, ("0.3", "1.2")).collect()}
    assert got == {1: (0.0, "unknown_event"), 2: (1.5, None), 3: (0.25, None), 9: (None, "unknown_event")}


def test_a_repeated_micro_batch_adds_no_row(spark, tmp_path):
    write = flows.epochs(str(tmp_path / "out"))
    for epoch, n in ((0, 3), (1, 2), (1, 2), (0, 3)):
        write(spark.range(n), epoch)
    assert flows.read_epochs(spark, str(tmp_path / "out"), "id long").count() == 5


def test_receipts_refresh_only_touched_tracks(spark):
    cues = spark.createDataFrame([(1, 1, 0, 1000, "x"), (2, 1, 0, 1000, "x")], "track_id long, cue_id long, start_ms long, end_ms long, text string")
    batch = spark.createDataFrame([(1, 5, "asr", 2000, 2100)], "track_id long, obs_id long, kind string, start_ms long, end_ms long")
    seen = []
    flows.refresh_gaps(cues, lambda df, epoch: seen.extend((epoch, r.obs_id) for r in df.collect()))(batch, 3)
    assert seen == [(3, 5)]


def test_cues_are_staged_from_small_files(spark, tmp_path):
    # One file of one row group is one task; a shuffle of it would be held by that task, too.
    from cuelake.session import DEALT_ROWS
    from cuelake.sources.tables import Tables

    words = ["", "short", "a line of many words", "quite a long line with q", "wide enough to stay here"]
    docs = spark.range(2 * DEALT_ROWS + 1).select(F.col("id").alias("doc_id"), F.array_join(F.transform(
        F.sequence(F.lit(0), F.lit(6)), lambda at: F.element_at(F.array(*map(F.lit, words)), (1 + (F.col("id") + at * at) % len(words)).cast("int"))), "\n").alias("text"))
    docs.coalesce(1).write.parquet(f"{tmp_path}/documents.parquet")
    t = Tables(spark, str(tmp_path))
    seen = []
    parse = t.parsed_cues
    t.parsed_cues = lambda df: seen.append(len(df.inputFiles())) or parse(df)
    assert t.cues.count() > 0 and seen[0] == 3
    assert "Exchange" not in t.renumbered._jdf.queryExecution().executedPlan().toString()
    order = Window.partitionBy("track_id").orderBy("cue_id")
    numbered = t.edited.withColumn("cue_id", F.row_number().over(order).cast("bigint"))
    assert sorted(map(tuple, t.renumbered.collect())) == sorted(map(tuple, numbered.collect()))
