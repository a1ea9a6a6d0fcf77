"""Registered queries against their SQL twins, and the shape of key plans.

A cross-section runs by default; `CUELAKE_ALL=1` runs every query (also: tests/compare.py).
"""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from compare import compare, engine
from cuelake.operators import measures as ms
from cuelake.operators import sequences as sq
from cuelake.plans import all_checks, all_plans, registry
from cuelake.sources.tables import Tables

FOLDER = "/root/testdata/sf0.001"
PLANS, CHECKS = all_plans(), all_checks()
SOME = ["review_queue_t5", "interval_join_j1", "uncovered_speech_w5", "clip_owner_x5", "rebase_j10", "clock_offset_a2", "layout_audit_t8",
        "pending_issues_j17", "interval_hash_p14", "word_agreement_a4", "char_batches_w15", "capped_ledger_r2", "srt_scan_s1", "component_text_j26"]


def test_every_query_is_checked_or_known_to_lack_sql():
    assert set(CHECKS) <= set(PLANS)
    assert set(PLANS) - set(CHECKS) == {"word_disagreement_a5", "gate_counts_a26", "reference_disagreement_t1"}


@pytest.mark.parametrize("name", sorted(PLANS) if os.environ.get("CUELAKE_ALL") else SOME)
def test_query_equals_sql(spark, name):
    message, _, _ = compare(spark, engine(FOLDER), FOLDER, name, PLANS[name], CHECKS.get(name))
    assert message == ""


@pytest.mark.parametrize("name", ["interval_join_j1", "uncovered_cues_j2", "uncovered_speech_w5", "timeline_j16", "translation_audit_t7", "window_text_j5"])
def test_no_nested_loops(spark, name):
    text = PLANS[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_scan_reads_its_input_once(spark):
    df = PLANS["overlaps_w2"](spark, FOLDER)
    df.collect()
    text = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in text and text.count("FileScan") == 1


def test_units_of_no_length(spark, tmp_path):
    """The third line of track 32 shows for 0 ms once its times are moved (division by zero before)."""
    rows = [(32, "a first line\nand a second one\nab\nqq and a fourth line"), (33, "another track")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/parts")
    part = next(tmp_path.glob("parts/*.parquet"))
    (tmp_path / "documents.parquet").symlink_to(part)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{part}'")
    for name in ("layout_audit_t8", "material_flags_t9"):
        assert compare(spark, db, str(tmp_path), name, PLANS[name], CHECKS[name])[0] == ""
    fast = PLANS["layout_audit_t8"](spark, str(tmp_path)).where("kind = 'fast_cue' AND item_id = 3").collect()
    assert [r.measure for r in fast] == [float("inf")]
    # No integer for that measure: SQL refuses the cast here, the query binds the flag without one.
    for name in ("flag_binding_t13", "open_flags_t13"):
        assert {("fast_cue", 3)} <= {(r.kind, r.item_id) for r in PLANS[name](spark, str(tmp_path)).collect()}


def test_gate_counts_cues_out_of_order(spark, tmp_path):
    """Target cue 5 of track 72 starts ahead of cue 4: one blocker more than their overlap (the SQL left it out)."""
    rows = [(72, "a first line\nand a second one\nthe third one\nab\nand a fifth line"), (73, "another trac\nof two lines")]
    spark.createDataFrame(rows, "doc_id long, text string").coalesce(1).write.parquet(f"{tmp_path}/parts")
    part = next(tmp_path.glob("parts/*.parquet"))
    (tmp_path / "documents.parquet").symlink_to(part)
    t = Tables(spark, str(tmp_path))
    assert (72, 5, "out_of_order") in {tuple(r) for r in sq.validate(t.target, t.media).collect()}
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{part}'")
    assert compare(spark, db, str(tmp_path), "release_gate_a24", PLANS["release_gate_a24"], CHECKS["release_gate_a24"])[0] == ""


def test_alignment_reports_shuffle_no_words(spark):
    """Reports by track take one shuffle, of the cues (words went through three before)."""
    text = PLANS["alignment_scan_s5"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange ") == 1 and "Join" not in text


def test_receipts_do_not_write_the_words(spark):
    """A query that reads the words once cuts them as they stream by."""
    tables = Tables(spark, FOLDER)
    registry.PLANS["receipts_s10"](tables)
    assert "words" not in tables.__dict__


def test_listings_keep_empty_and_null_apart(spark, tmp_path):
    """Empty texts and sources came back as null, and null characters inside quotes were lost."""
    texts = [None, "", " ", '"', '""', "\\", "\r\n", "a\0b", 'a\0",\n\0"', "\ufeff", "null", ',"\r', " x\n"]
    rows = [(at if at else None, text, *pair) for at, (text, pair) in enumerate((x, p) for x in texts for p in [("de", "web"), (None, None), ("", ""), ("en", "\0")])]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").coalesce(1).write.parquet(f"{tmp_path}/parts")
    part = next(tmp_path.glob("parts/*.parquet"))
    (tmp_path / "documents.parquet").symlink_to(part)
    db = duckdb.connect()
    db.sql(f"CREATE VIEW documents AS SELECT * FROM '{part}'")
    assert compare(spark, db, str(tmp_path), "listings_s8", PLANS["listings_s8"], CHECKS["listings_s8"])[0] == ""


def test_gate_counts_its_checks_one_after_the_other(spark):
    """What is left to the last query is adding up counts (it held the shuffles of all checks on disk before)."""
    frame = PLANS["release_gate_a24"](spark, FOLDER)
    text = frame._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in text and text.count("Exchange ") <= 4
    parts = [df.select("track_id", F.lit(name).alias("check")) for df, name in ((frame, "b"), (frame, "a"), (frame.limit(1), "a"))]
    tracks = frame.select("track_id").unionByName(spark.createDataFrame([(-1,)], "track_id long"))
    whole, counted = ms.release_gate(tracks, parts), ms.gate_of_counts(tracks, [ms.blocker_counts(parts[:2]), ms.blocker_counts(parts[2:])])
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, counted.collect()))
