"""Time the headline queries: `BENCH_SF_DIR` (input folder), `BENCH_CPUS` (local threads).

Prints one JSON line. Every query runs to completion into a no-op sink; the derived cue table is
staged before the clock starts for the rest and timed as a query of its own.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cuelake.plans import all_plans  # noqa: E402
from cuelake.session import get_session  # noqa: E402
from cuelake.sources.tables import Tables  # noqa: E402

HEADLINE = [
    "gaps_w1", "overlaps_w2", "repetition_runs_w3", "merge_intervals_w4", "uncovered_speech_w5", "silent_cue_parts_w6",
    "interval_join_j1", "uncovered_cues_j2", "many_to_one_j3", "window_pack_j4", "window_text_j5", "reference_only_j6",
    "provisional_links_j7", "rebase_j10", "active_cue_j11", "neighbours_j12", "clock_offset_a2", "word_agreement_a4",
    "track_stats_a9", "reading_profile_a12", "ledger_status_a17", "capped_ledger_r2", "clip_owner_x5", "char_batches_w15",
    "interval_hash_p14", "norm_text_p4", "phrase_loop_p16", "translation_audit_t7", "layout_audit_t8", "pending_issues_j17",
    "work_plan_v1", "srt_scan_s1", "review_queue_t5",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus) if cpus.isdigit() else 8, "12g")
    spark.sparkContext.setLogLevel("ERROR")
    plans = all_plans()
    spent: dict[str, float] = {}
    spark.range(1000).selectExpr("sum(id)").collect()
    begun = time.time()
    Tables(spark, folder).cues.selectExpr("count(*)").collect()
    spent["stage_cues"] = round(time.time() - begun, 3)
    for name in HEADLINE:
        begun = time.time()
        plans[name](spark, folder).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.time() - begun, 3)
        print(name, spent[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(spent.values()), 3), "unit": "sec",
                      "queries": spent, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
