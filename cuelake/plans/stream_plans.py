"""Streams that run and end inside a query, and files written and read back.

Inputs grow in two instalments; the stream is drained after each, so that the second run starts from
the checkpoint of the first. Rows must equal those of the batch query named.
"""

from pyspark.sql import functions as F

from cuelake.operators import measures as ms
from cuelake.plans.link_plans import gap_rows
from cuelake.plans.measure_plans import KINDS, limits
from cuelake.plans.registry import plan
from cuelake.session import scratch_folder
from cuelake.sources import records as rc
from cuelake.streaming import flows


def instalments(rows, key):
    """Two parts of `rows`, the first up to the middle of the range of `key`."""
    low, high = rows.agg(F.min(key), F.max(key)).first()
    middle = (low + high) // 2 if low is not None else 0
    return [rows.where(F.col(key) <= middle), rows.where(F.col(key) > middle)]


@plan("event_counts_r1", same_as="event_counts_a18")
def event_counts_r1(t):
    folder = scratch_folder(t.spark, "counts")
    log = t.raw("events").select("event_id", F.col("ts").alias("at"), F.col("event_type").alias("kind"), F.col("props").alias("detail"), F.col("user_id").cast("string").alias("run_id"))
    for part in instalments(log, "event_id"):
        rc.append_events(part.drop("event_id"), f"{folder}/log")
        counts = flows.stream_event_counts(rc.read_events(t.spark, f"{folder}/log", stream=True))
        flows.drain(counts, f"{folder}/checkpoint", mode="update", batch=flows.epochs(f"{folder}/out"))
    counts = flows.latest_counts(flows.read_epochs(t.spark, f"{folder}/out", "run_id string, kind string, n bigint"))
    whole = counts.select(F.col("run_id").cast("bigint").alias("run_id"), "kind", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("_one"))
    return ms.event_counts(whole, KINDS)


@plan("stream_ledger_r2", same_as="capped_ledger_r2")
def stream_ledger_r2(t):
    folder = scratch_folder(t.spark, "ledger")
    parts = instalments(t.ledger, "event_id")
    end = t.ledger.agg(F.max("at") + F.expr("INTERVAL 30 DAYS")).first()[0]
    # A last row of no authorization moves the watermark past all slots.
    close = t.spark.range(1).select(*[F.lit(end).alias("at") if f.name == "at" else F.lit(-1).cast(f.dataType).alias(f.name) if f.name in ("auth_id", "event_id") else F.lit(None).cast(f.dataType).alias(f.name) for f in t.ledger.schema.fields])
    for part in [*parts, close]:
        part.write.mode("append").parquet(f"{folder}/in")
        source = t.spark.readStream.schema(t.ledger.schema).parquet(f"{folder}/in")
        flows.drain(flows.stream_ledger(source, limits(t), slot_ms=604_800_000), f"{folder}/checkpoint", f"{folder}/out")
    return t.spark.read.schema("auth_id bigint, event_id bigint, accepted boolean").parquet(f"{folder}/out")


@plan("gap_questions_r3", same_as="speech_in_gaps_j20")
def gap_questions_r3(t):
    folder = scratch_folder(t.spark, "gaps")
    rows = gap_rows(t)
    for part in instalments(rows, "obs_id"):
        part.write.mode("append").parquet(f"{folder}/in")
        source = t.spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        flows.drain(source, f"{folder}/checkpoint", batch=flows.refresh_gaps(t.cues, flows.epochs(f"{folder}/out")))
    return flows.read_epochs(t.spark, f"{folder}/out", "track_id bigint, obs_id bigint, kind string, start_ms bigint, end_ms bigint").drop("epoch")


@plan("decisions_s6", """
SELECT track_id::VARCHAR || ':' || cue_id AS issue_id, format('{:03d}', cue_id % 3 + 1) AS revision, CASE WHEN cue_id % 2 = 0 THEN 'resolved' ELSE 'unresolved' END AS status, text AS reason,
 ['clip ' || cue_id, 'a "quoted" note'] AS evidence, 'gap' AS kind, start_ms, end_ms FROM cues""")
def decisions_s6(t):
    """Decision files of a hundred tracks each, in a folder per revision."""
    folder = scratch_folder(t.spark, "decisions")
    item = F.struct(
        F.concat_ws(":", "track_id", "cue_id").alias("issue_id"), F.when(F.col("cue_id") % 2 == 0, "resolved").otherwise("unresolved").alias("status"), F.col("text").alias("reason"),
        F.array(F.concat(F.lit("clip "), "cue_id"), F.lit('a "quoted" note')).alias("evidence"), F.struct(F.lit("gap").alias("kind"), "start_ms", "end_ms").alias("issue_interval"))
    files = t.cues.groupBy(F.format_string("%03d", F.col("cue_id") % 3 + 1).alias("revision"), F.floor(F.col("track_id") / 100).alias("_file")).agg(F.to_json(F.collect_list(item)).alias("value"))
    files.drop("_file").write.partitionBy("revision").option("maxRecordsPerFile", 1).text(folder)
    rows = rc.read_decisions(t.spark, f"{folder}/*/*.txt")
    return rows.select("issue_id", F.regexp_extract("revision", r"(\d+)$", 1).alias("revision"), "status", "reason", "evidence", "issue_interval.kind", "issue_interval.start_ms", "issue_interval.end_ms")


@plan("event_log_s7", """
SELECT user_id::VARCHAR AS run_id, event_type AS kind, props AS detail, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at, NULL AS broken FROM events UNION ALL SELECT NULL, NULL, NULL, NULL, '{"run_id": "cut'""")
def event_log_s7(t):
    folder = scratch_folder(t.spark, "log")
    log = t.raw("events").select("event_id", F.col("ts").alias("at"), F.col("event_type").alias("kind"), F.col("props").alias("detail"), F.col("user_id").cast("string").alias("run_id"))
    for part in instalments(log, "event_id"):
        rc.append_events(part.drop("event_id"), folder)
    t.spark.range(1).select(F.lit('{"run_id": "cut').alias("value")).write.mode("append").text(folder)
    return rc.read_events(t.spark, folder).select("run_id", "kind", "detail", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"), F.col("_corrupt_record").alias("broken"))


@plan("listings_s8", """
SELECT doc_id::VARCHAR AS id, CASE WHEN lang <> 'en' THEN lang END AS lang, coalesce(source, '') AS source, sha256(text) AS text_sha, length(text) AS n FROM documents""")
def listings_s8(t):
    folder = scratch_folder(t.spark, "listing")
    rows = t.raw("documents").select(F.col("doc_id").cast("string").alias("id"), F.when(F.col("lang") != "en", F.col("lang")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    rc.write_index(rows, folder)
    back = rc.read_listings(t.spark, folder, "id string, lang string, source string, text string")
    return back.select("id", "lang", "source", F.sha2("text", 256).alias("text_sha"), F.length("text").cast("bigint").alias("n"))


@plan("track_report_s16", same_as="track_stats_a9")
def track_report_s16(t):
    folder = scratch_folder(t.spark, "report")
    from cuelake.plans.measure_plans import track_stats_a9

    rows = track_stats_a9(t)
    rc.write_report(rows, folder)
    return t.spark.read.schema(rows.schema).json(folder)
