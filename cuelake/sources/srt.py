"""Subtitle files in and out, recogniser transcripts, legacy encodings."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuelake.functions import ms_to_srt, srt_to_ms

ARROW = r"^\s*(\S+)\s+-->\s+(\S+)\s*$"
NATIVE = {"utf-8", "utf-16", "utf-16be", "utf-16le", "utf-32", "iso-8859-1", "us-ascii"}


def scan_files(spark: SparkSession, glob: str) -> DataFrame:
    """Whole text files as (path, content)."""
    return spark.read.text(glob, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("content"))


def parse_srt(files: DataFrame, renumber: bool = False) -> DataFrame:
    """One row per block: cue id, times, text and the first rule it breaks (NULL when sound).

    Strict form: ids count up from one, valid stamps, start before end, text not blank. With
    `renumber` the id is the position and header ids are ignored. All per file row: no shuffle.
    """
    keep = [name for name in files.columns if name != "content"]
    body = F.regexp_replace(F.regexp_replace(F.col("content"), "^﻿", ""), r"\r\n?", "\n")
    body = F.regexp_replace(body, r"^\s+|\s+$", "")
    blocks = files.select(*keep, F.posexplode(F.split(body, r"\n[ \t]*\n\s*")).alias("_pos", "_block"))
    lines = F.split("_block", "\n")
    raw = blocks.select(
        *keep, (F.col("_pos") + 1).cast("bigint").alias("_no"), F.trim(F.get(lines, F.lit(0))).alias("_id"),
        F.get(lines, F.lit(1)).alias("_times"),
        F.array_join(F.slice(lines, 3, F.greatest(F.size(lines) - 2, F.lit(0))), "\n").alias("text"))
    raw = raw.withColumn("start_ms", srt_to_ms(F.regexp_extract("_times", ARROW, 1))).withColumn(
        "end_ms", srt_to_ms(F.regexp_extract("_times", ARROW, 2)))
    number = F.when(F.col("_id").rlike(r"^\d+$"), F.col("_id").cast("bigint"))
    bad_id = F.lit(False) if renumber else F.coalesce(number != F.col("_no"), F.lit(True))
    error = (F.when(bad_id, "bad_id").when(F.col("start_ms").isNull() | F.col("end_ms").isNull(), "bad_time")
             .when(F.col("start_ms") >= F.col("end_ms"), "no_duration").when(F.trim("text") == "", "blank_text"))
    return raw.select(*keep, F.col("_no").alias("cue_id"), "start_ms", "end_ms", "text", error.alias("error"))


def read_srt(spark: SparkSession, glob: str, mode: str = "permissive", renumber: bool = False) -> DataFrame:
    """Scan a subtitle corpus. `failfast` stops the job at the first broken block."""
    rows = parse_srt(scan_files(spark, glob), renumber)
    if mode == "failfast":
        check = F.assert_true(F.col("error").isNull(), F.concat_ws(" ", F.lit("Broken subtitle block:"), "error", F.lit("in"), "path"))
        # Kept as a filter condition: an unused column would be pruned away, and the check with it.
        rows = rows.where(check.isNull())
    return rows


@F.pandas_udf(T.StringType())
def _decode(content: pd.Series, charset: pd.Series) -> pd.Series:
    return pd.Series([bytes(raw).decode(name) for raw, name in zip(content, charset)])


def decode_tracks(files: DataFrame, encoding: str) -> DataFrame:
    """Bytes to text, with the hash of the original bytes and of the UTF-8 form.

    Spark decodes the encodings it knows; code pages go through one Arrow call.
    """
    name = encoding.lower()
    text = F.decode("content", name) if name in NATIVE else _decode("content", F.lit(name))
    rows = files.select("path", F.sha2("content", 256).alias("original_sha"), text.alias("text"))
    return rows.withColumn("utf8_sha", F.sha2(F.encode("text", "utf-8"), 256))


def srt_blocks(cues: DataFrame) -> DataFrame:
    """Cues as subtitle blocks; ids must already count from one (see `splice` and `scan`)."""
    block = F.concat_ws("\n", F.col("cue_id").cast("string"), F.concat(ms_to_srt("start_ms"), F.lit(" --> "), ms_to_srt("end_ms")), "text")
    return cues.select("track_id", "cue_id", block.alias("block"))


def write_srt(cues: DataFrame, path: str) -> None:
    """One folder per track with one file in it. Rows stream to the file in order; none is collected."""
    # An expression of the key, so that a join before this cannot make the shuffle redundant.
    rows = srt_blocks(cues).repartition(F.xxhash64("track_id")).sortWithinPartitions("track_id", "cue_id")
    rows.select("track_id", "block").write.mode("overwrite").option("lineSep", "\n\n").partitionBy("track_id").text(path)


# Fixed line form of a recogniser: MM:SS.sss --> MM:SS.sss | words (hours optional, comma allowed).
STAMP_LINE = r"(?m)^\s*((?:\d+:)?\d+:\d+[.,]\d{1,3})\s*-->\s*((?:\d+:)?\d+:\d+[.,]\d{1,3})\s*\|"


def transcript_ms(stamp):
    """`[H:]M:S.f` to milliseconds; parts after the first stay below sixty, else NULL."""
    plain = F.replace(stamp, F.lit(","), F.lit("."))
    parts = F.split(F.substring_index(plain, ".", 1), ":")
    whole = F.transform(parts, lambda part: part.cast("bigint"))
    total = F.aggregate(whole, F.lit(0).cast("bigint"), lambda acc, part: acc * 60 + part)
    fraction = F.rpad(F.substring_index(plain, ".", -1), 3, "0").cast("bigint")
    sound = F.forall(F.slice(whole, 2, 3), lambda part: part < 60)
    return F.when(sound, total * 1000 + fraction)


def parse_transcripts(replies: DataFrame) -> DataFrame:
    """Recogniser replies to clip-relative cues; words run on to the next stamp.

    `replies`: key columns, duration_ms, content. Rows that break a rule carry it in `error`.
    """
    keep = [name for name in replies.columns if name not in ("content", "duration_ms")]
    starts = F.regexp_extract_all("content", F.lit(STAMP_LINE), F.lit(1))
    ends = F.regexp_extract_all("content", F.lit(STAMP_LINE), F.lit(2))
    pieces = F.split("content", STAMP_LINE)
    zipped = F.arrays_zip(starts.alias("s"), ends.alias("e"), F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))).alias("t"))
    rows = replies.select(*keep, "duration_ms", (F.trim(F.get(pieces, F.lit(0))) != "").alias("_lead"), F.posexplode_outer(zipped).alias("_pos", "_z"))
    cues = rows.select(
        *keep, (F.col("_pos") + 1).cast("bigint").alias("cue_id"), transcript_ms(F.col("_z.s")).alias("start_ms"), transcript_ms(F.col("_z.e")).alias("end_ms"),
        F.trim(F.regexp_replace("_z.t", r"\s+", " ")).alias("text"), "_lead", "duration_ms")
    inside = (F.col("start_ms") < F.col("end_ms")) & (F.col("end_ms") <= F.col("duration_ms"))
    error = (F.when(F.col("cue_id").isNull(), "no_timestamps").when(F.col("_lead"), "leading_text")
             .when(F.col("text") == "", "blank_text").when(~F.coalesce(inside, F.lit(False)), "outside_clip"))
    return cues.select(*keep, "cue_id", "start_ms", "end_ms", "text", error.alias("error"))
