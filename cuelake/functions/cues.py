"""Small helpers on cue rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cuelake.functions.base import C, as_col
from cuelake.functions.times import char_budget, repaired_end

__all__ = ["absolute_episode", "unit_id", "track_key", "fast_cues", "fix_zero_duration"]

# Fixed offsets of the three seasons in absolute numbering.
SEASON_START = {1: 0, 2: 20, 3: 61}


def absolute_episode(season: C, episode: C) -> Column:
    pairs = [F.lit(x) for item in SEASON_START.items() for x in item]
    return (F.create_map(*pairs)[as_col(season).cast("int")] + as_col(episode)).cast("bigint")


def unit_id(cue_id: C, start_ms: C, prefix: str = "u") -> Column:
    return F.format_string(prefix + "%06d-%09d", as_col(cue_id), as_col(start_ms))


def track_key(path: C) -> Column:
    """Last part of a path or address, without a query."""
    return F.regexp_extract(as_col(path), r"([^/?]+)(\?[^/]*)?$", 1)


def fast_cues(cues: DataFrame, per_second: int = 20) -> DataFrame:
    """Cues over the reading budget, with the characters the budget allows."""
    shown = F.length(F.replace(F.col("text"), F.lit("\n"), F.lit(" ")))
    over = shown * 1000 > per_second * (F.col("end_ms") - F.col("start_ms"))
    return cues.where(over).withColumn("budget", char_budget("start_ms", "end_ms", per_second))


def fix_zero_duration(cues: DataFrame) -> DataFrame:
    """Zero or negative cues last one millisecond; the recogniser's end is kept beside it."""
    return cues.withColumn("raw_end_ms", F.col("end_ms")).withColumn("end_ms", repaired_end("start_ms", "raw_end_ms"))
