"""Stamps, clocks and interval arithmetic on integer milliseconds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuelake.functions.base import C, as_col, idiv

__all__ = [
    "idiv", "srt_to_ms", "ms_to_srt", "clock", "cps", "midpoint", "overlap_ms", "meaningful",
    "intersects", "char_budget", "repaired_end", "start_policy", "aligned_start",
    "round_seconds",
]

# Fixed form of a subtitle stamp: HH:MM:SS,mmm with minutes and seconds below sixty.
STAMP = r"^(\d{2,}):([0-5]\d):([0-5]\d),(\d{3})$"


def srt_to_ms(stamp: C) -> Column:
    """`HH:MM:SS,mmm` to milliseconds; NULL when the stamp is malformed."""
    stamp = F.trim(as_col(stamp))

    def part(group: int) -> Column:
        return F.regexp_extract(stamp, STAMP, group).cast("bigint")

    value = part(1) * 3_600_000 + part(2) * 60_000 + part(3) * 1_000 + part(4)
    return F.when(stamp.rlike(STAMP), value)


def ms_to_srt(ms: C) -> Column:
    ms = as_col(ms)
    return F.format_string(
        "%02d:%02d:%02d,%03d",
        idiv(ms, 3_600_000), idiv(ms, 60_000) % 60, idiv(ms, 1_000) % 60, ms % 1_000,
    )


def clock(seconds: C, ms: bool = False) -> Column:
    """Seconds (any numeric) as `HH:MM:SS`, floored, or with rounded milliseconds."""
    seconds = as_col(seconds)
    if not ms:
        whole = F.floor(seconds).cast("bigint")
        return F.format_string("%02d:%02d:%02d", idiv(whole, 3600), idiv(whole, 60) % 60, whole % 60)
    total = F.bround(seconds * 1000, 0).cast("bigint")
    return F.format_string(
        "%02d:%02d:%02d.%03d",
        idiv(total, 3_600_000), idiv(total, 60_000) % 60, idiv(total, 1_000) % 60, total % 1_000,
    )


def cps(text: C, start: C, end: C, newline: str = "") -> Column:
    """Characters per second; line breaks count as `newline` (nothing by default). Infinite where
    text stands for no time at all, NaN where there is none either, as in IEEE division."""
    shown = F.length(F.replace(as_col(text), F.lit("\n"), F.lit(newline)))
    length = as_col(end) - as_col(start)
    timeless = F.when(shown > 0, F.lit(float("inf"))).when(shown == 0, F.lit(float("nan")))
    return F.when(length == 0, timeless).otherwise(shown * F.lit(1000.0) / length)


def midpoint(start: C, end: C) -> Column:
    return idiv(as_col(start) + as_col(end), 2)


def intersects(ls: C, le: C, rs: C, re: C) -> Column:
    return (as_col(ls) < as_col(re)) & (as_col(le) > as_col(rs))


def overlap_ms(ls: C, le: C, rs: C, re: C) -> Column:
    return F.least(as_col(le), as_col(re)) - F.greatest(as_col(ls), as_col(rs))


def meaningful(ls: C, le: C, rs: C, re: C) -> Column:
    """Overlap of at least a quarter of the shorter side, held between 100 and 500 ms."""
    shorter = F.least(as_col(le) - as_col(ls), as_col(re) - as_col(rs))
    quarter = F.greatest(F.lit(100), F.least(F.lit(500), idiv(shorter, 4)))
    return overlap_ms(ls, le, rs, re) >= F.least(shorter, quarter)


def char_budget(start: C, end: C, per_second: int = 20) -> Column:
    return idiv((as_col(end) - as_col(start)) * per_second, 1000)


def repaired_end(start: C, end: C) -> Column:
    """A cue that ends at or before its start lasts one millisecond."""
    start, end = as_col(start), as_col(end)
    return F.when(end <= start, start + 1).otherwise(end)


def start_policy(start: C, end: C, aligned: C, late_ms: int = 1000, lead_ms: int = 500) -> Column:
    """Move a start only when speech begins clearly later; keep half a second of lead."""
    start, end, aligned = as_col(start), as_col(end), as_col(aligned)
    usable = F.when(aligned >= end, start).otherwise(aligned)
    return F.when(usable - start >= late_ms, F.greatest(start, usable - lead_ms)).otherwise(start)


def aligned_start(start: C, end: C, aligned: C, small_ms: int = 1000) -> Column:
    """First-pass rule: keep small shifts and starts that would pass the old end."""
    start, end, aligned = as_col(start), as_col(end), as_col(aligned)
    moved = F.when(F.abs(aligned - start) < small_ms, start).otherwise(aligned)
    return F.when(aligned.isNull() | (moved >= end), start).otherwise(moved)


def round_seconds(ms: C) -> Column:
    return F.round(as_col(ms) / F.lit(1000.0), 3)
