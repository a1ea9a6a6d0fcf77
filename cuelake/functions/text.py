"""Text normalisation, token tests and replacement checks."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cuelake.functions.base import C, as_col, let

__all__ = [
    "norm_text", "letter_tokens", "norm_turkish", "tr_lower", "tr_key", "align_text", "is_label",
    "has_loop", "is_degenerate", "valid_lang", "valid_episode", "fits_layout", "wrapped_lines",
    "near_name_pair", "name_suffix_pair", "count_in", "bag_agreement",
]


def norm_text(text: C) -> Column:
    """Lower-case word tokens joined by one space."""
    lowered = F.lower(F.translate(as_col(text), "İ", "i"))
    return F.array_join(F.regexp_extract_all(lowered, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1)), " ")


def letter_tokens(text: C) -> Column:
    """Letter-only tokens as an array: no digits, no underscore."""
    lowered = F.lower(F.translate(as_col(text), "İ", "i"))
    lowered = F.replace(lowered, F.lit("i̇"), F.lit("i"))
    return F.regexp_extract_all(lowered, F.lit(r"(\p{L}+)"), F.lit(1))


def tr_lower(text: C) -> Column:
    return F.lower(F.translate(as_col(text), "Iİ", "ıi"))


def norm_turkish(text: C) -> Column:
    """Turkish-aware lower case keeping letters, digits, spaces and the apostrophe."""
    kept = F.regexp_replace(tr_lower(text), r"[^\p{L}\p{N}\s']", "")
    return F.trim(F.regexp_replace(kept, r"\s+", " "))


def tr_key(text: C) -> Column:
    """Turkish lower case with everything but letters and digits removed."""
    return F.regexp_replace(tr_lower(text), "[^a-zçğıöşü0-9]", "")


def align_text(text: C) -> Column:
    """Punctuation to blanks, blanks collapsed: the form handed to a forced aligner."""
    spaced = F.regexp_replace(as_col(text), r"[^\p{L}\p{N}_\s]", " ")
    return F.trim(F.regexp_replace(spaced, r"\s+", " "))


def is_label(text: C) -> Column:
    """True when the text is nothing but bracketed sound labels."""
    return as_col(text).rlike(r"^\s*(?:\[[^\]]+\]\s*)+$")


def has_loop(tokens: C, widest: int = 4, repeats: int = 4) -> Column:
    """Some phrase of one to `widest` words stands `repeats` times in a row.

    A width-w loop is a stretch of (repeats-1)*w positions at which the token equals the one
    w places on, so one pass per width over the array finds it.
    """
    return let(as_col(tokens), lambda words: _looped(words, widest, repeats))


def _looped(tokens: Column, widest: int, repeats: int) -> Column:
    def looped(width: int) -> Column:
        need = (repeats - 1) * width
        ahead = F.slice(tokens, F.lit(width + 1), F.greatest(F.size(tokens) - width, F.lit(0)))
        same = F.zip_with(tokens, ahead, lambda a, b: F.coalesce(a == b, F.lit(False)))
        longest = F.aggregate(
            same,
            F.struct(F.lit(0).alias("now"), F.lit(0).alias("best")),
            lambda acc, hit: F.struct(
                F.when(hit, acc["now"] + 1).otherwise(F.lit(0)).alias("now"),
                F.greatest(acc["best"], F.when(hit, acc["now"] + 1).otherwise(F.lit(0))).alias("best"),
            ),
            lambda acc: acc["best"],
        )
        return longest >= need

    found = looped(1)
    for width in range(2, widest + 1):
        found = found | looped(width)
    return F.coalesce(found, F.lit(False))


def top_count(tokens: C) -> Column:
    """Occurrences of the most frequent token: longest equal stretch of the sorted array."""
    return F.aggregate(
        F.array_sort(as_col(tokens)),
        F.struct(F.lit("").alias("word"), F.lit(0).alias("now"), F.lit(0).alias("best")),
        lambda acc, word: F.struct(
            word.alias("word"),
            F.when(word == acc["word"], acc["now"] + 1).otherwise(F.lit(1)).alias("now"),
            F.greatest(
                acc["best"], F.when(word == acc["word"], acc["now"] + 1).otherwise(F.lit(1))
            ).alias("best"),
        ),
        lambda acc: acc["best"],
    )


def is_degenerate(tokens: C, longest: int = 40, share: float = 0.45) -> Column:
    """An over-long word, a phrase loop, or one word taking most of eight or more."""
    def judged(words: Column) -> Column:
        over_long = F.exists(words, lambda word: F.length(word) > longest)
        dominated = (F.size(words) >= 8) & (top_count(words) > F.size(words) * F.lit(share))
        return over_long | _looped(words, 4, 4) | dominated

    return let(as_col(tokens), judged)


def bag_agreement(heard: C, written: C) -> Column:
    """Shared words counted with multiplicity, over heard words; NULL when nothing was heard."""
    both = F.struct(as_col(heard).alias("h"), as_col(written).alias("w"))
    return let(both, lambda pair: _bag(pair["h"], pair["w"]))


def _bag(heard: Column, written: Column) -> Column:
    left = F.size(heard)
    counts = F.aggregate(
        F.array_sort(heard),
        F.struct(F.lit(None).cast("string").alias("word"), F.lit(0).alias("seen"),
                 F.lit(0).alias("have"), F.lit(0).alias("hits")),
        lambda acc, word: _bag_step(acc, word, written),
        lambda acc: acc["hits"],
    )
    return F.when(left > 0, F.round(counts / left.cast("double"), 3))


def _bag_step(acc: Column, word: Column, written: Column) -> Column:
    fresh = ~F.coalesce(word == acc["word"], F.lit(False))
    have = F.when(fresh, count_in(written, word)).otherwise(acc["have"])
    seen = F.when(fresh, F.lit(1)).otherwise(acc["seen"] + 1)
    return F.struct(
        word.alias("word"), seen.alias("seen"), have.alias("have"),
        F.when(seen <= have, acc["hits"] + 1).otherwise(acc["hits"]).alias("hits"),
    )


def count_in(tokens: Column, word: Column) -> Column:
    return F.size(F.filter(tokens, lambda other: other == word))


def valid_lang(tag: C) -> Column:
    return as_col(tag).rlike(r"^[a-z]{2,3}(-[A-Za-z0-9]{2,8})*$")


def valid_episode(key: C) -> Column:
    return as_col(key).rlike(r"^[A-Za-z0-9][A-Za-z0-9._-]*$")


def wrapped_lines(text: C, width: int = 42) -> Column:
    """Greedy word wrap: number of lines and longest line, as a struct."""
    lengths = F.filter(F.transform(F.split(as_col(text), r"\s+"), F.length), lambda length: length > 0)

    def step(acc: Column, length: Column) -> Column:
        joined = acc["line"] + 1 + length
        new_line = (acc["lines"] == 0) | (joined > width)
        line = F.when(new_line, length).otherwise(joined)
        return F.struct(
            F.when(new_line, acc["lines"] + 1).otherwise(acc["lines"]).alias("lines"),
            line.alias("line"),
            F.greatest(acc["longest"], line).alias("longest"),
        )

    start = F.struct(F.lit(0).alias("lines"), F.lit(0).alias("line"), F.lit(0).alias("longest"))
    return F.aggregate(lengths, start, step)


def fits_layout(text: C, budget: C, width: int = 42, lines: int = 2, shape: C | None = None) -> Column:
    """No markup, within the character budget, and at most two lines of 42.

    `shape`: the `wrapped_lines` of the flat text, where a column already holds them.
    """
    flat = F.trim(F.regexp_replace(as_col(text), r"[\r\n]", " "))
    # The wrap walks the words: once, and not at all where a cheaper rule has already failed.
    small = lambda shape: (shape["lines"] <= lines) & (shape["longest"] <= width)
    wraps = let(wrapped_lines(flat, width), small) if shape is None else small(as_col(shape))
    return (
        (flat != "") & ~flat.contains("<") & ~flat.contains(">")
        & (F.length(flat) <= as_col(budget))
        & wraps
    )


def near_name_pair(old: C, name_key: C) -> Column:
    """Old text is a close misspelling of the name key it was replaced by."""
    key = as_col(name_key)
    distance = F.levenshtein(tr_key(old), key)
    limit = F.when(F.length(key) <= 5, 1).otherwise(2)
    return (key != "") & (distance <= limit) & (distance <= F.length(key) * F.lit(0.34))


def name_suffix_pair(old: C, new: C, name_key: C) -> Column:
    """Same letters, and they spell the name plus an ending of at most five letters."""
    bare, key = tr_key(new), as_col(name_key)
    return (
        (tr_key(old) == bare) & bare.startswith(key)
        & (F.length(bare) - F.length(key)).between(0, 5)
    )
