"""Periodic runs of words, found on a grammar of the text.

A run is a stretch of words with smallest period q (words q apart are equal), at least `LEAST` words
and `TIMES` periods long, that no neighbouring word extends. Method, for each text by itself:

1. Re-Pair names the most frequent pair of neighbours by a new symbol until no pair occurs twice.
2. Runs that cross the boundary inside a symbol's expansion are worked out once a symbol. The symbols
   left over are joined by a balanced tree, whose boundaries are treated alike.
3. Runs of a symbol are translated to every place at which it is derived; intervals of one period
   that overlap by a period are one run.

A run lies whole in the expansion of the lowest node that holds it and crosses that node's boundary,
so none is missed. In a run every eight words in a row occur twice, as it is at least 24 words and 3
periods long; words outside such repeated eights are left out ahead of step 1, which changes no run
(for other limits nothing is left out).

Defined cases: a null or empty text has no runs and collapses to the empty text; rows with null or
repeated ids are judged by themselves; all columns of the input are kept, and the added columns
must not be among them (ValueError); a text is worked on alone, in memory in proportion to its length.
"""

from __future__ import annotations

import heapq
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cuelake.llm.common import SPACE, read

LEAST = 24
TIMES = 3
SEED = 8
ROWS = 256  # rows of output at a time
WORDS = re.compile(SPACE)
RUNS = T.ArrayType(T.StructType([T.StructField(x, T.LongType(), False) for x in ("start", "length", "period")]), False)


def repair(word: list[int]) -> tuple[dict[int, tuple[int, int]], list[tuple[int, int]]]:
    """(rules, top): rules {symbol: (left, right)} in order of making, top [(symbol, start)] left over."""
    n = len(word)
    sym, after, before = list(word), list(range(1, n + 1)), list(range(-1, n - 1))
    places = defaultdict(list)
    for i in range(n - 1):
        places[word[i], word[i + 1]].append(i)
    queue = [(-len(p), born, pair) for born, (pair, p) in enumerate(places.items()) if len(p) > 1]
    heapq.heapify(queue)
    rules, fresh, born = {}, max(word, default=0) + 1, len(places)
    while queue:
        count, _, (a, b) = heapq.heappop(queue)
        real, end = [], -1
        for i in sorted(set(places[a, b])):
            if i >= end and sym[i] == a and after[i] < n and sym[after[i]] == b:
                real.append(i)
                end = after[i] + 1
        places[a, b] = real
        if len(real) < 2:
            continue
        if len(real) < -count:
            heapq.heappush(queue, (-len(real), born, (a, b)))
            born += 1
            continue
        rules[fresh] = (a, b)
        touched = {}
        for i in real:
            gone = after[i]
            sym[i], sym[gone], after[i] = fresh, -1, after[gone]
            if after[i] < n:
                before[after[i]] = i
                touched[fresh, sym[after[i]]] = None
                places[fresh, sym[after[i]]].append(i)
            if before[i] >= 0:
                touched[sym[before[i]], fresh] = None
                places[sym[before[i]], fresh].append(before[i])
        del places[a, b]
        for pair in touched:
            if len(places[pair]) > 1:
                heapq.heappush(queue, (-len(places[pair]), born, pair))
                born += 1
        fresh += 1
    top, i = [], 0
    while i < n:
        top.append((sym[i], i))
        i = after[i]
    return rules, top


def _same(t, i: int, j: int, room: int, step: int) -> int:
    """How many words agree from places i and j on (step 1) or back (step -1), at most `room`."""
    k, width = 0, 32
    while k < room:
        m = min(width, room - k)
        if step > 0:
            odd = t[i + k : i + k + m] != t[j + k : j + k + m]
        else:
            odd = (t[i - k - m + 1 : i - k + 1] != t[j - k - m + 1 : j - k + 1])[::-1]
        if odd.any():
            return k + int(odd.argmax())
        k, width = k + m, 2 * width
    return k


def crossing(t, lo: int, mid: int, hi: int, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """Runs (start, end, period) of t[lo:hi] that hold both t[mid - 1] and t[mid], each with its smallest period.

    The longer side of a run holds half of it, so its words next to the boundary recur there one
    period on (four words of them, under the usual limits): these recurrences are the periods tried.
    """
    import numpy as np

    if hi - lo < least:
        return []
    found: dict[tuple[int, int], int] = {}
    width = max(1, min(4, least // 2 - least // times))
    for right in (True, False):
        side = t[mid:hi] if right else t[lo:mid][::-1]
        periods = np.flatnonzero(side[1 : (hi - lo) // times + 1] == side[0]) + 1
        periods = periods[periods + width <= len(side)]
        for k in range(1, width if len(periods) else 0):
            periods = periods[side[periods + k] == side[k]]
        while len(periods):
            q, periods = int(periods[0]), periods[1:]
            if right:
                s, e = mid - _same(t, mid - 1, mid + q - 1, mid - lo, -1), mid + q + _same(t, mid, mid + q, hi - mid - q, 1)
            else:
                s, e = mid - q - _same(t, mid - 1 - q, mid - 1, mid - q - lo, -1), mid + _same(t, mid - q, mid, hi - mid, 1)
            if s < mid < e and e - s >= max(least, times * q):
                found[s, e] = min(q, found.get((s, e), q))
                # Inside this run every multiple of its period gives the same stretch again.
                reach = e - mid if right else mid - s
                periods = periods[(periods % q != 0) | (periods + width > reach)]
    return [(s, e, q) for (s, e), q in found.items()]


def _pieces(word: list[int], seed: int) -> list[tuple[int, int]]:
    """Stretches of words covered by repeated runs of `seed` words."""
    grams = list(zip(*(word[k:] for k in range(seed)), strict=False))
    if len(set(grams)) == len(grams):
        return []
    often = Counter(grams)
    out: list[tuple[int, int]] = []
    for i, gram in enumerate(grams):
        if often[gram] > 1:
            if out and i <= out[-1][1]:
                out[-1] = (out[-1][0], i + seed)
            else:
                out.append((i, i + seed))
    return out


def word_runs(words: list[str], least: int = LEAST, times: int = TIMES) -> list[tuple[int, int, int]]:
    """All runs (start, length, period) of a text's words, by start, then period."""
    import numpy as np

    code: dict[str, int] = {}
    whole = [code.setdefault(w, len(code)) for w in words]
    pieces = _pieces(whole, SEED) if least >= 24 and times >= 3 else [(0, len(whole))]
    pieces = [(a, b) for a, b in pieces if b - a >= least]
    if not pieces:
        return []
    text, origin, mark = [], [], len(code)
    for a, b in pieces:  # joined by marks that occur once, so no run and no pair goes across
        text += whole[a:b] + [mark]
        origin += range(a, b + 1)
        mark += 1
    rules, top = repair(text)
    t, n = np.array(text), len(text)
    size, at, own, live = {}, {}, {}, set()
    stack = []
    for symbol, start in top:
        if symbol not in at:
            stack.append((symbol, start))
        while stack:  # one place of every symbol, from the derivation
            x, p = stack.pop()
            if x in at:
                continue
            at[x] = p
            if x in rules:
                a, b = rules[x]
                stack.append((a, p))
                size_a = _length(a, rules, size)
                stack.append((b, p + size_a))
    for x, (a, b) in rules.items():
        p, mid, end = at[x], at[x] + _length(a, rules, size), at[x] + _length(x, rules, size)
        own[x] = [(s - p, e - p, q) for s, e, q in crossing(t, p, mid, end, least, times)]
        if own[x] or a in live or b in live:
            live.add(x)
    places = defaultdict(list)
    for symbol, start in top:
        if symbol in live:
            places[symbol].append(np.array([start]))
    spans = [np.zeros((0, 3), np.int64)]
    for x in reversed(rules):
        if x not in live or x not in places:
            continue
        p = np.concatenate(places.pop(x))
        for s, e, q in own[x]:
            spans.append(np.stack([p + s, p + e, np.full(len(p), q)], axis=1))
        a, b = rules[x]
        if a in live:
            places[a].append(p)
        if b in live:
            places[b].append(p + size.get(a, 1))
    starts = [start for _, start in top] + [n]
    todo = [(0, len(top))]
    while todo:
        i, j = todo.pop()
        if j - i < 2 or starts[j] - starts[i] < least:
            continue
        m = (i + j) // 2
        here = crossing(t, starts[i], starts[m], starts[j], least, times)
        if here:
            spans.append(np.array(here))
        todo += [(i, m), (m, j)]
    spans = np.concatenate(spans)
    merged: list[list[int]] = []
    for s, e, q in spans[np.lexsort((-spans[:, 1], spans[:, 0], spans[:, 2]))].tolist():
        if merged and merged[-1][2] == q and s + q <= merged[-1][1]:
            merged[-1][1] = max(e, merged[-1][1])
        else:
            merged.append([s, e, q])
    return sorted((origin[s], e - s, q) for s, e, q in merged)


def _length(x: int, rules: dict, size: dict) -> int:
    """Length of a symbol's expansion; parts are older than the whole, so few are open at a time."""
    todo = [x]
    while todo:
        y = todo[-1]
        if y not in rules or y in size:
            todo.pop()
            continue
        a, b = rules[y]
        missing = [z for z in (a, b) if z in rules and z not in size]
        if missing:
            todo += missing
        else:
            size[y] = size.get(a, 1) + size.get(b, 1)
            todo.pop()
    return size.get(x, 1)


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> list[str]:
    """The words, without those that come after the first period of a run."""
    if not runs:
        return words
    gone = bytearray(len(words))
    for s, length, q in runs:
        gone[s + q : s + length] = b"\1" * (length - q)
    return [w for w, x in zip(words, gone, strict=True) if not x]


def periodic_runs(docs: DataFrame, text: str = "text", names: tuple[str, str] = ("runs", "collapsed"), least: int = LEAST, times: int = TIMES) -> DataFrame:
    """`docs` with its runs (array of start, length, period in words) and the text without repeated periods."""
    if clash := {x.lower() for x in names} & {x.lower() for x in docs.columns}:
        raise ValueError(f"columns in use: {sorted(clash)}")
    if times < 3 or least < 6:
        raise ValueError("a run is at least 6 words and 3 periods long")
    at = docs.columns.index(text)

    def judged(parts):
        for part in (part.slice(k, ROWS) for part in parts for k in range(0, len(part), ROWS)):
            spans, kept = [], []
            for value in part.column(at):
                words = WORDS.findall(value.as_py() or "")
                found = word_runs(words, least, times)
                spans.append([dict(zip(("start", "length", "period"), run, strict=True)) for run in found])
                kept.append(" ".join(collapse(words, found)))
            kind = pa.list_(pa.struct([pa.field(x, pa.int64(), False) for x in ("start", "length", "period")]))
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(spans, kind), pa.array(kept, pa.string())], names=[*part.schema.names, *names])

    schema = T.StructType([*docs.schema.fields, T.StructField(names[0], RUNS), T.StructField(names[1], T.StringType())])
    return docs.mapInArrow(judged, schema)


def with_cycles(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one of ten texts, by a checksum of the id, the words from a drawn place on repeat."""
    words = F.coalesce(F.regexp_extract_all("text", F.lit(f"({SPACE})")), F.array().cast("array<string>"))
    h = F.crc32(F.col("doc_id").cast("string"))
    rows = docs.select("doc_id", "text", h.alias("h"), F.when(h % 10 == 0, words).alias("w"))
    rows = rows.withColumn("n", F.size("w")).withColumn("g", F.floor(F.col("h") / 10))
    rows = rows.withColumn("a", F.when(F.col("n") > 0, F.col("g") % F.col("n")).cast("int"))
    left = F.col("n") - F.col("a")
    rows = rows.withColumn("p", (1 + F.floor(left / (3 + F.col("g") % 8))).cast("int"))
    cycle = F.flatten(F.array_repeat(F.slice("w", F.col("a") + 1, F.col("p")), F.ceil(left / F.col("p")).cast("int")))
    tail = F.slice(cycle, F.lit(1), left)
    planted = F.array_join(F.concat(F.slice("w", F.lit(1), F.col("a")), tail), " ")
    return rows.select("doc_id", F.when((F.col("h") % 10 == 0) & (F.col("n") > 0), planted).otherwise(F.col("text")).alias("text"))


def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(with_cycles(read(spark, sf_dir, "documents")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"].cast("string"), r["length"].cast("string"), r["period"].cast("string")), F.lit("\n")))
    none = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best = F.aggregate("runs", none, lambda top, r: F.when(top.isNull() | (r["length"] * top["period"] > top["length"] * r["period"]), r).otherwise(top))
    out = found.withColumn("best", best)
    return out.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    )
