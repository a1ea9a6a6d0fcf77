"""Benchmark decontamination: n-gram seeds, then Smith-Waterman alignment.

Every n-gram of the test items is looked for in every text; a bitmap of fixed size, whatever the
benchmark, keeps texts without any out of the join. Every n-gram found is a seed, however frequent:
seeds join passages to items by equality. A passage that shares too few words with its item to reach
`least` is dropped by an exact bound; the others are aligned word by word (match 2, mismatch and gap
-1, local), which scores edited copies. A pair is reported at `least` of the item's full score.
With n = 3, copies of a score over 0.5 that keep no n words in a row have words put in after every
second or single word; only replaced words bring the score to about 0.5 before the last seed goes.

Passages, not documents, move: the words around the n-grams found. A hot passage is a skewed key of an
inner join, which adaptive execution splits. The alignment works on batches of bounded size.

Defined cases: null and empty texts match nothing, as do items with fewer than n words; documents are
named by doc_id: rows that repeat an id count as one document, rows without one as one nameless
document; the best alignment of a document and item is kept, the first of equals; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm.common import few_at_a_time, read, stage

WIDTH = 3
LEAST = 0.5
SLACK = 8
BITS = 23
MATCH, MISS, GAP = 2, -1, -1
CELLS = 2_000_000
PAIRS = 2_000  # aligned at a time
AT_ONCE = 4 << 20  # bytes of text coded at a time: words are hashed once in each

_word = re.compile(r"\w+")


def coded(texts: list[str | None]):
    """64-bit codes of the lower-case words of each text."""
    import numpy as np
    import pandas as pd

    lists = [_word.findall((t or "").lower()) for t in texts]
    flat = pa.array([w for ws in lists for w in ws], pa.large_string()).dictionary_encode()
    codes = pd.util.hash_array(np.array(flat.dictionary.to_pylist(), dtype=object), categorize=False) if len(flat) else np.zeros(0, np.uint64)
    every = codes[flat.indices.to_numpy(zero_copy_only=False)].astype(np.uint64) if len(flat) else codes
    return np.split(every, np.cumsum([len(ws) for ws in lists])[:-1]) if lists else []


def grams(codes, width: int):
    """64-bit code of the words from each place."""
    import numpy as np

    n = len(codes) - width + 1
    out = np.zeros(max(0, n), np.uint64)
    for k in range(width if n > 0 else 0):
        out = (out ^ codes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return out


def places(code, bits: int = BITS):
    """The two bits of the filter that stand for a code."""
    import numpy as np

    mask = np.uint64((1 << bits) - 1)
    return (code & mask).astype(np.int64), (code >> np.uint64(64 - bits)).astype(np.int64)


def item_grams(items: DataFrame, width: int) -> DataFrame:
    """(item_id, words, grams) of each test item."""

    def batches(parts):
        for part in few_at_a_time(parts, rows=4096, size=AT_ONCE):
            words = coded(part.column(1).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array([w.view("i8") for w in words], pa.list_(pa.int64())), pa.array([grams(w, width).view("i8") for w in words], pa.list_(pa.int64()))],
                names=["item_id", "words", "grams"])

    return items.select(F.col("item_id").cast("long"), "text").mapInArrow(batches, "item_id long, words array<long>, grams array<long>")


def gram_filter(items: DataFrame, bits: int = BITS):
    """Bitmap of the items' n-grams: 2^bits bits (1 MB), made of at most 2^(bits - 15) rows."""
    import numpy as np

    mask = (1 << bits) - 1
    at = items.select(F.explode("grams").alias("g")).select(F.explode(F.array(F.col("g").bitwiseAND(F.lit(mask)), F.shiftrightunsigned("g", 64 - bits))).alias("bit"))
    at = at.select((F.col("bit") + 1).alias("bit"))  # bitmap functions count from 1
    rows = at.groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map")).collect()
    out = np.zeros(1 << bits, bool)
    for row in rows:
        part = np.unpackbits(np.frombuffer(bytes(row["map"]), np.uint8), bitorder="little")
        start = (row["k"] - 1) * len(part)
        out[start : start + len(part)] = part[: len(out) - start]
    return np.packbits(out, bitorder="little")


def passages(docs: DataFrame, bitmap, reach: int, width: int) -> DataFrame:
    """(doc_id, start, words, hits): the words around n-grams that pass the filter."""
    schema = "doc_id long, start long, words array<long>, hits array<struct<pos: long, gram: long>>"
    kind = pa.list_(pa.struct([("pos", pa.int64()), ("gram", pa.int64())]))

    def batches(parts):
        import numpy as np

        full = np.unpackbits(bitmap, bitorder="little").view(bool)
        for part in few_at_a_time(parts, rows=4096, size=AT_ONCE):
            ids, starts, words, hits = [], [], [], []
            for doc, codes in zip(part.column(0).to_pylist(), coded(part.column(1).to_pylist()), strict=True):
                gram = grams(codes, width)
                a, b = places(gram)
                at = np.flatnonzero(full[a] & full[b])
                for group in np.split(at, np.flatnonzero(np.diff(at) > reach) + 1) if len(at) else ():
                    low = max(0, int(group[0]) - reach)
                    ids.append(doc), starts.append(low), words.append(codes[low : int(group[-1]) + width + reach].view("i8"))
                    hits.append([{"pos": p, "gram": g} for p, g in zip(group.tolist(), gram[group].view("i8").tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(starts, pa.int64()), pa.array(words, pa.list_(pa.int64())), pa.array(hits, kind)], names=["doc_id", "start", "words", "hits"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches, schema)


def reachable(item, text, least: float) -> bool:
    """Whether the alignment can score `least`: a bound from the words both hold.

    A score of least * 2m over the m words of an item needs least * m equal words, in at most
    (3 - 2 * least) * m words of text, as each further word costs a gap.
    """
    import numpy as np

    shared = np.concatenate(([0], np.cumsum(np.isin(text, item))))
    span = int((3 - 2 * least) * len(item)) + 1
    most = (shared[span:] - shared[:-span]).max() if len(text) > span else shared[-1]
    return bool(most >= least * len(item))


def aligned(queries, texts):
    """(best score, end in the text) of the local alignment of each pair of code arrays."""
    import numpy as np

    best, end = np.zeros(len(queries)), np.zeros(len(queries), np.int64)
    order = sorted(range(len(queries)), key=lambda k: (len(queries[k]), len(texts[k])))
    at = 0
    while at < len(order):
        group = [order[at]]
        while at + len(group) < len(order) and (len(group) + 1) * (len(texts[order[at + len(group)]]) + 1) <= CELLS:
            group.append(order[at + len(group)])
        at += len(group)
        m, n = max(len(queries[k]) for k in group), max(len(texts[k]) for k in group)
        q, t = np.zeros((len(group), m), np.int64), np.zeros((len(group), n), np.int64)
        for row, k in enumerate(group):
            q[row, : len(queries[k])], t[row, : len(texts[k])] = queries[k], texts[k]
        real = np.array([[len(queries[k]), len(texts[k])] for k in group])
        inside = np.arange(n)[None, :] < real[:, 1:]
        slope = -GAP * np.arange(n + 1)
        row_best, row_end, last = np.zeros(len(group), np.int64), np.zeros(len(group), np.int64), np.zeros((len(group), n + 1), np.int64)
        for i in range(m):
            now = np.zeros_like(last)
            step = np.where((t == q[:, i : i + 1]) & inside, MATCH, MISS)
            now[:, 1:] = np.maximum(np.maximum(last[:, :-1] + step, last[:, 1:] + GAP), 0)
            now = np.maximum.accumulate(now + slope, axis=1) - slope
            now[i >= real[:, 0]] = 0
            now[:, 1:][~inside] = 0
            top = now.argmax(axis=1)
            value = now[np.arange(len(group)), top]
            better = value > row_best
            row_best[better], row_end[better] = value[better], top[better]
            last = now
        best[group], end[group] = row_best, row_end
    return best, end


def leaks(docs: DataFrame, items: DataFrame, least: float = LEAST, width: int = WIDTH, slack: int = SLACK) -> DataFrame:
    """(doc_id, item_id, score, first_word, last_word): texts that hold a test item, words from 0."""
    known = stage(item_grams(items, width), "items")
    reach = (known.agg(F.max(F.size("words"))).first()[0] or 0) + slack
    found = stage(passages(docs, gram_filter(known), reach, width).withColumn("at", F.monotonically_increasing_id()), "passages")
    hits = found.select("at", "start", F.explode("hits").alias("h")).select("at", "start", "h.*")
    seeds = known.select("item_id", F.posexplode("grams").alias("q", "gram"))
    met = hits.join(seeds, "gram").groupBy("at", "item_id").agg(F.min(F.col("pos") - F.col("q") - F.col("start")).alias("low"), F.max(F.col("pos") - F.col("q") - F.col("start")).alias("high"))
    pairs = met.join(found.select("at", "doc_id", "start", F.col("words").alias("text")), "at").join(known.select("item_id", F.col("words").alias("item")), "item_id")
    begin = F.greatest(F.col("low") - slack, F.lit(0)).cast("int")
    pairs = pairs.select("doc_id", "item_id", (F.col("start") + begin).alias("base"), F.slice("text", begin + 1, (F.col("high") + F.size("item") + slack - begin).cast("int")).alias("text"), "item")
    schema = "doc_id long, item_id long, score double, first_word long, last_word long"

    def batches(parts):
        import numpy as np

        for part in (part.slice(k, PAIRS) for part in parts for k in range(0, len(part), PAIRS)):
            t = [np.asarray(x.values.to_numpy()) for x in part.column(3)]
            q = [np.asarray(x.values.to_numpy()) for x in part.column(4)]
            able = [k for k in range(len(q)) if reachable(q[k], t[k], least)]
            part, q, t = part.take(pa.array(able, pa.int64())), [q[k] for k in able], [t[k] for k in able]
            base = part.column(2).to_numpy()
            best, end = aligned(q, t)
            score = best / np.maximum(1, [MATCH * len(x) for x in q])
            keep = np.flatnonzero(score >= least)
            _, back = aligned([q[k][::-1] for k in keep], [t[k][: end[k]][::-1] for k in keep])
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(keep, pa.int64())), part.column(1).take(pa.array(keep, pa.int64())), pa.array(score[keep]), pa.array(base[keep] + end[keep] - back), pa.array(base[keep] + end[keep] - 1)],
                names=["doc_id", "item_id", "score", "first_word", "last_word"])

    scored = pairs.mapInArrow(batches, schema)
    top = F.max(F.struct("score", (-F.col("first_word")).alias("first"), (-F.col("last_word")).alias("last")))
    best = scored.groupBy("doc_id", "item_id").agg(top.alias("b"))
    return best.select("doc_id", "item_id", "b.score", (-F.col("b.first")).alias("first_word"), (-F.col("b.last")).alias("last_word"))


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
