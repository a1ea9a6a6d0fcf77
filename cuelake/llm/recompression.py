"""Substring dedup over words by recompression.

Each round names runs of one symbol, then pairs of neighbours that fall on the two sides of a
partition of the symbols; names are hashes, so all tasks agree on them without meeting. A symbol
carries the words its name depends on: where these lie inside a window, the window alone fixes the
symbol, and every copy of the window has it. A window's anchor is, of such symbols of its highest
level (level 0, a word, always exists), the one with the least hash, leftmost of equals: neighbouring
windows tend to share it. Its key for the filter takes in half of the remaining words behind it or,
where the window ends before these, in front of it. Windows whose key two documents share are
verified word by word. See `repeats` for the passes.

Defined cases: a null or empty text has no words; rows with a null doc_id lose nothing and cause no
loss; rows that repeat an id do not remove each other; equal rows come back as often as they come
in; empty tables give no rows; other columns are ignored.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm import repeats
from cuelake.llm.common import SPACE, read
from cuelake.llm.repeats import mix

LENGTH = 50
ROUNDS = 3  # more give rarer symbols, but windows whose last rounds miss them; three make the longest runs of windows
EDGE = 1 << 40
BASE = 0x5851F42D4C957F2D


def compressed(codes, rounds: int = ROUNDS):
    """Levels of (first word depended on, word behind the last, symbol): the places never fall along a level."""
    import numpy as np

    sym = codes
    low = np.arange(len(sym), dtype=np.int64)
    high = low + 1
    levels = [(low, high, sym)]
    for r in range(rounds):
        new = np.concatenate(([True], sym[1:] != sym[:-1]))
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(sym)) - 1
        size = (last - first + 1).astype(np.uint64)
        left, right = np.concatenate(([-EDGE], low)), np.append(high, EDGE)
        sym = np.where(size > 1, mix(sym[first], size + np.uint64(2 * r * EDGE)), sym[first])
        low, high = left[first], right[last + 1]
        side = mix(sym, np.full(len(sym), r + 1, np.uint64)) >> np.uint64(63)
        pair = np.append((side[:-1] == 0) & (side[1:] == 1), False)
        start = np.flatnonzero(~np.concatenate(([False], pair[:-1])))
        both = pair[start]
        nxt = np.minimum(start + 1, len(sym) - 1)
        left, right = np.concatenate(([-EDGE], low)), np.append(high, EDGE)
        lone_right = ~both & (side[start] == 1)
        sym = np.where(both, mix(sym[start] + np.uint64(r), sym[nxt]), sym[start])
        # A pair depends on both of its symbols; one left alone on its neighbour on the other side.
        low = np.where(lone_right, left[start], low[start])
        high = np.where(lone_right, high[start], right[start + 1])
        levels.append((low, high, sym))
        if len(sym) < 2:
            break
    return levels


def least_of(value, first, behind):
    """Place of the least value, leftmost of equals, in every range [first, behind)."""
    import numpy as np

    best, out = np.arange(len(value)), np.zeros(len(first), np.int64)
    size = np.frexp((behind - first).astype(float))[1] - 1  # of the largest power of two inside
    for k in range(int(size.max(initial=0)) + 1):
        if k:
            a, b = best[: -(1 << k - 1)], best[1 << k - 1 :]
            best = np.where(value[b] < value[a], b, a)
        some = np.flatnonzero(size == k)
        a, b = best[first[some]], best[behind[some] - (1 << k)]
        out[some] = np.where(value[b] < value[a], b, a)
    return out


BLANK = bytes(0x20 if 9 <= k <= 13 else k for k in range(256))
LOW = [(1 << 8 * k) - 1 for k in range(9)]  # masks of the first k bytes
LONG = 64


class Split:
    """Words of a text: its bytes, spaces made one kind, and where each word begins and ends."""

    __slots__ = ("data", "starts", "ends")

    def __init__(self, data: bytes, starts, ends):
        self.data, self.starts, self.ends = data, starts, ends

    def __len__(self) -> int:
        return len(self.starts)

    def __getitem__(self, part: slice) -> Split:
        return Split(self.data, self.starts[part], self.ends[part])

    def bytes(self) -> bytes:
        return self.data[self.starts[0] : self.ends[-1]] if len(self.starts) else b""


class Words:
    split = b"\n"  # no word has one

    @staticmethod
    def units(text: str) -> Split:
        import numpy as np

        data = text.encode("utf-8", "surrogatepass").translate(BLANK)
        blank = np.ones(len(data) + 2, np.int8)
        np.equal(np.frombuffer(data, np.uint8), 0x20, out=blank[1:-1].view(bool))
        edges = np.flatnonzero(np.diff(blank))
        return Split(data, edges[::2], edges[1::2])

    @staticmethod
    def body(units: Split) -> bytes:
        return units.bytes()

    @staticmethod
    def joined(parts: list[Split]) -> bytes:
        return b" ".join(w for part in parts for w in part.bytes().split())

    @staticmethod
    def codes(lists: list[Split]):
        """64-bit codes of all words, a list's end marked by one of its own (0)."""
        import numpy as np
        import xxhash

        if not lists:
            return np.zeros(0, np.uint64)
        sizes = np.array([len(x) for x in lists])
        pieces = [x.bytes() for x in lists]
        behind = np.cumsum([len(x) + 1 for x in pieces])
        shift = np.concatenate(([0], behind[:-1])) - np.array([x.starts[0] for x in lists])
        data = b" ".join([*pieces, bytes(8)])
        shift = np.repeat(shift, sizes)
        start = np.concatenate([x.starts for x in lists]) + shift
        size = np.concatenate([x.ends for x in lists]) + shift - start
        eight = np.ndarray((len(data) - 7,), "<u8", data, strides=(1,))  # from every byte on
        low = np.array(LOW, np.uint64)
        code = mix(eight[start] & low[np.minimum(size, 8)], size.astype(np.uint64))
        for k in range(8, LONG, 8):
            at = np.flatnonzero(size > k)
            if not len(at):
                break
            code[at] = mix(code[at], eight[start[at] + k] & low[np.minimum(size[at] - k, 8)])
        for k in np.flatnonzero(size > LONG).tolist():
            code[k] = xxhash.xxh3_64_intdigest(data[start[k] : start[k] + size[k]])
        out = np.zeros(len(code) + len(lists), np.uint64)
        out[np.arange(len(code)) + np.repeat(np.arange(len(lists)), sizes)] = code
        return out

    @classmethod
    def anchors(cls, lists: list[Split], length: int):
        """(anchor, part) of the window from each place, and their (key, route) at given places."""
        import numpy as np

        codes = cls.codes(lists)
        n = max(0, len(codes) - length + 1)
        levels = compressed(codes) if len(codes) else []
        chosen, begin, end = np.full(n, -1), np.zeros(n, np.int64), np.zeros(n, np.int64)
        open_ = np.arange(n)
        for k in reversed(range(len(levels))):
            low, high, sym = levels[k]
            first, behind = np.searchsorted(low, open_), np.searchsorted(high, open_ + length, "right")
            fits = behind > first
            hit, at = open_[fits], least_of(repeats.mix(sym, np.full(1, k, np.uint64)), first[fits], behind[fits])
            chosen[hit], begin[hit], end[hit] = k, low[at], high[at]
            open_ = open_[~fits]
            if not len(open_):
                break
        power = np.full(len(codes) + 1, BASE, np.uint64)
        power[0] = 1
        power = np.multiply.accumulate(power)
        back = np.full(len(codes) + 1, pow(BASE, -1, 1 << 64), np.uint64)
        back[0] = 1
        back = np.multiply.accumulate(back)
        sums = np.concatenate((np.zeros(1, np.uint64), np.add.accumulate(codes * power[:-1]))) if len(codes) else np.zeros(1, np.uint64)
        more = (length - end + begin) // 2
        front = end + more > np.arange(n) + length

        def content(a, b):
            return (sums[b] - sums[a]) * back[a]

        def named(head):
            a, b, wide, before = begin[head], end[head], more[head], front[head]
            sort = (chosen[head] * 64 + b - a).astype(np.uint64)
            key = content(np.where(before, a - wide, a), np.where(before, b, b + wide))
            return repeats.mix(key, sort * np.uint64(2) + before.astype(np.uint64)), repeats.mix(content(a, b), sort)

        return begin * 64 + chosen, front.astype(np.int64), named

    @staticmethod
    def tags(base, place):
        import numpy as np

        return np.zeros_like(place)  # `resolve` asks for none

    @classmethod
    def resolve(cls, bodies: list[bytes], tags, docs, length: int):
        """(smallest document of an equal window, word by word, for every window of all bodies; windows of each)"""
        import numpy as np

        lists = [b.split() for b in bodies]
        sizes = np.array([len(x) for x in lists])
        words = pa.array([w for ws in lists for w in (*ws, b"")], pa.large_binary()).dictionary_encode()
        number = words.indices.to_numpy(zero_copy_only=False).astype(np.uint64)
        wide = max(1, (len(words.dictionary) - 1).bit_length())
        step = min(64 // wide, length)  # so many numbers fit one code
        codes = np.zeros_like(number)
        for k in range(step):
            codes <<= np.uint64(wide)
            codes[: max(0, len(number) - k)] |= number[k:]
        rank, _ = repeats.ranks(codes, length, step)
        owner = np.repeat(np.arange(len(lists)), sizes + 1)
        starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
        real = np.flatnonzero(np.arange(len(rank)) - starts[owner] + length <= sizes[owner])
        least = np.full(int(rank.max()) + 1, np.iinfo(np.int64).max)
        np.minimum.at(least, rank[real].astype(np.int64), docs[owner[real]])
        return least[rank[real].astype(np.int64)], sizes - length + 1


def dedup_words(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) for every row."""
    words = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(SPACE), F.lit(0))
    base = docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("mark"), words.alias("w"))
    base = base.select("doc_id", "mark", F.size("w").cast("long").alias("n_words"), F.sha2(F.array_join("w", " ").cast("binary"), 256).alias("whole"))
    lost = repeats.removals(docs, Words, length)
    return base.join(lost, ["doc_id", "mark"], "left").select("doc_id", "n_words", F.coalesce("n_removed", F.lit(0)).alias("n_removed"), F.coalesce("kept", "whole").alias("kept_sha256"))


def op6_recompression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_words(read(spark, sf_dir, "documents"))
