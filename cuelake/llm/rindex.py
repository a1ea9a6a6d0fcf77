"""Substring dedup over bytes by run-length indexes.

Of documents with equal texts only those of the smallest id take part: the others are removed whole.
Candidate segments that share an anchor meet in one task. A segment alone under its anchor shares
no window with another. Of the others, those of the smallest documents, one of each anchor, make a
collection: its Burrows-Wheeler transform is kept as runs, with the
text place sampled at both ends of every run, and the smallest document of every interval of equal
contexts. The segments behind are streamed through it from right to left. A step extends the match
by one byte (backward search on the runs); where it breaks off, the match goes on from the nearer
end of the next run of that byte, by the length which the text at the sampled place shares with it.
A match of full length reads the interval's document. Segments with windows still open make the next
collection (twice as many of each anchor, again by smallest documents), until none is open: rounds
follow the logarithm of the most segments of an anchor.

The anchor of a window is its minimizer, the byte string of `GRAM` bytes with the least hash,
leftmost of equals; its key for the filter takes in half of the remaining bytes behind it or, where the window ends
before these, in front of it. See `repeats` for the passes.

Defined cases: a null or empty text has no bytes; rows with a null doc_id lose nothing and cause no
loss; rows that repeat an id do not remove each other; equal rows come back as often as they come
in; empty tables give no rows; other columns are ignored. Bytes left over may split characters, so
only their hash is returned; matches never cross documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm import repeats
from cuelake.llm.common import read, stage, unstage

LENGTH = 50
GRAM = 16
PLACE_BITS = 24  # of a byte among those worked on together

END = 0xFF  # no byte of UTF-8
POWERS = [1 << 8 * k for k in range(1, 8)]


class RunIndex:
    """Run-compressed transform of a byte collection.

    Contexts are sorted to the end of their part, equal ones by part: a step from a row leads to the row
    of the place before, so that places are known from the samples on. Kept of a run: byte, first row, size, and the places of the text at its first and last row. Kept
    of an interval of contexts that share `length` bytes: first row and smallest document.
    """

    def __init__(self, text, documents, length: int):
        """documents: of each byte; every part of the text ends with END."""
        import numpy as np

        n = len(text)
        wide = np.concatenate((text, np.zeros(length + 16, np.uint8))).astype(np.uint64)
        self.eight = np.zeros(n + length + 8, np.uint64)  # bytes from every place on, first byte highest
        for k in range(8):
            self.eight = (self.eight << np.uint64(8)) | wide[k : k + len(self.eight)]
        self.n, self.length = n, length
        ends = np.flatnonzero(text == END)
        rest = np.repeat(ends, np.diff(ends, prepend=-1)) - np.arange(n) + 1  # bytes to the end of the part
        short = self.eight[:n] >> (8 * np.maximum(8 - rest, 0)).astype(np.uint64) << (8 * np.maximum(8 - rest, 0)).astype(np.uint64)
        _, order = repeats.ranks(short, int(rest.max()), 8, rest)
        interval = np.concatenate(([True], self.shared(order[:-1], order[1:]) < length))
        self.starts = np.flatnonzero(interval)
        self.sample = np.minimum.reduceat(documents[order], self.starts)
        self.own = np.empty(n, np.int64)  # of the collection's own places
        self.own[order] = self.sample[np.cumsum(interval) - 1]
        self.top = order[0]
        before = text[order - 1]  # the transform; the first byte is preceded by the last
        head = np.flatnonzero(np.concatenate(([True], before[1:] != before[:-1])))
        size = np.diff(np.append(head, n))
        by = np.argsort(before[head], kind="stable")  # runs of each byte, in order
        self.byte = np.append(before[head[by]].astype(np.int64), 256)  # none past the last run
        self.begin, self.size = np.append(head[by], n), np.append(size[by], 0)
        self.key = self.byte[:-1] * (n + 1) + self.begin[:-1]
        self.so_far = np.cumsum(self.size) - self.size  # rows before a run, bytes in order: where a step leads
        self.front, self.tail = np.append(order[head[by]], 0), np.append(order[head[by] + size[by] - 1], 0)

    def shared(self, a, b):
        """Length that the texts at two places share, up to `length`."""
        import numpy as np

        out, open_, powers = np.zeros(len(a), np.int64), np.arange(len(a)), np.array(POWERS, np.uint64)
        for k in range(0, self.length, 8):
            differ = self.eight[a[open_] + k] ^ self.eight[b[open_] + k]
            out[open_] += np.where(differ == 0, 8, 7 - np.searchsorted(powers, differ, "right"))
            open_ = open_[differ == 0]
            if not len(open_):
                break
        return np.minimum(out, self.length)

    def stream(self, text, last, stop):
        """Matching statistics, cut to `length`, of many strings at once, from byte `last` back to
        `stop`: (place, document) wherever the match has full length."""
        import numpy as np

        at, stop = last.copy(), stop.copy()
        row, place, size = np.zeros(len(at), np.int64), np.full(len(at), self.top), np.zeros(len(at), np.int64)
        while len(at):
            byte = text[at].astype(np.int64)
            run = np.searchsorted(self.key, byte * (self.n + 1) + row, "right") - 1
            here = (run >= 0) & (self.byte[run] == byte)
            broken = np.flatnonzero(~here | (row >= self.begin[run] + self.size[run]))
            if len(broken):
                above, below, old = run[broken], run[broken] + 1, place[broken]
                none = np.full(len(broken), -1)
                up, down = none.copy(), none.copy()
                ok = np.flatnonzero(here[broken])
                up[ok] = self.shared(self.tail[above[ok]], old[ok])
                ok = np.flatnonzero(self.byte[below] == byte[broken])
                down[ok] = self.shared(self.front[below[ok]], old[ok])
                high = up >= down
                run[broken] = np.where(high, above, below)
                row[broken] = np.where(high, self.begin[above] + self.size[above] - 1, self.begin[below])
                place[broken] = np.where(high, self.tail[above], self.front[below])
                size[broken] = np.minimum(size[broken], np.maximum(up, down))  # -1: the byte is nowhere
            row = self.so_far[run] + row - self.begin[run]
            place = place - 1
            size = np.minimum(size + 1, self.length)
            lost = np.flatnonzero(size == 0)
            row[lost], place[lost] = 0, self.top
            full = np.flatnonzero(size == self.length)
            if len(full):
                yield at[full], self.sample[np.searchsorted(self.starts, row[full], "right") - 1]
            more = at > stop
            if not more.all():
                row, place, size, at, stop = row[more], place[more], size[more], at[more], stop[more]
            at = at - 1


class Bytes:
    split = bytes([END])

    @staticmethod
    def units(text: str) -> bytes:
        return text.encode("utf-8", "surrogatepass")

    @staticmethod
    def body(units: bytes) -> bytes:
        return units

    @staticmethod
    def joined(parts: list[bytes]) -> bytes:
        return b"".join(parts)

    @staticmethod
    def anchors(pieces: list[bytes], length: int):
        """(anchor, part) of the window from each place, and their (key, route) at given places."""
        import numpy as np

        text = bytes([END]).join([*pieces, bytes(8)])
        n, more = len(text) - 8, (length - GRAM) // 2
        eight = np.ndarray((n + 1,), "<u8", text, strides=(1,)).copy()  # from every byte on
        hashed = repeats.mix(eight[: max(0, n - GRAM + 1)], eight[GRAM - 8 : n - 7])
        # Least hash and its place in one number; the least of a window by doubling.
        least, wide, size = (hashed & np.uint64((1 << 64) - (1 << PLACE_BITS))) | np.arange(len(hashed), dtype=np.uint64), length - GRAM + 1, 1
        while size < wide:
            step = min(size, wide - size)
            least = np.minimum(least[:-step], least[step:])
            size += step
        at = (least & np.uint64((1 << PLACE_BITS) - 1)).astype(np.int64)
        front = at + GRAM + more > np.arange(len(at)) + length

        def named(head):
            found, before = at[head], front[head]
            since = np.where(before, found - more, found + GRAM)
            beside = np.full(len(head), more, np.uint64)
            for k in range(0, more, 8):
                short = np.uint64((1 << 8 * min(8, more - k)) - 1)
                beside = repeats.mix(beside, eight[since + k] & short)
            return repeats.mix(hashed[found], beside + before.astype(np.uint64)), hashed[found]

        return at, front.astype(np.int64), named

    @staticmethod
    def tags(base, place):
        return base - place  # of a segment: where its anchor stands

    @staticmethod
    def resolve(bodies: list[bytes], tags, docs, length: int):
        """(smallest document that holds it, for every window of all bodies; windows of each)"""
        import numpy as np

        sizes = np.array([len(b) for b in bodies])
        joined = bytes([END]).join([*bodies, b""])
        text = np.frombuffer(joined, np.uint8)
        starts = np.cumsum(sizes + 1) - sizes - 1
        eight = np.ndarray((len(joined) - 7,), "<u8", joined, strides=(1,))
        one, two = eight[starts + tags], eight[starts + tags + 8]  # the anchor, GRAM bytes
        order = np.lexsort((docs, two, one))
        new = np.concatenate(([True], (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])))
        first = np.flatnonzero(new)
        nth = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
        least = np.full(len(text), np.iinfo(np.int64).max)
        windows = sizes - length + 1

        def places(of, n):
            """First n[k] places of each body, body by body."""
            return np.repeat(starts[of] - (np.cumsum(n) - n), n) + np.arange(n.sum())

        leaders = order[first]
        least[places(leaders, windows[leaders])] = np.repeat(docs[leaders], windows[leaders])
        alone = np.repeat(np.diff(np.append(first, len(order))) == 1, np.diff(np.append(first, len(order))))
        order, nth = order[~alone], nth[~alone]
        # Whole anchors, about AT_ONCE bytes at a time.
        heads = np.flatnonzero(nth == 0)
        lot = np.repeat((np.cumsum(sizes[order]) // repeats.AT_ONCE)[heads], np.diff(np.append(heads, len(order))))
        for cut in np.split(np.arange(len(order)), np.flatnonzero(np.diff(lot)) + 1):
            some, level = order[cut], np.frexp(nth[cut] + 1.0)[1] - 1  # 1, 2, 4, ... of an anchor
            while len(some):
                now = level == level.min()
                held, some, level = some[now], some[~now], level[~now]
                at = places(held, sizes[held] + 1)
                index = RunIndex(text[at], np.repeat(docs[held], sizes[held] + 1), length)
                least[at] = np.minimum(least[at], index.own)
                for place, document in index.stream(text, starts[some] + sizes[some] - 1, starts[some]):
                    least[place] = np.minimum(least[place], document)
                if len(some):
                    open_ = np.maximum.reduceat(least[places(some, windows[some])], np.cumsum(windows[some]) - windows[some]) == np.iinfo(np.int64).max
                    some, level = some[open_], level[open_]
        at = np.arange(len(bodies))
        return least[places(at, windows)], windows


def dedup_bytes(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for every row."""
    text = F.coalesce("text", F.lit("")).cast("binary")
    base = docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("mark"), F.octet_length(text).cast("long").alias("n_bytes"), F.sha2(text, 256).alias("whole"))
    texts = stage(base, "texts")
    able = texts.where((F.col("n_bytes") >= length) & F.col("doc_id").isNotNull())
    # Of equal texts only those of the smallest id are gone through: the others lose every byte, and no window starts in them first.
    copied = stage(able.groupBy("whole").agg(F.min("doc_id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").select("whole", "first"), "copied")
    base = stage(texts.join(copied, "whole", "left").withColumn("copy", F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))).drop("first"), "documents")
    unstage(texts)
    unstage(copied)
    heads = base.where(~F.col("copy") & (F.col("n_bytes") >= length) & F.col("doc_id").isNotNull()).select("doc_id", "mark")
    lost = repeats.removals(docs, Bytes, length, heads)
    joined = base.join(lost, ["doc_id", "mark"], "left")
    copy = F.col("copy")
    return joined.select(
        "doc_id", "n_bytes", F.when(copy, F.col("n_bytes")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(copy, F.lit(1).cast("long")).otherwise(F.coalesce("n_spans", F.lit(0))).alias("n_spans"),
        F.when(copy, F.sha2(F.lit(b""), 256)).otherwise(F.coalesce("kept", "whole")).alias("kept_sha256"))


def op7_rindex(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_bytes(read(spark, sf_dir, "documents"))
