"""Repeats of a fixed length across documents: the passes that both substring operators share.

A method names, for every window of `length` units (bytes or words), an anchor: a part of the
window chosen by the window's content alone, so that equal windows have equal anchors wherever
they stand. An anchor has a route, by which its windows meet, and a key, which may take in more of
the window, for the filter. Then:

1. every document's anchors, with the smallest and largest document per key already taken in each
   task, meet by hash range; keys of two documents or more set bits of a filter of fixed size;
2. texts are read again; runs of windows with one anchor in the filter become segments;
3. distinct segments meet by route; the method finds, for every window in them, the smallest
   document that holds it (`resolve`), on exact content;
4. answers join the segments' places; windows held by a smaller document mark their units.

A hot passage is one segment in step 3 (each task sends it once), and a skewed key of the inner join in
step 4, which adaptive execution splits. Texts move once, compressed. The filter costs 2^FILTER_BITS bits (32 MB) at any scale; where a corpus overfills it, it lets more
segments pass and results stay the same.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuelake.llm.common import stage

FILTER_BITS = 28
BLOCK_BITS = 9  # a key sets three bits in one block of 512
KEY_BITS = 46
AT_ONCE = 1 << 19  # units worked on together
ROWS = 64  # read together
FLUSH = 1 << 21  # keys sent together
FLUSH_BYTES = 1 << 26  # of segments sent together
MARK_BITS = 24
SHARED = 1 << 18  # shared keys, about, to a part
LEVEL = 3  # of compression, for what is shuffled


def mix(x, y):
    import numpy as np

    z = (x ^ (y * np.uint64(0x9E3779B97F4A7C15))) * np.uint64(0xBF58476D1CE4E5B9)
    z ^= z >> np.uint64(29)
    z = (z + y) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(32))


def _squeezed(values) -> bytes:
    import numpy as np
    import zstandard

    raw = np.ascontiguousarray(values, "<u8").view(np.uint8).reshape(-1, 8).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(raw).tobytes())


def _widened(data: bytes):
    import numpy as np
    import zstandard

    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(raw.reshape(8, -1).T).view("<u8").reshape(-1)


def _per_key(keys, low, high):
    """Distinct keys, sorted, with the least low and the largest high."""
    import numpy as np

    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))) if len(keys) else np.zeros(0, np.int64)
    if not len(keys):
        return keys, low, high
    return keys[first], np.minimum.reduceat(low[order], first), np.maximum.reduceat(high[order], first)


def _bits(keys):
    """(word of the filter in bytes, three bit masks) of 46-bit keys."""
    import numpy as np

    block = (keys >> np.uint64(KEY_BITS - FILTER_BITS + BLOCK_BITS)).astype(np.int64)
    for k in range(3):
        bit = ((keys >> np.uint64(k * BLOCK_BITS)) & np.uint64((1 << BLOCK_BITS) - 1)).astype(np.int64)
        yield block * (1 << (BLOCK_BITS - 3)) + (bit >> 3), np.left_shift(1, bit & 7).astype(np.uint8)


def _groups(batch, method, length, heads=None):
    """Documents of an Arrow batch (doc_id, mark, text, bit), cut and gathered to about AT_ONCE units:
    lists of (doc_id, mark, first unit, units), pieces overlapping by length - 1. Of heads, a bitmap:
    documents without their bit are left out."""
    group, room = [], AT_ONCE
    if heads is not None:
        import numpy as np

        bits = batch.column(3).to_numpy()
        batch = batch.take(pa.array(np.flatnonzero(heads.value[bits >> 3] >> (bits & 7).astype(np.uint8) & 1)))
    batch = batch.select([0, 1, 2])
    few = (batch.slice(k, ROWS) for k in range(0, batch.num_rows, ROWS))
    for doc, mark, text in (row for rows in few for row in zip(*(c.to_pylist() for c in rows.columns), strict=True)):
        if doc is None or not text:
            continue
        units = method.units(text)
        for at in range(0, max(0, len(units) - length + 1), AT_ONCE):
            piece = units[at : at + AT_ONCE + length - 1]
            group.append((doc, mark, at, piece))
            room -= len(piece)
            if room <= 0:
                yield group
                group, room = [], AT_ONCE
    if group:
        yield group


def _runs(group, method, length):
    """Runs of windows with one key: (key, route, base, tag, item of the group, first window, windows)."""
    import numpy as np

    sizes = np.array([len(g[3]) for g in group])
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    base, part, named = method.anchors([g[3] for g in group], length)  # over the group, units parted by one
    n = len(base)
    item = np.repeat(np.arange(len(group)), sizes + 1)[:n]
    where = np.flatnonzero(np.arange(n) - starts[item] + length <= sizes[item])
    if not len(where):
        return (np.zeros(0, np.uint64), np.zeros(0, np.uint64), *[np.zeros(0, np.int64)] * 5)
    new = np.concatenate(([True], (base[1:] != base[:-1]) | (part[1:] != part[:-1]) | (item[1:] != item[:-1])))
    opens = new[where]
    opens[0] = True
    first = np.flatnonzero(opens)
    head = where[first]
    return *named(head), base[head], method.tags(base[head], head), item[head], head - starts[item[head]], np.diff(np.append(first, len(where)))


def shared_filter(rows: DataFrame, method, length: int, heads=None):
    """(filter of the anchor keys that two documents or more hold, number of these keys)"""
    import numpy as np

    wide = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    split = min(10, max(4, (wide * 2 - 1).bit_length()))  # key ranges, at least twice the tasks up to 1024

    def send(parts):
        held, n = [], 0

        def flushed():
            keys, low, high = _per_key(*(np.concatenate(x) for x in zip(*held, strict=True)))
            edges = np.searchsorted(keys, np.arange((1 << split) + 1, dtype=np.uint64) << np.uint64(KEY_BITS - split))
            for k in range(1 << split):
                a, b = edges[k], edges[k + 1]
                if b > a:
                    yield k, _squeezed(np.diff(keys[a:b], prepend=np.uint64(0))), _squeezed(low[a:b].view(np.uint64)), _squeezed((high[a:b] - low[a:b]).view(np.uint64))

        def batch(rows_out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows_out, strict=True), (pa.int32(), pa.binary(), pa.binary(), pa.binary()), strict=True)], names=["part", "k", "low", "more"])

        for part in parts:
            for group in _groups(part, method, length, heads):
                keys, _, _, _, item, _, _ = _runs(group, method, length)
                docs = np.array([g[0] for g in group], np.int64)[item]
                held.append(_per_key(keys >> np.uint64(64 - KEY_BITS), docs, docs))
                n += len(held[-1][0])
                if n >= FLUSH:
                    yield batch(list(flushed()))
                    held, n = [], 0
        if n:
            yield batch(list(flushed()))

    def meet(table):
        parts = [(np.cumsum(_widened(k)).astype(np.uint64), _widened(a).view(np.int64), _widened(d).view(np.int64)) for k, a, d in zip(*(table.column(x).to_pylist() for x in ("k", "low", "more")), strict=True)]
        keys, low, high = _per_key(*(np.concatenate(x) for x in zip(*((k, a, a + d) for k, a, d in parts), strict=True)))
        shared = keys[low < high]
        at = table.column("part")[0].as_py()
        size = (1 << FILTER_BITS) // 8 >> split
        out = np.zeros(size, np.uint8)
        for word, mask in _bits(shared):
            np.bitwise_or.at(out, word - at * size, mask)
        import zstandard

        return pa.table({"part": pa.array([at], pa.int32()), "n": pa.array([len(shared)], pa.int64()), "bits": pa.array([zstandard.compress(out.tobytes())], pa.binary())})

    import zstandard

    sent = rows.mapInArrow(send, "part int, k binary, low binary, more binary")
    slices = sent.groupBy("part").applyInArrow(meet, "part int, n long, bits binary").collect()
    size = (1 << FILTER_BITS) // 8 >> split
    whole = np.zeros((1 << FILTER_BITS) // 8, np.uint8)
    for row in slices:
        whole[row["part"] * size : (row["part"] + 1) * size] = np.frombuffer(zstandard.decompress(bytes(row["bits"])), np.uint8)
    return whole, sum(row["n"] for row in slices)


#: Of a text for the shuffle, and back.
def packed(text: str) -> bytes:
    import zstandard

    return zstandard.compress(text.encode("utf-8", "surrogatepass"), LEVEL)


SEGMENTS = "part int, id long, doc_id long, mark int, start long, bodies binary, tags binary, low binary, more binary"


def segments(rows: DataFrame, method, length: int, bits, shared: int, heads=None) -> DataFrame:
    """Places of candidate segments, one a row, and their distinct contents, packed by part.

    A segment is named by its part and a 64-bit hash of its content. Parts follow the number of
    shared keys, so that one holds about as much whatever the corpus.
    """
    spark = rows.sparkSession
    filled = spark.sparkContext.broadcast(bits)
    parts_n = max(16, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")), shared // SHARED)
    kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), *[pa.binary()] * 4]
    names = [x.split()[0] for x in SEGMENTS.split(", ")]

    def find(parts):
        import numpy as np
        import xxhash
        import zstandard

        full, held = filled.value, {}

        def contents():
            for part, bodies in held.items():
                docs = np.array(list(bodies.values()), np.int64)
                packs = [zstandard.compress(x, LEVEL) for x in (method.split.join(bodies), docs[:, 2].astype(np.uint8).tobytes())]
                yield [part, None, None, None, None, *packs, _squeezed(np.ascontiguousarray(docs[:, 0]).view(np.uint64)), _squeezed((docs[:, 1] - docs[:, 0]).view(np.uint64))]

        def batch(out):
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True), kinds, strict=True)], names=names)

        room = FLUSH_BYTES
        for part in parts:
            for group in _groups(part, method, length, heads):
                keys, route, base_at, tag, item, first, count = _runs(group, method, length)
                hit = np.ones(len(keys), bool)
                for word, mask in _bits(keys >> np.uint64(64 - KEY_BITS)):
                    hit &= (full[word] & mask) != 0
                # Neighbouring runs of one anchor make one segment.
                at = np.flatnonzero(hit)
                joins = np.concatenate(([False], (np.diff(at) == 1) & (base_at[at[1:]] == base_at[at[:-1]]) & (item[at[1:]] == item[at[:-1]]))) if len(at) else hit[:0]
                head = np.flatnonzero(~joins)
                total = np.add.reduceat(count[at], head) if len(at) else count[:0]
                at = at[head]
                out = []
                for where, t, i, a, n in zip((route[at] % np.uint64(parts_n)).tolist(), tag[at].tolist(), item[at].tolist(), first[at].tolist(), total.tolist(), strict=True):
                    doc, mark, base, units = group[i]
                    body = method.body(units[a : a + n + length - 1])
                    digest = xxhash.xxh3_64_intdigest(body)
                    out.append((where, digest - (1 << 64) if digest >> 63 else digest, doc, mark, base + a, None, None, None, None))
                    bodies = held.setdefault(where, {})
                    seen = bodies.get(body)
                    if seen is None:
                        bodies[body] = (doc, doc, t)
                        room -= len(body) + 100
                    else:
                        bodies[body] = (min(seen[0], doc), max(seen[1], doc), t)
                if out:
                    yield batch(out)
                if room <= 0:
                    yield batch(list(contents()))
                    held, room = {}, FLUSH_BYTES
        if held:
            yield batch(list(contents()))

    return rows.mapInArrow(find, SEGMENTS)


def marked(doc: int, start: int, least, length: int) -> list[tuple[int, int]]:
    """Joined spans of the windows of a place whose smallest document is before `doc`."""
    import numpy as np

    at = np.flatnonzero(least < doc)
    if not len(at):
        return []
    cut = np.flatnonzero(np.diff(at) > length)
    return list(zip((start + at[np.concatenate(([0], cut + 1))]).tolist(), (start + at[np.append(cut, len(at) - 1)] + length).tolist(), strict=True))


def bitmap(names: DataFrame) -> dict[int, bytes]:
    """Bits of fixed number that stand for (doc_id, mark), in slices by number."""
    bits = names.select((_bit() + 1).alias("bit"))
    maps = bits.groupBy(F.bitmap_bucket_number("bit").alias("k")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("bit")).alias("map"))
    return {r["k"] - 1: bytes(r["map"]) for r in maps.collect()}


def _bit():
    return F.pmod(F.xxhash64("doc_id", "mark"), F.lit(1 << MARK_BITS))


def removals(docs: DataFrame, method, length: int, heads: DataFrame | None = None) -> DataFrame:
    """(doc_id, mark, n_removed, n_spans, kept_sha256) of the documents that lose something.

    docs: (doc_id, text); mark is a hash of the text, for rows that repeat an id. heads, (doc_id, mark):
    documents to go through, where the others are known to hold no window before them (a few of the
    others may be gone through as well).
    """
    import numpy as np

    rows = docs.select(F.col("doc_id").cast("long"), F.hash("text").alias("mark"), "text").withColumn("bit", _bit())
    wanted = None
    if heads is not None:
        flat = np.zeros((1 << MARK_BITS) // 8, np.uint8)
        for k, part in bitmap(heads).items():
            flat[k * len(part) : (k + 1) * len(part)] = np.frombuffer(part, np.uint8)
        wanted = rows.sparkSession.sparkContext.broadcast(flat)
    found = stage(segments(rows, method, length, *shared_filter(rows, method, length, wanted), wanted), "segments")

    def resolve(table):
        import numpy as np
        import xxhash
        import zstandard

        bodies: dict[bytes, list] = {}
        for packed_bodies, tags, low, more in zip(*(table.column(c).to_pylist() for c in ("bodies", "tags", "low", "more")), strict=True):
            low = _widened(low).view(np.int64)
            for body, tag, a, d in zip(zstandard.decompress(packed_bodies).split(method.split), zstandard.decompress(tags), low.tolist(), _widened(more).view(np.int64).tolist(), strict=True):
                row = bodies.setdefault(body, [tag, a, a + d])
                row[1], row[2] = min(row[1], a), max(row[2], a + d)
        tags, lows, highs = (np.array(x, np.int64) for x in zip(*bodies.values(), strict=True))
        names = np.array([xxhash.xxh3_64_intdigest(b) for b in bodies], np.uint64).view(np.int64)
        least, sizes = method.resolve(list(bodies), tags, lows, length)
        begin = np.cumsum(sizes) - sizes
        low, high = np.minimum.reduceat(least, begin), np.maximum.reduceat(least, begin)
        keep = np.flatnonzero(low < highs)
        # One number stands for an answer that is the same for all windows of a segment.
        short = np.where(low == high, 1, sizes)[keep]
        edges = np.append(0, np.cumsum(short))
        at = np.repeat(begin[keep] - edges[:-1], short) + np.arange(edges[-1])
        lists = pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(least[at], pa.int64()))
        part = table.column("part")[0].as_py()
        return pa.table({"part": pa.array(np.full(len(keep), part), pa.int32()), "id": pa.array(names[keep], pa.int64()), "n": pa.array(sizes[keep], pa.int32()), "least": lists})

    answers = found.where("bodies IS NOT NULL").select("part", "bodies", "tags", "low", "more").groupBy("part").applyInArrow(resolve, "part int, id long, n int, least array<long>")
    places = found.where("bodies IS NULL").select("part", "id", "doc_id", "mark", "start").join(answers, ["part", "id"]).where(F.array_min("least") < F.col("doc_id"))

    def spans(parts):
        import numpy as np

        for part in parts:
            out = []
            for d, m, s, n, least in zip(*(part.column(k).to_pylist() for k in range(4)), part.column(4), strict=True):
                if len(least) == 1:  # it is smaller, or the place would not be here
                    out.append((d, m, s, s + n - 1 + length))
                else:
                    out += [(d, m, a, b) for a, b in marked(d, s, np.asarray(least.values.to_numpy()), length)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out, strict=True) if out else [[]] * 4, (pa.int64(), pa.int32(), pa.int64(), pa.int64()), strict=True)], names=["doc_id", "mark", "a", "b"])

    lost = places.select("doc_id", "mark", "start", "n", "least").mapInArrow(spans, "doc_id long, mark int, a long, b long")
    lost = stage(lost.groupBy("doc_id", "mark").agg(F.array_sort(F.collect_set(F.struct("a", "b"))).alias("spans")), "spans")
    # A bitmap of fixed size keeps most of the texts that lose nothing out of the shuffle.
    losing = rows.sparkSession.sparkContext.broadcast(bitmap(lost))

    def pack(parts):
        for part in parts:
            at, size = [], 8 * 4096
            for k, b in enumerate(part.column(3).to_pylist()):
                bits = losing.value.get(b // size)
                if bits is not None and bits[b % size >> 3] >> (b & 7) & 1:
                    at.append(k)
            kept = part.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays([kept.column(0), kept.column(1), pa.array([packed(t) for t in kept.column(2).to_pylist()], pa.binary())], names=["doc_id", "mark", "body"])

    texts = rows.where("doc_id IS NOT NULL AND text IS NOT NULL").mapInArrow(pack, "doc_id long, mark int, body binary")

    def keep(parts):
        import zstandard

        for part in parts:
            out = []
            for body, found_spans in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), strict=True):
                units = method.units(zstandard.decompress(body).decode("utf-8", "surrogatepass"))
                kept, end, removed, n = [], 0, 0, 0
                for s in found_spans:
                    if n == 0 or s["a"] > end:
                        kept.append(units[end : s["a"]])
                        n += 1
                        removed -= s["a"]
                        removed += s["b"]
                        end = s["b"]
                    elif s["b"] > end:
                        removed += s["b"] - end
                        end = s["b"]
                kept.append(units[end:])
                out.append((removed, n, hashlib.sha256(method.joined(kept)).hexdigest()))
            a, b, c = zip(*out, strict=True) if out else ([], [], [])
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(a, pa.int64()), pa.array(b, pa.int64()), pa.array(c, pa.string())], names=["doc_id", "mark", "n_removed", "n_spans", "kept"])

    return texts.join(lost, ["doc_id", "mark"]).mapInArrow(keep, "doc_id long, mark int, n_removed long, n_spans long, kept string").distinct()


def ranks(codes, length: int, step: int = 1, rest=None):
    """(number of the string of `length` units from each place, places in the order of the numbers):
    equal strings have equal numbers; past the end counts as 0.

    codes stand for `step` units each; exact doubling to `length`. rest: units before a string ends,
    which codes take into account; with it, places of equal strings keep their order.
    """
    import numpy as np

    def numbered(key, kind=None):
        order = np.argsort(key, kind=kind)
        ordered = key[order]
        rank = np.empty(len(key), np.uint64)
        rank[order] = np.cumsum(np.concatenate(([True], ordered[1:] != ordered[:-1])))
        return rank, order

    stable = None if rest is None else "stable"
    rank, order = numbered(codes, stable if step >= length else None)
    while step < length:
        ahead = min(step, length - step)
        later = np.zeros_like(rank)
        later[: max(0, len(rank) - ahead)] = rank[ahead:]
        if rest is not None:
            later[rest <= ahead] = 0
        step += ahead
        rank, order = numbered(rank * np.uint64(len(rank) + 2) + later, stable if step >= length else None)
    return rank, order
