"""SimHash near duplicates by multi-index hashing.

Fingerprints come from one Arrow pass over the texts; everything after it is joins on 64-bit
numbers. Equal fingerprints collapse before any pair is looked for. Two fingerprints within
`max_distance` bits agree, in at least one of `max_distance // 2 + 1` segments, up to one bit:
every fingerprint looks up its segment values and their one-bit neighbours in the table of
segment values, and whole distances decide. A fingerprint has a bounded number of neighbours
within three bits (43,744), so links grow with the distinct fingerprints and not with copies. Crowds of
near copies are joined first, over the values next to them, so their pairs are not listed either.

Defined cases: a null text counts as empty; a text without words has fingerprint zero, which
links like any other; repeated rows come back as often as they come in; a row whose doc_id is null
gets its component's smallest id (null where the component has none); empty tables give no rows;
other columns of the input are ignored.

`similar_groups` is for corpora: beside the links of SimHash (`bits`) those of true similarity, |A and B| / |A or B| >= 0.8 over the sets
of five-word shingles. A radius of bits that reaches 0.8 leaves no segment long enough to look up (15 of
100 bits differ there, so 28 bits agree up to one in 6 of 100 pairs). So pairs meet where they share two of the
`SKETCH` smallest shingle hashes of each (missed by less than 1 in 10,000 pairs at 0.8), each pair at one
key only: that of their two smallest shared hashes. Before the sets themselves decide, two sketches
drop the unlike: parities of 512 shingle classes, of which two sets differ in no more than the
shingles that only one of them has (an exact bound), and, for large sets, SimHash of 256 bits.
Equal sets collapse first. Then every row of a key is compared with the key's first, those left in other
groups with one dealt by hash for each key (so a crowd meets up to 28 of its own), and only rows of
a key that this leaves in different groups are compared with each other.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuelake.llm.common import components, few_at_a_time, fresh, read, stage, unstage

BITS_AT_ONCE = 1 << 16
SHINGLE = 5
SKETCH = 8
#: Fingerprints of 256 bits of sets of MANY shingles or more; at 0.8, 39 bits differ (deviation 6),
#: and fewer than 1 in 1,000,000 such pairs lie beyond FAR.
FAR, MANY = 72, 64
#: Words of the table that tells which shingle sets have a candidate partner.
SIEVE = 1 << 18
PRINTS, PARITIES, FEW = [f"f{k}" for k in range(4)], [f"o{k}" for k in range(8)], [f"k{k}" for k in range(SKETCH)]


def simhash(text: str | None, width: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint: majority of the bits of XXH64 over word shingles."""
    import numpy as np
    import xxhash

    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z only, ASCII space only
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    if len(words) <= width:
        spans = [(0, len(line))]
    else:
        first = np.concatenate(([0], ends[: len(words) - width] + 1))
        spans = zip(first.tolist(), ends[width - 1 :].tolist(), strict=True)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(line[a:b], seed) for a, b in spans], dtype="<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), BITS_AT_ONCE):
        part = hashes[at : at + BITS_AT_ONCE].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42) -> DataFrame:
    """(doc_id, fp) for every row."""

    def batches(parts):
        for part in parts:
            fps = [simhash(text, width, seed) for text in part.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(batches, "doc_id long, fp long")


def segment_table(fps: DataFrame, max_distance: int) -> DataFrame:
    """The rows of `fps`, one for each segment: part, its size in bits, value."""
    n = max_distance // 2 + 1
    cuts = [64 * k // n for k in range(n + 1)]
    parts = []
    for k in range(n):
        size = cuts[k + 1] - cuts[k]
        mask = (1 << size) - 1
        value = F.shiftrightunsigned("fp", cuts[k])
        parts.append(F.struct(F.lit(k).alias("part"), F.lit(size).alias("size"), (value if size == 64 else value.bitwiseAND(F.lit(mask))).alias("value")))
    return fps.withColumn("s", F.explode(F.array(*parts))).select(*fps.columns, "s.*")


def crowded_links(fps: DataFrame, max_distance: int) -> DataFrame:
    """(u, v): some links within two bits, 64 a fingerprint at most, among those that share a segment with another.

    Two fingerprints next to one 64-bit value are within two bits of each other, so each is linked
    with the smallest next to that value: a crowd of near copies is joined without its pairs.
    """
    table = segment_table(fps, max_distance)
    crowds = table.groupBy("part", "value").agg(F.min("fp").alias("a"), F.max("fp").alias("b")).where("a <> b")
    crowd = table.join(crowds, ["part", "value"], "left_semi").select("fp").distinct()
    balls = crowd.select("fp", F.explode(F.expr("concat(array(fp), transform(sequence(0, 63), k -> fp ^ shiftleft(1L, k)))")).alias("hub"))
    least = balls.groupBy("hub").agg(F.min("fp").alias("v"), F.max("fp").alias("w")).where("v <> w").select("hub", "v")
    return balls.join(least, "hub").where("fp <> v").select(F.col("fp").alias("u"), "v").distinct()


def near_pairs(fps: DataFrame, max_distance: int = 3) -> DataFrame:
    """(u, v): distinct fingerprints u > v at `max_distance` bits or fewer; with a column `group`, only
    those that are not of one group.

    A pair one bit apart in a segment is looked up from the side that has a zero there, so each
    ball holds only the zeros flipped to one, and the value itself (first).
    """
    table = segment_table(fps if "group" in fps.columns else fps.withColumn("group", F.lit(None).cast("long")), max_distance)
    ball = F.expr("concat(array(value), transform(filter(sequence(0, size - 1), k -> (shiftrightunsigned(value, k) & 1L) = 0L), k -> value | shiftleft(1L, k)))")
    probes = table.select(F.col("fp").alias("own"), "group", "part", F.posexplode(ball).alias("flipped", "probe"))
    hit = probes.alias("p").join(
        table.alias("t"),
        (F.col("p.part") == F.col("t.part")) & (F.col("p.probe") == F.col("t.value"))
        & F.coalesce(F.col("p.group") != F.col("t.group"), F.lit(True))
        & (F.bit_count(F.col("p.own").bitwiseXOR(F.col("t.fp"))) <= max_distance)
        & ((F.col("p.flipped") > 0) | (F.col("p.own") < F.col("t.fp"))),
    )
    return hit.select(F.greatest("own", "fp").alias("u"), F.least("own", "fp").alias("v")).distinct()


def print_groups(fps: DataFrame, max_distance: int) -> DataFrame:
    """(node, root): components of the distinct fingerprints `fps`, linked at `max_distance` bits or fewer.

    Crowds are joined first; all other links are looked up between what that leaves apart.
    """
    if max_distance < 2:
        return components(near_pairs(fps, max_distance))
    crowds = components(crowded_links(fps, max_distance)).select(F.col("node").alias("fp"), F.col("root").alias("group"))
    apart = near_pairs(fps.join(crowds, "fp", "left"), max_distance)
    return components(apart.union(crowds.select(F.col("fp").alias("u"), F.col("group").alias("v"))))


def near_groups(docs: DataFrame, width: int = 3, seed: int = 42, max_distance: int = 3) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest id reachable."""
    fps = stage(fingerprints(docs, width, seed), "fps")
    roots = print_groups(fps.select("fp").distinct(), max_distance)
    smallest = fps.groupBy("fp").agg(F.min("doc_id").alias("low")).join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    smallest = smallest.withColumn("root", F.coalesce("root", "fp"))
    low = smallest.groupBy("root").agg(F.min("low").alias("component_id"))
    named = smallest.select("fp", "root").join(low, "root").select("fp", "component_id")
    return fps.join(named, "fp")


def shingle_sets(docs: DataFrame, width: int = SHINGLE, seed: int = 42) -> DataFrame:
    """(doc_id, mark, node, fp, size, f0 .. f3, o0 .. o7, k0 .. k7, keys, hashes) for every row; equal sets
    have equal nodes, rows of equal text equal marks; `fp` is the fingerprint of `fingerprints`.

    `hashes` are the set itself (32 bits of each hash: a wrong match takes two shingles that
    share them, one in four billion, and counts as one shingle), f0 .. f3 its SimHash of 256 bits, o0 .. o7 the
    parities of its 512 classes, k0 .. k7 its smallest hashes and `keys` the pairs of these, by the larger one.
    """
    longs = ["node", "fp", "size", *PRINTS, *PARITIES, *FEW]
    schema = "doc_id long, mark long, " + "".join(f"{c} long, " for c in longs) + "keys array<long>, hashes array<int>"

    def batches(parts):
        import numpy as np
        import xxhash

        digest = xxhash.xxh64_intdigest
        left, right = np.array(key_places()).T

        def row(text):
            words = (text or "").encode("utf-8", "surrogatepass").lower().split()
            line = b" ".join(words)
            n = max(1, len(words) - width + 1) if words else 0
            ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
            starts = np.concatenate(([0], ends[:-1] + 1))[:n].tolist()
            stops = ends[min(width, len(words)) - 1 :].tolist() if n else []
            hashes = np.unique(np.array([digest(line[a:b], seed) for a, b in zip(starts, stops, strict=True)], dtype="<u8"))
            ones, mixed, prints = 0, hashes, []
            for k in range(4):
                ones = np.zeros(64, np.int64)
                for at in range(0, len(mixed), BITS_AT_ONCE):
                    ones += np.unpackbits(mixed[at : at + BITS_AT_ONCE].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
                prints.append(int(np.packbits(ones * 2 > len(mixed), bitorder="little").view("<i8")[0]))
                mixed = (mixed ^ (mixed >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + np.uint64(k)
                mixed ^= mixed >> np.uint64(29)
            short = np.unique(hashes.astype("<u4"))
            odd = np.packbits(np.bincount(short & np.uint32(511), minlength=512) & 1, bitorder="little").view("<i8").tolist()
            few = hashes[:SKETCH]
            chosen = right < len(few)
            pairs = (few[left[chosen]] * np.uint64(0x9E3779B97F4A7C15)) ^ few[right[chosen]]
            node = int(np.uint64(digest(hashes.tobytes(), seed)).view(np.int64))
            return node, simhash(text), len(hashes), *prints, *odd, *few.view("i8").tolist(), *[None] * (SKETCH - len(few)), pairs.view("i8"), short.view("<i4")

        for part in few_at_a_time(parts):
            columns = list(zip(*map(row, part.column(1).to_pylist()), strict=True)) or [[]] * (len(longs) + 2)
            kinds = [pa.int64()] * len(longs) + [pa.list_(pa.int64()), pa.list_(pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(2), *(pa.array(c, k) for c, k in zip(columns, kinds, strict=True))],
                names=["doc_id", "mark", *longs, "keys", "hashes"])

    return docs.select(F.col("doc_id").cast("long"), "text", text_mark()).mapInArrow(batches, schema)


def key_places() -> list[tuple[int, int]]:
    """Places, in a sketch, of the two hashes of each key; keys of a shorter sketch come first."""
    return [(i, j) for j in range(SKETCH) for i in range(j)]


def text_mark():
    return F.xxhash64(F.coalesce("text", F.lit(""))).alias("mark")


def sieve(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """`rows` without most of those whose node is not among `nodes`: a table of `SIEVE` words of 64 bits at
    most, the same at any scale, goes to every task, so the others are never shuffled."""
    word = F.shiftrightunsigned("node", 6).bitwiseAND(F.lit(SIEVE - 1))
    words = nodes.select(word.alias("word"), F.expr("shiftleft(1L, cast(node & 63 AS int))").alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits"))
    held = rows.join(F.broadcast(words), word == F.col("word"))
    return held.where("(shiftrightunsigned(bits, cast(node & 63 AS int)) & 1L) = 1L").select(*rows.columns)


def alike(pairs: DataFrame, sets: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The (u, v) of `pairs` whose shingle sets have a similarity of 0.8 or more, and the staged table they are read from."""
    nodes = pairs.select(F.col("u").alias("node")).union(pairs.select("v")).distinct()
    own = sieve(sets.select("node", "hashes"), nodes).join(nodes, "node").dropDuplicates(["node"])  # a semi join would be moved below the sieve
    own = stage(own, "alike")  # sets without a partner hardly move
    both = pairs.join(own.select(F.col("node").alias("u"), F.col("hashes").alias("a")), "u").join(own.select(F.col("node").alias("v"), F.col("hashes").alias("b")), "v")
    return both.where(F.size(F.array_intersect("a", "b")) * 9 >= (F.size("a") + F.size("b")) * 4).select("u", "v"), own


def similar_groups(docs: DataFrame, bits: int | None = None) -> DataFrame:
    """(doc_id, mark, component_id, root) for every row, by five-word similarity of 0.8 or more and, with
    `bits`, by SimHash fingerprints within that many bits, looked up as in `near_groups`. A component has
    one root, also where an id is repeated in several. Tables go as soon as nothing reads them."""
    sets = stage(shingle_sets(docs), "sets")
    marks = ["size", *PRINTS, *PARITIES, *FEW]
    nodes = sets.groupBy("node").agg(*[F.first(c).alias(c) for c in marks])
    upto = F.array(*[F.lit(j + 1) for _, j in key_places()])
    keyed = sets.select("node", F.posexplode("keys").alias("place", "key")).select("node", "key", F.get(upto, "place").alias("upto")).distinct()
    shared = keyed.groupBy("key").agg(F.min("node").alias("lead"), F.max("node").alias("last")).where("lead <> last").select("key", "lead")
    met = stage(keyed.join(shared, "key").join(nodes, "node"), "keyed")

    def apart(a, b, columns):
        return sum((F.bit_count(F.col(f"{a}.{c}").bitwiseXOR(F.col(f"{b}.{c}"))) for c in columns), F.lit(0))

    def near(a, b):
        x, y = F.col(f"{a}.size"), F.col(f"{b}.size")
        like = (x * 5 >= y * 4) & (y * 5 >= x * 4) & (apart(a, b, PARITIES) * 9 <= x + y)
        return like & ((F.least(x, y) < MANY) | (apart(a, b, PRINTS) <= FAR))

    def first_meeting(a, b):
        own = [F.slice(F.array(*[f"{t}.{k}" for k in FEW]), F.lit(1), F.col(f"{t}.upto")) for t in (a, b)]
        return F.size(F.array_intersect(*own)) == 2

    def groups_after(rows, links):
        """(node, root) of the nodes that the links of `rows`, pairs of node and lead, and `links` join."""
        lead = rows.select("lead", "node", *marks[:-SKETCH]).distinct().alias("x").join(nodes.alias("y"), F.col("x.lead") == F.col("y.node")).where(near("x", "y"))
        leads = stage(lead.select(F.col("x.node").alias("u"), F.col("lead").alias("v")), "leads")
        close, own = alike(leads, sets)
        roots = components(close if links is None else close.union(links))
        unstage(own)
        unstage(leads)
        return roots

    def split_keys(rows, roots):
        """The rows of keys that hold several groups, with their roots, and a lead of each key dealt by hash."""
        rooted = rows.drop("root", "lead").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        dealt = F.xxhash64("key", "node")
        split = rooted.groupBy("key").agg(F.min("root").alias("r"), F.max("root").alias("s"), F.min_by("node", dealt).alias("lead"), F.min_by("root", dealt).alias("lead_root"))
        return stage(rooted.drop("lead_root").join(split.where("r <> s").select("key", "lead", "lead_root"), "key"), "rooted")

    first = groups_after(met.where("node <> lead"), None)
    rooted = split_keys(met, first)
    unstage(met)
    forest = groups_after(rooted.where("root <> lead_root"), first.select(F.col("node").alias("u"), F.col("root").alias("v")))
    left = split_keys(rooted, forest)
    unstage(rooted)
    rest = left.alias("x").join(left.alias("y"), (F.col("x.key") == F.col("y.key")) & (F.col("x.node") > F.col("y.node")) & (F.col("x.root") != F.col("y.root")) & near("x", "y") & first_meeting("x", "y"))
    rest = stage(rest.select(F.col("x.node").alias("u"), F.col("y.node").alias("v")), "rest")
    unstage(left)
    more, own = alike(rest, sets)
    found = forest.select(F.col("node").alias("u"), F.col("root").alias("v")).union(more)
    if bits is not None:
        prints = sets.select("fp", "node").distinct()
        touching = print_groups(prints.select("fp").distinct(), bits).withColumnRenamed("node", "fp")
        linked = prints.join(touching, "fp", "left").select("node", F.coalesce("root", "fp").alias("print"))
        low = linked.groupBy("print").agg(F.min("node").alias("v"))
        found = found.union(linked.join(low, "print").select(F.col("node").alias("u"), "v"))
    roots = components(found)
    for table in (own, rest):
        unstage(table)
    smallest = sets.groupBy("node").agg(F.min("doc_id").alias("low")).join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    low = smallest.groupBy("root").agg(F.min("low").alias("component_id"))
    out = stage(sets.select("doc_id", "mark", "node").join(smallest.select("node", "root").join(low, "root"), "node").select("doc_id", "mark", "component_id", "root"), "groups")
    unstage(sets)
    return out


def first_of_groups(docs: DataFrame) -> DataFrame:
    """`docs` with one row for each group of near documents, by SimHash within three bits or by
    similarity of 0.8: that of its smallest doc_id.

    A row is judged within its own group, so rows that share an id but not their text are documents
    of their own; of similar rows with one id one stays. Rows without an id all stay.
    """
    rows = similar_groups(docs, 3).where("doc_id = component_id").groupBy("root").agg(F.first("doc_id").alias("kept id"), F.min("mark").alias("kept mark"))
    mark, nth = fresh(docs, "mark"), fresh(docs, "nth")
    kept = docs.where("doc_id IS NOT NULL").withColumn(mark, text_mark())
    kept = kept.join(rows.select("kept id", "kept mark").distinct(), (kept["doc_id"] == rows["kept id"]) & (kept[mark] == rows["kept mark"]), "left_semi")
    once = Window.partitionBy("doc_id", mark).orderBy("doc_id")  # equal rows
    kept = kept.withColumn(nth, F.row_number().over(once)).where(F.col(nth) == 1).select(*docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = near_groups(read(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
