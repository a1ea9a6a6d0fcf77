"""Near copies among vectors, found by sorted projection passes.

A pass hashes every vector to the signs of `BITS` random projections, concatenated, orders all vectors
by these hashes and compares each with the `WINDOW` that follow it. Pairs that reach the cosine are
verified in double precision; a block of the order returns a spanning forest of its verified pairs,
at most one row a vector, and the forests of all passes are united to components. Blocks overlap by
the window, so nothing depends on where they end. The number of passes follows from the number of
vectors: as many as find a pair that just reaches the cosine with probability `GOAL` (nearer pairs
are found far more surely; where all vectors fit into one window, all pairs are found).

Links inside a component are then counted whole, however many a window shows: by their angle to
the component's smallest vector, its members fall into narrow rings. Of two rings the triangle
inequality often says that all pairs link, or none; the rest is compared in blocks. Counts alone
leave a block, never pairs, and equal vectors count as one with a weight.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components, or have another
length than most, link with nothing; each row is a vector of its own, also with a repeated or null id;
the component of rows without any id is null, and they are kept; other columns are ignored.
"""

from __future__ import annotations

import math

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cuelake.llm.common import components, read, stage, unstage
from cuelake.llm.forest import _matrix, usable

LEAST = 0.9
WINDOW = 256
BITS = 60
GOAL = 0.95
BLOCK_BYTES = 32 << 20
RINGS = 17  # rings within the angle of the least cosine
SLACK = 1e-6


def passes_for(n: int, least: float = LEAST, window: int = WINDOW, goal: float = GOAL) -> int:
    """Passes that find a pair of cosine `least` with probability `goal` among n vectors: it must agree
    on the leading signs that tell n / window groups apart."""
    if n <= window:
        return 1
    together = (1 - math.acos(least) / math.pi) ** min(BITS, math.log2(n / window))
    return max(1, math.ceil(math.log(1 - goal) / math.log1p(-together)))


def _unit(column):
    import numpy as np

    m = _matrix(column)
    scale = np.abs(m).max(axis=1, keepdims=True, initial=0.0)
    m = m / np.where(scale > 0, scale, 1)
    return m / np.maximum(np.linalg.norm(m, axis=1, keepdims=True), 1e-300)


def signs(units, number: int, seed: int):
    """Sign bits of a pass, the first projection in the highest bit."""
    import numpy as np

    planes = np.random.default_rng([seed, number]).standard_normal((units.shape[1], BITS))
    return ((units @ planes) >= 0) @ (np.int64(1) << np.arange(BITS - 1, -1, -1, dtype=np.int64))


def forest_of_windows(units, least: float, window: int):
    """(place, place) links that join what verified pairs at most `window` places apart join."""
    import numpy as np

    n, step, out = len(units), max(64, window), []
    for at in range(0, n - 1, step):
        near = units[at : at + step + window]
        rows = min(step, n - at)
        hit = near[:rows] @ near.T >= least
        gap = np.arange(len(near))[None, :] - np.arange(rows)[:, None]
        hit &= (gap > 0) & (gap <= window)
        if not hit.any():
            continue
        name, was = np.arange(len(near)), None
        while was is None or (name != was).any():
            was = name.copy()
            name[:rows] = np.minimum(name[:rows], np.where(hit, name[None, :], n).min(axis=1, initial=n))
            name = np.minimum(name, np.where(hit, name[:rows, None], n).min(axis=0, initial=n))
            name = name[name]
        joined = np.flatnonzero(name != np.arange(len(near)))
        out.append(np.stack([at + name[joined], at + joined], axis=1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def _pass_blocks(nodes: DataFrame, n: int, d: int, passes: int, window: int, seed: int) -> list[tuple[list, list]]:
    """For every pass, the (hash, node) at which each block starts and those at which its overlap ends."""
    import numpy as np

    spark = nodes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block = max(8 * window, min(BLOCK_BYTES // (8 * d), -(-n // parts)))

    def hashed(batches):
        for batch in batches:
            units = _unit(batch.column(1))
            for number in range(passes):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(units), number, np.int32)), pa.array(signs(units, number, seed)), batch.column(0)], names=["pass", "hash", "node"])

    def placed(batches):
        from pyspark import TaskContext

        part, seen = TaskContext.get().partitionId(), 0
        for batch in batches:
            k = len(batch)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.full(k, part, np.int32)), pa.array(np.arange(seen, seen + k))], names=["pass", "hash", "node", "part", "seen"])
            seen += k

    order = ["pass", "hash", "node"]
    keys = nodes.select("node", "vec").mapInArrow(hashed, "pass int, hash long, node long")
    keys = keys.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    keys = stage(keys.mapInArrow(placed, "pass int, hash long, node long, part int, seen long"), "order")
    sizes = {r["part"]: r["n"] for r in keys.groupBy("part").agg(F.count("*").alias("n")).collect()}
    begins, total = [], 0
    for part in range(max(sizes, default=0) + 1):
        begins.append(total)
        total += sizes.get(part, 0)
    # every pass holds all n nodes, so a row's place in its pass is its rank modulo n
    rank = (F.element_at(F.lit(begins).cast("array<long>"), F.col("part") + 1) + F.col("seen")) % n
    marks = keys.withColumn("rank", rank).where((F.col("rank") % block == 0) | (F.col("rank") % block == window)).select(*order, "rank").collect()
    unstage(keys)
    out = []
    for number in range(passes):
        mine = sorted((r["hash"], r["node"], r["rank"]) for r in marks if r["pass"] == number)
        out.append(([(h, x) for h, x, r in mine if r % block == 0], [(h, x) for h, x, r in mine if r % block == window and r > block]))
    return out


def _pass_links(nodes: DataFrame, number: int, marks: tuple[list, list], least: float, window: int, seed: int) -> DataFrame:
    import numpy as np

    kind = dict(nodes.dtypes)["vec"]
    pair = np.dtype([("h", np.int64), ("x", np.int64)])
    starts, ends = (np.array(m, dtype=pair) for m in marks)

    def dealt(batches):
        for batch in batches:
            own = np.empty(len(batch), pair)
            own["h"], own["x"] = signs(_unit(batch.column(1)), number, seed), batch.column(0).to_numpy()
            home = np.searchsorted(starts, own, side="right") - 1
            # the first rows of a block are compared with the last of the block before, too
            early = np.flatnonzero((home > 0) & (np.searchsorted(ends, own, side="right") < home))
            at = np.concatenate([np.arange(len(own)), early])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate([home, home[early] - 1])), pa.array(own["h"][at]), batch.column(0).take(pa.array(at)), batch.column(1).take(pa.array(at))], names=["block", "hash", "node", "vec"])

    def compared(block: pa.Table) -> pa.Table:
        node = block.column("node").to_numpy()
        order = np.lexsort((node, block.column("hash").to_numpy()))
        links = node[order][forest_of_windows(_unit(block.column("vec"))[order], least, window)]
        return pa.table({"u": links[:, 0], "v": links[:, 1]})

    rows = nodes.select("node", "vec").mapInArrow(dealt, f"block long, hash long, node long, vec {kind}")
    return rows.groupBy("block").applyInArrow(compared, "u long, v long")


def _link_counts(members: DataFrame, least: float, block: int) -> DataFrame:
    """(node, links): summed weights of a component's vectors within the cosine, the vector itself included.
    `members`: (comp, node, weight, vec, centre)."""
    import numpy as np

    limit = math.acos(least)
    width = limit / RINGS
    kind = dict(members.dtypes)["vec"]

    def ringed(batches):
        for batch in batches:
            a, b = _unit(batch.column(3)), _unit(batch.column(4))
            # by the chord, which keeps small angles exact
            angle = 2 * np.arcsin(np.clip(np.linalg.norm(a - b, axis=1) / 2, 0, 1))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array((angle / width).astype(np.int32))], names=["comp", "node", "weight", "vec", "ring"])

    ringed_rows = stage(members.mapInArrow(ringed, f"comp long, node long, weight long, vec {kind}, ring int"), "rings")
    sums = ringed_rows.groupBy("comp", "ring").agg(F.sum("weight").alias("weight"), F.count("*").alias("n"))
    met = sums.join(sums.select("comp", F.col("ring").alias("other"), F.col("weight").alias("heavy"), F.col("n").alias("m")), "comp")
    met = met.where((F.abs(F.col("ring") - F.col("other")) - 1) * width <= limit + SLACK)
    sure = (F.col("ring") + F.col("other") + 2) * width <= limit - SLACK
    met = stage(met.withColumn("sure", sure), "ring-pairs")
    known = met.where("sure").groupBy("comp", "ring").agg(F.sum("heavy").alias("links"))
    counts = ringed_rows.join(known, ["comp", "ring"]).select("node", "links")
    open_pairs = met.where("not sure").select("comp", "ring", "other", F.ceil(F.col("n") / block).alias("rows"), F.ceil(F.col("m") / block).alias("cols"))
    keys = ["comp", "ring", "other", "i", "j"]
    here = F.pmod(F.xxhash64("node"), F.col("rows"))
    left = ringed_rows.join(open_pairs, ["comp", "ring"]).withColumn("i", here).withColumn("j", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cols") - 1)))
    right = ringed_rows.toDF("comp", "node", "weight", "vec", "other").join(open_pairs, ["comp", "other"])
    right = right.withColumn("j", F.pmod(F.xxhash64("node"), F.col("cols"))).withColumn("i", F.explode(F.sequence(F.lit(0).cast("long"), F.col("rows") - 1)))

    def counted(a: pa.Table, b: pa.Table) -> pa.Table:
        node, other, weight = a.column("node").to_numpy(), b.column("node").to_numpy(), b.column("weight").to_numpy()
        if not len(node) or not len(other):
            return pa.table({"node": np.zeros(0, np.int64), "links": np.zeros(0, np.int64)})
        u, v = _unit(a.column("vec")), _unit(b.column("vec"))
        links = [(((u[k : k + 512] @ v.T) >= least) | (node[k : k + 512, None] == other[None, :])) @ weight for k in range(0, len(node), 512)]
        return pa.table({"node": node, "links": np.concatenate(links).astype(np.int64)})

    shape = ["node", "weight", "vec"]
    compared = left.select(*keys, *shape).groupBy(*keys).cogroup(right.select(*keys, *shape).toDF(*keys, *shape).groupBy(*keys)).applyInArrow(counted, "node long, links long")
    return counts.union(compared).groupBy("node").agg(F.sum("links").alias("links"))


def near_links(vectors: DataFrame, least: float = LEAST, window: int = WINDOW, goal: float = GOAL, seed: int = 11) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of a (vec_id, vec) table."""
    kind = "array<float>" if dict(vectors.dtypes)["vec"] == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("vec").cast(kind).alias("vec"))
    fine = rows.where(usable())
    top = fine.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    d = top[0]["d"] if top else 0
    good = F.coalesce(usable() & (F.size("vec") == d), F.lit(False))
    named = rows.select("vec_id", *(F.when(good, F.xxhash64(F.lit(x), "vec")).alias(f"h{x}") for x in (0, 1)))
    same = fine.where(F.size("vec") == d).groupBy(*(F.xxhash64(F.lit(x), "vec").alias(f"h{x}") for x in (0, 1)))
    nodes = same.agg(F.first("vec").alias("vec"), F.count("*").alias("weight"), F.min("vec_id").alias("least_id"))
    nodes = stage(nodes.withColumn("node", F.monotonically_increasing_id()), "vectors")
    n = nodes.count()
    links = None
    if n > 1:
        passes = passes_for(n, least, window, goal)
        marks = _pass_blocks(nodes, n, d, passes, window, seed)
        for number in range(passes):
            found = stage(_pass_links(nodes, number, marks[number], least, window, seed), "pass")
            links = found if links is None else links.union(found)
    if links is None:
        links = nodes.where("false").select(F.col("node").alias("u"), F.col("node").alias("v"))
    member = stage(components(links).select("node", F.col("root").alias("comp")).distinct(), "members")
    inside = nodes.join(member, "node")
    centres = nodes.join(member.where("node = comp"), "node").select(F.col("node").alias("comp"), F.col("vec").alias("centre"))
    pairs = inside.select("comp", "node", "weight", "vec").join(centres, "comp").select("comp", "node", "weight", "vec", "centre")
    counts = _link_counts(pairs, least, max(256, BLOCK_BYTES // (16 * max(1, d))))
    smallest = inside.groupBy("comp").agg(F.min("least_id").alias("least_of_all"))
    known = nodes.select("node", "h0", "h1", "weight", "least_id").join(member, "node", "left").join(counts, "node", "left").join(smallest, "comp", "left")
    known = known.select("h0", "h1", F.coalesce("links", "weight").alias("links"), F.coalesce(F.when(F.col("comp").isNotNull(), F.col("least_of_all")), "least_id").alias("component_id"))
    out = named.join(known, ["h0", "h1"], "left")
    component = F.when(F.col("links").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select("vec_id", F.coalesce(F.col("links") - 1, F.lit(0).cast("long")).alias("n_links"), component.alias("component_id"), F.coalesce(F.col("vec_id") == component, component.isNull()).alias("kept"))


def op12_passes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_links(read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec")))


SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (SELECT a.vec_id u, b.vec_id v FROM v a, v b WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach AS (SELECT u, v FROM link UNION SELECT r.u, l.v FROM reach r JOIN link l ON r.v = l.u),
root AS (SELECT u, min(v) v FROM reach GROUP BY u),
n AS (SELECT u, count(*) n FROM link GROUP BY u)
SELECT vec_id, coalesce(n.n, 0)::BIGINT AS n_links, least(vec_id, coalesce(root.v, vec_id)) AS component_id,
  vec_id = least(vec_id, coalesce(root.v, vec_id)) AS kept
FROM embeddings LEFT JOIN n ON n.u = vec_id LEFT JOIN root ON root.u = vec_id
"""
