"""Nearest neighbours by a forest of random-projection trees, with exact reranking.

Trees split a bounded sample of vectors (at most about `SAMPLE` rows, picked by a hash of vec_id)
at medians of random directions; every vector of the table is then routed through every tree.
A query walks all trees through one priority queue, keyed by the least margin on the way, until it
has opened `leaves` leaves. Leaves meet their queries in (tree, leaf, chunk) groups - chunks keep a
group bounded when the table outgrows the sample - where inner products are taken on the
original vectors in double precision; the best of all groups are ranked at the end.

A leaf visit returns at most k rows a query. Of equal vectors only the k + 1 smallest ids can rank,
so only those are indexed; they count as queries all the same.

Defined cases: vectors that are null, empty, zero, hold null or non-finite components, or have another
length than most, take no part; rows with a null id take no part; repeated ids of equal vectors
count once; with fewer than k candidates all are returned; ties go to the smaller id; empty tables
give no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cuelake.llm.common import read, stage

TREES = 8
LEAF = 512
SAMPLE = 65_536
LEAVES = 96
CHUNK = 20_000


def usable(vec: str = "vec") -> Column:
    v = F.col(vec)
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return v.isNotNull() & (F.size(v) > 0) & fine & F.exists(v, lambda x: x != 0)


def _matrix(column):
    import numpy as np

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    n = len(column)
    return column.flatten().to_numpy(zero_copy_only=False).reshape(n, -1).astype(np.float64) if n else np.zeros((0, 1))


def fit(sample, trees: int = TREES, leaf: int = LEAF, seed: int = 5):
    """(directions, thresholds): complete binary trees, nodes in heap order, split at medians."""
    import numpy as np

    depth = max(0, int(np.ceil(np.log2(max(1, len(sample) / leaf)))))
    inner = (1 << depth) - 1
    normals, limits = np.zeros((trees, inner, sample.shape[1]), np.float32), np.zeros((trees, inner), np.float32)
    rng = np.random.default_rng(seed)
    for t in range(trees):
        groups = {0: np.arange(len(sample))}
        for node in range(inner):
            rows = groups.pop(node)
            a = sample[rng.choice(rows)] - sample[rng.choice(rows)] if len(rows) > 1 else np.zeros(sample.shape[1])
            if not np.any(a):
                a = rng.standard_normal(sample.shape[1])
            a = a / np.linalg.norm(a)
            side = sample[rows] @ a
            order = np.argsort(side, kind="stable")
            half = len(rows) // 2
            limits[t, node] = side[order[half]] if len(rows) else 0.0
            normals[t, node] = a
            groups[2 * node + 1], groups[2 * node + 2] = rows[order[:half]], rows[order[half:]]
    return normals, limits


def route(vectors, normals, limits):
    """Leaf of every vector in every tree: (vectors, trees)."""
    import numpy as np

    trees, inner = limits.shape
    out = np.zeros((len(vectors), trees), np.int32)
    for t in range(trees):
        side = vectors @ normals[t].T >= limits[t] if inner else None
        node = np.zeros(len(vectors), np.int64)
        while inner and node[:1].size and node[0] < inner:  # all leaves are equally deep
            node = 2 * node + 1 + side[np.arange(len(node)), node]
        out[:, t] = node - inner
    return out


def opened(query, normals, limits, leaves: int):
    """The (tree, leaf) pairs that one queue over all trees opens first for this query."""
    trees, inner = limits.shape
    margins = [(normals[t] @ query - limits[t]).tolist() for t in range(trees)]
    heap = [(-float("inf"), t, 0) for t in range(trees)]
    found = []
    while heap and len(found) < leaves:
        key, t, node = heapq.heappop(heap)
        if node >= inner:
            found.append((t, node - inner))
            continue
        m = margins[t][node]
        heapq.heappush(heap, (max(key, -m), t, 2 * node + 2))
        heapq.heappush(heap, (max(key, m), t, 2 * node + 1))
    return found


def _best(left: pa.Table, right: pa.Table, k: int) -> pa.Table:
    import numpy as np

    qid, vid = left.column("query_id").to_numpy(), right.column("vec_id").to_numpy()
    q, v = _matrix(left.column("vec")), _matrix(right.column("vec"))
    outs = ([], [], [])
    step = max(1, 4_000_000 // max(1, len(vid)))
    for at in range(0, len(qid), step) if len(vid) else ():
        rough = q[at : at + step] @ v.T
        rough[qid[at : at + step, None] == vid[None, :]] = -np.inf
        keep = min(k, len(vid))
        bar = np.partition(rough, len(vid) - keep, axis=1)[:, len(vid) - keep]
        slack = 1e-9 * (1 + np.abs(bar[np.isfinite(bar)]).max(initial=0.0))
        i, j = np.nonzero((rough >= np.where(np.isfinite(bar), bar, -np.inf)[:, None] - slack) & np.isfinite(rough))
        exact = (q[at + i] * v[j]).sum(axis=1)  # one order of summing for a pair, wherever it meets
        order = np.lexsort((vid[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        head = np.arange(len(i)) - np.searchsorted(i, i) < k
        outs[0].append(qid[at + i[head]]), outs[1].append(vid[j[head]]), outs[2].append(exact[head])
    whole = [np.concatenate(x) if x else np.zeros(0, d) for x, d in zip(outs, ("i8", "i8", "f8"), strict=True)]
    return pa.table(dict(zip(("query_id", "vec_id", "score"), whole, strict=True)))


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20, trees: int = TREES, leaf: int = LEAF, leaves: int = LEAVES, sample: int = SAMPLE) -> DataFrame:
    """(query_id, rank, vec_id, score) of (vec_id, vec) tables; a query is no neighbour of its own id."""
    import numpy as np

    rows = vectors.select(F.col("vec_id").cast("long"), F.col("vec").cast("array<double>").alias("vec")).where(usable() & F.col("vec_id").isNotNull())
    asked = queries.select(F.col("vec_id").cast("long").alias("query_id"), F.col("vec").cast("array<double>").alias("vec")).where(usable() & F.col("vec_id").isNotNull())
    lengths = rows.groupBy(F.size("vec").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
    schema = "query_id long, vec_id long, score double"
    if not lengths:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    d, n = lengths[0]["d"], lengths[0]["count"]
    rows, asked = rows.where(F.size("vec") == d), asked.where(F.size("vec") == d).dropDuplicates(["query_id", "vec"])
    same = Window.partitionBy("vec").orderBy("vec_id")
    rows = rows.dropDuplicates(["vec_id", "vec"]).withColumn("_n", F.row_number().over(same)).where(F.col("_n") <= k + 1).drop("_n")
    rows = stage(rows.withColumn("vec", F.col("vec").cast("array<float>")) if dict(vectors.dtypes)["vec"] == "array<float>" else rows, "vectors")
    luck = F.pmod(F.xxhash64("vec_id", F.lit("fit")), F.lit(1 << 24)) < int((1 << 24) * min(1.0, sample / n))
    picked = rows.where(luck).orderBy("vec_id").toArrow()
    normals, limits = fit(_matrix(picked.column("vec")) if picked.num_rows else np.zeros((0, d)), trees, leaf)
    chunks = max(1, -(-n // (limits.shape[1] + 1) // CHUNK))

    def routed(parts):
        for part in parts:
            v = part.column(1)
            at = route(_matrix(v), normals, limits)
            for t in range(trees):
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(v), t, np.int32)), pa.array(at[:, t]), part.column(0), v], names=["tree", "leaf", "vec_id", "vec"])

    def asking(parts):
        for part in parts:
            m = _matrix(part.column(1)).astype(np.float32)
            hits = [(i, t, x) for i, q in enumerate(m) for t, x in opened(q, normals, limits, leaves)]
            i, t, x = (np.array(c, np.int32) for c in (zip(*hits, strict=True) if hits else ([], [], [])))
            yield pa.RecordBatch.from_arrays([pa.array(t), pa.array(x), part.column(0).take(pa.array(i)), part.column(1).take(pa.array(i))], names=["tree", "leaf", "query_id", "vec"])

    kind = dict(rows.dtypes)["vec"]
    placed = rows.mapInArrow(routed, f"tree int, leaf int, vec_id long, vec {kind}").withColumn("chunk", F.pmod(F.xxhash64("vec_id"), F.lit(chunks)))
    wanted = asked.select("query_id", F.col("vec").cast(kind).alias("vec")).repartition(int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions")), "query_id").mapInArrow(asking, f"tree int, leaf int, query_id long, vec {kind}")
    wanted = wanted.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))).withColumn("chunk", F.col("chunk").cast("long"))
    keys = ["tree", "leaf", "chunk"]
    met = wanted.groupBy(*keys).cogroup(placed.groupBy(*keys)).applyInArrow(lambda left, right: _best(left, right, k), schema)
    best = met.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op10_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vec"))
    return nearest(vectors, vectors.where(F.col("vec_id") % 20 == 0))
